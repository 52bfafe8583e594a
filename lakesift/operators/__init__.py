"""Table operators: joins, duplicates, profiles, checks, expectations, facts, measures."""
