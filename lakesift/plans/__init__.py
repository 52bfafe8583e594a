"""Layer plans: landing to staging, staging to checked tables, checked tables to published facts."""
