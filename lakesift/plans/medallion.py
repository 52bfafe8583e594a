"""The layered load: staged tables are checked into a silver layer, aggregated into
wide facts, gated by expectation suites, published, and verified."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakesift.functions.columns import venue, with_audit
from lakesift.operators.checks import (
    REASONS,
    Reference,
    check_primary_key,
    classify,
    flag_rows,
)
from lakesift.operators.expectations import Expectation, passed, run_suite
from lakesift.operators.facts import rate_fact
from lakesift.operators.joins import Lookup
from lakesift.operators.joins import star as join_star
from lakesift.session import names_in, remove, scratch
from lakesift.sources.catalog import load_required
from lakesift.sources.commits import CommitLog
from lakesift.sources.published import Shelf, verify_loaded
from lakesift.sources.rejects import append_rejects
from lakesift.sources.runlog import RunLog


@dataclass(frozen=True)
class GalaxyRules:
    """What holds between the tables of a silver layer.

    ``references`` maps a fact to ``{dimension: (fact key, dimension key)}``.
    """

    primary_keys: Mapping[str, Sequence[str]]
    references: Mapping[str, Mapping[str, tuple[str, str]]]
    non_negative: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def fact_order(self, facts: Sequence[str]) -> list[str]:
        """Facts in an order in which a fact that serves as dimension comes first."""
        pending, ordered = list(facts), []
        while pending:
            ready = [
                f for f in pending
                if not any(d in pending and d != f for d in self.references[f])
            ]
            if not ready:
                raise ValueError(f"facts refer to each other in a circle: {pending}")
            ordered += ready
            pending = [f for f in pending if f not in ready]
        return ordered


@dataclass(frozen=True)
class FactRules:
    """How one wide fact is built and judged."""

    name: str
    source: str
    keys: Sequence[str]
    metrics: Sequence[str]
    time: str
    time_out: str
    suite: Sequence[Expectation]
    cast: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Role:
    """One dimension in one role: fact column, dimension, its key, columns to add."""

    dim: str
    key: str
    dim_key: str
    cols: Mapping[str, str]


@dataclass(frozen=True)
class StarRules:
    """Main dimension (inner join), further roles (left joins) and the venue keys."""

    main: Role
    roles: Sequence[Role]
    own_key: str
    home_key: str


# -- silver ------------------------------------------------------------------

# Staging numbers its rows anew in every run; survivors must not depend on that.
SURROGATES = ("index",)


def silver_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """The folder of every silver table, as the last complete load left them."""
    return CommitLog(spark, f"{root.rstrip('/')}/commits").head().get("tables", {})


def read_silver(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A silver table: accepted rows only."""
    return spark.read.parquet(silver_tables(spark, root)[table])


def remove_old_loads(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of loads none of whose tables is current; returns their names.

    Only for times when no load is running and nobody reads what was current before.
    """
    kept = {path.rstrip("/").rsplit("/", 2)[1] for path in silver_tables(spark, root).values()}
    old = sorted(set(names_in(spark, f"{root.rstrip('/')}/loads")) - kept)
    for name in old:
        remove(spark, f"{root.rstrip('/')}/loads/{name}")
    return old


def _write_split(flagged: DataFrame, path: str, rejects_root: str, key: Column, run: tuple[str, str]) -> int:
    """Accepted rows to the silver table at ``path``, the others to the rejects; returns their number.

    The flagged rows are written once to a run folder, so that the joins behind
    them are not repeated, and read from there by both writes.
    """
    spark = flagged.sparkSession
    folder = scratch(spark, "flagged")
    rejected = F.col("issue_type").isNotNull()
    seen = Observation(f"rows of {path}")
    try:
        flagged.observe(seen, F.count_if(rejected).alias("rejected")).write.parquet(folder)
        stored = spark.read.schema(flagged.schema).parquet(folder)
        clean = with_audit(stored.where(~rejected).drop(*REASONS), *run)
        clean.write.parquet(path)
        if seen.get["rejected"]:
            append_rejects(stored.where(rejected), rejects_root, key, *run)
    finally:
        remove(spark, folder)
    return seen.get["rejected"]


@contextmanager
def recorded(log: RunLog, step: str, spark: SparkSession) -> Iterator[None]:
    """Run a step; a failure is logged with its class and what follows goes on."""
    try:
        yield
    except Exception as e:  # noqa: BLE001  whatever ends a step must not end the load
        log.error(step, e, str(e).partition("\n")[0][:500])
    finally:
        log.flush(spark)


class MissingInput(Exception):
    """A table that a step needs was not loaded."""


def load_silver(
    tables: Mapping[str, DataFrame],
    rules: GalaxyRules,
    silver_root: str,
    rejects_root: str,
    log: RunLog,
) -> dict[str, DataFrame]:
    """Check staged tables and write the silver layer; returns the tables that were loaded.

    Every load writes to a folder of its own and then makes its tables current in one commit, so readers see the
    layer before or after a load, and one that is killed leaves it as it was. A table that was not loaded stays
    what it was. Dimensions are checked for unique keys. Facts are checked against the cleaned
    dimensions and for signs. A silver table holds its accepted rows and nothing
    else; rejects go to the rejects dataset. A table that fails is logged with its
    error class, and so are the facts that need it; all others still load.
    """
    if not tables:
        log.step("load_to_silver", "success")
        return {}
    spark = next(iter(tables.values())).sparkSession
    root = f"{silver_root.rstrip('/')}/loads/{uuid.uuid4().hex}"
    groups = classify(list(tables), list(rules.primary_keys), list(rules.references))
    if groups["uncategorised"]:
        log.step("sort_tables", "warning", groups["uncategorised"])
        for t in groups["uncategorised"]:
            log.add("sort_tables", "uncategorised", t)
    run = (log.pipeline_id, log.run_id)
    silver: dict[str, DataFrame] = {}

    for t in groups["dimension"]:
        with recorded(log, f"check_keys {t}", spark):
            split = check_primary_key(tables[t], rules.primary_keys[t], ignore=SURROGATES)
            rejected = split.metrics.first()["rejected_rows"]
            if rejected:
                append_rejects(split.rejects, rejects_root, t, *run)
            with_audit(split.clean, *run).write.parquet(f"{root}/{t}")
            log.step(f"check_keys {t}", "success", f"{rejected} rows rejected")
            silver[t] = spark.read.parquet(f"{root}/{t}")

    target = F.coalesce("failed_dimension", "failed_column")
    kind = F.when(F.col("failed_dimension").isNotNull(), "orphans").otherwise("negatives")
    ordered: list[str] = []
    with recorded(log, "order_facts", spark):
        ordered = rules.fact_order(groups["fact"])
    for t in ordered:
        with recorded(log, f"check_rows {t}", spark):
            if absent := [d for d in rules.references[t] if d not in silver]:
                raise MissingInput(", ".join(absent))
            refs = [
                Reference(d, silver[d], own, dim_key)
                for d, (own, dim_key) in rules.references[t].items()
            ]
            flagged = flag_rows(tables[t], refs, rules.non_negative.get(t, ()))
            key = F.concat_ws("_", F.lit(t), target, kind)
            rejected = _write_split(flagged, f"{root}/{t}", rejects_root, key, run)
            log.step(f"check_rows {t}", "success", f"{rejected} rows rejected")
            silver[t] = spark.read.parquet(f"{root}/{t}")

    for t in groups["uncategorised"]:
        with recorded(log, f"copy {t}", spark):
            with_audit(tables[t], *run).write.parquet(f"{root}/{t}")
            silver[t] = spark.read.parquet(f"{root}/{t}")
    paths = {t: f"{root}/{t}" for t in silver}
    CommitLog(spark, f"{silver_root.rstrip('/')}/commits").add(lambda head: {"run": list(run), "tables": {**head.get("tables", {}), **paths}})
    for t in sorted(silver):
        log.add("load_to_silver", "tables", t)
    missing = sorted(set(tables) - set(silver))
    log.step("load_to_silver", "failed" if missing else "success", missing or None)
    log.flush(spark)
    return silver


# -- gold --------------------------------------------------------------------


def _lookup(tables: Mapping[str, DataFrame], role: Role) -> Lookup:
    return Lookup(tables[role.dim], role.key, role.dim_key, role.cols)


def build_fact(tables: Mapping[str, DataFrame], fact: FactRules, star: StarRules) -> DataFrame:
    """One wide fact: sums and rates at the grain, then the star around it.

    The sums come first, so only aggregated rows take part in the joins, and
    dimensions of dimensions are joined to one another before.
    """
    rates = rate_fact(
        tables[fact.source], fact.keys, fact.metrics, fact.time, fact.time_out, cast=fact.cast
    )
    roles = [star.main, *star.roles]
    wide = join_star(rates, [_lookup(tables, r) for r in roles], ["inner", *["left"] * len(star.roles)])
    return wide.withColumn("venue", venue(star.own_key, star.home_key))


def build_gold(
    tables: Mapping[str, DataFrame],
    required: Mapping[str, Sequence[str]],
    facts: Sequence[FactRules],
    star: StarRules,
    shelf: Shelf,
    log: RunLog,
    ts: datetime | None = None,
    cluster_by: Sequence[str] = (),
) -> tuple[dict[str, str], bool]:
    """Build, stage and judge every wide fact.

    Staging happens whether or not the suites pass; the second value tells if the
    staged versions may be published. Each suite is evaluated once. A fact that
    fails is logged, closes the gate, and leaves the other facts to be staged.
    """
    spark, staged, judged = shelf.spark, {}, []
    for fact in facts:
        with recorded(log, f"stage {fact.name}", spark):
            needed = {fact.source, star.main.dim, *[r.dim for r in star.roles]}
            if absent := sorted(t for t in needed if t not in tables):
                raise MissingInput(", ".join(absent))
            used = load_required(tables, {t: required[t] for t in required if t in needed})
            staged[fact.name] = shelf.stage(build_fact(used, fact, star), fact.name, ts, cluster_by)
            log.step(f"stage {fact.name}", "success", staged[fact.name])
        with recorded(log, f"suite {fact.name}", spark):
            if fact.name not in staged:
                raise MissingInput(fact.name)
            rows = run_suite(shelf.read_version(staged[fact.name]), fact.suite).collect()
            failed = [r["column"] for r in rows if not r["success"]]
            judged.append(passed(rows))
            log.step(f"suite {fact.name}", "failed" if failed else "success", failed or None)
    proceed = len(judged) == len(facts) and all(judged)
    log.step("gate", "success" if proceed else "failed")
    log.flush(spark)
    return staged, proceed


def publish_gold(
    shelf: Shelf, staged: Mapping[str, str], proceed: bool, log: RunLog, ts: datetime | None = None
) -> DataFrame | None:
    """Publish the staged versions if the gate is open, then verify what is visible."""
    if not proceed:
        log.step("publish", "skipped")
        log.flush(shelf.spark)
        return None
    report = None
    with recorded(log, "publish", shelf.spark):
        shelf.publish(staged, log.pipeline_id, log.run_id, ts)
        log.step("publish", "success")
        report = verify_loaded(shelf.spark, {t: shelf.read_published(t) for t in staged})
        for r in report.collect():
            log.step(f"verify {r['table_name']}", r["status"], r["row_count"])
    return report
