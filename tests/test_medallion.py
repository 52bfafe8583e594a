"""Landing text to published facts on a small hand-made lake with known faults."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from conftest import rows

from lakesift.plans import hockey as H
from lakesift.plans import medallion
from lakesift.plans.medallion import GalaxyRules, build_gold, load_silver, publish_gold, read_silver, remove_old_loads
from lakesift.sources import catalog as C
from lakesift.sources import landing as L
from lakesift.sources.published import Shelf
from lakesift.sources.rejects import read_reasons
from lakesift.sources.runlog import RunLog, latest, read_log

TS = datetime(2024, 5, 1, 8, tzinfo=timezone.utc)


def _line(table, **values):
    return ",".join(str(values.get(c, "NA")) for c in H.REGISTRY[table])


def _skater(**values):
    return _line("game_skater_stats", **{**{m: 1 for m in H.SKATER_METRICS if m not in H.SPARSE_METRICS}, **values})


def _goalie(**values):
    return _line("game_goalie_stats", **{**{m: 2 for m in H.GOALIE_METRICS}, **values})


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landing = root / "landing"
    landing.mkdir()

    def land(table, *lines):
        (landing / f"{table}.csv").write_text("\n".join([",".join(H.REGISTRY[table]), *lines]) + "\n")

    game = dict(type="R", date_time_GMT="2016-01-01T00:00:00", away_team_id=1, home_team_id=2, outcome="home win")
    land(
        "game",
        _line("game", game_id=10, season=20152016, **game),
        _line("game", game_id=10, season=20152016, **game),
        _line("game", game_id=11, season=20162017, **game),
        _line("game", game_id=11, season=20162017, away_goals=3, **game),
    )
    land("player_info", _line("player_info", player_id=100, firstName="Ann", lastName="Ice", primaryPosition="C"))
    land("team_info", *[_line("team_info", team_id=i, shortName=f"s{i}", teamName=f"n{i}") for i in (1, 2)])
    land(
        "game_skater_stats",
        _skater(game_id=10, player_id=100, team_id=2, timeOnIce=1200, goals=2),
        _skater(game_id=11, player_id=100, team_id=1, timeOnIce=0),
        _skater(game_id=12, player_id=100, team_id=1, timeOnIce=60),
        _skater(game_id=10, player_id=999, team_id=1, timeOnIce=60),
        _skater(game_id=11, player_id=100, team_id=2, timeOnIce=60, shots=-1),
    )
    land("game_goalie_stats", _goalie(game_id=10, player_id=100, team_id=1, timeOnIce=3600, saves=30))
    land("game_plays", _line("game_plays", play_id="10_1", game_id=10), _line("game_plays", play_id="77_1", game_id=77))
    land(
        "game_plays_players",
        _line("game_plays_players", play_id="10_1", game_id=10, player_id=100),
        _line("game_plays_players", play_id="77_1", game_id=77, player_id=100),
    )
    space = C.create_namespace(spark, C.staging_namespace(TS), str(root / "ns"))
    manifest = L.ingest_folder(spark, str(landing), H.REGISTRY, space)
    log = RunLog("p", "r", str(root / "log"))
    silver = load_silver(
        C.load_namespace(spark, space), H.GALAXY, str(root / "silver"), str(root / "rejects"), log
    )
    shelf = Shelf(spark, str(root / "gold"))
    staged, proceed = build_gold(silver, H.REQUIRED, H.FACTS, H.STAR, shelf, log, TS, ["season"])
    report = publish_gold(shelf, staged, proceed, log, TS)
    return dict(manifest=manifest, silver=silver, log=log, shelf=shelf, proceed=proceed, report=report,
                rejects=str(root / "rejects"))


def test_every_file_was_processed(lake):
    assert lake["manifest"].where("decision <> 'processed'").isEmpty()
    assert lake["manifest"].count() == 7


def test_silver_holds_the_accepted_rows(lake):
    counts = {t: df.count() for t, df in lake["silver"].items()}
    assert counts == {
        "game": 2, "player_info": 1, "team_info": 2, "game_skater_stats": 2,
        "game_goalie_stats": 1, "game_plays": 1, "game_plays_players": 1,
    }
    assert lake["silver"]["game"].columns[-3:] == ["load_timestamp", "pipeline_id", "run_id"]


def test_rejects_carry_their_reasons(spark, lake):
    got = read_reasons(spark, lake["rejects"]).groupBy("report", "issue_type").count()
    assert rows(got) == sorted([
        ("rejected_game", "pkey_dupe", 2),
        ("rejected_game_plays_game_orphans", "ri_orphan", 1),
        ("rejected_game_plays_players_game_plays_orphans", "ri_orphan", 1),
        ("rejected_game_skater_stats_game_orphans", "ri_orphan", 1),
        ("rejected_game_skater_stats_player_info_orphans", "ri_orphan", 1),
        ("rejected_game_skater_stats_shots_negatives", "negative_value", 1),
    ])


def test_wide_facts(lake):
    assert lake["proceed"]
    skater = lake["shelf"].read_published("fact_skater_stats_per_60")
    assert len(skater.columns) == 50
    assert skater.columns[:5] == ["player_id", "home_team_id", "away_team_id", "game_id", "team_id"]
    types = dict(skater.dtypes)
    assert (types["total_hits"], types["hits_per_60"], types["total_goals"], types["goals_per_60"]) == (
        "int", "float", "bigint", "double",
    )
    assert rows(skater, "game_id", "season", "goals_per_60", "total_toi_min", "venue", "home_team_name", "firstName") == [
        (10, "20152016", 6.0, 20.0, "Home", "n2", "Ann"),
        (11, "20162017", None, 0.0, "Away", "n2", "Ann"),
    ]
    goalie = lake["shelf"].read_published("fact_goalie_stats_per_60")
    assert len(goalie.columns) == 42
    assert rows(goalie, "saves_per_60", "venue") == [(30.0, "Away")]


def test_load_report_and_log(spark, lake):
    assert rows(lake["report"], "table_name", "row_count", "status") == [
        ("fact_goalie_stats_per_60", 1, "PASS"), ("fact_skater_stats_per_60", 2, "PASS"),
    ]
    steps = {r["step"]: r["status"] for r in latest(lake["log"].frame(spark)).collect()}
    assert steps["gate"] == "success"
    assert steps["suite fact_skater_stats_per_60"] == "success"


def test_closed_gate_publishes_nothing(spark, lake, tmp_path):
    from pyspark.sql import functions as F

    shelf, log = Shelf(spark, str(tmp_path)), RunLog("p", "r2")
    broken = dict(lake["silver"])
    broken["game_skater_stats"] = broken["game_skater_stats"].withColumn("shots", F.lit(-5))
    staged, proceed = build_gold(broken, H.REQUIRED, H.FACTS, H.STAR, shelf, log, TS)
    assert not proceed
    assert publish_gold(shelf, staged, proceed, log) is None
    assert shelf.audit().isEmpty()
    assert shelf.read_version(staged["fact_skater_stats_per_60"]).count() == 2


def test_fact_order():
    facts = ["game_plays_players", "game_plays", "game_shifts"]
    order = H.GALAXY.fact_order(facts)
    assert order.index("game_plays") < order.index("game_plays_players")
    with pytest.raises(ValueError):
        GalaxyRules({}, {"a": {"b": ("k", "k")}, "b": {"a": ("k", "k")}}).fact_order(["a", "b"])


def test_failures_are_logged_and_the_rest_still_loads(spark, tmp_path):
    """A fact without its dimension and an unreadable fact; the good fact loads, the log is written."""
    from pyspark.sql import functions as F

    from lakesift.sources.runlog import entries, read_log

    dim = spark.createDataFrame([(1,), (2,)], "d int")
    facts = {
        "good": spark.createDataFrame([(1, 5), (3, 5), (2, -1)], "d int, v int"),
        "alone": spark.createDataFrame([(1, 5)], "d int, v int"),
        "broken": spark.createDataFrame([(1, 5)], "d int, v int").withColumn("v", F.raise_error(F.lit("boom")).cast("int")),
    }
    rules = GalaxyRules(
        primary_keys={"dim": ["d"]},
        references={"good": {"dim": ("d", "d")}, "alone": {"absent": ("d", "d")}, "broken": {"dim": ("d", "d")}},
        non_negative={"good": ["v"], "broken": ["v"]},
    )
    log = RunLog("p", "r", str(tmp_path / "log"))
    silver = load_silver({"dim": dim, **facts}, rules, str(tmp_path / "silver"), str(tmp_path / "rejects"), log)
    assert sorted(silver) == ["dim", "good"]
    stored = read_log(spark, log.path)
    last = {r["step"]: r["status"] for r in latest(stored).collect()}
    assert last["check_rows good"] == "success" and last["check_rows alone"] == last["check_rows broken"] == last["load_to_silver"] == "failed"
    assert entries(stored, "check_rows alone", "error").first()["status"] == "MissingInput"
    assert entries(stored, "check_rows broken", "error").first()["status"] != ""
    # Plain files of a silver table hold accepted rows only.
    plain = spark.read.parquet(silver["good"].inputFiles()[0].rpartition("/")[0])
    assert plain.columns == ["d", "v", "load_timestamp", "pipeline_id", "run_id"]
    assert rows(plain, "d", "v") == [(1, 5)]
    assert read_reasons(spark, str(tmp_path / "rejects")).count() == 2


def test_two_ingests_give_the_same_silver_rows(spark, tmp_path):
    """One landing folder, read into different numbers of partitions: the same survivors with the same numbers."""
    landing = tmp_path / "landing"
    landing.mkdir()
    table = "\n".join(["k,v", *[f"{i % 40},{i}" for i in range(400)]]) + "\n"
    (landing / "t.csv").write_text(table)
    from pyspark.sql import types as T

    registry = {"t": {"k": T.IntegerType(), "v": T.IntegerType()}}
    found = []
    for run, size in (("a", "200b"), ("b", "128m")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        space = C.create_namespace(spark, f"again_{run}", str(tmp_path / run))
        L.ingest_folder(spark, str(landing), registry, space)
        rules = GalaxyRules(primary_keys={"t": ["k"]}, references={})
        silver = load_silver(C.load_namespace(spark, space), rules, str(tmp_path / f"s{run}"), str(tmp_path / f"r{run}"), RunLog("p", run))
        found.append(rows(silver["t"], "k", "v", "index"))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found[0]) == 40 and found[0] == found[1]


def test_measures_of_the_published_facts(lake):
    from lakesift.operators.measures import measure_set, yoy_diff, yoy_pct

    skater = lake["shelf"].read_published("fact_skater_stats_per_60")
    row = measure_set(skater, [], H.SKATER_SUMS, H.SKATER_RATES, "total_toi_min").first()
    assert (row["Total Goals"], row["Total TOI (Min)"], row["Goals per 60"]) == (3, 20.0, 9.0)
    goalie = lake["shelf"].read_published("fact_goalie_stats_per_60")
    row = measure_set(goalie, [], H.GOALIE_SUMS, H.GOALIE_RATES, "total_toi_min").first()
    assert (row["Total Saves"], row["Saves per 60"]) == (30, 30.0)
    assert rows(yoy_diff(skater, [], "season", "total_goals"), "season", "change") == [(2015, None), (2016, -1.0)]
    assert rows(yoy_pct(skater, [], "season", "total_goals"), "season", "pct_change") == [(2015, None), (2016, -50.0)]


def test_a_killed_load_leaves_the_layer_of_the_load_before(spark, tmp_path, monkeypatch):
    """A load that ends between its tables, and one that was complete."""
    rules = GalaxyRules({"dim": ["k"]}, {"fact": {"dim": ("k", "k")}})
    root, rejects = str(tmp_path / "silver"), str(tmp_path / "rejects")
    tables = lambda v: {"dim": spark.createDataFrame([(1, v)], "k int, v int"), "fact": spark.createDataFrame([(1, v)], "k int, v int")}
    load_silver(tables(1), rules, root, rejects, RunLog("p", "r1"))

    class Killed(BaseException):
        pass

    def killed(*args):
        raise Killed

    monkeypatch.setattr(medallion, "_write_split", killed)
    with pytest.raises(Killed):
        load_silver(tables(2), rules, root, rejects, RunLog("p", "r2"))
    assert [read_silver(spark, root, t).first()["v"] for t in ("dim", "fact")] == [1, 1]
    monkeypatch.undo()
    load_silver(tables(3), rules, root, rejects, RunLog("p", "r3"))
    load_silver({"dim": tables(4)["dim"]}, rules, root, rejects, RunLog("p", "r4"))
    assert [read_silver(spark, root, t).first()["v"] for t in ("dim", "fact")] == [4, 3]
    assert len(remove_old_loads(spark, root)) == 2
    assert [read_silver(spark, root, t).first()["v"] for t in ("dim", "fact")] == [4, 3]
    assert load_silver({}, rules, root, rejects, RunLog("p", "r5")) == {}


def test_facts_in_a_circle_are_logged(spark, tmp_path):
    rules = GalaxyRules({"dim": ["k"]}, {"a": {"b": ("k", "k")}, "b": {"a": ("k", "k")}})
    log = RunLog("p", "r", str(tmp_path / "log"))
    frame = spark.createDataFrame([(1,)], "k int")
    assert sorted(load_silver({"dim": frame, "a": frame, "b": frame}, rules, str(tmp_path / "s"), str(tmp_path / "r"), log)) == ["dim"]
    last = {r["step"]: r["status"] for r in latest(read_log(spark, log.path)).collect()}
    assert last["order_facts"] == last["load_to_silver"] == "failed"
