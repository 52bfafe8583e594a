"""Fixed values for a hockey statistics lake: tables, keys, checks, facts and suites."""

from __future__ import annotations

from pyspark.sql import types as T

from lakesift.operators.expectations import non_negative_suite
from lakesift.plans.medallion import FactRules, GalaxyRules, Role, StarRules

INT, STR, FLT, TS = T.IntegerType(), T.StringType(), T.FloatType(), T.TimestampType()


# The landing tables, their columns in file order and their types.
REGISTRY = {
    "team_info": dict(
        team_id=INT, franchiseId=INT, shortName=STR, teamName=STR, abbreviation=STR, link=STR
    ),
    "game_skater_stats": dict(
        game_id=INT, player_id=INT, team_id=INT, timeOnIce=INT, assists=INT, goals=INT,
        shots=INT, hits=INT, powerPlayGoals=INT, powerPlayAssists=INT, penaltyMinutes=INT,
        faceOffWins=INT, faceoffTaken=INT, takeaways=INT, giveaways=INT, shortHandedGoals=INT,
        shortHandedAssists=INT, blocked=INT, plusMinus=INT, evenTimeOnIce=INT,
        shortHandedTimeOnIce=INT, powerPlayTimeOnIce=INT,
    ),
    "game_goalie_stats": dict(
        game_id=INT, player_id=INT, team_id=INT, timeOnIce=INT, assists=INT, goals=INT, pim=INT,
        shots=INT, saves=INT, powerPlaySaves=INT, shortHandedSaves=INT, evenSaves=INT,
        shortHandedShotsAgainst=INT, evenShotsAgainst=INT, powerPlayShotsAgainst=INT,
        decision=STR, savePercentage=FLT, powerPlaySavePercentage=FLT,
        evenStrengthSavePercentage=FLT,
    ),
    "game": dict(
        game_id=STR, season=STR, type=STR, date_time_GMT=TS, away_team_id=INT, home_team_id=INT,
        away_goals=INT, home_goals=INT, outcome=STR, home_rink_side_start=STR, venue=STR,
        venue_link=STR, venue_time_zone_id=STR, venue_time_zone_offset=INT,
        venue_time_zone_tz=STR,
    ),
    "game_plays": dict(
        play_id=STR, game_id=STR, team_id_for=INT, team_id_against=INT, event=STR,
        secondaryType=STR, x=FLT, y=FLT, period=INT, periodType=STR, periodTime=INT,
        periodTimeRemaining=FLT, dateTime=TS, goals_away=INT, goals_home=INT, description=STR,
        st_x=FLT, st_y=FLT,
    ),
    "game_plays_players": dict(play_id=STR, game_id=STR, player_id=INT, playerType=STR),
    "game_shifts": dict(game_id=INT, player_id=INT, period=INT, shift_start=INT, shift_end=INT),
    "game_teams_stats": dict(
        game_id=INT, team_id=INT, HoA=STR, won=STR, settled_in=STR, head_coach=STR, goals=INT,
        shots=INT, hits=INT, pim=INT, powerPlayOpportunities=INT, powerPlayGoals=INT,
        faceOffWinPercentage=FLT, giveaways=INT, takeaways=INT, blocked=INT, startRinkSide=STR,
    ),
    "player_info": dict(
        player_id=INT, firstName=STR, lastName=STR, nationality=STR, birthCity=STR,
        primaryPosition=STR, birthDate=TS, birthStateProvince=STR, height=STR, height_cm=FLT,
        weight=INT, shootsCatches=STR,
    ),
}

# Primary keys, references, and columns that must not be negative.
GALAXY = GalaxyRules(
    primary_keys={
        "game": ["game_id"],
        "player_info": ["player_id"],
        "team_info": ["team_id"],
    },
    references={
        "game_plays": {"game": ("game_id", "game_id")},
        "game_teams_stats": {
            "game": ("game_id", "game_id"),
            "team_info": ("team_id", "team_id"),
        },
        "game_skater_stats": {
            "game": ("game_id", "game_id"),
            "player_info": ("player_id", "player_id"),
        },
        "game_goalie_stats": {
            "game": ("game_id", "game_id"),
            "player_info": ("player_id", "player_id"),
        },
        "game_shifts": {
            "game": ("game_id", "game_id"),
            "player_info": ("player_id", "player_id"),
        },
        "game_plays_players": {
            "game_plays": ("play_id", "play_id"),
            "player_info": ("player_id", "player_id"),
        },
    },
    non_negative={
        "game_skater_stats": [
            "timeOnIce", "assists", "goals", "shots", "hits", "powerPlayGoals",
            "powerPlayAssists", "penaltyMinutes", "faceOffWins", "faceoffTaken", "takeaways",
            "giveaways", "shortHandedGoals", "shortHandedAssists", "blocked", "evenTimeOnIce",
            "shortHandedTimeOnIce", "powerPlayTimeOnIce",
        ],
        "game_goalie_stats": [
            "timeOnIce", "assists", "goals", "shots", "saves", "powerPlaySaves",
            "shortHandedSaves", "evenSaves", "shortHandedShotsAgainst", "evenShotsAgainst",
            "powerPlayShotsAgainst", "savePercentage", "powerPlaySavePercentage",
            "evenStrengthSavePercentage",
        ],
    },
)

# Summed columns of the two wide facts, in result order.
SKATER_METRICS = [
    "goals", "assists", "shots", "hits", "powerPlayGoals", "powerPlayAssists",
    "penaltyMinutes", "faceOffWins", "faceoffTaken", "takeaways", "giveaways",
    "shortHandedGoals", "shortHandedAssists", "blocked",
]
GOALIE_METRICS = [
    "assists", "goals", "shots", "saves", "powerPlaySaves", "shortHandedSaves", "evenSaves",
    "shortHandedShotsAgainst", "evenShotsAgainst", "powerPlayShotsAgainst",
]

# Metrics that are mostly null and have narrow types in the result.
SPARSE_METRICS = ["hits", "takeaways", "giveaways", "blocked"]

GRAIN = ["player_id", "game_id", "team_id"]
TIME, TIME_OUT = "timeOnIce", "total_toi_min"


def _judged(metrics: list[str]) -> list[str]:
    return [*[f"{m}_per_60" for m in metrics], *[f"total_{m}" for m in metrics], TIME_OUT]


SKATER_FACT = FactRules(
    name="fact_skater_stats_per_60",
    source="game_skater_stats",
    keys=GRAIN,
    metrics=SKATER_METRICS,
    time=TIME,
    time_out=TIME_OUT,
    suite=non_negative_suite(_judged(SKATER_METRICS), column_count=50),
    cast={
        **{f"total_{m}": "int" for m in SPARSE_METRICS},
        **{f"{m}_per_60": "float" for m in SPARSE_METRICS},
    },
)
GOALIE_FACT = FactRules(
    name="fact_goalie_stats_per_60",
    source="game_goalie_stats",
    keys=GRAIN,
    metrics=GOALIE_METRICS,
    time=TIME,
    time_out=TIME_OUT,
    suite=non_negative_suite(_judged(GOALIE_METRICS), column_count=42),
)


def _team(side: str) -> Role:
    key = f"{side}_team_id"
    cols = {
        "shortName": f"{side}_team_shortName",
        "teamName": f"{side}_team_name",
        "abbreviation": f"{side}_team_abbr",
    }
    return Role("team_info", key, "team_id", cols)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


STAR = StarRules(
    main=Role(
        "game", "game_id", "game_id",
        _same(
            "season", "type", "date_time_GMT", "away_team_id", "home_team_id", "away_goals",
            "home_goals", "outcome",
        ),
    ),
    roles=[
        _team("away"),
        _team("home"),
        Role("player_info", "player_id", "player_id", _same("firstName", "lastName", "primaryPosition")),
    ],
    own_key="team_id",
    home_key="home_team_id",
)

REQUIRED = {
    "game_skater_stats": [*GRAIN, TIME, *SKATER_METRICS],
    "game_goalie_stats": [*GRAIN, TIME, *GOALIE_METRICS],
    "game": ["game_id", *STAR.main.cols],
    "team_info": ["team_id", "shortName", "teamName", "abbreviation"],
    "player_info": ["player_id", "firstName", "lastName", "primaryPosition"],
}

FACTS = [SKATER_FACT, GOALIE_FACT]

# The measures of the two published facts by their names, sums and rates of sums per 60.
SKATER_SUMS = {
    "Total TOI (Min)": "total_toi_min", "Total Goals": "total_goals", "Total Assists": "total_assists",
    "Total Shots": "total_shots",
}
SKATER_RATES = {"Goals per 60": "total_goals", "Assists per 60": "total_assists", "Shots per 60": "total_shots"}
GOALIE_SUMS = {
    "G Total TOI (Min)": "total_toi_min", "Total Saves": "total_saves", "G Total Assists": "total_assists",
    "G Total Shots": "total_shots", "G Total Goals": "total_goals",
}
GOALIE_RATES = {
    "G Assists per 60": "total_assists", "G Goals per 60": "total_goals", "G Shots per 60": "total_shots",
    "Saves per 60": "total_saves",
}
