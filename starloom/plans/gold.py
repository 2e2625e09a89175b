"""Gold star: five dimensions and the scan fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import contracts, rules
from starloom.functions.dates import date_key, day_type
from starloom.operators.lasting import LastingKeys, extend_keys, with_lasting_key
from starloom.operators.lookup import lookup_join, one_per_key
from starloom.operators.ranking import dense_key
from starloom.operators.skew import HotKeys, hot_keys, is_small
from starloom.rules import ScanPolicy

ROW_ID = "__row_id"
#: Silver columns that the fact has, or derives its keys from.
FACT_PLAIN = ("ticket_id", "ticket_category", "ticket_price_mad", "purchase_channel", "scan_status", "scan_timestamp", "entry_gate")
FACT_SCANS = ("match_id", "stadium_id", *FACT_PLAIN)
FAN = ("fan_id", "is_fan_id_valid")


def _load_ts(at: Column | None) -> Column:
    return (F.current_timestamp() if at is None else at).alias("load_ts")


def dim_stadium(
    stadiums: DataFrame, cities: DataFrame, at: Column | None = None, strict: bool = False
) -> DataFrame:
    """Stadiums with the name and region of their city."""
    city = one_per_key(cities, ["city_code"], ["city_name", "region"], strict)
    joined = lookup_join(stadiums, city, {"city_code": F.col("city_code")})
    return joined.select(
        F.col("stadium_id").alias("stadium_key"),
        "stadium_name",
        "city_code",
        "city_name",
        "region",
        "full_address",
        "seating_capacity",
        "pitch_type",
        _load_ts(at),
    )


def dim_team(teams: DataFrame, at: Column | None = None) -> DataFrame:
    return teams.select(
        F.col("team_code").alias("team_key"),
        "team_name",
        F.col("group").alias("team_group"),
        "federation",
        "coach_name",
        _load_ts(at),
    )


def dim_match(
    matches: DataFrame,
    stadiums: DataFrame,
    teams: DataFrame,
    at: Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """Matches with the names of stadium and both teams.

    ``stadium_id`` is the stadium's own, so it is NULL where no stadium matches.
    Whether a lookup is small is seen from its rows as stored, before they are made unique.
    """
    few_venues = is_small(stadiums.select("stadium_id", "stadium_name"))
    few_teams = is_small(teams.select("team_code", "team_name"))
    venue = one_per_key(stadiums, ["stadium_id"], ["stadium_name"], strict).withColumn(
        "venue_id", F.col("stadium_id")
    )
    team = one_per_key(teams, ["team_code"], ["team_name"], strict)
    joined = lookup_join(matches, venue, {"stadium_id": F.col("stadium_id")}, small=few_venues)
    for side in ("home", "away"):
        named = team.withColumnRenamed("team_name", f"{side}_team_name")
        joined = lookup_join(joined, named, {"team_code": F.col(f"{side}_team_code")}, small=few_teams)
    return joined.select(
        F.col("match_id").alias("match_key"),
        "match_date",
        "match_time",
        "match_datetime",
        "stage",
        F.col("group_code").alias("match_group"),
        F.col("venue_id").alias("stadium_id"),
        "stadium_name",
        "home_team_name",
        "away_team_name",
        "weather_notes",
        _load_ts(at),
    )


def dim_time(scans: DataFrame, matches: DataFrame, at: Column | None = None) -> DataFrame:
    """One row per day on which a scan or a match occurs."""
    days = (
        scans.select(F.to_date("scan_timestamp").alias("event_date"))
        .union(matches.select(F.to_date("match_datetime")))
        .filter(F.col("event_date").isNotNull())
        .distinct()
    )
    day = F.col("event_date")
    return days.select(
        date_key(day).alias("date_key"),
        "event_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        day_type(day).alias("day_type"),
        _load_ts(at),
    )


def dim_fan(
    scans: DataFrame, at: Column | None = None, lasting: LastingKeys | None = None
) -> DataFrame:
    """Identified fans numbered 1..n by fan id, and the anonymous fan as number 0.

    With ``lasting``, fans keep the numbers that earlier runs gave them, those no longer
    scanned included, and new ones follow.
    """
    valid = (F.col("fan_id") != rules.ANONYMOUS_FAN) & F.col("is_fan_id_valid")
    fans = scans.filter(valid).select("fan_id").distinct()
    if lasting is None:
        keyed = dense_key(fans, ["fan_id"], "fan_key", unique=True)
    else:
        path = lasting.path("fan")
        keyed = extend_keys(scans.sparkSession, fans, path, ["fan_id"], "fan_key", lasting.run)
    category, kind = rules.IDENTIFIED_FAN
    identified = keyed.select(
        F.col("fan_key").cast("bigint").alias("fan_key"),
        "fan_id",
        F.lit(category).alias("fan_category"),
        F.lit(kind).alias("fan_type"),
    )
    anonymous = scans.sparkSession.createDataFrame(
        [(rules.ANONYMOUS_FAN_KEY, rules.ANONYMOUS_FAN, *rules.UNIDENTIFIED_FAN)],
        "fan_key bigint, fan_id string, fan_category string, fan_type string",
    )
    return identified.unionByName(anonymous).select("*", _load_ts(at))


def link_teams(
    scans: DataFrame,
    matches: DataFrame,
    strict: bool = False,
    small: bool | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Scans with the two team codes of their match."""
    teams = ["home_team_code", "away_team_code"]
    mapping = one_per_key(matches, ["match_id"], teams, strict)
    return lookup_join(
        scans, mapping, {"match_id": "match_id"}, small=small, hot=hot
    )


def link_fans(
    scans: DataFrame, fans: DataFrame, small: bool | None = None, hot: HotKeys | None = None
) -> DataFrame:
    """Scans with the surrogate key of their fan; 0 for anonymous and unknown ones.

    Anonymous scans, often the largest group, are not looked up.
    """
    keys = fans.select("fan_id", "fan_key")
    known = F.col("fan_id") != rules.ANONYMOUS_FAN
    joined = lookup_join(
        scans, keys, {"fan_id": F.col("fan_id")}, needed=known, small=small, hot=hot
    )
    anonymous = F.lit(rules.ANONYMOUS_FAN_KEY).cast("bigint")
    return joined.withColumn("fan_key", F.coalesce("fan_key", anonymous))


def _days() -> dict[str, Column]:
    day = F.to_date("scan_timestamp")
    return {"date_key": date_key(day), "scan_day": F.date_format(day, "yyyy-MM-dd")}


def fact_rows(linked: DataFrame) -> DataFrame:
    """Fact columns that need no surrogate key, unknown members substituted.

    Measures can be taken on these rows directly. Key columns already there stay. Scans that were read
    without some of ``FACT_PLAIN`` give rows without them.
    """
    unknown = F.lit(rules.UNKNOWN_MEMBER)
    days = _days()
    keys = [c for c in ("fan_key", ROW_ID) if c in linked.columns]
    return linked.select(
        *keys,
        F.coalesce("match_id", unknown).alias("match_key"),
        F.coalesce("stadium_id", unknown).alias("stadium_key"),
        days["date_key"].alias("date_key"),
        F.coalesce("home_team_code", unknown).alias("home_team_key"),
        F.coalesce("away_team_code", unknown).alias("away_team_key"),
        *[c for c in FACT_PLAIN if c in linked.columns],
        days["scan_day"].alias("scan_day"),
    )


def fact_ticket_scan(
    scans: DataFrame,
    matches: DataFrame,
    fans: DataFrame,
    at: Column | None = None,
    strict: bool = False,
    small_matches: bool | None = None,
    lasting: LastingKeys | None = None,
    skew_of: DataFrame | None = None,
) -> DataFrame:
    """The fact: six foreign keys and a surrogate key 1..n by ticket and time.

    With ``lasting``, a ticket's scan keeps the key that an earlier run gave it, whatever
    has been added since, and new ones follow.

    ``scans`` may carry the stored row id of ``materialize`` as ``__row_id``. Without it they are
    taken for distinct, as silver scans are: the joined rows are stored once, sorted, and equal
    ones would be numbered side by side. Oversize groups are looked for in the scans, not in
    what is already joined; ``skew_of`` names stored rows with the fans and matches of scans that are not.
    """
    small_fans = is_small(fans.select("fan_id", "fan_key"))
    known = F.col("fan_id") != rules.ANONYMOUS_FAN
    hot_fans = HotKeys() if small_fans else hot_keys(scans if skew_of is None else skew_of, ["fan_id"], where=known)
    hot_matches = None
    if skew_of is not None and not small_matches:
        hot_matches = hot_keys(skew_of, ["match_id"], where=F.col("match_id").isNotNull())
    teams = link_teams(scans, matches, strict, small_matches, hot_matches)
    linked = link_fans(teams, fans, small_fans, hot_fans)
    # Days follow from the time that rows are ordered by, so they are not sorted along with them.
    rows = fact_rows(linked).drop("date_key", "scan_day")
    row_id = ROW_ID if ROW_ID in rows.columns else None
    order, key = ["ticket_id", "scan_timestamp"], "ticket_scan_key"
    if lasting is None:
        keyed = dense_key(rows, order, key, row_id, unique=row_id is None)
    else:
        rows = rows.drop(ROW_ID)
        keyed = with_lasting_key(scans.sparkSession, rows, lasting.path("scan"), order, key, lasting.run)
    return keyed.withColumns({**_days(), "load_ts": _load_ts(at)}).select(*contracts.FACT_TICKET_SCAN.names)


def with_unknown_member(dim: DataFrame, key: str) -> DataFrame:
    """The dimension with one more row, which UNKNOWN references find."""
    member = dim.sparkSession.range(1).select(F.lit(rules.UNKNOWN_MEMBER).alias(key))
    return dim.unionByName(member, allowMissingColumns=True)


def build_star(
    silver: dict[str, DataFrame],
    at: Column | None = None,
    policy: ScanPolicy | None = None,
    lasting: LastingKeys | None = None,
) -> dict[str, DataFrame]:
    """All gold tables from the silver ones: scans, matches, stadiums, teams, cities.

    ``lasting`` keeps surrogate keys from run to run. The policy says whether lookup keys that two rows share raise instead of taking the
    smallest, and whether dimensions get an unknown member.
    """
    policy = policy or ScanPolicy()
    strict = policy.strict_lookups
    scans, matches = silver["scans"], silver["matches"]
    fans = dim_fan(scans, at, lasting)
    star = {
        "dim_stadium": dim_stadium(silver["stadiums"], silver["cities"], at, strict),
        "dim_team": dim_team(silver["teams"], at),
        "dim_match": dim_match(matches, silver["stadiums"], silver["teams"], at, strict),
        "dim_time": dim_time(scans, matches, at),
        "dim_fan": fans,
        "fact_ticket_scan": fact_ticket_scan(scans, matches, fans, at, strict, lasting=lasting),
    }
    if policy.unknown_members:
        for name, key in (("dim_stadium", "stadium_key"), ("dim_team", "team_key"), ("dim_match", "match_key")):
            star[name] = with_unknown_member(star[name], key)
    return star
