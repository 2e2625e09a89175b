"""Registered queries: every operator over the whole of the tables it is given.

Load and audit times are left out of the results, as they differ between runs.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import contracts, rules
from starloom.functions.numbers import percent
from starloom.operators import distinct, profile
from starloom.operators.lasting import LastingKeys
from starloom.operators.lookup import duplicate_keys
from starloom.operators.quarantine import stamp
from starloom.operators.ranking import dense_key
from starloom.operators.skew import gather, hot_keys, is_small
from starloom.plans import gold, measures, silver_dims
from starloom.plans import run as full_run
from starloom.plans import silver_scans as plan
from starloom.plans.scenario import Scenario
from starloom.session import materialize, scratch_path
from starloom.sources import ingest, ledger, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---- shared inputs ----------------------------------------------------------------
def scans(spark: SparkSession, folder: str) -> DataFrame:
    return Scenario(spark, folder).scans()


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of the scans that need no join."""
    return Scenario(spark, folder).lines()


def copied_scans(spark: SparkSession, folder: str) -> DataFrame:
    return Scenario(spark, folder).scans_with_copies()


def bronze(raw: DataFrame, row_id: str | None = None) -> DataFrame:
    """Raw scans stored once, as bronze has them: for queries that read them more than once."""
    return materialize(raw, "bronze", row_id=row_id)


def matches_clean(spark: SparkSession, folder: str) -> DataFrame:
    return silver_dims.clean_matches(Scenario(spark, folder).matches())


def stadiums_clean(spark: SparkSession, folder: str) -> DataFrame:
    return silver_dims.clean_stadiums(Scenario(spark, folder).stadiums())


def teams_clean(spark: SparkSession, folder: str) -> DataFrame:
    return silver_dims.clean_teams(Scenario(spark, folder).teams())


def cities_clean(spark: SparkSession, folder: str) -> DataFrame:
    return silver_dims.clean_cities(Scenario(spark, folder).cities())


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return plan.cleaned_columns(plan.accepted_scans(copied_scans(spark, folder)))


def kept_short(spark: SparkSession, folder: str, small: bool) -> DataFrame:
    """Their ids and time, under short names, stored where lookups read them more than once."""
    ids = ("ticket_id_original", "fan_id_original")
    return plan.short_names(plan.kept_scans(copied_scans(spark, folder), small, columns=ids))


def stored_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned matches as stored: several lookups read them, and a size check."""
    return materialize(matches_clean(spark, folder), "matches")


def silver(spark: SparkSession, folder: str, matches: DataFrame | None = None) -> DataFrame:
    if matches is None:
        matches = stored_matches(spark, folder)
    return plan.silver_scans(copied_scans(spark, folder), matches)


def unkeyed_fact(
    spark: SparkSession,
    folder: str,
    matches: DataFrame | None = None,
    plain: Collection[str] = gold.FACT_PLAIN,
) -> DataFrame:
    """Fact rows for measures, which use neither surrogate key. ``plain`` names what they read beside keys."""
    if matches is None:
        matches = stored_matches(spark, folder)
    small = plan.lookup_is_small(matches)
    columns = ("match_id", "stadium_id", "scan_timestamp", *plain)
    kept = plan.kept_scans(copied_scans(spark, folder), small, columns=columns)
    hot = None if small else plan.fact_match_skew(kept)
    filled = plan.enrich_scans(kept, matches, small=small, columns=columns)
    return gold.fact_rows(gold.link_teams(filled, matches, small=small, hot=hot))


def stadium_dim(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_stadium(stadiums_clean(spark, folder), cities_clean(spark, folder))


def match_dim(spark: SparkSession, folder: str, matches: DataFrame | None = None) -> DataFrame:
    if matches is None:
        matches = matches_clean(spark, folder)
    return gold.dim_match(matches, stadiums_clean(spark, folder), teams_clean(spark, folder))


def star_scans(
    spark: SparkSession, folder: str, matches: DataFrame, small: bool, columns: Collection[str]
) -> tuple[DataFrame, DataFrame]:
    """Silver scans for a star with the silver ``columns`` and fans, and stored rows with their fans, matches and times.

    The cleaned scans are stored once. Fills change neither fans nor times, so dimensions read these there,
    and the fact alone reads the filled scans, which need no copy of their own then.
    """
    columns = (*columns, *gold.FAN)
    kept = plan.kept_scans(copied_scans(spark, folder), False, columns=columns)
    silver_ones = plan.enrich_scans(kept, matches, small=small, columns=columns)
    renamed = [F.col(plan.CLEANED_NAMES[c]).alias(c) for c in gold.FAN]
    return silver_ones, kept.select(*renamed, "match_id", "scan_timestamp")


def keyed_fact(spark: SparkSession, folder: str) -> DataFrame:
    matches = stored_matches(spark, folder)
    small = plan.lookup_is_small(matches)
    scans_clean, entered = star_scans(spark, folder, matches, small, gold.FACT_SCANS)
    fans = materialize(gold.dim_fan(entered).drop("load_ts"), "fans")
    return gold.fact_ticket_scan(scans_clean, matches, fans, small_matches=small, skew_of=entered)


def stored_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Keys of the fact, with those of fans, and whether a scan counts, and all dimensions, each stored once."""
    matches = stored_matches(spark, folder)
    small = plan.lookup_is_small(matches)
    columns = ("match_id", "stadium_id", "scan_timestamp", "scan_status")
    scans_clean, entered = star_scans(spark, folder, matches, small, columns)
    fans = materialize(gold.dim_fan(entered).drop("load_ts"), "fans")
    hot = None if small else plan.fact_match_skew(entered)
    few_fans = is_small(fans.select("fan_id", "fan_key"))
    hot_fans = None if few_fans else hot_keys(entered, ["fan_id"], where=plan.is_identified())
    # Of their times these facts hold days alone, which take fewer bytes through the joins.
    dated = scans_clean.withColumn("scan_timestamp", F.to_date("scan_timestamp"))
    teams = gold.link_teams(dated, matches, small=small, hot=hot)
    linked = gold.link_fans(teams, fans, few_fans, hot_fans)
    star = {
        "fact": gold.fact_rows(linked).drop("scan_timestamp", "scan_day"),
        "dim_stadium": stadium_dim(spark, folder),
        "dim_team": gold.dim_team(teams_clean(spark, folder)),
        "dim_match": match_dim(spark, folder, matches),
        "dim_time": gold.dim_time(entered, matches),
    }
    return {name: materialize(table, name) for name, table in star.items()} | {"dim_fan": fans}


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as wall-clock values, so results do not depend on the session's zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


#: A period that the data has scans of, and others outside.
REACHED = rules.ScanPolicy(period_year=1997, period_months=(3, 9))


# ---- row rules --------------------------------------------------------------------
@query
def ticket_normalize_repair(spark: SparkSession, folder: str) -> DataFrame:
    raw = lines(spark, folder).select("ticket_id", F.col("ticket_id").alias("ticket_id_raw"))
    return plan.with_ticket_id(raw)


@query
def fan_normalize_repair(spark: SparkSession, folder: str) -> DataFrame:
    raw = scans(spark, folder).select("fan_id", F.col("fan_id").alias("fan_id_raw"))
    return plan.with_fan_id(raw)


@query
def category_repair(spark: SparkSession, folder: str) -> DataFrame:
    return plan.with_category(lines(spark, folder).select("ticket_category"))


@query
def price_validation(spark: SparkSession, folder: str) -> DataFrame:
    raw = plan.with_category(lines(spark, folder).select("ticket_category", "ticket_price_mad"))
    return plan.with_price_checks(raw).select(
        "ticket_category_fixed",
        "ticket_price_mad",
        "ticket_price_valide",
        "prix_categorie_coherent",
    )


@query
def channel_repair(spark: SparkSession, folder: str) -> DataFrame:
    return plan.with_channel(lines(spark, folder).select("purchase_channel"))


@query
def date_validation(spark: SparkSession, folder: str) -> DataFrame:
    raw = scans(spark, folder).select("purchase_date", "scan_timestamp")
    dated = plan.with_dates(raw, REACHED)
    return dated.drop("scan_timestamp_ts")


# ---- quarantine and dedup ---------------------------------------------------------
@query
def null_ticket_audit(spark: SparkSession, folder: str) -> DataFrame:
    nulls = scans(spark, folder).filter(F.col("ticket_id").isNull())
    return stamp(nulls, "ticket_id_null").drop("audit_date")


@query
def ticket_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    known = scans(spark, folder).filter(F.col("ticket_id").isNotNull())
    return stamp(plan.ticket_split(known).rejected).drop("audit_date")


@query
def ticket_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return plan.ticket_split(scans(spark, folder)).accepted


@query
def fan_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return stamp(plan.fan_split(scans(spark, folder)).rejected).drop("audit_date")


@query
def fan_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return plan.fan_split(scans(spark, folder)).accepted


@query
def full_duplicate_audit(spark: SparkSession, folder: str) -> DataFrame:
    copies = profile.duplicate_rows(copied_scans(spark, folder))
    return stamp(copies, "complets_doublons").drop("audit_date")


@query
def full_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_rows(copied_scans(spark, folder))


@query
def ticket_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return plan.first_per_ticket(scans(spark, folder))


@query
def ticket_duplicate_audit(spark: SparkSession, folder: str) -> DataFrame:
    raw = bronze(scans(spark, folder))
    later = plan.repeated_tickets(raw, plan.ticket_skew(raw))
    return stamp(later, "ticket_id_doublons").drop("audit_date")


@query
def ticket_duplicate_audit_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same with groups split from 500 rows on, as groups of millions are by default."""
    raw = bronze(scans(spark, folder))
    hot = plan.ticket_skew(raw, group_rows=500, sample=1.0)
    return stamp(plan.repeated_tickets(raw, hot), "ticket_id_doublons").drop("audit_date")


@query
def fan_match_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    raw = bronze(scans(spark, folder), "row")
    kept = plan.first_per_fan_at_match(plan.fan_split(raw).accepted, "row")
    return kept.drop("row")


@query
def fan_match_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    raw = bronze(scans(spark, folder))
    later = plan.repeated_fans(plan.fan_split(raw).accepted, plan.fan_skew(raw))
    return stamp(later, "fan_id_doublons").drop("audit_date")


@query
def classified_scans(spark: SparkSession, folder: str) -> DataFrame:
    raw = bronze(copied_scans(spark, folder))
    classified = plan.classify_scans(raw, plan.scan_skew(raw), store=True)
    return classified.groupBy("audit_table").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("count").alias("n_input_rows")
    )


@query
def audit_rows(spark: SparkSession, folder: str) -> DataFrame:
    raw = bronze(copied_scans(spark, folder))
    # Read twice, for rejected rows and for copies, so it is stored once.
    stored = plan.told_scans(materialize(plan.place_scans(raw, plan.scan_skew(raw), store=True), "classified"))
    return plan.audit_of(stored).drop("audit_date")


# ---- profiles ---------------------------------------------------------------------
@query
def category_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return profile.frequency(
        plan.with_category(lines(spark, folder)), "ticket_category_fixed", "ticket_category_valide"
    )


@query
def channel_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return profile.frequency(
        plan.with_channel(lines(spark, folder)), "purchase_channel_fixed", "purchase_channel_valide"
    )


@query
def channel_raw_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return profile.frequency(lines(spark, folder), "purchase_channel")


@query
def price_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.number_profile(lines(spark, folder), "ticket_price_mad")


@query
def price_stats(spark: SparkSession, folder: str) -> DataFrame:
    judged = plan.with_price_checks(plan.with_category(lines(spark, folder)))
    valid, coherent = F.col("ticket_price_valide"), F.col("prix_categorie_coherent")
    return profile.conditional_counts(
        judged,
        {
            "prices_valid": valid,
            "prices_invalid": ~valid,
            "prices_coherent": coherent,
            "prices_incoherent": ~coherent & valid,
        },
    )


@query
def date_stats(spark: SparkSession, folder: str) -> DataFrame:
    raw = scans(spark, folder).select("purchase_date", "scan_timestamp")
    judged = plan.with_dates(raw, REACHED)
    order, period = F.col("date_order_valide"), F.col("scan_date_valide")
    return profile.conditional_counts(
        judged,
        {
            "order_valid": order,
            "order_invalid": ~order,
            "period_valid": period,
            "period_invalid": ~period,
        },
    )


@query
def invalid_category_sample(spark: SparkSession, folder: str) -> DataFrame:
    judged = plan.with_category(lines(spark, folder))
    wrong = judged.filter(~F.col("ticket_category_valide"))
    return profile.sample_rows(
        wrong.select("ticket_id", "ticket_category", "ticket_category_fixed"), 10, "ticket_id"
    )


@query
def sample_ordered(spark: SparkSession, folder: str) -> DataFrame:
    orders = Scenario(spark, folder).table("orders")
    return profile.sample_rows(orders.select("o_orderkey", "o_custkey", "o_orderstatus"), 5)


@query
def quality_score(spark: SparkSession, folder: str) -> DataFrame:
    judged = plan.accepted_scans(copied_scans(spark, folder))
    return judged.select("ticket_id", *plan.QUALITY_FLAGS, "quality_score", "completement_valide")


@query
def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.quality_summary(plan.accepted_scans(copied_scans(spark, folder)))


@query
def observed_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Step metrics collected on the way by the one job that stores the classified rows."""
    raw = bronze(copied_scans(spark, folder))
    table = F.col("audit_table")
    wanted = {"rows_in": F.sum("count"), "rows_distinct": F.count(F.lit(1))}
    for name in ("ticket_id_null", "ticket_id_doublons", "fan_id_doublons", rules.ACCEPTED):
        wanted[f"rows_{name}"] = F.count_if(table == name)
    watched, seen = profile.observed(plan.classify_scans(raw, plan.scan_skew(raw), store=True), wanted)
    materialize(watched, "watched")
    values = seen.get
    schema = T.StructType([T.StructField(name, T.LongType()) for name in wanted])
    return spark.createDataFrame([tuple(values[name] for name in wanted)], schema)


# ---- silver -----------------------------------------------------------------------
@query
def clean_stadiums(spark: SparkSession, folder: str) -> DataFrame:
    return stadiums_clean(spark, folder)


@query
def clean_teams(spark: SparkSession, folder: str) -> DataFrame:
    return teams_clean(spark, folder).withColumnRenamed("group", "team_group")


@query
def clean_cities(spark: SparkSession, folder: str) -> DataFrame:
    return cities_clean(spark, folder)


@query
def clean_matches(spark: SparkSession, folder: str) -> DataFrame:
    return zoneless(matches_clean(spark, folder), "match_datetime")


@query
def cleaned_scans(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder)


@query
def match_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    matches = stored_matches(spark, folder)
    small = plan.lookup_is_small(matches)
    filled = plan.fill_match_ids(kept_short(spark, folder, small), matches, small)
    return filled.select("ticket_id", "fan_id", "match_id", "stadium_id", "scan_timestamp")


@query
def match_enrichment_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a lookup taken for large and keys split from 20 rows on."""
    stored = materialize(plan.short_names(cleaned(spark, folder)), "cleaned")
    hot = plan.fill_skew(stored, group_rows=20, sample=1.0).stadium_day
    filled = plan.fill_match_ids(stored, stored_matches(spark, folder), small=False, hot=hot)
    return filled.select("ticket_id", "fan_id", "match_id", "stadium_id", "scan_timestamp")


@query
def lookup_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Stadium days with several matches, of which enrichment takes the smallest id."""
    played = matches_clean(spark, folder).filter("stadium_id IS NOT NULL")
    return duplicate_keys(played, ["stadium_id", "match_date"])


@query
def nearest_match_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    """Missing match ids from the match whose kick-off is nearest to the scan."""
    before = plan.short_names(cleaned(spark, folder))
    filled = plan.fill_nearest_match_ids(before, stored_matches(spark, folder))
    return filled.select("ticket_id", "fan_id", "match_id", "stadium_id", "scan_timestamp")


@query
def nearest_match_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The same with stadium days of more than two scans dealt over copies of their matches."""
    before = materialize(plan.short_names(cleaned(spark, folder)), "cleaned")
    day = [F.col("stadium_id"), F.to_date("scan_timestamp")]
    hot = hot_keys(before, day, where=F.col("match_id").isNull(), group_rows=2, sample=1.0)
    filled = plan.fill_nearest_match_ids(before, stored_matches(spark, folder), hot)
    return filled.select("ticket_id", "fan_id", "match_id", "stadium_id", "scan_timestamp")


@query
def match_enrichment_delta(spark: SparkSession, folder: str) -> DataFrame:
    """Missing match ids before and after, counted in one pass over the filled rows."""
    matches = stored_matches(spark, folder)
    small = plan.lookup_is_small(matches)
    before = kept_short(spark, folder, small).withColumn("missing_before", F.col("match_id").isNull())
    filled = plan.fill_match_ids(before, matches, small)
    counts = profile.conditional_counts(
        filled, {"null_before": F.col("missing_before"), "null_after": F.col("match_id").isNull()}
    )
    return counts.withColumn("n_filled", F.col("null_before") - F.col("null_after"))


@query
def stadium_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    matches = stored_matches(spark, folder)
    small = plan.lookup_is_small(matches)
    filled = plan.fill_match_ids(kept_short(spark, folder, small), matches, small)
    located = plan.fill_stadium_ids(filled, matches, small)
    return located.select("ticket_id", "fan_id", "match_id", "stadium_id", "scan_timestamp")


@query
def stadium_enrichment_delta(spark: SparkSession, folder: str) -> DataFrame:
    matches = stored_matches(spark, folder)
    small = plan.lookup_is_small(matches)
    filled = plan.fill_match_ids(kept_short(spark, folder, small), matches, small)
    before = filled.withColumn("missing_before", F.col("stadium_id").isNull())
    located = plan.fill_stadium_ids(before, matches, small)
    counts = profile.conditional_counts(
        located,
        {"null_before": F.col("missing_before"), "null_after": F.col("stadium_id").isNull()},
    )
    return counts.withColumn("n_filled", F.col("null_before") - F.col("null_after"))


@query
def silver_scans(spark: SparkSession, folder: str) -> DataFrame:
    return silver(spark, folder)


@query
def silver_conformity(spark: SparkSession, folder: str) -> DataFrame:
    return profile.conformity(silver(spark, folder))


# ---- gold -------------------------------------------------------------------------
@query
def dim_stadium(spark: SparkSession, folder: str) -> DataFrame:
    return stadium_dim(spark, folder).drop("load_ts")


@query
def dim_team(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_team(teams_clean(spark, folder)).drop("load_ts")


@query
def dim_match(spark: SparkSession, folder: str) -> DataFrame:
    dim = match_dim(spark, folder, stored_matches(spark, folder))
    return zoneless(dim, "match_datetime").drop("load_ts")


@query
def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    matches = stored_matches(spark, folder)
    return gold.dim_time(silver(spark, folder, matches), matches).drop("load_ts")


@query
def dim_fan(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_fan(silver(spark, folder)).drop("load_ts")


@query
def fact_ticket_scan(spark: SparkSession, folder: str) -> DataFrame:
    return keyed_fact(spark, folder).drop("load_ts")


@query
def fact_key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    fact = keyed_fact(spark, folder)
    return profile.key_uniqueness(fact, "ticket_scan_key")


@query
def fact_orphans(spark: SparkSession, folder: str) -> DataFrame:
    star = stored_star(spark, folder)
    roles = measures.ROLES.values()
    return profile.orphans(star["fact"], {key: (star[dim], dim_key) for dim, key, dim_key in roles})


#: Scans before this day make the first of two runs, all scans the second.
FIRST_RUN_END = "1995-06-01"


@query
def lasting_fan_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Fan keys after two runs on growing input, and the run that gave each."""
    scans_clean = materialize(silver(spark, folder), "silver")
    path = scratch_path(spark, "keys")
    early = scans_clean.filter(F.col("scan_timestamp") < F.lit(FIRST_RUN_END).cast("timestamp"))
    for run, part in (("first", early), ("second", scans_clean)):
        fans = gold.dim_fan(part, lasting=LastingKeys(path, run))
    given = spark.read.parquet(f"{path}/fan").select("fan_key", "run_id")
    return fans.join(given, "fan_key", "left").select("fan_id", "fan_key", "run_id")


@query
def lasting_scan_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the fact after two runs on growing input."""
    matches = stored_matches(spark, folder)
    columns = (*gold.FACT_SCANS, *gold.FAN)
    few = plan.lookup_is_small(matches)
    kept = plan.kept_scans(copied_scans(spark, folder), few, columns=columns)
    scans_clean = materialize(plan.enrich_scans(kept, matches, small=few, columns=columns), "silver")
    path, small = scratch_path(spark, "keys"), few
    early = scans_clean.filter(F.col("scan_timestamp") < F.lit(FIRST_RUN_END).cast("timestamp"))
    for run, part in (("first", early), ("second", scans_clean)):
        lasting = LastingKeys(path, run)
        fans = gold.dim_fan(part, lasting=lasting)
        fact = gold.fact_ticket_scan(part, matches, fans, small_matches=small, lasting=lasting)
    return zoneless(fact.select("ticket_scan_key", "ticket_id", "scan_timestamp", "fan_key"), "scan_timestamp")


@query
def dense_key_scaled(spark: SparkSession, folder: str) -> DataFrame:
    orders = Scenario(spark, folder).table("orders").select("o_orderpriority", "o_orderkey")
    return dense_key(orders, ["o_orderpriority", "o_orderkey"], "order_number")


# ---- measures ---------------------------------------------------------------------
#: What measures read of the scans beside keys.
COUNTED = ("scan_status",)
COUNTED_BY_CHANNEL = ("scan_status", "purchase_channel")


@query
def tickets_total(spark: SparkSession, folder: str) -> DataFrame:
    return measures.tickets(unkeyed_fact(spark, folder, plain=COUNTED))


@query
def tickets_by_stadium(spark: SparkSession, folder: str) -> DataFrame:
    star = {"dim_stadium": stadium_dim(spark, folder)}
    name = {"stadium_name": ("dim_stadium", "stadium_name")}
    return measures.fill_rates(unkeyed_fact(spark, folder, plain=COUNTED), star, ["stadium_key"], name)


@query
def tickets_by_channel(spark: SparkSession, folder: str) -> DataFrame:
    star = {"dim_stadium": stadium_dim(spark, folder)}
    fact = unkeyed_fact(spark, folder, plain=COUNTED_BY_CHANNEL)
    rates = measures.fill_rates(fact, star, ["purchase_channel"])
    total = rates.agg(F.sum("tickets").alias("total"))  # one row
    return rates.join(F.broadcast(total)).select(
        *rates.columns, percent(F.col("tickets"), F.col("total")).alias("pct_of_tickets")
    )


@query
def fill_rate_by_match(spark: SparkSession, folder: str) -> DataFrame:
    star = {"dim_stadium": stadium_dim(spark, folder)}
    return measures.fill_rates(unkeyed_fact(spark, folder, plain=COUNTED), star, ["match_key"])


@query
def fill_rate_by_stage(spark: SparkSession, folder: str) -> DataFrame:
    matches = stored_matches(spark, folder)
    star = {"dim_stadium": stadium_dim(spark, folder), "dim_match": match_dim(spark, folder, matches)}
    by = {"stage": ("dim_match", "stage")}
    only = F.col("purchase_channel") != rules.NO_MATCH
    fact = unkeyed_fact(spark, folder, matches, COUNTED_BY_CHANNEL)
    return measures.fill_rates(fact, star, (), by, where=only)


@query
def fill_rate_slices(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard's groupings from one pass over the fact: stadium, channel, stage, both, total."""
    matches = stored_matches(spark, folder)
    star = {"dim_stadium": stadium_dim(spark, folder), "dim_match": match_dim(spark, folder, matches)}
    slices = [["stadium_key"], ["purchase_channel"], ["stage"], ["purchase_channel", "stage"], []]
    stage = {"stage": ("dim_match", "stage")}
    fact = unkeyed_fact(spark, folder, matches, COUNTED_BY_CHANNEL)
    return measures.fill_rate_slices(fact, star, slices, stage)


def _by_role(spark: SparkSession, folder: str, name: str, role: str, attribute: str) -> DataFrame:
    star = stored_star(spark, folder)
    return measures.fill_rates(star["fact"], star, (), {name: (role, attribute)})


@query
def attendance_by_day_type(spark: SparkSession, folder: str) -> DataFrame:
    return _by_role(spark, folder, "day_type", "dim_time", "day_type")


@query
def attendance_by_fan_type(spark: SparkSession, folder: str) -> DataFrame:
    return _by_role(spark, folder, "fan_type", "dim_fan", "fan_type")


@query
def attendance_by_home_team(spark: SparkSession, folder: str) -> DataFrame:
    return _by_role(spark, folder, "home_team", "home_team", "team_name")


@query
def attendance_by_away_team(spark: SparkSession, folder: str) -> DataFrame:
    return _by_role(spark, folder, "away_team", "away_team", "team_name")


@query
def attended_stadiums(spark: SparkSession, folder: str) -> DataFrame:
    scanned = unkeyed_fact(spark, folder, plain=COUNTED).filter(measures.is_scanned())
    dim = stadium_dim(spark, folder).select("stadium_key", "seating_capacity")
    return measures.occurring(dim, scanned, "stadium_key")


@query
def fill_rate_gauge(spark: SparkSession, folder: str) -> DataFrame:
    return measures.fill_gauge(unkeyed_fact(spark, folder), stadium_dim(spark, folder))


@query
def fill_gauge_by_stadium(spark: SparkSession, folder: str) -> DataFrame:
    return measures.fill_gauge(
        unkeyed_fact(spark, folder), stadium_dim(spark, folder), by_stadium=True
    )


# ---- sources, sinks, catalog ------------------------------------------------------
def _zoneless_contract(schema: T.StructType) -> T.StructType:
    zoned = T.TimestampType()
    return T.StructType(
        [T.StructField(f.name, T.TimestampNTZType() if f.dataType == zoned else f.dataType)
         for f in schema]
    )


@query
def config_ingest_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Scans landed as CSV folders per stadium, copied to bronze by configuration, read back.

    Half the scans of the busiest gate land in files of another column order, with a column
    that the contract does not have.
    """
    base = scratch_path(spark, "ingest")
    site = F.coalesce("stadium_id", F.lit("NO_STADIUM"))
    landed = materialize(scans(spark, folder).withColumn("site", site), "landed")
    drifted = (F.col("entry_gate") == "GATE_N") & (F.col("scan_status") == "SCANNED")
    other = landed.filter(drifted).withColumn("device", F.lit("d1"))
    turned = [c for c in reversed(other.columns) if c != "site"]
    for part, mode in ((landed.filter(~drifted), "error"), (other.select("site", *turned), "append")):
        (
            gather(part, ["site"]).write.mode(mode).partitionBy("site")
            .options(header=True, escape="\\", ignoreLeadingWhiteSpace=False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{base}/landing/scans")
        )
    config = landed.select(
        F.lit("scans").alias("folder_name"), F.concat(F.lit("site="), "site").alias("file_name")
    ).distinct()
    config.write.csv(f"{base}/config_csv", header=True)
    schema = _zoneless_contract(contracts.TICKET_SCANS)
    ingest.land_csv(spark, f"{base}/config_csv", f"{base}/landing", f"{base}/bronze", schema)
    return zoneless(readers.read_scans(spark, f"{base}/bronze"), "scan_timestamp")


@query
def rescued_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Text in landing files that is no price or no date: kept with its column and reason."""
    base = scratch_path(spark, "rescue")
    price, day = F.col("ticket_price_mad"), F.col("purchase_date")
    text = scans(spark, folder).withColumns(
        {
            "ticket_price_mad": F.when(price % 56 == 0, F.concat(price, F.lit(" MAD"))).otherwise(price.cast("string")),
            "purchase_date": F.when(F.col("entry_time") == "18:07", "soon").otherwise(day.cast("string")),
            "site": F.col("entry_gate"),
        }
    )
    (
        gather(text, ["site"]).write.partitionBy("site")
        .options(header=True, escape="\\", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(f"{base}/landing/scans")
    )
    gates = lines(spark, folder).select("entry_gate").distinct()
    config = gates.select(F.lit("scans").alias("folder_name"), F.concat(F.lit("site="), "entry_gate").alias("file_name"))
    config.write.csv(f"{base}/config", header=True)
    schema = _zoneless_contract(contracts.TICKET_SCANS)
    ingest.land_csv(spark, f"{base}/config", f"{base}/landing", f"{base}/bronze", schema)
    told = ingest.read_rescued(spark, f"{base}/bronze")
    return told.select("ticket_id", "fan_id", "entry_gate", "ticket_price_mad", "purchase_date", "column", "value", "reason")


@query
def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Fact rows stored by day and read back with the day as text."""
    path = scratch_path(spark, "fact")
    fact = unkeyed_fact(spark, folder)
    written = writers.write_table(fact, path, partition_by=["scan_day"])
    return writers.reconcile(readers.read_table(spark, path, schema=fact.schema), written)


@query
def append_audit_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two audits appended to one table, the second with more columns, and read back."""
    path = scratch_path(spark, "audit")
    known = scans(spark, folder).filter(F.col("ticket_id").isNotNull())
    tickets = plan.ticket_split(known)
    columns = [*plan.SCAN, "ticket_id_fixed", "audit_table"]
    written = writers.append(tickets.rejected.select(*columns), path)
    fans = plan.fan_split(tickets.accepted).rejected.select(*columns, "fan_id_fixed")
    written += writers.append(fans, path)
    return writers.reconcile(readers.read_table(spark, path, merge_schema=True), written)


@query
def repeated_append_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs append their audits, the first again with fewer rows, and all is read back."""
    path = scratch_path(spark, "audit")
    known = materialize(scans(spark, folder).filter(F.col("ticket_id").isNotNull()), "known")
    tickets = plan.ticket_split(known)
    columns = [*plan.SCAN, "ticket_id_fixed", "audit_table"]
    by = ["audit_table"]
    writers.append_run(tickets.rejected.unionByName(tickets.rejected).select(*columns), path, "tickets", partition_by=by)
    fans = plan.fan_split(tickets.accepted).rejected.select(*columns, "fan_id_fixed")
    written = writers.append_run(fans, path, "fans", partition_by=by)
    written += writers.append_run(tickets.rejected.select(*columns), path, "tickets", partition_by=by)
    read = readers.read_table(spark, path, merge_schema=True, text_columns=["run_id"])
    return writers.reconcile(read, written)


@query
def registered_star_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The full run: raw tables to a stored star in the catalog, counted from there."""
    source = Scenario(spark, folder)
    raw = {
        "scans": bronze(source.scans_with_copies()),
        "matches": source.matches(),
        "stadiums": source.stadiums(),
        "teams": source.teams(),
        "cities": source.cities(),
    }
    base = scratch_path(spark, "star")
    layout = full_run.Layout(base)
    full_run.run_all(spark, raw, layout)
    database = f"gold_{base[-12:]}"
    listed = full_run.register_star(spark, layout, database)
    parts = [
        spark.table(f"{database}.{row.tableName}").agg(
            F.lit(row.tableName).alias("table_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for row in listed.orderBy("tableName").collect()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    counts = materialize(counts, "counts")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return counts


# ---- states, contents and files ---------------------------------------------------
@query
def distinct_tickets_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct tickets by stadium and day, by stadium and in all, from one stored state."""
    fact = materialize(unkeyed_fact(spark, folder), "fact_rows")
    by = ["stadium_key", "scan_day"]
    numbers = distinct.number_members(fact, "ticket_id", by)
    state = distinct.distinct_state(fact.join(numbers, "ticket_id", "left"), "member_no", by)
    path = scratch_path(spark, "distinct")
    writers.write_table(state, path)
    stored = readers.read_table(spark, path, schema=state.schema)
    levels = None
    for level, keys in ((0, by), (1, by[:1]), (3, [])):
        counted = distinct.count_states(stored, keys, "tickets_sold").withColumn("level", F.lit(level).cast("bigint"))
        levels = counted if levels is None else levels.unionByName(counted, allowMissingColumns=True)
    return levels


@query
def content_checked_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Fact rows stored by day, read back and compared with what the writing job saw."""
    path = scratch_path(spark, "fact")
    fact = unkeyed_fact(spark, folder)
    written = writers.write_checked(fact, path, partition_by=["scan_day"])
    return writers.reconcile_content(readers.read_table(spark, path, schema=fact.schema), written)


@query
def merged_files_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Scans stored in many small files, merged to files of a megabyte and read back."""
    small, merged = scratch_path(spark, "small"), scratch_path(spark, "merged")
    rows = scans(spark, folder)
    written = writers.write_table(rows.repartition(64), small)
    if writers.merge_files(spark, small, merged, 1 << 20) != written:
        raise writers.CountMismatch("rows were lost in merging files")
    return zoneless(readers.read_table(spark, merged, schema=rows.schema), "scan_timestamp")


@query
def audit_if_any(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected tickets replace an audit, no rejections leave it as it is."""
    path = scratch_path(spark, "audit")
    rejected = plan.ticket_split(scans(spark, folder).filter(F.col("ticket_id").isNotNull())).rejected
    columns = [*plan.SCAN, "ticket_id_fixed"]
    written = writers.write_if_any(rejected.select(*columns), path)
    writers.write_if_any(rejected.select(*columns).filter("ticket_id IS NULL"), path)
    return writers.reconcile(readers.read_table(spark, path), written)


@query
def channel_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Three rows of every channel as typed, the same ones in each run."""
    kept = lines(spark, folder).select("purchase_channel", "ticket_id", "match_id", "ticket_price_mad")
    return profile.sample_per_group(kept, ["purchase_channel"], 3, ["ticket_id", "match_id", "ticket_price_mad"], "s1")


@query
def incremental_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Scans of one gate land first, those of the others later; each run reads its new files alone."""
    base = scratch_path(spark, "landing")
    landing, target, taken = f"{base}/in", f"{base}/rows", f"{base}/ledger"
    text = lines(spark, folder).select("ticket_id", "match_id", "entry_gate", "ticket_price_mad")
    layout = {"header": "true", "escape": "\\", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    first = F.col("entry_gate") == "GATE_N"
    for run, part in (("first", first), ("second", ~first)):
        text.filter(part).write.mode("append").options(**layout).csv(landing)
        ledger.land_new(spark, landing, target, taken, run, text.schema, options=layout, pattern="*.csv")
    return ledger.read_landed(spark, target, taken, text.schema).drop("source_file")
