"""Silver scans: dedup, repair, quarantine, business rules, enrichment.

Two plans give the same accepted rows. ``accepted_scans`` computes only them, and drops
rejected rows as early as it can. ``classify_scans`` carries every row to the end with
one outcome each, for a run that stores accepted rows and audits from a single pass.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import contracts, rules
from starloom.functions import checks, repair, text
from starloom.operators import profile
from starloom.operators.asof import asof_join
from starloom.operators.lookup import fill_from_lookup
from starloom.operators.quarantine import Split, id_reasons, outcome, split, stamp
from starloom.operators.ranking import deal, keep_first, rank_rows
from starloom.operators.skew import HotKeys, hot_keys, hot_keys_of, is_small
from starloom.rules import ACCEPTED, ScanPolicy
from starloom.session import materialize

# A scan in its twelve columns: what ties between equal timestamps are decided on.
SCAN = tuple(contracts.TICKET_SCANS.names)
FIRST_SCAN = ["scan_timestamp"]
TICKET = ["ticket_id"]
FAN_AT_MATCH = ["match_id", "fan_id"]
_TICKET_HASH = "__ticket_hash"
_ENTRY_HASH = "__entry_hash"


@dataclass(frozen=True)
class ScanSkew:
    """Oversize groups among the keys that scans are ranked by."""

    ticket: HotKeys = field(default_factory=HotKeys)
    fan_at_match: HotKeys = field(default_factory=HotKeys)
    repaired_ticket: HotKeys = field(default_factory=HotKeys)


@dataclass(frozen=True)
class FillSkew:
    """Oversize groups among the keys that scans look missing references up by."""

    stadium_day: HotKeys = field(default_factory=HotKeys)
    match: HotKeys = field(default_factory=HotKeys)


def _ticket_groups():
    return TICKET, F.col("ticket_id").isNotNull()


def _fan_groups():
    fan = text.code_or(F.col("fan_id"), rules.ANONYMOUS_FAN)
    return ["match_id", fan], fan != rules.ANONYMOUS_FAN


def ticket_skew(raw: DataFrame, **limits) -> HotKeys:
    """Oversize groups of one ticket id, looked for in the raw scans.

    Groups there are at least as large as the ones a ranking meets after dedup, and the
    raw scans are a file scan of the key columns.
    """
    return hot_keys(raw, *_ticket_groups(), **limits)


def fan_skew(raw: DataFrame, **limits) -> HotKeys:
    """Oversize groups of one identified fan at one match."""
    return hot_keys(raw, *_fan_groups(), **limits)


def scan_skew(raw: DataFrame, policy: ScanPolicy | None = None, **limits) -> ScanSkew:
    """Oversize groups of every ranking that the policy asks for, in one look."""
    groupings = [_ticket_groups(), _fan_groups()]
    if policy is not None and policy.dedup_after_repair:
        fixed = repair.repair_ticket_id(text.code(F.col("ticket_id")))
        groupings.append(([fixed], fixed.isNotNull()))
    return ScanSkew(*hot_keys_of(raw, groupings, **limits))


def fill_skew(scans: DataFrame, **limits) -> FillSkew:
    """The same for the lookups, among the rows that need one."""
    day = F.to_date("scan_timestamp")
    lacks_match, lacks_stadium = F.col("match_id").isNull(), F.col("stadium_id").isNull()
    groupings = [
        (["stadium_id", day], lacks_match & ~lacks_stadium),
        (["match_id"], lacks_stadium & ~lacks_match),
    ]
    return FillSkew(*hot_keys_of(scans, groupings, **limits))


# ---- row rules --------------------------------------------------------------------
def with_ticket_id(df: DataFrame) -> DataFrame:
    """Normalised, repaired and judged ticket id."""
    return _judge_ticket(df.withColumn("ticket_id", text.code(F.col("ticket_id"))))


def _judge_ticket(normal: DataFrame) -> DataFrame:
    return normal.withColumn("ticket_id_fixed", repair.repair_ticket_id(F.col("ticket_id"))).withColumn(
        "ticket_id_valide", checks.ticket_id_valid(F.col("ticket_id_fixed"))
    )


def with_fan_id(df: DataFrame) -> DataFrame:
    """Normalised, repaired and judged fan id; NULL becomes the anonymous mark."""
    normal = text.code_or(F.col("fan_id"), rules.ANONYMOUS_FAN)
    return _judge_fan(df.withColumn("fan_id", normal))


def _judge_fan(normal: DataFrame) -> DataFrame:
    return normal.withColumn("fan_id_fixed", repair.repair_fan_id(F.col("fan_id"))).withColumn(
        "fan_id_valide", checks.fan_id_valid(F.col("fan_id_fixed"))
    )


def with_category(df: DataFrame) -> DataFrame:
    normal = text.code_or(F.col("ticket_category"), rules.NULL_TEXT)
    fixed = F.col("ticket_category_fixed")
    return (
        df.withColumn("ticket_category_clean", normal)
        .withColumn("ticket_category_fixed", repair.repair_category(F.col("ticket_category_clean")))
        .withColumn("ticket_category_valide", fixed.isin(*rules.CATEGORIES))
    )


def with_price_checks(df: DataFrame, policy: ScanPolicy | None = None) -> DataFrame:
    policy = policy or ScanPolicy()
    price = F.col("ticket_price_mad")
    return df.withColumns(
        {
            "ticket_price_valide": checks.price_valid(price),
            "prix_categorie_coherent": checks.in_band(
                F.col("ticket_category_fixed"), price, policy.price_bands
            ),
        }
    )


def with_channel(df: DataFrame, policy: ScanPolicy | None = None) -> DataFrame:
    policy = policy or ScanPolicy()
    accepted = [*rules.CHANNELS]
    if policy.invalid_channel_is_valid:
        accepted.append(rules.NO_MATCH)
    normal = text.code_or(F.col("purchase_channel"), rules.NULL_TEXT)
    return (
        df.withColumn("purchase_channel_clean", normal)
        .withColumn("purchase_channel_fixed", repair.repair_channel(F.col("purchase_channel_clean")))
        .withColumn("purchase_channel_valide", F.col("purchase_channel_fixed").isin(*accepted))
    )


def with_dates(df: DataFrame, policy: ScanPolicy | None = None) -> DataFrame:
    """Typed dates, their checks, and the purchase date pulled back to the scan's day."""
    policy = policy or ScanPolicy()
    bought, day, at = F.col("purchase_date_ts"), F.col("scan_date_ts"), F.col("scan_timestamp_ts")
    moment = F.col("scan_timestamp")
    if dict(df.dtypes)["scan_timestamp"] == "string":
        moment = moment.try_cast("timestamp")
    return (
        df.withColumns(
            {
                "purchase_date_ts": F.col("purchase_date").try_cast("date"),
                "scan_date_ts": moment.cast("date"),
                "scan_timestamp_ts": moment,
            }
        )
        .withColumns(
            {
                "date_order_valide": bought <= day,
                "scan_date_valide": checks.in_period(at, policy.period_year, policy.period_months),
                "purchase_date_fixed": repair.no_later_than(bought, day),
            }
        )
    )


QUALITY_FLAGS = (
    "ticket_id_valide",
    "fan_id_valide",
    "ticket_category_valide",
    "ticket_price_valide",
    "purchase_channel_valide",
)


#: What is told about the quality of a row: flags of all rules, score, and whether all hold.
QUALITY = (
    *QUALITY_FLAGS,
    "prix_categorie_coherent",
    "date_order_valide",
    "scan_date_valide",
    "quality_score",
    "completement_valide",
)


def with_quality(df: DataFrame, policy: ScanPolicy | None = None) -> DataFrame:
    """Quality score in percent and whether all five flags hold."""
    policy = policy or ScanPolicy()
    flags = [F.col(name) for name in QUALITY_FLAGS]
    return df.withColumns(
        {
            "quality_score": checks.score(flags, policy.quality_terms),
            "completement_valide": checks.all_true(flags),
        }
    )


def with_business_rules(df: DataFrame, policy: ScanPolicy | None = None) -> DataFrame:
    """Category, price, channel, dates and quality of each row."""
    df = with_price_checks(with_category(df), policy)
    return with_quality(with_dates(with_channel(df, policy), policy), policy)


# ---- quarantine steps -------------------------------------------------------------
def ticket_split(df: DataFrame) -> Split:
    """Judge ticket ids; rejected rows carry the audit table they belong to.

    Rows are accepted by the shape of the normalised id, before its repair: a filter on
    the flag would repeat the whole repair, once as predicate and once as column.
    """
    normal = df.withColumn("ticket_id", text.code(F.col("ticket_id")))
    good = F.col("ticket_id").rlike(rules.ACCEPTED_TICKET)
    reasons = id_reasons("ticket_id", F.col("ticket_id_valide"))
    return split(normal, good, reasons, _judge_ticket)


def fan_split(df: DataFrame) -> Split:
    normal = df.withColumn("fan_id", text.code_or(F.col("fan_id"), rules.ANONYMOUS_FAN))
    good = F.col("fan_id").rlike(rules.ACCEPTED_FAN)
    return split(normal, good, id_reasons("fan_id", F.col("fan_id_valide")), _judge_fan)


def is_identified() -> Column:
    return F.col("fan_id") != rules.ANONYMOUS_FAN


def first_per_ticket(df: DataFrame, hashed: str | None = None) -> DataFrame:
    """Earliest scan of each ticket id as typed."""
    known = df.filter(F.col("ticket_id").isNotNull())
    return keep_first(known, TICKET, FIRST_SCAN, ties=SCAN, hashed=hashed)


def repeated_tickets(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Later scans of each ticket id, numbered from 2."""
    known = df.filter(F.col("ticket_id").isNotNull())
    return rank_rows(known, TICKET, FIRST_SCAN, hot=hot, ties=SCAN).filter("row_num > 1")


def first_per_fan_at_match(df: DataFrame, row_id: str | None = None) -> DataFrame:
    """Earliest entry of each identified fan at each match, and every anonymous entry."""
    return keep_first(df, FAN_AT_MATCH, FIRST_SCAN, SCAN, only=is_identified(), row_id=row_id)


def repeated_fans(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Later entries of an identified fan at the same match."""
    known = df.filter(is_identified())
    ranked = rank_rows(known, FAN_AT_MATCH, FIRST_SCAN, hot=hot, ties=SCAN)
    return ranked.filter("row_num > 1").drop("row_num")


# ---- whole plans ------------------------------------------------------------------
def judged_scans(raw: DataFrame) -> DataFrame:
    """Rows up to the last quarantine but one: distinct, first per ticket, both ids valid.

    ``ticket_id_raw``, the id as typed, is unique among them. The first scans of tickets are taken before
    copies: rows are dealt by ticket then, where copies meet as well, so both steps share a shuffle.
    """
    first = first_per_ticket(raw, hashed=_TICKET_HASH)
    kept = profile.distinct_rows(first).drop(_TICKET_HASH).withColumn("ticket_id_raw", F.col("ticket_id"))
    return fan_split(ticket_split(kept).accepted).accepted


def accepted_scans(raw: DataFrame, policy: ScanPolicy | None = None) -> DataFrame:
    """Accepted rows with every rule column."""
    policy = policy or ScanPolicy()
    # What follows from the ids is left out of the shuffle, and so is the id as typed where fans are known.
    alone = F.when(~is_identified(), F.col("ticket_id_raw")).alias("ticket_id_raw")
    entered = judged_scans(raw).select(*SCAN, alone)
    kept = first_per_fan_at_match(entered, "ticket_id_raw").drop("ticket_id_raw")
    kept = _judge_fan(_judge_ticket(kept))
    if policy.dedup_after_repair:
        kept = keep_first(kept, ["ticket_id_fixed"], FIRST_SCAN, ties=[*SCAN, "ticket_id_fixed"])
    return with_business_rules(kept, policy)


def _ranked_copies(raw: DataFrame, hot: HotKeys) -> DataFrame:
    """Every distinct row with its copies, in ``count``, and its place among the scans of its ticket, in ``row_num``.

    Rows are dealt by ticket before copies are counted, so both steps share a shuffle. Rows without a ticket are
    counted apart, before their shuffle; they have no place. With oversize tickets, which copies of one row
    may make, all rows are counted like that, and ranked in a shuffle of their own.
    """
    known = F.col("ticket_id").isNotNull()
    if hot:
        return rank_rows(profile.row_copies(raw), TICKET, FIRST_SCAN, "row_num", known, hot, SCAN)
    dealt = deal(raw.filter(known), TICKET, _TICKET_HASH)
    order = list(dict.fromkeys([_TICKET_HASH, *TICKET, *FIRST_SCAN, *SCAN, *raw.columns]))
    counted = profile.sorted_copies(dealt, order)
    ranked = rank_rows(counted, TICKET, FIRST_SCAN, "row_num", ties=SCAN, hashed=_TICKET_HASH).drop(_TICKET_HASH)
    without = profile.row_copies(raw.filter(~known)).withColumn("row_num", F.lit(None).cast("bigint"))
    return ranked.unionByName(without)


def _ranked_entries(judged: DataFrame, hot: HotKeys, store: bool) -> DataFrame:
    """Rows that nothing rejects so far, with their place among the entries of their fan at their match, and all others."""
    taking = (F.col("__early") == ACCEPTED) & is_identified()
    if not store:
        return rank_rows(judged, FAN_AT_MATCH, FIRST_SCAN, "__entry", taking, hot, SCAN)
    judged = materialize(judged, "judged")
    # What is the same for all rows that take part is left out of their shuffle.
    alone = judged.filter(taking).drop("row_num", "__early")
    if hot:
        ranked = rank_rows(alone, FAN_AT_MATCH, FIRST_SCAN, "__entry", hot=hot, ties=SCAN)
    else:
        dealt = deal(alone, FAN_AT_MATCH, _ENTRY_HASH)
        ranked = rank_rows(dealt, FAN_AT_MATCH, FIRST_SCAN, "__entry", ties=SCAN, hashed=_ENTRY_HASH).drop(_ENTRY_HASH)
    ranked = ranked.withColumns({"row_num": F.lit(1).cast("bigint"), "__early": F.lit(ACCEPTED)})
    others = judged.filter(~taking).withColumn("__entry", F.lit(None).cast("bigint"))
    return ranked.unionByName(others)


def place_scans(
    raw: DataFrame, skew: ScanSkew | None = None, policy: ScanPolicy | None = None, store: bool = False
) -> DataFrame:
    """Every distinct row with its outcome, in ``audit_table``, and its copies, in ``count``.

    Three shuffles in all: by ticket, for copies and ranks, by the whole row for those without a ticket, and by
    fan and match. A row already rejected takes no part in the last ranking. With ``store`` the rows are stored
    before it, and only those that take part are shuffled again. The raw scans are read twice, so they should
    be stored as well. Rows hold what nothing else tells: the scan with normalised ids, and ids as typed where
    these differ. ``told_scans`` adds the rest.
    """
    skew = skew or ScanSkew()
    policy = policy or ScanPolicy()
    ranked = _ranked_copies(raw, skew.ticket)
    early = outcome(
        [
            ("ticket_id_null", F.col("ticket_id").isNull()),
            ("ticket_id_doublons", F.col("row_num") > 1),
            *id_reasons("ticket_id", F.col("ticket_id_valide")),
            *id_reasons("fan_id", F.col("fan_id_valide")),
        ]
    )
    typed = ranked.withColumns({"__ticket": F.col("ticket_id"), "__fan": F.col("fan_id")})
    judged = with_fan_id(with_ticket_id(typed)).withColumn("__early", early)
    # What follows from the normalised ids is left out of the next shuffle, and so are ids typed like that.
    told = (F.col("fan_id") == F.col("__fan")) & is_identified()
    narrow = judged.withColumns(
        {
            "__ticket": F.when(~F.col("ticket_id").eqNullSafe(F.col("__ticket")), F.col("__ticket")),
            "__fan": F.when(~told, F.col("__fan")),
        }
    ).select(*SCAN, "count", "__ticket", "__fan", "row_num", "__early")
    entered = _ranked_entries(narrow, skew.fan_at_match, store)
    final = F.when(F.col("__entry") > 1, F.lit("fan_id_doublons")).otherwise(F.col("__early"))
    placed = entered.withColumn("audit_table", final)
    if policy.dedup_after_repair:
        repaired = _judge_ticket(placed)
        placed = _reject_repaired_copies(repaired, skew.repaired_ticket).drop("ticket_id_fixed", "ticket_id_valide")
    return (
        placed
        .withColumn("row_num", F.when(F.col("audit_table") == "ticket_id_doublons", F.col("row_num")))
        .drop("__early", "__entry")
    )


def told_scans(placed: DataFrame, policy: ScanPolicy | None = None) -> DataFrame:
    """Placed rows with ids as typed and repaired, and every rule column: all that follows from a row alone."""
    fan = F.when(is_identified(), F.coalesce("__fan", "fan_id")).otherwise(F.col("__fan"))
    typed = placed.withColumns({"ticket_id_raw": F.coalesce("__ticket", "ticket_id"), "fan_id_raw": fan})
    names = [*SCAN, "count", "ticket_id_raw", "fan_id_raw", "row_num"]
    judged = ["ticket_id_fixed", "ticket_id_valide", "fan_id_fixed", "fan_id_valide"]
    told = _judge_fan(_judge_ticket(typed)).select(*names, *judged, "audit_table")
    return with_business_rules(told, policy)


def classify_scans(
    raw: DataFrame, skew: ScanSkew | None = None, policy: ScanPolicy | None = None, store: bool = False
) -> DataFrame:
    """Every distinct row with its outcome, copies, and every rule column."""
    return told_scans(place_scans(raw, skew, policy, store), policy)


def _reject_repaired_copies(placed: DataFrame, hot: HotKeys) -> DataFrame:
    """Of accepted rows whose ids were repaired to the same one, keep the earliest."""
    ranked = rank_rows(
        placed,
        ["ticket_id_fixed"],
        FIRST_SCAN,
        "__again",
        F.col("audit_table") == ACCEPTED,
        hot,
        ties=[*SCAN, "ticket_id_fixed"],
    )
    again = F.col("__again") > 1
    return ranked.withColumns(
        {
            "audit_table": F.when(again, "ticket_id_doublons").otherwise(F.col("audit_table")),
            "row_num": F.when(again, F.col("__again")).otherwise(F.col("row_num")),
        }
    ).drop("__again")


def accepted_of(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("audit_table") == ACCEPTED)


def audit_of(classified: DataFrame, at: Column | None = None) -> DataFrame:
    """One audit table: every rejected row, and one row per group of full copies.

    Each row shows its ids as they stood at the step that rejected it. ``count`` is filled
    only for copies, as being copied is no reason to reject the one row that is kept.
    """
    rejected = classified.filter(F.col("audit_table") != ACCEPTED).withColumn(
        "count", F.lit(None).cast("bigint")
    )
    copies = (
        classified.filter(F.col("count") > 1)
        .withColumn("row_num", F.lit(None).cast("bigint"))
        .withColumn("audit_table", F.lit("complets_doublons"))
    )
    table = F.col("audit_table")
    ticket_judged = ~table.isin("complets_doublons", "ticket_id_null", "ticket_id_doublons")
    fan_judged = table.startswith("fan_id")
    shown = {
        "ticket_id": F.when(ticket_judged, F.col("ticket_id")).otherwise(F.col("ticket_id_raw")),
        "fan_id": F.when(fan_judged, F.col("fan_id")).otherwise(F.col("fan_id_raw")),
    }
    for judged, names in (
        (ticket_judged, ("ticket_id_fixed", "ticket_id_valide")),
        (fan_judged, ("fan_id_fixed", "fan_id_valide")),
    ):
        shown.update({n: F.when(judged, F.col(n)) for n in names})
    both = rejected.unionByName(copies).withColumns(shown)
    return stamp(both, at=at).select(*contracts.AUDIT.names)


def cleaned_columns(df: DataFrame) -> DataFrame:
    return df.select(*contracts.TICKETS_CLEANED.names)


def fill_match_ids(
    scans: DataFrame,
    matches: DataFrame,
    small: bool | None = None,
    hot: HotKeys | None = None,
    strict: bool = False,
) -> DataFrame:
    """Fill a missing match id with the match at the scan's stadium on the scan's day."""
    played = matches.select(
        "stadium_id", F.to_date("match_date").alias("match_day"), "match_id"
    )
    on = {"stadium_id": "stadium_id", "match_day": F.to_date("scan_timestamp")}
    return fill_from_lookup(scans, played, on, "match_id", "match_id", small, hot, strict)


def fill_nearest_match_ids(
    scans: DataFrame, matches: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Fill a missing match id with that match at the stadium on the scan's day whose kick-off is
    nearest to the scan: the earlier of two equally near, the smallest id of several at one time.

    A match without a kick-off counts as played at the beginning of its day.
    """
    played = matches.select(
        "stadium_id",
        F.to_date("match_date").alias("match_day"),
        F.coalesce(F.col("match_datetime").cast("timestamp"), F.col("match_date").cast("timestamp")).alias("__kick_off"),
        F.col("match_id").alias("__found_id"),
    )
    on = {"stadium_id": F.col("stadium_id"), "match_day": F.to_date("scan_timestamp")}
    joined = asof_join(
        scans, played, on, F.col("scan_timestamp"), "__kick_off", ["__found_id"],
        needed=F.col("match_id").isNull(), hot=hot,
    )
    filled = F.coalesce("match_id", "__found_id").alias("match_id")
    return joined.select(*[filled if c == "match_id" else F.col(f"`{c}`") for c in scans.columns])


def fill_stadium_ids(
    scans: DataFrame,
    matches: DataFrame,
    small: bool | None = None,
    hot: HotKeys | None = None,
    strict: bool = False,
) -> DataFrame:
    """Fill a missing stadium id with the stadium of the scan's match."""
    venue = matches.select("match_id", "stadium_id")
    on = {"match_id": "match_id"}
    return fill_from_lookup(scans, venue, on, "stadium_id", "stadium_id", small, hot, strict)


def short_names(cleaned: DataFrame) -> DataFrame:
    """Drop the suffix of the three repaired attributes."""
    return cleaned.withColumnsRenamed(
        {
            "ticket_category_fixed": "ticket_category",
            "purchase_channel_fixed": "purchase_channel",
            "purchase_date_fixed": "purchase_date",
        }
    )


def fact_match_skew(raw: DataFrame, **limits) -> HotKeys:
    """Oversize groups among the match ids that scans bring along."""
    return hot_keys(raw, ["match_id"], where=F.col("match_id").isNotNull(), **limits)


def lookup_is_small(matches: DataFrame) -> bool:
    """Whether what scans look up in the matches may be broadcast, in silver and in gold."""
    return is_small(
        matches.select(
            "match_id", "match_date", "stadium_id", "home_team_code", "away_team_code"
        )
    )


def enrich_scans(
    cleaned: DataFrame,
    matches: DataFrame,
    policy: ScanPolicy | None = None,
    small: bool | None = None,
    skew: FillSkew | None = None,
    columns: Collection[str] | None = None,
) -> DataFrame:
    """Missing references filled, columns and names of the silver contract, or those of ``columns``."""
    policy = policy or ScanPolicy()
    if columns is not None and policy.dedup_fans_after_enrichment:
        raise ValueError("ties between the scans of a fan are decided on all columns")
    strict = policy.strict_lookups
    if policy.normalize_keys:
        keys = ("match_id", "stadium_id")
        cleaned, matches = (
            df.withColumns({k: text.code(F.col(k)) for k in keys}) for df in (cleaned, matches)
        )
    if small is None:
        small = lookup_is_small(matches)
    if (not small or policy.nearest_match) and skew is None:
        skew = fill_skew(cleaned)
    skew = skew or FillSkew()
    if policy.nearest_match:
        filled = fill_nearest_match_ids(short_names(cleaned), matches, skew.stadium_day)
    else:
        filled = fill_match_ids(short_names(cleaned), matches, small, skew.stadium_day, strict)
    filled = fill_stadium_ids(filled, matches, small, skew.match, strict)
    renamed = filled.withColumnsRenamed(
        {
            "ticket_id": "ticket_id_original",
            "fan_id": "fan_id_original",
            "ticket_id_valide": "is_ticket_id_valid",
            "fan_id_valide": "is_fan_id_valid",
        }
    ).withColumnsRenamed({"ticket_id_fixed": "ticket_id", "fan_id_fixed": "fan_id"})
    names = contracts.TICKET_SCANS_CLEAN.names
    silver = renamed.select(*[c for c in names if columns is None or c in columns])
    if policy.dedup_fans_after_enrichment:
        known = is_identified() & F.col("match_id").isNotNull()
        silver = keep_first(silver, FAN_AT_MATCH, FIRST_SCAN, only=known)
    return silver


#: Silver columns that cleaned scans have under another name.
CLEANED_NAMES = {
    "ticket_id_original": "ticket_id",
    "fan_id_original": "fan_id",
    "ticket_id": "ticket_id_fixed",
    "fan_id": "fan_id_fixed",
    "is_ticket_id_valid": "ticket_id_valide",
    "is_fan_id_valid": "fan_id_valide",
    "ticket_category": "ticket_category_fixed",
    "purchase_channel": "purchase_channel_fixed",
    "purchase_date": "purchase_date_fixed",
}


def kept_scans(
    raw: DataFrame,
    small: bool,
    policy: ScanPolicy | None = None,
    columns: Collection[str] | None = None,
) -> DataFrame:
    """Cleaned scans; stored where the matches are too many to broadcast (not ``small``).

    They are read several times then: by the look for oversize groups, and for the rows that look
    something up and those that do not. ``columns`` names the silver columns that are read later; what
    they and the fills do not come from is not stored.
    """
    kept = cleaned_columns(accepted_scans(raw, policy))
    if columns is not None:
        read = {"match_id", "stadium_id", "scan_timestamp", *(CLEANED_NAMES.get(c, c) for c in columns)}
        kept = kept.select(*[c for c in kept.columns if c in read])
    return kept if small else materialize(kept, "cleaned")


def silver_scans(
    raw: DataFrame,
    matches: DataFrame,
    policy: ScanPolicy | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Raw scans and cleaned matches to the silver table, in one lineage.

    Where the matches are too many to broadcast, the cleaned scans are stored once, and oversize
    groups are looked for there: a scan of a few columns, instead of a second run of the steps before.
    """
    policy = policy or ScanPolicy()
    if small is None:
        small = lookup_is_small(matches)
    return enrich_scans(kept_scans(raw, small, policy), matches, policy, small)
