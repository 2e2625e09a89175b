"""Rule tables: one input and the values every repair and check must give."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starloom import rules
from starloom.functions import checks, numbers, repair, text
from starloom.functions.dates import at_time, date_key, day_type
from starloom.plans import silver_scans as plan
from starloom.rules import ScanPolicy

TICKETS = [
    ("TICKET_ABC", "TICKET_ABC", True),
    ("TICKETABC", "TICKET_ABC", True),
    ("TK_123", "TICKET_123", True),
    (" ticket_abc ", "TICKET_ABC", True),
    ("TICKET_AB", "TICKET_AB", False),
    ("TICKET_ABCDEFGHIJKL", "TICKET_ABCDEFGHIJKL", True),
    ("TICKET_ABCDEFGHIJKLM", "TICKET_ABCDEFGHIJKLM", False),
    ("XX_1", None, None),
    ("TICKET_", None, None),
    ("TICKET_A_B", None, None),
    ("TK123", None, None),
    ("", None, None),
    (None, None, None),
]
FANS = [
    (None, "N/A", True),
    (" n/a ", "N/A", True),
    ("FAN_123456", "FAN_123456", True),
    ("fan123", "FAN_123", True),
    (" Fan_abc ", "FAN_ABC", True),
    ("FANATIC", "FAN_ATIC", True),
    ("FAN_12", None, None),
    ("FAN12", None, None),
    ("F#1", None, None),
    ("FAN_A_B", None, None),
    ("FAN_1234567890123", None, None),
]
CATEGORIES = [
    ("CATEGORY_1", "CATEGORY_1"),
    ("category 2", "CATEGORY_2"),
    ("CAT3", "CATEGORY_3"),
    ("cat 3", "CATEGORY_3"),
    (" cat_1 ", "CATEGORY_1"),
    ("CATEGORY__1", "CATEGORY_1"),
    ("2", "CATEGORY_2"),
    ("VIP", "INVALID"),
    (None, "INVALID"),
    ("UNKNOWN", "INVALID"),
    ("", "INVALID"),
    ("CATEGORY-1", "INVALID"),
    ("CATEGORY_4", "INVALID"),
    ("_1", "INVALID"),
    ("12", "INVALID"),
]
CHANNELS = [
    ("WEBSITE", "WEBSITE"),
    ("web", "WEBSITE"),
    ("website_v2", "WEBSITE"),
    (" Online ", "WEBSITE"),
    ("mobile_app", "MOBILE_APP"),
    ("APP", "MOBILE_APP"),
    ("phone", "MOBILE_APP"),
    (None, "INVALID"),
    ("kiosk", "INVALID"),
    ("INVALID", "INVALID"),
]
PRICES = [
    ("CATEGORY_1", None, False, False),
    ("CATEGORY_1", -1, False, False),
    ("CATEGORY_1", 0, True, False),
    ("CATEGORY_1", 249, True, False),
    ("CATEGORY_1", 250, True, True),
    ("CATEGORY_1", 350, True, True),
    ("CATEGORY_2", 150, True, True),
    ("CATEGORY_2", 250, True, True),
    ("CATEGORY_3", 50, True, True),
    ("CATEGORY_3", 150, True, True),
    ("CATEGORY_3", 151, True, False),
    ("INVALID", 100, True, False),
]


def column(spark, values, name, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")


def result(df, *names):
    return [tuple(r) for r in df.orderBy("i").select(*names).collect()]


def test_ticket_ids(spark):
    df = plan.with_ticket_id(column(spark, [t[0] for t in TICKETS], "ticket_id"))
    assert result(df, "ticket_id_fixed", "ticket_id_valide") == [t[1:] for t in TICKETS]


def test_fan_ids(spark):
    df = plan.with_fan_id(column(spark, [t[0] for t in FANS], "fan_id"))
    assert result(df, "fan_id_fixed", "fan_id_valide") == [t[1:] for t in FANS]


@pytest.mark.parametrize(
    ("table", "name", "split", "judged"),
    [
        (TICKETS, "ticket_id", plan.ticket_split, plan.with_ticket_id),
        (FANS, "fan_id", plan.fan_split, plan.with_fan_id),
    ],
)
def test_splits_agree_with_the_flag_and_lose_nothing(spark, table, name, split, judged):
    df = column(spark, [t[0] for t in table], name)
    parts = split(df)
    flagged = result(judged(df).filter(f"{name}_valide"), "i", f"{name}_fixed")
    assert result(parts.accepted, "i", f"{name}_fixed") == flagged
    assert parts.accepted.count() + parts.rejected.count() == len(table)
    for _, valid, reason in result(parts.rejected, "i", f"{name}_valide", "audit_table"):
        assert reason == (f"{name}_irreparable" if valid is None else f"{name}_invalide")


def test_categories(spark):
    df = plan.with_category(column(spark, [t[0] for t in CATEGORIES], "ticket_category"))
    expected = [(fixed, fixed != "INVALID") for _, fixed in CATEGORIES]
    assert result(df, "ticket_category_fixed", "ticket_category_valide") == expected


def test_channels(spark):
    df = column(spark, [t[0] for t in CHANNELS], "purchase_channel")
    out = plan.with_channel(df)
    assert result(out, "purchase_channel_fixed", "purchase_channel_valide") == [
        (fixed, True) for _, fixed in CHANNELS
    ]
    strict = plan.with_channel(df, ScanPolicy(invalid_channel_is_valid=False))
    assert result(strict, "purchase_channel_valide") == [(f != "INVALID",) for _, f in CHANNELS]


def test_prices(spark):
    df = spark.createDataFrame(
        [(i, c, p) for i, (c, p, _, _) in enumerate(PRICES)],
        "i int, ticket_category_fixed string, ticket_price_mad int",
    )
    out = plan.with_price_checks(df)
    assert result(out, "ticket_price_valide", "prix_categorie_coherent") == [p[2:] for p in PRICES]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_dates(spark, kind):
    scan = datetime(2025, 12, 31, 20)
    table = [
        (date(2025, 12, 31), scan, True, True, date(2025, 12, 31)),
        (date(2026, 1, 5), scan, False, True, date(2025, 12, 31)),
        (None, scan, None, True, None),
        (date(2025, 11, 1), datetime(2026, 1, 1), True, False, date(2025, 11, 1)),
        (date(2025, 11, 1), datetime(2025, 11, 30), True, False, date(2025, 11, 1)),
        (date(2025, 11, 1), None, None, None, date(2025, 11, 1)),
    ]
    df = spark.createDataFrame(
        [(i, b, s) for i, (b, s, *_) in enumerate(table)],
        "i int, purchase_date date, scan_timestamp timestamp",
    ).withColumn("scan_timestamp", F.col("scan_timestamp").cast(kind))
    out = plan.with_dates(df)
    names = ("date_order_valide", "scan_date_valide", "purchase_date_fixed")
    assert result(out, *names) == [t[2:] for t in table]


def test_quality(spark):
    flags = [(True,) * 5, (True, True, False, True, True), (True, True, False, False, True),
             (True, None, True, True, True)]
    df = spark.createDataFrame(
        [(i, *f) for i, f in enumerate(flags)],
        "i int, " + ", ".join(f"{f} boolean" for f in plan.QUALITY_FLAGS),
    )
    got = result(plan.with_quality(df), "quality_score", "completement_valide")
    assert [round(s, 2) for s, _ in got] == [83.33, 66.67, 50.0, 66.67]
    assert [v for _, v in got] == [True, False, False, None]


def test_text_cleaners(spark):
    df = column(spark, ["  gRAND stade  de x "], "c")
    shown = {
        "title": text.title, "code": text.code, "trimmed": text.trimmed,
        "address": text.address, "without_blanks": text.without_blanks,
    }
    got = df.select(*[f(F.col("c")).alias(n) for n, f in shown.items()]).first().asDict()
    assert got == {
        "title": "Grand Stade  De X", "code": "GRAND STADE  DE X", "trimmed": "gRAND stade  de x",
        "address": "grand stade  de x", "without_blanks": "gRANDstadedex",
    }


def test_match_times(spark):
    df = column(spark, ["1899-12-30T17:00:00.0000000", "late", None], "raw")
    day = F.lit(date(2025, 12, 21))
    clock = text.clock_time(F.col("raw"))
    got = result(df.select("i", clock.alias("t"), at_time(day, clock).alias("at")), "t", "at")
    assert got == [
        ("17:00:00", datetime(2025, 12, 21, 17)), ("", datetime(2025, 12, 21)), (None, None)
    ]


def test_calendar(spark):
    df = column(spark, [date(2025, 12, 20), date(2025, 12, 21), date(2025, 12, 22)], "d", "date")
    got = result(df.select("i", date_key(F.col("d")).alias("k"), day_type(F.col("d")).alias("t")), "k", "t")
    assert got == [(20251220, "Weekend"), (20251221, "Weekend"), (20251222, "Weekday")]


def test_safe_divide_and_cap(spark):
    table = [(1.0, 2.0, 0.5), (1.0, 0.0, 0.0), (1.0, None, 0.0), (None, 2.0, None), (6.0, 2.0, 1.0)]
    df = spark.createDataFrame([(i, n, d) for i, (n, d, _) in enumerate(table)], "i int, n double, d double")
    got = df.select("i", numbers.capped(numbers.safe_divide(F.col("n"), F.col("d"))).alias("q"))
    assert result(got, "q") == [(q,) for *_, q in table]


def test_row_rules_apply_to_a_stream_unchanged(spark, tmp_path):
    column(spark, [t[0] for t in TICKETS], "ticket_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("i int, ticket_id string").parquet(str(tmp_path / "in"))
    run = (
        plan.with_ticket_id(stream).writeStream.format("memory").queryName("judged")
        .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    run.awaitTermination(120)
    assert result(spark.table("judged"), "ticket_id_fixed") == [(t[1],) for t in TICKETS]


def test_accepted_shapes_agree_with_repair_and_check(spark):
    """One test per row stands for repair and judgement; both must say the same of any id."""
    parts = ["TICKET", "TK", "FAN", "_", "N/A", "A", "B2", "C" * 11, "D" * 12, "E" * 13, "-", ""]
    ids = sorted({a + b + c for a in parts for b in parts for c in parts})
    frame = spark.createDataFrame([(i,) for i in ids], "id string")
    judged = frame.select(
        F.col("id").rlike(rules.ACCEPTED_TICKET).alias("ticket_shape"),
        F.coalesce(checks.ticket_id_valid(repair.repair_ticket_id(F.col("id"))), F.lit(False)).alias("ticket"),
        F.col("id").rlike(rules.ACCEPTED_FAN).alias("fan_shape"),
        F.coalesce(checks.fan_id_valid(repair.repair_fan_id(F.col("id"))), F.lit(False)).alias("fan"),
    )
    assert judged.filter("ticket_shape <> ticket OR fan_shape <> fan").isEmpty()
    assert judged.filter("ticket").count() > 5 and judged.filter("fan").count() > 5
