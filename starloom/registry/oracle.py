"""The registered queries once more, in plain SQL over the same tables.

Written from the rules, not from the Spark plans: global windows and joins as a single
machine would run them.
"""

from __future__ import annotations

RAW = """
city_raw AS (
 SELECT ' '||lower('C'||n_nationkey)||' ' AS city_code, ' '||n_name AS city_name,
        ' '||r_name||' ' AS region, lower('AP'||n_nationkey) AS airport_code, ' dry ' AS climate_type
 FROM nation JOIN region ON n_regionkey=r_regionkey),
team_raw AS (
 SELECT lower('T'||n_nationkey)||' ' AS team_code, ' '||n_name||' ' AS team_name,
        substr('abcde', n_regionkey+1, 1) AS team_group, lower(r_name) AS federation,
        ' Coach '||n_nationkey AS coach_name
 FROM nation JOIN region ON n_regionkey=r_regionkey),
stadium_raw AS (
 SELECT 'STD_'||s_suppkey AS stadium_id, ' '||s_name AS stadium_name,
        CASE WHEN s_suppkey%11=4 THEN 'c99' ELSE lower('C'||s_nationkey)||' ' END AS city_code,
        ' '||s_suppkey||' Main St ' AS full_address,
        CAST(20000+(s_suppkey%7)*5000 AS INT) AS seating_capacity,
        CASE WHEN s_suppkey%2=0 THEN 'natural ' ELSE ' Hybrid' END AS pitch_type,
        '+212 5 '||s_suppkey AS contact_phone, ' Info'||s_suppkey||'@X.ORG' AS email
 FROM supplier),
order_sited AS (
 SELECT *, CASE WHEN (o_custkey//15)%13=7 THEN o_custkey//15-1 ELSE o_custkey//15 END AS sid FROM orders),
match_raw AS (
 SELECT 'M'||o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS match_date,
        '1899-12-30T'||CASE WHEN o_orderkey%2=0 THEN '17:00:00' ELSE '20:30:00' END||'.0000000'
          AS match_time,
        ' '||o_orderpriority||' ' AS stage, substr('abcdef', CAST(o_orderkey%6 AS INT)+1, 1) AS group_code,
        CASE WHEN o_orderkey%37=5 THEN ' nowhere' ELSE ' std_'||sid END AS stadium_id,
        't'||(o_orderkey%27) AS home_team_code,
        't'||((o_orderkey+7)%25)||' ' AS away_team_code, ' calm ' AS weather_notes
 FROM order_sited),
scan_raw AS (
 SELECT CASE WHEN l_suppkey%50=7 THEN NULL ELSE CASE CAST(l_partkey%8 AS INT)
          WHEN 0 THEN 'TICKET_'||(l_orderkey*10+l_linenumber) WHEN 1 THEN 'ticket_'||(l_orderkey*10+l_linenumber)
          WHEN 2 THEN 'TK_'||(l_orderkey*10+l_linenumber)     WHEN 3 THEN 'TICKET'||(l_orderkey*10+l_linenumber)
          WHEN 4 THEN '  Ticket_'||(l_orderkey*10+l_linenumber)||' ' WHEN 5 THEN 'TICKET_'||(l_linenumber)
          WHEN 6 THEN 'XX-'||(l_orderkey*10+l_linenumber)
          ELSE 'TICKET_A'||(l_orderkey*10+l_linenumber) END END AS ticket_id,
        CASE WHEN l_partkey%11=0 THEN NULL ELSE 'M'||l_orderkey END AS match_id,
        CASE WHEN l_partkey%13=0 THEN NULL ELSE 'STD_'||sid END AS stadium_id,
        CASE CAST(l_suppkey%6 AS INT) WHEN 0 THEN NULL WHEN 1 THEN 'FAN_'||(100000+o_custkey)
          WHEN 2 THEN 'fan'||(100000+o_custkey) WHEN 3 THEN ' fan_'||(100000+o_custkey)||' '
          WHEN 4 THEN CASE WHEN l_linenumber=1 THEN 'F#'||o_custkey ELSE 'FAN_'||(100000+o_custkey) END
          ELSE 'FAN'||(100000+o_custkey) END AS fan_id,
        CASE CAST(l_partkey%9 AS INT) WHEN 0 THEN 'CATEGORY_1' WHEN 1 THEN 'category 2' WHEN 2 THEN 'CAT3'
          WHEN 3 THEN ' cat_1 ' WHEN 4 THEN '2' WHEN 5 THEN 'CATEGORY_3' WHEN 6 THEN 'VIP'
          WHEN 7 THEN NULL ELSE 'CATEGORY__1' END AS ticket_category,
        CASE WHEN l_partkey%17=0 THEN NULL WHEN l_partkey%19=0 THEN -CAST(l_quantity AS INT)
          ELSE CAST(l_quantity AS INT)*8 END AS ticket_price_mad,
        CASE CAST(l_suppkey%7 AS INT) WHEN 0 THEN 'WEBSITE' WHEN 1 THEN 'web' WHEN 2 THEN ' Online '
          WHEN 3 THEN 'mobile_app' WHEN 4 THEN 'APP' WHEN 5 THEN NULL ELSE 'kiosk' END AS purchase_channel,
        CASE WHEN l_partkey%23=0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS purchase_date,
        '18:0'||l_linenumber AS entry_time, 'GATE_'||l_returnflag AS entry_gate,
        CASE WHEN l_linestatus='F' THEN 'SCANNED' ELSE 'REJECTED' END AS scan_status,
        CASE WHEN l_partkey%4=0 THEN l_shipdate ELSE o_orderdate + INTERVAL '1' HOUR * l_linenumber END
          AS scan_timestamp
 FROM lineitem JOIN order_sited ON l_orderkey=o_orderkey),
scan_in AS (
 SELECT * FROM scan_raw UNION ALL
 SELECT * FROM scan_raw WHERE stadium_id='STD_3' AND purchase_channel='kiosk')
"""

SCAN = (
    "ticket_id", "match_id", "stadium_id", "fan_id", "ticket_category", "ticket_price_mad",
    "purchase_channel", "purchase_date", "entry_time", "entry_gate", "scan_status",
    "scan_timestamp",
)
SCAN_LIST = ", ".join(SCAN)


def _order(*keys: str) -> str:
    """Time first, then the other columns of a scan, NULLs first."""
    rest = [c for c in SCAN if c not in keys and c != "scan_timestamp"]
    return ", ".join(f"{c} NULLS FIRST" for c in ["scan_timestamp", *rest])


BY_TICKET = f"(PARTITION BY ticket_id ORDER BY {_order('ticket_id')})"
BY_FAN = f"(PARTITION BY match_id, fan_id ORDER BY {_order('match_id', 'fan_id')})"


def _ticket_rules(source: str) -> str:
    """Ticket id normalised, repaired and judged; ``source`` is a table name."""
    return f"""
 SELECT *, regexp_matches(ticket_id_fixed, '^TICKET_[A-Z0-9]{{3,12}}$') AS ticket_id_valide FROM (
  SELECT *, CASE WHEN regexp_matches(ticket_id, '^TICKET_[A-Z0-9]+$') THEN ticket_id
                 WHEN regexp_matches(ticket_id, '^TICKET[A-Z0-9]+$') THEN 'TICKET_'||substr(ticket_id, 7)
                 WHEN regexp_matches(ticket_id, '^TK_[A-Z0-9]+$') THEN 'TICKET_'||substr(ticket_id, 4)
            END AS ticket_id_fixed
  FROM (SELECT * REPLACE (upper(trim(ticket_id)) AS ticket_id) FROM {source}))"""


def _fan_rules(source: str) -> str:
    return f"""
 SELECT *, fan_id_fixed = 'N/A' OR regexp_matches(fan_id_fixed, '^FAN_[A-Z0-9]{{3,12}}$') AS fan_id_valide
 FROM (
  SELECT *, CASE WHEN fan_id = 'N/A' THEN 'N/A'
                 WHEN regexp_matches(fan_id, '^FAN_[A-Z0-9]{{3,12}}$') THEN fan_id
                 WHEN regexp_matches(fan_id, '^FAN[A-Z0-9]{{3,12}}$') THEN 'FAN_'||substr(fan_id, 4)
            END AS fan_id_fixed
  FROM (SELECT * REPLACE (CASE WHEN fan_id IS NULL THEN 'N/A' ELSE upper(trim(fan_id)) END AS fan_id)
        FROM {source}))"""


CATEGORY_CLEAN = "CASE WHEN ticket_category IS NULL THEN 'UNKNOWN' ELSE upper(trim(ticket_category)) END"
CATEGORY_FIXED = f"""CASE
  WHEN regexp_matches({CATEGORY_CLEAN}, '^(CATEGORY[ _]*|CAT[ _]*|)1$') THEN 'CATEGORY_1'
  WHEN regexp_matches({CATEGORY_CLEAN}, '^(CATEGORY[ _]*|CAT[ _]*|)2$') THEN 'CATEGORY_2'
  WHEN regexp_matches({CATEGORY_CLEAN}, '^(CATEGORY[ _]*|CAT[ _]*|)3$') THEN 'CATEGORY_3'
  ELSE 'INVALID' END"""
CHANNEL_CLEAN = "CASE WHEN purchase_channel IS NULL THEN 'UNKNOWN' ELSE upper(trim(purchase_channel)) END"
CHANNEL_FIXED = f"""CASE
  WHEN {CHANNEL_CLEAN} IN ('WEBSITE','WEB','WEBSITE_V2','ONLINE') THEN 'WEBSITE'
  WHEN {CHANNEL_CLEAN} IN ('MOBILE_APP','APP','PHONE') THEN 'MOBILE_APP' ELSE 'INVALID' END"""
PRICE_OK = "(ticket_price_mad IS NOT NULL AND ticket_price_mad >= 0)"
COHERENT = """CASE
  WHEN ticket_category_fixed='CATEGORY_1' AND ticket_price_mad BETWEEN 250 AND 350 THEN true
  WHEN ticket_category_fixed='CATEGORY_2' AND ticket_price_mad BETWEEN 150 AND 250 THEN true
  WHEN ticket_category_fixed='CATEGORY_3' AND ticket_price_mad BETWEEN 50 AND 150 THEN true
  ELSE false END"""
SCAN_DAY = "CAST(scan_timestamp AS DATE)"
ORDER_OK = f"(purchase_date <= {SCAN_DAY})"
PERIOD_OK = "(year(scan_timestamp)=1997 AND month(scan_timestamp) BETWEEN 3 AND 9)"
PURCHASE_FIXED = f"CASE WHEN purchase_date > {SCAN_DAY} THEN {SCAN_DAY} ELSE purchase_date END"
INITCAP = (
    "array_to_string(list_transform(string_split(lower(trim({0})),' '),"
    " lambda w: upper(w[1:1])||w[2:]),' ')"
)
THREE = "('CATEGORY_1','CATEGORY_2','CATEGORY_3')"

CHAIN = f"""
scan_distinct AS (SELECT {SCAN_LIST}, count(*) AS copies FROM scan_in GROUP BY ALL),
ticket_ranked AS (
 SELECT *, CASE WHEN ticket_id IS NOT NULL THEN row_number() OVER {BY_TICKET} END AS rn
 FROM scan_distinct),
ticket_kept AS (SELECT * EXCLUDE (rn) FROM ticket_ranked WHERE rn = 1),
ticket_judged AS ({_ticket_rules('ticket_kept')}),
ticket_ok AS (SELECT * FROM ticket_judged WHERE ticket_id_valide),
fan_judged AS ({_fan_rules('ticket_ok')}),
fan_ok AS (SELECT * FROM fan_judged WHERE fan_id_valide),
fan_ranked AS (
 SELECT *, CASE WHEN fan_id <> 'N/A' THEN row_number() OVER {BY_FAN} ELSE 1 END AS rn FROM fan_ok),
accepted AS (
 SELECT * EXCLUDE (rn), {CATEGORY_FIXED} AS ticket_category_fixed,
        {CHANNEL_FIXED} AS purchase_channel_fixed, {PURCHASE_FIXED} AS purchase_date_fixed
 FROM fan_ranked WHERE rn = 1),
quality AS (
 SELECT *, ticket_category_fixed IN {THREE} AS ticket_category_valide,
        {PRICE_OK} AS ticket_price_valide, true AS purchase_channel_valide FROM accepted),
scored AS (
 SELECT *, CAST(ticket_id_valide::INT + fan_id_valide::INT + ticket_category_valide::INT
                + ticket_price_valide::INT + purchase_channel_valide::INT AS DOUBLE)
           / CAST(6 AS DOUBLE) * 100 AS quality_score,
        ticket_id_valide AND fan_id_valide AND ticket_category_valide AND ticket_price_valide
          AND purchase_channel_valide AS completement_valide
 FROM quality)
"""

DIMS = f"""
stadium_clean AS (
 SELECT stadium_id, {INITCAP.format('stadium_name')} AS stadium_name, upper(trim(city_code)) AS city_code,
        trim(full_address) AS full_address, seating_capacity, upper(trim(pitch_type)) AS pitch_type,
        regexp_replace(contact_phone, '\\s+', '', 'g') AS contact_phone, lower(trim(email)) AS email
 FROM stadium_raw),
team_clean AS (
 SELECT upper(trim(team_code)) AS team_code, {INITCAP.format('team_name')} AS team_name,
        upper(trim(team_group)) AS team_group, upper(trim(federation)) AS federation,
        trim(coach_name) AS coach_name
 FROM team_raw),
city_clean AS (
 SELECT upper(trim(city_code)) AS city_code, {INITCAP.format('city_name')} AS city_name,
        trim(region) AS region, upper(trim(airport_code)) AS airport_code, trim(climate_type) AS climate_type
 FROM city_raw),
match_clean AS (
 SELECT match_id, match_date, regexp_extract(match_time, '(\\d{{2}}:\\d{{2}}:\\d{{2}})', 1) AS match_time,
        CAST(CAST(match_date AS VARCHAR)||' '||regexp_extract(match_time, '(\\d{{2}}:\\d{{2}}:\\d{{2}})', 1)
             AS TIMESTAMP) AS match_datetime,
        trim(stage) AS stage, upper(trim(group_code)) AS group_code, upper(trim(stadium_id)) AS stadium_id,
        upper(trim(home_team_code)) AS home_team_code, upper(trim(away_team_code)) AS away_team_code,
        trim(weather_notes) AS weather_notes
 FROM match_raw),
d_stadium AS (
 SELECT s.stadium_id AS stadium_key, s.stadium_name, s.city_code, c.city_name, c.region, s.full_address,
        s.seating_capacity, s.pitch_type
 FROM stadium_clean s LEFT JOIN city_clean c ON s.city_code=c.city_code),
d_match AS (
 SELECT m.match_id AS match_key, m.match_date, m.match_time, m.match_datetime, m.stage,
        m.group_code AS match_group, s.stadium_id, s.stadium_name, h.team_name AS home_team_name,
        a.team_name AS away_team_name, m.weather_notes
 FROM match_clean m LEFT JOIN stadium_clean s ON m.stadium_id=s.stadium_id
 LEFT JOIN team_clean h ON m.home_team_code=h.team_code
 LEFT JOIN team_clean a ON m.away_team_code=a.team_code)
"""

FILLED = f"""
match_filled AS (
 SELECT t.* REPLACE (coalesce(t.match_id, m.match_id) AS match_id), t.match_id IS NULL AS match_was_null
 FROM accepted t LEFT JOIN
  (SELECT stadium_id, match_date, min(match_id) AS match_id FROM match_clean GROUP BY ALL) m
   ON t.stadium_id=m.stadium_id AND CAST(t.scan_timestamp AS DATE)=m.match_date),
both_filled AS (
 SELECT t.* REPLACE (coalesce(t.stadium_id, m.stadium_id) AS stadium_id),
        t.stadium_id IS NULL AS stadium_was_null
 FROM match_filled t LEFT JOIN match_clean m ON t.match_id=m.match_id),
silver AS (
 SELECT ticket_id AS ticket_id_original, fan_id AS fan_id_original, ticket_id_fixed AS ticket_id,
        fan_id_fixed AS fan_id, ticket_id_valide AS is_ticket_id_valid, fan_id_valide AS is_fan_id_valid,
        match_id, stadium_id, ticket_category_fixed AS ticket_category, ticket_price_mad,
        purchase_channel_fixed AS purchase_channel, purchase_date_fixed AS purchase_date,
        entry_time, entry_gate, scan_status, scan_timestamp
 FROM both_filled)
"""

GOLD = """
d_fan AS (
 SELECT row_number() OVER (ORDER BY fan_id) AS fan_key, fan_id, 'Regular' AS fan_category,
        'Identified' AS fan_type
 FROM (SELECT DISTINCT fan_id FROM silver WHERE fan_id <> 'N/A' AND is_fan_id_valid)
 UNION ALL SELECT 0, 'N/A', 'Unidentified', 'Undentified'),
f_rows AS (
 SELECT coalesce(t.match_id, 'UNKNOWN') AS match_key, coalesce(t.stadium_id, 'UNKNOWN') AS stadium_key,
        coalesce(f.fan_key, 0) AS fan_key,
        CAST(strftime(t.scan_timestamp, '%Y%m%d') AS INT) AS date_key,
        coalesce(m.home_team_code, 'UNKNOWN') AS home_team_key,
        coalesce(m.away_team_code, 'UNKNOWN') AS away_team_key,
        t.ticket_id, t.ticket_category, t.ticket_price_mad, t.purchase_channel, t.scan_status,
        t.scan_timestamp, t.entry_gate, strftime(t.scan_timestamp, '%Y-%m-%d') AS scan_day
 FROM silver t LEFT JOIN match_clean m ON t.match_id=m.match_id LEFT JOIN d_fan f ON t.fan_id=f.fan_id),
fact AS (
 SELECT row_number() OVER (ORDER BY ticket_id NULLS FIRST, scan_timestamp NULLS FIRST,
   fan_key NULLS FIRST, match_key NULLS FIRST, stadium_key NULLS FIRST, date_key NULLS FIRST,
   home_team_key NULLS FIRST, away_team_key NULLS FIRST, ticket_category NULLS FIRST,
   ticket_price_mad NULLS FIRST, purchase_channel NULLS FIRST, scan_status NULLS FIRST,
   entry_gate NULLS FIRST, scan_day NULLS FIRST) AS ticket_scan_key, * FROM f_rows),
fact_seats AS (
 SELECT f.*, s.seating_capacity, s.stadium_name FROM f_rows f
 LEFT JOIN d_stadium s ON f.stadium_key=s.stadium_key)
"""

SCANNED = "count(*) FILTER (WHERE upper(scan_status)='SCANNED')"
RATE = f"""{SCANNED} AS tickets, max(seating_capacity) AS capacity,
 CASE WHEN coalesce(max(seating_capacity), 0)=0 THEN 0.0
      ELSE CAST({SCANNED} AS DOUBLE)/max(seating_capacity) END AS fill_rate"""


def _sql(body: str, *parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in (RAW, *parts)) + "\n" + body.strip()


def _pct(part: str, total: str) -> str:
    return f"CASE WHEN {total}=0 THEN 0.0 ELSE {part}*CAST(100 AS DOUBLE)/{total} END"


REASON_OF = """CASE audit_table WHEN 'complets_doublons' THEN 'ligne double'
 WHEN 'ticket_id_null' THEN 'ticket_id nulle' WHEN 'ticket_id_doublons' THEN 'ticket_id dupliqué'
 WHEN 'ticket_id_invalide' THEN 'ticket_id invalide'
 WHEN 'ticket_id_irreparable' THEN 'ticket_id irréparable'
 WHEN 'fan_id_invalide' THEN 'fan_id invalide' WHEN 'fan_id_irreparable' THEN 'fan_id irréparable'
 WHEN 'fan_id_doublons' THEN 'fan_id dupliqué dans le même match' END AS audit_reason"""
TICKET_TABLE = """CASE WHEN NOT ticket_id_valide THEN 'ticket_id_invalide'
 WHEN ticket_id_valide IS NULL THEN 'ticket_id_irreparable' END AS audit_table"""
FAN_TABLE = """CASE WHEN NOT fan_id_valide THEN 'fan_id_invalide'
 WHEN fan_id_valide IS NULL THEN 'fan_id_irreparable' END AS audit_table"""

KNOWN = f"""
known AS (SELECT * FROM scan_raw WHERE ticket_id IS NOT NULL),
known_judged AS ({_ticket_rules('known')}),
raw_fans AS ({_fan_rules('scan_raw')})
"""

NO_TICKET = "NULL::VARCHAR AS ticket_id_fixed, NULL::BOOLEAN AS ticket_id_valide"
NO_FAN = "NULL::VARCHAR AS fan_id_fixed, NULL::BOOLEAN AS fan_id_valide"
NO_NUM = "NULL::BIGINT AS row_num, NULL::BIGINT AS \"count\""
WITH_IDS = f"{SCAN_LIST}, ticket_id_fixed, ticket_id_valide"
AUDIT = f"""
ticket_rejected AS (SELECT *, {TICKET_TABLE} FROM ticket_judged WHERE ticket_id_valide IS NOT TRUE),
fan_rejected AS (SELECT *, {FAN_TABLE} FROM fan_judged WHERE fan_id_valide IS NOT TRUE),
audited AS (
 SELECT {SCAN_LIST}, {NO_TICKET}, {NO_FAN}, NULL::BIGINT AS row_num, copies AS "count",
        'complets_doublons' AS audit_table FROM scan_distinct WHERE copies > 1
 UNION ALL
 SELECT {SCAN_LIST}, {NO_TICKET}, {NO_FAN}, {NO_NUM}, 'ticket_id_null' FROM scan_distinct
 WHERE ticket_id IS NULL
 UNION ALL
 SELECT {SCAN_LIST}, {NO_TICKET}, {NO_FAN}, rn, NULL::BIGINT, 'ticket_id_doublons'
 FROM ticket_ranked WHERE rn > 1
 UNION ALL
 SELECT {WITH_IDS}, {NO_FAN}, {NO_NUM}, audit_table FROM ticket_rejected
 UNION ALL
 SELECT {WITH_IDS}, fan_id_fixed, fan_id_valide, {NO_NUM}, audit_table FROM fan_rejected
 UNION ALL
 SELECT {WITH_IDS}, fan_id_fixed, fan_id_valide, {NO_NUM}, 'fan_id_doublons' FROM fan_ranked WHERE rn > 1)
"""


TIME = """SELECT CAST(strftime(event_date, '%Y%m%d') AS INT) AS date_key, event_date,
 CAST(year(event_date) AS INT) AS year, CAST(month(event_date) AS INT) AS month,
 strftime(event_date, '%B') AS month_name, CAST(day(event_date) AS INT) AS day,
 CASE WHEN dayofweek(event_date) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type
 FROM (SELECT CAST(scan_timestamp AS DATE) AS event_date FROM silver
       UNION SELECT CAST(match_datetime AS DATE) FROM match_clean)
 WHERE event_date IS NOT NULL"""


def _orphan(key: str, dim: str, dim_key: str) -> str:
    return f"""SELECT '{key}' AS foreign_key, count(*) AS orphan_rows, count(DISTINCT {key}) AS orphan_keys
 FROM f_rows WHERE {key} NOT IN (SELECT {dim_key} FROM {dim})"""


def _by_role(name: str, join: str) -> str:
    """Attendance by an attribute of a dimension; ``join`` ties it to the fact as ``f``."""
    return _sql(
        f"SELECT {name}, {RATE} FROM fact_seats f LEFT JOIN {join} GROUP BY 1",
        CHAIN, DIMS, FILLED, GOLD,
        f"d_time AS ({TIME})",
    )


ORACLES: dict[str, str] = {
    "ticket_normalize_repair": _sql(
        "SELECT * FROM ticket_out",
        "ids AS (SELECT ticket_id, ticket_id AS ticket_id_raw FROM scan_raw)",
        f"ticket_out AS ({_ticket_rules('ids')})",
    ),
    "fan_normalize_repair": _sql(
        "SELECT * FROM fan_out",
        "ids AS (SELECT fan_id, fan_id AS fan_id_raw FROM scan_raw)",
        f"fan_out AS ({_fan_rules('ids')})",
    ),
    "category_repair": _sql(
        f"""SELECT ticket_category, {CATEGORY_CLEAN} AS ticket_category_clean,
        {CATEGORY_FIXED} AS ticket_category_fixed, {CATEGORY_FIXED} IN {THREE} AS ticket_category_valide
        FROM scan_raw"""
    ),
    "price_validation": _sql(
        f"""SELECT ticket_category_fixed, ticket_price_mad, {PRICE_OK} AS ticket_price_valide,
        {COHERENT} AS prix_categorie_coherent
        FROM (SELECT *, {CATEGORY_FIXED} AS ticket_category_fixed FROM scan_raw)"""
    ),
    "channel_repair": _sql(
        f"""SELECT purchase_channel, {CHANNEL_CLEAN} AS purchase_channel_clean,
        {CHANNEL_FIXED} AS purchase_channel_fixed,
        {CHANNEL_FIXED} IN ('WEBSITE','MOBILE_APP','INVALID') AS purchase_channel_valide FROM scan_raw"""
    ),
    "date_validation": _sql(
        f"""SELECT purchase_date, scan_timestamp, purchase_date AS purchase_date_ts,
        {SCAN_DAY} AS scan_date_ts, {ORDER_OK} AS date_order_valide, {PERIOD_OK} AS scan_date_valide,
        {PURCHASE_FIXED} AS purchase_date_fixed FROM scan_raw"""
    ),
    "null_ticket_audit": _sql(
        f"""SELECT *, {REASON_OF} FROM
        (SELECT *, 'ticket_id_null' AS audit_table FROM scan_raw WHERE ticket_id IS NULL)"""
    ),
    "ticket_quarantine": _sql(
        f"""SELECT *, {REASON_OF} FROM
        (SELECT *, {TICKET_TABLE} FROM known_judged WHERE ticket_id_valide IS NOT TRUE)""",
        KNOWN,
    ),
    "ticket_accepted": _sql("SELECT * FROM known_judged WHERE ticket_id_valide", KNOWN),
    "fan_quarantine": _sql(
        f"""SELECT *, {REASON_OF} FROM
        (SELECT *, {FAN_TABLE} FROM raw_fans WHERE fan_id_valide IS NOT TRUE)""",
        KNOWN,
    ),
    "fan_accepted": _sql("SELECT * FROM raw_fans WHERE fan_id_valide", KNOWN),
    "full_duplicate_audit": _sql(
        f"""SELECT *, {REASON_OF} FROM (SELECT {SCAN_LIST}, count(*) AS "count",
        'complets_doublons' AS audit_table FROM scan_in GROUP BY {SCAN_LIST} HAVING count(*) > 1)"""
    ),
    "full_dedup": _sql("SELECT DISTINCT * FROM scan_in"),
    "ticket_keep_first": _sql(
        f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER {BY_TICKET} AS rn FROM scan_raw
        WHERE ticket_id IS NOT NULL) WHERE rn = 1"""
    ),
    "ticket_duplicate_audit": _sql(
        f"""SELECT *, {REASON_OF} FROM (
        SELECT *, row_number() OVER {BY_TICKET} AS row_num,
        'ticket_id_doublons' AS audit_table FROM scan_raw WHERE ticket_id IS NOT NULL)
        WHERE row_num > 1"""
    ),
    "fan_match_keep_first": _sql(
        f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, CASE WHEN fan_id <> 'N/A' THEN row_number() OVER {BY_FAN} ELSE 1 END AS rn
        FROM raw_fans WHERE fan_id_valide) WHERE rn = 1""",
        KNOWN,
    ),
    "fan_match_duplicates": _sql(
        f"""SELECT * EXCLUDE (rn), {REASON_OF} FROM (
        SELECT *, row_number() OVER {BY_FAN} AS rn, 'fan_id_doublons' AS audit_table
        FROM raw_fans WHERE fan_id_valide AND fan_id <> 'N/A') WHERE rn > 1""",
        KNOWN,
    ),
    "classified_scans": _sql(
        """SELECT audit_table, count(*) AS n_rows, CAST(sum(copies) AS BIGINT) AS n_input_rows FROM (
        SELECT 'ticket_id_null' AS audit_table, copies FROM scan_distinct WHERE ticket_id IS NULL
        UNION ALL SELECT 'ticket_id_doublons', copies FROM ticket_ranked WHERE rn > 1
        UNION ALL SELECT audit_table, copies FROM ticket_rejected
        UNION ALL SELECT audit_table, copies FROM fan_rejected
        UNION ALL SELECT 'fan_id_doublons', copies FROM fan_ranked WHERE rn > 1
        UNION ALL SELECT 'accepted', copies FROM accepted) GROUP BY audit_table""",
        CHAIN,
        AUDIT,
    ),
    "audit_rows": _sql(f"SELECT *, {REASON_OF} FROM audited", CHAIN, AUDIT),
    "category_frequency": _sql(
        f"""SELECT {CATEGORY_FIXED} AS ticket_category_fixed,
        {CATEGORY_FIXED} IN {THREE} AS ticket_category_valide, count(*) AS n_rows
        FROM scan_raw GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2"""
    ),
    "channel_frequency": _sql(
        f"""SELECT {CHANNEL_FIXED} AS purchase_channel_fixed, true AS purchase_channel_valide,
        count(*) AS n_rows FROM scan_raw GROUP BY 1, 2 ORDER BY 3 DESC, 1"""
    ),
    "channel_raw_frequency": _sql(
        """SELECT purchase_channel, count(*) AS n_rows FROM scan_raw
        GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST"""
    ),
    "price_profile": _sql(
        """SELECT min(ticket_price_mad) AS min_value, max(ticket_price_mad) AS max_value,
        avg(ticket_price_mad) AS mean_value, count(*) FILTER (WHERE ticket_price_mad < 0) AS n_negative,
        count(*) FILTER (WHERE ticket_price_mad IS NULL) AS n_null FROM scan_raw"""
    ),
    "price_stats": _sql(
        f"""SELECT count(*) FILTER (WHERE p) AS prices_valid, count(*) FILTER (WHERE NOT p) AS prices_invalid,
        count(*) FILTER (WHERE c) AS prices_coherent, count(*) FILTER (WHERE NOT c AND p) AS prices_incoherent
        FROM (SELECT {PRICE_OK} AS p, {COHERENT} AS c FROM
        (SELECT *, {CATEGORY_FIXED} AS ticket_category_fixed FROM scan_raw))"""
    ),
    "date_stats": _sql(
        f"""SELECT count(*) FILTER (WHERE {ORDER_OK}) AS order_valid,
        count(*) FILTER (WHERE NOT {ORDER_OK}) AS order_invalid,
        count(*) FILTER (WHERE {PERIOD_OK}) AS period_valid,
        count(*) FILTER (WHERE NOT {PERIOD_OK}) AS period_invalid FROM scan_raw"""
    ),
    "invalid_category_sample": _sql(
        f"""SELECT ticket_id, ticket_category, {CATEGORY_FIXED} AS ticket_category_fixed FROM scan_raw
        WHERE {CATEGORY_FIXED} = 'INVALID'
        ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 10"""
    ),
    "sample_ordered": """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        ORDER BY 1, 2, 3 LIMIT 5""",
    "quality_score": _sql(
        """SELECT ticket_id, ticket_id_valide, fan_id_valide, ticket_category_valide,
        ticket_price_valide, purchase_channel_valide, quality_score, completement_valide FROM scored""",
        CHAIN,
    ),
    "quality_summary": _sql(
        f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE completement_valide) AS n_fully_valid,
        avg(quality_score) AS avg_score, min(quality_score) AS min_score, max(quality_score) AS max_score,
        {_pct("count(*) FILTER (WHERE completement_valide)", "count(*)")} AS pct_fully_valid
        FROM scored""",
        CHAIN,
    ),
    "observed_metrics": _sql(
        """SELECT (SELECT count(*) FROM scan_in) AS rows_in,
        (SELECT count(*) FROM scan_distinct) AS rows_distinct,
        (SELECT count(*) FROM scan_distinct WHERE ticket_id IS NULL) AS rows_ticket_id_null,
        (SELECT count(*) FROM ticket_ranked WHERE rn > 1) AS rows_ticket_id_doublons,
        (SELECT count(*) FROM fan_ranked WHERE rn > 1) AS rows_fan_id_doublons,
        (SELECT count(*) FROM accepted) AS rows_accepted""",
        CHAIN,
    ),
    "clean_stadiums": _sql("SELECT * FROM stadium_clean", DIMS),
    "clean_teams": _sql("SELECT * FROM team_clean", DIMS),
    "clean_cities": _sql("SELECT * FROM city_clean", DIMS),
    "clean_matches": _sql("SELECT * FROM match_clean", DIMS),
    "cleaned_scans": _sql(
        """SELECT ticket_id, match_id, stadium_id, fan_id, ticket_category_fixed, ticket_price_mad,
        purchase_channel_fixed, purchase_date_fixed, entry_time, entry_gate, scan_status, scan_timestamp,
        ticket_id_fixed, ticket_id_valide, fan_id_fixed, fan_id_valide FROM accepted""",
        CHAIN,
    ),
    "match_enrichment": _sql(
        "SELECT ticket_id, fan_id, match_id, stadium_id, scan_timestamp FROM match_filled",
        CHAIN, DIMS, FILLED,
    ),
    "match_enrichment_delta": _sql(
        """SELECT count(*) FILTER (WHERE match_was_null) AS null_before,
        count(*) FILTER (WHERE match_id IS NULL) AS null_after,
        count(*) FILTER (WHERE match_was_null) - count(*) FILTER (WHERE match_id IS NULL) AS n_filled
        FROM match_filled""",
        CHAIN, DIMS, FILLED,
    ),
    "stadium_enrichment": _sql(
        "SELECT ticket_id, fan_id, match_id, stadium_id, scan_timestamp FROM both_filled",
        CHAIN, DIMS, FILLED,
    ),
    "stadium_enrichment_delta": _sql(
        """SELECT count(*) FILTER (WHERE stadium_was_null) AS null_before,
        count(*) FILTER (WHERE stadium_id IS NULL) AS null_after,
        count(*) FILTER (WHERE stadium_was_null) - count(*) FILTER (WHERE stadium_id IS NULL) AS n_filled
        FROM both_filled""",
        CHAIN, DIMS, FILLED,
    ),
    "silver_scans": _sql("SELECT * FROM silver", CHAIN, DIMS, FILLED),
    "silver_conformity": _sql(
        f"""SELECT *, {_pct('categories_ok', 'n_rows')} AS pct_categories_ok,
        {_pct('prices_ok', 'n_rows')} AS pct_prices_ok, {_pct('channels_ok', 'n_rows')} AS pct_channels_ok
        FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE ticket_category IN {THREE}) AS categories_ok,
        count(*) FILTER (WHERE ticket_price_mad >= 0) AS prices_ok,
        count(*) FILTER (WHERE purchase_channel IN ('WEBSITE','MOBILE_APP')) AS channels_ok,
        count(*) FILTER (WHERE match_id IS NULL) AS match_id_null,
        count(*) FILTER (WHERE stadium_id IS NULL) AS stadium_id_null FROM silver)""",
        CHAIN, DIMS, FILLED,
    ),
    "dim_stadium": _sql("SELECT * FROM d_stadium", DIMS),
    "dim_team": _sql("SELECT team_code AS team_key, * EXCLUDE (team_code) FROM team_clean", DIMS),
    "dim_match": _sql("SELECT * FROM d_match", DIMS),
    "dim_time": _sql(TIME, CHAIN, DIMS, FILLED),
    "dim_fan": _sql("SELECT * FROM d_fan", CHAIN, DIMS, FILLED, GOLD),
    "fact_ticket_scan": _sql("SELECT * FROM fact", CHAIN, DIMS, FILLED, GOLD),
    "fact_key_uniqueness": _sql(
        """SELECT count(*) AS n_rows, count(DISTINCT ticket_scan_key) AS n_keys,
        count(*) FILTER (WHERE ticket_scan_key IS NULL) AS n_null,
        count(*) = count(DISTINCT ticket_scan_key) AS is_unique FROM fact""",
        CHAIN, DIMS, FILLED, GOLD,
    ),
    "fact_orphans": _sql(
        " UNION ALL ".join(
            [
                _orphan("stadium_key", "d_stadium", "stadium_key"),
                _orphan("match_key", "match_clean", "match_id"),
                _orphan("date_key", "d_time", "date_key"),
                _orphan("fan_key", "d_fan", "fan_key"),
                _orphan("home_team_key", "team_clean", "team_code"),
                _orphan("away_team_key", "team_clean", "team_code"),
            ]
        ),
        CHAIN, DIMS, FILLED, GOLD,
        f"d_time AS ({TIME})",
    ),
    "lookup_duplicates": _sql(
        """SELECT stadium_id, match_date, count(*) AS n_rows FROM match_clean
        WHERE stadium_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
        DIMS,
    ),
    "dense_key_scaled": """SELECT o_orderpriority, o_orderkey,
        row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS order_number FROM orders""",
    "tickets_total": _sql(f"SELECT {SCANNED} AS tickets FROM f_rows", CHAIN, DIMS, FILLED, GOLD),
    "tickets_by_stadium": _sql(
        f"SELECT stadium_key, stadium_name, {RATE} FROM fact_seats GROUP BY 1, 2",
        CHAIN, DIMS, FILLED, GOLD,
    ),
    "tickets_by_channel": _sql(
        f"""SELECT *, {_pct('tickets', 'sum(tickets) OVER ()')} AS pct_of_tickets FROM
        (SELECT purchase_channel, {RATE} FROM fact_seats GROUP BY 1)""",
        CHAIN, DIMS, FILLED, GOLD,
    ),
    "fill_rate_by_match": _sql(
        f"SELECT match_key, {RATE} FROM fact_seats GROUP BY 1", CHAIN, DIMS, FILLED, GOLD
    ),
    "fill_rate_by_stage": _sql(
        f"""SELECT stage, {RATE} FROM fact_seats f LEFT JOIN d_match m ON f.match_key=m.match_key
        WHERE purchase_channel <> 'INVALID' GROUP BY 1""",
        CHAIN, DIMS, FILLED, GOLD,
    ),
    "attendance_by_day_type": _by_role("day_type", "d_time d ON f.date_key=d.date_key"),
    "attendance_by_fan_type": _by_role("fan_type", "d_fan d ON f.fan_key=d.fan_key"),
    "attendance_by_home_team": _by_role(
        "home_team", "(SELECT team_code, team_name AS home_team FROM team_clean) d ON f.home_team_key=d.team_code"
    ),
    "attendance_by_away_team": _by_role(
        "away_team", "(SELECT team_code, team_name AS away_team FROM team_clean) d ON f.away_team_key=d.team_code"
    ),
    "attended_stadiums": _sql(
        """SELECT stadium_key, seating_capacity FROM d_stadium WHERE stadium_key IN
        (SELECT stadium_key FROM f_rows WHERE upper(scan_status)='SCANNED')""",
        CHAIN, DIMS, FILLED, GOLD,
    ),
    "fill_rate_gauge": _sql(
        """SELECT *, CASE WHEN coalesce(total_capacity, 0)=0 THEN 0.0
        ELSE least(1.0, tickets_sold/total_capacity) END AS gauge FROM
        (SELECT (SELECT count(DISTINCT ticket_id) FROM f_rows) AS tickets_sold,
                (SELECT CAST(sum(seating_capacity) AS DOUBLE)*(36.0/9.0) FROM d_stadium) AS total_capacity)""",
        CHAIN, DIMS, FILLED, GOLD,
    ),
    "fill_gauge_by_stadium": _sql(
        """SELECT stadium_key, tickets_sold, total_capacity, CASE WHEN coalesce(total_capacity, 0)=0 THEN 0.0
        ELSE least(1.0, tickets_sold/total_capacity) END AS gauge FROM
        (SELECT stadium_key, count(DISTINCT ticket_id) AS tickets_sold FROM f_rows GROUP BY 1)
        LEFT JOIN (SELECT stadium_key, CAST(sum(seating_capacity) AS DOUBLE)*(36.0/9.0) AS total_capacity
                   FROM d_stadium GROUP BY 1) USING (stadium_key)""",
        CHAIN, DIMS, FILLED, GOLD,
    ),
    "config_ingest_csv": _sql("SELECT * FROM scan_raw"),
    "partitioned_roundtrip": _sql(
        "SELECT * EXCLUDE (fan_key) FROM f_rows", CHAIN, DIMS, FILLED, GOLD
    ),
    "append_audit_roundtrip": _sql(
        f"""SELECT {SCAN_LIST}, ticket_id_fixed, {TICKET_TABLE}, NULL::VARCHAR AS fan_id_fixed
        FROM known_judged WHERE ticket_id_valide IS NOT TRUE
        UNION ALL SELECT {SCAN_LIST}, ticket_id_fixed, {FAN_TABLE}, fan_id_fixed FROM good_fans
        WHERE fan_id_valide IS NOT TRUE""",
        KNOWN,
        "good AS (SELECT * FROM known_judged WHERE ticket_id_valide)",
        f"good_fans AS ({_fan_rules('good')})",
    ),
    "registered_star_counts": _sql(
        """SELECT 'dim_stadium' AS table_name, count(*) AS n_rows FROM d_stadium
        UNION ALL SELECT 'dim_team', count(*) FROM team_clean
        UNION ALL SELECT 'dim_match', count(*) FROM d_match
        UNION ALL SELECT 'dim_fan', count(*) FROM d_fan
        UNION ALL SELECT 'fact_ticket_scan', count(*) FROM f_rows
        UNION ALL SELECT 'dim_time', count(*) FROM
         (SELECT CAST(scan_timestamp AS DATE) AS d FROM silver WHERE scan_timestamp IS NOT NULL
          UNION SELECT CAST(match_datetime AS DATE) FROM match_clean)""",
        CHAIN, DIMS, FILLED, GOLD,
    ),
}

# ---- runs that add to earlier ones, matches by time, several groupings at once --------
EARLY = "scan_timestamp < TIMESTAMP '1995-06-01'"
LASTING = f"""
early_fans AS (SELECT DISTINCT fan_id FROM silver WHERE fan_id <> 'N/A' AND is_fan_id_valid AND {EARLY}),
lasting_fans AS (
 SELECT fan_id, CASE WHEN fan_key=0 THEN 0 ELSE row_number() OVER (ORDER BY fan_key=0, late, fan_id) END AS fan_key,
        CASE WHEN fan_key=0 THEN NULL WHEN late THEN 'second' ELSE 'first' END AS run_id
 FROM (SELECT *, fan_id NOT IN (SELECT fan_id FROM early_fans) AS late FROM d_fan))
"""
ORACLES["lasting_fan_keys"] = _sql("SELECT * FROM lasting_fans", CHAIN, DIMS, FILLED, GOLD, LASTING)
ORACLES["lasting_scan_keys"] = _sql(
    f"""SELECT row_number() OVER (ORDER BY NOT coalesce({EARLY}, false), ticket_id NULLS FIRST,
    scan_timestamp NULLS FIRST, l.fan_key, match_key, stadium_key, date_key, home_team_key, away_team_key,
    ticket_category NULLS FIRST, ticket_price_mad NULLS FIRST, purchase_channel, scan_status, entry_gate)
    AS ticket_scan_key, ticket_id, scan_timestamp, l.fan_key
    FROM f_rows f JOIN d_fan d ON f.fan_key=d.fan_key JOIN lasting_fans l ON d.fan_id=l.fan_id""",
    CHAIN, DIMS, FILLED, GOLD, LASTING,
)
ORACLES["nearest_match_enrichment"] = _sql(
    """SELECT ticket_id, fan_id, coalesce(match_id, CASE WHEN later IS NULL OR since <= ahead THEN earlier
        ELSE later END) AS match_id, stadium_id, scan_timestamp
    FROM (SELECT t.*, b.match_id AS earlier, n.match_id AS later,
            epoch_us(t.scan_timestamp) - epoch_us(b.match_datetime) AS since,
            epoch_us(n.match_datetime) - epoch_us(t.scan_timestamp) AS ahead
        FROM (SELECT *, CAST(scan_timestamp AS DATE) AS scan_day FROM accepted) t
        ASOF LEFT JOIN kick_offs b ON t.stadium_id=b.stadium_id AND t.scan_day=b.match_date
            AND t.scan_timestamp >= b.match_datetime
        ASOF LEFT JOIN kick_offs n ON t.stadium_id=n.stadium_id AND t.scan_day=n.match_date
            AND t.scan_timestamp <= n.match_datetime)""",
    CHAIN, DIMS,
    """kick_offs AS (SELECT stadium_id, match_date, match_datetime, min(match_id) AS match_id
        FROM match_clean GROUP BY ALL)""",
)
ORACLES["nearest_match_salted"] = ORACLES["nearest_match_enrichment"]
ORACLES["fill_rate_slices"] = _sql(
    f"""SELECT stadium_key, purchase_channel, stage,
    CAST(GROUPING_ID(stadium_key, purchase_channel, stage) AS BIGINT) AS slice, {RATE}
    FROM (SELECT f.*, m.stage FROM fact_seats f LEFT JOIN d_match m ON f.match_key=m.match_key)
    GROUP BY GROUPING SETS ((stadium_key), (purchase_channel), (stage), (purchase_channel, stage), ())""",
    CHAIN, DIMS, FILLED, GOLD,
)
ORACLES["repeated_append_audit"] = _sql(
    f"""SELECT {SCAN_LIST}, ticket_id_fixed, {TICKET_TABLE}, NULL::VARCHAR AS fan_id_fixed, 'tickets' AS run_id
    FROM known_judged WHERE ticket_id_valide IS NOT TRUE
    UNION ALL SELECT {SCAN_LIST}, ticket_id_fixed, {FAN_TABLE}, fan_id_fixed, 'fans' FROM good_fans
    WHERE fan_id_valide IS NOT TRUE""",
    KNOWN,
    "good AS (SELECT * FROM known_judged WHERE ticket_id_valide)",
    f"good_fans AS ({_fan_rules('good')})",
)

ORACLES["rescued_cells"] = _sql(
    """SELECT ticket_id, fan_id, entry_gate,
    CASE WHEN ticket_price_mad % 56 <> 0 THEN ticket_price_mad END AS ticket_price_mad,
    CASE WHEN entry_time <> '18:07' THEN purchase_date END AS purchase_date,
    'ticket_price_mad' AS "column", ticket_price_mad || ' MAD' AS value, 'does not convert' AS reason
    FROM scan_raw WHERE ticket_price_mad % 56 = 0
    UNION ALL SELECT ticket_id, fan_id, entry_gate,
    CASE WHEN ticket_price_mad % 56 <> 0 THEN ticket_price_mad END, NULL, 'purchase_date', 'soon', 'does not convert'
    FROM scan_raw WHERE entry_time = '18:07'"""
)

ORACLES["distinct_tickets_rollup"] = _sql(
    """SELECT stadium_key, scan_day, CAST(GROUPING_ID(stadium_key, scan_day) AS BIGINT) AS level,
    count(DISTINCT ticket_id) AS tickets_sold FROM f_rows
    GROUP BY GROUPING SETS ((stadium_key, scan_day), (stadium_key), ())""",
    CHAIN, DIMS, FILLED, GOLD,
)
ORACLES["merged_files_roundtrip"] = ORACLES["config_ingest_csv"]
ORACLES["audit_if_any"] = _sql(
    f"SELECT {SCAN_LIST}, ticket_id_fixed FROM known_judged WHERE ticket_id_valide IS NOT TRUE", KNOWN
)
ORACLES["channel_samples"] = _sql(
    """SELECT purchase_channel, ticket_id, match_id, ticket_price_mad FROM scan_raw
    QUALIFY row_number() OVER (PARTITION BY purchase_channel ORDER BY
        md5(concat_ws('|', 's1', ticket_id, match_id, ticket_price_mad)), ticket_id NULLS FIRST,
        match_id NULLS FIRST, ticket_price_mad NULLS FIRST) <= 3"""
)
ORACLES["incremental_landing"] = _sql(
    """SELECT ticket_id, match_id, entry_gate, ticket_price_mad,
    CASE WHEN entry_gate = 'GATE_N' THEN 'first' ELSE 'second' END AS run_id FROM scan_raw"""
)

# Other physical paths to the same rows.
ORACLES["ticket_duplicate_audit_split"] = ORACLES["ticket_duplicate_audit"]
ORACLES["match_enrichment_salted"] = ORACLES["match_enrichment"]
ORACLES["content_checked_roundtrip"] = ORACLES["partitioned_roundtrip"]
