"""Table contracts and conforming frames to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """A frame does not have the columns and types its contract names."""


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def contract(columns: str) -> T.StructType:
    """Contract from "name type, name type"; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# ---- bronze -----------------------------------------------------------------------
TICKET_SCANS = contract(
    "ticket_id string, match_id string, stadium_id string, fan_id string, ticket_category string, "
    "ticket_price_mad int, purchase_channel string, purchase_date date, entry_time string, "
    "entry_gate string, scan_status string, scan_timestamp timestamp"
)
STADIUMS = contract(
    "stadium_id string, stadium_name string, city_code string, full_address string, "
    "seating_capacity int, pitch_type string, contact_phone string, email string"
)
TEAMS = contract(
    "team_code string, team_name string, group string, federation string, coach_name string"
)
CITIES = contract(
    "city_code string, city_name string, region string, airport_code string, climate_type string"
)
MATCHES = contract(
    "match_id string, match_date date, match_time string, stage string, group_code string, "
    "stadium_id string, home_team_code string, away_team_code string, weather_notes string"
)
CONFIG_SQL = contract(
    "database_name string, datasource string, schema_name string, table_name string, "
    "target_path string"
)
CONFIG_CSV = contract("folder_name string, file_name string")

# ---- silver -----------------------------------------------------------------------
TICKETS_CLEANED = contract(
    "ticket_id string, match_id string, stadium_id string, fan_id string, "
    "ticket_category_fixed string, ticket_price_mad int, purchase_channel_fixed string, "
    "purchase_date_fixed date, entry_time string, entry_gate string, scan_status string, "
    "scan_timestamp timestamp, ticket_id_fixed string, ticket_id_valide boolean, "
    "fan_id_fixed string, fan_id_valide boolean"
)
TICKET_SCANS_CLEAN = contract(
    "ticket_id_original string, fan_id_original string, ticket_id string, fan_id string, "
    "is_ticket_id_valid boolean, is_fan_id_valid boolean, match_id string, stadium_id string, "
    "ticket_category string, ticket_price_mad int, purchase_channel string, purchase_date date, "
    "entry_time string, entry_gate string, scan_status string, scan_timestamp timestamp"
)
MATCHES_CLEAN = contract(
    "match_id string, match_date date, match_time string, match_datetime timestamp, stage string, "
    "group_code string, stadium_id string, home_team_code string, away_team_code string, "
    "weather_notes string"
)
AUDIT = contract(
    "ticket_id string, match_id string, stadium_id string, fan_id string, ticket_category string, "
    "ticket_price_mad int, purchase_channel string, purchase_date date, entry_time string, "
    "entry_gate string, scan_status string, scan_timestamp timestamp, ticket_id_fixed string, "
    "ticket_id_valide boolean, fan_id_fixed string, fan_id_valide boolean, row_num bigint, "
    "count bigint, audit_table string, audit_reason string, audit_date timestamp"
)

# ---- gold -------------------------------------------------------------------------
DIM_STADIUM = contract(
    "stadium_key string, stadium_name string, city_code string, city_name string, region string, "
    "full_address string, seating_capacity int, pitch_type string, load_ts timestamp"
)
DIM_TEAM = contract(
    "team_key string, team_name string, team_group string, federation string, "
    "coach_name string, load_ts timestamp"
)
DIM_MATCH = contract(
    "match_key string, match_date date, match_time string, match_datetime timestamp, "
    "stage string, match_group string, stadium_id string, stadium_name string, "
    "home_team_name string, away_team_name string, weather_notes string, load_ts timestamp"
)
DIM_TIME = contract(
    "date_key int, event_date date, year int, month int, month_name string, day int, "
    "day_type string, load_ts timestamp"
)
DIM_FAN = contract(
    "fan_key bigint, fan_id string, fan_category string, fan_type string, load_ts timestamp"
)
FACT_TICKET_SCAN = contract(
    "ticket_scan_key bigint, match_key string, stadium_key string, fan_key bigint, date_key int, "
    "home_team_key string, away_team_key string, ticket_id string, ticket_category string, "
    "ticket_price_mad int, purchase_channel string, scan_status string, "
    "scan_timestamp timestamp, entry_gate string, scan_day string, load_ts timestamp"
)
GOLD = {
    "dim_stadium": DIM_STADIUM,
    "dim_team": DIM_TEAM,
    "dim_match": DIM_MATCH,
    "dim_time": DIM_TIME,
    "dim_fan": DIM_FAN,
    "fact_ticket_scan": FACT_TICKET_SCAN,
}

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def same_type(actual: T.DataType, wanted: T.DataType) -> bool:
    """Equal types; timestamps with and without zone are interchangeable to the rules."""
    if isinstance(actual, _TIMESTAMPS) and isinstance(wanted, _TIMESTAMPS):
        return True
    return actual == wanted


def conform(df: DataFrame, schema: T.StructType, missing_as_null: bool = False) -> DataFrame:
    """Project ``df`` to the contract: its columns, its order, its types.

    Columns outside the contract are dropped. A value that does not convert becomes NULL,
    it never fails the job. A column already of the contract's type is passed through
    untouched, so the projection still reaches the file scan.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    absent = [f.name for f in schema.fields if f.name not in present]
    if absent and not missing_as_null:
        raise ContractError(f"missing columns: {', '.join(absent)}")
    out = []
    for field in schema.fields:
        if field.name not in present:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif same_type(present[field.name], field.dataType):
            out.append(F.col(f"`{field.name}`"))
        else:
            out.append(F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name))
    return df.select(*out)


def assert_contract(
    df: DataFrame, schema: T.StructType, ignore: Sequence[str] = ()
) -> DataFrame:
    """Raise ``ContractError`` unless names, order and types agree; return ``df``."""
    wanted = [(f.name, f.dataType) for f in schema.fields if f.name not in ignore]
    actual = [(f.name, f.dataType) for f in df.schema.fields if f.name not in ignore]
    if [n for n, _ in wanted] != [n for n, _ in actual]:
        raise ContractError(f"columns {[n for n, _ in actual]} instead of {[n for n, _ in wanted]}")
    for (name, want), (_, got) in zip(wanted, actual, strict=True):
        if not same_type(got, want):
            raise ContractError(f"{name} is {got.simpleString()}, not {want.simpleString()}")
    return df
