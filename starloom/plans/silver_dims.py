"""Silver dimensions: cleaned stadiums, teams, cities and matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import text
from starloom.functions.dates import at_time

STADIUM_CLEANERS = {
    "stadium_name": text.title,
    "city_code": text.code,
    "full_address": text.trimmed,
    "pitch_type": text.code,
    "contact_phone": text.without_blanks,
    "email": text.address,
}
TEAM_CLEANERS = {
    "team_name": text.title,
    "team_code": text.code,
    "group": text.code,
    "federation": text.code,
    "coach_name": text.trimmed,
}
CITY_CLEANERS = {
    "city_name": text.title,
    "city_code": text.code,
    "region": text.trimmed,
    "airport_code": text.code,
    "climate_type": text.trimmed,
}
MATCH_CLEANERS = {
    "match_time": text.clock_time,
    "stage": text.trimmed,
    "group_code": text.code,
    "stadium_id": text.code,
    "home_team_code": text.code,
    "away_team_code": text.code,
    "weather_notes": text.trimmed,
}


def clean_stadiums(stadiums: DataFrame) -> DataFrame:
    return text.clean(stadiums, STADIUM_CLEANERS)


def clean_teams(teams: DataFrame) -> DataFrame:
    return text.clean(teams, TEAM_CLEANERS)


def clean_cities(cities: DataFrame) -> DataFrame:
    return text.clean(cities, CITY_CLEANERS)


def clean_matches(matches: DataFrame, midnight_without_time: bool = True) -> DataFrame:
    """Cleaned matches with the kick-off as one timestamp.

    A match whose time cannot be read gets an empty time and midnight, or NULL if
    ``midnight_without_time`` is false.
    """
    clock = F.col("match_time")
    if not midnight_without_time:
        clock = F.nullif(clock, F.lit(""))
    return text.clean(matches, MATCH_CLEANERS).select(
        "match_id",
        "match_date",
        "match_time",
        at_time(F.col("match_date"), clock).alias("match_datetime"),
        "stage",
        "group_code",
        "stadium_id",
        "home_team_code",
        "away_team_code",
        "weather_notes",
    )
