"""Repair of identifiers and categories by pattern, synonym or band.

Every repair is one regular-expression test and one replacement per row, inside
whole-stage code generation; nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import rules


def rewrite_prefix(c: Column, prefix: str, rest: str, canonical: str) -> Column:
    """Give texts of shape ``prefix rest`` the canonical prefix; NULL for other shapes."""
    shape = f"^(?:{prefix}){rest}$"
    return F.when(c.rlike(shape), F.regexp_replace(c, f"^(?:{prefix})", canonical))


def repair_ticket_id(c: Column) -> Column:
    """TICKET_X, TICKETX and TK_X all become TICKET_X."""
    return rewrite_prefix(c, "TICKET_?|TK_", "[A-Z0-9]+", "TICKET_")


def repair_fan_id(c: Column) -> Column:
    """FAN_X and FANX become FAN_X for 3 to 12 characters; the anonymous mark stays."""
    repaired = rewrite_prefix(c, "FAN_?", "[A-Z0-9]{3,12}", "FAN_")
    return F.when(c == rules.ANONYMOUS_FAN, c).otherwise(repaired)


def repair_category(c: Column) -> Column:
    """CATEGORY n, CATn, a bare n and their spellings become CATEGORY_n."""
    spelled = c.rlike(r"^(?:CAT(?:EGORY)?[ _]*[123]$|[123]\z)")
    canonical = F.concat(F.lit("CATEGORY_"), F.regexp_extract(c, "[123]", 0))
    return F.when(spelled, canonical).otherwise(F.lit(rules.NO_MATCH))


def map_synonyms(c: Column, synonyms: Mapping[str, str], default: str) -> Column:
    """Canonical name whose own text or synonym pattern matches, else the default."""
    names = list(synonyms)
    found = F.when(c.isin(names), c)
    for name in names:
        found = found.when(c.rlike(synonyms[name]), F.lit(name))
    return found.otherwise(F.lit(default))


def repair_channel(c: Column) -> Column:
    return map_synonyms(c, rules.CHANNEL_SYNONYMS, rules.NO_MATCH)


def no_later_than(value: Column, limit: Column) -> Column:
    """``value``, or ``limit`` where the value lies after it; NULL values stay NULL."""
    return F.when(value > limit, limit).otherwise(value)
