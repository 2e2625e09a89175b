"""Fixed values of the ticket domain, kept apart from the operators that use them."""

from __future__ import annotations

from dataclasses import dataclass, field

# Shapes of identifiers, and the shapes that can be repaired into them.
ANONYMOUS_FAN = "N/A"
TICKET_SHAPE = r"^TICKET_[A-Z0-9]{3,12}$"
FAN_SHAPE = r"^FAN_[A-Z0-9]{3,12}$"
# The same, told from a normalised id before its repair: one test instead of three.
ACCEPTED_TICKET = r"^(?:TICKET_?|TK_)[A-Z0-9]{3,12}$"
ACCEPTED_FAN = r"^(?:N/A\z|FAN_?[A-Z0-9]{3,12}$)"

# Accepted categories and the inclusive price band of each, in MAD.
PRICE_BANDS = {
    "CATEGORY_1": (250, 350),
    "CATEGORY_2": (150, 250),
    "CATEGORY_3": (50, 150),
}
CATEGORIES = tuple(PRICE_BANDS)

# Accepted purchase channels and the spellings that mean each.
CHANNEL_SYNONYMS = {
    "WEBSITE": r"^(?:WEB|WEBSITE_V2|ONLINE)$",
    "MOBILE_APP": r"^(?:APP|PHONE)$",
}
CHANNELS = tuple(CHANNEL_SYNONYMS)

# Defaults standing for NULL, for no match, and for unknown members.
NULL_TEXT = "UNKNOWN"
NO_MATCH = "INVALID"
UNKNOWN_MEMBER = "UNKNOWN"
ANONYMOUS_FAN_KEY = 0

# Attributes of identified fans and of the one anonymous member.
IDENTIFIED_FAN = ("Regular", "Identified")
UNIDENTIFIED_FAN = ("Unidentified", "Undentified")

# The status that counts as attended, and the shape of the tournament.
SCANNED = "SCANNED"
TOURNAMENT_MATCHES = 36
TOURNAMENT_STADIUMS = 9
QUALITY_TERMS = 6.0

# Audit table and audit reason of every rejection, in the order of the steps.
# The two "irreparable" reasons hold rows whose id no repair fits.
AUDIT_REASONS = {
    "complets_doublons": "ligne double",
    "ticket_id_null": "ticket_id nulle",
    "ticket_id_doublons": "ticket_id dupliqué",
    "ticket_id_invalide": "ticket_id invalide",
    "ticket_id_irreparable": "ticket_id irréparable",
    "fan_id_invalide": "fan_id invalide",
    "fan_id_irreparable": "fan_id irréparable",
    "fan_id_doublons": "fan_id dupliqué dans le même match",
}
ACCEPTED = "accepted"


@dataclass(frozen=True)
class ScanPolicy:
    """Choices a caller may change; the defaults give the documented results."""

    period_year: int = 2025
    period_months: tuple[int, int] = (12, 12)
    quality_terms: float = QUALITY_TERMS
    # Count INVALID as a valid channel, which makes the flag true for every row.
    invalid_channel_is_valid: bool = True
    price_bands: dict[str, tuple[int, int]] = field(default_factory=lambda: dict(PRICE_BANDS))
    # Keep one row per repaired ticket id as well, not only per id as it was typed.
    dedup_after_repair: bool = False
    # Raise when two lookup rows share a key, instead of taking the smallest.
    strict_lookups: bool = False
    # Of several matches at a stadium on a day, the one whose kick-off is nearest to the scan.
    nearest_match: bool = False
    # Compare match and stadium ids without regard to case and outer spaces.
    normalize_keys: bool = False
    # Keep one entry per repaired fan id and match once missing matches are filled.
    dedup_fans_after_enrichment: bool = False
    # Give the dimensions a row that UNKNOWN references of the fact point to.
    unknown_members: bool = False
