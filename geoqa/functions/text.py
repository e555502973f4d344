"""Text normalisers and predicates used to match names and road numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the checks depend on (kept as in the source checks).
REF_PREFIX_PATTERN = "^(A|N|D|C|VC|CV|M) [0-9]"      # numbered-road ref, C17
RURAL_NAME_PATTERN = ("(c.r.|c.e.|rural| ral |chemin|exploit|desserte|dite? .*d[eu]s?]|"
                      "d[eu]s? .*dite?|('de).*(à|au))")  # cadastre names to skip, C23 (case-insensitive)
RURAL_NAME_PATTERN_STRICT = ("(c\\.r\\.|c\\.e\\.|rural| ral |chemin|exploit|desserte|dite? .*d[eu]s?]|"
                             "d[eu]s? .*dite?|('de).*(à|au))")
NAME_LETTERS_PATTERN = "[a-z][a-z][a-z]"             # at least three lower-case letters, C23
EXCLUDED_WORDS = ("EXPLOITA", "RURAL")               # street-register words to skip, C12
EXCLUDED_SHOPS = ("car", "car_repair", "kiosk")      # C3
MAJOR_HIGHWAY_PATTERN = "^(motorway|trunk|primary|secondary|tertiary|unclassified)"  # C20


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_ref(c) -> Column:
    """Road number as compared with official numbers: upper case, keep only
    ``0-9 A-Z .``, a leading ``M`` (metropolitan road) becomes ``D``."""
    return F.regexp_replace(F.regexp_replace(F.upper(_c(c)), "[^0-9A-Z.]", ""), "^M", "D")


def normalise_alt_ref(c) -> Column:
    """old_ref / nat_ref variant: upper case, keep only ``0-9 A-Z``."""
    return F.regexp_replace(F.upper(_c(c)), "[^0-9A-Z]", "")


def pretty_ref(c) -> Column:
    """``D12`` -> ``D 12``: a space before the trailing alphanumeric run
    (only the first match is rewritten, as the source check does)."""
    return F.regexp_replace(_c(c), "^(.*?)([A-Z]*)([0-9A-Z]*)$", "$1$2 $3")


def strip_spaces(c) -> Column:
    return F.regexp_replace(_c(c), " ", "")


def blank(c) -> Column:
    """NULL or empty (``coalesce(x,'') = ''``)."""
    return F.coalesce(_c(c), F.lit("")) == ""


def is_rural_name(c, strict_dots: bool = False) -> Column:
    pat = RURAL_NAME_PATTERN_STRICT if strict_dots else RURAL_NAME_PATTERN
    return _c(c).rlike("(?i)" + pat)


def matches_ci(text, pattern) -> Column:
    """``text ~* pattern`` where the pattern is a column (case-insensitive).  A name with a sign that
    may not form a pattern (``Rue *``, ``[bis``) is looked for as it stands."""
    literal = _c(pattern).rlike(r"[*+?\[\]{}\\()]")
    return F.when(literal, F.contains(F.lower(_c(text)), F.lower(_c(pattern)))).otherwise(
        F.regexp_like(_c(text), F.concat(F.lit("(?i)"), F.when(~literal, _c(pattern)).otherwise(""))))


def unbracket(c) -> Column:
    """Drop round brackets so a name can serve as a pattern."""
    return F.regexp_replace(_c(c), "[()]", "")
