"""Text standardization, names of people and organizations, keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal suffixes that do not count when names are compared.
LEGAL_SUFFIXES = ["LLC", "Inc", "Corp", "Ltd", "et al"]

# Words that mark a party as an organization.
ENTITY_WORDS = [
    "LLC", "Inc", "Corp", "Ltd", "Bank", "Insurance", "N.A.", "Company", "Co.", "Services", "Funding",
    "Associates", "Partners", "Group",
]

# Entity classes. The words of each class are ours; the first class that matches wins.
ENTITY_CLASSES = [
    ("LLC", ["LLC", "L.L.C."]),
    ("TRUST", ["Trust", "Trustee"]),
    ("GOVERNMENT", ["State of", "County of", "City of", "Department", "United States", "IRS"]),
    ("CORPORATION", ["Inc", "Corp", "Corporation", "Ltd", "Bank", "Insurance", "N.A.", "Company", "Co."]),
]


def clean(c: Column) -> Column:
    return F.trim(c)


def lowered(c: Column) -> Column:
    return F.lower(F.trim(c))


def uppered(c: Column) -> Column:
    return F.upper(F.trim(c))


def flag(c: Column) -> Column:
    """``true`` in any case and padding is true; everything else, and null, is false."""
    return F.coalesce(lowered(c) == "true", F.lit(False))


def is_filled(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def any_word(words: list[str]) -> str:
    """A case-insensitive pattern that matches the words literally and only as whole words."""
    body = "|".join(re.escape(w).replace("\\ ", " ") for w in words)
    return rf"(?i)(?:^|[^A-Za-z0-9])(?:{body})(?:$|[^A-Za-z0-9])"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def is_entity(name: Column) -> Column:
    return name.rlike(any_word(ENTITY_WORDS))


def entity_type(name: Column) -> Column:
    result = F.when(~is_filled(name), F.lit("UNKNOWN"))
    for kind, words in ENTITY_CLASSES:
        result = result.when(name.rlike(any_word(words)), F.lit(kind))
    return result.otherwise(F.when(is_entity(name), F.lit("CORPORATION")).otherwise(F.lit("INDIVIDUAL")))


def tidy_name(name: Column) -> Column:
    """Squeezed and stripped of special characters."""
    return squeeze(F.regexp_replace(name, r"[^A-Za-z0-9 .,&'#-]", ""))


def cased_name(tidy: Column, entity: Column) -> Column:
    """People in title case, organizations as written."""
    return F.when(entity, tidy).otherwise(F.initcap(tidy))


def display_name(name: Column) -> Column:
    tidy = tidy_name(name)
    return cased_name(tidy, is_entity(tidy))


def match_name(name: Column) -> Column:
    """The form in which names are compared: lower case, letters and digits of any script, no legal suffix."""
    words = squeeze(F.regexp_replace(F.lower(name), r"[^\p{L}\p{M}\p{N} ]", " "))
    ends = "|".join(s.lower() for s in LEGAL_SUFFIXES)
    return squeeze(F.regexp_replace(words, rf"(?:\s(?:{ends}))+$", ""))


def name_tokens(name: Column) -> Column:
    return F.array_distinct(F.split(match_name(name), " "))


# What a well-formed value looks like. Postal codes are those of the US.
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PHONE = r"^\+?[0-9][0-9 ().-]{8,18}$"
POSTAL_CODE = r"^[0-9]{5}(-[0-9]{4})?$"


def matches(c: Column, pattern: str) -> Column:
    """Does the trimmed text match? Null does not."""
    return F.coalesce(F.trim(c).rlike(pattern), F.lit(False))


def phone_e164(c: Column, country: str = "1") -> Column:
    """Digits with a leading plus; numbers without a country code get ``country``. Null when impossible."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    full = F.when(F.ltrim(c).startswith("+"), digits) \
        .when(F.length(digits) == 10, F.concat(F.lit(country), digits)) \
        .otherwise(digits)
    return F.when(F.length(full).between(11, 15), F.concat(F.lit("+"), full))


def hash_key(*parts: Column) -> Column:
    """Stable key over several values. Each carries its length and null is a mark without one, so no two lists meet."""
    texts = [p.cast("string") for p in parts]
    token = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("∅")) for t in texts]
    return F.sha2(F.concat_ws("|", *token), 256)


def mask(c: Column) -> Column:
    """Replace a personal value by its hash: equal values stay joinable, the text is gone."""
    return F.sha2(c.cast("string"), 256)


def search_text(*parts: Column) -> Column:
    return F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])
