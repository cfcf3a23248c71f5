"""Identifiers of publications as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing identifier.
NULL_WORDS = ("", "nan", "none", "null", "na", "n/a", "<na>", "nat")


def usable(x: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(x)).isin(*NULL_WORDS), F.lit(False))


def blank(x: Column) -> Column:
    return x.isNull() | (F.trim(x) == "")


def clean_pmid(x: Column) -> Column:
    """Leading digits of a usable value, else null."""
    return F.when(usable(x), F.nullif(F.regexp_extract(F.trim(x), r"^([0-9]+)", 1), F.lit("")))


def clean_doi(x: Column) -> Column:
    """Without resolver or doi: prefix and outer slashes, lower case."""
    bare = F.regexp_replace(F.lower(F.trim(x)), r"^https?://(dx\.)?doi\.org/", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"^doi:\s*", ""), r"^/+|/+$", "")
    return F.when(usable(x), F.nullif(bare, F.lit("")))


def clean_pmcid(x: Column) -> Column:
    """PMC and digits; bare digits get the prefix, anything else is null."""
    up = F.upper(F.trim(x))
    up = F.regexp_replace(up, r"\.0$", "")
    return F.when(up.rlike(r"^PMC[0-9]+$"), up).when(up.rlike(r"^[0-9]+$"), F.concat(F.lit("PMC"), up))


def canonical_key(pmcid: Column, doi: Column, pmid: Column) -> Column:
    return F.coalesce(F.concat(F.lit("PMCID:"), pmcid), F.concat(F.lit("DOI:"), doi), F.concat(F.lit("PMID:"), pmid))


def record_id(key: Column) -> Column:
    return F.sha1(key.cast("binary"))


def uuid5(namespace: str, key: Column) -> Column:
    """A version-5 UUID from built-in hashes only."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), key.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("bigint").bitwiseAND(63).bitwiseOR(128)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))

