"""Text, key and reference expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values, in the reference's order: titles before a name. Anything but letters in them stands for a blank.
TITLES = ("MR", "MRS", "MS", "MISS", "DR", "PROF", "SHRI", "SMT", "SRI", "KUM", "MASTER", "BABY", "B/O")

#: Fixed values, in the reference's order: endings of procedure names that make no other procedure.
VARIANTS = ("- LEFT", "- RIGHT", "- BILATERAL", "(REVISION)", "- ELECTIVE", "- EMERGENCY")


def same_text(c: Column) -> Column:
    """Form in which two texts are the same but for case, outer blanks and runs of blanks; null stays null."""
    return F.lower(F.trim(F.regexp_replace(c.cast("string"), r"\s+", " ")))


def title_pattern(titles: Sequence[str] = TITLES) -> str:
    """Pattern of one title in front of a name whose characters are letters and single blanks."""
    return "^(" + "|".join(re.sub("[^A-Z]+", " ", t) for t in titles) + ") +"


def normalize_name(c: Column, titles: Sequence[str] = TITLES) -> Column:
    """Upper case letters and single blanks, up to two leading titles removed; null stays null."""
    title = title_pattern(titles)
    letters = F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.trim(c)), "[^A-Z ]", " "), " +", " "))
    return F.trim(F.regexp_replace(F.regexp_replace(letters, title, ""), title, ""))


def normalize_procedure(c: Column) -> Column:
    """Upper case letters, digits and single blanks, without the endings VARIANTS, each taken off once in that order."""
    out = F.upper(F.trim(c))
    for v in VARIANTS:
        lead, rest = ("- ", v[2:]) if v.startswith("- ") else ("", v)
        out = F.regexp_replace(out, rf"\s*{'-' if lead else ''}\s*{re.escape(rest)}$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(out, "[^A-Z0-9 ]", " "), " +", " "))


def normalize_phone(c: Column) -> Column:
    """Last ten digits, or null where there are fewer."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.substring(digits, -10, 10))


def phone_last4(c: Column) -> Column:
    """Last four digits of a phone that has ten, or null."""
    return F.substring(normalize_phone(c), -4, 4)


def reference_sequence(c: Column) -> Column:
    """Running number at the end of a reference, as a number, so that lost leading zeros do not matter."""
    tail = F.regexp_extract(c, r"([0-9]+)[^0-9]*$", 1)
    return F.nullif(tail, F.lit("")).try_cast("bigint")


def joined(cols: Sequence[Column]) -> Column:
    """Text that tells the columns' values apart: each is led by its length, a null is a bare dash, so no value can look like
    a null, like another split of the same text, or like its neighbour."""
    text = [c.cast("string") for c in cols]
    return F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text])


def sha_key(cols: Sequence[Column]) -> Column:
    """sha-256 in hex over the columns, nulls marked."""
    return F.sha2(joined(cols), 256)


def surrogate_key(cols: Sequence[Column]) -> Column:
    """Non-negative 64-bit key."""
    return F.xxhash64(joined(cols)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def row_hash(cols: Sequence[Column]) -> Column:
    """128 bits over the columns, as hex: two 64-bit hashes of differing input."""
    text = joined(cols)
    return F.concat(F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit("b"), text)))
