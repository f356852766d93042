"""Text expressions: casing, transliteration, padding, name normalising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin-1 letters and their ASCII base letters.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
BASE = "aaaaaaeeeeiiiiooooouuuuncyAAAAAAEEEEIIIIOOOOOUUUUNCY"
# Letters whose ASCII form has two characters.
DIGRAPHS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE"}

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()


def to_ascii(c: Column) -> Column:
    """Base letters for accented ones; any other non-ASCII character becomes ``?``."""
    out = F.translate(c, ACCENTED, BASE)
    for letter, pair in DIGRAPHS.items():
        out = F.replace(out, F.lit(letter), F.lit(pair))
    return F.regexp_replace(out, r"[^\x00-\x7F]", "?")


def title_case(c: Column) -> Column:
    """Upper-case an ``a-z`` letter at the start or after a space; leave the rest.

    ``initcap`` is not used because it also lowers the other letters.
    """
    words = F.transform(
        F.split(c, " "),
        lambda w: F.concat(F.translate(F.substring(w, 1, 1), LOWER, UPPER),
                           F.substr(w, F.lit(2))),
    )
    return F.array_join(words, " ")


def trim_spaces(c: Column) -> Column:
    """Trim spaces only (tabs and line feeds stay)."""
    return F.trim(c)


def pad_left(c: Column, width: int = 2, fill: str = "0") -> Column:
    """Left-pad without ever truncating, unlike ``lpad``."""
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def header_name(c: Column) -> Column:
    """Header text to a key: ASCII, lower case, runs of spaces to ``_``."""
    return F.regexp_replace(F.lower(to_ascii(c)), " +", "_")


def key_to_place(c: Column) -> Column:
    """A header key back to a place name."""
    return title_case(F.replace(c, F.lit("_"), F.lit(" ")))


def standard_name(c: Column) -> Column:
    """ASCII, lower, trimmed, title-cased."""
    return title_case(trim_spaces(F.lower(to_ascii(c))))


def ascii_text(text: str) -> str:
    """``to_ascii`` for a Python string, for column names."""
    for letter, pair in DIGRAPHS.items():
        text = text.replace(letter, pair)
    text = text.translate(str.maketrans(ACCENTED, BASE))
    return "".join(ch if ord(ch) < 128 else "?" for ch in text)
