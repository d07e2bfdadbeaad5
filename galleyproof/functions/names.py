"""Names and titles reduced to plain ASCII, without leaving the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters spelled out with other letters than their base letter.
SPELLED_OUT = [
    ("ß", "ss"),
    ("Ä", "Ae"), ("ä", "ae"),
    ("Å", "Aa"), ("å", "aa"),
    ("Æ", "Ae"), ("æ", "ae"),
    ("Ö", "Oe"), ("ö", "oe"),
    ("Ø", "Oe"), ("ø", "oe"),
    ("Ü", "Ue"), ("ü", "ue"),
    ("Đ", "d"), ("đ", "d"),
    ("Ł", "l"), ("ł", "l"),
]


@cache
def _base_letters() -> tuple[str, str]:
    """Every single character that is an ASCII letter plus marks, and that letter.

    Follows Unicode's canonical decomposition, so Spark needs no normalising function.
    """
    marked, plain = [], []
    for code in range(0x80, 0x10000):
        parts = unicodedata.normalize("NFD", chr(code))
        base = "".join(p for p in parts if unicodedata.category(p) != "Mn")
        if base != chr(code) and len(base) == 1 and base.isascii() and base.isalnum():
            marked.append(chr(code))
            plain.append(base)
    return "".join(marked), "".join(plain)


def strip_marks(c: Column) -> Column:
    """Letters without accents: composed letters by translation, loose marks dropped."""
    return F.regexp_replace(F.translate(c, *_base_letters()), r"\p{Mn}", "")


def ascii_name(c: Column) -> Column:
    """A personal name as an ASCII label of ``[A-Za-z0-9._-]`` in title case."""
    spelled = c
    for letter, spelling in SPELLED_OUT:
        spelled = F.replace(spelled, F.lit(letter), F.lit(spelling))
    c = F.when(c.rlike(r"[^\x00-\x7F]"), strip_marks(spelled)).otherwise(c)
    c = F.regexp_replace(F.lower(F.regexp_replace(c, r"\s+", "-")), "[^a-z0-9._-]+", "")
    c = F.btrim(F.regexp_replace(c, "-{2,}", "-"), F.lit("-"))
    # no blanks are left, so they can mark the words for a moment
    return F.replace(F.initcap(F.regexp_replace(c, "([^a-z]+)", " $1 ")), F.lit(" "), F.lit(""))


def title_tokens(c: Column) -> Column:
    """Distinct lower-case words of a title, accents and punctuation removed."""
    return F.array_remove(F.array_distinct(F.split(strip_marks(F.lower(c)), "[^a-z0-9]+")), "")
