"""Defensive casts as column builders: null instead of an error, never a guess (FN-1 to FN-7, FN-17, FN-18, FN-20)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]{1,19}$"


def _compatible() -> tuple[str, str, list[tuple[str, str]]]:
    """Forms of letters, digits and marks that full-width and other variants, blanks and ligatures stand for, by the Unicode tables."""
    single, several = [], []
    for code in [*range(0xA0, 0x250), *range(0x2000, 0x2190), *range(0x3000, 0x3001), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFFEF)]:
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c)
        if plain != c and len(plain) == 1:
            single.append((c, plain))
        elif plain != c and plain.isascii() and plain.isalpha():
            several.append((c, plain))
    return "".join(a for a, _ in single), "".join(b for _, b in single), several


_FORMS, _PLAIN, _LIGATURES = _compatible()


def _spans(characters: str, gap: int = 24) -> str:
    """Character class of a few ranges that hold the characters and what lies near them; one that names each is slow, as all of its parts are asked."""
    spans = []
    for c in sorted(map(ord, characters)):
        if spans and c - spans[-1][1] <= gap:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


_NEAR_FORMS, _NEAR_LIGATURES = _spans(_FORMS), _spans("".join(c for c, _ in _LIGATURES), 256)


def once(x: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once a row, also in a lambda, where Spark works it out for each use."""
    return F.get(F.transform(F.array(x), then), F.lit(0))


def is_ascii(x: Column) -> Column:
    """Whether every character is one byte."""
    return F.length(x) == F.octet_length(x)


def compat(x: Column) -> Column:
    """Compatibility variants of Latin letters, digits, marks and blanks as what they stand for; see ``text.nfkc`` for all of Unicode."""

    def spelled(y: Column) -> Column:
        for c, plain in _LIGATURES:
            y = F.replace(y, F.lit(c), F.lit(plain))
        return y

    def plain(x: Column) -> Column:
        return F.when(x.rlike(_NEAR_FORMS), F.translate(x, _FORMS, _PLAIN)).otherwise(x)

    return F.when(is_ascii(x), x).when(x.rlike(_NEAR_LIGATURES), spelled(plain(x))).otherwise(plain(x))


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def to_int(x: Column) -> Column:
    t = F.trim(x)
    return F.when(t.rlike(INTEGER), t.try_cast("bigint"))


def to_double(x: Column) -> Column:
    """Spark alone would take '1.0d', '1f' and 'NaN' for numbers."""
    t = F.trim(x)
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def to_double_fr(x: Column) -> Column:
    """'2,25%' and '2.25' are 2.25; '-' and blanks are null."""
    return to_double(F.replace(F.replace(F.trim(x), F.lit("%"), F.lit("")), F.lit(","), F.lit(".")))


def to_int_fr(x: Column) -> Column:
    """All but digits and minus is dropped, so '12,5' is 125; see ``to_int_fr_strict``."""
    return to_int(F.regexp_replace(x, "[^0-9-]", ""))


def to_int_fr_strict(x: Column) -> Column:
    """Blanks alone may separate thousands."""
    return to_int(F.regexp_replace(F.trim(x), r"(?<=[0-9])[  ](?=[0-9]{3})", ""))


def to_date_fr(x: Column) -> Column:
    t = F.trim(x)
    return F.when(t.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(t, "d/M/yyyy"))


def to_date_period(x: Column) -> Column:
    """'02-2026' is the first of that month."""
    t = F.trim(x)
    return F.when(t.rlike(r"^[0-9]{2}-[0-9]{4}$"), F.try_to_date(F.concat(F.lit("01-"), t), "dd-MM-yyyy"))


def placeholder_decimal(x: Column, scale: int = 6) -> Column:
    """Decimal of a text in which '-' and blanks stand for nothing and a comma for the point."""
    t = F.nullif(F.nullif(F.replace(F.replace(F.trim(x), F.lit("%"), F.lit("")), F.lit(","), F.lit(".")), F.lit("")), F.lit("-"))
    return F.when(t.rlike(NUMBER), t.try_cast(f"decimal(38,{scale})"))


def unit_or_one(x: Column) -> Column:
    return F.coalesce(F.regexp_replace(x, "[^0-9]", "").try_cast("int"), F.lit(1))


def normalize_number(x: Column) -> Column:
    """struct(i, d, s): a whole number, a number with point or percent sign, or the cleaned text."""

    def parsed(clean: Column, percent: Column) -> Column:
        whole = clean.rlike(r"^[+-]?[0-9]+$") & ~percent
        real = F.when(percent, clean.rlike(NUMBER)).otherwise(clean.rlike(r"^[+-]?[0-9]+[.][0-9]+$"))
        i = F.when(whole, clean.try_cast("bigint"))
        d = F.when(real, clean.try_cast("double"))
        return F.struct(i.alias("i"), d.alias("d"), F.when(i.isNull() & d.isNull(), clean).alias("s"))

    def number(t: Column) -> Column:
        return once(F.nullif(F.replace(F.translate(t, "%    ​\"'", ""), F.lit(","), F.lit(".")), F.lit("")), lambda c: parsed(c, t.endswith("%")))

    return once(F.trim(compat(x)), number)
