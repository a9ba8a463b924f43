"""Text folding, header names, periods and codes as column builders (FN-8 to FN-16, FN-19 to FN-29, FN-35 to FN-43)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terrace.functions.casts import compat, is_ascii, normalize_number, once


def _accents() -> tuple[str, str]:
    """Latin letters that decompose into one ASCII letter and marks, and those letters."""
    pairs = []
    for code in range(0xC0, 0x250):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(plain) == 1 and plain.isascii() and plain.isalpha():
            pairs.append((chr(code), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _accents()


def strip_accents(x: Column) -> Column:
    return F.when(is_ascii(x), x).otherwise(F.translate(x, _FROM, _TO))


def _ascii(x: Column) -> Column:
    return F.regexp_replace(x, r"[^\x00-\x7F]", "")


@F.pandas_udf(StringType())
def nfkc(x: pd.Series) -> pd.Series:
    """Full compatibility normalisation and trim, for the few texts that need it; no built-in function does that."""
    return x.str.normalize("NFKC").str.strip()


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def normalize_name(x: Column) -> Column:
    """Key for name matching: lower case, no accents, dashes as blanks, single blanks, ASCII alone."""
    return collapse(F.replace(_ascii(strip_accents(F.lower(F.trim(x)))), F.lit("-"), F.lit(" ")))


def name_key(x: Column) -> Column:
    """Key for exact name matching in any script: folded like ``normalize_name``, but letters beyond Latin stay, compared without case and marks.

    Null where nothing is left of a name, so that it matches nothing.
    """
    kept = F.regexp_replace(strip_accents(F.lower(F.trim(x))), r"[^\x00-\x7F\p{L}\p{M}\p{N}]", "")
    return F.collate(F.nullif(collapse(F.replace(kept, F.lit("-"), F.lit(" "))), F.lit("")), "UNICODE_CI_AI")


def fold_header(x: Column) -> Column:
    """Header key: no accents, one kind of apostrophe, single blanks, lower case."""
    return F.lower(collapse(F.replace(strip_accents(compat(F.coalesce(x, F.lit("")))), F.lit("’"), F.lit("'"))))


# Slug patterns and their canonical names, the first that matches counts.
FIELD_RULES = (
    (r"\bcode\b.*\brayon\b", "code_rayon_action"),
    (r"\brayon\b.*\baction\b", "rayon_action"),
    (r"\brayon\b", "rayon_action"),
    (r"\bcode\b.*\blocalite\b", "code_localite"),
    (r"\blocalite\b|\bville\b|\bcommune\b", "localite"),
    (r"\bnombre\b.*\bguichet\b", "nombre_guichets"),
    (r"\bguichet\b", "nombre_guichets"),
    (r"\bdepots?\b.*\bmontant\b", "depots_montant"),
    (r"\bdepots?\b.*\bpercent\b", "depots_percent"),
    (r"\bcredit\b.*\bmontant\b", "credits_montant"),
    (r"\bcredit\b.*\bpercent\b", "credits_percent"),
    (r"\bimmobilier\b", "credit_immobilier"),
    (r"\bequipement\b", "credit_equipement"),
    (r"\btresorerie\b", "credit_tresorerie"),
    (r"\bconsommation\b", "credit_consommation"),
    (r"\bmenages?\b", "credit_menages"),
    (r"\bsocietes?\b.*\bnon\b.*\bfinancieres?\b.*\bprivees?\b", "credit_entreprises_privees"),
    (r"\bsocietes?\b.*\bnon\b.*\bfinancieres?\b.*\bpubliques?\b", "credit_entreprises_publiques"),
    (r"\bentreprises?\b", "credit_entreprises"),
    (r"\bpercent\b", "percent"),
    (r"\bvariation\b.*\bpercent\b", "variation_percent"),
    (r"\bencours\b.*\bvariation\b", "variation_percent"),
)


def slug(x: Column) -> Column:
    folded = F.replace(strip_accents(F.lower(F.trim(compat(F.coalesce(x, F.lit("")))))), F.lit("%"), F.lit(" percent "))
    return F.regexp_replace(F.regexp_replace(folded, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def field_name(x: Column, rules: tuple[tuple[str, str], ...] = FIELD_RULES) -> Column:
    """Canonical column name of a label: its slug, or what the first matching rule says."""

    def named(s: Column) -> Column:
        found = F.when(s == "", "column")
        for pattern, name in rules:
            found = found.when(s.rlike(pattern), name)
        return found.otherwise(s)

    return once(slug(x), named)


def normalize_map(m: Column) -> Column:
    """A map with canonical keys and values as ``normalize_number`` gives them; on two labels of one name, the last one's value."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(field_name(e["key"]).alias("key"), normalize_number(e["value"]).alias("value")))
    # of each name the last entry, at the place of its first
    last = lambda es, k: F.element_at(F.filter(es, lambda e: e["key"] == k), -1)
    single = lambda es: F.transform(F.array_distinct(F.transform(es, lambda e: e["key"])), lambda k: last(es, k))
    return F.map_from_entries(once(entries, single))


def period_from_title(x: Column) -> Column:
    """'MM-YYYY' from 'MM-YYYY' or 'MM/YYYY', else a year, else null."""
    month = r"(0[1-9]|1[0-2])[-/]([0-9]{4})"
    dated = F.when(x.rlike(month), F.concat(F.regexp_extract(x, month, 1), F.lit("-"), F.regexp_extract(x, month, 2)))
    return F.coalesce(dated, capture(x, r"\b([0-9]{4})\b"))


def capture(x: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


QUANTITY = r"^\s*([0-9][0-9\s]*)\s+(\S.*)$"


def quantity(x: Column) -> Column:
    """Number that a label begins with, without blanks; '1' by default."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_extract(x, QUANTITY, 1), r"\s", ""), F.lit("")), F.lit("1"))


def quantity_label(x: Column) -> Column:
    return F.coalesce(F.trim(capture(x, QUANTITY, 2)), x)


def code_from_link(href: Column, label: Column) -> Column:
    """Upper-case code of a currency link, else the beginning of the folded label."""
    return F.coalesce(F.upper(capture(href, r"(?i)/graph/currency/([a-z]{2,4})")), F.upper(F.substring(fold_header(label), 1, 8)))


def deepest_code(*codes: Column) -> Column:
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in codes))


def split_types(x: Column) -> Column:
    return F.split(F.nullif(F.trim(x), F.lit("")), r"\|")


def to_tags(x: Column) -> Column:
    return F.from_json(F.nullif(F.trim(x), F.lit("")), "map<string,string>")


# Categories in order of choice.
CATEGORIES = ("amenity", "shop", "tourism", "leisure", "healthcare", "office", "craft", "historic")


def pick_category(tags: Column, keys: tuple[str, ...] = CATEGORIES) -> Column:
    """struct(key, value) of the first category that the tags hold."""
    key = F.get(F.filter(F.array(*(F.lit(k) for k in keys)), lambda k: F.coalesce(F.map_contains_key(tags, k), F.lit(False))), F.lit(0))
    return F.struct(key.alias("key"), F.try_element_at(tags, key).alias("value"))


def code_parts(code: Column, separator: str = "-") -> Column:
    """struct(country, region, province, commune, level) of a dashed hierarchical code."""
    parts = F.split(code, separator)
    n = F.size(parts)
    upto = [F.when(n >= k, F.array_join(F.slice(parts, 1, k), separator)) for k in range(1, 5)]
    level = F.when(n == 1, "country").when(n == 2, "region").when(n == 3, "province").when(n == 4, "commune")
    return F.struct(upto[0].alias("country"), upto[1].alias("region"), upto[2].alias("province"), upto[3].alias("commune"), level.alias("level"))


def clean_address(x: Column) -> Column:
    """Letters, digits, blanks, plus and six marks, with single blanks."""
    return collapse(F.regexp_replace(x, r"[^\p{L}\p{N}\s+,.'/#-]", ""))


def identifier(x: Column, default: str = "column") -> Column:
    clean = F.regexp_replace(F.regexp_replace(x, "[^A-Za-z0-9_]", "_"), "^_+|_+$", "")
    clean = F.when(clean == "", default).otherwise(clean)
    return F.when(clean.rlike("^[0-9]"), F.concat(F.lit("t_"), clean)).otherwise(clean)


def absolute_url(href: Column, base: Column) -> Column:
    """The link itself if it has a scheme, else host and path below the page's scheme and host."""
    root = F.regexp_extract(base, r"^([a-z]+://[^/?#]+)", 1)
    return F.when(href.startswith("http"), href).otherwise(F.concat(root, href))


def duration_ms(start: Column, end: Column) -> Column:
    return F.floor((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1000).cast("bigint")


# Month names as the bank's calendar shows them.
MONTHS_FR = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")


def month_name_fr(date: Column) -> Column:
    return F.element_at(F.array(*(F.lit(m) for m in MONTHS_FR)), F.month(date))
