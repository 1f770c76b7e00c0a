"""Scalar text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions import lexicons as L


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c) -> Column:
    """Null is the empty string."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def strip(c) -> Column:
    return F.btrim(col(c), F.lit(L.WS_CHARS))


def raw_text(c) -> Column:
    return strip(F.regexp_replace(col(c), "\r\n?", "\n"))


def clean_text(c) -> Column:
    """White space as single blanks, none at the ends. Only a text with other white space than single blanks and line feeds needs a replacement sign by sign."""
    c = F.replace(col(c), F.lit("\n"), F.lit(" "))
    odd = F.contains(c, F.lit("  ")) | F.rlike(c, F.lit(L.ODD_WS))
    return F.trim(F.when(odd, F.regexp_replace(c, f"{L.WS}+", " ")).otherwise(c))


def parse_count(c) -> Column:
    """Digits with optional thousands commas; blank is null; anything else fails the query."""
    return F.nullif(F.replace(strip(text_of(c)), F.lit(","), F.lit("")), F.lit("")).cast("bigint")


def parse_plain_int(c) -> Column:
    return F.nullif(strip(text_of(c)), F.lit("")).cast("bigint")


def parse_time(c) -> Column:
    return F.to_timestamp_ntz(F.nullif(strip(text_of(c)), F.lit("")), F.lit("yyyy-M-d H:m:s"))


def parse_yes_no(c) -> Column:
    s = strip(text_of(c))
    return F.when(s == "是", True).when(s == "否", False)


def parse_bool(c) -> Column:
    return F.lower(strip(text_of(c))) == "true"


def parse_optional_bool(c) -> Column:
    s = F.lower(strip(text_of(c)))
    return F.when(s == "true", True).when(s == "false", False)


def parse_list(c) -> Column:
    """JSON text to strings: a list's items, or a scalar as the only item; blank is the empty list."""
    s = strip(text_of(c))
    v = F.try_parse_json(s)
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string"))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.coalesce(items, F.array(F.try_variant_get(v, "$", "string"))))


def char_len(c) -> Column:
    return F.length(strip(c))


def token_len(c) -> Column:
    return F.size(F.filter(F.split(col(c), f"{L.WS}+"), lambda x: x != ""))


def only_symbols(c) -> Column:
    return (col(c) != "") & F.rlike(col(c), F.lit(L.SYMBOLS_ONLY))


def contains_any(c, keywords) -> Column:
    out = F.lit(False)
    for k in keywords:
        out = out | col(c).contains(k)
    return out


def tags(c, lexicon) -> Column:
    """Tags of which some keyword occurs, in the lexicon's order."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(col(c).contains(k), F.lit(t)) for t, k in lexicon]))).cast("array<string>")


def canonical(c) -> Column:
    """The form under which near-verbatim repeats are equal."""
    out = F.when(F.contains(col(c), F.lit("[")), F.regexp_replace(col(c), L.BRACKET_TAG, "")).otherwise(col(c))
    out = F.replace(out, F.lit(" "), F.lit(""))  # most of what goes, as bytes
    return F.array_join(F.split(out, f"{L.REMOVED_CLASS}+"), "")


def key(c) -> Column:
    """32 bytes that stand for a text: texts are told apart, grouped and joined by them, and need not be moved."""
    return F.unhex(F.sha2(col(c), 256))


def key_of(rows: DataFrame, name: str) -> Column:
    """The key of a text column, null for '': its column ``key_<name>`` where the rows have it, so that the text need not be read."""
    return F.col(f"key_{name}") if f"key_{name}" in rows.columns else F.when(F.col(name) != "", key(name))
