"""Text clean-up expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from skyledger import fixed_values as fv


def strip(col: Column) -> Column:
    """Remove white space of every kind from both ends (``trim`` knows only spaces)."""
    return F.btrim(col, F.lit(fv.WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.when(col.rlike(r"(?U)\S"), col)


def tokens_to_null(col: Column, tokens=fv.NA_TOKENS) -> Column:
    return F.when(~col.isin(*tokens), col)


def strip_code_suffix(col: Column, trimmed: bool = True) -> Column:
    """``AA(1)`` -> ``AA``."""
    bare = F.when(col.contains("("), F.regexp_replace(col, fv.CODE_SUFFIX, "")).otherwise(col)
    return strip(bare) if trimmed else bare


def _literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(entries.items())))


def _expand_words(col: Column, entries: dict[str, str]) -> Column:
    # Words are separated by single spaces here, so a word is a match with no
    # non-space neighbour. "X." and "X" share one pattern.
    for word in sorted({w.rstrip(".") for w in entries}):
        col = F.regexp_replace(col, rf"(?<![^ ]){word}\.?(?![^ ])", entries[word])
    return col


def normalize_name(col: Column) -> Column:
    """Upper case, no corporate suffix, words spelled out, canonical name; null stays null."""
    bare = strip(F.regexp_replace(F.upper(strip(col)), fv.CORPORATE_SUFFIX, ""))
    spelled = _expand_words(F.regexp_replace(bare, r"(?U)\s+", " "), fv.ABBREVIATIONS)
    return F.coalesce(_literal_map(fv.CANONICAL_NAMES)[spelled], spelled)


def city_of(description: Column) -> Column:
    """``City, ST: Airport`` -> ``City, ST``."""
    return strip(F.substring_index(description, ":", 1))
