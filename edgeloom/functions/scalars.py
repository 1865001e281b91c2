"""Scalar functions with the null and text rules of the curation tables; every one is a native column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that a delimited annotation file uses for a missing value.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def text(x: Column) -> Column:
    return x.cast("string")


def joined(*parts: Column | str) -> Column:
    """Concatenation that is null where any part is; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else text(p) for p in parts])


def curie(x: Column) -> Column:
    """Every underscore as a colon; null stays null."""
    return F.replace(text(x), F.lit("_"), F.lit(":"))


def or_none(x: Column) -> Column:
    """The text of x, or ``None`` where it is null."""
    return F.coalesce(text(x), F.lit("None"))


def or_default(x: Column, default: str) -> Column:
    return F.coalesce(text(x), F.lit(default))


def title_bool(x: Column) -> Column:
    """``True`` or ``False``; null stays null."""
    return F.initcap(text(x))


def to_id(x: Column) -> Column:
    """A 64-bit id, or null where the text isn't one; surrounding white space is allowed."""
    return text(x).try_cast("bigint")


def matches(x: Column, pattern: str) -> Column:
    """Whether the pattern occurs anywhere in x, case-sensitive; null doesn't match."""
    return F.coalesce(x.rlike(pattern), F.lit(False))


def na_to_null(x: Column, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    return F.when(~F.trim(x).isin(*tokens), x)


def prefix_swap(x: Column, old: str, new: str) -> Column:
    """``old`` replaced by ``new`` wherever it occurs."""
    return F.replace(x, F.lit(old), F.lit(new))


def folder(path: Column) -> Column:
    """What stands before the last slash."""
    return F.regexp_replace(path, "/[^/]*$", "")


def in_folder(where: Column, name: str) -> Column:
    """``name`` in the folder, with one slash between them."""
    return F.concat(F.regexp_replace(where, "/+$", ""), F.lit("/" + name))


def date_stamp(day: Column | None = None) -> Column:
    """yymmdd of the day, today by default."""
    return F.date_format(F.current_date() if day is None else day, "yyMMdd")


def first_item(array: Column) -> Column:
    """The first element, null where there is none."""
    return F.get(array, F.lit(0))


def piped(*parts: Column) -> Column:
    """Values joined with a pipe, null where any is null."""
    return F.concat(*[x for p in parts for x in (F.lit("|"), text(p))][1:])


def chunks_needed(n: Column, size: int) -> Column:
    return F.ceil(n / F.lit(size)).cast("bigint")


def scaled(grid: Column, factor: int = 255) -> Column:
    """Occupancy 0 or 1 as 0 or ``factor``; a short, since 255 is over a byte's range."""
    return (grid.cast("int") * factor).cast("smallint")
