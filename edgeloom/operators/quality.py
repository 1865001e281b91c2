"""Ambiguity, frequency and consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def drop_ambiguous(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is theirs alone; null keys are equal to each other.

    One aggregation, combined before the shuffle: a key of any number of rows sends one row from each task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"), F.first(row).alias("_row")).filter("_times = 1").select("_row.*")


def ambiguous(df: DataFrame, *keys: str) -> DataFrame:
    """Every row of a key that several rows have, with how many; null keys are equal to each other."""
    several = df.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(several[f"_{i}"])
    return df.join(several, same).select(*[df[c] for c in df.columns], "times")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values and how often each occurs, without null."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def any_null(column: str) -> Column:
    return F.bool_or(F.col(column).isNull())


def all_equal(a: str, b: str) -> Column:
    """Whether a and b agree in every row; null agrees with nothing."""
    return F.bool_and(F.coalesce(F.col(a) == F.col(b), F.lit(False)))


def mismatches(a: str, b: str) -> Column:
    return F.count_if(F.col(a) != F.col(b))


def profile(df: DataFrame) -> DataFrame:
    """A row for each column: ``place``, ``name``, ``type``, and the table's ``rows``, ``nulls`` and ``most`` (the greatest value as text), in one pass."""
    facts = [F.struct(F.lit(i).cast("bigint").alias("place"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(f"`{f.name}`").isNull()).alias("nulls"), F.max(f"`{f.name}`").cast("string").alias("most")) for i, f in enumerate(df.schema)]
    return df.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def lacking(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a null in any of the columns."""
    condition = F.lit(False)
    for c in columns:
        condition = condition | F.col(c).isNull()
    return df.filter(condition)


def watched(df: DataFrame, name: str | Observation) -> DataFrame:
    """``df`` with its row count observed as ``rows`` while it is used; no job of its own."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))
