"""Cleaning primitives shared by the silver tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def trimmed(col: str) -> Column:
    return F.trim(F.col(col))


def normal(col: str) -> Column:
    return F.lower(F.trim(F.col(col)))


def norm_text(df: DataFrame, trim: Sequence[str] = (), lower: Sequence[str] = ()) -> DataFrame:
    return df.withColumns({**{c: trimmed(c) for c in trim}, **{c: normal(c) for c in lower}})


def select_as(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project ``{source: target}``."""
    return df.select(*[F.col(src).alias(dst) for src, dst in names.items()])


def to_flag(col: str, truthy: object) -> Column:
    """True only for the given code; NULL and every other code are false."""
    return F.coalesce(F.col(col) == F.lit(truthy), F.lit(False))


def parse_ts(col: str, fmt: str = "M/d/yyyy H:mm") -> Column:
    """Text to timestamp; text that does not fit the format becomes NULL."""
    return F.try_to_timestamp(F.col(col), F.lit(fmt))


def in_range(col: str, lo: float | None = None, hi: float | None = None) -> Column:
    """Present and inside the closed range; an open end is not checked."""
    c = F.col(col)
    tests = [c.isNotNull()]
    if lo is not None:
        tests.append(c >= lo)
    if hi is not None:
        tests.append(c <= hi)
    return reduce(lambda a, b: a & b, tests)


def validity(rules: Mapping[str, tuple[float | None, float | None]]) -> Column:
    """One boolean over all ``{column: (low, high)}`` rules; never NULL."""
    return F.coalesce(reduce(lambda a, b: a & b, [in_range(c, *r) for c, r in rules.items()]), F.lit(False))


def filter_valid(df: DataFrame, rules: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Keep valid rows.  Applied to bronze columns, so the range tests reach the scan."""
    return df.filter(reduce(lambda a, b: a & b, [in_range(c, *r) for c, r in rules.items()]))


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, NULL keys equal; the smallest remaining values win (NULLs first).

    Both forms thin out each key before the shuffle (partial aggregation, or the partial group
    limit Spark plans for ``row_number = 1``), so a key that holds a third of all rows leaves each
    map task as a single row.  The leading 64-bit digest makes almost every sort comparison one
    comparison of integers; the full key still decides, so equal digests cannot merge rows.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    w = W.partitionBy("_key", *keys).orderBy(*rest)
    numbered = df.withColumn("_key", F.xxhash64(*keys)).withColumn("_row", F.row_number().over(w))
    return numbered.filter(F.col("_row") == 1).drop("_key", "_row")


def stamp(df: DataFrame, name: str = "dbt_loaded_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())
