"""Reading, writing and maintaining tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.session import ensure_checkpoint_dir
from vitalframe.sources.schemas import BRONZE


# --- read and write -----------------------------------------------------------------------------
def read_source(spark: SparkSession, name: str, base: str) -> DataFrame:
    """A bronze table with its declared schema."""
    return spark.read.schema(BRONZE[name]).parquet(f"{base}/{name}.parquet")


def read_labeled_csv(spark: SparkSession, path: str, target: str, schema: str | None = None) -> DataFrame:
    """CSV rows that carry a target; types are inferred unless a schema is given, which saves a pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path).na.drop(subset=[target])


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a query as a table, replacing what is there, and read it back."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def export_pairs(df: DataFrame, path: str) -> None:
    """Prompt/completion records as JSON lines."""
    df.select("prompt", "completion").write.mode("overwrite").json(path)


def export_chat(df: DataFrame, path: str) -> None:
    df.select(F.to_json("messages").alias("value")).write.mode("overwrite").text(path)


# --- typed tables -------------------------------------------------------------------------------
def with_defaults(df: DataFrame, schema: str, defaults: Mapping[str, object]) -> DataFrame:
    """Cast to a declared schema.  Absent columns take their default; a NULL that was given stays."""
    fields = T.StructType.fromDDL(schema).fields
    given = {c.lower(): c for c in df.columns}

    def column(field: T.StructField) -> Column:
        if field.name.lower() in given:
            value = F.col(given[field.name.lower()])
        elif defaults.get(field.name) == "now":
            value = F.current_timestamp()
        else:
            value = F.lit(defaults.get(field.name))
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in fields])


def append_rows(target: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Target plus new rows; columns the new rows lack are NULL."""
    return target.unionByName(new_rows, allowMissingColumns=True)


# Folders that the rows of one day are spread over by their key.
KEY_BUCKETS = 8


def key_bucket(keys: Sequence[str], buckets: int = KEY_BUCKETS) -> Column:
    """Number of the folder of a key; NULL parts count as a value of their own."""
    return F.pmod(F.xxhash64(*[c for k in keys for c in (F.col(k), F.col(k).isNull())]), F.lit(buckets)).cast("int")


def stored_keys(spark: SparkSession, path: str, schema: T.StructType, touched: Sequence[tuple], keys: Sequence[str], day: str) -> DataFrame:
    """Keys already stored in the touched (day, key_bucket) folders; no other folder is read."""
    days = {d for d, _ in touched}
    known = sorted(d for d in days if d is not None)
    in_day = F.col(day).isin(known) if known else F.lit(False)
    if None in days:
        in_day = in_day | F.col(day).isNull()
    saved = spark.read.schema(schema).parquet(path)
    return saved.where(in_day & F.col("key_bucket").isin(sorted({b for _, b in touched}))).select(*dict.fromkeys([*keys, day, "key_bucket"]))


def append_new(rows: DataFrame, path: str, keys: Sequence[str], day: str, buckets: int = KEY_BUCKETS) -> None:
    """Append the rows whose key the table at ``path`` does not hold; doing it again adds nothing.

    The table is partitioned by day and key bucket. A key must always come with the same day, so its
    row can only lie in one folder, and only the folders that the new rows touch are read. Days come
    to the driver once each, at most ``buckets`` times the days of the new rows. Keys are compared with
    NULL equal to NULL. An append that was cut off halfway is completed by its repetition.
    """
    spark = rows.sparkSession
    fresh = rows.dropDuplicates(list(keys)).withColumn("key_bucket", key_bucket(keys, buckets))
    fresh.limit(0).write.mode("ignore").partitionBy(day, "key_bucket").parquet(path)  # makes the folder once
    fresh.persist()
    try:
        touched = [tuple(r) for r in fresh.select(day, "key_bucket").distinct().collect()]
        if touched:
            new, old = fresh.alias("new"), stored_keys(spark, path, fresh.schema, touched, keys, day).alias("old")
            same = reduce(Column.__and__, [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in dict.fromkeys([*keys, "key_bucket"])])
            new.join(old, same, "left_anti").write.mode("append").partitionBy(day, "key_bucket").parquet(path)
    finally:
        fresh.unpersist()


def merge_upsert(
    target: DataFrame, source: DataFrame, key: str, update: Sequence[str], insert: Sequence[str]
) -> DataFrame:
    """Matched rows take ``update`` columns from the source, unmatched source rows are added.

    ``key`` must be unique in the source.  The target is never shuffled for the sake of the insert
    side: its keys are first cut down to the source's by a semi join.
    """
    fresh = source.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in update])
    joined = target.join(fresh, key, "left")
    updated = joined.select(
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
          for c in target.columns]
    )
    known = target.select(key).join(source.select(key), key, "left_semi")
    added = source.join(known, key, "left_anti").select(*[c for c in target.columns if c in insert])
    return append_rows(updated, added)


# Profile columns that change only for female users.
WOMENS_COLUMNS = ("is_pregnant", "pregnancy_trimester", "menstrual_cycle_regular", "last_menstrual_period")


def patch_rows(
    target: DataFrame, patches: DataFrame, key: str, stamp: Column | None = None, gender: str | None = None,
    stamp_column: str = "last_updated",
) -> DataFrame:
    """Partial update: an attribute that is not supplied (NULL) keeps its value.

    Patched rows get the stamp.  Where the patch names a gender, women's-health columns change
    only for ``Female``.
    """
    columns = [c for c in patches.columns if c != key and c in target.columns]
    renamed = patches.select(
        key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns],
        *([F.col(gender).alias("_gender")] if gender else []),
    )
    joined = target.join(renamed, key, "left")

    def value(c: str) -> Column:
        if c in columns:
            new = F.col(f"_new_{c}")
            if gender and c in WOMENS_COLUMNS:
                new = F.when(F.col("_gender") == "Female", new)
            return F.coalesce(new, F.col(c)).alias(c)
        if stamp is not None and c == stamp_column:
            return F.when(F.col("_hit"), stamp).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return joined.select(*[value(c) for c in target.columns])


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Rows for which the condition does not hold; an unknown condition keeps the row."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def evolve(df: DataFrame, add: Mapping[str, str] | None = None, widen: Mapping[str, str] | None = None) -> DataFrame:
    """New columns are NULL; widened columns are cast."""
    return df.withColumns(
        {
            **{c: F.col(c).cast(t) for c, t in (widen or {}).items()},
            **{c: F.lit(None).cast(t) for c, t in (add or {}).items()},
        }
    )


def lookup_rows(df: DataFrame, **values: object) -> DataFrame:
    """Point lookup; values are literals, never spliced into SQL text."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in values.items()]))


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and row count of each table."""
    parts = [df.agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def starter_models(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The starter pair of models: ids with a NULL id among them, then the rows whose id is 1."""
    first = base.select(F.col(base.columns[0]).cast("int").alias("id"))
    return first, first.filter("id = 1")
