"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import vitalframe
from vitalframe.sources.tables import work_path

# ASCII white space of the text contracts: space, tab, line feed, vertical tab, form feed, return.
BLANKS = r"\x20\x09-\x0D"


# Texts differ in length by orders of magnitude: what a task hands to Python at once is bounded in
# rows and in bytes, so that long texts do not add up in either process. No row is left out.
BATCH_ROWS = 1_024
BATCH_BYTES = "8m"

HOT_KEYS = 1_000
SALTS = 64

_shared: set[str] = set()


def share_code(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once; they need not have it installed."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _shared:
        return
    package = os.path.dirname(os.path.abspath(vitalframe.__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="package-"), "vitalframe"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)
    _shared.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on a key that a few values may dominate on the left; null keys match nothing.

    Values with more than one part in HOT_KEYS of all rows, at most HOT_KEYS of them, are counted first
    and met in SALTS tasks each.
    """
    counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    every = counts.agg(F.sum("_n").alias("_every"))
    hot = counts.join(F.broadcast(every), F.col("_n") * HOT_KEYS > F.col("_every")).select(key, F.lit(SALTS).alias("_salts"))
    mark = lambda df: df.join(F.broadcast(hot), key, "left")
    salts = F.when(F.col(key).isNull(), SALTS).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = mark(left).withColumn("_salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int")).drop("_salts")
    copied = mark(right).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return spread.join(copied, [key, "_salt"], how).drop("_salt")


def words(text: Column) -> Column:
    """Runs of non-blank characters, in order; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
