"""Shards along a Hilbert curve over several metadata dimensions, in DataFrame functions only.

Each dimension is quantised at its own quantiles, the cell gets its index on a Hilbert curve, rows are
sorted by index and the order is cut into runs of equal row counts. Neighbours on the curve are
neighbours in every dimension, so the files of a shard span narrow ranges of all of them and readers
can skip files by any.

The global place of a row comes from a range shuffle on (index, id, digest): rows are numbered inside
their partition and partition sizes, one row each, give the offsets. No window runs over all rows, and
a crowded cell is split by id.

Results for odd input: null text has no bytes; null metadata sorts first; equal rows are told apart by
their place in the input; an empty table gives no rows; extra columns pass through where asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.common import written

SHARDS = 24
BITS = 4
ACCURACY = 1000


def sortable(col: Column, kind: str) -> Column:
    """The value as texts or numbers are compared; null is the smallest."""
    return F.coalesce(col, F.lit("")) if kind == "string" else F.coalesce(col.cast("double"), F.lit(float("-inf")))


def text_cuts(df: DataFrame, dim: str, cells: int) -> list[str]:
    """Whole values of a text dimension that end its equal shares of the rows; exact, at most ``cells`` - 1.

    Distinct values are counted and dealt into ranges; ranges, one row each, give the offsets, and
    running counts stay inside a range. A value that many rows share is one row.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(sortable(F.col(dim), "string").alias("value")).agg(F.count("*").alias("rows"))
    # what is numbered must not be planned again, or the numbers might change
    ranges = written(counts.repartitionByRange(parts, "value").withColumn("part", F.spark_partition_id()), "values")
    everywhere, earlier = Window.partitionBy(), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("part").agg(F.sum("rows").alias("_size"))
    offsets = sizes.select("part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("before"), F.sum("_size").over(everywhere).alias("total"))
    running = F.sum("rows").over(Window.partitionBy("part").orderBy("value"))
    placed = ranges.withColumn("running", running).join(offsets, "part").withColumn("upto", F.col("before") + F.col("running"))
    ends = [F.min(F.when(F.col("upto") * cells >= F.col("total") * k, F.col("value"))).alias(str(k)) for k in range(1, cells)]
    return [cut for cut in placed.agg(*ends).first() if cut is not None]


def quantised(df: DataFrame, dims: Sequence[str], bits: int = BITS) -> Column:
    """Array of cells per row: how many of the dimension's quantile cuts lie below the value.

    Texts are compared as wholes, so values with a long common beginning get cells of their own.
    """
    kinds, cells = dict(df.dtypes), 1 << bits
    values = {d: sortable(F.col(d), kinds[d]) for d in dims}
    numeric = [d for d in values if kinds[d] != "string"]
    shares = [k / cells for k in range(1, cells)]
    cuts = {d: text_cuts(df, d, cells) for d in values if kinds[d] == "string"}
    if numeric:
        cuts |= zip(numeric, df.agg(*(F.percentile_approx(values[d], shares, ACCURACY).alias(str(k)) for k, d in enumerate(numeric))).first())
    # a value that many rows share gives equal cuts, which count once
    return F.array(*(sum((F.when(values[d] > F.lit(cut), 1).otherwise(0) for cut in sorted(set(cuts[d] or []))), F.lit(0)) for d in dims))


def with_hilbert_index(df: DataFrame, cells: str, dims: int, bits: int = BITS, out: str = "curve") -> DataFrame:
    """Add the place on the Hilbert curve of a cell array with the given number of bits per dimension.

    The exchanges and reflections of the curve run from the highest bit to the lowest over the array;
    every step is a column of its own, so that no expression is written out twice.
    """
    masks = [1 << q for q in range(bits - 1, -1, -1)]

    def literal(pairs: list[tuple[int, int]]) -> Column:
        return F.array(*(F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q, i in pairs))

    def turn(x: Column, s: Column) -> Column:
        low, at = s["q"] - 1, F.get(x, s["i"])
        swap = F.get(x, F.lit(0)).bitwiseXOR(at).bitwiseAND(low)
        first = F.lit(0)
        reflected = lambda v, k: F.when(k == first, v.bitwiseXOR(low)).otherwise(v)
        swapped = lambda v, k: F.when((k == first) | (k == s["i"]), v.bitwiseXOR(swap)).otherwise(v)
        return F.when(at.bitwiseAND(s["q"]) != 0, F.transform(x, reflected)).otherwise(F.transform(x, swapped))

    df = df.withColumn("_turned", F.aggregate(literal([(q, i) for q in masks[:-1] for i in range(dims)]), F.col(cells), turn) if bits > 1 else F.col(cells))
    # Gray code: each axis takes all axes before it
    upto = lambda k: F.aggregate(F.slice("_turned", F.lit(1), k + 1), F.lit(0), lambda acc, v: acc.bitwiseXOR(v))
    df = df.withColumn("_grey", F.transform("_turned", lambda v, k: upto(k)))
    last = F.element_at("_grey", -1)
    undo = F.lit(0)
    for q in masks[:-1]:
        undo = undo.bitwiseXOR(F.when(last.bitwiseAND(q) != 0, F.lit(q - 1)).otherwise(F.lit(0)))
    df = df.withColumn("_undo", undo).withColumn("_axes", F.transform("_grey", lambda v: v.bitwiseXOR(F.col("_undo"))))
    order = literal([(q, i) for q in masks for i in range(dims)])
    walk = lambda acc, s: acc * 2 + F.when(F.get("_axes", s["i"]).bitwiseAND(s["q"]) != 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return df.withColumn(out, F.aggregate(order, F.lit(0).cast("long"), walk)).drop("_turned", "_grey", "_undo", "_axes")


def shard(
    docs: DataFrame,
    dims: Sequence[str] = ("source", "lang", "size", "doc_id"),
    shards: int = SHARDS,
    carry: Sequence[str] = (),
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """id, size (bytes of the text plus 8), text_crc32, carried columns, curve, shard and slot.

    Row counts of shards differ by one at most. A dimension may be any column or "size".
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    wanted = dict.fromkeys(c for c in (id_col, *dims, *carry) if c != "size")
    rows = docs.select(*wanted, (F.length(content) + 8).cast("long").alias("size"), F.crc32(content).alias("text_crc32"), F.xxhash64(text).alias("_digest"))
    rows = written(rows, "metadata")
    placed = with_hilbert_index(rows.withColumn("_cells", quantised(rows, dims)), "_cells", len(dims))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (
        placed.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, "curve", id_col, "_digest", "_tie")
        .sortWithinPartitions("curve", id_col, "_digest", "_tie")
        .select(
            *dict.fromkeys([id_col, "size", "text_crc32", *carry, "curve"]),
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at"),
        )
    )
    # what is numbered must not be planned again, or the numbers might change
    numbered = written(sorted_rows, "curve-order")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_rows"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"), F.sum("_rows").over(Window.partitionBy()).alias("_total"))
    rank = F.col("_offset") + F.col("_at")
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return (
        numbered.join(offsets, "_part")
        .withColumn("_rank", rank)
        .withColumn("shard", F.expr(f"cast(_rank * {shards} div _total as int)"))
        .withColumn("slot", F.col("_rank") - first)
        .drop("_part", "_at", "_offset", "_total", "_rank")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **options) -> None:
    """Write whole rows as one folder per shard, in curve order inside."""
    placed = shard(docs, shards=shards, carry=docs.columns, **options)
    placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
