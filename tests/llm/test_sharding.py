"""Cells of text dimensions against sorted lists, and what files of a shard span."""

import random

from pyspark.sql import functions as F

from vitalframe.llm import sharding


def cells_by_hand(values, cells):
    order = sorted((v or "" for v in values), key=lambda v: v.encode())
    cuts = {order[-(-len(order) * k // cells) - 1] for k in range(1, cells)}
    return [sum((v or "").encode() > c.encode() for c in cuts) for v in values]


def check(spark, values, bits):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string").repartition(5)
    got = {r.id: r.c[0] for r in df.select("id", sharding.quantised(df, ["v"], bits).alias("c")).collect()}
    assert got == dict(enumerate(cells_by_hand(values, 1 << bits)))
    return got


def test_cells_of_values_with_a_long_common_beginning(spark):
    rng = random.Random(3)
    values = [f"https://common.example/{rng.randrange(10**6):06d}" for _ in range(700)]
    assert set(check(spark, values, 3).values()) == set(range(8))


def test_cells_with_hot_null_empty_and_odd_values(spark):
    values = ["hot"] * 200 + [None] * 60 + [""] * 20 + ["\N{GRINNING FACE}" * 3, "￮", "z" * 50_000] + [f"k{i:03d}" for i in range(317)]
    check(spark, values, 4)
    check(spark, ["same"] * 9, 4)
    check(spark, ["b"], 2)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, lang string")
    assert sharding.text_cuts(df, "source", 16) == [] and sharding.shard(df).count() == 0


def test_shards_span_few_values(spark):
    docs = spark.range(4800).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"),
        F.format_string("https://common.example/%04d", (F.col("id") * 7919) % 4800).alias("source"),
    )
    placed = sharding.shard(docs, dims=("source", "size"), shards=8, carry=["source"])
    spans = placed.groupBy("shard").agg(F.min("source").alias("lo"), F.max("source").alias("hi"), F.count("*").alias("n")).collect()
    assert {r.n for r in spans} == {600}
    assert max(int(r.hi[-4:]) - int(r.lo[-4:]) for r in spans) < 2 * 600


def test_bytes_and_checksums_of_texts(spark):
    import zlib

    texts = ["", None, "é" * 3, "a\nb", "\N{GRINNING FACE}"]
    docs = spark.createDataFrame([(i, t, "s", "l") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")
    out = {r.doc_id: (r.size, r.text_crc32) for r in sharding.shard(docs, shards=2).collect()}
    assert out == {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in enumerate(texts)}
