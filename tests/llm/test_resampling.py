"""Importance resampling against plain Python, on odd rows, ties and empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitalframe.llm import resampling
from vitalframe.llm.common import share_code

ODD = [
    (1, None), (2, ""), (3, "one two three four"), (3, "one two three four"), (None, "some words of a row without id " * 5), (4, "É漢字 x2 A-B c\x00d \x7f end"),
    (5, "long text with words " * 3000), (6, "Z" * 5000), (7, "the target speaks of rivers and of stones " * 4), (8, "..."), (9, "the target speaks of rivers and of stones " * 4),
]
TARGET = [(1, "the target speaks of rivers"), (2, None), (3, "rivers and stones")]


def features(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % resampling.BUCKETS for r in runs)


def brute(docs, target):
    s, t = Counter(), Counter()
    for rows, into in ((docs, s), (target, t)):
        for _, text in rows:
            into.update(features(text)[1])
    top, bottom = sum(s.values()) + resampling.BUCKETS, sum(t.values()) + resampling.BUCKETS
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * top / ((s[b] + 1) * bottom))) for b in range(resampling.BUCKETS)}
    out = []
    for i, text in docs:
        n, held = features(text)
        weight = sum(gain[b] * k for b, k in held.items())
        h = None if i is None else int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, sum(held.values()), weight, score, None])
    eligible = sorted((r for r in out if r[4] is not None and r[1] >= resampling.LEAST_WORDS), key=lambda r: (-r[4], r[0]))
    return out, eligible


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_equals_brute_force(spark, percent):
    share_code(spark)
    docs = spark.createDataFrame([(*r, 1, "a") for r in ODD], "doc_id long, text string, score int, range string").repartition(3)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    want, eligible = brute(ODD, TARGET)
    for place, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[5] = place
    got = resampling.resample(docs, target, percent=percent).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_ties_go_to_the_smaller_id_and_repeated_rows_are_drawn_each(spark):
    share_code(spark)
    rows = [(i, 30, 10, 5, 100) for i in range(50)] + [(7, 30, 10, 5, 100)] * 100 + [(90, 19, 1, 1, 999), (91, 30, 1, 1, 101)]
    scored = spark.createDataFrame(rows, "id long, n_words long, n_features long, weight long, score long").repartition(5)
    got = resampling.ranked(scored, percent=50).where(F.col("rank").isNotNull()).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 76))
    assert [r["id"] for r in got] == [91, *range(7), *[7] * 68][:75]


def test_empty_tables(spark):
    share_code(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(ODD, "doc_id long, text string")
    assert resampling.resample(none, some).count() == 0
    rows = resampling.resample(some, none, target_text="text").collect()
    want, _ = brute(ODD, [])
    assert Counter((r["doc_id"], r["weight"]) for r in rows) == Counter((r[0], r[3]) for r in want)


def test_long_texts_in_parts_keep_rows(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(resampling, "PART_CHARS", 20)
    texts = pa.array(["a b c d", None, "x" * 50, "", "p q", "r s t"])
    parts = [(start, part.to_pylist()) for start, part in resampling._parts(texts)]
    assert [t for _, part in parts for t in part] == texts.to_pylist() and [s for s, _ in parts] == [0, 2, 3]
