"""Both searches against brute force: shards, blocks, hot words, ties and odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalframe.operators import search


def brute_text(docs, queries, k):
    """docs: (key, user, domain, text); queries: (id, user, domain, text)."""
    words = lambda t: Counter(w for w in re.split("[^a-z0-9]+", (t or "").lower()) if w)
    bags = {d[0]: words(d[3]) for d in docs}
    found = Counter(w for b in bags.values() for w in b)
    idf = {w: math.log((len(docs) + 1) / (n + 1)) + 1 for w, n in found.items()}
    norm = lambda b: math.sqrt(sum((n * idf.get(w, 0.0)) ** 2 for w, n in b.items()))
    out = {}
    for q, user, domain, text in queries:
        asked = words(text)
        scored = []
        for key, u, d, _ in docs:
            shared = asked.keys() & bags[key].keys()
            if u == user and d == domain and user is not None and key != q and shared:
                dot = sum(asked[w] * bags[key][w] * idf[w] ** 2 for w in shared)
                scored.append((-round(dot / norm(asked) / norm(bags[key]), 6), key))
        out[q] = [(key, -s) for s, key in sorted(scored)[:k]]
    return {q: v for q, v in out.items() if v}


def talk(n, users, seed, common="the"):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(3000)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 14)))
        rows.append((f"c{i:04d}", f"u{0 if rng.random() < 0.5 else rng.randrange(users)}", "D", f"{common} {text}"))
    return rows + [("empty", "u0", "D", ""), ("null", "u0", "D", None), ("nobody", None, "D", "the w1"), ("same1", "u0", "D", "the w1 w2"), ("same2", "u0", "D", "the w1 w2")]


COLUMNS = "conversation_id string, user_id string, routed_to_domain string, text string"


@pytest.mark.parametrize(("shard_rows", "level_rows", "probe"), [(20_000, 1000, 10_000), (100, 60, 0), (37, 1, 50)])
def test_text_search_matches_brute_force(spark, shard_rows, level_rows, probe):
    docs = talk(500, 4, 5)
    corpus = spark.createDataFrame(docs, COLUMNS)
    index = search.text_index(corpus, "conversation_id", "text", shard_rows=shard_rows, level_rows=level_rows)
    asked = docs[:500:9] + docs[-5:] + [("new", "u0", "D", "unknown words only"), ("mixed", "u0", "D", "The W1 unknown w3")]
    queries = spark.createDataFrame(asked, "query_id string, user_id string, routed_to_domain string, query_text string")
    for k in (1, 3):
        got = defaultdict(list)
        for r in search.similar_by_text(queries, index, k, probe).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.conversation_id, r.score))
        assert {q: [key for key, _ in v] for q, v in got.items()} == {q: [key for key, _ in v] for q, v in brute_text(docs, asked, k).items()}


def test_blocks_that_cannot_reach_the_best_are_not_read(spark):
    """One word is in every text, one in few: the search must not read the common word's weak blocks."""
    docs = [(f"c{i:04d}", "u", "D", "the " + " ".join(f"x{i}y{j}" for j in range(1 + i % 40)) + (" rare" if i % 200 == 0 else "")) for i in range(2000)]
    index = search.text_index(spark.createDataFrame(docs, COLUMNS), "conversation_id", "text", shard_rows=3000, level_rows=10)
    asked = [("q", "u", "D", "the rare")]
    queries = spark.createDataFrame(asked, "query_id string, user_id string, routed_to_domain string, query_text string")
    read = search.blocks_to_read(queries, index, 3, 0).where("essential").join(index.blocks, ["user_id", "routed_to_domain", "shard", "term", "level"])
    held = {r.term: r.n for r in read.groupBy("term").agg(F.sum("held").alias("n")).collect()}
    assert "the" not in held and held["rare"] <= 10
    got = [(r.conversation_id, r.score) for r in search.similar_by_text(queries, index, 3, 0).orderBy("rank").collect()]
    assert got == [(key, pytest.approx(s, abs=1e-6)) for key, s in brute_text(docs, asked, 3)["q"]]


def test_many_words_meet_without_a_broadcast(spark, monkeypatch):
    docs = talk(200, 3, 8)
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(search, "COMMON_WORDS", 20)
    index = search.text_index(spark.createDataFrame(docs, COLUMNS), "conversation_id", "text", shard_rows=50, level_rows=5)
    assert 0 < index.words.where("common").count() <= 20
    queries = spark.createDataFrame(docs[:40], "query_id string, user_id string, routed_to_domain string, query_text string")
    got = defaultdict(list)
    for r in search.similar_by_text(queries, index, 3).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.conversation_id)
    assert got == {q: [key for key, _ in v] for q, v in brute_text(docs, docs[:40], 3).items()}


def test_empty_tables_find_nothing(spark):
    none = spark.createDataFrame([], COLUMNS)
    some = spark.createDataFrame(talk(5, 2, 1), COLUMNS)
    index = search.text_index(none, "conversation_id", "text")
    assert search.similar_by_text(some.select(F.col("conversation_id").alias("query_id"), "user_id", "routed_to_domain", F.col("text").alias("query_text")), index).count() == 0


@pytest.mark.parametrize(("shard_rows", "query_rows"), [(20_000, 2_000), (30, 7)])
def test_embedding_search_of_all_rows_matches_brute_force(spark, shard_rows, query_rows):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(260):
        vector = [float(x) for x in np.round(rng.normal(size=4), 1)]
        rows.append((f"d{i:03d}", "hot" if i % 2 else f"u{i % 6}", "D", vector))
    rows += [("zero", "hot", "D", [0.0] * 4), ("short", "hot", "D", [1.0, 2.0]), ("none", "hot", "D", None), ("alone", "one", "D", [1.0] * 4), ("nobody", None, "D", [1.0] * 4)]
    rows += [(f"copy{i}", "hot", "D", [0.5, 0.5, 0.5, 0.5]) for i in range(6)]
    corpus = spark.createDataFrame(rows, "conversation_id string, user_id string, routed_to_domain string, embedding array<double>")
    asked = corpus.select(F.col("conversation_id").alias("query_id"), "user_id", "routed_to_domain", F.col("embedding").alias("query_embedding"))
    got = defaultdict(list)
    for r in search.similar_by_embedding(asked, corpus, 4, shard_rows=shard_rows, query_rows=query_rows).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.conversation_id, r.score))

    def cos(a, b):
        if a is None or b is None or len(a) != len(b) or not any(a) or not any(b):
            return None
        return round(float(np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b))), 6)

    for key, user, _, vector in rows:
        scored = sorted(((cos(vector, v), other) for other, u, _, v in rows if u == user and user is not None and other != key), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
        want = [(other, s) for s, other in scored[:4]]
        assert [w[0] for w in want] == [g[0] for g in got[key]] and [w[1] for w in want] == pytest.approx([g[1] for g in got[key]], abs=1.1e-6), key


def test_words_are_counted_in_tasks_by_rows_and_cores(spark, monkeypatch):
    # short texts fit one task by their bytes
    monkeypatch.setattr(search, "TASK_ROWS", 100)
    docs = talk(2000, 4, 5)
    index = search.text_index(spark.createDataFrame(docs, COLUMNS), "conversation_id", "text")
    assert len(index.postings.inputFiles()) >= max(15, spark.sparkContext.defaultParallelism)
    assert {r["shard"] for r in index.postings.collect()} == {0}
