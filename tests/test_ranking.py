"""Exact ranks, samples and splits, with one group that holds most rows."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitalframe.operators import cleaning, ranking, sampling
from vitalframe.operators import context as ctx
from vitalframe.operators import search


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows; two thirds carry the same label."""
    return spark.range(2000).select(
        F.format_string("k%05d", "id").alias("key"),
        F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 2 == 0, "warm").otherwise("cold").alias("label"),
        (F.col("id") % 7).alias("v"),
    )


def test_ranked_equals_sorted_position(skewed):
    bucket = F.col("v").cast("string")
    out = ranking.ranked(skewed, ["label"], ["v", "key"], bucket, "rank", "total").collect()
    by_label = {}
    for row in out:
        by_label.setdefault(row.label, []).append(row)
    assert sum(len(x) for x in by_label.values()) == 2000
    for rows in by_label.values():
        rows.sort(key=lambda x: (x.v, x.key))
        assert [x["rank"] for x in rows] == list(range(1, len(rows) + 1))
        assert {x.total for x in rows} == {len(rows)}


def test_null_groups_and_buckets_are_kept(spark):
    rows = [(None, None, 1), (None, "2024-01-01", 2), (None, "2024-01-02", 3), ("a", None, 4), ("a", "2024-01-01", 5)]
    df = spark.createDataFrame(rows, "g string, d string, i int")
    out = {r.i: r["rank"] for r in ranking.ranked(df, ["g"], ["d", "i"], F.col("d")).collect()}
    assert out == {1: 1, 2: 2, 3: 3, 4: 1, 5: 2}


def test_surrogate_ids_are_dense_and_stable(skewed):
    ids = [r.patient_id for r in ranking.surrogate_id(skewed, "P_", ["key", "label"]).collect()]
    again = {r.key: r.patient_id for r in ranking.surrogate_id(skewed.repartition(7), "P_", ["key", "label"]).collect()}
    assert sorted(int(i[2:]) for i in ids) == list(range(1, 2001))
    assert again == {r.key: r.patient_id for r in ranking.surrogate_id(skewed, "P_", ["key", "label"]).collect()}


def test_time_ids_rise_with_time_and_put_null_last(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 10 != 0, F.timestamp_seconds(1_600_000_000 + (F.col("id") % 50) * 3600)).alias("ts"),
        F.col("id").cast("string").alias("k"),
    )
    rows = ranking.surrogate_id_by_time(df, "M_", "ts", ["k"]).collect()
    rows.sort(key=lambda r: int(r.patient_id[2:]))
    assert [int(r.patient_id[2:]) for r in rows] == list(range(1, 501))
    times = [r.ts for r in rows]
    known = [t for t in times if t is not None]
    assert known == sorted(known) and times[len(known):] == [None] * 50


def test_ids_by_time_with_half_of_all_times_missing(spark):
    df = spark.range(4000).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 2 == 0, F.timestamp_seconds(F.col("id") % 6)).alias("ts")
    ).repartition(6)
    rows = sorted(ranking.surrogate_id_by_time(df, "M_", "ts", ["k"]).withColumn("h", ranking.row_hash(["k"])).collect(), key=lambda r: int(r.patient_id[2:]))
    assert [int(r.patient_id[2:]) for r in rows] == list(range(1, 4001))
    order = [(r.ts is None, r.ts or dt.datetime.min, r.h) for r in rows]
    assert order == sorted(order) and sum(r.ts is None for r in rows) == 2000


def test_stratified_sample_hits_targets(skewed):
    targets = {r.label: r.target for r in sampling.class_targets(skewed, "label", 300).collect()}
    out = sampling.stratified_sample(skewed, "label", 300, "key", 5).collect()
    assert Counter(r.label for r in out) == Counter(targets)
    assert len({r.key for r in out}) == len(out)
    again = sampling.stratified_sample(skewed.repartition(5), "label", 300, "key", 5).collect()
    assert {r.key for r in again} == {r.key for r in out}
    other = sampling.stratified_sample(skewed, "label", 300, "key", 6).collect()
    assert {r.key for r in other} != {r.key for r in out}


def test_sample_larger_than_data_keeps_all(skewed):
    assert sampling.stratified_sample(skewed, "label", 10_000, "key").count() == 2000


def test_null_labels_are_not_sampled(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "key string, label string")
    assert [r.key for r in sampling.stratified_sample(df, "label", 5, "key").collect()] == ["b"]


def test_split_shares_per_class(skewed):
    out = sampling.stratified_split(skewed, "label", [("train", 7), ("val", 2), ("test", 1)], "key", 1).collect()
    count = Counter((r.label, r.split) for r in out)
    for label, n in Counter(r.label for r in out).items():
        assert abs(count[label, "train"] - 0.7 * n) <= 1 and abs(count[label, "val"] - 0.2 * n) <= 1
    assert len(out) == 2000


def test_hash_split_is_a_partition(skewed):
    train, valid = sampling.hash_split(skewed, "key")
    assert train.count() + valid.count() == 2000 and 0.75 < train.count() / 2000 < 0.85
    assert train.join(valid, "key").count() == 0


def test_dedupe_keeps_one_deterministic_row(spark):
    rows = [("a", 1, None), ("a", 1, 5), ("a", 1, 2), (None, 1, 3), (None, 1, 3)] + [("hot", 9, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, j int, x int").repartition(6)
    out = {(r.k, r.j): r.x for r in cleaning.dedupe(df, ["k", "j"]).collect()}
    assert out == {("a", 1): None, (None, 1): 3, ("hot", 9): 0}


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = cleaning.dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keyword_fallback_matches_brute_force(spark):
    """Every message asks; one session holds most of a user's history."""
    words = ["my bp is high", "blood pressure again", "blood sugar up", "glucose and bp", "cholesterol today", "hello"]
    rows = []
    for i in range(240):
        session = "big" if i % 3 else f"s{i % 4}"
        rows.append((f"c{i:03d}", f"u{i % 2}", session, "D", words[(i * 7) % 6] + " and blood pressure" * (i % 2), i))
    history = spark.createDataFrame(
        rows, "conversation_id string, user_id string, session_id string, routed_to_domain string, user_message string, n int"
    ).select(
        "*", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n") * 60).alias("message_timestamp"), F.lit("ok").alias("assistant_response")
    )
    asked = history.select(
        F.col("conversation_id").alias("query_id"), "user_id", "session_id", "routed_to_domain",
        F.col("user_message").alias("query_text"),
    )
    got = {}
    for r in ctx.keyword_fallback(asked, history).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.conversation_id))
    from vitalframe.functions.vocab import SEARCH_TOPICS

    expected = {}
    for cid, user, session, _, text, _ in rows:
        topics = [t for t, ws in SEARCH_TOPICS.items() if any(w in text for w in ws)]
        hits = [
            o for o in rows if o[1] == user and o[2] != session and any(t in o[4] for t in topics)
        ]
        hits.sort(key=lambda o: (-o[5], o[0]))
        if hits:
            expected[cid] = [(i + 1, o[0]) for i, o in enumerate(hits[:3])]
    assert {k: sorted(v) for k, v in got.items()} == expected


def test_embedding_search_matches_brute_force(spark):
    import math
    import random

    rng = random.Random(1)
    docs = [(f"d{i}", f"u{i % 3}", "D", [rng.random() for _ in range(4)]) for i in range(60)]
    corpus = spark.createDataFrame(docs, "conversation_id string, user_id string, routed_to_domain string, embedding array<double>")
    asked = corpus.filter(F.col("conversation_id").isin("d0", "d1", "d2")).select(
        F.col("conversation_id").alias("query_id"), "user_id", "routed_to_domain", F.col("embedding").alias("query_embedding")
    )
    got = {(r.query_id, r["rank"]): r.conversation_id for r in search.similar_by_embedding(asked, corpus, 3).collect()}

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    for q in docs[:3]:
        ranked = sorted((d for d in docs if d[1] == q[1] and d[0] != q[0]), key=lambda d: -cos(q[3], d[3]))
        assert [got[q[0], i + 1] for i in range(3)] == [d[0] for d in ranked[:3]]


def test_past_talks_prefer_similar_ones(spark):
    """A request that is similar to something in the index gets that; any other what the key words find."""
    rows = [
        ("old", "u", "s1", "D", "blood sugar was fine", "2023-01-01 10:00:00"),
        ("older", "u", "s1", "D", "blood sugar was high", "2022-01-01 10:00:00"),
        ("new", "u", "s2", "D", "walking helps", "2024-01-30 10:00:00"),
        ("other", "v", "s3", "D", "glucose and walking", "2024-01-30 10:00:00"),
    ]
    history = spark.createDataFrame(
        rows, "conversation_id string, user_id string, session_id string, routed_to_domain string, user_message string, at string"
    ).select("*", F.to_timestamp("at").alias("message_timestamp"), F.lit("ok").alias("assistant_response"))
    asked = spark.createDataFrame(
        [("q1", "u", "s9", "D", "walking with glucose"), ("q2", "u", "s9", "D", "glucose"), ("q3", "u", "s9", "D", "hello")],
        "query_id string, user_id string, session_id string, routed_to_domain string, query_text string",
    )
    got = {}
    index = ctx.past_index(history, dt.date(2024, 2, 1))
    for r in ctx.past_talks(asked, history, index).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.conversation_id))
    assert {k: sorted(v) for k, v in got.items()} == {"q1": [(1, "new")], "q2": [(1, "old"), (2, "older")]}


def test_distinct_rows_are_numbered_in_one_shuffle(spark, monkeypatch):
    """The ids of a table made distinct first, with NULL keys, negative zeros and a key that holds most rows."""
    rows = [(f"c{i % 40}" if i % 7 else None, float(i % 11) * (-1.0 if i % 11 == 0 else 1.0), i % 5) for i in range(600)] + [("hot", 0.0, i) for i in range(900)]
    df = spark.createDataFrame(rows, "a string, b double, rest int")
    same = df.withColumn("b", F.col("b") + F.lit(0.0))
    expect = sorted(map(str, ranking.surrogate_id(cleaning.dedupe(same, ["a", "b"]), "P_", ["a", "b"]).collect()))
    assert len(expect) == len({(a, b) for a, b, _ in rows})
    for hot, task in ((100_000, 1_000_000), (3, 100), (0, 7)):
        monkeypatch.setattr(ranking, "HOT_ROWS", hot)
        monkeypatch.setattr(ranking, "TASK_ROWS", task)
        out = ranking.distinct_surrogate_id(df, ["a", "b"], "P_", ["a", "b"])
        assert sorted(map(str, out.select("a", "b", "rest", "patient_id").collect())) == expect
    monkeypatch.setattr(ranking, "HOT_ROWS", 100_000)
    out = ranking.distinct_surrogate_id(df, ["a", "b"], "P_", ["a", "b"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    # the rows, the same rows to be counted (reused), and the table of buckets
    assert moved and all("hashpartitioning(_bucket" in line for line in moved), moved
    none = ranking.distinct_surrogate_id(df.limit(0), ["a", "b"], "P_", ["a", "b"])
    assert none.count() == 0
