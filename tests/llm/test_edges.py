"""Line runs, label samples, repeated vectors and weak supervision against plain versions; clashing names."""

import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalframe.llm import balltree, licences, lines, quality, toxicity
from vitalframe.llm.common import share_code, spread_join, table


# --- line runs ----------------------------------------------------------------------------------
def kept_lines(docs, least_chars=40, least_docs=5):
    strip = " \t\n\x0b\f\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(lower)
    holders = defaultdict(list)
    for i, text in docs:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= least_chars:
                holders[k].append(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= least_docs}
    return {i: "\n".join(line for line in (text or "").split("\n") if i >= gone.get(key(line), i)) for i, text in docs}


@pytest.mark.parametrize("batches", [1, 6])
def test_lines_against_brute_force(spark, batches):
    """A line in every document, lines around the least number of documents, and own lines."""
    rng = np.random.default_rng(2)
    pool = [f"shared line number {n} that is certainly long enough to count" for n in range(60)]
    docs = []
    for i in range(400):
        own = [f"a line of document {i} alone, with a good many words in it", "short", pool[0]]
        own += [pool[int(n)] for n in rng.zipf(1.4, 4) if n < 60]
        docs.append((i, "\n".join(rng.permutation(own))))
    docs += [(400, None), (401, "")]
    got = lines.drop_repeated(spark.createDataFrame(docs, "doc_id long, text string"), batches=batches).collect()
    assert {r["doc_id"]: r["kept_text"] for r in got} == kept_lines(docs)


def test_runs_hold_a_key_once(spark):
    """Whatever the order of batches, a key is in the run that brought it, and totals count all of them."""
    store = lines.LineRuns(spark, fan_out=2)
    batches = [[(1, 2, 5), (2, 1, 9)], [(2, 4, 3), (3, 1, 1)], [(1, 1, 8), (4, 1, 4)], [(2, 1, 20), (3, 1, None)], []]
    for batch in batches:
        store.add(spark.createDataFrame([(bytes([k]), d, i) for k, d, i in batch], "key binary, docs long, last_id long"))
    keys = [r["key"] for run in store.runs() for r in run.collect()]
    assert sorted(map(bytes, keys)) == [bytes([k]) for k in (1, 2, 3, 4)]
    assert {(r["key"][0], r["docs"], r["last_id"]) for r in store.totals().collect()} == {(1, 3, 8), (2, 6, 20), (3, 2, 1), (4, 1, 4)}
    assert max(map(len, store.levels)) < 2 and sum(len(i.collect()) for i in store.increments) == 4


def test_names_of_the_operators_own(spark):
    docs = spark.createDataFrame([(1, "some words here", 11, 12, 13, 14)], "doc_id long, text string, _words long, _lines long, _id long, _row long")
    names = ("_words", "_lines", "_id", "_row", "doc_id")
    for made in (lines.drop_repeated(docs, keep=names), quality.judge_documents(docs, keep=names)):
        assert [made.first()[c] for c in names] == [11, 12, 13, 14, 1]


# --- top-k --------------------------------------------------------------------------------------
def test_top_k_repeats_ties_and_long_vectors(spark):
    rows = [(0, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])] + [(9, [2.0, 2.0])] * 3
    rows += [(20, [1e15, 1e15]), (21, [1e300, 0.0]), (22, [1.0, 1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("copies", F.lit(5)).withColumn("score", F.lit(1))
    for shard_rows in (2, 100):
        got = balltree.top_k(docs, F.col("vec_id") == 0, k=5, shard_rows=shard_rows).orderBy("rank").collect()
        assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [
            (1, 9, 4 << 20), (2, 9, 4 << 20), (3, 9, 4 << 20), (4, 3, 2 << 20), (5, 1, 1 << 20)]
    assert balltree.top_k(docs.where("false"), F.col("vec_id") == 0).count() == 0
    # products near 64 bits are exact
    big = 2.0**20
    near = spark.createDataFrame([(0, [big, 1.0]), (1, [big, 3.0]), (2, [big, 2.0])], "vec_id long, embedding array<double>")
    scores = {r["vec_id"]: r["score"] for r in balltree.top_k(near, F.col("vec_id") == 0).collect()}
    assert scores == {1: (1 << 60) + 3 * (1 << 20), 2: (1 << 60) + 2 * (1 << 20)}


# --- toxicity sample ----------------------------------------------------------------------------
def test_sample_is_the_smallest_digests(spark, sf):
    share_code(spark)
    docs, labels = table(spark, sf, "documents").withColumn("range", F.lit(1)), table(spark, sf, "labels")
    for rows in (1, 40, 10_000):
        got = Counter(map(tuple, toxicity.labelled_sample(docs, labels, rows).collect()))
        known = labels.where(toxicity.fold(F.col("doc_id")) != toxicity.HELD_OUT).select("doc_id", "toxic", F.xxhash64("doc_id").alias("d")).collect()
        texts = dict(docs.select("doc_id", "text").collect())
        expect = set()
        for label in (0, 1):
            of_class = sorted((r["d"], r["doc_id"]) for r in known if r["toxic"] == label)[:rows]
            expect |= {(texts[i], label) for _, i in of_class if i in texts}
        assert set(got) == expect and set(got.values()) <= {1}


# --- weak supervision ---------------------------------------------------------------------------
def plain_estimate(patterns):
    """Expectation maximisation as a loop over documents' vote patterns."""
    n = len(next(iter(patterns)))
    share, good, bad = quality.FIRST_SHARE, [quality.FIRST_ON_GOOD] * n, [quality.FIRST_ON_BAD] * n
    for _ in range(quality.ROUNDS):
        p = {}
        for votes in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(good[j][v + 1] / bad[j][v + 1]) for j, v in enumerate(votes))
            p[votes] = 1 / (1 + math.exp(-odds))
        g = sum(docs * p[v] for v, docs in patterns.items())
        every = sum(patterns.values())
        prior = quality.PRIOR_DOCS

        def shares(weight, total, first):
            return [tuple((sum(weight(v) for v in patterns if v[j] == x - 1) + prior * first[x]) / (total + prior) for x in range(3)) for j in range(n)]

        new = ((g + prior * quality.FIRST_SHARE) / (every + prior),
               shares(lambda v: patterns[v] * p[v], g, quality.FIRST_ON_GOOD), shares(lambda v: patterns[v] * (1 - p[v]), every - g, quality.FIRST_ON_BAD))
        flat = lambda k: [k[0], *(x for side in k[1:] for rule in side for x in rule)]
        moved = max(abs(a - b) for a, b in zip(flat((share, good, bad)), flat(new)))
        share, good, bad = new
        if moved < quality.SETTLED:
            break
    return share, good, bad


def test_posterior_against_a_plain_loop(spark):
    rng = np.random.default_rng(6)
    n = len(quality.votes(F.col("m")))
    rows = []
    for k in range(1500):
        fine = k % 4 != 0
        rows.append((k, [int(v) for v in rng.choice((-1, 0, 1), n, p=(0.05, 0.25, 0.7) if fine else (0.5, 0.3, 0.2))]))
    voted = spark.createDataFrame(rows, "doc_id long, votes array<int>")
    judge = quality.estimate(voted)
    share, good, bad = plain_estimate(Counter(tuple(v) for _, v in rows))
    assert abs(judge.share - share) < 1e-9 and np.allclose(judge.on_good, good) and np.allclose(judge.on_bad, bad)
    p = dict(voted.select("doc_id", quality.posterior([F.col("votes")[j] for j in range(n)], judge)).collect())
    assert sum((p[k] >= 0.5) == (k % 4 != 0) for k in p) > 0.97 * len(rows)


def test_verdicts_agree_with_the_labels(spark):
    """Of documents past the base test, good ones are far more often kept than bad ones."""
    sf = "/root/testdata/sf0.01"
    judged = quality.judge_documents(table(spark, sf, "documents")).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    rows = judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).orderBy("quality").collect()
    print([(r["quality"], round(r["kept"], 3), r["n"]) for r in rows])
    assert rows[-1]["kept"] > rows[0]["kept"] + 0.2


# --- licences -----------------------------------------------------------------------------------
SYSTEM = "/usr/share/common-licenses"
KNOWN = {"Apache-2.0": "Apache-2.0", "GPL-3": "GPL-3.0", "GPL-2": "GPL-2.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "BSD": "BSD-3-Clause"}


def in_lines(text, width=70, prefix=""):
    rows, row = [], ""
    for word in text.split():
        if len(row) + len(word) > width:
            rows.append(row)
            row = ""
        row += f" {word}" if row else word
    return "\n".join(prefix + r for r in [*rows, row])


def test_whole_licence_files_are_found_and_inherited(spark, sf):
    """Beside a corpus, whose texts make the document frequencies."""
    mit, bsd = dict(licences.FILE_TEMPLATES)["MIT"], dict(licences.FILE_TEMPLATES)["BSD-3-Clause"]
    texts = {"MIT": "MIT License\n\nCopyright (c) 2019 Some One\n\n" + in_lines(mit.split(". ", 1)[1]), "BSD-3-Clause": "Copyright (c) 2001, A University\n" + in_lines(bsd)}
    for name, licence in KNOWN.items():
        if os.path.exists(f"{SYSTEM}/{name}"):
            texts[licence] = open(f"{SYSTEM}/{name}", encoding="utf-8").read()
    rows, expect = [], {}
    for n, (licence, text) in enumerate(texts.items()):
        rows += [(10 * n, f"{licence}/LICENSE", text), (10 * n + 1, f"{licence}/src/deep/x.py", "print(1)\n"), (10 * n + 2, f"{licence}/y.py", None)]
        expect |= {10 * n: (licence, "own"), 10 * n + 1: (licence, "inherited"), 10 * n + 2: (licence, "inherited")}
    # a header over several comment lines, a novel that mentions a licence, and a reserved right beside a licence
    head = in_lines("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.", 50, "# ")
    novel = " ".join(f"they walked along road {k} and spoke of the weather" for k in range(60)) + ". He had lost his driving licence in June."
    rows += [(1000, "p/a.py", head + "\n\nimport os\n" + "x = compute(y)\n" * 80), (1001, "p/b.txt", novel), (1002, "p/c.txt", "Copyright. All rights reserved.\nReleased under the MIT License.\n" + novel)]
    expect |= {1000: ("MIT", "own"), 1001: (None, "none"), 1002: ("MIT", "own")}
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    corpus = table(spark, sf, "documents").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(None).cast("string").alias("path"), "text")
    found = licences.scan(docs.unionByName(corpus), F.col("path")).where("doc_id >= 0").collect()
    assert {r["doc_id"]: (r["licence"], r["origin"]) for r in found} == expect


def test_cosines_against_numpy(spark):
    """Scores of lines and whole texts by dense vectors over all terms."""
    texts = ["Released under the MIT License", "licensed under the apache license version 2.0 today", "plain words only", dict(licences.FILE_TEMPLATES)["ISC"], "the the software licence", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    split = lambda t: [w for w in re.split(licences.TERM_BREAK, (t or "").lower()) if w]
    held = [set(split(t)) for t in texts]
    vocabulary = {r[3] for r in licences._template_terms()}
    idf = lambda w: math.log((1 + len(texts)) / (1 + (sum(w in h for h in held) if w in vocabulary else 0))) + 1

    def vector(text, damped):
        return {w: (1 + math.log(n) if damped else n) * idf(w) for w, n in Counter(split(text)).items()}

    def cosine(a, b):
        size = lambda v: math.sqrt(sum(x * x for x in v.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / (size(a) * size(b)) if a else 0

    got = {r["doc_id"]: r["score"] for r in licences.scan(docs, F.lit(None).cast("string")).collect()}
    for i, text in enumerate(texts):
        whole = max(cosine(vector(text, True), vector(t, True)) for _, t in licences.FILE_TEMPLATES)
        line = max(cosine(vector(text, False), vector(t, False)) for _, t in licences.TEMPLATES)
        expect = whole if whole >= licences.FILE_THRESHOLD else line if line >= licences.THRESHOLD and i != 2 else None
        assert (got[i] is None) == (expect is None) and (expect is None or abs(got[i] - expect) < 1e-6), (i, got[i], whole, line)


def test_spread_join_equals_join(spark):
    left = spark.createDataFrame([(k, "hot" if k % 3 == 0 else None if k % 7 == 0 else f"k{k}") for k in range(400)], "n long, name string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4)], "name string, v long")
    for how in ("inner", "left"):
        assert Counter(map(tuple, spread_join(left, right, "name", how).select("n", "name", "v").collect())) == Counter(map(tuple, left.join(right, "name", how).select("n", "name", "v").collect()))
