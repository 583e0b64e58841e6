"""Merkle fingerprints against a plain Python tree, odd input and located edits."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitalframe.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def root_of(text):
    sections, now = [], []
    lines = (text or "").split("\n")
    for n, line in enumerate(lines):
        now.append(sha(line))
        if not line.encode().strip() or now[-1] < "4" or n == len(lines) - 1:
            sections.append(sha("".join(now)))
            now = []
    return sha("".join(sections))


def bag(text):
    return Counter(p for line in text.split("\n") for p in re.findall(merkle.PIECE, line))


def likeness(a, b):
    if root_of(a) == root_of(b):
        return 1.0
    x, y = bag(a), bag(b)
    n = sum(x.values()) + sum(y.values())
    return 2.0 * sum((x & y).values()) / n if n else 0.0


ODD = [
    (None, "null id"), (1, None), (2, ""), (3, "one"), (3, "one"), (3, "one"), (4, "a\n\n\nb \t\n"), (5, "é漢字 😀. More! end?"), (6, "A" * 50_000),
    (7, "word. " * 9_000), (8, "word. " * 9_001), (9, "\n"), (10, "\n\n"), (11, "x. y. z."), (11, "z. y. x."),
]


def expected(rows):
    order = sorted(((i is not None, i or 0, t or ""), i, t or "") for i, t in rows)
    out = Counter()
    # rows of equal id follow one another by digest, so only distinct ids are compared with their neighbour
    for n, (_, i, text) in enumerate(order):
        out[(i, len(text), root_of(text))] += 1
    return out


def test_odd_rows_equal_plain_python(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ODD], "doc_id long, text string, range int, _nodes string")
    rows = merkle.fingerprints(docs).collect()
    assert Counter((r["doc_id"], len(r["text"]), r["tree"]["root"]) for r in rows) == expected(ODD)
    for r in rows:
        assert r["edited_tree"]["root"] == root_of(r["edited_text"])
        assert r["to_edited"]["likeness"] == pytest.approx(likeness(r["text"], r["edited_text"]), abs=1e-12)
        assert r["to_edited"]["equal"] == (r["text"] == r["edited_text"])
        n, k = len(r["text"]), len(r["text"]) // merkle.SHARE
        assert r["edited_text"][: n - k] == r["text"][: n - k] and len(r["edited_text"]) <= n


def test_next_document_wraps_and_survives_repeated_rows(spark):
    base = [(i, f"text {i}") for i in range(40)]
    docs = spark.createDataFrame(base + [(20, "text 20")] * 300, "doc_id long, text string").repartition(7)
    got = Counter((r["doc_id"], r["next_text"]) for r in merkle.with_next(docs).collect())
    want = Counter({(i, f"text {(i + 1) % 40}"): 1 for i in range(40)})
    want[(20, "text 20")] = 300
    assert got == want


def test_one_row_and_no_rows(spark):
    one = merkle.fingerprints(spark.createDataFrame([(1, "abcd efgh")], "doc_id long, text string")).collect()
    assert [(r["edited_text"], r["to_next"]["likeness"]) for r in one] == [("abcd efab", 1.0)]
    assert merkle.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_differing_branches_hold_the_edit(spark):
    lines = [f"Paragraph {i} speaks of matter {i * i} at length." for i in range(40)]
    other = lines[:17] + ["A new one."] + [lines[17].replace("length", "leisure")] + lines[18:]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(other), 1)], "a string, b string, kept int")
    df = merkle.compare(merkle.with_tree(merkle.with_tree(df, "a", "ta"), "b", "tb"), "ta", "tb", "diff")
    r = df.first()
    d = r["diff"]
    before = sum(len(s["paragraphs"]) for s in r["ta"]["sections"][: d["section"]])
    assert not d["equal"] and before + d["paragraph"] == 17 and (d["paragraphs_a"], d["paragraphs_b"]) == (1, 2)
    assert d["sections_a"] < len(r["ta"]["sections"]) and r["kept"] == 1
    assert d["likeness"] == pytest.approx(likeness(r["a"], r["b"]), abs=1e-12) and d["likeness"] > 0.9


def test_inserted_paragraph_moves_no_far_boundary(spark):
    lines = [f"Line number {i} of the text." for i in range(200)]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(["Inserted first."] + lines))], "a string, b string")
    r = merkle.with_tree(merkle.with_tree(df, "a", "ta"), "b", "tb").select(
        F.transform(F.col("ta")["sections"], lambda s: s["digest"]).alias("x"), F.transform(F.col("tb")["sections"], lambda s: s["digest"]).alias("y")
    ).first()
    assert r["x"][2:] == r["y"][-len(r["x"]) + 2 :]
