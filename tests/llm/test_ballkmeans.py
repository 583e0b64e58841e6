"""Product codes against plain exact k-means, on odd vectors, ties and empty tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vitalframe.llm import ballkmeans
from vitalframe.llm.common import share_code

SCHEMA = "vec_id long, embedding array<double>, label int, codes string"


def lloyd(rows, parts, entries, rounds):
    """Compare every part with every entry; rows are (id, integers, label)."""
    width = len(rows[0][1]) // parts
    x = np.array([r[1] for r in rows], dtype=object).reshape(len(rows), parts, width)
    order = sorted((r[0], tuple(r[1]), n) for n, r in enumerate(rows) if r[0] is not None)[:entries]
    books = [[list(x[n, p]) for _, _, n in order] for p in range(parts)]

    def assign():
        out = []
        for n in range(len(rows)):
            out.append([min((sum((a - b) ** 2 for a, b in zip(x[n, p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)])
        return out

    for _ in range(rounds):
        held = defaultdict(list)
        for n, found in enumerate(assign()):
            for p, (_, k) in enumerate(found):
                held[p, k].append(x[n, p])
        for (p, k), members in held.items():
            books[p][k] = [sum(m[c] for m in members) // len(members) for c in range(width)]
    final = assign()
    errors = [sum(d for d, _ in found) for found in final]
    by_label = defaultdict(int)
    for r, e in zip(rows, errors):
        by_label[r[2]] += e
    digest = hashlib.sha256(",".join(str(int(v)) for p in books for e in p for v in e).encode()).hexdigest()
    return Counter((r[0], bytes(k for _, k in found), e, by_label[r[2]]) for r, found, e in zip(rows, final, errors)), digest


def vectors(n, length, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [[float(v) for v in row] for row in np.round(rng.normal(0, spread, (n, length)), 2)]


def usable(rows):
    floored = lambda v: [int(np.floor(256 * x)) for x in v]
    return [(i, floored(v), label) for i, v, label, _ in rows]


@pytest.mark.parametrize(("n", "length", "parts", "entries", "rounds"), [(300, 12, 4, 16, 2), (40, 8, 2, 64, 3), (200, 6, 6, 8, 4), (120, 8, 4, 1, 2)])
def test_equals_exhaustive_k_means(spark, n, length, parts, entries, rounds):
    share_code(spark)
    rows = [(i, v, i % 3 or None, "x") for i, v in enumerate(vectors(n, length, n))]
    # repeated rows, ties among equal parts, null ids
    rows += [(5, [0.5] * length, None, None)] * 30 + [(1000 + i, [float(i % 2)] * length, 7, "x") for i in range(20)] + [(None, [0.25] * length, 1, "x")]
    got, books = ballkmeans.compress(spark.createDataFrame(rows, SCHEMA).repartition(4), parts, entries, rounds)
    want, digest = lloyd(usable(rows), parts, entries, rounds)
    assert Counter((r["id"], bytes(r["codes"]), r["error"], r["label_error"]) for r in got.collect()) == want
    assert books.digest() == digest


def test_rings_leave_out_work_but_no_winner():
    rng = np.random.default_rng(3)
    books = ballkmeans.Codebooks(rng.integers(-50, 50, (1, 40, 3)))
    x = rng.integers(-60, 60, (5000, 3))
    exact, d = books.first(0, x)
    for start in (exact, rng.integers(0, 40, len(x)), np.zeros(len(x), np.int64)):
        code, best = books.again(0, x, start)
        assert (code == exact).all() and (best == d).all()


def test_rows_that_take_no_part(spark):
    share_code(spark)
    good = [(i, v, 1, "x") for i, v in enumerate(vectors(20, 4, 1))]
    odd = [None, [], [1.0, None, 0.0, 0.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0] * 8, [1e15, 1e15, 0.0, 0.0], [1e300] * 4]
    rows = good + [(100 + n, v, 1, "x") for n, v in enumerate(odd)]
    got, _ = ballkmeans.compress(spark.createDataFrame(rows, SCHEMA), 2, 8)
    assert sorted(r["id"] for r in got.collect()) == list(range(20))
    edge = ballkmeans.limit(4) / ballkmeans.SCALE - 1
    got, books = ballkmeans.compress(spark.createDataFrame([(1, [edge] * 4, 1, ""), (2, [-edge] * 4, 1, "")], SCHEMA), 2, 1, 0)
    assert {r["id"]: r["error"] for r in got.collect()} == {1: 0, 2: 4 * int(2 * edge * ballkmeans.SCALE) ** 2}


def test_empty_tables_and_lengths_that_do_not_divide(spark):
    share_code(spark)
    got, books = ballkmeans.compress(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and books is None
    with pytest.raises(ValueError, match="equal parts"):
        ballkmeans.compress(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1, "x")], SCHEMA), 2)
