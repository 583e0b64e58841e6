"""Vector code compression: product codes whose codebooks come from exact ball k-means.

Vectors become integers and are cut into equal parts; each part position has a codebook of entries. An
entry and the parts assigned to it form a ball. Only entries whose distance from a ball's centre is at
most twice the ball's radius can own one of its parts: the ball's neighbours. A part that is nearer
to its entry than half the way to the nearest other entry lies in the stable core and is not looked at
again. The neighbours, ordered by distance, cut the rest of the ball into rings: a part in a ring is
compared exactly with the neighbours that the ring reaches and with no others. All distances are
squared integers and ties count as reached, so the result is that of comparing everything.

Every round is one pass over the vectors: a task codes its rows and adds up its parts per entry, sums
meet in an aggregate, and one row per entry and component, bounded by the parameters, comes to the
driver as the next codebooks. Codes are kept with the vectors in a written table for the next round.

Results for odd input: rows whose vector is null or empty, or holds null or non-finite components,
take no part; nor do rows of another length than the most common one, or with a component so large that an error
might pass 64 bits (``limit``); a length that the parts do not divide is refused with a ValueError; null
ids are coded, but start no entry; repeated rows are coded, and count, each; with fewer rows than
entries the codebooks are shorter; an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
# A label above one row in so many is joined by a broadcast of at most as many rows.
HOT_SHARE = 64
# Rows handled together, and part components compared together, in one task.
BLOCK_ROWS = 8_192
BLOCK_NUMBERS = 1 << 22


def limit(length: int) -> int:
    """Components stay below this, so that four times the squared distance of two whole vectors fits 62 bits."""
    return math.isqrt(2**58 // max(1, length))


def _floored(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(SCALE * x.cast("double")))


def usable(table: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label") -> tuple[DataFrame, int]:
    """id, label and v (integers) of the rows that take part, and the length of their vectors."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = table.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = rows.where((F.size("vector") > 0) & finite)
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    length = common["length"] if common else 0
    bound = float(limit(length))
    small = F.forall("vector", lambda x: F.abs(SCALE * x.cast("double")) < bound)
    return rows.where((F.size("vector") == length) & small).select("id", "label", _floored(F.col("vector")).alias("v")), length


@dataclass
class Codebooks:
    """Entries as array (part, entry, component), with what rounds on them need."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        e = self.entries
        gap = ((e[:, :, None, :] - e[:, None, :, :]) ** 2).sum(-1)
        n = e.shape[1]
        # an entry is not its own neighbour
        gap[:, np.arange(n), np.arange(n)] = np.iinfo(np.int64).max
        self.near = np.argsort(gap, axis=2, kind="stable")[:, :, : n - 1]
        self.gaps = np.take_along_axis(gap, self.near, axis=2)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def first(self, part: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every row by comparing all, and its distance."""
        code, best = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        for entry, centre in enumerate(self.entries[part]):
            d = ((x - centre) ** 2).sum(1)
            nearer = d < best
            code[nearer], best[nearer] = entry, d[nearer]
        return code, best

    def again(self, part: int, x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every row, given any earlier one, by stable cores, neighbours and rings."""
        own = ((x - self.entries[part][code]) ** 2).sum(1)
        gaps, near = self.gaps[part], self.near[part]
        if not gaps.shape[1]:
            return code, own
        code, best = code.copy(), own.copy()
        moving = np.flatnonzero(4 * own >= gaps[code, 0])
        # a ball's radius names its neighbours; no ring is wider than the widest ball's list
        radius = np.zeros(len(gaps), np.int64)
        np.maximum.at(radius, code, own)
        width = int((gaps <= 4 * radius[:, None]).sum(1).max())
        step = max(1, BLOCK_NUMBERS // max(1, width * x.shape[1]))
        for at in range(0, len(moving), step):
            rows = moving[at : at + step]
            mine = code[rows]
            reach = (gaps[mine, :width] <= 4 * own[rows, None]).sum(1)
            starts = np.cumsum(reach) - reach
            row = np.repeat(np.arange(len(rows)), reach)
            ring = np.arange(len(row)) - np.repeat(starts, reach)
            rival = near[mine[row], ring]
            d = ((x[rows[row]] - self.entries[part][rival]) ** 2).sum(1)
            least = np.minimum.reduceat(d, starts)
            # among the nearest, the lowest index
            winner = np.minimum.reduceat(np.where(d == np.repeat(least, reach), rival, len(gaps)), starts)
            better = (least < own[rows]) | ((least == own[rows]) & (winner < mine))
            best[rows[better]], code[rows[better]] = least[better], winner[better]
        return code, best


def seeds(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The vectors of the smallest ids as first entries."""
    first = rows.where(F.col("id").isNotNull()).orderBy("id", "v").limit(entries).select("v").collect()
    whole = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, length // parts)
    return Codebooks(whole.transpose(1, 0, 2).copy())


def _blocks(batches: Iterator[pa.RecordBatch], first: bool, parts: int, width: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray | None]]:
    """Rows in blocks: the batch, vectors as (row, part, component), and the codes of the last round."""
    held: list[pa.RecordBatch] = []

    def block():
        t = pa.Table.from_batches(held)
        v = np.frombuffer(b"".join(t.column("v").to_pylist()), np.int32) if not first else pc.list_flatten(t.column("v")).combine_chunks().to_numpy()
        x = v.reshape(t.num_rows, parts, width).astype(np.int64)
        codes = None if first else np.frombuffer(b"".join(t.column("codes").to_pylist()), np.uint8).reshape(t.num_rows, parts).astype(np.int64)
        return t, x, codes

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // (parts * width))):
            yield block()
            held = []
    if held:
        yield block()


def code(rows: DataFrame, books: Codebooks, last: bool) -> DataFrame:
    """Code every row against the codebooks, in one pass.

    Rows with integer arrays ``v`` are compared with all entries, rows of an earlier pass by ball
    k-means. All but the last pass hand on v and codes, and behind a task's rows one row per used
    entry and component with count and sum (part, entry, place, n, total); the last gives codes and error.
    """
    first = "codes" not in rows.columns
    parts, entries, width = books.entries.shape
    id_kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    names = ["id", "label", "v", "codes", "error", "part", "entry", "place", "n", "total"]
    kinds = [None, None, pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    schema = f"id {id_kind}, label {label_kind}, v binary, codes binary, error long, part int, entry int, place int, n long, total long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((parts, entries), np.int64)
        totals = np.zeros((parts, entries, width), np.int64)
        own_kinds: list[pa.DataType] = []
        for t, x, old in _blocks(batches, first, parts, width):
            own_kinds = [t.column("id").type, t.column("label").type]
            codes, error = np.zeros((len(x), parts), np.int64), np.zeros(len(x), np.int64)
            for p in range(parts):
                found, d = books.first(p, x[:, p]) if old is None else books.again(p, x[:, p], old[:, p])
                codes[:, p] = found
                error += d
                if not last:
                    held[p] += np.bincount(found, minlength=entries)
                    np.add.at(totals[p], found, x[:, p])
            packed = [r.tobytes() for r in codes.astype(np.uint8)]
            vectors = [None] * len(x) if last else [r.tobytes() for r in x.reshape(len(x), -1).astype(np.int32)]
            nothing = [pa.nulls(len(x), k) for k in kinds[5:]]
            made = [t.column("id").combine_chunks(), t.column("label").combine_chunks(), pa.array(vectors, pa.binary()), pa.array(packed, pa.binary()), pa.array(error, pa.int64()), *nothing]
            yield pa.RecordBatch.from_arrays(made, names=names)
        if not last and own_kinds:
            p, e, c = (i.ravel() for i in np.indices(totals.shape))
            used = held[p, e] > 0
            p, e, c = p[used], e[used], c[used]
            numbers = [pa.array(a, k) for a, k in zip((p, e, c, held[p, e], totals[p, e, c]), kinds[5:])]
            nothing = [pa.nulls(len(p), k) for k in (*own_kinds, *kinds[2:5])]
            yield pa.RecordBatch.from_arrays([*nothing, *numbers], names=names)

    return rows.mapInArrow(run, schema)


def moved(coded: DataFrame, books: Codebooks) -> Codebooks:
    """Every used entry at the floored mean of its parts; unused ones stay."""
    sums = coded.where(F.col("part").isNotNull()).groupBy("part", "entry", "place")
    sums = sums.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    entries = books.entries.copy()
    for r in sums.collect():  # one row per entry and component
        entries[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return Codebooks(entries)


def label_errors(coded: DataFrame) -> DataFrame:
    """Add label_error, the errors summed over equal labels (nulls together).

    Labels that hold more than one row in HOT_SHARE, at most HOT_SHARE of them, are broadcast; the sums of
    all others meet their rows in a shuffle.
    """
    # fields of equal structs may be null, so an ordinary join keeps null labels
    keyed = coded.withColumn("key", F.struct("label"))
    sums = written(keyed.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("held")), "label-sums")
    total = sums.agg(F.sum("held")).first()[0] or 0
    hot = F.broadcast(sums.where(F.col("held") * HOT_SHARE > total).drop("held"))
    cold = sums.where(F.col("held") * HOT_SHARE <= total).drop("held")
    return keyed.join(hot, "key").unionByName(keyed.join(hot.select("key"), "key", "left_anti").join(cold, "key")).drop("key")


def compress(
    table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    vector: str = "embedding", id_col: str = "vec_id", label: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """id, label, codes (one byte per part), error and label_error of every usable row, and the final codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: entries must be 1 to 256")
    rows, length = usable(table, vector, id_col, label)
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    if not length:
        nothing = rows.select("id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return nothing.where(F.lit(False)), None
    books = seeds(rows, length, parts, entries)
    for n in range(rounds):
        coded = written(code(rows, books, last=False), f"codes-{n}")
        books = moved(coded, books)
        rows = coded.where(F.col("part").isNull()).select("id", "label", "v", "codes")
    coded = written(code(rows, books, last=True).select("id", "label", "codes", "error"), "codes")
    return label_errors(coded), books
