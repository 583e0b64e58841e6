"""Best-fit packing of documents into token sequences by a grouping genetic algorithm.

Every document becomes its ids and one end id. Documents above the capacity are cut into full pieces,
of which only the first may be shorter; full pieces fill a sequence alone. All other pieces are dealt
by hash into groups of bounded size. On each group several islands (one task each) evolve a small
population of packings: crossover injects whole well-filled sequences of one parent into the other,
removes the sequences that hold the same pieces, and places the displaced pieces by best fit. After
each epoch the best packing of an island moves to the next one. What the best islands leave badly
filled is dissolved and dealt anew, so that groups with too many long pieces meet groups with too
many short ones. All rounds run on lengths; texts are read once.

Results for odd input: null and empty texts are one piece that holds the end id only; repeated rows
are packed each; an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.llm import bpe
from vitalframe.llm.common import written

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 8192
ISLANDS = 2
EPOCHS = 2
ROUNDS = 3
POPULATION = 4
GENERATIONS = 5
# A sequence with at most this share of its capacity unused is not dissolved.
SPARE = 1 / 256

Bins = list[list[int]]


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per piece: id column, piece, start, length, ids_crc32 (of its packed ids)."""
    names = ["piece", "start", "length", "ids_crc32"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = T.StructType(
        [docs.schema[id_col]]
        + [T.StructField(n, T.IntegerType() if k == pa.int32() else T.LongType()) for n, k in zip(names, kinds)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, end, width = bpe.codec(path).encode_all, end_id.to_bytes(bpe.ID_BYTES, "little"), capacity * bpe.ID_BYTES
        for batch in batches:
            for at in range(0, batch.num_rows, bpe.ROWS_PER_BATCH):
                part = batch.slice(at, bpe.ROWS_PER_BATCH)
                owner, rows = [], []
                for n, ids in enumerate(encode_all(part.column(text))):
                    ids += end
                    first = len(ids) % width or width
                    spans = [(0, first), *((a, a + width) for a in range(first, len(ids), width))]
                    owner += [n] * len(spans)
                    rows += [
                        (k, a // bpe.ID_BYTES, (b - a) // bpe.ID_BYTES, zlib.crc32(ids[a:b]))
                        for k, (a, b) in enumerate(spans)
                    ]
                made = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(id_col).take(pa.array(owner)), *made], names=[id_col, *names])

    return docs.select(*dict.fromkeys([id_col, text])).mapInArrow(run, schema)


def best_fit(order: list[int], sizes: list[int], capacity: int, bins: Bins, gaps: list[int]) -> None:
    """Put each piece where it leaves the smallest gap, opening a sequence where none has room."""
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0
    for b, gap in enumerate(gaps):
        by_gap[gap].append(b)
        open_gaps |= 1 << gap
    for item in order:
        size = sizes[item]
        room = open_gaps >> size
        if room:
            gap = size + (room & -room).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps ^= 1 << gap
            bins[b].append(item)
        else:
            gap, b = capacity, len(bins)
            bins.append([item])
            gaps.append(capacity)
        gap -= size
        gaps[b] = gap
        by_gap[gap].append(b)
        open_gaps |= 1 << gap


def crossover(well: Bins, other: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Inject well-filled sequences of one parent, drop those of the other that share a piece, best-fit the displaced."""
    ranked = sorted(well, key=lambda b: sum([sizes[i] for i in b]), reverse=True)
    share = rng.uniform(0.2, 0.8)
    child = [list(b) for b in ranked[: max(1, int(0.9 * len(ranked)))] if rng.random() < share]
    held = bytearray(len(sizes))
    for b in child:
        for i in b:
            held[i] = 1
    displaced = []
    for b in other:
        if any([held[i] for i in b]):
            displaced += [i for i in b if not held[i]]
        else:
            child.append(list(b))
    gaps = [capacity - sum([sizes[i] for i in b]) for b in child]
    displaced.sort(key=lambda i: -sizes[i])
    best_fit(displaced, sizes, capacity, child, gaps)
    return child


def merit(bins: Bins, sizes: list[int]) -> tuple[int, int]:
    """Fewer sequences first, then the more unevenly filled."""
    return -len(bins), sum([sum([sizes[i] for i in b]) ** 2 for b in bins])


def evolve(sizes: list[int], parents: list[Bins], capacity: int, seed: str) -> Bins:
    """Best packing after some generations from the given packings and random ones."""
    rng = random.Random(seed)
    population = [(merit(p, sizes), p) for p in parents]
    while len(population) < POPULATION:
        noise = 0 if not population else capacity // 16
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i] - rng.random() * noise)
        bins: Bins = []
        best_fit(order, sizes, capacity, bins, [])
        population.append((merit(bins, sizes), bins))
    need = -(-sum(sizes) // capacity)
    for _ in range(GENERATIONS):
        population.sort(key=lambda p: p[0], reverse=True)
        if -population[0][0][0] <= need:
            break
        a, b = rng.sample(range(len(population) - 1), 2) if len(population) > 2 else (0, 1)
        child = crossover(population[a][1], population[b][1], sizes, capacity, rng)
        population[-1] = (merit(child, sizes), child)
    return max(population, key=lambda p: p[0])[1]


def _island_epoch(capacity: int, stamp: str):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        group, island = key
        pdf = pdf.sort_values(["origin", "row"], ignore_index=True)
        rows = pdf.loc[pdf["origin"] == pdf["origin"].iloc[0], ["row", "size"]]
        place = {r: i for i, r in enumerate(rows["row"])}
        parents = []
        for _, packing in pdf[pdf["bin"] >= 0].groupby("origin"):
            bins: dict[int, list[int]] = {}
            for r, b in zip(packing["row"], packing["bin"]):
                bins.setdefault(b, []).append(place[r])
            parents.append(list(bins.values()))
        sizes = rows["size"].tolist()
        best = evolve(sizes, parents, capacity, f"{stamp}-{group}-{island}")
        flat = [(i, n) for n, b in enumerate(best) for i in b]
        out = rows.iloc[[i for i, _ in flat]].reset_index(drop=True)
        out["bin"] = [n for _, n in flat]
        out["offset"] = out.groupby("bin")["size"].cumsum() - out["size"]
        out["fill"] = out.groupby("bin")["size"].transform("sum")
        out["bins"] = len(best)
        out.insert(0, "island", island)
        out.insert(0, "group", group)
        return out

    return run


def _round(items: DataFrame, n_groups: int, capacity: int, number: int) -> DataFrame:
    """Best packing of each group: row, size, group, bin, offset, fill."""
    shape = "group long, island int, row long, size long, bin long, offset long, fill long, bins long"
    dealt = items.select(
        F.pmod(F.xxhash64(F.lit(number), "row"), F.lit(n_groups)).alias("group"),
        F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"),
        "row", "size", F.lit(-1).cast("long").alias("bin"), F.lit(0).alias("origin"),
    )
    for epoch in range(EPOCHS):
        stamp = f"{number}-{epoch}"
        best = written(dealt.groupBy("group", "island").applyInPandas(_island_epoch(capacity, stamp), shape), f"islands-{stamp}")
        own = best.select("group", "island", "row", "size", "bin", F.lit(0).alias("origin"))
        moved = best.select("group", ((F.col("island") + 1) % ISLANDS).alias("island"), "row", "size", "bin", F.lit(1).alias("origin"))
        dealt = own.unionByName(moved)
    winners = best.groupBy("group").agg(F.min_by("island", F.struct("bins", "island")).alias("island"))
    return best.join(winners, ["group", "island"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to rows with a length of 1 to capacity.

    Rows longer than the capacity are refused. The order of rows within a sequence is free; offsets
    are gapless from 0.
    """
    rows = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    bad = F.coalesce((F.col("length") < 1) | (F.col("length") > capacity), F.lit(True))
    counts = rows.agg(F.count(F.when(bad, 1)).alias("bad"), F.count(F.when(F.col("length") < capacity, 1)).alias("open")).first()
    if counts["bad"]:
        raise ValueError(f"{counts['bad']} pieces have no length from 1 to {capacity}")
    placed = [rows.where(F.col("length") == capacity).select("row", (F.lit(1 << 62) + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    items, left = rows.where(F.col("length") < capacity).select("row", F.col("length").alias("size")), counts["open"]
    for number in range(ROUNDS):
        if not left:
            break
        n_groups = max(1, round(left / group_pieces))
        last = number == ROUNDS - 1 or n_groups == 1
        best = _round(items, n_groups, capacity, number)
        if not last:
            best = written(best, f"round-{number}")
        done = best if last else best.where(F.col("fill") >= capacity * (1 - SPARE))
        sequence = F.lit(number << 56) + F.col("group") * (1 << 20) + F.col("bin")
        placed.append(done.select("row", sequence.alias("sequence_id"), "offset"))
        if last:
            break
        items = best.where(F.col("fill") < capacity * (1 - SPARE)).select("row", "size")
        left = items.count()
    where = placed[0]
    for more in placed[1:]:
        where = where.unionByName(more)
    return rows.join(where, "row").drop("row")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents, cut and packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(cut(docs, path, capacity, end_id), capacity)
