"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A bit of a document's 64-bit fingerprint is set if it is set in over half of the digests of its word
shingles, repeats included. Fingerprints that differ in at most three bits are linked, and documents
are grouped by the connected components of these links.

Two fingerprints within the radius meet at a variant that lies half-way: every fingerprint emits the
variants around it, a shuffle brings equal variants together, and what meets is linked.

* Screen. One of three blocks of the bits holds at least one of three differing bits, so without it
  the rest differs in at most two: each fingerprint emits, per block, the rest and all its one-bit
  variants. Fingerprints that meet no other one here have no link.
* Links. Of a pair at distance three, one has an even and one an odd number of set bits. Even ones
  emit their one-bit variants; odd ones emit themselves, their one-bit variants, and the two-bit
  variants with both bits in one half (two of three differing bits always share a half). Whoever
  meets at such a variant is within the radius of the smallest near emitter of it by the triangle
  inequality, so everyone is linked to that one: no pairs within a group are ever listed, and no
  link between different fingerprints is lost up to the components they form.

Equal fingerprints are one node, however many documents share them.

Distances only estimate what texts share, so `one_per_group` checks what the balls group. Equal
shingle sets are one node. Nodes of one component of the fingerprints meet, and those that meet are
compared: their sets are joined, and a link needs the wanted similarity (Jaccard) exactly. So a wrong
link cannot occur, and no pair within three bits is lost.

Three of 64 bits is also a narrow ball. Every node therefore emits a key per band of minimum hashes
as well, and nodes that meet at such a key are compared like those of a component. A similar pair
beyond three bits is missed only if it meets at no key: one in 400 at 0.8, one in 4,000 at 0.83.

A key's members are first compared with its hub, the member that meets most others; then every two
members whom the links so far leave in different components. So no member leaves a group untried,
and pairs inside a component are not listed.

Results for odd input: null and empty texts have fingerprint zero and are linked like any other;
repeated rows share their group; a group whose ids are all null has a null component; an empty table
gives no rows; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.llm.common import written
from vitalframe.llm.components import stars

BITS = 64
SEED = 42
SHINGLE = 3
BLOCKS = [range(0, 22), range(22, 43), range(43, 64)]
SIMILARITY = 0.8
# A pair at similarity s meets at a key with probability 1 - (1 - s ** ROWS) ** BANDS.
BANDS = 20
ROWS = 6
CHUNK = 8_192
# So many short rows (an id, two digests) take some 150 MB on the driver and on each executor.
BROADCAST_ROWS = 2_000_000
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def shingle_digests(text: bytes | None, shingle: int) -> np.ndarray:
    """Eight bytes per word shingle, repeats included (fewer words: the whole sequence; none: no row)."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty((0, 8), np.uint8)
    digest = xxhash.xxh64_digest
    joined = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    return np.frombuffer(b"".join([digest(s, SEED) for s in joined]), np.uint8).reshape(-1, 8)


def majority(digests: np.ndarray) -> int:
    """Signed number of the bits that are set in over half of the digests (none: zero)."""
    counts = np.unpackbits(digests, axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(digests)).tobytes(), "big", signed=True)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles (fewer words: the whole sequence; none: zero)."""
    return majority(shingle_digests(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and the fingerprint of the whole text."""
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = part.column(text).cast(pa.binary()).to_pylist()
                made = [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=schema.names)

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def different(digests: np.ndarray) -> np.ndarray:
    """Sorted different digests as numbers (none: that of the empty sequence)."""
    return np.unique(digests.view(">u8").astype(np.uint64)) if len(digests) else np.array([xxhash.xxh64_intdigest(b"", SEED)], np.uint64)


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """Sorted digests of the different word shingles (fewer words: the whole sequence, also of none)."""
    return different(shingle_digests(text, shingle))


def band_keys(hashes: np.ndarray) -> list[int]:
    """Per band a digest of its number and its minimum hashes."""
    least = np.min([np.min(hashes[at : at + CHUNK, None] * FACTORS, axis=0) for at in range(0, len(hashes), CHUNK)], axis=0).reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least)]


def set_marks(docs: DataFrame, shingle: int) -> DataFrame:
    """id, digest, fingerprint, node (a digest of the shingle set), its size and its band keys."""
    made_fields = [T.StructField(n, T.LongType()) for n in ("fingerprint", "node")] + [T.StructField("size", T.IntegerType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    schema = T.StructType([docs.schema["id"], docs.schema["digest"], *made_fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, nodes, sizes, keys = [], [], [], []
            for text in batch.column("text").cast(pa.binary()):
                digests = shingle_digests(text.as_py(), shingle)
                hashes = different(digests)
                prints.append(majority(digests))
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                sizes.append(len(hashes))
                keys.append(np.array(band_keys(hashes), np.uint64).view(np.int64))
            made = [pa.array(prints, pa.int64()), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), *made], names=schema.names)

    return docs.select("id", "digest", "text").mapInArrow(run, schema)


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """node and the digests of its shingles, for rows of node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = [shingle_set(t.as_py(), shingle).view(np.int64) for t in part.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"])

    return texts.select("node", "text").mapInArrow(run, "node long, hashes array<long>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("of_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    shared = both.select("a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("shared"), (F.size("of_a") + F.size("of_b")).alias("total"))
    return shared.where(F.col("shared") >= similarity * (F.col("total") - F.col("shared")) - 1e-9).select("a", "b")


def _ball_keys(marked: DataFrame) -> DataFrame:
    """node, size and a key per component of the fingerprints that the node's documents have."""
    prints = written(marked.select("node", "size", "fingerprint").distinct(), "prints")
    roots = ball_roots(prints.select("fingerprint").distinct())
    root = F.coalesce("root", "fingerprint")
    return prints.join(roots, "fingerprint", "left").select("node", "size", F.xxhash64(F.lit("ball"), root).alias("key")).distinct()


def _meetings(rows: DataFrame) -> DataFrame:
    """node, size, key and n, the members of the key, for keys with two members and more."""
    return rows.join(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")


def _pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """Different pairs (a, b), a the smaller, of rows (x, y) whose sizes allow the similarity."""
    able = F.least("x.size", "y.size") >= similarity * F.greatest("x.size", "y.size") - 1e-9
    return rows.where(able & (F.col("x.node") != F.col("y.node"))).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def similar_links(met: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Edges (a, b) at the similarity whose components are those of all such pairs that meet at a key."""
    member = F.struct("node", "size")
    degree = met.groupBy("node").agg(F.sum("n").alias("degree"))
    hubs = met.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", "node", "size")).alias("y"))
    tried = written(_pairs(met.select("key", member.alias("x")).join(hubs, "key"), similarity), "tried")
    links = written(verified(tried, sets, similarity), "links")
    placed = met.join(stars(links), "node", "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    member = F.struct("node", "size", "root")
    rest = written(placed.join(mixed, "key").select("key", member.alias("x")), "rest")
    apart = rest.join(rest.withColumnRenamed("x", "y"), "key").where(F.col("x.root") < F.col("y.root"))
    more = _pairs(apart, similarity).join(tried, ["a", "b"], "left_anti")
    return links.unionByName(verified(written(more, "more"), sets, similarity))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _around(flips: Sequence[int]) -> Column:
    return F.array(*(F.lit(_signed(f)).cast("long") for f in flips))


def _flipped(bits: Column, flips: Sequence[int]) -> Column:
    return F.transform(_around(flips), lambda f: bits.bitwiseXOR(f))


def _screen_variants(fp: Column) -> Column:
    """Per block: the other bits, and their one-bit variants; the blank block carries a mark of its own."""
    parts = []
    for block in BLOCKS:
        rest = sum(1 << i for i in range(BITS) if i not in block)
        mark = 1 << block[0]
        flips = [mark, *(mark | 1 << i for i in range(BITS) if i not in block)]
        parts.append(_flipped(fp.bitwiseAND(F.lit(_signed(rest))), flips))
    return F.concat(*parts)


def _screened(distinct: DataFrame) -> DataFrame:
    """Fingerprints that meet another one when a block is left out."""
    met = Window.partitionBy("variant").orderBy("fingerprint")
    beside = F.lag("fingerprint").over(met).isNotNull() | F.lead("fingerprint").over(met).isNotNull()
    emitted = distinct.select("fingerprint", F.explode(_screen_variants(F.col("fingerprint"))).alias("variant"))
    return emitted.withColumn("beside", beside).where("beside").select("fingerprint").distinct()


def _links(candidates: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within three bits."""
    fp = F.col("fingerprint")
    one = [1 << i for i in range(BITS)]
    half = BITS // 2
    two = [1 << i | 1 << j for side in (0, half) for i in range(side, side + half) for j in range(i)  if j >= side]
    odd = F.bit_count(fp) % 2 == 1
    flips = F.when(odd, _around([0, *one, *two])).otherwise(_around(one))
    emitted = candidates.select("fingerprint", F.explode(F.transform(flips, lambda f: fp.bitwiseXOR(f))).alias("variant"))
    # at an odd variant even fingerprints are one bit away and odd ones none or two; at an even
    # variant all are one bit away
    near = (F.bit_count(fp) % 2 == 0) | (F.bit_count("variant") % 2 == 0)
    middle = F.min(F.when(near, fp)).over(Window.partitionBy("variant"))
    return emitted.withColumn("middle", middle).where(F.col("middle") != fp).select(fp.alias("a"), F.col("middle").alias("b")).distinct()


def ball_roots(distinct: DataFrame) -> DataFrame:
    """fingerprint and root, the smallest fingerprint of its component, for those of different fingerprints that are linked."""
    roots = stars(_links(written(_screened(distinct), "screened")))
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    return linked.select(F.col("node").alias("fingerprint"), "root")


def components(marked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add component_id, the smallest id reachable over links, and root, the component's smallest
    fingerprint, to rows with a fingerprint."""
    per_fp = written(marked.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "fingerprints")
    # fingerprints without a link are components of their own
    linked = ball_roots(per_fp.select("fingerprint"))
    grouped = per_fp.join(linked, "fingerprint", "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    of_root = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = grouped.join(of_root, "root").select("fingerprint", "component_id", "root")
    return marked.join(of_fp, "fingerprint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns (the first is the id), fingerprint, component_id and root of every document."""
    marked = written(fingerprints(docs, shingle, text, keep), "marked")
    return components(marked, keep[0])


def _counted(rows: DataFrame) -> DataFrame:
    """Written rows, marked for broadcast if there are at most BROADCAST_ROWS; more are met in a shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def one_per_group(docs: DataFrame, shingle: int, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The document with the smallest id of every component, whole; of repeated rows one stays.

    Links are pairs that share at least the similarity of their shingles. Short rows of ids decide which
    texts are compared and which rows go; whole texts are only moved where these are too many to broadcast.
    """
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    asked = docs.select(F.col(id_col).alias("id"), digest.alias("digest"), F.col(text).alias("text"))
    marked = written(set_marks(asked, shingle), "marked")
    first = F.min(F.struct("id", "digest", "size", "keys")).alias("first")
    firsts = written(marked.groupBy("node").agg(first).select("node", "first.*"), "firsts")
    keyed = firsts.select("node", "size", F.explode("keys").alias("key")).unionByName(_ball_keys(marked))
    met = written(_meetings(keyed), "met")
    wanted = firsts.join(met.select("node").distinct(), "node").select("node", F.col("id").alias("first_id"), F.col("digest").alias("first_digest"))
    # equal id and text make a repeated row, whatever its other columns hold
    same = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    sets = written(shingle_sets(asked.join(_counted(written(wanted, "wanted")), same), shingle).dropDuplicates(["node"]), "sets")
    merged = stars(similar_links(met, sets, similarity))
    placed = firsts.select("node", "id", "digest").join(merged, "node", "left")
    best = placed.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(F.struct("id", "digest")).alias("first"))
    chosen = best.select(F.col("first.id").alias("first_id"), F.col("first.digest").alias("first_digest"))
    # rows that stay once are named by neither list, so they pass where they lie
    held = marked.groupBy("id", "digest").agg(F.count("*").alias("copies"))
    gone = held.join(chosen, same, "left_anti").select("id", "digest", F.lit(True).alias("gone"))
    repeated = held.where("copies > 1").join(chosen, same, "left_semi").select("id", "digest", F.lit(False).alias("gone"))
    fates = written(gone.unionByName(repeated).select(F.col("id").alias("first_id"), F.col("digest").alias("first_digest"), "gone"), "fates")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), digest.alias("digest")).join(_counted(fates), same, "left")
    once = rows.where("NOT gone").dropDuplicates(["id", "digest"])
    return rows.where("gone IS NULL").unionByName(once).select("row.*")
