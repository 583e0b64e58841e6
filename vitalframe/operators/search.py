"""Exact top-k searches among the conversations that share a query's filter values (user, domain).

Large filter groups are cut into shards of bounded size by the digest of the conversation; only queries
that meet such a group are repeated, once per shard. Small tables are broadcast after a check of their
size; beyond it the rows are shuffled.

Text: postings carry the impact of a word in a conversation (TF-IDF weight by the norm of the whole
text) and are filed in blocks of similar impact. The table of blocks, with the largest and smallest
impact of each, tells a search which blocks cannot reach the k-th score; their postings are never read.

Embeddings: a task brings its vectors to length one, once each, and compares a shard with a block of
queries by one matrix product.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.operators.ranking import top_k
from vitalframe.sources.tables import materialize, work_path

FILTERS = ("user_id", "routed_to_domain")
# Conversations of a filter group that one task compares, and queries that it compares them with.
SHARD_ROWS = 20_000
QUERY_ROWS = 2_000
# Texts whose words one task counts, at most on average, and least number of such tasks for a core.
TASK_ROWS = 50_000
TASKS_PER_CORE = 3
# Scores held at once by a task.
CELL_NUMBERS = 1 << 22
# A table of at most so many short rows is broadcast.
BROADCAST_ROWS = 100_000
# A word with more than this share of all postings is joined by broadcast; there are at most as many.
COMMON_WORDS = 4_096
# In groups of at most so many rows, all postings of a word are one block, number 0, and all are read.
LEVEL_ROWS = 256
# Blocks per halving of the impact in larger groups.
BLOCKS_PER_OCTAVE = 2
# Searches with more postings than this first look at the best blocks to raise their bar.
PROBE_ABOVE = 10_000
# Scores are rounded to six places; a block within this of the bar may still tie.
MARGIN = 2e-6


def small(table: DataFrame, rows: int) -> DataFrame:
    """The table, marked for broadcast if its counted rows allow it."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


# --- shards -------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Shards:
    """Large filter groups with their number of shards, and the number of rows in all groups."""

    groups: DataFrame
    n_groups: int
    n_rows: int
    filters: tuple[str, ...]

    def deal(self, rows: DataFrame, key: str) -> DataFrame:
        """Add the shard of every row, and whether its group is large."""
        joined = rows.join(small(self.groups, self.n_groups), list(self.filters), "left")
        joined = joined.withColumn("shard", F.pmod(F.xxhash64(key), F.coalesce("shards", F.lit(1))).cast("int"))
        return joined.withColumn("large", F.col("shards").isNotNull()).drop("shards")

    def spread(self, queries: DataFrame) -> DataFrame:
        """Every query once per shard of its group, and whether the group is large."""
        joined = queries.join(small(self.groups, self.n_groups), list(self.filters), "left")
        numbers = F.sequence(F.lit(0), F.coalesce("shards", F.lit(1)) - 1)
        return joined.withColumn("large", F.col("shards").isNotNull()).withColumn("shard", F.explode(numbers)).drop("shards")


def shards(rows: DataFrame, filters: Sequence[str] = FILTERS, shard_rows: int = SHARD_ROWS, large_rows: int | None = None) -> Shards:
    """Count the filter groups of a table and decide into how many shards each large one is cut."""
    path = work_path(rows.sparkSession, "group_sizes")
    sizes = materialize(rows.groupBy(*filters).agg(F.count("*").alias("held")), path)
    large = F.col("held") > (shard_rows if large_rows is None else min(large_rows, shard_rows))
    n = sizes.agg(F.count_if(large).alias("large"), F.coalesce(F.sum("held"), F.lit(0)).alias("held")).first()
    groups = sizes.where(large).select(*filters, F.ceil(F.col("held") / shard_rows).cast("int").alias("shards"))
    return Shards(groups, n["large"], n["held"], tuple(filters))


# --- text ---------------------------------------------------------------------------------------
@dataclass(frozen=True)
class TextIndex:
    """Stored postings, blocks and words of a searchable table."""

    postings: DataFrame
    blocks: DataFrame
    words: DataFrame
    n_words: int
    shards: Shards
    key: str


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.col(text)), "[^a-z0-9]+"), "")


def word_counts(rows: DataFrame, ident: Sequence[str], text: str) -> DataFrame:
    """term and tf of every row; a text's words are counted where it lies, as runs of its sorted words."""
    df = rows.select(*ident, F.sort_array(words_of(text)).alias("_words"))
    opens = F.transform("_words", lambda w, i: F.when((i == 0) | (w != F.get(F.col("_words"), i - 1)), i))
    df = df.withColumn("_opens", F.filter(opens, lambda i: i.isNotNull()))
    ends = lambda j: F.coalesce(F.get(F.col("_opens"), j + 1), F.size("_words"))
    runs = F.transform("_opens", lambda i, j: F.struct(F.get(F.col("_words"), i).alias("term"), (ends(j) - i).alias("tf")))
    # the plain form would be given a filter on its input that counts all words a second time
    return df.select(*ident, F.inline_outer(runs)).where(F.col("term").isNotNull())


def _weighed(counts: DataFrame, words: DataFrame, n_words: int, ident: str) -> DataFrame:
    """Counts of known words as weights by the norm of their text.

    Where the words are too many to broadcast, the common ones are, and all others meet in a shuffle,
    none of them with more than a small share of the rows.
    """
    idf = words.select("term", "idf")
    if n_words <= BROADCAST_ROWS:
        found = counts.join(F.broadcast(idf), "term")
    else:
        common = F.broadcast(words.where("common").select("term", "idf"))  # at most COMMON_WORDS rows
        rare = counts.join(common.select("term"), "term", "left_anti")
        found = counts.join(common, "term").unionByName(rare.join(words.where("NOT common").select("term", "idf"), "term"))
    weight = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(weight * weight).over(Window.partitionBy(ident)))
    return found.withColumn("impact", weight / norm).drop("tf", "idf")


def text_index(
    texts: DataFrame, key: str, text: str, filters: Sequence[str] = FILTERS, path: str | None = None,
    shard_rows: int = SHARD_ROWS, level_rows: int = LEVEL_ROWS,
) -> TextIndex:
    """Build and store the index of a table; ``key`` must identify a row.

    Results for odd input: rows without words are in no block; NULL filter values are never met.
    """
    spark = texts.sparkSession
    path = path or work_path(spark, "text_index")
    dealt = shards(texts, filters, shard_rows, level_rows)
    ident = [key, *filters, "shard", "large"]
    # few large files may hold many texts, so they are spread before their words are counted; the norm
    # of a text then needs no second shuffle. Counting takes long for the bytes it reads, so that the
    # number of tasks goes by rows and cores: tasks joined by bytes are too few to be dealt out evenly
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-dealt.n_rows // TASK_ROWS))
    spread = dealt.deal(texts.select(key, *filters, text), key).repartition(tasks, key)
    counts = word_counts(spread, ident, text)
    kinds = spread.select(F.explode(F.array_distinct(words_of(text))).alias("term"))
    found_in = materialize(kinds.groupBy("term").agg(F.count("*").alias("docs")), f"{path}/words")
    total = found_in.agg(F.count("*").alias("words"), F.coalesce(F.sum("docs"), F.lit(0)).alias("postings")).first()
    idf = F.log(F.lit(dealt.n_rows + 1) / (F.col("docs") + 1)) + 1
    words = found_in.select("term", idf.alias("idf"), (F.col("docs") * COMMON_WORDS > total["postings"]).alias("common"))
    octave = 1 + F.greatest(F.lit(0), F.floor(-F.log2("impact") * BLOCKS_PER_OCTAVE))
    level = F.when(F.col("large"), octave).otherwise(0).cast("int").alias("level")
    weighed = _weighed(counts, words, total["words"], key)
    postings = materialize(weighed.select(*filters, "shard", "term", level, key, "impact"), f"{path}/postings")
    spans = postings.where("level > 0").groupBy(*filters, "shard", "term", "level")
    spans = spans.agg(F.count("*").alias("held"), F.min("impact").alias("low"), F.max("impact").alias("top"))
    blocks = materialize(spans, f"{path}/blocks") if dealt.n_groups else spans
    return TextIndex(postings, blocks, words, total["words"], dealt, key)


def _reachable(asked: DataFrame, index: TextIndex, k: int) -> DataFrame:
    """All blocks of a query's words in large groups, with what they can contribute, from the table of blocks alone.

    ``bar``: the smallest impact in the fewest best blocks of one word that surely hold k conversations
    besides the query's own. ``reach``: what a conversation in the block can score at most, with the best blocks
    of the query's other words. ``cum``: what a conversation can score that holds this word and weaker
    ones only.
    """
    on = [*index.shards.filters, "shard", "term"]
    met = asked.join(index.blocks, on).repartition("query_id")
    of_word = Window.partitionBy("query_id", "shard", "term").orderBy("level")
    met = met.withColumn("best", F.col("weight") * F.first("top").over(of_word)).withColumn("seen", F.sum("held").over(of_word))
    met = met.withColumn("leads", F.row_number().over(of_word) == 1)
    in_shard, of_query = Window.partitionBy("query_id", "shard"), Window.partitionBy("query_id")
    once = F.when(F.col("leads"), F.col("best")).otherwise(0.0)
    # rows of one word are peers in this order, so the sum takes in the whole word
    weaker = in_shard.orderBy("best", "term").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    met = met.withColumn("all_best", F.sum(once).over(in_shard)).withColumn("cum", F.sum(once).over(weaker))
    met = met.withColumn("bar", F.max(F.when(F.col("seen") > k, F.col("weight") * F.col("low")).otherwise(0.0)).over(of_query))
    met = met.withColumn("reach", F.col("all_best") - F.col("best") + F.col("weight") * F.col("top"))
    met = met.withColumn("left", F.sum("held").over(of_query))
    return met.select("query_id", *on, "level", "weight", "best", "reach", "cum", "bar", "leads", "left")


def _summed(met: DataFrame, index: TextIndex) -> DataFrame:
    """Sum of the products of all postings in the given blocks, per query and conversation."""
    filters = list(index.shards.filters)
    pairs = met.join(index.postings, [*filters, "shard", "term", "level"]).where(F.col(index.key) != F.col("query_id"))
    return pairs.groupBy("query_id", *filters, "shard", index.key).agg(F.sum(F.col("weight") * F.col("impact")).alias("score"))


def _kth(scored: DataFrame, k: int) -> DataFrame:
    best = top_k(scored.select("query_id", "score"), ["query_id"], [F.desc("score")], k)
    return best.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))


def blocks_to_read(queries: DataFrame, index: TextIndex, k: int, probe_above: int = PROBE_ABOVE) -> DataFrame:
    """The blocks of a query's words that may matter; ``essential`` ones find conversations, the
    others only add to the scores of those found.

    Words that together stay below the bar are not essential: no conversation can get there with them alone.
    Searches with few postings read everything, as that is cheaper.
    """
    filters = list(index.shards.filters)
    asked = _weighed(word_counts(queries, ["query_id", *filters], "query_text"), index.words, index.n_words, "query_id")
    asked = index.shards.spread(asked.withColumnRenamed("impact", "weight"))
    shown = ["query_id", *filters, "shard", "term", "level", "weight", "best", "essential"]
    whole = asked.where("NOT large").withColumns({"level": F.lit(0), "best": F.lit(0.0), "essential": F.lit(True)}).select(*shown)
    if not index.shards.n_groups:
        return whole
    met = materialize(_reachable(asked.where("large").drop("large"), index, k), work_path(queries.sparkSession, "reachable_blocks"))
    many = F.col("left") > probe_above
    if not met.where(many).limit(1).count():
        return whole.unionByName(met.withColumn("essential", F.lit(True)).select(*shown))
    # sums over the best blocks only are too small at most, so their k-th is a bar as well
    probed = _kth(_summed(met.where(many & F.col("leads")), index), k)
    met = met.join(probed, "query_id", "left").withColumn("bar", F.greatest("bar", F.coalesce("kth", F.lit(0.0)))).drop("kth")
    met = met.withColumn("essential", ~many | (F.col("cum") >= F.col("bar") - MARGIN))
    kept = met.where(F.col("reach") >= F.col("bar") - MARGIN).select(*shown)
    return whole.unionByName(materialize(kept, work_path(queries.sparkSession, "blocks_to_read")))


def similar_by_text(queries: DataFrame, index: TextIndex, k: int = 3, probe_above: int = PROBE_ABOVE) -> DataFrame:
    """Exact top ``k`` by cosine of TF-IDF vectors; only conversations that share a word can score.

    ``queries`` has a unique ``query_id``, the filter columns and ``query_text``. Equal scores go to
    the smaller key.
    """
    spark, key, filters = queries.sparkSession, index.key, list(index.shards.filters)
    met = blocks_to_read(queries, index, k, probe_above)
    scored = _summed(met.where("essential"), index)
    weak = met.where(~F.col("essential")).select("query_id", "shard", "term", "weight", "best").distinct()
    if index.shards.n_groups and weak.limit(1).count():
        scored = materialize(scored, work_path(spark, "partial_scores"))
        rest = weak.groupBy("query_id", "shard").agg(F.sum("best").alias("rest"))
        found = scored.join(rest, ["query_id", "shard"], "left").join(_kth(scored, k), "query_id", "left")
        found = found.where(F.col("score") + F.coalesce("rest", F.lit(0.0)) >= F.coalesce("kth", F.lit(0.0)) - MARGIN).select(*scored.columns)
        # the weak words of what is left are looked up conversation by conversation
        looked = found.join(weak, ["query_id", "shard"]).join(index.postings.drop("level"), [*filters, "shard", "term", key])
        added = looked.select("query_id", key, (F.col("weight") * F.col("impact")).alias("score"))
        scored = found.select("query_id", key, "score").unionByName(added).groupBy("query_id", key).agg(F.sum("score").alias("score"))
    scored = scored.select("query_id", key, F.round("score", 6).alias("score"))
    return top_k(scored, ["query_id"], [F.desc("score"), F.col(key)], k)


# --- embeddings -----------------------------------------------------------------------------------
def _matrix(vectors: pa.Array, length: int) -> np.ndarray:
    """One row of length one per vector; vectors without a direction or of another length are NaN throughout."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), length), False)
    out = np.full((len(vectors), length), np.nan)
    rows = pc.list_flatten(vectors.filter(fits)).to_numpy(zero_copy_only=False).reshape(-1, length)
    norm = np.sqrt((rows * rows).sum(1))
    out[fits.to_numpy(zero_copy_only=False)] = rows / np.where(norm > 0, norm, np.nan)[:, None]
    return out


def _first_k(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest scores of every row; NaN counts as smallest, ties go to the first column."""
    k = min(k, scores.shape[1])
    worth = np.where(np.isnan(scores), -np.inf, scores)
    bar = np.partition(worth, worth.shape[1] - k, axis=1)[:, worth.shape[1] - k]
    row, column = np.nonzero(worth >= bar[:, None])
    order = np.lexsort((column, -worth[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _compare(key: str, k: int):
    """Best k conversations for the queries of all groups of a cell, group by group."""

    def run(asked: pa.Table, corpus: pa.Table) -> pa.Table:
        asked, corpus = asked.combine_chunks(), corpus.sort_by([("group", "ascending"), (key, "ascending")]).combine_chunks()
        kinds = [asked.schema.field("query_id").type, corpus.schema.field(key).type, pa.float64()]
        one = lambda t, c: t.column(c).combine_chunks() if isinstance(t.column(c), pa.ChunkedArray) else t.column(c)
        groups = pc.unique(one(asked, "group")) if asked.num_rows else pa.array([], pa.string())
        q_group = pc.index_in(one(asked, "group"), groups).to_numpy(zero_copy_only=False)
        c_group = pc.fill_null(pc.index_in(one(corpus, "group"), groups), -1).to_numpy(zero_copy_only=False)
        q_vectors, c_vectors = one(asked, "vector"), one(corpus, "vector")
        lengths = [n for n in pc.unique(pc.list_value_length(q_vectors)).to_pylist() if n]
        sides = [(_matrix(q_vectors, n), _matrix(c_vectors, n)) for n in lengths]
        q_ids, c_ids = one(asked, "query_id").to_numpy(zero_copy_only=False), one(corpus, key).to_numpy(zero_copy_only=False)
        q_order = np.argsort(q_group, kind="stable")
        # rows of a group lie together in the sorted corpus
        sizes = np.bincount(c_group[c_group >= 0], minlength=len(groups))
        starts = np.zeros(len(groups), np.int64)
        starts[c_group[::-1][c_group[::-1] >= 0]] = np.flatnonzero(c_group >= 0)[::-1]
        found_q, found_c, found_s = [], [], []
        for g in range(len(groups)):
            mine = q_order[np.searchsorted(q_group[q_order], g, "left") : np.searchsorted(q_group[q_order], g, "right")]
            theirs = np.arange(starts[g], starts[g] + sizes[g])
            if not len(theirs):
                continue
            step = max(1, CELL_NUMBERS // len(theirs))
            for at in range(0, len(mine), step):
                rows = mine[at : at + step]
                scores = np.full((len(rows), len(theirs)), np.nan)
                for q, c in sides:
                    these = np.round(q[rows] @ c[theirs].T, 6)
                    scores = np.where(np.isnan(scores), these, scores)
                # one more than asked, as a query's own conversation may be among them
                row, column = _first_k(scores, k + 1)
                other = c_ids[theirs[column]] != q_ids[rows[row]]
                row, column = row[other], column[other]
                first = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, column = row[first], column[first]
                found_q.append(rows[row])
                found_c.append(theirs[column])
                found_s.append(scores[row, column])
        if not found_q:
            return pa.table([pa.array([], t) for t in kinds], names=["query_id", key, "score"])
        q, c, s = np.concatenate(found_q), np.concatenate(found_c), np.concatenate(found_s)
        columns = [one(asked, "query_id").take(pa.array(q)), one(corpus, key).take(pa.array(c)), pa.array(s, pa.float64(), from_pandas=True)]
        return pa.table(columns, names=["query_id", key, "score"])

    return run


def similar_by_embedding(
    queries: DataFrame, corpus: DataFrame, k: int = 3, filters: Sequence[str] = FILTERS,
    since: dt.date | None = None, key: str = "conversation_id", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Exact top ``k`` conversations per query by cosine of embeddings, among those with its filter values.

    ``queries`` has ``query_id``, the filter columns and ``query_embedding``; ``corpus`` has the key, the filter
    columns and ``embedding``; ids must identify rows. Every message may be a query: large groups are cut
    into parts of ``shard_rows`` conversations and blocks of ``query_rows`` queries, small groups share a
    task. Conversations without a direction or of another length score NULL and come last; NULL ids and
    filter values are never met.
    """
    filters = list(filters)
    if since:
        corpus = corpus.filter(F.col("conversation_date") >= F.lit(since))
    corpus = corpus.where(reduce_and([F.col(c).isNotNull() for c in (key, *filters)]))
    queries = queries.where(reduce_and([F.col(c).isNotNull() for c in ("query_id", *filters)]))
    parts, blocks = shards(corpus, filters, shard_rows), shards(queries, filters, query_rows)
    n_cells = max(int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(parts.n_rows + blocks.n_rows) // shard_rows))

    def in_cells(rows: DataFrame, ident: str) -> DataFrame:
        group = F.to_json(F.struct(*filters, "part", "block"))
        return rows.select(F.pmod(F.xxhash64(group), F.lit(n_cells)).alias("cell"), group.alias("group"), ident, "vector")

    vectors = parts.deal(corpus.select(key, *filters, F.col("embedding").cast("array<double>").alias("vector")), key).drop("large").withColumnRenamed("shard", "part")
    vectors = in_cells(blocks.spread(vectors).drop("large").withColumnRenamed("shard", "block"), key)
    asked = blocks.deal(queries.select("query_id", *filters, F.col("query_embedding").cast("array<double>").alias("vector")), "query_id").drop("large").withColumnRenamed("shard", "block")
    asked = in_cells(parts.spread(asked).drop("large").withColumnRenamed("shard", "part"), "query_id")
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField(key, corpus.schema[key].dataType), T.StructField("score", T.DoubleType())])
    found = asked.groupBy("cell").cogroup(vectors.groupBy("cell")).applyInArrow(_compare(key, k), schema)
    return top_k(found, ["query_id"], [F.desc_nulls_last("score"), F.col(key)], k)


def reduce_and(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
