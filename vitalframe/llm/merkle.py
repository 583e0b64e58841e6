"""Document fingerprints: a Merkle tree over the paragraphs and sections of a text, in DataFrame functions only.

A paragraph is what lies between two line feeds, and its node is the SHA-256 of its bytes. A section
is a run of paragraphs that ends at a blank one, at one whose digest is below a fixed mark (so that an
inserted paragraph moves no boundary but its own), or with the text; its node is the SHA-256 of its
paragraphs' digests, and the root that of the sections' digests. Equal roots mean equal texts.

Two trees are compared from the top: equal roots end the comparison; otherwise equal sections at both
ends are left out, then equal paragraphs at both ends of what is left. The branches that remain are
where the texts differ. Inside them the texts are compared by pieces (runs of at most 16 characters
that start anew behind every sentence mark), as bags: an order-free sorted merge, linear after the sort.

Results for odd input: null and empty texts are one empty paragraph, all with the same root; texts of
any length are read whole; repeated rows are fingerprinted each, and follow one another in the order of
documents; null ids come first in that order; a single document is its own next one; an empty table
gives no rows; extra columns play no part, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.sources.tables import work_path

SHARE = 4
# Spark's limit on the buckets of a table.
MOST_RANGES = 100_000
# A paragraph whose digest sorts below this mark ends its section: one in four.
SECTION_END = "4"
PIECE = r"[^.!?]{1,16}[.!?]?|[.!?]"
BLANK = r"^[\x20\x09-\x0D]*$"


# --- trees --------------------------------------------------------------------------------------
def _runs(items: str, ends: str) -> Column:
    """Consecutive items of an array, cut behind the given places (counted from 0)."""
    start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(F.col(ends), k - 1) + 1)
    return F.transform(F.col(ends), lambda e, k: F.slice(F.col(items), start(k) + 1, e - start(k) + 1))


def _digest(children: Column) -> Column:
    return F.sha2(F.array_join(F.transform(children, lambda c: c["digest"]), ""), 256)


def with_tree(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the tree of a text column: struct(root, sections: digest, paragraphs: digest, pieces)."""
    pieces = lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), lambda s: F.xxhash64(s))
    node = lambda p: F.struct(F.sha2(p, 256).alias("digest"), p.rlike(BLANK).alias("blank"), pieces(p).alias("pieces"))
    df = df.withColumn("_nodes", F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), node))
    last = lambda i: i == F.size("_nodes") - 1
    ending = F.transform("_nodes", lambda p, i: F.when(p["blank"] | (p["digest"] < SECTION_END) | last(i), i))
    df = df.withColumn("_ends", F.filter(ending, lambda i: i.isNotNull()))
    section = lambda ps: F.struct(_digest(ps).alias("digest"), ps.alias("paragraphs"))
    df = df.withColumn("_sections", F.transform(_runs("_nodes", "_ends"), section))
    return df.withColumn(out, F.struct(_digest(F.col("_sections")).alias("root"), F.col("_sections").alias("sections"))).drop("_nodes", "_ends", "_sections")


# --- comparison ---------------------------------------------------------------------------------
def _equal_ends(df: DataFrame, a: str, b: str, stem: str) -> DataFrame:
    """Add how many children of two lists agree at the front and, behind those, at the back."""
    def agreeing(x: Column, y: Column) -> Column:
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p["digest"] == q["digest"], F.lit(False)))
        first_other = F.array_position(same, False)
        return F.when(first_other == 0, F.size(same)).otherwise(first_other - 1).cast("int")

    least = F.least(F.size(a), F.size(b))
    df = df.withColumn(f"{stem}front", agreeing(F.col(a), F.col(b)))
    back = agreeing(F.reverse(F.col(a)), F.reverse(F.col(b)))
    return df.withColumn(f"{stem}back", F.least(back, least - F.col(f"{stem}front")))


def _middle(items: str, stem: str) -> Column:
    front, back = F.col(f"{stem}front"), F.col(f"{stem}back")
    return F.slice(items, front + 1, F.size(items) - front - back)


def _bag_overlap(a: str, b: str) -> Column:
    """How many entries two arrays of digests share, each counted as often as both hold it.

    The lowest bit of a digest gives way to the side it comes from; one pass over the sorted union
    then pairs equal digests.
    """
    side = lambda c, bit: F.transform(F.col(c), lambda x: x.bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(bit)))
    merged = F.sort_array(F.concat(side(a, 0), side(b, 1)))
    start = F.struct(F.lit(None).cast("long").alias("now"), F.lit(0).alias("open"), F.lit(0).alias("paired"))

    def step(acc: Column, x: Column) -> Column:
        here = x.bitwiseAND(F.lit(-2))
        left = F.when(acc["now"] == here, acc["open"]).otherwise(F.lit(0))
        from_b = x.bitwiseAND(F.lit(1)) == 1
        pair = from_b & (left > 0)
        opened = F.when(from_b, F.when(pair, left - 1).otherwise(left)).otherwise(left + 1)
        return F.struct(here.alias("now"), opened.alias("open"), (acc["paired"] + pair.cast("int")).alias("paired"))

    return F.aggregate(merged, start, step)["paired"]


def compare(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Add struct(equal, likeness, section, sections_a, sections_b, paragraph, paragraphs_a, paragraphs_b).

    The differing branches of a and b are ``sections_a`` and ``sections_b`` sections from number
    ``section`` on, and in them ``paragraphs_a`` and ``paragraphs_b`` paragraphs from number
    ``paragraph`` of those sections on (from 0). ``likeness`` is twice the pieces that both texts hold by
    the pieces of both: 1 for equal roots, else 0 where neither has any; 1 also where only blank
    lines or the order of pieces differ.
    """
    all_pieces = lambda t: F.aggregate(F.col(t)["sections"], F.lit(0), lambda n, s: F.aggregate(s["paragraphs"], n, lambda m, p: m + F.size(p["pieces"])))
    equal = F.col(a)["root"] == F.col(b)["root"]
    none = lambda t: F.slice(F.col(t)["sections"], 1, 0)
    for side, tree in (("_a", a), ("_b", b)):
        # below equal roots nothing is left to compare
        df = df.withColumn(f"{side}s", F.when(equal, none(tree)).otherwise(F.col(tree)["sections"]))
    df = _equal_ends(df, "_as", "_bs", "_s_")
    for side in ("_a", "_b"):
        df = df.withColumn(f"{side}m", _middle(f"{side}s", "_s_"))
        df = df.withColumn(f"{side}p", F.flatten(F.transform(f"{side}m", lambda s: s["paragraphs"])))
    df = _equal_ends(df, "_ap", "_bp", "_p_")
    for side in ("_a", "_b"):
        df = df.withColumn(f"{side}q", _middle(f"{side}p", "_p_"))
        df = df.withColumn(f"{side}r", F.flatten(F.transform(f"{side}q", lambda p: p["pieces"])))
    df = df.withColumn("_na", all_pieces(a)).withColumn("_nb", all_pieces(b))
    shared = F.col("_na") - F.size("_ar") + _bag_overlap("_ar", "_br")
    likeness = F.when(equal, F.lit(1.0)).when(F.col("_na") + F.col("_nb") == 0, F.lit(0.0)).otherwise(2.0 * shared / (F.col("_na") + F.col("_nb")))
    made = F.struct(
        equal.alias("equal"), likeness.alias("likeness"),
        F.col("_s_front").alias("section"), F.size("_am").alias("sections_a"), F.size("_bm").alias("sections_b"),
        F.col("_p_front").alias("paragraph"), F.size("_aq").alias("paragraphs_a"), F.size("_bq").alias("paragraphs_b"),
    )
    used = [f"{s}{k}" for s in ("_a", "_b") for k in "smpqr"] + ["_s_front", "_s_back", "_p_front", "_p_back", "_na", "_nb"]
    return df.withColumn(out, made).drop(*used)


# --- documents in order ---------------------------------------------------------------------------
def with_next(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Id, whole text (null: empty) and the next document's, by ascending id; after the last comes the first.

    Rows go to ranges of (id, digest, a spread of the row's place), so neither one id nor one repeated
    row fills a task. The ranges are written once, as a table bucketed by range: all that follows reads the
    same ranges, and the window over a range needs no second shuffle of texts.
    """
    spark = docs.sparkSession
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text")).withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    order = ["id", "digest", "spread"]
    name = f"document_ranges_{uuid.uuid4().hex}"
    ranged = rows.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id())
    ranged.write.bucketBy(n, "range").sortBy("range").option("path", work_path(spark, name)).saveAsTable(name)
    ranged = spark.table(name)
    firsts = ranged.groupBy("range").agg(F.min_by("text", F.struct(*order)).alias("handed"))
    # one small row per range in this window
    by_number = Window.orderBy("range")
    before = F.coalesce(F.lag("range").over(by_number), F.max("range").over(Window.partitionBy()))
    numbers = ranged.select("range").distinct().select("range", before.alias("before"))
    handed = firsts.join(numbers, "range").select(F.col("before").alias("range"), "handed")
    following = F.lead("text").over(Window.partitionBy("range").orderBy(*order))
    joined = ranged.withColumn("following", following).join(handed, "range")
    return joined.select(F.col("id").alias(id_col), "text", F.coalesce("following", "handed").alias("next_text"))


def edited(text: Column, other: Column, share: int = SHARE) -> Column:
    """The text with its last 1/share of code points replaced by as many first ones of the other (or all)."""
    taken = F.floor(F.length(text) / share).cast("int")
    return F.concat(F.left(text, F.length(text) - taken), F.left(other, taken))


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: id, text, edited_text, the trees of both, and the comparisons with the edited and with the next text."""
    rows = with_next(docs, text, id_col).withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    for name in ("text", "edited_text", "next_text"):
        rows = with_tree(rows, name, name.replace("text", "tree"))
    rows = compare(rows, "tree", "edited_tree", "to_edited")
    return compare(rows, "tree", "next_tree", "to_next").drop("next_text", "next_tree")
