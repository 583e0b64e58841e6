"""Quality filter by weak supervision, in DataFrame functions only.

Measures of the whole text feed rules that vote for or against a document or abstain. The votes of
all documents are counted by pattern (at most 3 to the number of rules); expectation maximisation on
those counts estimates how often each rule is right about good and about bad documents, and the
posterior probability of being good decides, not the agreement of all rules.

Results for odd input: null and empty texts have no words, all rules abstain on them and they fail
the base test; repeated rows are judged each; an empty table gives no rows; extra columns pass
through untouched where asked for, whatever their names (one named like a result column is then there
twice).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import BLANKS, words, written

LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
KEEP_FROM = 0.5
WINDOW = 3
ROUNDS = 60
SETTLED = 1e-4
# First guess of how often a rule votes -1, 0 and 1 on good and on bad documents: rules seldom accuse
# good documents, and each sees only some kinds of bad ones.
FIRST_ON_GOOD = (0.03, 0.27, 0.70)
FIRST_ON_BAD = (0.40, 0.30, 0.30)
FIRST_SHARE = 0.8
# Documents that the first guess counts for, so that no vote is ever taken as proof.
PRIOR_DOCS = 2.0
VALUES = (-1, 0, 1)
SYMBOLS = "#*$%&|<>"


# --- measures -----------------------------------------------------------------------------------
def _window_digests(words_col: Column) -> Column:
    """One digest per window of consecutive words, in order."""
    starts = F.sequence(F.lit(0), F.size(words_col) - WINDOW)
    digest = lambda i: F.xxhash64(*(F.get(words_col, i + k) for k in range(WINDOW)))
    return F.when(F.size(words_col) >= WINDOW, F.transform(starts, digest)).otherwise(F.array().cast("array<long>"))


def measure(docs: DataFrame, text: str = "text", out: str = "measures") -> DataFrame:
    """Add a struct of measures of the whole text."""
    blank = rf"[^{BLANKS}]"
    df = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("_words", words(F.col("_text"))).withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(blank)))
    df = df.withColumn("_windows", _window_digests(F.col("_words")))
    # only texts in which a window repeats have their windows sorted together with their places
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda i: F.get(F.col("_sorted"), i)["h"]
    twice = F.filter("_sorted", lambda x, i: F.coalesce(x["h"] == near(i - 1), F.lit(False)) | F.coalesce(x["h"] == near(i + 1), F.lit(False)))
    df = df.withColumn("_places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n"), i.alias("last"))
    covered = F.when(F.col("_places").isNull(), F.lit(0).cast("long")).otherwise(F.aggregate("_places", start, step)["n"])
    only = lambda kept: F.length(F.regexp_replace("_text", f"[^{kept}]+", "")).cast("long")
    made = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        only(SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_kinds"),
        only("!").alias("n_exclaims"),
        only(r"\p{L}").alias("n_letters"),
        only("A-Z").alias("n_capitals"),
        only("a-z").alias("n_small"),
        F.size(F.filter("_lines", lambda line: line.rlike(rf"[.!?:;\"'»”…][{BLANKS}]*$"))).cast("long").alias("n_ended_lines"),
    )
    return df.withColumn(out, made).drop("_text", "_words", "_lines", "_windows", "_sorted", "_places")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEAT_PERCENT * m["n_words"])


# --- rules --------------------------------------------------------------------------------------
def _share(top: Column, bottom: Column) -> Column:
    """Null where there is nothing to divide by, on which a rule abstains."""
    return top / F.when(bottom > 0, bottom)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def votes(m: Column) -> list[Column]:
    """One vote per rule: 1 good, -1 bad, 0 abstains."""
    n = m["n_words"]
    symbols, dup = _share(m["n_symbols"], n), _share(m["n_dup_lines"], m["n_lines"])
    repeats, exclaims = _share(m["n_repeat_words"], n), _share(m["n_exclaims"], n)
    capitals = _share(m["n_capitals"], m["n_capitals"] + m["n_small"])
    kinds, ended = _share(m["n_kinds"], n), _share(m["n_ended_lines"], m["n_lines"])
    width, letters = _share(m["word_chars"], n), _share(m["n_letters"], m["word_chars"])
    return [
        _vote(symbols > 0.1, symbols < 0.02),
        _vote(dup > 0.4, dup == 0),
        _vote(repeats > 0.3, repeats < 0.15),
        _vote(exclaims > 0.2, exclaims < 0.05),
        _vote(capitals > 0.4, capitals < 0.15),
        # the share of different words falls with length, so only extremes speak
        _vote(kinds < 0.25, kinds > 0.5),
        _vote(ended < 0.25, ended > 0.9),
        _vote((width < 3.5) | (width > 7.0), (width > 4) & (width < 6.5)),
        _vote(letters < 0.75, letters > 0.9),
    ]


# --- expectation maximisation -------------------------------------------------------------------
@dataclass(frozen=True)
class Judge:
    """Share of good documents, and per rule the shares of its votes -1, 0 and 1 on good and on bad ones."""

    share: float
    on_good: tuple[tuple[float, ...], ...]
    on_bad: tuple[tuple[float, ...], ...]


def posterior(voted: list[Column], judge: Judge) -> Column:
    """Probability of being good, given the votes."""
    odds = F.lit(math.log(judge.share / (1 - judge.share)))
    for vote, good, bad in zip(voted, judge.on_good, judge.on_bad):
        said = F.lit(0.0)
        for value, g, b in zip(VALUES, good, bad):
            said = F.when(vote == value, F.lit(math.log(g / b))).otherwise(said)
        odds = odds + said
    return 1 / (1 + F.exp(-odds))


def estimate(voted: DataFrame, column: str = "votes") -> Judge:
    """Expectation maximisation over the counts of vote patterns; each round is one aggregation of
    at most 3 to the number of rules rows."""
    n_rules = len(votes(F.col("m")))
    patterns = written(voted.groupBy(column).agg(F.count("*").alias("docs")).coalesce(1), "vote-patterns")
    judge = Judge(FIRST_SHARE, (FIRST_ON_GOOD,) * n_rules, (FIRST_ON_BAD,) * n_rules)
    cast = [F.col(column)[j] for j in range(n_rules)]
    for _ in range(ROUNDS):
        good, bad = F.col("docs") * F.col("p"), F.col("docs") * (1 - F.col("p"))
        sums = [F.sum(good).alias("good"), F.sum("docs").alias("docs")]
        for j, vote in enumerate(cast):
            for value in VALUES:
                sums += [F.sum(F.when(vote == value, part)).alias(f"{side}{j}_{value}") for side, part in (("g", good), ("b", bad))]
        row = patterns.withColumn("p", posterior(cast, judge)).agg(*sums).first().asDict()
        if not row["docs"]:
            return judge

        def shares(side: str, j: int, total: float, first: tuple[float, ...]) -> tuple[float, ...]:
            return tuple(((row[f"{side}{j}_{v}"] or 0) + PRIOR_DOCS * f) / (total + PRIOR_DOCS) for v, f in zip(VALUES, first))

        new = Judge(
            (row["good"] + PRIOR_DOCS * FIRST_SHARE) / (row["docs"] + PRIOR_DOCS),
            tuple(shares("g", j, row["good"], FIRST_ON_GOOD) for j in range(n_rules)),
            tuple(shares("b", j, row["docs"] - row["good"], FIRST_ON_BAD) for j in range(n_rules)),
        )
        flat = lambda k: [k.share, *(x for side in (k.on_good, k.on_bad) for rule in side for x in rule)]
        moved = max(abs(a - b) for a, b in zip(flat(judge), flat(new)))
        judge = new
        if moved < SETTLED:
            break
    return judge


def judge_documents(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, measures, votes, p_good, base_failed and kept, for every document.

    Measures are written once to the shared folder: the estimate needs those of all documents before
    the first one can be judged.
    """
    # the caller's columns travel in a struct, so that their names meet none of those made here
    rows = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_whole"))
    measured = measure(rows, "_whole").drop("_whole")
    voted = written(measured.withColumn("votes", F.array(*votes(F.col("measures")))), "measures")
    # texts too short for any verdict would only blur what the rules mean
    judge = estimate(voted.where(F.col("measures.n_words") >= LEAST_WORDS))
    m, cast = F.col("measures"), [F.col("votes")[j] for j in range(len(judge.on_good))]
    judged = voted.withColumn("p_good", posterior(cast, judge)).withColumn("base_failed", base_failed(m))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_FROM))
    return judged.select(*(F.col("_row")[c].alias(c) for c in keep), "measures", "votes", "p_good", "base_failed", "kept")
