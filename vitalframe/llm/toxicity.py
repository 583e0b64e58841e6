"""Toxicity as a weighted finite-state pattern grammar over clauses.

Words are mapped to classes (insult, threat, target, negation, report); small transducers, each
following one pattern, are composed into a single machine that reads a document word by word and
emits an event wherever an insult or threat is matched in its clause: aimed at someone, negated,
reported, or bare. A document's score is the logistic of the weighted events, so that a negated or
reported insult can weigh less than one that is aimed at the reader.

Two things are learned from labelled rows: insult stems (word beginnings that toxic documents share
and clean ones lack, in any language) and the weight of every event. Fitting reads at most
SAMPLE_ROWS labelled documents of each class, taken by the smallest digest of the id; scoring reads
every whole text.

Results for odd input: null and empty texts have no events and get the score of a text without any;
rows with a null label or id teach nothing; without labelled rows of both classes the fixed words and
weights below are used; repeated rows are scored each; extra columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.common import written

# Digest ranges that labelled ids are counted by.
RANGE_BITS = 16
SAMPLE_ROWS = 6_000
THRESHOLD = 0.3
HELD_OUT = 2
FOLDS = 4
# A stem counts as learned when it is this much more frequent in toxic than in clean documents,
# seldom enough in clean ones, and shared by enough toxic ones.
STEM_LENGTHS = range(3, 11)
LEAST_ODDS = 60.0
MOST_CLEAN_SHARE = 0.003
LEAST_TOXIC_ROWS = 4
LEAST_TOXIC_SHARE = 0.002
# digests of texts, small enough that a sample's sum fits 63 bits
DIGEST_BITS = 50
# toxic documents that a stem must newly explain for every clean one it would hit
LEAST_GAIN = 8
RIDGE = 1e-3
MEMO_WORDS = 100_000
# entries a task holds before it hands on its partial counts
COUNTED_STEMS = 60_000

# Closed word classes in the four languages of the corpus.
INSULTS = ["idiot", "moron", "scum", "trash", "loser", "clown", "stupid", "worthless", "pathetic", "disgusting"]
THREATS = ["kill", "hurt", "destroy", "murder", "stab", "shoot", "töten", "umbringen", "tuer", "matar", "matarte"]
TARGETS = [
    "you", "your", "yourself", "he", "she", "they", "them", "his", "her", "him", "their",
    "du", "dich", "dir", "dein", "ihr", "euch", "tu", "toi", "vous", "ton", "votre", "tú", "usted", "vosotros",
]
NEGATIONS = ["not", "no", "never", "without", "nicht", "kein", "keine", "nie", "pas", "jamais", "sans", "nunca", "sin"]
REPORTS = ["said", "says", "called", "quoted", "wrote", "sagte", "nannte", "schrieb", "dit", "appelé", "écrit", "dijo", "llamó", "escribió"]
DEFAULT_WEIGHTS = {"": -3.0, "bare": 1.5, "aimed": 2.5, "denied": 0.5, "reported": 0.5, "threat": 2.5}

TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
WORD, END, NEGATION, REPORT, TARGET, THREAT, INSULT = range(7)
EVENTS = ["bare", "aimed", "denied", "reported", "threat"]

Machine = dict[tuple[int, int], tuple[int, str | None]]


# --- the grammar --------------------------------------------------------------------------------
def _negation(state: int, kind: int) -> tuple[int, bool]:
    """Reach of a negation: the three words after it, within its clause."""
    return (0, False) if kind == END else (3, False) if kind == NEGATION else (max(0, state - 1), state > 0)


def _until_end(opener: int):
    """On from the opening class to the end of the clause."""

    def step(state: int, kind: int) -> tuple[int, bool]:
        return (0, False) if kind == END else (int(state or kind == opener), bool(state))

    return step


def _strike(state: int, kind: int) -> tuple[int, str | None]:
    """Which matched word the clause has had last, so that a target may also follow it."""
    if kind in (INSULT, THREAT):
        return kind, "insult" if kind == INSULT else "threat"
    if kind == END:
        return 0, None
    return (0, "late") if kind == TARGET and state else (state, None)


def compose() -> Machine:
    """Product of the four transducers: (state, class) to (next state, event); states by number, 0 first."""
    reported, aimed = _until_end(REPORT), _until_end(TARGET)
    numbers = {(0, 0, 0, 0): 0}
    todo, machine = [(0, 0, 0, 0)], {}
    while todo:
        now = todo.pop()
        for kind in range(INSULT + 1):
            (n, denied), (r, told), (a, at), (s, hit) = _negation(now[0], kind), reported(now[1], kind), aimed(now[2], kind), _strike(now[3], kind)
            event = None
            if hit == "insult":
                event = "denied" if denied else "reported" if told else "aimed" if at else "bare"
            elif hit == "threat":
                event = "denied" if denied else "reported" if told else "threat" if at else None
            elif hit == "late" and not now[1]:
                event = "aimed" if now[3] == INSULT else "threat"
            nxt = (n, r, a, s)
            if nxt not in numbers:
                numbers[nxt] = len(numbers)
                todo.append(nxt)
            machine[numbers[now], kind] = numbers[nxt], event
    return machine


@dataclass(frozen=True)
class Grammar:
    """Learned stems (with "*" for any ending) and event weights."""

    stems: tuple[str, ...]
    weights: tuple[tuple[str, float], ...]


class Reader:
    """Runs the composed machine over texts."""

    def __init__(self, stems: Sequence[str]):
        fixed = [(NEGATIONS, NEGATION), (REPORTS, REPORT), (TARGETS, TARGET), (THREATS, THREAT)]
        self.classes = {w: kind for words, kind in fixed for w in words}
        self.classes |= {s: INSULT for s in stems if not s.endswith("*")} | dict.fromkeys(".!?;\n", END)
        self.stems = {s[:-1] for s in stems if s.endswith("*")}
        self.lengths = sorted({len(s) for s in self.stems})
        self.machine = compose()
        self.memo: dict[str, int] = {}

    def kind(self, word: str) -> int:
        out = self.memo.get(word)
        if out is None:
            out = self.classes.get(word, WORD)
            if out != INSULT and any([word[:k] in self.stems for k in self.lengths if len(word) > k]):
                out = INSULT
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = out
        return out

    def events(self, text: str | None) -> Counter:
        kinds = list(map(self.kind, TOKEN.findall((text or "").lower())))
        found: Counter = Counter()
        if not kinds or max(kinds) < THREAT:
            return found
        state = 0
        for kind in kinds:
            state, event = self.machine[state, kind]
            if event:
                found[event] += 1
        return found


def event_vector(found: Counter) -> list[float]:
    """Constant, then per event its damped count."""
    return [1.0, *(math.log1p(found[e]) for e in EVENTS)]


# --- learning -----------------------------------------------------------------------------------
def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, held_out: int | None = HELD_OUT) -> DataFrame:
    """text and label of at most so many documents per class, those with the smallest id digests."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    if held_out is not None:
        one = one.where(fold(F.col("doc_id")) != held_out)
    # counted digest ranges (at most 2 * 2^RANGE_BITS rows) tell which of them hold the smallest digests,
    # so that only the ids of those ranges are ranked, each range by itself
    digest = F.xxhash64("doc_id")
    one = one.withColumn("digest", digest).withColumn("range", F.shiftright("digest", 64 - RANGE_BITS))
    counts = one.groupBy("label", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("label").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).where(F.col("before") < rows).drop("n")
    inside = F.row_number().over(Window.partitionBy("label", "range").orderBy("digest", "doc_id"))
    # at most one range per sampled row and class
    ranked = one.join(F.broadcast(ranges), ["label", "range"]).withColumn("place", F.col("before") + inside)
    chosen = ranked.where(F.col("place") <= rows).select("doc_id", "label")
    # at most twice the sample size of ids, so that no text is shuffled to find the sample
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
    return found.dropDuplicates(["text", "label"])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def _stem_counts(sample: DataFrame) -> DataFrame:
    """Documents of each class per word and word beginning."""

    def flushed(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        stems = list(counts[1].keys() | counts[0].keys())
        columns = [pa.array(stems, pa.string()), *(pa.array([counts[k][s] for s in stems], pa.int64()) for k in (1, 0))]
        for part in counts:
            part.clear()
        if stems:
            yield pa.RecordBatch.from_arrays(columns, names=["stem", "toxic", "clean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label")):
                seen = set(TOKEN.findall((text.as_py() or "").lower()))
                own = counts[label.as_py()]
                own.update(w for w in seen if len(w) > 2)
                own.update({w[:k] + "*" for w in seen for k in STEM_LENGTHS if len(w) > k})
                # partial counts; the sum after the shuffle makes them whole
                if len(own) > COUNTED_STEMS:
                    yield from flushed(counts)
        yield from flushed(counts)

    counts = sample.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "stem string, toxic long, clean long")
    return counts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _hits(sample: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """label, digest of the text and numbers of the candidates it holds, for rows that hold any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {s: n for n, s in enumerate(candidates)}
        for batch in batches:
            hits = []
            for text in batch.column("text").to_pylist():
                seen = set(TOKEN.findall((text or "").lower()))
                seen |= {w[:k] + "*" for w in seen for k in STEM_LENGTHS if len(w) > k}
                hits.append(sorted(number[s] for s in seen if s in number))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("digest"), pa.array(hits, pa.list_(pa.int32()))], names=["label", "digest", "hits"])

    digest = F.xxhash64("text").bitwiseAND(F.lit((1 << DIGEST_BITS) - 1))
    rows = sample.select(F.col("label").cast("int").alias("label"), "text", digest.alias("digest"))
    return rows.mapInArrow(run, "label int, digest long, hits array<int>").where(F.size("hits") > 0)


def _best_of_equals(sample: DataFrame, stems: Sequence[str]) -> list[str]:
    """Of stems in the same toxic documents, the one the greedy step would take first; the others then explain nothing."""
    toxic = F.col("label") == 1
    held = _hits(sample, stems).select("label", "digest", F.explode("hits").alias("n")).groupBy("n")
    held = held.agg(F.count(F.when(toxic, 1)).alias("toxic"), F.sum(F.when(toxic, F.col("digest"))).alias("holders"), F.count(F.when(~toxic, 1)).alias("clean"))
    best: dict[tuple[int, int], tuple[int, int, str]] = {}
    for n, count, holders, clean in held.collect():
        rank = (-clean, -len(stems[n]), stems[n])
        best[count, holders] = max(rank, best.get((count, holders), rank))
    return sorted(stem for _, _, stem in best.values())


def learned_stems(sample: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """The fixed insults, and the word beginnings and words that mark toxic documents."""
    odds = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    strong = (
        _stem_counts(sample)
        .where((F.col("toxic") >= max(LEAST_TOXIC_ROWS, LEAST_TOXIC_SHARE * n_toxic)) & (F.col("clean") <= MOST_CLEAN_SHARE * n_clean))
        .where(odds >= min(LEAST_ODDS, 0.5 * (n_clean + 1) * LEAST_TOXIC_ROWS / (n_toxic + 1)))
    )
    # the bounded sample bounds the stems too
    stems = [r["stem"] for r in strong.select("stem").collect() if r["stem"] not in INSULTS]
    candidates = [*INSULTS, *_best_of_equals(sample, stems)]
    # at most one list of such stems per document of the bounded sample
    held = _hits(sample, candidates).select("label", "hits").collect()
    holders: dict[int, set[int]] = {}
    clean: Counter = Counter()
    for doc, row in enumerate(held):
        for n in row["hits"]:
            if row["label"]:
                holders.setdefault(n, set()).add(doc)
            else:
                clean[n] += 1
    # Copies of one toxic document share all their words. A stem therefore counts only the documents
    # that no stem taken before it explains; the rare words of copies explain nothing new.
    kept, explained = list(INSULTS), set().union(*(holders.get(n, set()) for n in range(len(INSULTS))))
    least = max(LEAST_TOXIC_ROWS, LEAST_TOXIC_SHARE * n_toxic)
    while True:
        gains = [(len(docs - explained), -clean[n], -len(candidates[n]), candidates[n], n) for n, docs in holders.items() if n >= len(INSULTS)]
        gain = max(gains, default=(0,))
        if gain[0] < least or gain[0] < LEAST_GAIN * (clean[gain[-1]] + 0.5):
            return kept
        kept.append(gain[3])
        explained |= holders[gain[-1]]


def fit_weights(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(vectors.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(vectors @ w, -30, 30)))
        slope = vectors.T @ (labels - p) / len(labels) - RIDGE * w
        bend = (vectors * (p * (1 - p))[:, None]).T @ vectors / len(labels) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, held_out: int | None = HELD_OUT) -> Grammar:
    """Stems and event weights from a bounded sample of labelled documents."""
    sample = written(labelled_sample(docs, labels, rows, held_out), "toxicity-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Grammar(tuple(INSULTS), tuple(DEFAULT_WEIGHTS.items()))
    stems = sorted(learned_stems(sample, sizes[1], sizes[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(stems)
        for batch in batches:
            vectors = [event_vector(reader.events(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(vectors, pa.list_(pa.float64()))], names=["label", "x"])

    # equal event vectors are counted, so that what reaches the driver is at most the sample
    seen = sample.select(F.col("label").cast("int").alias("label"), "text").mapInArrow(run, "label int, x array<double>").groupBy("label", "x").count().orderBy("label", "x").collect()
    x = np.repeat(np.array([r["x"] for r in seen]), [r["count"] for r in seen], axis=0)
    y = np.repeat(np.array([r["label"] for r in seen], float), [r["count"] for r in seen])
    weights = fit_weights(x, y)
    # the sample holds the classes in other shares than the labelled rows; the constant is left as
    # fitted, which leans towards the rarer class
    return Grammar(tuple(stems), tuple(zip(["", *EVENTS], map(float, weights))))


def score(docs: DataFrame, grammar: Grammar, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The kept columns (all by default), score and the counts of matched events."""
    keep = list(docs.columns if keep is None else keep)
    names = ["score", *(f"n_{e}" for e in EVENTS)]
    clash = set(names) & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in the way")
    weights, stems = np.array([w for _, w in grammar.weights]), grammar.stems
    schema = f"{', '.join(f'`{c}` {docs.schema[c].dataType.simpleString()}' for c in keep)}, score double, {', '.join(f'n_{e} long' for e in EVENTS)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(stems)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [reader.events(t) for t in part.column(text).to_pylist()]
                z = np.array([event_vector(f) for f in found]) @ weights
                made = [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))), *(pa.array([f[e] for f in found], pa.int64()) for e in EVENTS)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=[*keep, *names])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)
