"""Text column functions: templates, label clean-up and small formats."""

from __future__ import annotations

from functools import reduce
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalframe.functions import vocab
from vitalframe.functions.rules import first_match, lookup


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fill(template: str, **columns: Column) -> Column:
    """Fill ``{name}`` places with columns as text; one NULL makes the whole text NULL."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(columns.get(name, F.col(name)).cast("string"))
    return F.concat(*parts)


def said_if(cond: Column, text: str | Column) -> Column:
    """The text when the condition holds, otherwise nothing."""
    return F.when(cond, text).otherwise("")


def like_any(col: str | Column, patterns: list[str]) -> Column:
    c = _c(col)
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])


def contains_any(col: str | Column, words: list[str]) -> Column:
    c = _c(col)
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def hits(col: str | Column, words: list[str]) -> Column:
    """The listed words that occur in the text, in list order.

    One generated test per word; a lambda over the word list would run interpreted and prepare the
    text again for every word.
    """
    c = _c(col)
    return F.array_compact(F.array(*[F.when(c.contains(w), w) for w in words]))


def strip(col: str | Column) -> Column:
    """Trim every kind of white space, line breaks included."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def strip_fences(col: str | Column) -> Column:
    """Content of the first fenced block, or the text itself when there is none."""
    text = strip(col)

    def inside(mark: str) -> Column:
        return strip(F.get(F.split(F.get(F.split(text, mark), F.lit(1)), "```"), F.lit(0)))

    return first_match([(inside("```json"), text.contains("```json")), (inside("```"), text.contains("```"))], text)


def clean_reply(col: str | Column, metrics_context: Column | None = None) -> Column:
    """Remove structural labels and lines, collapse blank lines, praise progress when there is any."""
    text = _c(col)
    for pattern, replacement in vocab.REPLY_LABELS:
        text = F.regexp_replace(text, f"(?i){pattern}", replacement)

    def keep(line: Column) -> Column:
        bare = strip(line)
        return ~bare.isin(vocab.STRUCTURAL_LINES) & ~bare.rlike(f"(?i){vocab.STRUCTURAL_LINE_PATTERN}")

    text = F.array_join(F.filter(F.split(text, "\n"), keep), "\n")
    text = F.regexp_replace(text, "\n\n\n+", "\n\n")
    if metrics_context is not None:
        improved = F.coalesce(F.lower(metrics_context).contains("improved"), F.lit(False))
        text = F.concat(said_if(improved, vocab.PROGRESS_PREFIX), text)
    return strip(text)


def remove_false_recall(col: str | Column) -> Column:
    text = _c(col)
    for pattern in vocab.FALSE_RECALL_PATTERNS:
        text = F.regexp_replace(text, f"(?i){pattern}", "")
    text = F.regexp_replace(text, "\n\n+", "\n\n")
    return strip(F.regexp_replace(text, "  +", " "))


def format_reply(reply: Column, domain: Column, urgency: Column, confidence: Column) -> Column:
    """Header, reply, urgency badge and confidence line."""
    share = F.floor(F.coalesce(confidence, F.lit(0.5)) * 100).cast("string")
    return F.concat(
        lookup(domain, vocab.DOMAIN_ICONS, vocab.DEFAULT_ICON),
        F.lit(" **"),
        F.initcap(F.replace(domain, F.lit("_"), F.lit(" "))),
        F.lit(" Assistant**\n\n"),
        reply,
        F.lit("\n\n"),
        lookup(urgency, vocab.URGENCY_BADGES, ""),
        F.lit("\n\n---\n*Classification confidence: "),
        share,
        F.lit(f"%*  \n{vocab.REPLY_FOOTER}\n"),
    )


def reply_urgency(col: str | Column) -> Column:
    c = _c(col)
    return first_match([(label, c.contains(mark)) for label, mark in vocab.REPLY_MARKERS.items()], "routine")


def predict_label(col: str | Column) -> Column:
    """Urgency named in a free-text prediction; ``unclear`` when no phrase is found."""
    return first_match(
        [(label, like_any(col, patterns)) for label, patterns in vocab.PREDICTION_PHRASES.items()], "unclear"
    )


def document_type(col: str | Column) -> Column:
    name = F.lower(_c(col))
    return first_match([(t, contains_any(name, words)) for t, words in vocab.DOCUMENT_TYPES.items()], "other")


def format_bytes(col: str | Column) -> Column:
    """One decimal, halves to even, units of 1024."""
    size = _c(col).cast("double")
    units = ["B", "KB", "MB", "GB"]
    scaled = [size / F.lit(float(1024**i)) for i in range(5)]

    def shown(i: int, unit: str) -> Column:
        return F.concat(F.bround(scaled[i], 1).cast("string"), F.lit(f" {unit}"))

    cases = [(shown(i, unit), scaled[i] < 1024) for i, unit in enumerate(units)]
    return first_match(cases, shown(4, "TB"))


def bmi(weight_kg: str | Column, height_cm: str | Column) -> Column:
    """Body mass index, one decimal; NULL unless both measures are positive."""
    w, h = _c(weight_kg), _c(height_cm)
    metres = h / 100
    return F.when((w > 0) & (h > 0), F.bround(w / (metres * metres), 1))


def valid_email(col: str | Column) -> Column:
    return F.coalesce(_c(col).rlike(vocab.EMAIL_PATTERN), F.lit(False))
