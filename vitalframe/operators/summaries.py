"""Session summaries: transcripts folded level by level until one reply per session is left."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.text import strip_fences
from vitalframe.operators.conversation import session_spans, session_transcripts
from vitalframe.operators.evaluation import score_batch
from vitalframe.operators.ranking import ranked
from vitalframe.sources.tables import append_new, materialize, work_path

SESSION = ("user_id", "session_id")

# Texts joined into one prompt, and the longest piece of a turn: together they bound every prompt of transcripts.
FAN_IN = 16
PIECE_CHARS = 4000
# Turns that share one bucket when pieces are numbered.
TURNS_PER_BUCKET = 64

# Keys that a summary reply carries.
SUMMARY_KEYS = ("main_topic", "key_concerns", "recommendations", "metrics_mentioned", "summary_text")
SUMMARY_HEAD = (
    "Sum up the talk below, or the partial summaries of it, as one JSON object with the keys "
    + ", ".join(SUMMARY_KEYS)
    + " (two or three sentences).\n---\n"
)


def transcript_pieces(transcripts: DataFrame, chars: int = PIECE_CHARS) -> DataFrame:
    """Turns cut into pieces of at most ``chars`` characters, numbered without gaps in each session.

    No character is lost. ``pos`` is the number from 1, ``nodes`` the session's number of pieces.
    """
    count = F.greatest(F.ceil(F.length("turn_text") / chars), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring("turn_text", i * chars + 1, F.lit(chars)))
    pieces = transcripts.select(*SESSION, "turn_no", F.posexplode(cut).alias("piece", "text"))
    bucket = F.lpad(F.floor(F.col("turn_no") / TURNS_PER_BUCKET).cast("string"), 18, "0")
    return ranked(pieces, SESSION, ["turn_no", "piece"], bucket, "pos", "nodes").select(*SESSION, "nodes", "pos", "text")


def fold_texts(
    texts: DataFrame, groups: Sequence[str], head: str, scorer: Callable[[pd.Series], pd.Series], fan_in: int = FAN_IN
) -> DataFrame:
    """One reply per group: ``fan_in`` neighbouring texts make a prompt, the replies are the next level's texts.

    ``texts`` has ``pos`` (1, 2, ... in each group), ``nodes`` (texts of the group) and ``text``. A row
    never holds more than ``fan_in`` texts, whatever the size of a group. Every level is written, so
    that no prompt is scored twice, and a group leaves as soon as one text is left; the driver learns
    one number, the largest group, which fixes the number of levels. A NULL reply counts as empty.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    spark = texts.sparkSession
    level = materialize(texts, work_path(spark, "fold_texts"))
    left = level.agg(F.max("nodes")).first()[0] or 0
    finished = None
    while finished is None or left > 1:
        ordered = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("text", F.lit("")).alias("text"))))
        chunk = F.floor((F.col("pos") - 1) / fan_in) + 1
        joined = level.groupBy(*groups, "nodes", chunk.alias("_chunk")).agg(ordered.alias("_texts"))
        prompts = joined.select(
            *groups,
            F.ceil(F.col("nodes") / fan_in).alias("nodes"),
            F.col("_chunk").alias("pos"),
            F.concat(F.lit(head), F.array_join(F.col("_texts.text"), "")).alias("_prompt"),
        )
        scored = score_batch(prompts, "_prompt", scorer, "text").drop("_prompt")
        scored = materialize(scored, work_path(spark, "fold_level"))
        last = scored.where("nodes = 1").select(*groups, F.col("text").alias("reply"))
        finished = last if finished is None else finished.unionByName(last)
        level, left = scored.where("nodes > 1"), -(-left // fan_in)
    return finished


def _part(path: str, kind: str) -> Column:
    return F.try_variant_get("_json", f"$.{path}", kind)


def summarize_sessions(
    history: DataFrame, scorer: Callable[[pd.Series], pd.Series], fan_in: int = FAN_IN, chars: int = PIECE_CHARS, head: str = SUMMARY_HEAD
) -> DataFrame:
    """What became of every session: its summary, or why it has none.

    Sessions of one message are not summed up; a reply that is not a JSON object, or empty, gives no
    summary. Absent texts are empty, absent or empty topics NULL, absent metrics an empty object.
    Messages without user or session belong to no session. The id is a digest of user, session and
    number of turns: repeating a run gives the same id, and a session that has grown a new one.
    """
    sessions = session_spans(history).dropna(subset=list(SESSION))
    pieces = transcript_pieces(session_transcripts(history), chars)
    replies = fold_texts(pieces, SESSION, head, scorer, fan_in)
    parsed = replies.withColumn("_json", F.try_parse_json(strip_fences("reply")))
    readable = F.schema_of_variant("_json").startswith("OBJECT")
    read = parsed.select(
        *SESSION,
        F.coalesce(readable, F.lit(False)).alias("_readable"),
        _part("main_topic", "string").alias("main_topic"),
        _part("summary_text", "string").alias("summary_text"),
        _part("key_concerns", "array<string>").alias("key_topics"),
        _part("recommendations", "array<string>").alias("recommendations"),
        F.to_json(_part("metrics_mentioned", "variant")).alias("mentioned_metrics"),
    )
    found = sessions.join(read, list(SESSION), "left")
    created = F.coalesce(F.col("_readable"), F.lit(False))

    def said(value: Column) -> Column:
        return F.when(created, value)

    return found.select(
        F.md5(F.concat_ws("|", *SESSION, F.col("turns").cast("string"))).alias("summary_id"),
        *SESSION,
        created.alias("summary_created"),
        F.when(~created, F.when(F.col("turns") < 2, "Not enough messages").otherwise("Unreadable reply")).alias("reason"),
        F.lit("session_summary").alias("summary_type"),
        said(F.col("main_topic")).alias("main_topic"),
        said(F.coalesce("summary_text", F.lit(""))).alias("summary_text"),
        said(F.when(F.size("key_topics") > 0, F.col("key_topics"))).alias("key_topics"),
        said(F.col("recommendations")).alias("recommendations"),
        said(F.coalesce("mentioned_metrics", F.lit("{}"))).alias("mentioned_metrics"),
        "domain", "turns", "time_period_start", "time_period_end",
    )


SAVED_COLUMNS = (
    "summary_id", "user_id", "summary_type", "summary_text", "key_topics", "domain", "mentioned_metrics",
    "time_period_start", "time_period_end",
)


def save_summaries(summaries: DataFrame, path: str) -> None:
    """Append the summaries that were created to the table at ``path``, by starting day; again adds nothing."""
    created = summaries.where("summary_created").select(
        *SAVED_COLUMNS, F.current_timestamp().alias("created_at"), F.to_date("time_period_start").alias("summary_date")
    )
    append_new(created, path, ["summary_id"], "summary_date")
