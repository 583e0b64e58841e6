"""Message triage, routing, metric extraction and conversation tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitalframe.functions import vocab
from vitalframe.functions.rules import age_years, band_half_open, first_match, flag, lookup
from vitalframe.functions.text import (
    bmi,
    clean_reply,
    document_type,
    format_bytes,
    format_reply,
    hits,
    remove_false_recall,
    valid_email,
)
from vitalframe.operators.aggregates import latest_k
from vitalframe.operators.ranking import ranked


# --- triage and routing -------------------------------------------------------------------------
def triage_message(df: DataFrame, text: str) -> DataFrame:
    """Keyword triage: the first emergency word decides alone, then urgent words, then symptom words."""
    found = df.withColumn("_low", F.lower(F.col(text))).withColumns(
        {
            "_emergency": hits("_low", vocab.EMERGENCY_KEYWORDS),
            "_urgent": hits("_low", vocab.URGENT_KEYWORDS),
            "_symptoms": hits("_low", vocab.SYMPTOM_KEYWORDS),
        }
    )
    emergency, urgent = F.size("_emergency") > 0, F.size("_urgent") > 0
    return found.withColumns(
        {
            "is_emergency": flag(emergency),
            "local_urgency": first_match(
                [("emergency", emergency), ("urgent", urgent), ("needs_attention", F.size("_symptoms") >= 3)],
                "routine",
            ),
            "detected_symptoms": F.when(emergency, F.slice("_emergency", 1, 1))
            .when(urgent, F.col("_urgent"))
            .otherwise(F.col("_symptoms")),
        }
    ).drop("_low", "_emergency", "_urgent", "_symptoms")


def route_domain(
    df: DataFrame, text: str, keywords: Mapping[str, Sequence[str]] = vocab.DOMAIN_KEYWORDS, default: str = "out_of_scope"
) -> DataFrame:
    """Domain with the most keyword hits; the earlier domain wins a tie; no hit leaves the scope."""
    low = df.withColumn("_low", F.lower(F.col(text)))
    counts = {d: F.size(hits("_low", [w.lower() for w in words])) for d, words in keywords.items()}
    scored = low.withColumn("_hits", F.struct(*[c.alias(d) for d, c in counts.items()]))
    best = F.greatest(*[F.col(f"_hits.{d}") for d in counts])
    domain = first_match([(d, (best > 0) & (F.col(f"_hits.{d}") == best)) for d in counts], default)
    return (
        scored.withColumns({"domain_hits": best, "routed_domain": domain})
        .withColumn("specialist_model", lookup("routed_domain", vocab.DOMAIN_MODELS))
        .drop("_low", "_hits")
    )


def resolve_urgency(df: DataFrame, routed: str, scope: str | None = None) -> DataFrame:
    """Local emergencies and urgent findings overrule the routed urgency; out of scope stays routine."""
    local = F.col("local_urgency")
    overrule = F.col("is_emergency") | (local == "urgent")
    out = df.withColumns(
        {
            "final_urgency": F.when(overrule, F.upper(local)).otherwise(F.upper(F.col(routed))),
            "safety_flags": F.when(overrule, F.col("detected_symptoms")).otherwise(F.array().cast("array<string>")),
        }
    )
    if scope:
        out = out.withColumn(
            "final_urgency", F.when(F.col(scope) == "out_of_scope", "ROUTINE").otherwise(F.col("final_urgency"))
        )
    return out


# --- metrics ------------------------------------------------------------------------------------
def _metric(kind: str, value: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("metric_type"),
        value.alias("metric_value"),
        F.lit(vocab.METRIC_UNITS[kind]).alias("metric_unit"),
    )


def _within(kind: str, value: Column) -> Column:
    lo, hi = vocab.METRIC_RANGES[kind]
    return value.between(lo, hi)


def _numbers(text: Column, pattern: str, group: int = 1) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), F.lit(group))
    return F.transform(found, lambda v: v.cast("double"))


def _readings(text: Column) -> Column:
    """Every plausible reading in the text, repeats removed, first mention first."""
    sys_kind, dia_kind = "blood_pressure_systolic", "blood_pressure_diastolic"
    pairs = F.arrays_zip(
        _numbers(text, vocab.BLOOD_PRESSURE_PATTERN, 1).alias("s"), _numbers(text, vocab.BLOOD_PRESSURE_PATTERN, 2).alias("d")
    )
    plausible = F.filter(pairs, lambda p: _within(sys_kind, p["s"]) & _within(dia_kind, p["d"]))
    pressure = F.flatten(F.transform(plausible, lambda p: F.array(_metric(sys_kind, p["s"]), _metric(dia_kind, p["d"]))))

    def single(kind: str, pattern: str) -> Column:
        return F.transform(F.filter(_numbers(text, pattern), lambda v: _within(kind, v)), lambda v: _metric(kind, v))

    sugar = [single("blood_sugar", p) for p in vocab.BLOOD_SUGAR_PATTERNS]
    return F.array_distinct(F.concat(pressure, *sugar, single("hba1c", vocab.HBA1C_PATTERN)))


def extract_metrics(
    df: DataFrame,
    texts: Sequence[str],
    keys: Sequence[str],
    domain: str | None = None,
    domains: Sequence[str] = tuple(vocab.EXTRACTION_DOMAINS),
) -> DataFrame:
    """One row per distinct reading found in the texts of a row; other domains are skipped."""
    kept = df.filter(F.col(domain).isin(list(domains))) if domain else df
    text = F.concat_ws(" ", *[F.coalesce(F.col(t), F.lit("")) for t in texts])
    return kept.select(*keys, F.explode(_readings(text)).alias("m")).select(*keys, "m.*")


def grade_metric(df: DataFrame) -> DataFrame:
    kind, value = F.col("metric_type"), F.col("metric_value")
    grades = first_match(
        [
            (band_half_open(value, limits, ("normal", "mild", "moderate", "severe"), "normal"), kind == name)
            for name, limits in vocab.METRIC_GRADES.items()
        ],
        "normal",
    )
    return df.withColumn("severity", grades).withColumn("is_abnormal", F.col("severity") != "normal")


# Where an extracted reading comes from and how far it is trusted.
EXTRACTED_SOURCE = "conversation_extracted"
EXTRACTED_CONFIDENCE = 0.95


def saved_readings(history: DataFrame) -> DataFrame:
    """Graded readings of all messages as rows of the metrics table.

    The id is a digest of message, type and value and the date is the message's, so the same message
    always gives the same rows.
    """
    keys = ["conversation_id", "user_id", "message_timestamp"]
    graded = grade_metric(extract_metrics(history, ["user_message", "assistant_response"], keys, "routed_to_domain"))
    return graded.select(
        F.md5(F.concat_ws("|", "conversation_id", "metric_type", F.col("metric_value").cast("string"))).alias("metric_id"),
        "user_id", "conversation_id", "metric_type", "metric_value", "metric_unit",
        F.to_date("message_timestamp").alias("measurement_date"),
        F.col("message_timestamp").alias("reported_date"),
        F.lit(EXTRACTED_SOURCE).alias("source"),
        F.lit(EXTRACTED_CONFIDENCE).alias("confidence_score"),
        "is_abnormal", "severity",
    )


def metric_trends(
    metrics: DataFrame, as_of: dt.date, days: int = 90, tie: str = "metric_id", types: Sequence[str] | None = None
) -> DataFrame:
    """First and latest value per user and metric with the direction of change.

    First and latest are partial aggregates, so a hot series never meets in one task.
    """
    recent = metrics.filter(F.col("measurement_date") >= F.lit(as_of - dt.timedelta(days=days)))
    if types:
        recent = recent.filter(F.col("metric_type").isin(list(types)))
    when = F.struct("measurement_date", tie)
    ends = recent.groupBy("user_id", "metric_type").agg(
        F.min_by("metric_value", when).alias("first_value"),
        F.max_by("metric_value", when).alias("current_value"),
        F.max("measurement_date").alias("latest_date"),
        F.count("*").alias("data_points"),
    )
    first, last = F.col("first_value"), F.col("current_value")
    change = F.when((F.col("data_points") < 2) | (first == 0), 0.0).otherwise(
        (last - first) / F.nullif(first, F.lit(0.0)) * 100
    )
    return (
        ends.withColumn("_change", change)
        .withColumns(
            {
                "trend": first_match(
                    [
                        ("single_reading", F.col("data_points") < 2),
                        ("stable", F.abs("_change") < 5),
                        ("increasing", F.col("_change") > 0),
                    ],
                    "decreasing",
                ),
                "percent_change": F.round("_change", 1),
            }
        )
        .drop("_change")
    )


# Readings of one day are split by the first characters of their id, so a busy day is not one sort.
TIE_PREFIX = 4


def metric_series(metrics: DataFrame, as_of: dt.date, days: int = 90, tie: str = "metric_id") -> DataFrame:
    """The readings behind a trend as rows, numbered in time order, so a series may have any length."""
    recent = metrics.filter(F.col("measurement_date") >= F.lit(as_of - dt.timedelta(days=days)))
    bucket = F.concat_ws("|", F.col("measurement_date").cast("string"), F.left(F.col(tie), F.lit(TIE_PREFIX)))
    return ranked(recent, ["user_id", "metric_type"], ["measurement_date", tie], bucket, "position").select("user_id", "metric_type", "position", "measurement_date", "metric_value")


# --- conversation tables ------------------------------------------------------------------------
def searchable(history: DataFrame) -> DataFrame:
    return history.withColumns(
        {
            "combined_text": F.concat("user_message", F.lit(" "), "assistant_response"),
            "conversation_date": F.to_date("message_timestamp"),
        }
    )


def session_spans(history: DataFrame) -> DataFrame:
    """Turns, first domain and span of each session."""
    return history.groupBy("user_id", "session_id").agg(
        F.count("*").alias("turns"),
        F.min_by("routed_to_domain", F.struct("message_timestamp", "conversation_id")).alias("domain"),
        F.min("message_timestamp").alias("time_period_start"),
        F.max("message_timestamp").alias("time_period_end"),
    )


def session_transcripts(history: DataFrame, min_turns: int = 2) -> DataFrame:
    """Transcript of each session, one row per numbered turn, with the span and first domain of the session.

    Joined in the order of ``turn_no`` the texts are the whole transcript; a session of any length never
    has to fit into one row. A missing message is an empty one.
    """
    keys = ["user_id", "session_id"]
    spans = session_spans(history).filter(F.col("turns") >= min_turns)
    numbered = ranked(
        history.select(*keys, "message_timestamp", "conversation_id", "user_message", "assistant_response"),
        keys,
        ["message_timestamp", "conversation_id"],
        F.date_format("message_timestamp", "yyyy-MM-dd HH:mm"),
        "turn_no",
    )
    text = F.concat(
        F.lit("\nTurn "), F.col("turn_no").cast("string"),
        F.lit(":\nUser: "), F.coalesce("user_message", F.lit("")),
        F.lit("\nAssistant: "), F.coalesce("assistant_response", F.lit("")), F.lit("\n"),
    )
    return numbered.select(*keys, "turn_no", text.alias("turn_text")).join(spans, keys)


def session_summaries(history: DataFrame) -> DataFrame:
    """Summary rows of sessions with at least two turns; the text is built from counts, not by a model."""
    return session_spans(history).filter("turns >= 2").select(
        F.md5(F.concat_ws("|", "user_id", "session_id")).alias("summary_id"),
        "user_id",
        F.lit("session_summary").alias("summary_type"),
        F.concat(F.col("domain"), F.lit(" session with "), F.col("turns").cast("string"), F.lit(" turns")).alias(
            "summary_text"
        ),
        "domain",
        "time_period_start",
        "time_period_end",
    )


def pair_turns(messages: DataFrame) -> DataFrame:
    """User message with the assistant reply that follows it."""
    asked = messages.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("user_message")
    )
    replied = messages.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("assistant_response")
    )
    return asked.join(replied, ["conv_id", "turn"])


def unpair_turns(pairs: DataFrame) -> DataFrame:
    """Paired rows back to one row per message."""
    rows = F.array(
        F.struct(F.col("turn").alias("turn"), F.lit("user").alias("role"), F.col("user_message").alias("text")),
        F.struct(
            (F.col("turn") + 1).alias("turn"), F.lit("assistant").alias("role"), F.col("assistant_response").alias("text")
        ),
    )
    return pairs.select("conv_id", F.explode(rows).alias("m")).select("conv_id", "m.*")


def clean_replies(df: DataFrame, reply: str, metrics_context: str | None = None) -> DataFrame:
    context = F.col(metrics_context) if metrics_context else None
    return df.withColumn("cleaned_response", clean_reply(reply, context))


def without_history(users: DataFrame, history: DataFrame) -> DataFrame:
    return users.join(history.select("user_id"), "user_id", "left_anti")


def strip_false_recall(replies: DataFrame, reply: str, history: DataFrame) -> DataFrame:
    """Remove claims of earlier talks from replies to users who have none on record."""
    known = history.select("user_id").distinct().withColumn("_known", F.lit(True))
    joined = replies.join(known, "user_id", "left")
    text = F.when(F.col("_known"), F.col(reply)).otherwise(remove_false_recall(reply))
    return joined.withColumn("checked_response", text).drop("_known")


def format_replies(df: DataFrame, reply: str, domain: str, urgency: str, confidence: str) -> DataFrame:
    return df.withColumn(
        "final_response", format_reply(F.col(reply), F.col(domain), F.col(urgency), F.col(confidence))
    )


# --- users, profiles and documents --------------------------------------------------------------
def user_profile(users: DataFrame, profiles: DataFrame) -> DataFrame:
    return users.join(profiles, "user_id", "left")


def patient_context(profile: DataFrame, as_of: dt.date, title: str = "Conditions") -> DataFrame:
    """Profile sentence of each user: age, conditions and body mass index where known."""
    age = age_years("date_of_birth", as_of)
    index = bmi("weight_kg", "height_cm")
    trimester = F.coalesce(F.col("pregnancy_trimester").cast("string"), F.lit("?"))
    conditions = F.concat_ws(
        ", ",
        *[F.when(F.col(c), word) for c, word in vocab.PROFILE_CONDITIONS.items()],
        F.when(F.col("is_pregnant"), F.concat(F.lit("pregnant (trimester "), trimester, F.lit(")"))),
    )

    def line(head: str, value: Column, known: Column) -> Column:
        return F.when(known, F.concat(F.lit(f"- {head}: "), value.cast("string"), F.lit("\n"))).otherwise("")

    return profile.withColumn(
        "patient_context",
        F.concat(
            F.lit("PATIENT PROFILE:\n"),
            line("Age", age, age.isNotNull() & (age != 0)),
            line(title, conditions, conditions != ""),
            line("BMI", index, index.isNotNull()),
        ),
    )


# Fields that make a profile complete, short and long form, and the bands of the result.
SHORT_PROFILE = ("height_cm", "weight_kg", "blood_type", "smoking_status", "exercise_frequency")
LONG_PROFILE = (
    "height_cm", "weight_kg", "blood_type", "smoking_status", "alcohol_consumption", "exercise_frequency",
    "emergency_contact_name", "emergency_contact_phone",
)
COMPLETENESS_CUTS, COMPLETENESS_LABELS = (50, 80), ("low", "good", "complete")


def completeness(fields: Sequence[str], present: Sequence[str]) -> Column:
    """Whole percentage of filled fields; a field the table lacks counts as empty."""
    filled = sum((F.col(f).isNotNull().cast("int") for f in fields if f in present), F.lit(0))
    return F.floor(filled * 100 / len(fields)).cast("int")


def user_stats(users: DataFrame, conversations: DataFrame, documents: DataFrame, profiles: DataFrame) -> DataFrame:
    """Conversations, documents and profile completeness per user; each side is reduced before the join."""
    talks = conversations.groupBy("user_id").agg(F.count("*").alias("conversations"))
    files = documents.groupBy("user_id").agg(F.count("*").alias("documents"))
    filled = profiles.select(
        "user_id",
        completeness(SHORT_PROFILE, profiles.columns).alias("profile_completeness"),
        completeness(LONG_PROFILE, profiles.columns).alias("full_profile_completeness"),
    )
    joined = users.select("user_id").join(talks, "user_id", "left").join(files, "user_id", "left")
    numbers = ("conversations", "documents", "profile_completeness", "full_profile_completeness")
    out = joined.join(filled, "user_id", "left").select("user_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers])
    return out.withColumn(
        "completeness_band",
        band_half_open("profile_completeness", COMPLETENESS_CUTS, COMPLETENESS_LABELS, "low"),
    )


def document_stats(documents: DataFrame, by: Sequence[str] = ("user_id",)) -> DataFrame:
    status = F.col("processing_status")
    return documents.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(status == "completed").alias("processed"),
        F.count_if(status == "pending").alias("pending"),
        F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("total_size"),
    )


def describe_documents(documents: DataFrame) -> DataFrame:
    return documents.withColumns(
        {"document_type": document_type("original_filename"), "shown_size": format_bytes("file_size_bytes")}
    )


def filter_docs(documents: DataFrame, kind: str) -> DataFrame:
    return documents.filter(F.col("document_type") == kind)


def list_types(documents: DataFrame) -> DataFrame:
    return documents.select("document_type").distinct()


def check_emails(users: DataFrame) -> DataFrame:
    return users.withColumn("email_ok", valid_email("email"))


# Accepted body measures.
HEIGHT_RANGE, WEIGHT_RANGE = (50, 250), (20, 300)


def profile_validity(profiles: DataFrame, as_of: dt.date) -> DataFrame:
    """Profiles whose measures and dates are possible; unknown values pass."""
    today = F.lit(as_of)

    def fine(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(True))

    checks = [fine(F.col("height_cm").between(*HEIGHT_RANGE)), fine(F.col("weight_kg").between(*WEIGHT_RANGE))]
    for name in ("last_menstrual_period", "date_of_birth"):
        if name in profiles.columns:
            checks.append(fine(F.col(name) <= today))
    valid = checks[0]
    for c in checks[1:]:
        valid = valid & c
    return profiles.withColumn("is_valid_profile", valid)


def recent_summaries(summaries: DataFrame, as_of: dt.date, days: int = 30, k: int = 2) -> DataFrame:
    since = dt.datetime.combine(as_of - dt.timedelta(days=days), dt.time())
    recent = summaries.filter(F.col("time_period_start") >= F.lit(since))
    return latest_k(recent, ["user_id", "domain"], "time_period_start", k, "summary_id")


def message_window(history: DataFrame, k: int = 5) -> DataFrame:
    """Last ``k`` turns of each session, oldest first, numbered from 1."""
    last = latest_k(history, ["user_id", "session_id"], "message_timestamp", k, "conversation_id")
    w = W.partitionBy("user_id", "session_id").orderBy("message_timestamp", "conversation_id")
    return last.withColumn("turn_no", F.row_number().over(w)).drop("recency")
