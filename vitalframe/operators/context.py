"""Context for a reply: similar talks, keyword search, trends and the full bundle per session."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions import vocab
from vitalframe.functions.rules import lookup
from vitalframe.functions.text import contains_any
from vitalframe.operators.aggregates import latest_k
from vitalframe.operators.conversation import (
    clean_replies,
    message_window,
    metric_trends,
    patient_context,
    recent_summaries,
    searchable,
    user_profile,
)
from vitalframe.operators.evaluation import parse_replies, score_batch
from vitalframe.operators.ranking import top_k
from vitalframe.operators.search import TextIndex, similar_by_text, text_index
from vitalframe.sources.tables import materialize, work_path

# Days back that a search for similar talks reaches.
SEARCH_DAYS = 30
# Characters of a past message shown in a context.
SHOWN_CHARS = 250


def latest_queries(history: DataFrame) -> DataFrame:
    """The newest message of every user and domain, as a search query."""
    newest = latest_k(history, ["user_id", "routed_to_domain"], "message_timestamp", 1, "conversation_id")
    return newest.select(
        F.col("conversation_id").alias("query_id"), "user_id", "session_id", "routed_to_domain",
        F.col("user_message").alias("query_text"),
    )


# --- keyword fallback ---------------------------------------------------------------------------
def _topic_sets() -> list[list[str]]:
    names = list(vocab.SEARCH_TOPICS)
    sets = []
    for mask in range(1, 2 ** len(names)):
        sets.append([n for i, n in enumerate(names) if mask & (1 << i)])
    return sets


def query_topics(text: str | Column) -> Column:
    """The search topics a message raises, as one comma-joined key; empty when it raises none."""
    low = F.lower(F.col(text) if isinstance(text, str) else text)
    return F.concat_ws(",", *[F.when(contains_any(low, words), topic) for topic, words in vocab.SEARCH_TOPICS.items()])


def keyword_fallback(queries: DataFrame, history: DataFrame, k: int = 3) -> DataFrame:
    """Newest ``k`` messages of the same user and domain, from other sessions, on a raised topic.

    For each user, domain and topic set the newest messages are kept, at most ``k`` per session and
    ``2 k`` in all.  Leaving out the query's own session removes at most ``k`` of them, so the
    remainder always holds the true newest ``k``, without pairing queries with whole histories.
    """
    low = F.lower("user_message")
    sets = F.array(
        *[F.when(contains_any(low, names), ",".join(names)) for names in _topic_sets()]
    )
    tagged = history.select(
        "user_id", "routed_to_domain", "session_id", "conversation_id", "message_timestamp", "user_message",
        "assistant_response", F.explode(F.filter(sets, lambda s: s.isNotNull())).alias("topics"),
    )
    group = ["user_id", "routed_to_domain", "topics"]
    newest = [F.desc("message_timestamp"), F.desc("conversation_id")]
    per_session = top_k(tagged, [*group, "session_id"], newest, k, "_in_session")
    kept = top_k(per_session, group, newest, 2 * k, "_in_group").drop("_in_session", "_in_group")
    asked = queries.withColumn("topics", query_topics("query_text")).filter(F.col("topics") != "")
    asked = asked.select("query_id", "user_id", "routed_to_domain", "topics", F.col("session_id").alias("_own"))
    found = asked.join(kept, group).filter(F.col("session_id") != F.col("_own"))
    return top_k(found, ["query_id"], newest, k).select(
        "query_id", "topics", "rank", "conversation_id", "user_message", "assistant_response",
        F.to_date("message_timestamp").alias("conversation_date"),
    )


def past_index(history: DataFrame, as_of: dt.date, days: int = SEARCH_DAYS) -> TextIndex:
    """Stored text index of the talks of the last days, to be searched many times."""
    recent = searchable(history).filter(F.col("conversation_date") >= F.lit(as_of - dt.timedelta(days=days)))
    return text_index(recent, "conversation_id", "combined_text")


def past_talks(requests: DataFrame, history: DataFrame, index: TextIndex, k: int = 3) -> DataFrame:
    """Up to ``k`` past conversations per request: the most similar ones of the index, and for requests
    that are similar to none, what the keyword search finds in the whole history."""
    picked = ["query_id", "conversation_id", "rank"]
    # at most k short rows per request; written, as both results read them
    similar = materialize(similar_by_text(requests, index, k).select(*picked), work_path(requests.sparkSession, "similar_talks"))
    rest = requests.join(similar.select("query_id").distinct(), "query_id", "left_anti")
    return similar.unionByName(keyword_fallback(rest, history, k).select(*picked))


# --- context texts ------------------------------------------------------------------------------
def _collected(df: DataFrame, keys: Sequence[str], order: str, text: Column, name: str, count: str) -> DataFrame:
    """Join a small, bounded number of texts per key in order, and count them."""
    rows = df.select(*keys, F.struct(F.col(order).alias("o"), text.alias("t")).alias("r"))
    grouped = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("r")).alias("rs"))
    return grouped.select(
        *keys, F.array_join(F.transform("rs", lambda r: r["t"]), "").alias(name), F.size("rs").alias(count)
    )


def session_context(history: DataFrame, k: int = 5) -> DataFrame:
    """The last ``k`` turns of each session as one text."""
    no = F.col("turn_no").cast("string")
    text = F.concat(
        F.lit("Turn "), no, F.lit(" - User: "), "user_message",
        F.lit("\nTurn "), no, F.lit(" - Assistant: "), "assistant_response", F.lit("\n\n"),
    )
    turns = message_window(history, k)
    return _collected(turns, ["user_id", "session_id"], "turn_no", text, "current_context", "current_turns")


def semantic_context(found: DataFrame, history: DataFrame) -> DataFrame:
    """Past conversations found for a query, as one text per query."""
    past = history.select(
        "conversation_id", "user_message", "assistant_response", F.to_date("message_timestamp").alias("day")
    )
    rows = found.select("query_id", "conversation_id", "rank").join(past, "conversation_id")

    def opening(col: str) -> Column:
        return F.left(F.col(col), F.lit(SHOWN_CHARS))

    text = F.concat(
        F.lit("\n[Past discussion "), F.col("rank").cast("string"), F.lit(" - "), F.col("day").cast("string"),
        F.lit("]\nUser: "), opening("user_message"), F.lit("...\nAssistant: "), opening("assistant_response"),
        F.lit("...\n"),
    )
    return _collected(rows, ["query_id"], "rank", text, "semantic_context", "similar_found")


def metrics_context(trends: DataFrame, types: Sequence[str]) -> DataFrame:
    """Trend lines per user, in the order of ``types``."""
    titles = {t: t.replace("_", " ").title() for t in types}
    places = {t: i for i, t in enumerate(types)}
    first, last = F.col("first_value").cast("string"), F.col("current_value").cast("string")
    head = F.concat(F.lit("- "), lookup("metric_type", titles), F.lit(": "))
    signed = F.format_string("%+.1f", F.col("percent_change"))
    line = F.when(
        F.col("data_points") >= 2,
        F.concat(head, first, F.lit(" → "), last, F.lit(" ("), F.col("trend"), F.lit(", "), signed, F.lit("% change)\n")),
    ).otherwise(F.concat(head, last, F.lit(" (single reading)\n")))
    rows = trends.filter(F.col("metric_type").isin(list(types))).withColumn("_place", lookup("metric_type", places))
    return _collected(rows, ["user_id"], "_place", line, "metrics_context", "metrics_tracked")


def summaries_context(recent: DataFrame) -> DataFrame:
    text = F.concat(F.lit("- "), "summary_text", F.lit("\n"))
    return _collected(recent, ["user_id", "domain"], "recency", text, "summaries_context", "summaries_available")


# Headings of the context sections.
HEADINGS = {
    "current_context": "\n\nCURRENT CONVERSATION:\n",
    "semantic_context": "\n\nRELEVANT PAST CONVERSATIONS:\n",
    "metrics_context": "\n\nHEALTH METRICS TRACKING:\n",
    "summaries_context": "\n\nRECENT SUMMARIES:\n",
}


def build_context(
    requests: DataFrame, history: DataFrame, users: DataFrame, profiles: DataFrame, metrics: DataFrame,
    summaries: DataFrame, as_of: dt.date,
    tracked: Mapping[str, Sequence[str]] = vocab.TRACKED_METRICS, index: TextIndex | None = None,
) -> DataFrame:
    """All context sections for every request, one row per request.

    A request has ``query_id``, ``user_id``, ``session_id``, ``routed_to_domain`` and ``query_text``.
    ``index`` is the stored text index of the talks to search; by default it is made here.  Every side
    is reduced to one row per join key first, so no join multiplies rows.
    """
    profile = patient_context(user_profile(users, profiles), as_of).select("user_id", "patient_context")
    current = session_context(history)
    index = past_index(history, as_of) if index is None else index
    found = semantic_context(past_talks(requests, history, index), history)
    trends = metric_trends(metrics, as_of)
    by_domain = [
        metrics_context(trends, types).withColumn("routed_to_domain", F.lit(domain)) for domain, types in tracked.items()
    ]
    measured = reduce(DataFrame.unionByName, by_domain)
    recent = summaries_context(recent_summaries(summaries, as_of)).withColumnRenamed("domain", "routed_to_domain")
    joined = (
        requests.join(profile, "user_id", "left")
        .join(current, ["user_id", "session_id"], "left")
        .join(found, "query_id", "left")
        .join(measured, ["user_id", "routed_to_domain"], "left")
        .join(recent, ["user_id", "routed_to_domain"], "left")
    )

    def section(name: str) -> Column:
        return F.coalesce(F.concat(F.lit(HEADINGS[name]), F.col(name)), F.lit("")).alias(name)

    def number(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).alias(name)

    return joined.select(
        "query_id", "user_id", "session_id", "routed_to_domain",
        F.coalesce("patient_context", F.lit("PATIENT PROFILE:\n")).alias("patient_context"),
        *[section(name) for name in HEADINGS],
        number("current_turns"), number("similar_found"), number("metrics_tracked"), number("summaries_available"),
    )


# --- prompts for a specialist and a router --------------------------------------------------------
# Default wording of the two prompts; callers pass their own to change it.
SPECIALIST_ROLES = {
    "DIABETES": "You are a diabetes care specialist. Answer in plain, conversational sentences without report headings.",
    "HEART_DISEASE": "You are a cardiovascular health specialist. Answer in plain, conversational sentences without "
    "report headings.",
    "MENTAL_HEALTH": "You are a mental health specialist. Be supportive, and name the 988 Lifeline when self-harm is mentioned.",
}
ROUTER_TEMPLATE = (
    "Classify the health message below. Answer with JSON only, using the keys domain, urgency, safety_flag, "
    "extracted_symptoms and reasoning.\n"
    "Domains: diabetes, hypertension, mental_health, maternal_health, womens_wellness, out_of_scope.\n"
    "Urgency: emergency, urgent, routine. Messages about a pregnancy always belong to maternal_health.\n"
    "Set safety_flag for self-harm, blood pressure of 180/120 or more, blood sugar above 400 or below 54, "
    "bleeding in pregnancy, severe chest pain or trouble breathing.\nMessage: "
)
SECTIONS = {
    "PATIENT INFORMATION": "patient_context",
    "TRACKED HEALTH METRICS": "metrics_context",
    "CURRENT CONVERSATION": "current_context",
    "RELEVANT PAST DISCUSSIONS": "semantic_context",
}


def specialist_prompts(
    context: DataFrame, question: str, domain: str, roles: Mapping[str, str] = SPECIALIST_ROLES
) -> DataFrame:
    """Full specialist prompt per request: role, context sections, question."""
    default = next(iter(roles.values()))
    parts = [lookup(domain, roles, default)]
    for title, column in SECTIONS.items():
        parts += [F.lit(f"\n\n## {title}\n"), F.col(column)]
    parts += [F.lit("\n\n## QUESTION\n"), F.col(question)]
    return context.withColumn("specialist_prompt", F.concat(*parts))


def router_prompts(messages: DataFrame, text: str, profiles: DataFrame, template: str = ROUTER_TEMPLATE) -> DataFrame:
    """Router prompt per message, with the known conditions of the user."""
    words = {"has_diabetes": "Diabetes", "has_hypertension": "Hypertension", "has_heart_disease": "Heart Disease",
             "has_mental_health_history": "Mental Health History"}
    known = profiles.select(
        "user_id", F.concat_ws(", ", *[F.when(F.col(c), w) for c, w in words.items()]).alias("_known")
    )
    joined = messages.join(known, "user_id", "left")
    history = F.when(F.col("_known") != "", F.concat(F.lit("\nMedical history: "), "_known")).otherwise("")
    return joined.withColumn("router_prompt", F.concat(F.lit(template), F.col(text), history)).drop("_known")


# What is read from a router reply, and the type it is read as.
CLASSIFICATION_FIELDS = {"domain": "string", "urgency": "string", "confidence": "double", "scope_violation": "boolean"}
# Domains of a router reply and the domain whose specialist answers; any other goes to the general model.
SPECIALIST_OF = {
    "DIABETES": "lifestyle_diseases_diabetes", "HEART_DISEASE": "lifestyle_diseases_hypertension", "MENTAL_HEALTH": "mental_health",
}
GENERAL_MODEL = vocab.DOMAIN_MODELS["general_health"]


def classify_messages(
    messages: DataFrame, text: str, profiles: DataFrame, scorer: Callable[[pd.Series], pd.Series],
    template: str = ROUTER_TEMPLATE, models: Mapping[str, str] = vocab.DOMAIN_MODELS, general: str = GENERAL_MODEL,
) -> DataFrame:
    """Domain, urgency, confidence and specialist of every message, as a scorer of router prompts says.

    Prompts are scored in batches and the replies written, so that no prompt is scored twice. Replies
    that are JSON with a domain are read; only the others go through the fallback. Messages out of scope
    have no specialist. NULL and empty replies count as unreadable.
    """
    scored = score_batch(router_prompts(messages, text, profiles, template), "router_prompt", scorer, "router_reply")
    scored = materialize(scored, work_path(messages.sparkSession, "router_replies"))
    parsed = parse_replies(scored, "router_reply", CLASSIFICATION_FIELDS, None)
    readable = F.coalesce(F.col("is_valid_json") & F.col("domain").isNotNull(), F.lit(False))
    columns = [*messages.columns, "router_reply"]
    specialists = {d: models[name] for d, name in SPECIALIST_OF.items()}
    model = F.when(~F.coalesce("scope_violation", F.lit(False)), F.coalesce(lookup("domain", specialists), F.lit(general)))
    read = parsed.where(readable).select(
        *columns, "domain", "urgency", "confidence", model.alias("specialist_model"), F.lit("success").alias("classification_status")
    )
    failed = parsed.where(~readable).select(*columns, fallback_classification().alias("c")).select(*columns, "c.*")
    failed = failed.withColumn("specialist_model", lookup("domain", specialists)).withColumn("classification_status", F.lit("error"))
    return read.unionByName(failed)


def specialist_replies(
    context: DataFrame, question: str, domain: str, scorer: Callable[[pd.Series], pd.Series], roles: Mapping[str, str] = SPECIALIST_ROLES
) -> DataFrame:
    """Specialist prompt, the scorer's reply and the reply as it is shown: without labels, with praise for progress."""
    scored = score_batch(specialist_prompts(context, question, domain, roles), "specialist_prompt", scorer, "specialist_reply")
    return clean_replies(scored, "specialist_reply", "metrics_context")


def fallback_classification(default_domain: str = "DIABETES") -> Column:
    """What a router reply that cannot be read is replaced with."""
    return F.struct(
        F.lit(default_domain).alias("domain"), F.lit("ROUTINE").alias("urgency"), F.lit(0.5).alias("confidence")
    )

