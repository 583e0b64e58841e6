"""Conversation analytics, context building and streaming."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.inputs import load, over
from checks.reg_tables import MESSAGES_CTE, READINGS_SQL
from checks.registry import register
from checks.sqltext import half_up, lit, pick
from vitalframe.functions import vocab
from vitalframe.operators import context as ctx
from vitalframe.operators import conversation as cv
from vitalframe.operators import search
from vitalframe.operators import summaries as sm
from vitalframe.sources import fixtures, tables
from vitalframe.streaming import jobs

DAY = dt.date(2024, 2, 1)
HISTORY = "conversation_history"


def talk(spark, sf):
    return load(spark, sf, HISTORY)


def _list(items):
    return "[" + ", ".join(lit(i) for i in items) + "]"


def _hits(text, items):
    return f"list_filter({_list(items)}, lambda w: contains({text}, w))"


def _triage_sql(source, key, text):
    e, u, s = (_hits(f"lower({text})", w) for w in (vocab.EMERGENCY_KEYWORDS, vocab.URGENT_KEYWORDS, vocab.SYMPTOM_KEYWORDS))
    return (
        f"SELECT {key}, len(e) > 0 AS is_emergency, CASE WHEN len(e) > 0 THEN 'emergency' WHEN len(u) > 0 THEN 'urgent' "
        "WHEN len(s) > 2 THEN 'needs_attention' ELSE 'routine' END AS local_urgency, "
        "array_to_string(CASE WHEN len(e) > 0 THEN e[1:1] WHEN len(u) > 0 THEN u ELSE s END, '|') AS detected_symptoms FROM "
        f"(SELECT *, {e} AS e, {u} AS u, {s} AS s FROM {source})"
    )


@register("k01_triage_message", over(HISTORY, _triage_sql(HISTORY, "conversation_id", "user_message")))
def _(spark, sf):
    return cv.triage_message(talk(spark, sf), "user_message").select(
        "conversation_id", "is_emergency", "local_urgency", "detected_symptoms"
    )


@register("k01_triage_documents", _triage_sql("documents", "doc_id", "text"))
def _(spark, sf):
    docs = fixtures.shared(spark, sf, "documents")
    return cv.triage_message(docs, "text").select("doc_id", "is_emergency", "local_urgency", "detected_symptoms")


_COUNTS = "[" + ", ".join(
    f"len({_hits('lower(user_message)', [w.lower() for w in ws])})" for ws in vocab.DOMAIN_KEYWORDS.values()
) + "]"
_ROUTED = (
    "routed",
    f"SELECT *, list_max(h) AS domain_hits, if(list_max(h) = 0, 'out_of_scope', {_list(vocab.DOMAIN_KEYWORDS)}"
    f"[list_position(h, list_max(h))]) AS routed_domain FROM (SELECT *, {_COUNTS} AS h FROM conversation_history)",
)
_MODEL = pick(*[(m, f"routed_domain = '{d}'") for d, m in vocab.DOMAIN_MODELS.items()])


@register(
    "k02_route_domain",
    over(HISTORY, f"SELECT conversation_id, domain_hits::int AS domain_hits, routed_domain, {_MODEL} AS specialist_model FROM routed", _ROUTED),
)
def _(spark, sf):
    return cv.route_domain(talk(spark, sf), "user_message").select(
        "conversation_id", "domain_hits", "routed_domain", "specialist_model"
    )


_TRIAGED = ("triaged", _triage_sql("routed", "conversation_id, urgency_level, routed_domain", "user_message"))


@register(
    "k03_resolve_urgency",
    over(HISTORY, "SELECT conversation_id, CASE WHEN routed_domain = 'out_of_scope' THEN 'ROUTINE' WHEN local_urgency IN ('emergency', 'urgent') "
         "THEN upper(local_urgency) ELSE upper(urgency_level) END AS final_urgency, if(local_urgency IN ('emergency', 'urgent'), "
         "detected_symptoms, '') AS safety_flags FROM triaged", _ROUTED, _TRIAGED),
)
def _(spark, sf):
    routed = cv.route_domain(cv.triage_message(talk(spark, sf), "user_message"), "user_message")
    return cv.resolve_urgency(routed, "urgency_level", "routed_domain").select("conversation_id", "final_urgency", "safety_flags")


def readings(spark, sf, *more):
    keys = ["conversation_id", "user_id", *more]
    return cv.extract_metrics(talk(spark, sf), ["user_message", "assistant_response"], keys, "routed_to_domain")


_READINGS = ("readings", READINGS_SQL)


@register("k04_extract_metrics", over(HISTORY, "SELECT * FROM readings", MESSAGES_CTE, _READINGS))
@register("k05_distinct_readings", over(HISTORY, "SELECT DISTINCT * FROM readings", MESSAGES_CTE, _READINGS))
def _(spark, sf):
    return readings(spark, sf)


_SEVERITY = pick(
    *[(g, f"metric_type = '{k}' AND metric_value >= {limit}") for k, (a, b, c) in vocab.METRIC_GRADES.items()
      for g, limit in (("severe", c), ("moderate", b), ("mild", a))], default="normal",
)
_GRADED = f"SELECT *, {_SEVERITY} AS severity, {_SEVERITY} <> 'normal' AS is_abnormal FROM readings"


@register("k06_grade_metric", over(HISTORY, _GRADED, MESSAGES_CTE, _READINGS))
def _(spark, sf):
    return cv.grade_metric(readings(spark, sf))


_TRENDS = (
    "trends",
    f"""SELECT user_id, metric_type, first_value, current_value, latest_date, data_points,
 CASE WHEN data_points < 2 THEN 'single_reading' WHEN abs(change) < 5 THEN 'stable' WHEN change > 0 THEN 'increasing' ELSE 'decreasing' END AS trend,
 {half_up('change', 1)} AS percent_change FROM (SELECT *, if(data_points < 2 OR first_value = 0, 0.0::double,
 (current_value - first_value) / nullif(first_value, 0) * 100) AS change FROM (
 SELECT user_id, metric_type, (array_agg(metric_value ORDER BY measurement_date, metric_id))[1] AS first_value,
 (array_agg(metric_value ORDER BY measurement_date DESC, metric_id DESC))[1] AS current_value, max(measurement_date) AS latest_date,
 count(*) AS data_points FROM health_metrics WHERE measurement_date >= DATE '2024-02-01' - 90 GROUP BY 1, 2))""",
)


@register("k07_metric_trends", over("health_metrics", "SELECT * FROM trends", _TRENDS))
@register("u05_get_metric_trends", over("health_metrics", "SELECT * FROM trends", _TRENDS))
def _(spark, sf):
    return cv.metric_trends(load(spark, sf, "health_metrics"), DAY)


@register(
    "k07_metric_series",
    over("health_metrics", "SELECT user_id, metric_type, row_number() OVER (PARTITION BY user_id, metric_type ORDER BY measurement_date, metric_id) "
         "AS position, measurement_date, metric_value FROM health_metrics WHERE measurement_date >= DATE '2024-02-01' - 90"),
)
def _(spark, sf):
    return cv.metric_series(load(spark, sf, "health_metrics"), DAY)


_SEARCHABLE = "SELECT *, user_message || ' ' || assistant_response AS combined_text, message_timestamp::date AS conversation_date FROM conversation_history"


@register("k08_searchable", over(HISTORY, _SEARCHABLE))
def _(spark, sf):
    return cv.searchable(talk(spark, sf))


_NEWEST = (
    "asked",
    "SELECT conversation_id AS query_id, user_id, session_id, routed_to_domain, user_message AS query_text FROM conversation_history "
    "QUALIFY row_number() OVER (PARTITION BY user_id, routed_to_domain ORDER BY message_timestamp DESC, conversation_id DESC) = 1",
)


_EVERY = (
    "everyone",
    "SELECT conversation_id AS query_id, user_id, session_id, routed_to_domain, user_message AS query_text FROM conversation_history",
)


def every_message(history):
    return history.select(
        F.col("conversation_id").alias("query_id"), "user_id", "session_id", "routed_to_domain", F.col("user_message").alias("query_text")
    )


_ALL = ("asked", _EVERY[1])


_BY_EMBEDDING = (
    "SELECT query_id, conversation_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, conversation_id) AS rank FROM ("
    f"SELECT q.query_id, c.conversation_id, {half_up('list_cosine_similarity(e.embedding::double[], c.embedding::double[])', 6)} AS score "
    "FROM asked q JOIN health_corpus e ON e.conversation_id = q.query_id JOIN health_corpus c ON c.user_id = q.user_id "
    "AND c.routed_to_domain = q.routed_to_domain AND c.conversation_id <> q.query_id AND c.conversation_date >= DATE '2024-02-01' - 30)) WHERE rank <= 3"
)


def by_embedding(spark, sf, asked):
    corpus = load(spark, sf, "health_corpus")
    vectors = corpus.select(F.col("conversation_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    asked = asked.select("query_id", "user_id", "routed_to_domain").join(vectors, "query_id")
    return search.similar_by_embedding(asked, corpus, 3, since=DAY - dt.timedelta(days=30))


@register("k09_similar_by_embedding", over("conversation_history health_corpus", _BY_EMBEDDING, _NEWEST))
def _(spark, sf):
    return by_embedding(spark, sf, ctx.latest_queries(talk(spark, sf)))


@register("k09_similar_by_embedding_all", over("conversation_history health_corpus", _BY_EMBEDDING, _ALL))
def _(spark, sf):
    return by_embedding(spark, sf, every_message(talk(spark, sf)))


_TERMS = "string_split_regex(lower({}), '[^a-z0-9]+')"


def _corpus(days):
    return "corpus", f"SELECT * FROM ({_SEARCHABLE}) WHERE conversation_date >= DATE '2024-02-01' - {days}"


_TFIDF = [
    ("dterm", f"SELECT conversation_id, user_id, routed_to_domain, term, count(*) AS tf FROM (SELECT *, unnest({_TERMS.format('combined_text')}) AS term "
     "FROM corpus) WHERE term <> '' GROUP BY ALL"),
    ("qterm", f"SELECT query_id, user_id, routed_to_domain, term, count(*) AS tf FROM (SELECT *, unnest({_TERMS.format('query_text')}) AS term "
     "FROM asked) WHERE term <> '' GROUP BY ALL"),
    ("idf", "SELECT term, ln(((SELECT count(*) FROM corpus) + 1) / (count(*) + 1)) + 1 AS idf FROM dterm GROUP BY 1"),
    ("dw", "SELECT dterm.*, tf * idf AS w FROM dterm JOIN idf USING (term)"),
    ("qw", "SELECT qterm.*, tf * coalesce(idf, 0) AS w FROM qterm LEFT JOIN idf USING (term)"),
    ("dn", "SELECT conversation_id, sqrt(sum(w * w)) AS n FROM dw GROUP BY 1"),
    ("qn", "SELECT query_id, sqrt(sum(w * w)) AS n FROM qw GROUP BY 1"),
]
_SIMILAR = (
    "alike",
    "SELECT query_id, conversation_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, conversation_id) AS rank "
    f"FROM (SELECT query_id, conversation_id, {half_up('dot / (qn.n * dn.n)', 6)} AS score FROM (SELECT q.query_id, d.conversation_id, sum(q.w * d.w) AS dot "
    "FROM qw q JOIN dw d ON d.user_id = q.user_id AND d.routed_to_domain = q.routed_to_domain AND d.term = q.term AND d.conversation_id <> q.query_id "
    "GROUP BY 1, 2) JOIN qn USING (query_id) JOIN dn USING (conversation_id))) WHERE rank <= 3",
)


@register("k09_similar_by_text", over(HISTORY, "SELECT * FROM alike", _NEWEST, _corpus(30), *_TFIDF, _SIMILAR))
def _(spark, sf):
    history = talk(spark, sf)
    return search.similar_by_text(ctx.latest_queries(history), ctx.past_index(history, DAY))


@register("k09_similar_by_text_all", over(HISTORY, "SELECT * FROM alike", _ALL, _corpus(30), *_TFIDF, _SIMILAR))
def _(spark, sf):
    history = talk(spark, sf)
    return search.similar_by_text(every_message(history), ctx.past_index(history, DAY))


_TOPIC_WORDS = "MAP {" + ", ".join(f"'{t}': {_list(ws)}" for t, ws in vocab.SEARCH_TOPICS.items()) + "}"
_TOPICS = (
    f"list_filter({_list(vocab.SEARCH_TOPICS)}, lambda t: len(list_filter(({_TOPIC_WORDS})[t], lambda w: contains(lower(query_text), w))) > 0)"
)


def _fallback(asked):
    return (
        "found",
        f"""SELECT query_id, array_to_string(ts, ',') AS topics, conversation_id, user_message, assistant_response,
 message_timestamp::date AS conversation_date, row_number() OVER (PARTITION BY query_id ORDER BY message_timestamp DESC, conversation_id DESC) AS rank
 FROM (SELECT *, {_TOPICS} AS ts FROM {asked}) q JOIN conversation_history h ON h.user_id = q.user_id AND h.routed_to_domain = q.routed_to_domain
 AND h.session_id <> q.session_id WHERE len(list_filter(ts, lambda t: contains(lower(user_message), t))) > 0 QUALIFY rank <= 3""",
    )


@register("k10_keyword_fallback", over(HISTORY, "SELECT * FROM found", _EVERY, _fallback("everyone")))
def _(spark, sf):
    history = talk(spark, sf)
    return ctx.keyword_fallback(every_message(history), history)


_CURRENT = (
    "current_talk",
    """SELECT user_id, session_id, string_agg('Turn ' || no || ' - User: ' || user_message || chr(10) || 'Turn ' || no || ' - Assistant: '
 || assistant_response || chr(10) || chr(10), '' ORDER BY no) AS current_context, count(*)::int AS current_turns FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id, session_id ORDER BY message_timestamp, conversation_id) AS no FROM (
 SELECT * FROM conversation_history QUALIFY row_number() OVER (PARTITION BY user_id, session_id
 ORDER BY message_timestamp DESC, conversation_id DESC) <= 5)) GROUP BY 1, 2""",
)


@register("k11_session_context", over(HISTORY, "SELECT * FROM current_talk", _CURRENT))
def _(spark, sf):
    return ctx.session_context(talk(spark, sf))


_SPANS = (
    "spans",
    """SELECT md5(user_id || '|' || session_id) AS summary_id, user_id, session_id, 'session_summary' AS summary_type,
 (array_agg(routed_to_domain ORDER BY message_timestamp, conversation_id))[1] AS domain, count(*) AS turns,
 min(message_timestamp) AS time_period_start, max(message_timestamp) AS time_period_end FROM conversation_history
 GROUP BY user_id, session_id HAVING count(*) > 1""",
)
_SUMMARIES = ("summaries", "SELECT *, domain || ' session with ' || turns || ' turns' AS summary_text FROM spans")
_RECENT = (
    "recent",
    """SELECT summary_id, user_id, domain, summary_text, time_period_start, row_number() OVER (PARTITION BY user_id, domain
 ORDER BY time_period_start DESC, summary_id DESC) AS recency FROM summaries WHERE time_period_start >= TIMESTAMP '2024-01-02' QUALIFY recency <= 2""",
)


@register(
    "k12_recent_summaries",
    over(HISTORY, "SELECT * FROM recent", _SPANS, _SUMMARIES, _RECENT),
)
def _(spark, sf):
    return cv.recent_summaries(cv.session_summaries(talk(spark, sf)), DAY).select(
        "summary_id", "user_id", "domain", "summary_text", "time_period_start", "recency"
    )


_PROFILE = (
    "profiles",
    """SELECT user_id, 'PATIENT PROFILE:' || chr(10) || if(coalesce(age, 0) = 0, '', '- Age: ' || age || chr(10))
 || if(len(cond) = 0, '', '- Conditions: ' || array_to_string(cond, ', ') || chr(10))
 || coalesce('- BMI: ' || index::varchar || chr(10), '') AS patient_context FROM (SELECT u.user_id,
 date_sub('year', date_of_birth, DATE '2024-02-01') AS age, list_filter([if(has_diabetes, 'diabetes', NULL), if(has_hypertension, 'hypertension', NULL),
 if(has_heart_disease, 'heart disease', NULL), if(has_mental_health_history, 'mental health history', NULL), if(has_pcos, 'PCOS', NULL),
 if(is_pregnant, 'pregnant (trimester ' || coalesce(pregnancy_trimester::varchar, '?') || ')', NULL)], lambda c: c IS NOT NULL) AS cond,
 round_even(weight_kg / ((height_cm / 100) * (height_cm / 100)), 1) AS index FROM users u LEFT JOIN user_medical_profiles p USING (user_id))""",
)


@register("k13_patient_context", over("users user_medical_profiles", "SELECT * FROM profiles", _PROFILE))
def _(spark, sf):
    joined = cv.user_profile(load(spark, sf, "users"), load(spark, sf, "user_medical_profiles"))
    return cv.patient_context(joined, DAY).select("user_id", "patient_context")


def _metric_lines(domain, types):
    titles = pick(*[(t.replace("_", " ").title(), f"metric_type = '{t}'") for t in types])
    change = "if(percent_change >= 0, '+', '') || printf('%.1f', percent_change)"
    return (
        f"SELECT user_id, '{domain}' AS routed_to_domain, string_agg('- ' || {titles} || ': ' || if(data_points > 1, first_value::varchar || ' → ' "
        f"|| current_value::varchar || ' (' || trend || ', ' || {change} || '% change)', current_value::varchar || ' (single reading)') || chr(10), '' "
        f"ORDER BY list_position({_list(types)}, metric_type)) AS metrics_context, count(*)::int AS metrics_tracked FROM trends "
        f"WHERE metric_type IN ({', '.join(lit(t) for t in types)}) GROUP BY 1"
    )


_CONTEXT = [
    _CURRENT,
    _fallback("asked"),
    *_TFIDF,
    _SIMILAR,
    ("past", "SELECT query_id, s.rank, user_message, assistant_response, message_timestamp::date AS conversation_date FROM alike s "
     "JOIN conversation_history USING (conversation_id) UNION ALL SELECT query_id, rank, user_message, assistant_response, conversation_date "
     "FROM found WHERE query_id NOT IN (SELECT query_id FROM alike)"),
    _TRENDS,
    _SPANS,
    _SUMMARIES,
    _RECENT,
    _PROFILE,
    ("past_talk", "SELECT query_id, string_agg(chr(10) || '[Past discussion ' || rank || ' - ' || conversation_date || ']' || chr(10) || 'User: ' "
     "|| left(user_message, 250) || '...' || chr(10) || 'Assistant: ' || left(assistant_response, 250) || '...' || chr(10), '' ORDER BY rank) "
     "AS semantic_context, count(*)::int AS similar_found FROM past GROUP BY 1"),
    ("measured", " UNION ALL ".join(_metric_lines(d, ts) for d, ts in vocab.TRACKED_METRICS.items())),
    ("summed", "SELECT user_id, domain AS routed_to_domain, string_agg('- ' || summary_text || chr(10), '' ORDER BY recency) AS summaries_context, "
     "count(*)::int AS summaries_available FROM recent GROUP BY 1, 2"),
    ("context", "SELECT query_id, a.user_id, a.session_id, a.routed_to_domain, query_text, coalesce(patient_context, 'PATIENT PROFILE:' || chr(10)) AS patient_context, "
     + ", ".join(f"coalesce({lit(h)} || {c}, '') AS {c}" for c, h in ctx.HEADINGS.items())
     + ", " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ("current_turns", "similar_found", "metrics_tracked", "summaries_available"))
     + " FROM asked a LEFT JOIN profiles USING (user_id) LEFT JOIN current_talk USING (user_id, session_id) LEFT JOIN past_talk USING (query_id) "
     "LEFT JOIN measured USING (user_id, routed_to_domain) LEFT JOIN summed USING (user_id, routed_to_domain)"),
]
_CONTEXT_INPUTS = "conversation_history users user_medical_profiles health_metrics"


def context(spark, sf, days=30):
    history = talk(spark, sf)
    asked = ctx.latest_queries(history)
    return asked, ctx.build_context(
        asked, history, load(spark, sf, "users"), load(spark, sf, "user_medical_profiles"), load(spark, sf, "health_metrics"),
        cv.session_summaries(history), DAY, index=ctx.past_index(history, DAY, days),
    )


@register("u03_get_smart_context", over(_CONTEXT_INPUTS, "SELECT * EXCLUDE (query_text) FROM context", _NEWEST, _corpus(30), *_CONTEXT))
@register("k14_build_context", over(_CONTEXT_INPUTS, "SELECT * EXCLUDE (query_text) FROM context", _NEWEST, _corpus(30), *_CONTEXT))
def _(spark, sf):
    return context(spark, sf)[1]


# With two days to search, some requests find nothing similar and fall back to key words.
@register("k14_short_search", over(_CONTEXT_INPUTS, "SELECT * EXCLUDE (query_text) FROM context", _NEWEST, _corpus(2), *_CONTEXT))
def _(spark, sf):
    return context(spark, sf, 2)[1]


_TURNS = (
    "turns_text",
    """SELECT user_id, session_id, no AS turn_no, chr(10) || 'Turn ' || no || ':' || chr(10) || 'User: ' || user_message || chr(10) || 'Assistant: '
 || assistant_response || chr(10) AS turn_text FROM (SELECT *, row_number() OVER (PARTITION BY user_id, session_id
 ORDER BY message_timestamp, conversation_id) AS no FROM conversation_history)""",
)


@register(
    "k15_session_transcripts",
    over(HISTORY, "SELECT user_id, session_id, turn_no, turn_text, turns, domain, time_period_start, time_period_end FROM spans "
         "JOIN turns_text USING (user_id, session_id)", _SPANS, _TURNS),
)
def _(spark, sf):
    return cv.session_transcripts(talk(spark, sf))


_LABELS_GONE = "reply"
for _pattern, _replacement in vocab.REPLY_LABELS:
    _LABELS_GONE = f"regexp_replace({_LABELS_GONE}, {lit(_pattern)}, {lit(_replacement)}, 'gi')"
_LINES = (
    f"array_to_string(list_filter(string_split({_LABELS_GONE}, chr(10)), lambda l: NOT list_contains({_list(vocab.STRUCTURAL_LINES)}, "
    f"regexp_replace(l, '^\\s+|\\s+$', '', 'g')) AND NOT regexp_matches(regexp_replace(l, '^\\s+|\\s+$', '', 'g'), {lit(vocab.STRUCTURAL_LINE_PATTERN)}, 'i')), chr(10))"
)


@register(
    "k16_clean_reply",
    over("raw_replies", f"SELECT event_id, regexp_replace(if(coalesce(contains(lower(metrics_context), 'improved'), false), {lit(vocab.PROGRESS_PREFIX)}, '') "
         f"|| regexp_replace({_LINES}, '\\n\\n\\n+', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS cleaned_response FROM raw_replies"),
)
def _(spark, sf):
    return cv.clean_replies(load(spark, sf, "raw_replies"), "reply", "metrics_context").select("event_id", "cleaned_response")


_UNRECALLED = "reply"
for _pattern in vocab.FALSE_RECALL_PATTERNS:
    _UNRECALLED = f"regexp_replace({_UNRECALLED}, {lit(_pattern)}, '', 'gi')"


@register(
    "k17_strip_false_recall",
    over("recall_replies conversation_history", f"SELECT user_id, if(user_id IN (SELECT user_id FROM conversation_history), reply, "
         f"regexp_replace(regexp_replace(regexp_replace({_UNRECALLED}, '\\n\\n+', chr(10) || chr(10), 'g'), '  +', ' ', 'g'), '^\\s+|\\s+$', '', 'g')) "
         "AS checked_response FROM recall_replies"),
)
def _(spark, sf):
    return cv.strip_false_recall(load(spark, sf, "recall_replies"), "reply", talk(spark, sf)).select("user_id", "checked_response")


_ICON = pick(*[(v, f"domain = '{k}'") for k, v in vocab.DOMAIN_ICONS.items()], default=vocab.DEFAULT_ICON)
_BADGE = pick(*[(v, f"urgency = '{k}'") for k, v in vocab.URGENCY_BADGES.items()], default="")
_TITLE = "MAP {'DIABETES': 'Diabetes', 'HEART_DISEASE': 'Heart Disease', 'MENTAL_HEALTH': 'Mental Health', 'WOMEN_WELLNESS': 'Women Wellness'}[domain]"


@register(
    "k18_format_reply",
    over("routed_replies", f"SELECT event_id, {_ICON} || ' **' || {_TITLE} || ' Assistant**' || chr(10) || chr(10) || reply || chr(10) || chr(10) || {_BADGE} "
         f"|| {lit(chr(10) * 2 + '---' + chr(10) + '*Classification confidence: ')} || floor(coalesce(confidence, 0.5) * 100)::int "
         f"|| {lit('%*  ' + chr(10) + vocab.REPLY_FOOTER + chr(10))} AS final_response FROM routed_replies"),
)
def _(spark, sf):
    return cv.format_replies(load(spark, sf, "routed_replies"), "reply", "domain", "urgency", "confidence").select(
        "event_id", "final_response"
    )


_FILLED = "+".join(f"({c} IS NOT NULL)::int" for c in ("height_cm", "weight_kg", "blood_type", "smoking_status", "exercise_frequency"))


@register(
    "k19_user_stats",
    over("users conversation_history uploaded_documents user_medical_profiles",
         "SELECT user_id, (SELECT count(*) FROM conversation_history c WHERE c.user_id = u.user_id) AS conversations, "
         "(SELECT count(*) FROM uploaded_documents d WHERE d.user_id = u.user_id) AS documents, coalesce(short, 0) AS profile_completeness, "
         "coalesce(long, 0) AS full_profile_completeness, CASE WHEN coalesce(short, 0) < 50 THEN 'low' WHEN short < 80 THEN 'good' ELSE 'complete' END "
         f"AS completeness_band FROM users u LEFT JOIN (SELECT user_id, 20 * ({_FILLED}) AS short, (100 * ({_FILLED})) // 8 AS long "
         "FROM user_medical_profiles) USING (user_id)"),
)
def _(spark, sf):
    return cv.user_stats(
        load(spark, sf, "users"), talk(spark, sf), load(spark, sf, "uploaded_documents"), load(spark, sf, "user_medical_profiles")
    )


@register(
    "k20_document_stats",
    over("uploaded_documents", "SELECT user_id, count(*) AS total, count(*) FILTER (processing_status = 'completed') AS processed, "
         "count(*) FILTER (processing_status = 'pending') AS pending, sum(file_size_bytes)::bigint AS total_size FROM uploaded_documents GROUP BY 1"),
)
def _(spark, sf):
    return cv.document_stats(load(spark, sf, "uploaded_documents"))


_TYPE = pick(*[(t, f"len({_hits('lower(original_filename)', ws)}) > 0") for t, ws in vocab.DOCUMENT_TYPES.items()], default="other")


@register("k21_document_type", over("uploaded_documents", f"SELECT document_id, {_TYPE} AS document_type FROM uploaded_documents"))
def _(spark, sf):
    return cv.describe_documents(load(spark, sf, "uploaded_documents")).select("document_id", "document_type")


@register(
    "k22_format_bytes",
    over("uploaded_documents", "SELECT document_id, CASE WHEN b < 1024 THEN round_even(b::double, 1)::varchar || ' B' "
         "WHEN b < 1048576 THEN round_even(b / 1024, 1)::varchar || ' KB' WHEN b < 1073741824 THEN round_even(b / 1048576, 1)::varchar || ' MB' "
         "ELSE round_even(b / 1073741824, 1)::varchar || ' GB' END AS shown_size FROM (SELECT *, file_size_bytes AS b FROM uploaded_documents)"),
)
def _(spark, sf):
    return cv.describe_documents(load(spark, sf, "uploaded_documents")).select("document_id", "shown_size")


@register(
    "k23_bmi",
    over("user_medical_profiles", "SELECT user_id, round_even(weight_kg / ((height_cm / 100) * (height_cm / 100)), 1) AS bmi FROM user_medical_profiles"),
)
def _(spark, sf):
    return load(spark, sf, "user_medical_profiles").select("user_id", cv.bmi("weight_kg", "height_cm").alias("bmi"))


@register(
    "k24_valid_email",
    over("users", "SELECT user_id, regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}') AS email_ok FROM users"),
)
def _(spark, sf):
    return cv.check_emails(load(spark, sf, "users")).select("user_id", "email_ok")


@register(
    "k25_pair_turns",
    "SELECT u.conv_id, u.turn, u.text AS user_message, a.text AS assistant_response FROM conversations u JOIN conversations a "
    "ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'",
)
def _(spark, sf):
    return cv.pair_turns(fixtures.shared(spark, sf, "conversations"))


@register(
    "k25_unpair_turns",
    "SELECT conv_id, turn, role, text FROM conversations c WHERE (role = 'user' AND EXISTS (FROM conversations a WHERE a.conv_id = c.conv_id "
    "AND a.turn = c.turn + 1 AND a.role = 'assistant')) OR (role = 'assistant' AND EXISTS (FROM conversations u WHERE u.conv_id = c.conv_id "
    "AND u.turn = c.turn - 1 AND u.role = 'user'))",
)
def _(spark, sf):
    return cv.unpair_turns(cv.pair_turns(fixtures.shared(spark, sf, "conversations")))


@register(
    "k26_filter_docs",
    over("uploaded_documents", f"SELECT 'imaging' AS listing, document_id AS item FROM uploaded_documents WHERE {_TYPE} = 'imaging' UNION ALL "
         f"SELECT DISTINCT 'types', {_TYPE} FROM uploaded_documents"),
)
def _(spark, sf):
    docs = cv.describe_documents(load(spark, sf, "uploaded_documents"))
    found = cv.filter_docs(docs, "imaging").select(F.lit("imaging").alias("listing"), F.col("document_id").alias("item"))
    return found.unionAll(cv.list_types(docs).select(F.lit("types"), "document_type"))


@register(
    "k27_profile_validity",
    over("users user_medical_profiles", "SELECT user_id, coalesce(height_cm BETWEEN 50 AND 250, true) AND coalesce(weight_kg BETWEEN 20 AND 300, true) "
         "AND coalesce(date_of_birth <= DATE '2024-02-01', true) AS is_valid_profile FROM users LEFT JOIN user_medical_profiles USING (user_id)"),
)
def _(spark, sf):
    joined = cv.user_profile(load(spark, sf, "users"), load(spark, sf, "user_medical_profiles"))
    return cv.profile_validity(joined, DAY).select("user_id", "is_valid_profile")


# --- streaming ------------------------------------------------------------------------------------
def stream(spark, sf):
    """The conversation table as a stream over the event files."""
    schema = fixtures.shared(spark, sf, "events").schema.simpleString()[len("struct<") : -1].replace(":", " ")
    jobs.file_stream(spark, sf, schema, "events.parquet").createOrReplaceTempView("events")
    return spark.sql(fixtures.view_sql(HISTORY))


def drained(spark, sf, name, start):
    out, checkpoint = tables.work_path(spark, name), tables.work_path(spark, f"{name}-checkpoint")
    start(stream(spark, sf), out, checkpoint, None).awaitTermination()
    return spark.read.parquet(out)


@register("s01_stream_searchable", over(HISTORY, _SEARCHABLE))
def _(spark, sf):
    return drained(spark, sf, "searchable", jobs.stream_searchable)


@register(
    "s02_stream_triage",
    over(HISTORY, "SELECT t.*, h.user_id, h.message_timestamp FROM (" + _triage_sql(HISTORY, "conversation_id", "user_message")
         + ") t JOIN conversation_history h USING (conversation_id)"),
)
def _(spark, sf):
    return drained(spark, sf, "triage", jobs.stream_triage)


@register(
    "s03_stream_metrics",
    over(HISTORY, f"SELECT g.*, message_timestamp, message_timestamp::date AS measurement_date FROM ({_GRADED}) g "
         "JOIN conversation_history h USING (conversation_id, user_id)", MESSAGES_CTE, _READINGS),
)
def _(spark, sf):
    return drained(spark, sf, "metrics", jobs.stream_metrics).drop("key_bucket")


# --- procedures as jobs ---------------------------------------------------------------------------
_KNOWN = (
    "known",
    "SELECT user_id, array_to_string(list_filter([if(has_diabetes, 'Diabetes', NULL), if(has_hypertension, 'Hypertension', NULL), "
    "if(has_heart_disease, 'Heart Disease', NULL), if(has_mental_health_history, 'Mental Health History', NULL)], lambda c: c IS NOT NULL), ', ') "
    "AS k FROM user_medical_profiles",
)


_PROMPT = (
    "prompts",
    f"SELECT conversation_id, {lit(ctx.ROUTER_TEMPLATE)} || user_message || if(coalesce(k, '') = '', '', chr(10) || 'Medical history: ' || k) AS router_prompt "
    "FROM conversation_history LEFT JOIN known USING (user_id)",
)


def router_stand_in(prompts):
    """A model that answers by a few words of the prompt, sometimes fenced, sometimes not in JSON."""
    import pandas as pd

    def answer(prompt):
        message = (prompt or "")[len(ctx.ROUTER_TEMPLATE) :]
        if "pharmacy" in message or "foods" in message:
            return "I cannot say." if "foods" in message else '{"domain": "OTHER", "urgency": "ROUTINE", "confidence": 0.4, "scope_violation": true}'
        if "anxiety" in message or "stress" in message:
            return '```json\n{"domain": "MENTAL_HEALTH", "urgency": "ROUTINE", "confidence": 0.75}\n```'
        if "BP" in message or "PAIN" in message:
            return '{"domain": "HEART_DISEASE", "urgency": "URGENT", "confidence": 0.9, "scope_violation": false}'
        if "vision" in message:
            return '{"domain": "EYES", "urgency": "URGENT", "confidence": 0.5}'
        if "A1C" in message:
            return '{"urgency": "URGENT"}'
        return '```\n{"domain": "DIABETES", "urgency": "NEEDS_ATTENTION", "confidence": 0.8}\n```'

    return pd.Series([answer(p) for p in prompts])


def _answers(*values):
    """The router's answer by message, written as SQL; one value per rule above."""
    tests = ("m LIKE '%foods%'", "m LIKE '%pharmacy%'", "m LIKE '%anxiety%' OR m LIKE '%stress%'", "m LIKE '%BP%' OR m LIKE '%PAIN%'", "m LIKE '%vision%'", "m LIKE '%A1C%'")
    return "CASE " + " ".join(f"WHEN {t} THEN {v}" for t, v in zip(tests, values)) + f" ELSE {values[-1]} END"


_DM, _HTN, _MH = (lit(vocab.DOMAIN_MODELS[ctx.SPECIALIST_OF[d]]) for d in ("DIABETES", "HEART_DISEASE", "MENTAL_HEALTH"))


@register(
    "u01_classify_user_query",
    over("conversation_history user_medical_profiles",
         f"SELECT conversation_id, router_prompt, {_answers(*map(lit, ('DIABETES', 'OTHER', 'MENTAL_HEALTH', 'HEART_DISEASE', 'EYES', 'DIABETES', 'DIABETES')))} AS domain, "
         f"{_answers(*map(lit, ('ROUTINE', 'ROUTINE', 'ROUTINE', 'URGENT', 'URGENT', 'ROUTINE', 'NEEDS_ATTENTION')))} AS urgency, "
         f"{_answers('0.5', '0.4', '0.75', '0.9', '0.5', '0.5', '0.8')}::double AS confidence, "
         f"{_answers(_DM, 'NULL', _MH, _HTN, lit(ctx.GENERAL_MODEL), _DM, _DM)} AS specialist_model, "
         f"{_answers(*map(lit, ('error', 'success', 'success', 'success', 'success', 'error', 'success')))} AS classification_status "
         f"FROM (SELECT *, substr(router_prompt, {len(ctx.ROUTER_TEMPLATE) + 1}) AS m FROM prompts)", _KNOWN, _PROMPT),
)
def _(spark, sf):
    history, profiles = talk(spark, sf).select("conversation_id", "user_id", "user_message"), load(spark, sf, "user_medical_profiles")
    found = ctx.classify_messages(history, "user_message", profiles, router_stand_in)
    prompts = ctx.router_prompts(history, "user_message", profiles).select("conversation_id", "router_prompt")
    return found.join(prompts, "conversation_id").select(
        "conversation_id", "router_prompt", "domain", "urgency", "confidence", "specialist_model", "classification_status"
    )


_ROLE = pick(*[(v, f"routed_to_domain = '{k}'") for k, v in ctx.SPECIALIST_ROLES.items()], default=ctx.SPECIALIST_ROLES["DIABETES"])
_SECTIONS = " || ".join(f"{lit(chr(10) * 2 + '## ' + t + chr(10))} || {c}" for t, c in ctx.SECTIONS.items())


_REPLIES = ("Risk assessment: 2/5 - Key messages: rest well.", "TRIAGE:\nRecommended foods: beans \n\n\n\nSleep.", "All is well.")


def specialist_stand_in(prompts):
    """A model whose reply depends on the length of the prompt."""
    import pandas as pd

    return pd.Series([_REPLIES[len(p) % 3] for p in prompts])


_ASKED_PROMPT = f"{_ROLE} || {_SECTIONS} || {lit(chr(10) * 2 + '## QUESTION' + chr(10))} || query_text"


@register(
    "u02_specialist_prompt",
    over(_CONTEXT_INPUTS, f"SELECT query_id, specialist_prompt, regexp_replace(if(coalesce(contains(lower(metrics_context), 'improved'), false), "
         f"{lit(vocab.PROGRESS_PREFIX)}, '') || regexp_replace({_LINES}, '\\n\\n\\n+', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS cleaned_response "
         f"FROM (SELECT *, {_list(_REPLIES)}[length(specialist_prompt) % 3 + 1] AS reply FROM (SELECT *, {_ASKED_PROMPT} AS specialist_prompt FROM context))",
         _NEWEST, _corpus(30), *_CONTEXT),
)
def _(spark, sf):
    asked, bundle = context(spark, sf)
    joined = bundle.join(asked.select("query_id", "query_text"), "query_id")
    return ctx.specialist_replies(joined, "query_text", "routed_to_domain", specialist_stand_in).select("query_id", "specialist_prompt", "cleaned_response")


_SAVED = (
    "saved",
    f"""SELECT md5(conversation_id || '|' || metric_type || '|' || metric_value::varchar) AS metric_id, user_id, conversation_id, metric_type,
 metric_value, metric_unit, message_timestamp::date AS measurement_date, message_timestamp AS reported_date, 'conversation_extracted' AS source,
 0.95::double AS confidence_score, is_abnormal, severity FROM ({_GRADED}) JOIN conversation_history USING (conversation_id, user_id)""",
)


def saved(spark, sf, runs=1):
    """The table of extracted readings, saved so many times over."""
    path = tables.work_path(spark, "saved_readings")
    rows = cv.saved_readings(talk(spark, sf))
    for _ in range(runs):
        tables.append_new(rows, path, ["metric_id"], "measurement_date")
    return spark.read.parquet(path).select(*rows.columns)


@register("u04_extract_and_save_metrics", over(HISTORY, "SELECT * FROM saved", MESSAGES_CTE, _READINGS, _SAVED))
def _(spark, sf):
    return saved(spark, sf, runs=2)


_WITH_SAVED = (
    "health_metrics_saved",
    "SELECT metric_id, user_id, metric_type, metric_value, measurement_date FROM health_metrics UNION ALL "
    "SELECT metric_id, user_id, metric_type, metric_value, measurement_date FROM saved",
)


@register(
    "u05_trends_of_saved_readings",
    over("conversation_history health_metrics", "SELECT * FROM trends", MESSAGES_CTE, _READINGS, _SAVED, _WITH_SAVED,
         (_TRENDS[0], _TRENDS[1].replace("FROM health_metrics", "FROM health_metrics_saved"))),
)
def _(spark, sf):
    return cv.metric_trends(tables.append_rows(load(spark, sf, "health_metrics"), saved(spark, sf)), DAY)


@register(
    "u06_summarize_session",
    over(HISTORY, "SELECT summary_id, user_id, summary_type, summary_text, domain, time_period_start, time_period_end FROM summaries", _SPANS, _SUMMARIES),
)
def _(spark, sf):
    return cv.session_summaries(talk(spark, sf))


# Words that the stand-in takes for concerns, in the order it lists them.
_CONCERNS = ("CHEST PAIN", "anxiety", "cholesterol", "fever", "pharmacy", "vision loss")


def summary_stand_in(prompts):
    """A model that names the concerns and the highest pressure of a text, and partial summaries alike; else not in JSON."""
    import json
    import re

    import pandas as pd

    def answer(prompt):
        text = prompt[len(sm.SUMMARY_HEAD) :]
        concerns = [c for c in _CONCERNS if c in text]
        pressures = [int(a or b) for a, b in re.findall(r'BP (?:is )?(\d+)/|"bp": (\d+)', text)]
        if not concerns and not pressures:
            return "Nothing of note."
        reply = json.dumps({
            "main_topic": concerns[0] if concerns else "pressure", "key_concerns": concerns, "recommendations": ["rest"] * len(pressures[:1]),
            "metrics_mentioned": {"bp": max(pressures)} if pressures else {}, "summary_text": "Talk of " + ", ".join(concerns) + ".",
        })
        return f"```json\n{reply}\n```" if len(concerns) % 2 else reply

    return pd.Series([answer(p) for p in prompts], dtype=object)


_FOUND = (
    "found",
    "SELECT user_id, session_id, "
    + ", ".join(f"bool_or(contains(user_message, {lit(c)})) AS c{i}" for i, c in enumerate(_CONCERNS))
    + r""", max(list_max(list_transform(regexp_extract_all(user_message, 'BP (?:is )?(\d+)/', 1), lambda v: v::int))) AS bp
 FROM conversation_history GROUP BY 1, 2""",
)
_SUMMED = (
    "summed",
    f"""SELECT md5(user_id || '|' || session_id || '|' || turns) AS summary_id, user_id, session_id, turns > 1 AND (len(concerns) > 0 OR bp IS NOT NULL) AS summary_created,
 turns, domain, time_period_start, time_period_end, concerns, bp FROM (SELECT user_id, session_id, bp, list_filter([{", ".join(f"if(c{i}, {lit(c)}, NULL)" for i, c in enumerate(_CONCERNS))}],
 lambda c: c IS NOT NULL) AS concerns FROM found) JOIN (SELECT user_id, session_id, (array_agg(routed_to_domain ORDER BY message_timestamp, conversation_id))[1] AS domain,
 count(*) AS turns, min(message_timestamp) AS time_period_start, max(message_timestamp) AS time_period_end FROM conversation_history GROUP BY 1, 2) USING (user_id, session_id)""",
)
_OUTCOMES = (
    "outcomes",
    """SELECT summary_id, user_id, session_id, summary_created, if(summary_created, NULL, if(turns < 2, 'Not enough messages', 'Unreadable reply')) AS reason,
 'session_summary' AS summary_type, if(summary_created, coalesce(concerns[1], 'pressure'), NULL) AS main_topic,
 if(summary_created, 'Talk of ' || array_to_string(concerns, ', ') || '.', NULL) AS summary_text,
 if(summary_created AND len(concerns) > 0, array_to_string(concerns, '|'), NULL) AS key_topics,
 if(summary_created, if(bp IS NULL, '', 'rest'), NULL) AS recommendations,
 if(summary_created, if(bp IS NULL, '{}', '{"bp":' || bp || '}'), NULL) AS mentioned_metrics, domain, turns, time_period_start, time_period_end FROM summed""",
)


@register("u06_session_outcomes", over(HISTORY, "SELECT * FROM outcomes", _FOUND, _SUMMED, _OUTCOMES))
def _(spark, sf):
    return sm.summarize_sessions(talk(spark, sf), summary_stand_in)


@register(
    "u06_saved_summaries",
    over(HISTORY, f"SELECT {', '.join(sm.SAVED_COLUMNS)}, time_period_start::date AS summary_date FROM outcomes WHERE summary_created", _FOUND, _SUMMED, _OUTCOMES),
)
def _(spark, sf):
    path, rows = tables.work_path(spark, "saved_summaries"), sm.summarize_sessions(talk(spark, sf), summary_stand_in)
    for _ in range(2):
        sm.save_summaries(rows, path)
    return spark.read.parquet(path).select(*sm.SAVED_COLUMNS, "summary_date")
