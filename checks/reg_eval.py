"""Model-output evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import load, over
from checks.registry import register
from checks.sqltext import half_up, lit, pct
from vitalframe.functions.text import reply_urgency, strip_fences
from vitalframe.operators import evaluation as ev

_PREDICTED = (
    "scored",
    "SELECT *, CASE WHEN regexp_matches(model_prediction_raw, 'IMMEDIATE EMERGENCY|emergency evaluation|Direct to emergency|emergency department') "
    "THEN 'emergency' WHEN regexp_matches(model_prediction_raw, 'URGENT.*evaluation|24-48 hours|urgent medical evaluation|requires URGENT') "
    "THEN 'urgent' WHEN regexp_matches(model_prediction_raw, 'ROUTINE.*follow-up|routine monitoring|regular monitoring|ROUTINE.*care') "
    "THEN 'routine' ELSE 'unclear' END AS predicted_urgency FROM model_predictions",
)
ACTUAL, PREDICTED = "ground_truth_urgency", "predicted_urgency"


def scored(spark, sf):
    return ev.predict_labels(load(spark, sf, "model_predictions"), "model_prediction_raw")


def _sql(final):
    return over("model_predictions", final, _PREDICTED)


@register("e01_predict_label", _sql("SELECT patient_id, predicted_urgency FROM scored"))
def _(spark, sf):
    return scored(spark, sf).select("patient_id", PREDICTED)


_HIT = "count(*) FILTER (ground_truth_urgency = predicted_urgency)"


@register(
    "e02_accuracy",
    _sql(f"SELECT 'OVERALL ACCURACY' AS metric, count(*) AS total, {_HIT} AS correct, {pct(_HIT, 'count(*)')} AS accuracy_percentage FROM scored"),
)
def _(spark, sf):
    return ev.accuracy(scored(spark, sf), ACTUAL, PREDICTED)


@register(
    "e03_confusion",
    _sql("SELECT actual, predicted, n AS count_val, " + pct("n", "sum(n) OVER (PARTITION BY actual)") + " AS percentage FROM "
         "(SELECT ground_truth_urgency AS actual, predicted_urgency AS predicted, count(*) AS n FROM scored GROUP BY 1, 2)"),
)
def _(spark, sf):
    return ev.confusion(scored(spark, sf), ACTUAL, PREDICTED)


@register(
    "e04_class_accuracy",
    _sql(f"SELECT ground_truth_urgency, count(*) AS total_cases, {_HIT} AS correct_cases, {pct(_HIT, 'count(*)')} AS class_accuracy "
         "FROM scored GROUP BY 1"),
)
def _(spark, sf):
    return ev.class_accuracy(scored(spark, sf), ACTUAL, PREDICTED)


@register(
    "e05_safety_misses",
    _sql("SELECT 'Emergency cases missed' AS safety_metric, count(*) AS count_val FROM scored WHERE ground_truth_urgency = 'emergency' "
         "AND predicted_urgency <> 'emergency' UNION ALL SELECT 'Emergency → Routine (CRITICAL ERROR)', count(*) FROM scored "
         "WHERE ground_truth_urgency = 'emergency' AND predicted_urgency = 'routine'"),
)
def _(spark, sf):
    return ev.safety_misses(scored(spark, sf), ACTUAL, PREDICTED)


_ORDER = "md5('5|' || patient_id), patient_id"


def _samples_sql(correct):
    name, op = ("CORRECT", "=") if correct else ("INCORRECT", "<>")
    return (
        f"SELECT '{name} PREDICTIONS' AS category, patient_id, ground_truth_urgency AS actual, predicted_urgency AS predicted, "
        f"left(prompt, 200) AS prompt_preview, left(model_prediction_raw, 200) AS prediction_preview FROM scored "
        f"JOIN (SELECT patient_id, prompt FROM model_responses) USING (patient_id) WHERE ground_truth_urgency {op} predicted_urgency "
        f"ORDER BY {_ORDER} LIMIT 5"
    )


@register("e06_sample_predictions", over("model_responses", f"(SELECT * FROM ({_samples_sql(True)})) UNION ALL (SELECT * FROM ({_samples_sql(False)}))", _PREDICTED))
def _(spark, sf):
    args = (ACTUAL, PREDICTED, "model_prediction_raw", "patient_id")
    df = scored(spark, sf).join(load(spark, sf, "model_responses").select("patient_id", "prompt"), "patient_id")
    return ev.sample_predictions(df, *args, True, 5, 5).unionAll(ev.sample_predictions(df, *args, False, 5, 5))


# --- JSON replies ---------------------------------------------------------------------------------
_BARE = "trim(regexp_replace(regexp_replace(reply, '^```(json)?', ''), '```$', ''))"
_PARSED = (
    "parsed",
    f"""SELECT *, try_cast({_BARE} AS json) AS j FROM router_results""",
)
_CLASSIFIED = (
    "classified",
    """SELECT test_id, test_notes, expected_domain, expected_urgency, expected_safety_flag, reply, j IS NOT NULL AS is_valid_json,
 j->>'$.domain' AS classified_domain, j->>'$.urgency' AS classified_urgency, (j->>'$.safety_flag')::boolean AS classified_safety_flag,
 j->>'$.reasoning' AS reasoning, array_to_string((j->'$.extracted_symptoms')::varchar[], '|') AS extracted_symptoms FROM parsed""",
)


def classified(spark, sf):
    fields = {"domain": "string", "urgency": "string", "safety_flag": "boolean", "reasoning": "string"}
    parsed = ev.parse_replies(load(spark, sf, "router_results"), "reply", fields)
    return parsed.withColumnsRenamed({c: f"classified_{c}" for c in ("domain", "urgency", "safety_flag")})


def _router(final):
    return over("router_results", final, _PARSED, _CLASSIFIED)


_SCORES = (
    "scores",
    "SELECT *, round((j->>'$.score')::double)::int AS score, (j->>'$.urgency_correct')::boolean AS urgency_correct, "
    "j->>'$.reasoning' AS reasoning FROM (SELECT *, try_cast(reply AS json) AS j FROM model_replies)",
)


def scores(spark, sf):
    fields = {"score": "decimal(38,0)", "urgency_correct": "boolean", "reasoning": "string"}
    return ev.parse_replies(load(spark, sf, "model_replies"), "reply", fields, None)


@register(
    "e07_parse_replies",
    _router("SELECT test_id, classified_domain, classified_urgency, classified_safety_flag, reasoning, extracted_symptoms, is_valid_json FROM classified"),
)
def _(spark, sf):
    return classified(spark, sf).select(
        "test_id", "classified_domain", "classified_urgency", "classified_safety_flag", "reasoning", "extracted_symptoms",
        "is_valid_json",
    )


@register("e08_strip_fences", over("router_results", f"SELECT test_id, {_BARE} AS body FROM router_results"))
def _(spark, sf):
    return load(spark, sf, "router_results").select("test_id", strip_fences("reply").alias("body"))


def _rate(cond, count, rate):
    hits = f"count(*) FILTER (coalesce({cond}, false))"
    return f"{hits} AS {count}, {pct(hits, 'count(*)')} AS {rate}"


_D, _U, _S = (
    "expected_domain = classified_domain", "expected_urgency = classified_urgency",
    "expected_safety_flag = classified_safety_flag",
)


@register(
    "e09_router_accuracy",
    _router("SELECT count(*) AS total_cases, " + ", ".join([
        _rate("is_valid_json", "valid_json_count", "json_success_rate"), _rate(_D, "domain_correct_count", "domain_accuracy"),
        _rate(_U, "urgency_correct_count", "urgency_accuracy"), _rate(_S, "safety_correct_count", "safety_accuracy"),
        _rate(f"{_D} AND {_U} AND {_S}", "perfect_match_count", "perfect_match_rate")]) + " FROM classified"),
)
def _(spark, sf):
    return ev.router_accuracy(classified(spark, sf))


@register(
    "e10_router_errors",
    _router("""SELECT test_id, 'CRITICAL: Safety Flag Errors' AS error_type, if(expected_safety_flag, 1, 2) AS severity_rank,
 if(expected_safety_flag, '🚨 MISSED EMERGENCY - False Negative', '⚠️ False Alarm - False Positive') AS error_severity,
 expected_safety_flag::varchar AS expected, classified_safety_flag::varchar AS classified, test_notes FROM classified
 WHERE expected_safety_flag <> classified_safety_flag
 UNION ALL SELECT test_id, 'Domain Errors', 3, NULL, expected_domain, classified_domain, test_notes FROM classified WHERE expected_domain <> classified_domain
 UNION ALL SELECT test_id, 'Urgency Errors', 3, NULL, expected_urgency, classified_urgency, test_notes FROM classified WHERE expected_urgency <> classified_urgency
 UNION ALL SELECT test_id, 'JSON Parse Errors', 4, NULL, reply, reply, test_notes FROM classified WHERE NOT is_valid_json"""),
)
def _(spark, sf):
    return ev.router_errors(classified(spark, sf))


@register(
    "e11_router_perfect",
    _router(f"SELECT test_id, expected_domain, expected_urgency, reasoning FROM classified WHERE {_D} AND {_U} AND {_S}"),
)
def _(spark, sf):
    return ev.router_perfect(classified(spark, sf)).select("test_id", "expected_domain", "expected_urgency", "reasoning")


_MODELS = {"small_reply": "small", "large_reply": "large", "mixed_reply": "mixed", "mute_reply": "mute"}


@register(
    "e12_judge_prompts",
    over("model_responses", "SELECT patient_id, prompt, expected_completion, expected_urgency, model_name, response, "
         f"{lit(ev.JUDGE_HEAD)} || 'ORIGINAL PROMPT:' || chr(10) || prompt || {lit(chr(10) * 2 + 'EXPECTED RESPONSE:' + chr(10))} || expected_completion || "
         f"{lit(chr(10) * 2 + 'MODEL RESPONSE:' + chr(10))} || response || {lit(chr(10) * 2 + 'Expected Urgency: ')} || expected_urgency || "
         f"{lit(chr(10) * 2 + ev.JUDGE_CRITERIA)} AS judge_prompt FROM ("
         + " UNION ALL ".join(f"SELECT *, '{m}' AS model_name, {c} AS response FROM model_responses" for c, m in _MODELS.items()) + ")"),
)
def _(spark, sf):
    return ev.judge_prompts(load(spark, sf, "model_responses"), _MODELS)


_RANKING = (
    "SELECT model_name, " + half_up("avg(score)", 2) + " AS avg_score, "
    + pct("count(*) FILTER (coalesce(urgency_correct, false))", "count(*)", 1) + " AS urgency_accuracy_pct, count(*) AS total_cases, "
    "count(*) FILTER (score >= 8) AS excellent_responses, count(*) FILTER (score < 5) AS poor_responses, min(score) AS worst_score, "
    "max(score) AS best_score FROM scores GROUP BY 1"
)


@register("d09_rank_models", over("model_replies", _RANKING, _SCORES))
@register("e13_judge_ranking", over("model_replies", _RANKING, _SCORES))
def _(spark, sf):
    return ev.rank_models(scores(spark, sf))


@register(
    "e14_failure_cases",
    over("model_replies model_responses", "SELECT patient_id, expected_urgency, left(prompt, 150) AS prompt_preview, left(small_reply, 200) AS response_preview, "
         "score, reasoning AS why_failed FROM scores JOIN model_responses USING (patient_id) WHERE model_name = 'model_b' AND score < 6 "
         "ORDER BY score, patient_id LIMIT 10", _SCORES),
)
def _(spark, sf):
    return ev.failure_cases(scores(spark, sf), load(spark, sf, "model_responses"), "model_b", "small_reply", 6, 10)


@register(
    "e15_score_batch",
    over("model_predictions", "SELECT patient_id, CASE WHEN lower(model_prediction_raw) LIKE '%emergency%' THEN 'emergency' "
         "WHEN lower(model_prediction_raw) LIKE '%urgent%' THEN 'urgent' ELSE 'routine' END AS model_response FROM model_predictions"),
)
def _(spark, sf):
    return ev.score_batch(load(spark, sf, "model_predictions"), "model_prediction_raw").select("patient_id", "model_response")


@register(
    "e16_reply_urgency",
    over("banner_replies model_predictions", "SELECT b.patient_id, p.ground_truth_urgency AS urgency FROM banner_replies b "
         "JOIN model_predictions p USING (patient_id)"),
)
def _(spark, sf):
    return load(spark, sf, "banner_replies").select("patient_id", reply_urgency("reply").alias("urgency"))
