"""Extra inputs of the registered queries: portable SELECTs over the shared tables and fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.sqltext import lit, with_ctes
from vitalframe.sources import fixtures
from vitalframe.sources.fixtures import view_sql
from vitalframe.sources.router_cases import CASES, router_testcases

AS_OF = "2024-02-01"

_CASE_COLUMNS = "case_no, test_id, expected_domain, expected_urgency, expected_safety_flag, user_query, test_notes"
_CASE_VALUES = ", ".join("(" + ", ".join(lit(v) for v in (i, *case)) + ")" for i, case in enumerate(CASES))

# name -> (fixtures or inputs it reads, SELECT valid in both engines)
EXTRA = {
    # One router reply per event: mostly right, some wrong, some fenced, some not JSON.
    "router_results": (
        ("router_cases",),
        """SELECT concat(c.test_id, '-', CAST(e.event_id AS VARCHAR(20))) AS test_id, c.user_query, c.test_notes,
 c.expected_domain, c.expected_urgency, c.expected_safety_flag,
 CASE WHEN e.event_id%29=0 THEN 'no answer' ELSE concat(CASE WHEN e.event_id%6=0 THEN '```json ' ELSE '' END,
 '{"domain": "', CASE WHEN e.event_id%11=0 THEN 'diabetes' ELSE c.expected_domain END, '", "urgency": "',
 CASE WHEN e.event_id%13=0 THEN 'routine' ELSE c.expected_urgency END, '", "safety_flag": ',
 CASE WHEN (e.event_id%17=0) = c.expected_safety_flag THEN 'false' ELSE 'true' END,
 ', "extracted_symptoms": ["s', CAST(e.event_id%4 AS VARCHAR(20)), '", "t"], "reasoning": "because"}',
 CASE WHEN e.event_id%6=0 THEN ' ```' ELSE '' END) END AS reply
 FROM events e JOIN router_cases c ON c.case_no = e.event_id%30""",
    ),
    "incoming_users": (
        (),
        """SELECT concat('u', CAST(c_custkey+700 AS VARCHAR(20))) AS user_id, concat('Renamed ', c_name) AS full_name,
 concat('n', CAST(c_custkey AS VARCHAR(20)), '@example.org') AS email, 'suspended' AS account_status FROM customer""",
    ),
    "profile_patches": (
        (),
        """SELECT concat('u', CAST(c_custkey AS VARCHAR(20))) AS user_id,
 CASE WHEN c_custkey%3=0 THEN CAST(60+c_custkey%10 AS DOUBLE) ELSE NULL END AS weight_kg,
 CASE WHEN c_custkey%5=0 THEN TRUE ELSE NULL END AS has_diabetes,
 CASE WHEN c_custkey%2=0 THEN TRUE ELSE NULL END AS is_pregnant,
 CASE c_custkey%3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' ELSE NULL END AS gender FROM customer""",
    ),
    "stamped_profiles": (
        ("user_medical_profiles",),
        "SELECT p.*, DATE '2023-06-01' AS last_updated FROM user_medical_profiles p",
    ),
    "model_responses": (
        ("model_predictions",),
        """SELECT patient_id, concat('Case ', patient_id) AS prompt, 'Expected answer' AS expected_completion,
 ground_truth_urgency AS expected_urgency, model_prediction_raw AS small_reply, upper(model_prediction_raw) AS large_reply,
 concat('Advice: ', model_prediction_raw) AS mixed_reply, 'none' AS mute_reply FROM model_predictions""",
    ),
    "banner_replies": (
        ("model_predictions",),
        """SELECT patient_id, CASE ground_truth_urgency WHEN 'emergency' THEN concat('⚠️ EMERGENCY: ', model_prediction_raw)
 WHEN 'urgent' THEN concat('⚡ URGENT: ', model_prediction_raw) ELSE concat('📋 ROUTINE: ', model_prediction_raw) END AS reply
 FROM model_predictions""",
    ),
    "recall_replies": (
        (),
        """SELECT concat('u', CAST(c_custkey AS VARCHAR(20))) AS user_id,
 CASE c_custkey%6 WHEN 0 THEN 'I remember your visit. Keep walking.' WHEN 1 THEN 'Last time we spoke. Drink  water. '
 WHEN 2 THEN 'WE PREVIOUSLY DISCUSSED salt. Eat beans.' WHEN 3 THEN concat('Your sugar level has improved a lot. Good.', c_name)
 WHEN 4 THEN 'You mentioned pain before lunch. Rest.' ELSE 'Nothing to remove. Sleep well.' END AS reply FROM customer""",
    ),
    "raw_replies": (
        (),
        """SELECT event_id, CASE event_id%5 WHEN 0 THEN 'risk ASSESSMENT: 3/5 - Key messages: rest well.'
 WHEN 1 THEN concat('Fine.', chr(10), 'Lifestyle priorities:', chr(10), 'Walk daily.', chr(10), chr(10), chr(10), 'Sleep.')
 WHEN 2 THEN concat('TRIAGE:', chr(10), 'Recommended foods: beans ') WHEN 3 THEN concat(' Priority topics:  salt', chr(10))
 ELSE 'All is well.' END AS reply,
 CASE WHEN event_id%3=0 THEN 'BP Improved by 5' WHEN event_id%3=1 THEN 'BP stable' ELSE NULL END AS metrics_context FROM events""",
    ),
    "routed_replies": (
        (),
        """SELECT event_id, CASE event_id%4 WHEN 0 THEN 'DIABETES' WHEN 1 THEN 'HEART_DISEASE' WHEN 2 THEN 'MENTAL_HEALTH' ELSE 'WOMEN_WELLNESS' END AS domain,
 CASE event_id%3 WHEN 0 THEN 'URGENT' WHEN 1 THEN 'NEEDS_ATTENTION' ELSE 'ROUTINE' END AS urgency,
 CASE WHEN event_id%7=0 THEN NULL ELSE CAST(event_id%8 AS DOUBLE)/8 END AS confidence, concat('Answer ', CAST(event_id AS VARCHAR(20))) AS reply FROM events""",
    ),
    "health_corpus": (
        ("conversation_history",),
        """SELECT h.conversation_id, h.user_id, h.routed_to_domain, CAST(h.message_timestamp AS DATE) AS conversation_date,
 h.message_timestamp, m.embedding FROM conversation_history h CROSS JOIN (SELECT count(*) AS n_vec FROM embeddings) z
 JOIN embeddings m ON m.vec_id = CAST(substring(h.conversation_id, 2, 20) AS BIGINT) % z.n_vec""",
    ),
    "model_accuracy": (
        (),
        """SELECT concat('model_', CAST(o_custkey%7 AS VARCHAR(20))) AS model,
 CAST(sum(CASE WHEN o_orderkey%100 < 70+o_custkey%7*5 THEN 1 ELSE 0 END) AS DOUBLE)/count(*) AS train_acc,
 CAST(sum(CASE WHEN o_orderkey%97 < 68+o_custkey%7*4 THEN 1 ELSE 0 END) AS DOUBLE)/count(*) AS val_acc,
 CAST(sum(CASE WHEN o_orderkey%91 < 60+o_custkey%7*4 THEN 1 ELSE 0 END) AS DOUBLE)/count(*) AS test_acc
 FROM orders GROUP BY o_custkey%7""",
    ),
    "starter_ids": ((), "SELECT nullif(c_nationkey, 0) AS id FROM customer"),
}


def input_ctes(name: str) -> list[tuple[str, str]]:
    """CTEs that define the named input for DuckDB, its own inputs first."""
    if name == "router_cases":
        return [("router_cases", f"SELECT * FROM (VALUES {_CASE_VALUES}) v({_CASE_COLUMNS})")]
    if name in EXTRA:
        needs, text = EXTRA[name]
        return [cte for n in needs for cte in input_ctes(n)] + [(name, text)]
    return [(name, view_sql(name))]


def ctes(*names: str) -> list[tuple[str, str]]:
    seen: dict[str, str] = {}
    for name in names:
        for key, body in input_ctes(name):
            seen.setdefault(key, body)
    return list(seen.items())


def over(names: str, final: str, *more: tuple[str, str]) -> str:
    """DuckDB statement over the named inputs."""
    return with_ctes([*ctes(*names.split()), *more], final)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input as a Spark DataFrame."""
    if name == "router_cases":
        return router_testcases(spark)
    if name not in EXTRA:
        return fixtures.view(spark, sf_dir, name)
    needs, text = EXTRA[name]
    for need in needs:
        load(spark, sf_dir, need).createOrReplaceTempView(need)
    for table in fixtures.SHARED_TABLES:
        if f"FROM {table}" in text or f"JOIN {table}" in text:
            fixtures.shared(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(text)
