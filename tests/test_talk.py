"""Triage, readings, replies and evaluation on hand-made rows, and the labelled router cases."""

import pytest
from pyspark.sql import functions as F

from vitalframe.functions import text as tx
from vitalframe.operators import conversation as cv
from vitalframe.operators import evaluation as ev
from vitalframe.sources.router_cases import CASES, router_testcases


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


def test_router_cases_are_complete(spark):
    df = router_testcases(spark)
    assert df.count() == 30
    counts = {r["expected_urgency"]: r["count"] for r in df.groupBy("expected_urgency").count().collect()}
    assert counts == {"emergency": 6, "urgent": 12, "routine": 12}


def test_triage_of_router_cases(spark):
    out = {r.test_id: r for r in cv.triage_message(router_testcases(spark), "user_query").collect()}
    assert out["H001"].is_emergency and out["H001"].detected_symptoms == ["severe headache"]
    assert out["M001"].local_urgency == "emergency" and out["M001"].detected_symptoms == ["end my life"]
    assert out["D001"].local_urgency == "routine" and out["D001"].detected_symptoms == ["blood sugar"]
    assert out["A004"].local_urgency == "routine" and out["A004"].detected_symptoms == []


def test_routing_of_router_cases(spark):
    out = {r.test_id: r for r in cv.route_domain(router_testcases(spark), "user_query").collect()}
    assert out["D003"].routed_domain == "lifestyle_diseases_diabetes"
    assert out["MA005"].routed_domain == "womens_wellness_maternal"
    assert out["A004"].routed_domain == "out_of_scope" and out["A004"].specialist_model is None
    assert {r.test_id for r in out.values()} == {c[0] for c in CASES}


@pytest.mark.parametrize(
    "message,expected",
    [
        ("BP 150/95 then 150 / 95", [("blood_pressure_systolic", 150.0), ("blood_pressure_diastolic", 95.0)]),
        ("BP 300/95 and 60/20", []),
        ("Blood  Sugar: 180, glucose 180", [("blood_sugar", 180.0)]),
        ("bs 39 and bs: 40 and bs 600", [("blood_sugar", 40.0), ("blood_sugar", 600.0)]),
        ("jobs 150", []),
        ("A1C 9.5, hba1c: 2.9, HBA1C 20", [("hba1c", 9.5), ("hba1c", 20.0)]),
        (None, []),
    ],
)
def test_readings(spark, message, expected):
    df = spark.createDataFrame([("c", message, "LIFESTYLE_DISEASES")], "id string, m string, d string")
    out = cv.extract_metrics(df, ["m"], ["id"], "d").collect()
    assert [(r.metric_type, r.metric_value) for r in out] == expected
    assert cv.extract_metrics(df.withColumn("d", F.lit("MENTAL_HEALTH")), ["m"], ["id"], "d").count() == 0


def test_grades(spark):
    rows = [("blood_pressure_systolic", v) for v in (129.0, 130.0, 140.0, 180.0)] + [("hba1c", 6.49), ("hba1c", 9.0), ("weight", 500.0)]
    df = cv.grade_metric(spark.createDataFrame(rows, "metric_type string, metric_value double"))
    assert [r.severity for r in df.collect()] == ["normal", "mild", "moderate", "severe", "normal", "severe", "normal"]
    assert [r.is_abnormal for r in df.collect()] == [False, True, True, True, False, True, False]


def test_trend_edges(spark):
    import datetime as dt

    d = dt.date(2024, 1, 10)
    rows = [("u", "a", 0.0, d, "1"), ("u", "a", 9.0, d, "2"), ("u", "b", 100.0, d, "1"), ("u", "b", 104.9, d, "2"),
            ("u", "c", 100.0, d, "1"), ("u", "c", 95.0, d, "2"), ("u", "d", 5.0, d, "1"), ("u", "e", 1.0, dt.date(2020, 1, 1), "1")]
    df = spark.createDataFrame(rows, "user_id string, metric_type string, metric_value double, measurement_date date, metric_id string")
    out = {r.metric_type: (r.trend, r.percent_change) for r in cv.metric_trends(df, dt.date(2024, 2, 1)).collect()}
    assert out == {"a": ("stable", 0.0), "b": ("stable", 4.9), "c": ("decreasing", -5.0), "d": ("single_reading", 0.0)}


def test_transcript_covers_a_long_session(spark):
    df = spark.range(1200).select(
        F.format_string("c%04d", "id").alias("conversation_id"), F.lit("u").alias("user_id"), F.lit("s").alias("session_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 7).alias("message_timestamp"),
        F.concat(F.lit("q"), "id").alias("user_message"), F.concat(F.lit("a"), "id").alias("assistant_response"),
        F.lit("D").alias("routed_to_domain"),
    )
    rows = cv.session_transcripts(df).orderBy("turn_no").collect()
    assert [r.turn_no for r in rows] == list(range(1, 1201)) and {r.turns for r in rows} == {1200}
    assert [r.turn_text for r in rows] == [f"\nTurn {i + 1}:\nUser: q{i}\nAssistant: a{i}\n" for i in range(1200)]


def test_fences(spark):
    assert one(spark, '```json\n{"a": 1}\n``` tail', tx.strip_fences) == '{"a": 1}'
    assert one(spark, "```\nx\n```", tx.strip_fences) == "x"
    assert one(spark, "  plain ", tx.strip_fences) == "plain"


def test_scores_are_rounded_not_cut(spark):
    df = spark.createDataFrame([('{"score": 7.5}',), ('{"score": "x"}',), ("nope",), (None,)], "reply string")
    out = ev.parse_replies(df, "reply", {"score": "decimal(38,0)"}, None).collect()
    assert [r.score for r in out] == [8, None, None, None]
    assert [r.is_valid_json for r in out] == [True, True, False, False]


def test_sizes(spark):
    values = [0, 1023, 1024, 1280, 1536, 1048576, 5 * 1024**3, 3 * 1024**4]
    df = spark.createDataFrame([(v,) for v in values], "b long")
    assert [r[0] for r in df.select(tx.format_bytes("b")).collect()] == [
        "0.0 B", "1023.0 B", "1.0 KB", "1.2 KB", "1.5 KB", "1.0 MB", "5.0 GB", "3.0 TB"
    ]


def test_emails(spark):
    good, bad = ["a.b+c@d-e.org"], ["a@b", "a b@c.de", "@c.de", "", None]
    assert all(one(spark, g, tx.valid_email) for g in good)
    assert not any(one(spark, b, tx.valid_email) for b in bad)


def test_document_words_match_inside_names(spark):
    assert one(spark, "Contract.pdf", tx.document_type) == "imaging"  # "ct" is found inside the word
    assert one(spark, "Blood_CT.pdf", tx.document_type) == "lab_report"
    assert one(spark, "notes.pdf", tx.document_type) == "other"


def test_bmi_guards(spark):
    df = spark.createDataFrame([(70.0, 175.0), (0.0, 175.0), (70.0, None), (45.0, 200.0)], "w double, h double")
    assert [r[0] for r in df.select(tx.bmi("w", "h")).collect()] == [22.9, None, None, 11.2]


def test_pairing_is_reversible(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "open"), (2, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pairs = cv.pair_turns(df)
    assert [tuple(r) for r in pairs.collect()] == [(1, 0, "q", "a")]
    assert sorted(map(tuple, cv.unpair_turns(pairs).collect())) == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]


def test_unreadable_router_replies_take_the_fallback(spark):
    import pandas as pd

    from vitalframe.operators import context as ctx

    replies = {
        "a": '```json\n{"domain": "MENTAL_HEALTH", "urgency": "URGENT", "confidence": 0.9}\n```', "b": "no idea", "c": None, "d": "", "e": '{"urgency": "URGENT"}',
        "f": '{"domain": "OTHER", "scope_violation": true}', "g": '{"domain": "SKIN", "confidence": "high"}', "h": '[1, 2]',
    }

    def scorer(prompts):
        return pd.Series([replies[p.split("Message: ")[1][0]] for p in prompts], dtype=object)

    messages = spark.createDataFrame([(k, "u", k) for k in replies], "conversation_id string, user_id string, user_message string")
    profiles = spark.createDataFrame([], "user_id string, has_diabetes boolean, has_hypertension boolean, has_heart_disease boolean, has_mental_health_history boolean")
    rows = {r.conversation_id: r for r in ctx.classify_messages(messages, "user_message", profiles, scorer).collect()}
    assert {k for k, r in rows.items() if r.classification_status == "error"} == {"b", "c", "d", "e", "h"}
    assert all((rows[k].domain, rows[k].urgency, rows[k].confidence) == ("DIABETES", "ROUTINE", 0.5) for k in "bcdeh")
    assert (rows["a"].domain, rows["a"].confidence, rows["a"].specialist_model) == ("MENTAL_HEALTH", 0.9, "mental_health_llm")
    assert rows["f"].specialist_model is None and rows["g"].specialist_model == ctx.GENERAL_MODEL and rows["g"].confidence is None
