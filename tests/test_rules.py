"""Boundary rows of the rule tables and the published quirks that are kept on purpose."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from vitalframe.functions import rules as r
from vitalframe.plans import diabetes as dm
from vitalframe.plans import hypertension as htn
from vitalframe.plans import maternal as mat
from vitalframe.plans import mental as mh
from vitalframe.plans import pcos


def labels(spark, values, table, default="unknown"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    return [row[0] for row in df.orderBy("i").select(r.band("x", table, default)).collect()]


CASES = [
    (dm.HBA1C_STAGES, [5.69, 5.7, 6.4, 6.45, 6.5, 7.9, 7.95, 8.0, 9.9, 9.95, 10.0, None],
     ["normal", "prediabetes", "prediabetes", "unknown", "diabetes_controlled", "diabetes_controlled", "unknown",
      "diabetes_uncontrolled", "diabetes_uncontrolled", "unknown", "diabetes_severe", "unknown"]),
    (dm.BMI_CLASSES, [18.49, 18.5, 24.9, 24.95, 25.0, 29.9, 29.95, 30.0, 34.95, 35.0, 39.95, 40.0, None],
     ["underweight", "normal", "normal", "unknown", "overweight", "overweight", "unknown", "obese_class1", "unknown",
      "obese_class2", "unknown", "obese_class3_severe", "unknown"]),
    (dm.GLUCOSE_CONTROL, [99.99, 100, 125, 125.5, 126, 180, 180.5, 181, 250, 250.01, None],
     ["normal", "prediabetes_range", "prediabetes_range", "unknown", "diabetes_mild", "diabetes_mild", "unknown",
      "diabetes_moderate", "diabetes_moderate", "diabetes_severe", "unknown"]),
    (htn.SYSTOLIC_BANDS, [119, 120, 129, 130, 139, 140, 159, 160, 179, 180, None],
     ["normal", "elevated", "elevated", "stage1", "stage1", "stage2_moderate", "stage2_moderate", "stage2_severe",
      "stage2_severe", "crisis", "unknown"]),
    (htn.DIASTOLIC_BANDS, [79, 80, 89, 90, 99, 100, 119, 120, None],
     ["normal", "stage1", "stage1", "stage2_moderate", "stage2_moderate", "stage2_severe", "stage2_severe", "crisis", "unknown"]),
    (htn.STRESS_BANDS, [3, 3.5, 4, 6, 7, 8, 9, None],
     ["low", "unknown", "moderate", "moderate", "high", "high", "very_high", "unknown"]),
    (htn.MAP_BANDS, [92.99, 93, 106, 106.01, None], ["normal", "elevated", "elevated", "high", "unknown"]),
    (mat.TEMPERATURE_BANDS, [96.99, 97, 99.5, 99.55, 99.6, 100.3, 100.35, 100.4, 102.9, 102.95, 103, None],
     ["hypothermia", "normal", "normal", "unknown", "low_grade_fever", "low_grade_fever", "unknown", "fever", "fever",
      "unknown", "high_fever", "unknown"]),
    (mat.AGE_BANDS, [17, 18, 19, 20, 34, 35, 39, 40, None],
     ["adolescent_high_risk", "teenage_pregnancy", "teenage_pregnancy", "optimal_reproductive_age",
      "optimal_reproductive_age", "advanced_maternal_age", "advanced_maternal_age", "very_advanced_maternal_age", "unknown"]),
    (pcos.LH_BANDS, [1.89, 1.9, 12.5, 12.55, 12.6, 20, 20.01, None],
     ["low", "normal", "normal", "unknown", "elevated_mild", "elevated_mild", "elevated_high", "unknown"]),
    (pcos.RATIO_BANDS, [0.99, 1, 1.9, 1.95, 2, 2.9, 2.95, 3, None],
     ["low_ratio", "normal_ratio", "normal_ratio", "unknown", "elevated_pcos_suggestive", "elevated_pcos_suggestive",
      "unknown", "very_elevated_pcos_likely", "unknown"]),
    (pcos.ANDROGEN_BANDS, [70, 70.5, 71, 100, 100.5, 101, 150, 150.01, None],
     ["no_hyperandrogenism", "unknown", "mild_hyperandrogenism", "mild_hyperandrogenism", "unknown",
      "moderate_hyperandrogenism", "moderate_hyperandrogenism", "severe_hyperandrogenism", "unknown"]),
]


@pytest.mark.parametrize("table,values,expected", CASES, ids=[c[0][0][0] + str(i) for i, c in enumerate(CASES)])
def test_band_boundaries(spark, table, values, expected):
    assert labels(spark, [None if v is None else float(v) for v in values], table) == expected


def test_every_cut_is_covered(spark):
    """Below, at and above each cut exactly one label or the default applies."""
    for table in (dm.HBA1C_STAGES, htn.LDL_BANDS, mat.HYPERGLYCEMIA_BANDS, pcos.AMH_BANDS, mh.DEPRESSION_BANDS):
        names = {label for label, _ in table} | {"unknown"}
        assert set(labels(spark, [x / 4 for x in range(0, 1200)], table)) <= names


def bp(spark, rows):
    silver = spark.createDataFrame(
        [(s, d, a, c, h) for s, d, a, c, h in rows], "systolic_bp long, diastolic_bp long, age long, cholesterol long, hdl long"
    )
    fixed = dict(
        country="c", gender="f", bmi=22.0, heart_rate=70, ldl=90, triglycerides=100, glucose=90, smoking_status="never",
        physical_activity_level="low", alcohol_intake=1.0, salt_intake=1.0, sleep_duration=7.0, stress_level=1,
        has_family_history=False, has_diabetes=False, hypertension_status=None,
    )
    silver = silver.withColumns({k: F.lit(v) for k, v in fixed.items()})
    silver = silver.withColumn("hypertension_status", F.lit(None).cast("string"))
    return htn.hypertension_prompts(htn.hypertension_risk(htn.hypertension_core(silver)))


def test_pressure_stage_order(spark):
    rows = bp(spark, [(165, 85, 50, 180, 50), (185, 125, 50, 180, 50), (118, 79, 50, 180, 50), (125, 79, 50, 180, 50)]).collect()
    assert rows[0].bp_stage == "stage1_hypertension"  # the diastolic band decides first
    assert rows[0].bp_urgency_level == "severe_urgency"
    assert rows[1].bp_stage == "stage2_hypertension"  # the crisis label is out of reach
    assert rows[1].potential_hypertensive_emergency and rows[1].bp_urgency_level == "hypertensive_crisis_emergency"
    assert [rows[2].bp_stage, rows[3].bp_stage] == ["normal", "elevated"]


def test_unknown_inputs_leave_score_null(spark):
    rows = bp(spark, [(118, 79, None, 180, 50), (118, 79, 50, None, 50), (118, 79, 50, 180, None), (118, 79, 50, 180, 0)]).collect()
    assert rows[0].cardiovascular_risk_score is None and rows[0].ten_year_cv_risk_category is None
    assert rows[1].cardiovascular_risk_score is None
    assert rows[2].cardiovascular_risk_score == 2 and rows[2].cholesterol_hdl_ratio is None
    assert rows[3].cholesterol_hdl_ratio is None and rows[3].cholesterol_ratio_risk == "unknown"
    assert rows[0].has_hypertension_diagnosis is None and rows[0].should_ask_medication_sideeffects is False


def test_flags_are_two_valued(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "b boolean")
    assert [x[0] for x in df.select(r.flag(F.col("b"))).collect()] == [False, True, False]


def test_not_in_with_null_is_false(spark):
    df = spark.createDataFrame([(None, 80.0, 20.0, 5.0)], "smoking_history string, blood_glucose_level double, bmi double, hba1c_level double")
    df = df.withColumns({c: F.lit(False) for c in ("has_diabetes", "has_hypertension", "has_heart_disease")})
    row = dm.diabetes_core(df).first()
    assert row.has_smoking_history is False and row.smoking_status_clean == "no_info"


def test_fertility_age_second_step_is_dead(spark):
    df = spark.createDataFrame([(36.0,), (45.0,), (30.0,)], "a double")
    assert [x[0] for x in df.select(r.steps("a", pcos.FERTILITY_AGE_POINTS)).collect()] == [2, 2, 0]


def test_age_in_completed_years(spark):
    day = dt.date(2024, 2, 29)
    born = [dt.date(2000, 2, 29), dt.date(2000, 3, 1), dt.date(2023, 12, 31), None]
    df = spark.createDataFrame([(b,) for b in born], "b date")
    assert [x[0] for x in df.select(r.age_years("b", day)).collect()] == [24, 23, 0, None]


def test_topics_default_and_order(spark):
    df = spark.createDataFrame([(True, True), (False, None)], "a boolean, b boolean")
    out = df.select(r.topics([("x", F.col("a")), ("y", F.col("b"))], "none").alias("t"), r.topics([("x", F.col("a"))]).alias("u")).collect()
    assert [tuple(o) for o in out] == [("x, y", "x"), ("none", "")]


def test_no_reserved_names():
    """Rule labels are plain words, so they can be compared as text."""
    for table in (dm.HBA1C_STAGES, htn.SYSTOLIC_BANDS, mat.SYSTOLIC_BANDS, pcos.AMH_BANDS):
        assert all(re.fullmatch(r"[a-z0-9_]+", label) for label, _ in table)
