"""Silver tables: normalise, validate, de-duplicate.

Every table is the same three steps over its own column map: keep valid bronze rows, project to
the canonical schema, keep one row per business key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.operators.cleaning import dedupe, filter_valid, normal, parse_ts, to_flag, trimmed

# Accepted ranges of the bronze columns. (None, None) asks for presence only.
DIABETES_RANGES = {
    "GENDER": (None, None),
    "AGE": (10, 120),
    "BMI": (10, 100),
    "HBA1C_LEVEL": (0, 20),
    "BLOOD_GLUCOSE_LEVEL": (0, None),
}
BLOOD_PRESSURE_RANGES = {
    "COUNTRY": (None, None),
    "AGE": (18, 120),
    "BMI": (10, 100),
    "SYSTOLIC_BP": (60, 250),
    "DIASTOLIC_BP": (40, 150),
    "CHOLESTEROL": (100, 400),
}
MENTAL_PRESENT = {
    "TIMESTAMP_TXT": (None, None),
    "GENDER": (None, None),
    "COUNTRY": (None, None),
    "SELF_EMPLOYED": (None, None),
    "FAMILY_HISTORY": (None, None),
    "TREATMENT": (None, None),
    "COPING_STRUGGLES": (None, None),
}
MATERNAL_RANGES = {
    "AGE": (15, 60),
    "SYSTOLICBP": (70, 200),
    "DIASTOLICBP": (40, 130),
    "BS": (4, 25),
    "BODYTEMP": (95, 105),
    "HEARTRATE": (50, 120),
    "RISKLEVEL": (None, None),
}
PCOS_RANGES = {
    "AGE": (12, 60),
    "ANTI_MULLERIAN_HORMONE": (0, 50),
    "LUTEINIZING_HORMONE": (0, 100),
    "FOLLICLE_STIMULATING_HORMONE": (0, 50),
    "TOTAL_TESTOSTERONE": (0, 1000),
    "BODY_MASS_INDEX": (10, 100),
    "MENSTRUAL_CYCLE": (None, None),
}
INFERTILITY_RANGES = {
    "PATIENT_FILE_NO": (None, None),
    "I_BETA_HCG": (0, 100000),
    "II_BETA_HCG": (0, 100000),
    "AMH": (0, 50),
    "PCOS": (None, None),
}

# Business keys where they are fewer than the table's columns.
BLOOD_PRESSURE_KEY = (
    "country", "gender", "age", "bmi", "cholesterol", "systolic_bp", "diastolic_bp",
    "smoking_status", "physical_activity_level", "hypertension_status",
)
PCOS_KEY = (
    "age", "amh_level", "lh_level", "fsh_level", "testosterone_level", "bmi", "menstrual_cycle_pattern",
)


# Makes one row per business key of the valid rows.
Unique = Callable[[DataFrame, Sequence[str]], DataFrame]


def _silver(
    bronze: DataFrame, ranges: dict, columns: dict[str, Column], key: Sequence[str] | None = None, unique: Unique = dedupe
) -> DataFrame:
    clean = filter_valid(bronze, ranges).select(*[c.alias(name) for name, c in columns.items()])
    return unique(clean, list(key or columns))


def _same(*names: str) -> dict[str, Column]:
    return {n.lower(): F.col(n) for n in names}


def stg_diabetes(bronze: DataFrame, unique: Unique = dedupe) -> DataFrame:
    return _silver(
        bronze,
        DIABETES_RANGES,
        {
            "gender": normal("GENDER"),
            **_same("AGE"),
            "has_hypertension": to_flag("HYPERTENSION", 1),
            "has_heart_disease": to_flag("HEART_DISEASE", 1),
            "smoking_history": normal("SMOKING_HISTORY"),
            **_same("BMI", "HBA1C_LEVEL", "BLOOD_GLUCOSE_LEVEL"),
            "has_diabetes": to_flag("DIABETES", 1),
        },
        unique=unique,
    )


def stg_blood_pressure(bronze: DataFrame, unique: Unique = dedupe) -> DataFrame:
    return _silver(
        bronze,
        BLOOD_PRESSURE_RANGES,
        {
            "country": trimmed("COUNTRY"),
            "gender": normal("GENDER"),
            **_same("AGE"),
            "education_level": normal("EDUCATION_LEVEL"),
            "employment_status": normal("EMPLOYMENT_STATUS"),
            **_same("BMI", "CHOLESTEROL", "SYSTOLIC_BP", "DIASTOLIC_BP", "HEART_RATE"),
            **_same("LDL", "HDL", "TRIGLYCERIDES", "GLUCOSE"),
            "smoking_status": normal("SMOKING_STATUS"),
            "physical_activity_level": normal("PHYSICAL_ACTIVITY_LEVEL"),
            **_same("ALCOHOL_INTAKE", "SALT_INTAKE", "SLEEP_DURATION", "STRESS_LEVEL"),
            "has_family_history": to_flag("FAMILY_HISTORY", True),
            "has_diabetes": to_flag("DIABETES", True),
            "hypertension_status": trimmed("HYPERTENSION"),
        },
        BLOOD_PRESSURE_KEY,
        unique,
    )


def stg_mental_health(bronze: DataFrame) -> DataFrame:
    text = (
        "DAYS_INDOORS", "GROWING_STRESS", "CHANGES_HABITS", "MENTAL_HEALTH_HISTORY", "MOOD_SWINGS",
        "WORK_INTEREST", "SOCIAL_WEAKNESS", "MENTAL_HEALTH_INTERVIEW", "CARE_OPTIONS",
    )
    return _silver(
        bronze,
        MENTAL_PRESENT,
        {
            "survey_timestamp": parse_ts("TIMESTAMP_TXT"),
            "gender": normal("GENDER"),
            "country": trimmed("COUNTRY"),
            "occupation": trimmed("OCCUPATION"),
            "is_self_employed": F.col("SELF_EMPLOYED"),
            "has_family_history": F.col("FAMILY_HISTORY"),
            "receiving_treatment": F.col("TREATMENT"),
            "has_coping_struggles": F.col("COPING_STRUGGLES"),
            **{c.lower(): trimmed(c) for c in text},
        },
    )


def stg_maternal(bronze: DataFrame) -> DataFrame:
    return _silver(
        bronze,
        MATERNAL_RANGES,
        {
            **_same("AGE"),
            "systolic_bp": F.col("SYSTOLICBP"),
            "diastolic_bp": F.col("DIASTOLICBP"),
            "blood_sugar": F.col("BS"),
            "body_temperature": F.col("BODYTEMP"),
            "heart_rate": F.col("HEARTRATE"),
            "risk_level": normal("RISKLEVEL"),
        },
    )


def stg_pcos(bronze: DataFrame) -> DataFrame:
    return _silver(
        bronze,
        PCOS_RANGES,
        {
            **_same("AGE"),
            "amh_level": F.col("ANTI_MULLERIAN_HORMONE"),
            "lh_level": F.col("LUTEINIZING_HORMONE"),
            "fsh_level": F.col("FOLLICLE_STIMULATING_HORMONE"),
            "testosterone_level": F.col("TOTAL_TESTOSTERONE"),
            "bmi": F.col("BODY_MASS_INDEX"),
            "has_family_history": to_flag("FAMILY_HISTORY", True),
            "menstrual_cycle_pattern": normal("MENSTRUAL_CYCLE"),
        },
        PCOS_KEY,
    )


def stg_pcos_infertility(bronze: DataFrame) -> DataFrame:
    return _silver(
        bronze,
        INFERTILITY_RANGES,
        {
            "patient_id": F.col("PATIENT_FILE_NO"),
            "has_pcos": to_flag("PCOS", 1),
            "beta_hcg_first_measurement": F.col("I_BETA_HCG"),
            "beta_hcg_second_measurement": F.col("II_BETA_HCG"),
            "amh_level": F.col("AMH"),
        },
    )


SILVER = {
    "diabetes": ("raw_diabetes", stg_diabetes),
    "hypertension": ("raw_bloodpressure", stg_blood_pressure),
    "mental_health": ("raw_mentalhealth", stg_mental_health),
    "maternal": ("raw_maternalhealth", stg_maternal),
    "pcos": ("raw_pcos", stg_pcos),
    "pcos_infertility": ("raw_pcos_infertility", stg_pcos_infertility),
}
