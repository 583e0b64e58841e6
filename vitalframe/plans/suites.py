"""Column test suites of the gold tables.

Derived columns are tested by rule: every derived column must be present, booleans and small
counts take their natural values, and categorical columns take the labels listed here or in the
rule tables.  The exceptions are named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vitalframe.plans import diabetes as dm
from vitalframe.plans import hypertension as htn
from vitalframe.plans import maternal as mat
from vitalframe.plans import mental as mh
from vitalframe.plans import pcos


def _labels(table, *more: str) -> list[str]:
    names = list(table) if isinstance(table, dict) else [label for label, _ in table]
    return [*names, *more]


def _words(text: str) -> list[str]:
    return text.split()


def _values(table: dict, *more: str) -> list[str]:
    return [*dict.fromkeys(table.values()), *more]


# Labels of the categorical columns that are not written as rule tables.
DIABETES_LABELS = {
    "diabetes_stage": _labels(dm.HBA1C_STAGES, "unknown"),
    "glucose_control_status": _labels(dm.GLUCOSE_CONTROL, "unknown"),
    "bmi_category": _labels(dm.BMI_CLASSES, "unknown"),
    "smoking_status_clean": _labels(dm.SMOKING_WORDS, "no_info"),
    "glucose_urgency_level": _words("emergency urgent needs_attention routine"),
    "hyperglycemia_urgency": _labels(dm.HIGH_GLUCOSE, "stable"),
    "hypoglycemia_urgency": _labels(dm.LOW_GLUCOSE, "no_hypoglycemia"),
    "weight_management_priority": _words("critical high moderate low maintenance"),
    "smoking_cessation_priority": _words("critical high moderate relapse_prevention not_applicable"),
    "age_risk_category": _labels(dm.ONSET_AGES),
}
HYPERTENSION_LABELS = {
    "bp_stage": _labels(htn.STAGE_POINTS, "unknown"),
    "systolic_category": _labels(htn.SYSTOLIC_BANDS, "unknown"),
    "diastolic_category": _labels(htn.DIASTOLIC_BANDS, "unknown"),
    "pulse_pressure_category": _labels(htn.PULSE_BANDS, "unknown"),
    "map_category": _labels(htn.MAP_BANDS, "unknown"),
    "heart_rate_category": _labels(htn.HEART_RATE_BANDS, "unknown"),
    "cholesterol_category": _labels(htn.CHOLESTEROL_BANDS, "unknown"),
    "ldl_category": _labels(htn.LDL_BANDS, "unknown"),
    "hdl_category": _labels(htn.HDL_BANDS, "unknown"),
    "triglycerides_category": _labels(htn.TRIGLYCERIDE_BANDS, "unknown"),
    "cholesterol_ratio_risk": _labels(htn.RATIO_BANDS, "unknown"),
    "glucose_status": _labels(htn.GLUCOSE_BANDS, "unknown"),
    "smoking_status_clean": _labels(htn.SMOKING_WORDS, "unknown"),
    "activity_level_clean": _labels(htn.ACTIVITY_WORDS, "unknown"),
    "alcohol_risk_level": _labels(htn.ALCOHOL_BANDS, "unknown"),
    "salt_intake_risk": _labels(htn.SALT_BANDS, "unknown"),
    "sleep_adequacy": _labels(htn.SLEEP_BANDS, "unknown"),
    "stress_category": _labels(htn.STRESS_BANDS, "unknown"),
    "bp_urgency_level": _labels(htn.TONES, "routine"),
    "ten_year_cv_risk_category": _labels(htn.TEN_YEAR_BANDS),
    "dietary_modification_priority": _words("critical high moderate preventive maintenance"),
    "exercise_priority": _words("high moderate preventive maintenance"),
    "weight_loss_priority": _words("critical high moderate maintenance"),
    "smoking_cessation_priority_htn": _words("critical high moderate relapse_prevention not_applicable"),
    "alcohol_reduction_priority": _words("high moderate maintenance"),
    "stress_management_priority": _words("high moderate low"),
    "medication_urgency": _words("immediate urgent prompt consider lifestyle_first"),
    "kidney_damage_risk": _words("high_nephropathy_risk moderate_nephropathy_risk low_risk"),
    "age_bp_risk_category": _words(
        "young_onset_critical midlife_high_risk elderly_high_risk isolated_systolic_elderly standard_management"
    ),
    "communication_tone": _values(htn.TONES, "supportive_maintenance"),
}
MENTAL_LABELS = {
    "age_category": _labels(mh.AGE_BANDS, "unknown"),
    "mental_health_history_clean": _labels(mh.HISTORY_WORDS, "unknown"),
    "genetic_history_risk": _words("high_genetic_risk moderate_risk possible_risk low_risk"),
    "mood_swing_severity": _labels(mh.MOOD_WORDS, "none_reported"),
    "stress_level": _labels(mh.STRESS_WORDS, "unknown"),
    "social_functioning_status": _labels(mh.SOCIAL_WORDS, "unknown"),
    "work_motivation_status": _labels(mh.WORK_WORDS, "unknown"),
    "behavioral_change_status": _labels(mh.HABIT_WORDS, "unknown"),
    "social_isolation_level": _labels(mh.ISOLATION_WORDS, "unknown"),
    "care_awareness_status": _labels(mh.CARE_WORDS, "unknown"),
    "occupation_category": _labels(mh.OCCUPATION_WORDS, "unknown"),
    "employment_status": _words("self_employed student homemaker employed"),
    "mental_health_disclosure_comfort": _labels(mh.COMFORT_WORDS, "unknown"),
    "gender_clean": _labels(mh.GENDER_WORDS, "other"),
    "depression_severity": _labels(mh.DEPRESSION_BANDS),
    "anxiety_severity": _labels(mh.ANXIETY_BANDS),
    "mental_health_urgency_level": _labels(mh.TONES, "monitoring"),
    "functional_impairment_category": _labels(mh.IMPAIRMENT_BANDS),
    "therapy_priority": _words("high_priority moderate_priority low_priority preventive"),
    "medication_evaluation_priority": _words(
        "psychiatric_evaluation_urgent psychiatric_evaluation_needed consider_evaluation not_indicated"
    ),
    "communication_tone": _values(mh.TONES, "positive_preventive"),
    "recommended_followup_timeframe": _values(mh.FOLLOW_UPS, "as_needed"),
    "treatment_plan_complexity": _labels(mh.COMPLEXITY_BANDS, "basic_self_help"),
    "monitoring_intensity_needed": _words(
        "intensive_monitoring frequent_monitoring regular_monitoring periodic_monitoring self_monitoring"
    ),
    "conversation_starting_point": _words(
        "safety_assessment crisis_intervention treatment_review history_exploration symptom_screening"
    ),
    "primary_clinical_concern": _words(
        "immediate_safety severe_depression severe_anxiety comorbid_conditions functional_decline "
        "treatment_discontinuation social_withdrawal symptom_management"
    ),
}
MATERNAL_LABELS = {
    "maternal_age_category": _labels(mat.AGE_BANDS, "unknown"),
    "pregnancy_bp_stage": _words(
        "normal elevated_monitor gestational_htn_stage1 severe_htn_preeclampsia_risk unknown"
    ),
    "systolic_category_pregnancy": _labels(mat.SYSTOLIC_BANDS, "unknown"),
    "diastolic_category_pregnancy": _labels(mat.DIASTOLIC_BANDS, "unknown"),
    "map_risk_category": _labels(mat.MAP_BANDS, "unknown"),
    "heart_rate_category_pregnancy": _labels(mat.HEART_RATE_BANDS, "unknown"),
    "blood_sugar_category": _labels(mat.SUGAR_BANDS, "unknown"),
    "hyperglycemia_severity": _labels(mat.HYPERGLYCEMIA_BANDS, "unknown"),
    "temperature_category": _labels(mat.TEMPERATURE_BANDS, "unknown"),
    "risk_level_clean": _labels(mat.RISK_WORDS, "unknown"),
    "preeclampsia_risk_category": _labels(mat.PREECLAMPSIA_BANDS),
    "gestational_diabetes_risk_category": _labels(mat.GDM_BANDS),
    "maternal_emergency_type": _words(
        "hypertensive_emergency high_fever_emergency hyperglycemic_emergency severe_tachycardia_emergency no_emergency"
    ),
    "maternal_urgency_level": _labels(mat.TONES, "routine"),
    "fetal_risk_category": _words("high_fetal_risk moderate_fetal_risk standard_monitoring"),
    "bp_monitoring_frequency": _words("continuous_hospital twice_daily_home daily_home routine_prenatal"),
    "glucose_monitoring_frequency": _labels(mat.MONITORING_SUGAR, "routine_screening"),
    "hospitalization_recommendation": _words(
        "immediate_hospitalization consider_admission observation_needed outpatient_management"
    ),
    "delivery_timing_consideration": _words(
        "expedited_delivery_consideration early_delivery_planning routine_delivery_planning"
    ),
    "communication_tone": _values(mat.TONES, "reassuring_educational"),
    "recommended_followup_timeframe": _values(mat.FOLLOW_UPS, "routine_prenatal_schedule"),
    "monitoring_intensity_needed": _words(
        "continuous_inpatient intensive_outpatient frequent_monitoring increased_monitoring routine_prenatal"
    ),
    "conversation_starting_point": _words(
        "emergency_assessment preeclampsia_screening infection_assessment risk_assessment routine_check_in"
    ),
    "primary_clinical_concern": _words(
        "severe_hypertension_preeclampsia maternal_fever_sepsis_risk severe_hyperglycemia preeclampsia_high_risk "
        "gestational_diabetes_management gestational_hypertension multiple_abnormalities "
        "advanced_maternal_age_monitoring routine_prenatal_care"
    ),
    "overall_risk_stratification": _labels(mat.STRATA, "low_risk"),
}
PCOS_LABELS = {
    "reproductive_age_category": _labels(pcos.AGE_BANDS, "unknown"),
    "lh_level_category": _labels(pcos.LH_BANDS, "unknown"),
    "fsh_level_category": _labels(pcos.FSH_BANDS, "unknown"),
    "lh_fsh_ratio_category": _labels(pcos.RATIO_BANDS, "unknown"),
    "amh_level_category": _labels(pcos.AMH_BANDS, "unknown"),
    "ovarian_reserve_status": _labels(pcos.RESERVE_BANDS, "unknown"),
    "testosterone_category": _labels(pcos.TESTOSTERONE_BANDS, "unknown"),
    "hyperandrogenism_severity": _labels(pcos.ANDROGEN_BANDS, "unknown"),
    "bmi_category": _labels(dm.BMI_CLASSES, "unknown"),
    "menstrual_pattern_clean": _labels(pcos.CYCLE_WORDS, "unknown"),
    "pcos_phenotype": _words(
        "phenotype_a_classic phenotype_b_anovulatory_hyperandrogenic phenotype_c_ovulatory_hyperandrogenic "
        "phenotype_d_mild_pcos no_pcos_phenotype"
    ),
    "pcos_severity_category": _labels(pcos.SEVERITY_BANDS),
    "metabolic_risk_category": _labels(pcos.METABOLIC_BANDS),
    "fertility_risk_category": _labels(pcos.FERTILITY_BANDS),
    "type2_diabetes_risk": _words("very_high_risk high_risk moderate_risk average_risk"),
    "cardiovascular_risk_category": _words("very_high_risk high_risk moderate_risk average_risk"),
    "endometrial_cancer_risk": _words("elevated_risk moderate_risk average_risk"),
    "pcos_urgency_level": _labels(pcos.TONES, "routine_monitoring", "screening_recommended", "routine"),
    "weight_management_priority": _words("critical_priority high_priority moderate_priority recommended not_indicated"),
    "hormonal_treatment_indication": _words("likely_needs_treatment consider_treatment not_indicated"),
    "fertility_treatment_priority": _words(
        "high_priority_referral consider_fertility_specialist fertility_counseling_recommended "
        "routine_fertility_education"
    ),
    "communication_tone": _values(pcos.TONES, "reassuring_informative"),
    "recommended_followup_timeframe": _values(pcos.FOLLOW_UPS, "routine_annual"),
    "monitoring_intensity_needed": _words(
        "intensive_monitoring frequent_monitoring regular_monitoring periodic_monitoring routine_screening"
    ),
    "conversation_starting_point": _words(
        "pcos_diagnosis_discussion symptom_assessment risk_screening hormonal_health_checkup"
    ),
    "primary_clinical_concern": _words(
        "severe_hyperandrogenism severe_pcos_symptoms pcos_with_fertility_concerns pcos_metabolic_complications "
        "confirmed_pcos_management possible_pcos_screening menstrual_irregularity hyperandrogenic_symptoms "
        "hormonal_wellness_checkup"
    ),
    "overall_complexity_level": _words(
        "very_high_complexity high_complexity moderate_complexity low_moderate_complexity low_complexity"
    ),
}


@dataclass(frozen=True)
class Suite:
    labels: dict[str, list[str]]
    counts: dict[str, int]  # column -> largest value; the smallest is 0
    untested: tuple[str, ...] = ()
    may_be_null: tuple[str, ...] = ()


# Small counts with their largest value, and the columns without tests.
SUITES = {
    "diabetes": Suite(
        DIABETES_LABELS,
        {"cardiometabolic_disease_count": 3},
        ("glucose_hba1c_concordance", "is_severely_obese", "has_triple_diagnosis", "has_smoking_history"),
    ),
    "hypertension": Suite(
        HYPERTENSION_LABELS,
        {"metabolic_syndrome_criteria_count": 5},
        ("bmi_category", "is_obese", "has_hypertension_diagnosis"),
    ),
    "mental_health": Suite(
        MENTAL_LABELS,
        {"isolation_severity_score": 4, "case_complexity_score": 5},
        ("calculated_age",),
        ("isolation_severity_score",),
    ),
    "maternal": Suite(
        MATERNAL_LABELS,
        {"abnormal_vitals_count": 5},
        (
            "should_ask_blurred_vision_diabetes", "should_ask_urinary_symptoms", "should_ask_vaginal_symptoms",
            "should_ask_exposure_history", "should_ask_current_complications", "should_ask_multiple_pregnancy",
            "should_ask_prenatal_vitamins", "should_ask_supplements", "should_ask_sleep_quality",
            "should_ask_work_activity", "should_ask_prenatal_visits", "should_ask_specialist_care",
        ),
    ),
    "pcos": Suite(
        PCOS_LABELS,
        {"rotterdam_criteria_count": 3, "hormonal_abnormality_count": 4},
        (),
        ("lh_fsh_ratio",),
    ),
}


def suite_for(gold: DataFrame, silver: DataFrame, domain: str) -> tuple[list[str], dict[str, list]]:
    """Columns that must be present and the accepted values per column of a gold table."""
    suite = SUITES[domain]
    source = set(silver.columns)
    tested = [f for f in gold.schema.fields if f.name not in source and f.name not in suite.untested]
    not_null = [f.name for f in tested if f.name not in suite.may_be_null]
    accepted: dict[str, list] = {}
    for field in tested:
        if field.name in suite.labels:
            accepted[field.name] = suite.labels[field.name]
        elif field.name in suite.counts:
            accepted[field.name] = list(range(suite.counts[field.name] + 1))
        elif isinstance(field.dataType, T.BooleanType):
            accepted[field.name] = [True, False]
    return not_null, accepted
