"""Training text: feature selection, prompt and response builders, prompt/completion rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.rules import band_half_open, first_match, lookup, one_of
from vitalframe.functions.text import fill, said_if
from vitalframe.operators.cleaning import stamp
from vitalframe.operators.ranking import distinct_surrogate_id, surrogate_id, surrogate_id_by_time
from vitalframe.operators.silver import SILVER
from vitalframe.plans import prompt_texts as txt

# BMI classes of the training text; unlike the gold table these bands have no gaps.
BMI_CUTS = (18.5, 25, 30, 35, 40)
BMI_LABELS = ("Underweight", "Normal", "Overweight", "Obese Class I", "Obese Class II", "Obese Class III")

# Silver columns that identify a row.
IDENTITY = {
    "diabetes": (
        "gender", "age", "has_hypertension", "has_heart_disease", "smoking_history", "bmi", "hba1c_level",
        "blood_glucose_level", "has_diabetes",
    ),
    "hypertension": (
        "country", "gender", "age", "bmi", "cholesterol", "systolic_bp", "diastolic_bp", "smoking_status",
        "physical_activity_level", "hypertension_status",
    ),
    "mental_health": (
        "gender", "country", "occupation", "is_self_employed", "has_family_history", "receiving_treatment",
        "has_coping_struggles", "days_indoors", "growing_stress", "changes_habits", "mental_health_history",
        "mood_swings", "work_interest", "social_weakness", "mental_health_interview", "care_options",
    ),
}

# Feature columns of the training views, with new names where they change.
HYPERTENSION_COLUMNS = {
    "gender": "gender", "smoking_status_clean": "smoking_status", "is_current_smoker": "is_current_smoker",
    "is_obese": "is_obese", "is_sedentary": "is_sedentary", "systolic_bp": "systolic_bp",
    "diastolic_bp": "diastolic_bp", "systolic_category": "systolic_category",
    "diastolic_category": "diastolic_category", "pulse_pressure": "pulse_pressure",
    "pulse_pressure_category": "pulse_pressure_category", "hdl_category": "hdl_category",
    "ldl_category": "ldl_category", "triglycerides_category": "triglycerides_category",
    "has_diabetes": "has_diabetes", "ten_year_cv_risk_category": "ten_year_cv_risk_category",
    "metabolic_syndrome_criteria_count": "metabolic_syndrome_score",
    "stroke_risk_factors_count": "stroke_risk_factors_count",
    "potential_hypertensive_emergency": "potential_hypertensive_emergency", "medication_urgency": "medication_urgency",
    "physical_activity_level": "physical_activity_level", "sleep_duration": "sleep_duration",
    "sleep_adequacy": "sleep_adequacy", "stress_level": "stress_level", "stress_category": "stress_category",
    "salt_intake_risk": "salt_intake_risk", "should_ask_crisis_symptoms": "should_ask_crisis_symptoms",
    "should_ask_cardiovascular_symptoms": "should_ask_cardiovascular_symptoms",
    "should_ask_stroke_symptoms": "should_ask_stroke_symptoms",
    "should_ask_kidney_symptoms": "should_ask_kidney_symptoms",
    "should_ask_headache_vision": "should_ask_headache_vision",
    "should_ask_chest_symptoms": "should_ask_chest_symptoms", "should_ask_diet_sodium": "should_ask_diet_sodium",
    "should_ask_exercise_habits": "should_ask_exercise_habits", "should_ask_stress_sleep": "should_ask_stress_sleep",
    "should_ask_alcohol_use": "should_ask_alcohol_use",
    "should_ask_weight_management": "should_ask_weight_management",
    "should_ask_current_medications": "should_ask_current_medications",
    "should_ask_medication_adherence": "should_ask_medication_adherence",
    "needs_lipid_management_discussion": "needs_lipid_management",
    "needs_specialist_referral_flag": "needs_specialist_referral",
    "smoking_cessation_priority_htn": "smoking_cessation_priority",
    "weight_loss_priority": "weight_management_priority",
    "stress_management_priority": "stress_management_priority", "priority_education_topics": "education_topics",
}
HYPERTENSION_URGENT = ["urgent", "immediate", "high"]
HYPERTENSION_ROUTINE = ["routine", "monitor", "low"]
DIABETES_COLUMNS = {
    "gender": "gender", "is_current_smoker": "is_current_smoker", "is_obese": "is_obese",
    "diabetes_stage": "diabetes_stage", "hba1c_level": "hba1c_level",
    "glucose_control_status": "glucose_control_status", "glucose_hba1c_concordance": "glucose_hba1c_concordance",
    "has_diabetes": "has_diabetes", "cardiometabolic_disease_count": "cardiometabolic_disease_count",
    "has_triple_diagnosis": "has_triple_diagnosis", "has_multiple_conditions": "has_multiple_conditions",
    "has_heart_disease": "has_heart_disease", "has_hypertension": "has_hypertension",
    "cardiovascular_risk_score": "cardiovascular_risk_score",
    "diabetes_complication_risk_score": "diabetes_complication_risk_score",
    "metabolic_syndrome_score": "metabolic_syndrome_score", "has_premature_disease": "has_premature_disease",
    "glucose_urgency_level": "glucose_urgency_level", "hyperglycemia_urgency": "hyperglycemia_urgency",
    "hypoglycemia_urgency": "hypoglycemia_urgency", "should_ask_diabetic_symptoms": "should_ask_diabetic_symptoms",
    "should_ask_cardiovascular_symptoms": "should_ask_cardiovascular_symptoms",
    "should_ask_neuropathy_symptoms": "should_ask_neuropathy_symptoms",
    "should_ask_diet_habits": "should_ask_diet_habits",
    "should_ask_physical_activity": "should_ask_physical_activity",
    "should_ask_medication_adherence": "should_ask_medication_adherence",
    "needs_glucose_monitoring_discussion": "needs_glucose_monitoring",
    "needs_bp_monitoring_discussion": "needs_bp_monitoring",
    "needs_specialist_referral_flag": "needs_specialist_referral",
    "smoking_cessation_priority": "smoking_cessation_priority",
    "weight_management_priority": "weight_management_priority", "priority_education_topics": "education_topics",
}
# Gold columns the mental-health view leaves out.
MENTAL_LEFT_OUT = (
    "calculated_age", "mental_health_history_clean", "genetic_history_risk", "has_coping_difficulties",
    "employment_status", "mental_health_disclosure_comfort", "perceived_workplace_stigma",
    "should_ask_medication_sideeffects", "should_ask_scheduling_barriers",
)


def _pick(df: DataFrame, domain: str, columns: Mapping[str, str], **computed: Column) -> DataFrame:
    return df.select(
        "patient_id",
        F.lit(domain).alias("condition_type"),
        *[F.col(src).alias(dst) for src, dst in columns.items()],
        *[c.alias(name) for name, c in computed.items()],
    )


def _bmi_text() -> Column:
    return band_half_open("bmi", BMI_CUTS, BMI_LABELS, "Unknown")


# First letters of the ids.
PREFIX = {"hypertension": "HTN_", "diabetes": "DM_"}


def numbered_silver(bronze: DataFrame, domain: str) -> DataFrame:
    """The silver table with ``patient_id``; where ids go by digest, rows are made distinct and numbered in one shuffle."""
    build = SILVER[domain][1]
    if domain not in PREFIX:
        return number_rows(build(bronze), domain)
    return build(bronze, unique=partial(distinct_surrogate_id, prefix=PREFIX[domain], identity=IDENTITY[domain]))


def number_rows(df: DataFrame, domain: str) -> DataFrame:
    """Add ``patient_id`` to a silver or gold table.

    Ids depend on silver columns only.  Numbering the silver table shuffles its few columns; the
    feature tiers are row by row and come after it.  A table that has ids is returned as it is.
    """
    if "patient_id" in df.columns:
        return df
    if domain == "mental_health":
        return surrogate_id_by_time(df, "MH_", "survey_timestamp", IDENTITY[domain])
    return surrogate_id(df, PREFIX[domain], IDENTITY[domain])


def select_hypertension_features(gold: DataFrame) -> DataFrame:
    urgency = first_match(
        [
            ("emergency", F.col("potential_hypertensive_emergency")),
            ("urgent", F.col("medication_urgency").isin(HYPERTENSION_URGENT)),
            ("routine", F.col("medication_urgency").isin(HYPERTENSION_ROUTINE)),
        ],
        "needs_assessment",
    )
    return _pick(
        number_rows(gold, "hypertension"), "hypertension", HYPERTENSION_COLUMNS, bmi_category=_bmi_text(),
        clinical_urgency_level=urgency,
    )


def select_diabetes_features(gold: DataFrame) -> DataFrame:
    urgency = first_match(
        [(level, F.col("glucose_urgency_level") == level) for level in ("emergency", "urgent")], "routine"
    )
    return _pick(
        number_rows(gold, "diabetes"), "diabetes", DIABETES_COLUMNS, bmi_category=_bmi_text(),
        clinical_urgency_level=urgency,
    )


def mental_feature_columns(gold: DataFrame) -> dict[str, str]:
    """Every derived gold column but the few left out; the standard gender replaces the raw one."""
    silver = set(IDENTITY["mental_health"]) | {"survey_timestamp", "dbt_loaded_at", "patient_id"}
    keep = [c for c in gold.columns if c not in silver and c not in MENTAL_LEFT_OUT]
    renamed = {"gender_clean": "gender"}
    return {c: renamed.get(c, c) for c in keep} | {"survey_timestamp": "source_timestamp"}


def select_mental_features(gold: DataFrame) -> DataFrame:
    return _pick(number_rows(gold, "mental_health"), "mental_health", mental_feature_columns(gold))


def stamp_selection(view: DataFrame) -> DataFrame:
    return stamp(view, "feature_selection_timestamp")


# --- builders -----------------------------------------------------------------------------------
def _all_said(texts: Mapping[str, str]) -> Column:
    """The texts of the flags that hold, run together."""
    return F.concat(*[said_if(F.col(name), text) for name, text in texts.items()])


def _patient(*flags: str) -> Column:
    notes = {name: txt.PATIENT_NOTES[name] for name in flags}
    return F.concat(fill(txt.PATIENT), _all_said(notes), F.lit("."))


def _join(parts: list[str], separator: str) -> Column:
    """Columns with a separator between them; one NULL makes the result NULL."""
    pieces = [F.col(parts[0])]
    for name in parts[1:]:
        pieces += [F.lit(separator), F.col(name)]
    return F.concat(*pieces)


def _pairs(df: DataFrame, components: dict[str, Column], prompt: list[str], response: list[str], extra: list[str]):
    built = df.withColumns(components)
    shown = [c for c in components if c != "urgency_note"]
    return built.select(
        "patient_id",
        "condition_type",
        "clinical_urgency_level",
        _join(prompt, " ").alias("user_prompt"),
        _join(response, "\n\n").alias("assistant_response"),
        F.col("clinical_urgency_level").alias("ground_truth_urgency"),
        *shown,
        *extra,
    )


def diabetes_pairs(view: DataFrame) -> DataFrame:
    t = txt.DIABETES
    heart, pressure = F.col("has_heart_disease"), F.col("has_hypertension")
    severe = txt.DIABETES_SEVERE_WORDS
    history = F.concat(
        said_if(heart, "History of heart disease. "), said_if(pressure, "History of hypertension. ")
    )
    several = F.concat(
        F.lit(t["several"]), said_if(heart, "heart disease, "), said_if(pressure, "hypertension, "), F.lit("diabetes.")
    )
    components = {
        "patient_context": _patient("is_current_smoker", "is_obese"),
        "clinical_presentation": F.concat(
            fill(t["findings"]),
            F.when(F.col("glucose_hba1c_concordance") == "concordant", t["concordant"]).otherwise(t["discordant"]),
            said_if(F.col("has_diabetes"), t["confirmed"]),
        ),
        "comorbidities": first_match(
            [
                (t["no_comorbidity"], F.col("cardiometabolic_disease_count") == 0),
                (t["triple"], F.col("has_triple_diagnosis")),
                (several, F.col("has_multiple_conditions")),
            ],
            history,
        ),
        "urgency_note": first_match(
            [
                (fill(t["high_glucose"]), F.col("hyperglycemia_urgency").isin(severe)),
                (fill(t["low_glucose"]), F.col("hypoglycemia_urgency").isin(severe)),
                (t["glucose_urgent"], F.col("glucose_urgency_level") == "urgent"),
            ],
            t["glucose_routine"],
        ),
        "risk_assessment": F.concat(
            fill(t["risk"]), said_if(F.col("has_premature_disease"), t["premature"]), fill(t["urgency"])
        ),
        "symptom_inquiry": F.concat(F.lit(t["symptoms"]), _all_said(txt.DIABETES_SYMPTOMS)),
        "management_recommendations": F.concat(
            F.lit(t["management"]),
            _all_said(txt.DIABETES_MANAGEMENT),
            lookup("smoking_cessation_priority", txt.DIABETES_SMOKING, ""),
            lookup("weight_management_priority", txt.DIABETES_WEIGHT, ""),
        ),
        "education_guidance": F.concat(
            F.lit(t["education"]), F.coalesce("education_topics", F.lit(t["education_default"]))
        ),
        "triage_recommendation": lookup(
            "clinical_urgency_level", txt.DIABETES_TRIAGE, txt.DIABETES_TRIAGE_DEFAULT
        ),
    }
    return _pairs(
        view,
        components,
        ["patient_context", "clinical_presentation", "comorbidities", "urgency_note"],
        [
            "risk_assessment", "symptom_inquiry", "management_recommendations", "education_guidance",
            "triage_recommendation",
        ],
        [],
    )


def hypertension_pairs(view: DataFrame) -> DataFrame:
    t = txt.HYPERTENSION
    emergency, need = F.col("potential_hypertensive_emergency"), F.col("medication_urgency")
    components = {
        "patient_context": _patient("is_current_smoker", "is_obese", "is_sedentary"),
        "clinical_presentation": F.concat(
            fill(t["findings"]),
            said_if(F.col("has_diabetes"), t["confirmed"]),
            said_if(emergency, t["emergency_met"]),
        ),
        "comorbidities": F.concat(
            F.lit(t["comorbidities"]), said_if(F.col("has_diabetes"), t["diabetes"]), fill(t["factors"])
        ),
        "lifestyle_factors": fill(t["lifestyle"]),
        "urgency_note": first_match(
            [
                (t["note_emergency"], emergency),
                (t["note_immediate"], need == "immediate"),
                (t["note_urgent"], need == "urgent"),
            ],
            t["note_routine"],
        ),
        "risk_assessment": fill(t["risk"]),
        "symptom_inquiry": F.concat(F.lit(t["symptoms"]), _all_said(txt.HYPERTENSION_SYMPTOMS)),
        "lifestyle_assessment": F.concat(F.lit(t["areas"]), _all_said(txt.HYPERTENSION_AREAS)),
        "management_recommendations": F.concat(
            F.lit(t["management"]),
            lookup(need, txt.HYPERTENSION_MEDICATION, txt.HYPERTENSION_MEDICATION_DEFAULT),
            said_if(F.col("should_ask_current_medications"), t["medications"]),
            said_if(F.col("needs_lipid_management"), t["lipids"]),
            F.lit(t["priorities"]),
            lookup("smoking_cessation_priority", txt.HYPERTENSION_SMOKING, ""),
            lookup("weight_management_priority", txt.HYPERTENSION_WEIGHT, ""),
            said_if(one_of("stress_management_priority", "high", "moderate"), t["stress"]),
            said_if(F.col("needs_specialist_referral"), t["referral"]),
        ),
        "education_guidance": F.concat(
            F.lit(t["education"]),
            F.coalesce("education_topics", F.lit(t["education_default"])),
            F.lit(t["key_messages"]),
        ),
        "triage_recommendation": lookup(
            "clinical_urgency_level", txt.HYPERTENSION_TRIAGE, txt.HYPERTENSION_TRIAGE_DEFAULT
        ),
    }
    return _pairs(
        view,
        components,
        ["patient_context", "clinical_presentation", "comorbidities", "lifestyle_factors", "urgency_note"],
        [
            "risk_assessment", "symptom_inquiry", "lifestyle_assessment", "management_recommendations",
            "education_guidance", "triage_recommendation",
        ],
        ["systolic_bp", "diastolic_bp", "medication_urgency", "potential_hypertensive_emergency"],
    )


def mental_pairs(view: DataFrame) -> DataFrame:
    def text(col: str, default: str) -> Column:
        return F.coalesce(F.col(col).cast("string"), F.lit(default))

    def true(col: str) -> Column:
        return F.coalesce(F.col(col), F.lit(False))

    def number(col: str) -> Column:
        return F.coalesce(F.col(col), F.lit(0))

    fields = {
        "gender": text("gender", "unspecified"),
        "age_category": text("age_category", "adult"),
        "occupation": text("occupation_category", "not specified"),
        "depression": text("depression_severity", "not assessed"),
        "depression_score": text("depression_risk_score", "0"),
        "anxiety": text("anxiety_severity", "not assessed"),
        "anxiety_score": text("anxiety_risk_score", "0"),
        "symptoms": text("symptom_count", "0"),
        "severe_symptoms": text("severe_symptom_count", "0"),
        "impairment": text("functional_impairment_category", "not assessed"),
        "isolation": text("social_isolation_level", "unknown"),
        "urgency_upper": F.upper(text("mental_health_urgency_level", "NEEDS_ASSESSMENT")),
    }
    urgency, screening = F.col("mental_health_urgency_level"), true("needs_suicide_risk_screening")

    def top_score(limit: int) -> Column:
        return (number("depression_risk_score") >= limit) | (number("anxiety_risk_score") >= limit)

    prompt = F.concat(
        fill(txt.MENTAL_PATIENT, **fields),
        F.when(true("has_mental_health_history"), txt.MENTAL_HISTORY[0]).otherwise(txt.MENTAL_HISTORY[1]),
        first_match(
            [
                (txt.MENTAL_TREATMENT["current"], true("in_active_treatment")),
                (txt.MENTAL_TREATMENT["gap"], true("has_treatment_gap")),
            ],
            txt.MENTAL_TREATMENT["none"],
        ),
        fill(txt.MENTAL_PRESENTATION, **fields),
        said_if(true("has_comorbid_depression_anxiety"), txt.MENTAL_COMORBID),
        F.lit("\n"),
        said_if(screening, txt.MENTAL_ALERT),
    )
    plans = txt.MENTAL_TREATMENT_PLANS
    response = F.concat(
        fill(txt.MENTAL_ASSESSMENT, **fields),
        lookup(urgency, txt.MENTAL_ACTIONS, txt.MENTAL_ACTIONS_DEFAULT),
        fill(txt.MENTAL_SYMPTOMS, **fields),
        said_if(screening, txt.MENTAL_SAFETY),
        fill(txt.MENTAL_FUNCTION, **fields),
        first_match(
            [
                (plans["score_15"], top_score(15)),
                (plans["score_10"], top_score(10)),
                (plans["symptoms_3"], number("symptom_count") >= 3),
            ],
            plans["otherwise"],
        ),
        F.lit(txt.MENTAL_EDUCATION),
        lookup(urgency, txt.MENTAL_FOLLOW_UP, txt.MENTAL_FOLLOW_UP_DEFAULT),
        F.lit("\n\nDISPOSITION: "),
        lookup(urgency, txt.MENTAL_DISPOSITION, txt.MENTAL_DISPOSITION_DEFAULT),
    )
    level = text("mental_health_urgency_level", "needs_assessment")
    return view.select(
        "patient_id",
        "condition_type",
        level.alias("mental_health_urgency_level"),
        prompt.alias("user_prompt"),
        response.alias("assistant_response"),
        level.alias("ground_truth_urgency"),
        text("depression_severity", "not_assessed").alias("depression_severity"),
        text("anxiety_severity", "not_assessed").alias("anxiety_severity"),
        screening.alias("needs_suicide_risk_screening"),
        fields["depression_score"].alias("depression_risk_score"),
        fields["anxiety_score"].alias("anxiety_risk_score"),
        fields["symptoms"].alias("symptom_count"),
        fields["severe_symptoms"].alias("severe_symptom_count"),
        # Read by later checks, so they travel with the pair.
        "primary_clinical_concern",
    )


SELECT = {
    "diabetes": select_diabetes_features,
    "hypertension": select_hypertension_features,
    "mental_health": select_mental_features,
}
PAIRS = {"diabetes": diabetes_pairs, "hypertension": hypertension_pairs, "mental_health": mental_pairs}


def training_pairs(gold: DataFrame, domain: str) -> DataFrame:
    """Gold prompts table to prompt/response pairs."""
    return PAIRS[domain](SELECT[domain](gold))


# --- training rows --------------------------------------------------------------------------------
def to_training_rows(pairs: DataFrame, system_prompt: str) -> DataFrame:
    return pairs.select(
        "patient_id",
        "ground_truth_urgency",
        F.concat(F.lit(system_prompt), F.col("user_prompt")).alias("prompt"),
        F.col("assistant_response").alias("completion"),
    )


def to_chat_messages(pairs: DataFrame, system_prompt: str) -> DataFrame:
    """One nested record per pair: system, user and assistant messages."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = F.array(
        message("system", F.lit(system_prompt)),
        message("user", F.col("user_prompt")),
        message("assistant", F.col("assistant_response")),
    )
    return pairs.select(
        "patient_id", F.struct(messages.alias("messages")).alias("messages"), "ground_truth_urgency", "condition_type"
    )


def apply_template(cases: DataFrame, template: DataFrame, text: str, prompt: str = "system_prompt") -> DataFrame:
    """Put every template in front of every case's text: one row per case and template."""
    return cases.crossJoin(template.select(prompt)).withColumn("complete_prompt", F.concat(prompt, text)).drop(prompt)


def preview(df: DataFrame, columns: Mapping[str, int], keys: list[str]) -> DataFrame:
    """Lengths and opening characters of long texts."""
    return df.select(
        *keys,
        *[F.length(c).alias(f"{c}_len") for c in columns],
        *[F.left(F.col(c), F.lit(n)).alias(f"{c}_preview") for c, n in columns.items()],
    )


DOMAIN_SOURCE = {domain: SILVER[domain][0] for domain in SELECT}
