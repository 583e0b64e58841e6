"""DuckDB statements of the training views and texts.  Only the fixed texts are shared with Spark."""

from __future__ import annotations

import re

from checks.gold_sql import chain
from checks.sqltext import lit, pick, with_ctes, yes
from vitalframe.plans import prompt_texts as t
from vitalframe.plans.training_text import (
    DIABETES_COLUMNS,
    HYPERTENSION_COLUMNS,
    IDENTITY,
    MENTAL_LEFT_OUT,
)

BMI_TEXT = pick(
    ("Underweight", "bmi < 18.5"),
    ("Normal", "bmi < 25"),
    ("Overweight", "bmi < 30"),
    ("Obese Class I", "bmi < 35"),
    ("Obese Class II", "bmi < 40"),
    ("Obese Class III", "bmi >= 40"),
    default="Unknown",
)


def digest(columns) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({c}::varchar, '~')" for c in columns) + "))"


def numbered(prefix: str, domain: str, first: str = "") -> str:
    order = f"{first}{digest(IDENTITY[domain])}"
    return f"'{prefix}' || row_number() OVER (ORDER BY {order}) AS patient_id"


def text(template: str, **names: str) -> str:
    """Template to a ``||`` chain, so one NULL empties the whole text as intended."""
    parts = re.split(r"\{(\w+)\}", template)
    out = []
    for i, part in enumerate(parts):
        if i % 2:
            out.append(f"({names.get(part, part)})::varchar")
        elif part:
            out.append(lit(part))
    return " || ".join(out)


def when(cond: str, said: str) -> str:
    return f"if({yes(cond)}, {lit(said)}, '')"


def said(column: str, table: dict, default: str = "") -> str:
    return pick(*[(v, f"{column} = {lit(k)}") for k, v in table.items()], default=default)


def all_when(table: dict) -> str:
    return " || ".join(when(k, v) for k, v in table.items())


def joined(separator: str, *parts: str) -> str:
    return f" || {lit(separator)} || ".join(f"({p})" for p in parts)


def view_ctes(domain: str) -> list[tuple[str, str]]:
    base = chain(domain, "prompts")
    if domain == "hypertension":
        cols = ", ".join(f"{a} AS {b}" for a, b in HYPERTENSION_COLUMNS.items())
        urgency = pick(
            ("emergency", "potential_hypertensive_emergency"),
            ("urgent", "medication_urgency IN ('urgent', 'immediate', 'high')"),
            ("routine", "medication_urgency IN ('routine', 'monitor', 'low')"),
            default="needs_assessment",
        )
        body = (
            f"SELECT {numbered('HTN_', domain)}, 'hypertension' AS condition_type, {cols}, {BMI_TEXT} AS bmi_category, "
            f"{urgency} AS clinical_urgency_level FROM gold"
        )
    elif domain == "diabetes":
        cols = ", ".join(f"{a} AS {b}" for a, b in DIABETES_COLUMNS.items())
        body = (
            f"SELECT {numbered('DM_', domain)}, 'diabetes' AS condition_type, {cols}, {BMI_TEXT} AS bmi_category, "
            "if(glucose_urgency_level IN ('emergency', 'urgent'), glucose_urgency_level, 'routine') "
            "AS clinical_urgency_level FROM gold"
        )
    else:
        hide = ", ".join([*IDENTITY["mental_health"], "survey_timestamp", "gender_clean", *MENTAL_LEFT_OUT])
        body = (
            f"SELECT {numbered('MH_', domain, 'survey_timestamp NULLS LAST, ')}, 'mental_health' AS condition_type, "
            f"gender_clean AS gender, survey_timestamp AS source_timestamp, * EXCLUDE ({hide}) FROM gold"
        )
    return [*base, ("view", body)]


def _diabetes_pair() -> str:
    d = t.DIABETES
    parts = {
        "patient_context": f"{text(t.PATIENT)} || {when('is_current_smoker', t.PATIENT_NOTES['is_current_smoker'])} || "
        f"{when('is_obese', t.PATIENT_NOTES['is_obese'])} || '.'",
        "clinical_presentation": f"{text(d['findings'])} || {lit(d['discordant'])} || {when('has_diabetes', d['confirmed'])}",
        "comorbidities": "CASE cardiometabolic_disease_count WHEN 0 THEN " + lit(d["no_comorbidity"])
        + " WHEN 3 THEN " + lit(d["triple"]) + " WHEN 2 THEN " + lit(d["several"])
        + " || if(has_heart_disease, 'heart disease, ', '') || if(has_hypertension, 'hypertension, ', '') || 'diabetes.'"
        + " ELSE if(has_heart_disease, 'History of heart disease. ', '') "
        + "|| if(has_hypertension, 'History of hypertension. ', '') END",
        "urgency_note": f"if(glucose_urgency_level = 'urgent', {lit(d['glucose_urgent'])}, {lit(d['glucose_routine'])})",
        "risk_assessment": f"{text(d['risk'])} || {when('has_premature_disease', d['premature'])} || {text(d['urgency'])}",
        "symptom_inquiry": f"{lit(d['symptoms'])} || {all_when(t.DIABETES_SYMPTOMS)}",
        "management_recommendations": f"{lit(d['management'])} || {all_when(t.DIABETES_MANAGEMENT)} || "
        f"{when(chr(40) + 'smoking_cessation_priority' + chr(41) + ' = ' + lit('high'), t.DIABETES_SMOKING['high'])} || "
        + when("weight_management_priority = 'high'", t.DIABETES_WEIGHT["high"]),
        "education_guidance": f"{lit(d['education'])} || coalesce(education_topics, {lit(d['education_default'])})",
        "triage_recommendation": said("clinical_urgency_level", t.DIABETES_TRIAGE, t.DIABETES_TRIAGE_DEFAULT),
    }
    prompt = joined(" ", "patient_context", "clinical_presentation", "comorbidities", "urgency_note")
    answer = joined(
        "\n\n", "risk_assessment", "symptom_inquiry", "management_recommendations", "education_guidance",
        "triage_recommendation",
    )
    return _assemble(parts, prompt, answer, "")


def _hypertension_pair() -> str:
    h = t.HYPERTENSION
    notes = " || ".join(when(k, v) for k, v in t.PATIENT_NOTES.items())
    parts = {
        "patient_context": f"{text(t.PATIENT)} || {notes} || '.'",
        "clinical_presentation": f"{text(h['findings'])} || {when('has_diabetes', h['confirmed'])} || "
        f"{when('potential_hypertensive_emergency', h['emergency_met'])}",
        "comorbidities": f"{lit(h['comorbidities'])} || {when('has_diabetes', h['diabetes'])} || {text(h['factors'])}",
        "lifestyle_factors": text(h["lifestyle"]),
        "urgency_note": f"CASE WHEN potential_hypertensive_emergency THEN {lit(h['note_emergency'])} "
        f"WHEN medication_urgency = 'urgent' THEN {lit(h['note_urgent'])} ELSE {lit(h['note_routine'])} END",
        "risk_assessment": text(h["risk"]),
        "symptom_inquiry": f"{lit(h['symptoms'])} || {all_when(t.HYPERTENSION_SYMPTOMS)}",
        "lifestyle_assessment": f"{lit(h['areas'])} || {all_when(t.HYPERTENSION_AREAS)}",
        "management_recommendations": f"{lit(h['management'])} || "
        f"{said('medication_urgency', t.HYPERTENSION_MEDICATION, t.HYPERTENSION_MEDICATION_DEFAULT)} || "
        f"{when('should_ask_current_medications', h['medications'])} || {when('needs_lipid_management', h['lipids'])} || "
        f"{lit(h['priorities'])} || {said('smoking_cessation_priority', t.HYPERTENSION_SMOKING)} || "
        f"{said('weight_management_priority', t.HYPERTENSION_WEIGHT)} || "
        + when("stress_management_priority <> 'low'", h["stress"]) + " || "
        + when("needs_specialist_referral", h["referral"]),
        "education_guidance": f"{lit(h['education'])} || education_topics || {lit(h['key_messages'])}",
        "triage_recommendation": said("clinical_urgency_level", t.HYPERTENSION_TRIAGE, t.HYPERTENSION_TRIAGE_DEFAULT),
    }
    prompt = joined(
        " ", "patient_context", "clinical_presentation", "comorbidities", "lifestyle_factors", "urgency_note"
    )
    answer = joined(
        "\n\n", "risk_assessment", "symptom_inquiry", "lifestyle_assessment", "management_recommendations",
        "education_guidance", "triage_recommendation",
    )
    return _assemble(
        parts, prompt, answer, ", systolic_bp, diastolic_bp, medication_urgency, potential_hypertensive_emergency"
    )


def _assemble(parts: dict[str, str], prompt: str, answer: str, extra: str) -> str:
    built = ", ".join(f"{sql} AS {name}" for name, sql in parts.items())
    shown = ", ".join(p for p in parts if p != "urgency_note")
    return (
        f"SELECT patient_id, condition_type, clinical_urgency_level, {prompt} AS user_prompt, {answer} AS assistant_response, "
        f"clinical_urgency_level AS ground_truth_urgency, {shown}{extra} FROM (SELECT *, {built} FROM view)"
    )


def _mental_pair() -> str:
    f = {
        "gender": "gender",
        "age_category": "age_category",
        "occupation": "occupation_category",
        "depression": "depression_severity",
        "depression_score": "depression_risk_score",
        "anxiety": "anxiety_severity",
        "anxiety_score": "anxiety_risk_score",
        "symptoms": "symptom_count",
        "severe_symptoms": "severe_symptom_count",
        "impairment": "functional_impairment_category",
        "isolation": "social_isolation_level",
        "urgency_upper": "upper(mental_health_urgency_level)",
    }
    u = "mental_health_urgency_level"
    prompt = " || ".join(
        [
            text(t.MENTAL_PATIENT, **f),
            f"if(has_mental_health_history, {lit(t.MENTAL_HISTORY[0])}, {lit(t.MENTAL_HISTORY[1])})",
            f"if(in_active_treatment, {lit(t.MENTAL_TREATMENT['current'])}, "
            f"if(has_treatment_gap, {lit(t.MENTAL_TREATMENT['gap'])}, {lit(t.MENTAL_TREATMENT['none'])}))",
            text(t.MENTAL_PRESENTATION, **f),
            when("has_comorbid_depression_anxiety", t.MENTAL_COMORBID),
            "chr(10)",
            when("needs_suicide_risk_screening", t.MENTAL_ALERT),
        ]
    )
    plans = t.MENTAL_TREATMENT_PLANS
    answer = " || ".join(
        [
            text(t.MENTAL_ASSESSMENT, **f),
            said(u, t.MENTAL_ACTIONS, t.MENTAL_ACTIONS_DEFAULT),
            text(t.MENTAL_SYMPTOMS, **f),
            when("needs_suicide_risk_screening", t.MENTAL_SAFETY),
            text(t.MENTAL_FUNCTION, **f),
            pick(
                (plans["score_15"], "greatest(depression_risk_score, anxiety_risk_score) >= 15"),
                (plans["score_10"], "greatest(depression_risk_score, anxiety_risk_score) >= 10"),
                (plans["symptoms_3"], "symptom_count >= 3"),
                default=plans["otherwise"],
            ),
            lit(t.MENTAL_EDUCATION),
            said(u, t.MENTAL_FOLLOW_UP, t.MENTAL_FOLLOW_UP_DEFAULT),
            lit("\n\nDISPOSITION: "),
            said(u, t.MENTAL_DISPOSITION, t.MENTAL_DISPOSITION_DEFAULT),
        ]
    )
    return (
        f"SELECT patient_id, condition_type, {u}, {prompt} AS user_prompt, {answer} AS assistant_response, "
        f"{u} AS ground_truth_urgency, depression_severity, anxiety_severity, needs_suicide_risk_screening, "
        "depression_risk_score::varchar AS depression_risk_score, anxiety_risk_score::varchar AS anxiety_risk_score, "
        "symptom_count::varchar AS symptom_count, severe_symptom_count::varchar AS severe_symptom_count, "
        "primary_clinical_concern FROM view"
    )


PAIR_SQL = {"diabetes": _diabetes_pair, "hypertension": _hypertension_pair, "mental_health": _mental_pair}


def pair_ctes(domain: str) -> list[tuple[str, str]]:
    return [*view_ctes(domain), ("pairs", PAIR_SQL[domain]())]


BUCKET = "(concat('0x', substr(md5(patient_id), 1, 8))::ubigint % 10)"


def row_ctes(domain: str) -> list[tuple[str, str]]:
    """Training and validation rows."""
    row = "SELECT patient_id, ground_truth_urgency, {} || user_prompt AS prompt, assistant_response AS completion FROM pairs"
    return [
        *pair_ctes(domain),
        ("train", row.format(lit(t.TRAIN_SYSTEM[domain])) + f" WHERE {BUCKET} < 8"),
        ("valid", row.format(lit(t.VALIDATION_SYSTEM[domain])) + f" WHERE {BUCKET} >= 8"),
    ]


def pair_sql(domain: str, final: str) -> str:
    return with_ctes(pair_ctes(domain), final)


def rows_sql(domain: str, final: str, *more: tuple[str, str]) -> str:
    return with_ctes([*row_ctes(domain), *more], final)


def seeded(seed: int, key: str = "patient_id") -> str:
    return f"md5('{seed}|' || {key}::varchar)"
