"""Fixed texts of the training prompts and responses.  Data only; the builders are in training_text."""

from __future__ import annotations

# Sentences shared by the domains. ``{name}`` is filled from the column of that name.
PATIENT = "Patient is a {gender} with BMI of {bmi_category}"
PATIENT_NOTES = {
    "is_current_smoker": ", currently smokes",
    "is_obese": ", classified as obese",
    "is_sedentary": ", sedentary lifestyle",
}

# Diabetes texts.
DIABETES = {
    "findings": "Clinical findings: Diabetes stage: {diabetes_stage}. HbA1c level: {hba1c_level}%. "
    "Glucose control: {glucose_control_status}. ",
    "concordant": "Lab values are concordant. ",
    "discordant": "Lab values show discordance. ",
    "confirmed": "Confirmed diabetes diagnosis. ",
    "no_comorbidity": "No significant comorbidities.",
    "triple": "Patient has triple diagnosis (diabetes, hypertension, heart disease).",
    "several": "Patient has multiple conditions: ",
    "risk": "Risk assessment: Cardiovascular risk score: {cardiovascular_risk_score}. "
    "Diabetes complication risk: {diabetes_complication_risk_score}. "
    "Metabolic syndrome score: {metabolic_syndrome_score}. ",
    "premature": "Premature disease present. ",
    "urgency": "Glucose urgency: {glucose_urgency_level}.",
    "high_glucose": "URGENT: Severe hyperglycemia detected ({hyperglycemia_urgency}).",
    "low_glucose": "URGENT: Severe hypoglycemia detected ({hypoglycemia_urgency}).",
    "glucose_urgent": "Glucose levels require urgent medical attention.",
    "glucose_routine": "Glucose levels are at routine monitoring status.",
    "symptoms": "Key symptoms to assess: ",
    "management": "Recommended management approach: ",
    "education": "Priority education topics: ",
    "education_default": "General diabetes management",
}
DIABETES_SEVERE_WORDS = ["severe", "critical", "emergency"]
DIABETES_SYMPTOMS = {
    "should_ask_diabetic_symptoms": "classic diabetic symptoms (polyuria, polydipsia, weight loss), ",
    "should_ask_cardiovascular_symptoms": "cardiovascular symptoms (chest pain, shortness of breath), ",
    "should_ask_neuropathy_symptoms": "neuropathy symptoms (tingling, numbness, pain), ",
    "should_ask_diet_habits": "dietary habits, ",
    "should_ask_physical_activity": "physical activity level, ",
    "should_ask_medication_adherence": "medication adherence",
}
DIABETES_MANAGEMENT = {
    "needs_glucose_monitoring": "Initiate glucose monitoring discussion. ",
    "needs_bp_monitoring": "Blood pressure monitoring needed. ",
    "needs_specialist_referral": "Consider specialist referral. ",
}
DIABETES_SMOKING = {
    "high": "High priority: smoking cessation counseling. ",
    "medium": "Medium priority: smoking cessation support. ",
}
DIABETES_WEIGHT = {
    "high": "High priority: weight management intervention. ",
    "medium": "Moderate priority: weight management support. ",
}
DIABETES_TRIAGE = {
    "emergency": "This patient requires IMMEDIATE EMERGENCY evaluation. Direct to emergency department immediately.",
    "urgent": "This patient requires URGENT medical evaluation within 24-48 hours. Schedule appointment promptly "
    "and provide interim guidance.",
    "routine": "This patient can be managed with ROUTINE follow-up. Schedule regular monitoring and provide "
    "lifestyle counseling.",
}
DIABETES_TRIAGE_DEFAULT = "Further assessment needed to determine appropriate care level."

# Hypertension texts.
HYPERTENSION = {
    "findings": "Clinical findings: Blood pressure: {systolic_bp}/{diastolic_bp} mmHg "
    "({systolic_category}/{diastolic_category}). Pulse pressure: {pulse_pressure} mmHg ({pulse_pressure_category}). ",
    "confirmed": "Confirmed diabetes diagnosis. ",
    "emergency_met": "HYPERTENSIVE EMERGENCY CRITERIA MET. ",
    "comorbidities": "Comorbidities and risk factors: ",
    "diabetes": "Type 2 diabetes, ",
    "factors": "Metabolic syndrome score: {metabolic_syndrome_score}. "
    "Stroke risk factors count: {stroke_risk_factors_count}. "
    "10-year cardiovascular risk: {ten_year_cv_risk_category}. "
    "Lipid profile: HDL {hdl_category}, LDL {ldl_category}, Triglycerides {triglycerides_category}.",
    "lifestyle": "Lifestyle assessment: Physical activity: {physical_activity_level}. "
    "Sleep: {sleep_duration} hours/night ({sleep_adequacy}). Stress level: {stress_level}/10 ({stress_category}). "
    "Sodium intake risk: {salt_intake_risk}.",
    "note_emergency": "URGENT: Blood pressure indicates potential hypertensive emergency. "
    "Immediate medical evaluation required.",
    "note_immediate": "URGENT: Blood pressure requires immediate medical attention and likely medication initiation.",
    "note_urgent": "Elevated blood pressure requiring prompt medical follow-up within 1-2 weeks.",
    "note_routine": "Blood pressure at routine monitoring level.",
    "risk": "Risk assessment: 10-year cardiovascular risk: {ten_year_cv_risk_category}. "
    "Metabolic syndrome score: {metabolic_syndrome_score}. Stroke risk factors: {stroke_risk_factors_count}.",
    "symptoms": "Key symptoms to assess: ",
    "areas": "Lifestyle areas to assess: ",
    "management": "Recommended management approach: ",
    "medications": "Review current medications and adherence. ",
    "lipids": "Lipid management discussion needed. ",
    "priorities": "Lifestyle priorities: ",
    "stress": "Stress reduction techniques. ",
    "referral": "Cardiology referral recommended. ",
    "education": "Priority education topics: ",
    "education_default": "General hypertension management",
    "key_messages": ". Key messages: DASH diet (rich in fruits, vegetables, whole grains), "
    "sodium restriction <2000mg/day, 150 minutes weekly moderate exercise, "
    "home blood pressure monitoring, medication adherence if prescribed.",
}
HYPERTENSION_SYMPTOMS = {
    "should_ask_crisis_symptoms": "PRIORITY - Severe headache, vision changes, chest pain, confusion "
    "(hypertensive emergency signs). ",
    "should_ask_cardiovascular_symptoms": "Cardiovascular - chest pain, palpitations, shortness of breath. ",
    "should_ask_stroke_symptoms": "Stroke warning signs - sudden weakness, numbness, speech difficulty, facial drooping. ",
    "should_ask_headache_vision": "Persistent headaches, blurred vision. ",
    "should_ask_kidney_symptoms": "Kidney symptoms - changes in urination, leg swelling. ",
    "should_ask_chest_symptoms": "Chest discomfort, palpitations. ",
}
HYPERTENSION_AREAS = {
    "should_ask_diet_sodium": "sodium intake and dietary patterns, ",
    "should_ask_exercise_habits": "physical activity level and exercise routine, ",
    "should_ask_stress_sleep": "stress levels and sleep quality, ",
    "should_ask_alcohol_use": "alcohol consumption patterns, ",
    "should_ask_weight_management": "weight management goals and challenges",
}
HYPERTENSION_MEDICATION = {
    "immediate": "IMMEDIATE - Antihypertensive medication needed urgently. Consider emergency department evaluation. ",
    "urgent": "URGENT - Schedule appointment within 24-48 hours. Antihypertensive therapy likely needed. ",
    "prompt": "Prompt medical follow-up recommended. Medication discussion appropriate. ",
    "consider": "Consider medication if lifestyle modifications insufficient. ",
}
HYPERTENSION_MEDICATION_DEFAULT = "Lifestyle modifications as first-line approach. "
HYPERTENSION_SMOKING = {
    "critical": "HIGH PRIORITY - Smoking cessation counseling. ",
    "high": "HIGH PRIORITY - Smoking cessation counseling. ",
    "moderate": "Smoking cessation support. ",
}
HYPERTENSION_WEIGHT = {
    "critical": "HIGH PRIORITY - Weight management intervention (target 5-10% reduction). ",
    "high": "HIGH PRIORITY - Weight management intervention (target 5-10% reduction). ",
    "moderate": "Weight management support. ",
}
HYPERTENSION_TRIAGE = {
    "emergency": "TRIAGE: IMMEDIATE EMERGENCY evaluation required. Direct to the emergency department immediately. "
    "Do not delay. Patient may have hypertensive emergency requiring IV medications and intensive monitoring.",
    "urgent": "TRIAGE: URGENT medical evaluation within 24-48 hours. Schedule appointment promptly. Begin home blood "
    "pressure monitoring. Provide interim lifestyle guidance. Patient likely needs antihypertensive medication.",
    "routine": "TRIAGE: ROUTINE follow-up appropriate. Schedule regular monitoring appointment. Focus on lifestyle "
    "modifications. Home blood pressure tracking recommended. Re-evaluate in 1-3 months.",
}
HYPERTENSION_TRIAGE_DEFAULT = "TRIAGE: Further assessment needed to determine appropriate care level."

# Mental-health texts. Fields arrive already defaulted, so nothing here is NULL.
MENTAL_PATIENT = (
    "Patient Demographics: {gender} in {age_category} age group, occupation: {occupation}.\n\nMental Health History: "
)
MENTAL_HISTORY = ("Documented mental health history present. ", "No documented history. ")
MENTAL_TREATMENT = {
    "current": "Currently in treatment. ",
    "gap": "Treatment gap - previously treated but not currently. ",
    "none": "Not currently in treatment. ",
}
MENTAL_PRESENTATION = (
    "\n\nCurrent Presentation:\n"
    "• Depression: {depression} (score: {depression_score})\n"
    "• Anxiety: {anxiety} (score: {anxiety_score})\n"
    "• Total symptom count: {symptoms}\n"
    "• Severe symptoms: {severe_symptoms}\n"
    "• Functional impairment: {impairment}\n"
    "• Social isolation: {isolation}\n"
)
MENTAL_COMORBID = "• Comorbid depression and anxiety present\n"
MENTAL_ALERT = "⚠️ SAFETY ALERT: Suicide risk screening criteria met. Direct assessment required.\n"
MENTAL_ASSESSMENT = "=== CLINICAL ASSESSMENT ===\n\nURGENCY LEVEL: {urgency_upper}\n"
MENTAL_ACTIONS = {
    "emergency": "• IMMEDIATE ACTION: Call 988 Suicide & Crisis Lifeline or 911\n"
    "• Go to nearest emergency department\n"
    "• Do not leave person alone\n"
    "• Emergency psychiatric evaluation required TODAY\n",
    "urgent": "• Schedule psychiatric evaluation within 24-48 hours\n"
    "• Crisis resources: 988 available 24/7\n"
    "• Close monitoring recommended\n",
    "needs_attention": "• Schedule mental health evaluation within 1-2 weeks\n"
    "• Consider therapy referral\n"
    "• Monitor symptoms for changes\n",
}
MENTAL_ACTIONS_DEFAULT = (
    "• Routine mental health support appropriate\n"
    "• Preventive counseling if desired\n"
    "• Focus on self-care and coping skills\n"
)
MENTAL_SYMPTOMS = (
    "\n\n=== SYMPTOM ASSESSMENT ===\n\n"
    "Depression Evaluation:\n"
    "• Severity: {depression}\n"
    "• Risk score: {depression_score}/27 (PHQ-9 style)\n"
    "• Key symptoms to assess: low mood, anhedonia, sleep changes, appetite changes, energy, concentration, "
    "worthlessness/guilt, psychomotor changes\n\n"
    "Anxiety Evaluation:\n"
    "• Severity: {anxiety}\n"
    "• Risk score: {anxiety_score}/21 (GAD-7 style)\n"
    "• Key symptoms to assess: excessive worry, restlessness, fatigue, concentration difficulty, irritability, "
    "muscle tension, sleep disturbance\n\n"
)
MENTAL_SAFETY = (
    "🚨 SAFETY ASSESSMENT REQUIRED:\n"
    '• Directly ask: "Are you having thoughts of harming yourself or ending your life?"\n'
    "• Assess: ideation, plan, intent, means, protective factors\n"
    "• Use Columbia Suicide Severity Rating Scale framework\n"
    "• If positive: immediate safety planning and crisis intervention\n"
    "• Crisis resources: 988 Lifeline (call/text), Crisis Text Line (HOME to 741741)\n\n"
)
MENTAL_FUNCTION = (
    "=== FUNCTIONAL IMPACT ===\n\n"
    "• Functional impairment: {impairment}\n"
    "• Social functioning: {isolation}\n"
    "• Areas to evaluate:\n"
    "  - Work/school performance and attendance\n"
    "  - Daily activities and self-care\n"
    "  - Social relationships and support network\n"
    "  - Physical activity and hobbies\n\n"
    "=== TREATMENT RECOMMENDATIONS ===\n\n"
)
# Tried in order: score of 15 or more, score of 10 or more, three symptoms, otherwise the default.
MENTAL_TREATMENT_PLANS = {
    "score_15": "1. THERAPY: High priority - immediate referral recommended\n"
    "   • Cognitive Behavioral Therapy (CBT)\n"
    "   • If available: schedule within 1 week\n\n"
    "2. MEDICATION: Psychiatric evaluation recommended\n"
    "   • Consider SSRI/SNRI for moderate-severe symptoms\n"
    "   • Refer to psychiatrist or psychiatric NP\n\n",
    "score_10": "1. THERAPY: Recommended - schedule within 2-3 weeks\n"
    "   • CBT, Acceptance and Commitment Therapy (ACT), or Interpersonal Therapy\n\n"
    "2. MEDICATION: Consider if symptoms persist despite therapy\n\n",
    "symptoms_3": "1. THERAPY: Consider counseling for symptom management\n"
    "   • Supportive therapy or brief intervention\n\n"
    "2. MEDICATION: Not indicated at this time, focus on therapy first\n\n",
    "otherwise": "1. PREVENTIVE SUPPORT: Mental health education and self-care\n2. MONITOR: Track symptoms over time\n\n",
}
MENTAL_EDUCATION = (
    "3. PSYCHOSOCIAL INTERVENTIONS:\n"
    "   • Increase social support and connection\n"
    "   • Address barriers to care (cost, stigma, access)\n"
    "   • Workplace accommodations if needed\n"
    "   • Support groups or peer support\n\n"
    "=== PATIENT EDUCATION ===\n\n"
    "Self-Care Strategies:\n"
    "• Sleep: Maintain consistent 7-9 hour schedule\n"
    "• Exercise: 30 minutes of activity 5x/week (proven effective for mild-moderate depression/anxiety)\n"
    "• Nutrition: Regular meals, limit caffeine/alcohol\n"
    "• Stress management: Relaxation techniques, mindfulness, deep breathing\n"
    "• Social connection: Reach out to friends/family, avoid isolation\n"
    "• Pleasant activities: Schedule enjoyable activities daily\n"
    "• Limit substances: Alcohol can worsen depression/anxiety\n\n"
    "When to Seek Immediate Help:\n"
    "• Thoughts of self-harm or suicide\n"
    "• Severe symptoms interfering with daily functioning\n"
    "• Symptoms rapidly worsening\n"
    "• Unable to care for self or dependents\n\n"
    "Crisis Resources:\n"
    "• 988 Suicide & Crisis Lifeline (24/7 call/text)\n"
    "• Crisis Text Line: Text HOME to 741741\n"
    "• Emergency: 911\n"
    "• SAMHSA National Helpline: 1-800-662-4357\n\n"
    "=== FOLLOW-UP PLAN ===\n\n"
)
MENTAL_FOLLOW_UP = {
    "emergency": "IMMEDIATE: Emergency evaluation today, then daily monitoring",
    "urgent": "Within 48 hours: Psychiatric appointment, then weekly follow-up",
    "needs_attention": "Within 1-2 weeks: Mental health evaluation, then bi-weekly monitoring",
}
MENTAL_FOLLOW_UP_DEFAULT = "As needed: Routine check-ins, self-monitoring of symptoms"
MENTAL_DISPOSITION = {
    "emergency": "Emergency department or mobile crisis team",
    "urgent": "Urgent outpatient psychiatric appointment",
    "needs_attention": "Outpatient mental health services",
}
MENTAL_DISPOSITION_DEFAULT = "Self-care with optional counseling support"

# System prompts of the training and validation sets.
_TRIAGE_ROLE = (
    "Your role is to assess patient presentations, evaluate urgency (Emergency/Urgent/Routine), "
    "identify key symptoms for inquiry, provide evidence-based management recommendations, "
    "and suggest appropriate patient education. You must prioritize patient safety, "
)
_DIABETES_SYSTEM = (
    "You are a medical AI assistant specializing in diabetes and metabolic disease management. " + _TRIAGE_ROLE
    + "detect emergencies (severe hyperglycemia/hypoglycemia), provide clear triage recommendations "
    "based on ADA clinical guidelines, and recommend specialist referral when appropriate."
)
_HYPERTENSION_SYSTEM = (
    "You are a medical AI assistant specializing in hypertension and cardiovascular disease management. "
    + _TRIAGE_ROLE
    + "detect hypertensive emergencies (BP ≥180/120 with symptoms), provide clear triage recommendations "
    "based on ACC/AHA guidelines, and recommend specialist referral when appropriate."
)
_DECISION_SUPPORT = " You serve as a clinical decision support tool, not a replacement for medical diagnosis."
_MENTAL_ROLE = "You are a compassionate mental health AI assistant specializing in depression, anxiety, and psychiatric triage. "
CHAT_SYSTEM = {"diabetes": _DIABETES_SYSTEM + _DECISION_SUPPORT}
TRAIN_SYSTEM = {
    "diabetes": _DIABETES_SYSTEM + "\n\nPatient Case:\n",
    "hypertension": _HYPERTENSION_SYSTEM + _DECISION_SUPPORT + "\n\nPatient Case:\n",
    "mental_health": _MENTAL_ROLE
    + "Your role is to assess mental health presentations, evaluate urgency "
    "(Emergency/Urgent/Needs_Attention/Routine), "
    "conduct safety assessments for suicide risk when indicated, identify key symptoms, "
    "provide evidence-based treatment recommendations, and suggest appropriate referrals. "
    "CRITICAL: If suicide risk screening is indicated, directly and compassionately ask about suicidal thoughts. "
    "Use non-judgmental, validating language that acknowledges suffering while instilling hope. "
    "Follow APA guidelines for depression and anxiety management.\n\nPatient Presentation:\n",
}
VALIDATION_SYSTEM = {
    "diabetes": TRAIN_SYSTEM["diabetes"],
    "hypertension": _HYPERTENSION_SYSTEM + "\n\nPatient Case:\n",
    "mental_health": _MENTAL_ROLE
    + "Assess urgency, conduct safety screening, and provide evidence-based recommendations."
    "\n\nPatient Presentation:\n",
}
