"""Fixed word lists, patterns and text values of the chat and evaluation rules."""

from __future__ import annotations

# Keyword triage lists, in the order they are tested.
EMERGENCY_KEYWORDS = [
    "chest pain", "heart attack", "stroke", "seizure", "unconscious", "severe bleeding", "not breathing",
    "suicide", "kill myself", "end my life", "severe headache", "can't breathe", "choking",
]
URGENT_KEYWORDS = [
    "high fever", "vomiting blood", "severe pain", "can't move", "vision loss", "confusion",
    "severe allergic", "broken bone", "severe burn",
]
SYMPTOM_KEYWORDS = [
    "headache", "fever", "cough", "fatigue", "nausea", "dizziness", "pain", "swelling", "rash",
    "shortness of breath", "anxiety", "depression", "insomnia", "stress", "blood pressure", "blood sugar",
    "diabetes", "hypertension",
]

# Routing vocabulary per domain.
DOMAIN_KEYWORDS = {
    "lifestyle_diseases_diabetes": [
        "diabetes", "blood sugar", "glucose", "insulin", "HbA1c", "diabetic", "hyperglycemia", "hypoglycemia",
    ],
    "lifestyle_diseases_hypertension": [
        "blood pressure", "hypertension", "BP", "cardiovascular", "cholesterol", "heart rate", "systolic", "diastolic",
    ],
    "mental_health": ["depression", "anxiety", "stress", "mental health", "mood", "sleep", "therapy", "counseling"],
    "womens_wellness_maternal": [
        "pregnancy", "pregnant", "prenatal", "gestational", "preeclampsia", "maternal", "baby",
    ],
    "womens_wellness_pcos": ["PCOS", "menstrual", "period", "ovulation", "fertility", "hormonal", "testosterone"],
    "emergency": ["chest pain", "stroke", "seizure", "unconscious", "severe bleeding", "suicide"],
    "general_health": ["healthy", "wellness", "prevention", "nutrition", "exercise", "general"],
}
DOMAIN_MODELS = {
    "lifestyle_diseases_diabetes": "diabetes_llm_16k",
    "lifestyle_diseases_hypertension": "hypertension_llm",
    "mental_health": "mental_health_llm",
    "womens_wellness_maternal": "maternal_health_llm",
    "womens_wellness_pcos": "pcos_llm",
    "emergency": "emergency_protocol",
    "general_health": "general_health_llm",
}

# Document types by words in the file name, first list that matches wins.
DOCUMENT_TYPES = {
    "lab_report": ["lab", "blood", "test", "result"],
    "prescription": ["prescription", "rx", "medication"],
    "imaging": ["xray", "x-ray", "mri", "ct", "scan", "imaging"],
    "discharge_summary": ["discharge", "summary", "hospital"],
}

# Metric patterns, units and accepted ranges.
BLOOD_PRESSURE_PATTERN = r"(\d{2,3})\s*/\s*(\d{2,3})"
BLOOD_SUGAR_PATTERNS = [
    r"blood\s+sugar[:\s]+(\d{2,3})",
    r"glucose[:\s]+(\d{2,3})",
    r"\bbs[:\s]+(\d{2,3})",
    r"sugar\s+level[:\s]+(\d{2,3})",
]
HBA1C_PATTERN = r"(?:hba1c|a1c)[:\s]+(\d+\.?\d*)"
METRIC_UNITS = {
    "blood_pressure_systolic": "mmHg",
    "blood_pressure_diastolic": "mmHg",
    "blood_sugar": "mg/dL",
    "hba1c": "%",
}
METRIC_RANGES = {
    "blood_pressure_systolic": (70, 250),
    "blood_pressure_diastolic": (40, 150),
    "blood_sugar": (40, 600),
    "hba1c": (3, 20),
}
# (mild, moderate, severe) lower limits
METRIC_GRADES = {
    "blood_pressure_systolic": (130, 140, 180),
    "blood_pressure_diastolic": (80, 90, 110),
    "blood_sugar": (140, 180, 250),
    "hba1c": (6.5, 7.0, 9.0),
}
TRACKED_METRICS = {
    "LIFESTYLE_DISEASES": [
        "blood_pressure_systolic", "blood_pressure_diastolic", "blood_sugar", "hba1c", "weight", "cholesterol_total",
    ],
    "WOMEN_WELLNESS": ["blood_pressure_systolic", "blood_sugar", "weight"],
}
EXTRACTION_DOMAINS = ["LIFESTYLE_DISEASES", "WOMEN_WELLNESS"]

# Topics of the keyword search and the words that raise them.
SEARCH_TOPICS = {
    "blood pressure": ["blood pressure", "bp", "hypertension"],
    "blood sugar": ["blood sugar", "glucose", "diabetes"],
    "cholesterol": ["cholesterol", "ldl", "hdl"],
}

# Urgency phrases in free-text predictions (LIKE patterns, first list wins).
PREDICTION_PHRASES = {
    "emergency": ["%IMMEDIATE EMERGENCY%", "%emergency evaluation%", "%Direct to emergency%", "%emergency department%"],
    "urgent": ["%URGENT%evaluation%", "%24-48 hours%", "%urgent medical evaluation%", "%requires URGENT%"],
    "routine": ["%ROUTINE%follow-up%", "%routine monitoring%", "%regular monitoring%", "%ROUTINE%care%"],
}
REPLY_MARKERS = {"emergency": "⚠️ EMERGENCY:", "urgent": "⚡ URGENT:"}

# Structural phrases removed from replies, with their replacement.
REPLY_LABELS = [
    (r"Risk assessment:\s*\d+/\d+\s*-\s*", ""),
    (r"Key messages:\s*", ""),
    (r"Recommended keywords:\s*", ""),
    (r"Priority areas to discuss:\s*", ""),
    (r"Lifestyle areas to assess:\s*", ""),
    (r"Priority topics:\s*", ""),
    (r"TRIAGE:\s*", ""),
    (r"Recommended foods:\s*", "I recommend: "),
]
STRUCTURAL_LINES = ["Priority areas to assess:", "Lifestyle priorities:", "Key phrases:", "Recommended keywords:"]
STRUCTURAL_LINE_PATTERN = r"^(Risk assessment|Key messages|TRIAGE|Priority topics):\s*$"
PROGRESS_PREFIX = "Great progress with your health metrics! 🎉\n\n"

# Claims of shared history, removed for users without one (case is ignored).
FALSE_RECALL_PATTERNS = [
    r"We've talked about [^.]+\.",
    r"I remember [^.]+\.",
    r"we previously discussed [^.]+\.",
    r"Last time [^.]+\.",
    r"we explored [^.]+together[^.]+\.",
    r"you mentioned [^.]+before[^.]+\.",
    r"I'm glad to see [^.]+progress[^.]+\.",
    r"your [^.]+ has improved [^.]+\.",
    r"I've reviewed your [^.]+\.",
]

# Reply decoration.
DOMAIN_ICONS = {"DIABETES": "💉", "HEART_DISEASE": "❤️", "MENTAL_HEALTH": "🧠"}
DEFAULT_ICON = "🏥"
URGENCY_BADGES = {
    "URGENT": "\n\n⚠️ **URGENT**: Please seek medical attention within 24 hours.\n",
    "NEEDS_ATTENTION": "\n\n📋 **Note**: Consider scheduling a doctor's appointment to discuss this.\n",
}
REPLY_FOOTER = "*💡 Remember: This is educational guidance. Always consult healthcare professionals for medical decisions.*"

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Condition words of the profile sentence, by profile column.
PROFILE_CONDITIONS = {
    "has_diabetes": "diabetes",
    "has_hypertension": "hypertension",
    "has_heart_disease": "heart disease",
    "has_mental_health_history": "mental health history",
    "has_pcos": "PCOS",
}
