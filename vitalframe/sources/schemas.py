"""Declared schemas of the bronze tables and the typed application tables."""

from __future__ import annotations

# Column names and types of the input and application tables.
BRONZE = {
    "raw_diabetes": "GENDER string, AGE double, HYPERTENSION int, HEART_DISEASE int, SMOKING_HISTORY string, "
    "BMI double, HBA1C_LEVEL double, BLOOD_GLUCOSE_LEVEL double, DIABETES int",
    "raw_bloodpressure": "COUNTRY string, AGE bigint, GENDER string, BMI double, CHOLESTEROL bigint, "
    "SYSTOLIC_BP bigint, DIASTOLIC_BP bigint, HEART_RATE bigint, LDL bigint, HDL bigint, TRIGLYCERIDES bigint, "
    "GLUCOSE bigint, SMOKING_STATUS string, PHYSICAL_ACTIVITY_LEVEL string, ALCOHOL_INTAKE double, "
    "SALT_INTAKE double, SLEEP_DURATION double, STRESS_LEVEL bigint, FAMILY_HISTORY boolean, DIABETES boolean, "
    "HYPERTENSION string, EDUCATION_LEVEL string, EMPLOYMENT_STATUS string",
    "raw_mentalhealth": "TIMESTAMP_TXT string, GENDER string, COUNTRY string, OCCUPATION string, "
    "SELF_EMPLOYED boolean, FAMILY_HISTORY boolean, TREATMENT boolean, COPING_STRUGGLES boolean, "
    "DAYS_INDOORS string, GROWING_STRESS string, CHANGES_HABITS string, MENTAL_HEALTH_HISTORY string, "
    "MOOD_SWINGS string, WORK_INTEREST string, SOCIAL_WEAKNESS string, MENTAL_HEALTH_INTERVIEW string, "
    "CARE_OPTIONS string",
    "raw_maternalhealth": "AGE bigint, SYSTOLICBP bigint, DIASTOLICBP bigint, BS double, BODYTEMP double, "
    "HEARTRATE bigint, RISKLEVEL string",
    "raw_pcos": "AGE bigint, ANTI_MULLERIAN_HORMONE double, LUTEINIZING_HORMONE double, "
    "FOLLICLE_STIMULATING_HORMONE double, TOTAL_TESTOSTERONE double, BODY_MASS_INDEX double, "
    "FAMILY_HISTORY boolean, MENSTRUAL_CYCLE string",
    "raw_pcos_infertility": "PATIENT_FILE_NO bigint, PCOS int, I_BETA_HCG double, II_BETA_HCG double, AMH double",
}

APP = {
    "users": "user_id string, email string, hashed_password string, full_name string, date_of_birth date, "
    "gender string, phone_number string, account_status string, created_at timestamp_ntz, "
    "last_login timestamp_ntz, failed_login_attempts int, account_locked_until timestamp_ntz, "
    "email_verified boolean, terms_accepted boolean, privacy_consent boolean",
    "user_medical_profiles": "profile_id string, user_id string, height_cm double, weight_kg double, bmi double, "
    "blood_type string, has_diabetes boolean, has_hypertension boolean, has_heart_disease boolean, "
    "has_mental_health_history boolean, has_pcos boolean, smoking_status string, alcohol_consumption string, "
    "exercise_frequency string, is_pregnant boolean, pregnancy_trimester int, menstrual_cycle_regular boolean, "
    "last_menstrual_period date, emergency_contact_name string, emergency_contact_phone string, "
    "emergency_contact_relationship string, created_at timestamp_ntz, last_updated timestamp_ntz",
    "uploaded_documents": "document_id string, user_id string, original_filename string, document_type string, "
    "upload_timestamp timestamp_ntz, file_size_bytes bigint, stage_path string, bucket_path string, "
    "processing_status string, processing_started_at timestamp_ntz, processing_completed_at timestamp_ntz, "
    "processing_error_message string, extracted_data variant, extraction_confidence_score double, "
    "detected_test_types array<string>, detected_date date, issuing_facility string, is_encrypted boolean, "
    "hipaa_compliant boolean, data_retention_until date",
    "conversation_history": "conversation_id string, user_id string, session_id string, "
    "message_timestamp timestamp_ntz, user_message string, assistant_response string, routed_to_domain string, "
    "used_llm_model string, router_confidence_score double, urgency_level string, "
    "detected_symptoms array<string>, follow_up_recommended boolean, referenced_documents array<string>, "
    "used_medical_profile boolean, response_time_seconds double, tokens_used int",
    "application_logs": "log_id string, log_timestamp timestamp_ntz, log_level string, log_source string, "
    "log_message string, user_id string, session_id string, function_name string, error_type string, "
    "stack_trace string, request_payload variant, response_status int",
    "health_metrics": "metric_id string, user_id string, conversation_id string, metric_type string, "
    "metric_value double, metric_unit string, measurement_date date, reported_date timestamp_ntz, source string, "
    "confidence_score double, is_abnormal boolean, severity string, created_at timestamp_ntz, notes string",
    "conversation_summaries": "summary_id string, user_id string, summary_type string, summary_text string, "
    "key_topics array<string>, domain string, mentioned_metrics variant, time_period_start timestamp_ntz, "
    "time_period_end timestamp_ntz, created_at timestamp_ntz, generated_by string",
}

# Column defaults of the application tables. "now" means the load time.
APP_DEFAULTS = {
    "users": {
        "account_status": "active",
        "created_at": "now",
        "failed_login_attempts": 0,
        "email_verified": False,
        "terms_accepted": False,
        "privacy_consent": False,
    },
    "user_medical_profiles": {
        "has_diabetes": False,
        "has_hypertension": False,
        "has_heart_disease": False,
        "has_mental_health_history": False,
        "has_pcos": False,
        "is_pregnant": False,
        "created_at": "now",
        "last_updated": "now",
    },
    "uploaded_documents": {
        "upload_timestamp": "now",
        "processing_status": "pending",
        "is_encrypted": True,
        "hipaa_compliant": True,
    },
    "conversation_history": {
        "message_timestamp": "now",
        "follow_up_recommended": False,
        "used_medical_profile": True,
    },
    "application_logs": {"log_timestamp": "now"},
    "health_metrics": {
        "reported_date": "now",
        "source": "conversation_extracted",
        "confidence_score": 1.0,
        "is_abnormal": False,
        "created_at": "now",
    },
    "conversation_summaries": {"summary_type": "session_summary", "created_at": "now"},
}

# Keys declared on the application tables (primary key, foreign key to users).
APP_KEYS = {
    "users": ("user_id", None),
    "user_medical_profiles": ("profile_id", "user_id"),
    "uploaded_documents": ("document_id", "user_id"),
    "conversation_history": ("conversation_id", "user_id"),
    "application_logs": ("log_id", None),
    "health_metrics": ("metric_id", "user_id"),
    "conversation_summaries": ("summary_id", "user_id"),
}
