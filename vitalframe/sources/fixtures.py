"""Projections of the shared tables onto the bronze and application tables.

Each text is one SELECT that Spark and DuckDB read alike, so a query and its check share one
input.  Tables that must hold exact duplicates repeat every tenth order once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHARED_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The projections, keyed by view name.
_SELECTS = {
    "raw_diabetes": """
SELECT CASE WHEN (l_orderkey*31+l_partkey*17+l_linenumber)%43=0 THEN NULL WHEN l_suppkey%4=0 THEN ' Female' WHEN l_suppkey%4=1 THEN 'Male ' WHEN l_suppkey%4=2 THEN 'FEMALE' ELSE 'male' END AS GENDER,
 CAST((l_orderkey*13+l_partkey*29+l_linenumber*7)%125 AS DOUBLE) AS AGE,
 CASE WHEN (l_partkey*3+l_linenumber)%11=0 THEN 1 ELSE 0 END AS HYPERTENSION,
 CASE WHEN (l_orderkey*5+l_linenumber)%17=0 THEN 1 ELSE 0 END AS HEART_DISEASE,
 CASE l_linenumber%7 WHEN 0 THEN 'never' WHEN 1 THEN 'No Info' WHEN 2 THEN 'current' WHEN 3 THEN 'former' WHEN 4 THEN 'ever' WHEN 5 THEN 'not current' ELSE NULL END AS SMOKING_HISTORY,
 CAST(800+(l_orderkey*19+l_partkey*11+l_linenumber*5)%5000 AS DOUBLE)/100 AS BMI,
 CAST(350+(l_orderkey*7+l_partkey*23+l_linenumber)%900 AS DOUBLE)/100 AS HBA1C_LEVEL,
 CAST(40+(l_orderkey*37+l_partkey*3+l_linenumber*11)%420 AS DOUBLE) AS BLOOD_GLUCOSE_LEVEL,
 CASE WHEN (l_orderkey+l_partkey)%9=0 THEN 1 ELSE 0 END AS DIABETES FROM lineitem""",
    "raw_bloodpressure": """
SELECT CASE WHEN (l_orderkey+l_linenumber)%47=0 THEN NULL ELSE concat(' Country_', CAST(l_suppkey%25 AS VARCHAR(20)), ' ') END AS COUNTRY,
 CAST(15+(l_orderkey*13+l_partkey*29+l_linenumber*7)%75 AS BIGINT) AS AGE, CASE WHEN l_suppkey%2=0 THEN 'Male' ELSE ' FEMALE' END AS GENDER,
 CAST(90+(l_orderkey*19+l_partkey*11+l_linenumber*5)%400 AS DOUBLE)/10 AS BMI,
 CAST(95+(l_orderkey*3+l_partkey*41+l_linenumber)%260 AS BIGINT) AS CHOLESTEROL,
 CAST(85+(l_orderkey*17+l_partkey*7+l_linenumber)%120 AS BIGINT) AS SYSTOLIC_BP, CAST(50+(l_orderkey*11+l_partkey*5+l_linenumber*3)%85 AS BIGINT) AS DIASTOLIC_BP,
 CAST(50+(l_orderkey*7+l_partkey)%85 AS BIGINT) AS HEART_RATE, CAST(60+(l_orderkey*5+l_partkey*3)%150 AS BIGINT) AS LDL, CAST((l_orderkey*3+l_partkey*13)%90 AS BIGINT) AS HDL,
 CAST(60+(l_orderkey*29+l_partkey)%480 AS BIGINT) AS TRIGLYCERIDES, CAST(65+(l_orderkey*23+l_partkey*7)%110 AS BIGINT) AS GLUCOSE,
 CASE l_linenumber%4 WHEN 0 THEN 'Current' WHEN 1 THEN 'Former' WHEN 2 THEN ' Never' ELSE 'vape' END AS SMOKING_STATUS,
 CASE l_partkey%4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High ' ELSE NULL END AS PHYSICAL_ACTIVITY_LEVEL,
 CAST((l_orderkey+l_partkey*3)%210 AS DOUBLE)/10 AS ALCOHOL_INTAKE, CAST((l_orderkey*3+l_partkey)%140 AS DOUBLE)/10 AS SALT_INTAKE, CAST(40+(l_orderkey*9+l_partkey)%65 AS DOUBLE)/10 AS SLEEP_DURATION,
 CAST(1+(l_orderkey+l_partkey)%10 AS BIGINT) AS STRESS_LEVEL, CASE WHEN l_orderkey%3=0 THEN TRUE WHEN l_orderkey%3=1 THEN FALSE ELSE NULL END AS FAMILY_HISTORY, l_partkey%5=0 AS DIABETES,
 CASE l_suppkey%3 WHEN 0 THEN 'High' WHEN 1 THEN ' Low' ELSE NULL END AS HYPERTENSION, 'Tertiary ' AS EDUCATION_LEVEL, 'Employed' AS EMPLOYMENT_STATUS FROM lineitem""",
    "raw_mentalhealth": """
SELECT CASE WHEN event_id%53=0 THEN NULL WHEN event_id%59=0 THEN '13/45/2014 11:29' ELSE concat('0',CAST(1+event_id%9 AS VARCHAR(20)),'/',CAST(10+event_id%19 AS VARCHAR(20)),'/',CAST(1960+event_id%60 AS VARCHAR(20)),' 1',CAST(event_id%10 AS VARCHAR(20)),':29') END AS TIMESTAMP_TXT,
 CASE user_id%4 WHEN 0 THEN 'Female' WHEN 1 THEN ' Male' WHEN 2 THEN 'M' ELSE 'nb' END AS GENDER, 'Poland ' AS COUNTRY, CASE event_id%5 WHEN 0 THEN 'Student' WHEN 1 THEN 'Corporate' WHEN 2 THEN 'Housewife' WHEN 3 THEN 'Others' ELSE 'Business' END AS OCCUPATION,
 event_id%7=0 AS SELF_EMPLOYED, event_id%3=0 AS FAMILY_HISTORY, event_id%2=0 AS TREATMENT, event_id%5<2 AS COPING_STRUGGLES,
 CASE event_id%6 WHEN 0 THEN 'Go out Every day' WHEN 1 THEN '1-14 days' WHEN 2 THEN '15-30 days' WHEN 3 THEN '31-60 days' WHEN 4 THEN 'More than 2 months' ELSE NULL END AS DAYS_INDOORS,
 CASE event_id%4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Maybe' ELSE NULL END AS GROWING_STRESS, CASE (event_id*3+user_id)%3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS CHANGES_HABITS,
 CASE (event_id+user_id)%3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS MENTAL_HEALTH_HISTORY, CASE (event_id+user_id)%4 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Low' ELSE NULL END AS MOOD_SWINGS,
 CASE (event_id*5+user_id)%3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS WORK_INTEREST, CASE (event_id*7+user_id*2)%3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS SOCIAL_WEAKNESS,
 CASE event_id%3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END AS MENTAL_HEALTH_INTERVIEW, CASE event_id%3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'Not sure' ELSE 'No' END AS CARE_OPTIONS FROM events""",
    "raw_maternalhealth": """
SELECT CAST(12+(o_orderkey*7+o_custkey)%52 AS BIGINT) AS AGE, CAST(65+(o_orderkey*11+o_custkey*3)%125 AS BIGINT) AS SYSTOLICBP, CAST(38+(o_orderkey*13+o_custkey)%90 AS BIGINT) AS DIASTOLICBP,
 CAST(30+(o_orderkey*3+o_custkey*7)%230 AS DOUBLE)/10 AS BS, CAST(945+(o_orderkey*17+o_custkey)%110 AS DOUBLE)/10 AS BODYTEMP, CAST(45+(o_orderkey*5+o_custkey)%80 AS BIGINT) AS HEARTRATE,
 CASE o_orderkey%4 WHEN 0 THEN ' High Risk' WHEN 1 THEN 'mid risk' WHEN 2 THEN 'Low Risk ' ELSE NULL END AS RISKLEVEL FROM orders""",
    "raw_pcos": """
SELECT CAST(10+(o_orderkey*7+o_custkey)%55 AS BIGINT) AS AGE, CAST((o_orderkey*3+o_custkey)%150 AS DOUBLE)/10 AS ANTI_MULLERIAN_HORMONE, CAST((o_orderkey*11+o_custkey)%300 AS DOUBLE)/10 AS LUTEINIZING_HORMONE,
 CAST((o_orderkey*5+o_custkey*3)%260 AS DOUBLE)/10 AS FOLLICLE_STIMULATING_HORMONE, CAST((o_orderkey*13+o_custkey)%400 AS DOUBLE) AS TOTAL_TESTOSTERONE, CAST(90+(o_orderkey*17+o_custkey)%400 AS DOUBLE)/10 AS BODY_MASS_INDEX,
 CASE WHEN o_orderkey%3=0 THEN TRUE WHEN o_orderkey%3=1 THEN FALSE ELSE NULL END AS FAMILY_HISTORY, CASE o_orderkey%4 WHEN 0 THEN 'Regular' WHEN 1 THEN ' Irregular' WHEN 2 THEN 'irregular' ELSE NULL END AS MENSTRUAL_CYCLE FROM orders""",
    "raw_pcos_infertility": """
SELECT CASE WHEN c_custkey%31=0 THEN NULL ELSE c_custkey END AS PATIENT_FILE_NO, CASE WHEN c_custkey%37=0 THEN NULL WHEN c_custkey%3=0 THEN 1 ELSE 0 END AS PCOS, CAST((c_custkey*97)%110000 AS DOUBLE) AS I_BETA_HCG, CAST((c_custkey*53)%2000 AS DOUBLE)/10 AS II_BETA_HCG, CAST((c_custkey*7)%600 AS DOUBLE)/10 AS AMH FROM customer""",
    "users": """
SELECT concat('u', CAST(c_custkey AS VARCHAR(20))) AS user_id, c_name AS full_name, CASE WHEN c_custkey%6=0 THEN 'bad-email' ELSE concat('u', CAST(c_custkey AS VARCHAR(20)), '@example.com') END AS email,
 DATE '1950-01-01' + CAST(c_custkey%20000 AS INTEGER) AS date_of_birth, CASE c_custkey%3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' ELSE NULL END AS gender, 'active' AS account_status FROM customer""",
    "user_medical_profiles": """
SELECT concat('p', CAST(c_custkey AS VARCHAR(20))) AS profile_id, concat('u', CAST(c_custkey AS VARCHAR(20))) AS user_id,
 CASE WHEN c_custkey%7=0 THEN NULL ELSE CAST(150+c_custkey%50 AS DOUBLE) END AS height_cm, CASE WHEN c_custkey%9=0 THEN NULL ELSE CAST(45+c_custkey%80 AS DOUBLE) END AS weight_kg,
 CASE WHEN c_custkey%4=0 THEN NULL ELSE 'O+' END AS blood_type, c_custkey%3=0 AS has_diabetes, c_custkey%4=0 AS has_hypertension, c_custkey%11=0 AS has_heart_disease, c_custkey%5=0 AS has_mental_health_history, c_custkey%13=0 AS has_pcos,
 CASE c_custkey%4 WHEN 0 THEN 'never' WHEN 1 THEN 'current' ELSE NULL END AS smoking_status, CASE WHEN c_custkey%2=0 THEN 'moderate' ELSE NULL END AS exercise_frequency, c_custkey%17=0 AS is_pregnant, CASE WHEN c_custkey%17=0 THEN 1+CAST(c_custkey%3 AS INTEGER) ELSE NULL END AS pregnancy_trimester
 FROM customer WHERE c_custkey%8<>0""",
    "conversation_history": """
SELECT concat('c', CAST(event_id AS VARCHAR(20))) AS conversation_id, concat('u', CAST(user_id AS VARCHAR(20))) AS user_id, concat('s', CAST(user_id AS VARCHAR(20)), '_', CAST(CAST(floor(event_id/3) AS BIGINT)%4 AS VARCHAR(20))) AS session_id, ts AS message_timestamp,
 CASE event_id%10 WHEN 0 THEN 'I have CHEST PAIN and a stroke scare' WHEN 1 THEN 'severe pain and vision loss since today' WHEN 2 THEN 'headache, fever and a cough, also some stress'
  WHEN 3 THEN concat('My BP is ', CAST(60+event_id%200 AS VARCHAR(20)), '/', CAST(35+event_id%120 AS VARCHAR(20)), ' today') WHEN 4 THEN concat('blood sugar: ', CAST(30+event_id%600 AS VARCHAR(20)), ' and glucose ', CAST(90+event_id%100 AS VARCHAR(20)))
  WHEN 5 THEN concat('my A1C ', CAST(2+event_id%9 AS VARCHAR(20)), '.5 came back') WHEN 6 THEN 'what foods help with cholesterol' WHEN 7 THEN 'anxiety before meetings' WHEN 8 THEN 'pharmacy hours?' ELSE concat('BP 150/95 then 150 / 95, bs ', CAST(100+event_id%300 AS VARCHAR(20))) END AS user_message,
 CASE event_id%4 WHEN 0 THEN 'Risk assessment: 3/5 - Key messages: rest.' WHEN 1 THEN 'I remember your visit. Last time we spoke. Keep walking.' WHEN 2 THEN 'TRIAGE: routine follow-up' ELSE 'Recommended foods: beans' END AS assistant_response,
 CASE event_id%3 WHEN 0 THEN 'LIFESTYLE_DISEASES' WHEN 1 THEN 'MENTAL_HEALTH' ELSE 'WOMEN_WELLNESS' END AS routed_to_domain, CASE event_id%4 WHEN 0 THEN 'emergency' WHEN 1 THEN 'urgent' ELSE 'routine' END AS urgency_level FROM events""",
    "health_metrics": """
SELECT concat('m', CAST(event_id AS VARCHAR(20))) AS metric_id, concat('u', CAST(user_id AS VARCHAR(20))) AS user_id, CASE event_id%4 WHEN 0 THEN 'blood_pressure_systolic' WHEN 1 THEN 'blood_sugar' WHEN 2 THEN 'hba1c' ELSE 'weight' END AS metric_type,
 CASE WHEN event_id%97=0 THEN CAST(0 AS DOUBLE) ELSE CAST(80+(event_id*7)%120 AS DOUBLE) END AS metric_value, CAST(ts AS DATE) AS measurement_date FROM events""",
    "uploaded_documents": """
SELECT concat('d', CAST(p_partkey AS VARCHAR(20))) AS document_id, concat('u', CAST(p_partkey%50 AS VARCHAR(20))) AS user_id,
 CASE p_partkey%6 WHEN 0 THEN 'Blood_Test.pdf' WHEN 1 THEN 'rx_may.pdf' WHEN 2 THEN 'MRI knee.pdf' WHEN 3 THEN 'discharge.pdf' WHEN 4 THEN 'notes.pdf' ELSE 'LAB-result.pdf' END AS original_filename,
 CAST(p_partkey*977 AS BIGINT) AS file_size_bytes, CASE p_partkey%3 WHEN 0 THEN 'completed' WHEN 1 THEN 'pending' ELSE 'failed' END AS processing_status FROM part""",
    "model_predictions": """
SELECT concat('P', CAST(o_orderkey AS VARCHAR(20))) AS patient_id, CASE o_orderkey%3 WHEN 0 THEN 'emergency' WHEN 1 THEN 'urgent' ELSE 'routine' END AS ground_truth_urgency,
 CASE (o_orderkey%3 + CASE WHEN o_custkey%10=0 THEN 1 ELSE 0 END)%4 WHEN 0 THEN 'This patient requires IMMEDIATE EMERGENCY evaluation.' WHEN 1 THEN 'URGENT medical evaluation within 24-48 hours.' WHEN 2 THEN 'ROUTINE follow-up is fine.' ELSE 'Further assessment needed.' END AS model_prediction_raw FROM orders""",
    "model_replies": """
SELECT concat('P', CAST(o_orderkey AS VARCHAR(20))) AS patient_id, CASE o_custkey%4 WHEN 0 THEN 'model_a' WHEN 1 THEN 'model_b' WHEN 2 THEN 'model_c' ELSE 'model_d' END AS model_name,
 CASE WHEN o_orderkey%23=0 THEN 'sorry, no json' ELSE concat('{"score": ', CAST(1+(o_orderkey+o_custkey)%10 AS VARCHAR(20)), ', "urgency_correct": ', CASE WHEN o_orderkey%5=0 THEN 'false' ELSE 'true' END, ', "domain": "diabetes", "reasoning": "r"}') END AS reply FROM orders""",
}

# Which rows appear a second time.
_REPEATED = {
    "raw_diabetes": "WHERE l_orderkey%10=0",
    "raw_bloodpressure": "WHERE l_orderkey%10=0",
    "raw_maternalhealth": "WHERE o_orderkey%10=0",
    "raw_pcos": "WHERE o_orderkey%10=0",
    "raw_pcos_infertility": "WHERE c_custkey%10=0",
}

VIEWS = tuple(_SELECTS)


def view_sql(name: str) -> str:
    """Portable SELECT that yields the named input table."""
    body = _SELECTS[name].strip()
    if name in _REPEATED:
        return f"{body}\nUNION ALL\n{body} {_REPEATED[name]}"
    return body


def register_shared(spark: SparkSession, sf_dir: str) -> None:
    """Expose the shared parquet tables of one scale factor as temporary views."""
    for table in SHARED_TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)


def shared(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table, derived by Spark from the shared tables it reads."""
    text = view_sql(name)
    for table in SHARED_TABLES:
        if f"FROM {table}" in text:
            shared(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(text)
