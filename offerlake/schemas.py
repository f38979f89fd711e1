"""Fixed schemas: raw feed records, silver offers, salary rejects."""

from __future__ import annotations

from pyspark.sql import types as T

# Feed A record (JSON array element).  Numbers that may arrive as text are
# declared STRING so both shapes survive parsing; they are coerced later.
FEED_A_RECORD = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("applyUrl", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("exp", T.StringType()),
    T.StructField("edu", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("remote", T.VariantType()),   # bool or text: the raw type matters
    T.StructField("date", T.StringType()),
    T.StructField("profession", T.StructType([
        T.StructField("fr", T.StringType()),
        T.StructField("en", T.StringType()),
        T.StructField("es", T.StringType()),
        T.StructField("cs", T.StringType()),
        T.StructField("sk", T.StringType()),
    ])),
    T.StructField("salMin", T.StringType()),
    T.StructField("salMax", T.StringType()),
    T.StructField("salPer", T.StringType()),
    T.StructField("salCur", T.StringType()),
    T.StructField("status", T.StringType()),
])

# Feed B record (value of the keyed JSON object).
FEED_B_RECORD = T.StructType([
    T.StructField("jk", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("loc", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("kw", T.StringType()),
    T.StructField("snippet", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("jobTypes", T.ArrayType(T.StringType())),
    T.StructField("salary", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("remote", T.VariantType()),   # bool or text: the raw type matters
])

# Landed bronze rows: position in the source document, the key (keyed
# objects) and the record's raw JSON text.
BRONZE_ROWS = T.StructType([
    T.StructField("pos", T.LongType(), False),
    T.StructField("key", T.StringType()),
    T.StructField("raw", T.StringType()),
])

# Fixed values.
SILVER_COLUMNS = [
    "offer_id", "source", "url", "apply_url", "title", "company", "city",
    "departement", "is_idf", "profession", "kw", "contract", "experience",
    "education", "remote", "sal_min_eur", "sal_max_eur", "sal_source_period",
    "has_salary", "posted_date", "date_is_precise", "status", "is_twin",
    "skills", "run_date", "ingested_at",
]

SILVER = T.StructType([
    T.StructField("offer_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("url", T.StringType()),
    T.StructField("apply_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("departement", T.StringType(), False),
    T.StructField("is_idf", T.BooleanType(), False),
    T.StructField("profession", T.StringType()),
    T.StructField("kw", T.StringType()),
    T.StructField("contract", T.StringType(), False),
    T.StructField("experience", T.StringType()),
    T.StructField("education", T.StringType()),
    T.StructField("remote", T.StringType()),
    T.StructField("sal_min_eur", T.IntegerType()),
    T.StructField("sal_max_eur", T.IntegerType()),
    T.StructField("sal_source_period", T.StringType()),
    T.StructField("has_salary", T.BooleanType(), False),
    T.StructField("posted_date", T.StringType()),
    T.StructField("date_is_precise", T.BooleanType(), False),
    T.StructField("status", T.IntegerType()),
    T.StructField("is_twin", T.BooleanType(), False),
    T.StructField("skills", T.ArrayType(T.StringType(), False), False),
    T.StructField("run_date", T.StringType(), False),
    T.StructField("ingested_at", T.StringType(), False),
])

REJECTS = T.StructType([
    T.StructField("offer_id", T.StringType()),
    T.StructField("salary_raw", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("run_date", T.StringType()),
])

# Columns where a whitespace-only string means "absent".
# Fixed values.
OPTIONAL_TEXT_COLUMNS = (
    "title", "url", "apply_url", "company", "city", "profession", "kw",
    "experience", "education", "sal_source_period", "posted_date",
)

# Fixed values.
SOURCES = ("WTTJ", "Indeed")
EXP_BUCKETS = ("Junior (< 3 ans)", "Confirmé (3-5 ans)", "Senior (5+ ans)", "Autre", "Non précisé")
