"""Table schemas.  Every base table is unique on ``KEY``."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["source", "source_job_id"]

_text = T.StringType()
_time = T.TimestampNTZType()
_list = T.ArrayType(T.StringType())


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


JOBS_RAW = _struct(
    ("source", _text, False),
    ("source_job_id", _text, False),
    ("created_at", _time, False),
    ("search_term", _text, False),
    ("fetched_at", _time, False),
    ("redirect_url", _text, True),
    ("raw_json", _text, False),
)

DESCRIPTIONS_RAW = _struct(
    ("source", _text, False),
    ("source_job_id", _text, False),
    ("redirect_url", _text, True),
    ("scraped_at", _time, False),
    ("html_description", _text, True),
)

JOBS = _struct(
    ("source", _text, False),
    ("source_job_id", _text, False),
    ("posted_at", _time, False),
    ("created_at", _time, False),
    ("job_title", _text, False),
    ("role_title", _text, False),
    ("role_match_method", _text, True),
    ("company", _text, False),
    ("location", _text, True),
    ("min_salary", T.DoubleType(), True),
    ("max_salary", T.DoubleType(), True),
    ("redirect_url", _text, True),
)

JOB_REQUIREMENTS = _struct(
    ("source", _text, False),
    ("source_job_id", _text, False),
    ("technical_tools", _list, True),
    ("technical_concepts", _list, True),
    ("certifications", _list, True),
    ("min_years", T.IntegerType(), True),
    ("max_years", T.IntegerType(), True),
    ("seniority", _text, True),
    ("extraction_status", _text, True),
    ("error", _text, True),
    ("extracted_at", _time, False),
)

TABLES = {
    "jobs_raw": JOBS_RAW,
    "descriptions_raw": DESCRIPTIONS_RAW,
    "jobs": JOBS,
    "job_requirements": JOB_REQUIREMENTS,
}

# Column filled with the load time when a row brings none.
DEFAULT_TIME = {
    "jobs_raw": "fetched_at",
    "descriptions_raw": "scraped_at",
    "jobs": "created_at",
    "job_requirements": "extracted_at",
}

# The fields read from a posting payload.  Salaries stay text until they are
# cast, so that a bad value is an error and not a silent null.
POSTING_PAYLOAD = T.StructType(
    [
        T.StructField("title", _text),
        T.StructField("company", T.StructType([T.StructField("display_name", _text)])),
        T.StructField("location", T.StructType([T.StructField("display_name", _text)])),
        T.StructField("salary_min", _text),
        T.StructField("salary_max", _text),
    ]
)

POSTING_ENVELOPE = T.StructType(
    [
        T.StructField("id", _text),
        T.StructField("created", _text),
        T.StructField("redirect_url", _text),
    ]
)

ROLE_TAXONOMY = T.StructType(
    [
        T.StructField("name", _text),
        T.StructField("aliases", _list),
        T.StructField("search_term", _list),
    ]
)


def required_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]
