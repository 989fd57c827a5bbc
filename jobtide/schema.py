"""Canonical schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _DBL, _INT = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LOCATION = _struct(
    ("display_name", _STR), ("area", T.ArrayType(_STR)), ("country", _STR), ("latitude", _DBL), ("longitude", _DBL)
)
SALARY = _struct(("min", _DBL), ("max", _DBL), ("currency", _STR), ("is_predicted", T.BooleanType()))
CONTRACT = _struct(("type", _STR), ("time", _STR))

#: One collected posting as it is stored in the raw zone (one JSON record per line).
RAW_POSTING = _struct(
    ("job_id", _STR), ("source", _STR), ("source_id", _STR), ("title", _STR), ("company", _STR),
    ("description", _STR), ("location", LOCATION), ("salary", SALARY), ("contract", CONTRACT),
    ("category", _STR), ("url", _STR), ("posted_date", _STR), ("search_query", _STR), ("ingested_at", _STR),
)

#: What a raw JSON line may hold, in either shape. Objects arrive as their JSON text in a text field, so one schema reads
#: nested and flat records, also mixed in one file.
RAW_LINE = _struct(
    *[(name, _STR) for name in RAW_POSTING.fieldNames()],
    ("country", _STR), ("salary_min", _STR), ("salary_max", _STR), ("salary_is_predicted", _STR), ("redirect_url", _STR),
    ("latitude", _STR), ("longitude", _STR), ("contract_type", _STR), ("contract_time", _STR), ("extracted_skills", T.ArrayType(_STR)),
)

#: One posting as the collection API delivers it.
API_PAYLOAD = _struct(
    ("id", _STR), ("title", _STR), ("company", _struct(("display_name", _STR))), ("description", _STR),
    ("location", _struct(("display_name", _STR), ("area", T.ArrayType(_STR)))),
    ("salary_min", _DBL), ("salary_max", _DBL), ("salary_is_predicted", _INT),
    ("contract_type", _STR), ("contract_time", _STR), ("category", _struct(("label", _STR), ("tag", _STR))),
    ("redirect_url", _STR), ("created", _STR), ("latitude", _DBL), ("longitude", _DBL),
)

#: Cleaned postings, partitioned by year and month.
JOBS = _struct(
    ("job_id", _STR), ("title", _STR), ("company", _STR), ("description", _STR), ("location", _STR),
    ("country", _STR), ("salary_min_usd", _DBL), ("salary_max_usd", _DBL), ("salary_mid_usd", _DBL),
    ("category", _STR), ("url", _STR), ("posted_date", T.DateType()), ("extracted_skills", T.ArrayType(_STR)),
    ("skill_count", _INT), ("year", _INT), ("month", _INT),
)

#: One row per posting and skill, partitioned by year and month.
JOB_SKILLS = _struct(
    ("job_id", _STR), ("posted_date", T.DateType()), ("country", _STR), ("salary_mid_usd", _DBL),
    ("skill", _STR), ("year", _INT), ("month", _INT),
)

#: The bulk-import twins keep the raw salary name and a timestamp.
BULK_JOBS = _struct(
    ("job_id", _STR), ("title", _STR), ("company", _STR), ("description", _STR), ("location", _STR),
    ("salary_min", _DBL), ("salary_max", _DBL), ("salary_mid", _DBL), ("posted_date", T.TimestampType()),
    ("extracted_skills", T.ArrayType(_STR)), ("skill_count", _INT), ("source", _STR), ("ingested_at", _STR),
    ("year", _INT), ("month", _INT),
)
BULK_JOB_SKILLS = _struct(
    ("job_id", _STR), ("posted_date", T.TimestampType()), ("salary_mid", _DBL), ("skill", _STR),
    ("country", _STR), ("year", _INT), ("month", _INT),
)

PARTITIONS = ("year", "month")
