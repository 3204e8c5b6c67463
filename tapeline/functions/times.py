"""Time text of events, runs and manifests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strict manifest time and run-id stamp.
STRICT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
MILLIS = r"\.\d+Z$"
RUN_STAMP = r"(\d{8})_(\d{6})"
ZONED = r"(Z|[+-]\d{2}:?\d{2})$"


def event_time(text: Column) -> Column:
    """ISO time with ``Z`` or an offset; a naive one is UTC; NULL when unreadable."""
    zoned = F.when(text.rlike(ZONED), text).otherwise(F.concat(text, F.lit("Z")))
    return F.try_to_timestamp(zoned)


def run_time(run_id: Column) -> Column:
    """Time stamp (UTC) inside a run id such as ``run_20240102_030405``."""
    digits = F.concat(F.regexp_extract(run_id, RUN_STAMP, 1), F.regexp_extract(run_id, RUN_STAMP, 2), F.lit("Z"))
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmssX"))


def created_at_code(text: Column) -> Column:
    """OK, MILLIS, FORMAT or MISSING for a strict ``YYYY-MM-DDTHH:MM:SSZ`` field."""
    return (
        F.when(text.isNull(), "MISSING").when(text.rlike(MILLIS), "MILLIS").when(~text.rlike(STRICT), "FORMAT").otherwise("OK")
    )
