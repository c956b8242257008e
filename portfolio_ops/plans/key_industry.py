"""Rating facts: extract the key industry from landed JSON, insert only new keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.operators.change import insert_new
from portfolio_ops.operators.filters import required_keys
from portfolio_ops.schemas import KEY_INDUSTRY
from portfolio_ops.sources.landing import json_paths


def extract_key_industry(interim: DataFrame) -> DataFrame:
    found = json_paths(interim, "RECORD_CONTENT", fv.KEY_INDUSTRY_PATHS)
    rows = required_keys(found, ["KEY_INDUSTRY_KEY"])
    rows = rows.withColumn("CREATED_AT", F.current_timestamp().cast("timestamp_ntz"))
    return rows.select(*KEY_INDUSTRY.fieldNames())


def key_industry(interim: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows to append. Rows without an industry key are dropped before the join."""
    return insert_new(stored, extract_key_industry(interim), fv.KEY_INDUSTRY_KEYS)
