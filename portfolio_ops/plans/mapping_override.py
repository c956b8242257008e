"""Landing of the section-mapping override table: defaults, then soft delete."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.functions.exprs import is_true
from portfolio_ops.schemas import MAPPING_OVERRIDE
from portfolio_ops.sources.landing import with_defaults
from portfolio_ops.sources.snapshot import select_for


def land_mapping_override(records: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """``defaults``: who and what created a row, for CREATED_BY, CREATED_FROM and SOURCE_NAME."""
    filled = with_defaults(records, {"CREATED_AT": F.current_timestamp(), **defaults})
    return select_for(filled, MAPPING_OVERRIDE)


def live_overrides(landed: DataFrame) -> DataFrame:
    """Rows not marked deleted; a missing mark counts as not deleted."""
    return landed.filter(~is_true(F.col("IS_DELETED")))
