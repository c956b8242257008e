"""Vectors that can take part in a search: present, finite, not zero."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """False for a null, empty or zero vector and for null or non-finite components."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def usable_rows(table: DataFrame, label: str | None = None) -> DataFrame:
    """``vec_id, label, dims, vector`` of the rows that take part. Vectors of different
    lengths never meet; a row without id takes no part."""
    marks = [F.col(label).alias("label")] if label else []
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), *marks,
                        F.size("embedding").alias("dims"), F.col("embedding").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
