"""User functions: registration for SQL and for DataFrames."""

from __future__ import annotations

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def make_capitalise():
    """Arrow function: first letter upper, the rest lower.

    Built inside a function so that it travels to the workers by value and
    they need no copy of this package.
    """

    def initials(text: pd.Series) -> pd.Series:
        return text.str[:1].str.upper() + text.str[1:].str.lower()

    return F.pandas_udf(initials, "string")


def register_user_functions(spark: SparkSession) -> None:
    """Make the library's user functions callable from SQL text."""
    spark.udf.register("capitalise", make_capitalise())


def vector_hot_index(column: str) -> Column:
    """Index of the 1.0 in a one-hot vector column, from 0; NULL if none."""
    place = F.array_position(vector_to_array(F.col(column)), F.lit(1.0))
    return F.nullif(place, F.lit(0)) - 1
