"""Categories as numbers, fitted and joined by Spark whatever their count."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.operators.ordering import add_positions
from sunledger.session import materialise


def category_index(df: DataFrame, column: str) -> DataFrame:
    """(value, number): the distinct values as text, numbered from 0 in text order; stored."""
    values = df.select(F.col(column).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    numbered = add_positions(values, ["value"], "number")
    return materialise(numbered.select("value", F.col("number").cast("int").alias("number")), "categories")


def with_index(df: DataFrame, column: str, index: DataFrame, name: str) -> DataFrame:
    """``df`` with the number of its category; null for a value that has none.

    Every value has one row in ``index``, so a join neither adds nor drops rows.
    """
    numbers = index.select(F.col("value").alias("_value"), F.col("number").alias(name))
    return df.join(numbers, F.col(column).cast("string") == F.col("_value"), "left").drop("_value")


def one_hot_vector(df: DataFrame, column: str, index: DataFrame, name: str) -> DataFrame:
    """One sparse 0/1 vector column; all zeros for a value that is no category.

    The plan has the same size for any number of categories.
    """
    size = index.count()
    numbered = with_index(df, column, index, "_number").withColumn("_number", F.coalesce("_number", F.lit(size)))
    # Fitted on the largest number alone: the categories themselves stay on the executors.
    last = df.sparkSession.range(size, size + 1).select(F.col("id").cast("int").alias("_number"))
    encoder = OneHotEncoder(inputCols=["_number"], outputCols=[name], dropLast=True).fit(last)
    return encoder.transform(numbered).drop("_number")
