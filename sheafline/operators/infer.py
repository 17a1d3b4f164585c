"""Strict type inference: a text column gets a type only when every value fits it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults
from ..functions import numbers
from ..functions.names import col

# Spellings of truth values in data files (fixed values).
TRUE_TEXT = ["True", "TRUE", "true"]
FALSE_TEXT = ["False", "FALSE", "false"]


def read_nulls(c: Column, nulls=None) -> Column:
    """NULL for cells that the reader takes as missing."""
    return F.when(~c.isin(list(defaults.READ_NULLS if nulls is None else nulls)), c)


def type_tests(c: Column) -> dict[str, Column]:
    """Aggregates that count how many values fit each type."""
    bare = F.trim(c)
    return {
        "bigint": F.count_if(bare.rlike(numbers.INTEGER) & bare.try_cast("bigint").isNotNull()),
        "double": F.count_if(bare.rlike(numbers.NUMBER)),
        "boolean": F.count_if(c.isin(TRUE_TEXT + FALSE_TEXT)),
    }


def strict_type(n: int, n_bigint: int, n_double: int, n_boolean: int) -> str:
    """The type that all `n` values fit; a column without values counts as DOUBLE."""
    for kind, fit in (("bigint", n_bigint if n else -1), ("double", n_double), ("boolean", n_boolean)):
        if fit == n:
            return kind
    return "string"


def infer_types(df: DataFrame, nulls=None, keep_text: tuple[str, ...] = ()) -> DataFrame:
    """One row per column: position, name, values, inferred type. One aggregate over the cells."""
    cells = F.array(*[F.struct(F.lit(i).cast("bigint").alias("col_pos"), F.lit(c).alias("column"), col(c).alias("raw"))
                      for i, c in enumerate(df.columns)])
    long = df.select(F.explode(cells).alias("cell")).select("cell.col_pos", "cell.column", read_nulls(F.col("cell.raw"), nulls).alias("v"))
    n, v = F.col("n"), F.col("v")
    counted = long.groupBy("col_pos", "column").agg(F.count(v).alias("n"), *[t.alias(k) for k, t in type_tests(v).items()])
    kind = (F.when(F.col("column").isin(list(keep_text)), F.lit("string"))
            .when(n == 0, F.lit("double")).when(F.col("bigint") == n, F.lit("bigint"))
            .when(F.col("double") == n, F.lit("double")).when(F.col("boolean") == n, F.lit("boolean"))
            .otherwise(F.lit("string")))
    return counted.select("col_pos", "column", n.alias("n_values"), kind.alias("inferred_type"))


def parse(c: Column, dtype: T.DataType) -> Column:
    """A text cell (missing values already NULL) as its inferred type."""
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNotNull(), c.isin(TRUE_TEXT))
    return c if isinstance(dtype, T.StringType) else F.trim(c).try_cast(dtype)


def typed(df: DataFrame, types: dict[str, str], nulls=None) -> DataFrame:
    """Apply inferred types to an all-text table."""
    return df.select(*[parse(read_nulls(col(c), nulls), spark_type(types.get(c, "string"))).alias(c)
                       for c in df.columns])


def infer_and_type(df: DataFrame, nulls=None, keep_text: tuple[str, ...] = ()) -> DataFrame:
    """Infer, then cast (collects one row per column)."""
    return typed(df, {r["column"]: r["inferred_type"] for r in infer_types(df, nulls, keep_text).collect()}, nulls)


def spark_type(kind: str) -> T.DataType:
    return {"bigint": T.LongType(), "double": T.DoubleType(),
            "boolean": T.BooleanType()}.get(kind, T.StringType())
