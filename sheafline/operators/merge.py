"""Schema consistency, union of conformed datasets, run summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from ..functions.names import col


def schema_consistency(datasets: DataFrame, order: str = "dataset_id") -> DataFrame:
    """Per dataset: are its ordered columns those of the first dataset, and what differs?

    The first column list is a scalar subquery, not a join.
    """
    first = datasets.agg(F.min_by("columns", order)).scalar()
    same = F.col("columns").eqNullSafe(F.col("first_columns"))
    return datasets.withColumn("first_columns", first).select(
        "dataset_id", same.alias("consistent"),
        F.array_except("first_columns", "columns").alias("lacks"),
        F.array_except("columns", "first_columns").alias("extra"))


def _common_type(types: set[str]) -> str | None:
    """The type a column gets when the parts disagree: DOUBLE for numbers, else text."""
    if len(types) == 1:
        return None
    return "double" if types <= {"bigint", "double", "int"} else "string"


def merge_union(parts: dict[str, DataFrame], allow_missing: bool = False,
                dataset: str = "dataset_id") -> DataFrame:
    """All rows of all datasets, tagged with their dataset. Strict about columns by default."""
    frames = list(parts.items())
    first = frames[0][1].columns
    if not allow_missing:
        odd = [name for name, df in frames if df.columns != first]
        if odd:
            raise ValueError(f"datasets with other columns than the first: {odd}")
    kinds: dict[str, set[str]] = {}
    for _, df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    target = {c: _common_type(k) for c, k in kinds.items()}

    def aligned(df: DataFrame) -> DataFrame:
        out = []
        for f in df.schema.fields:
            c = col(f.name)
            if target[f.name] == "string":
                c = numbers.as_text(c, f.dataType)
            elif target[f.name] == "double":
                c = c.cast("double")
            out.append(c.alias(f.name))
        return df.select(*out)

    tagged = [aligned(df).withColumn(dataset, F.lit(name)) for name, df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), tagged)


def merge_total(merged: DataFrame) -> DataFrame:
    return merged.agg(F.count(F.lit(1)).alias("total_rows"))


def run_summary(datasets: DataFrame) -> DataFrame:
    """One row: datasets processed of datasets found."""
    return datasets.agg(F.count_if(F.col("status") == "ok").alias("processed"),
                        F.count(F.lit(1)).alias("found"))


def runs(datasets: DataFrame, outputs: DataFrame) -> DataFrame:
    """The run list: original name, output name, final columns."""
    return datasets.where(F.col("status") == "ok").join(outputs, "dataset_id").select(
        F.col("dataset_id").alias("original"), "harmonized", "columns")

