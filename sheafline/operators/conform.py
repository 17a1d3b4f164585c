"""Conforming a cleaned table to the unified schema: rename, cast, reorder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults
from ..functions import numbers
from ..functions.names import col, unique_names
from .clean import TableProfile
from .match import resolve_columns
from .unify import UnifiedSchema


@dataclass
class Conformed:
    """`mapping` is original -> standard; `issues` lists (column, target type) left as they were."""

    df: DataFrame
    mapping: dict[str, str]
    issues: list[tuple[str, str]]


def columns_table(df: DataFrame, dataset_id: str, ids: tuple[str, ...] = ()) -> DataFrame:
    data = [c for c in df.columns if c not in ids]
    return df.sparkSession.createDataFrame(
        [(dataset_id, i, c) for i, c in enumerate(data)], "dataset_id STRING, col_pos BIGINT, name STRING")


def rename_project(df: DataFrame, mapping: dict[str, str], on_collision: str = "suffix",
                   ids: tuple[str, ...] = ()) -> DataFrame:
    """Rename mapped columns, keep the others. Two sources of one standard never share a name:
    the later gets a suffix, or both are merged with `on_collision="coalesce"`."""
    data = [c for c in df.columns if c not in ids]
    targets = [mapping.get(c, c) for c in data]
    if on_collision == "coalesce":
        groups: dict[str, list[str]] = {}
        for source, target in zip(data, targets):
            groups.setdefault(target, []).append(source)
        types = {f.name: f.dataType for f in df.schema.fields}
        merged = []
        for target, sources in groups.items():
            same = len({types[s] for s in sources}) == 1
            parts = [col(s) if same else numbers.as_text(col(s), types[s]) for s in sources]
            merged.append((parts[0] if len(parts) == 1 else F.coalesce(*parts)).alias(target))
        return df.select(*[col(c) for c in ids], *merged)
    names = unique_names(targets, on_collision)
    return df.select(*[col(c) for c in ids], *[col(s).alias(n) for s, n in zip(data, names)])


def integer_fits(c: Column, dtype: T.DataType) -> Column:
    """Aggregate: may the whole column become BIGINT (no fraction, no overflow)?"""
    d = numbers.coerce_double(c, dtype)
    return F.coalesce(F.bool_and(d.isNull() | numbers.is_whole(d)), F.lit(True))


def to_integer(c: Column, dtype: T.DataType) -> Column:
    """BIGINT value of one cell; only valid where `integer_fits` holds."""
    if isinstance(dtype, T.StringType):
        bare = F.trim(c)
        exact = F.when(bare.rlike(numbers.INTEGER), bare.try_cast("bigint"))
        return F.coalesce(exact, numbers.coerce_double(c, dtype).try_cast("bigint"))
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    if isinstance(dtype, T.BooleanType):
        return c.cast("bigint")
    return numbers.coerce_double(c, dtype).try_cast("bigint")


def to_float(c: Column, dtype: T.DataType) -> Column:
    return numbers.coerce_double(c, dtype)


def to_string(c: Column, dtype: T.DataType, null_as_text: str | None = None) -> Column:
    out = numbers.as_text(c, dtype)
    return out if null_as_text is None else F.coalesce(out, F.lit(null_as_text))


def failing_integers(df: DataFrame, columns: list[str]) -> set[str]:
    """The columns that must not become BIGINT; one aggregate for all that need a look."""
    types = {f.name: f.dataType for f in df.schema.fields}
    unsure = [c for c in columns if not isinstance(types[c], (T.IntegralType, T.BooleanType))]
    if not unsure:
        return set()
    fits = df.agg(*[integer_fits(col(c), types[c]).alias(f"f{i}") for i, c in enumerate(unsure)]).first()
    return {c for i, c in enumerate(unsure) if not fits[i]}


def failing_by_profile(prof: TableProfile, mapping: dict[str, str]) -> set[str]:
    """The same answer, under final names, from the cleaning profile: no job."""
    names = unique_names([mapping.get(c.name, c.name) for c in prof.kept])
    return {name for name, c in zip(names, prof.kept) if not c.fits_integer}


def cast_types(df: DataFrame, column_types: dict[str, str], null_as_text: str | None = None,
               failing: set[str] | None = None) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Cast the columns that have a target type; unknown types leave a column untouched.

    An integer target with any fractional value leaves the whole column as it was and is reported.
    `failing` spares the guard job when the answer is known (e.g. for a stream).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    wanted = {c: column_types[c] for c in df.columns if c in column_types}
    if failing is None:
        failing = failing_integers(df, [c for c, t in wanted.items() if t == "integer"])
    out, issues = [], []
    for c in df.columns:
        target = wanted.get(c)
        if target == "integer" and c in failing:
            issues.append((c, target))
            out.append(col(c))
        elif target == "integer":
            out.append(to_integer(col(c), types[c]).alias(c))
        elif target == "float":
            out.append(to_float(col(c), types[c]).alias(c))
        elif target == "string":
            out.append(to_string(col(c), types[c], null_as_text).alias(c))
        else:
            out.append(col(c))
    return df.select(*out), issues


def reorder(df: DataFrame, standards: list[str], ids: tuple[str, ...] = ()) -> DataFrame:
    """Ids, then standards in schema order, then the extra columns in file order."""
    data = [c for c in df.columns if c not in ids]
    first = [s for s in standards if s in data]
    return df.select(*[col(c) for c in [*ids, *first, *[c for c in data if c not in first]]])


def resolve_table(df: DataFrame, schema: UnifiedSchema, ids: tuple[str, ...] = (),
                  min_score: int = defaults.RESOLVE_SCORE) -> dict[str, str]:
    """original -> standard for one table (collects one row per column)."""
    columns = columns_table(df, "", ids)
    found = resolve_columns(columns, schema.variations(df.sparkSession), min_score)
    return {r.original: r.standard for r in found.orderBy("col_pos").collect()}


def conform(df: DataFrame, schema: UnifiedSchema, mapping: dict[str, str] | None = None,
            ids: tuple[str, ...] = (), null_as_text: str | None = None, on_collision: str = "suffix",
            failing: set[str] | None = None) -> Conformed:
    """Rename to the standards, cast to their types, put them in schema order."""
    mapping = resolve_table(df, schema, ids) if mapping is None else mapping
    renamed = rename_project(df, mapping, on_collision, ids)
    types = {c: t for c, t in schema.column_types.items() if c not in ids}
    cast, issues = cast_types(renamed, types, null_as_text, failing)
    return Conformed(reorder(cast, list(schema.column_mappings), ids), mapping, issues)
