"""What a folder run knows of each file, kept for later runs.

One row per file: what the survey found, the facts of its columns (counts, type votes, bounds) and its first place names.
A file counts as known while path, modification time, size and the cleaning options are the same. Files that are gone are
in no later state.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Row, SparkSession

from ..operators.clean import CleanOptions
from ..sources.csv import FileState

_COUNTS = ["raw", "values", "hits", "ints", "floats", "plain_fractions", "lifted_fractions", "bigint", "double", "boolean"]
_BOUNDS = ["plain_low", "plain_high", "lifted_low", "lifted_high"]
_FACT = "STRUCT<pos: INT, " + ", ".join([f"`{c}`: BIGINT" for c in _COUNTS] + [f"`{c}`: DOUBLE" for c in _BOUNDS]) + ">"
STATE = f"""path STRING, modified TIMESTAMP, size BIGINT, options STRING, lines BIGINT, decodable BOOLEAN, header STRING, broken BOOLEAN,
    facts ARRAY<{_FACT}>, places ARRAY<STRUCT<name: STRING, places: ARRAY<STRING>>>"""


def fingerprint(options: CleanOptions) -> str:
    return hashlib.sha256(repr(options).encode()).hexdigest()


def read(spark: SparkSession, path: str, options: CleanOptions) -> dict[tuple, Row]:
    """The rows of a state that were found under the same options, by (path, modified, size)."""
    rows = spark.read.schema(STATE).parquet(path).where("options = '" + fingerprint(options) + "'")
    return {(r.path, r.modified, r.size): r for r in rows.collect()}  # one row per file


def facts(dataset: str, row: Row) -> list[Row]:
    return [Row(dataset_id=dataset, **f.asDict()) for f in row.facts or []]


def places(row: Row) -> dict[str, list[str]]:
    return {p.name: p.places for p in row.places or []}


def table(spark: SparkSession, options: CleanOptions, files: list[FileState], found: list[Row], named: dict[str, dict[str, list[str]]]) -> DataFrame:
    own: dict[str, list] = {}
    for r in found:
        values = r.asDict()
        own.setdefault(r.dataset_id, []).append(tuple(values.get(c) for c in ["pos", *_COUNTS, *_BOUNDS]))
    rows = [(f.path, f.modified, f.size, fingerprint(options), f.facts.lines, f.facts.decodable, f.facts.header, f.facts.broken,
             own.get(f.dataset_id, []), list(named.get(f.dataset_id, {}).items())) for f in files if f.facts is not None]
    return spark.createDataFrame(rows, STATE)


def write(spark: SparkSession, path: str, options: CleanOptions, files: list[FileState], found: list[Row], named: dict[str, dict[str, list[str]]]) -> None:
    """A state is complete or not there: the path must be new."""
    table(spark, options, files, found, named).write.parquet(path)
