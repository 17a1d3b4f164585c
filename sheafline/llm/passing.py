"""Scoring a text column in Arrow batches while other columns pass through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT = "__text"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def with_text(rows: DataFrame, keep: tuple[str, ...] | list[str], text: str) -> tuple[DataFrame, int, str]:
    """`keep` and the text column of `rows`, the text's position, and the kept columns as DDL. A text column that is
    kept anyway is not sent twice."""
    out = rows.select(*map(quoted, keep))
    kept = ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in out.schema.fields)
    if text in keep:
        return out, list(keep).index(text), kept
    return rows.select(*map(quoted, keep), quoted(text).alias(TEXT)), len(keep), kept
