"""New files of a known layout, conformed as they arrive.

Cleaning and conforming are projections once the profile and the mapping are known, so the same
functions run on a streaming DataFrame. What needs a finished table - profile, schema, statistics -
comes from an earlier batch run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.clean import CleanOptions, TableProfile, apply_profile
from ..operators.conform import conform, failing_by_profile
from ..operators.unify import UnifiedSchema


def conform_stream(stream: DataFrame, prof: TableProfile, schema: UnifiedSchema, mapping: dict[str, str],
                   ids: tuple[str, ...] = (), options: CleanOptions | None = None) -> DataFrame:
    """Clean and conform a stream with a known profile and mapping; no state, no shuffle."""
    cleaned = apply_profile(stream, prof, ids, options)
    return conform(cleaned, schema, mapping, ids, failing=failing_by_profile(prof, mapping)).df
