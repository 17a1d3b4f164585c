"""The ledger of dataset names: a table with a version per run, the latest complete one counts."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ..functions import files

COLUMNS = "dataset_id STRING, slug STRING, name STRING"


def versions(folder: str) -> list[int]:
    """Numbers of the complete versions, in order."""
    store, name = files.opened(folder)
    found = store.get_file_info(fs.FileSelector(name, allow_not_found=True))
    numbers = [int(m[1]) for f in found if (m := re.fullmatch(r"v([0-9]{1,9})", f.base_name))]
    return sorted(n for n in numbers if files.exists(f"{folder}/v{n}/_SUCCESS"))


def read(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame | None:
    """(dataset_id, slug, name) of a version, the latest by default; None before the first run."""
    known = versions(folder)
    return spark.read.schema(COLUMNS).parquet(f"{folder}/v{version or known[-1]}") if known else None


def write(names: DataFrame, folder: str) -> int:
    """Adds the outcome of a run as the next version. Of two runs at once, the later one fails."""
    number = (versions(folder) or [0])[-1] + 1
    names.selectExpr("CAST(dataset_id AS STRING) AS dataset_id", "slug", "name").write.parquet(f"{folder}/v{number}")
    return number
