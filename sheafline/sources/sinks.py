"""Sinks: one folder per dataset, records as JSON lines, the schema document.

`write_tables` and `write_sidecars` write any number of datasets in one job: rows are dealt out by ranges of (dataset, order), so a
large dataset is written by several tasks, and every task has one file open at a time. What was written is listed in a
manifest, which comes last; readers that go by it see all of a dataset or nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack

import pyarrow as pa
import pyarrow.csv
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import files
from ..functions.names import col
from ..functions.session import materialize
from ..operators.unify import SCHEMA_TYPE, UnifiedSchema

DATASET = "dataset_id"


def write_datasets(frames: dict[str, DataFrame], folder: str, names: dict[str, str] | None = None,
                   fmt: str = "parquet", mode: str = "errorifexists", at_once: int = 8) -> dict[str, str]:
    """Write each dataset below `folder`; returns its status. One whose target exists or is forbidden is
    skipped; any other failure is raised.

    Up to `at_once` writes run side by side, so many small datasets keep the cluster busy.
    """
    names = names or {}

    def write(dataset: str) -> str:
        writer = frames[dataset].write.mode(mode)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        try:
            writer.format(fmt).save(f"{folder}/{names.get(dataset, dataset)}")
            return "ok"
        except (PySparkException, PermissionError) as e:
            why = _refused(e)
            if why is None:
                raise
            return f"skipped: {why}"

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(frames, pool.map(write, frames)))


def _refused(e: Exception) -> str | None:
    """Why a target cannot be written, if the target is the reason."""
    if isinstance(e, PySparkException) and e.getCondition() == "PATH_ALREADY_EXISTS":
        return "exists"
    if isinstance(e, PermissionError) or re.search("Permission denied|AccessControlException|AccessDenied", str(e)):
        return "forbidden"
    return None


def write_merged(merged: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """All datasets in one table, one partition folder per dataset; a large dataset keeps its files."""
    merged.write.mode(mode).partitionBy(DATASET).format(fmt).save(path)


def record_json(records: DataFrame) -> DataFrame:
    """(dataset_id, record): each catalog record as one JSON line."""
    fields = [c for c in records.columns if c != DATASET]
    return records.select(DATASET, F.to_json(F.struct(*fields)).alias("record"))


def write_records(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The catalog as JSON lines."""
    record_json(records).select("record").write.mode(mode).text(path)


MANIFEST = "_manifest"
_WRITTEN = f"{DATASET} STRING, file STRING, row_count BIGINT, status STRING"


def _written(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=[DATASET, "file", "row_count", "status"])


def _taken(spark: SparkSession, folder: str, depth: str) -> DataFrame | None:
    """Names in a folder that exist before anything is written: a repeated task must not take its own files for others'."""
    if not files.exists(folder):
        return None
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("_metadata.file_path")
    def decoded(c):
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    step = decoded(decoded(F.regexp_extract("file_path", depth, 1)))  # a name is encoded as a file, and that as a URI
    return materialize(found.select(step.alias("_name")).where("_name <> ''").distinct())


def _finish(spark: SparkSession, written: DataFrame, skipped: DataFrame | None, folder: str) -> DataFrame:
    """Runs the writing job and commits its manifest."""
    whole = written if skipped is None else written.unionByName(skipped)
    whole.write.mode("append").parquet(f"{folder}/{MANIFEST}")
    return spark.read.schema(_WRITTEN).parquet(f"{folder}/{MANIFEST}")


def _apart(rows: DataFrame, folder: str, name, depth: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows with `_name`, without those whose target exists, and a manifest of the latter."""
    rows = rows.withColumn("_name", name)
    taken = _taken(rows.sparkSession, folder, depth)
    if taken is None:
        return rows, None
    left = rows.join(taken.withColumnRenamed("_name", "_taken"), F.col("_name") == F.col("_taken"), "left")
    held = left.where("_taken IS NOT NULL").select(DATASET).distinct().select(
        DATASET, F.lit(None).cast("string").alias("file"), F.lit(None).cast("bigint").alias("row_count"), F.lit("skipped: exists").alias("status"))
    return left.where("_taken IS NULL").drop("_taken"), held


def write_sidecars(records: DataFrame, folder: str, names: dict[str, str] | None = None, suffix: str = "_metadata.json") -> DataFrame:
    """One JSON file per dataset, all in one job; returns the manifest (dataset_id, file, row_count, status).

    A dataset whose file exists is skipped and says so, one whose file may not be written too; other failures raise.
    """
    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for dataset, name, record in zip(*(batch.column(i).to_pylist() for i in range(3))):
                file = files.file_name(name) + suffix
                try:
                    with files.whole(f"{folder}/{file}") as out:
                        out.write(record.encode())
                    done.append((dataset, file, 1, "ok"))
                except PermissionError:
                    done.append((dataset, None, None, "skipped: forbidden"))
            yield _written(done)

    spark = records.sparkSession
    name = _named(names)
    ready, held = _apart(record_json(records), folder, name, rf"([^/]*){re.escape(suffix)}$")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = ready.select(DATASET, "_name", "record").repartitionByRange(tasks, DATASET)
    return _finish(spark, dealt.mapInArrow(save, _WRITTEN), held, folder)


def _named(names: dict[str, str] | None):
    """The output name of each dataset; that of the dataset itself unless `names` has another."""
    if not names:
        return F.col(DATASET)
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.col(DATASET)), F.col(DATASET))


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset_id, record): the files that the manifest lists."""
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [files.read(f"{folder}/{f}").decode() for f in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[DATASET, "record"])

    listed = spark.read.schema(_WRITTEN).parquet(f"{folder}/{MANIFEST}").where("status = 'ok'").select(DATASET, "file")
    return listed.repartition(spark.sparkContext.defaultParallelism).mapInArrow(load, f"{DATASET} STRING, record STRING")


def write_tables(rows: DataFrame, folder: str, names: dict[str, str] | None = None, fmt: str = "parquet", order: str | None = None,
                 columns: str | None = None) -> DataFrame:
    """The rows of many datasets, each below a folder of its own, in one job; returns the manifest with a row per file.

    `order` names a column that orders the rows of a dataset and is not written itself, `columns` one with the names of the dataset's own columns,
    if not all datasets have all. Tasks write `part-<task>` files, one at a time, so memory holds a batch. Targets that
    exist or are forbidden are skipped; other failures raise.
    """
    data = [c for c in rows.columns if c not in (DATASET, order, columns)]
    if not data:
        raise ValueError("no column to write")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, now, done = TaskContext.get().partitionId(), None, []
        stack, writer, count, file = ExitStack(), None, 0, None

        def close() -> None:
            stack.close()
            if now is not None:
                done.append((now, file, count, "ok") if writer is not None else (now, None, None, "skipped: forbidden"))

        try:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                at = 0
                while at < len(ids):
                    end = at + 1
                    while end < len(ids) and ids[end] == ids[at]:
                        end += 1
                    part = batch.slice(at, end - at)
                    if ids[at] != now:
                        close()
                        now, count, writer = ids[at], 0, None
                        own = part.column(2)[0].as_py() if columns else data
                        file = f"{files.file_name(part.column(1)[0].as_py())}/part-{task:05d}.{fmt}"
                        schema = pa.schema([batch.schema.field(c) for c in own])
                        try:
                            out = stack.enter_context(files.whole(f"{folder}/{file}"))
                            make = pa.parquet.ParquetWriter if fmt == "parquet" else pa.csv.CSVWriter
                            writer = stack.enter_context(make(out, schema))
                        except PermissionError:
                            stack.pop_all()
                    if writer is not None:
                        writer.write_table(pa.Table.from_batches([part.select(own)], schema))
                    count += end - at
                    at = end
            close()
        except BaseException:
            stack.pop_all()  # an unfinished file keeps its working name
            raise
        yield _written(done)

    spark = rows.sparkSession
    ready, held = _apart(rows, folder, _named(names), rf"{re.escape(folder.rstrip('/').split('/')[-1])}/([^/]*)/[^/]*$")
    by = [order] if order else [F.spark_partition_id()]
    ready = ready.select(DATASET, "_name", *([columns] if columns else []), *[col(c) for c in data], *[F.struct(*by).alias("_order")])
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = ready.repartitionByRange(tasks, DATASET, "_order").sortWithinPartitions(DATASET, "_order").drop("_order")
    return _finish(spark, dealt.mapInArrow(save, _WRITTEN), held, folder)


def read_schema(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Schema documents as rows of the schema type; key order is kept.

    One (indented) document per file, or with `lines` one document per line.
    """
    return spark.read.schema(SCHEMA_TYPE).option("multiLine", not lines).json(path)


def write_schema(spark: SparkSession, schema: UnifiedSchema, path: str, mode: str = "errorifexists") -> None:
    """The schema document as one JSON line."""
    document = " ".join(line.strip() for line in schema.to_json().splitlines())
    spark.createDataFrame([(document,)], "value STRING").coalesce(1).write.mode(mode).text(path)
