"""Tolerant CSV source: headers as data, no aborted runs, one scan per distinct header.

A survey reads the folder once as lines and tells, per file, its first line, whether every line is valid
UTF-8, how many lines there are, and whether quotes stay open at the end of a line. Files that cannot be
used are reported, not raised. A file is named by its path below the deepest folder that holds all files. Data is then read
all-text with an explicit schema plus SPARE overflow columns, so rows with too many fields can be told apart from short rows,
which are padded with NULL.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from functools import cached_property, reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults
from ..functions.names import unique_names

SPARE = 8  # fields beyond a file's columns that are looked at: a row with a value in one is too long
OVERFLOW = [f"_overflow{i}" for i in range(SPARE)]
DATASET = "dataset_id"


def parse_header(line: str) -> list[str]:
    """Column names of a header line: blanks are named by position, repeats get a suffix."""
    cells = next(csv.reader([line.removeprefix("\ufeff")]), [])
    return unique_names([c if c.strip() else f"Unnamed: {i}" for i, c in enumerate(cells)])


def _reader(spark: SparkSession, pattern: str, recursive: bool):
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)


def _plain(uri: Column) -> Column:
    """A local file is listed as file:///x, and file:/x in the metadata of its rows; spaces and the like are encoded in both."""
    return F.regexp_replace(uri, "^file:/+", "file:/")


def listing(spark: SparkSession, folder: str, pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """(path, modified, size) of every file that is not empty; contents are not read."""
    found = _reader(spark, pattern, recursive).format("binaryFile").load(folder)
    return found.select(_plain(F.col("_metadata.file_path")).alias("path"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def survey(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """(path, lines, decodable, header, broken) per file that is not empty: number of lines, whether all are
    valid UTF-8, the first line with text, and whether some line leaves a quote open.

    One aggregate over the lines; a huge file costs one partial row per task.
    """
    lines = _reader(spark, pattern, recursive).text(folder).select(
        "value", _plain(F.col("_metadata.file_path")).alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")).alias("at"))
    has_text = F.trim(F.regexp_replace("value", "^\ufeff", "")) != ""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("lines"), F.bool_and(F.is_valid_utf8("value")).alias("decodable"),
        F.min_by("value", F.when(has_text, F.col("at"))).alias("header"), F.bool_or(quotes % 2 == 1).alias("broken"))


def _readable(uri: str) -> str:
    """A file URI from `_metadata` as a reader path: decoded, with glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def read_text_table(spark: SparkSession, paths: list[str], columns: list[str], bad_rows: str = "drop_long",
                    multi_line: bool = False, with_order: bool = False, root: str | None = None) -> DataFrame:
    """All-text rows of files that share `columns`, tagged with their `dataset_id`.

    `bad_rows`: `drop_long` drops rows with more fields than the header, `quarantine` returns only
    those. `multi_line` allows line breaks inside quotes, at the price of unsplittable files.
    `with_order` adds `row_order`, which sorts the rows of a file as they stand in it. `root` is the folder URI
    below which paths name the files; without it, base names do.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *OVERFLOW]])
    raw = (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("escape", '"')
           .option("mode", "PERMISSIVE").option("maxColumns", max(20480, len(schema) + 1)).option("multiLine", multi_line).csv([_readable(p) for p in paths]))
    surplus = F.coalesce(*OVERFLOW)
    keep = surplus.isNotNull() if bad_rows == "quarantine" else surplus.isNull()
    tags = [_dataset(root).alias(DATASET)]
    if with_order:
        tags.append(_order().alias("row_order"))
    named = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return raw.select(*tags, *named, *OVERFLOW).where(keep).drop(*OVERFLOW)


def _dataset(root: str | None) -> Column:
    """The name of a row's file. It comes percent-encoded; a plus sign stands for itself there."""
    named = F.col("_metadata.file_name") if root is None else F.substring(_plain(F.col("_metadata.file_path")), len(root) + 1, 1 << 30)
    return F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B")))


def _order() -> Column:
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))


NARROW = 64  # files of up to so many columns are read together; wider ones by powers of two


def read_cells(spark: SparkSession, paths: list[str] | str, width: int, multi_line: bool, root: str, pattern: str = "*",
               recursive: bool = False) -> DataFrame:
    """(dataset_id, cells ARRAY<STRING>, extra, at): the rows of files with any headers of up to `width` columns, in one
    scan. Cells beyond a row's fields are NULL; `extra` tells that a row had more than `width` fields."""
    names = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, *OVERFLOW]])
    raw = (_reader(spark, pattern, recursive).schema(schema).option("header", True).option("encoding", "UTF-8").option("escape", '"')
           .option("mode", "PERMISSIVE").option("maxColumns", max(20480, len(schema) + 1)).option("multiLine", multi_line)
           .csv(paths if isinstance(paths, str) else [_readable(p) for p in paths]))
    return raw.select(_dataset(root).alias(DATASET), F.array(*names).alias("cells"), F.coalesce(*OVERFLOW).isNotNull().alias("extra"), _order().alias("at"))


@dataclass(frozen=True)
class FileState:
    dataset_id: str
    path: str
    lines: int
    status: str        # `ok`, or why the file is skipped
    modified: object = None
    size: int = 0
    facts: object = None   # its row of the survey


@dataclass(frozen=True)
class Group:
    """Files that are read alike: one header, and line breaks inside quotes or not."""

    paths: list[str]
    columns: list[str]
    multi_line: bool


@dataclass
class Folder:
    """`files`: what became of each file. `groups`: the usable ones by how they are read."""

    spark: SparkSession
    root: str
    files: list[FileState]
    groups: list[Group]
    folder: str = ""
    pattern: str = "*"
    recursive: bool = False

    def _read(self, group: Group, paths: list[str], options: dict) -> DataFrame:
        return read_text_table(self.spark, paths, group.columns, root=self.root, **{"multi_line": group.multi_line} | options)

    def tables(self, **options) -> list[DataFrame]:
        """One all-text table per group; `dataset_id` tells the files apart."""
        return [self._read(group, group.paths, options) for group in self.groups]

    def datasets(self, **options) -> dict[str, DataFrame]:
        """One all-text table per usable file, without tags; nothing is read yet."""
        return {name: self.dataset(name, **options) for name in self.heads()}

    def dataset(self, name: str, **options) -> DataFrame:
        """The all-text table of one usable file."""
        group, path = self._places[name]
        return self._read(group, [path], options).drop(DATASET)

    @cached_property
    def _places(self) -> dict[str, tuple[Group, str]]:
        return {_name(p, self.root): (group, p) for group in self.groups for p in group.paths}

    def heads(self) -> dict[str, list[str]]:
        """The column names of every usable file."""
        return {name: group.columns for name, (group, _) in self._places.items()}

    def rows(self, only: set[str] | None = None) -> DataFrame:
        """The rows of all usable files (or of those named) as `read_cells` gives them.

        The number of scans depends on quoted line breaks and the largest number of columns, not on the number of files or
        headers. Files that belong to no scan are not read, unless all usable files are read in one scan: then that is a
        scan of the folder, and rows of other files have names that `heads` does not have.
        """
        scans: dict[tuple[bool, int], list[str]] = {}
        for name, (group, path) in self._places.items():
            if only is None or name in only:
                scans.setdefault((group.multi_line, max(NARROW, 1 << (len(group.columns) - 1).bit_length())), []).append(path)
        parts = []
        for (multi_line, width), paths in scans.items():
            whole = len(paths) == sum(f.status == "ok" for f in self.files)
            width = min(width, max(len(g.columns) for g in self.groups))
            parts.append(read_cells(self.spark, self.folder if whole else paths, width, multi_line, self.root,
                                    *((self.pattern, self.recursive) if whole else ())))
        return reduce(DataFrame.unionByName, parts)


def open_folder(spark: SparkSession, folder: str, pattern: str = "*.csv", recursive: bool = False,
                known: dict[tuple, object] | None = None) -> Folder:
    """Survey a folder and group its usable files. Brings one row per file to the driver.

    `known` holds surveys of earlier runs by (path, modified, size); only files not in it are read. Raises only when the
    folder holds no usable file.
    """
    known = known or {}
    # files without a byte are in no table of the file source
    listed = {(p := re.sub("^file:/+", "file:/", uri)): (p, None, 0) for uri in _reader(spark, pattern, recursive).text(folder).inputFiles()}
    listed.update({r.path: (r.path, r.modified, r.size) for r in listing(spark, folder, pattern, recursive).collect()})
    root = _common_folder(list(listed))
    facts = {path: known[key] for path, key in listed.items() if key in known}
    new = [path for path in listed if path not in facts]
    if len(new) == len(listed):
        found = survey(spark, folder, pattern, recursive) if listed else None
    else:
        found = survey(spark, [_readable(p) for p in new], "*") if new else None
    if found is not None:
        facts.update({r.path: r for r in found.collect()})
    files, groups = [], {}
    for path in sorted(listed, key=lambda p: _name(p, root)):
        fact = facts.get(path)
        if fact and fact.decodable is False:
            status = "skipped: not UTF-8"
        elif not fact or fact.header is None:
            status = "skipped: no columns"
        else:
            status = "ok"
            groups.setdefault((tuple(parse_header(fact.header)), fact.broken), []).append(path)
        files.append(FileState(_name(path, root), path, fact.lines if fact else 0, status, *listed[path][1:], fact))
    if not groups:
        raise ValueError(f"no usable file in {folder}")
    return Folder(spark, root, files, [Group(paths, list(columns), broken) for (columns, broken), paths in groups.items()], folder, pattern, recursive)


def _common_folder(uris: list[str]) -> str:
    """The deepest folder URI, with its slash, that holds all files."""
    folders = [uri.rsplit("/", 1)[0].split("/") for uri in uris] or [[""]]
    shared = []
    for steps in zip(*folders):
        if len(set(steps)) > 1:
            break
        shared.append(steps[0])
    return "/".join(shared) + "/"


def _name(path: str, root: str) -> str:
    """Path of a file URI below the root, as the file source reports it."""
    return unquote(path[len(root):])


def sample_text(sample: Column, chars: int = defaults.SAMPLE_CHARS) -> Column:
    """The sample rows of `file_profile` as one text of at most `chars` characters."""
    return F.substring(F.concat_ws(" ", sample), 1, chars)


def file_profile(df: DataFrame, dataset_id: str, order: str | None = None, rows: int = defaults.SAMPLE_ROWS,
                 path: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """One row: dataset_id, path, columns, row_count and the first rows as JSON text.

    Each task keeps its first rows only; nothing else moves.
    """
    columns = columns or [c for c in df.columns if c != order]
    shown = F.to_json(F.struct(*["`" + c.replace("`", "``") + "`" for c in columns]),
                      {"ignoreNullFields": "false"}).alias("shown")
    if order:
        head = df.select(F.col(order).alias("o"), shown).orderBy("o").limit(rows)
        sample = head.agg(F.transform(F.sort_array(F.collect_list(F.struct("o", "shown"))),
                                      lambda r: r["shown"]).alias("sample"))
    else:
        sample = df.select(shown).limit(rows).agg(F.collect_list("shown").alias("sample"))
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dataset_id).alias(DATASET), F.lit(path).cast("string").alias("path"),
        F.lit(columns).cast("array<string>").alias("columns"), "row_count", sample.scalar().alias("sample"))
