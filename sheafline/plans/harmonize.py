"""End to end: raw tables -> unified schema, conformed tables, statistics, catalog.

Tables given as DataFrames are profiled by a job each. Files of a folder are profiled together, in one job for any
number of files and headers (see `operators.tables`), their places are found in a second one, and their conformed rows come
out of one scan. Names, profiles and mappings - rows per column, not per record - are all that reaches the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col
from ..functions.session import materialize, new_path
from ..operators import catalog as cat
from ..operators import conform as con
from ..operators import match, merge, naming, stats, tables, unify
from ..operators.clean import CleanOptions, TableProfile, apply_profile, profile, profile_each
from ..operators.tables import Step
from ..operators.unify import UnifiedSchema
from ..sources import csv, sinks
from . import progress

CONCURRENT_JOBS = 8


class Lazy(Mapping):
    """A dictionary whose values are made when they are asked for, once."""

    def __init__(self, names: list[str], make: Callable[[str], DataFrame]):
        self._names, self._make, self._made = dict.fromkeys(names), make, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


@dataclass
class Scan:
    """The rows of all files at once, and what becomes of their cells."""

    rows: DataFrame                    # dataset_id, cells, extra, at
    steps: dict[str, list[Step]]       # by dataset
    widths: dict[str, int]
    options: CleanOptions

    @cached_property
    def plan(self) -> tuple[DataFrame, int]:
        return tables.steps_table(self.rows.sparkSession, self.steps, self.widths)

    def values(self) -> DataFrame:
        return tables.conformed(self.rows, self.plan, self.options, carry=("at",))

    def audited(self) -> DataFrame:
        """Every row with its values, or why it is refused, written once and read back."""
        path = new_path(self.rows.sparkSession, "audited")
        found = tables.conformed(self.rows, self.plan, self.options, carry=("at",), refused=True)
        found.write.parquet(path)
        return self.rows.sparkSession.read.schema(found.schema).parquet(path)


@dataclass
class Harmonized:
    schema: UnifiedSchema
    frames: Mapping[str, DataFrame]
    profiles: dict[str, TableProfile]
    mappings: DataFrame
    datasets: DataFrame          # dataset_id, row_count, columns, status
    stats: DataFrame             # dataset_id + STATS_SCHEMA
    catalog: DataFrame
    issues: list[tuple[str, str, str]] = field(default_factory=list)   # dataset, column, type not given
    null_as_text: str | None = None
    scan: Scan | None = None     # of a folder run

    def consistency(self) -> DataFrame:
        return merge.schema_consistency(self.datasets.where("status = 'ok'"))

    def merged(self, allow_missing: bool = False) -> DataFrame:
        """All conformed rows; text that stands for NULL becomes NULL again. Of a folder, one scan."""
        if self.scan:
            return tables.columns_of(self.scan.values(), tables.merged_kinds(self.scan.steps, allow_missing))
        parts = self.frames
        if self.null_as_text is not None:
            parts = {name: df.select(*[
                F.nullif(col(f.name), F.lit(self.null_as_text)).alias(f.name)
                if isinstance(f.dataType, T.StringType) else col(f.name) for f in df.schema.fields])
                for name, df in parts.items()}
        return merge.merge_union(parts, allow_missing)

    def quarantine(self, allow_missing: bool = True) -> tuple[DataFrame, DataFrame]:
        """Of a folder run: the merged rows, and (dataset_id, at, pos, column, raw, reason) of all that was refused - rows
        with too many fields or no values (pos -1), and cells that lost their value to a target type. One scan gives both."""
        found = self.scan.audited()
        kept = tables.columns_of(found.where("reason IS NULL"), tables.merged_kinds(self.scan.steps, allow_missing), (tables.DATASET, "at"))
        return kept, tables.refused_cells(found, ("at",))

    def write(self, folder: str, fmt: str = "csv") -> DataFrame:
        """Of a folder run, everything to disk: `datasets/` and `metadata/` by output name, `catalog/`, `schema/`, and `merged/`
        if all datasets have the same columns. Returns (dataset_id, name, file, row_count, status) per data file."""
        names = {r.dataset_id: r.name for r in self.names().collect()}  # one row per dataset
        known = tables.merged_kinds(self.scan.steps, allow_missing=True)
        rows = tables.columns_of(self.scan.values(), known, (tables.DATASET, "at", "steps"))
        if self.null_as_text is not None:
            rows = rows.withColumns({c: F.when(F.array_contains(F.transform("steps", lambda s: s["name"]), c), F.coalesce(col(c), F.lit(self.null_as_text)))
                                     for c, (kind, _) in known.items() if kind == "string"})
        rows = rows.withColumn("_own", F.transform("steps", lambda s: s["name"])).drop("steps")
        done = sinks.write_tables(rows, f"{folder}/datasets", {d: f"{n}_harmonized" for d, n in names.items()}, fmt, "at", "_own")
        sinks.write_sidecars(self.catalog, f"{folder}/metadata", names)
        sinks.write_records(self.catalog, f"{folder}/catalog")
        sinks.write_schema(self.datasets.sparkSession, self.schema, f"{folder}/schema")
        if len({tuple(s.name for s in own) for own in self.scan.steps.values()}) == 1:
            sinks.write_merged(self.merged(), f"{folder}/merged")
        return done.join(self.names().select("dataset_id", "name"), "dataset_id", "left").select("dataset_id", "name", "file", "row_count", "status")

    def summary(self) -> DataFrame:
        return merge.run_summary(self.datasets)

    def facts(self, scraped: DataFrame | None = None) -> DataFrame:
        """(dataset_id, facts JSON): what an external writer of records may rely on, with two sample rows each."""
        if self.scan:
            shown = tables.row_json(self.scan.values(), (tables.DATASET, "at"), self.null_as_text)
            sample = tables.first_rows(shown, 2, "shown").withColumnRenamed("shown", "sample")
        else:
            spark = self.datasets.sparkSession
            shown = spark.createDataFrame([], "dataset_id STRING, shown STRING")
            for name, df in self.frames.items():
                row = F.to_json(F.struct(*[col(c) for c in df.columns]), {"ignoreNullFields": "false"})
                shown = shown.unionByName(df.limit(2).select(F.lit(name).alias("dataset_id"), row.alias("shown")))
            sample = shown.groupBy("dataset_id").agg(F.collect_list("shown").alias("sample"))
        known = self.datasets.where("status = 'ok'").join(sample, "dataset_id", "left")
        return cat.fact_sheet(known, self.stats, scraped)

    def names(self) -> DataFrame:
        """Output name per dataset, from the record titles."""
        slugs = naming.title_slugs(self.catalog.select("dataset_id", F.col("catalog_info.title").alias("title")))
        return naming.free_names(slugs.where("status = 'ok'"))


def build_schema(spark: SparkSession, names: DataFrame, proposal: str | None) -> UnifiedSchema:
    """The proposed schema repaired to cover all names, or the fallback without a usable proposal."""
    parsed = None
    if proposal is not None:
        row = unify.parse_proposals(spark.createDataFrame([(proposal,)], "response STRING")).select(
            "parsed", unify.strip_fence(F.col("response")).alias("body")).first()
        parsed = json.loads(row.body) if row.parsed else None
    if not parsed:
        return unify.fallback_document(names)
    schema = UnifiedSchema.from_json(json.dumps(parsed, ensure_ascii=False))
    missing = materialize(unify.unmapped_names(names, schema.variations(spark)))
    if missing.isEmpty():
        return schema
    added = unify.assign_unmapped(missing, schema.standards(spark)).orderBy("name").collect()
    if any(r.is_new for r in added) and "column_types" not in parsed:
        return unify.fallback_document(names)
    for r in added:  # one row per uncovered name
        schema.column_mappings.setdefault(r.standard, []).append(r.name)
        if r.is_new:
            schema.column_types.setdefault(r.standard, "string")
    return schema


def harmonize(raw: dict[str, DataFrame], proposal: str | None = None, responses: DataFrame | None = None,
              scraped: DataFrame | None = None, options: CleanOptions | None = None,
              profiles: dict[str, TableProfile] | None = None, ids: tuple[str, ...] = (),
              null_as_text: str | None = None, skipped: dict[str, str] | None = None) -> Harmonized:
    """Harmonize raw tables, keyed by dataset name. `ids` are carried along in every table."""
    opts = options or CleanOptions()
    spark = next(iter(raw.values())).sparkSession if raw else SparkSession.active()
    profiles = dict(profiles or {})
    todo = [name for name in raw if name not in profiles]
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:  # independent jobs; the cluster is shared by them
        profiles.update(zip(todo, pool.map(lambda name: profile(raw[name], ids, opts), todo)))
    skipped = dict(skipped or {}) | {name: "skipped: no data" for name in raw if not profiles[name].kept}
    raw = {name: df for name, df in raw.items() if profiles[name].kept}
    cleaned = {name: apply_profile(df, profiles[name], ids, opts) for name, df in raw.items()}

    schema, mappings, by_dataset = resolve(spark, {name: profiles[name] for name in cleaned}, proposal)

    def facts(name: str) -> tuple:
        places = [c for c in stats.spatial_columns([p.name for p in profiles[name].kept]) if c]
        looked_at = apply_profile(raw[name], profiles[name], (), opts, only=places)
        return stats.table_facts(looked_at, profiles[name])

    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        table_stats = stats.stats_table(spark, dict(zip(cleaned, pool.map(facts, cleaned))))
    frames, issues = {}, []
    for name, df in cleaned.items():
        failing = con.failing_by_profile(profiles[name], by_dataset[name])
        done = con.conform(df, schema, by_dataset[name], ids, null_as_text, failing=failing)
        frames[name] = done.df
        issues += [(name, c, t) for c, t in done.issues]
    columns = {name: [c for c in df.columns if c not in ids] for name, df in frames.items()}
    datasets, records = describe(spark, profiles, columns, skipped, table_stats, mappings, responses, scraped)
    return Harmonized(schema, frames, profiles, mappings, datasets, table_stats, records, issues, null_as_text)


def resolve(spark: SparkSession, profiles: dict[str, TableProfile], proposal: str | None) -> tuple[UnifiedSchema, DataFrame, dict[str, dict[str, str]]]:
    """The unified schema of all datasets, their mappings as a table, and as original -> standard by dataset."""
    columns = spark.createDataFrame(
        [(name, i, c.name) for name, prof in profiles.items() for i, c in enumerate(prof.kept)],
        "dataset_id STRING, col_pos BIGINT, name STRING")
    schema = build_schema(spark, unify.column_union(columns), proposal)
    mappings = match.resolve_columns(columns, schema.variations(spark))
    by_dataset: dict[str, dict[str, str]] = {name: {} for name in profiles}
    found = mappings.orderBy("dataset_id", "col_pos").collect()  # one row per column
    mappings = spark.createDataFrame(found, mappings.schema)  # names are matched once; what follows reads the answer
    for m in found:
        by_dataset[m.dataset_id][m.original] = m.standard
    return schema, mappings, by_dataset


def describe(spark: SparkSession, profiles: dict[str, TableProfile], columns: dict[str, list[str]], skipped: dict[str, str], table_stats: DataFrame,
             mappings: DataFrame, responses: DataFrame | None, scraped: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The datasets with their status, and the catalog."""
    datasets = spark.createDataFrame(
        [(name, profiles[name].rows, own, "ok") for name, own in columns.items()]
        + [(name, None, None, why) for name, why in skipped.items()],
        "dataset_id STRING, row_count BIGINT, columns ARRAY<STRING>, status STRING")
    return datasets, cat.catalog(datasets.where("status = 'ok'"), table_stats, match.mapping_log(mappings), responses, scraped)


def harmonize_folder(spark: SparkSession, folder: str, options: CleanOptions | None = None, pattern: str = "*.csv", recursive: bool = False,
                     proposal: str | None = None, responses: DataFrame | None = None, scraped: DataFrame | None = None,
                     null_as_text: str | None = None, since: str | None = None, state: str | None = None) -> Harmonized:
    """Harmonize all CSV files of a folder, with a status for each.

    The number of jobs does not grow with the files. `state` is a new path to which the run writes what it knows of each
    file; given as `since` to a later run, only files that are new or changed are profiled again. When columns are judged
    by their first values (`options.sample_size`), each file takes jobs of its own and there is no state.
    """
    opts = options or CleanOptions(infer=True)
    if opts.sample_size:
        return _folder_by_sample(spark, folder, opts, pattern, recursive, proposal=proposal, responses=responses, scraped=scraped, null_as_text=null_as_text)
    before = progress.read(spark, since, opts) if since else {}
    source = csv.open_folder(spark, folder, pattern, recursive, {key: row for key, row in before.items()})
    files = {f.dataset_id: f for f in source.files if f.status == "ok"}
    heads = source.heads()
    old = {name: before[key] for name, f in files.items() if (key := (f.path, f.modified, f.size)) in before}
    new = set(files) - set(old)
    facts = [r for name, row in old.items() for r in progress.facts(name, row)]
    if new:
        own = {name: heads[name] for name in new}
        known = tables.heads_table(spark, own)
        facts += tables.profile_facts(tables.within(source.rows(new), known), opts).collect()  # one row per column
    profiles = tables.read_profiles(facts, heads, opts)
    skipped = {f.dataset_id: f.status for f in source.files if f.status != "ok"}
    skipped |= {name: "skipped: no rows" if name not in profiles else "skipped: no data" for name in files
                if name not in profiles or not profiles[name].kept}
    kept = {name: profiles[name] for name in files if name not in skipped}
    places = {name: progress.places(old[name]) for name in kept if name in old}
    places |= _places(spark, source, {name: kept[name] for name in kept if name in new}, heads, opts)
    if state:
        progress.write(spark, state, opts, source.files, facts, places)
    schema, mappings, by_dataset = resolve(spark, kept, proposal)
    table_stats = stats.stats_table(spark, {name: stats.profile_facts(prof, places.get(name, {})) for name, prof in kept.items()})
    steps, issues = {}, []
    for name, prof in kept.items():
        steps[name], failed = tables.conforming_steps(prof, by_dataset[name], schema.column_types, list(schema.column_mappings))
        issues += [(name, c, t) for c, t in failed]

    def frame(name: str) -> DataFrame:
        cleaned = apply_profile(source.dataset(name), kept[name], (), opts)
        return con.conform(cleaned, schema, by_dataset[name], (), null_as_text, failing=con.failing_by_profile(kept[name], by_dataset[name])).df

    datasets, records = describe(spark, profiles, {name: [s.name for s in own] for name, own in steps.items()}, skipped, table_stats, mappings, responses, scraped)
    scan = Scan(source.rows(set(kept)), steps, {name: len(heads[name]) for name in kept}, opts) if kept else None
    return Harmonized(schema, Lazy(list(kept), frame), kept, mappings, datasets, table_stats, records, issues, null_as_text, scan)


def _places(spark: SparkSession, source: csv.Folder, profiles: dict[str, TableProfile], heads: dict[str, list[str]], opts: CleanOptions) -> dict[str, dict[str, list[str]]]:
    """The first place names by dataset and cleaned column, in one job."""
    steps = {}
    for name, prof in profiles.items():
        wanted = {c for c in stats.spatial_columns([c.name for c in prof.kept]) if c}
        if wanted:
            steps[name] = [s for s in tables.cleaning_steps(prof) if s.name in wanted]
    if not steps:
        return {}
    plan = tables.steps_table(spark, steps, {name: len(heads[name]) for name in steps})
    out: dict[str, dict[str, list[str]]] = {}
    for r in tables.top_places(source.rows(set(steps)), plan, opts).collect():  # one row per place column
        column = next(s.name for s in steps[r.dataset_id] if s.pos == r.pos)
        out.setdefault(r.dataset_id, {})[column] = r.places
    return out


def _folder_by_sample(spark: SparkSession, folder: str, opts: CleanOptions, pattern: str, recursive: bool, **more) -> Harmonized:
    source = csv.open_folder(spark, folder, pattern, recursive)
    profiles: dict[str, TableProfile] = {}
    for table in source.tables(with_order=bool(opts.order_by)):
        ids = (opts.order_by,) if opts.order_by else ()
        profiles.update(profile_each(table, csv.DATASET, ids, opts))
    raw = {name: df for name, df in source.datasets().items() if name in profiles}
    skipped = {f.dataset_id: f.status for f in source.files if f.status != "ok"}
    skipped.update({f.dataset_id: "skipped: no rows" for f in source.files
                    if f.status == "ok" and f.dataset_id not in profiles})
    return harmonize(raw, options=opts, profiles=profiles, skipped=skipped, **more)
