"""Many text tables at once: rows as arrays of cells, and a small table that says what to do with them.

`rows(dataset_id, cells ARRAY<STRING>, extra BOOLEAN, at STRUCT)` holds the rows of any number of tables with any headers;
`extra` tells that a row had more fields than fit, `at` orders the rows of a table. `heads(dataset_id, width)` says how many
columns each table has. So profiling, cleaning, conforming and merging are one job and one plan each, whatever the number of
tables: what differs between tables is data that is joined to their rows, not a branch of the plan.

The joined tables have a row per table. They are broadcast while they are known to be small (BROADCAST); beyond that their
rows are repeated SALTS times, so that a table with a third of all rows is spread over many tasks.

A row with a value beyond its table's columns is refused: `too many fields`. A row without any value after cleaning is
refused: `no values`. A cell that holds a value and becomes NULL by its target type is refused: `not a number`, `not an
integer`. `staged` writes rows, refused rows and refused cells together, in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults
from ..functions import numbers, text
from ..functions.bind import bind
from ..functions.session import materialize
from . import infer
from . import conform as con
from .clean import CleanOptions, TableProfile, _clean, _facts, _keeps_value, _read_profile, extract_numbers

DATASET = "dataset_id"
BROADCAST = 32 << 20  # bytes of a table of facts per dataset up to which every task gets all of it
SALTS = 16
TOO_LONG, NO_VALUES = "too many fields", "no values"


def attach(rows: DataFrame, facts: DataFrame, size: int) -> DataFrame:
    """Joins one row of facts to every row of its dataset; `size` is about the bytes of the facts."""
    if size <= BROADCAST:
        return rows.join(F.broadcast(facts), DATASET)
    salted = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return spread.join(salted.hint("shuffle_hash"), [DATASET, "_salt"]).drop("_salt")


def heads_table(spark: SparkSession, heads: dict[str, list[str]]) -> tuple[DataFrame, int]:
    rows = [(name, len(columns)) for name, columns in heads.items()]
    return materialize(spark.createDataFrame(rows, f"{DATASET} STRING, width INT")), 64 * len(rows)


def _too_long() -> Column:
    beyond = F.slice("cells", F.col("width") + 1, F.greatest(F.size("cells") - F.col("width"), F.lit(0)))
    return F.col("extra") | F.exists(beyond, lambda c: c.isNotNull())


def within(rows: DataFrame, heads: tuple[DataFrame, int]) -> DataFrame:
    """Rows with their table's `width` cells, and `long`: has the row values beyond them?"""
    known = attach(rows, *heads)
    return known.select(*[c for c in rows.columns if c not in ("cells", "extra")], "width",
                        F.slice("cells", F.lit(1), F.col("width")).alias("cells"), _too_long().alias("long"))


# ---- profile ------------------------------------------------------------------------------------

def profile_facts(rows: DataFrame, options: CleanOptions, keys: tuple[str, ...] = (DATASET,)) -> DataFrame:
    """(keys, pos, facts): all whole-column facts of all tables, by one aggregate over the cells of rows from `within`.

    Position -1 counts the rows that keep a value. Counts add up and bounds combine, so facts of parts of a table can
    be merged (`merged_facts`).
    """
    some = F.exists("cells", lambda c: _keeps_value(c, options))
    none = F.lit(None).cast("string")
    marked = F.array(F.struct(F.lit(-1).alias("pos"), none.alias("raw"), some.alias("filled")))
    cells = F.transform("cells", lambda c, i: F.struct(i.alias("pos"), c.alias("raw"), F.lit(False).alias("filled")))
    long = rows.where(~F.col("long")).select(*keys, F.inline(F.concat(marked, cells)))
    r = infer.read_nulls(F.col("raw")) if options.infer else F.col("raw")
    long = long.select(*keys, "pos", "filled", F.lit(None).cast("double").alias("num"), r.alias("r"), _clean(F.col("raw"), options).alias("v"))
    long = long.withColumn("v", text.flag_nulls(F.col("v"), options.null_flags))
    parsed = numbers.parse_cells(long, {"n": "v"}, options.decoration)
    return parsed.groupBy(*keys, "pos").agg(*_facts(options))


def merged_facts(parts: DataFrame, keys: tuple[str, ...] = (DATASET,)) -> DataFrame:
    """One row per key and position from facts of several parts."""
    def combine(name: str) -> Column:
        how = F.min if name.endswith("_low") else F.max if name.endswith("_high") else F.sum
        return how(name).alias(name)

    return parts.groupBy(*keys, "pos").agg(*[combine(c) for c in parts.columns if c not in (*keys, "pos")])


def read_profiles(facts: Iterable, heads: dict[str, list[str]], options: CleanOptions) -> dict[str, TableProfile]:
    """Profiles by dataset from the collected rows of `profile_facts`; tables without rows have none."""
    found: dict[str, dict[int, dict]] = {}
    for row in facts:
        found.setdefault(row[DATASET], {})[row["pos"]] = row.asDict()
    out = {}
    for name, got in found.items():
        fields = [T.StructField(c, T.StringType()) for c in heads[name]]
        out[name] = _read_profile(None, fields, {c: c for c in heads[name]}, got, options)
    return out


# ---- what to do with each cell ------------------------------------------------------------------

@dataclass(frozen=True)
class Step:
    """One column of a conformed table: which cell it comes from, and how."""

    pos: int
    name: str
    strict: str          # type inferred at read: string, bigint, double, boolean
    lift: str            # numbers out of text: '', whole, point, text
    target: str          # type asked for by the schema: '', integer, float, string
    kind: str            # type of the result: string, bigint, double, boolean


STEP = "STRUCT<pos: INT, name: STRING, strict: STRING, lift: STRING, target: STRING, kind: STRING>"
KINDS = {T.LongType(): "bigint", T.DoubleType(): "double", T.BooleanType(): "boolean", T.StringType(): "string"}


def cleaning_steps(prof: TableProfile) -> list[Step]:
    """The columns that cleaning keeps, in their own order and under their own names."""
    places = {c.source: i for i, c in enumerate(prof.columns)}
    out = []
    for c in prof.kept:
        strict, final = KINDS[c.dtype], KINDS[c.final_type]
        lift = "" if not (c.is_text and c.numeric) else {"bigint": "whole", "double": "point"}.get(final, "text")
        out.append(Step(places[c.source], c.name, strict, lift, "", final))
    return out


def conforming_steps(prof: TableProfile, mapping: dict[str, str], column_types: dict[str, str], standards: list[str]) -> tuple[list[Step], list[tuple[str, str]]]:
    """The columns of the conformed table in schema order, and the (column, type) that could not be given."""
    steps = cleaning_steps(prof)
    names = con.unique_names([mapping.get(s.name, s.name) for s in steps])
    failing, issues, out = con.failing_by_profile(prof, mapping), [], []
    for name, s in zip(names, steps):
        target = column_types.get(name, "")
        if target == "integer" and name in failing:
            issues.append((name, target))
            target = ""
        kind = {"integer": "bigint", "float": "double", "string": "string"}.get(target, s.kind)
        out.append(Step(s.pos, name, s.strict, s.lift, target if target in ("integer", "float", "string") else "", kind))
    first = {s: i for i, s in enumerate(standards)}
    out.sort(key=lambda s: first.get(s.name, len(first)))  # stable: the others stay in file order
    return out, issues


def steps_table(spark: SparkSession, steps: dict[str, list[Step]], widths: dict[str, int]) -> tuple[DataFrame, int]:
    """(dataset_id, width, steps) and about its bytes."""
    rows = [(name, widths[name], [(s.pos, s.name, s.strict, s.lift, s.target, s.kind) for s in own]) for name, own in steps.items()]
    size = sum(64 + sum(80 + len(s.name.encode()) for s in own) for own in steps.values())
    return materialize(spark.createDataFrame(rows, f"{DATASET} STRING, width INT, steps ARRAY<{STEP}>")), size


def _value(raw: Column, step: Column, opts: CleanOptions) -> Column:
    """STRUCT<has, whole, num, flag, text>: a cell cleaned and cast as its step says; `has`: did it hold a value?"""
    read = infer.read_nulls(raw) if opts.infer else raw
    cleaned = bind(_clean(raw, opts), lambda c: text.flag_nulls(c, opts.null_flags))

    def typed(v: Column) -> Column:
        strict, lift = step["strict"], step["lift"]
        whole = (F.when(strict == "bigint", infer.parse(read, T.LongType())).when(lift == "whole", numbers.extract_int(v, opts.decoration)))
        num = (F.when(strict == "double", infer.parse(read, T.DoubleType()))
               .when(lift == "point", F.coalesce(numbers.extract_float(v, opts.decoration), numbers.extract_int(v, opts.decoration).cast("double"))))
        flag = F.when(strict == "boolean", infer.parse(read, T.BooleanType()))
        plain = F.when(strict == "string", F.when(lift == "", v).when(lift == "text", extract_numbers(v, opts.decoration)))
        return F.struct(whole.alias("whole"), num.alias("num"), flag.alias("flag"), plain.alias("text"))

    def cast(t: Column) -> Column:
        target = step["target"]
        w, d, b, s = t["whole"], t["num"], t["flag"], t["text"]
        string, double, boolean = T.StringType(), T.DoubleType(), T.BooleanType()
        present = w.isNotNull() | d.isNotNull() | b.isNotNull() | s.isNotNull()
        whole = (F.when(target == "", w).when(target == "integer", F.coalesce(
            w, b.cast("bigint"), F.when(d.isNotNull(), con.to_integer(d, double)), F.when(s.isNotNull(), con.to_integer(s, string)))))
        num = F.when(target == "", d).when(target == "float", F.coalesce(
            numbers.coerce_double(d, double), w.cast("double"), b.cast("double"), F.when(s.isNotNull(), numbers.coerce_double(s, string))))
        out = F.when(target == "", s).when(target == "string", F.coalesce(s, w.cast("string"), F.when(d.isNotNull(), numbers.as_text(d, double)), numbers.as_text(b, boolean)))
        return F.struct(present.alias("has"), whole.alias("whole"), num.alias("num"), F.when(target == "", b).alias("flag"), out.alias("text"))

    return bind(bind(cleaned, typed), cast)


def conformed(rows: DataFrame, steps: tuple[DataFrame, int], options: CleanOptions, carry: tuple[str, ...] = (), refused: bool = False) -> DataFrame:
    """(dataset_id, carry, steps, values ARRAY<STRUCT<has, whole, num, flag, text>>) of the rows that hold a value.

    With `refused` every row stays: `reason` says why a row is refused, and `cells` are its texts.
    """
    known = attach(rows, *steps)
    own = F.slice("cells", F.lit(1), F.col("width"))
    value = lambda s: _value(F.get(F.col("cells"), s["pos"]), s, options)
    found = known.select(DATASET, *carry, "steps", own.alias("cells"), _too_long().alias("long"), F.transform("steps", value).alias("values"))
    some = F.exists("values", lambda v: v["has"])
    if refused:
        reason = F.when(F.col("long"), F.lit(TOO_LONG)).when(~some, F.lit(NO_VALUES))
        return found.select(DATASET, *carry, "steps", "cells", "values", reason.alias("reason"))
    # unfolded rather than filtered: a filter would move below the projection and compute every cell twice
    kept = F.when(some & ~F.col("long"), F.array(F.struct("steps", "values")))
    return found.select(DATASET, *carry, F.inline(kept))


def refused_cells(found: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(dataset_id, carry, pos, column, raw, reason): what `conformed(refused=True)` had to refuse, a row per cell; a refused
    row has pos -1 and its whole text."""
    def cell(s: Column, i: Column) -> Column:
        v = F.get(F.col("values"), i)
        gone = v["has"] & v["whole"].isNull() & v["num"].isNull() & v["flag"].isNull() & v["text"].isNull()
        reason = F.when(s["target"] == "integer", F.lit("not an integer")).otherwise(F.lit("not a number"))
        return F.when(gone, F.struct(s["pos"].alias("pos"), s["name"].alias("column"), F.get(F.col("cells"), s["pos"]).alias("raw"), reason.alias("reason")))

    whole = F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("column"), F.to_json("cells").alias("raw"), F.col("reason").alias("reason"))
    cells = F.filter(F.transform("steps", cell), lambda c: c.isNotNull())
    return found.select(DATASET, *carry, F.inline(F.when(F.col("reason").isNotNull(), F.array(whole)).otherwise(cells)))


# ---- results ------------------------------------------------------------------------------------

def _as(kind: str, v: Column, kinds: set[str]) -> Column:
    """A value of one of `kinds` as the type that a column of these is merged to."""
    if kind == "bigint":
        return v["whole"]
    if kind == "double":
        return F.coalesce(v["num"], v["whole"].cast("double")) if "bigint" in kinds else v["num"]
    if kind == "boolean":
        return v["flag"]
    forms = {"string": v["text"], "bigint": v["whole"].cast("string"), "boolean": numbers.as_text(v["flag"], T.BooleanType()),
             "double": F.when(v["num"].isNotNull(), numbers.as_text(v["num"], T.DoubleType()))}
    return F.coalesce(*[c for k, c in forms.items() if k in kinds])


def columns_of(values: DataFrame, columns: dict[str, tuple[str, set[str]]], carry: tuple[str, ...] = (DATASET,)) -> DataFrame:
    """The columns of `merged_kinds` out of `conformed` rows; a table that lacks one has NULL there."""
    same = F.transform("steps", lambda s: s["name"])
    found = values.select(*carry, "values", F.transform(F.lit(list(columns)).cast("array<string>"), lambda c: F.array_position(same, c)).alias("places"))
    picked = [F.when(F.col("places")[i] > 0, _as(kind, F.get(F.col("values"), (F.col("places")[i] - 1).cast("int")), kinds)).alias(name)
              for i, (name, (kind, kinds)) in enumerate(columns.items())]
    return found.select(*picked, *carry)


def merged_kinds(steps: dict[str, list[Step]], allow_missing: bool = False) -> dict[str, tuple[str, set[str]]]:
    """Columns of the union of all tables, each with its type and the types it has in them; without `allow_missing` all must
    have the first one's columns."""
    first = [s.name for s in next(iter(steps.values()))]
    if not allow_missing:
        odd = [name for name, own in steps.items() if [s.name for s in own] != first]
        if odd:
            raise ValueError(f"datasets with other columns than the first: {odd}")
    kinds: dict[str, set[str]] = {}
    for own in steps.values():
        for s in own:
            kinds.setdefault(s.name, set()).add(s.kind)
    return {name: (min(k) if len(k) == 1 else "double" if k <= {"bigint", "double"} else "string", k) for name, k in kinds.items()}


def row_json(values: DataFrame, carry: tuple[str, ...] = (DATASET,), null_as_text: str | None = None) -> DataFrame:
    """(carry, shown): every row as a JSON object of its own columns."""
    def plain(c: Column) -> Column:
        whole = F.to_json(F.struct(c.alias("x")), {"ignoreNullFields": "false"})
        return F.substring(whole, F.lit(6), F.length(whole) - 6)

    def shown(s: Column, i: Column) -> Column:
        v = F.get(F.col("values"), i)
        words = v["text"] if null_as_text is None else F.coalesce(v["text"], F.lit(null_as_text))
        value = (F.when(s["kind"] == "bigint", plain(v["whole"])).when(s["kind"] == "double", plain(v["num"]))
                 .when(s["kind"] == "boolean", plain(v["flag"]))
                 .otherwise(plain(F.when(s["target"] == "string", words).otherwise(v["text"]))))
        return F.concat(plain(s["name"]), F.lit(":"), value)

    return values.select(*carry, F.concat(F.lit("{"), F.array_join(F.transform("steps", shown), ","), F.lit("}")).alias("shown"))


def first_rows(rows: DataFrame, count: int, value: str, order: str = "at") -> DataFrame:
    """(dataset_id, list): the first values of each dataset; every task keeps `count` a dataset before the shuffle."""
    place = F.row_number().over(Window.partitionBy(DATASET).orderBy(order))
    few = rows.select(DATASET, order, value).withColumn("_place", place).where(F.col("_place") <= count)
    return few.groupBy(DATASET).agg(F.transform(F.sort_array(F.collect_list(F.struct("_place", value))), lambda r: r[value]).alias(value))


def top_places(rows: DataFrame, steps: tuple[DataFrame, int], options: CleanOptions, k: int = defaults.TOP_LOCATIONS) -> DataFrame:
    """(dataset_id, pos, places): the first `k` distinct place names of every column that `steps` name.

    Each task keeps `k` names a column before the shuffle.
    """
    cells = F.transform("steps", lambda s: F.struct(s["pos"].alias("pos"), F.get(F.col("cells"), s["pos"]).alias("raw"), s.alias("step")))
    long = attach(rows, *steps).where(~_too_long()).select(DATASET, F.inline(cells)).where("raw IS NOT NULL").distinct()
    value = bind(_value(F.col("raw"), F.col("step"), options), lambda v: _as("string", v, set(KINDS.values())))
    named = long.select(DATASET, "pos", value.alias("place"))
    wanted = F.when((F.lower("place") != "total") & (F.length("place") > 1), F.col("place"))
    named = named.select(DATASET, "pos", wanted.alias("place")).distinct()
    place = F.row_number().over(Window.partitionBy(DATASET, "pos").orderBy(F.col("place").asc_nulls_last()))
    few = named.withColumn("_place", place).where((F.col("_place") <= k) & F.col("place").isNotNull())
    return few.groupBy(DATASET, "pos").agg(F.sort_array(F.collect_list("place")).alias("places"))
