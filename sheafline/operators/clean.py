"""Cleaning: one profiling aggregate, then one projection.

The profile holds everything that needs a whole column - which columns are empty, which text
columns are numeric, how many cells survive, the span of years - so cleaning and statistics share
a single pass, and the cleaned rows come out of a narrow projection without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults
from ..functions import numbers, text
from ..functions.bind import bind
from ..functions.names import col, tidy_name, unique_names
from . import infer


@dataclass(frozen=True)
class CleanOptions:
    """`sample_size`/`order_by`: judge numeric columns by their first values in that order instead
    of by the whole column. `indic_digits`: read Devanagari digits as ASCII ones."""

    null_flags: tuple[str, ...] = tuple(defaults.NULL_FLAGS)
    decoration: str = defaults.NUMBER_DECORATION
    numeric_share: float = defaults.NUMERIC_SHARE
    sample_size: int | None = None
    order_by: str | None = None
    indic_digits: bool = False
    on_collision: str = "suffix"
    infer: bool = False            # text columns come straight from a file: infer strict types first
    nullable_ints: bool = True     # False: an inferred integer column with a NULL becomes DOUBLE
    keep_text: tuple[str, ...] = ()


@dataclass(frozen=True)
class ColumnProfile:
    """Facts of one column. `plain` facts read cells as they are, `lifted` ones after number
    extraction; which of them holds for the cleaned column depends on `numeric`."""

    source: str
    name: str
    dtype: T.DataType          # strict type of the column before number extraction
    raw_values: int            # not NULL before cleaning
    values: int                # not NULL after cleaning
    hits: int = 0              # number-like values (text columns)
    ints: int = 0              # convertible to BIGINT
    floats: int = 0            # convertible to DOUBLE, written with a point
    numeric: bool = False
    plain_years: tuple[float | None, float | None] = (None, None)
    lifted_years: tuple[float | None, float | None] = (None, None)
    plain_fractions: int = 0   # numbers that are no 64-bit integer
    lifted_fractions: int = 0

    @property
    def is_text(self) -> bool:
        return isinstance(self.dtype, T.StringType)

    @property
    def final_type(self) -> T.DataType:
        if self.is_text and self.numeric and self.ints + self.floats == self.values:
            return T.DoubleType() if self.floats else T.LongType()
        return self.dtype

    @property
    def years(self) -> tuple[float | None, float | None]:
        return self.lifted_years if self.numeric else self.plain_years

    @property
    def fits_integer(self) -> bool:
        return not (self.lifted_fractions if self.numeric else self.plain_fractions)


@dataclass(frozen=True)
class TableProfile:
    rows: int
    columns: list[ColumnProfile] = field(default_factory=list)

    @property
    def kept(self) -> list[ColumnProfile]:
        """Columns that held at least one value before cleaning, under their final names."""
        return [c for c in self.columns if c.raw_values]


# ---- single steps -------------------------------------------------------------------------------

def drop_null_rows(df: DataFrame, ids: tuple[str, ...] = ()) -> DataFrame:
    """Drop rows whose data columns are all NULL."""
    data = [c for c in df.columns if c not in ids]
    return df.where(_any_value([col(c) for c in data])) if data else df


def drop_null_columns(df: DataFrame, ids: tuple[str, ...] = ()) -> DataFrame:
    """Drop columns without any value; one aggregate decides."""
    data = [c for c in df.columns if c not in ids]
    if not data:
        return df
    counts = df.agg(*[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(data)]).first()
    empty = {c for i, c in enumerate(data) if counts[i] == 0}
    return df.select(*[col(c) for c in df.columns if c not in empty])


def clean_names(df: DataFrame, on_collision: str = "suffix") -> DataFrame:
    return df.toDF(*unique_names([tidy_name(c) for c in df.columns], on_collision))


def clean_cells(df: DataFrame, ids: tuple[str, ...] = ()) -> DataFrame:
    return _map_text(df, ids, text.clean_cell)


def null_flags(df: DataFrame, ids: tuple[str, ...] = (), flags=None) -> DataFrame:
    return _map_text(df, ids, lambda c: text.flag_nulls(c, flags))


def _map_text(df: DataFrame, ids, fn) -> DataFrame:
    is_text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        fn(col(c)).alias(c) if c in is_text and c not in ids else col(c) for c in df.columns
    ])


def _any_value(cells: list[Column]) -> Column:
    """Is any cell not NULL? A flat expression, as thousands of nested ORs would overflow the planner."""
    return F.array_contains(F.array(*[c.isNotNull() for c in cells]), True)


# ---- profile ------------------------------------------------------------------------------------

def _addressable(df: DataFrame) -> DataFrame:
    """Columns that share a name (or differ in case only) get suffixes, so each can be referred to."""
    names = unique_names(df.columns)
    return df if names == df.columns else df.toDF(*names)


def _clean(c: Column, opts: CleanOptions) -> Column:
    """A raw text cell, cleaned but not yet flagged."""
    cleaned = text.clean_cell(infer.read_nulls(c) if opts.infer else c)
    return numbers.ascii_digits(cleaned) if opts.indic_digits else cleaned


def _clean_all(texts: list[Column], opts: CleanOptions) -> Column:
    """The cleaned and flagged text cells of a row as one array: one expression for any width."""
    cleaned = F.transform(F.array(*texts).cast("array<string>"), lambda c: _clean(c, opts))
    return F.transform(cleaned, lambda c: text.flag_nulls(c, opts.null_flags))


def _keeps_value(c: Column, opts: CleanOptions) -> Column:
    """Does a raw text cell hold a value? Same as cleaning, flagging and testing it, but cheaper."""
    space = r"[\s\x1c-\x1f]*"
    # cleaning makes every run of blanks one space, so a flag's spaces meet any such run
    flags = [r"[\s\x1c-\x1f]+".join(map(re.escape, w.split())) for w in opts.null_flags if w.strip() and w == " ".join(w.split())]
    empty = f"(?U)^{space}(?:{'|'.join(flags)})?{space}$"
    exact = bind(_clean(c, opts), lambda v: text.flag_nulls(v, opts.null_flags).isNotNull())
    plain = ~c.rlike(empty) & (~c.isin(defaults.READ_NULLS) if opts.infer else F.lit(True))
    return c.isNotNull() & F.when(F.contains(c, F.lit("\x00")), exact).otherwise(plain)


def _present(f: T.StructField) -> Column:
    """Is there a value in a column that is no text?"""
    c = col(f.name)
    return c.isNotNull() & ~F.isnan(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c.isNotNull()


def _is_text(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.StringType)


def _long_cells(df: DataFrame, fields: list[T.StructField], keys: tuple[str, ...], opts: CleanOptions) -> DataFrame:
    """One row per cell: keys, `pos`, `r` and `v` (text before and after cleaning), `num` and `filled`
    (other types). An extra cell at -1 is `filled` when its row keeps any value.

    The same few expressions serve every column, so the generated code stays small for any width.
    """
    def cell(pos: int, raw=None, num=None, filled=None) -> Column:
        return F.struct(F.lit(pos).alias("pos"), (F.lit(None).cast("string") if raw is None else raw).alias("raw"),
                        (F.lit(None).cast("double") if num is None else num).alias("num"),
                        (F.lit(False) if filled is None else filled).alias("filled"))

    texts = [col(f.name) for f in fields if _is_text(f)]
    others = [f for f in fields if not _is_text(f)]
    some = F.exists(F.array(*texts), lambda c: _keeps_value(c, opts)) if texts else F.lit(False)
    if others:
        some = F.array_contains(F.array(*[_present(f) for f in others]), True) | some
    cells = [cell(i, raw=col(f.name)) if _is_text(f) else
             cell(i, num=numbers.coerce_double(col(f.name), f.dataType), filled=_present(f))
             for i, f in enumerate(fields)]
    long = df.select(*[col(k) for k in keys], F.explode(F.array(cell(-1, filled=some), *cells)).alias("cell"))
    long = long.select(*[col(k) for k in keys], "cell.*")
    r = infer.read_nulls(F.col("raw")) if opts.infer else F.col("raw")
    cleaned = _clean(F.col("raw"), opts)
    # Two projections: a cell is mentioned several times when it is flagged.
    long = long.select(*[col(k) for k in keys], "pos", "num", "filled", r.alias("r"), cleaned.alias("v"))
    return long.withColumn("v", text.flag_nulls(F.col("v"), opts.null_flags))


def _facts(opts: CleanOptions) -> list[Column]:
    """The aggregates over the cells of one column."""
    r, v, filled = F.col("r"), F.col("v"), F.col("filled")
    plain = F.coalesce("n_plain", "num")
    lifted = F.coalesce(F.col("n_int").cast("double"), "n_point", plain)
    out = [F.count_if(r.isNotNull() | filled).alias("raw"), F.count_if(v.isNotNull() | filled).alias("values"),
           F.count_if("n_hit").alias("hits"), F.count("n_int").alias("ints"), F.count("n_point").alias("floats")]
    for name, c in (("plain", plain), ("lifted", lifted)):
        year = F.when((c > defaults.YEAR_ABOVE) & (c < defaults.YEAR_BELOW), c)
        out += [F.count_if(~numbers.is_whole(c)).alias(f"{name}_fractions"),
                F.min(year).alias(f"{name}_low"), F.max(year).alias(f"{name}_high")]
    return out + ([test.alias(kind) for kind, test in infer.type_tests(r).items()] if opts.infer else [])


def profile(df: DataFrame, ids: tuple[str, ...] = (), options: CleanOptions | None = None) -> TableProfile:
    """All whole-column facts of a raw table in one aggregate."""
    return _profiles(df, (), ids, options or CleanOptions()).get((), TableProfile(0))


def profile_each(df: DataFrame, by: str, ids: tuple[str, ...] = (),
                 options: CleanOptions | None = None) -> dict[str, TableProfile]:
    """The profiles of many datasets with the same columns in one job, keyed by `by`."""
    return {key: prof for (key,), prof in _profiles(df, (by,), ids, options or CleanOptions()).items()}


def _profiles(df: DataFrame, keys: tuple[str, ...], ids: tuple[str, ...], opts: CleanOptions) -> dict[tuple, TableProfile]:
    """Brings one row per dataset and column to the driver; map-side combine keeps a huge dataset
    from skewing the job."""
    written, df = df.columns, _addressable(df)
    labels = dict(zip(df.columns, written))
    fields = [f for f in df.schema.fields if f.name not in ids and f.name not in keys]
    if not fields:
        return {}
    cells = numbers.parse_cells(_long_cells(df, fields, keys, opts), {"n": "v"}, opts.decoration)
    found: dict[tuple, dict[int, dict]] = {}
    for row in cells.groupBy(*keys, "pos").agg(*_facts(opts)).collect():
        found.setdefault(tuple(row[k] for k in keys), {})[row["pos"]] = row.asDict()
    out = {}
    for key, got in found.items():
        part = df
        for k, value in zip(keys, key):
            part = part.where(col(k) == value)
        out[key] = _read_profile(part, fields, labels, got, opts)
    return out


def _read_profile(df: DataFrame, fields, labels: dict[str, str], got: dict[int, dict], opts: CleanOptions) -> TableProfile:
    rows, columns = got[-1]["values"], []
    for i, f in enumerate(fields):
        fact, dtype = got[i], f.dataType
        values = fact["values"]
        if _is_text(f) and opts.infer and f.name not in opts.keep_text:
            kind = infer.strict_type(fact["raw"], fact["bigint"], fact["double"], fact["boolean"])
            if kind == "bigint" and not opts.nullable_ints and values < rows:
                kind = "double"
            dtype = infer.spark_type(kind)
        year = "year" in labels[f.name].lower()
        columns.append(ColumnProfile(
            f.name, "", dtype, fact["raw"], values, fact["hits"], fact["ints"], fact["floats"],
            numeric=isinstance(dtype, T.StringType) and values > 0 and fact["hits"] >= values * opts.numeric_share,
            plain_years=(fact["plain_low"], fact["plain_high"]) if year else (None, None),
            lifted_years=(fact["lifted_low"], fact["lifted_high"]) if year else (None, None),
            plain_fractions=fact["plain_fractions"], lifted_fractions=fact["lifted_fractions"]))
    # Only columns that stay reach the output, so only their names have to differ.
    kept = [c for c in columns if c.raw_values]
    names = dict(zip([c.source for c in kept],
                     unique_names([tidy_name(labels[c.source]) for c in kept], opts.on_collision)))
    columns = [replace(c, name=names.get(c.source, tidy_name(labels[c.source]))) for c in columns]
    if opts.sample_size:
        columns = [_judge_by_sample(df, c, opts) for c in columns]
    return TableProfile(rows, columns)


def _judge_by_sample(df: DataFrame, c: ColumnProfile, opts: CleanOptions) -> ColumnProfile:
    """Numeric or not by the first `sample_size` values in `order_by` order."""
    if not c.is_text or not c.values:
        return c
    carry = [col(opts.order_by).alias("o")] if opts.order_by else []
    cells = df.select(F.get(_clean_all([col(c.source)], opts), F.lit(0)).alias("v"), *carry).where("v IS NOT NULL")
    if opts.order_by:
        cells = cells.orderBy("o")
    seen = cells.limit(opts.sample_size).agg(
        F.count("*").alias("n"), F.count_if(numbers.looks_numeric(F.col("v"), opts.decoration)).alias("h")).first()
    return replace(c, numeric=seen.h >= seen.n * opts.numeric_share)


def numeric_likeness(df: DataFrame, ids: tuple[str, ...] = (), options: CleanOptions | None = None) -> DataFrame:
    """One row per text column: values, number-like values, share, verdict."""
    opts = options or CleanOptions()
    texts = [f for f in df.schema.fields if f.name not in ids and _is_text(f)]
    counted = _long_cells(df, texts, (), opts).where("pos >= 0").groupBy("pos").agg(
        F.count("v").alias("n_values"), F.count_if(numbers.looks_numeric(F.col("v"), opts.decoration)).alias("n_numeric"))
    return counted.select(
        F.element_at(F.lit([tidy_name(f.name) for f in texts]), F.col("pos") + 1).alias("column"), "n_values", "n_numeric",
        F.try_divide(F.col("n_numeric"), F.col("n_values")).alias("ratio"),
        ((F.col("n_values") > 0) & (F.col("n_numeric") >= F.col("n_values") * opts.numeric_share)).alias("is_numeric"))


# ---- composite ----------------------------------------------------------------------------------

def extract_numbers(c: Column, decoration: str = defaults.NUMBER_DECORATION) -> Column:
    """Canonical number text for cells that convert, the cell itself for the rest."""
    return F.coalesce(numbers.extract_int(c, decoration).cast("string"),
                      bind(numbers.extract_float(c, decoration), numbers.float_text), c)


def _final_cell(p: ColumnProfile, c: Column, opts: CleanOptions) -> Column:
    if not p.is_text or not p.numeric:
        return c
    whole = numbers.extract_int(c, opts.decoration)
    if isinstance(p.final_type, T.LongType):
        return whole
    if isinstance(p.final_type, T.DoubleType):
        return F.coalesce(numbers.extract_float(c, opts.decoration), whole.cast("double"))
    return extract_numbers(c, opts.decoration)


def apply_profile(df: DataFrame, prof: TableProfile, ids: tuple[str, ...] = (),
                  options: CleanOptions | None = None, only: list[str] | None = None) -> DataFrame:
    """Clean with a known profile: a narrow projection and a row filter, also fit for a stream.

    `only` names the cleaned columns to look at; rows are not dropped then, as that takes all columns.
    """
    opts, df = options or CleanOptions(), _addressable(df)
    kept = [p for p in prof.kept if only is None or p.name in only]
    id_cols = [col(c) for c in ids]
    if not kept:
        return df.where(F.lit(False)).select(*id_cols)
    raw = {f.name: f for f in df.schema.fields}
    texts = [p.source for p in kept if p.is_text]
    cleaned = _clean_all([col(t) for t in texts], opts)

    def typed(p: ColumnProfile) -> Column:
        if _is_text(raw[p.source]):
            return infer.parse(infer.read_nulls(col(p.source)), p.dtype)
        return F.when(_present(raw[p.source]), col(p.source))

    cells = df.select(*id_cols, cleaned.alias("_text"), *[
        typed(p).alias(f"_cell{i}") for i, p in enumerate(kept) if not p.is_text])
    cell = [F.get("_text", F.lit(texts.index(p.source))) if p.is_text else F.col(f"_cell{i}") for i, p in enumerate(kept)]
    if only is None:
        # A filter would be pushed below the cleaning and clean every cell a second time there. A row
        # that unfolds into one row or none is dropped after its cells are computed once.
        some = F.exists("_text", lambda c: c.isNotNull())
        others = [F.col(f"_cell{i}") for i, p in enumerate(kept) if not p.is_text]
        some = _any_value(others) | some if others else some
        rows = F.when(some, F.array(F.struct(*[c.alias(f"_cell{i}") for i, c in enumerate(cell)])))
        cells = cells.select(*id_cols, F.inline(rows))
    else:
        cells = cells.select(*id_cols, *[c.alias(f"_cell{i}") for i, c in enumerate(cell)])
    return cells.select(*id_cols, *[_final_cell(p, F.col(f"_cell{i}"), opts).alias(p.name) for i, p in enumerate(kept)])


def clean(df: DataFrame, ids: tuple[str, ...] = (), options: CleanOptions | None = None,
          prof: TableProfile | None = None) -> DataFrame:
    """The whole cleaning: names, cells, null flags, empty rows and columns, numbers.

    `ids` are carried along untouched. Runs one profiling job unless a profile is given.
    """
    prof = prof or profile(df, ids, options)
    return apply_profile(df, prof, ids, options)
