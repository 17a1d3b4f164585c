"""One schema over all datasets: name union, coverage, repair, fallback, proposal parsing."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import defaults
from ..functions import text
from ..functions.session import materialize
from . import match

# The schema document as a DDL string.
SCHEMA_TYPE = """
  domain STRING, column_mappings MAP<STRING, ARRAY<STRING>>, column_types MAP<STRING, STRING>,
  required_columns ARRAY<STRING>,
  data_standards STRUCT<jurisdiction_level: STRING, sector: STRING, ministry: STRING>
"""
VARIATIONS = "std_pos BIGINT, standard STRING, var_pos BIGINT, variation STRING"
STANDARDS = "std_pos BIGINT, standard STRING, type STRING"


@dataclass
class UnifiedSchema:
    """The schema document; `column_mappings` keeps its order."""

    column_mappings: dict[str, list[str]]
    column_types: dict[str, str] = field(default_factory=dict)
    domain: str = "unknown"
    required_columns: list[str] = field(default_factory=list)
    data_standards: dict[str, str] = field(default_factory=lambda: dict(defaults.FALLBACK_STANDARDS))

    @classmethod
    def from_json(cls, document: str) -> "UnifiedSchema":
        d = json.loads(document)
        return cls(d.get("column_mappings", {}), d.get("column_types", {}), d.get("domain", "unknown"),
                   d.get("required_columns", []), d.get("data_standards", {}))

    def to_json(self) -> str:
        return json.dumps({
            "domain": self.domain, "column_mappings": self.column_mappings,
            "column_types": self.column_types, "required_columns": self.required_columns,
            "data_standards": self.data_standards}, indent=2, ensure_ascii=False)

    def variations(self, spark: SparkSession) -> DataFrame:
        rows = [(i, s, j, v) for i, (s, vs) in enumerate(self.column_mappings.items()) for j, v in enumerate(vs)]
        return spark.createDataFrame(rows, VARIATIONS)

    def standards(self, spark: SparkSession) -> DataFrame:
        rows = [(i, s, self.column_types.get(s)) for i, s in enumerate(self.column_mappings)]
        return spark.createDataFrame(rows, STANDARDS)

    @classmethod
    def from_tables(cls, standards: DataFrame, variations: DataFrame, **document) -> "UnifiedSchema":
        """Collects the (metadata-sized) schema tables into a document."""
        names = standards.orderBy("std_pos").collect()
        mappings = {r.standard: [] for r in names}
        for r in variations.orderBy("std_pos", "var_pos").collect():
            mappings[r.standard].append(r.variation)
        return cls(mappings, {r.standard: r.type for r in names if r.type is not None}, **document)


def explode_schema(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(standards, variations) of a DataFrame whose rows have `SCHEMA_TYPE` columns."""
    entries = documents.select("column_types", F.posexplode(F.map_entries("column_mappings")).alias("std_pos", "e"))
    entries = entries.select(F.col("std_pos").cast("bigint").alias("std_pos"), F.col("e.key").alias("standard"),
                             F.col("e.value").alias("names"), "column_types")
    standards = entries.select("std_pos", "standard",
                               F.try_element_at("column_types", F.col("standard")).alias("type"))
    variations = entries.select("std_pos", "standard", F.posexplode("names").alias("var_pos", "variation"))
    return standards, variations.withColumn("var_pos", F.col("var_pos").cast("bigint"))


# ---- names and coverage -------------------------------------------------------------------------

def column_union(columns: DataFrame) -> DataFrame:
    """All distinct column names over all datasets, in code-point order."""
    return columns.select("name").distinct().orderBy("name")


def unmapped_names(names: DataFrame, variations: DataFrame) -> DataFrame:
    return names.join(variations.select(F.col("variation").alias("name")), "name", "left_anti")


def coverage(names: DataFrame, variations: DataFrame) -> DataFrame:
    """One row: valid, mapped_count, total_count."""
    known = variations.select(F.col("variation").alias("name")).distinct().withColumn("hit", F.lit(True))
    counted = names.join(known, "name", "left").agg(
        F.count("hit").alias("mapped_count"), F.count(F.lit(1)).alias("total_count"))
    return counted.select((F.col("mapped_count") == F.col("total_count")).alias("valid"),
                          "mapped_count", "total_count")


def missing_required(columns: DataFrame, mappings: DataFrame, required: list[str]) -> DataFrame:
    """Per dataset, the required standards that none of its columns resolves to (a report only)."""
    have = columns.select("dataset_id").distinct().join(
        mappings.groupBy("dataset_id").agg(F.collect_set("standard").alias("have")), "dataset_id", "left")
    wanted = F.array(*[F.lit(r) for r in required]).cast("array<string>")
    return have.select("dataset_id", F.array_except(
        wanted, F.coalesce("have", F.array().cast("array<string>"))).alias("missing_required"))


# ---- repair -------------------------------------------------------------------------------------

def assign_unmapped(names: DataFrame, standards: DataFrame, above: int = defaults.ASSIGN_ABOVE) -> DataFrame:
    """Give every uncovered name a standard: the most similar one above the threshold, or its own.

    Names are taken in sorted order and a name without a home founds a standard that later names
    may join. That order is kept exactly without a sequential loop: with all similar pairs known, a
    name founds a standard iff it reaches no given standard and no earlier founder. Every round
    settles all names whose earlier neighbours are settled; rounds repeat until none is open.

    Returns (name, standard, std_pos, score, is_new). Founded standards have no position (NULL):
    they follow the given ones in the order of their founders. A founder's own score is NULL.
    """
    low = above + 1
    keyed = materialize(names.select("name").distinct().withColumn("a", text.squeezed_name(F.col("name"))))
    forms = keyed.groupBy("a").agg(F.min("name").alias("head"))  # only the first name of a form can found
    given = standards.select(F.replace(F.lower("standard"), F.lit("_"), F.lit("")).alias("b"), "std_pos",
                             F.lit(0).alias("var_pos"), "standard")
    home = materialize(forms.join(match.best_match(forms.select("a"), given, low), "a", "left"))
    possible = home.where("standard IS NULL").select("a", "head")

    # Edges: a possible founder `a` and any other form `b` that is similar enough.
    near = match.similar_pairs(possible.select("a"), forms.select(F.col("a").alias("b")), low).where("a <> b")
    edges = materialize(near.join(possible, "a").join(forms.select(F.col("a").alias("b"),
                                                                   F.col("head").alias("b_head")), "b"))
    founders = _first_founders(possible, edges.where("head < b_head").select("a", "b"))

    # A name may join every founder before it; a founder's other spellings join it with score 100.
    reach = edges.join(founders, "a", "left_semi").select(F.col("b").alias("a"), F.col("head").alias("founder"), "score")
    twins = possible.join(founders, "a", "left_semi").select("a", F.col("head").alias("founder"), F.lit(100).alias("score"))
    offers = keyed.join(reach.unionByName(twins), "a").where("founder <= name").groupBy("name").agg(
        F.min_by(F.struct("founder", "score"), F.struct(-F.col("score"), F.col("founder"))).alias("f"))
    placed = keyed.join(home.drop("head"), "a").join(offers, "name", "left")
    use = F.col("f.score").isNotNull() & (F.col("score").isNull() | (F.col("f.score") > F.col("score")))
    return placed.select(
        "name",
        F.when(use, text.snake_name(F.col("f.founder"))).otherwise(F.col("standard")).alias("standard"),
        F.when(~use, F.col("std_pos")).alias("std_pos"),
        F.when(~use, F.col("score")).when(F.col("f.founder") != F.col("name"), F.col("f.score"))
        .cast("int").alias("score"),
        use.alias("is_new"))


def _first_founders(possible: DataFrame, later: DataFrame) -> DataFrame:
    """The forms that found a standard; `later(a, b)` pairs a possible founder with a later form."""
    state = possible.select("a", F.lit("open").alias("fate"))
    while True:
        todo = state.where("fate = 'open'").select("a")
        reached = later.join(todo, "a", "left_semi").select(F.col("b").alias("a")).distinct().withColumn("waits", F.lit(True))
        judged = state.join(reached, "a", "left").withColumn("new", (F.col("fate") == "open") & F.col("waits").isNull())
        beaten = later.join(judged.where("new").select("a"), "a", "left_semi").select(
            F.col("b").alias("a")).distinct().withColumn("beaten", F.lit(True))
        fate = (F.when(F.col("new"), F.lit("founder")).when((F.col("fate") == "open") & F.col("beaten"), F.lit("joins"))
                .otherwise(F.col("fate")))
        state = materialize(judged.join(beaten, "a", "left").select("a", fate.alias("fate")))
        if state.where("fate = 'open'").isEmpty():
            return state.where("fate = 'founder'").select("a")


# ---- fallback -----------------------------------------------------------------------------------

def _pattern_hits(patterns) -> Column:
    """ARRAY<STRUCT<std_pos, standard, type>> of the pattern groups found in `name`."""
    key = text.squeezed_name(F.col("name"))
    tests = []
    for pos, (standard, regexes) in enumerate(patterns):
        regex = "|".join(f"(?:{r.replace('_', '').replace(' ', '')})" for r in regexes)
        tests.append(F.when(key.rlike(regex), F.struct(
            F.lit(pos).cast("bigint").alias("std_pos"), F.lit(standard).alias("standard"),
            F.lit(fallback_type(standard)).alias("type"))))
    return F.filter(F.array(*tests), lambda h: h.isNotNull())


def fallback_type(standard: str) -> str:
    return "integer" if "count" in standard or standard == "year" else "string"


def fallback_schema(names: DataFrame, patterns=None) -> DataFrame:
    """(name, std_pos, standard, type): every pattern hit, or the name as its own standard.

    The patterns are a parameter table, so they become expressions of one projection - no join.
    Pass-through standards have no fixed position (NULL); they follow in name order.
    """
    patterns = defaults.FALLBACK_PATTERNS if patterns is None else patterns
    itself = F.struct(F.lit(None).cast("bigint").alias("std_pos"), text.snake_name(F.col("name")).alias("standard"),
                      F.lit("string").alias("type"))
    found = names.select("name", _pattern_hits(patterns).alias("hits"))
    taken = F.when(F.size("hits") > 0, F.col("hits")).otherwise(F.array(itself))
    return found.select("name", F.explode(taken).alias("h")).select("name", "h.*")


def effective_fallback(mapped: DataFrame) -> DataFrame:
    """One standard per name: the first pattern group that took it."""
    return mapped.groupBy("name").agg(
        F.min_by(F.struct("std_pos", "standard", "type"), F.coalesce("std_pos", F.lit(-1).cast("bigint"))).alias("m")
    ).select("name", "m.*")


def fallback_document(names: DataFrame, patterns=None) -> UnifiedSchema:
    """The fallback schema as a document (collects names: metadata-sized)."""
    rows = sorted(fallback_schema(names, patterns).collect(),
                  key=lambda r: (r.std_pos is None, r.std_pos or 0, r.name))
    mappings, types = {}, {}
    for r in rows:
        mappings.setdefault(r.standard, []).append(r.name)
        types.setdefault(r.standard, r.type)
    return UnifiedSchema(mappings, types)


# ---- proposals ----------------------------------------------------------------------------------

def strip_fence(response: Column) -> Column:
    """The body of the first ```json fence, else of the first ``` fence, else the whole text."""
    whole = text.text_strip(response)
    tagged = F.get(F.split(F.get(F.split(whole, "```json"), F.lit(1)), "```"), F.lit(0))
    fenced = F.get(F.split(whole, "```"), F.lit(1))
    body = (F.when(F.contains(whole, F.lit("```json")), tagged)
            .when(F.contains(whole, F.lit("```")), fenced).otherwise(whole))
    return text.text_strip(body)


def parse_proposals(responses: DataFrame, body: str = "response", schema: str = SCHEMA_TYPE) -> DataFrame:
    """Adds `parsed` (TRUE when the response holds a JSON object), `document` (NULL if not) and `other` (TRUE when it
    holds JSON of another kind: an array, a number, null)."""
    js = strip_fence(F.col(body))
    kind = F.schema_of_variant(F.try_parse_json("_json"))
    marked = responses.withColumn("_json", js).withColumn("_kind", kind).withColumn(
        "parsed", F.coalesce(F.startswith("_kind", F.lit("OBJECT")), F.lit(False)))
    marked = marked.withColumn("other", F.col("_kind").isNotNull() & ~F.col("parsed")).drop("_kind")
    return marked.withColumn("document", F.when(F.col("parsed"), F.from_json("_json", schema))).drop("_json")
