"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, examples, leaks, lexical, lm, mixing, multiindex, omh, pieces, quality, toxicity, urlrules, warc, wrappers


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as WARC archives and read back, one row per record."""
    records = warc.read_archives(warc.write_archives(_table(spark, sf, "pages")), payloads=False)
    page = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).cast("long")
    return records.select(page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page(F.col("refers_to")).alias("refers_to"), "error")


def op2_language_model(spark: SparkSession, sf: str) -> DataFrame:
    """Log10 probability of every text by a model of nine tenths of them."""
    docs = _table(spark, sf, "documents").select("doc_id", "text", lm.held_out(F.col("doc_id")).alias("held_out"))
    model = lm.train(docs.where("NOT held_out"))
    return lm.score(docs, model, keep=("doc_id", "held_out"))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Expected grade and P(grade >= 1) of every document; selected where that is at least one half."""
    docs = _table(spark, sf, "documents")
    model = quality.train(docs, _table(spark, sf, "labels"), quality.grade_of(F.col("quality"), F.col("toxic")))
    return (quality.score(docs, model).withColumn("held_out", examples.held_out(F.col("doc_id")))
            .withColumn("selected", F.col("tail_probability") >= quality.SELECT))


def op4_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """The class of near copies of every document; the first of each class is kept."""
    found = omh.classes(_table(spark, sf, "documents"))
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("first.text_key"))
    return found.select("doc_id", "class_id", first.alias("kept"))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with every benchmark item that it holds."""
    groups = leaks.build(_table(spark, sf, "benchmark"))
    return leaks.scan(_table(spark, sf, "documents"), groups).select("doc_id", F.inline("leaks"))


def op6_multi_index(spark: SparkSession, sf: str) -> DataFrame:
    """Links of every embedding with cosine >= 0.9, and its component."""
    return multiindex.links(_table(spark, sf, "embeddings"))


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mixed = mixing.mix(_table(spark, sf, "documents"))["documents"]
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.extract(_table(spark, sf, "pages"))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of every document, with the ids of the labelled examples it rests on."""
    docs = _table(spark, sf, "documents")
    index = toxicity.train(docs, _table(spark, sf, "labels"))
    return (toxicity.score(docs, index).withColumn("held_out", examples.held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int")))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op10_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """The verdict on the URL of every page."""
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, RULES)) + " AS rules(host, path, verdict)")
    return urlrules.judge(_table(spark, sf, "pages"), rules)


def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten documents that fit each benchmark item best, by BM25 in whole numbers."""
    index = lexical.build(_table(spark, sf, "documents"))
    return lexical.search(index, _table(spark, sf, "benchmark"))


def op12_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Every text as ids and back again."""
    coded = pieces.encode(_table(spark, sf, "documents"))
    back = pieces.decode(coded, keep=("doc_id", "ids"), text="decoded")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding as a code of 16 bytes, with its error and that of its label."""
    coded, books = codes.compress(_table(spark, sf, "embeddings"), keep=("vec_id", "label"))
    return codes.grouped_error(coded).select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_language_model, op3_quality, op4_order_minhash, op5_decontamination, op6_multi_index, op7_mixing, op8_html_extraction, op9_toxicity, op10_url_filters, op11_lexical_search,
    op12_sentencepiece, op13_vector_codes)}
