"""The registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm import (
    conversations, decontaminate, licenses, line_dedup, mixing, ngram_join, quality_model, quality_rules, spelling, suffix_dedup, toxicity,
    url_filters, warc,
)
from eodlake.llm.common import table

SEED = 11


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    docs = docs.select(
        "doc_id", "source", mixing.text_size("text").alias("words"), mixing.seeded(SEED, "doc_id", "text").alias("place")
    )
    mixed = mixing.mix(docs, F.col("words"), F.array("source"), F.col("place"), tie=("doc_id",))
    return mixed.select(
        "row.doc_id", "size", F.col("source_size")[0].alias("source_size"), F.col("target")[0].alias("target"), "taken"
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join_ngrams(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc_key.id").alias("doc_id"), F.col("item").alias("item_id"), "item_windows", "found_windows", "other_values"
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = warc.new_folder(spark)
    records = warc.read_warc(warc.write_warc(pages, folder), folder, with_payload=False)
    number = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.when(F.col("digest_ok"), F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    facts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_rules.cascade(docs, "text", facts=facts)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", *facts, base.alias("base_failed"), "kept")


def _held_out(of: int, rest: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of)) == rest


def _labelled(spark: SparkSession, sf_dir: str, label: str, of: int, rest: int, rows: tuple[int, int]) -> DataFrame:
    """(text, label) of a seeded sample of about `rows` labelled rows that may be learned from, of label 0 and 1."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label")).where(~_held_out(of, rest))
    totals = {r.label: r.n for r in labels.where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1_000_000)) / 1e6
    share = F.when(F.col("label") == 1, rows[1] / max(1, totals.get(1, 0))).otherwise(rows[0] / max(1, totals.get(0, 0)))
    sample = labels.where("label in (0, 1)").where(place < share)
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")


def _predictions(scored: DataFrame, of: int, rest: int) -> DataFrame:
    return scored.select(
        "doc_id", F.coalesce(_held_out(of, rest), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality_model.fit(_labelled(spark, sf_dir, "quality", 5, 0, quality_model.LABELLED_ROWS))
    return _predictions(quality_model.score(table(spark, sf_dir, "documents"), model), 5, 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.fit(_labelled(spark, sf_dir, "toxic", 4, 2, (toxicity.ORDINARY_ROWS, toxicity.TOXIC_ROWS)))
    return _predictions(toxicity.score(table(spark, sf_dir, "documents"), model), 4, 2)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files <source>/<language>/<id>."""
    part = lambda c: F.coalesce(F.col(c), F.lit("none"))
    files = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat_ws("/", part("source"), part("lang"), F.col("doc_id").cast("string")).alias("path")
    )
    return licenses.scan(files, "doc_id", "path", "text", licenses.matcher(files)).withColumnRenamed("id", "doc_id")


#: The rules that the contract of the query names.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), rules)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of conversations with the damage that the contract names; `there` is false for dropped rows."""
    space = F.lit(" ")
    text = F.coalesce("text", space)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), (F.crc32(name) % 20).alias("harm"))
    harm = F.col("harm")
    return rows.select(
        "conv_id", "turn", (harm != 0).alias("there"),
        F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(harm == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversations.repair(damaged(table(spark, sf_dir, "conversations")), there=F.col("there"))
    return found.withColumnRenamed("key", "conv_id")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.word_counts(table(spark, sf_dir, "documents"), harm=199))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_ngram_join": op3_ngram_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc": op5_warc,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_model": op7_quality_model,
    "op8_url_filters": op8_url_filters,
    "op9_toxicity": op9_toxicity,
    "op10_licenses": op10_licenses,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_repair_conversations": op12_repair_conversations,
    "op13_spelling": op13_spelling,
}
