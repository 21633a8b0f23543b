"""The queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bagminhash, chat_format, decontam_fm, html_blocks, kneser_ney, line_dedup, packing, separator_scan, spotsigs, toxicity
from ._spark import table

#: <|endoftext|> of the vocabulary, which no text yields.
SEPARATOR = 50256


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _rest(column, modulus: int):
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus, F.lit(-1))


def op1_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), size=1024, end_id=0)


def op2_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "\\### Assistant: </turn> ok"
    fixed = spark.range(2, numPartitions=1).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    messages = own.unionByName(fixed).withColumn("content", chat_format.text_parts(F.col("text")))
    formatted = chat_format.format_chat(messages)
    read = formatted.withColumn("turns", chat_format.parse_chat(F.col("formatted"))).withColumn("masked", chat_format.masked_text(F.col("formatted"), F.col("spans")))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.classifier(docs, labels.filter(_rest(F.col("doc_id"), 5) != 0))
    scored = toxicity.score(docs, model)
    # how many counterfactual texts training formed, and how many of them had other features
    formed = [F.lit(n).cast("long").alias(k) for k, n in (("counterfactuals", model.swapped), ("counterfactuals_moved", model.held))]
    return scored.select("doc_id", (_rest(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", *formed)


def op5_bagminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = bagminhash.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select("doc_id", "class_id", "class_rows")


def op6_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam_fm.benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), decontam_fm.is_contaminated().alias("contaminated")
    )


def op7_kneser_ney_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _rest(F.col("doc_id"), 7) == 2
    model = kneser_ney.train(docs.filter(~held_out))
    scored = kneser_ney.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score", kneser_ney.perplexity().alias("perplexity"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_blocks.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op9_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def spotsigs_near_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9's join over all documents; beside op9's query, whose columns leave no room for it."""
    return spotsigs.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_separator_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, manifest = separator_scan.write_flat(table(spark, sf_dir, "documents"), tokenizer_path(), SEPARATOR)
    counted = separator_scan.scan_files(spark, f"file://{path}", SEPARATOR)
    counted = counted.withColumn("file", F.substring_index("file_id", "/", -1).cast("long"))
    # the scan knows documents by their places alone; the manifest gives them their names
    return counted.join(manifest, ["file", "ordinal"], "left").select("doc_id", "n_tokens", F.col("file").alias("file_id"), "ordinal", "start", "ended")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_cost_balanced_packing,
        op2_fuzzy_line_dedup,
        op3_chat_formatting,
        op4_counterfactual_toxicity,
        op5_bagminhash_near_dedup,
        op6_fm_index_decontamination,
        op7_kneser_ney_scoring,
        op8_html_extraction,
        op9_spotsigs_fingerprints,
        op10_separator_token_counts,
        spotsigs_near_classes,
    )
}

_ESCAPED = r"replace(replace(replace({0}, '\', '\b'), '#', '\h'), '<', '\l')"

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op3_chat_formatting": rf"""
WITH m AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || replace({_ESCAPED.format("role")}, chr(10), '\n') || chr(10) || {_ESCAPED.format("text")} || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM m GROUP BY conv_id""",
}
