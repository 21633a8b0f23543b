"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; ``run`` writes each result as Parquet and reads it for
the next. All stages but the last return the columns of ``documents``.

Defined results of every stage: an empty table gives an empty one; a null text
stays null and counts as empty; extra columns of ``documents`` pass through;
texts of any length are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import bagminhash, decontam_fm, line_dedup, packing, toxicity
from foliant.llm._spark import cut, table
from foliant.llm.queries import tokenizer_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, scores below a half.

    Null and empty texts score by the intercept alone; repeated rows stay or go
    together; without labels of both classes every row has one score.
    """
    model = toxicity.classifier(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand in an earlier place.

    Places are ordered by doc_id (null last), text's hash and line number; empty
    lines stay; a document of which every line goes stays with an empty text;
    repeated rows keep the same lines; n_chars is counted anew.
    """
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies.

    The one of the least doc_id (null last), among equal ones of the least text
    name; null and empty texts are one class; of repeated rows one stays.
    """
    return bagminhash.drop_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; stray benchmark passages are cut out of the others' texts.

    Repeated rows are judged each; a null text is not contaminated; an empty
    benchmark changes nothing; n_chars of a text that was cut is counted anew.
    """
    found = decontam_fm.benchmark_hits(docs, table(spark, sf_dir, "benchmark")).filter(~decontam_fm.is_contaminated())
    text = F.when(F.col("n_hit") > 0, decontam_fm.without_spans(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_hit") > 0, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumns({"n_chars": n_chars, "text": text}).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences.

    A null or empty text is a piece of the end id alone; repeated rows are packed
    each; ties go to the earlier document and the lower sequence.
    """
    return packing.pack(docs, tokenizer_path(), size=1024, end_id=0)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Trained models, MinHash candidates and tokenizers are beyond SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return cut(STAGES[-1][1](spark, docs, sf_dir))
