"""The corpus pipeline: five stages over the documents, each one of the training-data operators.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame, and its
result is written as Parquet and read again as the next one's ``docs``. All stages but the last return
the columns of ``documents``; the last returns the packed pieces.

NULLs, empty texts, repeated rows, empty tables and extra columns are each operator's to define (see its docstring); extra columns
pass through the first four stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from tidemark.llm.common import fold, materialize, read_table
from tidemark.llm.queries import vocabulary

# A document of which lines found elsewhere make up this share and that is shown to be a near copy of one other document keeps
# that document's lines: the join below decides about it as a whole. All others lose theirs; a text that loses all becomes empty.
COPY_SHARE = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from labelled documents whose id is not in fold 0 of 5."""
    return toxicity.reject_toxic(docs, read_table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of templates that recur across documents; ``n_chars`` follows the text."""
    cleaned = line_dedup.dedup_lines(docs, copy_share=COPY_SHARE)
    n_chars = F.when(F.col(cleaned.columns[-1]) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones (five-word shingles, similarity of 0.8 or more)."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark passages."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, packed into sequences of 4096 tokens (best-fit decreasing)."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), units="bare")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Training a classifier, tokenization and best-fit packing are not expressible in SQL.
ORACLE_SQL = None
