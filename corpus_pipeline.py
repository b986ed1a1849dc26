"""A training-data pipeline of five of the operators, each stage written and read again.

1. quality: documents that the quality classifier scores below its threshold go.
2. lines: later occurrences of three-line windows go from the texts.
3. near_copies: of each group of near copies (five-word shingles, similarity 0.8 or more) the
   document with the smallest id stays.
4. benchmark: documents that hold a window of a benchmark item go.
5. pieces: SentencePiece ids of every text that is left, and their decoding.

A stage works on all that its predecessor kept; all but the last return the columns of documents.
The first stage has no SQL form, so the pipeline is tested against plain versions of its stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.llm.common import importable, table
from revlens.llm.decontaminate import drop_contaminated
from revlens.llm.line_dedup import clean_lines
from revlens.llm.near_dedup import drop_near_copies
from revlens.llm.piece_bpe import encode_texts
from revlens.llm.quality import drop_low_quality
from revlens.session import written

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return drop_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return encode_texts(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark),
          ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage: (doc_id, n_tokens, ids, decoded)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
