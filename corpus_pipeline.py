"""From raw documents to packed training sequences.

STAGES are (name, function) in order.  A function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and reread as the next
one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.llm import common, decontaminate, lines, minhash, packing, quality
from vetline.llm.queries import tokenizer_path
from vetline.sources.tables import read_table

SHINGLE, PERCENT, SUB_KEYS = 5, 80, 12      # near-duplicates of the pipeline: five words, 0.8; missed with 1e-5 at most

# Models, minimum hashes and packing are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def _stage(fn):
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.configure(spark)
        return fn(spark, docs, sf_dir)
    return run


@_stage
def quality_stage(spark, docs, sf_dir):
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


@_stage
def line_stage(spark, docs, sf_dir):
    """Texts without repeated lines; documents of which nothing is left go."""
    out = lines.without_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_stage
def near_stage(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return minhash.one_of_each(docs, shingle=SHINGLE, percent=PERCENT, sub_keys=SUB_KEYS)


@_stage
def benchmark_stage(spark, docs, sf_dir):
    """Documents into which no benchmark item leaks."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


@_stage
def packing_stage(spark, docs, sf_dir):
    """The pieces of the documents and their places in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.configure(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
