"""The corpus pipeline: five stages from ``documents`` to packed token sequences.

1. quality rules: documents that the current policy rejects go;
2. line dedup: lines that at least ten of the remaining documents share go;
3. MinHash near-dedup: one document of each group of near copies stays;
4. mixing: documents are repeated to bring the sources to their target weights;
5. packing: every remaining document is tokenized and placed in a sequence.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. ``run`` writes each stage's
rows as Parquet into the shared checkpoint folder and rereads them for the next.

Every stage hands on all columns of its input untouched but the text (and its length) that line
dedup changes, whatever their names.

Defined cases: those of the operators. A null text fails the quality rules. Rows that repeat
in id and text count as one document to the near-dedup stage, which keeps one of them; rows
without an id are kept or dropped by their own text. An empty table gives empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm import line_dedup, minhash_forest, packing, poisson_mix, quality_rules
from eddyline.llm.queries import documents
from eddyline.session import shared_path

# Packing cannot be stated in SQL (a tokenizer, best-fit decreasing): tested by brute force.
ORACLE_SQL = None


def private(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names of its own for all columns, so that no column of the input meets one that
    an operator adds, and the private names of those that the stages use."""
    names = [f"_in{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def given(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, under their names, from rows that carry them privately."""
    return out.select(*[F.col(f"_in{k}").alias(c) for k, c in enumerate(docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, at = private(docs)
    return given(quality_rules.apply_policy(quality_rules.ledger(rows, at["text"])).where("kept"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, at = private(docs)
    out = line_dedup.dedup_lines(rows, at["text"])
    if "n_chars" in at:
        out = out.withColumn(at["n_chars"], F.length(at["text"]).cast(docs.schema["n_chars"].dataType))
    return given(out, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, at = private(docs)
    return given(minhash_forest.keep_representatives(rows, at["text"], at["doc_id"]), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, at = private(docs)
    return given(poisson_mix.replicate(rows, poisson_mix.WEIGHTS, at["source"], at["doc_id"]), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.query(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("mix_sources", mix),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = documents(spark, sf_dir)
    base = shared_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
