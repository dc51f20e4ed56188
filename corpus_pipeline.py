"""A training corpus from raw documents: filter, deduplicate, cut repeats, mix, pack."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.llm import mixing, packing, quality, simhash_dedup, substring_dedup  # noqa: E402
from tidemark.llm.common import written  # noqa: E402


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _stage(work: Callable) -> Callable:
    """A stage that gets and gives all columns; those not of documents wait under other names."""

    @wraps(work)
    def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names, given = [], docs.columns
        for i, name in enumerate(given):
            names.append(name if name in COLUMNS and name not in names else f"o{i}")
        others = tuple(n for n in names if n not in ("doc_id", "text"))
        out = work(spark, docs.toDF(*names), others, sf_dir)
        if "n_chars" in names:
            out = out.withColumn("n_chars", F.length("text").cast("long"))
        return out.select(*names).toDF(*given)

    return apply


@_stage
def quality_filter(spark, docs, others, sf_dir):
    """Drops the documents that the quality classifier rejects."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.classify(docs, model, carry=others, keep_text=True).filter("predicted = 1")


@_stage
def near_dedup(spark, docs, others, sf_dir):
    """Keeps one document of each group of near copies."""
    return simhash_dedup.deduplicated(docs, carry=others)


@_stage
def repeat_cut(spark, docs, others, sf_dir):
    """Cuts passages that an earlier document holds; n_chars is counted anew."""
    cut = substring_dedup.substring_dedup(docs, carry=others, rejoin=False)
    return cut.withColumn("text", F.col("kept"))


@_stage
def source_mix(spark, docs, others, sf_dir):
    """Repeats and cuts the documents of each source to its share of words."""
    return mixing.mixed_documents(docs, carry=others)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", repeat_cut),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", pack),
]

# SQL has none of: nearest neighbours in a latent space, XXH64, byte-level BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's rows are a table in the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
