"""Corpus pipeline: toxicity, exact dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. ``run`` writes each stage to the folder in spark.checkpoint.dir and reads
it again for the next; a stage's table is removed when the next one is written.

Every stage takes an empty table to an empty one, null texts for empty ones,
repeated rows for rows of their own, and leaves columns that it doesn't know as
they are, whatever their names; the last one returns pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from junctura.checkpoints import checkpoint_folder
from junctura.llm import contentsort, mixing, packing, simhash, toxicity
from junctura.llm.common import removed
from junctura.llm.queries import tokenizer_path

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay; null and empty texts score by the model's bias."""
    taken = {c.lower() for c in docs.columns}
    out = next(n for k in range(len(taken) + 1) if (n := f"__score{k}") not in taken)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, out=out).where(f"{out} < {TOXIC}").drop(out)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, of rows that tie in it one; null texts equal empty ones."""
    return contentsort.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays; rows of one doc_id count as one, and a null doc_id stays."""
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one without words is never taken. Reruns agree."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens; an empty text is its end token alone."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No stage but the second can be said in SQL; tests hold the operators against plain versions or held-out rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents in turn."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            removed(spark, last)
        last = path
    return docs
