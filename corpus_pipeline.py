"""A training corpus from the ``documents`` table, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``.  All but the last return the columns of ``documents``.

1. quality classifier: documents that it rejects go;
2. exact de-duplication: one row of equal texts stays.  The session's ``lexiflow.digest.index`` names an index folder
   that is kept over runs, and ``lexiflow.batch.id`` this run's batch: a run that is repeated under the same id
   decides as before, another one drops what earlier batches brought.  Unset, each run has an index of its own;
3. MinHash near-duplicates (5-word shingles, similarity 0.8): one document of each group stays;
4. mixing: documents are taken at rates that bring toxic text down to its limit of the tokens, at the
   largest total for which no domain has to grow; no rate exceeds 1, so nothing is doubled, and where toxic text
   is below the limit, nothing is dropped; a limit that can't be met is logged;
5. BPE: token ids and the text they decode to.

Nulls in any column, empty and very long texts, ties, repeated rows and empty tables have the results that each operator's
text defines (a null or empty text scores as such, copies of it go, it is never a near copy, and it has no
tokens); of equal rows the exact stage keeps one; columns beyond those of ``documents`` are carried through the
first four stages whatever their names, and left out by the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.llm import bpe, exact_dedup, minhash, mixing, quality_gbdt
from lexiflow.llm.common import materialise, table, workers_import

#: Target token shares of the mix, toxic text's an upper limit; what the quality stage rejects is no domain any more.
TARGETS = {"clean": 0.97, "toxic": 0.03}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return quality_gbdt.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, spark.conf.get("lexiflow.digest.index", None))
    kept = exact_dedup.drop_copies(docs, index, batch_id=spark.conf.get("lexiflow.batch.id", None))
    index.close()
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marks = table(spark, sf_dir, "labels").filter("toxic IS NOT NULL")
    domains = marks.select("doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("domain"))
    return mixing.mix(docs, domains, TARGETS, total="down", limits=("toxic",))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, decoded."""
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("BPE", encode),
]

#: Trained models decide in the first and fourth stage, which SQL can't express; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the ``documents`` in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
