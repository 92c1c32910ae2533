"""A corpus from documents: reject, deduplicate, redact, mix, encode.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last give the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.durable import remove, shared_dir
from rivulet.llm import importance, mixing, pii, probminhash, spm
from rivulet.llm.queries import public_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: the documents that it rejects go. A null text has no features and weight 0; without labels of both
    kinds all stay; repeated rows share a verdict; an empty table gives an empty one."""
    return importance.keep(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates: one document of each group stays, that of the smallest id (null last). Texts without words are copies
    only of equal ones, null as empty; of repeated rows one stays."""
    return probminhash.keep_one(docs.select(*COLUMNS))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: every span found is replaced by its kind, and n_chars is the new length. A null text stays null and
    keeps its n_chars; rows stay as many as they are."""
    return pii.redact(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as the mix takes it, up to three times. A null source is one of its own, last; texts
    without words are taken in whole copies or by rank, at 0 words; of repeated rows as many are taken as bring the source nearest to its target."""
    return mixing.mixed(docs.select(*COLUMNS))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: ids, byte spans and decoded text of every document, as digests. A null text is empty: no ids; each of
    repeated rows has its row."""
    return spm.digests(docs, public_model())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", reject_poor),
    ("MinHash near-dedup", keep_one_of_each),
    ("PII", redact_personal),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: Most stages can't be expressed in SQL; tests hold them against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents. Each stage's result is stored in the shared folder, and deleted when the next is; other
    columns of documents than COLUMNS are left out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
        if k:
            remove(spark, f"{at}/{k - 1}")
    return docs
