"""The corpus pipeline: documents through five stages, each written to the shared scratch folder and read again.

Quality classifier, n-gram Jaccard join (one document of each near-duplicate group stays), benchmark decontamination,
mixing of sources to target weights, sharding. All stages but the last return the columns of `documents`; the last
adds `shard` and `slot`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estratos.llm import decontamination, jaccard, mixing, quality, sharding
from estratos.llm.common import held_out, read, written

#: Documents with a lower score are rejected.
LEAST_SCORE = 0.3
SHARDS = 16


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier accepts; it never learns from labels of fold 0 of 5."""
    labels = read(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    vectors, network = quality.fit(docs.select("doc_id", "text"), labels, docs.select("text"))
    return quality.accepted(docs, vectors, network, LEAST_SCORE)


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by 5-word shingles with a similarity of 0.8 or more."""
    return jaccard.deduplicate(docs, 5, 80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that share no window of 10 words with the benchmark."""
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw each source to its target; a document that is taken several times is as many rows."""
    return mixing.draws(docs).select("row", F.explode("copies")).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shuffle into shards of equal numbers of rows."""
    return sharding.shuffle_into_shards(docs, SHARDS)


STAGES = [
    ("quality classifier", classify),
    ("n-gram jaccard join", join_near),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: Training a network is not expressible in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
