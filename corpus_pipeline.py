"""From raw documents to packed training sequences, in four stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.llm import jaccard_join, mixing, packing, quality
from joulemart.llm.components import written
from joulemart.session import new_work_dir

#: Documents scored lower are rejected.
QUALITY_THRESHOLD = 0.3
#: Up to so many keys (of 8 bytes) are sent to every task.
BROADCAST_KEYS = 500_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier finds poor; it learns from `labels` without the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.filter(~quality.held_out(F.col("doc_id"))))
    scored = quality.score(docs, model, column="__score")
    return scored.filter(F.col("__score") >= QUALITY_THRESHOLD).select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of every group that 5-word shingles of 80 % similarity link.

    Of equal rows one stays, and so does of rows with one doc_id in one group; rows with one doc_id and
    different texts are judged each by its own text. Documents without words stay, and so do those without
    a doc_id, of which equal ones are one.
    """
    found = written(jaccard_join.similar_documents(docs, identity_too=True), "similar")
    losers = _sent_out(found.filter("not keeper and doc_id is not null").select(F.col("doc_id").alias("__id")).distinct())
    kept = docs.join(losers, F.col("doc_id") == F.col("__id"), "left_anti")
    # A key that several rows have does not tell which of them is meant.
    again = found.groupBy("doc_id").count().filter("count > 1").select(F.coalesce("doc_id", F.lit(jaccard_join.NO_KEY)).alias("__id"))
    again = _sent_out(written(again, "repeated"))
    is_again = F.coalesce("doc_id", F.lit(jaccard_join.NO_KEY)) == F.col("__id")
    several = docs.join(again, is_again, "left_semi").withColumn("__text", F.coalesce(F.md5("text"), F.lit("")))
    texts = several.filter("doc_id is not null").select("doc_id", "__text", "text").dropDuplicates(["doc_id", "__text"])
    identity = ["doc_id", "n", "d1", "d2"]
    keepers = found.filter("keeper").select(*identity, "component").distinct()
    judged = jaccard_join.set_digests(texts).join(keepers, identity)
    # Of a group one text, of those without words each.
    stay = judged.groupBy("doc_id", "component", F.when(F.col("n") == 0, F.col("__text"))).agg(F.min("__text").alias("__text"))
    own = several.join(stay.select("doc_id", "__text"), ["doc_id", "__text"], "left_semi").select(*several.columns)
    twice = own.union(several.filter("doc_id is null")).dropDuplicates(["doc_id", "__text"])
    return kept.join(again, is_again, "left_anti").union(twice.drop("__text"))


def _sent_out(keys: DataFrame) -> DataFrame:
    """Keys to join by: sent to every task if they are few, else left to a shuffle."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that a source of n has a share in proportion to the root of n."""
    return mixing.poisson_mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of 2,048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", keep_one_of_similar),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: A learned classifier and tokenizer ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each from the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
