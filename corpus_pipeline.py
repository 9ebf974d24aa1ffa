"""Training text from raw documents: five stages, each one of the operators in netstats.llm.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return the columns of
documents. `run` writes each stage's rows to the shared folder and goes on from there, so that a lost executor
costs the current stage only; what the next stage has read is deleted. Null and empty texts are documents like others: of all of them
one stays. Rows equal in id and text are one document after the second stage. Without labels or items the stages that use them
keep all. No rows give no rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netstats.llm.bpe import token_digests
from netstats.llm.decontaminate import bounded, contained_items
from netstats.llm.exact import content_groups
from netstats.llm.quality import resample
from netstats.llm.shared import cut, removed, shared_folder
from netstats.llm.simhash import near_duplicates

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _name() -> Column:
    """What a row is known by: its id, a null one last, and its text. Two texts that share an id, or have none, are two documents."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.md5("text").alias("digest"))


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(_name().alias("doc_id"), "text")


def _only(docs: DataFrame, names: DataFrame) -> DataFrame:
    """The rows of `docs` whose `_name` is the doc_id of one of `names`."""
    marks = names.select(F.col("doc_id").alias("name")).distinct()
    columns = [F.col(f"d.{c}") for c in docs.columns]
    marked = docs.select(_name().alias("name"), F.struct("*").alias("d"))
    # The fields may be null, the name is not; its text is compared by hash, null with null.
    key = F.md5(F.to_json("name"))
    return marked.withColumn("key", key).join(marks.select(key.alias("key")), "key", "left_semi").select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = resample(docs.withColumn("_name", _name()), labels, also=("_name",))
    return _only(docs, scored.where("kept").select(F.col("_name").alias("doc_id")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space; of rows equal in id and text one."""
    kept = _only(docs, content_groups(_named(docs)).where("kept"))
    again = Window.partitionBy(F.md5(F.to_json(_name()))).orderBy(F.xxhash64(*docs.columns))
    return kept.withColumn("_again", F.row_number().over(again)).where("_again = 1").drop("_again")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group whose SimHash fingerprints links of three bits at most connect."""
    found = near_duplicates(_named(docs), shingle=3)
    return _only(docs, found.where("doc_id = component_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = bounded(cut(contained_items(docs, items, threshold=0.8).select(F.col("key").alias("_key")).distinct()))
    return docs.join(held, F.unhex(F.md5("text")) == F.col("_key"), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return token_digests(docs, TOKENIZER)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("decontaminate", decontaminate), ("encode", encode)]

#: SQL cannot express byte-level BPE, nor the hashes of the quality stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, last = f"{shared_folder(spark)}/{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
        if last:
            removed(spark, last)
        last = f"{folder}/{name}"
    return docs
