"""The corpus pipeline: documents in, a manifest of balanced shards out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import decontaminate, language_id, mixing, sharding, superminhash
from waymark.llm.storage import materialize

N_SHARDS = 8


def whole_rows(docs: DataFrame) -> DataFrame:
    """doc_id and text beside the whole row, so that no other column's name can clash."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that belong to no learned language, or have no letters, go.

    Models are learned from the documents that come in; ``lang`` stays as it is.  Repeated
    rows fare alike, a null id is as good as any; without any ``lang`` nothing is learned and
    all documents go.  An empty table stays empty.
    """
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    told = whole_rows(docs).withColumn("language", language_id.identify(docs, model))
    return told.where("not language.rejected").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of five-word-shingle near copies the document of smallest id stays.

    Rows are compared under a 64-bit hash of id and text, so a row without an id is grouped
    like any other; it stays only if its group has no id.  Of texts without words, rows that
    repeat an id and a text stay once and rows without an id all stay.
    """
    keyed = whole_rows(docs).withColumn("key", F.xxhash64("doc_id", "text"))
    groups = superminhash.near_duplicates(keyed.select("key", "text"), k=5, percent=80, id_col="key")
    # rows of one key are alike: which one stays is settled at the end
    groups = groups.groupBy(F.col("id").alias("key")).agg(
        F.count(F.lit(1)).alias("times"), F.max("n_shingles").alias("n"), F.max("component_id").alias("component")
    )
    ids = keyed.groupBy("key").agg(F.max("doc_id").alias("doc_id"))
    group = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "times", "n"))
    chosen = groups.join(ids, "key").groupBy(group.alias("group")).agg(first.alias("first")).select("first.*")
    chosen = materialize(
        chosen.select("key", ((F.col("times") == 1) | (F.col("n") == 0) & F.col("no_id")).alias("all")), "chosen"
    )
    kept = keyed.select("key", "row").join(chosen, "key")
    repeated = kept.where("not all").groupBy("key").agg(F.first("row").alias("row"))
    return kept.where("all").select("row").unionByName(repeated.select("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of a benchmark item go; all others stay whole.

    Repeated rows fare alike; a null or empty text holds nothing and stays.  Without items all
    stay; an empty table stays empty.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = decontaminate.with_verdict(decontaminate.find_hits(whole_rows(docs), benchmark))
    return hits.where("not contaminated").select("row.*")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document stands in as many rows as the mix takes.

    A text without words is never taken.  Rows that share id and text are interchangeable,
    and equal hashes are ordered by size.  An empty table stays empty.
    """
    sized = docs.select(
        "doc_id",
        "source",
        mixing.word_count(F.col("text")).alias("size"),
        mixing.row_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.struct(*docs.columns).alias("row"),
    )
    mixed = mixing.mix_sources(sized, key_col="key").where("copies > 0")
    rows = mixed.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return rows.select("row.*")


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest: shard and slot of every row, with its size and checksum but no text.

    Rows are ordered by id (null first), size and checksum; equal ones are interchangeable.
    An empty table gives an empty manifest.
    """
    narrow = docs.select(
        "doc_id",
        "lang",
        "source",
        sharding.record_bytes(F.col("text")).alias("size"),
        F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    return sharding.assign_shards(narrow, "size", ["doc_id", "size", "text_crc32"], N_SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_to_targets),
    ("sharding", assign_shards),
]
#: A language model's verdicts are not expressible in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
