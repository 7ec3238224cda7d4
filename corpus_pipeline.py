"""The corpus pipeline: documents in, packed token sequences out.

Each stage calls one operator, works on all that its predecessor kept, and is
written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import outliers, packing, simhash, substrings, toxicity
from reviewloom.llm.common import read_table, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(model) < 0.5)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language and source."""
    return outliers.robust_outliers(docs).where("kept").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of fingerprints within 3 bits.

    A row repeated with its id and text stays once; of several texts of one id that
    name the group, the one of the smallest hash stays.  Rows without an id cannot be
    named and stay.
    """
    known = docs.where("doc_id is not null")
    groups = simhash.near_duplicate_groups(known, radius=simhash.RADIUS)
    first = (
        groups.groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
        .select(F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("__hash"))
    )
    # One narrow row per group against one row per id: nothing to be skewed.
    hashed = known.withColumn("__hash", simhash.text_hash(F.col("text")))
    chosen = hashed.join(first.hint("merge"), ["doc_id", "__hash"], "left_semi")
    once = chosen.dropDuplicates(["doc_id", "__hash"])
    return once.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages; untouched ones as they were."""
    columns = docs.columns
    kept = substrings.remove_repeats(docs, keep=tuple(columns))
    text = F.when(F.col("n_removed") == 0, F.col("given_text")).otherwise(F.col("kept"))
    changed = {
        "text": text,
        "n_chars": F.when(F.col("n_removed") == 0, F.col("given_n_chars")).otherwise(
            F.length("kept").cast("bigint")
        ),
    }
    return kept.select(*[changed.get(c, F.col(f"given_{c}")).alias(c) for c in columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

# Model fitting, components and packing have no SQL form; tests compare each stage
# with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
