"""From documents to packed training sequences: language, exact and near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that the next one reads. All but the last
return the columns of documents. No stage draws at random, so a run repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaylens.llm import exact, jaccard, langid, mixing, packing
from delaylens.llm.common import new_folder, table, text_bytes
from delaylens.llm.queries import END_ID, MOST_COPIES, WEIGHTS, WINDOW, tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known, be it one or several, learned from docs with a ``lang``.

    Null texts and texts without a letter go. Where no document has a ``lang``, all others stay.
    """
    model = langid.fit(docs, F.col("lang"))
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = langid.label(docs, model, docs.columns, spans=False)
    return found.filter(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def _first_of(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``_key`` of ``kept``, or all its rows where ``_all`` holds."""
    rows = docs.select(F.struct("*").alias("row"), key.alias("_key"))
    turn = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64("row")))
    joined = rows.join(kept, "_key").withColumn("_turn", turn)
    return joined.filter((F.col("_turn") == 1) | F.col("_all")).select("row.*")


def _key(*parts: Column) -> Column:
    return F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; of rows that repeat it, one. Null texts are empty."""
    found = exact.duplicates(docs, keep="largest").filter("kept")
    kept = found.select(_key(F.col("doc_id"), F.col("text_sha256")).alias("_key"), F.lit(False).alias("_all"))
    return _first_of(docs, _key(F.col("doc_id"), F.sha2(text_bytes(F.col("text")), 256)), kept)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the row with the smallest doc_id stays (null last); texts without words all stay."""
    found = jaccard.near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("best")
    best = found.filter("component IS NOT NULL").groupBy("component").agg(first)
    alone = found.filter("component IS NULL").select("doc_id", "print", F.lit(True).alias("_all")).distinct()
    kept = best.select("best.doc_id", "best.print", F.lit(False).alias("_all")).unionByName(alone)
    kept = kept.select(_key(F.col("doc_id"), F.col("print")).alias("_key"), "_all")
    return _first_of(docs, _key(F.col("doc_id"), F.xxhash64("text")), kept)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mixture of sources takes it."""
    mixed = mixing.mix(docs, docs.columns, mixing.words(F.col("text")), "source", WEIGHTS, MOST_COPIES)
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return mixed.filter("copies > 0").select("row", F.explode(copies)).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most 4096 tokens."""
    cut = packing.pieces(docs, ["doc_id"], tokenizer_path(), "text", END_ID, WINDOW)
    flat = cut.select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens")
    return packing.pack(flat, ["doc_id", "start", "ids_crc32"], WINDOW)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("pack", pack),
]

#: Learned labels and learned merges have no SQL; tests/llm compares every stage with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed documents; every stage but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
