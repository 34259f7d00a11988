"""Helpers shared by the operators: staged tables, bounded labelled samples, gapless numbers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaylens.operators.joins import skew_join
from delaylens.session import scratch_path

#: Code points 9 to 13 and 32 separate words.
WORD = "[^\\x20\\x09-\\x0D]+"
BLOCK_BITS = 14


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, removed when the driver ends."""
    path = scratch_path(spark, name)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    Cuts the lineage: what was computed is kept although executors may be lost.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the number written as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def with_class(
    rows: DataFrame, label: Column, labels: DataFrame | None, seed: int
) -> tuple[DataFrame, int, DataFrame | None]:
    """Arguments of :func:`labelled_rows` for a whole-number ``label`` of ``rows``, or of ``labels``."""
    kind = label.cast("int").alias("class")
    if labels is None:
        return rows.select("doc_id", "text", kind), seed, None
    return rows.select("doc_id", "text"), seed, labels.select("doc_id", kind)


def labelled_rows(rows: DataFrame, seed: int, labels: DataFrame | None = None) -> DataFrame:
    """Staged (doc_id, class, n, h, t, copies): ids, classes, and sizes and hashes of the texts of ``rows``.

    The class is a column of ``rows`` (doc_id, text, class), or that of ``labels`` (doc_id,
    class). Only ids, sizes and hashes are joined, so no text crosses a shuffle, however
    many labels there are. Rows without a class or an id are left out; equal ones are counted.
    """
    text, kinds = F.coalesce("text", F.lit("")), ["class"] if labels is None else []
    known = rows.dropna(subset=["doc_id", *kinds]).select(
        "doc_id", *kinds, F.octet_length(text).cast("long").alias("n"), F.xxhash64(text).alias("t")
    )
    thin = staged(known.groupBy("doc_id", *kinds, "n", "t").agg(F.count("*").alias("copies")), "sample")
    if labels is not None:
        marks = labels.dropna(subset=["doc_id", "class"]).groupBy("doc_id", "class").agg(F.count("*").alias("marks"))
        joined = skew_join(thin, marks, ["doc_id"]).withColumn("copies", F.col("copies") * F.col("marks"))
        thin = staged(joined.drop("marks"), "sample")
    return thin.withColumn("h", F.xxhash64(F.col("doc_id"), F.lit(seed)))


def labelled_sample(
    rows: DataFrame, per_class: int, class_bytes: int, seed: int, thin: DataFrame | None = None
) -> list[tuple[str, object]]:
    """Whole texts and classes of a bounded sample of ``rows`` (doc_id, text, and class unless in ``thin``).

    Of each class the rows with the smallest hashed ids are taken, at most
    ``per_class`` rows and ``class_bytes`` bytes, in that order; a text that does not
    fit what is left of the bytes is passed over. Rows without a class or an id are
    left out, and a class has none if each of its texts is larger than ``class_bytes``.
    The choice depends on the ids and texts alone. Rows that repeat id, class and text are
    counted, and their text comes back once, so no more than the sample reaches the driver.
    ``thin`` is the result of :func:`labelled_rows`, made here when not given.
    """
    if thin is None:
        thin = labelled_rows(rows, seed)
    wanted: dict[tuple[object, object, int], int] = {}
    order = ["h", "doc_id", "n", "t"]
    for (kind,) in thin.select("class").distinct().orderBy("class").collect():
        room, left = class_bytes, per_class
        own = thin.filter(F.col("class") == F.lit(kind))
        while left:
            # what does not fit now never will; the first row always fits
            found = own.filter(F.col("n") <= room).orderBy(*order).limit(left).collect()
            asked = left
            for r in found:
                taken = min(r["copies"], left, room // r["n"] if r["n"] else left)
                if taken:
                    room -= taken * r["n"]
                    left -= taken
                    wanted[r["doc_id"], r["class"], r["t"]] = taken
            if len(found) < asked:
                break
            last = F.struct(*[F.lit(found[-1][c]).cast(thin.schema[c].dataType).alias(c) for c in order])
            own = own.filter(F.struct(*order) > last)
    if not wanted:
        return []
    text, key = F.coalesce("text", F.lit("")), ["doc_id", "t"]
    picked = rows.sparkSession.createDataFrame(sorted({(i, t) for i, _, t in wanted}), thin.select(*key).schema)
    known = rows.select("doc_id", text.alias("text"), F.xxhash64(text).alias("t"))
    texts = known.join(F.broadcast(picked), key, "left_semi").groupBy(*key).agg(F.first("text").alias("text"))
    held = {(r["doc_id"], r["t"]): r["text"] for r in texts.collect()}
    found = sorted((i, kind, held[i, t], t) for i, kind, t in wanted)
    return [(text, kind) for i, kind, text, t in found for _ in range(wanted[i, kind, t])]


def with_block(df: DataFrame, name: str = "_block") -> DataFrame:
    """Name the block of at most 16,384 consecutive rows of its task that a row stands in."""
    return df.withColumn(name, F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS))


def numbered(df: DataFrame, key: str, order: list[str], out: str, placed: bool = False) -> DataFrame:
    """Number the rows of each key 0, 1, 2, ... without bringing a key's rows together.

    Rows are written with their block; numbers run inside (key, block), and only one
    count per key and block takes part in the sums over blocks. ``placed`` rows are
    staged with their block already.
    """
    rows = df if placed else staged(with_block(df), "numbered")
    counts = rows.groupBy(key, "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(key, "_block").orderBy(*order)
    ranked = rows.withColumn("_rank0", F.row_number().over(inside) - 1)
    return (
        ranked.join(starts, [key, "_block"])
        .withColumn(out, (F.col("_start") + F.col("_rank0")).cast("long"))
        .drop("_start", "_rank0", "_block")
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        values = batch.column(column)
        start = size = 0
        for i, n in enumerate(pa.compute.binary_length(values).to_pylist()):
            if i > start and size + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
