"""Archives rolled by size and read side by side, with one payload on a third of the pages."""

import hashlib

from delaylens.llm import warc
from delaylens.llm.common import new_folder
from pyspark.sql import functions as F


def test_hot_payload_rolled_archives_and_parallel_reading(spark):
    same = F.lit("the same page " * 20)
    pages = spark.range(900).select(
        F.col("id").alias("record_id"), F.concat(F.lit("http://h/"), "id").alias("url"),
        F.when(F.col("id") % 3 == 0, same).otherwise(F.concat(F.lit("page "), F.sha2(F.col("id").cast("string"), 512))).cast("binary").alias("payload"),
        F.lit("x").alias("archive"), F.lit(1).alias("digest"),
    )
    archives = warc.write(pages.repartition(5), new_folder(spark, "warc-test"), most=9000)
    assert archives.count() > 8 and archives.agg(F.sum("records")).first()[0] == 900
    read = warc.read(archives)
    assert read.rdd.getNumPartitions() == archives.count()
    rows = {r["record_id"]: r for r in read.collect()}
    hot = hashlib.sha256(b"the same page " * 20).hexdigest()
    for i in range(900):
        expected = ("response", None) if i % 3 or i == 0 else ("revisit", 0)
        assert (rows[i]["record_type"], rows[i]["refers_to"]) == expected
        assert i % 3 or (rows[i]["payload_digest"], rows[i]["payload_bytes"]) == (hot, 280)
        assert (rows[i]["payload"] is None) == (expected[0] == "revisit")
