"""The bounded sample that the classifiers learn from."""

import zlib

import pytest

from delaylens.llm import common, langid
from delaylens.llm.common import labelled_sample
from delaylens.llm.queries import QUERIES
from pyspark.sql import functions as F

SEED = 6


@pytest.fixture(scope="module")
def in_order(spark):
    """Ids in the order in which the sample takes them."""
    ids = spark.range(40).select("id", F.xxhash64("id", F.lit(SEED)).alias("h")).orderBy("h", "id")
    return [r["id"] for r in ids.collect()]


def table(spark, texts):
    return spark.createDataFrame([(i, t, k) for i, (t, k) in texts.items()], "doc_id long, text string, class string")


def greedy(in_order, texts, per_class, class_bytes):
    taken = []
    room = class_bytes
    for i in in_order:
        if i in texts and len(taken) < per_class and len(texts[i][0]) <= room:
            room -= len(texts[i][0])
            taken.append(i)
    return sorted((texts[i][0], texts[i][1]) for i in taken)


@pytest.mark.parametrize("large_at", [0, 1, 5])
@pytest.mark.parametrize("per_class", [4, 12, 100])
def test_sample_goes_on_after_a_large_text(spark, in_order, large_at, per_class):
    texts = {i: (f"{i:02d}" + "x" * (1 + 7 * i % 30), "a") for i in in_order}
    texts[in_order[large_at]] = ("y" * 301, "a")
    got = labelled_sample(table(spark, texts), per_class, 300, SEED)
    assert sorted(got) == greedy(in_order, texts, per_class, 300) and len(got) >= 4
    assert sum(len(t) for t, _ in got) <= 300


def test_language_with_a_large_first_text_is_learned(spark, in_order):
    english, french = "the children watch from the window ", "les enfants jouent dans la maison "
    texts = {i: ((english, "en") if n % 2 else (french, "fr")) for n, i in enumerate(in_order)}
    texts[in_order[0]] = (french * 100, "fr")
    docs = table(spark, texts).withColumnRenamed("class", "lang")
    assert langid.fit(docs, F.col("lang"), class_bytes=len(french) * 50).languages == ["en", "fr"]


def test_sample_holds_its_bound_where_ids_repeat(spark, in_order):
    """One id with a third of the rows, as copies of one text and as different texts."""
    first, second, *rest = in_order
    rows = [(first, f"{n:03d}" + "x" * 7, "a") for n in range(30)] + [(second, "y" * 10, "a")] * 30
    rows += [(i, "z" * 10, "a") for i in rest[:30]]
    df = spark.createDataFrame(rows, "doc_id long, text string, class string")
    for per_class, class_bytes in ((12, 10_000), (100, 95), (40, 10_000), (1000, 10_000)):
        got = labelled_sample(df.repartition(3), per_class, class_bytes, SEED)
        assert len(got) == min(per_class, class_bytes // 10, 90)
        assert sum(text.startswith("y") for text, _ in got) == min(30, max(0, len(got) - 30))
        assert sum(text[0].isdigit() for text, _ in got) == min(30, len(got))


def test_labels_of_their_own_choose_the_same_sample(spark, monkeypatch):
    """With labels in another table, repeated and with clashing columns, and no text in any join that shuffles."""
    texts = {i: (f"{i:02d} " + "x" * (1 + 7 * i % 30), i % 3 if i % 3 < 2 else None) for i in range(60)}
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in texts.items()] + [(7, "again", 1), (None, "x", 1)], "doc_id long, text string, class int")
    marks = docs.select("doc_id", "class").distinct()
    clash = marks.withColumns({"text": F.lit("other"), "held_out": F.lit(True), "n": F.lit(1), "t": F.lit(2), "quality": F.col("class")})
    seen = []
    joined = common.skew_join

    def watched(facts, dim, on, **params):
        seen.append((facts.columns, dim.columns))
        return joined(facts, dim, on, **params)

    monkeypatch.setattr(common, "skew_join", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        args = common.with_class(docs, F.col("quality"), clash, SEED)
        thin = common.labelled_rows(*args)
        got = labelled_sample(docs, 15, 400, SEED, thin)
        expected = labelled_sample(docs, 15, 400, SEED)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == expected and len(got) > 20
    assert seen and all("text" not in columns for pair in seen for columns in pair)


def test_labelled_queries_with_clashing_columns(spark, tmp_path):
    rows = [(i, f"good plain words number {i}" if i % 2 else f"bad awful mess {i}!!!", "en") for i in range(60)]
    rows += [(1, None, None), (None, "no id", "en"), (2, rows[2][1], "en"), (200, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"class": F.lit(9), "held_out": F.lit("x")})
    labels = spark.range(60).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"), (1 - F.col("id") % 2).alias("toxic"),
        F.lit("clash").alias("text"), F.lit(1).alias("held_out"), F.lit(2).alias("class"), F.lit(3).alias("copies"),
    )
    for n, some in (("full", labels), ("none", labels.limit(0))):
        some.write.parquet(f"{tmp_path}/{n}/labels.parquet")
        docs.write.parquet(f"{tmp_path}/{n}/documents.parquet")
        for name, folds, fold in (("op3_quality", 3, 1), ("op9_toxicity", 4, 2)):
            found = QUERIES[name](spark, f"{tmp_path}/{n}").collect()
            assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
            known = {r["doc_id"]: r["held_out"] for r in found if r["doc_id"] is not None}
            assert all(known[i] == (zlib.crc32(str(i).encode()) % folds == fold) for i in known)
