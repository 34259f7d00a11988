"""The whole pipeline and its queries on a small Parquet table, against plain Python."""

from collections import Counter

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from delaylens.llm import langid, mixing
from test_operators import brute_exact, brute_near, check_packed

WORDS = {
    "en": "the children watch quick brown foxes from their window while older people walk home through rain".split(),
    "fr": "les enfants jouent près de la rivière dans une vieille maison avec leurs amis ce matin".split(),
}


def text(lang, seed, n=40):
    words = WORDS[lang]
    return " ".join(words[(seed * 7 + i * i + seed * i) % len(words)] + "abcdefghij"[(seed + 3 * i) % 10] for i in range(n))


def documents():
    rows = []
    for i in range(40):
        lang = "en" if i % 2 else "fr"
        rows.append((i, text(lang, i), lang, "abc"[i % 3]))
    changed = rows[4][1].split()
    changed[20] = "changed"
    rows += [(100, rows[3][1], "en", "a"), (101, rows[3][1], "en", "b"), (102, rows[8][1], "fr", "c")]  # exact copies
    rows += [(110, " ".join([*rows[5][1].split(), "end"]), "en", "a"), (111, " ".join(changed), "fr", "a")]  # one near, one not
    rows += [(120, "12 34 !!", "en", "a"), (121, None, "en", "b"), (122, "", "fr", "c"), (123, "De.", "fr", "c")]
    return rows


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("documents")
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(documents(), schema).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def survivors():
    """Rows that plain Python keeps after each of the first three stages."""
    language = [r for r in documents() if langid.LETTERS.search(r[1] or "")]
    largest = {}
    for r in language:
        largest[r[1]] = max(largest.get(r[1], r[0]), r[0])
    exact = [r for r in language if largest[r[1]] == r[0]]
    near = [r for r in exact if any(least == r[0] for (i, _, least) in brute_near(exact) if i == r[0])]
    return {"language": language, "exact_duplicates": exact, "near_duplicates": near}


def test_each_stage_keeps_exactly_the_right_rows(spark, base):
    want = survivors()
    assert len({len(rows) for rows in want.values()} | {len(documents())}) == 4  # each stage has something to drop
    docs = spark.read.parquet(f"{base}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, base)
        assert sorted(map(tuple, docs.collect())) == sorted(want[name]), name


def test_run_packs_the_mixture_of_the_survivors(spark, base):
    near = spark.createDataFrame(survivors()["near_duplicates"], spark.read.parquet(f"{base}/documents.parquet").schema)
    mixed = [(r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)["mixture"](spark, near, base).collect()]
    source = {r[0]: r[3] for r in documents()}
    sizes, taken = Counter(), Counter()
    for i, t, _, s in survivors()["near_duplicates"]:
        sizes[s] += len(t.split())
    for i, t in mixed:
        taken[source[i]] += len(t.split())
    names = sorted(sizes)
    targets = mixing.capped_targets([sizes[s] for s in names], [1, 2, 3], sum(sizes.values()), 3)
    assert len(mixed) > 20 and all(abs(taken[s] - t) <= 41 for s, t in zip(names, targets)), (taken, targets)
    check_packed(corpus_pipeline.run(spark, base).collect(), mixed)


def test_exact_query_equals_brute_force(spark, base):
    got = entry_points.queries()["op4_exact"](spark, base)
    found = got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert Counter(map(tuple, found)) == brute_exact(documents())


def test_mixing_query_takes_every_document(spark, base):
    got = {r["doc_id"]: r for r in entry_points.queries()["op2_mixing"](spark, base).collect()}
    assert sorted(got) == sorted(r[0] for r in documents())
    for i, t, _, _ in documents():
        assert got[i]["size"] == len((t or "").split()) and got[i]["taken"] == got[i]["size"] * got[i]["copies"]
