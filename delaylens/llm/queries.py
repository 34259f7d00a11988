"""The operators as queries over the supplied tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm import addressable, alignment, collocations, exact, hashing, jaccard, langid, mixing, packing, quality, sharding, toxicity, warc
from delaylens.llm.common import fold_of, new_folder, table

SHARDS = 16
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
WINDOW = 4096
LEAST_PAYLOAD = 100
NEAREST = 20
QUERY_STEP = 20


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes."""
    placed = sharding.shard_texts(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source, weights 1, 2, 3 repeating."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, ["doc_id"], mixing.words(F.col("text")), "source", WEIGHTS, MOST_COPIES)
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def held_out(spark: SparkSession, sf_dir: str, folds: int, fold: int) -> DataFrame:
    """Texts of all documents, and whether their labels are held out."""
    kept_back = fold_of(F.col("doc_id"), folds) == fold
    return table(spark, sf_dir, "documents").select("doc_id", "text", kept_back.alias("held_out"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from two thirds of the labels."""
    docs, labels = held_out(spark, sf_dir, 3, 1), table(spark, sf_dir, "labels")
    net = quality.fit(docs.filter(~F.col("held_out")), F.col("quality"), labels=labels)
    found = quality.score(docs, net, ["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates among all documents; the largest doc_id stays."""
    return exact.duplicates(table(spark, sf_dir, "documents"), keep="largest").drop("_copy")


OP4_SQL = """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t FROM documents
    ), g AS (
        SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
    ), n AS (
        SELECT doc_id, t, row_number() OVER (PARTITION BY t, doc_id) AS copy FROM d
    )
    SELECT n.doc_id, g.keep_id, g.group_size,
        n.doc_id IS NOT DISTINCT FROM g.keep_id AND n.copy = 1 AS kept,
        sha256(n.t) AS text_sha256
    FROM n JOIN g ON n.t = g.t
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("record_id"), "url", F.col("html").cast("binary").alias("payload")
    )
    found = warc.read(warc.write(pages, new_folder(spark, "warc"), LEAST_PAYLOAD))
    return found.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP5_SQL = """
    WITH p AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), g AS (
        SELECT payload_digest, min(page_id) AS first_id, count(*) AS n FROM p
        WHERE payload_bytes >= 100 GROUP BY payload_digest
    )
    SELECT p.page_id, p.payload_bytes, p.payload_digest,
        CASE WHEN p.page_id IS DISTINCT FROM g.first_id AND g.first_id IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN p.page_id IS DISTINCT FROM g.first_id THEN g.first_id END AS refers_to
    FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest
"""


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.filter(~held_out), F.col("lang"))
    found = langid.label(docs.select("doc_id", "text", held_out.alias("held_out")), model, ["doc_id", "held_out"], spans=False)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents, five words, similarity 0.8."""
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op8_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every 20th vector among all others."""
    is_query = F.col("vec_id") % QUERY_STEP == 0
    return hashing.search(table(spark, sf_dir, "embeddings"), is_query, NEAREST)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from three quarters of the labels."""
    docs, labels = held_out(spark, sf_dir, 4, 2), table(spark, sf_dir, "labels")
    model, prior = toxicity.fit(docs.filter(~F.col("held_out")), F.col("toxic"), labels=labels)
    found = toxicity.score(docs, model, prior, ["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "terms")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences of at most 4096."""
    docs = table(spark, sf_dir, "documents")
    cut = packing.pieces(docs, ["doc_id"], tokenizer_path(), "text", END_ID, WINDOW)
    flat = cut.select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens")
    return packing.pack(flat, ["doc_id", "start", "ids_crc32"], WINDOW)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of two and three words of all documents, the first 2000 of each language."""
    return collocations.mine(table(spark, sf_dir, "documents"))


OP11_SQL = """
    WITH d AS (
        SELECT coalesce(lang, 'und') AS lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    ), p AS (
        SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d
    ), w AS (
        SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p
    ), g AS (
        SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
        FROM w, (VALUES (1), (2), (3)) AS sizes(m)
    ), f AS (
        SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY lang, m, phrase
    ), n AS (
        SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
    ), c AS (
        SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10
    ), k AS (
        SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM c
    ), s AS (
        SELECT k.lang, k.phrase, k.m, k.a, k.k, l.f AS l, r.f AS r,
            ((1000000::HUGEINT * k.a * k.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM k
        JOIN f AS l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ')
        JOIN f AS r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:], ' ')
    ), b AS (
        SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), i AS (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE m = 3
    ), x AS (
        SELECT DISTINCT c.lang, c.phrase FROM c JOIN i ON i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 50 * c.a
    ), o AS (
        SELECT b.lang, b.phrase, b.a, b.l, b.r, n.n, b.score,
            row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
        FROM b JOIN n ON n.lang = b.lang ANTI JOIN x ON x.lang = b.lang AND x.phrase = b.phrase
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned on the bytes of all documents."""
    docs = table(spark, sf_dir, "documents")
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    found = alignment.align(docs, F.col("doc_id").cast("long"), *paths)
    return found.withColumnRenamed("row", "doc_id")


def op13_addressable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as directly addressable codes and read back."""
    docs = table(spark, sf_dir, "documents")
    files = addressable.write(docs, new_folder(spark, "codes"), tokenizer_path("byte_bpe_50k.json"))
    return addressable.read(files).withColumnRenamed("key", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_exact": op4_exact,
    "op5_warc": op5_warc,
    "op6_langid": op6_langid,
    "op7_jaccard": op7_jaccard,
    "op8_hashing": op8_hashing,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_alignment": op12_alignment,
    "op13_addressable": op13_addressable,
}

ORACLES: dict[str, str] = {"op4_exact": OP4_SQL, "op5_warc": OP5_SQL, "op11_collocations": OP11_SQL}
