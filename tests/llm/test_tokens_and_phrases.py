"""Collocations, token alignment and addressable codes against plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from delaylens.llm import addressable, alignment, collocations
from delaylens.llm.automaton import Automaton, automaton, united
from delaylens.llm.common import new_folder
from delaylens.llm.queries import OP11_SQL, QUERIES, tokenizer_path
from delaylens.llm.tokens import TextIds
from pyspark.sql import functions as F

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
EXTRA = "key long, row string, rank int, block int, pair string, lang string, range string, phrase string, part int"
WORDS = "the of a New York Zürich big apple pie new deal über straße it's 12 3.5 x".split()


def texts():
    draw = random.Random(5)
    made = [" ".join(draw.choice(WORDS) + draw.choice(["", "", "", ".", ",", "\n", " \t"]) for _ in range(n)) for n in (0, 1, 5, 60, 300, 900)]
    odd = [None, "", " ", "\n\n", "a  b", "日本 語 text", "x <|endoftext|> y", "▁mark", "tab\there\x00z", "İstanbul ŉ é́", "A. B, C"]
    return [*made, *odd, made[4], made[4], made[3], "word " * 20_000]


def documents(spark):
    rows = [(i // 2 if i else None, t, (None, "en", "de")[i % 3], 1) for i, t in enumerate(texts())]
    rows += [rows[5], rows[5], (7, None, None, None)]
    base = spark.createDataFrame(rows, "doc_id long, text string, tag string, extra int")
    extra = [f.strip().split(" ") for f in EXTRA.split(",") if not f.strip().startswith("lang")]
    return base.select("doc_id", "text", F.col("tag").alias("lang"), *[F.lit(None).cast(t).alias(n) for n, t in extra])


@pytest.mark.parametrize("name, spaced, plain", [(BYTE_LEVEL, True, False), (BYTE_LEVEL, True, True), ("word_bpe_49k.json", False, False)])
def test_cached_ids_equal_whole_texts(name, spaced, plain):
    path = tokenizer_path(name)
    known, whole = TextIds(path, spaced, plain), Tokenizer.from_file(path)
    whole.encode_special_tokens = plain
    draw = random.Random(3)
    signs = [chr(c) for c in range(0x190)] + list(" '’\n\t\r  abst.,!0129Çß") * 9 + ["'re", "'LL", "<|endoftext|>", "日", "é"]
    some = ["".join(draw.choice(signs) for _ in range(draw.randrange(40))) for _ in range(3000)]
    some += [t or "" for t in texts()]
    found = [np.frombuffer(f, "<u4").tolist() for f in known.of(some)]
    assert found == [whole.encode(t, add_special_tokens=False).ids for t in some]


def test_parts_are_bounded_and_stay_right(monkeypatch):
    monkeypatch.setattr("delaylens.llm.tokens.HALF_CACHE", 50)
    path = tokenizer_path(BYTE_LEVEL)
    known, whole = TextIds(path, True), Tokenizer.from_file(path)
    for a in range(0, 900, 30):
        some = [" ".join(f"w{i} same {i}x" for i in range(a, a + 30)), "same"]
        assert [np.frombuffer(f, "<u4").tolist() for f in known.of(some)] == [whole.encode(t).ids for t in some]
        assert len(known.parts) + len(known.parts.old) < 400


# addressable codes


@pytest.mark.parametrize("ids", [[], [0], [50256] * 700, list(range(3000)), [2**32 - 1, 0, 1, 255, 256] * 99])
def test_codes_give_back_any_id(ids):
    ids = np.array(ids, "<u4")
    held = addressable.TokenFile.of(addressable.to_bytes([5, None], np.array([0, 1]), ids))
    assert held.keys == [5, None] and held.codes.n == len(ids)
    at = np.random.default_rng(1).integers(0, max(len(ids), 1), 4 * len(ids))
    assert held.codes.get(at).tolist() == ids[at].tolist()
    for start, stop in ((0, len(ids)), (len(ids) // 3, len(ids) // 2), (len(ids), len(ids))):
        assert held.codes.run(start, stop).tolist() == ids[start:stop].tolist()


def test_widths_are_the_smallest():
    draw = np.random.default_rng(2)
    ids = (draw.zipf(1.2, 5000) % 4096).astype("<u4")

    def cost(wide):
        total, shift = 0.0, 0
        for k, w in enumerate(wide):
            n = (ids >> shift > 0).sum() if shift else len(ids)
            total += n * (w + (1 + 1 / addressable.RANK_WORDS if k + 1 < len(wide) else 0))
            shift += w
        return total

    def splits(bits):
        return [[]] if not bits else [[w, *rest] for w in range(1, bits + 1) for rest in splits(bits - w)]

    best = addressable.widths(ids)
    assert sum(best) == 12 and cost(best) == pytest.approx(min(map(cost, splits(12))))


def expected_ids(rows):
    whole, start, out = Tokenizer.from_file(tokenizer_path(BYTE_LEVEL)), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc, len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_files_hold_all_documents_in_order(spark):
    docs = documents(spark)
    files = addressable.write(docs, new_folder(spark, "codes"), tokenizer_path(BYTE_LEVEL), file_ids=700)
    assert files.count() > 5
    found = sorted(tuple(r) for r in addressable.read(files).select("start", "key", "n_tokens", "ids_crc32").collect())
    at = 0
    for start, _, n, _ in found:
        assert start == at
        at += n
    keys = [k for _, k, _, _ in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    expected = expected_ids([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert Counter(f[1:] for f in found) == Counter(expected)
    empty = addressable.write(docs.limit(0), new_folder(spark, "codes"), tokenizer_path(BYTE_LEVEL))
    assert addressable.read(empty).count() == 0


def test_damaged_end_is_found(spark, tmp_path):
    path = tmp_path / "x.dac"
    path.write_bytes(addressable.to_bytes([1, 2], np.array([0, 2]), np.array([7, 0, 7, 9], "<u4")))
    files = spark.createDataFrame([(str(path), 0)], "file string, first long")
    with pytest.raises(Exception, match="end id"):
        addressable.read(files).collect()


# alignment


def plain_alignment(rows):
    a_side, b_side = Tokenizer.from_file(tokenizer_path(BYTE_LEVEL)), SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    a_side.encode_special_tokens = True
    letters, names = alignment.byte_letters(), {i: t for t, i in a_side.get_vocab().items()}
    counts, found = Counter(), []
    for doc, text in rows:
        a, b = a_side.encode(" " + (text or ""), add_special_tokens=False).ids, b_side.encode(text or "")
        bytes_a = [bytes(letters[c] for c in names[i]) for i in a]
        pieces = [(i, b_side.id_to_piece(i)) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        if not text or any(b"".join(x) != b" " + text.encode() for x in (bytes_a, bytes_b)):
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = (np.cumsum([len(t) for t in x]).tolist() for x in (bytes_a, bytes_b))
        links = []
        for i, (start, end) in enumerate(zip([0, *ends_a], ends_a)):
            links += [(i, j) for j, (s, e) in enumerate(zip([0, *ends_b], ends_b)) if s < end and start < e] if len(a) < 2000 else []
        if len(a) >= 2000:
            i = j = 0
            while i < len(a):
                links.append((i, j))
                i, j = i + (ends_a[i] <= ends_b[j]), j + (ends_b[j] <= ends_a[i])
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i2, j2 = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        links = [(a[i], b[j]) for i, j in links]
        counts.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((doc, len(a), len(b), len(groups), links, digest))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return Counter(
        (doc, n_a, n_b, g, len(links), digest, sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links))
        for doc, n_a, n_b, g, links, digest in found
    )


def test_alignment_equals_plain_python(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 3000)
    docs = documents(spark).repartition(3)
    paths = tokenizer_path(BYTE_LEVEL), tokenizer_path(PIECES)
    found = alignment.align(docs, F.col("doc_id"), *paths)
    order = ["row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    rows = Counter(tuple(r) for r in found.select(*order).collect())
    assert rows == plain_alignment([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert alignment.align(docs.limit(0), F.col("doc_id"), *paths).count() == 0


# phrases


def plain_phrases(rows, least, percent=50, first=2000, longest=3):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for sign in ",;:!?\n\x0b\x0c\r":
            lowered = lowered.replace(sign, ".")
        for piece in lowered.split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    held = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for (lang, *words), a in held.items():
        longer = [b for (other, *w), b in held.items() if other == lang and len(w) > len(words)
                  and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * b >= percent * a for b in longer):
            continue
        cuts = [(f[lang, *words[:k]], f[lang, *words[k:]], k) for k in range(1, len(words))]
        score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for x, y, k in cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang in n:
        for rank, (_, score, a, phrase, left, right) in enumerate(sorted(o for o in out if o[0] == lang)[:first], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def phrase_rows(found):
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("shard_words, range_rows, longest", [(50, 40, 3), (7, 16, 4), (100_000, 10_000, 2)])
def test_phrases_equal_plain_python(spark, monkeypatch, shard_words, range_rows, longest):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(collocations, "WINDOW_BYTES", 64)
    docs = documents(spark).repartition(3)
    found = collocations.mine(docs, least=3, longest=longest, range_rows=range_rows)
    expected = plain_phrases([(r["text"], r["lang"]) for r in docs.collect()], 3, longest=longest)
    assert expected and phrase_rows(found) == expected


def test_phrases_of_an_empty_table(spark):
    assert collocations.mine(documents(spark).limit(0)).count() == 0


def test_best_phrases_only(spark):
    docs = documents(spark)
    found = phrase_rows(collocations.mine(docs, least=2, first=3))
    assert found == plain_phrases([(r["text"], r["lang"]) for r in docs.collect()], 2, first=3)


def counted(lines):
    shard = collocations.Shard(3)
    assert not list(shard.add(b"en", "\n".join(lines).encode()))
    return shard.count()


def as_dict(phrases):
    return {
        p: w
        for depth, level in enumerate(phrases.levels, 1)
        for p, w in zip(phrases.phrases(depth).to_pylist(), level.weight.tolist())
    }


def test_automaton_keeps_counts_and_shares_continuations():
    phrases = counted(["a b c", "d b c", "a b c", "d b c", "x y"] * 3)
    built = automaton(phrases)
    assert as_dict(Automaton.of(built.to_bytes()).unfold()) == as_dict(phrases)
    # "a" and "d" go on alike, so one state serves both
    assert len(built.first) - 1 < sum(len(lv.label) for lv in phrases.levels) - 3


def test_automaton_survives_hash_collisions(monkeypatch):
    monkeypatch.setattr("delaylens.llm.automaton.mixed", lambda *c: np.zeros(len(c[0]), np.uint64))
    phrases = counted([" ".join(random.Random(s).choices("abcdef", k=9)) for s in range(40)])
    assert as_dict(automaton(phrases).unfold()) == as_dict(phrases)


def test_ranges_unite_to_the_whole_and_know_their_first_words():
    draw = random.Random(9)
    parts = [counted([" ".join(draw.choices("abcdefg", k=12)) for _ in range(20)]) for _ in range(4)]
    whole = as_dict(united(parts))
    total = Counter()
    for part in parts:
        total.update(as_dict(part))
    assert whole == total
    keys = sorted(tuple(p.split(b" ")) for p in whole)
    bounds = [keys[len(keys) // 4], (b"en", b"c", b"zz"), keys[-2]]
    seen = {}
    for i, pieces in enumerate(zip(*[p.cut(bounds) for p in parts])):
        found = as_dict(united([automaton(p).unfold() for p in pieces if p is not None]))
        low = bounds[i - 1] if i else ()
        for phrase, weight in found.items():
            assert weight == whole[phrase]
            words = tuple(phrase.split(b" "))
            if not (len(words) < len(low) and words == low[: len(words)]):
                assert phrase not in seen
                seen[phrase] = weight
    assert seen == whole


def test_compose_finds_weights_and_misses():
    built = automaton(counted(["a b c", "a b d", "b c"]))
    asked = collocations.acceptor(["en"] * 4 + ["fr"], ["a b", "b", "c a", "zz b", "a"])
    phrases, weights = asked.unfold(), built.compose(asked)
    found = {}
    for depth, values in enumerate(weights, 1):
        found |= dict(zip(phrases.phrases(depth).to_pylist(), values.tolist()))
    assert found[b"en a b"] == 2 and found[b"en b"] == 3
    assert found[b"en c a"] == 0 and found[b"en zz b"] == 0 and found[b"fr"] == 0


def test_queries_on_a_parquet_table(spark, tmp_path):
    docs = documents(spark)
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    files = f"{tmp_path}/documents.parquet/*.parquet"
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{files}'")
        cursor = db.sql(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({OP11_SQL})")
        expected = sorted(cursor.fetchall())
    assert phrase_rows(QUERIES["op11_collocations"](spark, str(tmp_path))) == expected
    n = docs.count()
    assert QUERIES["op12_alignment"](spark, str(tmp_path)).count() == n
    assert QUERIES["op13_addressable"](spark, str(tmp_path)).count() == n
