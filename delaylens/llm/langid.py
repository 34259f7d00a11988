"""Language of text and of the spans of mixed-language text.

A word's script narrows its candidate languages. Each candidate scores the word by its
letters' trigrams, and the Viterbi path over the words, with a penalty for each switch,
labels the spans. Many documents take each step of the path together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import labelled_sample, slices

BUCKETS = 1 << 16
SWITCH = 12.0
SMOOTH = 0.5
CACHE_WORDS = 200_000
SLICE_BYTES = 8 << 20
PER_CLASS, CLASS_BYTES = 1500, 3 << 20
UNKNOWN = "und"
#: First and last code points of scripts. Letters elsewhere are "other".
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul_jamo", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_STARTS = np.array([s[1] for s in SCRIPTS])
_ENDS = np.array([s[2] for s in SCRIPTS])
_NAMES = sorted({s[0] for s in SCRIPTS})
_IDS = np.array([_NAMES.index(s[0]) for s in SCRIPTS])
OTHER = len(_NAMES)


def scripts_of(words: list[str]) -> np.ndarray:
    """Script of each word's first letter."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    at = np.searchsorted(_STARTS, first, "right") - 1
    return np.where((at >= 0) & (first <= _ENDS[at]), _IDS[at], OTHER)


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of each word between spaces, and where each word's begin."""
    data = [b" " + w.encode() + b"  " for w in words]
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b"".join(data) + b"  ", np.uint8).astype(np.uint32)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    slot = (code * np.uint32(2654435761)) >> np.uint32(16)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    # the last two places of a word's bytes reach into the next word
    inner = np.ones(len(slot), bool)
    ends = np.cumsum(lengths)
    inner[ends - 1] = False
    inner[ends - 2] = False
    return slot[inner], starts - 2 * np.arange(len(words))


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # languages x BUCKETS
    allowed: np.ndarray  # scripts x languages

    def scores(self, words: list[str]) -> np.ndarray:
        """Score of each word in each language; minus infinity where its script rules one out."""
        slots, starts = trigrams(words)
        sums = np.add.reduceat(self.logp[:, slots], starts, axis=1).T
        return np.where(self.allowed[scripts_of(words)], sums, -np.inf).astype(np.float32)


def train(sample: list[tuple[str, str]]) -> Model:
    """Trigram model of each language in ``sample`` (text, language)."""
    languages = sorted({lang for _, lang in sample})
    counts = np.full((len(languages), BUCKETS), SMOOTH)
    seen = np.zeros((OTHER + 1, len(languages)))
    for text, lang in sample:
        words = LETTERS.findall(text.lower())
        if words:
            k = languages.index(lang)
            counts[k] += np.bincount(trigrams(words)[0], minlength=BUCKETS)
            seen[:, k] += np.bincount(scripts_of(words), minlength=OTHER + 1)
    logp = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    # a language uses a script that holds a hundredth of its words; a script of no language leaves all
    allowed = seen >= 0.01 * np.maximum(seen.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, logp, allowed)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word of many documents at once.

    ``scores`` holds the words of all documents one after the other. Documents take
    their t-th step together, the longest first, so that those still running stand in front.
    Staying wins ties with switching, and the smaller label wins among equals.
    """
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    kind = np.min_scalar_type(scores.shape[1])
    back = np.zeros(scores.shape, kind)
    best = scores[starts].astype(np.float64)
    running = np.searchsorted(-sizes, -np.arange(sizes[0] + 1), "left")
    rows = np.arange(len(sizes))
    labels = np.arange(scores.shape[1])
    for t in range(1, int(sizes[0])):
        n = running[t]
        top = best[:n].argmax(axis=1)
        moved = best[rows[:n], top] - switch
        stay = best[:n] >= moved[:, None]
        at = starts[:n] + t
        back[at] = np.where(stay, labels, top[:, None])
        best[:n] = np.where(stay, best[:n], moved[:, None]) + scores[at]
    path = np.zeros(len(scores), kind)
    state = best.argmax(axis=1)
    path[starts + sizes - 1] = state
    for t in range(int(sizes[0]) - 1, 0, -1):
        n = running[t]
        at = starts[:n] + t
        state[:n] = back[at, state[:n]]
        path[at - 1] = state[:n]
    return path


class _Words(dict):
    """Number of each lower-case word, given at first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _label(model: Model, switch: float, with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table, letters = _Words(), np.zeros((0, len(model.languages)), np.float32), np.zeros(0, np.int64)
        for batch in slices(batches, "text", SLICE_BYTES):
            if len(known) > CACHE_WORDS:
                known, table, letters = _Words(), table[:0], letters[:0]
            texts = batch.column("text")
            ids, lengths = [], np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                words = LETTERS.findall((texts[i].as_py() or "").lower())
                lengths[i] = len(words)
                ids.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            if len(known) > len(table):
                fresh = list(known)[len(table) :]
                table = np.concatenate([table, model.scores(fresh)])
                letters = np.concatenate([letters, np.fromiter(map(len, fresh), np.int64, len(fresh))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *_labels(model, switch, table, letters, ids, lengths, with_spans)],
                names=["row", "lang_pred", "score", "spans"],
            )

    return run


def _labels(model, switch, table, letters, ids, lengths, with_spans) -> list[pa.Array]:
    k = len(model.languages)
    full = np.flatnonzero(lengths)
    label = np.full(len(lengths), -1)
    score = np.zeros(len(lengths))
    spans: list[list[dict] | None] = [[] if with_spans else None for _ in lengths]
    if len(full):
        words = np.concatenate([ids[i] for i in full])
        sizes = lengths[full]
        scores, weight = table[words], letters[words]
        path = viterbi(scores, sizes, switch)
        starts = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(full)), sizes)
        shares = np.zeros((len(full), k))
        np.add.at(shares, (doc, path), weight)
        label[full] = shares.argmax(axis=1)
        own = path == label[full][doc]
        if k > 1:
            mine = scores[np.arange(len(path)), path]
            rest = scores.copy()
            rest[np.arange(len(path)), path] = -np.inf
            gap = np.minimum(mine - rest.max(axis=1), 50.0)
            margin = np.add.reduceat(np.where(own, gap, 0.0), starts)
            sure = 1 / (1 + (k - 1) * np.exp(-np.clip(margin, -50, 50)))
        else:
            sure = np.ones(len(full))
        score[full] = shares.max(axis=1) / shares.sum(axis=1) * sure
        if with_spans:
            for j, i in enumerate(full):
                own_path = path[starts[j] : starts[j] + sizes[j]]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(own_path)) + 1, [len(own_path)]])
                spans[i] = [
                    {"lang": model.languages[own_path[a]], "first_word": int(a), "words": int(b - a)}
                    for a, b in zip(cuts[:-1], cuts[1:])
                ]
    names = [UNKNOWN if j < 0 else model.languages[j] for j in label]
    kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32())]))
    return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(spans, kind)]


def fit(docs: DataFrame, lang: Column, per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES) -> Model | None:
    """Model from a bounded sample of ``docs`` (doc_id, text) labelled by ``lang``; None without labels.

    Per language the sample holds at most ``per_class`` rows and ``class_bytes`` bytes of whole texts.
    """
    rows = docs.select("doc_id", "text", lang.cast("string").alias("class"))
    sample = labelled_sample(rows.filter(F.col("class") != UNKNOWN), per_class, class_bytes, 6)
    return train(sample) if sample else None


def label(
    docs: DataFrame, model: Model | None, columns: list[str], text: str = "text", switch: float = SWITCH, spans: bool = True
) -> DataFrame:
    """Language, score and spans of each whole text.

    Returns ``row`` (a struct of ``columns``), lang_pred, score (0 to 1) and spans (lang, first_word,
    words; null unless ``spans``). The language holds the most letters; the score is its share of the
    letters times the confidence in its words. Null texts, texts without letters and, without
    a model, all texts are ``und`` with score 0.
    """
    rows = docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    span = "array<struct<lang: string, first_word: int, words: int>>"
    if model is None:
        return rows.select(
            "row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast(span).alias("spans")
        )
    return rows.mapInArrow(_label(model, switch, spans), f"row {kind}, lang_pred string, score double, spans {span}")
