"""Toxicity by weak supervision.

Voters are words and word beginnings, each with a least share of a text's words, that a bounded labelled
sample ties to toxic text. A voter votes when a document holds its term in that share or more, and abstains
otherwise: a beginning that long texts hold by chance is a sign only where it is frequent. The label itself is one more voter that may
err. A generative model with a hidden class estimates by expectation maximisation how often
each voter fires in either class; voters that still fire together within a class are correlated
and share one vote. A linear classifier is trained on the model's posterior labels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import labelled_rows, labelled_sample, slices, with_class

WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
BEGINNINGS = range(4, 9)
#: Least shares of a text's words that a voter asks for; 0 is a single word.
SHARES = (0.0, 0.005, 0.02)
VOTERS = 600
LEAST_DOCS, LEAST_ODDS = 6, 2.5
ROUNDS = 40
TIED = 0.3
RIDGE = 0.001
PER_CLASS, CLASS_BYTES = 2000, 6 << 20
CACHE_WORDS = 200_000
SLICE_BYTES = 8 << 20


def terms_of(word: str) -> list[str]:
    """The word itself and its proper beginnings, marked with a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if n < len(word))]


#: A term and the place of its least share in SHARES.
Voter = tuple[str, int]


def frequent_terms(texts: list[str], least: int) -> set[str]:
    """Terms of at least ``least`` of the texts."""
    docs: Counter[str] = Counter()
    for text in texts:
        docs.update({t for w in set(WORDS.findall(text.lower())) for t in terms_of(w)})
    return {t for t, n in docs.items() if n >= least}


def document_voters(text: str, known: set[str] | None = None) -> set[Voter]:
    """Every voter that votes on a text, or only those of ``known`` terms."""
    words = Counter(WORDS.findall(text.lower()))
    times: Counter[str] = Counter()
    for word, n in words.items():
        for term in terms_of(word):
            if known is None or term in known:
                times[term] += n
    total = words.total()
    return {(term, i) for term, n in times.items() for i, least in enumerate(SHARES) if n >= least * total}


@dataclass
class Classifier:
    voters: list[Voter]
    weights: np.ndarray
    bias: float


def choose_voters(found: list[set[Voter]], labels: np.ndarray) -> list[Voter]:
    """Voters most tied to label 1, by smoothed log odds times the square root of their documents."""
    sides = [Counter(), Counter()]
    for voters, y in zip(found, labels):
        sides[int(y)].update(voters)
    n = [max(int((labels == y).sum()), 1) for y in (0, 1)]
    ranked = []
    for voter, hits in sides[1].items():
        if hits >= LEAST_DOCS:
            odds = np.log((hits + 0.5) / n[1]) - np.log((sides[0][voter] + 0.5) / n[0])
            if odds >= LEAST_ODDS:
                ranked.append((-odds * hits**0.5, voter))
    return [voter for _, voter in sorted(ranked)[:VOTERS]]


def label_model(votes: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the hidden class of each document, and the share of a vote each voter has.

    ``votes`` is documents x voters, ``given`` the labels as one more, fallible voter. Within each
    class the residuals of every two voters are correlated; a voter's share is one over the sum of
    its correlations above ``TIED``, itself included.
    """
    share = np.ones(votes.shape[1])
    belief = np.where(given == 1, 0.9, 0.1)
    for turn in range(ROUNDS):
        weight = np.stack([1 - belief, belief])
        mass = weight.sum(axis=1)
        prior = np.log(np.maximum(mass, 1) / mass.sum())
        fires = (weight @ votes + 0.1) / (mass[:, None] + 0.2 + 1e-9)
        right = (weight @ given + np.array([1, 9])) / (mass + 10)
        if turn == ROUNDS // 4:
            share = shares(votes, belief, fires)
        on, off = np.log(fires), np.log1p(-fires)
        like = prior + (votes * share) @ (on - off).T + (share * off).sum(axis=1)
        like += np.where(given[:, None] == 1, np.log(right), np.log1p(-right))
        new = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -50, 50)))
        if np.abs(new - belief).max() < 1e-6 and turn > ROUNDS // 4:
            break
        belief = new
    return belief, share


def shares(votes: np.ndarray, belief: np.ndarray, fires: np.ndarray) -> np.ndarray:
    left = votes - (np.outer(1 - belief, fires[0]) + np.outer(belief, fires[1]))
    spread = np.sqrt(np.maximum((left**2).mean(axis=0), 1e-9))
    tied = (left.T @ left) / len(left) / np.outer(spread, spread)
    return 1 / np.maximum(np.where(tied > TIED, tied, 0).sum(axis=1), 1)


def train_linear(x: np.ndarray, target: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft targets by Newton steps; the bias is moved to ``prior``."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    ridge = np.full(len(w), RIDGE * len(x) / 10)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - target) + ridge * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    own = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    return w[:-1], float(w[-1] + np.log(prior / (1 - prior)) - np.log(own / (1 - own)))


def train(sample: list[tuple[str, int]], prior: float) -> Classifier | None:
    """Classifier from a bounded sample; ``prior`` is the share of label 1 among all labelled rows."""
    labels = np.array([y for _, y in sample], np.float64)
    # no other term can be chosen
    known = frequent_terms([t for t, y in sample if y == 1], LEAST_DOCS)
    found = [document_voters(t, known) for t, _ in sample]
    voters = choose_voters(found, labels)
    if not voters:
        return None
    places = {v: i for i, v in enumerate(voters)}
    votes = np.zeros((len(sample), len(voters)))
    for i, own in enumerate(found):
        votes[i, [places[v] for v in own if v in places]] = 1
    posterior, _ = label_model(votes, labels)
    weights, bias = train_linear(votes, posterior, min(max(prior, 1e-3), 0.5))
    return Classifier(voters, weights, bias)


class _KnownTerms(dict):
    """The classifier's terms that a word brings."""

    def __init__(self, terms: set[str]) -> None:
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = tuple(t for t in terms_of(word) if t in self.terms)
        return found


def _score(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters: dict[str, list[tuple[float, float]]] = {}
        for (term, i), weight in zip(model.voters, model.weights):
            voters.setdefault(term, []).append((SHARES[i], float(weight)))
        known = _KnownTerms(set(voters))
        for batch in slices(batches, "text", SLICE_BYTES):
            texts, scores, terms = batch.column("text"), [], []
            for i in range(batch.num_rows):
                words = Counter(WORDS.findall((texts[i].as_py() or "").lower()))
                total, times = words.total(), {}
                for word, n in words.items():
                    for term in known[word]:
                        times[term] = times.get(term, 0) + n
                own = sorted(times)
                scores.append(model.bias + sum(w for t in own for least, w in voters[t] if times[t] >= least * total))
                terms.append(own)
            score = 1 / (1 + np.exp(-np.clip(np.array(scores, np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(score), pa.array(terms, pa.list_(pa.string()))],
                names=["row", "score", "terms"],
            )

    return run


def fit(
    rows: DataFrame, label: Column, per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES,
    labels: DataFrame | None = None,
) -> tuple[Classifier | None, float]:
    """Classifier (None where no voter is found) and share of label 1, from ``rows`` (doc_id, text).

    The sample holds at most ``per_class`` rows and ``class_bytes`` bytes of whole texts of each class;
    the share counts all labelled rows. ``label`` is read from ``labels`` (doc_id and others) where they
    are a table of their own.
    """
    thin = labelled_rows(*with_class(rows, label, labels, 9)).filter(F.col("class").isin(0, 1))
    counts = {r["class"]: r["n"] for r in thin.groupBy("class").agg(F.sum("copies").alias("n")).collect()}
    prior = counts.get(1, 0) / max(sum(counts.values()), 1)
    if len(counts) < 2:
        return None, prior
    return train(labelled_sample(rows, per_class, class_bytes, 9, thin), prior), prior


def score(
    docs: DataFrame, model: Classifier | None, prior: float, columns: list[str], text: str = "text"
) -> DataFrame:
    """``row`` (a struct of ``columns``), score and the terms found in each whole text.

    The score is the probability of label 1. Null and empty texts hold no term; without a
    model every text scores ``prior``. Rows that repeat are scored each; of other columns only
    ``columns`` are read.
    """
    rows = docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    if model is None:
        return rows.select("row", F.lit(prior).alias("score"), F.array().cast("array<string>").alias("terms"))
    return rows.mapInArrow(_score(model), f"row {kind}, score double, terms array<string>")
