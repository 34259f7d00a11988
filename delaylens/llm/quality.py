"""Quality of text by a byte-level convolutional network in numpy.

Every second byte starts a window of eight bytes; a filter is a linear function of the window's byte
embeddings. Activations are max-pooled over blocks of 128 bytes, and two neighbouring
blocks make a chunk, so that chunks overlap by half and cover the whole document. A small layer turns each
chunk's pooled filters into a logit, and the mean over the chunks is the document's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import labelled_rows, labelled_sample, slices, with_class

WINDOW, STRIDE, BLOCK = 8, 2, 128
EMBED, FILTERS, HIDDEN = 4, 32, 16
EPOCHS, BATCH, RATE = 14, 24, 0.004
PER_CLASS, CLASS_BYTES = 1200, 3 << 20
SLICE_BYTES = 4 << 20
TILE = 256


@dataclass
class Network:
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WINDOW * EMBED x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def fresh(seed: int) -> Network:
    rng = np.random.default_rng(seed)

    def normal(scale: float, *shape: int) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return Network(
        normal(0.5, 256, EMBED),
        normal(0.3, WINDOW * EMBED, FILTERS),
        np.zeros(FILTERS, np.float32),
        normal(0.25, FILTERS, HIDDEN),
        np.zeros(HIDDEN, np.float32),
        normal(0.25, HIDDEN),
        np.zeros(1, np.float32),
    )


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each padded with zeros to whole blocks (a window's reach at least), and block counts."""
    blocks = np.array([-(-(len(t) + WINDOW) // BLOCK) for t in texts], np.int64)
    data = b"".join(t + bytes(n * BLOCK - len(t)) for t, n in zip(texts, blocks.tolist()))
    return np.frombuffer(data + bytes(WINDOW), np.uint8), blocks


def pooled(net: Network, data: np.ndarray, blocks: np.ndarray, places: bool = False):
    """Largest activation of each filter in each block, and where it is if ``places``.

    Windows that reach into the next text are left out: a text ends with zeros of a window's length.
    """
    total, per = int(blocks.sum()), BLOCK // STRIDE
    tops = np.empty((total, FILTERS), np.float32)
    where = np.empty((total, FILTERS), np.int64) if places else None
    last = np.zeros(total, bool)
    last[np.cumsum(blocks) - 1] = True
    cross = (WINDOW - 1) // STRIDE
    for a in range(0, total, TILE):
        b = min(a + TILE, total)
        lifted = net.embed[data[a * BLOCK : b * BLOCK + WINDOW]]
        n = (b - a) * per
        view = np.lib.stride_tricks.as_strided(
            lifted, (n, WINDOW * EMBED), (STRIDE * EMBED * lifted.itemsize, lifted.itemsize)
        )
        active = (np.ascontiguousarray(view) @ net.filters).reshape(b - a, per, FILTERS)
        active[last[a:b], per - cross :] = -1e9
        if places:
            where[a:b] = active.argmax(axis=1)
            tops[a:b] = np.take_along_axis(active, where[a:b, None, :], axis=1)[:, 0]
        else:
            tops[a:b] = active.max(axis=1)
    return np.maximum(tops + net.bias, 0), where


def chunk_rows(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second block of each chunk, and chunks of each text; one block alone is a chunk."""
    counts = np.maximum(blocks - 1, 1)
    starts = np.cumsum(blocks) - blocks
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.repeat(starts, counts) + inside
    return first, np.where(np.repeat(blocks, counts) > 1, first + 1, first), counts


def logits(net: Network, texts: list[bytes]) -> np.ndarray:
    data, blocks = laid_out(texts)
    tops, _ = pooled(net, data, blocks)
    first, second, counts = chunk_rows(blocks)
    chunk = np.maximum(tops[first], tops[second])
    inner = np.maximum(chunk @ net.hidden + net.hidden_bias, 0)
    each = inner @ net.out + net.out_bias
    return np.add.reduceat(each, np.cumsum(counts) - counts) / counts


def gradients(net: Network, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Gradient of the weighted log loss; max-pooling sends it to the winning windows alone."""
    data, blocks = laid_out(texts)
    tops, where = pooled(net, data, blocks, places=True)
    first, second, counts = chunk_rows(blocks)
    right = tops[second] > tops[first]
    chunk = np.maximum(tops[first], tops[second])
    before = chunk @ net.hidden + net.hidden_bias
    inner = np.maximum(before, 0)
    each = inner @ net.out + net.out_bias
    logit = np.add.reduceat(each, np.cumsum(counts) - counts) / counts
    slope = (1 / (1 + np.exp(-logit)) - labels) * weights / len(labels)
    g = np.repeat(slope / counts, counts).astype(np.float32)
    d_out, d_out_bias = inner.T @ g, np.array([g.sum()], np.float32)
    d_before = (g[:, None] * net.out) * (before > 0)
    d_hidden, d_hidden_bias = chunk.T @ d_before, d_before.sum(axis=0)
    d_chunk = (d_before @ net.hidden.T) * (chunk > 0)
    block = np.where(right, second[:, None], first[:, None])
    row, f = np.nonzero(d_chunk)
    grad = d_chunk[row, f]
    block = block[row, f]
    start = block * BLOCK + where[block, f] * STRIDE
    window = data[start[:, None] + np.arange(WINDOW)]
    lifted = net.embed[window].reshape(len(row), WINDOW * EMBED)
    d_filters, d_bias = np.zeros_like(net.filters), np.bincount(f, grad, FILTERS).astype(np.float32)
    order = np.argsort(f, kind="stable")
    cuts = np.searchsorted(f[order], np.arange(FILTERS + 1))
    back = np.empty_like(lifted)
    for k in range(FILTERS):
        own = order[cuts[k] : cuts[k + 1]]
        d_filters[:, k] = grad[own] @ lifted[own]
        back[own] = grad[own, None] * net.filters[:, k]
    d_embed = np.zeros_like(net.embed)
    flat, back = window.ravel(), back.reshape(-1, EMBED)
    for e in range(EMBED):
        d_embed[:, e] = np.bincount(flat, back[:, e], 256)
    return [d_embed, d_filters, d_bias, d_hidden, d_hidden_bias, d_out, d_out_bias]


def train(sample: list[tuple[str, int]], seed: int = 3) -> Network:
    """Adam over a bounded sample of whole texts; both classes weigh the same."""
    net, rng = fresh(seed), np.random.default_rng(seed)
    texts = [t.encode() for t, _ in sample]
    labels = np.array([y for _, y in sample], np.float32)
    share = np.array([max((labels == y).sum(), 1) for y in (0, 1)])
    weights = (len(labels) / 2 / share)[labels.astype(int)].astype(np.float32)
    moment = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + RATE / 20
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            found = gradients(net, [texts[i] for i in pick], labels[pick], weights[pick])
            step += 1
            for p, g, m, v in zip(net.parts(), found, moment, second):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def _score(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            score = 1 / (1 + np.exp(-np.clip(logits(net, texts).astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score)], names=["row", "score"])

    return run


def fit(
    rows: DataFrame, label: Column, per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES,
    labels: DataFrame | None = None,
) -> Network | None:
    """Network from a bounded sample of ``rows`` (doc_id, text) with 0/1 labels; None without both labels.

    The sample holds at most ``per_class`` rows and ``class_bytes`` bytes of whole texts of each class.
    ``label`` is read from ``labels`` (doc_id and others) where they are a table of their own.
    """
    thin = labelled_rows(*with_class(rows, label, labels, 3)).filter(F.col("class").isin(0, 1))
    sample = labelled_sample(rows, per_class, class_bytes, 3, thin)
    return train(sample) if len({y for _, y in sample}) == 2 else None


def score(docs: DataFrame, net: Network | None, columns: list[str], text: str = "text") -> DataFrame:
    """``row`` (a struct of ``columns``) and score of each whole text: the probability of label 1.

    Null and empty texts are scored as zeros; without a network every score is 0.5. Rows that repeat are
    scored each; of other columns only ``columns`` are read.
    """
    rows = docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text"))
    if net is None:
        return rows.select("row", F.lit(0.5).alias("score"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_score(net), f"row {kind}, score double")
