"""Links between documents whose shingle sets have a Jaccard similarity of 0.8 or more.

A set's parity sketch XORs every shingle into one bit, so two sketches differ in at most as
many bits as the sets have elements that are not shared. Sets are compared in size bands.
For sizes a <= b a link needs b <= 1.25 a and at most (a + b) / 9 unshared shingles, so a
sketch of more segments than that has segments on which both sets agree (pigeonhole). Segments are
ordered by their bits, the fullest first, an order that agreeing segments share. If all but d of the
segments agree, the first d + 1 of either sketch have one in common, so only these are
emitted: no pair that links is lost, and a passage that many documents share seldom fills one.

Sets that are equal are one node from the start. In every run of equal segments the first
node is paired with the others, the pairs are verified on whole sets, and components are
found. In a run that still holds more than one component, the node that shares most runs becomes the
pivot. What a set and the pivot do not share is the XOR of the two; two sets of a run link only if enough of these
differences agree, so a prefix join on the rarest differences finds every pair left, and copies edited
in different places never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import slices, staged
from delaylens.operators.joins import lookup

SHINGLE = 5
BAND = 3
SLACK = 1.12
BIT_SPACE = 16
CACHE_WORDS = 300_000
SEEN_SETS = 500_000
SLICE_BYTES = 8 << 20
_U = np.uint64

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Odd factors of a word's hash by its place in the shingle.
PLACES = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | _U(1)


class WordHashes(dict):
    """64-bit hash of each word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: str, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; a text of fewer words has one shingle."""
    # both calls touch ASCII alone: A-Z, and the white space of the word pattern
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        h += w[i : len(words) - width + 1 + i] * PLACES[i]
    h = np.sort(mix(h))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def signature(found: np.ndarray) -> int:
    """64-bit name of a set."""
    total = mix(found).sum(dtype=np.uint64) if len(found) else _U(0)
    return int(mix(np.array([total ^ _U(len(found) * 0x9E3779B97F4A7C15 % (1 << 64))], np.uint64)).view(np.int64)[0])


def band_edges(most: int) -> list[int]:
    """Smallest size of each band, up to the first edge above ``most``."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(int(edges[-1] * BAND) + 1)
    return edges


def tolerances(n: int) -> list[tuple[int, int, int]]:
    """(join, segments, most unshared shingles) of each band join a set of ``n`` takes part in."""
    edges = band_edges(n)
    band = len(edges) - 2

    def segments(k: int) -> int:
        upper = int(edges[k] * BAND) + 1
        return int(SLACK * ((upper - 1) // 4 + 1)) + 3

    found = [(band, segments(band), n // 4)]
    if band and 4 * n <= 5 * (edges[band] - 1):
        found.append((band - 1, segments(band - 1), (edges[band] - 1 + n) // 9))
    return found


def sketch_keys(found: np.ndarray) -> np.ndarray:
    """Keys of the segments a set emits, the fullest of each join; equal where two sets agree."""
    keys = []
    for join, segments, most in tolerances(len(found)):
        salt = _U((join + 1) * 0xD1B54A32D192ED03 % (1 << 64))
        h = mix(found + salt)
        bits = np.sort(((h >> _U(32)) * _U(segments) >> _U(32)) << _U(BIT_SPACE) | (h & _U((1 << BIT_SPACE) - 1)))
        if (bits[1:] == bits[:-1]).any():
            # parity: a bit that an even number of shingles hits is not set
            bits, hits = np.unique(bits, return_counts=True)
            bits = bits[hits % 2 == 1]
        own = filled = np.zeros(0, np.uint64)
        if len(bits):
            segment = bits >> _U(BIT_SPACE)
            first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            prints = np.bitwise_xor.reduceat(mix(bits + salt), first)
            filled = segment[first]
            own = mix(prints + filled * _U(0x9E3779B97F4A7C15) + salt)
            # the fullest segments have the smallest keys
            tokens = np.minimum(np.diff(np.append(first, len(bits))), 255).astype(np.uint64)
            own = np.sort((_U(255) - tokens) << _U(56) | own >> _U(8))
        if len(own) <= most:
            empty = np.setdiff1d(np.arange(segments, dtype=np.uint64), filled)
            own = np.concatenate([own, np.sort(mix(mix(empty + salt) + _U(1)))])
        own = own[: most + 1]
        keys.append(own)
    return np.concatenate(keys).view(np.int64)


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, signature and keys of each row's set; no keys for a set a task has just seen."""
    hashes, seen = WordHashes(), set()
    for batch in slices(batches, "text", SLICE_BYTES):
        texts, sizes, names, keys = batch.column("text"), [], [], []
        for i in range(batch.num_rows):
            found = shingle_set(texts[i].as_py() or "", hashes)
            node = signature(found)
            sizes.append(len(found))
            names.append(node)
            new = len(found) > 0 and node not in seen
            keys.append(sketch_keys(found) if new else np.zeros(0, np.int64))
            if new:
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(node)
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("print"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), lists],
            names=["doc_id", "print", "n", "node", "keys"],
        )


def _new_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Node and set of the filled sets, those a task has just seen left out."""
    hashes, seen = WordHashes(), set()
    for batch in slices(batches, "text", SLICE_BYTES):
        texts = batch.column("text")
        for i in range(batch.num_rows):
            found = shingle_set(texts[i].as_py() or "", hashes)
            node = signature(found)
            if len(found) and node not in seen:
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(node)
                yield node, found


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nodes, sets, held = [], [], 0

    def out() -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), values], names=["node", "shingles"])

    for node, found in _new_sets(batches):
        nodes.append(node)
        sets.append(found)
        held += len(found)
        if held >= 500_000:
            yield out()
            nodes, sets, held = [], [], 0
    if nodes:
        yield out()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each run of equal keys next to its first node; rows come sorted by key and node."""
    key = first = first_n = last = None
    place = 0
    for batch in batches:
        k, node, n = (batch.column(c).to_numpy() for c in ("key", "node", "n"))
        if not len(k):
            continue
        new = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
        again = np.concatenate([[not new[0] and node[0] == last], (k[1:] == k[:-1]) & (node[1:] == node[:-1])])
        k, node, n, new = (x[~again] for x in (k, node, n, new))
        if not len(k):
            continue
        run = np.cumsum(new)
        heads = np.flatnonzero(new)
        # run 0 goes on from the batch before
        a = np.concatenate([[0 if first is None else first], node[heads]])[run]
        na = np.concatenate([[0 if first_n is None else first_n], n[heads]])[run]
        begins = np.concatenate([[-place], heads])[run]
        at = np.arange(len(k)) - begins
        key, first, first_n, last, place = k[-1], a[-1], na[-1], node[-1], int(at[-1]) + 1
        keep = at > 0
        if keep.any():
            columns = [k, a, node, at, na, n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[keep].astype(t)) for c, t in zip(columns, ("i8", "i8", "i8", "i8", "i4", "i4"))],
                names=["key", "a", "b", "place", "na", "nb"],
            )


def near(a: str, b: str):
    """Whether two sizes allow a similarity of 0.8."""
    return (F.col(a) * 5 >= F.col(b) * 4) & (F.col(b) * 5 >= F.col(a) * 4)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets have 100 * intersection >= 80 * union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa").cast("long") + F.size("sb") - F.col("shared")
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", shared)
    return both.filter(100 * F.col("shared") >= 80 * union).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): the smallest node that links reach.

    Each round takes the smallest label among a node's neighbours and then that label's own label.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    edges = staged(both.filter("node <> other").distinct(), "edges")
    labels = staged(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("component").alias("theirs"))
        least = edges.join(theirs, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        taken = labels.join(least, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "theirs").alias("component")
        )
        further = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = staged(
            taken.join(further, "component").select("node", "old", F.least("component", "further").alias("component")),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.filter("component <> old").isEmpty():
            return labels


def _labelled(rows: DataFrame, labels: DataFrame, node: str, out: str) -> DataFrame:
    found = labels.select(F.col("node").alias(node), F.col("component").alias("_c"))
    return rows.join(found, node, "left").withColumn(out, F.coalesce("_c", F.col(node))).drop("_c")


def _rest(candidates: DataFrame, links: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Component labels after the runs that hold more than one component are compared through a pivot."""
    marked = _labelled(_labelled(candidates, labels, "a", "ca"), labels, "b", "cb")
    runs = marked.groupBy("key").agg(
        F.max("place").alias("last"),
        F.max(F.col("ca") != F.col("cb")).alias("open"),
        F.sum(F.xxhash64("b").cast("decimal(38,0)")).alias("members"),
        F.min("a").alias("first"),
    )
    # runs of the same nodes are one
    open_runs = runs.filter("open and last > 1").groupBy("members", "first", "last").agg(F.min("key").alias("key"))
    open_runs = staged(open_runs.select("key"), "runs")
    if open_runs.isEmpty():
        return labels
    rows = candidates.join(open_runs, "key", "left_semi")
    members = rows.select("key", F.col("b").alias("node"), F.col("nb").alias("n"))
    # a text that others were made from shares the most runs and lies closest to them
    common = members.groupBy("node").agg(F.count("*").alias("runs"))
    turned = members.join(common, "node")
    pivots = turned.groupBy("key").agg(F.max_by(F.struct("node", "n"), F.struct("runs", "node")).alias("pivot"))
    spokes = turned.join(pivots, "key").select("pivot.node", "pivot.n", F.col("node").alias("x"), F.col("n").alias("nx"))
    spokes = spokes.toDF("p", "np", "x", "nx").filter("p <> x").distinct()
    apart = staged(differences(spokes, sets), "differences")
    near_pivot = apart.filter("linked").select(F.col("p").alias("a"), F.col("x").alias("b"))
    if not near_pivot.isEmpty():
        links = staged(links.unionByName(near_pivot), "links")
        labels = components(links)
    fresh = staged(sharing_differences(apart, labels), "pairs")
    if fresh.isEmpty():
        return labels
    more = staged(verified(fresh, sets), "links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def differences(spokes: DataFrame, sets: DataFrame) -> DataFrame:
    """The shingles (``apart``) that a set ``x`` and its pivot ``p`` do not share, and whether they link."""
    left = sets.select(F.col("node").alias("p"), F.col("shingles").alias("sp"))
    right = sets.select(F.col("node").alias("x"), F.col("shingles").alias("sx"))
    both = spokes.join(left, "p").join(right, "x")
    apart = F.concat(F.array_except("sx", "sp"), F.array_except("sp", "sx"))
    found = both.select("p", "np", "x", "nx", apart.alias("apart")).withColumn("d", F.size("apart").cast("long"))
    return found.withColumn("linked", 9 * F.col("d") <= F.col("np") + F.col("nx"))


def sharing_differences(apart: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of a pivot that may link although they are not in one component yet.

    With dx and dy shingles by which x and y differ from the pivot, x and y differ in
    dx + dy - 2c of them, c being the differences they have in common. A link allows (nx + ny) / 9, so
    c >= (dx + dy - (nx + ny) / 9) / 2. Two sets that both link with the pivot are in one component; for any
    others this is more than (d + (np - n) / 9) / 2 for the one whose partner does not
    link with the pivot. With the rarest differences first, the first d - c + 1 of both have one in common.
    """
    place = _labelled(apart, labels, "x", "c")
    hub = _labelled(apart.select("p").distinct(), labels, "p", "pc")
    open_pivots = place.join(hub, "p").groupBy("p").agg(F.max(F.col("c") != F.col("pc")).alias("open")).filter("open")
    place = place.join(open_pivots.select("p"), "p", "left_semi")
    half = F.col("d") - F.floor((9 * F.col("d") + F.col("np") - F.col("nx")) / 18)
    full = F.least(F.col("d"), F.floor(F.col("nx") / 4) + 1)
    each = staged(place.select("p", "x", "nx", "d", "linked", "c", full.alias("full"), F.least(half, full).alias("half"), F.explode("apart").alias("shingle")), "apart")
    counts = each.groupBy("p", "shingle").agg(F.count("*").alias("times")).filter("times > 1")
    rare = Window.partitionBy("p", "x").orderBy("times", "shingle")
    whole = Window.partitionBy("p", "x")
    # shingles of one member alone come before the shared ones
    ranked = each.join(counts, ["p", "shingle"]).withColumn(
        "at", F.col("d") - F.count("*").over(whole) + F.row_number().over(rare)
    )
    ranked = staged(ranked.filter(F.col("at") <= F.when(F.col("linked"), F.col("half")).otherwise(F.col("full"))), "rare")

    def side(i: str) -> DataFrame:
        return ranked.select("p", "shingle", *[F.col(c).alias(f"{c}{i}") for c in ("x", "nx", "d", "linked", "c", "half", "at")])

    least = F.greatest(F.ceil((9 * (F.col("d1") + F.col("d2")) - F.col("nx1") - F.col("nx2")) / 18), F.lit(1))
    # both unlinked: the first half of either; else all of the unlinked one's against the linked one's half
    asked = ~F.col("linked1") & (F.col("linked2") | ((F.col("x1") < F.col("x2")) & (F.col("at1") <= F.col("half1"))))
    pairs = side("1").filter("not linked1").join(side("2").filter("at2 <= half2"), ["p", "shingle"]).filter(
        asked & (F.col("c1") != F.col("c2")) & near("nx1", "nx2")
        & (F.col("at1") <= F.col("d1") - least + 1) & (F.col("at2") <= F.col("d2") - least + 1)
    )
    return pairs.select(F.least("x1", "x2").alias("a"), F.greatest("x1", "x2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size and component of each row of ``docs``.

    Returns doc_id, n_shingles, component_id (the smallest id that links reach, itself
    included), component (a number of the component, null without words) and print (a hash of the
    text, which tells rows of one id apart). Documents without words link with nothing and keep their own id; rows that
    repeat are in one component; null ids count in no minimum, and a component of null ids
    alone has a null id; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    printed = rows.withColumn("print", F.xxhash64("text"))
    thin = staged(
        printed.mapInArrow(_thin, "doc_id long, print long, n long, node long, keys array<long>"), "sets"
    )
    keys = thin.select(F.explode("keys").alias("key"), "node", F.col("n").cast("int").alias("n"))
    ordered = keys.repartition("key").sortWithinPartitions("key", "node")
    candidates = staged(
        ordered.mapInArrow(_runs, "key long, a long, b long, place long, na int, nb int"), "candidates"
    )
    pairs = staged(candidates.filter(near("na", "nb")).select("a", "b").distinct(), "pairs")
    nodes = candidates.select(F.col("a").alias("node")).unionByName(candidates.select(F.col("b").alias("node")))
    # one text stands for each node
    prints = thin.drop("keys").join(nodes.distinct(), "node", "left_semi").groupBy("node").agg(F.min("print").alias("print"))
    wanted = lookup(printed.select("text", "print"), prints.select("print").distinct(), ["print"], "left_semi")
    sets = staged(wanted.select("text").mapInArrow(_sets, "node long, shingles array<long>").dropDuplicates(["node"]), "shingles")
    links = staged(verified(pairs, sets), "links")
    labels = _rest(candidates, links, components(links), sets)
    placed = _labelled(thin.drop("keys").filter("n > 0"), labels, "node", "component")
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = placed.join(least, "component").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "component", "print"
    )
    alone = thin.filter("n = 0").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("doc_id").alias("component_id"),
        F.lit(None).cast("long").alias("component"),
        "print",
    )
    return linked.unionByName(alone)
