"""Align the tokens of two tokenizers on the bytes of the same text, in Arrow tables.

A block of texts is encoded by both tokenizers. Lists of ids are flattened with their
parents, byte lengths are summed within each document, and an Acero join on (document,
end) gives the ends that both share and those of one side alone. Between two neighbouring
ends one token of A overlaps one of B, so the joined rows are the links. Table.group_by
counts a block's pairs of ids, Spark adds the blocks up, and the sums return to the blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import slices, staged
from delaylens.llm.tokens import byte_letters, text_ids

BLOCK_BYTES = 2 << 20
B_BITS = 32
SPACE_MARK = "▁"


def decimal_forms(n: int, ends: str) -> pa.Array:
    """``0,``, ``1,``, ... and the same for each of the other ``ends``."""
    return pa.array([f"{i}{e}" for e in ends for i in range(n)], pa.large_string())


class Sides:
    """Both tokenizers and the bytes of their tokens; one for each worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.a = text_ids(path_a, True, plain_specials=True)
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            bytes_a[i] = bytes(letters.get(c, 0) for c in token)
        bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            is_byte = self.b.is_byte(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(SPACE_MARK, " ").encode())
        self.bytes = {"a": pa.array(bytes_a, pa.large_binary()), "b": pa.array(bytes_b, pa.large_binary())}
        self.forms = {"a": decimal_forms(len(bytes_a), ",|"), "b": decimal_forms(len(bytes_b), ",;")}

    def encode(self, texts: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        found = self.a.of([" " + t for t in texts])
        offsets = np.cumsum([0, *[len(f) // 4 for f in found]])
        ids = pa.array(np.frombuffer(b"".join(found), "<u4").astype("<i8"))
        ids_a = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), ids)
        return ids_a, pa.array(self.b.encode(texts, num_threads=1), pa.large_list(pa.int64()))


@cache
def sides(path_a: str, path_b: str) -> Sides:
    return Sides(path_a, path_b)


def joined_bytes(ids: pa.LargeListArray, token_bytes: pa.Array) -> tuple[memoryview, np.ndarray]:
    """All bytes of the tokens one behind the other, and where each document's begin and end."""
    found = token_bytes.take(pc.list_flatten(ids))
    ends = np.frombuffer(found.buffers()[1], "<i8", len(found) + 1)
    # unsigned, as bytes are compared by value
    return memoryview(found.buffers()[2] or b"").cast("B"), ends[ids.offsets.to_numpy()]


def whole(texts: list[str | None], ids: pa.LargeListArray, token_bytes: pa.Array) -> np.ndarray:
    """Which texts are not empty and equal their tokens' bytes, after a space."""
    data, cuts = joined_bytes(ids, token_bytes)
    return np.array([bool(t) and data[i:j] == b" " + t.encode() for t, i, j in zip(texts, cuts, cuts[1:])], bool)


def kept(ids: pa.LargeListArray, valid: np.ndarray) -> pa.LargeListArray:
    """Empty lists for documents that are not valid."""
    mask = pa.array(valid)
    tokens = pc.list_flatten(ids).filter(mask.take(pc.list_parent_indices(ids)))
    sizes = np.where(valid, pc.list_value_length(ids).to_numpy(), 0)
    return pa.LargeListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int64()), tokens)


def ends_table(ids: pa.LargeListArray, token_bytes: pa.Array, side: str) -> pa.Table:
    """(doc, end, place, id) of a block's tokens; ``end`` is the byte after the token in its document."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.binary_length(token_bytes).take(flat).cast(pa.int64()))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total]).take(ids.offsets[:-1])
    end = pc.subtract(total, before.take(doc))
    place = pa.array(np.arange(len(flat)))
    return pa.table({"doc": doc, "end": end, side: place, f"id_{side}": flat})


def linked(ids_a: pa.LargeListArray, ids_b: pa.LargeListArray, both: Sides) -> pa.Table:
    """One row per overlapping pair of tokens, in order: doc, a, id_a, b, id_b, group, and whether it closes the group."""
    left = ends_table(ids_a, both.bytes["a"], "a")
    right = ends_table(ids_b, both.bytes["b"], "b")
    rows = left.join(right, ["doc", "end"], join_type="full outer", use_threads=False)
    rows = rows.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
    closes = pc.and_(pc.is_valid(rows["a"]), pc.is_valid(rows["b"]))
    closed = pc.cumulative_sum(closes.cast(pa.int64()))
    group = pc.subtract(closed, closes.cast(pa.int64()))
    # the token that covers a stretch is the next one to end; a document's last row has both
    covering = {c: pc.fill_null_backward(rows[c]) for c in ("a", "id_a", "b", "id_b")}
    own = {"ends_a": pc.is_valid(rows["a"]), "ends_b": pc.is_valid(rows["b"])}
    return pa.table({"doc": rows["doc"], **covering, **own, "group": group, "closes": closes})


def group_digests(links: pa.Table, ids_a: pa.LargeListArray, ids_b: pa.LargeListArray, both: Sides) -> list[str]:
    """sha256 of each document's groups, written as ``a1,a2|b1;a3|b2,b3``; empty without tokens.

    Every token is one of two ready forms, with the mark behind it. The forms are taken in
    the order of the groups, so the block's text arises in one step and is cut by document.
    """
    ends_a, ends_b = links.filter(links["ends_a"]), links.filter(links["ends_b"])
    group_a, group_b = ends_a["group"].to_numpy(), ends_b["group"].to_numpy()
    n = links["group"].to_numpy()[-1] + 1 if len(links) else 0
    of_a, of_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    at_a = np.arange(len(group_a)) + (np.cumsum(of_b) - of_b)[group_a]
    at_b = np.arange(len(group_b)) + np.cumsum(of_a)[group_b]
    n_a, n_b = len(both.bytes["a"]), len(both.bytes["b"])
    form = np.empty(len(at_a) + len(at_b), np.int64)
    form[at_a] = ends_a["id_a"].to_numpy() + n_a * ends_a["closes"].to_numpy()
    form[at_b] = 2 * n_a + ends_b["id_b"].to_numpy() + n_b * ends_b["closes"].to_numpy()
    forms = pa.concat_arrays([both.forms["a"], both.forms["b"]]).take(pa.array(form))
    starts = np.frombuffer(forms.buffers()[1], "<i8", len(forms) + 1)
    data = memoryview(forms.buffers()[2] or b"")
    cuts = starts[ids_a.offsets.to_numpy() + ids_b.offsets.to_numpy()]
    return [hashlib.sha256(data[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(cuts, cuts[1:])]


def block_rows(texts: list[str | None], both: Sides) -> tuple[dict[str, pa.Array], pa.Table]:
    """Columns of a block's documents, and its pairs of ids (local, pair, n)."""
    ids_a, ids_b = both.encode([t or "" for t in texts])
    valid = whole(texts, ids_a, both.bytes["a"]) & whole(texts, ids_b, both.bytes["b"])
    ids_a, ids_b = kept(ids_a, valid), kept(ids_b, valid)
    links = linked(ids_a, ids_b, both)
    pair = pc.bit_wise_or(pc.shift_left(links["id_a"], B_BITS), links["id_b"]).combine_chunks()
    coded = pc.dictionary_encode(pair)
    local = coded.indices if len(pair) else pa.array([], pa.int32())
    counted = pa.table({"local": local}).group_by("local", use_threads=False).aggregate([([], "count_all")])
    values = coded.dictionary.take(counted["local"])
    pairs = pa.table({"local": counted["local"], "pair": values, "n": counted["count_all"]})
    doc = links["doc"].to_numpy()
    n_links = np.bincount(doc, minlength=len(texts))
    n_groups = np.bincount(doc[links["closes"].to_numpy()], minlength=len(texts))
    columns = {
        "n_a": pc.list_value_length(ids_a).cast(pa.int64()),
        "n_b": pc.list_value_length(ids_b).cast(pa.int64()),
        "n_groups": pa.array(n_groups, pa.int64()),
        "n_links": pa.array(n_links, pa.int64()),
        "groups_sha256": pa.array(group_digests(links, ids_a, ids_b, both), pa.string()),
        "links": pa.array(links_of(doc, local.to_numpy().astype(np.int64), len(texts)), pa.binary()),
    }
    return columns, pairs


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values in bytes of seven bits, the lowest first, and where each begins and the last one ends."""
    sizes = 1 + sum((values >> (7 * k) > 0).astype(np.int64) for k in range(1, 5))
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(at[-1], np.uint8)
    for k in range(5):
        some = sizes > k
        out[at[:-1][some] + k] = values[some] >> (7 * k) & 127 | np.where(sizes[some] > k + 1, 128, 0)
    return out, at


def unpacked(data: np.ndarray) -> np.ndarray:
    """The values of :func:`packed`."""
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    values = np.zeros(len(ends), np.int64)
    for k in range(5):
        some = starts + k <= ends
        values[some] |= (data[starts[some] + k].astype(np.int64) & 127) << (7 * k)
    return values


def links_of(doc: np.ndarray, local: np.ndarray, documents: int) -> list[bytes]:
    """Each document's links in order of their pair, as packed differences; their place in the text is not kept."""
    key = np.sort(doc << 32 | local)
    n = np.bincount(doc, minlength=documents)
    value = key & 0xFFFFFFFF
    first = (np.cumsum(n) - n)[n > 0]
    step = np.diff(value, prepend=0)
    step[first] = value[first]
    data, at = packed(step)
    cuts = at[np.concatenate([[0], np.cumsum(n)])].tolist()
    return [data[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]


def _align(path_a: str, path_b: str):
    names = ["block", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "local", "pair", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, block = sides(path_a, path_b), TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", BLOCK_BYTES):
            columns, pairs = block_rows(batch.column("text").to_pylist(), both)
            columns |= {"row": batch.column("row")}
            for part, n in ((columns, batch.num_rows), (dict(zip(pairs.column_names, pairs.columns)), len(pairs))):
                part = {"block": pa.array(np.full(n, block)), **part}
                kinds = {"row": batch.column("row").type, "groups_sha256": pa.string(), "links": pa.binary()}
                arrays = [part.get(c, pa.nulls(n, kinds.get(c, pa.int64()))) for c in names]
                table = pa.table([a.cast(kinds.get(c, pa.int64())) if c != "row" else a for a, c in zip(arrays, names)], names)
                yield from table.combine_chunks().to_batches(max_chunksize=1 << 16)
            block += 1

    return run


def _sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of a block's links over the corpus-wide counts of their pairs."""
    n = left["n_links"].to_numpy()
    doc = pa.array(np.repeat(np.arange(len(left)), n))
    total = np.cumsum(unpacked(np.frombuffer(b"".join(left["links"].to_pylist()), np.uint8)))
    # differences start again with each document
    before = np.concatenate([[0], total])[np.cumsum(n) - n]
    local = pa.array(total - np.repeat(before, n))
    order = pc.sort_indices(right, sort_keys=[("local", "ascending")])
    count, best = right["count"].take(order).take(local), right["best"].take(order).take(local)
    rows = pa.table({"doc": doc, "count": count, "best": best.cast(pa.int64())})
    sums = rows.group_by("doc", use_threads=False).aggregate([("count", "sum"), ("best", "sum")])
    out = {c: np.zeros(len(left), "<i8") for c in ("best_sum", "count_sum")}
    for c, values in out.items():
        values[sums["doc"].to_numpy()] = sums[c].to_numpy()
    held = left.drop_columns(["block", "links"])
    return held.append_column("n_best", pa.array(out["best_sum"])).append_column("count_sum", pa.array(out["count_sum"]))


def align(docs: DataFrame, row: Column, tokenizer_a: str, tokenizer_b: str, text: str = "text") -> DataFrame:
    """Token groups and links of every document, with the corpus-wide counts of its linked pairs.

    ``tokenizer_a`` is a byte-level tokenizer file, given a space and the text;
    ``tokenizer_b`` a sentencepiece model that adds the space itself. Returns ``row`` and
    n_a, n_b, n_groups, n_links, groups_sha256, n_best (links whose pair is the most
    frequent of its B id, ties included) and count_sum. Null and empty texts, and texts
    that the bytes of either side's tokens do not give back, have no tokens. Rows that
    repeat a document are aligned and counted each; an empty table gives no rows.
    """
    rows = docs.select(row.alias("row"), F.col(text).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    schema = (
        f"block long, row {kind}, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, links binary, local long, pair long, n long"
    )
    held = staged(rows.mapInArrow(_align(tokenizer_a, tokenizer_b), schema), "links")
    pairs = held.filter(F.col("pair").isNotNull()).select("block", "local", "pair", "n")
    counts = staged(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    id_b = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    # a B id has at most as many pairs as A has ids
    top = counts.groupBy(id_b.alias("id_b")).agg(F.max("count").alias("most"))
    known = counts.withColumn("id_b", id_b).join(top, "id_b")
    known = known.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = pairs.join(known, "pair").select(F.col("block").alias("home"), "local", "count", "best")
    documents = held.filter(F.col("pair").isNull()).drop("local", "pair", "n")
    out = f"row {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return documents.groupBy("block").cogroup(back.groupBy("home")).applyInArrow(_sums, out)
