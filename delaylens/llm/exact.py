"""Exact duplicates through Patricia tries that own each distinct text.

Every task first combines the copies it reads in a trie, so that a text held by a third
of all rows reaches the shuffle once for each task. Rows are then partitioned by length
and content hash, and each partition inserts the full byte strings into its trie, whose
terminal nodes keep the owner and the number of copies. A trie that outgrows its budget
spills its heaviest subtree: the subtree's strings, and any later string that leads into
it, go on to a further round with more partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import staged, text_bytes
from delaylens.llm.trie import PatriciaTrie

BUDGET = 96 << 20
OUT_ROWS, OUT_BYTES = 10_000, 8 << 20
SCHEMA = pa.schema(
    [("sha", pa.binary()), ("owner", pa.int64()), ("n", pa.int64()), ("raw", pa.binary()), ("spilled", pa.bool_())]
)
DDL = "sha binary, owner long, n long, raw binary, spilled boolean"


def _better(a: int | None, b: int | None, keep: str) -> int | None:
    if a is None or b is None:
        return b if a is None else a
    return max(a, b) if keep == "largest" else min(a, b)


def _chunks(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded rows and bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3] or b"")
        if len(held) >= OUT_ROWS or size >= OUT_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        raws = batch.column("raw")
        others = [batch.column(c).to_pylist() for c in ("sha", "owner", "n")]
        for i, (sha, owner, n) in enumerate(zip(*others)):
            yield sha, owner, n, raws[i].as_py()


def _combine(keep: str, budget: int):
    """One row for each distinct text of a task, or of as much of it as fits the budget."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = PatriciaTrie()
        for sha, owner, n, raw in _read(batches):
            entry = trie.add(raw)
            if entry:
                entry[1], entry[2] = _better(entry[1], owner, keep), entry[2] + n
            else:
                entry.extend((sha, owner, n))
            if trie.weight > budget:
                yield from ((e[0], e[1], e[2], key, False) for key, e in trie.items())
                trie = PatriciaTrie()
        yield from ((e[0], e[1], e[2], key, False) for key, e in trie.items())

    return lambda batches: _chunks(rows(batches))


def _own(keep: str, budget: int):
    """Owner and copies of each text; texts of spilled subtrees come out whole for the next round."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = PatriciaTrie()
        for sha, owner, n, raw in _read(batches):
            entry = trie.add(raw)
            if entry is None:
                yield sha, owner, n, raw, True
                continue
            if entry:
                entry[1], entry[2] = _better(entry[1], owner, keep), entry[2] + n
            else:
                entry.extend((sha, owner, n))
            while trie.weight > budget and trie.entries > 1:
                yield from ((e[0], e[1], e[2], key, True) for key, e in trie.spill())
        yield from ((*e, None, False) for _, e in trie.items())

    return lambda batches: _chunks(rows(batches))


def owners(docs: DataFrame, raw: Column, keep: str = "largest", budget: int = BUDGET) -> DataFrame:
    """sha (of the text), owner and n of each distinct text of ``docs``; ids in doc_id, may be null."""
    texts = docs.select(
        F.unhex(F.sha2(raw, 256)).alias("sha"), F.col("doc_id").alias("owner"), F.lit(1).cast("long").alias("n"), raw.alias("raw")
    )
    todo = texts.mapInArrow(_combine(keep, budget), DDL)
    finished, turn = None, 0
    while True:
        place = [F.octet_length("raw").alias("length"), F.xxhash64("raw", F.lit(turn)).alias("content")]
        if turn == 0:
            dealt = todo.repartition(*place)
        else:
            # a partition's share of what was spilled fits its budget
            spilled = todo.agg(F.sum(F.octet_length("raw"))).first()[0]
            dealt = todo.repartition(2 + 2 * spilled // budget, *place)
        done = staged(dealt.mapInArrow(_own(keep, budget), DDL), "owners")
        part = done.filter(~F.col("spilled")).select("sha", "owner", "n")
        finished = part if finished is None else finished.unionByName(part)
        todo = done.filter("spilled")
        if todo.isEmpty():
            return finished
        turn += 1


def duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "largest", budget: int = BUDGET
) -> DataFrame:
    """The row that stays for each row of ``docs``.

    Returns doc_id, keep_id, group_size, kept, text_sha256, and ``_copy``, which counts rows that
    repeat both id and text: only the first of those is kept. Null texts count as
    empty. Null ids never own a text unless all of its ids are null; then keep_id is null
    and one row is kept. Other columns are ignored; an empty table gives no rows.
    """
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    own = owners(ids, text_bytes(F.col("text")), keep, budget)
    thin = ids.select("doc_id", F.unhex(F.sha2(text_bytes(F.col("text")), 256)).alias("sha"))
    again = Window.partitionBy("sha", "doc_id").orderBy("doc_id")
    counted = thin.withColumn("_copy", F.row_number().over(again))
    return counted.join(own, "sha").select(
        "doc_id",
        F.col("owner").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("owner")) & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "_copy",
    )
