"""Pack token sequences with minimum bin slack.

A document's tokens are cut into whole windows and one remainder. Remainders are counted
by length; at most one count per length below the window reaches the driver. A window
starts with the longest length left, and a bitset subset-sum dynamic programme over the
lengths left finds the multiset that fills it closest to capacity; its counts are
backtracked, and the pattern is used as often as the lengths last, so the number of
programmes depends on the window and not on the rows. Spark then numbers the pieces of
each length and joins them to their place in the pattern.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import numbered, slices, staged, with_block
from delaylens.llm.tokens import text_ids

SLICE_BYTES = 8 << 20


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length, within ``counts``, sum closest to ``capacity`` from below.

    Bit s of a set says that a sum of s can be reached. Lengths are added in descending
    order, in chunks of 1, 2, 4, ... pieces, until the capacity itself can be reached.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((c for c in counts if 0 < c <= capacity and counts[c] > 0), reverse=True):
        left, chunk = min(counts[length], capacity // length), 1
        while left:
            take = min(chunk, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            chunk *= 2
        if reach >> capacity:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not (before >> total) & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def patterns(counts: dict[int, int], window: int) -> list[tuple[int, dict[int, int]]]:
    """(times, counts by length) of the windows that use up ``counts``."""
    left = {c: n for c, n in counts.items() if n > 0}
    found = []
    while left:
        first = max(left)
        left[first] -= 1
        pattern = closest_fill(left, window - first)
        left[first] += 1
        pattern[first] = pattern.get(first, 0) + 1
        times = min(left[c] // n for c, n in pattern.items())
        found.append((times, pattern))
        for c, n in pattern.items():
            left[c] -= times * n
            if not left[c]:
                del left[c]
    return found


def placements(found: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, pieces a window, first window, offset) of each pattern's lengths."""
    rows, ranks, window = [], {}, 0
    for times, pattern in found:
        offset = 0
        for length in sorted(pattern, reverse=True):
            each = pattern[length]
            first = ranks.get(length, 0)
            rows.append((length, first, times * each, each, window, offset))
            ranks[length] = first + times * each
            offset += length * each
        window += times
    return rows


def _pieces(path: str, end: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = text_ids(path, False)
        stop = end.to_bytes(4, "little")
        for batch in slices(batches, "text", SLICE_BYTES):
            at, starts, lengths, sums, totals = [], [], [], [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, found in enumerate(ids.of(texts)):
                whole = memoryview(found + stop)
                n = len(whole) // 4
                for start in range(0, n, window):
                    piece = whole[4 * start : 4 * (start + window)]
                    at.append(i)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(n)
            columns = [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(at, pa.int64())), *columns],
                names=["row", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return run


def pieces(
    docs: DataFrame, columns: list[str], tokenizer: str, text: str = "text", end: int = 2, window: int = 4096
) -> DataFrame:
    """Cut every document's ids, with ``end`` behind them, into windows and a remainder.

    Returns ``row`` (a struct of ``columns``), start, length, ids_crc32, doc_tokens. A null text is
    empty and leaves the end id alone.
    """
    rows = docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"row {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.mapInArrow(_pieces(tokenizer, end, window), schema)


def pack(cut: DataFrame, order: list[str], window: int = 4096) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` from 1 to ``window``.

    Sequences hold at most ``window`` tokens, gapless from 0. Equal pieces are numbered
    one by one; an empty table gives no rows.
    """
    spark = cut.sparkSession
    held = staged(with_block(cut), "pieces")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    schema = "length long, first long, ranks long, each long, window long, at long"
    plan = spark.createDataFrame(placements(patterns(counts, window)), schema)
    ranked = numbered(held, "length", order, "_rank", placed=True)
    inside = F.col("_rank") - F.col("first")
    placed = ranked.join(F.broadcast(plan), "length").filter((inside >= 0) & (inside < F.col("ranks")))
    return placed.select(
        *cut.columns,
        (F.col("window") + F.floor(inside / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(inside, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
