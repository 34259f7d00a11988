"""Token ids in directly addressable codes: any id can be read without decoding a block.

An id is cut into chunks of bits, lowest first. Level k packs the k-th chunks of all ids
that have one; a continuation bitmap says which ids go on, and a rank directory gives
their place in the next level. Each file chooses the widths that make it smallest from the
bit lengths of its own ids. Files are written in order of the documents' ids; a document
lies in one file.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import slices, staged
from delaylens.llm.tokens import text_ids
from delaylens.llm.warc import file_system
from delaylens.operators.ordered import place, running_totals

MAGIC = b"DAC1"
WORD = 64
RANK_WORDS = 8
SLICE_BYTES = 4 << 20
FILE_IDS = 8 << 20
READ_IDS = 1 << 20
OUT_DOCS = 20_000


def widths(ids: np.ndarray) -> list[int]:
    """Chunk widths, lowest bits first, that need the fewest bits with their bitmaps and directories."""
    lengths = np.bincount(np.frexp(ids.astype("f8"))[1], minlength=2) if len(ids) else np.array([0, 0])
    top = max(len(lengths) - 1, 1)
    longer = np.concatenate([np.cumsum(lengths[::-1])[::-1], [0]])
    # at[b] ids have a chunk that starts at bit b
    at = [len(ids)] + [int(longer[b + 1]) for b in range(1, top)]
    mark = 1 + 1 / RANK_WORDS
    best: list[tuple[float, list[int]]] = [(0.0, [])] * (top + 1)
    for b in range(top - 1, -1, -1):
        best[b] = min(
            (at[b] * (e - b + (mark if e < top else 0)) + best[e][0], [e - b, *best[e][1]]) for e in range(b + 1, top + 1)
        )
    return best[0][1]


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits one behind the other in 64-bit words, one spare word at the end."""
    rows = -(-len(values) // WORD)
    lanes = np.zeros(rows * WORD, "<u8")
    lanes[: len(values)] = values
    lanes = lanes.reshape(rows, WORD)
    words = np.zeros((rows, width), "<u8")
    for lane in range(WORD):
        word, shift = divmod(lane * width, WORD)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + width > WORD:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(WORD - shift)
    return np.append(words.ravel(), np.uint64(0))


def unpack(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The packed values at the positions ``at``."""
    bit = at.astype("<i8") * width
    word, shift = bit >> 6, (bit & 63).astype("<u8")
    low = words[word] >> shift
    # shifted in two steps, as a shift by all 64 bits is not defined
    high = (words[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
    return (low | high) & np.uint64((1 << width) - 1)


@dataclass
class Bitmap:
    """Bits with the number of ones before each block of eight words."""

    words: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, bits: np.ndarray) -> Bitmap:
        blocks = len(bits) // (WORD * RANK_WORDS) + 1
        padded = np.zeros(blocks * WORD * RANK_WORDS, bool)
        padded[: len(bits)] = bits
        words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(words).reshape(blocks, RANK_WORDS).sum(1, dtype="<u8")
        return cls(words, np.cumsum(ones, dtype="<u8") - ones)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype("<u8")) & np.uint64(1)).astype(bool)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each position."""
        word = at >> 6
        block = word // RANK_WORDS
        ones = self.ranks[block].astype("<i8")
        for k in range(RANK_WORDS - 1):
            inside = block * RANK_WORDS + k
            ones += np.where(inside < word, np.bitwise_count(self.words[inside]), 0)
        below = self.words[word] & ((np.uint64(1) << (at & 63).astype("<u8")) - np.uint64(1))
        return ones + np.bitwise_count(below)

    def run(self, start: int, stop: int) -> np.ndarray:
        """The bits from ``start`` to ``stop``."""
        part = self.words[start >> 6 : (stop + 63) >> 6]
        return np.unpackbits(part.view("u1"), bitorder="little")[start & 63 :][: stop - start].astype(bool)


@dataclass
class Codes:
    """Levels of chunks: width, packed chunks and, but for the last level, who goes on."""

    levels: list[tuple[int, np.ndarray, Bitmap | None]]
    n: int

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        left, levels, wide = ids.astype("<u8"), [], widths(ids)
        for k, width in enumerate(wide):
            chunks = pack(left & np.uint64((1 << width) - 1), width)
            left = left >> np.uint64(width)
            more = left > 0
            levels.append((width, chunks, Bitmap.of(more) if k + 1 < len(wide) else None))
            left = left[more]
        return cls(levels, len(ids))

    def get(self, at: np.ndarray) -> np.ndarray:
        """Ids at any positions."""
        ids, where, shift = np.zeros(len(at), "<u8"), np.arange(len(at)), 0
        at = np.asarray(at, "<i8")
        for width, chunks, more in self.levels:
            ids[where] |= unpack(chunks, width, at) << np.uint64(shift)
            if more is None:
                break
            on = more.get(at)
            where, at, shift = where[on], more.rank(at[on]), shift + width
        return ids.astype("<u4")

    def run(self, start: int, stop: int) -> np.ndarray:
        """Ids of a run of positions: a rank at either end of it for each level."""
        ids, where, shift = np.zeros(stop - start, "<u8"), slice(None), 0
        for width, chunks, more in self.levels:
            ids[where] |= unpack(chunks, width, np.arange(start, stop)) << np.uint64(shift)
            if more is None or start == stop:
                break
            on = np.flatnonzero(more.run(start, stop))
            where = on if shift == 0 else where[on]
            start, stop = more.rank(np.array([start, stop])).tolist()
            shift += width
        return ids.astype("<u4")


def to_bytes(keys: list[int | None], starts: np.ndarray, ids: np.ndarray) -> bytes:
    """A file: magic, length of a JSON header, header, then the sections that it places."""
    codes = Codes.of(ids)
    known = np.array([k is not None for k in keys], bool)
    parts = {
        "keys": np.array([0 if k is None else k for k in keys], "<i8"),
        "known": np.packbits(known, bitorder="little"),
        "starts": starts.astype("<u8"),
    }
    for k, (_, chunks, more) in enumerate(codes.levels):
        parts[f"chunks{k}"] = chunks
        if more is not None:
            parts[f"more{k}"], parts[f"ranks{k}"] = more.words, more.ranks
    sections, at = {}, 0
    for name, part in parts.items():
        sections[name] = [at, part.nbytes]
        at += part.nbytes + -part.nbytes % 8
    about = {"ids": len(ids), "docs": len(keys), "widths": [w for w, _, _ in codes.levels], "sections": sections}
    header = json.dumps(about).encode()
    header += b" " * (-(len(header) + 8) % 8)
    body = [p.tobytes() + bytes(-p.nbytes % 8) for p in parts.values()]
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *body])


@dataclass
class TokenFile:
    """Documents and ids of a file's bytes; the arrays are views of them."""

    keys: list[int | None]
    starts: np.ndarray
    codes: Codes

    @classmethod
    def of(cls, data: bytes) -> TokenFile:
        if data[:4] != MAGIC:
            raise ValueError("not a file of addressable codes")
        body = 8 + int.from_bytes(data[4:8], "little")
        about = json.loads(data[8:body])

        def part(name: str, kind: str) -> np.ndarray:
            at, size = about["sections"][name]
            return np.frombuffer(data, kind, size // np.dtype(kind).itemsize, body + at)

        known = np.unpackbits(part("known", "u1"), bitorder="little")
        keys = [k if ok else None for k, ok in zip(part("keys", "<i8").tolist(), known)]
        levels, last = [], len(about["widths"]) - 1
        for k, width in enumerate(about["widths"]):
            more = Bitmap(part(f"more{k}", "<u8"), part(f"ranks{k}", "<u8")) if k < last else None
            levels.append((width, part(f"chunks{k}", "<u8"), more))
        return cls(keys, part("starts", "<u8").astype("<i8"), Codes(levels, about["ids"]))


def _write(folder: str, tokenizer: str, end: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = file_system(folder)
        encode, stop = text_ids(tokenizer, True), end.to_bytes(4, "little")
        keys, starts, ids, n, seq = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            part = TaskContext.get().partitionId()
            name = f"part-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            system.create_dir(inner, recursive=True)
            with system.open_output_stream(f"{inner}/{name}", compression=None) as out:
                out.write(to_bytes(keys, np.array(starts), np.frombuffer(b"".join(ids), "<u4")))
            return pa.RecordBatch.from_pylist(
                [{"file": f"{folder}/{name}", "part": part, "seq": seq, "docs": len(keys), "ids": n}]
            )

        for batch in batches:
            for piece in slices(iter([batch]), "text", SLICE_BYTES):
                found = encode.of([t or "" for t in piece.column("text").to_pylist()])
                for key, own in zip(piece.column("key").to_pylist(), found):
                    if n >= file_ids:
                        yield close()
                        keys, starts, ids, n, seq = [], [], [], 0, seq + 1
                    keys.append(key)
                    starts.append(n)
                    ids.append(own + stop)
                    n += len(own) // 4 + 1
        if keys:
            yield close()

    return run


def write(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = 0,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Files of the ids of all ``docs``, each document's ids followed by ``end``.

    Returns file, docs, ids and ``first``, the number of ids in all files before. Documents
    stand in ascending order of ``key`` (a whole number; nulls first), equal keys by text;
    rows that repeat both stand one behind the other. A null text is empty, and an empty
    table has no files. Other columns are not read. A file ends with the document that
    brings it to ``file_ids`` ids, so only a longer document makes a larger file. Names
    are new in each attempt; only files named by finished tasks count.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("print"),
        F.monotonically_increasing_id().alias("row"),
    )
    # the row's place parts a key that many rows repeat; it orders only what is equal
    spread = rows.repartitionByRange(F.col("key").asc_nulls_first(), "print", "row")
    ordered = spread.sortWithinPartitions(F.col("key").asc_nulls_first(), "print", "text", "row").select("key", "text")
    schema = "file string, part long, seq long, docs long, ids long"
    files = staged(ordered.mapInArrow(_write(folder, tokenizer, end, file_ids), schema), "files")
    summed = running_totals(place(files, ["part", "seq"]), {"upto": F.col("ids")})
    return summed.select("file", "docs", "ids", (F.col("upto") - F.col("ids")).alias("first"))


def _read(end: int):
    schema = pa.schema([(c, pa.int64()) for c in ("key", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                system, inner = file_system(path)
                with system.open_input_stream(inner, compression=None) as stream:
                    held = TokenFile.of(stream.read())
                stops = np.append(held.starts[1:], held.codes.n)
                if (held.codes.get(stops - 1) != end).any():
                    raise ValueError(f"a document of {path} does not close with the end id")
                doc = 0
                while doc < len(held.keys):
                    start = int(held.starts[doc])
                    upto = max(int(np.searchsorted(stops, start + READ_IDS, "right")), doc + 1)
                    upto = min(upto, doc + OUT_DOCS)
                    ids = memoryview(held.codes.run(start, int(stops[upto - 1])).tobytes())
                    cuts = (4 * (np.append(held.starts[doc:upto], stops[upto - 1]) - start)).tolist()
                    sums = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
                    starts = held.starts[doc:upto]
                    columns = (held.keys[doc:upto], first + starts, stops[doc:upto] - starts, sums)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)
                    doc = upto

    return run


def read(files: DataFrame, end: int = 0) -> DataFrame:
    """Documents of the files of :func:`write`: key, start among all ids, n_tokens and ids_crc32.

    A task reads whole files; the last id of each document is looked up by its place and must be ``end``.
    """
    held = files.select("file", "first")
    tasks = max(held.count(), 1)
    schema = "key long, start long, n_tokens long, ids_crc32 long"
    return held.repartitionByRange(tasks, "first").mapInArrow(_read(end), schema)
