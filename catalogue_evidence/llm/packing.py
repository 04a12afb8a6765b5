"""Packing of documents into sequences of bounded length by sums of squares.

Each task encodes its documents and packs them as they come, in portions of bounded size: a document goes where the sum
of squares, over all residual gaps, of the number of open sequences with that gap becomes smallest. Sequences that a
portion fills stay; what lies in the others is pooled over all tasks, in groups of bounded size, and packed once more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue_evidence.llm.bytelevel import byte_level
from catalogue_evidence.llm.chunks import portions
from catalogue_evidence.llm.common import staged

PORTION = 1 << 16  # pieces packed together, in a task or in a group of what tasks left open, at most
TOKENS = 1 << 23  # that such pieces hold, before the next portion begins
ROUNDS = 4  # times that a group's open sequences are emptied and packed again


def sums_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence, from 0, of each piece in the order given.

    With N(g) open sequences of gap g, a piece of size s moves one from gap g to gap g - s and changes the sum of N(g)^2
    by 2 (N(g - s) - N(g) + 1), by 1 - 2 N(s) where it fills one, and by 2 N(capacity - s) + 1 in a new one. The least
    change wins; ties go to the smallest gap, and to a new sequence last.
    """
    n_open = np.zeros(capacity + 1, np.int64)
    of_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), np.int64)
    made = 0
    for k, s in enumerate(sizes.tolist()):
        gaps = np.flatnonzero(n_open[s:capacity]) + s
        gap, least = capacity, 2 * n_open[capacity - s] + 1 if s < capacity else 0
        if len(gaps):
            change = 2 * (n_open[gaps - s] - n_open[gaps] + 1)
            if gaps[0] == s:
                change[0] = 1 - 2 * n_open[s]
            at = int(change.argmin())
            if change[at] <= least:
                gap = int(gaps[at])
        if gap == capacity:
            own, made = made, made + 1
        else:
            own = of_gap[gap].pop()
            n_open[gap] -= 1
        if gap > s:
            of_gap[gap - s].append(own)
            n_open[gap - s] += 1
        out[k] = own
    return out


def packed(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """sums_of_squares() in the order given, then its open sequences' pieces again from the largest one down, as long as
    that saves sequences; or all pieces from the largest one down where that takes fewer."""

    def falling(which: np.ndarray) -> np.ndarray:
        order = which[np.argsort(-sizes[which], kind="stable")]
        out = np.empty(len(sizes), np.int64)
        out[order] = sums_of_squares(sizes[order], capacity)
        return out[which]

    every = np.arange(len(sizes))
    best = sums_of_squares(sizes, capacity)
    for _ in range(ROUNDS):
        gap = capacity - np.bincount(best, sizes).astype(np.int64)
        which = np.flatnonzero(gap[best] > 0)
        if not len(which):
            break
        again = falling(which)
        if again.max() + 1 >= (gap > 0).sum():
            break
        best[which] = len(gap) + again
        best = np.unique(best, return_inverse=True)[1].astype(np.int64)
    other = falling(every) if len(sizes) else best
    return other if len(sizes) and other.max() < best.max() else best


def offsets(sequence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each piece's place in its sequence, in order of the pieces."""
    order = np.argsort(sequence, kind="stable")
    before = np.cumsum(sizes[order]) - sizes[order]
    first = np.flatnonzero(np.diff(sequence[order], prepend=-1))
    before -= np.repeat(before[first], np.diff(np.append(first, len(order))))
    out = np.empty(len(sizes), np.int64)
    out[order] = before
    return out


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(start, ids) of a document's pieces: whole unless longer than capacity, else the rest first and then full ones."""
    first = len(ids) % capacity or min(len(ids), capacity)
    bounds = [0, *range(first, len(ids) + 1, capacity)]
    return [(i, ids[i:j]) for i, j in zip(bounds, bounds[1:])]


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _first(docs: DataFrame, path: str, pattern: str, capacity: int, end: int, with_ids: bool) -> DataFrame:
    """Pieces with the sequences that tasks give them, and whether such a sequence is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = byte_level(path, pattern)
        base = TaskContext.get().partitionId() << 20
        held: list[tuple] = []
        done = tokens = 0

        def portion() -> pa.RecordBatch:
            cols = list(zip(*held))
            sizes = np.array(cols[3], np.int64)
            sequence = sums_of_squares(sizes, capacity)
            full = np.bincount(sequence, sizes) == capacity
            arrays = [pa.array(c, t) for c, t in zip(cols, _TYPES)]
            arrays += [pa.array((base + done << 17) + sequence), pa.array(offsets(sequence, sizes)), pa.array(full[sequence])]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            at = 0
            for texts in portions(batch.column(1)):
                keys = batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                for key, text in zip(keys, texts):
                    ids = np.append(own.encode(text, added=True), np.uint32(end)).astype("<u4")
                    for k, (start, part) in enumerate(cut(ids, capacity)):
                        raw = part.tobytes()
                        held.append((key, k, start, len(part), zlib.crc32(raw), raw if with_ids else None))
                        tokens += len(part)
                        if len(held) == PORTION or tokens >= TOKENS:
                            yield portion()
                            held.clear()
                            done, tokens = done + 1, 0
        if held:
            yield portion()

    schema = _PIECE + ", full boolean"
    names = [f.name for f in T.StructType.fromDDL(schema)]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, end: int = 0, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset): the pieces of docs and where they are packed.

    A document is the ids of its whole text by the tokenizers library's file `path`, strings of added tokens counting as
    these tokens, and then `end`; a null or empty text has that id alone. One longer than capacity is cut, the first
    piece taking what full ones leave. Each row of docs is packed for itself, however often it comes; a null doc_id stays
    null; a text however long gives pieces of capacity. ids are unsigned 32-bit little-endian integers, null unless
    with_ids. sequence_id is any number, offset a piece's place in its sequence, without gaps. Only doc_id and text are
    read, other columns don't matter, and no rows give no rows.
    """
    first = staged(_first(docs, path, pattern, capacity, end, with_ids), "packed-in-tasks")
    rest = first.filter(~F.col("full")).drop("full")
    n = rest.agg(F.count(F.lit(1)).alias("pieces"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).first()
    groups = max(1, -(-n["pieces"] // PORTION), -(-n["tokens"] // (2 * TOKENS)))

    def again(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values(["sequence_id", "offset"], kind="stable").reset_index(drop=True)
        sizes = some["length"].to_numpy(np.int64)
        sequence = packed(sizes, capacity)
        some["offset"] = offsets(sequence, sizes)
        some["sequence_id"] = (1 << 62) + (int(some["group"].iloc[0]) << 20) + sequence
        return some.drop(columns="group")

    # Groups are a hash of first sequences, each at most capacity long: they are of nearly equal and bounded size.
    rest = rest.withColumn("group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    return first.filter("full").drop("full").unionByName(rest.groupBy("group").applyInPandas(again, _PIECE))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): what pack() with ids puts together; ids is at most as long as its capacity. doc_ids
    are those of the pieces in order, null ones included."""
    in_order = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    made = pieces.groupBy("sequence_id").agg(in_order.alias("in_order"))
    joined = F.aggregate("in_order", F.lit(b""), lambda so_far, p: F.concat(so_far, p["ids"]))
    return made.select("sequence_id", joined.alias("ids"), F.transform("in_order", lambda p: p["doc_id"]).alias("doc_ids"))
