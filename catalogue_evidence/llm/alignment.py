"""Alignment of two tokenizers' tokens by an inverted index of token pairs.

Documents are numbered in blocks. For each block and pair of ids whose occurrences end at one byte, a bitmap holds the
documents with that pair and further bitmaps, one for each binary digit, how often it occurs there beyond once. Counts of
set bits give the pairs' counts in the corpus; they return along the bitmaps to the documents as scores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from catalogue_evidence.llm.bytelevel import ByteLevel, byte_level
from catalogue_evidence.llm.chunks import portions
from catalogue_evidence.llm.common import staged

DOCS = 1 << 12  # in a block, at most
LINKS = 1 << 21  # in a block, before the next one begins
RAW = DOCS // 8  # bytes of a bitmap; one of fewer documents than that would take is the list of their numbers
MARK = "▁"  # stands for a blank in pieces


class Pieces:
    """Ids of a sentencepiece model and the bytes that its pieces stand for."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.bytes = [self._bytes(i) for i in range(self.size)]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One for each Python worker, which serves task after task."""
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to size - 1, to the right in rows of bytes with room for a mark behind, and where they are."""
    width = len(str(size - 1))
    rows = np.frombuffer(b"".join(b"%*d;" % (width, i) for i in range(size)), np.uint8).reshape(size, width + 1)
    return rows, rows != ord(" ")


@dataclass
class Links:
    """Of some texts: their counts, digests, and all their links as ids (a, b) with the number of their text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: list[str]
    a: np.ndarray
    b: np.ndarray
    text: np.ndarray


class Aligner:
    def __init__(self, first: ByteLevel, second: Pieces) -> None:
        self.first, self.second = first, second
        size = max(first.size, second.size)
        self.digits, self.shown = _digits(size)
        self.len_a, self.len_b = (np.fromiter(map(len, x.bytes), np.int64, x.size) for x in (first, second))

    def links(self, texts: list[str]) -> Links:
        """Texts that either tokenizer doesn't give back have none. Tokens have bytes, so a group has one link: its last
        token of either kind."""
        spaced = [" " + t for t in texts]
        ids_a = [self.first.encode(t, added=False) if len(t) > 1 else np.zeros(0, np.uint32) for t in spaced]
        ids_b = self.second.encode(texts)
        get_a, get_b = self.first.bytes.__getitem__, self.second.bytes.__getitem__
        for k, t in enumerate(spaced):
            raw = t.encode()
            if b"".join(map(get_b, ids_b[k])) != raw or b"".join(map(get_a, ids_a[k].tolist())) != raw:
                ids_a[k], ids_b[k] = ids_a[k][:0], []
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(texts)) for x in (ids_a, ids_b))
        a = np.concatenate([*ids_a, np.zeros(0)]).astype(np.int64)
        b = np.concatenate([*(np.array(x, np.int64) for x in ids_b), np.zeros(0, np.int64)])
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])  # both run over the same bytes of all texts
        common = np.zeros(1 + (end_a[-1] if len(a) else 0), np.uint8)
        common[end_a] = 1
        common[end_b] += 1
        last_a, last_b = common[end_a] == 2, common[end_b] == 2
        text = np.repeat(np.arange(len(texts)), n_a)[last_a]
        digests = self._digests(a, b, last_a, last_b, n_a + n_b)
        return Links(n_a, n_b, np.bincount(text, minlength=len(texts)), digests, a[last_a], b[last_b], text)

    def _digests(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, n: np.ndarray) -> list[str]:
        """SHA-256 of each text's groups, written as a1,a2|b1;a3|b2,b3; of a text without tokens, nothing."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        per_a, per_b = np.bincount(group_a), np.bincount(group_b)
        at_a = np.arange(len(a)) + (np.cumsum(per_b) - per_b)[group_a]
        at_b = np.arange(len(b)) + np.cumsum(per_a)[group_b]
        ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        marks[at_a[last_a]], marks[at_b[last_b]] = ord("|"), ord(";")
        rows = self.digits[ids]
        rows[:, -1] = marks
        shown = self.shown[ids]
        written = memoryview(rows[shown].tobytes())
        ends = np.concatenate(([0], np.cumsum(shown.sum(axis=1))))[np.concatenate(([0], np.cumsum(n)))]
        return [hashlib.sha256(written[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(ends.tolist(), ends[1:].tolist())]


def containers(of: np.ndarray, number: np.ndarray, n: int) -> tuple[np.ndarray, bytes]:
    """(sizes, bytes): for each of n sets of numbers below DOCS the bitmap of those in it, or where that is shorter the
    list of them as 16-bit integers. of: the set of each number, both in order."""
    count = np.bincount(of, minlength=n)
    dense = 2 * count >= RAW
    sizes = np.where(dense, RAW, 2 * count)
    out = np.zeros(sizes.sum(), np.uint8)
    begin = np.cumsum(sizes) - sizes
    raw = dense[of]
    np.bitwise_or.at(out, begin[of[raw]] + (number[raw] >> 3), (1 << (number[raw] & 7)).astype(np.uint8))
    nth = np.arange(len(of)) - (np.cumsum(count) - count)[of]
    at = begin[of[~raw]] + 2 * nth[~raw]
    out[at], out[at + 1] = number[~raw] & 0xFF, number[~raw] >> 8
    return sizes, out.tobytes()


def members(sizes: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(of, number): what containers() was given."""
    held = np.frombuffer(raw, np.uint8)
    begin = np.cumsum(sizes) - sizes
    dense = sizes == RAW
    bits = np.unpackbits(held[begin[dense][:, None] + np.arange(RAW)], axis=1, bitorder="little")
    row, number = np.nonzero(bits)
    few = np.flatnonzero(~dense)
    of = np.repeat(few, sizes[few] // 2)
    inner = 2 * (np.arange(len(of)) - np.repeat(np.cumsum(sizes[few] // 2) - sizes[few] // 2, sizes[few] // 2))
    at = begin[of] + inner
    return np.concatenate((np.flatnonzero(dense)[row], of)), np.concatenate((number, held[at] + 256 * held[at + 1].astype(np.int64)))


def popcounts(sizes: np.ndarray, raw: bytes) -> np.ndarray:
    """How many numbers each container holds."""
    held = np.frombuffer(raw, np.uint8)
    dense = sizes == RAW
    count = sizes // 2
    count[dense] = np.bitwise_count(held[(np.cumsum(sizes) - sizes)[dense][:, None] + np.arange(RAW)]).sum(axis=1)
    return count


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_OF_DOCS = {"doc_ids": _LONGS, "n_a": _LONGS, "n_b": _LONGS, "n_groups": _LONGS, "digests": pa.list_(pa.string())}
_OF_PAIRS = {"pairs": _LONGS, "documents": _LONGS, "links": _LONGS}
_OF_BITMAPS = {"of": _INTS, "plane": _INTS, "sizes": _INTS, "bitmaps": pa.binary()}
_INDEX = pa.schema({"block": pa.int64()} | _OF_DOCS | _OF_PAIRS | _OF_BITMAPS)


def _block(block: int, keys: list, parts: list[Links]) -> pa.RecordBatch:
    """The index of a block of documents: one row."""
    number = np.concatenate([p.text + sum(len(q.n_a) for q in parts[:i]) for i, p in enumerate(parts)])
    pair = np.concatenate([p.a << 32 | p.b for p in parts])
    ids, of = np.unique(pair, return_inverse=True)
    # Bitmaps of portions merge by this one sort: a document stands once in a pair's bitmap, with its multiplicity.
    met, times = np.unique(of.astype(np.int64) << 16 | number, return_counts=True)
    of, number, more = met >> 16, met & 0xFFFF, times - 1
    sets = [(np.arange(len(ids)), np.zeros(len(ids), np.int64), *containers(of, number, len(ids)))]
    for digit in range(int(more.max(initial=0)).bit_length()):
        has = more >> digit & 1 == 1
        which, place = np.unique(of[has], return_inverse=True)
        sets.append((which, np.full(len(which), digit + 1), *containers(place, number[has], len(which))))
    owner, plane, sizes = (np.concatenate([s[k] for s in sets]).astype(np.int64) for k in range(3))
    raw = b"".join(s[3] for s in sets)
    count = popcounts(sizes, raw)
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, owner, count << np.maximum(plane - 1, 0))
    values = [block, keys, *(np.concatenate([getattr(p, c) for p in parts]) for c in ("n_a", "n_b", "n_groups"))]
    values += [[d for p in parts for d in p.digests], ids, count[: len(ids)], links, owner, plane, sizes, raw]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _INDEX.types)], schema=_INDEX)


def index(docs: DataFrame, first: str, pattern: str, second: str) -> DataFrame:
    """Blocks of documents, one row each: what is kept of the documents, the block's pairs (a << 32 | b) with the numbers of
    documents and links that their bitmaps count, and the bitmaps. of, plane and sizes say for each bitmap whose pair it
    is, what it holds (0: the documents; k: binary digit k - 1 of how often beyond once) and its bytes. A block ends with
    DOCS documents or LINKS links, so that one is larger only by its last portion of text, however long that is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Aligner(byte_level(first, pattern), pieces(second))
        block = TaskContext.get().partitionId() << 32
        keys: list = []
        parts: list[Links] = []
        links = 0
        for batch in batches:
            at = 0
            for texts in portions(batch.column(1)):
                while texts:
                    some = texts[: DOCS - len(keys)]
                    parts.append(own.links(some))
                    keys += batch.column(0).slice(at, len(some)).to_pylist()
                    at, texts, links = at + len(some), texts[len(some) :], links + len(parts[-1].a)
                    if len(keys) == DOCS or links >= LINKS:
                        yield _block(block, keys, parts)
                        block, keys, parts, links = block + 1, [], [], 0
        if keys:
            yield _block(block, keys, parts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, from_arrow_schema(_INDEX))


def pairs(blocks: DataFrame) -> DataFrame:
    """(pair, n_documents, n_links, best): in the whole corpus, of each pair a << 32 | b; best if no pair of its b has more
    links."""
    each = blocks.select(F.inline(F.arrays_zip("pairs", "documents", "links")))
    total = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("documents").alias("n_documents"), F.sum("links").alias("n_links"))
    total = staged(total, "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = total.groupBy(b.alias("b")).agg(F.max("n_links").alias("most"))  # a row for each id of one vocabulary
    return total.join(F.broadcast(most), b == most["b"]).select("pair", "n_documents", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def align(docs: DataFrame, first: str, pattern: str, second: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each row of docs.

    A is the byte-level file `first` of the tokenizers library over a blank and the text, B the sentencepiece model
    `second`, which puts that blank there itself; both without special tokens, whose strings are plain text. Groups end
    where tokens of both end; links are pairs of tokens that end together, one a group. A pair's count is its links in
    the corpus; n_best are the links of pairs whose count no other pair of the same B id exceeds, count_sum is the sum
    of counts over links. Texts that are null, empty or not given back by both have zeros and ''. Repeated rows and null
    doc_ids are documents like others; a text however long is one. Only doc_id and text are read. No rows give no rows.
    """
    blocks = staged(index(docs, first, pattern, second), "pair-bitmaps")
    total = pairs(blocks)
    each = blocks.select("block", F.posexplode("pairs").alias("place", "key"))
    back = each.join(total, each["key"] == total["pair"]).groupBy("block").agg(F.collect_list(F.struct("place", "n_links", "best")).alias("scores"))
    back = back.select(F.col("block").alias("to"), "scores")
    met = blocks.select("block", *_OF_DOCS, *_OF_BITMAPS).join(back, F.col("block") == F.col("to"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {n: batch.column(n).slice(i, 1) for n in batch.schema.names}
                yield _scored({n: c.flatten() if pa.types.is_list(c.type) else c for n, c in row.items()})

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return met.drop("block", "to").mapInArrow(run, schema)


def _scored(row: dict[str, pa.Array]) -> pa.RecordBatch:
    """A block's documents, with the scores of their pairs added up along the bitmaps."""
    n = len(row["doc_ids"])
    of, plane, sizes = (row[c].to_numpy().astype(np.int64) for c in ("of", "plane", "sizes"))
    place, links, best = (row["scores"].field(k).to_numpy(zero_copy_only=False) for k in range(3))
    count, top = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], top[place] = links, best
    container, number = members(sizes, row["bitmaps"][0].as_py() or b"")
    weight = 1 << np.maximum(plane - 1, 0)
    count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(count_sum, number, (weight * count[of])[container])
    np.add.at(n_best, number, (weight * top[of])[container])
    kept = [row[c] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_groups")]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.RecordBatch.from_arrays([*kept, pa.array(n_best), pa.array(count_sum), row["digests"]], names=names)
