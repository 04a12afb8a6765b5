"""Token ids in files: frequency ranks in byte-aligned variable length, control bytes apart from data bytes.

A folder holds part-NNNNN.ids files in ascending doc_id order and vocabulary.ids with the id of each rank. A part file
is: 4 bytes "IDS1", number of documents, of control bytes and of data bytes (64-bit); doc_id of each document (64-bit),
1 for each that is null (8-bit), number of ids of each (32-bit); all control bytes; all data bytes. Each document's ids
begin with a new control byte. A control byte holds the lengths of four ids, less one, in two bits each, the first in
the lowest; an id is the little-endian rank in as many bytes. All numbers are little-endian and unsigned but doc_id.
"""

from __future__ import annotations

import json
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from catalogue_evidence.llm.chunks import Ragged, Recent, list_ends, slices
from catalogue_evidence.llm.common import shared_path

MAGIC = b"IDS1"
IDS_IN_FILE = 4_000_000
END_ID = 2
BROADCAST_FILES = 1_000_000  # more files than this find their first ids by a shuffle join
# How the tokenizers file normalises and cuts; what it says beside that is in the file itself.
USUAL = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
]


def _plain(c: str) -> bool:
    """A letter that is its own normal form, whose lower case is one letter, in every version of Unicode and place in a word."""
    low = c.lower()
    whole = len(low) == 1 and low.isalpha() and ord(low) < 0x530 and unicodedata.is_normalized("NFC", c + low)
    return c.isalpha() and whole and not 0x370 <= ord(c) < 0x400


LETTERS = "".join(c for c in map(chr, range(0x41, 0x530)) if _plain(c))
#: ASCII but for white space, control characters, the apostrophe of contractions and the bar of special tokens.
PLAIN = f"^[{LETTERS}!-&(-{{}}~]+$"
WORD = f"^[{LETTERS}]+$"
PIECES = f"([{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+)"
#: The characters that stand for the bytes of a letter in a byte-level vocabulary.
BYTES = {ord(c): "".join(chr(b) if 0xA1 <= b <= 0xAC or 0xAE <= b else chr(0x100 + b - 0x5E) if b < 0xA1 else chr(0x143) for b in c.encode()) for c in LETTERS if not c.isascii()}
#: Lengths of the four ids of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def packed(ranks: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of documents of n[0], n[1], ... ranks, each of which begins with a new control byte."""
    r = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    places, used = spread(n)
    codes = np.zeros(places, np.uint8)
    codes[used] = size - 1
    codes = codes.reshape(-1, 4)
    return (codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6).tobytes(), data.tobytes()


def spread(n: np.ndarray) -> tuple[int, np.ndarray]:
    """How many places the control bytes of documents of n ids have, and which of them are used."""
    room = -(-n // 4) * 4
    first = np.cumsum(room) - room
    return int(room.sum()), np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def unpacked(control: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ranks in control and data bytes of documents of n ranks."""
    size = LENGTHS[control].ravel()[spread(n)[1]]
    begin = np.cumsum(size, dtype=np.int64) - size
    out = np.zeros((len(size), 4), np.uint8)
    for k in range(4):
        has = np.flatnonzero(size > k)
        out[has, k] = data[begin[has] + k]
    return out.view("<u4").ravel()


class _Words:
    """Ids of texts by a tokenizers file whose pieces never reach across white space.

    Texts are cut at white space and each different chunk of a portion is encoded once. The tokenizer as it is encodes a
    chunk, but for those whose characters are all PLAIN: there normal form is lower case and PIECES are the pieces that
    the tokenizer cuts, so the tokenizer's model is asked for each new piece alone.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        cut = json.loads(self.tokenizer.to_str())
        #: Whether the file cuts and normalises as PLAIN and PIECES suppose; with any other file every chunk goes to the tokenizer.
        self.usual = [cut["normalizer"], cut["pre_tokenizer"]] == USUAL and all("|" in t["content"] for t in cut["added_tokens"])
        self.pieces = Recent(self.encode_pieces, 250_000)
        self.chunks = Recent(self.alone, 50_000)

    def packed(self, ids: list[int]) -> bytes:
        return array(self.kind().dtype.char, ids).tobytes()

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        ask = self.model.tokenize
        return [self.packed([t.id for t in ask(p if p.isascii() else p.translate(BYTES))]) for p in pieces]

    def alone(self, chunks: list[str]) -> list[bytes]:
        return [self.packed(e.ids) for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def encode_chunks(self, chunks: pa.Array) -> Ragged:
        plain = pc.match_substring_regex(chunks, PLAIN) if self.usual else pa.array(np.zeros(len(chunks), bool))
        low = pc.utf8_lower(chunks.filter(plain))
        word = pc.match_substring_regex(low, WORD)
        cut = pc.ascii_split_whitespace(pc.ascii_rtrim_whitespace(pc.replace_substring_regex(low.filter(pc.invert(word)), PIECES, r"\1 ")))
        words = low.filter(word)
        pieces = pa.concat_arrays([words, cut.flatten()]).dictionary_encode()
        made = Ragged.of(self.pieces.each(pieces.dictionary.to_pylist()), self.kind).take(pieces.indices.to_numpy())
        rest = Ragged.of(self.chunks.each(chunks.filter(pc.invert(plain)).to_pylist()), self.kind)
        last = np.concatenate((np.arange(1, len(words) + 1), len(words) + list_ends(cut), len(pieces) + np.arange(1, len(rest.ends) + 1)))
        kind = np.where(plain.to_numpy(zero_copy_only=False), 1, 2)  # words are 0, other plain chunks 1, the rest 2
        kind[kind == 1] -= word.to_numpy(zero_copy_only=False)
        place = np.empty(len(chunks), np.int64)
        place[np.argsort(kind, kind="stable")] = np.arange(len(chunks))
        return made.and_then(rest).joined(last).take(place)

    def encode(self, texts: pa.Array) -> Ragged:
        """The ids of each text."""
        cut = pc.ascii_split_whitespace(texts)
        words = cut.flatten().dictionary_encode()
        return self.encode_chunks(words.dictionary).take(words.indices.to_numpy()).joined(list_ends(cut))


_words: dict[str, _Words] = {}


def words_of(path: str) -> _Words:
    if path not in _words:
        _words[path] = _Words(path)
    return _words[path]


def encode(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): ids of each whole text by the tokenizers file at path, without special tokens, and the end id.

    ids is binary: unsigned little-endian integers of 16 bits where the vocabulary has 65,536 ids at most, else of 32.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words_of(path)
        end = np.array([end_id], own.kind)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), 8 << 20):
                raw = [np.append(x, end).tobytes() for x in own.encode(texts).arrays()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(raw, pa.binary())], names=["doc_id", "ids"])
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def _write(uri: str, content: bytes) -> None:
    """Put a file in place whole; a repeated task finds it there or replaces it with the same bytes."""
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as f:
        f.write(content)
    if fs.get_file_info(path).type == pyarrow.fs.FileType.File:
        fs.delete_file(path)
    fs.move(own, path)


def write(tokens: DataFrame, folder: str, width: int, ids_in_file: int = IDS_IN_FILE) -> DataFrame:
    """Write (doc_id, ids), null doc_ids first, to files in folder; (file, n_docs, n_ids) of each file written.

    ids holds unsigned little-endian integers of `width` bytes. tokens is read three times and so should be a stored
    table. Counts of all ids give the ranks, ties by id; there are as many counts as the vocabulary has ids, and they
    alone reach the driver. Of rows with one doc_id those of fewer ids come first, then those of the smaller crc32.
    """
    spark = tokens.sparkSession
    kind = np.dtype(f"<u{width}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(0, np.int64)
        for batch in batches:
            for i in range(0, len(batch), 512):
                some = np.bincount(values(batch.column(0).slice(i, 512), kind)[0], minlength=len(found))
                some[: len(found)] += found
                found = some
        ids = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found[ids])], names=["id", "n"])

    counts = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    ids = np.array([i for i, _ in sorted(((r["id"], r["n"]) for r in counts), key=lambda x: (-x[1], x[0]))], np.uint32)
    _write(f"{folder}/vocabulary.ids", ids.astype("<u4").tobytes())
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    total = sum(r["n"] for r in counts)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        parts: dict[str, list] = {k: [] for k in ("doc_id", "n", "control", "data")}
        for batch in batches:
            for i in range(0, len(batch), 512):
                some = batch.slice(i, 512)
                flat, n = values(some.column(1), kind)
                control, data = packed(rank[flat], n)
                for k, x in zip(parts, (some.column(0), n, control, data)):
                    parts[k].append(x)
        if parts["n"]:
            n, control, data = np.concatenate(parts["n"]), b"".join(parts["control"]), b"".join(parts["data"])
            doc_id = pa.chunked_array(parts["doc_id"])
            head = MAGIC + np.array([len(n), len(control), len(data)], "<u8").tobytes()
            head += doc_id.fill_null(0).to_numpy().astype("<i8").tobytes() + doc_id.is_null().to_numpy().astype(np.uint8).tobytes()
            _write(f"{folder}/part-{file:05d}.ids", head + n.astype("<u4").tobytes() + control + data)
            out = [[file], [len(n)], [int(n.sum())]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["file", "n_docs", "n_ids"])

    order = [F.col("doc_id"), F.octet_length("ids"), F.crc32("ids")]
    files = max(1, -(-total // ids_in_file))
    sorted_ids = tokens.select("doc_id", "ids").repartitionByRange(files, *order).sortWithinPartitions(*order)
    rows = sorted_ids.mapInArrow(store, "file long, n_docs long, n_ids long").collect()  # one row a file
    return spark.createDataFrame([tuple(r) for r in rows], "file long, n_docs long, n_ids long")


def values(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The integers in a column of binaries, in one array, and how many each holds; a null holds none."""
    column = column.fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return raw.view(kind), np.diff(at).astype(np.int64) // kind.itemsize


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files that write() tells of.

    start counts the ids of all documents before; ids_crc32 is of the ids as little-endian unsigned 32-bit integers.
    """
    content = [r["content"] for r in spark.read.format("binaryFile").load(f"{folder}/vocabulary.ids").select("content").collect()]
    ids = np.frombuffer(content[0], "<u4")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    base = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ids").load(folder)
    parts = parts.select(F.regexp_extract("path", r"part-(\d+)\.ids$", 1).cast("long").alias("of"), "content")
    if files.count() <= BROADCAST_FILES:
        base = F.broadcast(base)  # or else contents would be shuffled
    parts = parts.join(base, parts["of"] == base["file"]).select("base", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                raw = batch.column(1)[k].as_py()
                if raw[:4] != MAGIC:
                    raise ValueError("no file of token ids")
                docs, n_control, n_data = (int(x) for x in np.frombuffer(raw, "<u8", 3, 4))
                at = 28
                doc_id = np.frombuffer(raw, "<i8", docs, at)
                missing = np.frombuffer(raw, np.uint8, docs, at + 8 * docs).astype(bool)
                n = np.frombuffer(raw, "<u4", docs, at + 9 * docs).astype(np.int64)
                control = np.frombuffer(raw, np.uint8, n_control, at + 13 * docs)
                data = np.frombuffer(raw, np.uint8, n_data, at + 13 * docs + n_control)
                flat = ids[unpacked(control, data, n)]
                start = np.cumsum(n) - n
                crc = [zlib.crc32(flat[s : s + c].tobytes()) for s, c in zip(start.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_id, pa.int64(), mask=missing),
                        pa.array(start + batch.column(0)[k].as_py(), pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return parts.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def through_files(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """encode(), write() to a new folder in the shared one, and read(): one row for each row of docs.

    Null and empty texts have the end id alone. A null doc_id comes before all others. No rows give no rows.
    """
    spark = docs.sparkSession
    stored = shared_path(spark, "token-ids")
    encode(docs, path, end_id).write.option("compression", "zstd").parquet(stored)
    folder = shared_path(spark, "token-files")
    files = write(spark.read.schema("doc_id long, ids binary").parquet(stored), folder, np.dtype(_Words(path).kind).itemsize)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(spark, folder, files)
