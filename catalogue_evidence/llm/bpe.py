"""Byte-level BPE by recursive DuckDB queries inside Spark's tasks.

Spark deals out the documents; in each task, the words that a portion of texts brings anew become token rows that join
the merge table until no pair of a word can merge, and an ordered aggregation over token rows decodes.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import string
import tempfile
from collections.abc import Iterator
from itertools import chain, compress

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.llm.chunks import Ragged, Recent, list_ends, slices

#: A round merges each word's leftmost pair of lowest rank, which is in one number with its place; a word without such a
#: pair has no next row.
ENCODE = """
WITH RECURSIVE step(word, tokens) AS (
  SELECT word, tokens FROM words
  UNION ALL
  SELECT s.word, list_concat(list_append(s.tokens[:(best.pair & 255) - 1], (best.pair >> 8)::INTEGER), s.tokens[(best.pair & 255) + 2:])
  FROM step s
  JOIN (
    SELECT p.word, min(m.merged::BIGINT << 8 | p.pos) AS pair
    FROM (
      SELECT word, unnest(tokens[:-2]) AS lhs, unnest(tokens[2:]) AS rhs, generate_subscripts(tokens[2:], 1) AS pos FROM step
    ) p
    JOIN merges m ON m.lhs = p.lhs AND m.rhs = p.rhs
    GROUP BY p.word
  ) best ON best.word = s.word
)
SELECT word, arg_min(tokens, len(tokens)) AS tokens FROM step GROUP BY word ORDER BY word
"""
#: The same for long words, one row a token: a round merges all of a word's pairs of lowest rank, but of overlapping ones
#: every other, and of a word where a merge would bring a pair of lower rank the leftmost alone. Rows carry their place;
#: a merged pair's second place becomes null, and the state holds a row for each place, whatever the number of rounds.
ENCODE_LONG = """
WITH RECURSIVE state(word, pos, token) USING KEY (word, pos) AS (
  SELECT word, pos, token FROM letters
  UNION
  SELECT word, unnest([pos, next_pos]), unnest([merged, NULL]) FROM (
    SELECT *, count(lower) OVER (PARTITION BY word) = 0 OR pos = min(pos) OVER (PARTITION BY word) AS allowed FROM (
      SELECT c.*, (SELECT min(m.merged) FROM merges m WHERE m.merged < c.merged AND (
        m.lhs = c.merged AND m.rhs IN (c.after, c.lhs, c.merged) OR m.rhs = c.merged AND m.lhs IN (c.before, c.rhs, c.merged))) AS lower
      FROM (
        SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY pos) AS place FROM (
          SELECT *, sum(fresh) OVER (PARTITION BY word ORDER BY pos) AS run FROM (
            SELECT *, CASE WHEN lag(next_pos) OVER (PARTITION BY word ORDER BY pos) = pos THEN 0 ELSE 1 END AS fresh FROM (
              SELECT s.*, m.merged, min(m.merged) OVER (PARTITION BY s.word) AS best FROM (
                SELECT word, pos, token AS lhs, lead(token) OVER w AS rhs, lead(pos) OVER w AS next_pos, lag(token) OVER w AS before, lead(token, 2) OVER w AS after
                FROM recurring.state WHERE token IS NOT NULL WINDOW w AS (PARTITION BY word ORDER BY pos)
              ) s JOIN merges m ON m.lhs = s.lhs AND m.rhs = s.rhs
            ) WHERE merged = best
          )
        )
      ) c WHERE place % 2 = 1
    )
  ) WHERE allowed
)
SELECT word, list(token ORDER BY pos) AS tokens FROM state WHERE token IS NOT NULL GROUP BY word ORDER BY word
"""
#: The order of rows is that of the subquery: one thread runs it, and decode() holds the bytes against the vocabulary. An
#: order inside of the aggregate takes three times as long. Bytes are letters of Latin-1, as only texts can be joined.
DECODE = """
SELECT doc, string_agg(letters, '') AS text FROM (
  SELECT t.doc, v.letters FROM tokens t JOIN vocabulary v ON v.id = t.id ORDER BY t.pos
) GROUP BY doc
"""
WORDS = 20_000  # in one query
LONG = 64  # bytes, 256 at most, from which on a word is cut where no token can lie, and what is still longer is encoded by ENCODE_LONG
PORTION = 2 << 20  # bytes of texts whose different chunks are encoded at once
MARKS = "".join(c for c in string.punctuation if c != "'")  # neither letter, digit nor blank, and no beginning of 's and its like


def awkward(chunk: str) -> bool:
    """Whether a chunk has white space where the pattern may not cut a text as blanks do."""
    return chunk[-1:].isspace() or chunk[:1] == " " and chunk[1:2].isspace()


def wordlike(chunk: str) -> bool:
    """Whether a chunk is one piece of letters, with or without a blank before them."""
    return (chunk[1:] if chunk[:1] == " " else chunk).isalpha()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def places(last: np.ndarray) -> np.ndarray:
    """Where each item is once those marked as last stand behind all others, both in their order."""
    out = np.empty(len(last), np.int64)
    out[np.argsort(last, kind="stable")] = np.arange(len(last))
    return out


class Codec:
    """A vocabulary of ranks, with its merges as a DuckDB table: any two tokens whose bytes joined are a token merge."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = ranks = read_ranks(path)
        # White space as the Unicode property; this library's \s holds four more control characters.
        self.pieces = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.decimal = pa.array([b"%d " % i for i in range(max(ranks.values()) + 1)], pa.large_binary())
        merges = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.inside = np.zeros(1 << 16, bool)  # pairs of bytes that some token holds
        for t in ranks:
            self.inside[[a << 8 | b for a, b in zip(t, t[1:])]] = True
        # What doesn't fit in memory goes to the task's own temporary folder.
        config = {"threads": 1, "memory_limit": "256MB", "temp_directory": tempfile.mkdtemp(prefix="duckdb-")}
        self.db = duckdb.connect(":memory:", config=config)
        self._table("merges", dict(zip(("lhs", "rhs", "merged"), (pa.array(c, pa.int32()) for c in zip(*merges)), strict=True)))
        self._table("vocabulary", {"id": pa.array(ranks.values(), pa.int32()), "letters": pa.array([t.decode("latin-1") for t in ranks])})
        known = {i: t for t, i in ranks.items()}
        self.bytes = pa.array(map(known.get, range(max(known) + 1)), pa.large_binary())
        self.words = Recent(self.encode_words, 150_000)
        self.chunks = Recent(self.encode_chunks, 50_000)  # those of more pieces than one

    def _table(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _asked(self, query: str, name: str, columns: dict[str, pa.Array]) -> pa.Table:
        self.db.register(name, pa.table(columns))
        out = self.db.sql(query).to_arrow_table()
        self.db.unregister(name)
        return out

    def pieces_of(self, raw: bytes) -> list[bytes]:
        """A long word cut between bytes that no token holds side by side, so that no merge can reach across."""
        b = np.frombuffer(raw, np.uint8)
        cuts = (np.flatnonzero(~self.inside[b[:-1].astype(np.uint16) << 8 | b[1:]]) + 1).tolist()
        return [raw[i:j] for i, j in zip([0, *cuts], [*cuts, len(raw)])]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Token ids as 32-bit integers of each word; a word that is a token as a whole is that token."""
        raw = [w.encode() for w in words]
        parts = {b: self.pieces_of(b) for b in raw if len(b) >= LONG and b not in self.ranks}
        known: dict[bytes, bytes] = {}
        rest: list[bytes] = []
        for b in {*raw, *chain.from_iterable(parts.values())} - {b for b, bs in parts.items() if len(bs) > 1}:
            if (r := self.ranks.get(b)) is not None:
                known[b] = np.int32(r).tobytes()
            else:
                rest.append(b)
        rest.sort(key=len)
        n = bisect.bisect_left(rest, LONG, key=len)
        for i in range(0, n, WORDS):
            some = rest[i : min(i + WORDS, n)]
            ends = np.cumsum([0, *map(len, some)], dtype=np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(self.byte[np.frombuffer(b"".join(some), np.uint8)]))
            known.update(zip(some, self._tokens(ENCODE, "words", {"word": pa.array(range(len(some)), pa.int32()), "tokens": tokens})))
        for b in rest[n:]:  # one by one: each may be as long as a text
            letters = {"word": pa.array(np.zeros(len(b), np.int32)), "pos": pa.array(range(len(b)), pa.int32()), "token": pa.array(self.byte[np.frombuffer(b, np.uint8)])}
            known[b] = self._tokens(ENCODE_LONG, "letters", letters)[0]
        return [b"".join([known[p] for p in parts[b]]) if b in parts else known[b] for b in raw]

    def _tokens(self, query: str, name: str, columns: dict[str, pa.Array]) -> list[bytes]:
        got = self._asked(query, name, columns).column("tokens").combine_chunks()
        raw, at = got.flatten().to_numpy().astype(np.int32).tobytes(), 4 * list_ends(got)
        return [raw[i:j] for i, j in zip([0, *at.tolist()], at.tolist())]

    def cut(self, chunk: str) -> list[str]:
        """The pieces of a chunk. Of letters, marks behind them and single line ends between such they are known without
        the pattern, which joins a line end without other white space beside it with nothing."""
        lines = chunk.split("\n")
        if len(lines) > 1 and not all(line and not line[-1].isspace() and (line[0] == " " and not i or not line[0].isspace()) for i, line in enumerate(lines)):
            return self.pieces.findall(chunk)
        out: list[str] = []
        for i, line in enumerate(lines):
            if i:
                out.append("\n")
            word = line.rstrip(MARKS)
            if wordlike(word):
                out.append(word)
                if len(word) < len(line):
                    out.append(line[len(word) :])
            else:
                out += self.pieces.findall(line)
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Chunks begin and end where pieces of the pattern do, so that each can be encoded for itself."""
        pieces = [self.cut(c) for c in chunks]
        words = list({w for ws in pieces for w in ws})
        known = dict(zip(words, self.words.each(words), strict=True))
        return [b"".join([known[w] for w in ws]) for ws in pieces]

    def encode_all(self, texts: pa.Array) -> Ragged:
        """Ids of each text, cut before its blanks; a text with more white space beside a blank is cut into pieces."""
        cut = pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")
        different = cut.flatten().dictionary_encode()
        odd = np.fromiter(map(awkward, chunks := different.dictionary.to_pylist()), bool, len(chunks))
        again = pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False).copy()
        again[np.repeat(np.arange(len(texts)), np.diff(list_ends(cut), prepend=0))[odd[different.indices.to_numpy()]]] = True
        if again.any():
            pieces = [self.pieces.findall(t) for t in texts.filter(pa.array(again)).to_pylist()]
            cut = pa.concat_arrays([cut.filter(pa.array(~again)), pa.array(pieces, cut.type)])
            different = cut.flatten().dictionary_encode()
            chunks = different.dictionary.to_pylist()
        word = np.fromiter(map(wordlike, chunks), bool, len(chunks))
        made = self.words.each(list(compress(chunks, word))) + self.chunks.each(list(compress(chunks, ~word)))
        ids = Ragged.of(made, np.int32).take(places(~word)[different.indices.to_numpy()]).joined(list_ends(cut))
        return ids.take(places(again)) if again.any() else ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_all(pa.array(texts, pa.string())).arrays()

    def decimals(self, ids: Ragged) -> list[bytes]:
        """The decimal ids of each text, joined by one blank."""
        made = self.decimal.take(pa.array(ids.flat))
        raw, at = memoryview(made.buffers()[2]), np.frombuffer(made.buffers()[1], np.int64)
        ends = at[ids.ends].tolist()
        return [raw[i : max(i, j - 1)] for i, j in zip([0, *ends], ends)]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        size = np.array([len(x) for x in ids], np.int64)
        if not size.sum():
            return [b""] * len(ids)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), size)
        pos = np.arange(len(doc))
        flat = np.concatenate(ids)
        made = self._asked(DECODE, "tokens", {"doc": pa.array(doc), "pos": pa.array(pos), "id": pa.array(flat)})
        out = [b""] * len(ids)
        for k, text in zip(made.column("doc").to_pylist(), made.column("text").to_pylist()):
            out[k] = text.encode("latin-1")
        if b"".join(out) != self.bytes.take(pa.array(flat[(flat >= 0) & (flat < len(self.bytes))])).buffers()[2]:  # unknown ids have no bytes
            raise RuntimeError("decoded tokens are out of order")
        return out


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each Python worker, which serves task after task."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of each whole text, none for a null or empty one. One row for each row of docs.

    path: a file of ranks that all executors see. Special tokens don't exist: their strings are ordinary text. Only
    doc_id and text are read, equal rows stay as often as they come, a null doc_id stays null, no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), PORTION):
                made = own.encode_all(texts)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, made.ends), pa.int32()), pa.array(made.flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], names=["doc_id", "ids"])
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes): what the ids of (doc_id, ids) stand for; of null ids, nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for i in range(0, len(batch), 256):
                some = batch.slice(i, 256)
                raw = own.decode([np.array(x or [], np.int32) for x in some.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    return tokens.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode() and decode() in one pass, with digests of both.

    ids_sha256 is of the decimal ids joined by one blank, decoded_sha256 of the decoded bytes, both in lower-case hex.
    A null or empty text has no tokens and the digest of nothing. Rows are those of docs, as in encode().
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), PORTION):
                ids = own.encode_all(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array(np.diff(ids.ends, prepend=0)),
                        pa.array([hashlib.sha256(x).hexdigest() for x in own.decimals(ids)]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in own.decode(ids.arrays())]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                at += len(texts)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
