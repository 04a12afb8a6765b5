"""SimHash near-duplicate groups by multi-index hashing.

Fingerprints are made in Arrow batches; links between fingerprints are found and closed by joins of Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.llm.common import components, fresh, staged

PIECE = 1 << 16  # shingles hashed at a time
LOW = 0xFFFFFFFF
BUCKET = 1_000  # distinct fingerprints with one half, beyond which it is split


def shingle_hashes(text: bytes, size: int = 3, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of lower-cased words, repeats included, in pieces of bounded length."""
    joined = b" ".join(text.lower().split())  # of bytes: only A-Z and the ASCII white space count
    if not joined:
        return
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    n = max(1, len(gaps) + 2 - size)
    starts = np.concatenate(([0], gaps + 1))[:n]
    ends = np.concatenate((gaps, [len(joined)]))[-n:]
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, PIECE):
        pairs = zip(starts[i : i + PIECE].tolist(), ends[i : i + PIECE].tolist())
        yield np.array([digest(joined[s:e], seed) for s, e in pairs], np.uint64)


def fingerprints(texts: list[bytes | None], size: int = 3, seed: int = 42) -> np.ndarray:
    """A 64-bit SimHash for each text: a bit is 1 if set in over half the shingle hashes. No words: 0."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[np.ndarray] = []
    whose: list[int] = []

    def count() -> None:
        if held:
            bits = np.unpackbits(np.concatenate(held).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            begin = np.cumsum([0, *map(len, held)])[:-1]
            np.add.at(ones, whose, np.add.reduceat(bits, begin, axis=0, dtype=np.int64))
            held.clear(), whose.clear()

    waiting = 0
    for k, text in enumerate(texts):
        for hashes in shingle_hashes(text or b"", size, seed):
            held.append(hashes), whose.append(k)
            total[k] += len(hashes)
            waiting += len(hashes)
            if waiting >= PIECE:
                count()
                waiting = 0
    count()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def with_fingerprints(docs: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp, text_hash): fp is the fingerprint as a signed long. A null text counts as one without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fp = fingerprints(texts, size, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64()), batch.column(2)], names=["doc_id", "fp", "text_hash"])

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")))
    return plain.mapInArrow(run, "doc_id long, fp long, text_hash long")


def _segments(fp: Column) -> list[Column]:
    """Both halves of a fingerprint as keys of 33 bits: which half, and its value."""
    return [F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(LOW)) + F.lit(LOW + 1)]


def _ball(key: Column) -> Column:
    """The key, and if it holds an even number of ones also its 32 neighbours at one bit.

    Of two halves that differ in one bit exactly one is even, so flips from even halves alone meet every such pair once.
    """
    flips = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: key.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    return F.concat(F.array(key), F.when(F.bit_count(key.bitwiseAND(F.lit(LOW))) % 2 == 0, flips).otherwise(F.array().cast("array<bigint>")))


def _quarters(fp: Column, key: Column) -> list[Column]:
    """Both halves of the half that key isn't, as keys of 17 bits: which one, and its value."""
    other = F.when(key > LOW, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(F.lit(LOW)))
    return [F.shiftrightunsigned(other, 16), other.bitwiseAND(F.lit(0xFFFF)) + F.lit(0x10000)]


def _around(quarter: Column) -> Column:
    return F.transform(F.array(*[F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(16)]]), lambda flip: quarter.bitwiseXOR(flip))


def links(fps: DataFrame, most: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b): distinct fingerprints, a < b, that differ in at most `most` (0 to 3) bits; found by multi-index hashing.

    Two fingerprints that differ in 3 bits or fewer differ in at most one bit in one of their 32-bit halves. Each half
    is a hash table; a fingerprint looks up the ball of radius one round each of its halves, and whole distances of
    what it meets are then checked. A half of more than `bucket` fingerprints is split once more, by the quarters of
    the other half, in the same way.
    """
    if not 0 <= most <= 3:
        raise ValueError("two halves with balls of one bit serve distances up to 3")
    fp = F.col("fp")
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)
    pair = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    stored = fps.select(fp.alias("b"), F.explode(F.array(*_segments(fp))).alias("key"))
    asked = fps.select(fp.alias("a"), F.explode(F.concat(*[_ball(k) for k in _segments(fp)])).alias("key"))
    large = staged(stored.groupBy(F.col("key").alias("of")).count().filter(F.col("count") > bucket).select("of"), "simhash-large")
    if large.isEmpty():
        met = asked.join(stored, (asked["key"] == stored["key"]) & near)
        return met.select(*pair).distinct()
    small = lambda df: df.join(large, df["key"] == large["of"], "left_anti")
    in_large = lambda df: df.join(large, df["key"] == large["of"], "left_semi")
    some, many = small(stored), in_large(stored)
    met = asked.join(some, (asked["key"] == some["key"]) & near).select(*pair)
    # Of a bucket's members the other halves, too, lie within three bits, so one of their own halves lies within one.
    many = many.select("b", "key", F.explode(F.array(*_quarters(F.col("b"), F.col("key")))).alias("quarter"))
    wanted = in_large(asked).select("a", "key", F.explode(F.concat(*[_around(q) for q in _quarters(F.col("a"), F.col("key"))])).alias("quarter"))
    dense = wanted.join(many, (wanted["key"] == many["key"]) & (wanted["quarter"] == many["quarter"]) & near).select(*pair)
    return met.unionByName(dense).distinct()


def groups(docs: DataFrame, most: int = 3, size: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash), one row for each row of docs.

    fingerprint: 16 lower-case hex digits. component_id: the smallest doc_id that links of at most `most` bits reach,
    itself included. A null text has no words and so fingerprint zero, linked like any other. A null doc_id is kept and
    gets the smallest doc_id of its group, null if there is none. Equal rows stay as often as they come. Only doc_id
    and text are read; other columns don't matter. No rows give no rows.
    """
    made = staged(with_fingerprints(docs, size, seed), "simhash")
    fps = staged(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    found = components(links(fps, most), "simhash-links")
    linked = fps.join(found, fps["fp"] == found["node"]).select("fp", "label", "least")
    least = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    linked = linked.select("fp", "label").join(least, "label").select(F.col("fp").alias("linked_fp"), "component_id")
    owner = staged(
        fps.join(linked, fps["fp"] == linked["linked_fp"], "left").select(
            F.col("fp").alias("key"), F.coalesce("component_id", "least").alias("component_id")
        ),
        "simhash-owner",
    )
    return made.join(owner, made["fp"] == owner["key"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash"
    )


def keep_one(docs: DataFrame, most: int = 3, size: int = 3, seed: int = 42) -> DataFrame:
    """docs with one row left of each group: that of the smallest doc_id, of equal doc_ids one text's
    (the least hash's), of equal texts one row.

    Rows without a doc_id can't be told apart by it and all stay. All columns stay, whatever their names. No rows give
    no rows.
    """
    cols = docs.columns
    kept, of, row = (fresh(n, docs) for n in ("_kept", "_of", "_row"))
    place = groups(docs, most, size, seed).filter(F.col("doc_id") == F.col("component_id"))
    chosen = place.groupBy(F.col("doc_id").alias(kept), "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    chosen = staged(chosen.groupBy(kept).agg(F.min(F.struct("text_hash", "copies")).alias(of)), "simhash-kept")
    same = (docs["doc_id"].cast("long") == chosen[kept]) & (F.xxhash64(docs["text"].cast("string")) == chosen[of]["text_hash"])
    mine = docs.join(chosen, same)
    once = mine.filter(F.col(of)["copies"] == 1).select(*[docs[c] for c in cols])
    # Columns may have no order, so rows get numbers, in a table, as numbers change with the order of partitions.
    again = mine.filter(F.col(of)["copies"] > 1).select(F.col(kept), F.monotonically_increasing_id().alias(of), F.struct(*[docs[c] for c in cols]).alias(row))
    again = staged(again, "simhash-copies").groupBy(kept).agg(F.min_by(row, of).alias(row)).select(f"{row}.*")
    return once.unionByName(again).unionByName(docs.filter(docs["doc_id"].isNull()))
