"""Benchmark decontamination: short test items inside documents of any length, by MinHash sketches and exact containment.

DataFrame functions only. A document much longer than an item shares too small a part of its own shingles with it for
banded signatures of both to meet, so the sketch is the item's alone: items are partitioned by size, and each keeps the
least hash values of its rarest shingles, as many as its partition needs so that no document that contains the item to the
threshold can miss all of them. Documents look up every shingle of theirs among the sketches alone, which gives
candidate pairs; only candidate documents are read again, and their containment of their own candidates is counted in
full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.llm.common import fresh, staged

#: An item table of more shingles than this isn't broadcast but joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: The same for the digests of documents that meet a sketch or hold an item.
BROADCAST_UNITS = 500_000
WORDS = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(w: Column, size: int = WORDS) -> Column:
    """The distinct XXH64 values of the shingles of a column of words; fewer words than size make one shingle, none none.
    Values don't depend on size: words alone are hashed.

    The words must be a column by themselves: an expression would be worked out anew for every shingle.
    """
    starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, size)])))


def item_index(items: DataFrame, threshold: float = THRESHOLD, size: int = WORDS) -> DataFrame:
    """(item_id, n_shingles, hash, in_sketch): all shingles of each item, those of its sketch marked.

    An item of k shingles that a document contains to the threshold t misses at most (1 - t) k of them there, so one of
    any floor((1 - t) k) + 1 is found. A sketch takes the least hashes among the shingles that the fewest items have, so
    passages that many items share don't make candidates. Items are partitioned by size in powers of two and a partition's sketches are as
    long as its largest possible item needs. Items without words have no shingles and match nothing; items that share
    an item_id count as one item of all their shingles.
    """
    split = items.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("words"))
    each = split.select("item_id", F.explode(shingle_hashes(F.col("words"), size)).alias("hash"))
    each = each.distinct()
    shared = each.groupBy("hash").agg(F.count(F.lit(1)).alias("n_items")).withColumnRenamed("hash", "_hash")
    each = each.join(shared, F.col("hash") == F.col("_hash"))
    hashes = F.array_sort(F.collect_list(F.struct("n_items", "hash")))
    sets = each.groupBy("item_id").agg(hashes.alias("hashes")).withColumn("n_shingles", F.size("hashes").cast("long"))
    upper = F.pow(F.lit(2), F.floor(F.log2(F.col("n_shingles"))) + 1) - 1
    least = sets.withColumn("m", F.floor(upper * F.lit(1 - threshold) + F.lit(1e-9)).cast("int") + 1)
    return least.select("item_id", "n_shingles", "m", F.posexplode("hashes").alias("pos", "of")).select(
        "item_id", "n_shingles", F.col("of.hash").alias("hash"), (F.col("pos") < F.col("m")).alias("in_sketch")
    )


def short_lengths(items: DataFrame, size: int = WORDS) -> list[int]:
    """The numbers of words, under size, that items have: their one shingle is looked up among documents' runs of as many."""
    n = F.size(words(F.col("text")))
    return sorted(r["n"] for r in items.select(n.alias("n")).filter((F.col("n") > 0) & (F.col("n") < size)).distinct().collect())  # size - 1 at most


def shingles_of(docs: DataFrame, size: int = WORDS, short: list[int] | tuple = ()) -> DataFrame:
    """(unit, doc_hash): the distinct shingle hashes of each row of (unit, text), and those of runs of as many words as
    short says."""
    w = F.col("words")
    runs = [F.when(F.size(w) >= n, shingle_hashes(w, n)).otherwise(F.array().cast("array<bigint>")) for n in short]
    hashes = F.array_distinct(F.concat(shingle_hashes(w, size), *runs)) if runs else shingle_hashes(w, size)
    return docs.select("unit", words(F.col("text")).alias("words")).select("unit", F.explode(hashes).alias("doc_hash"))


def candidates(docs: DataFrame, index: DataFrame, size: int = WORDS, short: list[int] | tuple = ()) -> DataFrame:
    """(unit, item_id): pairs of a row of (unit, text) and an item some of whose sketch the text has."""
    sketch = index.filter("in_sketch").select("item_id", "hash")
    met = shingles_of(docs, size, short).join(_small(sketch), F.col("doc_hash") == F.col("hash"))
    return met.select("unit", "item_id").distinct()


def _small(df: DataFrame, most: int | None = None) -> DataFrame:
    """df, for a broadcast if it has few rows. What is counted should be stored."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if most is None else most) else df


def _found(docs: DataFrame, items: DataFrame, threshold: float, size: int) -> DataFrame:
    """(unit, item_id, n_shingles, n_found) of each pair that passes. docs: (unit, text); rows of one unit have one text."""
    index = staged(item_index(items, threshold, size), "item-index")
    short = short_lengths(items, size)
    pairs = staged(candidates(docs, index, size, short), "item-candidates")
    asked = _small(pairs.select(F.col("unit").alias("_unit")).distinct(), BROADCAST_UNITS)
    once = docs.join(asked, docs["unit"] == asked["_unit"], "left_semi").groupBy("unit").agg(F.min("text").alias("text"))
    own = pairs.join(_small(index.select("item_id", "n_shingles", "hash")), "item_id")  # all shingles of each candidate item
    met = own.join(shingles_of(once, size, short).withColumnRenamed("unit", "_unit"), (F.col("unit") == F.col("_unit")) & (F.col("hash") == F.col("doc_hash")))
    counted = met.groupBy("unit", "item_id", "n_shingles").agg(F.count(F.lit(1)).alias("n_found"))
    return staged(counted.filter(F.col("n_found") >= F.lit(threshold) * F.col("n_shingles") - F.lit(1e-9)), "items-found")


def _unit(text: Column) -> Column:
    return F.md5(text.cast("string").cast("binary"))


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = WORDS) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment): documents that contain an item to the threshold.

    containment is the share of the item's distinct shingles that the document has; an item of fewer words than a
    shingle is one shingle of its own length and found wherever its words stand side by side. Null and empty texts contain
    nothing. Of rows with one doc_id each counts for itself and the best stands, rows without a doc_id
    together too. Only doc_id and text, item_id and text are read. No rows on either side give no rows.
    """
    texts = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("unit", _unit(F.col("text")))
    found = _found(texts, items, threshold, size).withColumnRenamed("unit", "_unit")
    same = texts.select("doc_id", "unit").join(_small(found, BROADCAST_UNITS), F.col("unit") == F.col("_unit"))
    best = same.groupBy("doc_id", "item_id", "n_shingles").agg(F.max("n_found").alias("n_found"))
    return best.withColumn("containment", F.col("n_found").cast("double") / F.col("n_shingles"))


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = WORDS) -> DataFrame:
    """docs without the rows whose text contains an item to the threshold; all other rows and columns, whatever their
    names, stay, rows without a text too. No items or no rows leave docs as they are."""
    texts = docs.filter(docs["text"].isNotNull()).select(docs["text"].cast("string").alias("text"))
    found = _found(texts.withColumn("unit", _unit(F.col("text"))), items, threshold, size)
    name = fresh("_found", docs)
    gone = _small(found.select(F.col("unit").alias(name)).distinct(), BROADCAST_UNITS)
    return docs.join(gone, _unit(docs["text"]) == gone[name], "left_anti")
