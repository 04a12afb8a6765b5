"""Joins on keys of which some hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.sources.shared import staged

TRACKED = 10_000  # keys that the sketch of frequent ones follows; a key of more than a few 10,000ths of the rows is found


def frequent_keys(df: DataFrame, key: str, shares: int) -> dict:
    """About how many rows the keys have that hold more than one of so many shares of df's rows; null counts as no key.

    The counts come from a sketch of bounded size, so at most `shares` keys reach the driver; they may be too high by a
    share of the rows that is small beside the one asked for.
    """
    if not 0 < shares <= TRACKED:
        raise ValueError(f"1 to {TRACKED} shares can be told apart")
    sketch = F.expr(f"approx_top_k(_key, {shares}, {TRACKED})").alias("top")
    got = df.select(F.col(key).alias("_key")).filter("_key is not null").agg(sketch, F.count(F.lit(1)).alias("n")).first()
    return {r["item"]: r["count"] for r in got["top"] or [] if r["count"] * shares > got["n"]}


def skew_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, shares: int | None = None) -> DataFrame:
    """left and right joined where their keys are equal, with no task that gets all rows of a key that is frequent in left.

    Rows of such a key are dealt out by a hash of the whole row to so many parts that each is about one of `shares`
    (four for each shuffle partition) of left's rows, and its rows of right are repeated for each part: in all at most
    twice as many repetitions as shares, whatever left's size. Other keys join as they are. All columns of both stay; a
    null key joins nothing.
    """
    spark = left.sparkSession
    shares = shares or min(TRACKED, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    left = staged(left, "skewed")  # read for the sketch and for the join
    heavy = frequent_keys(left, left_key, shares)
    if not heavy:
        return left.join(right, left[left_key] == right[right_key])
    n = max(1, sum(heavy.values()), left.count())
    kind = left.schema[left_key].dataType.simpleString()
    parts = spark.createDataFrame([(k, max(1, -(-c * shares // n))) for k, c in heavy.items()], f"_hot {kind}, _parts long")
    parts = F.broadcast(parts)  # a row for each frequent key: at most as many as shares
    one = F.lit(1).cast("long")
    salted = left.join(parts, left[left_key] == F.col("_hot"), "left")
    salted = salted.select(*[left[c] for c in left.columns], F.pmod(F.xxhash64(*[left[c] for c in left.columns]), F.coalesce("_parts", one)).alias("_salt"))
    spread = right.join(parts, right[right_key] == F.col("_hot"), "left")
    spread = spread.select(*[right[c] for c in right.columns], F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", one) - 1)).alias("_part"))
    met = salted.join(spread, (salted[left_key] == spread[right_key]) & (salted["_salt"] == spread["_part"]))
    return met.select(*[salted[c] for c in left.columns], *[spread[c] for c in right.columns])
