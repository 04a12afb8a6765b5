"""Approximate nearest neighbours: an inverted file of coarse centroids with product-quantised residuals.

The index is fitted on a bounded sample and holds every vector. Asymmetric distance tables rule out what can't be among
the k nearest of a cell of a probed list; exact distances on the original vectors rank all of the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogue_evidence.llm.common import staged

SAMPLE = 16_384  # vectors that the centroids and codebooks are fitted on
PART = 2  # dimensions of a quantised part
CELL = 4_096  # vectors of a list that one call looks through
ASKERS = 4_096  # queries that one call answers; each block of them costs a copy of the list's vectors
TARGET = 0.975  # share of the sample's own nearest neighbours that lie in the lists probed


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int = 7) -> np.ndarray:
    """k centroids of Lloyd's rounds, from distinct rows; fewer where x has fewer distinct rows."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:k]].astype(np.float64)
    for _ in range(rounds):
        nearest = closest(x, centres)
        size = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)


def closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])


@dataclass
class Index:
    """Coarse centroids, and for each part of PART dimensions the codebook of residuals."""

    centres: np.ndarray
    books: list[np.ndarray]

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int) -> Index:
        centres = kmeans(sample, lists, 12)
        rest = sample - centres[closest(sample, centres)]
        return cls(centres, [kmeans(rest[:, i : i + PART], 256, 8) for i in range(0, sample.shape[1], PART)])

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = closest(x, self.centres)
        rest = x - self.centres[own]
        codes = [closest(rest[:, i * PART : (i + 1) * PART], b) for i, b in enumerate(self.books)]
        return own, np.stack(codes, 1).astype(np.uint8)

    def probes(self, sample: np.ndarray, k: int, target: float = TARGET, queries: int = 256) -> int:
        """So many lists must be probed that the share `target` of the sample's nearest neighbours in itself lie there.

        Each query's lists are taken by distance of their centroids; of a larger set the nearest lie closer still.
        """
        own = closest(sample, self.centres)
        depth = []
        for q in sample[:queries]:
            d = ((sample - q) ** 2).sum(1)
            near = own[np.argpartition(d, min(k, len(d) - 1))[: k + 1]]
            place = np.empty(len(self.centres), int)
            place[np.argsort(distances(q[None], self.centres)[0], kind="stable")] = np.arange(len(self.centres))
            depth.append(place[near])
        return int(np.quantile(np.concatenate(depth), target, method="higher")) + 1

    def errors(self, x: np.ndarray, of: int, codes: np.ndarray) -> np.ndarray:
        """Distances of vectors of list `of` from what their codes stand for."""
        coded = self.stacked[np.arange(len(self.books)), codes].reshape(len(x), -1)[:, : x.shape[1]]
        return np.sqrt(((x - self.centres[of] - coded) ** 2).sum(1))

    def near(self, query: np.ndarray, of: int, codes: np.ndarray) -> np.ndarray:
        """Approximate squared distances to the codes of list `of`: sums over a table from the query's residual to all
        codewords of each part."""
        parts = len(self.books)
        rest = np.zeros(parts * PART)
        rest[: len(query)] = query - self.centres[of]
        table = ((self.stacked - rest.reshape(parts, 1, PART)) ** 2).sum(2)
        return table[np.arange(parts), codes].sum(1)

    @cached_property
    def stacked(self) -> np.ndarray:
        """All codebooks as one array, short ones filled up with what no code names."""
        out = np.zeros((len(self.books), max(map(len, self.books)), PART))
        for i, b in enumerate(self.books):
            out[i, : len(b), : b.shape[1]] = b
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors of doubles without those that are null, zero, or hold a null or non-finite component, and
    without those whose length isn't the most frequent one (of ties the smallest); a row without vec_id has no part."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
    sizes = out.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return out.filter(F.size("v") == sizes[0]["n"]) if sizes else out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def search(vectors: DataFrame, asked: Column, k: int = 10, lists: int | None = None, probes: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows found for each row of vectors where asked holds.

    score is the Euclidean distance in double precision, ties go to the smaller vec_id, rank counts from 1. Rows that
    usable() leaves out neither ask nor answer; no rows give no rows. Rows with one vec_id stay rows of their own: each asks
    and answers, and only a row itself is none of its own answers. So many lists are probed as the sample itself needs.
    The index is fitted on at most `sample` vectors, those of the least hash of vec_id, and holds every vector. A list
    is dealt out in cells of at most about CELL vectors and ASKERS queries, so that no hot list is one task's work. Each
    cell gives its exact k nearest, so answers are the exact ones of the probed lists. All other rows are answers where
    there are fewer than k. Recall is measured in the tests.
    """
    data = staged(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    some = data.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(sample).select("v").collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not some:
        return data.sparkSession.createDataFrame([], empty)
    n = data.count()
    lists = lists or int(min(4096, max(1, round(n**0.5))))
    fitted = np.array([r["v"] for r in some])
    index = Index.fit(fitted, lists)
    lists = len(index.centres)
    probes = min(lists, probes or max(8, index.probes(fitted, k)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, codes = index.encode(_matrix(batch.column(1)))
            cols = [*batch.columns, pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "v", "row", "list", "code"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            near = np.argsort(distances(x, index.centres), 1, kind="stable")[:, :probes]
            take = pa.array(np.repeat(np.arange(len(x)), near.shape[1]))
            cols = [*(c.take(take) for c in batch.columns), pa.array(near.ravel(), pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=["query_id", "q", "asker", "list"])

    coded = staged(data.mapInArrow(encode, "vec_id long, v array<double>, row long, list int, code binary"), "codes")
    asking = data.filter(F.coalesce(asked, F.lit(False)))
    probed = staged(asking.mapInArrow(probe, "query_id long, q array<double>, asker long, list int"), "probes")
    cells = coded.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells"))
    blocks = probed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / ASKERS).cast("int").alias("blocks"))
    shape = F.broadcast(cells.join(blocks, "list"))  # a row for each list at most
    split = lambda of, parts: F.pmod(F.xxhash64(of), F.col(parts)).cast("int")
    spread = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = coded.join(shape, "list").select("list", "vec_id", "v", "row", "code", split("row", "cells").alias("cell"), spread("blocks").alias("block"))
    right = probed.join(shape, "list").select("list", "query_id", "q", "asker", split("asker", "blocks").alias("block"), spread("cells").alias("cell"))

    def answer(stored: pa.Table, queries: pa.Table) -> pa.Table:
        """The k nearest of a cell for each query: by the triangle inequality a true distance lies within the code's error
        of the approximate one, so none whose lower bound is above the k-th upper bound can be among them."""
        out = [(*[np.zeros(0, np.int64)] * 3, np.zeros(0))]
        if len(stored) and len(queries):
            stored, queries = stored.combine_chunks(), queries.combine_chunks()
            ids, rows = stored["vec_id"].to_numpy(), stored["row"].to_numpy()
            x = _matrix(stored["v"].combine_chunks())
            codes = np.frombuffer(b"".join(stored["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
            of = queries["list"][0].as_py()
            error = index.errors(x, of, codes) + 1e-9 * (1 + np.abs(x).max())  # and what sums of doubles may be off by
            asked_by = zip(queries["asker"].to_pylist(), queries["query_id"].to_pylist(), _matrix(queries["q"].combine_chunks()))
            for asker, query, q in asked_by:
                near = np.sqrt(index.near(q, of, codes))
                near[rows == asker] = np.inf
                most = np.partition(near + error, k - 1)[k - 1] if len(near) > k else np.inf
                some = np.flatnonzero((near - error <= most) & (rows != asker))
                score = np.sqrt(np.cumsum((x[some] - q) ** 2, 1)[:, -1])
                best = np.lexsort((ids[some], score))[:k]
                out.append((np.full(len(best), asker), np.full(len(best), query), ids[some][best], score[best]))
        return pa.table(dict(zip(("asker", "query_id", "vec_id", "score"), map(np.concatenate, zip(*out)), strict=True)))

    keys = ["list", "cell", "block"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(answer, "asker long, query_id long, vec_id long, score double")
    order = Window.partitionBy("asker").orderBy("score", "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
