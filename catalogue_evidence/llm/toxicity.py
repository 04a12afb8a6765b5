"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, weighted votes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.llm.common import staged
from catalogue_evidence.llm.language import held_out

EXAMPLES = 4_096  # labelled documents that serve as examples: a third of them toxic at most, the rest clean at most
NEIGHBOURS = 15
BLOCK = 128  # examples in a block of the index
SLACK = 1e-5  # that sums in single precision may be off by
MANY = 128  # examples with a term, from which on it has dense rows
PRIOR = 1.5  # weight of what a vote begins with, half of it for each side
PULL = 0.5  # of the calibration to the plain odds
PARTS = 16  # that examples are dealt out in
PREFIXES = (4, 5, 6, 7)  # letters of a word's beginnings that count as terms beside the word
LEVELS = (2, 3, 5)  # numbers of different words with one beginning that are terms of their own
WORD = re.compile(r"\w+")
#: A telling term: in so many toxic examples and such a share of them at least, so many times as frequent there as in
#: clean ones, and with such a chi-squared of one degree. Near copies count once.
LEAST, SHARE, RATIO, CHI2 = 4, 0.005, 5.0, 20.0
LEAN = 8.0  # weight of such a term beside the other words of the examples, which weigh 1
MINIMA = 4  # least hashes of words that two texts must have in common to count as near copies


def beginnings(words: Iterable[str]) -> Counter[str]:
    """Beginnings of different words, as fore*, and how many words have each; and beginnings that at least so many words
    have, as fore*2: cosines see no amounts, and one such word may be harmless."""
    fore = Counter(w[:n] + "*" for w in words for n in PREFIXES if len(w) > n)
    return fore + Counter(f"{t}{k}" for t, c in fore.items() for k in LEVELS if c >= k)


def words_of(text: str | None) -> Counter[str]:
    return Counter(WORD.findall((text or "").lower()))


def likeness(words: Counter[str]) -> int:
    """A key that most near copies share, and hardly any other texts: of the MINIMA least hashes of words together."""
    least = nsmallest(MINIMA, map(xxhash.xxh64_intdigest, words))
    return xxhash.xxh64_intdigest(repr(least)) >> 1


def ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... n[0] of them, then those from begin[1], and so on."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class BlockMax:
    """Examples as unit vectors in blocks. Terms of many examples have a dense row of weights in each block, and the
    largest of each; all others have postings."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], width: int, block: int = BLOCK, many: int = MANY) -> None:
        self.n, self.block = len(vectors), block
        self.blocks = -(-self.n // block)
        term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, int)]).astype(np.int64)
        row = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        order = np.lexsort((row, term))
        self.row = row[order].astype(np.int32)
        self.weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])[order].astype(np.float32)
        self.start = np.searchsorted(term[order], np.arange(width + 1)).astype(np.int32)
        common = np.flatnonzero(np.diff(self.start) >= many)
        self.common = np.full(width, -1, np.int32)  # number of a term's dense row, or -1
        self.common[common] = np.arange(len(common))

    @cached_property
    def dense(self) -> np.ndarray:
        """Weights by block, common term and example in the block; made where it is used, not sent there."""
        out = np.zeros((self.blocks, int(self.common.max(initial=-1)) + 1, self.block), np.float32)
        for t in np.flatnonzero(self.common >= 0):
            at = slice(self.start[t], self.start[t + 1])
            out[self.row[at] // self.block, self.common[t], self.row[at] % self.block] = self.weight[at]
        return out

    @cached_property
    def most(self) -> np.ndarray:
        return self.dense.max(2, initial=0).T.astype(np.float64)

    def search(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest examples of positive cosine, ties to the smaller row; exact.

        What rare terms add is known for every example; with each block's largest weights of common terms it bounds the
        block. Blocks are scored from the largest bound down, until the k-th best cosine lies above the next bound.
        """
        if not self.n:
            return np.zeros(0, np.int64), np.zeros(0)
        common = self.common[term]
        rare = common < 0
        n = self.start[term[rare] + 1] - self.start[term[rare]]
        posting = ranges(self.start[term[rare]], n)
        sure = np.bincount(self.row[posting], np.repeat(weight[rare], n) * self.weight[posting], self.blocks * self.block)
        sure = sure.reshape(self.blocks, self.block)
        own, weight = common[~rare], weight[~rare]
        bound = sure.max(1) + weight @ self.most[own]
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        todo = np.argsort(-bound, kind="stable")
        single = weight.astype(np.float32)
        flat = self.dense.reshape(-1, self.block)
        i, step = 0, 2
        while i < len(todo) and bound[todo[i]] > 0 and not (len(scores) == k and scores[-1] > bound[todo[i]] + SLACK):
            some = todo[i : i + step]
            least = scores[-1] - SLACK if len(scores) == k else 0
            some = some[bound[some] >= least]
            blocks = flat.take((some[:, None] * self.dense.shape[1] + own).ravel(), 0).reshape(len(some), len(own), self.block)
            got = (sure[some] + single @ blocks).ravel()
            hit = np.flatnonzero(got > max(least, 0))
            rows = np.concatenate((rows, some[hit // self.block] * self.block + hit % self.block))
            scores = np.concatenate((scores, got[hit]))
            best = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[best], scores[best]
            i, step = i + step, 4 * step
        return rows, scores


@dataclass
class Space:
    """Numbers of terms: first the telling ones, then every other word of an example."""

    telling: dict[str, int]
    numbers: dict[str, int]

    @classmethod
    def of(cls, telling: dict[str, int], words: Iterable[str]) -> Space:
        return cls(telling, telling | {w: len(telling) + k for k, w in enumerate(sorted(set(words) - telling.keys()))})

    def __len__(self) -> int:
        return len(self.numbers)

    @cached_property
    def begins(self) -> set[str]:
        return {t[: PREFIXES[0]] for t in self.telling if "*" in t}

    def counts(self, words: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """The terms that a text of such words has, and how often."""
        own = {k: c for w, c in words.items() if (k := self.numbers.get(w)) is not None}
        if self.begins and (some := [w for w in words if w[: PREFIXES[0]] in self.begins]):
            own.update((k, c) for t, c in beginnings(some).items() if (k := self.telling.get(t)) is not None)
        return np.fromiter(own.keys(), np.int64, len(own)), np.fromiter(own.values(), float, len(own))


@dataclass
class Model:
    """Examples, and how their votes become a probability; share: of toxic ones among all labels learned from."""

    space: Space
    weight: np.ndarray
    index: BlockMax
    toxic: np.ndarray
    doc_id: np.ndarray
    like: np.ndarray
    share: float
    slope: float = 1.0
    shift: float = 0.0

    def vote(self, words: dict[str, int], apart: int | None = None) -> tuple[float | None, np.ndarray]:
        """The log odds of toxic among the nearest examples, weighted by cosine, and their rows; None without any.

        apart: examples with this likeness have no vote."""
        term, n = self.space.counts(words)
        if not len(term):
            return None, np.zeros(0, np.int64)
        term, weight = unit(term, n, self.weight)
        more = 0 if apart is None else int((self.like == apart).sum())
        rows, cosine = self.index.search(term, weight, NEIGHBOURS + more)
        if more:
            rows, cosine = (x[self.like[rows] != apart][:NEIGHBOURS] for x in (rows, cosine))
        if not len(rows):
            return None, rows
        bad = float((cosine * self.toxic[rows]).sum())
        return float(np.log((bad + PRIOR / 2) / (float(cosine.sum()) - bad + PRIOR / 2))), rows

    def score(self, text: str | None) -> tuple[float, list[int]]:
        """The probability that a text is toxic, and the doc_ids of the examples that voted."""
        odds, rows = self.vote(words_of(text))
        if odds is None:
            return self.share, []
        return float(1 / (1 + np.exp(-(self.slope * odds + self.shift)))), self.doc_id[rows].tolist()


def calibrated(odds: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of the logistic curve through votes and labels, weighted so that the share of toxic ones is that
    of all labels, not of the examples. A weak pull to slope 1 and shift 0 keeps clean splits finite."""
    bad = toxic.mean() if len(toxic) else 0.0
    if not 0 < bad < 1 or not 0 < share < 1:
        return 1.0, 0.0
    weight = np.where(toxic > 0, share / bad, (1 - share) / (1 - bad))
    x = np.stack((odds, np.ones(len(odds))), 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (toxic - p)) - PULL * (at - (1.0, 0.0))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + PULL * np.eye(2), slope)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 0.0), float(at[1])


def unit(term: np.ndarray, n: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = (1 + np.log(n)) * weight[term]
    return term, w / max(np.linalg.norm(w), 1e-12)


def labelled(labels: DataFrame) -> DataFrame:
    """(known_id, toxic): labels that may be learned from. A document labelled both ways is toxic; null labels and ids
    don't count."""
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(5, 0))
    return known.groupBy(F.col("doc_id").cast("long").alias("known_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def examples(docs: DataFrame, known: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """(doc_id, toxic, words, n, like) of at most `most` of the labelled documents: a third of them toxic, two thirds
    clean, those of the least hash of doc_id. Documents of one doc_id are an example each."""
    at = F.xxhash64("known_id")
    chosen = known.filter("toxic = 1").orderBy(at, "known_id").limit(most // 3)
    chosen = chosen.unionByName(known.filter("toxic = 0").orderBy(at, "known_id").limit(most - most // 3))
    ids = F.broadcast(staged(chosen, "toxic-examples"))  # at most `most` rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter("text is not null").join(ids, F.col("doc_id") == F.col("known_id")).select("doc_id", "toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in batch.column(2).to_pylist()]
            cols = [pa.array(map(list, words), pa.list_(pa.string())), pa.array([list(w.values()) for w in words], pa.list_(pa.int64()))]
            like = pa.array(map(likeness, words), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols, like], names=["doc_id", "toxic", "words", "n", "like"])

    return texts.mapInArrow(run, "doc_id long, toxic int, words array<string>, n array<long>, like long")


def vocabulary(some: DataFrame) -> dict[str, int]:
    """The terms whose presence tells toxic examples from clean ones, of which near copies count as one.

    some: examples(). Terms of enough toxic examples are counted first, and those alone in clean ones."""
    one = staged(some.groupBy("toxic", "like").agg(F.min_by("words", F.struct("doc_id", "words")).alias("words")), "toxic-words")
    size = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad or not good:
        return {}

    def counted(toxic: int, among: set[str] | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: Counter[str] = Counter()  # of terms of the examples in one task
            for batch in batches:
                for words in batch.column(0).to_pylist():
                    own = {*words, *beginnings(words)}
                    found.update(own if among is None else own & among)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["term", "n"])

        made = one.filter(F.col("toxic") == toxic).select("words").repartition(PARTS).mapInArrow(run, "term string, n long")
        return made.groupBy("term").agg(F.sum("n").alias("n"))

    often = {r["term"]: r["n"] for r in counted(1, None).filter(F.col("n") >= max(LEAST, SHARE * bad)).collect()}
    other = {r["term"]: r["n"] for r in counted(0, set(often)).collect()}

    def tells(a: int, b: int) -> bool:
        chi2 = (bad + good) * (a * (good - b) - b * (bad - a)) ** 2 / (bad * good * (a + b) * (bad + good - a - b) + 1e-9)
        return a / bad >= RATIO * b / good and chi2 >= CHI2

    return {t: k for k, t in enumerate(sorted(t for t, a in often.items() if tells(a, other.get(t, 0))))}


def frequencies(docs: DataFrame, space: Space) -> tuple[np.ndarray, int]:
    """In how many of docs each term comes, and how many docs there are."""
    sent = docs.sparkSession.sparkContext.broadcast(space)  # as large as the examples' words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = sent.value
        found, total = np.zeros(len(space) + 1, np.int64), 0  # the last number stands for the documents
        for batch in batches:
            total += len(batch)
            for text in batch.column(0):
                found[space.counts(words_of(text.as_py()))[0]] += 1
        found[-1] = total
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at])], names=["term", "n"])

    made = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term long, n long")
    made = made.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row for each term at most
    out = np.zeros(len(space) + 1, np.int64)
    out[made["term"].to_numpy()] = made["n"].to_numpy()
    return out[:-1], int(out[-1])


def fit(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> Model:
    """The model: every example with all of its words. Document frequencies are those of all documents. Votes are
    calibrated on the examples themselves, each without its own vote and those of its near copies."""
    spark = docs.sparkSession
    known = staged(labelled(labels), "toxic-labels")
    share = known.agg(F.coalesce(F.avg("toxic"), F.lit(0.0)).alias("share")).first()["share"]
    some = staged(examples(docs, known, most), "toxic-texts")
    telling = vocabulary(some)
    got = some.toArrow()  # a row for each example, of its different words
    ids, toxic, like = got["doc_id"].to_numpy(), got["toxic"].to_numpy().astype(float), got["like"].to_numpy()
    words = [dict(zip(w, n)) for w, n in zip(got["words"].to_pylist(), got["n"].to_pylist())]
    space = Space.of(telling, (w for ws in words for w in ws))
    found, total = frequencies(docs, space)
    weight = np.log((1 + total) / (1 + found)) + 1
    weight[: len(telling)] *= LEAN
    vectors = [space.counts(w) for w in words]

    def alike(r: int) -> tuple:  # like ones share blocks: by telling terms, then by the most frequent words
        t = vectors[r][0]
        plain = t[t >= len(telling)]
        return sorted(t[t < len(telling)].tolist()), plain[np.lexsort((plain, -found[plain]))[:8]].tolist(), int(ids[r])

    rows = np.array(sorted((r for r in range(len(vectors)) if len(vectors[r][0])), key=alike), np.int64)
    index = BlockMax([unit(*vectors[r], weight) for r in rows], len(space))
    model = Model(space, weight, index, toxic[rows], ids[rows], like[rows], float(share))
    sent = spark.sparkContext.broadcast(model)

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = (batch.column(k).to_pylist() for k in (1, 2, 3))
            votes = [sent.value.vote(dict(zip(w, n)), like)[0] for w, n, like in zip(*each)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.float64())], names=["toxic", "odds"])

    votes = some.select(F.col("toxic").cast("double").alias("toxic"), "words", "n", "like").repartition(PARTS)
    votes = votes.mapInArrow(apart, "toxic double, odds double").filter("odds is not null").toArrow()  # a row an example
    order = np.lexsort((votes["odds"].to_numpy(), votes["toxic"].to_numpy()))
    odds, of = votes["odds"].to_numpy()[order], votes["toxic"].to_numpy()[order]
    model.slope, model.shift = calibrated(odds, of, model.share)
    return model


def score(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence), one row for each row of docs.

    score is the probability that a text is toxic, from the nearest labelled examples' votes, weighted by cosine and
    calibrated. Texts that share no word with any example, null and empty ones included, score the share of toxic ones
    among all labels learned from, which is 0 where there are none. evidence: doc_ids of the examples that voted,
    nearest first. Labels of rows held out (crc32 of doc_id as text divisible by 5) are never seen. Terms are all words
    of the examples, and telling beginnings of words. Only doc_id and text are read; rows repeat as in docs.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [sent.value.score(t.as_py()) for t in batch.column(1)]
            cols = [pa.array([s for s, _ in out], pa.float64()), pa.array([e for _, e in out], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "score", "evidence"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, score double, evidence array<long>").select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "evidence"
    )


def reject(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """docs without the rows that score() predicts toxic; other rows and all columns stay, rows without a text too if
    toxic ones are the lesser part of all labels. No rows give no rows."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for i in range(0, len(batch), 256):
                some = batch.slice(i, 256)
                scores = [sent.value.score(t)[0] for t in some.column(at).to_pylist()]
                yield some.filter(pa.array([x < 0.5 for x in scores]))

    return docs.mapInArrow(run, docs.schema)
