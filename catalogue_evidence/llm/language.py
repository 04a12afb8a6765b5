"""Language identification in two steps: the family first, then one-versus-one linear SVMs inside the family."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS = 1 << 14  # of hashed byte trigrams
SAMPLE = 2_048  # documents that the classifiers learn from, the same number of each language at most
FEWEST = 8  # documents of each language, however many languages there are
NONE = "und"
# Language families by ISO 639-1 code. Any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "ur"),
}
FAMILY = {lang: name for name, langs in FAMILIES.items() for lang in langs}


def counts(text: str) -> np.ndarray:
    """How often each hashed trigram of bytes of the lower-cased text occurs."""
    b = np.frombuffer((" " + text.lower() + " ").encode(), np.uint8).astype(np.uint32)
    code = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(18), minlength=DIMENSIONS)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Square roots of counts at unit length, so that long and short texts weigh the same."""
    x = np.sqrt(rows, dtype=np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def svm(x: np.ndarray, y: np.ndarray, rounds: int = 30, cost: float = 4.0, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM for y of 1 and -1, by dual coordinate descent on the hinge loss."""
    rng = np.random.default_rng(seed)
    w, bias, alpha = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(len(x))
    square = (x * x).sum(1) + 1.0
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(x)):
            gradient = y[i] * (float(x[i] @ w) + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w += np.float32(step) * x[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


@dataclass
class Model:
    """One-versus-one SVMs between families, and between the languages of each family."""

    groups: dict[str, list[str]]
    pairs: list[tuple[str, str]] = field(default_factory=list)  # of families or of languages, the first one positive
    weights: np.ndarray = field(default_factory=lambda: np.zeros((DIMENSIONS, 0), np.float32))
    biases: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> Model:
        family = np.array([FAMILY.get(lang, lang) for lang in langs])
        own = np.array(langs)
        groups = {f: sorted(set(own[family == f].tolist())) for f in sorted(set(family.tolist()))}
        made = []
        for label, pool in ((family, list(groups)), *((own, v) for v in groups.values())):
            for a, b in itertools.combinations(pool, 2):
                rows = np.flatnonzero((label == a) | (label == b))
                made.append(((a, b), svm(x[rows], np.where(label[rows] == a, 1.0, -1.0))))
        if not made:
            return cls(groups)
        return cls(groups, [p for p, _ in made], np.stack([w for _, (w, _) in made], 1), np.array([b for _, (_, b) in made]))

    def shares(self, margins: np.ndarray, pool: list[str]) -> np.ndarray:
        """For each text and member of pool, the mean of the logistic margins against the other members."""
        out = np.zeros((len(margins), len(pool)))
        where = {p: i for i, p in enumerate(self.pairs)}
        for i, j in itertools.combinations(range(len(pool)), 2):
            p = 1 / (1 + np.exp(-3 * np.clip(margins[:, where[pool[i], pool[j]]], -9, 9)))
            out[:, i] += p
            out[:, j] += 1 - p
        return out / (len(pool) - 1) if len(pool) > 1 else out + 1

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ self.weights + self.biases
        names = list(self.groups)
        family = self.shares(margins, names)
        best = family.argmax(1)
        lang, score = [""] * len(x), np.zeros(len(x))
        for f, name in enumerate(names):
            rows = np.flatnonzero(best == f)
            inside = self.shares(margins[rows], self.groups[name])
            top = inside.argmax(1)
            for r, t in zip(rows.tolist(), top.tolist()):
                lang[r] = self.groups[name][t]
            score[rows] = family[rows, f] * inside[np.arange(len(rows)), top]
        return lang, score


def sampled(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> DataFrame:
    """(text, lang) of rows of docs where learn holds: of each language, as many of the least hashes of doc_id as `sample`
    has room for, FEWEST at least. Equal rows count once. Only ids and hashes are ranked, and Spark cuts ranks early."""
    rows = docs.filter(F.coalesce(learn, F.lit(False)) & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").alias("doc_id"), F.col("lang").alias("lang"), F.col("text").alias("text"), F.xxhash64("text").alias("hash"))
    langs = rows.select("lang").distinct().count()
    most = max(FEWEST, sample // max(1, langs))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "hash")
    picked = rows.select("doc_id", "lang", "hash").distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    picked = F.broadcast(picked.select("doc_id", "lang", "hash"))  # `most` rows a language at most
    return rows.join(picked, ["doc_id", "lang", "hash"]).groupBy("doc_id", "lang", "hash").agg(F.min("text").alias("text")).select("text", "lang")


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """A model of text and non-null lang of at most sample rows of docs where learn holds, or somewhat more of very many languages; only their trigram counts,
    as sparse arrays, reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 64):
                some = batch.slice(i, 64)
                each = [counts(t) for t in some.column(0).to_pylist()]
                at = [np.flatnonzero(c) for c in each]
                cols = [pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32()))]
                cols.append(pa.array([c[a].astype(np.int32) for c, a in zip(each, at)], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([some.column(1), *cols], names=["lang", "at", "n"])

    rows = sampled(docs, learn, sample).mapInArrow(run, "lang string, at array<int>, n array<int>").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["at"], r["n"]))
    x = np.zeros((len(rows), DIMENSIONS), np.float32)
    for k, r in enumerate(rows):
        x[k, r["at"]] = r["n"]
    for i in range(0, len(x), 256):
        x[i : i + 256] = scaled(x[i : i + 256])
    return Model.fit(x, [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of each whole text; und with score 0 where it is null, has no letter, or nothing was
    learned. Only doc_id and text are read; rows repeat as in docs; null doc_ids stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 128):
                some = batch.slice(i, 128)
                texts = [t or "" for t in some.column(1).to_pylist()]
                has = [bool(model.groups) and any(map(str.isalpha, t)) for t in texts]
                lang, score = [NONE] * len(texts), np.zeros(len(texts))
                if rows := [k for k, h in enumerate(has) if h]:
                    made, score[rows] = model.predict(scaled(np.stack([counts(texts[k]) for k in rows])))
                    for k, name in zip(rows, made):
                        lang[k] = name
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(lang), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(of: int, which: int) -> Column:
    """Whether crc32 of the doc_id as text leaves the remainder `which` by `of`; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == which, F.lit(False))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): predictions of all rows by what the rows that aren't held out teach.

    Rows stay as often as they come, null doc_ids too; null texts and those without a letter are und with score 0. No
    rows give no rows."""
    model = fit(docs, ~held_out(3, 1), sample)
    return predict(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")
