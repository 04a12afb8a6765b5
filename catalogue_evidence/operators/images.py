"""Image checks on Spark's decoded pixels; statistics in a numpy helper, the rest in columns.

Pixels come from the JVM's decoders, which know no WebP or AVIF: such files count as undecodable. Images shrink by
antialiased cubic convolution with weights in fixed point, and turn grey in whole numbers, so hashes of equal pixels
can be compared with those that other imaging libraries left in a results table. Decoders may differ by a step in the
pixels of lossy formats.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of a good image; the messages stand in quality_error().
LEAST_BYTES, LEAST_SIDE, LEAST_RATIO, MOST_RATIO, LEAST_ENTROPY, LEAST_SPREAD = 2_000, 240, 0.18, 5.5, 2.0, 4.0
BITS = 22  # of resampling weights
# Weights of red, green and blue in grey, in 65,536ths.
LUMA = (19_595, 38_470, 7_471)
FIGURES = "path string, width int, height int, channels int, entropy double, stddev double, dhash string"


@lru_cache(1024)
def taps(n: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, weights): the places of n from which each of `to` places is drawn, and the weight of each, in units of
    1 / 2**BITS. Cubic convolution with a = -0.5, widened by the ratio where an image shrinks; weights add up to 1."""
    scale = n / to
    wide = max(scale, 1.0)
    middle = (np.arange(to) + 0.5) * scale
    first = np.maximum((middle - 2 * wide + 0.5).astype(int), 0)
    end = np.minimum((middle + 2 * wide + 0.5).astype(int), n)
    at = first[:, None] + np.arange((end - first).max())
    t = np.abs((at - middle[:, None] + 0.5) / wide)
    cubic = np.where(t < 1, (1.5 * t - 2.5) * t * t + 1, np.where(t < 2, ((-0.5 * t + 2.5) * t - 4) * t + 2, 0.0))
    cubic = np.where(at < end[:, None], cubic, 0.0)
    share = cubic / cubic.sum(1, keepdims=True) * (1 << BITS)
    return first, np.trunc(share + np.copysign(0.5, share)).astype(np.int64)


def resized(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """pixels (h, w, channels) on a grid of width by height: rows first, then columns, each rounded to bytes."""

    def drawn(a: np.ndarray, to: int) -> np.ndarray:
        if len(a) == to:
            return a
        first, weight = taps(len(a), to)
        most = 255 * int(np.abs(weight).sum(1).max()) + (1 << BITS)  # that a sum of bytes can come to
        kind = np.int32 if most < 1 << 31 else np.int64
        flat, share = np.ascontiguousarray(a, kind).reshape(len(a), -1), weight.astype(kind)
        out = np.full((to, flat.shape[1]), 1 << (BITS - 1), kind)
        for k in range(weight.shape[1]):  # as many as an output place has taps, not as an image has pixels
            out += flat[np.minimum(first + k, len(a) - 1)] * share[:, k, None]
        return np.clip(out >> BITS, 0, 255).reshape(to, *a.shape[1:])

    across = drawn(pixels.swapaxes(0, 1), width).swapaxes(0, 1)
    return drawn(across, height).astype(np.uint8)


def grey_of(pixels: np.ndarray) -> np.ndarray:
    """Luma of ITU-R 601 in whole numbers, as (h, w, 1)."""
    red, green, blue = (pixels[:, :, k].astype(np.int32) * w for k, w in enumerate(LUMA))
    return ((red + green + blue + (1 << 15)) >> 16)[:, :, None]


def same_path(path: Column) -> Column:
    """Both sources' names of a local file as one; they differ in slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def rgb_of(data: bytes, width: int, height: int, channels: int) -> np.ndarray:
    x = np.frombuffer(data, np.uint8)[: width * height * channels].reshape(height, width, channels)
    return np.repeat(x, 3, 2) if channels == 1 else x[:, :, [2, 1, 0]]  # stored in the order blue, green, red


def entropy(pixels: np.ndarray) -> float:
    """Shannon bits of the histograms of all channels as one."""
    counts = np.concatenate([np.bincount(pixels[:, :, k].ravel(), minlength=256) for k in range(pixels.shape[2])])
    p = counts[counts > 0] / counts.sum()
    return float(-(p * np.log2(p)).sum())


def dhash(pixels: np.ndarray) -> str:
    """Bit 8y + x says whether the grey of a 9 by 8 image falls from place x to the next in row y; 16 hex digits."""
    tiny = resized(grey_of(pixels), 9, 8)[:, :, 0]
    bits = (tiny[:, :-1] > tiny[:, 1:]).ravel()
    return f"{sum(1 << i for i in np.flatnonzero(bits).tolist()):016x}"


def image_figures(images: DataFrame) -> DataFrame:
    """(path, width, height, channels, entropy, stddev, dhash) of Spark's image rows; pixels go no further than the helper,
    which stands where images are read."""

    def figures(data: bytes, width: int, height: int, channels: int) -> tuple[float | None, float | None, str | None]:
        if width <= 0 or height <= 0:
            return None, None, None
        x = rgb_of(data, width, height, channels)
        return entropy(resized(x, 128, 128)), float(resized(x, 96, 96).reshape(-1, 3).std(0).mean()), dhash(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [batch.column(k).to_pylist() for k in (1, 2, 3)]
            made = [figures(d.as_py(), *s) for d, *s in zip(batch.column(4), *size)]  # one image's bytes at a time
            cols = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.float64(), pa.float64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *cols], names=["path", "width", "height", "channels", "entropy", "stddev", "dhash"])

    return images.select("image.origin", "image.width", "image.height", "image.nChannels", "image.data").mapInArrow(run, FIGURES)


def image_quality(images: DataFrame, lengths: DataFrame) -> DataFrame:
    """(path, length, width, height, entropy, stddev, dhash, error) of Spark's image rows and (path, length); error is
    empty for images that are good enough."""
    size = lengths.select(same_path(F.col("path")).alias("_p"), "length")
    made = image_figures(images)
    both = made.join(size, same_path(made["path"]) == F.col("_p"))
    return both.select("path", "length", "width", "height", "entropy", "stddev", "dhash", quality_error().alias("error"))


def quality_error() -> Column:
    """The first thing wrong with (length, width, height, entropy, stddev), empty if nothing is."""
    c = F.col
    ratio = c("width") / F.greatest(c("height"), F.lit(1))
    return (
        F.when(c("length") < LEAST_BYTES, "image smaller than 2 KB")
        .when(c("width") <= 0, "undecodable image")
        .when(F.least("width", "height") < LEAST_SIDE, F.concat(F.lit("dimensions too small: "), c("width").cast("string"), F.lit("x"), c("height").cast("string")))
        .when((ratio < LEAST_RATIO) | (ratio > MOST_RATIO), F.concat(F.lit("extreme aspect ratio: "), F.format_string("%.3f", ratio)))
        .when((c("entropy") < LEAST_ENTROPY) | (c("stddev") < LEAST_SPREAD), "blank or near-blank image")
        .otherwise("")
    )


def file_figures(files: DataFrame) -> DataFrame:
    """(path, length, sha256, head) of rows of binary files; head: the first three bytes as hex digits."""
    return files.select("path", F.length("content").cast("long").alias("length"), F.sha2("content", 256).alias("sha256"), F.hex(F.substring("content", 1, 3)).alias("head"))


def content_hash(files: DataFrame) -> DataFrame:
    """(path, length, sha256) of rows of binary files."""
    return file_figures(files).select("path", "length", "sha256")


def jpeg_error() -> Column:
    """What keeps (width, height, channels, head) from being a JPEG file in colour that is large enough, empty if nothing."""
    return (
        F.when(F.coalesce(F.col("width"), F.lit(-1)) <= 0, "undecodable")
        .when(F.col("head") != "FFD8FF", "format is not JPEG")
        .when(F.col("channels") != 3, "mode is not RGB")
        .when(F.least("width", "height") < LEAST_SIDE, F.concat(F.lit("size="), F.col("width").cast("string"), F.lit("x"), F.col("height").cast("string")))
        .otherwise("")
    )


def jpeg_check(files: DataFrame, images: DataFrame) -> DataFrame:
    """(path, sha256, error): error is empty for decodable three-channel JPEG files of 240 pixels a side and more."""
    i = images.select(F.col("image.origin").alias("_o"), "image.width", "image.height", F.col("image.nChannels").alias("channels"))
    both = file_figures(files).join(i, same_path(F.col("path")) == same_path(F.col("_o")), "left")
    return both.select("path", "sha256", jpeg_error().alias("error"))


def image_checks(files: DataFrame, images: DataFrame) -> DataFrame:
    """(path, length, width, height, entropy, stddev, dhash, error, sha256, jpeg_error): image_quality(), content_hash() and
    jpeg_check() of the files that are among images, each read once and each image decoded once."""
    made = image_figures(images)
    held = file_figures(files).withColumnRenamed("path", "_file")
    both = made.join(held, same_path(made["path"]) == same_path(held["_file"]))
    return both.select("path", "length", "width", "height", "entropy", "stddev", "dhash", quality_error().alias("error"), "sha256", jpeg_error().alias("jpeg_error"))
