"""Encodings of text chunks, kept from one task of a Python worker to its next ones in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401


class Recent:
    """Chunk -> encoding. Two generations of at most `most` chunks each: what is asked for again stays, the rest goes."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 250_000) -> None:
        self.encode, self.most = encode, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def each(self, chunks: list[str]) -> list[bytes]:
        """The encoding of each of some different chunks."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new = []
        for c in chunks:
            if c not in young:
                if c in old:
                    young[c] = old[c]
                else:
                    new.append(c)
        if new:
            young.update(zip(new, self.encode(new), strict=True))
        return [young[c] for c in chunks]


@dataclass
class Ragged:
    """Lists of integers, one after the other in one array, and where each of them ends."""

    flat: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, parts: list[bytes], kind: type) -> Ragged:
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(kind).itemsize
        return cls(np.frombuffer(b"".join(parts), kind), np.cumsum(size))

    def take(self, which: np.ndarray) -> Ragged:
        begin = np.concatenate((np.zeros(1, np.int64), self.ends))[which]
        n = self.ends[which] - begin
        ends = np.cumsum(n)
        return Ragged(self.flat[np.repeat(begin - (ends - n), n) + np.arange(len(ends) and ends[-1])], ends)

    def joined(self, last: np.ndarray) -> Ragged:
        """Lists that each hold those of self up to number last[k], from where the one before ends."""
        return Ragged(self.flat, np.concatenate((np.zeros(1, np.int64), self.ends))[last])

    def and_then(self, other: Ragged) -> Ragged:
        return Ragged(np.concatenate((self.flat, other.flat)), np.concatenate((self.ends, other.ends + len(self.flat))))

    def arrays(self) -> list[np.ndarray]:
        ends = self.ends.tolist()
        return [self.flat[i:j] for i, j in zip([0, *ends], ends)]


def list_ends(column: pa.ListArray) -> np.ndarray:
    """Where the lists of a column end in their flattened values."""
    at = column.offsets.to_numpy()
    return at[1:].astype(np.int64) - at[0]


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """A column of texts, null as empty, in slices of about `most` bytes, so that long texts come alone."""
    column = column.fill_null("")
    sizes = pa.compute.binary_length(column).to_pylist()
    begin = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield column.slice(begin, i + 1 - begin)
            begin, total = i + 1, 0
    if begin < len(column):
        yield column.slice(begin)


def portions(column: pa.Array, most: int = 1 << 20) -> Iterator[list[str]]:
    """The texts of slices()."""
    return (x.to_pylist() for x in slices(column, most))
