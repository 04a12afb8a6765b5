"""Ids of a byte-level BPE that is given as a file of the tokenizers library."""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Longer runs of white space may exceed what the faster library's pattern search can hold.
BLANKS = 4096


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if it prints, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids as the tokenizers library gives them, by tiktoken over the same vocabulary where that is the same.

    Ids of such a vocabulary are the ranks of its merges, and both libraries cut texts by the same pattern: a test holds
    them against each other over all code points. Texts with the string of an added token, where those count, and with
    very long runs of white space go to the tokenizers library itself.
    """

    def __init__(self, path: str, pattern: str) -> None:
        spec = json.loads(open(path, encoding="utf-8").read())
        if spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{path} isn't a plain byte-level vocabulary")
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.fast = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.path = path
        self.size = 1 + max([*ranks.values(), *self.added.values()])
        self.bytes = [b""] * self.size
        for raw, i in [*ranks.items(), *((t.encode(), i) for t, i in self.added.items())]:
            self.bytes[i] = raw
        self.blanks = re.compile(rf"\s{{{BLANKS}}}")

    @cached_property
    def known(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    @cached_property
    def literal(self) -> Tokenizer:
        out = Tokenizer.from_file(self.path)
        out.encode_special_tokens = True
        return out

    def encode(self, text: str, added: bool) -> np.ndarray:
        """The ids of a text; added: whether strings of added tokens in it are these tokens and not plain text."""
        if added and any(t in text for t in self.added):
            return np.array(self.known.encode(text, add_special_tokens=False).ids, np.uint32)
        if len(text) >= BLANKS and self.blanks.search(text):
            return np.array(self.literal.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


_made: dict[tuple[str, str], ByteLevel] = {}


def byte_level(path: str, pattern: str) -> ByteLevel:
    """One for each Python worker, which serves task after task."""
    if (path, pattern) not in _made:
        _made[path, pattern] = ByteLevel(path, pattern)
    return _made[path, pattern]
