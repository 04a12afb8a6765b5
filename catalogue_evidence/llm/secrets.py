"""Secret scans: three base patterns, and random strings found by how few characters a token of theirs holds."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.llm.chunks import portions

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are taken whole, so shorter ones drop out
#: Where a random string can stand. What base spans leave of a run counts as runs of its own.
LEAST = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: Characters a token, at most, of a string that counts as random. Identifiers hold 3 and more, base64 about 1.6.
EFFICIENCY = 2.2
#: The same for names of words in one case, whose parts are judged without what joins them: rare or foreign words hold 1.6
#: and more, random letters in one case about 1.4.
WORD_EFFICIENCY = 1.5
WORD = r"(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{0,4}"
NAME = re.compile(rf"[+/_=-]*{WORD}(?:[+/_=-]+{WORD})*[+/_=-]*")
JOINT = re.compile(r"[+/_=-]+")
#: Digests and identifiers known by their form, which are random but no secrets.
KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"  # digests
    r"|[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"  # UUIDs
    r"|sha(?:1|224|256|384|512)-[A-Za-z0-9+/]+=*"  # integrity digests
    r"|[0-9+/_=-]+)"  # numbers, dates, rules
)


class Scanner:
    """The scan of a text; efficiency is judged by the vocabulary in the file of ranks at path."""

    def __init__(self, path: str, pattern: str, efficiency: float = EFFICIENCY) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.efficiency = efficiency

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of assign, access and hex spans, sorted."""
        out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(out)

    def is_random(self, run: str) -> bool:
        if KNOWN.fullmatch(run):
            return False
        if NAME.fullmatch(run):
            parts = [x for x in JOINT.split(run) if x]
            return sum(map(len, parts)) <= WORD_EFFICIENCY * sum(len(self.tokens.encode_ordinary(x)) for x in parts)
        return len(run) <= self.efficiency * len(self.tokens.encode_ordinary(run))

    def random(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans of random strings in what base spans, sorted by their starts, leave of the text's runs."""
        out = []
        i = 0
        for m in RUN.finditer(text):
            at = m.start()
            while i < len(base) and base[i][0] < m.end():
                out.append((at, 3, base[i][0]))
                at = max(at, base[i][2])
                if base[i][2] > m.end():  # it may reach into the next run
                    break
                i += 1
            out.append((at, 3, m.end()))
        return [(s, k, e) for s, k, e in out if e - s >= LEAST and self.is_random(text[s:e])]

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans, and all spans: (start, kind, end) by start, then kind."""
        base = self.base(text)
        return base, sorted(base + self.random(text, base))


_scanners: dict[tuple[str, str, float], Scanner] = {}


def scanner(path: str, pattern: str, efficiency: float = EFFICIENCY) -> Scanner:
    key = (path, pattern, efficiency)
    if key not in _scanners:
        _scanners[key] = Scanner(*key)
    return _scanners[key]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, path: str, pattern: str, efficiency: float = EFFICIENCY) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random), one row for each row of docs.

    Spans are kind:start:end in code points, by start and then by kind, comma-joined; base_sha256 is the digest of the
    three base kinds' spans, spans holds all kinds. Spans of kind random are runs of LEAST or more characters, without
    what base spans take of them, that have no form of a known digest or identifier and whose tokens hold few characters.
    A null or empty text has no spans. Only doc_id and text are read; rows repeat as in docs; null doc_ids stay; no rows
    give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(path, pattern, efficiency)
        for batch in batches:
            at = 0
            for texts in portions(batch.column(1)):
                found = [own.spans(t) for t in texts]
                counts = [[sum(k == kind for _, k, _ in spans) for _, spans in found] for kind in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        *[pa.array(c, pa.int64()) for c in counts[:3]],
                        pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]),
                        pa.array([written(spans) for _, spans in found], pa.string()),
                        pa.array(counts[3], pa.int64()),
                    ],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"],
                )
                at += len(texts)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def redact(docs: DataFrame, path: str, pattern: str, efficiency: float = EFFICIENCY) -> DataFrame:
    """docs with each secret of its texts replaced by <kind>, overlapping spans by the first one's; n_chars follows.

    All rows and columns stay; texts without a secret, null ones included, stay as they are, and so does their n_chars.
    """

    def clean(text: str, own: Scanner) -> str:
        out, at = [], 0
        for s, k, e in own.spans(text)[1]:
            if s >= at:
                out += [text[at:s], f"<{KINDS[k]}>"]
            at = max(at, e)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(path, pattern, efficiency)
        for batch in batches:
            for i in range(0, len(batch), 256):
                some = batch.slice(i, 256)
                was = some.column("text").to_pylist()
                now = [t and clean(t, own) for t in was]
                made = {"text": now}
                if "n_chars" in some.schema.names:
                    counts = some.column("n_chars").to_pylist()
                    made["n_chars"] = [n if a == b else len(b) for n, a, b in zip(counts, was, now)]
                for name, values in made.items():
                    field = some.schema.field(name)
                    some = some.set_column(some.schema.get_field_index(name), field, pa.array(values, field.type))
                yield some

    return docs.mapInArrow(run, docs.schema)
