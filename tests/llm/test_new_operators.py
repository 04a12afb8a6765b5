"""Packing, whitening and alignment against the libraries themselves and plain loops."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import sentencepiece

from tokenizers import Tokenizer

from catalogue_evidence.llm import alignment, bytelevel, packing, queries, whitening

ODD = [
    (5, "a b  c\n\nd"), (5, "a b  c\n\nd"), (9, None), (7, ""), (7, ""), (None, "one two"), (None, None), (11, "é中\U0001f600 <|endoftext|> <s> <0x41> tail"), (12, "word " * 9_000), (13, " " * 30_000),
    (14, "a▁b ▁"), (15, "\0 x"), (16, "x" * 5_000), (17, "it's 12 o'clock　now"), (18, " " + "\n" * 9_000),
]


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, offset int, sequence_id string")


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def pieces_by_library(rows):
    own = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    out = []
    for i, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        bounds = [0, *range(min(first, len(ids)), len(ids) + 1, 2048)]
        out += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def check_packed(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 2048
    return len(by), math.ceil(sum(r["length"] for r in rows) / 2048)


def test_packing(spark, sf_dir, given):
    rows = queries.op11_packing(spark, sf_dir).collect()
    assert in_order(tuple(r)[:5] for r in rows) == in_order(pieces_by_library(given.items()))
    n, least = check_packed(rows)
    assert n <= 1.05 * least + 1
    odd = queries.packing.pack(table_of(spark, ODD), queries.BYTE_TOKENIZER, queries.PATTERN)
    rows = odd.collect()
    assert in_order(tuple(r)[:5] for r in rows) == in_order(pieces_by_library(ODD))
    check_packed(rows)
    for r in packing.sequences(odd).collect():
        mine = sorted((x for x in rows if x["sequence_id"] == r["sequence_id"]), key=lambda x: x["offset"])
        assert bytes(r["ids"]) == b"".join(bytes(x["ids"]) for x in mine) and r["doc_ids"] == [x["doc_id"] for x in mine]
    assert packing.pack(table_of(spark, ODD).limit(0), queries.BYTE_TOKENIZER, queries.PATTERN).count() == 0


def squares_by_loops(sizes, capacity):
    bins = []
    for s in sizes:
        def cost(k):
            left = [b for b in [*bins[:k], *bins[k + 1 :]] if b]
            left.append((bins[k] if k < len(bins) else capacity) - s)
            return sum(n * n for g, n in collections.Counter(left).items() if g)
        fits = [(cost(k), b, k) for k, b in enumerate(bins) if b >= s]
        new = (cost(len(bins)), capacity + 1, len(bins))
        best = min([*((c, b) for c, b, _ in fits), new[:2]])
        if best == new[:2]:
            bins.append(capacity)
            k = len(bins) - 1
        else:
            k = next(k for c, b, k in fits if (c, b) == best)
        bins[k] -= s
    return sorted(bins)


def test_each_piece_goes_where_squares_become_smallest():
    rng = random.Random(5)
    for capacity, n in ((10, 60), (17, 80), (40, 120)):
        sizes = [rng.randint(1, capacity) for _ in range(n)]
        own = packing.sums_of_squares(np.array(sizes), capacity)
        gaps = capacity - np.bincount(own, sizes).astype(int)
        assert sorted(gaps.tolist()) == squares_by_loops(sizes, capacity)
        again = packing.packed(np.array(sizes), capacity)
        assert np.bincount(again, sizes).max() <= capacity and again.max() <= own.max() and len(np.unique(again)) == again.max() + 1


def test_open_sequences_of_many_portions_are_packed_together(spark, monkeypatch):
    rng = random.Random(6)
    texts = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randint(1, 1500)))) for i in range(800)]
    for portion in (20, 1 << 16):
        monkeypatch.setattr(packing, "PORTION", portion)
        rows = packing.pack(table_of(spark, texts).repartition(7), queries.BYTE_TOKENIZER, queries.PATTERN, with_ids=False).collect()
        assert sorted(tuple(r)[:5] for r in rows) == sorted(pieces_by_library(texts))
        n, least = check_packed(rows)
        assert n <= (1.25 if portion == 20 else 1.03) * least


def test_both_libraries_cut_alike():
    own = bytelevel.byte_level(queries.BYTE_TOKENIZER, queries.PATTERN)
    rng = random.Random(7)
    letters = [*"ab1 .'\n\t", "  ", "é", "中", " ", " ", "　", "\x85", "\x1c", "\U0001f600", "’", "ſ", "²", "<|endoftext|>", "'ll", "\0", "️"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += [f"a{chr(c)}1 {chr(c)} {chr(c)}{chr(c)}.\n{chr(c)}" for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    for added, library in ((True, own.known), (False, own.literal)):
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [own.encode(t, added).tolist() for t in texts] == want


def whitened_by_numpy(vectors):
    x = np.floor(256 * np.array(vectors, float)).astype(int)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T, bias=True)
    e, u = np.linalg.eigh(np.atleast_2d(v))
    e, u = e[::-1], u[:, ::-1]
    return x, n, s, e, u


def check_whitened(rows, vectors, most=4):
    """vectors: by vec_id, those that take part."""
    x, n, s, e, u = whitened_by_numpy(list(vectors.values()))
    k = min(most, int((e > e[0] * 1e-12).sum()))
    assert len(rows) == k * len(vectors)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    for c in range(1, k + 1):
        want = ((x - s / n) @ u[:, c - 1]) / math.sqrt(e[c - 1])
        have = np.array([got[i, c]["whitened"] for i in vectors])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7
        assert all(abs(got[i, c]["explained"] - e[c - 1] / e.sum()) < 1e-10 for i in vectors)
    for i, row in zip(vectors, x.tolist()):
        assert got[i, 1]["deviation"] == sum((n * a - int(b)) ** 2 for a, b in zip(row, s)) and got[i, 1]["n"] == n
    assert {r["identity_error"] for r in rows}.pop() < 1e-9


def test_whitening(spark, sf_dir):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    check_whitened(queries.op12_whitening(spark, sf_dir).collect(), vectors)
    schema = "vec_id long, embedding array<double>, x int, component string"
    rng = np.random.default_rng(4)
    good = {i: rng.normal(size=3).tolist() for i in range(40)}
    good |= {100: good[3], 101: [-0.0, 0.0, 1e-9]}
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [1.0, math.nan, 2.0]), (204, [1.0, math.inf, 2.0]), (205, [1.0, 2.0])]
    rows = [(i, v, 0, "") for i, v in [*good.items(), *bad]]
    check_whitened(whitening.whiten(spark.createDataFrame(rows, schema)).collect(), good)
    twice = whitening.whiten(spark.createDataFrame([*rows, *rows[:5], (None, good[1], 0, "")], schema)).collect()
    assert len(twice) == 3 * (len(good) + 6) and {r["n"] for r in twice} == {len({tuple(np.floor(256 * np.array(v))) for v in good.values()})}
    equal = spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, [1.0, 2.0], 0, "")], schema)
    assert whitening.whiten(equal).count() == 0 == whitening.whiten(equal.limit(0)).count()
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 1.0], 0, ""), (2, [-3.0, 2.0], 0, ""), (3, [0.0, 9.0], 0, "")], schema)).collect()
    assert {r["deviation"] for r in huge} == {None} and all(math.isfinite(r["whitened"]) for r in huge)
    some = spark.createDataFrame([(1, [1e6, 1.0], 0, ""), (2, [-3.0, 2.0], 0, ""), (3, [0.0, 9.0], 0, "")], schema)
    check_whitened(whitening.whiten(some).collect(), {1: [1e6, 1.0], 2: [-3.0, 2.0], 3: [0.0, 9.0]})


@pytest.mark.parametrize("values", [
    np.linspace(1, 90, 24), np.ones(24), np.r_[7.0, 2.0, np.zeros(22)], 2.0 ** -np.arange(24), np.r_[9, 9, 9, 9, 9, np.ones(19)], np.r_[5.0, 3.0], np.r_[5 + 1e-10 * np.arange(24)],
])
def test_leading_eigenvectors_and_counts(values):
    rng = np.random.default_rng(8)
    turn = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    v = (turn * values) @ turn.T
    v = (v + v.T) / 2
    every = np.linalg.eigvalsh(v)[::-1]
    for x in rng.uniform(-1, 1.2 * values.max(), 20):
        assert whitening.above(v, x) == (every > x).sum()
    e, u = whitening.leading(v, 4)
    assert len(e) == min(4, (every > 1e-12 * every[0]).sum()) and np.abs(e - every[: len(e)]).max() < 1e-12 * every[0]
    assert np.abs(v @ u - u * e).max() < 1e-12 * every[0] and np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12


def aligned_by_loops(rows):
    a_model = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    letters = bytelevel.byte_letters()

    def bytes_b(i):
        p = b_model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()

    docs, count = [], collections.Counter()
    for i, text in rows:
        made, links = [], []
        if text:
            a = [(x, bytes(letters[c] for c in a_model.id_to_token(x))) for x in a_model.encode(" " + text, add_special_tokens=False).ids]
            b = [(x, bytes_b(x)) for x in b_model.encode(text)]
            raw = (" " + text).encode()
            if b"".join(t for _, t in a) == b"".join(t for _, t in b) == raw:
                made, ends = [a, b], []
                for tokens in made:
                    at, out = 0, []
                    for _, t in tokens:
                        at += len(t)
                        out.append(at)
                    ends.append(out)
                common = sorted(set(ends[0]) & set(ends[1]))
                place = [{e: k for k, e in enumerate(x)} for x in ends]
                links = [(a[place[0][e]][0], b[place[1][e]][0]) for e in common]
        if not links:
            docs.append((i, 0, 0, 0, [], ""))
            continue
        written, j = [], [0, 0]
        for e in common:
            sides = []
            for k in (0, 1):
                to = place[k][e] + 1
                sides.append(",".join(str(x) for x, _ in made[k][j[k] : to]))
                j[k] = to
            written.append("|".join(sides))
        count.update(links)
        docs.append((i, len(a), len(b), len(common), links, hashlib.sha256(";".join(written).encode()).hexdigest()))
    top = collections.Counter()
    for (x, y), n in count.items():
        top[y] = max(top[y], n)
    return [(i, na, nb, g, len(ls), sum(count[p] == top[p[1]] for p in ls), sum(count[p] for p in ls), d) for i, na, nb, g, ls, d in docs], count


def test_alignment(spark, sf_dir, given):
    got = queries.op13_alignment(spark, sf_dir).collect()
    want, _ = aligned_by_loops(given.items())
    assert in_order(tuple(r) for r in got) == in_order(want)
    df = table_of(spark, ODD)
    want, count = aligned_by_loops(ODD)
    args = queries.BYTE_TOKENIZER, queries.PATTERN, queries.PIECE_MODEL
    assert in_order(tuple(r) for r in alignment.align(df, *args).collect()) == in_order(want)
    assert any(r[3] for r in want) and sum(r[1] == 0 for r in want) > 4
    totals = {r["pair"]: (r["n_documents"], r["n_links"]) for r in alignment.pairs(alignment.index(df, *args)).collect()}
    assert {p: n for p, (_, n) in totals.items()} == {a << 32 | b: n for (a, b), n in count.items()}
    assert all(d <= n for d, n in totals.values())
    assert alignment.align(df.limit(0), *args).count() == 0


def test_small_blocks_give_the_same_scores(spark, sf_dir, given, monkeypatch):
    monkeypatch.setattr(alignment, "LINKS", 2_000)
    got = queries.op13_alignment(spark, sf_dir).collect()
    assert in_order(tuple(r) for r in got) == in_order(aligned_by_loops(given.items())[0])


def test_bitmaps_hold_what_they_were_given():
    rng = np.random.default_rng(9)
    sets = [np.sort(rng.choice(alignment.DOCS, k, replace=False)) for k in (1, 0, 255, 256, 257, 4096, 3, 2000)]
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    sizes, raw = alignment.containers(of, np.concatenate(sets), len(sets))
    assert alignment.popcounts(sizes, raw).tolist() == [len(s) for s in sets] and sizes.max() == alignment.RAW and sizes.sum() == len(raw)
    back_of, number = alignment.members(sizes, raw)
    assert [sorted(number[back_of == k].tolist()) for k in range(len(sets))] == [s.tolist() for s in sets]


