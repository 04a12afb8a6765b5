import json

import tiktoken

import corpus_pipeline as pipeline
from catalogue_evidence.llm import bpe, decontaminate, secrets, simhash, toxicity

KEYS = "doc_id long, text string, lang string, source string, n_chars long"


def test_each_stage_against_brute_force_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}

    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    kept = stages["toxicity"](spark, docs, sf_dir)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in rows if not scores[i]}
    assert kept.columns == docs.columns

    kept = stages["simhash"](spark, docs, sf_dir)
    fps = dict(zip(rows, simhash.fingerprints([(r["text"] or "").encode() for r in rows.values()]).tolist()))
    label = {i: i for i in rows}
    ids = sorted(rows)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if a < b and (fps[a] ^ fps[b]).bit_count() <= 3 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label.values()))
    assert kept.columns == docs.columns

    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in stages["decontamination"](spark, docs, sf_dir).collect()}

    def shingles(text):
        w = "".join(c if c.isalpha() or c.isnumeric() else " " for c in (text or "").lower()).split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    tests = [s for s in map(shingles, items) if s]
    leaks = {i for i, r in rows.items() if any(len(s & d) >= 0.8 * len(s) for d in [shingles(r["text"])] for s in tests)}
    assert leaks and kept == set(rows) - leaks

    clean = {r["doc_id"]: r for r in stages["secrets"](spark, docs, sf_dir).collect()}
    own = secrets.scanner(pipeline.RANKS, pipeline.PATTERN)
    changed = {i for i, r in rows.items() if own.spans(r["text"] or "")[1]}
    assert changed == {i for i, r in rows.items() if clean[i]["text"] != r["text"]}
    assert all(not own.base(r["text"] or "") for r in clean.values())
    assert all(clean[i]["n_chars"] == len(clean[i]["text"]) for i in changed)


def test_run_joins_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        docs = stage(spark, docs, sf_dir)
    assert sorted(pipeline.run(spark, sf_dir).collect()) == sorted(docs.collect())


def test_stages_take_nulls_copies_and_no_rows(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "secret=abcdefgh1234", "en", None, 5)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, KEYS)
        for name, stage in pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), stage(spark, docs, sf_dir).schema)
            if name == "secrets" and given:
                assert {r["text"] for r in docs.collect() if r["doc_id"] is None} == {"<assign>"}
        assert docs.count() == (2 if given else 0)
