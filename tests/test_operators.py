import json

import duckdb
import pytest
from pyspark.sql import functions as F

from catalogue_evidence.operators import assemble, audit, conflicts, extract, publish, review, scoring, skew
from catalogue_evidence.operators.assemble import KEY
from catalogue_evidence.plans import oracles, queries
from catalogue_evidence.sources import shared, tables

PAGE = """<html><head><title>Exact Product 60 caps</title>
<script type="application/ld+json">{"@graph": [{"@type": ["Thing", "product"], "name": "Exact Product 60 capsules", "brand": {"name": "Test Brand"}, "image": "/exact.png"}]}</script>
<script type="application/ld+json">{broken</script>
<meta property="og:image" content="/logo.png"></head><body><h1>Exact &amp; Product</h1>
<img src="/a.jpg" alt="x"><img src="/a.jpg" alt="xyz"><img src="/a.jpg" alt="abc"><img class="Product" data-srcset="/b.jpg 1x, //cdn.x.com/c.jpg 2x"><script>no()</script></body></html>"""


def rows(spark, fields, *values):
    return spark.createDataFrame(list(values), ", ".join(f if " " in f else f"{f} string" for f in fields))


def test_page_extraction(spark):
    pages = rows(spark, ["page_url", "html"], ("https://x.com/p", PAGE), ("https://x.com/p", PAGE), ("https://x.com/n", None))
    texts = {r["page_url"]: r for r in extract.page_text(pages).collect()}
    assert texts["https://x.com/p"]["title"] == "Exact Product 60 caps" and texts["https://x.com/n"]["text"] == ""
    assert "Exact & Product" in texts["https://x.com/p"]["text"] and "no()" not in texts["https://x.com/p"]["text"]
    assert [r["brand"] for r in extract.jsonld_products(pages).collect()] == ["Test Brand"]
    found = {r["url"]: r for r in extract.dedup_page_candidates(extract.extract_candidates(pages)).collect()}
    assert set(found) == {"https://x.com/exact.png", "https://x.com/a.jpg", "https://x.com/b.jpg", "https://cdn.x.com/c.jpg"}
    assert found["https://x.com/a.jpg"]["alt"] == "xyz" and found["https://x.com/a.jpg"]["disc_ord"] == 2
    assert found["https://cdn.x.com/c.jpg"]["origin"] == "woocommerce-gallery-srcset"


def test_titles_are_those_of_the_sql(spark, tmp_path):
    """Pages with one URL and different bodies, references cut short or of other marks, odd blanks, and no title."""
    titles = [" a\x0bb \xa0c\u2003", "\u3000 &amp;lt; &quot;q&quot; &lt;b&gt; and&&&amp", "\n d\t\t e\r\n", "a<b>c", "", None, "x\x85\u2028 "]
    pages = [(k, f"https://x.com/{k % 2}", t if t is None else f"<html><title>{t}</title><title>second</title></html>") for k, t in enumerate(titles)]
    rows(spark, ["page_id long", "url", "html"], *pages, (100, "https://x.com/0", "<TITLE>x</TITLE>")).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r["title"] for r in queries.page_titles(spark, str(tmp_path)).collect()}
    sql = oracles.oracle_sql()["d1_page_titles"].replace("from pages", f"from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == dict(duckdb.sql(sql).fetchall()) and len(got) == len(pages) + 1


def test_rendered_candidates(spark):
    fields = ["page_url", "disc_ord long", "url", "origin", "alt", "page_title", "w int", "h int"]
    img = "browser-rendered-img"
    items = rows(
        spark, fields, ("p", 0, "https://x/logo.png", "browser-og", "", "t", 0, 0), ("p", 1, "https://x/a.jpg", img, "", "t", 100, 500),
        ("p", 2, "https://x/b.jpg", img, "", "t", 0, 10), ("p", 3, "https://x/b.jpg", img, "again", "t", 0, 0), ("p", 4, "data:x", img, "", "t", 0, 0),
    )
    assert sorted(r["disc_ord"] for r in extract.rendered_candidates(items).collect()) == [0, 2]


CATALOGUE = ["batchIndex", KEY, "brand", "productName", "size", "rawSize", "targetJpgPath", "sourcePage", "sourceClass", "sourceDomain", "isSharedSourceConflict", "domains array<string>"]
CANDIDATES = [KEY, "disc_ord long", *assemble.CANDIDATE]
FETCHED = ["url", "final_url", "content_type", "error", "width", "height", "bytes", "sha256", "perceptualHash"]


def one(spark, **more):
    base = ("1", "k", "Test Brand", "Exact Product", "60 caps", "", "a/b.jpg", "https://x.com/p", "", "", "false", ["x.com"])
    return rows(spark, CATALOGUE, tuple(more.get(f.split()[0], v) for f, v in zip(CATALOGUE, base)))


def candidate(k, url, origin="jsonld-product-image", alt="Exact Product 60 capsules", name="Exact Product 60 capsules", brand="Test Brand", page="https://x.com/p"):
    return ("k", k, url, page, origin, alt, "", name, brand)


def fetch(spark, *urls, **bad):
    return rows(spark, FETCHED, *[(u, u, "image/png", bad.get("error", ""), "600", "600", "9", "s", "h") for u in urls])


def none(spark):
    return rows(spark, [KEY, "resolvedImageUrl"]).limit(0), rows(spark, [KEY, "exactVariantConfirmed"]).limit(0)


def test_best_candidate_and_its_score(spark):
    c = one(spark)
    cand = rows(spark, CANDIDATES, candidate(1, "https://x.com/exact-product.png"))
    ranked = scoring.rank_candidates(scoring.candidate_score(cand, c))
    got = ranked.first()
    assert got["exact"] and got["score"] == 45 + 20 + 45 + 25 + 15 + 18 + 12 + 14
    best = scoring.select_best(scoring.judge(ranked, c, fetch(spark, "https://x.com/exact-product.png"), *none(spark)), c).first()
    assert best["status"] == scoring.HIGH and best["stagingPath"] == "staging/00001_b.jpg" and best["autoApprovalEligible"]


def test_cut_comes_before_filters_and_ties_keep_discovery(spark):
    c = one(spark)
    cand = rows(spark, CANDIDATES, *[candidate(k, f"https://x.com/{k}.png") for k in range(1, 62)])
    ranked = scoring.rank_candidates(scoring.candidate_score(cand, c))
    assert [r["disc_ord"] for r in ranked.orderBy("rank").collect()] == list(range(1, 61))
    bad = rows(spark, [KEY, "resolvedImageUrl"], *[("k", f"https://x.com/{k}.png") for k in range(1, 61)])
    best = scoring.select_best(scoring.judge(ranked, c, fetch(spark, "https://x.com/61.png"), bad, none(spark)[1]), c).first()
    assert best["status"] == "UNRESOLVED" and best["reason"].count("previously rejected") == 6


def test_reasons_in_order_and_rows_without_candidates(spark):
    c = one(spark)
    cand = rows(
        spark, CANDIDATES, candidate(1, "https://x.com/zz.png", "og-image", "", "", ""), candidate(2, "https://x.com/weak.png", "page-img", "", "", ""),
        candidate(3, "https://x.com/variable.png", alt="Exact Product", name="", page="https://x.com/p?attribute_size=1"), candidate(4, "https://x.com/gone.png"),
    )
    ranked = scoring.rank_candidates(scoring.candidate_score(cand, c))
    judged = scoring.judge(ranked, c, fetch(spark, "https://x.com/variable.png"), *none(spark))
    why = {r["disc_ord"]: r["skip"] for r in judged.collect()}
    assert why[1].startswith("og-image with no") and why[2] == "critically weak identity match skipped: brand_cov=0.00 prod_cov=0.00"
    assert why[3].startswith("variable product page") and why[4] == "jsonld-product-image: not fetched"
    empty = scoring.select_best(judged.limit(0), c).first()
    assert empty["reason"] == "no exact image candidate found" and empty["status"] == "UNRESOLVED"


def test_confirmed_override_blesses_any_candidate(spark):
    c = one(spark, isSharedSourceConflict="true")
    cand = rows(spark, CANDIDATES, candidate(1, "https://x.com/p.png", "page-img", name=""))
    ranked = scoring.rank_candidates(scoring.candidate_score(cand, c))
    ok = rows(spark, [KEY, "exactVariantConfirmed"], ("k", "true"))
    assert scoring.judge(ranked, c, fetch(spark, "https://x.com/p.png"), none(spark)[0], ok).first()["high_confidence"]
    assert not scoring.judge(ranked, c, fetch(spark, "https://x.com/p.png"), *none(spark)).first()["high_confidence"]


def test_proposed_overrides(spark):
    cand = scoring.candidate_score(rows(spark, CANDIDATES, candidate(1, "https://x.com/e.png"), candidate(2, "https://x.com/f.png")), one(spark))
    old = rows(spark, [KEY, "approvedDirectImageUrl", "approvedSourcePageUrl", "exactVariantConfirmed", "reviewer", "evidenceNote"], ("k", "old", "", "true", "", ""), ("j", "kept", "", "", "", ""))
    open_ = rows(spark, [KEY, "status"], ("k", "UNRESOLVED"))
    got = {r[KEY]: r for r in scoring.propose_overrides(cand, open_, old).collect()}
    assert got["k"]["approvedDirectImageUrl"] == "https://x.com/e.png" and got["k"]["exactVariantConfirmed"] == "false" and got["j"]["approvedDirectImageUrl"] == "kept"
    staged = rows(spark, [KEY, "status"], ("k", "STAGED_X"))
    assert {r["approvedDirectImageUrl"] for r in scoring.propose_overrides(cand, staged, old).collect()} == {"old", "kept"}


RESULT = [KEY, "brand", "productName", "size", "sha256", "perceptualHash", "status", "autoApprovalEligible boolean", "reason"]


def test_conflicts(spark):
    r = rows(
        spark, RESULT, ("a", "B", "P", "60 caps", "s1", "h1", "STAGED_X", True, ""), ("b", "b", "p", "60 capsules", "s1", "h1", "STAGED_X", True, ""),
        ("c", "B", "P", "90 caps", "s2", "h2", "STAGED_X", True, ""), ("d", "B", "P", "60 caps", "s2", "h2", "UNRESOLVED", False, ""),
        ("e", "B", "Q", "1 g", "", None, "STAGED_X", True, ""), ("f", "B", "R", "2 g", "", None, "STAGED_X", True, ""),
    )
    report = conflicts.conflict_report(r).collect()
    assert sorted((x["conflictType"], x[KEY]) for x in report) == [("phash", "c"), ("phash", "d"), ("sha256", "c"), ("sha256", "d")]
    assert {x["conflictType"]: x["status"] for x in report if x[KEY] == "c"} == {"sha256": "STAGED_X", "phash": conflicts.CONFLICT}
    marked = {x[KEY]: (x["status"], x["autoApprovalEligible"]) for x in conflicts.mark_conflicts(r).collect()}
    assert marked["c"] == (conflicts.CONFLICT, False) and marked["d"] == ("UNRESOLVED", False) and marked["a"] == ("STAGED_X", True)


def payload(decision, confidence, **more):
    return json.dumps({"decision": decision, "confidence": confidence} | {c: True for c in review.CHECKS} | more)


@pytest.mark.parametrize(
    ("status", "body", "want"),
    [
        ("OK", payload("REVIEW", 90), review.REJECTED), ("OK", payload("REVIEW", 89), review.REVIEW), ("OK", payload("APPROVE", 97), review.REJECTED),
        ("OK", payload("APPROVE", 98), review.APPROVED), ("OK", payload("APPROVE", 98, brand_exact=None), review.REJECTED), ("ERROR", None, review.REVIEW), ("OK", None, review.REVIEW),
    ],
)
def test_decisions(spark, status, body, want):
    v = rows(spark, [KEY, "status", "payload", "error"], ("k", status, body, ""))
    assert review.decided(v).first()["new_decision"] == want


def test_people_are_never_overruled_and_upserts_repeat(spark):
    res = rows(spark, review.RESULT, *[tuple(k if c == KEY else "v" for c in review.RESULT) for k in ("h", "m")])
    sheet = rows(spark, review.SHEET, *[tuple({KEY: k, "manualVisualDecision": review.APPROVED, "reviewer": who}.get(c, "") for c in review.SHEET) for k, who in (("h", "Ann"), ("m", "gemini"))])
    v = rows(spark, [KEY, "status", "payload", "error"], ("h", "OK", payload("REJECT", 99), ""), ("m", "OK", payload("REJECT", 99), ""))
    out = review.apply_verifications(sheet, v, res, res, "model", "now")
    assert {r[KEY]: r["manualVisualDecision"] for r in out.collect()} == {"h": review.APPROVED, "m": review.REJECTED}
    new = review.new_rejections(sheet, v, res, "now")
    old = rows(spark, review.REJECTED_FIELDS, ("m", "v", "", "before", "", ""), ("x", "u", "", "kept", "", ""))
    once = review.upsert_rejected(old, new)
    assert sorted(r[KEY] for r in once.collect()) == ["m", "x"] and sorted(review.upsert_rejected(once, new).collect()) == sorted(once.collect())


EVENTS = [KEY, "event_id long", "ts long", "decision"]


def test_human_decisions(spark):
    sheet = rows(spark, review.SHEET, *[tuple({KEY: k}.get(c, "") for c in review.SHEET) for k in ("a", "b")])
    cat = rows(spark, [KEY, "brand", "productName", "size"], ("a", "B", "P", "S"), ("b", "B", "P", "S"))
    events = rows(spark, EVENTS, ("a", 1, 1, "approve"), ("a", 2, 2, "reject"), ("a", 3, 3, "skip"), ("b", 4, 1, "reject"), ("b", 5, 1, "reject"))
    got = {r[KEY]: r for r in review.apply_human_decisions(sheet, events, cat).collect()}
    assert got["a"]["manualVisualDecision"] == review.REJECTED and got["a"]["brandExact"] == "true" and got["a"]["reviewedSizeQuantity"] == "S"
    res = rows(spark, [KEY, "resolvedImageUrl", "evidencePage"], ("a", "", ""), ("b", "u", "e"))
    none = rows(spark, review.REJECTED_FIELDS).limit(0)
    once = review.human_rejections(events, res, none, "now")
    assert [r[KEY] for r in once.collect()] == ["b"] and review.human_rejections(events, res, once, "now").count() == 1


def test_duplicate_paths_name_the_row_before(spark):
    m = rows(spark, ["row_no long", KEY, "assetId", "targetJpgPath"], (1, "k1", "a", "p"), (2, "k2", "a", "p"), (3, "k3", "a", "p"), (4, "k4", "a", "q"))
    assert sorted((r[KEY], r["problem"]) for r in audit.duplicate_paths(m).collect()) == [("k2", "DUPLICATE_PATH_WITH_k1"), ("k3", "DUPLICATE_PATH_WITH_k2")]


def test_last_row_of_a_key_wins_in_chunks(spark):
    a, b = rows(spark, [KEY, "status"], ("x", "1"), ("y", "1"), ("", "1")), rows(spark, [KEY, "status"], ("x", "2"))
    assert {r[KEY]: r["status"] for r in review.merge_chunks(a, b).collect()} == {"x": "2", "y": "1"}


def test_evidence_in_parts_is_that_of_the_whole(spark):
    from itertools import product

    from pyspark.sql import functions as F

    from catalogue_evidence.functions import text as t

    parts = ["", "very soft", "gels 30", "Gels", "60", "ml 2 x 30", "fl", "oz soft", "soft gels", "Soft&amp;Gel 12 caps"]
    cand = [(str(i), f"https://x.com/{u}", "", "o", a, b, n, "brand " + n) for i, (u, a, b, n) in enumerate(product(["gels-30%20ml", "a.jpg"], parts, parts[:4], parts))]
    df = spark.createDataFrame(cand, f"{KEY} string, url string, page_url string, origin string, alt string, page_title string, structured_product_name string, structured_brand string")
    raw = {"name": "structured_product_name", "brand": "structured_brand", "alt": "alt", "title": "page_title", "url": "url"}
    col = {**{k: F.col(v) for k, v in raw.items()}, "dec": F.expr("url_decode(url)")}
    join = lambda p: F.concat_ws(" ", *[col[x] for x in p])
    want = [t.significant_tokens(join(p)).alias(f"want_{n}") for n, p in scoring.TOKENS.items()] + [F.array_sort(t.size_signatures(join(p))).alias(f"want_{n}") for n, p in scoring.SIZES.items()]
    got = scoring._evidence(df.select("*", *want))
    same = [F.col(n).eqNullSafe(F.col(f"want_{n}")) for n in scoring.TOKENS] + [F.array_sort(n).eqNullSafe(F.col(f"want_{n}")) for n in scoring.SIZES]
    assert got.count() == len(cand) and all(got.filter(~c).count() == 0 for c in same)


def largest_and_mean(df):
    """Rows of df's largest task, and of a task in the mean."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes), sum(sizes) / len(sizes)


@pytest.fixture
def plain(spark):
    """Joins as they are planned, without Spark's own splits of large partitions and without broadcasts of given tables."""
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    was = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in was.items():
        spark.conf.set(k, v)


def test_rows_of_one_page_spread_over_tasks(plain):
    n = 4000
    rows_ = plain.range(n).select(F.concat(F.lit("k"), "id").alias(KEY), F.lit(1).alias("page_ord"), F.when(F.col("id") % 10 < 3, F.lit("hot")).when(F.col("id") % 10 == 3, F.lit(None)).otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("page_url"))
    pages = rows_.filter("page_url is not null").select(F.col("page_url").alias("visited")).distinct().select("visited", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("disc_ord"))
    found = pages.select("*", F.concat("visited", F.col("disc_ord").cast("string")).alias("url"), *[F.lit("").alias(c) for c in assemble.CANDIDATE if c != "url"])
    got = assemble.join_page_candidates(rows_, found)
    want = rows_.join(found.select("visited", "url", F.col("disc_ord").alias("d")), F.col("page_url") == F.col("visited")).select(KEY, (F.lit(1_000_000) + F.col("d")).alias("disc_ord"), "url")
    assert sorted(map(tuple, got.select(KEY, "disc_ord", "url").collect())) == sorted(map(tuple, want.collect()))
    most, mean = largest_and_mean(got)
    assert most < 1.7 * mean and largest_and_mean(want)[0] > 2.2 * mean
    assert set(skew.frequent_keys(rows_, "page_url", 32)) == {"hot"} and skew.frequent_keys(rows_, "page_url", 2) == {}
    twice = skew.skew_join(rows_.unionByName(rows_), found, "page_url", "visited")
    assert twice.count() == 2 * want.count() and skew.skew_join(rows_.limit(0), found, "page_url", "visited").count() == 0
    numbers = plain.range(100).select((F.col("id") % 3).alias("a"), "id")
    assert skew.skew_join(numbers, plain.range(3).withColumnRenamed("id", "b"), "a", "b", 8).count() == 100


def test_a_path_of_many_rows_spreads_over_tasks(plain):
    n = 3000
    m = plain.range(n).select((n - F.col("id")).alias("row_no"), F.concat(F.lit("k"), "id").alias(KEY), F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 7 == 0, "twice").otherwise(F.concat(F.lit("p"), F.floor(F.col("id") / 5))).alias("targetJpgPath"))
    want, last = [], {}
    for r in sorted(m.collect(), key=lambda r: r["row_no"]):
        p = r["targetJpgPath"] or ""
        if p in last:
            want.append((r["row_no"], r[KEY], f"DUPLICATE_PATH_WITH_{last[p]}", p))
        last[p] = r[KEY]
    got = audit.duplicate_paths(m)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    most, mean = largest_and_mean(got)
    assert most < 2.5 * mean and largest_and_mean(got.filter("path = ''"))[0] < 500
    assert audit.duplicate_paths(m.limit(0)).count() == 0


def test_a_row_before_is_found_in_other_partitions(plain):
    data = [(g, i, i * 7 if i % 5 else None) for g, k in (("a", 1), (None, 40), ("b", 900), ("c", 2)) for i in range(k)]
    df = plain.createDataFrame(data, "g string, o int, v int")
    got = {(r["g"], r["o"]): r["was"] for r in shared.previous(df, ["g"], ["o"], "v", "was", "t").collect()}
    assert got == {(g, o): None if o == 0 else ((o - 1) * 7 if (o - 1) % 5 else None) for g, o, _ in data}


def test_slices_sort_only_what_lies_around_them(spark, monkeypatch):
    seen = []
    plain_ranked = shared.ranked

    def counted(df, *args):
        seen.append(df.count())
        return plain_ranked(df, *args)

    monkeypatch.setattr(tables, "ranked", counted)
    n = 50_000
    df = spark.range(n).select("id", F.when(F.col("id") < 3, F.lit("none")).otherwise((F.col("id") * F.col("id")).cast("string")).alias("at"))
    assert sorted(r["id"] for r in tables.slice_rows(df, "at", 20_000, 50).collect()) == list(range(20_000, 20_050)) and seen[-1] < 300
    assert sorted(r["id"] for r in tables.slice_rows(df, "at", 1, 5).collect())[-3:] == [3, 4, 5] and tables.slice_rows(df, "at", 0, 5).count() == 5
    assert [r["id"] for r in tables.slice_rows(df, "at", n - 1, 50).collect()] == [n - 1] and tables.slice_rows(df, "at", n, 50).count() == 0
    ties = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("at"))
    assert tables.slice_rows(ties, "at", 400, 900).count() == 900
    large = spark.createDataFrame([(i, (1 << 62) + i) for i in range(100)], "id int, at long")
    assert sorted(r["id"] for r in tables.slice_rows(large, "at", 40, 20).collect()) == list(range(40, 60))


def test_queue_places_with_uneven_numbers(plain):
    k = plain.range(2000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias(KEY), F.when(F.col("id") == 0, F.lit("x")).otherwise((F.col("id") ** 5).cast("decimal(38,0)").cast("string")).alias("batchIndex"), *[F.lit("").alias(c) for c in ("brand", "productName", "size")])
    r = k.select(KEY, *[F.lit("").alias(c) for c in ("status", "resolvedImageUrl", "reason")])
    q = publish.review_queue(k, r, k.select(KEY, F.lit("").alias("manualVisualDecision")), 300)
    got = [(x["place"], x[KEY], x["page"], x["pages"]) for x in sorted(q.collect(), key=lambda x: x["place"])]
    assert got == [(i + 1, f"k{i:05d}", i // 300 + 1, 7) for i in range(2000)]
    most, mean = largest_and_mean(q)
    assert most < 2 * mean


def test_texts_are_normalised_once(spark, sf_dir):
    plan = queries.texts(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^a-z0-9.]+") == 1 and plan.count("([a-z0-9]+)") == 1
