import hashlib
import json
import struct
import tempfile
import zlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from catalogue_evidence.operators import conflicts, extract, images, publish, review
from catalogue_evidence.operators.assemble import KEY
from catalogue_evidence.plans import adapters, passes, queries
from catalogue_evidence.sources import shared, tables
from catalogue_evidence.streaming import decisions, versions
from tests.test_operators import PAGE, payload, rows

CATALOGUE = [
    "batchIndex", "region", KEY, "productId", "variantIndex", "brand", "productName", "size", "rawSize", "sourcePage", "sourceDomain", "sourceClass",
    "currentImageReference", "imageAlt", "isSharedSourceConflict", "isBarcodeDatabaseSource", "targetJpgPath",
]
OVERRIDES = [KEY, "approvedDirectImageUrl", "approvedSourcePageUrl", "exactVariantConfirmed", "reviewer", "evidenceNote"]
SOURCE = ["region", "productId", "variantIndex", "imageSrc", "imageKind", "imageTrusted", "imageResolutionMethod", "imageMatchStatus", "imageNotes"]


def png(pixels):
    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_from_page_to_published_row(spark):
    cat = rows(
        spark, CATALOGUE, ("1", "ca", "ca:test:0", "test", "0", "Test Brand", "Exact Product", "60 caps", "60 capsules", "https://x.com/p", "", "", "", "", "false", "false", "assets/t.jpg"),
    )
    url = "https://x.com/exact.png"
    fetched = rows(spark, ["url", "final_url", "content_type", "error", "width", "height", "bytes", "sha256", "perceptualHash"], (url, url, "image/png", "", "600", "600", "9000", "sha", "hash"))
    inputs = passes.Inputs(cat, rows(spark, ["brand", "officialDomain"], ("Test Brand", "x.com")), rows(spark, ["page_url", "html"], ("https://x.com/p", PAGE)), rows(spark, ["page_url", "json"]).limit(0), fetched, rows(spark, OVERRIDES).limit(0))
    asked = []

    def verify(staged):
        asked.append(staged.count())
        body = payload("APPROVE", 98 if len(asked) > 1 else 50)
        return staged.selectExpr(KEY, "'OK' as status", f"'{body}' as payload", "'' as error")

    none = rows(spark, review.REJECTED_FIELDS).limit(0)
    results, sheet, rejected = passes.run_passes(spark, inputs, verify, none, tempfile.mkdtemp(prefix="spark-"), "m", "now", passes=1)
    r = results.first()
    assert r["status"].startswith("STAGED") and r["origin"] == "jsonld-product-image" and r["resolvedImageUrl"] == url
    assert sheet.first()["manualVisualDecision"] == review.REVIEW and rejected.count() == 1
    results, sheet, _ = passes.run_passes(spark, inputs, verify, none, tempfile.mkdtemp(prefix="spark-"), "m", "now", passes=1)
    files = rows(spark, ["path", "error", "sha256"], (r["stagingPath"], "", "sha"), ("assets/t.jpg", "", "sha"))
    source = rows(spark, SOURCE, ("ca", "test", "0", "old", "", "", "", "", ""), ("ca", "other", "0", "old", "", "", "", "", "n"))
    approved, regional, summary = passes.gate(inputs, results, sheet, files, source, 1)
    assert approved.count() == 1 and summary.first()["pass"]
    got = {x["productId"]: x for x in regional.collect()}
    assert got["test"]["imageSrc"] == "/assets/t.jpg" and got["test"]["imageNotes"] == publish.NOTE and got["other"]["imageSrc"] == "old"
    assert not passes.gate(inputs, results, sheet, files, source, 2)[2].first()["pass"]


def test_second_pass_leaves_the_rejected_candidate(spark):
    cat = rows(spark, CATALOGUE, ("1", "ca", "k", "t", "0", "Test Brand", "Exact Product", "60 caps", "", "https://x.com/p", "", "", "", "", "false", "false", "a/t.jpg"))
    urls = ["https://x.com/exact.png", "https://x.com/test-brand-exact-product-60-caps.jpg"]
    page = PAGE.replace("</body>", '<img src="/test-brand-exact-product-60-caps.jpg"></body>')
    fetched = rows(spark, ["url", "final_url", "content_type", "error", "width", "height", "bytes", "sha256", "perceptualHash"], *[(u, u, "image/png", "", "600", "600", "9000", u, u) for u in urls])
    inputs = passes.Inputs(cat, rows(spark, ["brand", "officialDomain"], ("Test Brand", "x.com")), rows(spark, ["page_url", "html"], ("https://x.com/p", page)), rows(spark, ["page_url", "json"]).limit(0), fetched, rows(spark, OVERRIDES).limit(0))
    seen = []

    def verify(staged):
        got = staged.first()["resolvedImageUrl"]
        seen.append(got)
        return staged.selectExpr(KEY, "'OK' as status", f"'{payload('APPROVE', 99) if got == seen[0] and len(seen) > 1 or len(seen) == 2 else payload('REJECT', 99)}' as payload", "'' as error")

    none = rows(spark, review.REJECTED_FIELDS).limit(0)
    _, sheet, rejected = passes.run_passes(spark, inputs, verify, none, tempfile.mkdtemp(prefix="spark-"), "m", "now")
    assert len(seen) == 2 and set(seen) == set(urls)
    assert sheet.first()["manualVisualDecision"] == review.APPROVED and [r["resolvedImageUrl"] for r in rejected.collect()] == [seen[0]]


def test_searches_payloads_and_rendered_pages_find_more(spark):
    shared = ("", "", "", "", "false", "false")
    cat = rows(
        spark, CATALOGUE, ("1", "ca", "s", "t", "0", "Test Brand", "Exact Product", "60 caps", "", "", *shared, "a/s.jpg"),
        ("2", "ca", "p", "t", "0", "Test Brand", "Exact Product", "60 caps", "", "https://Store.com/products/exact?x=1", *shared, "a/p.jpg"),
        ("3", "ca", "i", "t", "0", "Test Brand", "Exact Product", "60 caps", "", "https://x.com/picture", *shared, "a/i.jpg"),
        ("4", "ca", "r", "t", "0", "Test Brand", "Exact Product", "60 caps", "", "", *shared, "a/r.jpg"),
    )
    name = "test-brand-exact-product-60-caps"
    urls_ = [f"https://x.com/{name}.jpg", f"https://cdn.com/{name}-2.jpg", f"https://x.com/{name}-3.jpg", f"https://r.com/{name}-4.jpg", "https://x.com/picture"]
    final = {"https://x.com/picture": urls_[2]}
    fetched = rows(spark, ["url", "final_url", "content_type", "error", "width", "height", "bytes", "sha256", "perceptualHash"], *[(u, final.get(u, u), "image/png", "", "600", "600", "9000", u, u) for u in urls_])
    inputs = passes.Inputs(
        cat, rows(spark, ["brand", "officialDomain"], ("Test Brand", "x.com")), rows(spark, ["page_url", "html"], ("https://found.com/p", f'<title>Test Brand Exact Product 60 caps</title><img src="https://x.com/{name}.jpg">')),
        rows(spark, ["page_url", "json"], ("https://store.com/products/exact.js", json.dumps({"title": "Exact Product 60 caps", "vendor": "Test Brand", "images": [urls_[1]]}))), fetched, rows(spark, OVERRIDES).limit(0),
        rows(spark, [KEY, "rank int", "href", "title"], ("s", 1, "https://amazon.com/x", "Exact Product"), ("s", 2, "https://found.com/p", "Exact Product"), ("p", 1, "https://found.com/p", "Exact Product")),
        rows(spark, [KEY, "rank int", "href", "title"], ("r", 1, "https://amazon.com/x", "t"), ("r", 2, "https://r.com/p", "t"), ("s", 1, "https://r.com/p", "t")),
        rows(spark, ["page_url", "disc_ord long", "url", "origin", "alt", "page_title", "w int", "h int"], ("https://r.com/p", 0, "https://r.com/tiny.jpg", "browser-img", "", "t", 20, 20), ("https://r.com/p", 1, urls_[3], "browser-img", "Test Brand Exact Product 60 caps", "t", 600, 600)),
    )
    none = rows(spark, review.REJECTED_FIELDS).limit(0)
    got = {r[KEY]: r for r in passes.acquire(inputs, none).collect()}
    assert {k: r["resolvedImageUrl"] for k, r in got.items()} == {"s": urls_[0], "p": urls_[1], "i": urls_[2], "r": None}
    assert {k: r["origin"] for k, r in got.items() if k != "r"} == {"s": "page-img", "p": "shopify-product-json", "i": "direct-image-response"}
    more = {r[KEY]: r for r in passes.proposed(inputs, passes.acquire(inputs, none)).collect()}
    assert set(more) == {"r"} and more["r"]["approvedDirectImageUrl"] == urls_[3] and more["r"]["exactVariantConfirmed"] == "false"
    verify = lambda staged: staged.selectExpr(KEY, "'OK' as status", f"'{payload('REJECT', 50)}' as payload", "'' as error")
    results, sheet, _ = passes.run_passes(spark, inputs, verify, none, tempfile.mkdtemp(prefix="spark-"), "m", "now", passes=2)
    assert {r[KEY] for r in results.filter("status like 'STAGED%'").collect()} >= {"r"}
    files = rows(spark, ["path", "error", "sha256"]).limit(0)
    parts = passes.finish(inputs, results, sheet, files, rows(spark, SOURCE, ("ca", "t", "0", "old", "", "", "", "", "")), 4)
    assert parts["queue"].count() == 4 and not parts["summary"].first()["pass"] and parts["approved"].count() == 0
    assert parts["status"].first()["catalogueRows"] == 4 and parts["regional"].count() == 1


def test_csv_keeps_marks_line_ends_and_blanks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿k,v,extra\r\n1,"two\nlines ""quoted""",x\r\n2,,\r\n'.encode())
    got = tables.read_table_csv(spark, str(tmp_path / "a.csv"), ["k", "v", "absent"])
    assert sorted(map(tuple, got.collect())) == [("1", 'two\nlines "quoted"', ""), ("2", "", "")]
    assert tables.read_table_csv(spark, str(tmp_path / "none.csv"), ["k"]).count() == 0
    tables.write_table_csv(got, str(tmp_path / "out"), ["v", "more", "k"])
    again = tables.read_table_csv(spark, str(tmp_path / "out"), ["k", "v", "absent"])
    assert sorted(again.collect()) == sorted(got.collect())


def test_regions_slices_and_files(spark, tmp_path):
    df = rows(spark, ["region", "batchIndex"], *[("ca" if i % 2 else "us", str(i)) for i in range(10, 30)])
    tables.write_regional(df, f"file://{tmp_path}/r")
    assert spark.read.parquet(f"file://{tmp_path}/r").groupBy("region").count().count() == 2
    assert sorted(int(r["batchIndex"]) for r in tables.slice_rows(df, "batchIndex", 5, 3).collect()) == [15, 16, 17]
    gaps = df.filter("batchIndex % 3 = 0")  # 12, 15, 18, ...
    assert sorted(int(r["batchIndex"]) for r in tables.slice_rows(gaps, "batchIndex", 1, 3).collect()) == [15, 18, 21]
    assert tables.slice_rows(gaps, "batchIndex", 100, 3).count() == 0 and tables.slice_rows(df.limit(0), "batchIndex", 0, 3).count() == 0
    (tmp_path / "s/staging").mkdir(parents=True)
    (tmp_path / "s/staging/a.jpg").write_bytes(b"abc")
    assert [tuple(r) for r in tables.list_files(spark, f"file://{tmp_path}/s").collect()] == [("staging/a.jpg", 3)]
    tables.write_summary(df.limit(1), f"file://{tmp_path}/j")
    assert spark.read.json(f"file://{tmp_path}/j").count() == 1


def test_images(spark, tmp_path):
    rng = np.random.default_rng(1)
    noise = rng.integers(0, 255, (300, 400, 3), dtype=np.uint8)
    for name, p in {"a": noise, "b": noise, "small": noise[:100], "blank": np.full((300, 300, 3), 7, np.uint8)}.items():
        (tmp_path / f"{name}.png").write_bytes(png(p) + (b"\0" * 3000 if name == "blank" else b""))
    (tmp_path / "bad.png").write_bytes(b"x" * 5000)
    files = tables.read_files(spark, f"file://{tmp_path}")
    got = {r["path"].rsplit("/", 1)[1]: r for r in images.image_quality(tables.read_images(spark, f"file://{tmp_path}"), files.select("path", "length")).collect()}
    assert got["a.png"]["error"] == "" and got["a.png"]["dhash"] == got["b.png"]["dhash"] and len(got["a.png"]["dhash"]) == 16
    assert got["small.png"]["error"].startswith("dimensions too small: 400x100") and got["blank.png"]["error"] == "blank or near-blank image"
    assert got["bad.png"]["error"] == "undecodable image"
    hashes = {r["path"].rsplit("/", 1)[1]: r for r in images.content_hash(files).collect()}
    assert hashes["bad.png"]["sha256"] == hashlib.sha256(b"x" * 5000).hexdigest() and hashes["bad.png"]["length"] == 5000
    checks = {r["path"].rsplit("/", 1)[1]: r["error"] for r in images.jpeg_check(files, tables.read_images(spark, f"file://{tmp_path}")).collect()}
    assert checks["bad.png"] == "undecodable" and checks["a.png"] == "format is not JPEG"


#: Three suppliers whose file is no image, two with tiny files, two with one image of 40 by 40 cells, and one named twice.
SUPPLIERS = [0, 8, 18, 28, 9, 19, 16510, 3, 3]


def supplied(spark, folder, keys=SUPPLIERS):
    """Suppliers as a table, and the rows that the SQL of a query has for it, as texts of columns by name."""
    import duckdb

    from catalogue_evidence.plans.oracles import oracle_sql

    spark.createDataFrame([(k,) for k in keys], "s_suppkey long").coalesce(1).write.parquet(f"{folder}/supplier.parquet")
    con = duckdb.connect()
    con.execute(f"create view supplier as select * from read_parquet('{folder}/supplier.parquet/*.parquet')")
    return lambda name: sorted(str(sorted(r.items())) for r in con.execute(oracle_sql()[name]).to_arrow_table().to_pylist())


def test_equal_images_are_one_file(spark, tmp_path):
    want = supplied(spark, tmp_path)
    root, every = queries.drawn(spark, str(tmp_path))
    assert every.count() == len(SUPPLIERS) and tables.list_files(spark, root, "*.txt").count() == 4
    assert sorted(str(sorted(r.asDict().items())) for r in queries.image_files(spark, str(tmp_path)).collect()) == want("a5_a6_image_files")


def test_images_are_read_and_decoded_once(spark, tmp_path):
    want = supplied(spark, tmp_path, SUPPLIERS[:-1])
    checked = queries.image_checks(spark, str(tmp_path))
    scans = [x.rsplit("] ", 1)[1] for x in checked._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in x]
    assert sorted(scans) == ["binaryFile", "image", "parquet"]
    assert sorted(str(sorted(r.asDict().items())) for r in checked.collect()) == want("g1_g4_images")


def test_files_are_written_and_listed_by_some_tasks(spark, tmp_path):
    many = spark.range(0, 60, numPartitions=1).selectExpr("id as k", "'x' as content")
    tables.write_files(many, f"file://{tmp_path}/many", "k", "content")
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    was = spark.conf.get(listing)
    files = tables.read_files(spark, f"file://{tmp_path}/many", "*.txt").collect()
    tasks = {r["path"].rsplit("/", 1)[1].split("-")[1] for r in files}
    assert len(files) == 60 and len(tasks) > 4 and spark.conf.get(listing) == was
    with tables.whole_listings(spark):
        assert spark.conf.get(listing) == "16"


def test_jpeg(spark, tmp_path):
    """Files of the JVM's own encoder: in colour, grey, and too small."""
    (tmp_path / "in").mkdir()
    rng = np.random.default_rng(2)
    (tmp_path / "big.png").write_bytes(png(rng.integers(0, 255, (260, 300, 3), dtype=np.uint8)))
    (tmp_path / "small.png").write_bytes(png(rng.integers(0, 255, (90, 300, 3), dtype=np.uint8)))
    jvm = spark._jvm
    io, file = jvm.javax.imageio.ImageIO, jvm.java.io.File
    for name in ("big", "small"):
        assert io.write(io.read(file(f"{tmp_path}/{name}.png")), "jpg", file(f"{tmp_path}/in/{name}.jpg"))
    assert io.write(jvm.java.awt.image.BufferedImage(300, 260, 10), "jpg", file(f"{tmp_path}/in/grey.jpg"))  # 10: bytes of grey
    root = f"file://{tmp_path}/in"
    files, decoded = tables.read_files(spark, root), tables.read_images(spark, root)
    got = {r["path"].rsplit("/", 1)[1]: r for r in images.jpeg_check(files, decoded).collect()}
    assert {k: r["error"] for k, r in got.items()} == {"big.jpg": "", "small.jpg": "size=300x90", "grey.jpg": "mode is not RGB"}
    assert got["big.jpg"]["sha256"] == hashlib.sha256((tmp_path / "in/big.jpg").read_bytes()).hexdigest()
    quality = {r["path"].rsplit("/", 1)[1]: r["error"] for r in images.image_quality(decoded, files.select("path", "length")).collect()}
    assert quality["big.jpg"] == "" and quality["small.jpg"] == "dimensions too small: 300x90"


def drawn_by_loops(line, to):
    """One line of values by cubic convolution (a = -0.5), a value and a tap at a time."""

    def cubic(t):
        t = abs(t)
        return 1.5 * t**3 - 2.5 * t**2 + 1 if t < 1 else -0.5 * (t**3 - 5 * t**2 + 8 * t - 4) if t < 2 else 0.0

    scale, out = len(line) / to, []
    for place in range(to):
        middle, wide = (place + 0.5) * scale, max(scale, 1.0)
        near = range(max(0, int(middle - 2 * wide + 0.5)), min(len(line), int(middle + 2 * wide + 0.5)))
        shares = [cubic((x + 0.5 - middle) / wide) for x in near]
        fixed = [int(abs(w / sum(shares)) * 2**22 + 0.5) * (1 if w > 0 else -1) for w in shares]
        out.append(min(255, max(0, (sum(int(line[x]) * w for x, w in zip(near, fixed)) + 2**21) // 2**22)))
    return out


def test_resampling():
    """Against a plain loop on 50 images that shrink, grow and keep a side; and the hash's bits one by one."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        h, w, to_w, to_h = (int(x) for x in rng.integers((3, 3, 1, 1), (70, 70, 30, 30)))
        x = rng.choice([0, 255], (h, w, 1)) if rng.random() < 0.3 else rng.integers(0, 256, (h, w, 1))
        across = [drawn_by_loops(x[y, :, 0], to_w) if to_w != w else x[y, :, 0].tolist() for y in range(h)]
        down = [drawn_by_loops([row[c] for row in across], to_h) if to_h != h else [row[c] for row in across] for c in range(to_w)]
        assert np.array_equal(images.resized(x.astype(np.uint8), to_w, to_h)[:, :, 0], np.array(down).T)
    x = rng.integers(0, 256, (50, 40, 3)).astype(np.uint8)
    grey = [[(19595 * int(r) + 38470 * int(g) + 7471 * int(b) + 32768) // 65536 for r, g, b in row] for row in x]
    tiny = np.array([drawn_by_loops(row, 9) for row in grey])
    tiny = np.array([drawn_by_loops(tiny[:, c], 8) for c in range(9)]).T
    assert images.dhash(x) == f"{sum(1 << (8 * j + i) for j in range(8) for i in range(8) if tiny[j, i] > tiny[j, i + 1]):016x}"


def whole_passes(spark, inputs, verify, rejected, model, now, passes_):
    """The same passes with every row acquired in each of them."""
    last = sheet = None
    for n in range(passes_):
        if last is not None:
            inputs = replace(inputs, overrides=passes.proposed(inputs, last))
        results = passes.acquire(inputs, rejected)
        if last is not None:
            done = sheet.filter(f"manualVisualDecision = '{review.APPROVED}'").select(KEY)
            results = review.upsert(results, last.join(done, KEY, "left_semi"), KEY)
        results = shared.staged(results, "whole")
        sheet = review.merge_review_sheet(results, spark.createDataFrame([], ", ".join(f"{c} string" for c in review.SHEET)) if sheet is None else sheet)
        waiting = review.pending_verification(inputs.catalogue, results, sheet, resume=True).select(KEY)
        verified = shared.staged(verify(results.join(waiting, KEY, "left_semi")), "whole")
        rejected = shared.staged(review.upsert_rejected(rejected, review.new_rejections(sheet, verified, results, now)), "whole")
        sheet = shared.staged(review.full_review(inputs.catalogue, review.apply_verifications(sheet, verified, inputs.catalogue, results, model, now)), "whole")
        if n < passes_ - 1:
            last, sheet, _ = review.prepare_retry(results, sheet, include_review=True)
            last, sheet = shared.staged(last, "whole"), shared.staged(sheet, "whole")
    return results, sheet, rejected


def same_rows(a, b):
    return sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))


def test_passes_over_what_changed_are_those_over_everything(spark, sf_dir, monkeypatch):
    inputs = queries.pass_inputs(spark, sf_dir)
    # Pages of their own for some rows, and rendered items, which become overrides of rows without a result.
    c = inputs.catalogue.withColumn("sourcePage", F.when(F.col("batchIndex").cast("int") % 4 == 1, F.concat(F.lit("https://x.com/"), F.col("batchIndex").cast("int") % 9)).otherwise(F.col("sourcePage")))
    pages = c.filter("sourcePage like 'https://x.com%'").select(F.col("sourcePage").alias("page_url")).distinct().withColumn("html", F.concat(F.lit('<title>t</title><img src="/a-'), F.monotonically_increasing_id(), F.lit('.jpg">')))
    searches = c.select(KEY, F.lit(1).alias("rank"), F.concat(F.lit("https://r.com/"), "productId").alias("href"), F.col("productName").alias("title"))
    name = F.concat_ws("-", F.replace("productName", F.lit(" "), F.lit("-")), "brand", F.replace("size", F.lit(" "), F.lit("-")))
    items = c.select(F.concat(F.lit("https://r.com/"), "productId").alias("page_url"), F.lit(0).cast("long").alias("disc_ord"), F.concat(F.lit("https://r.com/"), name, F.lit(".jpg")).alias("url"), F.lit("browser-img").alias("origin"), F.concat_ws(" ", "brand", "productName", "size").alias("alt"), F.lit("").alias("page_title"), F.lit(600).alias("w"), F.lit(600).alias("h"))
    fetched = inputs.fetched.unionByName(queries.fetched(items.select("url")).withColumn("sha256", F.sha2(F.substring(F.md5("url"), 1, 2), 256)))
    inputs = replace(inputs, catalogue=c, pages=pages, fetched=shared.staged(fetched, "fetched"), searches=searches.limit(0), rendered_searches=searches, rendered=items)
    inputs = replace(inputs, overrides=shared.staged(inputs.overrides, "overrides"), catalogue=shared.staged(c, "catalogue"), pages=shared.staged(pages, "pages"))
    parsed, acquired, of = [], [], passes.best_candidates

    def counted(pages_):
        parsed.extend(r["page_url"] for r in pages_.select("page_url").collect())
        return plain(pages_)

    def best(inputs_, rejected_, keys=None, pages_=None):
        out = of(inputs_, rejected_, keys, pages_)
        acquired.append(out.count())
        return out

    plain = extract.extract_candidates
    with monkeypatch.context() as m:
        m.setattr(passes.extract, "extract_candidates", counted)
        m.setattr(passes, "best_candidates", best)
        got = passes.run_passes(spark, inputs, queries._reviewed, adapters.rejected(spark, sf_dir), tempfile.mkdtemp(prefix="spark-"), "m", "now")
    total = c.count()
    assert len(parsed) == len(set(parsed)) > 0 and acquired[0] == total and 0 < acquired[2] < acquired[1] < total
    want = whole_passes(spark, inputs, queries._reviewed, adapters.rejected(spark, sf_dir), "m", "now", 3)
    assert all(same_rows(x, y) for x, y in zip(got, want))
    statuses = {r["status"] for r in got[0].select("status").distinct().collect()}
    assert conflicts.CONFLICT in statuses and {r["origin"] for r in got[0].filter("origin is not null").collect()} >= {"manual-override", "shopify-product-json"}


def test_pages_are_parsed_before_candidates_are_planned(spark, sf_dir):
    inputs = queries.pass_inputs(spark, sf_dir)
    pages = passes.Pages(inputs)
    some = inputs.catalogue.filter("batchIndex < 5").select(KEY)
    out = passes.best_candidates(inputs, adapters.rejected(spark, sf_dir), some, pages)
    assert "MapInArrow" not in out._jdf.queryExecution().toString() and {r[KEY] for r in out.collect()} == {r[KEY] for r in some.collect()}


def test_resumed_runs_and_overrides_alone(spark, sf_dir):
    inputs = queries.pass_inputs(spark, sf_dir)
    none = adapters.rejected(spark, sf_dir).limit(0)
    whole = {r[KEY]: r for r in passes.acquire(inputs, none).collect()}
    staged = [k for k, r in whole.items() if r["status"].startswith("STAGED")]
    prior = spark.createDataFrame([r for k, r in whole.items() if k not in staged[:9]] , passes.acquire(inputs, none).schema).withColumn("origin", F.lit("kept"))
    files = prior.filter("stagingPath is not null").select(F.col("stagingPath").alias("path")).filter(F.crc32("path") % 4 != 0)
    there = {r["path"] for r in files.collect()}
    got = {r[KEY]: r for r in passes.resume(inputs, prior, files, none).collect()}
    assert set(got) == set(whole) and {k for k, r in got.items() if r["origin"] == "kept"} == {k for k in staged[9:] if whole[k]["stagingPath"] in there}
    assert all(got[k]["resolvedImageUrl"] == whole[k]["resolvedImageUrl"] for k in whole)
    todo = {r[KEY] for r in inputs.overrides.collect()}
    back = prior.withColumn("status", F.when(F.crc32(KEY) % 2 == 0, F.lit("ERROR")).otherwise(F.col("status")))
    was = {r[KEY]: r for r in back.collect()}
    now = {r[KEY]: r for r in passes.acquire_overrides(inputs, back, none).collect()}
    for k, r in now.items():
        fresh = k in todo and not (k in was and was[k]["status"].startswith("STAGED"))
        assert r["origin"] != "kept" if fresh else r == was[k]
    assert set(now) == set(was) | {k for k in todo if k not in was}


def test_streamed_decisions_are_those_of_the_batch(spark, tmp_path):
    events = rows(spark, [KEY, "event_id long", "ts long", "decision"], *[(f"k{i % 3}", i, i % 4, ("approve", "reject", "skip")[i % 3 if i % 5 else 0]) for i in range(40)])
    for k in range(4):
        events.filter(f"event_id % 4 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    last = {}

    def sink(batch, number):
        last.update({r["immutableKey"]: tuple(r)[1:] for r in batch.collect()})

    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    decisions.stream_decisions(stream, sink, f"{tmp_path}/ck").awaitTermination(120)
    assert last == {r["_e"]: tuple(r)[1:] for r in review.human_effects(events).collect()}


def test_streamed_chunks_are_upserted(spark, tmp_path):
    for k in range(3):
        rows(spark, [KEY, "status"], ("a", str(k)), (f"b{k}", "x")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        decisions.stream_chunk_results(spark, f"{tmp_path}/in", f"{KEY} string, status string", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
    got = {r[KEY]: r["status"] for r in decisions.current(spark, f"{tmp_path}/out").collect()}
    assert got == {"a": "2", "b0": "x", "b1": "x", "b2": "x"}
    assert decisions.current(spark, f"{tmp_path}/none") is None and decisions.current(spark, f"{tmp_path}/out", 0) is None
    # The last row of a key in one batch wins, a batch may run again, and untouched buckets stay where they are.
    own = f"{tmp_path}/own"
    sink = decisions.upsert_into(spark, own, order="at")
    first = rows(spark, [KEY, "status", "at int"], ("a", "late", 9), ("a", "early", 1), ("b", "x", 1), ("", "blank", 1), ("c", "y", 2))
    sink(first, 3)
    for _ in range(2):
        sink(rows(spark, [KEY, "status", "at int"], ("b", "z", 1), ("b", "w", 2)), 5)
    assert held(decisions.current(spark, own)) == {"a": "late", "b": "w", "c": "y"} and held(decisions.current(spark, own, 5)) == {"a": "late", "b": "x", "c": "y"}
    was, now = versions.version(spark, own, 3).buckets, versions.version(spark, own).buckets
    assert sum(was[b] != now[b] for b in was) == 1 and versions.versions(spark, own) == [3, 5]


def held(df):
    return {r[KEY]: r["status"] for r in df.collect()}


def test_readers_see_versions_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    own = f"{tmp_path}/own"
    sink = decisions.upsert_into(spark, own, buckets=4)
    sink(rows(spark, [KEY, "status"], *[(f"k{i}", "0") for i in range(20)]), 0)
    before = held(versions.snapshot(spark, own))
    publish = versions.Folder.publish

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions.Folder, "publish", die)
    with pytest.raises(RuntimeError):
        sink(rows(spark, [KEY, "status"], *[(f"k{i}", "1") for i in range(10)]), 1)
    assert held(versions.snapshot(spark, own)) == before and len(list((tmp_path / "own/data").iterdir())) == 2
    monkeypatch.setattr(versions.Folder, "publish", publish)
    sink(rows(spark, [KEY, "status"], *[(f"k{i}", "2") for i in range(5)]), 1)
    assert held(versions.snapshot(spark, own)) == before | {f"k{i}": "2" for i in range(5)} and held(versions.snapshot(spark, own, 0)) == before
    assert len(list((tmp_path / "own/data").iterdir())) == 2  # what the lost attempt wrote is gone
    empty = rows(spark, [KEY, "status"]).limit(0)
    sink(empty, 2)
    assert versions.versions(spark, own) == [0, 1, 2] and held(versions.snapshot(spark, own)) == held(versions.snapshot(spark, own, 1))
    none = f"{tmp_path}/none"
    assert versions.snapshot(spark, none) is None
    decisions.upsert_into(spark, none)(empty, 0)
    assert versions.snapshot(spark, none).count() == 0


def test_disk_stays_bounded_over_many_batches(spark, tmp_path):
    own = tmp_path / "own"
    sink = decisions.upsert_into(spark, str(own), buckets=3)
    want, most = {}, 0
    for n in range(20):
        new = {f"k{i * n % 31}": str(n) for i in range(3)}
        sink(rows(spark, [KEY, "status"], *new.items()).coalesce(1), n)
        want |= new
        most = max(most, sum(1 for x in own.glob("data/*/bucket=*")))
    assert held(versions.snapshot(spark, str(own))) == want
    assert most <= 3 * (versions.KEPT + 1) and len(list((own / "manifests").glob("0*"))) == versions.KEPT


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_batch_lost_around_its_commit_is_replayed(spark, tmp_path, monkeypatch, when):
    for k in range(3):
        rows(spark, [KEY, "status"], ("a", str(k)), (f"b{k}", "x")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    start = lambda: decisions.stream_chunk_results(spark, f"{tmp_path}/in", f"{KEY} string, status string", f"{tmp_path}/out", f"{tmp_path}/ck", files=1)
    write, calls = versions.write_version, []

    def lost(*args, **kwargs):
        calls.append(args[3])
        if len(calls) == 2 and when == "before":  # what the batch wrote isn't published
            with monkeypatch.context() as m:
                m.setattr(versions.Folder, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
                return write(*args, **kwargs)
        out = write(*args, **kwargs)
        if len(calls) == 2:  # the version stands, but the stream doesn't know
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(versions, "write_version", lost)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination(120)
    seen = held(versions.snapshot(spark, f"{tmp_path}/out"))
    assert len(seen) == (2 if when == "before" else 3)
    start().awaitTermination(120)
    assert calls == [0, 1, 1, 2] and held(versions.snapshot(spark, f"{tmp_path}/out")) == {"a": "2", "b0": "x", "b1": "x", "b2": "x"}


def test_queue_pages_follow_the_catalogue(spark, sf_dir):
    got = queries.queue(spark, sf_dir).orderBy("place").collect()
    cat = {r[KEY]: int(r["batchIndex"]) for r in adapters.catalogue(spark, sf_dir).collect()}
    assert [r["place"] for r in got] == list(range(1, len(got) + 1)) and [cat[r[KEY]] for r in got] == sorted(cat[r[KEY]] for r in got)
    assert {r["pages"] for r in got} == {-(-len(got) // 100)} and json.dumps([r["page"] for r in got]) == json.dumps([(i // 100) + 1 for i in range(len(got))])


def test_every_sql_query_has_a_twin(spark):
    from catalogue_evidence.plans.oracles import oracle_sql

    assert set(oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", ["f1_f2_f10_best_evidence", "i10_verified", "h5_k1_failures", "k6_queue", "j1_j2_path_problems", "l1_stream", "l2_stream", "a5_a6_image_files", "g1_g4_images"])
def test_against_sql(spark, sf_dir, name):
    import os

    import duckdb

    from catalogue_evidence.plans.oracles import oracle_sql

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{sf_dir}/{f}')")
    cur = con.execute(oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, cur.fetchall()))
