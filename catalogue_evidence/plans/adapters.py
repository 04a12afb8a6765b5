"""Catalogue-shaped tables derived from the shared test tables by fixed rules, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHERE = "array('ca','eu','uk','us')[p_partkey % 4]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue row for each part."""
    key = f"concat({WHERE}, ':p', p_partkey, ':0')"
    return read(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey + 1 as string) as batchIndex", f"{WHERE} as region", f"{key} as immutableKey",
        "concat('p', p_partkey) as productId", "'0' as variantIndex", "p_brand as brand", "p_name as productName",
        "concat(p_size, array(' caps',' ml',' softgel',' g')[cast(floor(p_partkey / 4) % 4 as int)]) as size", "'' as rawSize",
        "'' as format", "'' as sku",
        "concat('https://shop', p_partkey % 37, '.example.com/', case when p_partkey % 11 = 0 then 'shared' else cast(p_partkey as string) end) as sourcePage",
        "concat('supplier', p_partkey % 7, '.example.com') as sourceDomain",
        "case p_partkey % 5 when 0 then 'official-manufacturer-product-page' when 1 then 'barcode-database' else 'third-party-product-page' end as sourceClass",
        "concat('https://img.example.com/', p_partkey % 900, case when p_partkey % 3 = 0 then '.jpg' else '' end) as currentImageReference",
        "p_name as imageAlt", "cast(p_partkey % 11 = 0 as string) as isSharedSourceConflict", "cast(p_partkey % 5 = 1 as string) as isBarcodeDatabaseSource",
        f"left(md5({key}), 24) as assetId", f"concat('assets/product-images/catalogue-v28/', left(md5({key}), 24), '.jpg') as targetJpgPath",
    )


def domain_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, p = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    host = "concat('supplier', l_suppkey % 7, '.example.com') as officialDomain"
    pairs = li.join(p, F.col("l_partkey") == F.col("p_partkey")).filter("l_suppkey % 3 = 0")
    return pairs.selectExpr("p_brand as brand", host).distinct()


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A candidate for each line, of its part's row; a third of them show another part's name."""
    li, p = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    both = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    size = "concat(p_size, array('-caps','-ml','-softgel','-g')[cast(floor(p_partkey / 4) % 4 as int)])"
    cols = both.selectExpr(
        f"concat({WHERE}, ':p', p_partkey, ':0') as immutableKey",
        f"concat('https://www.supplier', l_suppkey % 7, '.example.com/', case l_linenumber % 3 when 0 then replace(p_name, ' ', '-') when 1 then concat(lower(p_brand), '-', replace(p_name, ' ', '%20')) else 'item' end, '-', {size}, '-', l_suppkey, case when l_linenumber % 6 = 5 then '-logo' else '' end, '.jpg') as url",
        "concat('https://www.supplier', l_suppkey % 7, '.example.com/p', l_partkey, case when l_linenumber % 5 = 4 then '?attribute_size=1' else '' end) as page_url",
        "array('jsonld-product-image','shopify-product-json','woocommerce-gallery','og-image','twitter-image','page-img','rss')[l_linenumber % 7] as origin",
        "case when l_linenumber % 2 = 0 then concat(p_brand, ' ', p_name) else p_type end as alt",
        "p_name as page_title", "case when l_linenumber % 7 = 0 then p_name else '' end as structured_product_name",
        "case when l_linenumber % 7 < 2 then p_brand else '' end as structured_brand",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
    )
    order = Window.partitionBy("immutableKey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return cols.withColumn("disc_ord", F.row_number().over(order).cast("long")).drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rendered page shows, an item for each line of its part: repeats, small, bad and odd addresses among them."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat('https://pages.example.com/', l_partkey) as page_url", "l_orderkey * 100 + l_linenumber * 10 + l_suppkey % 10 as disc_ord",
        "concat(case l_linenumber % 6 when 0 then 'data:' when 1 then 'https://cdn.example.com/site-logo' else 'https://cdn.example.com/i' end, l_suppkey % 5, '.jpg') as url",
        "case when l_linenumber % 4 = 0 then 'browser-og' else 'browser-img' end as origin", "l_returnflag as alt", "'' as page_title",
        "cast(case when l_quantity < 5 then null else l_quantity * 20 end as int) as w", "cast(l_quantity * 9 as int) as h",
    )


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An overriding URL for one row in 17, half of them confirmed."""
    c = catalogue(spark, sf_dir)
    n = F.col("batchIndex").cast("long") - 1
    return c.filter(n % 17 == 3).select(
        "immutableKey", F.concat(F.lit("https://cdn.example.com/o"), n.cast("string"), F.lit(".jpg")).alias("approvedDirectImageUrl"),
        F.when(n % 3 == 0, F.lit("https://brand.example.com/p")).otherwise("").alias("approvedSourcePageUrl"),
        F.when(n % 2 == 0, "True").otherwise("false").alias("exactVariantConfirmed"), F.lit("ann").alias("reviewer"),
        F.when(n % 5 == 0, F.lit("")).otherwise(F.concat_ws(" ", "brand", "productName", "size")).alias("evidenceNote"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An acquisition result for each part; digests repeat across parts."""
    c = catalogue(spark, sf_dir)
    n = F.col("batchIndex").cast("long") - 1
    digest = F.sha2(F.concat(F.lit("b"), (n % 1500).cast("string")), 256)
    status = F.when(n % 10 == 9, "UNRESOLVED").when(n % 10 == 8, "ERROR").when(n % 10 < 3, "STAGED_HIGH_CONFIDENCE_NEEDS_VISUAL_REVIEW")
    staged = n % 10 < 8
    put = lambda v: F.when(staged, v).otherwise(F.lit(""))
    return c.select(
        "batchIndex", "immutableKey", "brand", "productName", "size", "targetJpgPath",
        status.otherwise("STAGED_NEEDS_MANUAL_REVIEW").alias("status"),
        put(F.col("currentImageReference")).alias("resolvedImageUrl"), put(F.col("sourcePage")).alias("evidencePage"),
        put(F.lit("page-img")).alias("origin"), put(F.lit("600")).alias("width"), put(F.lit("600")).alias("height"), put(F.lit("9000")).alias("bytes"),
        put(digest).alias("sha256"), put(F.substring(F.md5((n % 1200).cast("string")), 1, 16)).alias("perceptualHash"),
        F.lit("1.0").alias("pageBrandCoverage"), F.lit("1.0").alias("pageProductCoverage"), F.lit("true").alias("exactSizeEvidence"),
        F.lit("90").alias("imageCandidateScore"), F.lit("false").alias("autoApprovalEligible"), F.lit("").alias("reason"),
        put(F.concat(F.lit("staging/"), "batchIndex")).alias("stagingPath"),
    )


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review sheet with decisions of people and machines."""
    from catalogue_evidence.operators import review as r

    n = F.col("batchIndex").cast("long") - 1
    decision = F.when(n % 4 == 0, r.APPROVED).when(n % 4 == 1, r.REJECTED).when(n % 8 == 2, r.REVIEW).when(n % 8 == 6, "").otherwise(r.PENDING)
    flags = [F.when((n % 4 == 0) & (n % (40 + 8 * k) != 0), F.lit("True")).otherwise(F.lit("")).alias(f) for k, f in enumerate(r.FLAGS)]
    reviewed = [F.when((n % 4 == 0) & (n % 60 != 0), F.col(x)).otherwise(F.lit("")).alias(f) for f, x in r.REVIEWED.items()]
    return results(spark, sf_dir).filter(n % 9 != 7).select(
        *r.RESULT, decision.alias("manualVisualDecision"), F.when(n % 8 == 0, "ann").otherwise("gemini-api").alias("reviewer"), F.lit("note").alias("evidenceNote"), *flags, *reviewed
    )


def verifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verification for every other staged result, of each decision and confidence, some failed."""
    from catalogue_evidence.operators.review import CHECKS

    n = F.col("batchIndex").cast("long") - 1
    decision = F.when(n % 3 == 0, "APPROVE").when(n % 3 == 1, "REJECT").otherwise("REVIEW")
    checks = [F.when(n % 17 != k, n % 19 != k).alias(c) for k, c in enumerate(CHECKS)]
    payload = F.to_json(F.struct(decision.alias("decision"), (85 + n % 16).cast("int").alias("confidence"), *checks, F.concat(F.lit("why "), n.cast("string")).alias("reason"), F.lit("seen").alias("evidence")))
    ok = n % 23 != 0
    return results(spark, sf_dir).filter((n % 2 == 0) & F.col("status").startswith("STAGED")).select(
        "immutableKey", F.when(ok, "OK").otherwise("ERROR").alias("status"), F.when(ok, payload).alias("payload"), F.when(~ok, "timeout").otherwise("").alias("error")
    )


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("batchIndex").cast("long") - 1
    return results(spark, sf_dir).filter((n % 6 == 0) & F.col("status").startswith("STAGED")).select(
        "immutableKey", "resolvedImageUrl", "evidencePage", F.lit("old").alias("reason"), F.lit("").alias("aiConfidence"), F.lit("t0").alias("rejectedAt")
    )


def decision_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People's decisions: each event decides on the row of its user's number."""
    e = read(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "purchase", "approve").when(F.col("event_type") == "error", "reject").otherwise("skip")
    c = catalogue(spark, sf_dir).select("immutableKey", (F.col("batchIndex").cast("long") - 1).alias("n"))
    return e.join(c, F.col("user_id") == F.col("n")).select("event_id", "ts", "immutableKey", kind.alias("decision"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target paths with a fault in some rows."""
    n = F.col("batchIndex").cast("long") - 1
    p = F.col("targetJpgPath")
    path = (
        F.when(n % 97 == 1, "").when(n % 97 == 2, F.concat(F.lit("/"), p)).when(n % 97 == 3, F.replace(p, F.lit("/"), F.lit("\\")))
        .when(n % 97 == 4, F.concat(F.lit("../"), p)).when(n % 97 == 5, F.concat(F.lit("assets/"), "assetId", F.lit(".png")))
        .when(n % 97 == 6, "assets/product-images/catalogue-v28/000000000000000000000000.jpg").otherwise(p)
    )
    return catalogue(spark, sf_dir).select((n + 1).alias("row_no"), "immutableKey", "assetId", path.alias("targetJpgPath"))


def store_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, error, sha256) of the store's files: most staged ones, and most final ones."""
    r = results(spark, sf_dir)
    n = F.col("batchIndex").cast("long") - 1
    sha = F.when(n % 31 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("sha256"))
    s = r.filter((F.col("stagingPath") != "") & (n % 29 != 0)).select(F.col("stagingPath").alias("path"), F.when(n % 37 == 0, "undecodable").otherwise("").alias("error"), sha.alias("sha256"))
    f = r.filter(n % 41 != 0).select(F.col("targetJpgPath").alias("path"), F.when(n % 43 == 0, "undecodable").otherwise("").alias("error"), F.col("sha256"))
    return s.unionByName(f)


def regional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional catalogue rows; productId and variantIndex make up the key with the region."""
    return catalogue(spark, sf_dir).select(
        "region", "productId", "variantIndex", F.col("currentImageReference").alias("imageSrc"), F.lit("external").alias("imageKind"), F.lit("False").alias("imageTrusted"),
        F.lit("none").alias("imageResolutionMethod"), F.lit("OLD").alias("imageMatchStatus"), F.when(F.col("batchIndex").cast("long") % 2 == 0, "kept").otherwise("").alias("imageNotes"), "productName",
    )


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_url, html): the raw pages, with images and product records put in by page_id."""
    img = "concat('<meta property=\"og:image\" content=\"/og', page_id % 3, '.png\"><img class=\"wp-post-image\" src=\"/p', page_id, '.jpg\" alt=\"Item ', page_id, '\" srcset=\"/p', page_id, '.jpg 1x, //cdn.example.com/q', page_id, '.jpg 2x\"><img src=\"/site-logo.png\">')"
    ld = "concat('<script type=\"application/ld+json\">{\"@graph\":[{\"@type\":[\"Thing\",\"product\"],\"name\":\"Item ', page_id, '\",\"brand\":{\"name\":\"B', page_id % 5, '\"},\"image\":[\"/ld', page_id, '.jpg\"]}]}</script>')"
    return read(spark, sf_dir, "pages").selectExpr("page_id", f"concat('https://pages.example.com/', page_id) as page_url", f"concat(html, {img}, {ld}) as html")


#: Images that drawings() makes, by supplier number in turn: pixels of a cell across and down, and bytes of the image.
#: Images are eight by eight cells; sizes are such that every byte of the file is ASCII.
GRIDS = [(40, 40, 5888)] * 6 + [(13, 13, 2048), (32, 192, 27904)]
BLANK, BROKEN, TINY = 5, 8, 9  # places in turn: of one colour, not an image, and shorter than any image may be
TURNS = 10


def cell_colour(k: Column, cell: Column, channel: int) -> Column:
    """0 to 126, for the red (0), green (1) or blue (2) of a cell."""
    return (k * 37 + cell * cell * 11 + cell * (k % 13) * 29 + channel * 53) % 127


def drawings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, content): a run-length coded bitmap of 64 colours for each supplier, as text of ASCII characters. Keys are
    dealt out before anything is drawn: a table of few bytes is read by one task, however many rows it has."""
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = read(spark, sf_dir, "supplier").select("s_suppkey").repartition(parts, "s_suppkey").select("s_suppkey", F.col("s_suppkey").cast("long").alias("k"))
    turn = (F.col("k") % TURNS).cast("int")
    grid = F.array(*[F.array(*map(F.lit, g)) for g in GRIDS])
    s = s.withColumn("turn", turn).withColumn("g", F.coalesce(F.get(grid, turn), F.array(F.lit(1), F.lit(1), F.lit(1))))
    wide, high, size = (F.col("g")[i] for i in range(3))
    short = lambda n: F.concat(F.char(n % 256), F.char(F.floor(n / 256)))
    whole = lambda n: F.concat(short(n), F.repeat(F.char(F.lit(0)), 2))
    zero = F.char(F.lit(0))
    head = F.concat(
        F.lit("BM"), whole(size + 310), whole(F.lit(0)), whole(F.lit(310)), whole(F.lit(40)), whole(wide * 8), whole(high * 8),
        short(F.lit(1)), short(F.lit(8)), whole(F.lit(1)), whole(size), whole(F.lit(0)), whole(F.lit(0)), whole(F.lit(64)), whole(F.lit(64)),
    )
    cells = F.sequence(F.lit(0), F.lit(63))
    own = lambda i: F.when(F.col("turn") == BLANK, F.lit(0)).otherwise(i)
    palette = F.array_join(F.transform(cells, lambda i: F.concat(*[F.char(cell_colour(F.col("k"), own(i), c)) for c in (2, 1, 0)], zero)), "")
    line = lambda y: F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda x: F.concat(F.char(wide), F.char(y * 8 + x))), ""), zero, zero)
    lines = F.array_join(F.transform(F.sequence(F.lit(7), F.lit(0), F.lit(-1)), lambda y: F.repeat(line(y), high)), "")  # from the bottom up
    image = F.rpad(F.concat(lines, zero, F.char(F.lit(1))), size, zero)
    content = F.when(F.col("turn") == BROKEN, F.repeat(F.lit("x"), 3000)).when(F.col("turn") == TINY, F.lit("tiny")).otherwise(F.concat(head, palette, image))
    return s.select("s_suppkey", content.alias("content"))
