"""Catalogue rows to candidates: domains, pages to visit, and the union of all candidate sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogue_evidence.functions import urls
from catalogue_evidence.functions.text import norm_text, significant_tokens
from catalogue_evidence.operators.skew import skew_join

KEY = "immutableKey"
#: A candidate's columns beside the row's key and its place of discovery.
CANDIDATE = ["url", "page_url", "origin", "alt", "page_title", "structured_product_name", "structured_brand"]
PAGES, SEARCH_PAGES, RENDERED_PAGES, RENDERED_VISITS = 3, 8, 6, 4


def is_true(c: str) -> Column:
    return F.coalesce(F.lower(F.col(c)) == "true", F.lit(False))


def text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def filled(c: str, key: str = KEY) -> Column:
    """A column to join by: blank and null values become the row's own key, which nothing matches, so that rows without a
    value don't all meet in one task."""
    return F.when(text(c) == "", F.concat(F.lit("\0"), text(key))).otherwise(F.col(c))


def official_domains(catalogue: DataFrame, domain_map: DataFrame) -> DataFrame:
    """catalogue with domains: those of the row's brand, and the row's own on an official manufacturer's page."""
    pairs = domain_map.select(norm_text(F.col("brand")).alias("_brand"), F.lower("officialDomain").alias("d"))
    sets = pairs.groupBy("_brand").agg(F.array_sort(F.collect_set("d")).alias("_domains"))
    own = F.when(
        (F.col("sourceClass") == "official-manufacturer-product-page") & (text("sourceDomain") != ""),
        F.array(F.lower("sourceDomain")),
    ).otherwise(F.array().cast("array<string>"))
    out = catalogue.withColumn("_key", norm_text(F.col("brand"))).join(sets, F.col("_key") == F.col("_brand"), "left")
    domains = F.array_union(F.coalesce("_domains", F.array().cast("array<string>")), own)
    return out.withColumn("domains", domains).select(*catalogue.columns, "domains")


def pages_for_row(catalogue: DataFrame) -> DataFrame:
    """(immutableKey, page_ord, page_url): up to three pages of each row, its source page before its unwrapped
    reference; none that are shared by incompatible rows, barcode databases, or on domains that prove nothing."""
    shared = is_true("isSharedSourceConflict")
    source = F.when(~shared & ~is_true("isBarcodeDatabaseSource") & (text("sourcePage") != ""), F.col("sourcePage"))
    target = urls.decode_resolver(text("currentImageReference"))
    decoded = F.when(~shared & (target != "") & ~urls.is_bad_page_domain(urls.canonical_domain(target)), target)
    pages = catalogue.select(KEY, F.array_distinct(F.array_compact(F.array(source, decoded))).alias("pages"))
    return pages.select(KEY, F.posexplode(F.slice("pages", 1, PAGES)).alias("page_ord", "page_url"))


def override_candidates(catalogue: DataFrame, overrides: DataFrame) -> DataFrame:
    """A candidate for each row with an overriding URL; the reviewer's note is its alt text."""
    o = overrides.filter(text("approvedDirectImageUrl") != "").select(
        F.col(KEY).alias("_k"), "approvedDirectImageUrl", "approvedSourcePageUrl", "evidenceNote"
    )
    page = F.coalesce(F.nullif(F.col("approvedSourcePageUrl"), F.lit("")), F.col("sourcePage"))
    return catalogue.join(o, catalogue[KEY] == o["_k"]).select(
        KEY, F.lit(0).cast("long").alias("disc_ord"), F.col("approvedDirectImageUrl").alias("url"), page.alias("page_url"),
        F.lit("manual-override").alias("origin"), text("evidenceNote").alias("alt"), *_blank("page_title", "structured_product_name", "structured_brand"),
    )


def direct_candidates(catalogue: DataFrame) -> DataFrame:
    """A candidate for each row whose current reference is an image by its URL and no resolver's."""
    url = F.col("currentImageReference")
    fits = url.startswith("http") & ~url.contains(urls.RESOLVER) & urls.is_direct_image_url(url)
    page = F.coalesce(F.nullif(F.col("sourcePage"), F.lit("")), url)
    return catalogue.filter(fits).select(
        KEY, F.lit(0).cast("long").alias("disc_ord"), url.alias("url"), page.alias("page_url"),
        F.lit("direct-current-image").alias("origin"), text("imageAlt").alias("alt"), *_blank("page_title", "structured_product_name", "structured_brand"),
    )


def _blank(*names: str) -> list[Column]:
    return [F.lit("").alias(n) for n in names]


def join_page_candidates(row_pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates of each row's pages. Pages are parsed once and shared by all rows that name them, however many these
    are: rows of a page that many share are dealt out. Page bodies, which no score uses, don't travel. candidates:
    (visited, disc_ord, CANDIDATE)."""
    rows = row_pages.select(KEY, "page_ord", F.col("page_url").alias("_asked"))
    met = skew_join(rows, candidates.select("visited", "disc_ord", *CANDIDATE), "_asked", "visited")
    order = F.col("page_ord").cast("long") * 1_000_000 + F.col("disc_ord")
    return met.select(KEY, order.alias("disc_ord"), *CANDIDATE)


def assemble_candidates(*sources: DataFrame) -> DataFrame:
    """(immutableKey, disc_ord, CANDIDATE): the union of candidate sources in order, the first of each row's URL kept.

    disc_ord becomes the place of discovery over all sources, from 1. Empty and bad URLs drop out.
    """
    cols = [KEY, "disc_ord", *CANDIDATE]
    union = None
    for i, s in enumerate(sources):
        one = s.select(*cols).withColumn("_source", F.lit(i))
        union = one if union is None else union.unionByName(one)
    good = union.filter((text("url") != "") & ~urls.is_bad_image_url(F.col("url")))
    first = good.groupBy(KEY, "url").agg(F.min(F.struct("_source", "disc_ord", *[c for c in CANDIDATE if c != "url"])).alias("first"))
    place = F.row_number().over(Window.partitionBy(KEY).orderBy("first._source", "first.disc_ord", "url"))
    return first.select(KEY, place.alias("disc_ord"), *[F.col("url") if c == "url" else F.col(f"first.{c}") for c in CANDIDATE])


def flag_rejected(candidates: DataFrame, rejected: DataFrame, **flags: str) -> DataFrame:
    """candidates with flags, flag=column: whether the row's (immutableKey, that column) is among the rejected ones.

    One join serves all flags. A row has few rejected URLs, at most those of its candidates; blank keys have none."""
    known = rejected.filter(text(KEY) != "").groupBy(F.col(KEY).alias("_k")).agg(F.collect_set("resolvedImageUrl").alias("_bad"))
    out = candidates.join(known, candidates[KEY] == known["_k"], "left")
    return out.select(*candidates.columns, *[F.coalesce(F.array_contains("_bad", F.col(c)), F.lit(False)).alias(n) for n, c in flags.items()])


def latest_by_key(df: DataFrame, order: str, key: str = KEY) -> DataFrame:
    """The last row of each key by order; rows with a blank key drop out."""
    best = df.filter(text(key) != "").groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*df.columns), order).alias("_row"))
    return best.select("_row.*")


def rank_search_results(results: DataFrame, catalogue: DataFrame, rendered: bool = False) -> DataFrame:
    """(immutableKey, page_ord, page_url): the search results worth a visit, those on preferred domains first.

    results: (immutableKey, rank, href, title); catalogue: with brand, productName and domains. A result must share a
    token with the brand or product, or lie on a preferred domain; no tokens ask for nothing. The first of equal URLs
    counts. rendered: results of a rendered search, of which only some hosts are left out.
    """
    rows = catalogue.select(
        F.col(KEY).alias("_k"), "domains",
        F.array_union(significant_tokens(F.col("brand")), significant_tokens(F.col("productName"))).alias("tokens"),
    )
    r = results.withColumn("href", urls.decode_search_redirect(F.col("href"))).filter(text("href").rlike("(?i)^https?://"))
    r = r.withColumn("dom", urls.canonical_domain(F.col("href")))
    r = r.withColumn("words", F.regexp_extract_all(F.lower(F.concat_ws(" ", text("title"), "href")), F.lit("([a-z0-9]+)"), F.lit(1)))
    r = r.join(rows, r[KEY] == rows["_k"])
    if rendered:
        keep, most = ~F.col("dom").rlike("|".join(x.replace(".", r"\.") for x in urls.RENDERED_SKIP)), RENDERED_PAGES
    else:
        fits = (F.size("tokens") == 0) | F.arrays_overlap("words", "tokens") | urls.is_official(F.col("dom"), F.col("domains"))
        keep, most = ~urls.is_bad_page_domain(F.col("dom")) & fits, SEARCH_PAGES
    preferred = F.when(urls.is_official_loose(F.col("dom"), F.col("domains")), 0).otherwise(1)
    once = r.filter(keep).groupBy(KEY, F.col("href").alias("page_url")).agg(F.min("rank").alias("rank"), F.min(preferred).alias("p"))
    place = F.row_number().over(Window.partitionBy(KEY).orderBy("p", "rank", "page_url"))
    return once.withColumn("page_ord", place).filter(F.col("page_ord") <= most).select(KEY, "page_ord", "page_url")


def needs_search(catalogue: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows without a candidate, from a barcode database, or whose source is shared by incompatible rows."""
    have = candidates.select(F.col(KEY).alias("_k")).distinct()
    out = catalogue.join(have, catalogue[KEY] == have["_k"], "left")
    return out.filter(F.col("_k").isNull() | is_true("isBarcodeDatabaseSource") | is_true("isSharedSourceConflict")).drop("_k")
