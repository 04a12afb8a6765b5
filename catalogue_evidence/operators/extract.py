"""Candidates from raw pages: one Arrow helper parses each distinct page once and returns its rows."""

from __future__ import annotations

import html
import json
import re
import urllib.parse
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogue_evidence.functions import urls

# How much of a page's text counts, where image addresses stand, and classes of product images.
PAGE_TEXT = 250_000
SOURCES = ("data-large_image", "data-zoom-image", "data-src", "data-lazy-src", "data-original", "src")
GALLERY = ("wp-post-image", "woocommerce", "product")
SPACE = re.compile(r"\s+")
FOUND = "page_url string, disc_ord long, url string, origin string, alt string, page_title string, structured_product_name string, structured_brand string"


def clean_url(value: str | None, base: str) -> str:
    """An absolute http or https URL, or nothing."""
    if not value:
        return ""
    value = html.unescape(value.strip())
    try:
        full = urllib.parse.urljoin(base, "https:" + value if value.startswith("//") else value)
        return full if urllib.parse.urlparse(full).scheme in ("http", "https") else ""
    except ValueError:
        return ""


class Page(HTMLParser):
    """Title, visible text, JSON-LD scripts, and the tags that name images, in order of the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: list[str] = []
        self.text: list[str] = []
        self.scripts: list[str] = []
        self.tags: list[tuple[str, dict[str, str]]] = []
        self.inside = ""
        self.titled = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in reversed(attrs)}  # of repeated attributes the first
        if tag == "script":
            self.inside = "ld" if a.get("type") == "application/ld+json" else "code"
            if self.inside == "ld":
                self.scripts.append("")
        elif tag == "style":
            self.inside = "code"
        elif tag == "title" and not self.titled:
            self.inside, self.titled = "title", True
        elif tag in ("meta", "link", "img"):
            self.tags.append((tag, a))

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "title"):
            self.inside = ""

    def handle_data(self, data: str) -> None:
        if self.inside == "ld":
            self.scripts[-1] += data
        elif self.inside == "title":
            self.title.append(data), self.text.append(data)
        elif not self.inside:
            self.text.append(data)

    @classmethod
    def of(cls, source: str) -> Page:
        page = cls()
        page.feed(source)
        page.close()
        return page

    def words(self, parts: list[str]) -> str:
        return SPACE.sub(" ", " ".join(p.strip() for p in parts if p.strip())).strip()


def products(scripts: list[str]) -> list[dict]:
    """Objects of type product, in any case and among other types, in lists and graphs; a bad script has none."""
    out: list[dict] = []

    def walk(node: object) -> None:
        if isinstance(node, list):
            for x in node:
                walk(x)
        elif isinstance(node, dict):
            kinds = node.get("@type")
            if any(str(k).lower() == "product" for k in (kinds if isinstance(kinds, list) else [kinds])):
                out.append(node)
            if isinstance(node.get("@graph"), list):
                walk(node["@graph"])

    for s in scripts:
        try:
            walk(json.loads(s))
        except (ValueError, RecursionError):
            continue
    return out


def found_on(page: Page, base: str) -> list[tuple[str, str, str, str, str]]:
    """(url, origin, alt, product name, brand) of all images that a page names, in order of discovery."""
    out: list[tuple[str, str, str, str, str]] = []

    def add(value: object, origin: str, alt: str = "", name: str = "", brand: str = "") -> None:
        if u := clean_url(str(value or ""), base):
            out.append((u, origin, alt, name, brand))

    for p in products(page.scripts):
        name, brand, images = str(p.get("name") or ""), p.get("brand") or "", p.get("image") or []
        brand = str(brand.get("name") if isinstance(brand, dict) else brand)
        for image in images if isinstance(images, list) else [images]:
            add(image.get("url") or image.get("contentUrl") if isinstance(image, dict) else image, "jsonld-product-image", name, name, brand)
    wanted = [("meta", "property", "og:image", "content", "og-image"), ("meta", "property", "og:image:secure_url", "content", "og-image")]
    wanted += [("meta", "name", "twitter:image", "content", "twitter-image"), ("link", "rel", "image_src", "href", "image-src-link")]
    for tag, attribute, value, holder, origin in wanted:
        for t, a in page.tags:
            if t == tag and a.get(attribute) == value:
                add(a.get(holder), origin)
    for t, a in page.tags:
        if t == "img":
            alt = " ".join(x for x in (a.get("alt"), a.get("title"), a.get("data-caption")) if x)
            origin = "woocommerce-gallery" if any(g in a.get("class", "").lower() for g in GALLERY) else "page-img"
            for s in SOURCES:
                add(a.get(s), origin, alt)
            for s in ("srcset", "data-srcset"):
                for part in a.get(s, "").split(","):
                    add(part.split()[0] if part.strip() else "", origin + "-srcset", alt)
    return out


def _balanced(pages: DataFrame) -> DataFrame:
    """Pages dealt out by URL and content, each (page_url, html) once; repeats are told by hash and length."""
    each = pages.select(F.col("page_url").cast("string"), F.col("html").cast("string"))
    known = each.select("*", F.xxhash64("html").alias("_hash"), F.length("html").alias("_n"))
    return known.dropDuplicates(["page_url", "_hash", "_n"]).drop("_hash", "_n")


def written_title(source: Column) -> Column:
    """The title that a pattern finds in a page's source, up to the next tag: references to the three marks of markup are
    resolved, all others stay as they are written, also those cut short; empty without a title, null of a null page.
    page_text() has the title as browsers show it."""
    c = F.regexp_extract(source, "<title>([^<]*)</title>", 1)
    for was, now in {"&lt;": "<", "&gt;": ">", "&amp;": "&"}.items():  # the ampersand's last, so that nothing is resolved twice
        c = F.replace(c, F.lit(was), F.lit(now))
    return F.regexp_replace(F.regexp_replace(c, r"[\t\n\f\r ]+", " "), r"^\p{Zs}+|\p{Zs}+$", "")


def page_text(pages: DataFrame) -> DataFrame:
    """(page_url, title, text) of (page_url, html): white space collapsed, text cut at 250,000 characters; of a null
    page both are empty. Equal rows give one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 128):
                some = batch.slice(i, 128)
                made = [Page.of(h or "") for h in some.column(1).to_pylist()]
                cols = [pa.array([p.words(p.title) for p in made], pa.string()), pa.array([p.words(p.text)[:PAGE_TEXT] for p in made], pa.string())]
                yield pa.RecordBatch.from_arrays([some.column(0), *cols], names=["page_url", "title", "text"])

    return _balanced(pages).mapInArrow(run, "page_url string, title string, text string")


def jsonld_products(pages: DataFrame) -> DataFrame:
    """(page_url, ord, name, brand, json) of the products that a page's JSON-LD describes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, p in enumerate(products(Page.of(source or "").scripts)):
                    brand = p.get("brand") or ""
                    rows.append((url, k, str(p.get("name") or ""), str(brand.get("name") if isinstance(brand, dict) else brand), json.dumps(p)))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(cols, names=["page_url", "ord", "name", "brand", "json"])

    return _balanced(pages).mapInArrow(run, "page_url string, ord long, name string, brand string, json string")


def extract_candidates(pages: DataFrame) -> DataFrame:
    """Rows of FOUND for every image that the pages name, with bad URLs and repeats still in it.

    Later sources of a page take up where earlier ones end, so disc_ord is unique in a page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 128):
                some = batch.slice(i, 128)
                rows = []
                for url, source in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    page = Page.of(source or "")
                    title = page.words(page.title)
                    rows += [(url, k, u, origin, alt, title, name, brand) for k, (u, origin, alt, name, brand) in enumerate(found_on(page, url or ""))]
                kinds = [pa.string(), pa.int64(), *[pa.string()] * 6]
                names = ["page_url", "disc_ord", "url", "origin", "alt", "page_title", "structured_product_name", "structured_brand"]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    return _balanced(pages).mapInArrow(run, FOUND)


def extract_store_json(payloads: DataFrame) -> DataFrame:
    """Rows of FOUND from (page_url, json): a store's product record, its featured image first."""
    p = F.from_json("json", "title string, vendor string, featured_image string, images array<string>")
    rows = payloads.withColumn("p", p).filter(F.col("p").isNotNull() & F.col("page_url").contains("/products/"))
    images = F.coalesce("p.images", F.array().cast("array<string>"))
    first = F.coalesce(F.col("p.featured_image"), F.lit("")) != ""
    each = rows.select("page_url", "p", F.posexplode(F.when(first, F.concat(F.array("p.featured_image"), images)).otherwise(images)).alias("k", "raw"))
    value = F.trim("raw")
    origin = F.regexp_extract("page_url", "^(https?://[^/?#]+)", 1)
    url = (
        F.when(value.startswith("//"), F.concat(F.lit("https:"), value)).when(value.startswith("/"), F.concat(origin, value))
        .when(value.rlike("^https?://"), value)
    )
    name, vendor = F.coalesce("p.title", F.lit("")), F.coalesce("p.vendor", F.lit(""))
    return each.select(
        "page_url", F.col("k").cast("long").alias("disc_ord"), url.alias("url"), F.lit("shopify-product-json").alias("origin"),
        name.alias("alt"), F.lit("").alias("page_title"), name.alias("structured_product_name"), vendor.alias("structured_brand"),
    ).filter(F.coalesce("url", F.lit("")) != "")


def store_slug(page_url: Column) -> Column:
    """The store and product that a page's or a payload's URL names, empty without one."""
    store, slug = (F.regexp_extract(page_url, r"^(https?://[^/]+)[^?#]*?/products/([^/?#]+)", k) for k in (1, 2))
    return F.when(slug != "", F.concat_ws(" ", F.lower(store), F.regexp_replace(slug, r"\.js(on)?$", ""))).otherwise("")


def payloads_of_pages(pages: DataFrame, payloads: DataFrame) -> DataFrame:
    """(page_url, json): the payloads of each page's store and product, whatever URL of it they were fetched from."""
    own = payloads.select(store_slug(F.col("page_url")).alias("_slug"), "json").filter("_slug <> ''").distinct()
    asked = pages.select("page_url").distinct().withColumn("_asked", store_slug(F.col("page_url"))).filter("_asked <> ''")
    return asked.join(own, F.col("_asked") == F.col("_slug")).select("page_url", "json")


def image_responses(pages: DataFrame, fetched: DataFrame) -> DataFrame:
    """Rows of FOUND for pages that turn out to be an image themselves."""
    images = fetched.filter(F.lower(F.coalesce("content_type", F.lit(""))).startswith("image/")).select(F.col("url").alias("_url"), "final_url")
    both = pages.select("page_url").distinct().join(images, F.col("page_url") == F.col("_url"))
    blank = [F.lit("").alias(c) for c in ("alt", "page_title", "structured_product_name", "structured_brand")]
    return both.select("page_url", F.lit(0).cast("long").alias("disc_ord"), F.col("final_url").alias("url"), F.lit("direct-image-response").alias("origin"), *blank)


def dedup_page_candidates(candidates: DataFrame) -> DataFrame:
    """Each page's URLs once: with the longest alt text, of ties the first, at the place of the first; bad URLs drop out."""
    good = candidates.filter((F.col("url") != "") & ~urls.is_bad_image_url(F.col("url")))
    rest = [c for c in candidates.columns if c not in ("page_url", "url", "disc_ord")]
    best = good.groupBy("page_url", "url").agg(
        F.max_by(F.struct(*rest), F.struct(F.length("alt"), -F.col("disc_ord"))).alias("b"), F.min("disc_ord").alias("disc_ord")
    )
    return best.select(*[F.col(f"b.{c}").alias(c) if c in rest else F.col(c) for c in candidates.columns])


def rendered_candidates(items: DataFrame) -> DataFrame:
    """The first row of each page's URL of (page_url, disc_ord, url, origin, alt, page_title, w, h), without addresses
    off the web and, of page images, bad URLs and those known to be under 180 wide or high. An og-image's row stays."""
    og = F.col("origin") == "browser-og"
    w, h = F.coalesce("w", F.lit(0)), F.coalesce("h", F.lit(0))
    small = (w != 0) & (h != 0) & (F.least(w, h) < 180)
    good = items.filter(og | (F.col("url").startswith("http") & ~urls.is_bad_image_url(F.col("url")) & ~small))
    first = F.row_number().over(Window.partitionBy("page_url", "url").orderBy("disc_ord"))
    return good.withColumn("_n", first).filter("_n = 1").drop("_n", "w", "h")
