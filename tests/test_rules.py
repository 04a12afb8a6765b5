import pytest
from pyspark.sql import functions as F

from catalogue_evidence.functions import text, urls


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def held(spark, columns, **values):
    """A column over a row of given values, made columns by themselves first."""
    df = spark.range(1).select(*[v.alias(k) for k, v in values.items()])
    return df.select(columns.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("Vitamin&nbsp;D™ 60 Capsules", "vitamin d 60 caps"),
        ("programs", "prog"),
        ("60 softgels", "60 softgelss"),
        ("8 fluid ounces", "8 fluid oz"),
        (None, ""),
    ],
)
def test_norm(spark, given, want):
    assert value(spark, text.norm_text(F.lit(given).cast("string"))) == want


def test_tokens_and_coverage(spark):
    assert value(spark, text.significant_tokens(F.lit("The Exact-Product 5 Plus"))) == ["exact", "product"]
    cover = text.token_coverage(F.col("need"), F.col("hay"))
    tokens = text.significant_tokens
    assert held(spark, cover, need=tokens(F.lit("the")), hay=tokens(F.lit("x"))) == 1.0
    assert held(spark, cover, need=tokens(F.lit("aa aa bb")), hay=tokens(F.lit("aa"))) == pytest.approx(2 / 3)


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("30 ml", {"30ml", "1floz"}), ("2 x 30 caps", {"2x30", "30caps"}), ("1,000 mg", {"000mg"}), ("60 softgels", set()), ("60 softgel", {"60softgels"}),
        ("60 soft gels", {"60softgels"}), ("60 vcaps", {"60caps"}), ("60 veg capsules", set()), ("1 fl oz", {"1floz"}), ("5 billion", {"5billion"}), ("", set()),
    ],
)
def test_sizes(spark, given, want):
    assert set(value(spark, text.size_signatures(F.lit(given)))) == want


@pytest.mark.parametrize(("want", "seen", "match"), [("60 softgels", "x", True), ("60 caps", "exact-60-capsules.jpg", True), ("60 caps", "120 caps", False), ("", "", True)])
def test_size_match(spark, want, seen, match):
    s = text.size_signatures
    assert held(spark, text.exact_size_match(F.col("a"), F.col("b")), a=s(F.lit(want)), b=s(F.lit(seen))) is match


def test_small_text_rules(spark):
    assert value(spark, text.append_note(F.lit(""), "done")) == "done"
    assert value(spark, text.append_note(F.lit("kept"), "done")) == "kept | done"
    assert value(spark, text.image_src(F.lit("a\\b/c.jpg"))) == "/a/b/c.jpg"
    assert value(spark, text.staging_path(F.lit("7"), F.lit("a/b.jpg"))) == "00007_b.jpg"
    assert value(spark, text.staging_path(F.lit("1234567"), F.lit("b.jpg"))) == "1234567_b.jpg"
    assert value(spark, text.is_truthy(F.lit(" Yes "))) is True and value(spark, text.is_truthy(F.lit(None).cast("string"))) is False


def test_urls(spark):
    one = lambda f, *x: value(spark, f(*[F.lit(v) for v in x]))
    assert one(urls.canonical_domain, "https://www.A.com:80/x") == "a.com" and one(urls.canonical_domain, "nothing") == ""
    domains = F.array(F.lit("foo.com"))
    assert value(spark, urls.is_official(F.lit("notfoo.com"), domains)) is False
    assert value(spark, urls.is_official(F.lit("a.foo.com"), domains)) is True
    assert value(spark, urls.is_official_loose(F.lit("notfoo.com"), domains)) is True
    assert [one(urls.is_bad_image_url, u) for u in ("/logo.png", "/silicon.jpg", "/%63ollections/x.jpg", "/p.jpg")] == [True, True, True, False]
    assert one(urls.url_unquote, "a%20b+c") == "a b+c" and one(urls.url_unquote, "a%zzb") == "a%zzb"
    assert one(urls.decode_resolver, "https://api.microlink.io/?url=https%3A%2F%2Fa.com%2Fx&b=1") == "https://a.com/x"
    assert one(urls.decode_resolver, "https://a.com/y") == "https://a.com/y"
    assert one(urls.decode_search_redirect, "https://s.com/ck/a?u=a1aHR0cHM6Ly9hLmNvbS94&p=1") == "https://a.com/x"
    assert one(urls.decode_search_redirect, "https://s.com/ck/a?u=a1%2A") is None
    assert one(urls.barcode_of, "https://www.barcodelookup.com/0123456789012") == "0123456789012"
    assert one(urls.is_direct_image_url, "/a.JPEG?x=1") and not one(urls.is_direct_image_url, "/a.jpgx")


def test_search_query(spark):
    args = [F.lit(x) for x in ("B", "P", "60 caps", "", "S1", "https://barcodelookup.com/12345678")]
    none = F.array().cast("array<string>")
    assert value(spark, urls.search_query(none, *args)) == '"B" "P" "60 caps" "S1" buy product 12345678'
    some = F.array(*[F.lit(d) for d in ("d.com", "c.com", "b.com", "a.com")])
    assert value(spark, urls.search_query(some, *args)) == "(site:a.com OR site:b.com OR site:c.com) P 60 caps 12345678"


def test_references_are_resolved_like_the_standard_library(spark):
    import html
    import random
    from html.entities import html5

    rng = random.Random(2)
    names = sorted(html5)
    parts = ["&", "#", ";", "x", "X", " ", "a", "b1", "&#", "&#x", "&amp;", "&am", "mp;", "<", "é", "\n", "\U0001f600", "&" + "a" * 40]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(1500)]
    texts += [f"a&{n}b" for n in names] + [f"&{n.rstrip(';')}{rng.choice(['x', ';', ' ', '&', '1', ''])}" for n in names]
    texts += [f"&#{n}{e}" for n in [*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 10**30] for e in (";", "", "z")]
    texts += [f"&#x{n:x};&#X{n:X}" for n in [*range(300), 0xD800, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000, 16**20]] + ["&#000000000065;", "&#x0000000041;", "&#", "&#;", "&#x;", "", "&", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["u"] for r in df.select("t", text.unescape(F.col("t")).alias("u")).collect()]
    wrong = [(t, html.unescape(t), u) for t, u in zip(texts, got) if t is not None and html.unescape(t) != u]
    assert not wrong and got[-1] is None


def test_bad_urls_are_found_word_by_word(spark):
    """As the pattern of all words finds them, in either case and behind escapes; without that pattern in the plan."""
    words = [*urls.BAD_URL_WORDS, *urls.SITE_DEFAULTS]
    given = [f"https://x.com/a{w.upper()}b.jpg" for w in words] + [f"https://x.com/%{ord(w[0]):02x}{w[1:]}" for w in words] + ["https://x.com/lo-go.jpg", "/%zzlogo", "a+icon", "", None]
    df = spark.createDataFrame([(u,) for u in given], "u string")
    want = F.coalesce(F.lower(urls.url_unquote(F.col("u"))).rlike("|".join(words)), F.lit(False))
    got = df.select(urls.is_bad_image_url(F.col("u")).alias("bad"), want.alias("want")).collect()
    assert all(r["bad"] == r["want"] for r in got) and sum(r["bad"] for r in got) == 2 * len(words) + 2
    assert "RLIKE" not in df.select(urls.is_bad_image_url(F.col("u")))._jdf.queryExecution().optimizedPlan().toString().upper()
