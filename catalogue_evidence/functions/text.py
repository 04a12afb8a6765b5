"""Text rules that decide identity: normal form, tokens, coverage and package sizes, as Column expressions.

Lambdas evaluate what they hold for every element, so functions that take `tokens` or `signatures` want columns by
themselves, made in an earlier select.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit spellings, replaced as substrings in this order.
UNIT_ALIASES = {
    "capsules": "caps", "capsule": "caps", "vcaps": "caps", "v-caps": "caps", "vegcaps": "caps",
    "tablets": "tabs", "tablet": "tabs", "softgel": "softgels", "soft gels": "softgels",
    "milliliters": "ml", "millilitres": "ml", "milliliter": "ml", "millilitre": "ml",
    "grams": "g", "gram": "g", "ounces": "oz", "ounce": "oz", "fluid ounces": "fl oz",
}
# Words that say nothing about identity.
STOPWORDS = [
    "and", "the", "with", "for", "of", "a", "an", "plus", "formula", "support", "complex",
    "capsules", "capsule", "caps", "tablets", "tablet", "tabs", "softgels", "softgel", "liquid",
    "powder", "cream", "spray", "drops", "supplement", "professional", "advanced", "natural",
]
# How package sizes are written in normal form.
SIZE_PATTERNS = [
    r"\b\d+(?:\.\d+)?\s*(?:ml|g|kg|mg|mcg|oz|fl oz|caps|tabs|softgels|count|ct|packets|sachets|servings)\b",
    r"\b\d+\s*x\s*\d+\b",
    r"\b\d+\s*(?:billion|million)\b",
]
# Volumes that count as the same size, the left one in millilitres.
EQUIVALENT_SIZES = {"30ml": "1floz", "60ml": "2floz", "120ml": "4floz"}
#: The public table of character names, as the standard library has it, for a map by one literal.
NAMED = "\x01".join(f"{k}\x02{v}" for k, v in sorted(html5.items()))
LONGEST = max(map(len, html5))
#: What a reference may look like behind its ampersand.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Numbers that stand for the characters of an older code page, where that has any.
OLD_PAGE = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
# What counts as true.
TRUTHY = ["true", "yes", "1", "approved"]


def _numbered(ref: Column) -> Column:
    """The character of a reference by number, without its ampersand: none for what isn't a character in a page, and the
    mark of a bad one for surrogates and what lies beyond all characters."""
    hexadecimal = F.lower(F.substring(ref, 2, 1)) == "x"
    digits = F.regexp_replace(ref, "^#[xX]?0*|;$", "")
    large = F.length(digits) > F.when(hexadecimal, 6).otherwise(7)
    n = F.when(large, F.lit(1 << 24)).when(digits == "", F.lit(0)).otherwise(F.call_function("conv", digits, F.when(hexadecimal, 16).otherwise(10), F.lit(10)).cast("int"))
    bad, text = F.lit("\ufffd"), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    nothing = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n % 65536 >= 65534)
    return (
        F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), bad).when(n.between(0x80, 0x9F), F.substring(F.lit(OLD_PAGE), n - 0x7F, F.lit(1)))
        .when(nothing, "").otherwise(text)
    )


def _referred(part: Column) -> Column:
    """A part of a text behind an ampersand, the reference at its beginning resolved: by number, by name, or by the longest
    name that it begins with; without any, the ampersand stays."""
    ref = F.regexp_extract(part, REFERENCE, 1)
    names = F.str_to_map(F.lit(NAMED), F.lit("\x01"), F.lit("\x02"))
    lengths = F.sequence(F.least(F.length(ref), F.lit(LONGEST)), F.lit(2), F.lit(-1))
    known = F.get(F.filter(F.when(F.length(ref) >= 2, lengths), lambda n: F.map_contains_key(names, F.substring(ref, F.lit(1), n))), F.lit(0))
    named = F.concat(names[F.substring(ref, F.lit(1), known)], F.substring(part, known + 1, F.length(part)))
    numbered = F.concat(_numbered(ref), F.substring(part, F.length(ref) + 1, F.length(part)))
    return F.when(ref.startswith("#"), numbered).when(known.isNotNull(), named).otherwise(F.concat(F.lit("&"), part))


def unescape(c: Column) -> Column:
    """A text with its character references resolved, each once, as browsers do. c should be a column by itself: texts
    without an ampersand stay as they are."""
    parts = F.split(c, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), _referred)
    return F.when(c.contains("&"), F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(c)


def norm_text(c: Column) -> Column:
    """Lower case, units in one spelling, and single blanks for all but letters a-z, digits and points. Null is empty."""
    return norm_of(unescape(F.coalesce(c, F.lit(""))))


def norm_of(c: Column) -> Column:
    """norm_text() of a text whose character references are resolved already."""
    c = F.lower(c)
    for was, now in {"™": " ", "®": " ", **UNIT_ALIASES}.items():  # replace() searches bytes; translate() looks every letter up
        c = F.replace(c, F.lit(was), F.lit(now))
    return F.trim(F.regexp_replace(c, "[^a-z0-9.]+", " "))


def tokens_of(norm: Column) -> Column:
    """Runs of letters and digits of a normal form, longer than one and no stopwords, in order and with repeats."""
    words = F.regexp_extract_all(norm, F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(words, lambda t: (F.length(t) > 1) & ~t.isin(STOPWORDS))


def significant_tokens(c: Column) -> Column:
    """The tokens of a text. Where its sizes are asked for too, work its normal form out once and use tokens_of()."""
    return tokens_of(norm_text(c))


def token_coverage(needle: Column, hay: Column) -> Column:
    """Share of the tokens needle that are among the tokens hay; 1 without any. Both are token columns."""
    found = F.size(F.filter(needle, lambda t: F.array_contains(hay, t)))
    return F.when(F.size(needle) == 0, F.lit(1.0)).otherwise(found / F.greatest(F.size(needle), F.lit(1)))


def sizes_in(norm: Column) -> Column:
    """Package sizes in a normal form, without white space, with repeats; norm must be a column by itself."""
    found = [F.regexp_extract_all(norm, F.lit(f"({p})"), F.lit(1)) for p in SIZE_PATTERNS]
    return F.transform(F.concat(*found), lambda s: F.replace(s, F.lit(" "), F.lit("")))


def signatures_of(sizes: Column) -> Column:
    """Sizes, each once, with equivalent volumes; in no set order. sizes must be a column by itself."""
    same = F.transform(sizes, lambda s: F.create_map(*[F.lit(x) for kv in EQUIVALENT_SIZES.items() for x in kv])[s])
    return F.array_distinct(F.concat(sizes, F.filter(same, lambda s: s.isNotNull())))


def size_signatures(c: Column) -> Column:
    """Package sizes in a text, as in signatures_of(), all in one expression, which works its parts out repeatedly."""
    return signatures_of(sizes_in(norm_text(c)))


def exact_size_match(expected: Column, evidence: Column) -> Column:
    """Whether two signature columns share a size; true where none is expected."""
    return (F.size(expected) == 0) | F.coalesce(F.arrays_overlap(expected, evidence), F.lit(False))


def identity_norm(brand: Column, product: Column, size: Column) -> Column:
    return F.struct(norm_text(brand).alias("brand"), norm_text(product).alias("product"), F.array_sort(size_signatures(size)).alias("sizes"))


def identity_plain(brand: Column, product: Column, size: Column) -> Column:
    return F.struct(*[F.lower(F.trim(c)).alias(n) for n, c in (("brand", brand), ("product", product), ("size", size))])


def immutable_key(region: Column, product_id: Column, variant: Column) -> Column:
    return F.concat_ws(":", region, product_id, variant)


def is_truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin(TRUTHY), F.lit(False))


def append_note(c: Column, note: str) -> Column:
    return F.btrim(F.concat(F.coalesce(c, F.lit("")), F.lit(f" | {note}")), F.lit(" |"))


def image_src(target: Column) -> Column:
    return F.concat(F.lit("/"), F.translate(target, "\\", "/"))


def staging_path(batch: Column, target: Column) -> Column:
    """The row's number, filled up to five digits but never cut, and the target's file name."""
    filled = F.when(F.length(batch) < 5, F.lpad(batch, 5, "0")).otherwise(batch)
    return F.concat(filled, F.lit("_"), F.element_at(F.split(target, "/"), -1))
