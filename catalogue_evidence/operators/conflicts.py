"""Identical or perceptually identical assets under incompatible identities: counts by digest, never a self-join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.functions.text import identity_plain, norm_text, signatures_of, sizes_in
from catalogue_evidence.operators.assemble import filled, text

# What marked rows say.
CONFLICT = "STAGED_DUPLICATE_CONFLICT_NEEDS_REVIEW"
REASON = "Same or perceptually identical bytes are assigned to incompatible product/package identities."
KINDS = {"sha256": "sha256", "phash": "perceptualHash"}


def _identified(results: DataFrame) -> DataFrame:
    """results with _identity, a number for brand, product and sizes in their normal forms, each worked out once."""
    normal = results.select("*", *[norm_text(F.col(c)).alias(f"_{c}") for c in ("brand", "productName", "size")])
    sized = normal.select("*", sizes_in(F.col("_size")).alias("_sizes")).select("*", signatures_of(F.col("_sizes")).alias("_signatures"))
    identity = F.struct(F.col("_brand").alias("brand"), F.col("_productName").alias("product"), F.array_sort("_signatures").alias("sizes"))
    return sized.select(*results.columns, F.xxhash64(F.to_json(identity)).alias("_identity"))


def identity_counts(results: DataFrame) -> DataFrame:
    """(kind, digest, identity, n): the rows of each identity with a digest of either kind; blank digests don't count."""
    digests = F.array(*[F.struct(F.lit(k).alias("kind"), text(c).alias("digest")) for k, c in KINDS.items()])
    each = _identified(results).select(F.col("_identity").alias("identity"), F.inline(digests)).filter("digest <> ''")
    return each.groupBy("kind", "digest", "identity").agg(F.count(F.lit(1)).alias("n"))


def changed_counts(counts: DataFrame, old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """identity_counts() after rows old have become rows new, and the change, (kind, digest, identity, n), itself."""
    change = identity_counts(new).unionByName(identity_counts(old).withColumn("n", -F.col("n")))
    change = change.groupBy("kind", "digest", "identity").agg(F.sum("n").alias("n")).filter("n <> 0")
    total = counts.unionByName(change).groupBy("kind", "digest", "identity").agg(F.sum("n").alias("n"))
    return total.filter("n <> 0"), change


def conflicting(counts: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(kind, digest) of the digests that more than one identity has by its counts; of: of results with such digests alone."""
    if of is not None:
        digests = F.array(*[F.struct(F.lit(k).alias("kind"), text(c).alias("digest")) for k, c in KINDS.items()])
        counts = counts.join(of.select(F.inline(digests)).distinct(), ["kind", "digest"], "left_semi")
    return counts.groupBy("kind", "digest").count().filter("count > 1").drop("count")


def conflict_digests(results: DataFrame, kind: str) -> DataFrame:
    """(digest, n_rows, n_identities) of the digests of a kind that more than one identity has; blank digests don't count."""
    rows = results.filter(text(KINDS[kind]) != "").select(F.col(KINDS[kind]).alias("digest"), "brand", "productName", "size")
    each = _identified(rows).groupBy("digest", "_identity").agg(F.count(F.lit(1)).alias("n"))
    sums = each.groupBy("digest").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_identities"))
    return sums.filter("n_identities > 1")


def duplicate_conflicts(results: DataFrame, kind: str) -> DataFrame:
    """(conflictType, digest, all columns of results) of all rows whose digest is in conflict."""
    digests = conflict_digests(results, kind).select(F.col("digest").alias("_d"))
    found = results.join(digests, results[KINDS[kind]] == digests["_d"], "left_semi")
    return found.select(F.lit(kind).alias("conflictType"), F.col(KINDS[kind]).alias("digest"), *results.columns)


def mark(results: DataFrame, digests: dict[str, DataFrame]) -> DataFrame:
    """results with staged rows marked that have one of the (digest) of a kind, and no longer eligible for approval."""
    out = results
    for kind, found in digests.items():
        d = found.select(F.col("digest").alias(f"_{kind}"))
        out = out.join(d, filled(KINDS[kind]) == d[f"_{kind}"], "left")
    hit = F.coalesce(*[F.col(f"_{k}") for k in digests]).isNotNull() & text("status").startswith("STAGED")
    for name, value in (("status", F.lit(CONFLICT)), ("autoApprovalEligible", F.lit(False)), ("reason", F.lit(REASON))):
        kind = results.schema[name].dataType
        out = out.withColumn(name, F.when(hit, value.cast(kind)).otherwise(F.col(name)))
    return out.select(results.columns)


def mark_conflicts(results: DataFrame, kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """results with staged rows in conflict by any of kinds marked, and no longer eligible for approval."""
    return mark(results, {k: conflict_digests(results, k) for k in kinds})


def conflict_report(results: DataFrame) -> DataFrame:
    """Conflicts of both kinds; a row can be in both. Those by perceptual hash show the status that bytes have led to."""
    return duplicate_conflicts(results, "sha256").unionByName(duplicate_conflicts(mark_conflicts(results, ("sha256",)), "phash"))


def hash_identity_failures(checked: DataFrame) -> DataFrame:
    """(immutableKey, reason): digests, in the key's place, of bytes approved for more than one plain identity."""
    identity = identity_plain(F.col("brand"), F.col("productName"), F.col("size"))
    each = checked.select(F.col("jpgSha256").alias("sha"), identity.alias("identity")).distinct().groupBy("sha").count()
    text_ = F.concat(F.lit("identical bytes approved across "), F.col("count").cast("string"), F.lit(" incompatible identities"))
    return each.filter("count > 1").select(F.col("sha").alias("immutableKey"), text_.alias("reason"))
