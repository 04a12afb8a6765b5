"""The fail-closed gate, the approved catalogue, its regional parts, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.functions.text import append_note, image_src, immutable_key, is_truthy
from catalogue_evidence.operators.assemble import KEY, filled, text
from catalogue_evidence.operators.conflicts import hash_identity_failures
from catalogue_evidence.operators.review import APPROVED, PENDING, REVIEWED, decision_counts
from catalogue_evidence.sources.shared import ranked, staged

# What is said where a reviewer's attestation is missing.
ATTESTATIONS = {
    "brandExact": "brand not explicitly confirmed",
    "productNameExact": "product name not explicitly confirmed",
    "sizeQuantityExact": "size/quantity not explicitly confirmed",
    "strengthExactOrNotApplicable": "strength not confirmed or marked N/A",
    "formExactOrNotApplicable": "dosage form not confirmed or marked N/A",
    "flavourAudienceBundleExactOrNotApplicable": "flavour/audience/bundle not confirmed or marked N/A",
    "officialProductImageOrBottle": "image is not confirmed as official product/bottle image",
    "noLogoPlaceholderLifestyle": "logo/placeholder/lifestyle exclusion not confirmed",
}
# What approved rows of the regional catalogues say.
METHOD = "self-hosted-jpg-strict-exact-product-package-approved"
NOTE = "V28 self-hosted exact product/package JPG approved."


def validate_rows(catalogue: DataFrame, results: DataFrame, review: DataFrame, images: DataFrame) -> DataFrame:
    """catalogue with resolvedImageUrl, evidencePage, jpgSha256, passed_hash and failure, the first stage that a row fails.

    images: (path, error, sha256), one row for each file under the store, error where it is no good JPEG. Every table
    has one row a key. passed_hash: the row came as far as the comparison of digests, and passed it.
    """
    r = results.select(F.col(KEY).alias("_r"), "resolvedImageUrl", "evidencePage", "stagingPath", F.col("sha256").alias("_sha"))
    v = review.select(F.col(KEY).alias("_v"), "manualVisualDecision", *ATTESTATIONS, *REVIEWED)
    s = images.select(F.col("path").alias("_s"), F.col("error").alias("_s_error"), F.col("sha256").alias("jpgSha256"))
    f = images.select(F.col("path").alias("_f"), F.col("error").alias("_f_error"))
    out = catalogue.join(r, F.col(KEY) == F.col("_r"), "left").join(v, F.col(KEY) == F.col("_v"), "left")
    out = out.join(s, filled("stagingPath") == F.col("_s"), "left").join(f, filled("targetJpgPath") == F.col("_f"), "left")
    missing = F.array_join(F.array_compact(F.array(*[F.when(~is_truthy(F.col(c)), F.lit(m)) for c, m in ATTESTATIONS.items()])), "; ")
    differ = [F.when(F.trim(text(c)) != F.trim(text(x)), F.lit(f"{c} mismatch")) for c, x in REVIEWED.items()]
    mismatch = F.array_join(F.array_compact(F.array(*differ)), "; ")
    early = F.coalesce(
        F.when(F.col("_r").isNull(), F.lit("missing acquisition result")),
        F.when(F.col("_v").isNull() | (text("manualVisualDecision") != APPROVED), F.lit("not visually approved")),
        F.nullif(missing, F.lit("")),
        F.nullif(mismatch, F.lit("")),
        F.when((text("stagingPath") == "") | F.col("_s").isNull(), F.lit("approved row missing staged image")),
        F.when(text("_s_error") != "", F.concat(F.lit("invalid JPEG: "), F.col("_s_error"))),
        F.when(~F.col("jpgSha256").eqNullSafe(F.col("_sha")), F.lit("SHA-256 differs from acquisition record")),
    )
    late = F.coalesce(
        F.when(F.col("_f").isNull(), F.lit("final target JPG missing; rerun with --materialize-approved")),
        F.when(text("_f_error") != "", F.concat(F.lit("final target unreadable: "), F.col("_f_error"))),
    )
    return out.select(
        *catalogue.columns, "resolvedImageUrl", "evidencePage", "jpgSha256", early.isNull().alias("passed_hash"), F.coalesce(early, late).alias("failure")
    )


def failures(gated: DataFrame) -> DataFrame:
    """(immutableKey, reason): failed rows, and digests that more than one identity was approved with."""
    own = gated.filter(F.col("failure").isNotNull()).select(KEY, F.col("failure").alias("reason"))
    return own.unionByName(hash_identity_failures(gated.filter("passed_hash")))


def approved_catalogue(gated: DataFrame) -> DataFrame:
    """The rows that pass, with their image's path in the store; digests in conflict don't take rows out."""
    cols = [c for c in gated.columns if c not in ("passed_hash", "failure")]
    return gated.filter(F.col("failure").isNull()).select(*cols, image_src(F.col("targetJpgPath")).alias("imageSrc"))


def rebuild_regional(source: DataFrame, approved: DataFrame) -> DataFrame:
    """All source rows, approved ones with their own image's columns."""
    a = approved.select(F.col(KEY).alias("_a"), F.col("imageSrc").alias("_src"))
    out = source.join(a, immutable_key(F.col("region"), F.col("productId"), F.col("variantIndex")) == F.col("_a"), "left")
    values = {
        "imageSrc": F.col("_src"), "imageKind": F.lit("product"), "imageTrusted": F.lit("True"),
        "imageResolutionMethod": F.lit(METHOD), "imageMatchStatus": F.lit(APPROVED), "imageNotes": append_note(F.col("imageNotes"), NOTE),
    }
    return out.select(*[F.when(F.col("_a").isNotNull(), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in source.columns])


def validation_summary(gated: DataFrame, source: DataFrame, expected: int, preview: int = 200) -> DataFrame:
    """One row: scope, expected, approvedAndMaterialized, failureCount, failureReasonCounts, regionalSourceRows,
    regionalApprovedRows, failuresPreview, pass. The gate passes only if every expected row is there and approved."""
    fails = failures(gated)
    size = gated.agg(F.count(F.lit(1)).alias("scope"), F.count_if(F.col("failure").isNull()).alias("approvedAndMaterialized"))
    reasons = fails.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    counts = reasons.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("failureCount"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("failureReasonCounts"),
    )
    first = fails.orderBy(KEY, "reason").limit(preview).agg(F.array_sort(F.collect_list(F.struct(KEY, "reason"))).alias("failuresPreview"))
    by = lambda df, name: df.groupBy("region").agg(F.count(F.lit(1)).alias("n")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("region", "n")))).alias(name)
    )
    out = size.crossJoin(counts).crossJoin(by(source, "regionalSourceRows")).crossJoin(by(gated.filter("failure is null"), "regionalApprovedRows"))
    out = out.crossJoin(first).withColumn("expected", F.lit(expected).cast("long"))  # of one row each
    good = (F.col("approvedAndMaterialized") == expected) & (F.col("scope") == expected) & (F.col("failureCount") == 0)
    return out.withColumn("pass", good)


def status_report(catalogue: DataFrame, results: DataFrame, review: DataFrame, files: DataFrame) -> DataFrame:
    """One row: catalogueRows, acquisitionRows, acquisitionStatusCounts, reviewDecisionCounts, approved,
    manualReviewNeeded, rejectedPendingRetry, finalFilesPresent."""
    status = F.when(text("status") == "", "MISSING").otherwise(F.col("status"))
    by = results.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))
    a = by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("acquisitionRows"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("acquisitionStatusCounts"))
    of = lambda *names: F.coalesce(F.sum(F.when(F.col("decision").isin(*names), F.col("n"))), F.lit(0))
    d = decision_counts(review).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("decision", "n")))).alias("reviewDecisionCounts"),
        of(APPROVED).alias("approved"), of("REVIEW_REQUIRED", PENDING).alias("manualReviewNeeded"),
        of("REJECTED_WRONG_OR_UNCERTAIN").alias("rejectedPendingRetry"),
    )
    n = catalogue.agg(F.count(F.lit(1)).alias("catalogueRows"))
    there = catalogue.join(files.select(F.col("path").alias("_p")), F.col("targetJpgPath") == F.col("_p"), "left_semi")
    return n.crossJoin(a).crossJoin(d).crossJoin(there.agg(F.count(F.lit(1)).alias("finalFilesPresent")))  # of one row each


def review_queue(catalogue: DataFrame, results: DataFrame, review: DataFrame, page_size: int = 250) -> DataFrame:
    """(page, place, pages, batchIndex, immutableKey, brand, productName, size, status, resolvedImageUrl, reason,
    decision): rows without approval, in the catalogue's order, dealt out in pages. Places come from range partitions,
    so however unevenly batchIndex is spread, no task holds much more than others; rows without a number come first."""
    r = results.select(F.col(KEY).alias("_r"), "status", "resolvedImageUrl", "reason")
    v = review.select(F.col(KEY).alias("_v"), F.col("manualVisualDecision").alias("decision"))
    q = catalogue.select(F.col("batchIndex").try_cast("long").alias("batchIndex"), KEY, "brand", "productName", "size")
    q = q.join(r, F.col(KEY) == F.col("_r"), "left").join(v, F.col(KEY) == F.col("_v"), "left").filter(text("decision") != APPROVED)
    q = staged(q.drop("_r", "_v").withColumn("decision", F.when(text("decision") == "", PENDING).otherwise(F.col("decision"))), "queue")
    n = q.count()
    parts = max(int(q.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // 250_000))
    placed = ranked(q, [], ["batchIndex", KEY], parts, "_place", "queue-places").withColumn("place", F.col("_place") + 1)
    return placed.select(
        (F.floor(F.col("_place") / page_size) + 1).alias("page"), "place", F.lit(-(-n // page_size)).cast("long").alias("pages"),
        "batchIndex", KEY, "brand", "productName", "size", "status", "resolvedImageUrl", "reason", "decision",
    )
