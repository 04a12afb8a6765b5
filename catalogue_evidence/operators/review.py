"""Review as keyed upserts: resumed runs, machine and human decisions, rejected candidates and retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.operators.assemble import KEY, latest_by_key, text

# Decisions, statuses, reviewers that are machines, and columns of the sheets.
PENDING, APPROVED = "PENDING", "APPROVED_EXACT_PRODUCT_PACKAGE"
REJECTED, REVIEW = "REJECTED_WRONG_OR_UNCERTAIN", "REVIEW_REQUIRED"
RETRY = "RETRY_REQUIRED_PREVIOUS_CANDIDATE_REJECTED"
MACHINES = ["gemini", "gemini-api"]
FLAGS = [
    "brandExact", "productNameExact", "sizeQuantityExact", "strengthExactOrNotApplicable", "formExactOrNotApplicable",
    "flavourAudienceBundleExactOrNotApplicable", "officialProductImageOrBottle", "noLogoPlaceholderLifestyle",
]
REVIEWED = {"reviewedBrand": "brand", "reviewedProductName": "productName", "reviewedSizeQuantity": "size"}
CARRIED = ["reviewer", "evidenceNote", *FLAGS, *REVIEWED]
RESULT = [
    "batchIndex", KEY, "brand", "productName", "size", "targetJpgPath", "resolvedImageUrl", "evidencePage", "origin", "width",
    "height", "sha256", "perceptualHash", "pageBrandCoverage", "pageProductCoverage", "exactSizeEvidence", "imageCandidateScore", "status",
]
SHEET = [*RESULT, "manualVisualDecision", *CARRIED]
AI = ["aiDecision", "aiConfidence", "aiReason", "aiEvidence", "aiVisibleBrand", "aiVisibleProductName", "aiVisibleSizeQuantity", "aiModel", "aiVerifiedAt"]
REJECTED_FIELDS = [KEY, "resolvedImageUrl", "evidencePage", "reason", "aiConfidence", "rejectedAt"]
CHECKS = [
    "real_product_image", "brand_exact", "product_name_exact", "size_quantity_exact", "strength_exact_or_not_applicable",
    "form_exact_or_not_applicable", "flavour_audience_bundle_exact_or_not_applicable", "no_logo_placeholder_lifestyle",
]
PAYLOAD = (
    "decision string, confidence int, " + ", ".join(f"{c} boolean" for c in CHECKS) + ", visible_brand string, visible_product_name string, "
    "visible_size_quantity string, visible_strength string, visible_form string, evidence string, reason string"
)


def upsert(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Rows of old whose keys new doesn't have, and all of new; columns are old's."""
    ids = new.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return old.join(ids, cond, "left_anti").unionByName(new.select(old.columns))


def resume_split(rows: DataFrame, prior: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prior results that stand, staged ones whose file exists and whose row is asked for; and the rows still to do."""
    p = prior.filter(text("status").startswith("STAGED") & (text("stagingPath") != ""))
    kept = p.join(files.select(F.col("path").alias("_p")), F.col("stagingPath") == F.col("_p"), "left_semi")
    kept = kept.join(rows.select(F.col(KEY).alias("_k")), F.col(KEY) == F.col("_k"), "left_semi")
    return kept, rows.join(kept.select(F.col(KEY).alias("_k")), F.col(KEY) == F.col("_k"), "left_anti")


def merge_results(rows: DataFrame, kept: DataFrame, new: DataFrame) -> DataFrame:
    """The results of rows, new ones before kept ones; the order is that of batchIndex."""
    both = upsert(kept, new, KEY)
    return both.join(rows.select(F.col(KEY).alias("_k")), F.col(KEY) == F.col("_k"), "left_semi").orderBy(F.col("batchIndex").try_cast("long"))


def override_todo(catalogue: DataFrame, overrides: DataFrame, prior: DataFrame) -> DataFrame:
    """Rows of the catalogue with an overriding web address that aren't staged yet."""
    o = overrides.filter(text("approvedDirectImageUrl").startswith("http")).select(F.col(KEY).alias("_o"))
    s = prior.filter(text("status").startswith("STAGED")).select(F.col(KEY).alias("_s"))
    return catalogue.join(o, F.col(KEY) == F.col("_o"), "left_semi").join(s, F.col(KEY) == F.col("_s"), "left_anti")


def merge_chunks(*chunks: DataFrame) -> DataFrame:
    """Chunk results as one table, the later chunk's row where two have a key."""
    union = None
    for i, c in enumerate(chunks):
        one = c.withColumn("_chunk", F.lit(i))
        union = one if union is None else union.unionByName(one, allowMissingColumns=True)
    return latest_by_key(union, "_chunk").drop("_chunk")


def merge_review_sheet(results: DataFrame, old: DataFrame) -> DataFrame:
    """The review sheet of results, with decisions and reviewers' columns of an older sheet; other columns of it go."""
    o = old.select(F.col(KEY).alias("_k"), *[F.col(c).alias(f"_{c}") for c in ("manualVisualDecision", *CARRIED)])
    both = results.join(o, F.col(KEY) == F.col("_k"), "left")
    decision = F.when(F.col("_k").isNull(), F.lit(PENDING)).otherwise(F.col("_manualVisualDecision"))
    carried = [F.coalesce(F.col(f"_{c}"), F.lit("")).alias(c) for c in CARRIED]
    return both.select(*[F.col(c) for c in RESULT], decision.alias("manualVisualDecision"), *carried)


def acquisition_summary(results: DataFrame, conflicts: DataFrame) -> DataFrame:
    """One row: scopeRows, statusCounts, stagedRows, unresolvedRows, uniqueDownloadedJpgBytes, duplicateConflictRows."""
    by = results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    staged = text("status").startswith("STAGED")
    counts = by.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("scopeRows"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("statusCounts"),
        F.coalesce(F.sum(F.when(staged, F.col("n"))), F.lit(0)).alias("stagedRows"),
        F.coalesce(F.sum(F.when(~staged, F.col("n"))), F.lit(0)).alias("unresolvedRows"),
    )
    unique = results.filter(text("sha256") != "").agg(F.count_distinct("sha256").alias("uniqueDownloadedJpgBytes"))
    rows = conflicts.agg(F.count_distinct(KEY).alias("duplicateConflictRows"))
    return counts.crossJoin(unique).crossJoin(rows)  # of one row each


def pending_verification(catalogue: DataFrame, results: DataFrame, review: DataFrame, resume: bool = False, most: int = 0) -> DataFrame:
    """Staged rows that wait for verification, in the catalogue's order; with resume those without a settled decision."""
    staged = results.filter(text("status").startswith("STAGED")).select(F.col(KEY).alias("_k"))
    out = catalogue.join(staged, F.col(KEY) == F.col("_k"), "left_semi")
    if resume:
        done = review.filter(F.col("manualVisualDecision").isin(APPROVED, REJECTED, REVIEW)).select(F.col(KEY).alias("_k"))
        out = out.join(done, F.col(KEY) == F.col("_k"), "left_anti")
    out = out.orderBy(F.col("batchIndex").try_cast("long"), KEY)
    return out.limit(most) if most > 0 else out


def is_strict_approval(payload: Column, threshold: int = 98) -> Column:
    """Approved with enough confidence and every check true; a missing answer is no approval."""
    test = (payload["decision"] == "APPROVE") & (F.coalesce(payload["confidence"], F.lit(0)) >= threshold)
    for c in CHECKS:
        test = test & payload[c]
    return F.coalesce(test, F.lit(False))


def decide(status: Column, payload: Column, threshold: int = 98) -> Column:
    """The decision that a verification leads to: an error or an empty payload needs review, and a refusal or a confident
    answer of any kind but strict approval rejects."""
    sure = F.coalesce(payload["confidence"], F.lit(0)) >= 90
    return (
        F.when((status != "OK") | status.isNull() | payload.isNull(), REVIEW)
        .when(is_strict_approval(payload, threshold), APPROVED)
        .when((payload["decision"] == "REJECT") | sure, REJECTED)
        .otherwise(REVIEW)
    )


def decided(verifications: DataFrame, threshold: int = 98) -> DataFrame:
    """(immutableKey, status, error, p, new_decision) of (immutableKey, status, payload as JSON, error)."""
    p = F.from_json("payload", PAYLOAD)
    v = verifications.select(F.col(KEY).alias("_v"), F.col("status").alias("v_status"), F.col("error").alias("v_error"), p.alias("p"))
    return v.withColumn("new_decision", decide(F.col("v_status"), F.col("p"), threshold))


def apply_verifications(review: DataFrame, verifications: DataFrame, catalogue: DataFrame, results: DataFrame, model: str, now: str, threshold: int = 98) -> DataFrame:
    """The sheet with machine columns after verifications; what a person approved is never changed.

    Keys without a row on the sheet get one. review may lack the machine columns.
    """
    for c in AI:
        review = review if c in review.columns else review.withColumn(c, F.lit(""))
    sheet = [*SHEET, *AI]
    v = decided(verifications, threshold)
    c = catalogue.select(F.col(KEY).alias("_c"), *[F.col(x).alias(f"c_{x}") for x in ("batchIndex", "brand", "productName", "size", "targetJpgPath")])
    r = results.select(F.col(KEY).alias("_r"), *[F.col(x).alias(f"r_{x}") for x in RESULT[6:]])
    new = v.join(c, F.col("_v") == F.col("_c")).join(r, F.col("_v") == F.col("_r"))
    both = review.select(sheet).join(new, F.col(KEY) == F.col("_v"), "full")
    human = (F.col("manualVisualDecision") == APPROVED) & ~F.lower(text("reviewer")).isin(MACHINES)
    use = F.col("_v").isNotNull() & ~F.coalesce(human, F.lit(False))
    approved, failed = F.col("new_decision") == APPROVED, (F.col("v_status") != "OK") | F.col("p").isNull()
    confidence = F.col("p.confidence").cast("string")
    values: dict[str, Column] = {KEY: F.col("_v"), "aiModel": F.lit(model), "aiVerifiedAt": F.lit(now)}
    values |= {x: F.col(f"c_{x}") for x in ("batchIndex", "brand", "productName", "size", "targetJpgPath")}
    values |= {x: F.col(f"r_{x}") for x in RESULT[6:]}
    values |= {"manualVisualDecision": F.col("new_decision"), "reviewer": F.lit("gemini-api")}
    if_ok = lambda new, name: F.when(failed, F.coalesce(F.col(name), F.lit(""))).otherwise(F.coalesce(new, F.lit("")))
    values |= {
        "aiDecision": F.when(failed, "ERROR").otherwise(F.col("p.decision")),
        "aiReason": F.when(failed, F.col("v_error")).otherwise(F.col("p.reason")),
        "aiConfidence": if_ok(confidence, "aiConfidence"), "aiEvidence": if_ok(F.col("p.evidence"), "aiEvidence"),
        "aiVisibleBrand": if_ok(F.col("p.visible_brand"), "aiVisibleBrand"),
        "aiVisibleProductName": if_ok(F.col("p.visible_product_name"), "aiVisibleProductName"),
        "aiVisibleSizeQuantity": if_ok(F.col("p.visible_size_quantity"), "aiVisibleSizeQuantity"),
        "evidenceNote": F.when(approved, F.concat(F.lit("AI strict approval at "), confidence, F.lit("%: "), F.coalesce("p.evidence", F.lit(""))))
        .otherwise(if_ok(F.col("p.reason"), "evidenceNote")),
    }
    values |= {f: F.when(approved, "true").otherwise(text(f)) for f in FLAGS}
    values |= {f: F.when(approved, F.col(f"c_{x}")).otherwise(text(f)) for f, x in REVIEWED.items()}
    return both.select(*[F.coalesce(F.when(use, values[x]).otherwise(F.col(x)).cast("string"), F.lit("")).alias(x) for x in sheet])


def new_rejections(review: DataFrame, verifications: DataFrame, results: DataFrame, now: str, threshold: int = 98) -> DataFrame:
    """Candidates that verifications reject or leave in doubt, to be passed over by later runs; errors reject nothing,
    and neither do verifications of what a person approved."""
    v = decided(verifications, threshold).filter((F.col("v_status") == "OK") & F.col("p").isNotNull() & (F.col("new_decision") != APPROVED))
    human = review.filter((F.col("manualVisualDecision") == APPROVED) & ~F.lower(text("reviewer")).isin(MACHINES)).select(F.col(KEY).alias("_h"))
    v = v.join(human, F.col("_v") == F.col("_h"), "left_anti")
    return v.join(results, F.col("_v") == F.col(KEY)).select(
        KEY, text("resolvedImageUrl").alias("resolvedImageUrl"), text("evidencePage").alias("evidencePage"),
        F.coalesce("p.reason", F.lit("")).alias("reason"), F.coalesce(F.col("p.confidence").cast("string"), F.lit("")).alias("aiConfidence"),
        F.lit(now).alias("rejectedAt"),
    )


def upsert_rejected(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rejected candidates by key and URL, new values in place of old ones."""
    return upsert(old.select(REJECTED_FIELDS), new, KEY, "resolvedImageUrl")


def full_review(catalogue: DataFrame, review: DataFrame) -> DataFrame:
    """A sheet row for every catalogue row in its order, pending ones for those that had none."""
    own = ["batchIndex", "brand", "productName", "size", "targetJpgPath"]
    c = catalogue.select(F.col(KEY).alias("_k"), *[F.col(x).alias(f"_{x}") for x in own])
    both = c.join(review, F.col("_k") == F.col(KEY), "left")
    miss = F.col(KEY).isNull()
    put = {x: F.col(f"_{x}").cast("string") for x in own} | {KEY: F.col("_k"), "manualVisualDecision": F.lit(PENDING)}
    cols = [F.when(miss, put.get(x, F.lit(""))).otherwise(F.col(x).cast("string")).alias(x) for x in review.columns]
    return both.select(*cols).orderBy(F.col("batchIndex").try_cast("long"), KEY)


def decision_counts(review: DataFrame) -> DataFrame:
    """(decision, n); a blank decision is pending."""
    decision = F.when(text("manualVisualDecision") == "", PENDING).otherwise(F.col("manualVisualDecision"))
    return review.groupBy(decision.alias("decision")).agg(F.count(F.lit(1)).alias("n"))


def prepare_retry(results: DataFrame, review: DataFrame, include_review: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Results and sheet with rejected rows, and those in doubt if asked, set back for another candidate; and the staged
    paths that have become stale, (immutableKey, path), which the caller may delete."""
    asked = [REJECTED, *([REVIEW] if include_review else [])]
    hit = review.filter(F.col("manualVisualDecision").isin(asked)).select(F.col(KEY).alias("_k")).distinct()
    hit = hit.join(results.select(KEY), F.col("_k") == F.col(KEY), "left_semi")
    r = results.join(hit, F.col(KEY) == F.col("_k"), "left")
    blank = ["stagingPath", "sha256", "perceptualHash", "bytes", "width", "height"]
    on = F.col("_k").isNotNull()
    stale = r.filter(on & (text("stagingPath") != "")).select(KEY, F.col("stagingPath").alias("path"))
    cell = lambda x, v, df: F.when(on, v).otherwise(F.col(x)).cast(df.schema[x].dataType).alias(x)
    null = F.lit(None)
    fresh = [cell(x, F.lit(RETRY) if x == "status" else null, results) if x in [*blank, "status"] else F.col(x) for x in results.columns]
    s = review.join(hit, F.col(KEY) == F.col("_k"), "left")
    cleared = {"manualVisualDecision": F.lit(PENDING)} | {x: F.lit("") for x in ("reviewer", *FLAGS, *REVIEWED)}
    sheet = [cell(x, cleared[x], review) if x in cleared else F.col(x) for x in review.columns]
    return r.select(*fresh), s.select(*sheet), stale


def human_effects(events: DataFrame) -> DataFrame:
    """(immutableKey, last, approved, rejected) of (event_id, ts, immutableKey, decision): the last decision but skips by
    time and then id, and whether there was any approval and any rejection."""
    e = events.filter(F.col("decision").isin("approve", "reject"))
    return e.groupBy(F.col(KEY).alias("_e")).agg(
        F.max_by("decision", F.struct("ts", "event_id")).alias("last"),
        F.bool_or(F.col("decision") == "approve").alias("approved"),
        F.bool_or(F.col("decision") == "reject").alias("rejected"),
    )


def apply_human_decisions(review: DataFrame, events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The sheet after people's decisions. Flags that an approval sets outlive a later rejection; keys that aren't on
    the sheet stay off it."""
    return apply_human_effects(review, human_effects(events), catalogue)


def apply_human_effects(review: DataFrame, effects: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The sheet after the human_effects() of people's decisions, from a batch or as a stream keeps them."""
    c = catalogue.select(F.col(KEY).alias("_c"), *[F.col(x).alias(f"c_{x}") for x in REVIEWED.values()])
    both = review.join(effects, F.col(KEY) == F.col("_e"), "left").join(c, F.col(KEY) == F.col("_c"), "left")
    on, yes = F.col("_e").isNotNull(), F.coalesce("approved", F.lit(False))
    last = F.col("last") == "approve"
    values = {
        "manualVisualDecision": F.when(on, F.when(last, APPROVED).otherwise(REJECTED)),
        "reviewer": F.when(on, "human-local-review"),
        "evidenceNote": F.when(on, F.when(last, "Human visually confirmed exact brand, product, and package.").otherwise("Human rejected candidate as wrong or uncertain.")),
    }
    values |= {f: F.when(yes, "true") for f in FLAGS} | {f: F.when(yes, F.coalesce(F.col(f"c_{x}"), F.lit(""))) for f, x in REVIEWED.items()}
    return both.select(*[F.coalesce(values[x], F.col(x)).alias(x) if x in values else F.col(x) for x in review.columns])


def human_rejections(events: DataFrame, results: DataFrame, rejected: DataFrame, now: str) -> DataFrame:
    """rejected with the candidates that people rejected and that weren't in it, of rows that have a candidate."""
    hit = human_effects(events).filter("rejected").select("_e")
    new = results.join(hit, F.col(KEY) == F.col("_e"), "left_semi").filter(text("resolvedImageUrl") != "").select(
        KEY, "resolvedImageUrl", text("evidencePage").alias("evidencePage"),
        F.lit("Human rejected candidate as wrong or uncertain.").alias("reason"), F.lit("").alias("aiConfidence"), F.lit(now).alias("rejectedAt"),
    )
    old = rejected.select(F.col(KEY).alias("_k"), F.col("resolvedImageUrl").alias("_u"))
    new = new.join(old, (F.col(KEY) == F.col("_k")) & (F.col("resolvedImageUrl") == F.col("_u")), "left_anti")
    return rejected.select(REJECTED_FIELDS).unionByName(new.dropDuplicates([KEY, "resolvedImageUrl"]))
