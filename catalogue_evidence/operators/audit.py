"""Audits of paths, keys, identities and shared sources: aggregates over distinct values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.functions.text import identity_norm
from catalogue_evidence.operators.assemble import KEY, is_true, text
from catalogue_evidence.sources.shared import previous

# Fixed value: the form of target paths.
TARGET = r"^assets/product-images/catalogue-v28/[0-9a-f]{24}\.jpg$"
PREVIEW = 100


def path_problems(manifest: DataFrame) -> DataFrame:
    """(row_no, immutableKey, problem, path): all that is wrong with each target path. manifest: (row_no, immutableKey,
    assetId, targetJpgPath). Of rows that share a path, each names the one before it."""
    raw = text("targetJpgPath")
    name = F.element_at(F.split(F.regexp_replace(raw, "/+$", ""), "/"), -1)
    stem = F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)
    at = lambda test, message: F.when(test, F.lit(message))
    checks = [
        at(raw == "", "EMPTY_PATH"),
        at(raw.contains("\\"), "BACKSLASH"),
        at(raw.startswith("/"), "ABSOLUTE_PATH"),
        at(F.array_contains(F.split(raw, "/"), ".."), "TRAVERSAL"),
        at(~raw.rlike(TARGET), "SCHEMA_MISMATCH"),
        at(stem != text("assetId"), "ASSET_ID_FILENAME_MISMATCH"),
    ]
    own = manifest.select("row_no", KEY, raw.alias("path"), F.explode(F.array_compact(F.array(*checks))).alias("problem"))
    return own.select("row_no", KEY, "problem", "path").unionByName(duplicate_paths(manifest))


def duplicate_paths(manifest: DataFrame) -> DataFrame:
    """Each further row of a path, naming the key of the row before; paths that occur once are left out before any order
    is made. Empty paths count like others, and a path of many rows spreads over tasks."""
    raw = text("targetJpgPath")
    again = manifest.groupBy(raw.alias("_p")).count().filter("count > 1").select("_p")
    rows = manifest.select("row_no", KEY, raw.alias("path")).join(again, F.col("path") == F.col("_p"), "left_semi")
    return previous(rows, ["path"], ["row_no", KEY], KEY, "before", "duplicate-paths").filter(F.col("before").isNotNull()).select(
        "row_no", KEY, F.concat(F.lit("DUPLICATE_PATH_WITH_"), "before").alias("problem"), "path"
    )


def staged_missing(results: DataFrame, files: DataFrame) -> DataFrame:
    """Keys of staged rows whose file isn't there."""
    staged = results.filter(text("status").startswith("STAGED"))
    return staged.join(files.select(F.col("path").alias("_p")), F.col("stagingPath") == F.col("_p"), "left_anti").select(KEY)


def path_report(manifest: DataFrame) -> DataFrame:
    """One row: rowsChecked, pathProblems, uniquePaths, pass, and the first hundred problems as text."""
    problems = path_problems(manifest)
    size = manifest.agg(F.count(F.lit(1)).alias("rowsChecked"), F.count_distinct(text("targetJpgPath")).alias("uniquePaths"))
    n = problems.agg(F.count(F.lit(1)).alias("pathProblems"))
    line = F.concat_ws(" ", F.col("row_no").cast("string"), KEY, "problem", "path")
    first = problems.orderBy("row_no", "problem", KEY).limit(PREVIEW).select("row_no", "problem", line.alias("line"))
    first = first.agg(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "problem", "line"))), lambda x: x["line"]).alias("problemsPreview"))
    return size.crossJoin(n).crossJoin(first).withColumn("pass", F.col("pathProblems") == 0)  # of one row each


def reconcile(source: DataFrame, manifest: DataFrame) -> DataFrame:
    """(kind, n): keys that one side lacks, and shared keys whose target paths differ. Keys are taken once each."""
    s = source.select(F.col(KEY).alias("s_key"), text("targetJpgPath").alias("s_path")).dropDuplicates(["s_key"])
    m = manifest.select(F.col(KEY).alias("m_key"), text("targetJpgPath").alias("m_path")).dropDuplicates(["m_key"])
    both = s.join(m, F.col("s_key") == F.col("m_key"), "full")
    kind = (
        F.when(F.col("m_key").isNull(), "missing_in_manifest").when(F.col("s_key").isNull(), "missing_in_source")
        .when(F.col("s_path") != F.col("m_path"), "mapping_mismatch").otherwise("match")
    )
    return both.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def _groups(catalogue: DataFrame, keys: list[Column], names: list[str]) -> DataFrame:
    return catalogue.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("n"))


def identity_audit(catalogue: DataFrame) -> DataFrame:
    """One row: brands, repeatedIdentityGroups, repeatedIdentityRows, multiSizeGroups, blankBrands, blankNames, blankSizes."""
    blank = lambda c: F.count_if(F.trim(text(c)) == "")
    sums = catalogue.agg(
        F.count_distinct("brand").alias("brands"),
        blank("brand").alias("blankBrands"), blank("productName").alias("blankNames"), blank("size").alias("blankSizes"),
    )
    whole = _groups(catalogue, [F.lower(F.trim(text(c))) for c in ("brand", "productName", "size")], ["b", "p", "s"])
    repeated = whole.filter("n > 1").agg(
        F.count(F.lit(1)).alias("repeatedIdentityGroups"), F.coalesce(F.sum("n"), F.lit(0)).alias("repeatedIdentityRows")
    )
    sizes = whole.groupBy("b", "p").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").agg(F.count(F.lit(1)).alias("multiSizeGroups"))
    return sums.crossJoin(repeated).crossJoin(sizes)  # of one row each


def shared_source_pages(catalogue: DataFrame) -> DataFrame:
    """(sourcePage, n_identities, n_rows) of the pages that rows of more than one identity name; blank pages don't count."""
    rows = catalogue.filter(text("sourcePage") != "")
    identity = F.xxhash64(F.to_json(identity_norm(F.col("brand"), F.col("productName"), F.col("size"))))
    each = rows.select("sourcePage", identity.alias("identity")).groupBy("sourcePage", "identity").agg(F.count(F.lit(1)).alias("n"))
    sums = each.groupBy("sourcePage").agg(F.count(F.lit(1)).alias("n_identities"), F.sum("n").alias("n_rows"))
    return sums.filter("n_identities > 1")


def correct_conflicts(catalogue: DataFrame, flagged: DataFrame) -> DataFrame:
    """catalogue with source page and image reference blanked on the rows of flagged keys."""
    f = flagged.select(F.col(KEY).alias("_f")).distinct()
    out = catalogue.join(f, F.col(KEY) == F.col("_f"), "left")
    blank = {"sourcePage", "currentImageReference"}
    return out.select(*[F.when(F.col("_f").isNotNull(), "").otherwise(F.col(c)).alias(c) if c in blank else F.col(c) for c in catalogue.columns])


def scope_summary(catalogue: DataFrame) -> DataFrame:
    """(region, rows, keys, images, official, shared, barcode) by region and, as region ALL, in total."""
    official = F.col("sourceClass") == "official-manufacturer-product-page"
    counts = [
        F.count(F.lit(1)).alias("rows"), F.count_distinct(KEY).alias("keys"), F.count_distinct("currentImageReference").alias("images"),
        F.count_if(official).alias("official"), F.count_if(is_true("isSharedSourceConflict")).alias("shared"),
        F.count_if(is_true("isBarcodeDatabaseSource")).alias("barcode"),
    ]
    return catalogue.rollup("region").agg(*counts).withColumn("region", F.coalesce("region", F.lit("ALL")))


def domain_weights(catalogue: DataFrame) -> DataFrame:
    """(brand, officialDomain, evidenceWeight): rows of each brand on each official domain."""
    rows = catalogue.filter((F.col("sourceClass") == "official-manufacturer-product-page") & (text("sourceDomain") != ""))
    return rows.groupBy("brand", F.lower("sourceDomain").alias("officialDomain")).agg(F.count(F.lit(1)).alias("evidenceWeight"))
