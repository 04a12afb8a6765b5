"""Whole workloads: acquisition from tables, review passes, and the gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue_evidence.operators import assemble, conflicts, extract, publish, review, scoring
from catalogue_evidence.operators.assemble import KEY
from catalogue_evidence.sources.shared import staged


@dataclass
class Inputs:
    """What other systems have fetched, rendered and verified, as tables; those of searches may be left out."""

    catalogue: DataFrame
    domain_map: DataFrame
    pages: DataFrame  # (page_url, html)
    payloads: DataFrame  # (page_url, json), by a product page's or the payload's own URL
    fetched: DataFrame
    overrides: DataFrame
    searches: DataFrame | None = None  # (immutableKey, rank, href, title)
    rendered_searches: DataFrame | None = None  # the same, of a rendered search
    rendered: DataFrame | None = None  # (page_url, disc_ord, url, origin, alt, page_title, w, h)


class Pages:
    """Candidates of visited pages. Each page is parsed once, however many rows and passes ask for it: what is new is
    added as a table."""

    def __init__(self, inputs: Inputs) -> None:
        self.inputs = inputs
        self.known: DataFrame | None = None  # (page_url)
        self.found: DataFrame | None = None  # FOUND and visited

    def of(self, wanted: DataFrame) -> DataFrame:
        """Candidates of rows' pages, (immutableKey, page_ord, page_url)."""
        asked = wanted.select("page_url").distinct()
        new = staged(asked if self.known is None else asked.join(self.known, "page_url", "left_anti"), "pages-to-parse")
        if self.known is None or self.found is None or not new.isEmpty():
            payloads = extract.extract_store_json(extract.payloads_of_pages(new, self.inputs.payloads))
            parsed = extract.extract_candidates(self.inputs.pages.join(new, "page_url", "left_semi"))
            found = extract.dedup_page_candidates(parsed.unionByName(payloads)).unionByName(extract.image_responses(new, self.inputs.fetched))
            found = staged(found.select("*", F.col("page_url").alias("visited")), "page-candidates")
            self.found = found if self.found is None else self.found.unionByName(found)
            self.known = new if self.known is None else self.known.unionByName(new)
        return assemble.join_page_candidates(wanted, self.found)


def best_candidates(inputs: Inputs, rejected: DataFrame, keys: DataFrame | None = None, pages: Pages | None = None) -> DataFrame:
    """One result a catalogue row, or for each of keys (immutableKey) alone, conflicts not yet marked. Search results are
    visited for rows that need them."""
    pages = pages or Pages(inputs)
    catalogue = inputs.catalogue if keys is None else inputs.catalogue.join(keys, KEY, "left_semi")
    rows = assemble.official_domains(catalogue, inputs.domain_map)
    own = [
        assemble.override_candidates(rows, inputs.overrides), assemble.direct_candidates(rows), pages.of(assemble.pages_for_row(rows)),
    ]
    if inputs.searches is not None:
        have = own[0].select(KEY).unionByName(own[1].select(KEY)).unionByName(own[2].select(KEY))
        lacking = assemble.needs_search(rows, have)
        own.append(pages.of(assemble.rank_search_results(inputs.searches, lacking)))
    ranked = scoring.rank_candidates(scoring.candidate_score(assemble.assemble_candidates(*own), rows))
    judged = scoring.judge(ranked, rows, inputs.fetched, rejected, inputs.overrides)
    return scoring.select_best(judged, rows)


def acquire(inputs: Inputs, rejected: DataFrame) -> DataFrame:
    """One result a catalogue row, conflicts marked."""
    return conflicts.mark_conflicts(staged(best_candidates(inputs, rejected), "best-candidates"))


def resume(inputs: Inputs, prior: DataFrame, files: DataFrame, rejected: DataFrame) -> DataFrame:
    """The results of the catalogue, conflicts marked: staged prior ones whose file, (path), exists stand, and only the
    other rows are acquired."""
    kept, todo = review.resume_split(inputs.catalogue, prior, files)
    new = best_candidates(inputs, rejected, todo.select(KEY))
    return conflicts.mark_conflicts(staged(review.upsert(kept, new, KEY), "resumed"))


def acquire_overrides(inputs: Inputs, prior: DataFrame, rejected: DataFrame) -> DataFrame:
    """prior with the results of rows that have an override and aren't staged acquired anew; other rows and all marks
    stay as they are."""
    todo = review.override_todo(inputs.catalogue, inputs.overrides, prior)
    return review.upsert(prior, staged(best_candidates(inputs, rejected, todo.select(KEY)), "overridden"), KEY)


def proposed(inputs: Inputs, results: DataFrame) -> DataFrame:
    """The overrides with those that rendered pages propose for rows still without a staged image."""
    if inputs.rendered is None or inputs.rendered_searches is None:
        return inputs.overrides
    rows = assemble.official_domains(inputs.catalogue, inputs.domain_map)
    wanted = assemble.rank_search_results(inputs.rendered_searches, rows, rendered=True).filter(F.col("page_ord") <= assemble.RENDERED_VISITS)
    items = extract.rendered_candidates(inputs.rendered).withColumn("visited", F.col("page_url"))
    items = items.select("*", *[F.lit("").alias(c) for c in ("structured_product_name", "structured_brand")])
    found = assemble.join_page_candidates(wanted, items)
    return scoring.propose_overrides(scoring.candidate_score(found, rows), results, inputs.overrides)


@dataclass
class Acquired:
    """What a pass leaves to the next one."""

    found: DataFrame  # a result a row, as of before conflicts are marked
    counts: DataFrame  # conflicts.identity_counts() of found
    results: DataFrame  # found with conflicts marked, but approved rows as they were when approved


def advance(inputs: Inputs, rejected: DataFrame, before: Acquired | None, changed: DataFrame | None, done: DataFrame | None, pages: Pages, stored: Callable[[DataFrame, str], DataFrame]) -> Acquired:
    """What a pass over the whole catalogue would find, from what the pass before found and the keys that changed.

    Only changed rows are acquired. Conflicts are counts by digest and identity, to which old and new results of changed
    rows are a difference; marks are looked up anew for rows with a digest that it touches. done: keys whose results
    stay as they are.
    """
    new = stored(best_candidates(inputs, rejected, changed, pages), "found-now")
    kinds = list(conflicts.KINDS)
    marked = lambda rows, bad: conflicts.mark(rows, {k: bad.filter(F.col("kind") == k) for k in kinds})
    if before is None or changed is None:
        counts = stored(conflicts.identity_counts(new), "counts")
        return Acquired(new, counts, stored(marked(new, stored(conflicts.conflicting(counts), "conflicts")), "results"))
    total, change = conflicts.changed_counts(before.counts, before.found.join(changed, KEY, "left_semi"), new)
    counts, change = stored(total, "counts"), stored(change, "changed-counts")
    found = stored(review.upsert(before.found, new, KEY), "found")
    touched = change.select("kind", "digest").distinct()
    digests = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("digest")) for k, c in conflicts.KINDS.items()])
    hit = found.select(KEY, F.inline(digests)).join(touched, ["kind", "digest"], "left_semi").select(KEY)
    anew = hit.unionByName(changed.select(KEY)).distinct()
    if done is not None:
        anew = anew.join(done, KEY, "left_anti")
    rows = stored(found.join(anew, KEY, "left_semi"), "to-mark")
    bad = stored(conflicts.conflicting(counts, rows), "conflicts")
    return Acquired(found, counts, stored(review.upsert(before.results, marked(rows, bad), KEY), "results"))


def _differing(now: DataFrame, before: DataFrame) -> DataFrame:
    """Keys of rows that only one of two tables has."""
    before = before.select(now.columns)
    return now.exceptAll(before).select(KEY).unionByName(before.exceptAll(now).select(KEY))


def run_passes(spark: SparkSession, inputs: Inputs, verify, rejected: DataFrame, folder: str, model: str, now: str, passes: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results, review, rejected) after up to so many passes of acquisition, verification and retries.

    verify: staged results to (immutableKey, status, payload, error). The first pass acquires every row, later ones those
    that are requeued, newly overridden or newly rejected; results are those of passes over all rows. Each pass ends in
    tables under folder, so that lineage doesn't grow from pass to pass. Passes stop once every row is approved.
    """
    state = changed = done = sheet = None
    pages = Pages(inputs)
    total = inputs.catalogue.count()
    for n in range(passes):
        stored = partial(_stored, spark, f"{folder}/pass{n}")
        if state is not None:
            overrides = stored(proposed(inputs, last), "overrides")
            changed = stored(changed.unionByName(_differing(overrides, inputs.overrides.select(overrides.columns))).distinct(), "changed")
            inputs = replace(inputs, overrides=overrides)
            done = stored(sheet.filter(f"manualVisualDecision = '{review.APPROVED}'").select(KEY), "approved")
        state = advance(inputs, rejected, state, changed, done, pages, stored)
        results = state.results
        empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in review.SHEET))
        sheet = review.merge_review_sheet(results, empty if sheet is None else sheet)
        waiting = review.pending_verification(inputs.catalogue, results, sheet, resume=True).select(KEY)
        verified = stored(verify(results.join(waiting, KEY, "left_semi")), "verified")
        before = rejected
        rejected = stored(review.upsert_rejected(rejected, review.new_rejections(sheet, verified, results, now)), "rejected")
        sheet = review.full_review(inputs.catalogue, review.apply_verifications(sheet, verified, inputs.catalogue, results, model, now))
        sheet = stored(sheet, "review")
        if sheet.filter(f"manualVisualDecision = '{review.APPROVED}'").count() == total or n == passes - 1:
            return results, sheet, rejected
        last, sheet, _ = review.prepare_retry(results, sheet, include_review=True)
        last, sheet = stored(last, "retry-results"), stored(sheet, "retry-review")
        requeued = last.filter(F.col("status") == review.RETRY).select(KEY)
        keys = ["immutableKey", "resolvedImageUrl"]
        changed = stored(requeued.unionByName(_differing(rejected.select(keys), before.select(keys))).distinct(), "requeued")
    raise ValueError("at least one pass is needed")


def _stored(spark: SparkSession, folder: str, df: DataFrame, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")


def gate(inputs: Inputs, results: DataFrame, sheet: DataFrame, images: DataFrame, source: DataFrame, expected: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(approved catalogue, regional catalogue, summary) by the fail-closed gate."""
    gated = publish.validate_rows(inputs.catalogue, results, sheet, images)
    approved = publish.approved_catalogue(gated)
    return approved, publish.rebuild_regional(source, approved), publish.validation_summary(gated, source, expected)


def finish(inputs: Inputs, results: DataFrame, sheet: DataFrame, images: DataFrame, source: DataFrame, expected: int, per_page: int = 100) -> dict[str, DataFrame]:
    """What follows the passes: the queue of what people must still decide, the gate's parts, and the status."""
    approved, regional, summary = gate(inputs, results, sheet, images, source, expected)
    return {
        "queue": publish.review_queue(inputs.catalogue, results, sheet, per_page), "approved": approved, "regional": regional, "summary": summary,
        "status": publish.status_report(inputs.catalogue, results, sheet, images),
    }
