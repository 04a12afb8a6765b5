"""Sharding by balanced label propagation: linked documents gather in shards of equal row counts.

DataFrame functions only. Documents of equal text are linked. Members of a group that lie in one shard are alike, so the
state is a row for each group and shard with a count, whatever a group's size. In each round, groups ask to move their
outlying members to the shard that holds most of them; shards with room admit them up to their quota, and between full
ones as many go either way. Unlinked documents then fill every shard to the same number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogue_evidence.llm.common import ranked, staged

ROUNDS = 12
MEMBERS = 256  # of a group, whose places are looked up together
LEAST = 1e-4  # of the pairs that lie in one shard, by which a round must raise them for another to follow
BLOCK = 200_000  # rows whose sums are run up in one task


def _base(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("digest"),
    )


def _goals(state: DataFrame) -> DataFrame:
    """(digest, total, target): of groups in several shards, the one that holds most of them, of ties one by a hash."""
    pick = F.struct("cnt", F.xxhash64("digest", "shard").alias("tie"), "shard")
    goals = state.groupBy("digest").agg(F.max(pick).alias("best"), F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("n_shards"))
    return goals.filter("n_shards > 1").select("digest", "total", F.col("best.shard").alias("target"))


def _upto(rows: DataFrame, keys: list[str], rank: Column | None = None) -> DataFrame:
    """rows with upto, the sum of cnt over the rows of the same keys up to each one, in order of rank, a small number, a
    hash and the digest. Sums of blocks come first, so no task orders more than a block. rows should be stored."""
    blocks = max(1, -(-rows.count() // BLOCK))
    block = F.pmod(F.xxhash64("digest"), F.lit(blocks))
    rows = rows.withColumn("block", block if rank is None else block + rank * blocks)
    sums = rows.groupBy(*keys, "block").agg(F.sum("cnt").alias("sum"))
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"_{k}") for k in (*keys, "block")], F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    same = F.col("block") == F.col("_block")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    inside = F.sum("cnt").over(Window.partitionBy(*keys, "block").orderBy("digest", "shard"))
    return rows.join(sums, same).withColumn("upto", F.col("before") + inside).drop("block", "before", *[f"_{k}" for k in (*keys, "block")])


def _moved(state: DataFrame, moves: DataFrame) -> DataFrame:
    """state after moves (digest, shard, target, moved)."""
    done = moves.filter("moved > 0").select("digest", F.inline(F.array(
        F.struct(F.col("shard").alias("shard"), (-F.col("moved")).alias("cnt")),
        F.struct(F.col("target").alias("shard"), F.col("moved").alias("cnt")),
    )))
    return state.unionByName(done).groupBy("digest", "shard").agg(F.sum("cnt").alias("cnt")).filter("cnt > 0")


def _into_room(state: DataFrame, quota: int, shards: int) -> DataFrame | None:
    """Moves of groups' members to the shard with room that holds most of them, or else to the emptiest; members in full
    shards join them there, unless they are most of such a shard. None if nobody asks for any. A shard admits larger groups
    first, and exactly as many as it has room for."""
    spark = state.sparkSession
    load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("cnt").alias("n")).collect()}  # a row a shard
    free = {s: max(0, quota - load.get(s, 0)) for s in range(shards)}
    emptiest = max(free, key=lambda s: (free[s], -s))
    if not free[emptiest]:
        return None
    room = F.broadcast(spark.createDataFrame(list(free.items()), "home int, free long"))  # a row a shard
    placed = state.join(room, state["shard"] == room["home"]).drop("home")
    pick = F.struct("cnt", F.xxhash64("digest", "shard").alias("tie"), "shard", "free")
    best = F.max(F.when(F.col("free") > 0, pick)).alias("best")
    goals = placed.groupBy("digest").agg(best, F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("n_shards")).filter("n_shards > 1").select(
        "digest", "total", F.coalesce("best.shard", F.lit(emptiest)).alias("target"), F.coalesce("best.free", F.lit(free[emptiest])).cast("long").alias("open"),
    )
    free_to_go = (F.col("free") > 0) | (F.col("cnt") <= quota / 2)
    asked = placed.join(goals, "digest").filter((F.col("shard") != F.col("target")) & (F.col("open") > 0) & free_to_go)
    asked = staged(asked.select("digest", "shard", "target", "cnt", "open", "total"), "shard-moves")
    if asked.isEmpty():
        return None
    ahead = _upto(asked, ["target"], 63 - F.floor(F.log2("total"))).withColumn("ahead", F.col("upto") - F.col("cnt"))
    return ahead.select("digest", "shard", "target", F.greatest(F.lit(0), F.least("cnt", F.col("open") - F.col("ahead"))).alias("moved"))


def _swaps(state: DataFrame, quota: int) -> DataFrame | None:
    """Moves between full shards: of the members that wish to go from one shard to another and from that one back, as many
    go either way, larger groups first and in part where need be, so no shard's count changes. Shards that a group fills
    alone are settled. None if no two shards have wishes to exchange."""
    open_ = state.filter(F.col("cnt") < quota)
    asked = open_.join(_goals(open_), "digest").filter(F.col("shard") != F.col("target")).select("digest", "shard", "target", "cnt", "total")
    asked = staged(asked, "shard-wishes")
    wishes = asked.groupBy("shard", "target").agg(F.sum("cnt").alias("n"))  # a row for each two shards
    back = wishes.select(F.col("shard").alias("_to"), F.col("target").alias("_from"), F.col("n").alias("_n"))
    both = wishes.join(back, (F.col("shard") == F.col("_from")) & (F.col("target") == F.col("_to")))
    both = staged(both.select(F.col("shard").alias("_a"), F.col("target").alias("_b"), F.least("n", "_n").alias("most")), "shard-swaps")
    if both.isEmpty():
        return None
    ranked_ = _upto(asked, ["shard", "target"], 63 - F.floor(F.log2("total"))).join(F.broadcast(both), (F.col("shard") == F.col("_a")) & (F.col("target") == F.col("_b")))
    return ranked_.select("digest", "shard", "target", F.greatest(F.lit(0), F.least("cnt", F.col("most") - (F.col("upto") - F.col("cnt")))).alias("moved"))


def _between_two(state: DataFrame) -> DataFrame | None:
    """Moves of groups that lie in just two shards into either of them, so many each way that no shard's count changes. Of
    the groups between shards a and b, with x members in a and y in b, a first part goes to b and the rest to a: the
    sums of x moved and y moved are equal where the sum of x + y over the first part is that of y over all. The one
    group at that place makes up the difference, so at most one group for each two shards stays split."""
    split = state.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("shard").alias("a"), F.max("shard").alias("b"), F.min_by("cnt", "shard").alias("x"), F.max_by("cnt", "shard").alias("y"))
    two = staged(split.filter("n = 2").select("digest", "a", "b", "x", "y", (F.col("x") + F.col("y")).alias("cnt"), F.col("a").alias("shard")), "shards-of-two")
    if two.isEmpty():
        return None
    sums = two.groupBy(F.col("a").alias("_x"), F.col("b").alias("_y")).agg(F.sum("y").alias("all_y"))  # a row for each two shards
    placed = _upto(two, ["a", "b"]).join(F.broadcast(sums), (F.col("a") == F.col("_x")) & (F.col("b") == F.col("_y")))
    left = F.col("all_y") - (F.col("upto") - F.col("cnt"))  # of that sum, before this group
    to_b = F.when(F.col("upto") <= F.col("all_y"), F.col("x")).when(left > 0, F.greatest(F.lit(0), left - F.col("y"))).otherwise(0)
    to_a = F.when(F.col("upto") <= F.col("all_y"), 0).when(left > 0, F.greatest(F.lit(0), F.col("y") - left)).otherwise(F.col("y"))
    both = F.array(F.struct(F.col("a").alias("shard"), F.col("b").alias("target"), to_b.alias("moved")), F.struct(F.col("b").alias("shard"), F.col("a").alias("target"), to_a.alias("moved")))
    return placed.select("digest", F.inline(both))


def propagate(start: DataFrame, quota: int, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(digest, shard, cnt): where the members of linked groups end up, no shard holding more than quota of them if
    the start has none that does. start: (digest, shard, cnt). A round moves members into free room, swaps those that
    wish to go either way between two shards, and settles groups that lie in two; rounds end when linked pairs in one
    shard hardly grow."""
    state, joined = staged(start, "shards"), 0.0
    for _ in range(rounds):
        for moves in (lambda: _into_room(state, quota, shards), lambda: _swaps(state, quota), lambda: _between_two(state)):
            found = moves()
            if found is not None:
                state = staged(_moved(state, found), "shards")
        before, joined = joined, state.agg(F.sum(F.col("cnt").cast("double") * F.col("cnt")).alias("n")).first()["n"] or 0.0
        if joined <= before * (1 + LEAST):
            break
    return state


def levelled(state: DataFrame, sizes: list[int]) -> DataFrame:
    """state with what is beyond a shard's size moved to shards below theirs, as far as members of a group that lie in one
    shard can stay together; what can't is fewer than a group's members for each two shards."""
    spark = state.sparkSession
    load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("cnt").alias("n")).collect()}  # a row a shard
    over, gaps, at, upto = [], [], 0, 0
    for s, size in enumerate(sizes):
        n = load.get(s, 0)
        if n > size:
            over.append((s, n - size, upto))
            upto += n - size
        elif n < size:
            gaps.append((s, at, at + size - n))
            at += size - n
    if not over or not gaps:
        return state
    excess = F.broadcast(spark.createDataFrame(over, "_of int, excess long, _base long"))  # a row a shard, like gaps
    room = F.broadcast(spark.createDataFrame(gaps, "target int, lo long, hi long"))
    full = staged(state.join(excess, F.col("shard") == F.col("_of")).filter(F.col("cnt") <= F.col("excess")), "shards-over")
    go = _upto(full, ["shard"]).filter(F.col("upto") <= F.col("excess"))
    begin, end = F.col("_base") + F.col("upto") - F.col("cnt"), F.col("_base") + F.col("upto")
    moves = go.join(room, (begin >= F.col("lo")) & (end <= F.col("hi"))).select("digest", "shard", "target", F.col("cnt").alias("moved"))
    return staged(_moved(state, moves), "shards")


def _hashed(shards: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(shards)).cast("int")


def shard(docs: DataFrame, shards: int = 16, rounds: int = ROUNDS, rows_in_task: int = 250_000) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row for each row of docs. The law is rows.

    size is the text's UTF-8 bytes plus 1, text_crc32 of those bytes; a null text has none of them, and null texts are
    a group of their own. Shards hold row counts at most one apart, the first ones more. slot counts a shard's rows from
    0. Rows are ranked over range partitions, so neither a shard nor a group is any task's. Equal rows and null doc_ids
    are placed like others. grown_shard is null under this law. No rows give no rows.
    """
    base = _base(docs)
    n = base.count()
    parts = max(1, -(-n // rows_in_task))
    base = ranked(base, ["digest"], ["doc_id"], max(parts, 8), "member", "documents-by-text")
    base = staged(base, "documents-by-text")
    quota = n // shards
    sizes = [quota + (s < n % shards) for s in range(shards)]
    spark = docs.sparkSession
    groups = base.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Every member starts in a shard of its own choice, so a group starts evenly spread: counts by member number.
    spread = groups.select("digest", "n", F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(shards)) - 1)).alias("k"))
    start = spread.select(
        "digest",
        F.pmod(F.xxhash64("digest") + F.col("k"), F.lit(shards)).cast("int").alias("shard"),
        ((F.col("n") - F.col("k") - 1 + F.lit(shards)) / shards).cast("long").alias("cnt"),
    )
    state = levelled(propagate(start, quota, shards, rounds), sizes)
    # Members take the places of their group in order of their numbers: (shard, from, to) for each group.
    upto = F.sum("cnt").over(Window.partitionBy("digest").orderBy("shard"))  # at most as many rows as shards
    place = state.select("digest", "shard", (upto - F.col("cnt")).alias("lo"), upto.alias("hi"))
    place = place.groupBy("digest").agg(F.collect_list(F.struct("lo", "hi", "shard")).alias("places"), F.max("hi").alias("size_of"))
    # A group's places are dealt out by blocks of its members, so that no group's rows meet in one task.
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size_of") - 1) / MEMBERS))).alias("of_block")
    place = place.select(F.col("digest").alias("linked"), "places", blocks)
    base = base.withColumn("block", F.floor(F.col("member") / MEMBERS))
    met = base.join(place, (base["digest"] == place["linked"]) & (base["block"] == place["of_block"]), "left")
    inside = F.filter("places", lambda p: (p["lo"] <= F.col("member")) & (F.col("member") < p["hi"]))
    met = met.select(
        "doc_id", "size", "text_crc32", "digest",
        F.coalesce(F.get(inside, F.lit(0))["shard"], _hashed(shards, "digest", "doc_id")).alias("shard"),
        F.col("linked").isNull().cast("int").alias("free"),
    )
    # Linked rows come first in each shard; what is past a shard's size moves to the places that others have left.
    placed = staged(ranked(met, ["shard"], ["free", "digest", "doc_id"], max(parts, 8), "slot", "documents-by-shard"), "documents-by-shard")
    load = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}  # a row a shard
    limits, vacant, over = [], [], 0
    for s in range(shards):
        have = load.get(s, 0)
        limits.append((s, sizes[s]))
        if have < sizes[s]:
            vacant.append((s, over, over + sizes[s] - have, have))
            over += sizes[s] - have
    limit = F.broadcast(spark.createDataFrame(limits, "of int, most long"))
    gaps = F.broadcast(spark.createDataFrame(vacant, "to int, lo long, hi long, have long"))
    placed = placed.join(limit, placed["shard"] == F.col("of")).drop("of")
    stay = placed.filter("slot < most").select("doc_id", "size", "text_crc32", "shard", "slot")
    extra = placed.filter("slot >= most").select("doc_id", "size", "text_crc32", F.lit(0).alias("all"), "shard", "slot")
    extra = ranked(extra, ["all"], ["shard", "slot"], max(parts, 8), "at", "documents-moved")
    move = extra.join(gaps, (F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi"))).select(
        "doc_id", "size", "text_crc32", F.col("to").alias("shard"), (F.col("have") + F.col("at") - F.col("lo")).alias("slot")
    )
    return stay.unionByName(move).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
