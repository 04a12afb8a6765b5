"""Tables between steps in the folder that the cluster shares, and global ranks by range partitions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where unset, a session on this machine alone, as in
    tests, gets one of its own; on a cluster no folder of the driver will do."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here and lost executors lose nothing."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, group: list[str], order: list[str], partitions: int, rank: str, name: str) -> DataFrame:
    """Rank from 0 within each group by order, as a staged table, with no task that holds a whole group.

    Rows are range-partitioned by (group, order), so a large group spreads over many tasks. Spark's row ids give the
    place within a partition; how many rows of the group earlier partitions hold comes from a table with one row for
    each (partition, group on one of its edges): groups inside one partition need no offset. Rows that tie in order are
    ranked in either order among themselves.
    """
    spark = df.sparkSession
    cols = [F.col(c) for c in (*group, *order)]
    placed = staged(
        df.repartitionByRange(partitions, *cols).sortWithinPartitions(*cols).withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(part.alias("_part"), *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    placed = placed.withColumn("_part", part)
    # A group lies in consecutive partitions. Only a partition's first and last run can go on in another partition.
    runs = staged(runs, name + "-runs")
    edge = runs.groupBy("_part").agg(F.min("_first").alias("_lo"), F.max("_first").alias("_hi"))
    edges = runs.join(F.broadcast(edge), "_part").filter("_first = _lo or _first = _hi")
    before = F.coalesce(
        F.sum("_n").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    edges = edges.withColumn("_before", before).filter("_before > 0").select("_part", *group, "_before")
    firsts = runs.drop("_n")
    keys = ["_part", *group]
    same = [placed[k].eqNullSafe(firsts[k]) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    out = placed.join(firsts, cond, "inner").select(*[placed[c] for c in placed.columns], firsts["_first"])
    same = out["_part"] == edges["_part"]
    for k in group:
        same = same & out[k].eqNullSafe(edges[k])
    out = out.join(edges, same, "left").select(
        *[out[c] for c in df.columns], (out["_at"] - out["_first"] + F.coalesce(edges["_before"], F.lit(0))).alias(rank)
    )
    return out


def previous(df: DataFrame, group: list[str], order: list[str], value: str, out: str, name: str) -> DataFrame:
    """df with out: the value of the row before in each group by order, null for a group's first row; no task holds a
    whole group.

    Rows are range-partitioned by (group, order) and look back inside their partition. Only a partition's first row looks
    into another one: from one row for each partition with its last row's group and value.
    """
    cols = [F.col(c) for c in (*group, *order)]
    parts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # several a task, so that tasks come out even
    placed = staged(df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols).withColumn("_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_own", F.struct(*group)).withColumn("_value", F.struct(value))
    inside = Window.partitionBy("_part").orderBy("_at")
    looked = placed.withColumn("_of", F.lag("_own").over(inside)).withColumn("_was", F.lag("_value").over(inside))
    ends = placed.groupBy("_part").agg(F.min("_at").alias("_first"), F.max_by(F.struct("_own", "_value"), "_at").alias("_end"))
    carried = ends.withColumn("_end", F.lag("_end").over(Window.orderBy("_part"))).select("_first", "_end")  # a row a partition
    met = looked.join(F.broadcast(carried), looked["_at"] == carried["_first"], "left")
    of, was = F.coalesce("_of", "_end._own"), F.coalesce("_was", "_end._value")
    return met.select(*df.columns, F.when(of.eqNullSafe(F.col("_own")), was[value]).alias(out))
