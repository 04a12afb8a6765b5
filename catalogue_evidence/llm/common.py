"""Small things that every corpus job needs: inputs and components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue_evidence.sources.shared import ranked, shared_dir, shared_path, staged

__all__ = ["components", "fresh", "ranked", "shared_dir", "shared_path", "staged", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, df: DataFrame) -> str:
    """name, with underscores behind it until df has no column of that name in either case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): each node of undirected edges (a, b) with the smallest node it reaches.

    Labels spread along edges as minima and then jump to their label's label, so rounds grow with the logarithm of the
    longest chain. Each round is a join and a map-side combined minimum; nothing reaches the driver but one count.
    """
    both = staged(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        name + "-edges",
    )
    labels = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), name)
    while True:
        sent = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), "label")
        own = labels.select("node", "label", F.col("label").alias("was"))
        low = (
            own.unionByName(sent.withColumn("was", F.lit(None).cast("long")))
            .groupBy("node")
            .agg(F.min("label").alias("label"), F.max("was").alias("was"))
        )
        low = staged(low, name)
        to = low.select(F.col("node").alias("to"), F.col("label").alias("next"))
        labels = staged(low.join(to, low["label"] == to["to"]).select("node", F.col("next").alias("label"), "was"), name)
        if labels.filter("label <> was").isEmpty():
            return labels.select("node", "label")
