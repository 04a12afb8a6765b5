"""A table by key in versions, each published in one step.

folder/data/<attempt>/bucket=B holds whole buckets of keys; folder/manifests/<version> names, for each bucket, the folder
that is current as of that version. A manifest is written under another name and renamed, so readers see a version whole
or not at all; what no kept manifest names is removed once a newer version stands.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64  # of a table's keys
KEPT = 3  # versions


class Folder:
    """Small files and folders of a file system that Spark reaches, by its own client."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name) if name else self.root

    def names(self, of: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(of))) if self.fs.exists(self.at(of)) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write a file in one step, unless there is one of that name."""
        if self.fs.exists(self.at(name)):
            return False
        parent, _, own = name.rpartition("/")
        hidden = f"{parent}/_{own}-{uuid.uuid4().hex}"
        stream = self.fs.create(self.at(hidden), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return self.fs.rename(self.at(hidden), self.at(name))

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


@dataclass
class Version:
    number: int
    schema: StructType
    buckets: dict[str, str]  # bucket -> folder under data/


def _name(number: int) -> str:
    return f"manifests/{number:020d}"


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The published versions that are still kept, in order."""
    return [int(n) for n in Folder(spark, folder).names("manifests") if n.isdigit()]


def version(spark: SparkSession, folder: str, upto: int | None = None) -> Version | None:
    """The newest published version, or the newest one of number upto or less."""
    found = [n for n in versions(spark, folder) if upto is None or n <= upto]
    if not found:
        return None
    m = json.loads(Folder(spark, folder).text(_name(found[-1])))
    return Version(found[-1], StructType.fromJson(m["schema"]), m["buckets"])


def snapshot(spark: SparkSession, folder: str, upto: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of a version, None if there is none yet; of some buckets alone if said. Only these folders are read."""
    v = version(spark, folder, upto)
    if v is None:
        return None
    paths = [f"{folder}/data/{p}/bucket={b}" for b, p in v.buckets.items() if buckets is None or int(b) in buckets]
    reader = spark.read.schema(v.schema)
    return reader.parquet(*paths) if paths else spark.createDataFrame([], v.schema)


def bucket_of(key: str, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_version(spark: SparkSession, folder: str, rows: DataFrame, number: int, merge, key: str, buckets: int = BUCKETS, kept: int = KEPT) -> bool:
    """Merge rows into the table as version `number`: merge(old, new) gives a touched bucket's rows from what it had.

    A version that stands already isn't written again, so that a batch may be replayed. One writer at a time.
    """
    before = version(spark, folder, number)
    if before is not None and before.number == number:
        return False
    new = rows.withColumn("bucket", bucket_of(key, buckets))
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # as many as there are buckets at most
    now = dict(before.buckets) if before else {}
    schema = rows.schema if before is None else before.schema
    if touched:
        old = snapshot(spark, folder, before.number, touched) if before else None
        out = new if old is None else merge(old.withColumn("bucket", bucket_of(key, buckets)), new)
        attempt = f"{number:020d}-{uuid.uuid4().hex}"
        out.repartition(min(len(touched), buckets), "bucket").write.partitionBy("bucket").parquet(f"{folder}/data/{attempt}")
        now |= {str(b): attempt for b in touched}
    Folder(spark, folder).publish(_name(number), json.dumps({"schema": schema.jsonValue(), "buckets": now}))
    retain(spark, folder, kept)
    return True


def retain(spark: SparkSession, folder: str, kept: int = KEPT) -> None:
    """Remove all but the newest `kept` versions, and the buckets and failed attempts that none of these names."""
    own = Folder(spark, folder)
    numbers = versions(spark, folder)
    for n in numbers[:-kept]:
        own.remove(_name(n))
    named = {f"{p}/bucket={b}" for n in numbers[-kept:] for b, p in json.loads(own.text(_name(n)))["buckets"].items()}
    attempts = {x.split("/")[0] for x in named}
    for attempt in own.names("data"):
        if attempt not in attempts:
            own.remove(f"data/{attempt}")
            continue
        for b in own.names(f"data/{attempt}"):
            if b.startswith("bucket=") and f"{attempt}/{b}" not in named:
                own.remove(f"data/{attempt}/{b}")
    for name in own.names("manifests"):
        if not name.isdigit():
            own.remove(f"manifests/{name}")
