"""Helpers shared by the operators: inputs, scratch tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Spark removes the shuffle files of a query at its end, else when the driver happens to collect its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run within leave no shuffle files."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


class Scratch:
    """Tables of one operator run under the shared checkpoint folder.

    Each is written once and read back, so lineage is cut by a copy that any
    executor can read, and the shuffle files behind it go at once; ``drop`` frees
    one that no later plan needs.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_removed(self.spark):
            df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(name))
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def connected_components(edges: DataFrame, scratch: Scratch, label: str = "cc") -> DataFrame:
    """Components of an undirected graph as ``(node, component)``, the
    component being its smallest node; ``edges`` has columns ``a``, ``b``.

    Distributed union-find by alternating large-star and small-star steps:
    each hooks every neighbour of a node onto the smallest node around it, so
    the edge set shrinks to one star per component in a logarithmic number of
    rounds.  The minimum is pre-aggregated and joined back, so a hub's edges
    are split like those of any skewed join.  Self loops and repeated edges
    are harmless; a null end is no edge; without edges the result is empty.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e, state = _written(e, scratch, f"{label}-0")
    i = 0
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        i += 1
        before = state
        e, state = _written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), scratch, f"{label}-{i}")
        scratch.drop(f"{label}-{i - 1}")
        if state == before:
            break
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _written(e: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, tuple]:
    """The edges written, and their number and a sum that tells sets of edges apart."""
    seen = Observation()
    e = scratch.table(e.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")), name)
    return e, (seen.get["n"], seen.get["s"])
