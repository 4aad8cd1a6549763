"""Tables of key ranges that an update rewrites only where it changed.

A run writes the new rows of the ranges it touched into a folder of its own,
``run=<id>/range=<n>/``, and then replaces one small file, ``_current``, that
names the folder of every range.  That replacement is the publication: until
then readers see the old table whole, after it the new one, and a run that dies
before it has changed nothing.  No row is written twice, untouched ranges keep
their files, and the file also carries the run's counts, so that a run which
died between publishing and logging can still be logged with its true figures.

``_current`` has one entry per range.  ``sweep`` deletes the folders that neither
it nor the state before it names; the latter stays for readers that began earlier.
A table has one writer at a time, as the load jobs have.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.sources import io

CURRENT = "_current"
RANGE = "range"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place in one step: readers see the old or the new one."""
    temp, fs = _path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(temp), fs.makeQualified(target), how)


class RangeTable:
    """A table at ``path`` whose rows lie in ranges of ``width`` values of the
    integer column ``key`` (rows without a key in range -1)."""

    def __init__(self, spark: SparkSession, path: str, key: str, width: int, schema: T.StructType):
        self.spark, self.path, self.key, self.width, self.schema = spark, path.rstrip("/"), key, width, schema

    def range_of(self) -> Column:
        return F.coalesce(io.key_range(self.key, self.width), F.lit(-1)).cast("long")

    def state(self) -> dict:
        """``ranges`` (range to run), ``last`` (id and counts of the run that published it) and ``before`` (the ranges it replaced)."""
        text = read_text(self.spark, f"{self.path}/{CURRENT}")
        return json.loads(text) if text else {"ranges": {}, "before": {}, "last": None}

    def _folder(self, run: str, n) -> str:
        return f"{self.path}/run={run}/{RANGE}={n}"

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The table, or only some of its ranges: no other folder is listed or read."""
        ranges = self.state()["ranges"]
        chosen = ranges if only is None else {str(n): ranges[str(n)] for n in only if str(n) in ranges}
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(self._folder(run, n) for n, run in chosen.items()))

    def touched(self, staged: DataFrame) -> list[int]:
        """The ranges that staged rows fall in: at most as many values as the table has ranges."""
        return sorted(r[0] for r in staged.select(self.range_of().alias("n")).distinct().collect())

    def rewrite(self, new: DataFrame, touched: list[int], run: str, source_rows: int, action: str = "acao") -> dict:
        """Write the marked new rows of the touched ranges once and publish them.

        The I / U counts are observed by that write.  Rows are dealt by range
        with a rebalance, so a large range is written by several tasks and small
        ones share a task.  Nothing touched: nothing is written or published.
        """
        counts = {"linhas_origem": source_rows, "linhas_inseridas": 0, "linhas_atualizadas": 0, "linhas_totais_destino": 0}
        state = self.state()
        if touched:
            seen = Observation()
            marked = new.observe(seen, F.count(F.when(F.col(action) == "I", 1)).alias("i"), F.count(F.when(F.col(action) == "U", 1)).alias("u"))
            rows = marked.drop(action).select(*self.schema.fieldNames(), self.range_of().alias(RANGE))
            rows.hint("rebalance", F.col(RANGE)).write.partitionBy(RANGE).parquet(f"{self.path}/run={run}")
            i, u = int(seen.get["i"]), int(seen.get["u"])
            counts |= {"linhas_inseridas": i, "linhas_atualizadas": u, "linhas_totais_destino": i + u}
        ranges = {**state["ranges"], **{str(n): run for n in touched}}
        self.publish({"ranges": ranges, "before": state["ranges"], "last": {"run": run, "counts": counts}})
        return counts

    def publish(self, state: dict) -> None:
        p, fs = _path(self.spark, self.path)
        fs.mkdirs(p)
        write_text(self.spark, f"{self.path}/{CURRENT}", json.dumps(state))

    def sweep(self) -> int:
        """Delete folders that neither the current nor the former state names; returns how many."""
        state = self.state()
        kept = {(run, str(n)) for ranges in (state["ranges"], state["before"]) for n, run in ranges.items()}
        p, fs = _path(self.spark, self.path)
        gone = 0
        for top in (fs.listStatus(p) if fs.exists(p) else []):
            run = top.getPath().getName()
            if not run.startswith("run="):
                continue
            parts = [f.getPath() for f in fs.listStatus(top.getPath()) if f.getPath().getName().startswith(f"{RANGE}=")]
            old = [x for x in parts if (run[4:], x.getName().split("=", 1)[1]) not in kept]
            for x in old:
                fs.delete(x, True)
            if len(old) == len(parts):
                fs.delete(top.getPath(), True)
            gone += len(old)
        return gone


class DayTable(RangeTable):
    """The same for a table whose ranges are the days of a date column."""

    def __init__(self, spark: SparkSession, path: str, day: str, schema: T.StructType):
        super().__init__(spark, path, day, 1, schema)

    def range_of(self) -> Column:
        return F.coalesce(F.unix_date(F.col(self.key)), F.lit(-1)).cast("long")


def is_range_table(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, f"{path.rstrip('/')}/{CURRENT}")
    return bool(fs.exists(p))


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a stored table of either kind; none where nothing is stored yet."""
    if is_range_table(spark, path):
        return RangeTable(spark, path, "", 1, schema).read()
    if not io.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
