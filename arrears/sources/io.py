"""Scans and sinks (S1-S3, K1, K2, K6) and the staged overwrite.

Parquet tables in Spark reject ``UPDATE`` / ``MERGE`` and overwriting a
table the plan reads from, so a table update is: compute the new state
lazily, write it as a staged table in the cluster's shared checkpoint
folder (this cuts the lineage), then overwrite the target from the staged
copy.  A lost executor during either write only re-runs its tasks from
durable inputs; if the whole job dies during the overwrite, ``recover``
restores the target from the complete staged copy.
"""

from __future__ import annotations

from collections.abc import Sequence

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from arrears.session import checkpoint_dir

# Bookkeeping columns a staged copy may carry that the table does not.
STAGE_ONLY_COLS = ("acao", "na_origem")


def read_source(spark: SparkSession, path: str, schema: T.StructType | None = None,
                columns: Sequence[str] | None = None, fmt: str = "parquet",
                char_cols: Sequence[str] = ()) -> DataFrame:
    """Scan with a declared schema and an explicit column list;
    only the listed columns reach the Parquet ``ReadSchema``.  ``char_cols``
    are fixed-width ``char(n)`` columns: their trailing blanks are trimmed
    on read, since the source ignores them in comparisons and Spark does
    not (D8; comparisons stay case-sensitive)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    if columns:
        df = df.select(*columns)
    return trim_char_columns(df, char_cols)


def trim_char_columns(df: DataFrame, char_cols: Sequence[str]) -> DataFrame:
    """``rtrim`` of fixed-width text columns."""
    from pyspark.sql import functions as F
    present = [c for c in char_cols if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: F.rtrim(F.col(c)) for c in present})


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table of another database (``db.table``)."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_remote(spark: SparkSession, options: dict, where: Column | None = None,
                columns: Sequence[Column | str] | None = None) -> DataFrame:
    """S3: a remote table (``format`` + options, e.g. JDBC).  Projection and
    filter are plain DataFrame ops; Catalyst pushes the filter and the
    column list to the source."""
    opts = dict(options)
    fmt = opts.pop("format", "jdbc")
    df = spark.read.format(fmt).options(**opts).load()
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is stored at ``path``.  Only a missing path counts as
    "no table yet"; any other error is raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p))


def append(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """K1."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def staged_path(spark: SparkSession, target_path: str) -> str:
    """Deterministic staging location of a target, under the shared
    checkpoint folder (so a later run can find it for recovery)."""
    h = hashlib.sha1(target_path.rstrip("/").encode()).hexdigest()[:16]
    return checkpoint_dir(spark).rstrip("/") + f"/staged/{h}"


def _write(df: DataFrame, path: str, partition_by: Sequence[str] | None, dynamic: bool = False) -> None:
    # explicit either way: the session's own mode may be dynamic
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def stage(df: DataFrame, target_path: str) -> DataFrame:
    """Write the new state of a target whole to its staged location and
    return a frame reading it back: the lineage is cut there, and the copy
    is what ``recover`` restores from."""
    spark = df.sparkSession
    path = staged_path(spark, target_path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _publishing(spark: SparkSession, target_path: str, now: bool | None = None) -> bool:
    """Whether a publish of the target began and has not ended; ``now`` sets it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(staged_path(spark, target_path) + ".publishing")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if now is True:
        fs.create(p, True).close()
    elif now is False:
        fs.delete(p, False)
    return bool(fs.exists(p))


def publish(staged: DataFrame, path: str, partition_by: Sequence[str] | None = None,
            dynamic: bool = False) -> None:
    """Overwrite the target from a staged copy (all partitions, or only
    those present with ``dynamic``).  A marker beside the staged copy says
    that this has begun; it goes when the last file is in place."""
    keep = [c for c in staged.columns if c not in STAGE_ONLY_COLS]
    _publishing(staged.sparkSession, path, True)
    _write(staged.select(*keep), path, partition_by, dynamic=dynamic)
    _publishing(staged.sparkSession, path, False)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
            reads_target: bool = True) -> None:
    """Full replace.  When the new state is computed from the table
    itself it is first staged whole, then published over the target."""
    if not reads_target:
        _write(df, path, partition_by)
        return
    publish(stage(df, path), path, partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Snapshot update: overwrite only the partitions present in ``df``
    (dynamic partition overwrite), from a staged copy."""
    publish(stage(df, path), path, partition_by, dynamic=True)


def recover(spark: SparkSession, path: str, partition_by: Sequence[str] | None = None,
            dynamic: bool = False) -> bool:
    """Publish the staged state again when a job died while overwriting the
    target (its marker is still there), whether or not what it left behind
    can be read.  A table that is merely absent is left alone.  Returns True
    when it restored the table."""
    if not _publishing(spark, path):
        return False
    publish(spark.read.parquet(staged_path(spark, path)), path, partition_by, dynamic=dynamic)
    return True


def purge(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """K6: empty a table, keeping its schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def key_range(key: str, width: int) -> Column:
    """Partition value of a numeric key: its range of ``width`` ids.  New
    rows of an id-increasing table land in the newest ranges only."""
    from pyspark.sql import functions as F
    return F.floor(F.col(key) / F.lit(width)).cast("long")


def touched_partitions(target: DataFrame, staged: DataFrame, part_col: str) -> DataFrame:
    """The target rows in the partitions the staged rows fall in.

    The distinct partition values are read -- metadata, bounded by the
    number of partitions, as the file listing itself is -- and become a
    partition filter, so other partitions are neither listed nor read.  (A
    semi join would not do: Spark prunes by one only behind a selective
    filter, which a whole extract does not have.)
    """
    from pyspark.sql import functions as F
    values = [r[0] for r in staged.select(part_col).distinct().collect()]
    return target.filter(F.col(part_col).isin(values)) if values else target.filter(F.lit(False))


def apply_to_partitions(spark: SparkSession, target_path: str, staged: DataFrame, part_col: str,
                        compute, target_schema=None) -> DataFrame:
    """Rewrite only the partitions of a partitioned table that ``staged``
    touches: read those partitions, compute their new state with
    ``compute(target_slice, staged)`` (it must keep ``part_col``), stage it
    and publish it with dynamic partition overwrite.  Returns the staged
    new state (with any bookkeeping columns, e.g. ``acao``)."""
    recover(spark, target_path, [part_col], dynamic=True)
    reader = spark.read if target_schema is None else spark.read.schema(target_schema)
    target = reader.parquet(target_path)
    new = compute(touched_partitions(target, staged, part_col), staged)
    new = stage(new, target_path)
    publish(new, target_path, [part_col], dynamic=True)
    return new
