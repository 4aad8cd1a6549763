"""Appends that happen exactly once (K1, A10).

A batch is written whole into a hidden folder of its table, ``_batches/<run>/``,
by one ordinary Spark write that also counts its rows.  A ledger file with those
counts is put beside it; from then on the batch will be in the table.  Its files
are then renamed into the table under names that begin with the run id.  A job
that dies in between leaves the ledger, and the next run renames what is left and
gets the counts: rows come once, and the volume row is the true one.  A batch
without a ledger was never complete and is deleted.

Renaming moves metadata only: rows are written once, against twice for a staged
copy that is appended afterwards.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears.sources.ranges import _path, read_text, write_text

FOLDER, LEDGER = "_batches", "ledger.json"


def _base(path: str) -> str:
    return f"{path.rstrip('/')}/{FOLDER}"


def append(df: DataFrame, path: str, run: str, source_rows: int | None = None, partition_by: list[str] | None = None) -> dict:
    """Append ``df`` as the batch ``run``; returns its counts."""
    prepare(df, path, run, source_rows, partition_by)
    return finish(df.sparkSession, path, run)


def prepare(df: DataFrame, path: str, run: str, source_rows: int | Callable[[int], int] | None, partition_by: list[str] | None = None) -> None:
    """Write the batch and its ledger; nothing of it is visible yet.
    ``source_rows`` may be a function of the batch's rows that is asked after
    the write (which may observe a count); without it the batch's own rows are the source rows (loads
    that count what is absent)."""
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{_base(path)}/{run}/rows")
    n = int(seen.get["n"])
    if callable(source_rows):
        source_rows = int(source_rows(n))
    counts = {"linhas_origem": n if source_rows is None else source_rows, "linhas_inseridas": n, "linhas_atualizadas": 0, "linhas_totais_destino": n}
    write_text(df.sparkSession, f"{_base(path)}/{run}/{LEDGER}", json.dumps(counts))


def finish(spark: SparkSession, path: str, run: str) -> dict:
    """Rename the files of a batch into the table (those that are still to be
    renamed) and return its counts; ``settle`` drops the ledger later."""
    counts = json.loads(read_text(spark, f"{_base(path)}/{run}/{LEDGER}"))
    rows, fs = _path(spark, f"{_base(path)}/{run}/rows")
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    if fs.exists(rows):
        prefix = rows.toUri().getPath()
        files = fs.listFiles(rows, True)
        while files.hasNext():
            f = files.next().getPath()
            if f.getName().startswith(("_", ".")):
                continue
            inside = f.toUri().getPath()[len(prefix):].strip("/").split("/")
            folder = jpath("/".join([path.rstrip("/"), *inside[:-1]]))
            fs.mkdirs(folder)
            fs.rename(f, jpath(folder, f"{run}-{inside[-1]}"))
    return counts


def open_batches(spark: SparkSession, path: str) -> dict[str, dict]:
    """Runs whose ledger is still there, with their counts, all finished by this
    call; batches that never got a ledger are deleted."""
    base, fs = _path(spark, _base(path))
    found = {}
    for f in (fs.listStatus(base) if fs.exists(base) else []):
        run = f.getPath().getName()
        if read_text(spark, f"{_base(path)}/{run}/{LEDGER}") is None:
            fs.delete(f.getPath(), True)
        else:
            found[run] = finish(spark, path, run)
    return found


def settle(spark: SparkSession, path: str, run: str) -> None:
    """Drop the ledger of a batch whose volume row is in the log."""
    p, fs = _path(spark, f"{_base(path)}/{run}")
    fs.delete(p, True)
