"""Insert-only loads (L15-L17, L19-L24) as Structured Streaming jobs.

The batch loads read a source table by id above the target's high-water
mark; when the source lands as files, the same load runs as a stream: the
file source tracks what was read (checkpointed offsets), and each
micro-batch is inserted with the same insert-if-absent operator, so a
replayed batch after a failure inserts nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from arrears.operators.merge import insert_absent
from arrears.session import checkpoint_dir
from arrears.sources.io import exists


def insert_only_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                       keys: Sequence[str], query_name: str, checkpoint: str | None = None,
                       fmt: str = "parquet", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that appends each micro-batch's absent keys to the
    target table.  The checkpoint lives in the cluster's shared folder
    unless given."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    ckpt = checkpoint or (checkpoint_dir(spark).rstrip("/") + f"/streams/{query_name}")

    def write_batch(batch: DataFrame, _batch_id: int) -> None:
        s = batch.sparkSession
        target = s.read.schema(schema).parquet(target_path) if exists(s, target_path) else s.createDataFrame([], schema)
        new = insert_absent(target, batch.select(*schema.fieldNames()), list(keys))
        new.write.mode("append").parquet(target_path)

    return (stream.writeStream.queryName(query_name).option("checkpointLocation", ckpt)
            .foreachBatch(write_batch).start())
