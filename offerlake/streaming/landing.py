"""Incremental bronze landing: new feed documents -> one dated landing per run.

A file stream with the ``availableNow`` trigger tells, exactly once (tracked in
the stream's checkpoint), which documents arrived since the last run.  All of
them are landed together, by the batch landing's own code and layout, so
positions are unique within the date and the date is immutable once committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.sources import bronze, feeds, published


def land_new_documents(spark: SparkSession, source_dir: str, bronze_root: str, name: str,
                       run_date: str, checkpoint: str) -> bool:
    """Land the documents that appeared in ``source_dir`` since the last run as ``run_date``;
    False when there were none.  A date that is already committed is an error: documents
    that arrive later belong to a later run."""
    docs = (spark.readStream.format("text").option("wholetext", "true")
                 .option("maxFilesPerTrigger", str(2**31 - 1)).load(source_dir)
                 .select(F.input_file_name().alias("file"), "value"))
    dest = bronze.partition_path(bronze_root, name, run_date)
    landed = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        own = f"batch{batch_id}"
        found = published.current(spark, dest)
        if found is not None and not found.startswith(f"{own}-"):
            raise feeds.MalformedFeedError(f"{dest} is already committed")
        if found is None:                                             # a replayed batch has landed before
            rows = feeds.explode_twin_map(batch) if name == "cross_site" else feeds.explode_records(batch)
            version = published.new_version(own)
            rows.write.parquet(f"{dest}/{version}")
            if published.publish(spark, dest, version, exclusive=True) != version:
                raise feeds.MalformedFeedError(f"{dest} is already committed")
        landed.append(batch_id)

    q = (docs.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return bool(landed)
