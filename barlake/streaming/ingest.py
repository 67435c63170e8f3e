"""Upsert newly landed bar files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from barlake.schemas import DAILY_KLINE
from barlake.storage.tables import init_table, upsert


LEDGER = "landed_file STRING"


def ledger_path(table: str) -> str:
    """The landed files that the table at this path has taken in."""
    return f"{table.rstrip('/')}__landed"


def stream_upsert_bars(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    order: str = "ingest_seq",
    landing_id: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Upsert every landed Parquet file once, then stop; run again to pick up new files.

    The source remembers its files in ``checkpoint`` (a shared folder).  A batch that is
    replayed after a failure writes the same rows under the same keys, so nothing doubles.

    A ledger next to the table names the files that are in it, and a batch's rows of a file that is there already
    are left out.  So a stream that has lost its checkpoint and reads everything again does not put
    older values back.  The ledger is written after the table: where a batch breaks off in between, its
    files come again before any newer one and change nothing.

    Within one landing the first arrival of a key wins; a later landing replaces it.  If
    several landings may meet in one batch, ``landing_id`` names an increasing number per
    landing, and the result does not depend on how files are grouped into batches."""
    init_table(spark, table, DAILY_KLINE)
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(ledger_path(table))
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        known = session.read.schema(LEDGER).parquet(ledger_path(table))
        files = batch.select("landed_file").distinct().join(known, "landed_file", "left_anti").collect()  # one batch's
        batch = batch.join(known.distinct(), "landed_file", "left_anti").drop("landed_file")
        if landing_id:
            newest_first = F.struct((-F.col(landing_id)).alias("newest"), F.col(order))
            batch = batch.withColumn("arrival_rank", newest_first)
        upsert(session, table, DAILY_KLINE, batch, None, "arrival_rank" if landing_id else order)
        if files:
            session.createDataFrame(files, LEDGER).coalesce(1).write.mode("append").parquet(ledger_path(table))

    return (
        reader.parquet(landing)
        .select("*", F.col("_metadata.file_path").alias("landed_file"))
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
