"""The METAR ingest as a Structured Streaming job.

CSV files dropped into a folder are parsed as they arrive (the same
``parse_metar`` as the batch load) and appended to a Parquet table
partitioned by year and month, each row tagged with its micro-batch id and
its position in the input (``_seq``).  Upsert semantics are resolved when the
table is read (``read_current``): per key, the row of the latest batch wins,
and within a batch the last in file order.  A micro-batch that is replayed
after a failure appends identical rows with the same order, which the read
collapses, so the sink is effectively idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from weatherlake import schema
from weatherlake.operators.upsert import upsert_last
from weatherlake.sources.metar_csv import CSV_OPTIONS, SEQ, parse_metar

BATCH = "_batch"


def raw_schema(columns: Sequence[str] = schema.RAW_COLUMNS) -> T.StructType:
    """All-text schema of the CSV files (a stream needs it up front)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def start_ingest(spark: SparkSession, source_dir: str, table_path: str, checkpoint_location: str, *,
                 columns: Sequence[str] = schema.RAW_COLUMNS, strict: bool = True,
                 key: Sequence[str] = schema.KEY_DATE, max_files_per_trigger: int | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start the ingest.  ``columns`` is the header of the files (the order of
    their columns).  With ``available_now`` the query processes what is there
    and stops; otherwise it keeps polling the folder."""
    reader = spark.readStream.schema(raw_schema(columns)).options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_offset"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        raw = batch.select(
            *[c for c in batch.columns if c not in ("_file", "_offset")],
            F.struct(F.col("_file").alias("file"), F.col("_offset").alias("offset"),
                     F.monotonically_increasing_id().alias("row")).alias(SEQ))
        obs = parse_metar(raw, strict=strict).withColumn(BATCH, F.lit(batch_id).cast("long"))
        # Collapse keys inside the batch first: less to store and to read.
        latest = upsert_last(obs, key, [SEQ])
        latest.write.mode("append").partitionBy("year", "month").parquet(table_path)

    writer = (stream.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_current(spark: SparkSession, table_path: str, key: Sequence[str] = schema.KEY_DATE) -> DataFrame:
    """The table as a keyed table holds it: last write wins per key, by
    (batch, file order)."""
    df = spark.read.parquet(table_path)
    current = upsert_last(df, key, [BATCH, SEQ])
    known = [c for c in schema.OBS_COLUMNS if c in current.columns]
    return current.select(*known)
