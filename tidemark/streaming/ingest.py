"""Listings that arrive as files, ingested by Structured Streaming as far as they go.

The source is a folder of Parquet listings; the trigger takes what is there and stops, and the checkpoint remembers the
files. Each micro-batch is anti-joined with everything seen, as the memory never expires (a watermark would forget), and
writes its references and seen keys under the batch's own number, so a batch that is run again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.state import to_fetch

KEYS = ["fonte", "id_na_fonte"]


def _seen(spark: SparkSession, root: str, before: int) -> DataFrame:
    """Keys of earlier batches; the current batch's own folder, left by a broken attempt, doesn't count."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/seen")
    schema = "fonte string, id_na_fonte string"
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema + ", batch long").parquet(f"{root}/seen").filter(F.col("batch") < before).select(*KEYS)


def ingest(spark: SparkSession, folder: str, root: str, schema) -> int:
    """Process the files not taken yet; returns the number of batches. References land in root/refs/batch=N."""
    taken = []

    def one(batch: DataFrame, n: int) -> None:
        s = batch.sparkSession
        fresh = to_fetch(batch, None, _seen(s, root, n)).persist()
        fresh.write.mode("overwrite").parquet(f"{root}/refs/batch={n}")
        fresh.select(*KEYS).write.mode("overwrite").parquet(f"{root}/seen/batch={n}")
        fresh.unpersist()
        taken.append(n)

    q = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder).writeStream.foreachBatch(one).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return len(taken)


def changes(spark: SparkSession, folder: str, schema, delay: str = "2 hours", width: str = "1 day") -> DataFrame:
    """Streaming count of listed records by source and event-time window, late ones within the delay included."""
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    return rows.withWatermark("capturado_em", delay).groupBy(F.window("capturado_em", width).alias("janela"), "fonte").agg(F.count("*").alias("n"))


def count_windows(spark: SparkSession, folder: str, root: str, schema, delay: str = "2 hours", width: str = "1 day") -> None:
    """Bring the counts of `changes` up to date with the files in folder; they land in root/counts, whole each time."""

    def one(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/counts")

    q = changes(spark, folder, schema, delay, width).writeStream.outputMode("complete").foreachBatch(one).option("checkpointLocation", f"{root}/windows").trigger(availableNow=True).start()
    q.awaitTermination()
