"""Running figures over audit rows as they arrive: per source and hour, per source and batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import match_key, source_name
from tidegate.operators import monitor
from tidegate.operators.bronze import folder_of


def hourly_counts(audit: DataFrame) -> DataFrame:
    """Rows and failures per source and hour of start time."""
    return (
        audit.withColumn("start_time", F.col("start_time").cast("timestamp"))
        .groupBy(
            F.window("start_time", "1 hour").alias("_hour"),
            match_key(source_name(F.col("source_system"))).alias("source_name"),
        )
        .agg(
            F.count(F.lit(1)).alias("object_count"),
            F.sum(F.when(F.col("status") == "FAILED", 1).otherwise(0)).alias("failed_count"),
        )
        .select(
            F.col("_hour.start").cast("timestamp_ntz").alias("hour_start"),
            "source_name",
            "object_count",
            "failed_count",
        )
    )


def write_updates(audit: DataFrame, table: str, checkpoint: str) -> None:
    """Store what each micro-batch adds to the counts, under the micro-batch's number.

    No state is kept and nothing is too late: a row counts in the batch it arrives with,
    however long ago its run started. A repeated batch overwrites its own folder.
    """

    def store(rows: DataFrame, epoch: int) -> None:
        hourly_counts(rows).write.mode("overwrite").parquet(f"{table}/epoch={epoch}")

    query = (
        audit.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_counts(updates: DataFrame) -> DataFrame:
    """The sum of what all batches added to each group."""
    return updates.groupBy("hour_start", "source_name").agg(
        F.sum("object_count").alias("object_count"), F.sum("failed_count").alias("failed_count")
    )


BATCH_KEY = ["_name", "batch_id"]


def live_batches(audit: DataFrame) -> DataFrame:
    """Figures of each source and batch, kept as streaming state and merged with every arrival.

    There is no watermark: a row of the oldest batch still counts when it comes. The state has
    one row of fixed width per source and batch, as the monitor has.
    """
    text = source_name(F.col("source_system"))
    named = audit.withColumn("_name", match_key(text)).withColumn("_text", text)
    return named.groupBy(*BATCH_KEY).agg(*monitor.batch_figures(), F.min("_text").alias("_text"))


def write_batches(audit: DataFrame, table: str, checkpoint: str, fold_after: int = 16) -> None:
    """Store the new totals of the groups each micro-batch touched.

    A repeated micro-batch overwrites its own folder. After ``fold_after`` of them the latest
    totals of all groups are written once and the folders they came from are removed, so the
    table has a bounded number of files. Every stored row is a total as of its ``_epoch``;
    whatever a crash leaves behind, the latest row of a group is right.
    """

    def store(rows: DataFrame, epoch: int) -> None:
        rows.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{table}/at={epoch:09d}")
        if (epoch + 1) % fold_after == 0:
            _fold(rows.sparkSession, table, epoch)

    # every state partition commits files with each micro-batch: one a core, however wide shuffles are;
    # the stream copies the session as it starts, and a resumed one keeps the number it began with
    session, setting = audit.sparkSession, "spark.sql.shuffle.partitions"
    width = session.conf.get(setting)
    session.conf.set(setting, min(int(width), session.sparkContext.defaultParallelism))
    try:
        query = (
            live_batches(audit).writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        session.conf.set(setting, width)
    query.awaitTermination()


def _stored(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(table)


def _latest(stored: DataFrame) -> DataFrame:
    rest = F.struct(*[name for name in stored.columns if name not in BATCH_KEY])
    return stored.groupBy(*BATCH_KEY).agg(F.max_by(rest, "_epoch").alias("_row")).select(*BATCH_KEY, "_row.*")


def _fold(spark: SparkSession, table: str, epoch: int) -> None:
    folded = f"fold={epoch:09d}"
    _latest(_stored(spark, table)).write.mode("overwrite").parquet(f"{table}/{folded}")
    files, root = folder_of(spark, table)
    for status in files.listStatus(root):  # at most fold_after folders and the last fold
        name = status.getPath().getName()
        if name < f"at={epoch + 1:09d}" and name.startswith("at=") or name.startswith("fold=") and name < folded:
            files.delete(status.getPath(), True)


def current_batches(spark: SparkSession, table: str) -> DataFrame:
    """The monitor's row of every source and batch, from the stored totals."""
    return monitor.from_figures(_latest(_stored(spark, table)))
