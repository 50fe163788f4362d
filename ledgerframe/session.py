"""Spark session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI-safe arithmetic is handled in the
# operators; here we pin the time zone (period keys are derived from
# timestamps) and turn on adaptive execution so joins and aggregations are
# re-planned from real shuffle sizes (broadcast only when the runtime size is
# under the threshold, skewed partitions split, small partitions coalesced).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # the partition columns written here (period, source file) are text: read
    # them back as text, never as numbers or dates guessed from their values
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


# Sizing for a large cluster (hundreds of executors, tens of TB of statements):
# start with many shuffle partitions and let AQE coalesce them to ~256 MB each
# (the aggregates here shrink data by orders of magnitude after the partial
# aggregation, so most shuffles end up small); split a partition that is 5x
# the median and over 512 MB (a hot ticker, month or owner); broadcast a join
# side only when its measured size is under 64 MB; read ~256 MB per scan task.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def build_session(master: str | None = None, app_name: str = "ledgerframe",
                  conf: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Session with the defaults above; ``cluster=True`` adds
    :data:`CLUSTER_CONF`; ``conf`` overrides both."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    base = {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}
    for key, value in {**base, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
