"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps plain timestamps and hour truncation free of zone shifts; adaptive
# execution sizes shuffles, splits skewed joins and skewed output partitions.
SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Keys of a small run are named one by one to the scan.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Listing an hour's folder takes less than starting a task for it.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.ansi.enabled": "true",
    # Writes replace the partitions they have rows for; the writer checks that it is set.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpoints of split groups go when no plan refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # A run over a few million events cuts a large history at the scan by a Bloom
    # filter of 8 MB; Spark adds it only where the history scan exceeds 10 GB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
}


def build_session(app: str = "hourmart", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
