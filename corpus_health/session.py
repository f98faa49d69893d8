"""Settings the plans are written for; a cluster sets them in its own way."""

from pyspark.sql import SparkSession

CONF = {
    # partition counts and join sides follow measured sizes; skewed joins split
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows handed to Python at once: long documents make large batches
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in CONF.items():
        builder = builder.config(key, value)
    return builder
