"""Entry point for spark-submit; see vidlake/__main__.py."""

from pyspark.sql import SparkSession

from vidlake.__main__ import run

if __name__ == "__main__":
    run(SparkSession.builder.appName("vidlake").getOrCreate())
