"""Summaries over cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(df: DataFrame, value: str = "tweets") -> DataFrame:
    """One row: locations, total, mean, population variance and σ (two decimals)."""
    v = F.col(value)
    return df.agg(
        F.count(v).alias("locations"),
        F.sum(v).cast("bigint").alias("total"),
        F.round(F.avg(v), 2).alias("average"),
        F.round(F.var_pop(v), 2).alias("variance"),
        F.round(F.stddev_pop(v), 2).alias("stdev"),
    )


def sigma_bucket(df: DataFrame, value: str = "tweets") -> DataFrame:
    """Add ``fill_key``: below the mean, then by steps of one σ above it. Mean and
    σ are one scalar subquery, no join."""
    v = F.col(value)
    stats = df.agg(F.struct(F.avg(v).alias("mu"), F.stddev_pop(v).alias("sd")).alias("s"))
    mu, sd = F.col("_s.mu"), F.col("_s.sd")
    key = (F.when(v < mu, "below_avg")
            .when(v < mu + sd, "one_std")
            .when(v < mu + 2 * sd, "two_std")
            .otherwise("three_std"))
    return df.withColumn("_s", stats.scalar()).withColumn("fill_key", key).drop("_s")
