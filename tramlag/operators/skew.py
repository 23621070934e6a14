"""Joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a skewed sort-merge join only when both inputs come straight
from a shuffle. The schedule and fact joins read deduplicated or joined inputs, so their
hot keys are found on a sample and salted explicitly. The sample only steers the layout:
a key that it misses is joined as usual, so results do not depend on it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_SHARE = 0.01
MIN_SAMPLED = 10


def hot_keys(
    df: DataFrame,
    keys: list[str],
    sample_share: float = SAMPLE_SHARE,
    partitions: int | None = None,
) -> list[tuple]:
    """Keys (null included) that alone exceed half a mean shuffle partition, with salt counts.

    At most `2 * partitions` keys qualify, and their salts sum to at most
    `4 * partitions`, whatever the size of the data.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation()
    sampled = df.select(*keys).sample(sample_share, seed=17).observe(seen, F.count(F.lit(1)).alias("n"))
    top = sampled.groupBy(*keys).count().where(F.col("count") >= MIN_SAMPLED)
    rows = top.orderBy(F.desc("count"), *keys).limit(2 * partitions).collect()
    total = seen.get["n"] if rows else 0
    unit = total / (2 * partitions)
    return [(*row[:-1], math.ceil(row["count"] / unit)) for row in rows if row["count"] > max(unit, 1)]


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], hot: list[tuple], how: str = "inner"
) -> DataFrame:
    """Equi-join; rows of `left` under a hot key spread over that key's salts.

    The matching rows of `right` are repeated once per salt, so each left row still meets
    every match exactly once. Hot null keys, which match nothing, only spread. `how` may
    be `inner` or `left`.
    """
    if not hot:
        return left.join(right, keys, how)
    names = [f"_hot_{key}" for key in keys]
    fields = [T.StructField(name, left.schema[key].dataType) for name, key in zip(names, keys)]
    schema = T.StructType([*fields, T.StructField("_salts", T.IntegerType())])
    # `hot` holds at most 2 * shuffle partitions rows (see hot_keys): bounded, so broadcast
    salts = F.broadcast(left.sparkSession.createDataFrame(hot, schema))

    def marked(df: DataFrame) -> DataFrame:
        same = [df[key].eqNullSafe(salts[name]) for name, key in zip(names, keys)]
        return df.join(salts, same, "left").drop(*names)

    salt = F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*left.columns), F.col("_salts")).cast("int")
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    left = marked(left).withColumn("_salt", salt).drop("_salts")
    right = marked(right).withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a lookup table of unknown size, safe for hot keys of `left`.

    The plan is the same at every size: a salted equi-join, of which Spark broadcasts the
    lookup side where its own statistics allow.
    """
    return salted_join(left, right, keys, hot_keys(left, keys), how)
