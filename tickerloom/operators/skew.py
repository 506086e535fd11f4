"""Key skew: measuring it, and spreading work that a hot key would pile up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.fixed_values import BALANCED_SKEW, HIGH_VOLUME_FACTOR

# A key is split once it has more rows than this; one slice is then one task's work.
SLICE_ROWS = 5_000_000
# A dimension that Spark estimates above this many bytes is joined without a broadcast hint.
MAX_BROADCAST_BYTES = 10 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of the optimized plan; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its estimated size is at most ``max_bytes``.

    An estimate never falls short by leaving out a filter or an aggregate, it is then the
    size of what is read. A larger frame comes back unchanged, and Spark picks the join.
    """
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def spread_hot_keys(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    weight: str,
    spread_on: list[str],
    slice_rows: int = SLICE_ROWS,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Prepare an inner equi join whose keys may be very uneven on the big side.

    ``small[weight]`` says how many big-side rows a row of the small side stands for; a
    key has at most the sum over its rows. A key above ``slice_rows`` is cut into slices:
    its big-side rows spread over them by a hash of ``spread_on``, and its small-side rows
    are repeated once per slice. Both sides take the slice count from the same list, so
    each pair meets exactly once. The list has at most one key per ``slice_rows`` big-side
    rows and no hint; keys that are not on it have the single slice 0. The hash sees row
    columns only, so filters pass below it and a retried task repeats it.
    """
    hot = (
        small.groupBy(*keys)
        .agg(F.sum(weight).alias("_rows"))
        .filter(F.col("_rows") > slice_rows)
        .select(*keys, F.ceil(F.col("_rows") / slice_rows).cast("int").alias("_slices"))
    )
    slices = F.coalesce("_slices", F.lit(1))
    placed = F.xxhash64(*spread_on)
    big = (
        big.join(hot, keys, "left")
        .withColumn("_slice", F.pmod(placed, slices).cast("int"))
        .drop("_slices")
    )
    small = (
        small.join(hot, keys, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return big, small, [*keys, "_slice"]


def ticker_counts(trades: DataFrame) -> DataFrame:
    return trades.groupBy("ticker").agg(F.count("*").alias("trade_count"))


def ticker_skew(trades: DataFrame) -> DataFrame:
    """Trades per ticker with a category against the median ticker.

    The exact median keeps one entry per distinct count. Distinct counts of N
    rows number at most sqrt(2N), about 1.4 million for 10^12 trades.
    """
    counts = ticker_counts(trades)
    median = counts.select(F.median("trade_count")).scalar()
    return counts.withColumn(
        "category",
        F.when(F.col("trade_count") > median * HIGH_VOLUME_FACTOR, "High volume")
        .otherwise("Normal"),
    )


def skew_summary(trades: DataFrame) -> DataFrame:
    """One row: ticker count, median, largest, smallest, and their ratio."""
    return ticker_counts(trades).agg(
        F.count("*").alias("tickers"),
        F.median("trade_count").alias("median_count"),
        F.max("trade_count").alias("max_count"),
        F.min("trade_count").alias("min_count"),
    ).withColumn(
        "skew_ratio",
        F.coalesce(F.try_divide("max_count", "min_count"), F.lit(0.0)),
    )


def top_tickers(trades: DataFrame, n: int = 5) -> DataFrame:
    return ticker_counts(trades).orderBy(F.desc("trade_count"), "ticker").limit(n)


def salted_count(df: DataFrame, key: str, salt_on: str, n: int = 10) -> DataFrame:
    """Row count per key in two phases, over (key, salt) and then over key.

    The salt is a hash, not a random number: a retried task gives the same rows.
    A plain count needs none of this, its partial form already removes the skew.
    """
    salt = F.pmod(F.xxhash64(salt_on), F.lit(n)).alias("_salt")
    partial = df.groupBy(key, salt).agg(F.count("*").alias("_part"))
    return partial.groupBy(key).agg(F.sum("_part").alias("cnt"))


def placed_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """What-if: add the ``partition`` that a hash of the key's text would pick among ``n``.

    The first seven hexadecimal digits of MD5, a hash that other systems have as well.
    """
    digits = F.substring(F.md5(F.col(key).cast("string")), 1, 7)
    return df.withColumn("partition", F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(n)).cast("int"))


def key_placement(df: DataFrame, key: str) -> DataFrame:
    """Messages per (partition, key)."""
    return df.groupBy("partition", key).agg(F.count("*").alias("messages"))


def key_distribution(df: DataFrame, key: str, listed: list[str] | None = None) -> DataFrame:
    """Keys and messages per partition.

    ``listed`` names the keys to spell out in the ``keys`` column; its length
    bounds the list, however many stray keys the data holds.
    """
    measures = [F.count(key).alias("key_count"), F.sum("messages").alias("messages")]
    if listed is not None:
        known = F.when(F.col(key).isin(*listed), F.col(key))
        measures.append(F.array_join(F.array_sort(F.collect_set(known)), ", ").alias("keys"))
    return key_placement(df, key).groupBy("partition").agg(*measures)


def placement_balance(distribution: DataFrame) -> DataFrame:
    """One row: most and fewest keys in a partition, the gap, and the verdict."""
    return distribution.agg(
        F.max("key_count").alias("max_keys"), F.min("key_count").alias("min_keys")
    ).withColumn("skew", F.col("max_keys") - F.col("min_keys")).withColumn(
        "balanced", F.col("skew") <= BALANCED_SKEW
    )
