"""Groups, segments, availability and platform preference."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodgewise.functions.scores import market_segment
from lodgewise.operators.ranking import quantiles


def grouped_summary(df: DataFrame, groups, price: str, rating: str, rollup: bool = True) -> DataFrame:
    """Counts and mean price and rating per group, with subtotals marked by `level`."""
    grouped = df.rollup(*groups) if rollup else df.groupBy(*groups)
    level = [F.grouping_id().cast("int").alias("level")] if rollup else []
    return grouped.agg(
        *level,
        F.count(F.lit(1)).alias("places"),
        F.avg(F.col(price).cast("double")).alias("avg_price"),
        F.avg(F.col(rating).cast("double")).alias("avg_rating"),
    )


def with_segment(df: DataFrame, price: str, name: str = "market_segment") -> DataFrame:
    """Add budget / mid-range / luxury by the terciles of all prices."""
    terciles = quantiles(df, price, {"_low": 1 / 3, "_high": 2 / 3})
    joined = df.withColumn("_terciles", terciles.select(F.struct("_low", "_high")).scalar())  # one row
    return joined.select(*df.columns, market_segment(price, "_terciles._low", "_terciles._high").alias(name))


def availability(df: DataFrame, key: str, platform: str, known_platforms: int) -> DataFrame:
    """Platforms that list a place, their share of the platforms known, and whether there are several."""
    n = F.count_distinct(platform)
    return df.groupBy(key).agg(
        n.alias("booking_platform_count"),
        (n / F.lit(float(known_platforms))).alias("availability_score"),
        (n > 1).alias("cross_platform_availability"),
    )


def platform_preference(reviews: DataFrame, key: str, platform: str, name: str = "platform_preference_score") -> DataFrame:
    """Share of a place's reviews on each platform."""
    counts = reviews.groupBy(key, platform).agg(F.count(F.lit(1)).alias("reviews"))
    total = F.sum("reviews").over(Window.partitionBy(key))
    return counts.withColumn(name, F.col("reviews") / total)


def row_variance(values) -> Column:
    """Population variance of the known values in a row; null when none is known."""
    known = F.filter(F.array(*[F.col(v).cast("double") for v in values]), lambda x: x.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.size(known)
    squares = F.aggregate(known, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
    return F.when(F.size(known) > 0, squares / F.size(known))
