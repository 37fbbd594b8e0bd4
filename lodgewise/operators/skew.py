"""Spread the work of crowded join keys."""

from pyspark.sql import DataFrame, functions as F

from lodgewise.session import cut

_BROADCAST_KEYS = 100_000  # more hot keys are joined by shuffling


def split_hot_keys(
    left: DataFrame, right: DataFrame, key: str, block_rows: int = 10_000, block_pairs: int | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt both sides of a many-to-many join where a key has many rows on them.

    Every key with more than `block_rows` rows on a side is cut into blocks on each side, and every left block
    meets every right block once. Which keys these are is counted first; where there are none, the sides are
    joined as they are. Else the keys to cut are joined by key, however many they are, and the salt comes from the
    place of a row in its input, so equal rows are spread too.

    With `block_pairs` two blocks have about so many pairs at most, or more where there would be many more blocks than
    tasks, so that the copies of a row don't grow with the table; `block_rows` bounds the right side, which alone is
    held in memory.
    """
    n_left = left.groupBy(key).agg(F.count(F.lit(1)).alias("_nl"))
    n_right = right.groupBy(key).agg(F.count(F.lit(1)).alias("_nr"))
    product = F.col("_nl").cast("double") * F.col("_nr")
    crowded = (product > float(block_pairs)) if block_pairs else (F.col("_nl") > block_rows)
    hot = cut(n_left.join(n_right, key).filter(crowded | (F.col("_nr") > block_rows)).select(F.col(key).alias("_hot"), "_nl", "_nr"))
    if hot.isEmpty():
        return left, right, [key]
    blocks_l = F.ceil(F.col("_nl") / F.lit(block_rows)).cast("int")
    blocks_r = F.ceil(F.col("_nr") / F.lit(block_rows)).cast("int")
    if block_pairs:
        most = max(float(block_pairs), hot.agg(F.sum(product)).first()[0] / (4 * tasks(left)))
        # n pairs of blocks send _nl * _br + _nr * _bl rows, fewest where blocks have as many rows on both sides
        n = F.ceil(product / F.lit(most))
        blocks_l = F.least(n, F.ceil(F.sqrt(n * F.col("_nl") / F.col("_nr")))).cast("int")
        blocks_r = F.greatest(blocks_r, F.ceil(n / blocks_l)).cast("int")
    hot = hot.select("_hot", blocks_l.alias("_bl"), blocks_r.alias("_br"))
    hot = few_rows(hot)

    def salted(df: DataFrame, own: str, other: str, own_salt: str, other_salt: str) -> DataFrame:
        own_blocks, other_blocks = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        rows = df.withColumn("_row", F.xxhash64(F.monotonically_increasing_id()))
        return (
            rows.join(hot, F.col(key) == F.col("_hot"), "left")
            .withColumn(own_salt, F.pmod("_row", own_blocks).cast("int"))
            .withColumn(other_salt, F.explode(F.sequence(F.lit(0), other_blocks - 1)))
            .drop("_row", "_hot", "_bl", "_br")
        )

    return salted(left, "_bl", "_br", "_sl", "_sr"), salted(right, "_br", "_bl", "_sr", "_sl"), [key, "_sl", "_sr"]


def few_rows(keys: DataFrame) -> DataFrame:
    """To be sent to all tasks, if they are few enough."""
    return keys if keys.offset(_BROADCAST_KEYS).head(1) else F.broadcast(keys)


def tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def evenly(df: DataFrame) -> DataFrame:
    """Small rows that each cause much work, over all cores: their bytes would not tell Spark to do so."""
    return df.repartition(tasks(df))


def meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A many-to-many join of small rows that gives many pairs, over all cores.

    By the bytes of its sides Spark would broadcast one of them, or give all keys to a few tasks.
    """
    n = tasks(left)
    return left.repartition(n, *keys).join(right.repartition(n, *keys).hint("shuffle_hash"), keys)


def spread(df: DataFrame) -> DataFrame:
    """Rows of much work each, from files that give fewer tasks than there are cores; others stay where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
