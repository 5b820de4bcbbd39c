"""Questions about log types and capture values. All of them aggregate on the map side first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logtables.operators.extract import LOG_TYPE
from logtables.workspace import new_folder

#: Slots of each hash of ``top_log_types``.
SLOTS = 1 << 16
#: Part of the rows that ``rare_types_among_frequent`` looks at first.
SHARE = 0.05


def _key(order: str | Sequence[str]) -> Column:
    """What rows are ordered by. One column stays bare: its minimum is kept in a hash table, that of a struct is not."""
    orders = [order] if isinstance(order, str) else list(order)
    return F.col(f"`{orders[0]}`") if len(orders) == 1 else F.struct(*orders)


def _digest() -> list[Column]:
    return [F.xxhash64(LOG_TYPE, F.lit(i)).alias(name) for i, name in enumerate(["__a", "__b"])]


def log_types(df: DataFrame, order: str | Sequence[str], ordered: bool = True) -> DataFrame:
    """Each log type once, in the order of first appearance."""
    firsts = df.groupBy(LOG_TYPE).agg(F.min(_key(order)).alias("first_seen"))
    return (firsts.orderBy("first_seen") if ordered else firsts).select(LOG_TYPE)


def log_type_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(LOG_TYPE).agg(F.count("*").alias("count"))


def log_type_samples(
    df: DataFrame, message: str, order: str | Sequence[str], samples: int = 3
) -> DataFrame:
    """The first messages of each log type.

    Each task keeps only its first few rows per log type before the shuffle, so that a log type that holds
    most of the log does not end up in one task.
    """
    if samples < 1:
        raise ValueError("at least one sample is needed")
    first = W.partitionBy(LOG_TYPE).orderBy("__at")
    kept = (
        df.select(LOG_TYPE, _key(order).alias("__at"), F.col(f"`{message}`").alias("__message"))
        .withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") <= samples)
    )
    ordered = F.array_sort(F.collect_list(F.struct("__rank", "__message")))
    return kept.groupBy(LOG_TYPE).agg(
        F.transform(ordered, lambda item: item["__message"]).alias("samples")
    )


def frequent_log_types(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Log types by falling count; ``limit`` keeps the top ones."""
    ordered = log_type_counts(df).orderBy(F.desc("count"), LOG_TYPE)
    return ordered.limit(limit) if limit else ordered


def top_log_types(df: DataFrame, limit: int, slots: int = SLOTS) -> DataFrame:
    """The same as ``frequent_log_types`` with a limit, for logs of nearly as many log types as rows.

    There, counting all types exactly would shuffle nearly every row. Instead, all rows are first counted by two hashes of their type into
    ``slots`` slots each, so that no task sends more than these; a slot's count is never below that of a type in it. The types in the heaviest
    slots are counted exactly, which gives a count that the last of the top types reaches at least. A type with both slots at or above
    it may be among them, any other cannot: only such types are counted exactly. The log is read three times. Where no type stands
    out from what a slot holds by chance, all types are counted, as exactly as ever.
    """
    if limit < 1:
        raise ValueError("at least one log type is needed")
    spark = df.sparkSession
    typed = df.select(LOG_TYPE, *(
        (F.pmod(F.xxhash64(LOG_TYPE, F.lit(i)), F.lit(slots)) + i * slots).alias(f"__slot{i}") for i in range(2)
    ))
    counts = typed.select(F.explode(F.array("__slot0", "__slot1")).alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    folder = new_folder(spark, "slots")
    counts.write.parquet(folder)
    counts = spark.read.schema(counts.schema).parquet(folder)

    def within(rows: DataFrame, kept: DataFrame, i: int) -> DataFrame:
        # at most ``slots`` numbers
        return rows.join(F.broadcast(kept.select(F.col("slot").alias(f"__slot{i}"))), f"__slot{i}", "left_semi")

    heaviest = counts.where(F.col("slot") < slots).orderBy(F.desc("n"), "slot").limit(4 * limit)
    reached = log_type_counts(within(typed, heaviest, 0)).orderBy(F.desc("count")).limit(limit)
    found, least = reached.agg(F.count("*"), F.min("count")).first()
    kept = counts.where(F.col("n") >= (least if found == limit else 0))
    rows = within(within(typed, kept.where(F.col("slot") < slots), 0), kept.where(F.col("slot") >= slots), 1)
    return frequent_log_types(rows, limit)


def rare_log_types(df: DataFrame, below: int = 10) -> DataFrame:
    return log_type_counts(df).where(F.col("count") < below)


def surely_frequent(df: DataFrame, below: int, share: float = SHARE, most: int = SLOTS) -> DataFrame:
    """Digests (``__a``, ``__b``) of log types that a share of the rows shows at least ``below`` times: the most frequent ``most``.

    What part of the log shows often enough, the whole log does, so no rare type is ever among them.
    """
    part = log_type_counts(df.sample(share, 7)).where(F.col("count") >= below)
    return part.orderBy(F.desc("count"), LOG_TYPE).limit(most).select(*_digest())


def rare_types_among_frequent(df: DataFrame, below: int = 10, share: float = SHARE, most: int = SLOTS) -> DataFrame:
    """The same as ``rare_log_types``, for logs whose rows are nearly all of frequent types, of which there are many.

    There, every task sends a partial count of nearly every type. Types that a share of the rows proves frequent (``surely_frequent``) leave
    the log before it is counted; what is left is counted exactly. The proven types are sent to all tasks as two hashes of 64
    bits each, at most ``most`` of them (1 MB). The log is read twice, and scanned for captures once and a share.
    """
    if below < 1:
        raise ValueError("counts are compared with one at least")
    sure = surely_frequent(df, below, share, most).withColumn("__sure", F.lit(True))
    # an outer join stays above the scan for captures; an anti join would be moved below it, and repeat it for its keys
    rows = df.select(LOG_TYPE).withColumns({name: column for name, column in zip("__a __b".split(), _digest())})
    left = rows.join(F.broadcast(sure), ["__a", "__b"], "left").where(F.col("__sure").isNull())
    return rare_log_types(left, below)


def new_log_types(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """Log types, with counts, that the baseline (a table with a log type column) does not have.

    One aggregation over both tables: an anti join would be moved below the count by the optimizer, and
    would then send every event of a frequent log type to one task.
    """
    rows = df.select(LOG_TYPE, F.lit(1).alias("n"), F.lit(False).alias("known"))
    known = baseline.select(LOG_TYPE, F.lit(0).alias("n"), F.lit(True).alias("known"))
    both = rows.unionByName(known).groupBy(LOG_TYPE)
    return both.agg(F.sum("n").alias("count"), F.max("known").alias("known")).where("not known").drop("known")


def value_counts(df: DataFrame, capture: str) -> DataFrame:
    """How often each value of a capture occurs, counting every value of events with several."""
    values = df.select(F.explode(F.col(f"`{capture}`")).alias("value"))
    return values.groupBy("value").agg(F.count("*").alias("count"))
