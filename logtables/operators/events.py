"""From lines to events.

A timestamp at the start of a line begins an event; the lines after it belong to it. The assembly never
puts a whole source into one task: each source is cut into chunks of bounded size. A first pass leaves one row
per chunk, the place of its first timestamp; a scan along these rows tells which earlier chunk holds the event that the
loose end of a chunk continues (its lines before the first timestamp). So every line knows its chunk before the text moves:
it is shuffled once and put together once.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logtables.rules import RuleSet
from logtables.sources.text import BLOCK, LINE, SOURCE, TEXT, text_column
from logtables.workspace import new_folder

MESSAGE = "message"
ROWS_PER_CHUNK = 1_000_000
#: Of ``even_chunks``: sampled rows for each chunk, chunks at most, and bounds that are compared one by one.
SAMPLED, MOST_CHUNKS, STEP = 40, 4_000, 64


def line_events(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Every line is an event; texts of several lines are split."""
    body = F.regexp_replace(text_column(df, text), F.lit("\\r?\\n\\z"), F.lit(""))
    return df.select(
        *[F.col(f"`{name}`") for name in df.columns if name != text],
        F.explode(F.split(body, "\n", -1)).alias(text),
    )


def split_events(df: DataFrame, rules: RuleSet, text: str = TEXT, number: str | None = None) -> DataFrame:
    """One row per event of a text of several lines; ``number`` adds a column that counts them from 0."""
    events = rules.matcher.events(text_column(df, text))
    others = [F.col(f"`{name}`") for name in df.columns if name != text]
    if number:
        return df.select(*others, F.posexplode(events).alias(number, text))
    return df.select(*others, F.explode(events).alias(text))


def first_event(text: Column, rules: RuleSet) -> Column:
    """The first event of a text."""
    return rules.matcher.first_event(text)


def even_chunks(df: DataFrame, order: str | Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> Column:
    """Chunk numbers for a table without file splits: ranges of the order columns of about equal row count.

    The bounds are quantiles of a random sample of the order columns, ``SAMPLED`` rows for each chunk, that is taken
    now and becomes a constant, so a task that is run again finds the same chunks. So neither outliers nor gaps nor
    NULLs make a chunk large. Rows that agree in all the order columns cannot be told apart and stay together: name
    columns that tell all rows of a source apart, as ``assemble_events`` wants them. At most ``MOST_CHUNKS`` chunks.
    """
    orders = [order] if isinstance(order, str) else list(order)
    keys = [_rising(df, name) for name in orders]
    rows = df.count()
    chunks = ceil(rows / rows_per_chunk)
    if chunks > MOST_CHUNKS:
        raise ValueError(f"{rows} rows need {rows_per_chunk} or more rows per chunk: {ceil(rows / MOST_CHUNKS)}")
    if chunks < 2:
        return F.lit(0).cast("long")
    share = min(1.0, 1.1 * SAMPLED * chunks / rows)
    sample = df.select(F.struct(*keys).alias("k")).sample(share, seed=7).orderBy("k")
    found = [row["k"] for row in sample.select(F.to_json("k").alias("k")).collect()]
    bounds = list(dict.fromkeys(found[i * len(found) // chunks] for i in range(1, chunks))) if found else []
    # an array of all bounds, and of every STEP-th to find the place in it
    kind = f"array<{df.select(F.struct(*keys).alias('k')).schema['k'].dataType.simpleString()}>"
    every, few = _constants(bounds, kind), _constants(bounds[STEP - 1 :: STEP], kind)
    key = F.struct(*keys)
    whole = F.size(F.filter(few, lambda bound: bound <= key)) * STEP
    rest = F.slice(every, whole + 1, F.lit(STEP))
    return (whole + F.size(F.filter(rest, lambda bound: bound <= key))).cast("long")


def _rising(df: DataFrame, name: str) -> Column:
    """A value that JSON can hold and that never falls as the column rises; NULL stays first."""
    data_type = df.select(name).schema[0].dataType.simpleString()
    column = f"`{name}`"
    if data_type.startswith(("timestamp", "date")):
        column = f"unix_micros(timestamp({column}))"
    elif data_type.startswith(("decimal", "float", "double")):
        column = f"double({column})"
    elif data_type not in ("tinyint", "smallint", "int", "bigint", "string"):
        raise TypeError(f"column {name!r} must hold numbers, times or text, not {data_type}")
    return F.expr(column).alias(f"k_{name}")


def _constants(texts: Sequence[str], kind: str) -> Column:
    return F.from_json(F.lit(f"[{','.join(texts)}]"), kind)


def assemble_events(
    df: DataFrame,
    rules: RuleSet,
    text: str = TEXT,
    *,
    source: str | Sequence[str] = SOURCE,
    order: str | Sequence[str] = (BLOCK, LINE),
    chunk: str | Column | None = None,
    mark_last: str | None = None,
) -> DataFrame:
    """Put the lines of each source together to events.

    ``order`` is the line order within a source; two lines of a source with the same order stop the job, as nothing says
    which comes first. ``chunk`` cuts a source into bounded pieces and must rise
    with the order; files use their splits, other tables ranges of the order columns. The result has
    the source columns, the order columns of the event's first line, and ``message``. Lines before the
    first timestamp of a source form an event of their own. ``mark_last`` adds a flag for the last event
    of each source, which later lines could still continue.
    """
    sources = [source] if isinstance(source, str) else list(source)
    orders = [order] if isinstance(order, str) else list(order)
    by_block = isinstance(chunk, str) and chunk == BLOCK or chunk is None and orders[0] == BLOCK
    if chunk is None:
        chunk = F.col(BLOCK) if by_block else even_chunks(df, orders)
    elif isinstance(chunk, str):
        chunk = F.col(chunk)
    line = text_column(df, text)

    # keys are structs, because those compare equal where a column is NULL: no row gets lost in a join
    lines = df.select(
        F.struct(*sources).alias("__source"),
        F.struct(chunk.alias("c")).alias("__chunk"),
        F.struct(*orders).alias("__at"),
        F.coalesce(line, F.lit("")).alias("__line"),
        F.coalesce(rules.matcher.starts_event(line).cast("int"), F.lit(0)).alias("__start"),
    )
    # per chunk, one small row: where its first event starts, by the order column that tells lines of a chunk apart
    part = ["__source", "__chunk"]
    simple = len(orders) == 1 or orders == [BLOCK, LINE] and by_block
    place = F.col(f"__at.`{orders[-1]}`") if simple else F.col("__at")
    begins = F.col("__start") == 1
    chunks = lines.groupBy(*part).agg(
        F.min(F.when(begins, place)).alias("__first"),
        F.max(F.when(begins, place.isNull().cast("int"))).alias("__null"),  # an order of NULL comes before all others
    )
    # per source, along these rows: the chunk of the event that a loose end continues
    along = W.partitionBy("__source").orderBy("__chunk")
    started = F.when(F.col("__null").isNotNull(), F.col("__chunk"))
    carried = chunks.select(
        *part, "__first", "__null",
        F.coalesce(
            F.last(started, ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, -1)),
            F.first("__chunk").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)),
        ).alias("__anchor"),
        F.coalesce(
            F.max(started).over(W.partitionBy("__source")),
            F.min("__chunk").over(W.partitionBy("__source")),
        ).alias("__final"),
    )
    # written down, its size decides whether it is broadcast to the lines
    folder = new_folder(df.sparkSession, "chunks")
    carried.write.parquet(folder)
    carried = df.sparkSession.read.schema(carried.schema).parquet(folder)
    in_chunk = (F.col("__null") == 1) | (place >= F.col("__first"))
    placed = lines.join(carried, part).withColumn("__chunk", F.when(F.coalesce(in_chunk, F.lit(False)), F.col("__chunk")).otherwise(F.col("__anchor")))

    within = W.partitionBy(*part).orderBy("__at")
    tied = F.raise_error(F.lit(f"lines of one source agree in {', '.join(orders)}: name a column more in order")).cast("int")
    once = F.when(F.lag("__at").over(within) == F.col("__at"), tied).otherwise(F.col("__start"))
    numbered = placed.withColumn("__start", once).withColumn("__no", F.sum("__start").over(within.rowsBetween(W.unboundedPreceding, W.currentRow)))
    last = []
    if mark_last:
        numbered = numbered.withColumn("__starts", F.sum("__start").over(W.partitionBy(*part)))
        of_source = (F.col("__chunk") == F.col("__final")) & (F.col("__no") == F.col("__starts"))
        last = [F.max(of_source).alias(mark_last)]
    events = numbered.groupBy(*part, "__no").agg(F.min("__at").alias("__at"), _joined("__at", "__line").alias(MESSAGE), *last)
    return events.select(
        *[F.col(f"__source.`{name}`").alias(name) for name in sources],
        *[F.col(f"__at.`{name}`").alias(name) for name in orders],
        MESSAGE, *([mark_last] if mark_last else []),
    )


def _joined(key: str, text: str) -> Column:
    """Texts in key order, one per line."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(text).alias("t"))))
    return F.array_join(F.transform(ordered, lambda item: item["t"]), "\n")
