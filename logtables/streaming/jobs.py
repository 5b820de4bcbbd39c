"""Streaming jobs. Extraction and JSON enrichment are stateless: use ``extract`` and ``enrich_json``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtables.operators.analytics import log_type_counts
from logtables.operators.events import MESSAGE, assemble_events
from logtables.operators.extract import LOG_TYPE
from logtables.rules import RuleSet
from logtables.sources.text import BLOCK, LINE, SOURCE, TEXT
from logtables.workspace import new_folder

#: The split of a line as a chunk, beside the order columns.
_SPLIT = "split"


def stream_log_type_counts(events: DataFrame) -> DataFrame:
    """Running counts; one row of state per log type. Write it in "update" or "complete" mode."""
    return log_type_counts(events)


class Runs:
    """State that grows by batches, in runs: run m holds what the last batches up to the m-th have brought, as many as the largest power of
    two that divides m.

    What the first m batches have brought lies in as many runs as m has binary ones, so neither the files read per batch nor the times a
    row is written again grow faster than the logarithm of the batches. Half of all batches write their own rows only. Each batch
    overwrites its own run, so one that runs again gives the same state; runs that others have taken in stay until the user removes them.
    """

    def __init__(self, folder: str):
        self.folder = folder

    @staticmethod
    def until(m: int, after: int = 0) -> list[int]:
        """The runs that together hold batches after + 1 to m."""
        found = []
        while m > after:
            found.append(m)
            m -= m & -m
        return found

    def read(self, spark: SparkSession, runs: Sequence[int], schema: T.StructType) -> DataFrame:
        if not runs:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*(f"{self.folder}/run={m}" for m in runs))

    def add(self, rows: DataFrame, m: int, merged) -> None:
        """Write the m-th batch's rows, with all that its run takes in; ``merged`` puts rows of several runs together."""
        runs = self.until(m - 1, m - (m & -m))
        if runs:
            rows = merged(rows.unionByName(self.read(rows.sparkSession, runs, rows.schema)))
        rows.write.mode("overwrite").parquet(f"{self.folder}/run={m}")

    def newest(self, spark: SparkSession) -> int:
        """The last run; of the others only the names are looked at."""
        return spark.read.parquet(self.folder).agg(F.max("run")).first()[0] or 0


def _latest(key: str):
    def merged(rows: DataFrame) -> DataFrame:
        values = [name for name in rows.columns if name not in (key, "version")]
        newest = F.max_by(F.struct(*values), "version").alias("v")
        return rows.groupBy(key).agg(newest, F.max("version").alias("version")).select(key, *(F.col(f"v.`{n}`").alias(n) for n in values), "version")

    return merged


def upserts_to(stream: DataFrame, folder: str, checkpoint: str, key: str = LOG_TYPE, **trigger):
    """Start writing the rows that a streaming aggregation changes in each batch; ``upserted`` reads the result.

    What a batch writes follows the keys it changes, not all keys there are: see ``Runs``.
    """
    runs = Runs(folder)

    def write(batch: DataFrame, number: int) -> None:
        runs.add(batch.withColumn("version", F.lit(number + 1)), number + 1, _latest(key))

    writer = stream.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def upserted(spark: SparkSession, folder: str, schema: T.StructType, key: str = LOG_TYPE) -> DataFrame:
    """The newest row of each key of what ``upserts_to`` has written; ``schema`` is that of its stream."""
    runs = Runs(folder)
    kept = T.StructType([*schema, T.StructField("version", T.IntegerType())])
    return _latest(key)(runs.read(spark, runs.until(runs.newest(spark)), kept)).select(*schema.names)


def new_log_types_to(stream: DataFrame, folder: str, checkpoint: str, **trigger):
    """Start writing the log types that no earlier batch had, with an example row of each.

    Each batch is summed up by log type before anything is shuffled, so a frequent log type is no hot key; then the
    known log types, one row each, are taken away. They are kept beside the result, in ``Runs``. Batch n goes to ``folder/batch=n`` and looks
    at what the batches before it knew, so a batch that runs again gives the same result.
    """
    columns = [name for name in stream.columns if name != LOG_TYPE]
    kept = stream.select(LOG_TYPE).schema
    runs = Runs(f"{folder.rstrip('/')}-known")

    def write(batch: DataFrame, number: int) -> None:
        firsts = batch.groupBy(LOG_TYPE).agg(F.count("*").alias("n"), *(F.any_value(name).alias(name) for name in columns)).drop("n")
        known = runs.read(batch.sparkSession, runs.until(number), kept)
        firsts.join(known, LOG_TYPE, "left_anti").write.mode("overwrite").parquet(f"{folder}/batch={number}")
        written = batch.sparkSession.read.schema(stream.select(LOG_TYPE, *columns).schema).parquet(f"{folder}/batch={number}")
        runs.add(written.select(LOG_TYPE), number + 1, lambda rows: rows)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def append_to(stream: DataFrame, folder: str, checkpoint: str, **trigger):
    """Start writing a stream to Parquet files."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return (
        writer.option("path", folder).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def snapshots_to(stream: DataFrame, folder: str, checkpoint: str, **trigger):
    """Start writing the complete result of a streaming aggregation after each batch.

    Batch n goes to ``folder/batch=n``; a batch that is run again replaces its own folder only.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = stream.writeStream.outputMode("complete").foreachBatch(write)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The newest snapshot; of the others only the names are looked at."""
    newest = spark.read.parquet(folder).agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{folder}/batch={newest}")


def run_available(stream: DataFrame, name: str, complete: bool = False, new_types: bool = False) -> DataFrame:
    """Process what the source holds now and return the result as a table; ``complete``: of running counts by log type."""
    spark = stream.sparkSession
    folder, checkpoint = new_folder(spark, name), new_folder(spark, f"{name}-checkpoint")
    start = new_log_types_to if new_types else upserts_to if complete else append_to
    start(stream, folder, checkpoint).awaitTermination()
    if complete:
        return upserted(spark, folder, stream.schema)
    return spark.read.parquet(folder).select(*stream.columns)


class EventAssembly:
    """Multi-line events over a stream of lines.

    Each micro-batch is put together by the batch operator, which spreads a source over many tasks. The
    last event of each source may go on in the next batch: it is stored as open, and the next batch starts
    from it. The state is thus one event per source, kept in a table that survives the loss of any process.
    Lines of a source must arrive in order.

    A source ends with a line for which ``last_line`` is true, or if ``idle_batches`` batches bring nothing of it: then its
    event is complete and the state has no row of it. With ``time``, the time of a line, and ``idle_time`` (as in "10 minutes"), it also ends when
    the clock has gone on by more than that since its latest line. The clock is the latest time of all lines so far, so it stands still when
    nothing comes and doesn't depend on when batches run; lines without a time don't move it, and a source without any never ends by it.
    Lines that come after all, late ones too, begin with an event of their own.

    ``order`` and ``chunk`` are as in ``assemble_events``; the order has to rise from batch to batch.
    """

    def __init__(
        self,
        spark: SparkSession,
        rules: RuleSet,
        folder: str,
        *,
        text: str = TEXT,
        source: str | Sequence[str] = SOURCE,
        order: str | Sequence[str],
        chunk: str,
        last_line: Column | None = None,
        idle_batches: int | None = None,
        time: Column | None = None,
        idle_time: str | None = None,
    ):
        if chunk in ([order] if isinstance(order, str) else order):
            raise ValueError("the chunk column must not be one of the order columns")
        self.spark, self.rules, self.folder = spark, rules, folder
        self.text, self.chunk = text, chunk
        if (time is None) != (idle_time is None):
            raise ValueError("time and idle_time belong together")
        self.last_line, self.idle_batches = last_line, idle_batches
        self.time = F.lit(None) if time is None else time
        self.idle_time = None if idle_time is None else F.expr(f"interval {idle_time}")
        self.sources = [source] if isinstance(source, str) else list(source)
        self.orders = [order] if isinstance(order, str) else list(order)
        self._schema: T.StructType | None = None

    @classmethod
    def of_files(cls, spark: SparkSession, rules: RuleSet, folder: str, **options) -> EventAssembly:
        """Assembly of the lines of ``read_text_stream(placed=True)``.

        A file comes in one batch, in splits that many tasks read; lines are numbered within their splits in the batch, as streams
        themselves cannot. No file is read as a whole.
        """
        job = cls(spark, rules, folder, order=[BLOCK, LINE], chunk=_SPLIT, **options)
        job.numbers = True
        return job

    #: Are lines to be numbered in the order in which their splits are read?
    numbers = False

    def _path(self, batch: int) -> str:
        return f"{self.folder}/batch={batch}"

    def _stored(self, path: str) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(self._schema) if self._schema else reader).parquet(path)

    def _process(self, batch: DataFrame, number: int) -> None:
        if self.numbers:
            batch = batch.withColumn(LINE, F.monotonically_increasing_id()).withColumn(_SPLIT, F.col(BLOCK))
        names = [*self.sources, *self.orders, self.chunk]
        lines = batch.select(*names, F.col(self.text).alias(TEXT))
        ended = F.lit(False) if self.last_line is None else F.coalesce(self.last_line, F.lit(False))
        # one small row per source; keys are structs, because those compare equal where a column is NULL
        seen = batch.select(F.struct(*self.sources).alias("__source"), ended.alias("ended"), self.time.cast("timestamp").alias("last_time"))
        seen = seen.groupBy("__source").agg(F.max("ended").alias("ended"), F.max("last_time").alias("last_time"))
        if number > 0:
            state = self._stored(self._path(number - 1)).where("open = 1")
            lines = lines.unionByName(state.select(*names, F.col(MESSAGE).alias(TEXT)))
            earlier = state.select(F.struct(*self.sources).alias("__source"), "idle", F.col("last_time").alias("before"), "clock")
            seen = seen.join(earlier, "__source", "full")
        else:
            never = F.lit(None).cast("timestamp")
            seen = seen.withColumns({"idle": F.lit(None).cast("int"), "before": never, "clock": never})
        seen = seen.withColumn("last_time", F.greatest("last_time", "before"))
        idle = F.when(F.col("ended").isNull(), F.col("idle") + 1).otherwise(0)
        over = F.coalesce("ended", F.lit(False))
        if self.idle_batches is not None:
            over = over | (idle >= self.idle_batches)
        clock = F.lit(None).cast("timestamp")
        if self.idle_time is not None:
            clock = F.lit(seen.agg(F.max(F.greatest("last_time", "clock"))).first()[0]).cast("timestamp")
            over = over | F.coalesce(F.col("last_time") + self.idle_time < clock, F.lit(False))
        seen = seen.select("__source", idle.alias("idle"), over.alias("over"), "last_time", clock.alias("clock"))
        events = assemble_events(
            lines, self.rules, TEXT, source=self.sources, order=[*self.orders, self.chunk],
            chunk=self.chunk, mark_last="open",
        )
        # AQE splits a hot source: the other side has one row per source
        marked = events.withColumn("__source", F.struct(*self.sources)).join(seen, "__source", "left").drop("__source")
        stored = marked.withColumn("open", (F.col("open") & ~F.col("over")).cast("int")).drop("over")
        stored.write.mode("overwrite").partitionBy("open").parquet(self._path(number))

    def start(self, lines: DataFrame, checkpoint: str, **trigger):
        """Start on a stream of lines; the checkpoint folder belongs to this assembly's folder."""
        if self.numbers:
            places = [F.col(BLOCK), F.lit(0).cast("long").alias(LINE), F.col(BLOCK).alias(_SPLIT)]
            kept = lines.select(*self.sources, *places).schema
        else:
            kept = lines.select(*self.sources, *self.orders, self.chunk).schema
        self._schema = T.StructType([
            *kept, T.StructField(MESSAGE, T.StringType()), T.StructField("idle", T.IntegerType()),
            T.StructField("last_time", T.TimestampType()), T.StructField("clock", T.TimestampType()), T.StructField("open", T.IntegerType()),
        ])
        return (
            lines.writeStream.foreachBatch(self._process).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )

    def events(self, include_open: bool = True) -> DataFrame:
        """The events so far; ``include_open`` adds the last one of each source, as at the end of input."""
        stored = self.spark.read.parquet(self.folder)
        done = stored.where("open = 0")
        if include_open:
            newest = stored.agg(F.max("batch").alias("batch"))
            done = done.unionByName(stored.where("open = 1").join(F.broadcast(newest), "batch"))
        return done.select(*self.sources, *self.orders, MESSAGE)
