"""Structured Streaming. Each query reads the files as a stream and processes all that is there."""

from pyspark.sql import functions as F

from logtables import JsonLogParser, extract
from logtables.functions import accessors
from logtables.operators.events import MESSAGE
from logtables.operators.jsonlogs import OBJECT, field_text
from logtables.sources.text import TEXT, read_text_stream
from logtables.streaming.jobs import (
    EventAssembly, run_available, stream_log_type_counts,
)
from logtables.workspace import new_folder
from queries.inputs import (
    APP_RULES, JSON_RULES, LINE_RULES, SQL_AMOUNT, SQL_LEVEL, SQL_LOG_TYPE, SQL_TRACES, app_files, app_line,
    json_text, table, trace_lines,
)
from queries.registry import query


PARTS = 4
#: Rows in a file of a part, about: a part is dealt over its files, as many tasks write and read it.
FILE_ROWS = 50_000


def stream_of(spark, sf_dir, name, key="event_id"):
    """A table as a stream of PARTS batches, in the order of a key; rows without a key come in the last.

    Each part is dealt evenly over files, wherever its rows lie in the table, and read as one batch. Parts with fewer files than the
    largest are filled up with empty ones, so that no batch reaches into the next part.
    """
    rows = table(spark, sf_dir, name)
    folder = new_folder(spark, f"{name}-parts")
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    low, high = (0, 0) if low is None else (low, high)
    part = F.least(F.floor((F.col(key) - low) * PARTS / F.lit(max(1, high - low))), F.lit(PARTS - 1))
    files = max(2, -(-n // (PARTS * FILE_ROWS)))
    for i in range(PARTS):  # the stream takes files by their age
        rows.where(part == i).repartition(files).write.mode("append").parquet(folder)
        for _ in range((i + 1) * files - files_in(spark, folder)):
            rows.where(F.lit(False)).coalesce(1).write.mode("append").parquet(folder)
        if files_in(spark, folder) != (i + 1) * files:
            raise RuntimeError(f"part {i} of {name} has other files than expected")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def files_in(spark, folder):
    return len(spark.read.parquet(folder).inputFiles())


def app_stream(spark, sf_dir):
    return stream_of(spark, sf_dir, "events").select("event_id", app_line().alias("line"))


SQL_FIELDS = f"""{SQL_LEVEL} as level, user_id::varchar as uid, event_type as action, {SQL_AMOUNT} as amount"""


def firsts(*names):
    return [accessors.scalar(F.col(name)).alias(name) for name in names]


@query("s08_text_stream", f"select {SQL_FIELDS} from events")
def s08(spark, sf_dir):
    lines = read_text_stream(spark, app_files(spark, sf_dir), max_files=1)
    found = extract(lines, LINE_RULES, TEXT, log_type=False)
    return run_available(found.select(*firsts("level", "uid", "action", "amount")), "s08")


@query("s08_text_stream_in_splits", f"select {SQL_FIELDS} from events")
def s08_splits(spark, sf_dir):
    lines = read_text_stream(spark, app_files(spark, sf_dir), max_files=4, placed=True)
    job = EventAssembly.of_files(spark, LINE_RULES, new_folder(spark, "s08"))
    job.start(lines, new_folder(spark, "s08-checkpoint")).awaitTermination()
    found = extract(job.events(), LINE_RULES, MESSAGE)
    return found.select(*firsts("level", "uid", "action", "amount"))


@query("t01_stream_extraction", f"select event_id, {SQL_FIELDS}, {SQL_LOG_TYPE} as log_type from events")
def t01(spark, sf_dir):
    found = extract(app_stream(spark, sf_dir), APP_RULES, "line")
    return run_available(
        found.select("event_id", *firsts("level", "uid", "action", "amount"), "log_type"), "t01"
    )


@query("t02_stream_multiline_events", SQL_TRACES)
def t02(spark, sf_dir):
    lines = trace_lines(stream_of(spark, sf_dir, "events"))
    lines = lines.withColumn("part", F.floor(F.col("event_id") / 100_000))  # bounded pieces of a user's lines, of more than a line or two
    job = EventAssembly(
        spark, APP_RULES, new_folder(spark, "t02"), text="line", source="user_id", order="event_id", chunk="part",
        idle_batches=PARTS,
    )
    job.start(lines, new_folder(spark, "t02-checkpoint")).awaitTermination()
    return job.events()


@query("t03_stream_json", f"""select event_id, user_id::varchar as uid, event_type as action, {SQL_AMOUNT} as amount
    from events""")
def t03(spark, sf_dir):
    objects = stream_of(spark, sf_dir, "events").select("event_id", json_text().alias("value"))
    found = JsonLogParser(JSON_RULES).parse_one(objects)
    values = [field_text(F.col(OBJECT), f"extracted.{n}").alias(n) for n in ("uid", "action", "amount")]
    return run_available(found.select("event_id", *values), "t03")


@query("t04_stream_log_type_counts", f"""select {SQL_LOG_TYPE} as log_type, count(*) as "count" from events group by 1""")
def t04(spark, sf_dir):
    found = extract(app_stream(spark, sf_dir), APP_RULES, "line")
    return run_available(stream_log_type_counts(found), "t04", complete=True)


@query("t05_stream_new_log_types", f"select distinct {SQL_LOG_TYPE} as log_type from events")
def t05(spark, sf_dir):
    found = extract(app_stream(spark, sf_dir), APP_RULES, "line")
    return run_available(found.select("log_type"), "t05", new_types=True)
