"""From lines to events."""

from pyspark.sql import functions as F

from logtables import RuleSet, assemble_events, extract, line_events, split_events
from logtables.functions import accessors
from logtables.operators.events import even_chunks, first_event
from logtables.operators.extract import TIMESTAMPS
from queries.inputs import (
    APP_RULES, SQL_AMOUNT, SQL_FRAME, SQL_LEVEL, SQL_LINE, SQL_LOG_TYPE, SQL_TIME, SQL_TRACES,
    table, trace_lines, two_event_texts,
)
from queries.registry import query

SQL_TWO = f"""
select event_id, {SQL_LINE} as message from events
union all select event_id, '    at app.Svc.run(Svc.java:' || event_id || ')' from events where event_type = 'error'
union all select event_id, {SQL_TIME} || ' INFO done' from events"""


@query("a01_line_events", SQL_TWO)
def a01(spark, sf_dir):
    return line_events(two_event_texts(spark, sf_dir), "line").select("event_id", F.col("line").alias("message"))


@query("a02_multiline_events", SQL_TRACES)
def a02(spark, sf_dir):
    lines = trace_lines(table(spark, sf_dir, "events"))
    return assemble_events(
        lines, APP_RULES, "line", source="user_id", order="event_id",
        chunk=even_chunks(lines, "event_id", rows_per_chunk=2_000),
    )


@query("a02_trace_extraction", f"""
with events_of as ({SQL_TRACES})
select user_id, event_id, (len(message) - len(replace(message, chr(10), '')))::bigint
    + case when message like '    at %' then 1 else 0 end as frames,
  case when message not like '    at %' then left(message, 19) end as stamp from events_of""")
def a02_extract(spark, sf_dir):
    rules = APP_RULES.var("frame", r"\s{1,4}at (?<frame>[a-zA-Z\.]+\([a-zA-Z\.]+:\d+\))")
    found = extract(a02(spark, sf_dir), rules, "message", log_type=False)
    return found.select(
        "user_id", "event_id", F.size("frame").cast("long").alias("frames"),
        accessors.scalar(F.col(TIMESTAMPS)).alias("stamp"),
    )


@query("a04_split_events", f"""
select event_id, 0::bigint as no, {SQL_LINE} || {SQL_FRAME} as message from events
union all select event_id, 1, {SQL_TIME} || ' INFO done' from events""")
def a04(spark, sf_dir):
    events = split_events(two_event_texts(spark, sf_dir), APP_RULES, "line", number="no")
    return events.select("event_id", F.col("no").cast("long").alias("no"), F.col("line").alias("message"))


@query("a05_first_event", f"""select event_id, {SQL_LINE} || {SQL_FRAME} as message,
    {SQL_LOG_TYPE} || {SQL_FRAME} as log_type, {SQL_AMOUNT} as amount from events""")
def a05(spark, sf_dir):
    texts = two_event_texts(spark, sf_dir)
    first = texts.select("event_id", first_event(F.col("line"), APP_RULES).alias("message"))
    found = extract(first, APP_RULES, "message")
    return found.select("event_id", "message", "log_type", accessors.scalar(F.col("amount")).alias("amount"))


@query("a06_empty_input", r"""select doc_id, count(*) as events, count(*) filter (trim(line, ' ') = '') as blank,
    sum(len(regexp_extract_all(line, '(^|[ \t\r:,!;%@/()\[\]])w[a-z]*')))::bigint as words
    from (select doc_id, unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))) as line from (
      select doc_id, case when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then chr(10) || chr(10) else text end as text
      from documents)) group by 1""")
def a06(spark, sf_dir):
    # blank and other texts together: an empty text is one event, so is each blank line
    rules = RuleSet(right_boundary=False).var("word", "(?<word>w[a-z]*)")
    text = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, "\n\n").otherwise(F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    found = extract(split_events(docs, rules, "text"), rules, "text")
    blank = F.when(F.trim("log_type") == "", 1)
    return found.groupBy("doc_id").agg(
        F.count("*").alias("events"), F.count(blank).alias("blank"), F.sum(F.size("word")).cast("long").alias("words")
    )


@query("a07_levels_per_line", f"""select event_id, {SQL_LEVEL} as level, {SQL_TIME} as stamp from events
    union all select event_id, 'INFO', {SQL_TIME} from events""")
def a07(spark, sf_dir):
    events = split_events(two_event_texts(spark, sf_dir), APP_RULES, "line")
    found = extract(events, APP_RULES, "line", captures=["level"], log_type=False)
    return found.select(
        "event_id", accessors.scalar(F.col("level")).alias("level"),
        accessors.scalar(F.col(TIMESTAMPS)).alias("stamp"),
    )
