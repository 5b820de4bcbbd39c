"""Log texts made from the given tables, and the rules that read them. Each has its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables import PATTERN, RuleSet
from logtables.workspace import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- application log from events
APP_RULES = (
    RuleSet()
    .timestamp("time", r"\d{4}\-\d{2}\-\d{2} \d{2}:\d{2}:\d{2}")
    .var("level", r"(?<level>INFO|WARN|ERROR)")
    .var("user", r"user=(?<uid>\d+)")
    .var("action", r"action=(?<action>[a-z_]+)")
    .var("amount", rf"amount=(?<amount>{PATTERN.FLOAT})")
)
# the same without event starts: every line is an event
LINE_RULES = (
    RuleSet()
    .var("level", r"(?<level>INFO|WARN|ERROR)")
    .var("user", r"user=(?<uid>\d+)")
    .var("action", r"action=(?<action>[a-z_]+)")
    .var("amount", rf"amount=(?<amount>{PATTERN.FLOAT})")
)
# users stay in the log type
USER_RULES = (
    RuleSet()
    .timestamp("time", r"\d{4}\-\d{2}\-\d{2} \d{2}:\d{2}:\d{2}")
    .var("level", r"(?<level>INFO|WARN|ERROR)")
    .var("action", r"action=(?<action>[a-z_]+)")
    .var("amount", rf"amount=(?<amount>{PATTERN.FLOAT})")
)


def time_text() -> Column:
    return F.substring(F.col("ts").cast("string"), 1, 19)


def level() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "error", "ERROR").when(kind == "signup", "WARN").otherwise("INFO")


def amount_text() -> Column:
    return F.format_string("%.2f", "value")


def note() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "error", "! retry (code 7)").when(kind == "purchase", " paid in full").otherwise("")


def app_line() -> Column:
    return F.concat(
        time_text(), F.lit(" "), level(), F.lit(" user="), F.col("user_id").cast("string"),
        F.lit(" action="), F.col("event_type"), F.lit(" amount="), amount_text(), note(),
    )


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event: (event_id, line)."""
    return table(spark, sf_dir, "events").select("event_id", app_line().alias("line"))


SQL_TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
SQL_LEVEL = "case event_type when 'error' then 'ERROR' when 'signup' then 'WARN' else 'INFO' end"
SQL_AMOUNT = "printf('%.2f', value)"
SQL_NOTE = "case event_type when 'error' then '! retry (code 7)' when 'purchase' then ' paid in full' else '' end"
SQL_LINE = (
    f"{SQL_TIME} || ' ' || {SQL_LEVEL} || ' user=' || user_id || ' action=' || event_type"
    f" || ' amount=' || {SQL_AMOUNT} || {SQL_NOTE}"
)
SQL_LOG_TYPE = f"'<timestamp> <level> user=<uid> action=<action> amount=<amount>' || {SQL_NOTE}"
SQL_USER_TYPE = f"'<timestamp> <level> user=' || user_id || ' action=<action> amount=<amount>' || {SQL_NOTE}"
SQL_LINE_TYPE = f"{SQL_TIME} || ' <level> user=<uid> action=<action> amount=<amount>' || {SQL_NOTE}"


def app_files(spark: SparkSession, sf_dir: str) -> str:
    """The application log as text files; returns the folder."""
    folder = new_folder(spark, "app-log")
    app_log(spark, sf_dir).select("line").write.text(folder)
    return folder


# ---------------------------------------------------------------- lines of several events per user
def trace_lines(events: DataFrame) -> DataFrame:
    """Errors and signups begin an event; other rows are lines that continue the user's last event."""
    starts = F.col("event_type").isin("error", "signup")
    frame = F.concat(F.lit("    at app.Svc.run(Svc.java:"), F.col("event_id").cast("string"), F.lit(")"))
    return events.select("user_id", "event_id", F.when(starts, app_line()).otherwise(frame).alias("line"))


SQL_TRACES = f"""
with lines as (
  select user_id, event_id, event_type in ('error', 'signup') as starts,
         case when event_type in ('error', 'signup') then {SQL_LINE}
              else '    at app.Svc.run(Svc.java:' || event_id || ')' end as line
  from events),
numbered as (
  select *, sum(case when starts then 1 else 0 end) over (partition by user_id order by event_id) as no
  from lines)
select user_id, min(event_id) as event_id, string_agg(line, chr(10) order by event_id) as message
from numbered group by user_id, no"""


def two_event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row a text of two events; the first has a stack frame line in case of an error."""
    frame = F.concat(F.lit("\n    at app.Svc.run(Svc.java:"), F.col("event_id").cast("string"), F.lit(")"))
    first = F.concat(app_line(), F.when(F.col("event_type") == "error", frame).otherwise(""))
    second = F.concat(F.lit("\n"), time_text(), F.lit(" INFO done\n"))
    return table(spark, sf_dir, "events").select("event_id", F.concat(first, second).alias("line"))


SQL_FRAME = "case when event_type = 'error' then chr(10) || '    at app.Svc.run(Svc.java:' || event_id || ')' else '' end"


# ---------------------------------------------------------------- order log, with repeated captures
ORDER_RULES = (
    RuleSet()
    .var("order", r"order=(?<order_key>\d+)")
    .var("cust", r"cust=(?<cust>\d+)")
    .var("status", r"status=(?<status>[A-Z])")
)


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order; pending orders name a second customer, finished ones have no status."""
    cust, status = F.col("o_custkey"), F.col("o_orderstatus")
    again = F.when(status == "P", F.concat(F.lit(" then cust="), (cust + 1).cast("string"))).otherwise("")
    shown = F.when(status == "F", "").otherwise(F.concat(F.lit(" status="), status))
    line = F.concat(
        F.lit("order="), F.col("o_orderkey").cast("string"), F.lit(" cust="), cust.cast("string"), again, shown
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", line.alias("line"))


# ---------------------------------------------------------------- JSON log from events
JSON_RULES = (
    RuleSet()
    .var("user", r"user=(?<uid>\d+)")
    .var("action", r"action=(?<action>[a-z_]+)")
    .var("amount", rf"amount=(?<amount>{PATTERN.FLOAT})")
)


def json_text(*extra: Column) -> Column:
    message = F.concat(F.lit("user="), F.col("user_id").cast("string"), F.lit(" action="), F.col("event_type"))
    detail = F.concat(F.lit("amount="), amount_text())
    return F.to_json(F.struct(
        F.col("event_id").alias("id"), level().alias("level"), message.alias("message"),
        F.struct(detail.alias("detail"), F.lit(5).alias("n")).alias("ctx"), *extra,
    ))


def json_log(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", json_text(*extra).alias("value"))


SQL_MESSAGE = "'user=' || user_id || ' action=' || event_type"
SQL_HEAD = (
    f"'\"id\":' || event_id || ',\"level\":\"' || {SQL_LEVEL} || '\",\"message\":\"' || {SQL_MESSAGE}"
    f" || '\",\"ctx\":{{\"detail\":\"amount=' || {SQL_AMOUNT} || '\",\"n\":5}}'"
)


def json_files(spark: SparkSession, sf_dir: str) -> str:
    """The JSON log as files of one object per line, with a blank line and a bare number for each error."""
    folder = new_folder(spark, "json-log")
    line = json_text()
    junk = F.when(F.col("event_type") == "error", F.concat(line, F.lit("\n\n  42"))).otherwise(line)
    table(spark, sf_dir, "events").select(junk).write.text(folder)
    return folder
