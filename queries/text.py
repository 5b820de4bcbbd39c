"""Text sources, rules and extraction."""

from pyspark.sql import functions as F

from logtables import PATTERN, LogParser, LogQuery, RuleSet, extract
from logtables.functions import accessors
from logtables.operators.extract import TIMESTAMPS, matched
from logtables.sources.text import TEXT, read_binary_logs, read_text_logs
from queries.inputs import (
    APP_RULES, LINE_RULES, ORDER_RULES, SQL_AMOUNT, SQL_LEVEL, SQL_LINE, SQL_LINE_TYPE, SQL_LOG_TYPE,
    SQL_TIME, app_files, app_log, order_log, table,
)
from queries.registry import query

DELIMITED = r"'[ \t\r\n:,!;%@/()\[\]]+'"


def firsts(df, *names):
    return [accessors.scalar(F.col(name)).alias(name) for name in names]


SQL_FIELDS = f"""select {SQL_LEVEL} as level, user_id::varchar as uid, event_type as action,
    {SQL_AMOUNT} as amount"""


# ---------------------------------------------------------------- sources
@query("s01_text_files", f"{SQL_FIELDS} from events")
def s01(spark, sf_dir):
    found = extract(read_text_logs(spark, app_files(spark, sf_dir)), LINE_RULES, TEXT, log_type=False)
    return found.select(*firsts(found, "level", "uid", "action", "amount"))


@query("s02_binary_files", f"{SQL_FIELDS} from events")
def s02(spark, sf_dir):
    found = extract(read_binary_logs(spark, app_files(spark, sf_dir)), LINE_RULES, TEXT, log_type=False)
    return found.select(*firsts(found, "level", "uid", "action", "amount"))


@query("s02_binary_column", f"{SQL_FIELDS}, event_id from events")
def s02_column(spark, sf_dir):
    binary = app_log(spark, sf_dir).withColumn("line", F.col("line").cast("binary"))
    found = extract(binary, LINE_RULES, "line", log_type=False)
    return found.select(*firsts(found, "level", "uid", "action", "amount"), "event_id")


@query("s03_text_column", f"""
select conv_id, turn, len(n)::bigint as numbers, array_to_string(n, ' ') as found from (
  select conv_id, turn, list_filter(regexp_split_to_array(text, {DELIMITED}), lambda t: regexp_full_match(t, '[0-9]+')) as n
  from conversations)""")
def s03(spark, sf_dir):
    rules = RuleSet().var("number", r"(?<number>\d+)")
    found = extract(table(spark, sf_dir, "conversations"), rules, "text", log_type=False)
    return found.select(
        "conv_id", "turn", F.size("number").cast("long").alias("numbers"), F.array_join("number", " ").alias("found")
    )


@query("s09_query_input", f"{SQL_FIELDS} from events where event_type <> 'view'")
def s09(spark, sf_dir):
    q = LogQuery(LINE_RULES).select(["level", "uid", "action", "amount"]).filter("action <> 'view'")
    return q.from_(app_files(spark, sf_dir)).to_dataframe()


# ---------------------------------------------------------------- rules
@query("r02_priority", """select event_id, case when event_type = 'error' then user_id::varchar end as failed_uid,
    case when event_type <> 'error' then user_id::varchar end as uid from events""")
def r02(spark, sf_dir):
    # both rules match the same text: the higher priority wins, although it was added later
    rules = (
        RuleSet()
        .var("any", r"user=(?<uid>\d+) action=[a-z]+")
        .var("failed", r"user=(?<failed_uid>\d+) action=error", priority=5)
    )
    found = extract(app_log(spark, sf_dir), rules, "line", log_type=False)
    return found.select("event_id", *firsts(found, "failed_uid", "uid"))


@query("r03_timestamps", f"""select event_id, {SQL_TIME} as event_time,
    '<timestamp> ' || substr({SQL_LINE}, 21) as log_type from events""")
def r03(spark, sf_dir):
    # a timestamp goes before any variable rule of the same length, whatever the priority
    stamp = r"\d{4}\-\d{2}\-\d{2} \d{2}:\d{2}:\d{2}"
    rules = RuleSet().var("digits", rf"(?<digits>{stamp})", priority=100).timestamp("time", stamp)
    found = extract(app_log(spark, sf_dir), rules, "line")
    return found.select("event_id", accessors.scalar(F.col(TIMESTAMPS)).alias("event_time"), "log_type")


@query("r04_delimiters", f"""select event_id, user_id::varchar as uid, event_type as action,
    split_part({SQL_AMOUNT}, '.', 1) as whole from events""")
def r04(spark, sf_dir):
    # "=" and "." are delimiters here, so that values are tokens of their own
    rules = (
        RuleSet.with_delimiters(r" \t\n=.!")
        .var("user", r"user=(?<uid>\d+)")
        .var("action", r"action=(?<action>.+)")
        .var("amount", r"amount=(?<whole>.+)")
    )
    found = extract(app_log(spark, sf_dir), rules, "line", log_type=False)
    return found.select("event_id", *firsts(found, "uid", "action", "whole"))


@query("r06_longest_match", f"""select event_id, case when event_type = 'purchase' then {SQL_AMOUNT} end as paid,
    case when event_type <> 'purchase' then {SQL_AMOUNT} end as amount from events""")
def r06(spark, sf_dir):
    # the second rule has the lower rank, but its match is longer where the line goes on
    rules = (
        RuleSet()
        .var("amount", rf"amount=(?<amount>{PATTERN.FLOAT})", priority=1)
        .var("paid", rf"amount=(?<paid>{PATTERN.FLOAT}) paid")
    )
    found = extract(app_log(spark, sf_dir), rules, "line", log_type=False)
    return found.select("event_id", *firsts(found, "paid", "amount"))


OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@query("r09_patterns", f"""
select doc_id, array_to_string(list_filter(t, lambda x: regexp_full_match(x, '({OCTET}[.]){{3}}{OCTET}')), ' ') as ips,
    len(list_filter(t, lambda x: regexp_full_match(x, '-?[0-9]+')))::bigint as ints,
    len(list_filter(t, lambda x: regexp_full_match(x, '-?[0-9]+[.][0-9]+')))::bigint as floats
from (select doc_id, regexp_split_to_array(text, {DELIMITED}) as t from documents)""")
def r09(spark, sf_dir):
    rules = (
        RuleSet()
        .var("ip", rf"(?<ip>{PATTERN.IPV4})")
        .var("float", rf"(?<float>{PATTERN.FLOAT})")
        .var("int", rf"(?<int>{PATTERN.INT})")
    )
    found = extract(table(spark, sf_dir, "documents"), rules, "text", log_type=False)
    return found.select(
        "doc_id", F.array_join("ip", " ").alias("ips"), F.size("int").cast("long").alias("ints"),
        F.size("float").cast("long").alias("floats"),
    )


@query("r09_paths", r"""
with cut as (select page_id, url, regexp_extract(url, '^https?://([a-zA-Z0-9 ._-]+(/[a-zA-Z0-9 ._-]+)*)', 1) as run from pages)
select page_id, case when run = '' then null
    when rest = '' or regexp_matches(rest, '^[ \t\r\n:,!;%@/()\[\]]') then run
    when contains(run, '/') then regexp_replace(run, '/[^/]*$', '') end as path
from (select *, substr(url, position(run in url) + len(run)) as rest from cut)""")
def r09_paths(spark, sf_dir):
    rules = RuleSet().var("url", rf"//(?<path>{PATTERN.LINUX_FILE_PATH})")
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url"), rules, "url", log_type=False)
    return found.select("page_id", *firsts(found, "path"))


SQL_HEX = "md5(event_id::varchar)"
SQL_UUID = "||'-'||".join(f"substr({SQL_HEX}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


@query("r09_java", f"""select event_id, {SQL_UUID} as uuid, (event_id % 60000)::varchar as port, 'app.svc_' || event_id || '.Main' as cls,
    'fn$' || event_id as name, 'a,b:[c]#' || event_id as raw, 'app.svc.Main$Inner.run(Svc.java:' || event_id || ') ~[app.jar:' || event_id || ']' as location,
    '10.0.0.' || event_id % 256 as ip, '-' || event_id || '.5' as amount, 'svc ' || event_id || '.log' as file,
    'done (' || event_id || ' rows) <ok> ~5%' as text from events""")
def r09_java(spark, sf_dir):
    rules = (
        RuleSet()
        .var("uuid", rf"uuid=(?<uuid>{PATTERN.UUID})").var("port", rf"port=(?<port>{PATTERN.PORT})")
        .var("class", rf"class=(?<cls>{PATTERN.JAVA_FULLY_QUALIFIED_CLASS_NAME})").var("name", rf"name=(?<name>{PATTERN.JAVA_IDENTIFIER})")
        .var("raw", rf"raw=(?<raw>{PATTERN.LOG_LINE_NO_WHITE_SPACE})").var("frame", rf"at (?<location>{PATTERN.JAVA_STACK_LOCATION})")
        .var("peer", rf"ip=(?<ip>{PATTERN.IPV4})").var("amount", rf"amount=(?<amount>{PATTERN.FLOAT})")
        .var("file", rf"file=(?<file>{PATTERN.LINUX_FILE_NAME})").var("log", rf"log=(?<text>{PATTERN.LOG_LINE})")
    )
    key = F.col("event_id").cast("string")
    uuid = F.concat_ws("-", *(F.substring(F.md5(key), a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    line = F.concat(
        F.lit("uuid="), uuid, F.lit(" port="), (F.col("event_id") % 60000).cast("string"), F.lit(" class=app.svc_"), key, F.lit(".Main name=fn$"), key,
        F.lit(" raw=a,b:[c]#"), key, F.lit(" ip=10.0.0."), (F.col("event_id") % 256).cast("string"), F.lit(" amount=-"), key,
        F.lit(".5\n  at app.svc.Main$Inner.run(Svc.java:"), key, F.lit(") ~[app.jar:"), key, F.lit("]\nfile=svc "), key, F.lit(".log\nlog=done ("), key,
        F.lit(" rows) <ok> ~5%"),
    )
    found = extract(table(spark, sf_dir, "events").select("event_id", line.alias("line")), rules, "line", log_type=False)
    return found.select("event_id", *firsts(found, "uuid", "port", "cls", "name", "raw", "location", "ip", "amount", "file", "text"))


# ---------------------------------------------------------------- extraction
PAIRS = [a + b for a in "abcdehilnorstu" for b in "aenorstdhiluv"]
SQL_PAIR = f"'({'|'.join(PAIRS)})'"
SQL_STOPS = r"[ \t\r\n:,!;%@/()\[\]]"


@query("x01_many_options", rf"""select doc_id,
    len(list_filter(regexp_split_to_array(text, {DELIMITED}), lambda x: regexp_full_match(x, {SQL_PAIR})))::bigint as words,
    len(list_filter(range(1, len(e)), lambda i: regexp_matches(e[i], '(^|{SQL_STOPS})' || {SQL_PAIR} || '$')
        and regexp_matches(e[i + 1], '^the($|{SQL_STOPS})')))::bigint as followed
from (select doc_id, text, string_split(text, ' ') as e from documents)""")
def x01_many_options(spark, sf_dir):
    # hundreds of options, of which the longest has to win
    rules = RuleSet().var("pair", f"(?<pair>{'|'.join(f'{p}|{p} the' for p in PAIRS)})")
    found = extract(table(spark, sf_dir, "documents"), rules, "text", log_type=False)
    followed = F.filter("pair", lambda p: p.endswith(" the"))
    return found.select("doc_id", F.size("pair").cast("long").alias("words"), F.size(followed).cast("long").alias("followed"))


@query("x01_extract", f"{SQL_FIELDS}, event_id from events")
def x01(spark, sf_dir):
    found = extract(app_log(spark, sf_dir), APP_RULES, "line", log_type=False)
    return found.select("event_id", *firsts(found, "level", "uid", "action", "amount"))


@query("x01_extract_repeated", """select o_orderkey, o_orderkey::varchar as order_keys,
    o_custkey || case when o_orderstatus = 'P' then ' ' || (o_custkey + 1) else '' end as custs,
    case when o_orderstatus = 'F' then '' else o_orderstatus end as statuses from orders""")
def x01_repeated(spark, sf_dir):
    found = extract(order_log(spark, sf_dir), ORDER_RULES, "line", log_type=False)
    return found.select(
        "o_orderkey", F.array_join("order_key", " ").alias("order_keys"),
        F.array_join("cust", " ").alias("custs"), F.array_join("status", " ").alias("statuses"),
    )


#: Twenty optional parts, each of which begins in its own way; every third value is empty.
MANY_PARTS = 20
MANY_RULES = RuleSet().var("many", "order" + "".join(rf"(?: f{i}=(?<f{i}>\d*))?" for i in range(MANY_PARTS)))


def many_parts(spark, sf_dir):
    """Lines "order f0=.. f4=.. end" with the parts whose number and order key say so."""
    parts = []
    for i in range(MANY_PARTS):
        value = F.when((F.col("o_orderkey") + i) % 3 == 0, F.lit("")).otherwise((F.col("o_custkey") + i).cast("string"))
        parts.append(F.when((F.col("o_orderkey") + i * i) % 4 != 0, F.concat(F.lit(f" f{i}="), value)).otherwise(""))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("order"), *parts, F.lit(" end")).alias("line"))


def _many_sql(shown: str) -> list[str]:
    """For each part its SQL, where {v} is the value."""
    out = []
    for i in range(MANY_PARTS):
        value = shown.format(i=i, v=f"case when (o_orderkey + {i}) % 3 = 0 then '' else (o_custkey + {i})::varchar end")
        out.append(f"case when (o_orderkey + {i * i}) % 4 <> 0 then {value} else '' end")
    return out


@query("x01_many_optional_parts", f"""select o_orderkey,
    concat('order', {", ".join(_many_sql("' f{i}=<f{i}>'"))}, ' end') as log_type,
    concat({", ".join(_many_sql("'[' || {v} || ']'"))}) as found from orders""")
def x01_many(spark, sf_dir):
    found = extract(many_parts(spark, sf_dir), MANY_RULES, "line")
    values = [F.array_join(F.transform(f"f{i}", lambda v: F.concat(F.lit("["), v, F.lit("]"))), "") for i in range(MANY_PARTS)]
    return found.select("o_orderkey", "log_type", F.concat(*values).alias("found"))


#: Parts that begin alike: only the end of a match tells which of them took part.
ALIKE_RULES = RuleSet().var("alike", "go" + "".join(rf"(?: (?<w{i}>[a-z]+))?(?: (?<n{i}>[a-z]+)=\d)?" for i in range(8)))


@query("x01_parts_that_begin_alike", """select event_id,
    case when event_id % 3 = 2 then '' else event_type end as word,
    case when event_id % 3 = 0 then '' else event_type end as named,
    'x go' || case when event_id % 3 = 2 then '' else ' <w0>' end || case when event_id % 3 = 0 then '' else ' <n0>=7' end || ' 12'
    as log_type from events""")
def x01_alike(spark, sf_dir):
    word = F.when(F.col("event_id") % 3 == 2, "").otherwise(F.concat(F.lit(" "), "event_type"))
    named = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit(" "), "event_type", F.lit("=7")))
    lines = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("x go"), word, named, F.lit(" 12")).alias("line"))
    found = extract(lines, ALIKE_RULES, "line")
    return found.select("event_id", F.array_join("w0", ",").alias("word"), F.array_join("n0", ",").alias("named"), "log_type")


@query("x02_log_type", f"select event_id, {SQL_LOG_TYPE} as log_type from events")
def x02(spark, sf_dir):
    return extract(app_log(spark, sf_dir), APP_RULES, "line").select("event_id", "log_type")


@query("x03_message", f"select event_id, {SQL_LINE} as message from events")
def x03(spark, sf_dir):
    parser = LogParser(rules=LINE_RULES)
    return parser.parse(app_log(spark, sf_dir), "line").select("event_id", "message")


@query("x04_scalar_or_list", """select o_orderkey, o_custkey::varchar as first_cust,
    case when o_orderstatus = 'P' then '["' || o_custkey || '","' || (o_custkey + 1) || '"]'
         else '"' || o_custkey || '"' end as cust,
    (case when o_orderstatus = 'P' then 2 else 1 end)::bigint as n from orders""")
def x04(spark, sf_dir):
    found = extract(order_log(spark, sf_dir), ORDER_RULES, "line", log_type=False)
    cust = F.col("cust")
    return found.select(
        "o_orderkey", accessors.scalar(cust).alias("first_cust"),
        F.to_json(accessors.scalar_or_list(cust)).alias("cust"), F.size(cust).cast("long").alias("n"),
    )


@query("x05_as_text", """select o_orderkey,
    case when o_orderstatus = 'P' then '["' || o_custkey || '","' || (o_custkey + 1) || '"]'
         else o_custkey::varchar end as cust,
    case when o_orderstatus <> 'F' then o_orderstatus end as status from orders""")
def x05(spark, sf_dir):
    found = extract(order_log(spark, sf_dir), ORDER_RULES, "line", log_type=False)
    return found.select(
        "o_orderkey", *[accessors.as_text(F.col(name)).alias(name) for name in ("cust", "status")]
    )


@query("x06_strict_access", "select event_id, user_id::varchar as uid from events")
def x06(spark, sf_dir):
    found = extract(app_log(spark, sf_dir), APP_RULES, "line", log_type=False)
    return found.select("event_id", accessors.strict(F.col("uid"), "uid").alias("uid"))


@query("x07_variables", """select o_orderkey, '{"order_key":["' || o_orderkey || '"],"cust":["' || o_custkey ||
    case when o_orderstatus = 'P' then '","' || (o_custkey + 1) else '' end || '"]' ||
    case when o_orderstatus = 'F' then '' else ',"status":["' || o_orderstatus || '"]' end || '}' as variables
    from orders""")
def x07(spark, sf_dir):
    found = extract(order_log(spark, sf_dir), ORDER_RULES, "line", log_type=False)
    named = {name: F.col(name) for name in ORDER_RULES.capture_names}
    return found.select("o_orderkey", F.to_json(accessors.variables(named)).alias("variables"))


@query("x08_timestamp", f"select event_id, {SQL_TIME} as stamp, {SQL_TIME} as event_time from events")
def x08(spark, sf_dir):
    found = extract(app_log(spark, sf_dir), APP_RULES, "line", log_type=False)
    when = accessors.event_time(F.col(TIMESTAMPS), "yy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss")
    return found.select(
        "event_id", accessors.scalar(F.col(TIMESTAMPS)).alias("stamp"), when.cast("string").alias("event_time")
    )


@query("x09_event_json", f"""select event_id, '{{"level":"' || {SQL_LEVEL} || '","uid":"' || user_id || '","action":"'
    || event_type || '","amount":"' || {SQL_AMOUNT} || '","@LogType":"' || {SQL_LINE_TYPE} || '"}}' as event
    from events""")
def x09(spark, sf_dir):
    found = extract(app_log(spark, sf_dir), LINE_RULES, "line")
    named = {name: F.col(name) for name in LINE_RULES.capture_names}
    return found.select("event_id", accessors.event_json(named, F.col("log_type")).alias("event"))


@query("x10_typed", "select event_id, user_id as uid, value as amount from events")
def x10(spark, sf_dir):
    types = {"uid": "bigint", "amount": "double"}
    found = extract(app_log(spark, sf_dir), APP_RULES, "line", log_type=False, types=types)
    return found.select("event_id", *firsts(found, "uid", "amount"))


@query("x11_tokens", f"""
select doc_id, len(t)::bigint as n, md5(array_to_string(t, '|')) as digest from (
  select doc_id, list_filter(regexp_split_to_array(text, {DELIMITED}), lambda x: x <> '') as t from documents)""")
def x11(spark, sf_dir):
    tokens = accessors.tokens(F.col("text"), RuleSet())
    docs = table(spark, sf_dir, "documents").select("doc_id", tokens.alias("t"))
    return docs.select("doc_id", F.size("t").cast("long").alias("n"), F.md5(F.array_join("t", "|")).alias("digest"))


@query("x12_matched", f"""
select doc_id, len(list_filter(t, lambda x: regexp_full_match(x, '[0-9]+'))) > 0 as matched
from (select doc_id, regexp_split_to_array(text, {DELIMITED}) as t from documents)""")
def x12(spark, sf_dir):
    rules = RuleSet().var("number", r"(?<number>\d+)")
    found = extract(table(spark, sf_dir, "documents"), rules, "text", log_type=False)
    return found.select("doc_id", matched(rules).alias("matched"))
