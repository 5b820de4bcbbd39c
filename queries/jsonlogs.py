"""JSON logs: sources, mining, merging."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from logtables import JsonLogParser, LogQuery, RuleSet, enrich_columns
from logtables.operators.jsonlogs import CONFLICTS, CORRUPT, OBJECT, field_text, object_json
from logtables.sources.json import is_array
from logtables.workspace import new_folder
from queries.inputs import (
    JSON_RULES, SQL_AMOUNT, SQL_HEAD, SQL_LEVEL, SQL_MESSAGE, amount_text, json_files, json_log, json_text,
    level, table,
)
from queries.registry import query

def obj():
    return F.col(OBJECT)


def fields(*names):
    """Text of paths; the column is named after the last step."""
    return [field_text(obj(), name).alias(name.rsplit(".", 1)[-1]) for name in names]


def parser(*paths, rules=JSON_RULES):
    made = JsonLogParser(rules)
    return made.target_fields(list(paths)) if paths else made


ALL = f"""select event_id::varchar as id, user_id::varchar as uid, event_type as action, {SQL_AMOUNT} as amount
    from events"""
ID_ACTION = "select event_id::varchar as id, event_type as action from events"


# ---------------------------------------------------------------- sources
@query("s05_ndjson_files", ALL)
def s05(spark, sf_dir):
    found = parser().parse(json_files(spark, sf_dir))
    return found.select(*fields("id", "extracted.uid", "extracted.action", "extracted.amount"))


def array_text():
    """An array of two objects and two other values."""
    second = F.to_json(F.struct(F.col("event_id").alias("id"), F.lit("user=7 action=retry").alias("message")))
    return F.concat(F.lit("[ "), json_text(), F.lit(", \"user=1\", 5,\n "), second, F.lit(" ]"))


def array_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", array_text().alias("value"))


@query("s06_json_arrays", f"{ID_ACTION} union all select event_id::varchar, 'retry' from events")
def s06(spark, sf_dir):
    found = parser("message").parse(array_rows(spark, sf_dir), layout="array")
    return found.select(*fields("id", "extracted.action"))


#: Files that arrays are written to, however many rows there are: large files are read in splits, many small ones one by one.
ARRAY_FILES = 64


def array_files(rows, name):
    """Files of one array each, from rows (event_id, v: elements as text); returns the folder, with a part per file."""
    folder = new_folder(rows.sparkSession, name)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(ARRAY_FILES)))
    along = Window.partitionBy("part").orderBy("event_id")
    opened = F.when(F.lag(F.lit(1)).over(along).isNull(), "\n[").otherwise(",")
    closed = F.when(F.lead(F.lit(1)).over(along).isNull(), "\n]").otherwise("")
    rows.select(F.concat(opened, "v", closed).alias("value"), "part").write.partitionBy("part").text(folder)
    return folder


@query("s06_json_array_files", f"{ID_ACTION} union all select event_id::varchar, 'retry' from events")
def s06_files(spark, sf_dir):
    arrays = array_rows(spark, sf_dir).select("event_id", F.expr("substring(value, 2, length(value) - 2)").alias("v"))
    folder = array_files(arrays, "json-arrays")
    found = parser("message").parse(f"{folder}/part=*", layout="array")
    return found.select(*fields("id", "extracted.action"))


def mixed_rows(spark, sf_dir):
    """Clicks as arrays, other events as two lines: an object and a blank."""
    text = F.when(F.col("event_type") == "click", array_text()).otherwise(F.concat(json_text(), F.lit("\n\n")))
    return table(spark, sf_dir, "events").select(text.alias("value"))


SQL_MIXED = f"{ID_ACTION} union all select event_id::varchar, 'retry' from events where event_type = 'click'"


@query("s07_detect_layout", SQL_MIXED)
def s07(spark, sf_dir):
    found = parser("message").parse(mixed_rows(spark, sf_dir), layout="auto")
    return found.select(*fields("id", "extracted.action"))


@query("s07_detect_layout_of_files", f"{ID_ACTION} where event_id % 100 <> 0 or event_type <> 'click' union all {ID_ACTION} where event_id % 100 = 0 and event_type = 'click'")
def s07_files(spark, sf_dir):
    # a folder with files of arrays and files of lines
    events = table(spark, sf_dir, "events")
    as_array = (F.col("event_id") % 100 == 0) & (F.col("event_type") == "click")
    folder = array_files(events.where(as_array).select("event_id", json_text().alias("v")), "json-mixed")
    events.where(~as_array).select(json_text().alias("value"), F.lit(-1).alias("part")).write.mode("append").partitionBy("part").text(folder)
    found = parser("message").parse(f"{folder}/part=*", layout="auto")
    return found.select(*fields("id", "extracted.action"))


@query("s07_array_test", """select event_id, event_type = 'click' as is_array from events""")
def s07_test(spark, sf_dir):
    text = F.when(F.col("event_type") == "click", F.concat(F.lit("\n ["), json_text(), F.lit("]"))).otherwise(
        json_text()
    )
    return table(spark, sf_dir, "events").select("event_id", is_array(text).alias("is_array"))


# ---------------------------------------------------------------- mining
@query("j01_enrich_stream_of_objects", f"""select event_id, '{{' || {SQL_HEAD} || ',"extracted":{{"action":"' || event_type
    || '","amount":"' || {SQL_AMOUNT} || '","uid":"' || user_id || '"}}}}' as enriched from events""")
def j01(spark, sf_dir):
    return parser().parse(json_log(spark, sf_dir)).select("event_id", object_json(obj()).alias("enriched"))


@query("j02_enrich_one_object", f"""select event_id, case when event_type <> 'error' then user_id::varchar end as uid,
    case when event_type <> 'error' then {SQL_AMOUNT} end as amount, event_type = 'error' as refused from events""")
def j02(spark, sf_dir):
    # errors come cut off, which is no JSON
    text = F.when(F.col("event_type") == "error", F.expr("left(value, length(value) - 3)")).otherwise(F.col("value"))
    rows = json_log(spark, sf_dir).select("event_id", F.col("value"), F.col("event_type")).withColumn("value", text)
    found = parser().parse_one(rows.select("event_id", "value"), strict=False)
    return found.select("event_id", *fields("extracted.uid", "extracted.amount"), F.col(CORRUPT).isNotNull().alias("refused"))


@query("j03_target_fields", "select event_id, user_id::varchar as uid, null::varchar as amount from events")
def j03(spark, sf_dir):
    found = parser("message").parse(json_log(spark, sf_dir))
    return found.select("event_id", *fields("extracted.uid", "extracted.amount"))


@query("j04_dotted_path", f"select event_id, {SQL_AMOUNT} as amount, null::varchar as uid from events")
def j04(spark, sf_dir):
    found = parser("ctx.detail", "ctx.missing.step", "id.x").parse(json_log(spark, sf_dir))
    return found.select("event_id", *fields("extracted.amount", "extracted.uid"))


@query("j05_all_strings", f"""select event_id, '["' || user_id || '","' || (user_id + 1) || '","' || (user_id + 2) || '"]'
    as uid, {SQL_AMOUNT} as amount from events""")
def j05(spark, sf_dir):
    number = F.col("user_id")
    deep = F.array(F.struct(F.concat(F.lit('said "user='), (number + 1).cast("string"), F.lit('"')).alias("a"),
                            F.concat(F.lit("\t user="), (number + 2).cast("string")).alias("user=9")))
    rules = JSON_RULES.var("quoted", r'\"user=(?<uid>\d+)\"')
    found = parser(rules=rules).parse(json_log(spark, sf_dir, deep.alias("deep")))
    return found.select("event_id", *fields("extracted.uid", "extracted.amount"))


@query("j05_all_strings_typed", f"""select event_id, event_type as action, {SQL_AMOUNT} as amount,
    user_id || ',' || (user_id + 1) as uid from events""")
def j05_typed(spark, sf_dir):
    uid = F.col("user_id")
    text = lambda n: F.concat(F.lit("user="), n.cast("string"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", "value", text(uid).alias("message"),
        F.struct(F.array(text(uid + 1), F.concat(F.lit("action="), "event_type")).alias("list"),
                 F.create_map(F.lit("d"), F.concat(F.lit("amount="), amount_text())).alias("map")).alias("ctx"),
    )
    found = enrich_columns(rows, JSON_RULES)
    return found.select(
        "event_id", F.array_join("extracted.action", ",").alias("action"),
        F.array_join("extracted.amount", ",").alias("amount"), F.array_join("extracted.uid", ",").alias("uid"),
    )


@query("j06_skip_non_strings", "select event_id, null::varchar as number from events")
def j06(spark, sf_dir):
    rules = RuleSet().var("number", r"(?<number>\d+)")
    found = parser("id", "ctx.n", "ctx", "level", rules=rules).parse(json_log(spark, sf_dir))
    return found.select("event_id", *fields("extracted.number"))


@query("j07_first_event_of_field", """select event_id, user_id::varchar as uid,
    '["' || user_id || '","' || event_id || '"]' as every_uid from events""")
def j07(spark, sf_dir):
    two = F.concat(F.lit("user="), F.col("user_id").cast("string"), F.lit(" one\nuser="), F.col("event_id").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(two.alias("m"))).alias("value"))
    first = parser("m").parse(rows, keep_text=True).select("event_id", *fields("extracted.uid"), "value")
    every = parser("m").parse(first.select("event_id", "uid", "value"), all_events=True)
    return every.select("event_id", "uid", field_text(obj(), "extracted.uid").alias("every_uid"))


@query("j08_combine_fields", """select event_id, '["' || (event_id + 1) || '","' || (event_id + 2) || '","' || event_id || '"]' as uid
    from events""")
def j08(spark, sf_dir):
    n = F.col("event_id")
    text = lambda *ns: F.concat_ws(" ", *[F.concat(F.lit("user="), x.cast("string")) for x in ns])
    value = F.to_json(F.struct(text(n).alias("msg1"), text(n + 1, n + 2).alias("msg2")))
    rows = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    # in the order of the fields asked for, not of the document
    return parser("msg2", "msg1").parse(rows).select("event_id", *fields("extracted.uid"))


@query("j09_drop_timestamps", f"""select event_id, '{{"uid":"' || user_id || '"}}' as extracted from events""")
def j09(spark, sf_dir):
    rules = RuleSet().timestamp("t", r"\d{4}\-\d{2}\-\d{2}").var("user", r"user=(?<uid>\d+)")
    text = F.concat(F.substring(F.col("ts").cast("string"), 1, 10), F.lit(" user="), F.col("user_id").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(text.alias("m"))).alias("value"))
    found = parser(rules=rules).parse(rows)
    return found.select("event_id", *fields("extracted"))


# ---------------------------------------------------------------- merging
@query("j10_nest", f"""select event_id, user_id::varchar as uid, '{{' || {SQL_HEAD} || '}}' as rest,
    null::varchar as root_uid from events""")
def j10(spark, sf_dir):
    found = parser("message").on_conflict("nest", key="vars").parse(json_log(spark, sf_dir))
    rest = object_json(F.map_filter(obj(), lambda k, _: k != "vars"))
    return found.select("event_id", *fields("vars.uid"), rest.alias("rest"), field_text(obj(), "uid").alias("root_uid"))


@query("j11_nest_key_taken", f"""select event_id, user_id::varchar as uid, {SQL_LEVEL} as original_value,
    '' as conflicts from events""")
def j11(spark, sf_dir):
    found = parser("message").parse(json_log(spark, sf_dir, level().alias("extracted")))
    return found.select(
        "event_id", *fields("extracted.uid", "extracted.original_value"),
        F.array_join(CONFLICTS, ",").alias("conflicts"),
    )


@query("j11_original_value_clash", f"""select event_id, {SQL_LEVEL} as original_value, 'original_value' as conflicts
    from events""")
def j11_clash(spark, sf_dir):
    rules = RuleSet().var("user", r"user=(?<original_value>\d+)")
    found = parser("message", rules=rules).parse(json_log(spark, sf_dir, level().alias("extracted")))
    return found.select(
        "event_id", *fields("extracted.original_value"), F.array_join(CONFLICTS, ",").alias("conflicts")
    )


@query("j12_prefix", """select event_id, user_id::varchar as uid, event_type as action,
    case when event_type = 'click' then 'extracted.uid' else '' end as conflicts from events""")
def j12(spark, sf_dir):
    taken = F.when(F.col("event_type") == "click", F.lit("old")).alias("extracted.uid")
    found = parser("message").on_conflict("prefix").parse(json_log(spark, sf_dir, taken))
    return found.select(
        "event_id", *fields("extracted.uid", "extracted.action"), F.array_join(CONFLICTS, ",").alias("conflicts")
    )


@query("j13_overwrite", """select event_id, user_id::varchar as uid, event_type as action,
    'uid' as conflicts from events""")
def j13(spark, sf_dir):
    found = parser("message").on_conflict("overwrite").parse(json_log(spark, sf_dir, F.lit(-1).alias("uid")))
    return found.select("event_id", *fields("uid", "action"), F.array_join(CONFLICTS, ",").alias("conflicts"))


@query("j14_raise", """select event_id, case when event_type <> 'click' then user_id::varchar end as uid,
    case when event_type = 'click' then 'action' else '' end as taken, event_type = 'click' as refused from events""")
def j14(spark, sf_dir):
    # clicks have the key "action" already; without strict such an object is reported instead of ending the job
    action = F.when(F.col("event_type") == "click", F.lit("old")).alias("action")
    found = parser("message").on_conflict("raise").parse(json_log(spark, sf_dir, action), strict=False)
    return found.select("event_id", *fields("uid"), F.array_join(CONFLICTS, ",").alias("taken"), F.col(CORRUPT).isNotNull().alias("refused"))


@query("j15_nothing_to_merge", f"select event_id, '{{' || {SQL_HEAD} || '}}' as enriched from events")
def j15(spark, sf_dir):
    rules = RuleSet().var("none", r"nowhere=(?<none>\d+)")
    found = parser(rules=rules).on_conflict("overwrite").parse(json_log(spark, sf_dir))
    return found.select("event_id", object_json(obj()).alias("enriched"))


@query("j16_conflict_report", """select 'action' as taken, count(*) filter (where event_type = 'click') as n from events
    union all select 'uid', count(*) from events""")
def j16(spark, sf_dir):
    action = F.when(F.col("event_type") == "click", F.lit("old")).alias("action")
    log = json_log(spark, sf_dir, F.lit("x").alias("uid"), action)
    found = parser("message").on_conflict("overwrite").parse(log)
    return found.select(F.explode(CONFLICTS).alias("taken")).groupBy("taken").agg(F.count("*").alias("n"))


@query("j17_include_log_type", """select event_id,
    '["amount=<amount>","user=<uid> action=<action>"]' as log_types from events""")
def j17(spark, sf_dir):
    found = parser("ctx.detail", "message").include_log_type().parse(json_log(spark, sf_dir))
    return found.select("event_id", field_text(obj(), "extracted.@log_type").alias("log_types"))


@query("j18_write_json", f"""select event_id::varchar as id, {SQL_LEVEL} as level, user_id::varchar as uid,
    {SQL_MESSAGE} as message from events""")
def j18(spark, sf_dir):
    folder = new_folder(spark, "enriched-json")
    found = parser("message").parse(json_log(spark, sf_dir))
    found.select(object_json(obj()).alias("value")).write.text(folder)
    schema = "id string, level string, message string, extracted struct<uid: string>"
    return spark.read.schema(schema).json(folder).select("id", "level", "extracted.uid", "message")


# ---------------------------------------------------------------- query
@query("q04_dotted_projection", f"""select event_id::varchar as id, user_id::varchar as "extracted.uid",
    'amount=' || {SQL_AMOUNT} as "ctx.detail", null::varchar as "ctx.none" from events where event_type = 'error'""")
def q04(spark, sf_dir):
    q = LogQuery(parser()).select(["id", "extracted.uid", "ctx.detail", "ctx.none"])
    return q.filter(LogQuery.field("level") == "ERROR").from_(json_log(spark, sf_dir)).to_dataframe()


@query("q15_json_log_type_counts", """select 'user=<uid> action=<action>' as log_type, count(*) as "count" from events
    union all select 'amount=<amount>', count(*) from events
    union all select case event_type when 'error' then 'ERROR' when 'signup' then 'WARN' else 'INFO' end, count(*)
    from events group by 1""")
def q15(spark, sf_dir):
    q = LogQuery(parser().include_log_type()).from_(json_log(spark, sf_dir), order="event_id")
    return q.get_log_type_counts()


@query("q15_json_log_type_samples", """with t as (select 'user=<uid> action=<action>' as log_type, event_id from events
    union all select 'amount=<amount>', event_id from events),
  r as (select *, row_number() over (partition by log_type order by event_id) as n from t)
  select log_type, string_agg(event_id::varchar, ',' order by event_id) as ids from r where n <= 2 group by 1""")
def q15_samples(spark, sf_dir):
    made = parser("message", "ctx.detail").include_log_type().on_conflict("nest", key="vars")
    q = LogQuery(made).from_(json_log(spark, sf_dir), order="event_id")
    ids = F.transform("samples", lambda text: F.get_json_object(text, "$.id"))
    return q.get_log_type_with_sample(2).select("log_type", F.array_join(ids, ",").alias("ids"))


@query("q15_json_log_types", """select 'user=<uid> action=<action>' as log_type
    union all select 'amount=<amount>'""")
def q15_types(spark, sf_dir):
    made = parser("message", "ctx.detail").include_log_type().on_conflict("prefix", prefix="p_")
    return LogQuery(made).from_(json_log(spark, sf_dir), order="event_id").get_log_types()
