"""Projection, filters, log type analytics and sinks."""

import pyarrow as pa
from pyspark.sql import functions as F

from logtables import LogQuery, extract
from logtables.operators import analytics
from logtables.workspace import new_folder
from queries.inputs import (
    APP_RULES, LINE_RULES, ORDER_RULES, SQL_AMOUNT, SQL_LEVEL, SQL_LINE, SQL_LINE_TYPE,
    SQL_LOG_TYPE, SQL_TIME, SQL_USER_TYPE, USER_RULES, app_log, order_log,
)
from queries.registry import query

SQL_ORDER_TYPE = """'order=<order_key> cust=<cust>' || case when o_orderstatus = 'P' then ' then cust=<cust>' else '' end
    || case when o_orderstatus = 'F' then '' else ' status=<status>' end"""


def app_query(spark, sf_dir, rules=APP_RULES):
    return LogQuery(rules).from_(app_log(spark, sf_dir), text="line", order="event_id")


@query("q01_projection", f"select {SQL_AMOUNT} as amount, user_id::varchar as uid from events")
def q01(spark, sf_dir):
    return app_query(spark, sf_dir).select(["amount", "uid"]).to_dataframe()


@query("q02_wildcard", f"""select {SQL_TIME} as "timestamp", {SQL_LEVEL} as level, user_id::varchar as uid,
    event_type as action, {SQL_AMOUNT} as amount from events""")
def q02(spark, sf_dir):
    return app_query(spark, sf_dir).select(["timestamp", "*"]).to_dataframe()


@query("q03_metadata_fields", f"""select {SQL_LOG_TYPE} as "@log_type", {SQL_LINE} as "@log_message" from events""")
def q03(spark, sf_dir):
    return app_query(spark, sf_dir).select(["@log_type", "@log_message"]).to_dataframe()


@query("q05_filter", f"""select user_id::varchar as uid, event_type as action, {SQL_AMOUNT} as amount from events
    where value > 50 and event_type in ('click', 'purchase')""")
def q05(spark, sf_dir):
    q = app_query(spark, sf_dir).select(["uid", "action", "amount"]).filter("double(amount) > 50")
    return q.filter(F.col("action").isin("click", "purchase")).to_dataframe()


@query("q06_filter_on_unselected", f"""select user_id::varchar as uid from events
    where event_type = 'error' and {SQL_TIME} < '2024-01-15' and event_id >= 100""")
def q06(spark, sf_dir):
    q = app_query(spark, sf_dir).select("uid").filter("log_type like '%retry%' and timestamp < '2024-01-15'")
    return q.filter("event_id >= 100").to_dataframe()


@query("q08_log_types", f"""select log_type from (
    select {SQL_LOG_TYPE} as log_type, min(event_id) as first_seen from events group by 1) order by first_seen""")
def q08(spark, sf_dir):
    return app_query(spark, sf_dir).get_log_types()


@query("q09_log_type_counts", f"""select {SQL_LOG_TYPE} as log_type, count(*) as "count" from events group by 1""")
def q09(spark, sf_dir):
    return app_query(spark, sf_dir).get_log_type_counts()


@query("q09_order_log_type_counts", f"""select {SQL_ORDER_TYPE} as log_type, count(*) as "count" from orders group by 1""")
def q09_orders(spark, sf_dir):
    return LogQuery(ORDER_RULES).from_(order_log(spark, sf_dir), text="line").get_log_type_counts()


@query("q10_log_type_samples", f"""select log_type, string_agg(line, '|' order by event_id) as samples from (
    select event_id, {SQL_LOG_TYPE} as log_type, {SQL_LINE} as line,
           row_number() over (partition by {SQL_LOG_TYPE} order by event_id) as n from events) where n <= 3 group by 1""")
def q10(spark, sf_dir):
    found = app_query(spark, sf_dir).get_log_type_with_sample(3)
    return found.select("log_type", F.array_join("samples", "|").alias("samples"))


@query("q11_frequent_log_types", f"""select {SQL_ORDER_TYPE} as log_type, count(*) as "count" from orders
    group by 1 order by 2 desc, 1 limit 2""")
def q11(spark, sf_dir):
    return analytics.frequent_log_types(extract(order_log(spark, sf_dir), ORDER_RULES, "line"), limit=2)


@query("q11_top_types_among_many", f"""select {SQL_LINE_TYPE} as log_type, count(*) as "count" from events
    group by 1 order by 2 desc, 1 limit 5""")
def q11_many(spark, sf_dir):
    # the time stays in the log type, so nearly every row has one of its own
    return analytics.top_log_types(extract(app_log(spark, sf_dir), LINE_RULES, "line"), limit=5)


@query("q12_rare_log_types", f"""select {SQL_LINE_TYPE} as log_type, count(*) as "count" from events
    group by 1 having count(*) < 10""")
def q12(spark, sf_dir):
    # without a timestamp rule the time stays in the log type, which makes nearly every type rare
    return analytics.rare_log_types(extract(app_log(spark, sf_dir), LINE_RULES, "line"), below=10)


@query("q12_rare_types_among_frequent", f"""select {SQL_USER_TYPE} as log_type, count(*) as "count" from events
    group by 1 having count(*) < 10""")
def q12_frequent(spark, sf_dir):
    # a type per user and kind of line: most are frequent, and half of the rows prove it
    return analytics.rare_types_among_frequent(extract(app_log(spark, sf_dir), USER_RULES, "line"), below=10, share=0.5)


@query("q13_new_log_types", f"""select {SQL_ORDER_TYPE} as log_type, count(*) as "count" from orders
    where o_orderdate >= timestamp '1995-01-01' and ({SQL_ORDER_TYPE}) not in
      (select {SQL_ORDER_TYPE} from orders where o_orderdate < timestamp '1995-01-01' and o_orderstatus <> 'P')
    group by 1""")
def q13(spark, sf_dir):
    # pending orders are new: the baseline, orders before 1995, leaves them out
    cut = F.lit("1995-01-01").cast("timestamp_ntz")
    late = F.col("o_orderdate") >= cut
    log = order_log(spark, sf_dir)
    found = extract(log.where(late), ORDER_RULES, "line")
    baseline = extract(log.where(~late & (F.col("o_orderstatus") != "P")), ORDER_RULES, "line")
    return analytics.new_log_types(found, baseline)


@query("q14_value_counts", """select value, count(*) as "count" from (
    select o_custkey::varchar as value from orders
    union all select (o_custkey + 1)::varchar from orders where o_orderstatus = 'P') group by 1""")
def q14(spark, sf_dir):
    return analytics.value_counts(extract(order_log(spark, sf_dir), ORDER_RULES, "line", log_type=False), "cust")


# ---------------------------------------------------------------- sinks
SQL_ROWS = f"select {SQL_LEVEL} as level, user_id::varchar as uid, {SQL_AMOUNT} as amount from events"


@query("k01_to_dataframe", SQL_ROWS)
def k01(spark, sf_dir):
    return app_query(spark, sf_dir).select(["level", "uid", "amount"]).to_df()


@query("k02_to_arrow", f"""select {SQL_LOG_TYPE} as log_type, count(*) as "count" from events group by 1""")
def k02(spark, sf_dir):
    # the result as Arrow streams, stored as another program would get them, and read again
    def read(batches):
        for batch in batches:
            for stream in batch.column(0):
                yield from pa.ipc.open_stream(stream.as_buffer())

    result = app_query(spark, sf_dir).select(["@log_type"])
    folder = new_folder(spark, "arrow")
    result.arrow_streams().write.parquet(folder)
    rows = spark.read.parquet(folder).select("stream").mapInArrow(read, result.to_dataframe().schema)
    return rows.groupBy(F.col("@log_type").alias("log_type")).count()


@query("k03_rows", f"""select {SQL_LOG_TYPE} as log_type, count(*) as n from events group by 1""")
def k03(spark, sf_dir):
    rows = app_query(spark, sf_dir).select(["@log_type", "uid"]).row_lists()
    return rows.groupBy(F.col("row")[0].alias("log_type")).agg(F.count("*").alias("n"))


@query("k04_parquet", SQL_ROWS)
def k04(spark, sf_dir):
    folder = new_folder(spark, "rows")
    app_query(spark, sf_dir).select(["level", "uid", "amount"]).to_parquet(folder)
    return spark.read.parquet(folder)
