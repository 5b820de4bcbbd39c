import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logtables import LogQuery, RuleSet, extract
from logtables.operators import analytics
from logtables.sources.text import from_strings

RULES = RuleSet().var("metric", r"metric=(?<metric_name>[a-zA-Z0-9_]+) value=(?<value>\d+)")
LINES = ["2024-01-01 INFO: metric=cpu value=42", "2024-01-01 INFO: metric=memory value=100",
         "2024-01-01 INFO: metric=disk value=7", "2024-01-02 INFO: metric=cpu value=85"]


@pytest.fixture
def log(spark):
    return from_strings(spark, LINES)


def test_rows_and_exports(log):
    query = LogQuery(RULES).select(["metric_name", "value"]).from_(log)
    assert query.get_rows() == [["cpu", "42"], ["memory", "100"], ["disk", "7"], ["cpu", "85"]]
    assert query.get_rows() == list(query.iterate_rows())  # a query can run again
    assert query.to_arrow().column_names == ["metric_name", "value"] and query.to_pa().num_rows == 4
    assert query.to_pandas()["value"].tolist() == ["42", "100", "7", "85"]
    assert query.to_df().columns == ["metric_name", "value"]


def test_filters(log):
    query = LogQuery(RULES).select(["metric_name"]).from_(log).filter("int(value) > 50")
    assert query.get_rows() == [["memory"], ["cpu"]]
    assert query.filter(F.col("metric_name") == "cpu").get_rows() == [["cpu"]]
    assert query.replace_filter("log_type like '2024-01-02%' and line = 3").get_rows() == [["cpu"]]


def test_wildcard_metadata_and_lists(spark, log):
    query = LogQuery(RULES).select(["@log_type", "*", "@log_message"]).from_(log)
    assert query.to_df().columns == ["@log_type", "metric_name", "value", "@log_message"]
    assert query.get_rows()[0] == ["2024-01-01 INFO: metric=<metric_name> value=<value>", "cpu", "42", LINES[0]]
    rules = RuleSet().var("u", r"u=(?<u>\d+)").timestamp("t", r"\d\d:\d\d")
    rows = from_strings(spark, ["10:00 u=1 u=2", "x"])
    assert LogQuery(rules).select(["u", "timestamp"]).from_(rows).get_rows() == [['["1","2"]', "10:00"], [None, None]]
    raw = LogQuery(rules, raw_output=True).select("u").from_(rows)
    assert raw.get_rows() == [[["1", "2"]], [[]]]
    several = LogQuery(rules).select("u").from_(from_strings(spark, ["10:00 u=1\n u=2\n11:00 u=3"]), multiline=True)
    assert several.get_rows() == [['["1","2"]'], ["3"]]


def test_incomplete_queries(log):
    with pytest.raises(AttributeError):
        LogQuery(RULES).from_(log).validate_query()
    with pytest.raises(AttributeError):
        LogQuery(RULES).select([]).from_(log).validate_query()
    with pytest.raises(AttributeError):
        LogQuery(RULES).select("value").validate_query()
    with pytest.raises(Exception, match="UNRESOLVED"):
        LogQuery(RULES).select("nope").from_(log).validate_query()
    assert LogQuery(RULES).capture_names == ("metric_name", "value")


def test_captures_named_like_input_columns(spark):
    rows = spark.createDataFrame([("metric=cpu value=1", "old")], "text string, value string")
    assert LogQuery(RULES).select("value").from_(rows, text="text").get_rows() == [["1"]]


def test_paths(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(LINES))
    query = LogQuery(RULES).select(["value", "source"]).from_(str(tmp_path))
    assert [row[0] for row in query.get_rows()] == ["42", "100", "7", "85"]
    query.to_parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert [r[0][:10] for r in query.get_log_types().collect()] == ["2024-01-01", "2024-01-02"]


def test_log_types(spark, log):
    query = LogQuery(RULES).from_(log, order="line")
    first, second = (f"2024-01-0{i} INFO: metric=<metric_name> value=<value>" for i in (1, 2))
    assert [r[0] for r in query.get_log_types().collect()] == [first, second]
    assert {tuple(r) for r in query.get_log_type_counts().collect()} == {(first, 3), (second, 1)}
    samples = {r["log_type"]: r["samples"] for r in query.get_log_type_with_sample(2).collect()}
    assert samples == {first: LINES[:2], second: LINES[3:]}
    assert [r[0] for r in query.filter("value = 85").get_log_types().collect()] == [second]
    events = LogQuery(RULES).from_(log)._typed_events()[0]
    assert [tuple(r) for r in analytics.frequent_log_types(events, 1).collect()] == [(first, 3)]
    assert [r[0] for r in analytics.rare_log_types(events, below=2).collect()] == [second]
    new = analytics.new_log_types(events, events.where("line < 3"))
    assert [tuple(r) for r in new.collect()] == [(second, 1)]


@pytest.mark.parametrize("limit, slots", [(1, 64), (5, 256), (5, 1 << 16), (40, 16), (3000, 64)])
def test_top_types_among_many(spark, limit, slots):
    """Equal to counting all types, ties and NULL included, whatever the slots hold."""
    rng = random.Random(limit)
    types = [f"type {int(rng.paretovariate(0.7))}" for _ in range(1500)] + [f"own {i}" for i in range(1500)] + [None] * 7
    df = spark.createDataFrame([(t,) for t in types], "log_type string").repartition(5)
    expected = [tuple(r) for r in analytics.frequent_log_types(df, limit).collect()]
    assert [tuple(r) for r in analytics.top_log_types(df, limit, slots).collect()] == expected


def test_top_types_of_few_or_no_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "log_type string")
    assert [tuple(r) for r in analytics.top_log_types(df, 5).collect()] == [("a", 2), ("b", 1)]
    assert analytics.top_log_types(df.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        analytics.top_log_types(df, 0)


@pytest.mark.parametrize("share, most", [(0.5, 1000), (0.9, 3), (1.0, 1000), (0.01, 1000)])
def test_rare_types_among_frequent(spark, share, most):
    rng = random.Random(4)
    types = [f"type {rng.randrange(60)}" for _ in range(3000)] + [f"own {i % 40}" for i in range(60)] + [None] * 3 + [""] * 2 + ["hot"] * 1500
    df = spark.createDataFrame([(t,) for t in types], "log_type string").repartition(5)
    expected = sorted(map(tuple, analytics.rare_log_types(df, 10).collect()), key=str)
    assert len(expected) == 42
    assert sorted(map(tuple, analytics.rare_types_among_frequent(df, 10, share, most).collect()), key=str) == expected
    sure = analytics.surely_frequent(df, 10, share, most).collect()
    assert len(sure) <= most and (share < 0.5 or len(sure) >= min(most, 50))
    assert analytics.rare_types_among_frequent(df.limit(0), 10).count() == 0
    with pytest.raises(ValueError):
        analytics.rare_types_among_frequent(df, 0)


def test_proven_types_leave_before_the_count_and_captures_are_scanned_once(spark, log):
    df = extract(spark.createDataFrame([(line,) for line in LINES], "line string"), RULES, "line")
    plan = analytics.rare_types_among_frequent(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("BroadcastHashJoin") > plan.index("partial_count")  # plans are printed from the last step to the first
    assert "LeftAnti" not in plan
    # without types that repeat nothing is proven, and all are counted
    assert analytics.rare_types_among_frequent(df, 2).count() == analytics.rare_log_types(df, 2).count()


def test_results_as_arrow_streams_and_lists(spark):
    rows = spark.createDataFrame([("cpu", 4), ("x", None), (None, 5)], "u string, n int").repartition(2)
    query = LogQuery(RuleSet().var("a", r"(?<v>[a-z]+)")).select(["v", "n"]).from_(rows, text="u")
    streams = query.arrow_streams().collect()
    tables = [pa.ipc.open_stream(r["stream"]).read_all() for r in streams]
    assert [t.num_rows for t in tables] == [r["n_rows"] for r in streams]
    found = [tuple(r.values()) for r in pa.concat_tables(tables).to_pylist()]
    assert sorted(found, key=str) == sorted(map(tuple, query.get_rows()), key=str) and found
    assert sorted((r["row"] for r in query.row_lists().collect()), key=str) == sorted(
        ([v if v is None else str(v) for v in row] for row in query.get_rows()), key=str)


def test_samples_of_a_hot_log_type_are_limited_before_the_shuffle(log):
    plan = LogQuery(RULES).from_(log).get_log_type_with_sample(2)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan


def test_counts_are_added_up_before_the_shuffle(log):
    plan = LogQuery(RULES).from_(log).get_log_type_counts()._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "metric=<metric_name> value=<value>" in plan
