import json

import pytest
from pyspark.sql import functions as F

from logtables import ConflictStrategy, JsonLogParser, LogQuery, RuleSet, enrich_columns, enrich_json
from logtables.operators.jsonlogs import all_strings
from logtables.sources.json import read_json_logs
from logtables.sources.text import from_strings

USER = RuleSet().var("user_info", r"user=(?<user_id>\d+)")
MULTI = USER.var("level", r"(?<level>INFO|WARN|ERROR)").var("status", r"status=(?<status>\w+)")


def texts(spark, *values):
    return from_strings(spark, list(values))


def one(spark, parser, text):
    row = parser.parse_one(texts(spark, text)).select(F.to_json("object"), "conflicts").first()
    return json.loads(row[0]), row[1]


def on(*fields, rules=USER):
    return JsonLogParser(rules).target_fields(list(fields))


@pytest.mark.parametrize("parser, text, extracted", [
    (on("message"), {"ts": "2024", "message": "Processing user=123 request"}, {"user_id": "123"}),
    (on("message", "context", rules=MULTI), {"message": "INFO user=123", "context": "status=ok"},
     {"user_id": "123", "level": "INFO", "status": "ok"}),
    (on("message"), {"message": "no variables here", "other": "data"}, {}),
    (on("context.message"), {"ts": "x", "context": {"message": "user=456 logged in"}}, {"user_id": "456"}),
    (on("a.b.c.message"), {"a": {"b": {"c": {"message": "user=789"}}}}, {"user_id": "789"}),
    (on("missing.path"), {"message": "user=123"}, {}),
    (on("message.deeper"), {"message": "user=123"}, {}),
    (on("count", "message"), {"count": 42, "message": "user=123"}, {"user_id": "123"}),
    (JsonLogParser(USER), {"field1": "user=1", "field2": "user=2", "number": 42}, {"user_id": ["1", "2"]}),
    (on("*"), {"outer": {"inner": "user=1"}, "message": "user=2"}, {"user_id": ["1", "2"]}),
    (JsonLogParser(USER).target_fields("*"), {"m": ["user=1", {"x": ["user=2"]}, None, 5]}, {"user_id": ["1", "2"]}),
    (JsonLogParser(USER).target_fields("message"), {"message": "user=1", "other": "user=2"}, {"user_id": "1"}),
    (on("message"), {"message": "user=1 then user=2"}, {"user_id": ["1", "2"]}),
    (on("msg1", "msg2"), {"msg2": "user=2", "msg1": "user=1"}, {"user_id": ["1", "2"]}),
    (on("m"), {"m": "user=1\nuser=2"}, {"user_id": "1"}),
    (on("m", rules=MULTI.timestamp("t", r"\d{4}")), {"m": "2024 INFO\n user=2\n2025 WARN"},
     {"level": "INFO", "user_id": "2"}),
    (on("*"), {'user=7"': 'a "user=1" \\ é', "k": "\tuser=2 \u2028"}, {"user_id": "2"}),
])
def test_mining(spark, parser, text, extracted):
    result, conflicts = one(spark, parser, json.dumps(text, ensure_ascii=False))
    assert result == {**text, "extracted": extracted} and conflicts == []


def test_all_strings_in_document_order(spark):
    documents = [
        {"z": "a", "b": {"y": ['q"uo\\te', "", {"k": "\n\u20ac😀"}], "n": 1}, "a": None, "c:": ": x", "e": [[["deep"]]]},
        {}, {"k": "\\" * 2001, "long": "x\n" * 30_000}, {"colon\":": "v\":"},
    ]

    def walk(value):
        if isinstance(value, dict):
            return [s for v in value.values() for s in walk(v)]
        if isinstance(value, list):
            return [s for v in value for s in walk(v)]
        return [value] if isinstance(value, str) else []

    for ascii_only in (True, False):
        for indent in (None, 2):
            lines = [json.dumps(d, ensure_ascii=ascii_only, indent=indent) for d in documents]
            rows = texts(spark, *lines).orderBy("line").select(all_strings(F.col("value"))).collect()
            assert [r[0] for r in rows] == [walk(d) for d in documents]


@pytest.mark.parametrize("strategy, options, text, result, conflicts", [
    ("nest", {"key": "vars"}, {"message": "user=1"}, {"message": "user=1", "vars": {"user_id": "1"}}, []),
    ("nest", {}, {"message": "user=1", "extracted": {"x": [1]}},
     {"message": "user=1", "extracted": {"user_id": "1", "original_value": {"x": [1]}}}, []),
    ("overwrite", {}, {"message": "user=1", "user_id": 5}, {"message": "user=1", "user_id": "1"}, ["user_id"]),
    ("overwrite", {}, {"message": "x", "user_id": 5}, {"message": "x", "user_id": 5}, []),
    ("overwrite", {}, {"message": "user=1", "user_id": None}, {"message": "user=1", "user_id": "1"}, ["user_id"]),
    ("prefix", {"prefix": "p_"}, {"message": "user=1"}, {"message": "user=1", "p_user_id": "1"}, []),
    ("prefix", {}, {"message": "user=1"}, {"message": "user=1", "extracted.user_id": "1"}, []),
    ("prefix", {"prefix": "p_"}, {"message": "user=1", "p_user_id": "old"},
     {"message": "user=1", "p_user_id": "1"}, ["p_user_id"]),
    ("raise", {}, {"message": "user=1"}, {"message": "user=1", "user_id": "1"}, []),
    ("raise", {}, {"message": "x", "user_id": "old"}, {"message": "x", "user_id": "old"}, []),
])
def test_conflicts(spark, strategy, options, text, result, conflicts):
    parser = on("message").on_conflict(strategy, **options)
    assert one(spark, parser, json.dumps(text)) == (result, conflicts)


def test_raise_and_original_value(spark):
    with pytest.raises(Exception, match="user_id"):
        one(spark, on("message").on_conflict("raise"), '{"message": "user=1", "user_id": "old"}')
    rules = RuleSet().var("val", r"val=(?<original_value>\d+)")
    result, conflicts = one(spark, on("message", rules=rules), '{"message": "val=9", "extracted": "kept"}')
    assert result["extracted"] == {"original_value": "kept"} and conflicts == ["original_value"]
    with pytest.raises(ValueError, match="fields cannot be empty"):
        JsonLogParser(USER).target_fields([])
    assert one(spark, on("m").on_conflict(ConflictStrategy.OVERWRITE), '{"m": "user=1"}')[0]["user_id"] == "1"
    with pytest.raises(ValueError, match="conflict"):
        one(spark, on("message").on_conflict("other"), "{}")


def test_log_type(spark):
    result, _ = one(spark, on("message").include_log_type().on_conflict("nest", key="v"), '{"message": "user=1 in"}')
    assert result["v"] == {"user_id": "1", "@log_type": "user=<user_id> in"}
    result, _ = one(spark, JsonLogParser(MULTI).include_log_type(), '{"a": "ERROR", "b": "nothing"}')
    assert result["extracted"]["@log_type"] == ["<level>", "nothing"]


def test_layouts(spark, tmp_path):
    lines = '{"m": "user=1"}\n\n  42\n{"m": "user=2"}\n'
    array = '\n [{"m":\n "user=3"},\n "{\\"m\\": 1}", [1], {"m": "user=4"}\n]'
    found = on("m").parse(texts(spark, lines, array, "", " \n "))
    ids = found.select(F.expr("try_variant_get(object['extracted'], '$.user_id', 'string')"))
    assert sorted(r[0] for r in ids.collect()) == ["1", "2", "3", "4"]
    (tmp_path / "a.json").write_text(lines)
    (tmp_path / "b.json").write_text(array)
    (tmp_path / "empty.json").write_text("")
    read = read_json_logs(spark, str(tmp_path), "auto")
    assert sorted(json.loads(r["value"])["m"] for r in read.collect()) == ["user=1", "user=2", "user=3", "user=4"]
    only_lines = read_json_logs(spark, str(tmp_path / "a.json"), "auto")
    assert only_lines.count() == 2
    assert read_json_logs(spark, str(tmp_path / "b.json"), "array").count() == 2


def test_invalid_json(spark):
    for bad in ("not valid json", '{"a": ', "nope"):
        with pytest.raises(Exception, match="MALFORMED|JSON"):
            on("m").parse(texts(spark, bad)).collect()
    rows = on("m").parse(texts(spark, "oops", '{"m": "user=1"}', '{"m": '), strict=False).collect()
    assert sorted((r["_corrupt_record"] or "") for r in rows) == ["", "oops", '{"m": ']
    assert sum(r["object"] is not None for r in rows) == 1


def test_key_given_twice(spark):
    result, _ = one(spark, on("a"), '{"a": "user=1", "b": 1, "a": "user=2"}')
    assert result == {"b": 1, "a": "user=2", "extracted": {"user_id": "2"}}


def test_binary_and_observation(spark):
    from pyspark.sql import Observation

    frame = texts(spark, '{"message": "user=1", "user_id": "x"}').withColumn("value", F.col("value").cast("binary"))
    assert on("message").parse(frame).count() == 1
    seen = Observation("merge")
    rows = texts(spark, '{"message": "user=1", "user_id": "x"}', '{"message": "user=2"}')
    enrich_json(rows, USER, on_conflict="overwrite", observe=seen).collect()
    assert seen.get == {"conflicts": 1}


def test_typed_columns(spark):
    frame = spark.createDataFrame(
        [(1, ("user=1", ["user=2", None]), {"user=8": "user=3"}, [("user=4",)], "old")],
        "n int, s struct<a:string,b:array<string>>, m map<string,string>, l array<struct<t:string>>, extracted string",
    )
    row = enrich_columns(frame, USER, log_type=True).first()["extracted"]
    assert row["user_id"] == ["1", "2", "3", "4"] and row["original_value"] == "old"
    assert enrich_columns(frame, USER, ["s.a", "n"], key="v").first()["v"]["user_id"] == ["1"]


def test_query(spark):
    log = texts(spark, '{"message": "user=123", "service": "api", "level": "INFO"}\n'
                       '{"message": "user=456 user=7", "service": "web", "level": "ERROR"}')
    query = LogQuery(on("message")).select(["service", "extracted.user_id", "line", "none.at.all"]).from_(log)
    assert query.validate_query() is query
    assert query.get_rows() == [["api", "123", 0, None], ["web", '["456","7"]', 0, None]]
    assert query.filter(LogQuery.field("level") == "ERROR").get_rows() == [["web", '["456","7"]', 0, None]]
    for strategy in ({}, {"on_conflict": "prefix"}, {"on_conflict": "overwrite"}):
        parser = on("message", "level").include_log_type()
        if strategy:
            parser.on_conflict(strategy["on_conflict"])
        made = LogQuery(parser).from_(log)
        counts = {r["log_type"]: r["count"] for r in made.get_log_type_counts().collect()}
        assert counts == {"user=<user_id>": 1, "user=<user_id> user=<user_id>": 1, "INFO": 1, "ERROR": 1}
    samples = LogQuery(on("message").include_log_type()).from_(log).get_log_type_with_sample(1).collect()
    assert all(json.loads(r["samples"][0])["message"] for r in samples)
