"""Files of one JSON array each, read in splits of a few bytes, against json.loads."""

import json
import random

import pytest

from logtables.sources.json import json_layouts, read_json_logs


@pytest.fixture
def splits(spark):
    """Splits of so few bytes that most objects cross some."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]

    def set_to(size):
        for key, value in zip(keys, (size, 1, 64)):
            spark.conf.set(key, str(value))

    yield set_to
    for key in keys:
        spark.conf.unset(key)


def value(rng, depth=0):
    kind = rng.random()
    if depth < 3 and kind < 0.3:
        return {rng.choice(['a', 'b{', '}', '"q"', "\\"]) + str(i): value(rng, depth + 1) for i in range(rng.randint(0, 4))}
    if depth < 3 and kind < 0.45:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([1, -2.5, None, True, "", "{", "}}", "[]", "a\"b", "\\", "\\\\\"}", "\n", "é😀", "x" * rng.randint(0, 300), 'he said "{"', ", {"])


def objects(frame):
    return sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in frame.select("value").collect())


def expected(arrays):
    return sorted(json.dumps(x, sort_keys=True) for array in arrays for x in array if isinstance(x, dict))


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_equals_json_loads(spark, splits, tmp_path, size):
    rng = random.Random(size)
    arrays = [[value(rng) for _ in range(n)] for n in (0, 1, 2, 30, 60)]
    arrays += [[{"big": ["y" * 2000, {"z": "}" * 50}]}] * 3, [1, "x", None], [[{"a": 1}], {"b": 2}, [[{}]], {}]]
    for i, array in enumerate(arrays):
        text = json.dumps(array, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{i}.json").write_text(rng.choice(["", " \n"]) + text + rng.choice(["", "\n", " \n "]), "utf-8")
    (tmp_path / "blank.json").write_text(" \n ")
    (tmp_path / "bom.json").write_bytes(b"\xef\xbb\xbf[{\"a\": 7}]")
    splits(size)
    frame = read_json_logs(spark, str(tmp_path), "array")
    assert objects(frame) == expected([*arrays, [{"a": 7}]])
    assert frame.columns == read_json_logs(spark, str(tmp_path), "lines").columns


@pytest.mark.parametrize("text", [
    '[{"a": 1}', '[{"a": 1},]', '[{"a": 1} {"b": 2}]', '{"a": 1}', '[{"a": 1}]]', '[{"a": 1}] x', '[{"a": "}]', '[{"a": 1}, {"b" 2}]', "[1 2]",
])
def test_what_is_no_array_stops_the_job(spark, splits, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    for size in (5, 1000):
        splits(size)
        with pytest.raises(Exception):
            read_json_logs(spark, str(tmp_path), "array").collect()


def test_a_large_array_of_one_line_is_read_by_many_tasks(spark, splits, tmp_path):
    array = [{"id": i, "text": f'line {i} "}}"'} for i in range(20_000)]
    (tmp_path / "a.json").write_text(json.dumps(array))
    splits(50_000)
    frame = read_json_logs(spark, str(tmp_path), "array")
    assert frame.select("block").distinct().count() > 15
    assert objects(frame) == expected([array])


def test_auto_layout_keeps_names_in_tables(spark, splits, tmp_path):
    rng = random.Random(2)
    arrays = [[value(rng) for _ in range(20)] for _ in range(3)]
    lines = [{"n": i, "s": "}["} for i in range(30)]
    for i, array in enumerate(arrays):
        (tmp_path / f"{i}.json").write_text(json.dumps(array))
    (tmp_path / "lines.json").write_text("\n" + "".join(json.dumps(x) + "\n" for x in lines))
    splits(500)
    frame = read_json_logs(spark, str(tmp_path), "auto")
    assert objects(frame) == expected([*arrays, lines])
    assert "[file:" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert {r.layout for r in json_layouts(spark, str(tmp_path)).collect()} == {"array", "lines"}


@pytest.mark.parametrize("name", ["s06_json_array_files", "s07_detect_layout_of_files"])
def test_array_files_do_not_grow_with_the_rows(spark, tmp_path, monkeypatch, name):
    import queries.jsonlogs as logs
    from queries import QUERIES

    rows = spark.range(0, 150 * 500, 500, 2).toDF("event_id").selectExpr(
        "event_id", "timestamp'2024-01-01 00:00:00' as ts", "event_id % 7 as user_id", "'click' as event_type", "0.5D as value")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(logs, "new_folder", lambda spark, name: f"{tmp_path}/{name}")
    found = QUERIES[name](spark, str(tmp_path))
    ids = sorted(int(r.id) for r in found.where("action = 'click'").collect())
    assert ids == [500 * i for i in range(150)]
    assert 0 < len(list(tmp_path.glob("json-*/part=*"))) <= 64 + 1
