import random

import pytest
from pyspark.sql import functions as F

from logtables import RuleSet, assemble_events, extract
from logtables.sources.text import read_text_stream
from logtables.streaming.jobs import EventAssembly, Runs, new_log_types_to, run_available, stream_log_type_counts, upserted, upserts_to
from logtables.workspace import new_folder, shared_folder

RULES = RuleSet().timestamp("t", r"\d{4}-\d\d-\d\d").var("u", r"user=(?<u>\d+)")


def make_lines(n):
    rng = random.Random(n)
    return [
        (rng.choice("aab"), i, f"2024-01-01 user={i}" if rng.random() < 0.2 else f"  more user={i}") for i in range(n)
    ]


def test_assembly_over_many_batches(spark, tmp_path):
    rows, schema = make_lines(400), "source string, n long, value string"
    inbox = str(tmp_path / "in")
    expected = assemble_events(spark.createDataFrame(rows, schema), RULES, order="n", chunk=F.lit(0))
    wanted = {tuple(r) for r in expected.select("source", "n", "message").collect()}
    state, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")
    for start in range(0, 400, 80):  # a new run per batch of files, each going on from the last
        spark.createDataFrame(rows[start:start + 80], schema).coalesce(1).write.mode("append").parquet(inbox)
        lines = spark.readStream.schema(schema).parquet(inbox).withColumn("part", F.floor(F.col("n") / 30))
        job = EventAssembly(spark, RULES, state, order="n", chunk="part")
        job.start(lines, checkpoint).awaitTermination()
    got = [tuple(r) for r in job.events().select("source", "n", "message").collect()]
    assert len(got) == len(wanted) and set(got) == wanted
    closed = {tuple(r) for r in job.events(include_open=False).select("source", "n", "message").collect()}
    assert closed < wanted and len(wanted - closed) == 2  # one open event per source


def test_stream_equals_batch(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.log").write_text("\n".join(line for _, _, line in make_lines(50 + i)))
    stream = extract(read_text_stream(spark, str(tmp_path), max_files=1), RULES)
    batch = extract(spark.read.text(str(tmp_path)), RULES)
    rows = run_available(stream.select("value", "u", "log_type"), "rows")
    key = lambda r: r["value"]
    assert sorted(rows.collect(), key=key) == sorted(batch.select("value", "u", "log_type").collect(), key=key)
    counts = run_available(stream_log_type_counts(stream), "counts", complete=True)
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in batch.groupBy("log_type").count().collect()}
    new = run_available(stream.select("log_type"), "new", new_types=True)
    assert sorted(r[0] for r in new.collect()) == ["  more user=<u>", "<timestamp> user=<u>"]


def test_numbered_file_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = make_lines(60)
    (tmp_path / "in" / "a.log").write_text("\n".join(line for _, _, line in rows) + "\n")
    lines = read_text_stream(spark, str(tmp_path / "in"), numbered=True)
    job = EventAssembly(spark, RULES, str(tmp_path / "state"), order="line", chunk="block")
    job.start(lines, str(tmp_path / "checkpoint")).awaitTermination()
    text = "\n".join(r["message"] for r in job.events().orderBy("line").collect())
    assert text == "\n".join(line for _, _, line in rows)


class Session:
    """Stands for a session with given settings."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder or default)})


def test_folders(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(Session("spark://host", "s3a://bucket/tmp/"), "x").startswith("s3a://bucket/tmp/logtables/x-")
    assert shared_folder(Session("local[2]", None)) == shared_folder(Session("local[2]", None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        new_folder(Session("spark://host", None), "x")


def test_sources_end(spark, tmp_path):
    """A source ends with its last line, or when batches bring nothing of it; the state then forgets it."""
    schema = "source string, n long, value string"
    batches = [
        [("a", 1, "2024-01-01 a1"), ("b", 2, "2024-01-01 b1"), (None, 3, "2024-01-01 n1")],
        [("a", 4, "  more"), ("a", 5, "END"), ("b", 6, "  more")],
        [("c", 7, "2024-01-01 c1"), (None, 8, "  more")],
        [("a", 9, "late"), ("c", 10, "  more")],
        [("c", 11, "2024-01-01 c2")],
    ]
    inbox, state = str(tmp_path / "in"), str(tmp_path / "state")
    left = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        lines = spark.readStream.schema(schema).parquet(inbox).withColumn("part", F.floor(F.col("n") / 30))
        job = EventAssembly(spark, RULES, state, order="n", chunk="part", last_line=F.col("value") == "END", idle_batches=2)
        job.start(lines, str(tmp_path / "checkpoint")).awaitTermination()
        now = {(r["source"], r["n"]) for r in job.events().collect()} - {(r["source"], r["n"]) for r in job.events(include_open=False).collect()}
        left.append(now)
    assert left == [
        {("a", 1), ("b", 2), (None, 3)}, {("b", 2), (None, 3)}, {("b", 2), (None, 3), ("c", 7)}, {("a", 9), (None, 3), ("c", 7)}, {("a", 9), ("c", 11)},
    ]
    events = {(r["source"], r["message"]) for r in job.events().collect()}
    assert events == {
        ("a", "2024-01-01 a1\n  more\nEND"), ("b", "2024-01-01 b1\n  more"), (None, "2024-01-01 n1\n  more"), ("a", "late"),
        ("c", "2024-01-01 c1\n  more"), ("c", "2024-01-01 c2"),
    }


def test_files_in_splits(spark, tmp_path):
    """Large files in a stream: no file is one value, events cross splits, and the result is that of the batch reader."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    for i in range(3):
        (inbox / f"{i}.log").write_text("".join(line + "\n" for _, _, line in make_lines(200 + i)))
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    try:
        for key, value in zip(keys, ("300", "1")):
            spark.conf.set(key, value)
        lines = read_text_stream(spark, str(inbox), max_files=2, placed=True)
        job = EventAssembly.of_files(spark, RULES, str(tmp_path / "state"))
        job.start(lines, str(tmp_path / "checkpoint")).awaitTermination()
        found = job.events().select("source", "block", "message").collect()
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert len({r.block for r in found}) > 5
    expected = []
    for i in range(3):
        events = []
        for _, _, line in make_lines(200 + i):
            if line.startswith("2024") or not events:
                events.append(line)
            else:
                events[-1] += "\n" + line
        expected += [(f"{i}.log", e) for e in events]
    assert sorted((r.source.rsplit("/", 1)[1], r.message) for r in found) == sorted(expected)
    with pytest.raises(ValueError):
        read_text_stream(spark, str(inbox), numbered=True, placed=True)


@pytest.mark.parametrize("m", [1, 2, 7, 8, 100, 1023, 1024])
def test_runs_cover_all_batches_once(m):
    def covered(run):
        return list(range(run - (run & -run) + 1, run + 1))

    runs = Runs.until(m)
    assert sorted(b for r in runs for b in covered(r)) == list(range(1, m + 1)) and len(runs) <= 10
    taken = Runs.until(m - 1, m - (m & -m))
    assert sorted([m, *(b for r in taken for b in covered(r))]) == covered(m)


def test_state_in_runs_over_many_batches(spark, tmp_path):
    """Counts and new log types over eleven batches; a batch writes what it changes, and its run what it takes in."""
    inbox, schema = str(tmp_path / "in"), "log_type string, n long"
    rng, rows, news = random.Random(5), [], []
    for i in range(11):
        part = [(rng.choice(["hot", "hot", f"t{rng.randrange(4 * i + 1)}"]), j) for j in range(30)] + [(f"only {i}", 0)]
        news.append(sorted({t for t, _ in part} - {t for t, _ in rows}))
        rows += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    counts = stream_log_type_counts(stream)
    upserts_to(counts, str(tmp_path / "counts"), str(tmp_path / "c1")).awaitTermination()
    found = {r["log_type"]: r["count"] for r in upserted(spark, str(tmp_path / "counts"), counts.schema).collect()}
    assert found == {t: sum(u == t for u, _ in rows) for t, _ in rows}
    sizes = {m: spark.read.parquet(str(tmp_path / f"counts/run={m}")).count() for m in range(1, 12)}
    assert sizes[3] == len({t for t, _ in rows[62:93]}) and sizes[8] == len({t for t, _ in rows[:248]})
    new_log_types_to(stream, str(tmp_path / "new"), str(tmp_path / "c2")).awaitTermination()
    for i, types in enumerate(news):
        assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / f"new/batch={i}")).select("log_type").collect()) == types


def test_sources_end_by_time(spark, tmp_path):
    """A silent source ends by the time of other sources' lines; what comes late is an event of its own."""
    inbox, schema = str(tmp_path / "in"), "source string, n long, at string, value string"
    batches = [
        [("a", 1, "10:00", "2024-01-01 a1"), ("b", 2, "10:00", "2024-01-01 b1"), ("c", 3, None, "2024-01-01 c1")],
        [("b", 4, "10:04", "  b more"), ("a", 5, "10:01", "  a more")],
        [("b", 6, "10:12", "  b again")],            # a is 11 minutes old: over
        [("a", 7, "10:02", "  a late"), ("b", 8, "10:13", "  b last")],
        [("a", 9, "10:02", "  a later")],            # over again, by the clock of 10:13
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox).withColumn("part", F.lit(0).cast("long"))
    at = F.to_timestamp(F.concat(F.lit("2024-01-01 "), "at"))
    job = EventAssembly(spark, RULES, str(tmp_path / "state"), order="n", chunk="part", time=at, idle_time="10 minutes")
    job.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
    closed = sorted((r.source, r.message) for r in job.events(include_open=False).select("source", "message").collect())
    assert closed == [("a", "  a late"), ("a", "  a later"), ("a", "2024-01-01 a1\n  a more")]
    still = sorted(r.source for r in spark.read.parquet(str(tmp_path / "state/batch=4")).where("open = 1").collect())
    assert still == ["b", "c"]
    with pytest.raises(ValueError, match="belong together"):
        EventAssembly(spark, RULES, "x", order="n", chunk="part", idle_time="1 minute")
