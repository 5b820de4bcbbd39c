import random

import pytest
from pyspark.sql import functions as F

from logtables import PATTERN, LogParser, LogQuery, RuleSet, assemble_events, extract, line_events, split_events
from logtables.operators.events import even_chunks, first_event
from logtables.sources.text import from_strings, read_binary_logs, read_text_logs

STAMPED = RuleSet().timestamp("t", r"\d{4}-\d\d-\d\d").var("u", r"user=(?<u>\d+)")


def write_logs(folder, files, share):
    """Random log files; returns the expected events per file."""
    rng, expected = random.Random(files), {}
    for number in range(files):
        lines, events = [], []
        for i in range(300):
            if rng.random() < share:
                lines.append(f"2024-01-{i % 30 + 1:02d} user={i} start")
                events.append([lines[-1]])
            else:
                lines.append("  more " + "é" * rng.randint(0, 30) + f" user={i}")
                events[-1].append(lines[-1]) if events else events.append([lines[-1]])
        (folder / f"f{number}.log").write_text("\n".join(lines) + "\n")
        expected[number] = ["\n".join(event) for event in events]
    return expected


@pytest.mark.parametrize("split_size", ["128m", "700b", "90b"])
@pytest.mark.parametrize("share", [0.3, 0.02])
def test_files_in_any_splits(spark, tmp_path, split_size, share):
    expected = write_logs(tmp_path, 3, share)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        rows = LogParser(rules=STAMPED).events(str(tmp_path)).orderBy("source", "block", "line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for row in rows:
        got.setdefault(int(row["source"][-5]), []).append(row["message"])
    assert got == expected


def test_table_with_one_hot_source(spark):
    """Most rows are of one source; some sources and some texts are NULL; chunks cut through events."""
    rng, rows = random.Random(5), []
    for i in range(3_000):
        source = "hot" if rng.random() < 0.8 else rng.choice(["a", "b", None])
        text = f"2024-01-01 user={i}" if rng.random() < 0.1 else rng.choice([f"  more {i}", ""])
        rows.append((source, i, text))
    expected = {}
    for source, i, text in rows:
        events = expected.setdefault(source, [])
        if text.startswith("2024") or not events:
            events.append((i, [text]))
        else:
            events[-1][1].append(text)
    rng.shuffle(rows)
    lines = spark.createDataFrame(rows, "source string, n long, value string")
    for size in (7, 400, 10**6):
        got = assemble_events(lines, STAMPED, order="n", chunk=even_chunks(lines, "n", size), mark_last="last")
        found, last = {}, {}
        for row in got.orderBy("n").collect():
            found.setdefault(row["source"], []).append((row["n"], row["message"].split("\n")))
            if row["last"]:
                last.setdefault(row["source"], []).append(row["n"])
        assert found == expected
        assert last == {source: [events[-1][0]] for source, events in expected.items()}


def test_text_is_shuffled_by_chunk_not_by_source(spark, tmp_path):
    write_logs(tmp_path, 1, 0.2)
    plan = LogParser(rules=STAMPED).events(str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line and "__chunk" not in line:
            assert "__source" in line  # only the small table of chunks goes by source
    windows = [line for line in plan.splitlines() if "Window [sum(__start" in line]
    assert windows and all("__chunk" in line for line in windows)


STACK = """\
16/05/04 12:22:37 WARN server.TransportChannelHandler: Exception in connection from spark-35/192.168.10.50:55392
java.io.IOException: Connection reset by peer
        at sun.nio.ch.FileDispatcherImpl.read0(Native Method)
        at sun.nio.ch.SocketDispatcher.read(SocketDispatcher.java:39)
        at io.netty.channel.nio.AbstractNioByteChannel$NioByteUnsafe.read(AbstractNioByteChannel.java:119)
        at io.netty.util.concurrent.SingleThreadEventExecutor$2.run(SingleThreadEventExecutor.java:111)
        at java.lang.Thread.run(Thread.java:750)
"""
STACK_RULES = (
    RuleSet()
    .timestamp("spark_time", r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}")
    .var("level", "(?<level>INFO|WARN|ERROR)")
    .var("peer", rf"(?<host>spark\-{PATTERN.INT})/(?<ip>{PATTERN.IPV4}):(?<port>{PATTERN.PORT})")
    .var("exception", rf"(?<kind>({PATTERN.JAVA_PACKAGE_SEGMENT})+[{PATTERN.JAVA_IDENTIFIER_CHARSET}]*Exception): "
                      rf"(?<msg>{PATTERN.LOG_LINE})")
    .var("frame", rf"\s{{1,4}}at (?<stack>{PATTERN.JAVA_STACK_LOCATION})")
)


def test_stack_trace(spark, tmp_path):
    more = "16/05/04 12:22:38 INFO spark-36/10.0.0.1:80 done\n"
    (tmp_path / "app.log").write_text(STACK + more)
    first, second = LogParser(rules=STACK_RULES).parse(str(tmp_path)).orderBy("line").collect()
    assert first["message"] == STACK[:-1] and second["message"] == more[:-1]
    assert first["timestamps"] == ["16/05/04 12:22:37"] and first["level"] == ["WARN"]
    assert (first["host"], first["ip"], first["port"]) == (["spark-35"], ["192.168.10.50"], ["55392"])
    assert first["kind"] == ["java.io.IOException"] and first["msg"] == ["Connection reset by peer"]
    assert len(first["stack"]) == 5 and first["stack"][0] == "sun.nio.ch.FileDispatcherImpl.read0(Native Method)"
    assert first["log_type"].splitlines()[:3] == [
        "<timestamp> <level> server.TransportChannelHandler: Exception in connection from <host>/<ip>:<port>",
        "<kind>: <msg>", "        at <stack>",
    ]
    assert second["log_type"] == "<timestamp> <level> <host>/<ip>:<port> done"


def test_texts_of_several_events(spark):
    texts = ["a\n2024-01-01 x\n y\n\n2024-01-02\n", "2024-01-01", "", "\n", "2024-01-01 a\r\n b\r\n2024-01-02 c\r\n", None]
    rows = split_events(from_strings(spark, [t for t in texts if t is not None]), STAMPED, number="no").collect()
    got = {}
    for row in rows:
        got.setdefault(row["line"], []).append(row["value"])
    assert got == {
        0: ["a", "2024-01-01 x\n y\n", "2024-01-02"], 1: ["2024-01-01"], 2: [""], 3: [""],
        4: ["2024-01-01 a\n b", "2024-01-02 c"],
    }
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    firsts = [r[0] for r in frame.select(first_event(F.col("t"), STAMPED)).collect()]
    assert firsts == ["a", "2024-01-01", "", "", "2024-01-01 a\n b", None]
    plain = RuleSet().var("u", r"u(?<u>\d)")
    firsts = [r[0] for r in frame.select(first_event(F.col("t"), plain)).collect()]
    assert firsts == ["a", "2024-01-01", "", "", "2024-01-01 a", None]


def test_line_events(spark):
    rows = line_events(from_strings(spark, ["a\nb\n", "c", ""])).collect()
    assert [(r["line"], r["value"]) for r in rows] == [(0, "a"), (0, "b"), (1, "c"), (2, "")]


def test_sources(spark, tmp_path):
    (tmp_path / "dt=1").mkdir()
    (tmp_path / "dt=1" / "a.log").write_bytes("user=1 é\r\nuser=2\n".encode())
    (tmp_path / "dt=2").mkdir()
    (tmp_path / "dt=2" / "b.log").write_bytes(b"user=3 \xff\n")
    rules = RuleSet().var("u", r"user=(?<u>\d+)")
    rows = read_text_logs(spark, str(tmp_path), "dt = 1").orderBy("block", "line").collect()
    assert [r["value"] for r in rows] == ["user=1 é", "user=2"] and rows[0]["dt"] == 1
    lenient = extract(read_binary_logs(spark, str(tmp_path), strict=False), rules)
    assert sorted(r["u"][0] for r in lenient.where("value is not null").collect()) == ["1", "2"]
    with pytest.raises(Exception, match="INVALID_UTF8"):
        read_binary_logs(spark, str(tmp_path)).collect()
    assert [r["value"] for r in from_strings(spark, [b"\xc3\xa9", "x"]).collect()] == ["é", "x"]
    for wrong in (5, [1], None):
        with pytest.raises(TypeError):
            LogQuery(rules).from_(wrong)
    with pytest.raises(TypeError):
        from_strings(spark, [5])


@pytest.mark.parametrize("case", ["outlier", "equal", "nulls", "text"])
def test_even_chunks_hold_their_bound(spark, case):
    n, size = 20_000, 1_000
    first = {
        "outlier": F.when(F.col("id") == 0, 0).otherwise(F.col("id") + 10**15), "equal": F.when(F.col("id") % 10 > 0, 5).otherwise(F.col("id")),
        "nulls": F.when(F.col("id") % 3 == 0, F.col("id")), "text": F.col("id").cast("string"),
    }[case]
    lines = spark.range(n).select(first.alias("at"), "id", F.lit("x").alias("value"))
    counts = lines.groupBy(even_chunks(lines, ["at", "id"], size).alias("c")).count().collect()
    assert max(r["count"] for r in counts) <= 2 * size and sum(r["count"] for r in counts) == n
    rising = lines.withColumn("c", even_chunks(lines, ["at", "id"], size)).orderBy("at", "id").collect()
    assert [r["c"] for r in rising] == sorted(r["c"] for r in rising)


def test_order_must_tell_lines_apart(spark):
    lines = spark.createDataFrame([("a", 1, "user=1"), ("a", 1, "user=2"), ("b", 1, "user=3")], "source string, n long, value string")
    with pytest.raises(Exception, match="name a column more in order"):
        assemble_events(lines, STAMPED, order="n").collect()
