from pyspark.sql import functions as F

from queries.streams import PARTS, stream_of


def test_batches_are_several_files_in_the_order_of_the_key(spark, tmp_path):
    # seven files, each with ids of one range or of all; ids are uneven, some are missing
    ids = spark.range(0, 900, 1, 6).selectExpr("if(id > 800, id * 3, id) as event_id").union(spark.range(0, 2500, 7, 1).toDF("event_id"))
    table = ids.union(spark.sql("select cast(null as bigint) as event_id from range(3)"))
    table.write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # a partition for each file at least
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    batches = []

    def note(rows, _):
        found = rows.select("event_id", F.input_file_name().alias("file")).collect()
        batches.append((sorted(r.event_id for r in found if r.event_id is not None), sum(r.event_id is None for r in found), len({r.file for r in found})))

    try:
        stream = stream_of(spark, str(tmp_path), "events")
        query = stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert len(batches) == PARTS
    assert [b[1] for b in batches] == [0, 0, 0, 3]
    assert batches[0][2] > 1
    ranges = [b[0] for b in batches]
    assert all(a[-1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert sorted(i for b in ranges for i in b) == sorted(r.event_id for r in table.collect() if r.event_id is not None)


def test_parts_of_one_large_file_are_dealt_over_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("queries.streams.FILE_ROWS", 10)
    spark.range(0, 400, 1, 1).toDF("event_id").write.parquet(f"{tmp_path}/events.parquet")
    batches = []

    def note(rows, _):
        batches.append([r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()])

    stream = stream_of(spark, str(tmp_path), "events")
    stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    assert len(batches) == PARTS and sum(map(sum, batches)) == 400
    assert all(len(b) == 10 and max(b) <= 15 for b in batches)
