"""Streaming ingest: restart from the checkpoint, no loss, no duplicates, rejects kept aside."""
from pyspark.sql import functions as F

from abflow.streaming.ingest import read_ingested, read_text_stream, start_ingest


def test_restart_no_loss_no_duplicates(spark, tmp_path):
    src, out, ck, rej = (str(tmp_path / x) for x in ("in", "events", "ck", "rej"))
    msgs = [f'{{"eventId":"{i}","user":{{"userId":"u{i}"}},"curr_time":"20240101{i % 3:02d}"}}' for i in range(40)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(msgs[:20] + ["{bad", "[1]"]) + "\n")

    def run():
        q = start_ingest(read_text_stream(spark, src), out, ck, trigger={"availableNow": True}, rejects_path=rej)
        q.awaitTermination()

    run()
    (tmp_path / "in" / "b.json").write_text("\n".join(msgs[20:]) + "\n")
    run()
    run()   # nothing new: no batch, nothing written twice
    ev = read_ingested(spark, out)
    ids = sorted(int(r.eventId) for r in ev.select("eventId").collect())
    assert ids == list(range(40))
    assert ev.filter(F.col("userId").startswith("u")).count() == 40
    assert sorted(ev.select("curr_time").distinct().toPandas().curr_time) == ["2024010100", "2024010101", "2024010102"]
    assert spark.read.parquet(rej).count() == 2
    assert len(ev.columns) == 47   # 45 event columns, query_id, batch_id


def test_ledger_written_per_batch(spark, tmp_path):
    """A source carrying (topic, partition, offset) also gets its offset ledger written per batch."""
    from abflow.streaming.ingest import ARRIVAL, stored_offsets, write_batch
    df = spark.createDataFrame([('{"eventId":"1"}', "t", 0, 4, "2024010100"), ('{"eventId":"2"}', "t", 1, 9, "2024010100")],
                               f"value string, topic string, partition int, offset long, {ARRIVAL} string")
    for _ in range(2):   # replayed batch
        write_batch(df, 3, str(tmp_path / "ev"), None, "q1", ledger_path=str(tmp_path / "led"))
    write_batch(df.withColumn("offset", F.col("offset") + 5), 4, str(tmp_path / "ev"), None, "q1", ledger_path=str(tmp_path / "led"))
    led = sorted((r.topic, r.ledger, r.batch_id) for r in spark.read.parquet(str(tmp_path / "led")).collect())
    assert led == [("t", "0|10,1|15", 4), ("t", "0|5,1|10", 3)]
    assert spark.read.parquet(str(tmp_path / "ev")).count() == 4
    assert stored_offsets(spark, str(tmp_path / "led")) == '{"t": {"0": 10, "1": 15}}'
    assert stored_offsets(spark, str(tmp_path / "none")) is None


def test_new_checkpoint_and_hour(spark, tmp_path):
    """Messages without curr_time: the hour comes from the plan; a new checkpoint adds, not overwrites."""
    src, out = str(tmp_path / "in"), str(tmp_path / "events")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"eventId":"1"}\n')
    for ck in ("ck1", "ck2"):
        q = start_ingest(read_text_stream(spark, src, 1), out, str(tmp_path / ck), trigger={"availableNow": True})
        q.awaitTermination()
    ev = read_ingested(spark, out).collect()
    assert [r.eventId for r in ev] == ["1", "1"] and len({r.query_id for r in ev}) == 2
    assert all(len(r.curr_time) == 10 and r.curr_time.isdigit() for r in ev)
    # the batch's offset log holds the time that the hour is taken from
    log = (tmp_path / "ck1" / "offsets" / "0").read_text()
    assert "batchTimestampMs" in log


def test_replay_across_an_hour(spark, tmp_path):
    """The same batch again, an hour later: its rows carry their hour, so one copy stays."""
    from abflow.streaming.ingest import ARRIVAL, write_batch
    df = spark.createDataFrame([('{"eventId":"1"}', "2024010123")], f"value string, {ARRIVAL} string")
    for _ in range(2):
        write_batch(df, 0, str(tmp_path / "ev"), None, "q")
    write_batch(df.limit(0), 1, str(tmp_path / "ev"), None, "q")   # an empty batch writes nothing
    assert [(r.eventId, str(r.curr_time)) for r in spark.read.parquet(str(tmp_path / "ev")).collect()] == [("1", "2024010123")]


def test_messages_delivered_twice(spark, tmp_path):
    """Repeats within a batch, over batches and over a restart; rows without an offset all stay."""
    src, out, ck, rng = (str(tmp_path / x) for x in ("in", "ev", "ck", "rng"))
    schema = "value string, topic string, partition int, offset long"
    msg = lambda i: f'{{"eventId":"{i}","userId":"u{i % 3}","sceneId":"s","optType":"1"}}'
    drops = [[0, 1, 2, 2], [2, 3, 0], [4, 1]]
    for k, drop in enumerate(drops):
        rows = [(msg(i), "t", 0, i) for i in drop] + ([(msg(90 + k), None, None, None), (msg(80), "t", 0, None)] if k < 2 else [])
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        start_ingest(spark.readStream.schema(schema).parquet(src), out, ck, trigger={"availableNow": True}, dedup_within="2 hours",
                     ranges_path=rng, partials_path=str(tmp_path / "part")).awaitTermination()
    ids = sorted(int(r.eventId) for r in read_ingested(spark, out).select("eventId").collect())
    assert ids == [0, 1, 2, 3, 4, 80, 90, 91]
    from abflow.operators.keyed import offset_audit
    assert offset_audit(spark.read.parquet(rng).filter("topic is not null")).collect() == []
    from abflow.operators.partials import funnel, read_partials
    (row,) = funnel(read_partials(spark, str(tmp_path / "part")), "s", ("scene_id",)).collect()
    assert (row.exposures, row.users) == (8, 3)


def test_options_given_to_the_kafka_reader(monkeypatch):
    """The connector isn't here; what is asked of it is."""
    from abflow.streaming.ingest import read_event_stream
    said = {}

    class Reader:
        def format(self, f):
            said["format"] = f
            return self

        def option(self, k, v):
            said[k] = v
            return self

        def load(self):
            return self

        def select(self, *cols):
            said["columns"] = cols[1:]
            return self

    class Session:
        readStream = Reader()

    monkeypatch.setattr(F, "col", lambda c: type("C", (), {"cast": lambda s, t: s, "alias": lambda s, a: a})())
    read_event_stream(Session(), ["a", "b"], "h1:9092,h2:9092", '{"a":{"0":5}}', maxOffsetsPerTrigger=100, minPartitions="8")
    assert said == {"format": "kafka", "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "a,b", "startingOffsets": '{"a":{"0":5}}',
                    "maxOffsetsPerTrigger": 100, "minPartitions": "8", "columns": ("topic", "partition", "offset")}


def test_one_hour_is_written_by_more_than_one_task(spark, tmp_path):
    """A batch of some MB in one hour is dealt over tasks; a small one has one writer."""
    import os

    from abflow.streaming.ingest import ARRIVAL, write_batch
    text = F.to_json(F.struct(F.col("id").cast("string").alias("eventId"), F.sha2(F.col("id").cast("string"), 512).alias("name")))
    rows = spark.range(60000).select(text.alias("value"), F.lit("2024010100").alias(ARRIVAL))
    for n, d in ((60000, "big"), (50, "small")):
        write_batch(rows.limit(n).repartition(3), 0, str(tmp_path / d), None, "q")
        assert read_ingested(spark, str(tmp_path / d)).select("eventId").distinct().count() == n
    files = lambda d: [f for _, _, fs in os.walk(tmp_path / d) for f in fs if f.startswith("part-")]
    assert len(files("big")) > 1 and len(files("small")) == 1


def test_methods_of_an_event_row_are_short(spark, tmp_path, monkeypatch):
    """Code for 45 columns is run in pieces that the JVM compiles; the session's own limit comes back."""
    from abflow.streaming import ingest as I
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before, deal = spark.conf.get(name), I.dealt
    monkeypatch.setattr(I, "dealt", lambda df: seen.append(df.sparkSession.conf.get(name)) or deal(df))
    df = spark.createDataFrame([('{"eventId":"1"}', "2024010100")], f"value string, {I.ARRIVAL} string")
    I.write_batch(df, 0, str(tmp_path / "ev"), None, "q")
    assert seen == ["8000"] and spark.conf.get(name) == before


def test_rows_spread_by_their_bytes(spark):
    """A source of one split goes to as many tasks as it has work for, not to a fixed number."""
    from abflow.session import spread
    df = spread(spark.range(0, 4000000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")))
    assert "REBALANCE_PARTITIONS_BY_NONE" in df._jdf.queryExecution().executedPlan().toString()
