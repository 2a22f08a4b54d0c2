"""Streaming: restarts, repeated batches, late rows, sessions, carried state, sinks."""

import datetime as dt
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import sets
from millrace.sinks import clients, files, tables
from millrace.sinks.upsert import UpsertLog
from millrace.sources import text as text_source
from millrace.streaming import batches, joins, models, state, windows
from millrace.plans.replay import day_bounds, day_slices, drain, replay, replay_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY = dt.datetime(2024, 1, 1)


def at(spark, *rows, schema="ts timestamp_ntz, k string, v long"):
    """Rows whose first field is given in hours since the first day."""
    moved = [(DAY + dt.timedelta(hours=r[0]), *r[1:]) for r in rows]
    return spark.createDataFrame(moved, schema)


def read(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_day_slices_cover_every_row_once(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    slices = day_slices(events, "ts", 4)
    assert len(day_bounds(events, "ts", 4)) == 5
    assert sum(s.count() for s in slices) == events.count()
    assert all(s.count() > 0 for s in slices)
    timeless = events.limit(3).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert sum(s.count() for s in day_slices(events.unionByName(timeless), "ts", 4)) == events.count() + 3
    assert [s.count() for s in day_slices(timeless, "ts", 3)] == [3, 0, 0]
    assert [s.count() for s in day_slices(events.limit(0), "ts", 3)] == [0, 0, 0]


def test_restart_reads_only_new_files(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for rows in (range(3), range(3, 5)):
        spark.createDataFrame([(i,) for i in rows], "v long").write.mode("append").parquet(landing)
        stream = text_source.stream_files(spark, landing, "parquet", spark.read.parquet(landing).schema)
        drain(stream.writeStream.format("parquet").option("path", out), checkpoint)
        assert spark.read.parquet(out).count() == max(rows) + 1
    drain(stream.writeStream.format("parquet").option("path", out), checkpoint)  # nothing landed
    assert spark.read.parquet(out).count() == 5


def test_running_count_keeps_keys_without_new_rows(spark):
    rows = at(spark, (1, "a", 1), (2, "b", 1), (25, "a", 1), (50, "a", 1))
    path = scratch.new_dir(spark, "t")
    replay(
        spark,
        {"rows": day_slices(rows, "ts")},
        lambda rows: state.running_counts(rows, ["k"]).writeStream.outputMode("complete").foreachBatch(files.per_batch(path)),
        "t",
    )
    got = {(r["batch_id"], r["k"]): r["n"] for r in spark.read.parquet(path).collect()}
    assert got == {(0, "a"): 1, (0, "b"): 1, (1, "a"): 2, (1, "b"): 1, (2, "a"): 3, (2, "b"): 1}
    assert sorted(files.latest(spark, path).select("k", "n").collect()) == [("a", 3), ("b", 1)]


def test_first_record_of_a_key_counts(spark):
    rows = at(spark, (1, "a", 600), (25, "b", 700))
    stats = state.stats_by_key(rows, ["k"], "v", "v", 500.0).collect()
    assert sorted(stats) == [("a", 600, 600, 1), ("b", 700, 700, 1)]


def test_append_mode_holds_back_the_open_window(spark):
    rows = at(spark, (1, "a", 1), (5, "a", 1), (9, "a", 1))
    path = scratch.new_dir(spark, "t")
    replay(
        spark,
        {"rows": [rows]},
        lambda rows: windows.tumbling_counts(windows.watermarked(rows, "ts", "1 hour"), "ts", ["k"], "1 hour")
        .writeStream.outputMode("append").foreachBatch(files.per_batch(path)),
        "t",
    )
    starts = [r["window_start"].hour for r in spark.read.parquet(path).collect()]
    assert sorted(starts) == [1, 5]


def test_late_rows_are_dropped_and_reported(spark):
    late = [at(spark, (1, "a", 1)), at(spark, (60, "a", 1)), at(spark, (2, "a", 1), (61, "a", 1))]
    store = UpsertLog(scratch.new_dir(spark, "t"), ("window_start",))
    progress = replay(
        spark,
        {"rows": late},
        lambda rows: windows.tumbling_counts(windows.watermarked(rows, "ts", "1 hour"), "ts", ["k"], "1 hour")
        .writeStream.outputMode("update").foreachBatch(lambda df, b: store.write(df, b)),
        "t",
    )
    assert sorted(r["window_start"].hour + 24 * (r["window_start"].day - 1) for r in store.read(spark).collect()) == [1, 60, 61]
    assert sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators) > 0


def test_only_a_pause_longer_than_the_gap_ends_a_session(spark):
    rows = at(spark, (0, "a", 1), (5, "a", 1), (11, "a", 1), (17.5, "a", 1), (0, "b", 1))
    stamped = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    want = [("a", 0, 17, 3), ("a", 17, 23, 1), ("b", 0, 6, 1)]
    for sessions in (
        windows.session_counts(stamped, "ts", ["k"], "6 hours"),
        windows.session_counts_batch(rows, "ts", ["k"], "6 hours"),
    ):
        got = [(r["k"], r["session_start"].hour, r["session_end"].hour, r["n"]) for r in sessions.collect()]
        assert sorted(got) == want


def test_sessions_over_slices_equal_plain_sessions(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("ts", "user_id")
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    plain = windows.session_counts(stamped, "ts", ["user_id"], "9 hours")
    sliced = windows.session_counts_batch(events, "ts", ["user_id"], "9 hours")
    assert plain.exceptAll(sliced).isEmpty() and sliced.exceptAll(plain).isEmpty()
    assert sliced.where("to_date(session_start) <> to_date(session_end)").count() > 0


def test_sliding_average_of_a_half_filled_window(spark):
    rows = at(spark, (0, "a", 10.0), (1, "a", 30.0), schema="ts timestamp_ntz, k string, v double")
    got = windows.sliding_average(rows, "ts", ["k"], "v", "2 hours", "1 hour", 2).collect()
    by_start = {r["window_start"]: (r["per_slide"], r["window_avg"]) for r in got}
    assert by_start[DAY - dt.timedelta(hours=1)] == (5.0, 10.0)
    assert by_start[DAY] == (20.0, 20.0)
    assert by_start[DAY + dt.timedelta(hours=1)] == (15.0, 30.0)


def test_previous_batch_first_batch_emits_nothing_and_repeats_are_idempotent(spark):
    path = scratch.new_dir(spark, "t")
    step = batches.with_previous(path, lambda df: df.select("k").distinct(), sets.subtract)
    one, two = at(spark, (1, "a", 1), (2, "a", 1)), at(spark, (3, "a", 1), (4, "b", 1))
    empty = two.limit(0)
    step(one, 0)
    assert not os.path.exists(f"{path}/out")
    for _ in range(2):  # a batch that is run again leaves the same rows
        step(two, 1)
        assert read(spark, f"{path}/out") == [("b", 1)]
    step(empty, 2)
    step(two, 3)
    assert read(spark, f"{path}/out") == [("a", 3), ("b", 1), ("b", 3)]


def test_exclusive_counts_on_a_repeated_batch(spark):
    path = scratch.new_dir(spark, "t")
    step = batches.exclusive_counts(path, "k", ["s"], ["f"], "title", "id")
    rows = spark.createDataFrame(
        [(1, "s", "x"), (2, "s", "x"), (3, "f", "y"), (4, "s", "y"), (5, "f", "z"), (6, "other", "x")],
        "id long, k string, title string",
    )
    step(rows, 0)
    step(rows, 0)
    assert read(spark, path) == [(2, 1, 0)]


def test_alarm_resets_and_every_record_counts(spark):
    path = scratch.new_dir(spark, "t")
    step = state.threshold_alarm(path, "v", "v", 500.0, 10)
    batch = at(spark, *[(i / 10, "a", 600 + i) for i in range(8)])
    for number in (0, 1, 1, 2):
        step(batch, number)
    step(batch.limit(0), 3)
    rows = [(r["batch_id"], r["low"], r["high"], r["reached"], r["alarm"], r["carried"]) for r in spark.read.parquet(path).orderBy("batch_id").collect()]
    assert rows == [
        (0, 600, 607, 8, False, 8),
        (1, 600, 607, 16, True, 0),
        (2, 600, 607, 8, False, 8),
        (3, 600, 607, 8, False, 8),
    ]


def test_upsert_last_write_wins_and_compacts(spark):
    store = UpsertLog(scratch.new_dir(spark, "t"), ("k",))
    one, two = at(spark, (1, "a", 1), (2, "a", 2), (1, "b", 1)), at(spark, (3, "a", 3))
    store.create_if_missing(spark, one.schema)
    assert store.read(spark).isEmpty()
    store.write(one, 0, order=["ts"])
    store.create_if_missing(spark, one.schema)
    for _ in range(2):
        store.write(two, 1, order=["ts"])
        assert sorted((r["k"], r["v"]) for r in store.read(spark).collect()) == [("a", 3), ("b", 1)]
    folded = store.compact(spark, scratch.new_dir(spark, "t"))
    assert sorted((r["k"], r["v"]) for r in folded.read(spark).collect()) == [("a", 3), ("b", 1)]


def test_upsert_log_folds_as_it_goes(spark):
    path = scratch.new_dir(spark, "log")
    store = UpsertLog(path, ("k",), fold_every=2)
    plain = UpsertLog(scratch.new_dir(spark, "log"), ("k",))
    for n in range(5):
        rows = spark.createDataFrame([(k, n) for k in range(n, n + 3)], "k int, v int")
        for log in (store, plain):
            log.write(rows, n)
        assert sorted(map(tuple, store.read(spark).collect())) == sorted(map(tuple, plain.read(spark).collect()))
    assert store.folds(spark) == [1, 3]
    files = {f.rsplit("/", 2)[-2] for f in store.read(spark).inputFiles()}
    assert files == {"000000000003", "batch_id=4"}  # nothing older is read
    store.write(spark.createDataFrame([(9, 3)], "k int, v int"), 3)  # the batch runs again with the same rows and more
    assert (9, 3) in set(map(tuple, store.read(spark).collect())) and store.folds(spark) == [1, 3]
    as_of = {(k, v) for k, v in map(tuple, store.read(spark, upto=1).collect())}
    assert as_of == {(0, 0), (1, 1), (2, 1), (3, 1)}


def test_interval_join_ends_at_the_span(spark):
    left = at(spark, (0, "a", 1), (1, "b", 1)).withColumnRenamed("ts", "lts").withColumnRenamed("k", "lk")
    right = at(spark, (2, "a", 1), (1.5, "b", 1), (0.5, "b", 2), (30, "a", 9)).withColumnRenamed("ts", "rts").withColumnRenamed("k", "rk").withColumnRenamed("v", "rv")
    path = scratch.new_dir(spark, "t")
    replay(
        spark,
        {"left": day_slices(left, "lts", 1), "right": day_slices(right, "rts", 1)},
        lambda left, right: joins.within(
            windows.watermarked(left, "lts", "1 hour"), windows.watermarked(right, "rts", "1 hour"), "lk", "rk", "lts", "rts", "2 hours"
        ).select("lk", "rv").writeStream.format("parquet").option("path", path),
        "t",
    )
    assert read(spark, path) == [("a", 1), ("b", 1)]


def test_static_join_with_and_without_broadcast(spark):
    rows = at(spark, (1, "a", 1), (2, "x", 1))
    names = spark.createDataFrame([("a", "Anna")], "k string, name string")
    path = scratch.new_dir(spark, "t")
    joins.enrich(names, ["k"], ["ts"], files.per_batch(path))(rows, 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins.enrich(names, ["k"], ["ts"], files.per_batch(path))(rows, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = spark.read.parquet(path).select("v", "name", "batch_id").collect()
    assert sorted(got) == [(1, "Anna", 0), (1, "Anna", 1)]


def test_per_window_join(spark):
    left = at(spark, (0.1, "a", 1), (0.2, "a", 2), (1.1, "a", 3))
    right = (
        at(spark, (0.5, "a", 7)).groupBy(F.window("ts", "1 hour").alias("bucket"), "k").agg(F.sum("v").alias("s"))
    )
    assert sorted(joins.per_window(left, right, ["k"], "ts", "1 hour").select("v", "s").collect()) == [(1, 7), (2, 7)]


class FileClient:
    """Appends messages to a file of its own and records that it was opened."""

    def __init__(self, directory, name):
        self.file = open(os.path.join(directory, name), "w")

    def send(self, message):
        self.file.write(message + "\n")

    def close(self):
        self.file.close()


def test_client_is_opened_once_per_partition(spark, tmp_path):
    directory = str(tmp_path)

    def connect():
        import uuid

        return FileClient(directory, uuid.uuid4().hex)

    df = spark.range(40).select(F.col("id").cast("string").alias("m")).repartition(4)
    receipts = clients.deliver(df, "m", connect).collect()
    sent = [line for name in os.listdir(directory) for line in open(tmp_path / name).read().split()]
    assert sorted(sent, key=int) == [str(i) for i in range(40)]
    assert len(os.listdir(directory)) == len(receipts) <= 4
    assert sum(r["sent"] for r in receipts) == 40


def test_foreach_writer_opens_per_partition_and_epoch(spark, tmp_path):
    directory = str(tmp_path)
    writer = clients.PartitionWriter("m", lambda partition, epoch: FileClient(directory, f"{partition}-{epoch}"))
    rows = at(spark, *[(h, str(h), h) for h in range(60)]).select("ts", F.col("k").alias("m"))
    replay(spark, {"rows": day_slices(rows, "ts")}, lambda rows: rows.writeStream.foreach(writer), "t")
    names = os.listdir(directory)
    sent = [line for name in names for line in open(tmp_path / name).read().split()]
    assert sorted(sent, key=int) == [str(h) for h in range(60)]
    assert {n.split("-")[1] for n in names} == {"0", "1", "2"}


def test_tables(spark):
    name = f"t_{scratch.new_dir(spark, 'x')[-8:]}"
    df = spark.range(3)
    tables.create(df, name, scratch.new_dir(spark, "t"))
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        tables.create(df, name)
    write = tables.per_batch(name, scratch.new_dir(spark, "t"))
    write(df, 4)
    write(df, 4)
    assert spark.table(f"{name}_4").count() == 3
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {name}_4")


def test_text_batches_are_overwritten_not_doubled(spark, tmp_path):
    write = files.per_batch_text(f"{tmp_path}/words", "txt")
    df = spark.createDataFrame([("x",)], "value string")
    write(df, 7)
    write(df, 7)
    assert [r[0] for r in spark.read.text(f"{tmp_path}/words-7.txt").collect()] == ["x"]


def test_preview_and_console(spark, capsys, tmp_path):
    files.preview(spark.range(20), 3)
    assert "only showing top 3 rows" in capsys.readouterr().out
    spark.range(2).write.parquet(f"{tmp_path}/in")
    stream = text_source.stream_files(spark, f"{tmp_path}/in", "parquet", "id long")
    drain(stream.writeStream.format("console"), f"{tmp_path}/cp")


def test_jdbc_passes_its_arguments_on(monkeypatch, spark):
    seen = {}
    from pyspark.sql.classic import dataframe  # noqa: F401
    from pyspark.sql.readwriter import DataFrameWriter

    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: seen.update(url=url, table=table, mode=mode, **properties))
    files.jdbc(spark.range(1), "jdbc:x:y", "count_table", mode="append", user="u")
    assert seen == {"url": "jdbc:x:y", "table": "count_table", "mode": "append", "user": "u"}


def test_online_models_restart_from_the_stored_batch(spark):
    rows = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0)], "x double, y double")
    path = scratch.new_dir(spark, "t")
    learn = models.train_sgd(path, "y", ["x"], step=0.1)
    for number in (0, 1, 1):
        learn(rows, number)
    weights = [r["x"] for r in spark.read.parquet(path).orderBy("batch_id").collect()]
    assert weights == pytest.approx([0.65, 0.65 - 0.1 * ((0.65 - 3) + (1.3 - 5) * 2) / 2])


def test_rollup_streams_in_complete_mode(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_suppkey", "l_linenumber", "l_shipdate")
    path = scratch.new_dir(spark, "t")
    replay(
        spark,
        {"rows": day_slices(lines, "l_shipdate")},
        lambda rows: rows.rollup("l_suppkey", "l_linenumber").count().writeStream.outputMode("complete").foreachBatch(files.per_batch(path)),
        "t",
    )
    batch = lines.rollup("l_suppkey", "l_linenumber").count()
    assert files.latest(spark, path).exceptAll(batch).isEmpty()
    assert files.latest(spark, path).count() == batch.count()


def test_replayed_batches_are_the_slices(spark):
    rows = at(spark, (1, "a", 1), (30, "b", 1), (55, "c", 1))
    path = scratch.new_dir(spark, "t")
    replay_batches(rows, "ts", files.per_batch(path), "t")
    assert [(r["k"], r["batch_id"]) for r in spark.read.parquet(path).orderBy("ts").collect()] == [("a", 0), ("b", 1), ("c", 2)]
