"""Timers, paired streams, own sources and sinks: restarts, repeated batches, failing tasks."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace import scratch
from millrace.plans.replay import drain
from millrace.sinks import outbox
from millrace.sinks.files import per_batch
from millrace.sources import polls
from millrace.sources import text as text_source
from millrace.streaming import batches, inactivity, state

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def dirs(spark, *names):
    return [scratch.new_dir(spark, name) for name in names]


def rows_of(spark, path, *cols):
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*cols).collect()), key=repr)


def idle(spark, landing, out, idle_ms):
    stream = spark.readStream.schema("k int, g string").parquet(landing)
    return inactivity.idle_counts(stream, ["k", "g"], idle_ms).writeStream.outputMode("append").format("parquet").option("path", out)


def land(spark, landing, *rows, schema="k int, g string"):
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(landing)


def test_a_row_after_the_end_opens_a_new_count(spark):
    landing, out, checkpoint = dirs(spark, "in", "out", "cp")
    land(spark, landing, (1, "a"), (1, "a"), (2, None), (None, "c"))
    with inactivity.batches_with_data_only(spark):
        drain(idle(spark, landing, out, 1), checkpoint)
        assert rows_of(spark, out, "k") == []  # nothing has ended while nothing else has run
        land(spark, landing, (1, "a"))  # late: the count of this key is over, though its timer has not run
        drain(idle(spark, landing, out, 1), checkpoint)
    assert rows_of(spark, out, "k", "g", "n") == sorted([(1, "a", 2), (2, None, 1), (None, "c", 1)], key=repr)
    land(spark, landing)  # a file without rows gets the timers going again
    inactivity.run_out(idle(spark, landing, out, 1), checkpoint)
    assert rows_of(spark, out, "k", "g", "n") == sorted([(1, "a", 1), (1, "a", 2), (2, None, 1), (None, "c", 1)], key=repr)
    for opened, last in rows_of(spark, out, "opened_ms", "last_ms"):
        assert opened == last


def test_a_count_goes_on_across_a_restart_within_its_time(spark):
    landing, out, checkpoint = dirs(spark, "in", "out", "cp")
    with inactivity.batches_with_data_only(spark):
        for rows in ([(1, "a")] * 3 + [(2, "b")], [(1, "a")] * 2):
            land(spark, landing, *rows)
            drain(idle(spark, landing, out, 3_600_000), checkpoint)
    assert rows_of(spark, out, "k") == []
    held = spark.read.format("statestore").option("stateVarName", "count").load(checkpoint)
    found = {json.loads(r["key"])["k"]: (r["n"], r["ends_ms"] - r["last_ms"], r["last_ms"] > r["opened_ms"]) for r in held.select("key.*", "value.*").collect()}
    assert found == {1: (5, 3_600_000, True), 2: (1, 3_600_000, False)}
    query = idle(spark, landing, out, 3_600_000)
    with pytest.raises(TimeoutError):
        inactivity.run_out(query, checkpoint, timeout_s=1)


def test_a_long_batch_is_no_standstill(spark):
    landing, out, checkpoint = dirs(spark, "in", "out", "cp")

    def slow(batches):
        import time

        for batch in batches:
            time.sleep(12)
            yield batch

    land(spark, landing, (1, "a"), (2, "b"), (1, "a"))
    stream = spark.readStream.schema("k int, g string").parquet(landing).mapInPandas(slow, "k int, g string")
    counts = inactivity.idle_counts(stream, ["k", "g"], 1).writeStream.outputMode("append").format("parquet").option("path", out)
    inactivity.run_out(counts, checkpoint, timeout_s=10)
    assert rows_of(spark, out, "k", "g", "n") == [(1, "a", 2), (2, "b", 1)]


def test_state_is_read_back_at_any_batch(spark):
    landing, checkpoint = dirs(spark, "in", "cp")
    for rows in ([(1, "a"), (1, "b")], [(2, "a"), (None, "x")]):
        land(spark, landing, *rows)
        stream = spark.readStream.schema("k int, g string").parquet(landing)
        drain(state.running_counts(stream, ["k"]).writeStream.outputMode("update").format("noop"), checkpoint)
    read = lambda **o: {r["k"]: r["count"] for r in state.read_back(spark, checkpoint, **o).collect()}
    assert read() == {1: 2, 2: 1, None: 1} and read(batch_id=0) == {1: 2}


def test_two_streams_meet_in_their_batch_only(spark):
    one, two, out, checkpoint = dirs(spark, "one", "two", "out", "cp")
    seen = []

    def step(first, second, batch_id):
        seen.append((batch_id, first.columns, second.columns))
        joined = first.join(second, "k", "full").select("k", "g", "v")
        per_batch(out)(joined, batch_id)

    def run():
        first = spark.readStream.schema("k int, g string").parquet(one)
        second = spark.readStream.schema("k int, v double").parquet(two)
        return drain(batches.two_streams(first, second).writeStream.foreachBatch(batches.on_both(step)), checkpoint)

    land(spark, one, (1, "a"), (2, "b"))
    land(spark, two, (1, 0.5), schema="k int, v double")
    run()
    land(spark, one, (1, "later"))  # its partner came in an earlier batch
    land(spark, two, schema="k int, v double")
    run()
    want = [(0, 1, "a", 0.5), (0, 2, "b", None), (1, 1, "later", None)]
    assert rows_of(spark, out, "batch_id", "k", "g", "v") == want
    assert seen[0] == (0, ["k", "g"], ["k", "v"]) and len(seen) == 2
    again = batches.two_streams(spark.createDataFrame([(1, "later")], "k int, g string"), spark.createDataFrame([], "k int, v double"))
    batches.on_both(step)(again, 1)  # the batch runs again
    assert rows_of(spark, out, "batch_id", "k", "g", "v") == want


def test_messages_are_published_once_and_whole(spark):
    landing, box, checkpoint = dirs(spark, "in", "box", "cp")
    land(spark, landing, (1, "two\nlines"), (2, None), (3, "ünï \"quoted\""))
    land(spark, landing, (4, ""))

    def run():
        return drain(outbox.writer(spark.readStream.schema("k int, g string").parquet(landing), "g", box), checkpoint)

    run()
    run()  # nothing new
    land(spark, landing, (5, "next"))
    run()
    sent = sorted(tuple(r) for r in outbox.messages(spark, box).collect())
    assert sent == [(0, ""), (0, "two\nlines"), (0, "ünï \"quoted\""), (1, "next")]
    totals = outbox.receipts(spark, box).groupBy("batch").agg(F.sum("sent"), F.sum("sent_chars")).orderBy("batch").collect()
    assert [tuple(r) for r in totals] == [(0, 3, 9 + 12), (1, 1, 4)]


def test_a_batch_that_runs_again_is_not_doubled(tmp_path, spark):
    writer = outbox._Writer(str(tmp_path), "g")
    first = writer.write(iter([Row(g="a"), Row(g="b")]))
    writer.commit([first, None, outbox.Receipt("", 0, 0)], 7)
    second = writer.write(iter([Row(g="a"), Row(g="b")]))  # the job failed after it had published, and runs again
    writer.commit([second], 7)
    assert sorted(r.message for r in outbox.messages(spark, str(tmp_path)).collect()) == ["a", "b"]
    assert os.listdir(tmp_path / "segments") == [first.segment]
    third = writer.write(iter([Row(g="c")]))
    writer.abort([third, None], 8)
    assert os.listdir(tmp_path / "segments") == [first.segment]


def test_a_failing_task_leaves_no_message(tmp_path, spark):
    writer = outbox._Writer(str(tmp_path), "g")

    def broken():
        yield Row(g="a")
        raise OSError("connection lost")

    with pytest.raises(OSError):
        writer.write(broken())
    assert os.listdir(tmp_path / "segments") == []

    landing, box, checkpoint = (str(tmp_path / n) for n in ("in", "box", "cp"))
    mended = str(tmp_path / "mended")
    for part in ([(1, "a"), (2, "b")], [(3, "bad"), (4, "c")]):
        land(spark, landing, *part)

    @F.udf("string")
    def checked(value):
        if value == "bad" and not os.path.exists(mended):
            raise ValueError("bad row")
        return value

    def run():
        stream = spark.readStream.schema("k int, g string").parquet(landing).withColumn("g", checked("g"))
        return drain(outbox.writer(stream, "g", box), checkpoint)

    with pytest.raises(Exception, match="bad row"):
        run()
    assert not os.path.exists(f"{box}/manifests")
    open(mended, "w").close()
    run()  # the same batch again
    assert sorted(tuple(r) for r in outbox.messages(spark, box).collect()) == [(0, "a"), (0, "b"), (0, "bad"), (0, "c")]
    with pytest.raises(ValueError):
        outbox.OutboxSource({"path": box, "column": "missing"}).streamWriter(spark.range(1).schema, False)


def test_polls_are_read_once_across_restarts(spark, tmp_path):
    out, checkpoint = dirs(spark, "out", "cp")
    folders = [str(tmp_path / n) for n in ("a", "b")]

    def run(*used):
        drain(polls.stream(spark, list(used)).writeStream.format("parquet").option("path", out), checkpoint)
        return rows_of(spark, out, "input", "poll", "document")

    def poll(folder, name, document):
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
            file.write(document)

    poll(folders[0], "001", '{"x": 1}')
    poll(folders[0], ".hidden", "no")
    poll(folders[0], "_SUCCESS", "")
    assert run(folders[0]) == [("a", "001", '{"x": 1}')]
    assert run(folders[0]) == [("a", "001", '{"x": 1}')]  # nothing new
    poll(folders[0], "002", "é\nline")
    poll(folders[1], "001", "")
    want = [("a", "001", '{"x": 1}'), ("a", "002", "é\nline"), ("b", "001", "")]
    assert run(*folders) == want  # an input added later is read from its beginning
    poll(folders[1], "0005", "too late a name")
    assert run(*folders) == want
    assert polls.landed(str(tmp_path / "none")) == []


def test_new_files_only(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def write(text):
        spark.createDataFrame([(text,)], "value string").write.mode("append").text(landing)

    def run():
        lines = text_source.stream_new_lines(spark, landing, checkpoint)
        drain(lines.writeStream.format("parquet").option("path", out), checkpoint)
        return sorted(v for (v,) in rows_of(spark, out, "value"))

    write("before")
    assert run() == []
    marker = text_source.start_marker(spark, checkpoint)
    write("after")
    assert run() == ["after"]
    write("after a restart")
    assert run() == ["after", "after a restart"]
    assert text_source.start_marker(spark, checkpoint) == marker
