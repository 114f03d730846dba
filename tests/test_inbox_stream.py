"""Incremental inbox: only changed files are hashed; digests of chunks; logs and their compaction; update-mode spans."""
import hashlib
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from tablewise.sources import logs as LG
from tablewise.sources.digests import file_digests
from tablewise.streaming import inbox as IB
from tablewise.streaming import windows as WN


def tree(body: bytes, chunk: int, fanout: int) -> str:
    nodes = [hashlib.md5(body[i:i + chunk]).hexdigest() for i in range(0, max(len(body), 1), chunk)]
    while len(nodes) > 1:
        groups = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        nodes = [g[0] if len(g) == 1 else hashlib.md5("".join(g).encode()).hexdigest() for g in groups]
    return nodes[0]


def test_file_digests_are_those_of_the_chunk_tree(spark, tmp_out):
    bodies = {"empty": b"", "one": b"x" * 10, "edge": b"ab" * 50, "long": bytes(range(256)) * 40, "odd": b"q" * 10_001}
    for name, body in bodies.items():
        with open(f"{tmp_out}/{name}", "wb") as f:
            f.write(body)
    # Spark's listing leaves empty files out
    files = spark.createDataFrame([(f"file:{tmp_out}/{n}", len(b)) for n, b in bodies.items()], "path string, length bigint")
    for run in (1, 3, 1000):  # how chunks are dealt does not matter
        got = {r.path.rsplit("/", 1)[-1]: (r.digest, r.bytes_read) for r in file_digests(files, 100, run, 4).collect()}
        assert got == {n: (tree(b, 100, 4), len(b)) for n, b in bodies.items()}
    assert {r.digest for r in file_digests(files.where("path like '%one'")).collect()} == {hashlib.md5(b"x" * 10).hexdigest()}
    assert file_digests(files.where("false")).count() == 0


def test_one_large_file_is_read_by_several_tasks(spark, tmp_out):
    with open(f"{tmp_out}/big.csv", "wb") as f:
        f.write(os.urandom(1 << 20))
    files = spark.read.format("binaryFile").load(tmp_out).select("path", "length")
    got = file_digests(files, chunk_bytes=1 << 14, run=4)
    runs = files.select(F.explode(F.sequence(F.lit(0), F.ceil(F.col("length") / (1 << 14)).cast("int") - 1, F.lit(4))).alias("k"), "path")
    assert runs.repartition(4, "path", "k").groupBy(F.spark_partition_id()).count().count() > 1
    assert got.count() == 1 and "MapInArrow" in got._jdf.queryExecution().toString()


def put(inbox, name, shift, rows=40):
    os.makedirs(inbox, exist_ok=True)
    with open(f"{inbox}/{name}.csv", "w", encoding="utf-8") as f:
        f.write("x,y\n" + "".join(f"{i},{i * 2 + shift}\n" for i in range(rows)))


def test_only_changed_files_are_hashed(spark, tmp_out, monkeypatch):
    """Two triggers and a restart between them: the bytes hashed are those of new and rewritten files."""
    ran = []
    from tablewise.plans import run as RUN

    def fake(session, source, out, logs, trees):
        ran.append(source.rsplit("/", 1)[-1])
        return {"run_id": f"r{len(ran)}", "status": "failed" if source.endswith("bad.csv") and len(ran) < 6 else "success"}
    monkeypatch.setattr(RUN, "run_dataset", fake)
    inbox, work = f"{tmp_out}/inbox", f"{tmp_out}/work"
    index = IB.file_index(spark, f"{work}/files")
    hashed = lambda: index.read().agg(F.sum("bytes_read")).first()[0] or 0
    size = lambda *names: sum(os.path.getsize(f"{inbox}/{n}.csv") for n in names)

    put(inbox, "a", 0)
    put(inbox, "b", 0, 60)
    IB.stream_inbox(spark, inbox, work)
    assert sorted(ran) == ["a.csv", "b.csv"] and hashed() == size("a", "b")
    IB.stream_inbox(spark, inbox, work)  # nothing new: nothing is read
    assert len(ran) == 2 and hashed() == size("a", "b")
    before = hashed()
    put(inbox, "b", 10 ** 6, 61)  # rewritten in place
    put(inbox, "bad", 1)
    IB.stream_inbox(spark, inbox, work)
    assert sorted(ran[2:]) == ["b.csv", "bad.csv"] and hashed() - before == size("b", "bad")
    before = hashed()
    put(inbox, "a", 0)  # written again, the same content: hashed, not run; the failed one is tried again without a read
    IB.stream_inbox(spark, inbox, work)
    assert ran[4:] == ["bad.csv"] and hashed() - before == size("a")
    IB.stream_inbox(spark, inbox, work)
    assert ran[5:] == ["bad.csv"]
    IB.stream_inbox(spark, inbox, work)
    assert len(ran) == 6


def test_datasets_run_side_by_side_and_are_monitored_in_order(spark, tmp_out, monkeypatch):
    """They ran one after the other: the first could not meet the second. The first is monitored first all the same."""
    from tablewise.plans import run as RUN
    met, seen = threading.Event(), []

    def stage(r):
        if r.source.endswith("b.csv"):
            met.set()
        elif r.source.endswith("a.csv"):
            assert met.wait(20)
        elif r.source.endswith("bad.csv"):
            raise ValueError("bad")
        return r.source
    monkeypatch.setattr(RUN, "STAGE_FUNCS", (("only", stage),))
    monkeypatch.setattr(RUN, "observe", lambda session, doc, r: seen.append((doc["source_name"], doc["status"])))
    inbox, work = f"{tmp_out}/inbox", f"{tmp_out}/work"
    for i, name in enumerate(("a", "b", "bad", "d")):
        put(inbox, name, i)
        os.utime(f"{inbox}/{name}.csv", (1_700_000_000 + i,) * 2)
    done = IB.process_pending(spark, inbox, f"{work}/runlog", f"{work}/runs", f"{work}/logs", 1)
    want = [("a.csv", "success"), ("b.csv", "success"), ("bad.csv", "failed"), ("d.csv", "success")]
    assert seen == want and [(os.path.basename(r["dataset"]), r["status"]) for r in done] == want
    log = IB.read_runlog(spark, f"{work}/runlog").orderBy("processed_at").collect()
    assert [(os.path.basename(r.dataset), r.status) for r in log] == want and len({r.out for r in log}) == 4


def test_a_run_that_cannot_be_made_leaves_those_beside_it_logged(spark, tmp_out, monkeypatch):
    from tablewise.plans import run as RUN

    def fake(session, source, out, logs, trees):
        if source.endswith("a.csv"):
            raise OSError("no folder")
        return {"run_id": "r", "status": "success"}
    monkeypatch.setattr(RUN, "run_dataset", fake)
    inbox, work = f"{tmp_out}/inbox", f"{tmp_out}/work"
    for i, name in enumerate("ab"):
        put(inbox, name, i)
        os.utime(f"{inbox}/{name}.csv", (1_700_000_000 + i,) * 2)
    with pytest.raises(OSError, match="no folder"):
        IB.process_pending(spark, inbox, f"{work}/runlog", f"{work}/runs", f"{work}/logs", 1)
    assert [os.path.basename(r.dataset) for r in IB.read_runlog(spark, f"{work}/runlog").collect()] == ["b.csv"]


def test_new_files_come_from_the_checkpointed_source(spark, tmp_out):
    """The source brings each new file once, over a restart too, and reads no body."""
    inbox = f"{tmp_out}/in"
    seen = []

    def go():
        q = (IB.new_files(spark, inbox, 1).writeStream.foreachBatch(
            lambda b, e: seen.append(sorted(r.path.rsplit("/", 1)[-1] for r in b.collect())))
            .option("checkpointLocation", f"{tmp_out}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    put(inbox, "a", 0)
    put(inbox, "b", 0)
    go()
    put(inbox, "c", 0)
    go()
    assert [x for x in seen if x] == [["a.csv"], ["b.csv"], ["c.csv"]]


def test_log_rows_are_seen_once_over_compactions(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(LG, "COMPACT_FILES", 5)
    log = LG.LogTable(spark, f"{tmp_out}/log", "k string, v bigint")
    assert log.read().count() == 0 and not log.exists()
    most = 0
    for i in range(23):
        log.append(spark.createDataFrame([(f"k{i % 3}", i)], "k string, v bigint"))
        assert sorted(r.v for r in log.read().collect()) == list(range(i + 1))
        most = max(most, sum(n.endswith(".parquet") for _, _, names in os.walk(f"{tmp_out}/log") for n in names))
    assert most <= 5 * 2 + 3  # however many appends there are


def test_a_reader_during_a_compaction_sees_every_row_once(spark, tmp_out):
    log = LG.LogTable(spark, f"{tmp_out}/log", "k string, v bigint")
    for i in range(4):
        log.append(spark.createDataFrame([("a", i)], "k string, v bigint"))
    early = log.read()  # listed before the switch
    log.compact()
    log.append(spark.createDataFrame([("a", 4)], "k string, v bigint"))
    assert sorted(r.v for r in early.collect()) == [0, 1, 2, 3]
    assert sorted(r.v for r in log.read().collect()) == [0, 1, 2, 3, 4]
    # a compaction that ended before its switch leaves a part that nobody names
    os.makedirs(f"{tmp_out}/log/full-orphan")
    log.compact()
    log.compact()
    assert sorted(r.v for r in log.read().collect()) == [0, 1, 2, 3, 4]


def test_log_keeps_the_last_row_of_a_key(spark, tmp_out):
    log = LG.LogTable(spark, f"{tmp_out}/log", "k string, v bigint", key=["k"], order="v")
    for i in range(6):
        log.append(spark.createDataFrame([(f"k{i % 2}", i), (None, i)], "k string, v bigint"))
    log.compact()
    assert sorted((r.k or "", r.v) for r in log.read().collect()) == [("", 5), ("k0", 4), ("k1", 5)]


EVENTS = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("v", T.DoubleType())])


def feed(spark, folder, rows):
    (spark.createDataFrame(rows, "id long, at string, v double").withColumn("at", F.col("at").cast("timestamp"))
     .coalesce(1).write.mode("append").parquet(folder))


def test_spans_in_update_mode_late_repeated_and_restarted(spark, tmp_out):
    src, out, ck = f"{tmp_out}/src", f"{tmp_out}/out", f"{tmp_out}/ck"
    day = lambda d, h=1: f"2024-01-{d:02d} {h:02d}:00:00"
    go = lambda: WN.run_span_stream(spark, src, EVENTS, "at", "v", out, ck, delay="3 days", key=["id"], files_per_trigger=1)
    got = lambda: {r.span_start.day: (r.value_sum, r.value_count) for r in WN.spans(spark, out).collect()}
    feed(spark, src, [(1, day(1), 1.0), (2, day(2), 2.0), (3, day(2), None), (4, None, 9.0), (5, day(2), float("nan"))])
    feed(spark, src, [(2, day(2), 2.0), (6, day(3), 4.0)])  # the second row comes again
    go()
    assert got() == {1: (1.0, 1), 2: (2.0, 1), 3: (4.0, 1)}
    feed(spark, src, [(7, day(1), 8.0), (8, day(10), 16.0)])  # late, within three days
    go()  # a new query on the same checkpoint
    assert got() == {1: (9.0, 2), 2: (2.0, 1), 3: (4.0, 1), 10: (16.0, 1)}
    feed(spark, src, [(9, day(2), 32.0), (10, day(9), 64.0)])  # the first is later than the watermark allows
    go()
    assert got() == {1: (9.0, 2), 2: (2.0, 1), 3: (4.0, 1), 9: (64.0, 1), 10: (16.0, 1)}
    log = WN.span_log(spark, out)
    log.append(log.read().where("epoch = 0"))  # an epoch that is written again changes nothing
    assert got()[1] == (9.0, 2)
    log.compact()
    assert got() == {1: (9.0, 2), 2: (2.0, 1), 3: (4.0, 1), 9: (64.0, 1), 10: (16.0, 1)}
    assert {r.period: r.value_count for r in WN.monthly(spark, out).collect()} == {"2024-01": 6}


@pytest.mark.parametrize("span", ["6 hours", "7 days"])
def test_spans_equal_batch_windows(spark, tmp_out, span):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.repartition(3).write.parquet(f"{tmp_out}/src")
    WN.run_span_stream(spark, f"{tmp_out}/src", orders.schema, "o_orderdate", "o_totalprice", f"{tmp_out}/out", f"{tmp_out}/ck",
                       span=span, delay="10000 days", files_per_trigger=1)
    want = {r.w.start: (round(r.s, 2), r.n) for r in orders.groupBy(F.window(F.col("o_orderdate").cast("timestamp"), span).alias("w"))
            .agg(F.sum("o_totalprice").alias("s"), F.count("o_totalprice").alias("n")).collect()}
    assert {r.span_start: (round(r.value_sum, 2), r.value_count) for r in WN.spans(spark, f"{tmp_out}/out").collect()} == want
