"""Named streaming jobs: stop and restart, keyed state, late rows."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surfacekit.streaming import findings_stream as ST

SCHEMA = "finding string, vuln_class string, event_id long"


def arrive(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_job_folders_are_stable_and_apart(spark):
    assert ST.job_dir(spark, "a", "/x") == ST.job_dir(spark, "a", "/x")
    assert len({ST.job_dir(spark, *x) for x in (("a", "/x"), ("b", "/x"), ("a", "/y"))}) == 3
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with ST.state_store(spark):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_a_job_that_fails_in_its_second_batch_resumes_without_loss(spark, tmp_dir):
    folder = f"{tmp_dir}/in"
    for k in range(4):
        arrive(spark, folder, [(f"line {k}-{n}", "c", 10 * k + n) for n in range(5)])

    def start(broken):
        s = ST.stream_findings(spark, folder, SCHEMA)
        if broken:
            s = s.withColumn("finding", F.when(F.col("event_id") >= 10, F.raise_error(F.lit("power cut"))).otherwise(F.col("finding")))
        return ST.start_append(s, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")

    with pytest.raises(Exception, match="power cut"):
        ST.run(start(True))
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 5  # one batch is done
    ST.run(start(False))
    arrive(spark, folder, [("late file", "c", 99)])
    ST.run(start(False))
    got = sorted(r["finding"] for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == sorted([f"line {k}-{n}" for k in range(4) for n in range(5)] + ["late file"])


def test_first_rows_across_batches_and_restarts(spark, tmp_dir):
    rnd = random.Random(2)
    batches = [[(f"l{rnd.randrange(30)}", f"c{rnd.randrange(3)}", 1000 * (5 - b) + n) for n in range(40)] + [("hot", f"c{b % 3}", 1000 * (5 - b) + 500 + n) for n in range(20)]
               for b in range(3)]
    want = {}
    for rows in batches:
        for finding, cls, event in sorted(rows, key=lambda r: r[2]):
            want.setdefault(finding, (cls, event))
    for rows in batches:
        arrive(spark, f"{tmp_dir}/in", rows)
        s = ST.stream_findings(spark, f"{tmp_dir}/in", SCHEMA)
        ST.run(ST.start_distinct(s, "finding", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", partition_by="vuln_class", order=["event_id"]))
    out = ST.read_batches(spark, f"{tmp_dir}/out", SCHEMA).collect()
    assert len(out) == len(want) and {r["finding"]: (r["vuln_class"], r["event_id"]) for r in out} == want


def test_a_first_batch_without_rows_breaks_no_later_one(spark, tmp_dir):
    arrive(spark, f"{tmp_dir}/in", [])
    assert ST.read_batches(spark, f"{tmp_dir}/out", SCHEMA).count() == 0
    for rows in ([("a", "x", 1), (None, "y", 2)], [("a", "z", 3), (None, "y", 4), ("b", None, 5)]):
        s = ST.stream_findings(spark, f"{tmp_dir}/in", SCHEMA)
        ST.run(ST.start_distinct(s, "finding", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", partition_by="vuln_class", order=["event_id"]))
        arrive(spark, f"{tmp_dir}/in", rows)
    s = ST.stream_findings(spark, f"{tmp_dir}/in", SCHEMA)
    ST.run(ST.start_distinct(s, "finding", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", partition_by="vuln_class", order=["event_id"]))
    got = {(r["finding"], r["vuln_class"]) for r in ST.read_batches(spark, f"{tmp_dir}/out", SCHEMA).collect()}
    assert got == {("a", "x"), (None, "y"), ("b", None)}


def test_a_batch_reads_no_earlier_output(spark, tmp_dir):
    """The sink may even be gone: keyed state alone decides what is new."""
    import shutil

    arrive(spark, f"{tmp_dir}/in", [("a", "x", 1)])
    ST.run(ST.start_distinct(ST.stream_findings(spark, f"{tmp_dir}/in", SCHEMA), "finding", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))
    shutil.move(f"{tmp_dir}/out", f"{tmp_dir}/moved")
    arrive(spark, f"{tmp_dir}/in", [("a", "y", 2), ("b", "y", 3)])
    ST.run(ST.start_distinct(ST.stream_findings(spark, f"{tmp_dir}/in", SCHEMA), "finding", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))
    assert [r["finding"] for r in ST.read_batches(spark, f"{tmp_dir}/out", SCHEMA).collect()] == ["b"]


def test_table_streams_take_no_sibling(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/t.parquet")
    spark.range(5).write.parquet(f"{tmp_dir}/t.parquet.bak")
    ST.run(ST.start_append(ST.stream_table(spark, tmp_dir, "t"), f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 3


def test_windows_and_late_rows_are_the_input(spark, tmp_dir):
    rnd = random.Random(7)
    schema = "ts timestamp_ntz, event_type string, n long"
    t0 = dt.datetime(2024, 3, 1)
    batches = [[(t0 + dt.timedelta(seconds=rnd.randrange(3600 * (b + 1) * 6)), rnd.choice(["a", "b"]), 100 * b + n) for n in range(60)] for b in range(3)]
    batches.insert(1, [])
    late, counts, latest = Counter(), Counter(), None
    for rows in batches:
        limit = None if latest is None else latest - dt.timedelta(hours=2)
        for ts, kind, n in rows:
            start = ts.replace(minute=0, second=0)
            is_late = limit is not None and start + dt.timedelta(hours=1) <= limit
            counts[int((start - dt.datetime(1970, 1, 1)).total_seconds()), kind, is_late] += 1
            late[n] += is_late
        latest = max([x for x in [latest, *(r[0] for r in rows)] if x], default=None)
    for k, rows in enumerate(batches):
        arrive(spark, f"{tmp_dir}/in", rows, schema)
        for _ in range(2 if k == 2 else 1):  # a start with nothing new changes nothing
            s = ST.stream_findings(spark, f"{tmp_dir}/in", schema, files_per_trigger=None)
            ST.run(ST.start_windows(s, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", delay=7200))
    got = {(r["window_start"], r["event_type"]): (r["events"], r["late_events"]) for r in ST.windows_of(spark, f"{tmp_dir}/out").collect()}
    keys = {(w, k) for w, k, _ in counts}
    assert got == {x: (counts[*x, False], counts[*x, True]) for x in keys}
    assert sum(a + b for a, b in got.values()) == sum(map(len, batches))
    assert sorted(r["n"] for r in ST.late_rows(spark, f"{tmp_dir}/out", schema).collect()) == sorted(n for n, x in late.items() if x)
    assert any(late.values())
