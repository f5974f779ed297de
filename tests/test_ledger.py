"""SNK2's commit protocol and SET4's run history."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.errors import PySparkException

from surfacekit.operators import run_history as H
from surfacekit.sources.ledger import CommitConflict, Ledger


def keys(ledger):
    df = ledger.read()
    return [] if df is None else sorted(r[0] for r in df.select("k").collect())


def frame(spark, values):
    return spark.createDataFrame([(v, f"from {v}") for v in values], "k long, note string")


def test_each_key_is_appended_once(spark, tmp_dir):
    sink = Ledger(spark, f"{tmp_dir}/sink")
    assert sink.read() is None and sink.commits() == []
    assert sink.append_new(frame(spark, [1, 2, 2, 3]), "k") == 3
    assert sink.append_new(frame(spark, [3, 3, 4]), "k") == 1
    assert sink.append_new(frame(spark, [1, 4]), "k") == 0
    assert keys(sink) == [1, 2, 3, 4]
    assert [c.rows for c in sink.commits()] == [3, 1, 0] and [c.version for c in sink.commits()] == [1, 2, 3]


def test_a_first_append_without_rows_breaks_no_later_one(spark, tmp_dir):
    sink = Ledger(spark, f"{tmp_dir}/sink")
    assert sink.append_new(frame(spark, []), "k") == 0
    assert sink.read() is None
    assert sink.append_new(frame(spark, [5]), "k") == 1 and keys(sink) == [5]


def test_a_named_append_is_done_once(spark, tmp_dir):
    sink = Ledger(spark, f"{tmp_dir}/sink")
    assert sink.append_new(frame(spark, [1, 2]), "k", name="batch-0") == 2
    assert sink.append_new(frame(spark, [1, 2, 9]), "k", name="batch-0") == 0
    assert keys(sink) == [1, 2]


def test_a_failed_append_leaves_nothing_that_a_reader_sees(spark, tmp_dir):
    from pyspark.sql import functions as F

    sink = Ledger(spark, f"{tmp_dir}/sink")
    sink.append_new(frame(spark, [1]), "k")
    broken = frame(spark, range(10, 60)).withColumn("note", F.when(F.col("k") == 40, F.raise_error(F.lit("lost"))).otherwise(F.col("note")))
    with pytest.raises(PySparkException):
        sink.append_new(broken, "k", name="b")
    assert keys(sink) == [1] and len(sink.commits()) == 1
    assert sink.append_new(frame(spark, range(10, 60)), "k", name="b") == 50
    sink._stage(frame(spark, [77]))  # a writer that died before its commit
    assert 77 not in keys(sink) and sink.remove_strays() >= 1 and len(keys(sink)) == 51


def test_a_taken_version_is_not_overwritten(spark, tmp_dir):
    sink = Ledger(spark, f"{tmp_dir}/sink")
    assert sink._put_new(1, '{"name": "a", "folder": null, "rows": 0}')
    assert not sink._put_new(1, '{"name": "b", "folder": null, "rows": 0}')
    assert [c.name for c in sink.commits()] == ["a"]


def test_a_writer_that_comes_second_drops_what_the_first_brought(spark, tmp_dir):
    one, two = Ledger(spark, f"{tmp_dir}/sink"), Ledger(spark, f"{tmp_dir}/sink")
    one.append_new(frame(spark, [1]), "k")
    held = two.commits
    state = {"first": True}

    def late(after=0):
        """The second writer looks, and only then the first one commits."""
        found = held(after)
        if state["first"]:
            state["first"] = False
            one.append_new(frame(spark, [2, 3]), "k")
        return found

    two.commits = late
    assert two.append_new(frame(spark, [1, 3, 4]), "k") == 1
    assert keys(one) == [1, 2, 3, 4]
    never = Ledger(spark, f"{tmp_dir}/sink", attempts=2)
    never._put_new = lambda version, text: False
    with pytest.raises(CommitConflict):
        never.append_new(frame(spark, [8]), "k")
    assert keys(one) == [1, 2, 3, 4]


def test_writers_at_once(spark, tmp_dir):
    def write(k):
        return Ledger(spark, f"{tmp_dir}/sink").append_new(frame(spark, range(k, k + 10)), "k")

    with ThreadPoolExecutor(3) as pool:
        rows = list(pool.map(write, (0, 4, 8)))
    assert keys(Ledger(spark, f"{tmp_dir}/sink")) == list(range(18)) and sum(rows) == 18


def test_a_version_taken_at_once_has_one_writer(spark, tmp_dir):
    sinks = [Ledger(spark, f"{tmp_dir}/sink") for _ in range(3)]
    start = Barrier(3)

    def claim(k):
        won = []
        for version in range(1, 61):
            start.wait(60)
            won.append(sinks[k]._put_new(version, f'{{"name": "{k}", "folder": null, "rows": 0}}'))
        return won

    with ThreadPoolExecutor(3) as pool:
        won = list(zip(*pool.map(claim, range(3))))
    assert [sum(w) for w in won] == [1] * 60
    assert [c.name for c in sinks[0].commits()] == [str(w.index(True)) for w in won]


def test_null_keys_are_a_key(spark, tmp_dir):
    sink = Ledger(spark, f"{tmp_dir}/sink")
    nulls = spark.createDataFrame([(None, "x"), (None, "y")], "k long, note string")
    assert sink.append_new(nulls, "k") == 1 and sink.append_new(nulls, "k") == 0


# ---------------------------------------------------------------------- run history
def plain_intervals(runs):
    """Brute force: stretches of runs in a row, by walking over them."""
    out = []
    for asset in {a for r in runs for a in r}:
        since = None
        for n, r in enumerate([*runs, set()], 1):
            if asset in r and since is None:
                since = n
            if asset not in r and since is not None:
                out.append((asset, since, n if n <= len(runs) else None))
                since = None
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("asset", "since", "until").collect()), key=str)


def test_history_in_one_pass_equals_merging_run_by_run(spark):
    rnd = random.Random(3)
    runs = [{f"h{k}" for k in range(12) if rnd.random() < 0.6} for _ in range(6)]
    runs[3] = set()
    sightings = spark.createDataFrame([(a, n) for n, r in enumerate(runs, 1) for a in r for _ in range(2)] + [(None, 1), ("h1", None)], "asset string, run int")
    whole = H.history_of(sightings, last_run=6)
    assert rows(whole) == plain_intervals(runs)
    history = spark.createDataFrame([], "asset string, since long, until long")
    for n, r in enumerate(runs, 1):
        history = H.merge_run(history, spark.createDataFrame([(a,) for a in r] or [(None,)], "asset string"), n)
        history = spark.createDataFrame(history.collect(), history.schema)
    assert rows(history) == plain_intervals(runs)
    for a, b in ((1, 2), (1, 6), (3, 4), (6, 1), (2, 2)):
        want = {x: "kept" if x in runs[a - 1] and x in runs[b - 1] else "added" if x in runs[b - 1] else "removed" for x in runs[a - 1] | runs[b - 1]}
        assert dict(map(tuple, H.diff_runs(whole, a, b).collect())) == want
    moves = {r["run"]: (r["opened"], r["closed"]) for r in H.churn(whole).collect()}
    for n in range(1, 7):
        before, now = runs[n - 2] if n > 1 else set(), runs[n - 1]
        assert moves.get(n, (0, 0)) == (len(now - before), len(before - now))


def test_history_of_no_runs(spark):
    none = spark.createDataFrame([], "asset string, run int")
    assert H.history_of(none, 3).collect() == [] and H.churn(H.history_of(none, 3)).collect() == []


# ---------------------------------------------------------------------- whole JSON documents, SNK1
def test_json_files_and_those_that_do_not_parse(spark, tmp_dir):
    from surfacekit.sources import io

    texts = {"a": '{"u": [{"url": "x"}],\n "s": ["a"]}', "b": ' [{"u": null, "s": ["b"]},\n {"s": ["c"]}]', "c": '{"u": [', "d": "   ", "e": '[{"s": ["c"]}, {"s"', "f": "[]", "g": "{}"}
    for name, text in texts.items():
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text)
    documents, unparsed = io.json_files(spark, tmp_dir, "u array<struct<url:string>>, s array<string>")
    got = sorted((r["file"][-6], r["pos"], r["s"]) for r in documents.collect())
    assert [x for x in got if x[0] != "g"] == [("a", 0, ["a"]), ("b", 0, ["b"]), ("b", 1, ["c"])] and ("g", 0, None) in got
    assert sorted((r["file"][-6], r["n_chars"]) for r in unparsed.collect()) == [(k, len(texts[k])) for k in "cde"]
    assert documents.select("s").count() == 4  # pruning changes no row


def test_a_nonempty_write_runs_its_plan_once_and_keeps_the_target_on_failure(spark, tmp_dir):
    from pyspark.sql import functions as F

    from surfacekit.sources import io

    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    counted = spark.range(0, 8, 1, 2).mapInArrow(count, "id long")
    assert io.write_nonempty(counted, f"{tmp_dir}/o") and runs.value == 8
    assert not io.write_nonempty(counted.where("id < 0"), f"{tmp_dir}/o") and runs.value == 16
    assert spark.read.parquet(f"{tmp_dir}/o").count() == 8
    with pytest.raises(PySparkException):
        io.write_nonempty(spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id")), f"{tmp_dir}/o")
    assert spark.read.parquet(f"{tmp_dir}/o").count() == 8
    assert io.write_nonempty(spark.range(2), f"{tmp_dir}/o", mode="append") and spark.read.parquet(f"{tmp_dir}/o").count() == 10
    assert io.write_nonempty(spark.range(2).selectExpr("id", "id AS v"), f"{tmp_dir}/o", partition_by=["v"]) and spark.read.parquet(f"{tmp_dir}/o").count() == 2
    with pytest.raises(ValueError):
        io.write_nonempty(spark.range(2), f"{tmp_dir}/o", mode="error")
