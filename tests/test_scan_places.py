"""Rules are tried where their anchors are; the matches are those of a plain search."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from surfacekit import rules
from surfacekit.operators import secrets
from surfacekit.plans import report_queries, stream_queries
from surfacekit.streaming import findings_stream

PIECES = ("s3://abc", "a.s3.amazonaws.com", "abc.s3.amazonaws.com", "10.0.0.1", "192.168.1.1", "172.16.0.1", "/", ".", "1.2.3.4", "256.1.2.3", "@",
          "a@b.co", "_", "-", "İ", "é", "ſ", "K", "postgresql://", "redis://", "client_secret", "app_secret", "secret", "=", "'",
          '"', "refresh_token", "auth-token", "accesstoken", ": ", "abcdefghijklmnop", "0123456789abcdef", "firebaseio.com", "https://", "graphql",
          "__schema", "Authorization", "api_key", "bearer ", "x" * 30, "\n", "AKIA", "A1B2C3D4E5F6G7H8", "ghp_", "eyJ", "key-", "AC", "pwd")


def plain(text):
    for r in rules.SECRET_RULES:
        hits = [m for m in re.finditer(r.pattern, text, re.A) if not r.keep or re.search(r.keep, m[0], re.A)]
        yield from ((r.ord, i, m.start(), m[0]) for i, m in enumerate(hits))


def test_matches_are_those_of_a_plain_search(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 90))) for _ in range(1500)]
    corpus = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "url string, content string")
    got = sorted((int(r["url"]), r["rule_ord"], r["idx"], r["offset"], r["raw"]) for r in secrets.scan_secrets(corpus).collect())
    assert got == sorted((k, *m) for k, t in enumerate(texts) for m in plain(t)) and len(got) > 3000


def test_no_rule_is_searched_at_every_place():
    assert [r.name for r in rules.SECRET_RULES if r.lead is None and r.starts is None] == []


def test_a_long_run_without_a_match_is_walked_once():
    class Tried:
        pattern, places = re.compile(r"[a-z]+@x"), []

        def match(self, text, at):
            self.places.append(at)
            return self.pattern.match(text, at)

    text = "ab@" * 50 + "cd@x"
    tried = Tried()
    found = [m[0] for m in secrets._near(tried, text, [m.start() for m in re.finditer("@", text)], "abcd")]
    assert found == ["cd@x"] and len(tried.places) == len(set(tried.places)) <= len(text)


def test_pages_are_read_for_their_links_once(spark):
    plan = report_queries.stat_facts(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # the leak scan


def test_a_batch_scans_as_many_files_as_there_are_tasks(spark, tmp_dir):
    for name in ("pages", "documents", "conversations"):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        df.repartition(8).write.parquet(f"{tmp_dir}/{name}.parquet")
    got = stream_queries.q_str6(spark, tmp_dir)
    assert got.count() == secrets.secret_findings(stream_queries.T.secret_corpus(spark, tmp_dir)).count() > 0
    commits = spark.read.format("binaryFile").load(f"{findings_stream.job_dir(spark, 'str6-corpus', tmp_dir)}/ckpt/commits")
    assert commits.where(F.col("path").rlike(r"/commits/[0-9]+$")).count() <= -(-8 // spark.sparkContext.defaultParallelism)
