"""Chunks, totals, remote files, readers with a saved place, and event logs."""

import gzip
import io
import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quern.functions import hashing as H
from quern.functions import text as T
from quern.functions.prefix import running_total
from quern.operators import layout as L
from quern.operators import manifest as N
from quern.sources import remote, sinks
from quern.sources.readers import Source
from quern.sources.shard_reader import IncompatibleState, ShardReader
from quern.streaming import events


def test_balanced_chunks():
    rng = random.Random(1)
    files = [(f"f{i}", rng.randint(1, 1000)) for i in range(50)]
    size = dict(files)
    chunks = L.balanced_chunks(files, 6)
    assert sorted(x for c in chunks for x in c) == sorted(size) and len(chunks) == 6
    held = [sum(size[x] for x in c) for c in chunks]
    assert max(held) - min(held) <= max(size.values())
    assert L.balanced_chunks([("a", 1)], 5) == [["a"]] and L.balanced_chunks([], 3) == []


def test_running_total_with_null_and_far_keys(spark):
    rng = random.Random(2)
    keys = [None, None, -(1 << 63), (1 << 63) - 1, *(rng.randrange(10**6) for _ in range(500))]
    table = spark.createDataFrame([(k, rng.randint(0, 9)) for k in keys], "k bigint, n int")
    got = running_total(table, "k", "n", "before", rows_each=20).orderBy(F.col("k").asc_nulls_first(), "before").collect()
    assert len(got) == len(keys)
    total = 0
    for r in got:
        assert r.before == total
        total += r.n


def test_selected_refuses_nothing(spark):
    m = spark.createDataFrame([("u", "s", "d")], "uri string, source string, domain string")
    assert L.selected(m, ["s"]).count() == 1
    with pytest.raises(ValueError):
        L.selected(m, ["other"])
    with pytest.raises(ValueError):
        L.with_weights(m, {"s": 0.0})


def test_byte_round_trip(spark):
    row = spark.range(1).select(H.byte_text(F.concat(H.byte_ids(F.lit("aé漢\n"), 258), F.array(F.lit(257), F.lit(0))), 258).alias("t")).first()
    assert row.t == "aé漢\n"


def test_rolled_equals_a_writer(spark):
    rng = random.Random(3)
    rows = [(s, i, rng.randint(1, 60)) for s in ("a", "b", None) for i in range(80)]
    for before in (True, False):
        want, held, shard, last = {}, 0, 0, object()
        for s, i, n in sorted(rows, key=lambda r: (str(r[0]), r[1])):
            if s != last:
                held, shard, last = 0, 0, s
            if before and held and held + n > 100 or not before and held >= 100:
                held, shard = 0, shard + 1
            held += n
            want[s, i] = shard
        got = sinks.rolled(spark.createDataFrame(rows, "s string, i int, n int"), "s", ["i"], F.col("n"), 100, before)
        assert {(r.s, r.i): r.shard for r in got.collect()} == want


def test_remote_files_and_cursor(spark):
    lines = b"\n".join(json.dumps({"id": f"r{i}", "text": f"t{i}"}).encode() for i in range(5))
    buffer = io.BytesIO()
    pq.write_table(pa.table({"id": ["p0", "p1", ""], "text": ["x", None, "z"]}), buffer)
    store = {"a://1.jsonl.gz": gzip.compress(lines), "a://2.parquet": buffer.getvalue()}
    get = store.__getitem__
    first = remote.read_remote(spark, Source("s", "remote", []), ["a://1.jsonl.gz"], get)
    assert sorted(r.id for r in first.collect()) == [f"r{i}" for i in range(5)]
    cursor = remote.advanced(first.where("line < 2"))
    assert cursor == {"a://1.jsonl.gz": 2}
    rest = remote.read_remote(spark, Source("s", "remote", []), ["a://1.jsonl.gz"], get, cursor=cursor)
    assert sorted(r.id for r in rest.collect()) == ["r2", "r3", "r4"]
    assert remote.read_remote(spark, Source("s", "remote", []), ["a://1.jsonl.gz"], get, cursor=remote.advanced(rest, cursor)).collect() == []
    table = remote.read_remote(spark, Source("s", "remote", []), ["a://2.parquet"], get, kind="parquet")
    assert sorted(r.id for r in table.collect()) == ["p0", "s/1"]


def test_reader_resumes_and_refuses(spark, tmp_path):
    rows = [(f"d{i}", f"text {i}", "s", "d", "l", "{}", i // 4) for i in range(12)]
    schema = "id string, text string, source string, domain string, language string, metadata string, shard int"
    for k in range(3):
        part = spark.createDataFrame([r for r in rows if r[6] == k], schema).drop("shard")
        part.coalesce(1).write.parquet(str(tmp_path / f"s{k}"))
    manifest = sinks.build_manifest(spark, str(tmp_path) + "/*", "s").drop("created_at")
    whole = [r.id for r in ShardReader(spark, manifest)]
    assert sorted(whole) == sorted(r[0] for r in rows)
    reader = ShardReader(spark, manifest)
    taken = []
    for r in reader:
        taken.append(r.id)
        if len(taken) == 6:
            break
    state = json.loads(json.dumps(reader.state()))
    again = ShardReader(spark, manifest)
    again.load(state)
    assert taken + [r.id for r in again] == whole
    for changed in ({"world": 2}, {"worker": 1, "workers": 2}, {"source": "s"}):
        with pytest.raises(IncompatibleState):
            ShardReader(spark, manifest, **changed).load(state)
    with pytest.raises(IncompatibleState):
        ShardReader(spark, manifest).load(state | {"current_shard_id": "other"})
    parts = [[r.id for r in ShardReader(spark, manifest, world=2, rank=k, seed=3)] for k in (0, 1)]
    assert sorted(parts[0] + parts[1]) == sorted(whole)


def test_event_log(spark, tmp_path):
    path = str(tmp_path / "log")
    events.log(spark, path, {"step": 1, "tokens": 100, "seconds": 2.0}, {"step": 2, "tokens": 300, "seconds": 4.0})
    events.log(spark, path, {"step": 3, "tokens": 400, "seconds": 5.0})
    log = events.read_log(spark, path, "step int, tokens bigint, seconds double, timestamp string").withColumn("run", F.lit("r"))
    got = [(r.tokens_per_second, r.progress, r.eta_seconds) for r in events.step_metrics(log, "run", "step", "tokens", "seconds", 800).orderBy("step").collect()]
    assert got == [(50.0, 0.125, 14.0), (100.0, 0.375, 500 * 4 / 300), (100.0, 0.5, 5.0)] and log.where("timestamp is null").count() == 0
    events.heartbeat(spark, str(tmp_path / "beat"), step=1)
    events.heartbeat(spark, str(tmp_path / "beat"), step=2)
    assert [json.loads(r.value)["step"] for r in spark.read.text(str(tmp_path / "beat")).collect()] == [2]


def test_folded(spark):
    texts = ["STRASSE", "straße", "ΟΔΥΣΣΕΥΣ", "ﬁn", "Éa", "I"]
    got = [r.f for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.folded(F.col("t")).alias("f")).collect()]
    assert got == [t.casefold() for t in texts]


def test_append_and_reshard_refuse(spark):
    base = spark.createDataFrame([("a", "b/a", 1)], "id string, uri string, estimated_tokens int").withColumn("sha256", F.sha2("uri", 256))
    run = lambda id, uri: spark.createDataFrame([(id, uri, 1)], "id string, uri string, estimated_tokens int").withColumn("sha256", F.sha2("uri", 256))
    assert sorted(r.uri for r in N.append_run(base, run("c", "r/c"), "r", "b/in").collect()) == ["b/a", "b/in/c"]
    for id, uri, new in (("a", "r/c", "b/in"), ("c", "r/a", "b"), ("c", "other/c", "b/in")):
        with pytest.raises(ValueError):
            N.append_run(base, run(id, uri), "r", new)
    with pytest.raises(ValueError):
        N.reshard(base, (1, 1), (2, 1))
    assert N.reshard(base, (1, 1), (2, 1), reset_positions=True).count() == 2
