"""Runs that stop and go on, bounded calls in flight, and the cap on what a query reads."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import models, normalize, relational


def test_calls_in_flight_are_bounded_and_in_order():
    now, most, lock = [0], [0], threading.Lock()

    def call(x):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.002 * (x % 5))
        with lock:
            now[0] -= 1
        return x * x

    for limit in (1, 4):
        most[0] = 0
        assert list(models.in_order(call, iter(range(60)), limit)) == [x * x for x in range(60)]
        assert most[0] == limit
    taken = []
    first = models.in_order(call, (taken.append(x) or x for x in range(1000)), 3)
    next(first)
    assert len(taken) <= 5  # values are taken as calls end, not ahead
    with pytest.raises(ZeroDivisionError):
        list(models.in_order(lambda x: 1 // (x - 3), iter(range(9)), 4))


def test_rejects_and_transport_errors_are_told_apart(spark):
    def client():
        def call(text, attempt):
            if text == "down" or (text == "shaky" and attempt == 0):
                raise OSError("no route")
            return (None, "weak") if text == "bad" or (text == "better" and attempt < 2) else (f"ask {text}", None)

        return call

    rows = [(f"r{i}", t) for i, t in enumerate(["good", "down", "bad", "shaky", "better"] * 30)]
    df = spark.createDataFrame(rows, "source_record_id string, raw_content string").coalesce(1)
    for in_flight in (1, 6):
        out = normalize.generate(df, client, in_flight=in_flight).collect()
        assert [r["source_record_id"] for r in out] == [r[0] for r in rows]
        assert [(r["user"], r["reject_reason"], r["error"]) for r in out[:5]] == [("ask good", None, None), (None, None, "OSError: no route"), (None, "weak", None), ("ask shaky", None, None), ("ask better", None, None)]


def counting(log, stop_at):
    """A client that notes each call in a file and fails where so many have been made."""

    def make():
        def call(rows):
            with open(log, "a+", encoding="utf-8") as f:
                f.seek(0)
                if stop_at is not None and len(f.read().splitlines()) >= stop_at:
                    raise OSError("killed")
                f.write("".join(f"{r['content_hash']}\n" for r in rows))
            return [{"content_hash": r["content_hash"], "answer": r["content_hash"].upper()} for r in rows]

        return call

    return make


def test_a_killed_run_goes_on_where_it_stopped(spark, tmp_path):
    log, path = str(tmp_path / "calls"), str(tmp_path / "run")
    df = spark.createDataFrame([(f"h{i:03d}",) for i in range(100)], "content_hash string")
    ask = lambda stop: lambda rows: models.in_batches(rows.coalesce(1), ["content_hash"], counting(log, stop), "content_hash string, answer string", 1)
    calls = lambda: open(log, encoding="utf-8").read().splitlines()
    with pytest.raises(Exception, match="killed"):
        models.in_slices(df, path, ask(47), {"model": "a"}, 20)
    assert len(calls()) == 47 and sum(os.path.exists(f"{path}/slice-{k:06d}/_SUCCESS") for k in range(5)) == 2
    out = models.in_slices(df, path, ask(None), {"model": "a"}, 20)
    assert {r["content_hash"]: r["answer"] for r in out.collect()} == {f"h{i:03d}": f"H{i:03d}" for i in range(100)}
    assert len(calls()) == 47 + 60  # two slices of 20 were kept, seven answers of the third are asked again
    assert models.in_slices(df, path, ask(0), {"model": "a"}, 20).count() == 100 and len(calls()) == 107
    for other in (lambda: models.in_slices(df, path, ask(0), {"model": "b"}, 20), lambda: models.in_slices(df.limit(99), path, ask(0), {"model": "a"}, 20)):
        with pytest.raises(ValueError, match="other settings or requests"):
            other()
    spark.createDataFrame([("h000", "X")], "content_hash string, answer string").write.mode("overwrite").parquet(f"{path}/slice-000003")
    with pytest.raises(ValueError, match="does not answer its requests"):
        models.in_slices(df, path, ask(0), {"model": "a"}, 20)
    assert models.in_slices(df.limit(0), str(tmp_path / "none"), ask(0), {}, 20).count() == 0


def test_the_judge_asks_the_right_server_only(spark):
    rows = spark.createDataFrame([("h", "q", "r", "c")], "content_hash string, question string, reference string, candidate string")
    make = lambda: lambda row: "{}"
    assert models.judge(rows, None, make, "v", lambda _: ["a", "b"], "b").count() == 1
    with pytest.raises(Exception, match="not c"):
        models.judge(rows, None, make, "v", lambda _: ["a", "b"], "c").count()


def test_a_query_over_the_cap_does_not_run(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)
    spark.range(200_000).selectExpr("id", "id % 7 AS k").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    touched = F.udf(lambda x: ran.add(1) or x, "bigint")
    df = t.join(t.groupBy("k").count(), "k").withColumn("id", touched("id"))
    assert 2 * size * 0.5 < relational.scanned_bytes(df) <= 2 * size * 1.5
    with pytest.raises(ValueError, match="allowed"):
        relational.within(df, size)
    assert ran.value == 0 and relational.within(df, 4 * size).limit(5).count() == 5
    assert relational.scanned_bytes(spark.range(5)) == 0
