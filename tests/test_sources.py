import hashlib
import json
from datetime import datetime, timezone

import pytest

from sparkloom.operators import split
from sparkloom.plans.bridges import groups
from sparkloom.sources import files, jsonl, rest, sinks


def test_jsonl_order_and_errors(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n\n{"a": 2}\n')
    rows = jsonl.read_jsonl(spark, str(p), "a int").collect()
    assert sorted((r["ordinal"], r["a"]) for r in rows) == [(0, 1), (2, 2)]
    p.write_text('{"a": 1}\n[1]\n')
    with pytest.raises(Exception, match="not a JSON object"):
        jsonl.read_jsonl(spark, str(p), "a int").collect()


def test_missing_inputs(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n')
    df, missing = jsonl.read_many(spark, [str(p), str(tmp_path / "b.jsonl")], "a int")
    assert df.count() == 1 and len(missing) == 1
    with pytest.raises(FileNotFoundError):
        jsonl.read_many(spark, [str(tmp_path / "b.jsonl")], "a int")


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (0, "ñ"), (1, None)], "ordinal bigint, b string")
    a = jsonl.write_jsonl(df, str(tmp_path / "o"), ["ordinal"])
    b = jsonl.write_jsonl(df.repartition(3), str(tmp_path / "p"), ["ordinal"])
    assert a["records"] == b["records"] == 3
    text = "".join(x.read_text() for x in sorted((tmp_path / "o").glob("part-*")))
    assert text.splitlines()[0] == '{"b": "ñ", "ordinal": 0}'
    assert [json.loads(x) for x in text.splitlines()] == [{"b": "ñ", "ordinal": 0}, {"ordinal": 1}, {"b": "b", "ordinal": 2}]
    assert a["sha256"] == hashlib.sha256(text.encode()).hexdigest() and a["bytes"] == len(text.encode())


def test_verified_parquet(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t"))
    part = next((tmp_path / "t").glob("*.parquet"))
    assert files.verified_parquet(spark, str(part)).count() == 3
    with pytest.raises(ValueError):
        files.verified_parquet(spark, str(part), "0" * 64)
    bad = tmp_path / "x.parquet"
    bad.write_bytes(b"nothing at all")
    with pytest.raises(ValueError):
        files.verified_parquet(spark, str(bad))


def test_chunks():
    text = "---\ntitle: x\n---\n# Troubleshooting\n\nSome words that are long enough to stay.\n\n```yaml\n# not a heading\nkind: Pod\n```\n"
    assert [t for t, _ in files.chunk_markdown(text, 40, 1000, 50)] == ["Troubleshooting"]
    many = files.chunk_markdown("# T\n\n" + "\n\n".join(["A repeated phrase of words. " * 8] * 30), 40, 500, 50)
    assert len(many) > 1 and all(40 <= len(c) <= 500 for _, c in many)
    assert files.chunk_markdown("", 1, 10, 1) == []
    long = files.chunk_markdown("# T\n\n" + "x" * 950, 40, 500, 50)
    assert all(len(c) <= 500 for _, c in long) and sum(len(c) for _, c in long) >= 950


def test_markdown_tree(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.md").write_text("# A\n\n" + "words " * 60)
    (tmp_path / "b.md").write_bytes(b"\xff\xfe bad")
    (tmp_path / "c.txt").write_text("no")
    found = files.markdown_files(spark, str(tmp_path))
    assert found.count() == 1
    rows = files.markdown_chunks(found, 40, 1000, 50).collect()
    assert [(r["title"], r["chunk_index"]) for r in rows] == [("A", 0)]


def test_windows_are_halved():
    hits = {"n": 0}

    def count(a, b):
        hits["n"] += 1
        return (1001 if hits["n"] == 1 else 10), False

    t = lambda h: datetime(2026, 1, 1, h, tzinfo=timezone.utc)
    got = rest.windows(count, t(0), t(2))
    assert hits["n"] == 3 and got == [("2026-01-01T00:00:00Z", "2026-01-01T01:00:00Z"), ("2026-01-01T01:00:01Z", "2026-01-01T02:00:00Z")]


def test_rate_limits_are_waited_out():
    calls, slept = [], []

    def fetch(path, parameters):
        calls.append(path)
        if len(calls) < 3:
            raise rest.RateLimited(5)
        return {"ok": 1}

    assert rest.with_retries(fetch, sleep=slept.append)("/x", {}) == {"ok": 1} and slept == [5, 5]
    with pytest.raises(rest.RateLimited):
        rest.with_retries(lambda p, q: (_ for _ in ()).throw(rest.RateLimited(1000)))("/x", {})


def test_paged_source(spark):
    def fetch(path, p):
        rows = [{"row": {"i": k}} for k in range(p["offset"], min(250, p["offset"] + p["length"]))]
        return {"num_rows_total": 250, "rows": rows}

    spark.dataSource.register(rest.paged_source("paged_test", fetch))
    df = spark.read.format("paged_test").load()
    assert df.count() == 250 and df.agg({"row_index": "max"}).first()[0] == 249


def test_reports_and_tables(spark, tmp_path):
    assert sinks.read_report(spark, str(tmp_path / "no.json")) == (None, "missing")
    (tmp_path / "bad.json").write_text("{")
    assert sinks.read_report(spark, str(tmp_path / "bad.json")) == (None, "corrupt")
    out = str(tmp_path / "t")
    first = sinks.write_table(spark.range(4), out, {"revision": "r"})
    again = sinks.write_table(spark.range(9), out, {"revision": "r"})
    assert (first["records"], first["skipped"], again["records"], again["skipped"]) == (4, False, 4, True)
    assert sinks.write_table(spark.range(4).repartition(3), out, {}, force=True)["fingerprint"] == first["fingerprint"]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", range(6))
def test_a_stopped_rewrite_leaves_the_old_table_or_the_new(spark, tmp_path, monkeypatch, step):
    """The writer is stopped before its n-th touch of the file system; manifest and rows always belong together."""
    out, left = str(tmp_path / "t"), [step]
    old = sinks.write_table(spark.range(4), out, {"name": "old"})

    def stopping(f):
        def call(*a, **k):
            if left[0] == 0:
                raise Stopped
            left[0] -= 1
            return f(*a, **k)

        return call

    for name in ("replace", "delete", "size_of", "sha256_of"):
        monkeypatch.setattr(sinks.hadoop, name, stopping(getattr(sinks.hadoop, name)))
    try:
        sinks.write_table(spark.range(9).coalesce(1), out, {"name": "new"}, force=True)
    except Stopped:
        pass
    monkeypatch.undo()
    now, issue = sinks.read_report(spark, f"{out}.manifest.json")
    assert issue is None and now["name"] in ("old", "new")
    assert sinks.read_table(spark, out).count() == now["records"] == (4 if now["name"] == "old" else 9)
    assert now["name"] == ("old" if step < 3 else "new")
    assert now["name"] == "new" or now["fingerprint"] == old["fingerprint"]
    done = sinks.write_table(spark.range(5), out, {"name": "later"}, force=True)
    assert sinks.read_table(spark, out).count() == 5 == done["records"] and not done["skipped"]


def test_a_report_is_replaced_in_one_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r.json")
    sinks.write_json(spark, path, {"n": 1})
    sinks.write_json(spark, path, {"n": 2})
    assert sinks.read_report(spark, path) == ({"n": 2}, None)
    monkeypatch.setattr(sinks.hadoop, "replace", lambda *a: (_ for _ in ()).throw(Stopped))
    with pytest.raises(Stopped):
        sinks.write_json(spark, path, {"n": 3})
    assert sinks.read_report(spark, path) == ({"n": 2}, None)


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_stopped_rewrite_of_lines_is_put_right(spark, tmp_path, monkeypatch, step):
    path, left = str(tmp_path / "o"), [step]
    jsonl.write_jsonl(spark.range(3), path, ["id"])
    for name in ("rename", "delete"):
        def call(*a, real=getattr(jsonl.hadoop, name)):
            if left[0] == 0:
                raise Stopped
            left[0] -= 1
            return real(*a)

        monkeypatch.setattr(jsonl.hadoop, name, call)
    with pytest.raises(Stopped):
        jsonl.write_jsonl(spark.range(7), path, ["id"])
    monkeypatch.undo()
    assert spark.read.json(jsonl.recovered(spark, path)).count() == (7 if step == 2 else 3)
    assert jsonl.write_jsonl(spark.range(5), path, ["id"])["records"] == 5 and spark.read.json(path).count() == 5


def test_datasheet(spark):
    sheet = sinks.datasheet(split.statistics(split.allocate(groups(spark, "/root/testdata/sf0.001"))), "Data")
    assert sheet.startswith("# Data") and "| train |" in sheet


def test_stream_dedupe(spark, tmp_path):
    from sparkloom.streaming.dedupe import dedupe_stream

    src = tmp_path / "in"
    spark.createDataFrame([("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 00:01:00"), ("b", "2026-01-01 00:02:00")], "h string, t string").write.json(str(src))
    s = dedupe_stream(spark.readStream.schema("h string, t timestamp").json(str(src)), "h", "t")
    q = s.writeStream.format("memory").queryName("deduped").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r["h"] for r in spark.sql("select h from deduped").collect()) == ["a", "b"]
