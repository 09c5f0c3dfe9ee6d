import oracle
import pytest
from pyspark.sql import functions as F

from sparkloom import cli, config
from sparkloom.operators import gates, normalize
from sparkloom.plans.bridges import interim

SF = "/root/testdata/sf0.001"


def test_direct_pairs_and_licences(spark):
    df = spark.createDataFrame([("How?", None, "So.", ["GPL-3.0"], 0), (None, "Why?", " Because. ", ["x", "mit"], 1)], "q string, p string, a string, l array<string>, dataset_row bigint")
    out = normalize.by_license(normalize.records(df, normalize.direct_pair(df, ["q", "p"], ["a"])), [F.col("l")], {"mit": "MIT"}, ["MIT"])
    rows = {r["dataset_row"]: r for r in out.withColumn("url", normalize.row_url("https://d", F.lit(None).cast("string"))).collect()}
    assert rows[0]["raw_content"] == "USER:\nHow?\n\nASSISTANT:\nSo." and rows[0]["reject_reason"] == "license_not_allowed"
    assert rows[1]["license"] == "MIT" and rows[1]["pair"]["assistant"] == "Because." and rows[1]["url"] == "https://d?row=1"


def test_titles_and_fields(spark):
    df = spark.createDataFrame([("T", "body", "a"), ("body and more", "body", "b"), (None, "only", "c")], "t string, b string, a string")
    got = [r[0] for r in df.select(normalize.direct_pair(df, ["b"], ["a"], "t")[0]).collect()]
    assert got == ["T\n\nbody", "body and more", "only"]
    out = normalize.records(df, None, ["b", "a"]).collect()
    assert out[0]["raw_content"] == '{"a":"a","b":"body"}'
    assert normalize.records(df, None, ["b"], most=4).count() == 3


def test_chat_and_candidates(spark):
    df = spark.createDataFrame([("s", "r1", "text", "reverse_instruction", "q", "a"), ("s", "r2", "text", "direct_pair", "q", " ")], "source string, source_record_id string, raw_content string, normalization string, u string, a string").withColumn("category", F.lit("concepto"))
    chat = normalize.chat(df, F.col("u"), F.col("a"), F.lit(None).cast("string"), "Be kind.").collect()
    assert len(chat) == 1 and [m["content"] for m in chat[0]["messages"]] == ["Be kind.", "q", "a"]
    kept, skipped = normalize.by_mode(df, "direct_pair")
    assert kept.count() == 1 and skipped.first()["skipped"] == 1
    c = normalize.candidates(df)
    cache = c.select("source_record_id", "fingerprint", F.lit("Ask").alias("user"), F.lit(None).cast("string").alias("reject_reason"))
    assert [r["state"] for r in normalize.with_generated(c, cache).collect()] == ["generated"]
    assert [r["state"] for r in normalize.with_generated(c, cache.withColumn("fingerprint", F.lit("old"))).collect()] == ["missing"]
    made = normalize.generate(c, lambda: lambda text, k: (f"{text}{k}", None if k == 1 else "weak")).collect()
    assert (made[0]["user"], made[0]["reject_reason"]) == ("text1", None)


def test_labels_and_sources(spark):
    df = spark.createDataFrame([(1, ["bug", "stale"]), (2, ["Bug"]), (3, ["docs"])], "n int, labels array<string>")
    assert [r["n"] for r in normalize.by_labels(df, "stale", "bug").collect()] == [2]
    known = {"a": {"tier": 1}, "b": {"tier": "quarantine"}, "c": {"enabled": False}}
    assert normalize.select_sources(known, None) == ["a"] and normalize.select_sources(known, ["b", "a", "b"]) == ["b", "a"]
    with pytest.raises(ValueError):
        normalize.select_sources(known, ["z"])


def test_gates(spark):
    df = spark.createDataFrame([("g", "c1", "s", None), ("g", "c2", "s", "x")], "g string, category string, source string, license string")
    assert [(r["field"], r["rows"]) for r in gates.missing_fields(df, ["category", "license"]).collect()] == [("license", 1)]
    with pytest.raises(gates.GateError):
        gates.must_be_empty(gates.mixed_groups(df, "g"), "mixed")
    s = df.withColumn("split", F.lit("test"))
    assert gates.missing_categories(s, ["c1", "c3"]).first()["missing"] == ["c3"]
    a = spark.createDataFrame([(0, "x"), (1, "y")], "position int, content_hash string")
    assert gates.order_differences(a, a).isEmpty() and not gates.order_differences(a, a.where("position = 0")).isEmpty()
    assert gates.same_settings({"a": 1}, {"a": 1, "b": 2}, ["a", "b"]) == ["b"]


def test_lineage():
    ok = [("clean", {"records": 3, "fingerprint": "f1"}, None), ("dedupe", {"records": 2, "input": "f1", "fingerprint": "f2"}, None)]
    assert gates.lineage(ok) == []
    assert gates.lineage([*ok, ("split", {"records": 0, "input": "old"}, None), ("x", None, "corrupt")]) == ["split:empty", "split:input_changed", "x:corrupt"]


def test_configuration(tmp_path):
    p = tmp_path / "c.json"
    p.write_text('{"a": {"b": 1}}')
    assert config.dotted(config.load(p), "a.b") == 1
    with pytest.raises(config.ConfigError):
        config.dotted({}, "a")
    p.write_text("[]")
    with pytest.raises(config.ConfigError):
        config.load(p)
    assert config.cleaning_problems({"length": {"min_chars": 5, "max_chars": 1}, "language": {"min_probability": 2}, "pii": {"patterns": {"x": "("}}})[0].startswith("length")
    assert config.split_problems({"ratios": {"train": 0.9, "validation": 0.05, "test": 0.05}}) == []
    assert len(config.source_problems({"s": {"kind": "odd", "category": "odd", "tier": 9}}, {})) == 3
    with pytest.raises(config.ConfigError):
        config.require(["x"])


def test_commands(spark, tmp_path, capsys):
    interim(spark, SF).write.parquet(str(tmp_path / "in"))
    run = lambda *a: cli.main([*a], spark)
    assert run("clean", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "clean")) == 0
    assert run("dedupe", "--input", str(tmp_path / "clean"), "--output", str(tmp_path / "dedupe")) == 0
    assert run("split", "--input", str(tmp_path / "dedupe"), "--output", str(tmp_path / "split"), "--group", "content_hash") == 0
    assert run("status", "--root", str(tmp_path), "clean", "dedupe", "split") == 0
    assert run("status", "--root", str(tmp_path), "clean", "other") == 1
    assert spark.read.parquet(str(tmp_path / "split")).select("split").distinct().count() == 3
    assert run("clean", "--input", str(tmp_path / "no.parquet"), "--output", str(tmp_path / "x")) == 2


def _conversations(spark, tmp_path):
    """Two exchanges whose prose begins lines with "From" and whose numbers have seven digits."""
    answer = "From here\nfrom there on it is prose."
    rows = [(c, t, r, x) for c in (1476, 31) for t, r, x in ((0, "user", "How?"), (1, "assistant", answer + " " * (len(answer) % 2 + 2 * (len(answer) % 3 == 0))))]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_prose_that_begins_lines_with_from_is_counted_as_sql_counts_it(spark, tmp_path):
    from sparkloom.plans import catalogue

    sf = _conversations(spark, tmp_path)
    oracle.compare(catalogue.QUERIES["reclassification_counter"](spark, sf), oracle.connect(sf), catalogue.SQL["reclassification_counter"])
    assert [r["n"] for r in catalogue.QUERIES["reclassification_counter"](spark, sf).collect()] == [2]


def test_names_of_candidates_hold_six_digits(spark, tmp_path):
    from sparkloom.plans import catalogue

    sf = _conversations(spark, tmp_path)
    got = catalogue.QUERIES["syntax_candidate_files"](spark, sf)
    assert sorted(r["name"][:7] for r in got.collect()) == ["031000-", "147600-"]
    oracle.compare(got, oracle.connect(sf), catalogue.SQL["syntax_candidate_files"])
