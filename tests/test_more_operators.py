"""Extraction, training input, evaluation, boundaries, ranks and the index, against plain Python."""

import hashlib
import json
import random
import statistics
from html.parser import HTMLParser

import clients
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom import cli
from sparkloom.functions import text
from sparkloom.operators import cleaning, dedupe, evaluation, extract, graph, models, probes, ranks, similarity, split, stats, training
from sparkloom.plans import catalogue
from sparkloom.sources import files, jsonl, sinks

SF = "/root/testdata/sf0.001"


def test_prefix_sums_equal_running_ones(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), hashlib.sha256(str(i).encode()).hexdigest(), i, rng.randint(1, 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, h string, i bigint, n bigint").repartition(5)
    got = {r["i"]: r["_before"] for r in ranks.before(df, ["g"], "h", "i", F.col("n"), digits=1).collect()}
    sums: dict = {}
    for g, _, i, n in sorted(rows, key=lambda r: (r[1], r[2])):
        assert got[i] == sums.get(g, 0)
        sums[g] = sums.get(g, 0) + n


def test_ranks_pick_what_sorting_does(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randint(0, 9), f"h{i:03}") for i in range(90)]
    df = spark.createDataFrame(rows, "category string, length int, content_hash string")
    got = {(r["category"], r["rank"]): r["content_hash"] for r in probes.quantile_probes(df, 5).collect()}
    for c in "ab":
        s = sorted((n, h) for k, n, h in rows if k == c)
        assert {r for k, r in got if k == c} == {round(i * (len(s) - 1) / 4) for i in range(5)}
        assert all(got[c, r] == s[r][1] for k, r in got if k == c)
    values = [n for _, n, _ in rows]
    p = ranks.percentiles(df, "length", {"m": ("median", 0.5), "s": ("share", 0.9)}).first()
    assert (p["m"], p["s"]) == (statistics.median(values), sorted(values)[min(89, int(0.9 * 90))])


@pytest.mark.parametrize("few", [0, 1 << 18])
def test_components_of_strings(spark, few):
    edges = [("b", "a"), ("c", "b"), ("x", "y"), ("q", "q")] + [(f"n{i:02}", f"n{i + 1:02}") for i in range(20)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "src string, dst string"), few=few).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"} | {f"n{i:02}": "n00" for i in range(21)}


def test_exact_dedupe_keeps_the_first(spark):
    rows = [("h1", 0, 5), ("h1", 0, 2), ("h1", 1, 0), ("h2", 0, 9), (None, 0, 1), (None, 0, 3)]
    df = spark.createDataFrame(rows, "content_hash string, input_rank int, ordinal int")
    got = {(r["input_rank"], r["ordinal"]): (r["is_duplicate"], r["kept_id"]) for r in dedupe.exact_dedupe(df).collect()}
    assert got == {(0, 5): (True, 2), (0, 2): (False, 2), (1, 0): (True, 2), (0, 9): (False, 9), (0, 1): (False, 1), (0, 3): (False, 3)}
    assert [r["ordinal"] for r in dedupe.in_order(dedupe.exact_dedupe(df)).collect()] == [1, 2, 3, 9]


def test_cluster_ids_are_digests_of_sorted_members(spark):
    rows = [(k % 4, f"h{k}") for k in range(50)]
    got = {r["component"]: r["semantic_cluster_id"] for r in dedupe.cluster_ids(spark.createDataFrame(rows, "component int, content_hash string").repartition(3)).collect()}
    assert got == {c: hashlib.sha256("|".join(sorted(h for k, h in rows if k == c)).encode()).hexdigest() for c in range(4)}


def test_index_finds_near_vectors(spark):
    """Recall of the bucketed search against all pairs, with a third of the vectors equal."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 32))
    v = np.concatenate([base + rng.normal(scale=0.18, size=base.shape) for _ in range(6)] + [np.repeat(base[:1], 180, axis=0)])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, vector array<double>")
    s = v @ v.T
    want = {(i, j) for i, j in zip(*np.nonzero(s >= 0.92), strict=True)}
    got = {(r["query"], r["reference"]) for r in similarity.knn(df, 500, 0.92, (10, 24), size=64).collect()}
    assert got <= {(i, j) for i, j in zip(*np.nonzero(s >= 0.92 - 1e-9), strict=True)} and len(got & want) >= 0.95 * len(want)
    top = similarity.knn(df, 5, 0.92, (10, 24)).groupBy("query").count().agg(F.max("count"), F.count("*")).first()
    assert tuple(top) == (5, len(v))
    exact = {(r["query"], r["reference"]) for r in similarity.knn(df, 500, 0.92).collect()}
    assert exact == want


def test_pairs_are_cleaned_member_by_member(spark):
    rows = [("s", "concepto", "x" * 100, None, "mail a@b.org\n\n\n\nnow", "<p>Go to <b>c@d.org</b></p>"), ("s", "concepto", "short", "sys", "u", None)]
    df = spark.createDataFrame(rows, "source string, category string, raw_content string, system string, user string, assistant string").withColumn("language", F.lit("en"))
    a, b = cleaning.clean(df, pair=("system", "user", "assistant")).orderBy(F.desc("raw_content")).collect()
    assert (a["system"], a["user"], a["redactions"]) == (None, "mail <REDACTED_EMAIL>\n\nnow", {"email": 2}) and "<REDACTED_EMAIL>" in a["assistant"] and "<p>" not in a["assistant"]
    assert (a["reason"], a["cleaning"]["language"], a["cleaning"]["version"], a["cleaning"]["pii_redactions"]) == (None, "en", 1, {"email": 2})
    assert (b["reason"], b["assistant"]) == ("too_short", None)
    trusted = cleaning.clean(df.drop("language"), language=F.lit("xx"), trusted=["s"]).first()
    assert trusted["reason"] is None and trusted["cleaning"]["language"] == "en"
    code = cleaning.clean(df.withColumn("category", F.lit("dockerfile")), language=F.lit("xx")).first()
    assert code["cleaning"]["language"] == "code"


def test_sources_are_isolated(spark):
    kinds = {"good": lambda s: spark.range(3), "bad": lambda s: 1 / 0}
    sources = {"a": {"kind": "good"}, "b": {"kind": "bad"}}
    got = extract.extract(kinds, sources, ["b", "a"])
    assert [(r["source"], r["status"]) for r in got] == [("b", "failed"), ("a", "complete")] and "ZeroDivisionError" in got[0]["error"] and got[1]["records"] == 3
    assert [r["status"] for r in extract.extract(kinds, sources, ["a"], dry_run=True)] == ["planned"]
    with pytest.raises(ValueError):
        extract.extract(kinds, {"c": {"kind": "odd"}}, ["c"])


def test_repository_licences(spark):
    got = [r[0] for r in spark.createDataFrame([("mit",), ("NOASSERTION",), (" ",), (None,), ("Zlib",)], "s string").select(extract.repository_license(F.col("s"), {"mit": "MIT"})).collect()]
    assert got == ["MIT", None, None, None, "Zlib"]


def test_chat_records_by_offset(spark, tmp_path):
    good = {"messages": [{"role": r, "content": r} for r in ("system", "user", "assistant")], "meta": {"source": "s", "category": "concepto", "license": "MIT", "url": "u"}}
    lines = [json.dumps(good | {"n": i}) for i in range(6)]
    (tmp_path / "a.jsonl").write_text("\n".join([lines[0], "", *lines[1:]]) + "\n")
    schema = "messages array<struct<role string, content string>>, meta struct<source string, category string, license string, url string>, n int"
    df = jsonl.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema)
    assert [r["n"] for r in training.load_chat(df, offset=2, limit=3).collect()] == [2, 3, 4]
    with pytest.raises(ValueError, match="no chat records"):
        training.load_chat(df, offset=9)
    with pytest.raises(ValueError, match="invalid chat record at \\(0, 4\\)"):
        training.load_chat(df.withColumn("messages", F.when(F.col("n") == 3, F.slice("messages", 1, 2)).otherwise(F.col("messages"))))
    shown = training.formatted(df).first()
    assert shown["text"] == "<|im_start|>system\nsystem<|im_end|>\n<|im_start|>user\nuser<|im_end|>\n<|im_start|>assistant\nassistant<|im_end|>\n"
    with pytest.raises(Exception, match="renders to an empty text"):
        training.formatted(df.withColumn("messages", F.slice("messages", 1, 0))).collect()
    hashes = spark.createDataFrame([(i, f"h{i}") for i in range(30)], "i int, content_hash string").repartition(4)
    want = hashlib.sha256(json.dumps([f"h{i}" for i in range(30)], separators=(",", ":")).encode()).hexdigest()
    assert training.ordered_fingerprint(hashes, ["i"]) == want


def test_derived_files_keep_their_bytes(spark, tmp_path):
    lines = [f'{{"meta":  {{"content_hash": "h{i}"}}, "ñ": {i}}}' for i in range(40)]
    (tmp_path / "train.jsonl").write_text("\n".join(lines) + "\n\n")
    gone = spark.createDataFrame([("h3",), ("h17",)], "key string")
    out = str(tmp_path / "out")
    made = jsonl.derive(spark, str(tmp_path / "train.jsonl"), gone, out)
    kept = "".join(x + "\n" for i, x in enumerate(lines) if i not in (3, 17)).encode()
    assert made["output"] == {"records": 38, "bytes": len(kept), "sha256": hashlib.sha256(kept).hexdigest()} and made["excluded"] == {"records": 2, "unique_hashes": 2}
    assert jsonl.proves_derivation(spark, made, str(tmp_path / "train.jsonl"), gone, out, str(tmp_path / "again")) == []
    assert jsonl.proves_derivation(spark, made, str(tmp_path / "train.jsonl"), gone.limit(1), out, str(tmp_path / "again")) == ["excluded_changed"]
    with pytest.raises(ValueError):
        jsonl.derive(spark, str(tmp_path / "train.jsonl"), spark.createDataFrame([("no",)], "key string"), out)


def test_lines_are_numbered_over_files_and_blocks(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text("".join(f'{{"n": {i}, "pad": "{"x" * 50}"}}\n' for i in range(500)))
    (tmp_path / "a.jsonl").write_text('{"n": 0}\n\n{"n": 2}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = jsonl.read_glob(spark, str(tmp_path / "*.jsonl"), "n int").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r["ordinal"] == r["n"] for r in rows) and len(rows) == 502
    assert {r["file_name"].rsplit("/", 1)[1]: r["input_rank"] for r in rows} == {"a.jsonl": 0, "b.jsonl": 1}


def test_gates_before_training():
    statistics_ = {"provisional": False, "outputs": {n: {"sha256": n} for n in ("train", "validation", "test")}}
    found = {n: n for n in ("train", "validation", "test")}
    assert training.final_split_problems(statistics_, found) == []
    assert training.final_split_problems(statistics_ | {"provisional": True}, found | {"test": None, "validation": "x"}) == ["provisional", "validation:changed", "test:missing"]
    assert training.final_split_problems(statistics_, found | {"train": "d"}, {"parent_sha256": "train", "sha256": "d"}) == []
    assert training.final_split_problems(statistics_, found | {"train": "d"}, {"parent_sha256": "old", "sha256": "d"}) == ["train:other_parent"]
    assert training.final_split_problems(statistics_, found | {"validation": "r"}, None, {"original_sha256": "validation", "sha256": "r"}) == []
    assert training.baseline_problems(None, {}) == ["baseline:missing"] and training.baseline_problems({"provisional": False, "test_sha256": "test"}, statistics_) == []
    assert training.review_problems({"status": "draft", "sample_sha256": "a"}, "b") == ["review:not_approved", "sample:changed"]


def test_hard_tests_need_enough_sources(spark):
    rows = [(f"h{i}", "troubleshooting" if i % 2 else "concepto", f"s{i % 3}", i % 4, i == 9) for i in range(40)]
    df = spark.createDataFrame(rows, "content_hash string, category string, source string, score int, explicit boolean")
    got = split.hard_test(df, 40, "troubleshooting", 2, 50, 0.25, 3, 1).collect()
    assert len(got) == 10 and "h9" in {r["content_hash"] for r in got} and all(r["category"] == "troubleshooting" and r["score"] >= 1 for r in got)
    with pytest.raises(ValueError, match="required"):
        split.hard_test(df, 400, "troubleshooting", 2, 200, 0.25, 3, 1)
    with pytest.raises(ValueError, match="sources"):
        split.hard_test(df, 40, "troubleshooting", 2, 50, 0.25, 4, 1)


def test_probe_problems(spark):
    rows = [("a", "h1"), ("a", "h1"), ("b", ""), ("z", "h4"), ("a", "h5")]
    df = spark.createDataFrame(rows, "category string, content_hash string")
    held = spark.createDataFrame([("h5",)], "content_hash string")
    got = {r["issue"]: r["rows"] for r in probes.probe_problems(df, ["a", "b", "c"], 2, held).collect()}
    assert got == {"unknown_group": 1, "blank_id": 1, "repeated_id": 1, "missing_group": 1, "small_group": 1, "held_out": 1}


def test_served_models(spark):
    m = spark.createDataFrame([("models/q4/model.gguf",), ("other/model.gguf",)], "path string")
    assert evaluation.served_entry(m, "D:\\repo\\Models\\q4\\model.gguf") == {"path": "models/q4/model.gguf"}
    for served in ("", "x/model.gguf", "xmodels/q4/model.gguf"):
        with pytest.raises(ValueError):
            evaluation.served_entry(m, served)


def test_retries_must_be_those_asked_for(spark):
    r = evaluation.normalized_generation(spark.createDataFrame([("a", "p", 5, False, 1), ("b", "q", 5, False, 0)], "content_hash string, prediction string, completion_tokens int, truncated boolean, retry_count int"))
    new = spark.createDataFrame([("a", "n", 8, None)], "content_hash string, prediction string, completion_tokens int, finished_eos boolean")
    got = {x["content_hash"]: x for x in evaluation.merge_retries(r, new, 8).collect()}
    assert (got["a"]["prediction"], got["a"]["generated_completion_tokens_total"], got["a"]["truncated"], got["b"]["prediction"], got["b"]["selective_retry_applied"]) == ("n", 16, True, "q", False)
    with pytest.raises(ValueError):
        evaluation.merge_retries(r, new.withColumn("content_hash", F.lit("b")), 8)


def test_score_coverage_and_judge_manifest(spark):
    p = spark.createDataFrame([("a", "dockerfile", None), ("b", "dockerfile", "e"), ("c", "concepto", None), ("d", "dockerfile", None)], "content_hash string, category string, error string")
    s = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("d", 0.5)], "content_hash string, syntax_valid double")
    assert sorted(tuple(r) for r in evaluation.score_coverage(p, s, ["dockerfile"]).collect()) == [("b", "unexpected"), ("d", "not_binary")]
    m = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "content_hash string")
    assert {r["issue"]: r["rows"] for r in evaluation.judged_hashes_problems(m, p, 3).collect()} == {"other_count": 1, "blank": 1, "repeated": 1, "unknown": 1}


def test_boundaries(spark):
    texts = spark.createDataFrame([(f"h{i}", "t" * i) for i in range(5)], "content_hash string, text string")
    v = models.encode(texts, lambda: lambda ts: [[3.0, 4.0] for _ in ts], size=2).collect()
    assert len(v) == 5 and v[0]["embedding"] == pytest.approx([0.6, 0.8])
    asked = spark.createDataFrame([("a", [("user", "hello there")]), ("b", [("user", "hi")])], "content_hash string, messages array<struct<role string, content string>>")
    got = {r["content_hash"]: r for r in models.generate(asked, clients.backend, {"max_new_tokens": 9}, 1.2, 8).collect()}
    assert (got["a"]["retry_count"], got["a"]["generated_completion_tokens_total"], got["a"]["latency_seconds"], got["a"]["truncated"]) == (1, 11, 1.0, False)
    assert (got["b"]["retry_count"], got["b"]["completion_tokens"], got["b"]["error"]) == (0, 2, None)
    assert models.generate(asked, clients.failing, {"max_new_tokens": 9}).where("error like 'OSError%'").count() == 2
    rows = spark.createDataFrame([("a", "q", "r", "c"), ("b", "q", "r", "c")], "content_hash string, question string, reference string, candidate string")
    known = spark.createDataFrame([("a", "v1", "old"), ("b", "v0", "old")], "content_hash string, runtime string, payload string")
    assert {r["content_hash"]: r["payload"] == "old" for r in models.judge(rows, known, clients.judge, "v1").collect()} == {"a": True, "b": False}
    c = spark.createDataFrame([("1.Dockerfile", "FROM a\nRUN b"), ("2.Dockerfile", "FROM a")], "name string, content string")
    tool, read = clients.validator()
    assert {r["name"]: r["failure"] for r in models.check_files(c, lambda: tool, read).collect()} == {"1.Dockerfile": "rejected", "2.Dockerfile": None}
    with pytest.raises(Exception, match="ended with 2"):
        models.check_files(c, lambda: lambda f: (2, "broken"), read).collect()


def test_trees_and_manifests(spark, tmp_path):
    for name in ("docs/a/index.md", "docs/b/index.md", "docs/b/skip.md", "x.txt"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(f"# C#\n\n{name} " + "words " * 80)
    root = str(tmp_path)
    found = files.markdown_files(spark, root, ["docs/**/*.md"], ["*skip*"])
    assert sorted(r["path"] for r in found.collect()) == ["docs/a/index.md", "docs/b/index.md"]
    made = files.markdown_records(files.markdown_chunks(found, 40, 4000, 10, "r1"), "s", "https://github.com/o/r.git", "r1", "MIT", F.lit("concepto"), most=1).collect()
    assert [(r["title"], r["url"]) for r in made] == [("C#", "https://github.com/o/r/blob/r1/docs/a/index.md")]
    manifest = files.directory_manifest(spark, root)
    kept = spark.createDataFrame(manifest.collect(), manifest.schema)
    assert files.directory_mismatches(spark, root, kept).isEmpty()
    (tmp_path / "docs/a/index.md").write_text("changed")
    assert [r["path"] for r in files.directory_mismatches(spark, root, kept).collect()] == ["docs/a/index.md"]
    assert files.index_records(spark, root + "/none", root, "s", "https://h/r", "r").count() == 3


def test_front_matter_only_at_the_top():
    assert [t for t, _ in files.chunk_markdown("---\na: 1\n---\n# Top ##\n\n" + "w " * 50, 10, 500, 0)] == ["Top ##"]
    assert files.chunk_markdown("---\na: 1\n---", 1, 500, 0) == [("Untitled", "---\na: 1\n---")]


def test_folders_are_recreated_inside_their_root(spark, tmp_path):
    (tmp_path / "w" / "old").mkdir(parents=True)
    sinks.recreate(spark, str(tmp_path / "w"), str(tmp_path))
    assert list((tmp_path / "w").iterdir()) == []
    for path in (tmp_path, tmp_path / "w" / ".." / "..", tmp_path.parent / "other"):
        with pytest.raises(ValueError):
            sinks.recreate(spark, str(path), str(tmp_path))
    c = spark.createDataFrame([("000001-x.yaml", "kind: Pod\n"), ("n", None)], "name string, content string")
    assert sinks.write_candidates(c, str(tmp_path / "w"), str(tmp_path)) == 1 and (tmp_path / "w" / "000001-x.yaml").read_text() == "kind: Pod\n"


def test_vectors_are_encoded_once(spark, tmp_path):
    seen = []

    def encode(df):
        seen.append(df.count())
        return df.select("content_hash", F.array(F.lit(1.0)).alias("embedding"))

    t = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "x")], "content_hash string, text string")
    assert sinks.cached_vectors(spark, str(tmp_path / "v"), t.limit(1), encode).count() == 1
    assert sinks.cached_vectors(spark, str(tmp_path / "v"), t, encode).count() == 2 and seen == [1, 1]


def test_report_texts(spark):
    rows = [("l", "latency_seconds", None, 2.0, 1.0, 3.0), ("r", "latency_seconds", None, 3.0, None, None), ("l", "exact_match", "c", 0.5, 0.4, 0.6), ("r", "exact_match", "c", 0.6, 0.5, 0.7)]
    m = spark.createDataFrame(rows, "variant string, metric string, category string, mean double, ci95_low double, ci95_high double")
    out = sinks.comparison(m, "l", "r", {"r": (0.02, 0.01)}, {"r": {"backend": "b", "versions": {"x": 1}}})
    assert "| latency_seconds | 2.0000 [1.0000, 3.0000] | 3.0000 | +50.00% | yes |" in out and "+10.00 pp | no |" in out and "FAIL (2.00% of at most 1.00%)" in out and "b / x 1" in out
    assert sinks.loss_chart([(0, 2.0), (1, 1.0)]).count(",") == 2 and sinks.loss_chart([]).startswith("<svg")
    licences = spark.createDataFrame([("MIT",), ("X",), ("MIT",)], "license string")
    assert "| MIT | https://m | 2 |" in sinks.licenses_section(licences, {"MIT": "https://m"}) and "| X | n/a | 1 |" in sinks.licenses_section(licences, {})


def test_audit_of_nothing_measured(spark):
    rows = [("g", None, 3, 1.0, 0, False, ["a"]), ("g", 0.1, 5, 2.0, 4, True, []), ("h", None, 1, 1.0, 0, False, [])]
    df = spark.createDataFrame(rows, "k string, term_recall double, answer_words int, length_ratio double, bullets int, starts_with_heading boolean, flags array<string>")
    got = {r["k"]: r for r in stats.audit_summary(df, ["k"], ["a", "b"]).collect()}
    assert (got["g"]["records"], got["g"]["answer_words_median"], got["g"]["answer_words_p90"], got["g"]["low_term_recall_rate"], got["g"]["flag_rates"]) == (2, 4.0, 5, 1.0, {"a": 0.5})
    assert got["h"]["term_recall_median"] is None and got["h"]["low_term_recall_rate"] is None


class _Words(HTMLParser):
    """The words that a reader sees, for a look at the conversion."""

    def __init__(self):
        super().__init__()
        self.words, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.off:
            self.words += data.split()


def test_pages_keep_their_words(spark):
    raw = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in catalogue.QUERIES["html_to_text_pages"](spark, SF).collect():
        want = _Words()
        want.feed(raw[r["page_id"]])
        assert r["text"].replace("`", "").split() == " ".join(want.words).replace("`", "").split()


def test_chunks_of_the_fixture(spark):
    rows = catalogue.QUERIES["markdown_chunks"](spark, SF).collect()
    docs = {f"doc-{r['doc_id']}": r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    squeeze = lambda x: "".join(x.split())
    for r in rows:
        assert 200 <= len(r["chunk"]) <= 2000
        assert squeeze(r["chunk"].split("\n\n", 1)[-1][-50:]) in squeeze(f"# Title {r['path'][4:]}" + docs[r["path"]])


def test_blocks_of_the_fixture(spark):
    for r in catalogue.QUERIES["extract_blocks"](spark, SF).collect():
        kind = r["conv_id"] % 3
        assert (r["yaml"] is not None, r["dockerfile"] is not None) == (kind == 0, kind == 1)


def test_tool_results_are_tolerant(spark):
    cases = {"": [], "  ": [], '[{"a": 1}, 3]': [{"a": 1}], '{"a": 2}': [{"a": 2}], "3": [], 'x\n{"a": 4}\n[1]\n': [{"a": 4}], "[]": []}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r["t"]: [json.loads(x) for x in r["x"]] for r in df.select("t", F.transform(text.tool_results(F.col("t")), lambda v: F.to_json(v)).alias("x")).collect()}
    assert got == cases


def test_every_command(spark, tmp_path, capsys):
    run = lambda *a: cli.main([*map(str, a)], spark)
    turn = lambda u, a: [{"role": r, "content": c} for r, c in (("system", "s"), ("user", u), ("assistant", a))]
    rows = [(f"h{i}", turn(f"question {i}", "FROM a\nRUN b" if i % 2 else "answer"), {"source": "s", "category": "concepto", "license": "MIT", "url": "u"}, "concepto", "s", 0, i, [1.0, 0.0] if i < 2 else [0.0, 1.0 * i]) for i in range(8)]
    schema = "content_hash string, messages array<struct<role string, content string>>, meta struct<source string, category string, license string, url string>, category string, source string, input_rank int, ordinal int, embedding array<double>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "chat"))
    assert run("dedupe", "--input", tmp_path / "chat", "--output", tmp_path / "exact") == 0 and spark.read.parquet(str(tmp_path / "exact")).count() == 8
    assert run("dedupe", "--mode", "approximate", "--input", tmp_path / "chat", "--output", tmp_path / "near") == 0
    assert spark.read.parquet(str(tmp_path / "near")).select("semantic_cluster_id").distinct().count() == 2
    assert run("validate-dataset", "--input", tmp_path / "chat", "--output", tmp_path / "valid", "--client", "clients:validator") == 0
    assert {r["status"] for r in spark.read.parquet(str(tmp_path / "valid")).collect()} == {"rejected", "not_applicable"}
    assert run("train", "--input", tmp_path / "chat", "--output", tmp_path / "train", "--offset", 2, "--limit", 4) == 0 and spark.read.parquet(str(tmp_path / "train")).count() == 4
    assert run("benchmark", "--input", tmp_path / "chat", "--output", tmp_path / "base", "--client", "clients:backend", "--most", 9) == 0
    logged = ("--input", tmp_path / "chat", "--client", "clients:backend", "--most", 9, "--log", tmp_path / "log", "--slice", 3)
    assert run("benchmark", *logged, "--output", tmp_path / "base2") == 0 and run("benchmark", *logged, "--output", tmp_path / "base3") == 0
    told = lambda name: {(r["content_hash"], r["prediction"]) for r in spark.read.parquet(str(tmp_path / name)).collect()}
    assert told("base3") == told("base") and len(list((tmp_path / "log").glob("slice-*"))) == 3
    assert run("benchmark", *logged, "--penalty", 1.5, "--output", tmp_path / "base4") == 2
    scored = spark.read.parquet(str(tmp_path / "base")).withColumns({"category": F.lit("dockerfile"), "question": F.lit("q"), "reference": F.lit("r"), "exact_match": F.lit(None).cast("double"), "semantic_similarity": F.lit(0.5), "judge": F.struct(F.lit(3.0).alias("mean")), "tokens_per_second": F.lit(1.0), "batch_tokens_per_second": F.lit(1.0)})
    scored.write.parquet(str(tmp_path / "results"))
    assert run("benchmark-syntax", "--input", tmp_path / "results", "--output", tmp_path / "syntax") == 0
    assert run("benchmark-judge", "--input", tmp_path / "results", "--output", tmp_path / "judged", "--client", "clients:judge", "--runtime", "v1") == 0
    assert spark.read.parquet(str(tmp_path / "judged")).first()["judge"]["mean"] == 3.0
    assert run("report", "--baseline", tmp_path / "syntax", "--finetuned", tmp_path / "syntax", "--output", tmp_path / "report.md", "--allow-provisional") == 0 and "## Overall" in (tmp_path / "report.md").read_text()
    spark.createDataFrame([("direct_pair", "q", "a"), ("reverse_instruction", None, None)], "normalization string, user string, assistant string").withColumns({"source": F.lit("s"), "category": F.lit("concepto"), "raw_content": F.lit("some text"), "source_record_id": F.lit("r1")}).write.parquet(str(tmp_path / "interim"))
    assert run("normalize", "--input", tmp_path / "interim", "--output", tmp_path / "direct") == 0 and spark.read.parquet(str(tmp_path / "direct")).count() == 1
    assert run("normalize", "--mode", "prepare-sample", "--input", tmp_path / "interim", "--output", tmp_path / "sample") == 0
    assert run("normalize-generate", "--input", tmp_path / "sample", "--output", tmp_path / "made", "--client", "clients:instructions") == 0 and spark.read.parquet(str(tmp_path / "made")).first()["user"] == "Ask about some text"
    (tmp_path / "review.json").write_text('{"status": "draft"}')
    assert run("normalize-generate", "--scope", "full", "--review", tmp_path / "review.json", "--input", tmp_path / "sample", "--output", tmp_path / "all", "--client", "clients:instructions") == 2
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.md").write_text("# A\n\n" + "words " * 100)
    (tmp_path / "sources.json").write_text(json.dumps({"sources": {"m": {"kind": "markdown", "path": str(tmp_path / "docs"), "tier": 1, "license": "MIT"}, "gone": {"kind": "parquet", "path": str(tmp_path / "none"), "tier": 1}}}))
    assert run("extract", "--config", tmp_path / "sources.json", "--source", "m", "--output", tmp_path / "raw") == 0 and spark.read.parquet(str(tmp_path / "raw" / "m")).count() == 1
    assert run("extract", "--config", tmp_path / "sources.json", "--output", tmp_path / "raw2") == 2 and run("extract", "--config", tmp_path / "sources.json", "--output", tmp_path / "raw3", "--dry-run") == 0
    assert run("config-validate", tmp_path / "sources.json") == 0
    (tmp_path / "bad.json").write_text('{"ratios": {"train": 1}}')
    assert run("config-validate", tmp_path / "bad.json") == 2
