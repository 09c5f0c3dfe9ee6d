from pyspark.sql import functions as F

from sparkloom.functions import quality, text

FENCE = "```"


def one(spark, value, f, name="t"):
    return spark.createDataFrame([(value,)], f"{name} string").select(f(F.col(name)).alias("x")).first()["x"]


def test_markup_becomes_text(spark):
    page = "<html><style>p{}</style><h2>Ports</h2><script>x()</script><p>Use <code>ss -lt</code> first</p><pre>\nlisten 8443\nlisten 80\n</pre></html>"
    out = one(spark, page, text.html_to_text)
    assert out.split() == ["Ports", "Use", "`ss", "-lt`", "first", FENCE, "listen", "8443", "listen", "80", FENCE]
    assert one(spark, "3 < 5 and 7 > 2", text.html_to_text) == "3 < 5 and 7 > 2"
    assert one(spark, None, text.html_to_text) is None


def test_fences_are_balanced(spark):
    for lines in (["one", FENCE, "two"], [FENCE, "a", FENCE, "b", FENCE, "c  "]):
        fixed = one(spark, "\n".join(lines), text.repair_fences)
        assert sum(x.strip().startswith(FENCE) for x in fixed.splitlines()) % 2 == 0 and fixed.splitlines()[: len(lines) - 1] == lines[:-1]
    assert FENCE not in one(spark, f"before\n{FENCE} {FENCE}\nafter", text.repair_fences)


def test_normalize_drops_boilerplate_and_blank_runs(spark):
    assert one(spark, "Edit this page\r\nkeep  \r\n\r\n\r\n\r\nend\nNext\n", text.normalize_text) == "keep\n\nend"


def test_lines_are_those_of_python(spark):
    for value in ("a\nb\n", "a\r\nb\rc", "", "x y\x1cz", "\n\n"):
        assert one(spark, value, text.lines_of) == value.splitlines(), repr(value)


def test_strip_is_that_of_python(spark):
    for value in (" \t a b \n", "", "  ", "ñ "):
        assert one(spark, value, text.py_strip) == value.strip(), repr(value)


def test_redaction_counts_by_kind(spark):
    r = spark.createDataFrame([("write to a.b@example.com or 192.168.1.7, Bearer abcdefghijklmnop1234",)], "t string").select(*(c.alias(n) for n, c in zip(("t", "n"), text.redact(F.col("t")), strict=True))).first()
    assert r["t"] == "write to <REDACTED_EMAIL> or <REDACTED_PRIVATE_IPV4>, Bearer <REDACTED_BEARER_TOKEN>"
    assert r["n"] == {"email": 1, "private_ipv4": 1, "bearer_token": 1}


def messages(user, assistant, system="s"):
    return [{"role": "system", "content": system}, {"role": "user", "content": user}, {"role": "assistant", "content": assistant}]


def test_canonical_hash_ignores_system_and_line_ends(spark):
    rows = [(messages("q", "a  \r\nb"),), (messages("q", "a\nb", "other"),), (messages("q", "a\nc"),)]
    df = spark.createDataFrame(rows, "messages array<struct<role string, content string>>")
    h = [r["h"] for r in df.select(text.sha(text.canonical_content(F.col("messages"))).alias("h")).collect()]
    assert h[0] == h[1] != h[2]
    assert df.select(text.semantic_text(F.col("messages")).alias("x")).first()["x"] == "q\n\na  \r\nb"


def test_nfkc(spark):
    assert one(spark, "ﬁ①", text.nfkc) == "fi1"


def test_licences(spark):
    df = spark.createDataFrame([(["mit", "apache 2.0", "MIT", None],)], "l array<string>")
    ids = text.spdx(F.col("l"), {"mit": "MIT", "apache 2.0": "Apache-2.0"})
    assert df.select(ids.alias("x")).first()["x"] == ["MIT", "Apache-2.0"]
    assert df.select(text.first_allowed(ids, ["Apache-2.0"]).alias("x")).first()["x"] == "Apache-2.0"


def test_blocks(spark):
    assert one(spark, f"x\n{FENCE}yaml\nkind: Pod\n{FENCE}\n{FENCE}yml\na: 1\n{FENCE}", text.extract_yaml) == "kind: Pod\n---\na: 1"
    assert one(spark, "apiVersion: v1\nkind: Pod", text.extract_yaml) == "apiVersion: v1\nkind: Pod"
    assert one(spark, "From now on\nwe go", text.extract_dockerfile) is None
    assert one(spark, f"{FENCE}\nFROM a\nRUN b\n{FENCE}\n{FENCE}bash\nls\n{FENCE}", text.extract_dockerfile) == "FROM a\nRUN b"


def test_generated_instruction(spark):
    ok = one(spark, f'{FENCE}json\n{{"user": " Explain pods "}}\n{FENCE}', text.parse_generated_user)
    assert (ok["user"], ok["reason"]) == ("Explain pods", None)
    for bad, why in (("no", "invalid_json"), ("[1]", "missing_user"), ('{"user": ""}', "missing_user"), ('{"user": "Resume el fragmento proporcionado"}', "not_self_contained"), ('{"user": "Según el informe, di"}', "not_self_contained")):
        assert one(spark, bad, text.parse_generated_user)["reason"] == why, bad


def test_canonical_answer(spark):
    assert one(spark, f"{FENCE}bash\nls   -l \n\n pwd\n{FENCE}", text.canonical_answer) == "ls -l\npwd"


def test_repeated_ngrams(spark):
    assert one(spark, "a b c d", lambda c: quality.repeated_ngram_ratio(c, 2)) == 0.0
    assert one(spark, "a b a b", lambda c: quality.repeated_ngram_ratio(c, 2)) == 1 / 3
    assert one(spark, "a", lambda c: quality.repeated_ngram_ratio(c, 2)) == 0.0


def test_flags_of_a_changelog(spark):
    answer = "## Bug fixes\n" + "\n".join(f"- fix {i} (#12{i})" for i in range(12))
    df = spark.createDataFrame([("What does it do?", answer, "concepto")], "q string, a string, c string").withColumns(quality.measure(F.col("q"), F.col("a"), F.col("c")))
    found = df.select(quality.flags().alias("f")).first()["f"]
    assert {"long_list", "release_notes", "narrow_question_list_answer", "ends_in_structure"} <= set(found)


def test_hard_features(spark):
    found = one(spark, "First check kubelet and CoreDNS: error in dns, although memory is fine", quality.hard_features)
    assert found[0] == "multiple_components" and len(found) >= 5
