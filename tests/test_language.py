"""Language detection: held-out accuracy, and scores against plain Python."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from sparkloom.operators import cleaning, language

DOCS = "/root/testdata/sf0.01/documents.parquet"


def labelled(spark, path=DOCS):
    return spark.read.parquet(path).select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language"))


def test_languages_of_texts_not_learnt_from(spark):
    rows = labelled(spark)
    told = language.detector(language.profile_of(language.train(rows.where("crc32(cast(id as string)) % 4 <> 2"))))
    out = rows.where("crc32(cast(id as string)) % 4 = 2").select("language", told(F.col("text")).alias("t")).cache()
    assert out.where("t.language = language").count() >= 0.97 * out.count()
    assert out.where("t.probability between 0 and 1").count() == out.count()


def plain(rows, texts):
    """(language, probability) of texts by the rule, one n-gram at a time; rows: (text, language)."""
    ready = lambda t: " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
    grams = lambda t: [t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)]
    counts = defaultdict(Counter)
    for text, name in rows:
        counts[name].update(grams(ready(text)))
    top = {g for c in counts.values() for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[: language.GRAMS]}
    total = {name: sum(n for g, n in c.items() if g in top) for name, c in counts.items()}
    weight = {(name, g): round(math.log((counts[name][g] + 0.5) / (total[name] + 0.5 * len(top))) * language.UNIT) for name in counts for g in top}
    out = []
    for text in texts:
        known = [g for g in grams(ready(text or "")) if g in top] if text is not None else []
        sums = {name: sum(weight[name, g] for g in known) for name in counts}
        if not known:
            out.append((None, 0.0))
            continue
        best = min(sums, key=lambda name: (-sums[name], hashlib.sha256(f"3407:{name}".encode()).hexdigest()))
        scale = min(len(known), language.EVIDENCE) / len(known) / language.UNIT
        out.append((best, 1 / sum(math.exp((s - sums[best]) * scale) for s in sums.values())))
    return out


def test_scores_equal_plain_python(spark, monkeypatch):
    rows = [("The cat sat on the mat", "en"), ("El gato se sentó en la alfombra", "es"), ("Die Katze saß auf der Matte", "de"), ("the end", "en"), ("猫はマットの上", "ja"), (None, "en"), ("lost", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, text string, language string")
    profile = language.profile_of(language.train(df))
    texts = ["the mat", "la Alfombra!", "Straße", "猫", "", None, "12 34", "Ω", "the " * 5000, "cat gato Katze"]
    want = plain([r for r in rows if None not in r], texts)
    got = [tuple(r["t"]) for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", language.detector(profile)(F.col("t")).alias("t")).orderBy("i").select("t").collect()]
    for a, b in zip(got, want, strict=True):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-9, (a, b)
    monkeypatch.setattr(language, "AT_ONCE", 7)
    ready = [None if t is None else " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " " for t in texts[:-2]]
    assert profile.tell(ready)[0] == [b[0] for b in want[:-2]]


def test_equal_scores_go_by_the_seed_and_no_labels_tell_nothing(spark):
    df = spark.createDataFrame([(1, "ab ab", "x"), (2, "ab ab", "y"), (3, "ab ab", "z")], "id int, text string, language string")
    for seed in (1, 2, 3, 4):
        told = language.profile_of(language.train(df), seed).tell([" ab "])
        assert told[0] == [min("xyz", key=lambda n: hashlib.sha256(f"{seed}:{n}".encode()).hexdigest())] and abs(told[1][0] - 1 / 3) < 1e-9
    none = language.profile_of(language.train(df.limit(0)))
    assert none is None and df.select(language.detector(none)(F.col("text")).alias("t")).first()["t"]["language"] is None


def test_cleaning_asks_only_where_the_language_matters(spark):
    asked = spark.sparkContext.accumulator(0)

    @F.pandas_udf("language string, probability double")
    def told(texts):
        import pandas as pd

        asked.add(int(texts.notna().sum()))
        return pd.DataFrame({"language": ["en"] * len(texts), "probability": [0.9] * len(texts)})

    long = "plain words of a text that goes on and on " * 5
    rows = [(long, "s", "concepto"), (long, "trusted", "concepto"), (long, "s", "dockerfile"), ("short", "s", "concepto"), ("1 " * 60, "s", "concepto"), (long, None, None)]
    df = spark.createDataFrame(rows, "raw_content string, source string, category string")
    out = cleaning.clean(df, detector=told, trusted=["trusted"]).select("reason", "cleaning.language", "cleaning.language_probability").collect()
    assert asked.value == 2 and "_told" not in cleaning.clean(df, detector=told).columns
    assert [r["reason"] for r in out] == [None, None, None, "too_short", "language_not_allowed_or_uncertain", None]
    assert [r["language"] for r in out] == ["en", "en", "code", None, None, "en"]


def test_texts_that_are_not_chosen_do_not_move(spark):
    rows = [(i, ("en" if i % 2 else None if i % 10 == 0 else "es"), f"text {i % 400} " + "x" * 50) for i in range(1000)] + [(7, "en", "text 7 " + "x" * 50)] * 2 + [(None, "en", "no id")]
    df = spark.createDataFrame(rows, "id bigint, language string, text string").repartition(8)
    want = {}
    for i, lang, text in sorted(((i, lang, t) for i, lang, t in rows if lang), key=lambda r: (r[1], hashlib.sha256(r[2].encode()).hexdigest(), r[0] is not None, r[0])):
        want.setdefault(lang, []).append(text)
    for n in (37, 2000):
        some = language.first_texts(df, n)
        assert Counter(map(tuple, some.collect())) == Counter((lang, t) for lang, ts in want.items() for t in ts[:n])
    window = language.first_texts(df, 37)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in window  # what is ranked, without texts, is written before texts are read


def test_no_task_reads_all_hashes_of_a_language(spark):
    df = spark.range(60_000, numPartitions=8).select("id", F.lit("en").alias("language"), F.concat(F.lit("text "), F.when(F.col("id") < 5000, F.lit("alike")).otherwise(F.col("id").cast("string"))).alias("text"))
    store = spark.sparkContext._jsc.sc().statusStore()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("first-texts", "")
    try:
        got = Counter(r["text"] for r in language.first_texts(df, 1500).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.sparkContext._jsc.clearJobGroup()
    texts = ["text alike"] * 5000 + [f"text {i}" for i in range(5000, 60_000)]
    assert got == Counter(sorted(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())[:1500])
    track = spark.sparkContext.statusTracker()
    stages = {s for j in track.getJobIdsForGroup("first-texts") for s in track.getJobInfo(j).stageIds}
    tasks = [t for s in stages for t in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.taskList(s, 0, 1000))]
    assert tasks and max(t.taskMetrics().get().shuffleReadMetrics().recordsRead() for t in tasks if t.taskMetrics().isDefined()) < 45_000


def test_few_texts_are_decoded_at_once(monkeypatch):
    codes = np.array(sorted(language._code(g) for g in ("a", "b", "ab", " a")), np.int64)
    profile = language.Profile(["x", "y"], codes, np.array([[-1.0, -2], [-3, -1], [-2, -2], [-1, -5]]))
    texts, points, seen = [" ab ", None, "", " b a " * 30] * 25, language._points, []
    want = [profile.score([t]) for t in texts]
    monkeypatch.setattr(language, "AT_ONCE", 20)
    monkeypatch.setattr(language, "_points", lambda x: seen.append(sum(len(t or "") for t in x)) or points(x))
    total, known = profile.score(texts)
    assert max(seen) <= 320 and (total == np.concatenate([w[0] for w in want])).all() and (known == np.concatenate([w[1] for w in want])).all()
