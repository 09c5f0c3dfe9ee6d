"""Stages on hard tables, models against plain scorers, bounds of samples and memory."""

import itertools
import math
import random
import re
import resource
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm import decontamination, langid, line_dedup, near_dedup, quality, shared, toxicity

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CLASHES = ["n_lines", "n_removed", "lang_pred", "lang_score", "benchmark_items", "_row_key", "_removed", "_place", "row_key", "node", "digest", "kept", "class_id", "line", "part"]


def documents(spark, rows):
    """(doc_id, text) as a documents table with columns of every name that an operator uses inside."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df = df.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")})
    return df.withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("x"))) for c in CLASHES})


def sentence(rng, n=40):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def stage_rows(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, SF)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_hard_tables(spark, name):
    rng = random.Random(7)
    one, two = sentence(rng), sentence(rng)
    rows = [(0, one), (0, one), (1, two), (None, sentence(rng)), (2, None), (3, ""), (4, " \n "), (5, sentence(rng, 4000)), (6, one + "\n" + two), (6, sentence(rng)), (7, "!!! 123")]
    docs = documents(spark, rows)
    out = stage_rows(spark, name, docs)
    if name == "pack":
        assert out.agg(F.count_distinct("doc_id")).first()[0] == 8
    else:
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[c] == f"{c}-{'x' if r['doc_id'] is None else r['doc_id']}" for c in CLASHES), r
        kept = Counter(r["doc_id"] for r in out.collect())
        want = {
            "language_id": Counter({0: 2, 1: 1, None: 1, 5: 1, 6: 2}),
            "line_dedup": Counter({0: 2, 1: 1, None: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1}),
            "near_dedup": Counter({0: 1, 1: 1, None: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 2, 7: 1}),
            "decontaminate": Counter(d for d, _ in rows),
        }[name]
        if name == "line_dedup":  # of the two equal rows both keep their line; the text of 6 loses both of its lines
            assert kept == want
        else:
            assert kept == want
    assert stage_rows(spark, name, documents(spark, [])).count() == 0


def test_no_language_to_learn_from_keeps_texts(spark):
    docs = documents(spark, [(0, "some words"), (1, "123"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert [r["doc_id"] for r in stage_rows(spark, "language_id", docs).collect()] == [0]


def test_ids_with_unrelated_texts_are_classes_of_their_own(spark):
    rng = random.Random(11)
    a, b = sentence(rng, 120), sentence(rng, 120)
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, "?"), (4, "!")]
    kept = stage_rows(spark, "near_dedup", documents(spark, rows)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(1, a), (1, b), (4, "?"), (4, "!")])


def test_pipeline_against_brute_force(spark):
    """Stages two to four over a small table, each against a plain version of its rule."""
    rng = random.Random(5)
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if len(r["text"]) > 120)
    base = [sentence(rng, 100) for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20 + i, t[:-9]) for i, t in enumerate(base[:4])]
    rows += [(30, f"{sentence(rng)} {item} {sentence(rng)}"), (31, f"{sentence(rng)}\n{base[7]}\n{sentence(rng)}")]
    docs = documents(spark, rows)
    lines = [(d, k, line_dedup.normal(x)) for d, t in rows for k, x in enumerate(t.split("\n"))]
    grams = [{x[i : i + 8] for i in range(len(x) - 7)} for _, _, x in lines]
    gone = {lines[j][:2] for i in range(len(lines)) for j in range(len(lines)) if i != j and lines[i][:2] < lines[j][:2] and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])}
    after = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows}
    after = {d: t for d, t in after.items() if t.strip()}
    two = shared.stage(stage_rows(spark, "line_dedup", docs), "two")
    assert {r["doc_id"]: r["text"] for r in two.collect()} == after
    words = {d: re.findall("[a-z0-9]+", t.lower()) for d, t in after.items()}
    shingles = {d: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for d, w in words.items()}
    df = Counter(s for c in shingles.values() for s in c)
    idf = {s: math.log((len(after) + 1) / (n + 1)) + 1e-3 for s, n in df.items()}

    def like(a, b):
        weigh = lambda c: sum(n * idf[s] for s, n in c.items())
        return weigh(a & b) / weigh(a | b)

    kept = [d for d in sorted(after) if not any(e < d and like(shingles[d], shingles[e]) >= 0.8 for e in after)]
    three = shared.stage(stage_rows(spark, "near_dedup", two), "three")
    assert sorted(r["doc_id"] for r in three.collect()) == kept
    four = stage_rows(spark, "decontaminate", three)
    assert sorted(r["doc_id"] for r in four.collect()) == [d for d in kept if d != 30]


# ---------------------------------------------------------------- plain scorers


def test_network_equals_a_plain_one():
    """Every filter at every place, one after the other, from embeddings and filters tabulated place by place."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(30)) + (" trash" if k % 4 == 0 else "") for k in range(120)]
    m = toxicity.fit(texts, np.array([int(k % 4 == 0) for k in range(120)]))
    for text in [*texts[:5], "", None, "trash", "alpha trash"]:
        words, _ = shared.word_hashes([text])
        ids = [int(w) % toxicity.BUCKETS for w in words]
        z = m.out_bias
        for w, places in enumerate(m.tables):
            for f in range(m.bias.shape[1]):
                at = [sum(float(places[k][ids[i + k]][f]) for k in range(len(places))) + float(m.bias[w][f]) for i in range(len(ids) - len(places) + 1)]
                z += float(m.out[w][f]) * max(0.0, *at) if at else 0.0
        lang = toxicity.languages(*shared.word_hashes([text]))[0]
        assert toxicity.score([text], m)[0] == pytest.approx(1 / (1 + math.exp(-(z - m.shift[lang]))), abs=1e-5)


def test_language_scores_equal_a_plain_forward_sum():
    texts = ["the cat and the dog", "der hund und die katze", "the house", "das haus der katze"]
    pieces = ["▁the", "▁", "t", "h", "e", "he", "▁der", "d", "r", "er", "a", "s", "c", "ca", "at", "u", "n", "und", "▁und", "k", "z", "o", "g", "i"]
    m = langid.fit(texts, ["en", "de", "en", "de"], pieces, rounds=2)
    known = {p: k for k, p in enumerate(pieces)}

    def word(w, column):
        w = langid.WORD_START + w
        total = [1.0] + [0.0] * len(w)
        for end in range(1, len(w) + 1):
            for start in range(end):
                part = w[start:end]
                if part in known:
                    total[end] += total[start] * m.p[known[part], column]
                elif end == start + 1:
                    total[end] += total[start] * langid.UNKNOWN
        return math.log(total[-1])

    for text in ["the dog und", "haus", "xyz the"]:
        want = [sum(word(w, k) for w in langid.words_of(text)) for k in range(2)]
        assert langid.score([text], m)[0] == pytest.approx(want, rel=1e-9)


def test_long_words_are_learnt():
    """A sentence without spaces is one word of many letters."""
    a, b = "我们今天在北京的公园里看见了很多美丽的花朵和高大的树木还有可爱的小鸟", "わたしたちはきょうとうきょうのこうえんでたくさんのうつくしいはなをみました"
    assert len(a) > 24 and len(b) > 24
    m = langid.fit([a, b], ["zh", "ja"], sorted(set(a + b)) + [langid.WORD_START], rounds=3)
    p = dict(zip([*sorted(set(a + b)), langid.WORD_START], m.p[:-1], strict=True))
    zh, ja = m.languages.index("zh"), m.languages.index("ja")
    assert p["我"][zh] > 3 * p["我"][ja] and p["た"][ja] > 3 * p["た"][zh]
    assert (langid.score(["我们在公园", "きょうはなを"], m).argmax(axis=1) == [zh, ja]).all()
    huge = langid.score(["x" * 3000, a * 40], m)
    assert np.isfinite(huge).all()


def test_quality_scores_equal_a_plain_mean():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(20)) + (" good" if k % 2 else " bad") for k in range(80)]
    m = quality.fit(texts, np.arange(80) % 2)
    for text in [*texts[:4], "", None, "good"]:
        found = [int(b) for _, bucket in quality.features([text], m.buckets, m.ngrams) for b in bucket]
        z = sum(m.weight[b] for b in found) / max(1, len(found)) + m.bias
        assert quality.score([text], m)[0] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


# ---------------------------------------------------------------- bounds


def test_samples_are_bounded_by_rows_and_bytes(spark):
    rows = spark.createDataFrame([(7, "a", "same")] * 5000 + [(i, "b", f"text {i}") for i in range(900)], "doc_id bigint, label string, text string")
    got = shared.sampled_texts(rows, 100)
    n = Counter(label for _, label in got)
    assert n["a"] == 100 and 60 <= n["b"] <= 100
    again = shared.sampled_texts(rows.repartition(9), 100)
    assert got == again
    small = shared.sampled_texts(rows.withColumn("text", F.concat("text", F.lit("x" * 1000))), 100, most_bytes=40_000)
    assert sum(len(t) for t, _ in small) <= 40_000 and {label for _, label in small} == {"b"}


def test_conflicting_labels_count_by_the_greater(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, v) for i in range(40) for v in (0, int(i < 20))], "doc_id bigint, toxic int")
    texts, y = shared.labelled_texts(docs, labels, "toxic", 0, 5, 100)
    assert {t for t, v in zip(texts, y, strict=True) if v} == {t for t in texts if int(t[1:]) < 20} and len(texts) == len(set(texts))


def test_runs_of_one_letter_take_little_memory():
    index = decontamination.build([(1, "a" * 300), (2, "what is the capital of " + "france " * 8)] + [(10 + k, f"what is the capital of country number {k} in the list") for k in range(400)])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    t, i, _ = decontamination.found(["a" * 200_000, "what is the capital of " * 2000, "clean"], index)
    assert (0, 0) in set(zip(t.tolist(), i.tolist(), strict=True)) and 2 not in t
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 700_000  # kilobytes


def test_short_items_are_found_whole():
    items = [(1, "Who wrote it?"), (2, "two"), (3, "???"), (4, None), (5, "A longer item that goes by its windows and its edits"), (6, "who wrote")]
    index = decontamination.build(items)
    t, i, _ = decontamination.found(["He asked who WROTE it, twice", "who wrote him", "twofold", "one, two.", "", None], index)
    assert set(zip(t.tolist(), i.tolist(), strict=True)) == {(0, 0), (0, 5), (1, 5), (3, 1)}


def test_verbatim_passages_are_found_at_every_offset():
    rng = random.Random(3)
    item = sentence(rng, 60)[:224]
    index = decontamination.build([(1, item)])
    norm = bytes(decontamination.normalised([item])[0][:-1]).decode()
    missed = [a for a in range(len(norm) - 100) if not len(decontamination.found([f"zz yy {norm[a:a + 100]} xx qq"], index)[0])]
    assert not missed


def test_slices_do_not_change_what_is_found(monkeypatch):
    rng = random.Random(6)
    items = [(k, sentence(rng, rng.randint(10, 40))) for k in range(20)]
    texts = [f"{sentence(rng, 30)} {rng.choice(items)[1][:150]} {sentence(rng, 30)}" for _ in range(30)]
    index = decontamination.build(items)
    whole = [x.tolist() for x in decontamination.found(texts, index)[:2]]
    monkeypatch.setattr(decontamination, "PAIRS", 40)
    assert [x.tolist() for x in decontamination.found(texts, index)[:2]] == whole


@pytest.mark.parametrize("length", [20, 40, 80, 300])
def test_recall_of_lines_by_length(length):
    """Share of pairs at a Jaccard similarity of 0.8 to 0.9 that share a band, by length of line."""
    rng = random.Random(length)
    pairs = []
    while len(pairs) < 400:
        a = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(length)]
        b = a.copy()
        cut = rng.randint(1, max(2, length // 5))
        b = b[:-cut] if rng.random() < 0.7 else [*b[: length // 2], "_", *b[length // 2 :]]
        x, y = line_dedup.normal("".join(a)), line_dedup.normal("".join(b))
        s, t = ({z[i : i + 8] for i in range(max(1, len(z) - 7))} for z in (x, y))
        if 0.8 <= len(s & t) / len(s | t) <= 0.9:
            pairs.append((x, y))
    flat = [x for p in pairs for x in p]
    h, line = line_dedup.line_shingles(flat)
    key = line_dedup.band_keys(line_dedup.signatures(h, line, len(flat), line_dedup.BANDS * line_dedup.ROWS))
    met = (key[::2] == key[1::2]).any(axis=1).mean()
    assert met >= 0.97, met


def test_recall_of_near_documents():
    """Share of pairs at a weighted similarity of 0.8 to 0.85 that share a band, short and very long texts."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    for length, many in ((60, 150), (20_000, 6)):
        met = []
        while len(met) < many:
            a = [rng.choice(words) for _ in range(length)]
            b = a.copy()
            cut = max(1, round(length * rng.uniform(0.15, 0.2)))
            b = b[:-cut]
            s, t = near_dedup.Vectors([" ".join(a), " ".join(b)]), None
            one, two = (set(s.hash[s.at[k] : s.at[k + 1]].tolist()) for k in (0, 1))
            like = len(one & two) / len(one | two)
            if 0.8 <= like <= 0.86:
                key = near_dedup.bands(s, np.ones(len(s.hash), np.float32), near_dedup.Draws(36))
                met.append((key[0] == key[1]).any())
        assert np.mean(met) >= 0.97, (length, np.mean(met))


def test_near_copies_in_large_groups_are_found(spark, tmp_path):
    """One group of near copies that is most of the table, and a table of nothing else: idf alone would make them unlike."""
    from sparkloom.llm.queries import op2_near_dedup

    word = itertools.count()
    new = lambda n: [f"w{next(word)}" for _ in range(n)]
    for name, others in (("most", 20), ("all", 0)):
        base = new(200)
        texts = [" ".join([*base[:k], *new(1), *base[k + 1 :]]) for k in range(10, 190, 3)]
        texts += [" ".join(new(60)) for _ in range(others)]
        documents(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = {r["doc_id"]: r["class_id"] for r in op2_near_dedup(spark, f"{tmp_path}/{name}").collect()}
        assert got == {i: 0 if i < 60 else i for i in range(len(texts))}
        alone = {r["class_id"] for r in near_dedup.near_duplicates(documents(spark, list(enumerate(texts)))).collect()}
        assert len(alone) > 1 + others  # what weights alone leave apart
