"""Secret scans, the divergence audit and the prefix trie against brute force, and on hard tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sparkloom.llm import divergence, prefix_trie, secret_scan

# ---------------------------------------------------------------- secrets

DOCUMENT = "doc_id bigint, text string, lang string, source string, blob string, hits string, rule string"


def documents(spark, texts, ids=None, lang="en", source="s"):
    return spark.createDataFrame([(i, t, lang, source, "b", None, "r") for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCUMENT)


BASE = {
    "assign": (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}


def base_spans(text):
    out = []
    for k, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or "", re.I | re.A if kind == "assign" else 0):
            if len(m[group]) >= least:
                out.append((m.start(), k, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


SECRETS = [
    None, "", "password=short", "token=secret: longvalue1234", "ſecret = abcdefgh12 toKen: abcdefgh12", "é🙂 API_KEY='" + "ab12" * 5 + "' and apikey: x", "AKIA" * 9 + " AKIA123 AKIAABCDEFGHIJKL", "0f" * 16 + "g" + "0f" * 15,
    "secret=" + "0f" * 20 + "\n" + "AKIA" + "0" * 12, "password" + " " * 500 + "=" + " " * 500 + "'abcdefghij", "x" * 100_000 + "token:" + "y" * 90_000, "token=abcdefgh " * 3000, "-----BEGIN RSA PRIVATE KEY-----\nghp_" + "a" * 36,
    "token=abcdefgh " * 3000, "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK xoxb-1234567890-abc", "password\x00=abcdefghij\r\npasswd:\t12345678 secret:12345678",
]


def test_secrets_equal_brute_force(spark):
    got = {r["doc_id"]: r for r in secret_scan.secrets(documents(spark, SECRETS)).collect()}
    assert len(got) == len(SECRETS)
    for i, text in enumerate(SECRETS):
        want = base_spans(text)
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (i, want[:200], got[i]["spans"][:200])
        assert set(filter(None, want.split(","))) <= set(got[i]["spans"].split(","))
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in want.split(",")) for k in BASE]
    assert "private_key:0:31" in got[12]["spans"] and "github:32:72" in got[12]["spans"] and got[14]["spans"].startswith("jwt:0:38,slack:39:")


def test_secrets_of_random_texts(spark):
    rng = random.Random(5)
    parts = ["token", "SECRET", "api_key", "=", ": ", "'", '"', " ", "AKIA", "ABCDEF0123", "deadbeef", "0123456789abcdef", "é", "\n", "password", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(300)]
    got = {r["doc_id"]: r["base_sha256"] for r in secret_scan.secrets(documents(spark, texts)).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != hashlib.sha256(base_spans(t).encode()).hexdigest()] == []


def test_ledger_scans_only_what_it_lacks(spark, tmp_path, monkeypatch):
    asked = []
    real = secret_scan.scan

    def counted(blobs, rules):
        blobs = blobs.cache()
        asked.append({(r["text"], tuple(sorted(r["todo"]))) for r in blobs.collect()})
        return real(blobs, rules)

    monkeypatch.setattr(secret_scan, "scan", counted)
    ledger = secret_scan.Ledger(spark, f"file://{tmp_path}/ledger")
    a, b, c = "token=abcdefgh", "AKIA" + "0" * 12, "ghp_" + "z" * 36
    base = tuple(sorted(r.name for r in secret_scan.BASE))
    ledger.update(documents(spark, [a, b, a, a]), "one", secret_scan.BASE)
    assert asked[-1] == {(a, base), (b, base)}
    ledger.update(documents(spark, [a, b, c]), "two", secret_scan.BASE)
    assert asked[-1] == {(c, base)}
    ledger.update(documents(spark, [a, b, c]), "two", secret_scan.BASE)  # there already
    assert len(asked) == 2
    github = next(r for r in secret_scan.PROVIDERS if r.kind == "github")
    ledger.update(documents(spark, [a, c]), "three", (*secret_scan.BASE, github))
    assert asked[-1] == {(a, ("github@1",)), (c, ("github@1",))}
    found = {r["doc_id"]: [h["kind"] for h in r["hits"]] for r in ledger.by_path(documents(spark, [a, b, c, "", c]), ["doc_id"]).collect()}
    assert found == {0: ["assign"], 1: ["access"], 2: ["github"], 3: [], 4: ["github"]}
    # a rule of a later version reads again, and what the earlier one found no longer counts
    later = (secret_scan.BASE[0]._replace(version=2, least=9),)
    ledger.update(documents(spark, [a]), "four", later)
    assert asked[-1] == {(a, ("assign@2",))} and ledger.findings(later).count() == 0 and ledger.findings(secret_scan.BASE).count() == 2


def test_ledger_ignores_what_a_broken_update_left(spark, tmp_path):
    ledger = secret_scan.Ledger(spark, f"file://{tmp_path}/ledger")
    docs = documents(spark, ["token=abcdefgh"])
    docs.selectExpr("'zz' AS blob", "'hex@1' AS rule", "array(named_struct('start', 1L, 'stop', 2L)) AS spans").write.parquet(f"{tmp_path}/ledger/batch=one/findings")
    assert ledger.batches() == [] and ledger.findings().count() == 0
    ledger.update(docs, "one")
    assert [r["rule"] for r in ledger.findings().collect()] == ["assign@1"]


def test_secret_scan_runs_no_python(spark):
    plan = secret_scan.secrets(documents(spark, ["token=abcdefgh", None]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- divergence


def brute_divergence(rows, least):
    """rows: (text, lang, source)."""
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    docs = [(lang or "", source or "", words(text or "")) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(w for d in own for w in set(d[2]))
        kept = sorted(w for w in df if df[w] >= least)
        counts = defaultdict(Counter)
        for _, source, ws in own:
            counts[source].update(w for w in ws if df[w] >= least)
        total = Counter()
        for c in counts.values():
            total.update(c)
        share = lambda c: {w: 1 + (10**9 * (c[w] + 5)) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        p, q = {s: share(counts[s]) for s in {d[1] for d in own}}, share(total)
        for s in p:
            pairs = sorted(((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in p if o != s))
            terms = sorted((q[w] - p[s][w], w.encode()) for w in kept if counts[s][w] and p[s][w] > q[w])[:50]
            for part, got in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(got, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


@pytest.mark.parametrize(("cells", "side"), [(1 << 20, 256), (64, 3)])
def test_divergence_equals_brute_force(spark, monkeypatch, cells, side):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "SIDE", side)
    rng = random.Random(3)
    vocabulary = ["the", "The", "été", "ÉTÉ", "日本", "b", "a", "zz", "x1y", "don't", "ß"]
    rows = [(" ".join(rng.choice(vocabulary[: rng.randrange(1, 12)]) for _ in range(rng.randrange(40))), rng.choice(["en", "fr", None, "xx"]), rng.choice([None, "s", "é", "z", "Z", "t", "u", "v"])) for _ in range(160)]
    rows += [(None, "en", "none"), ("", None, ""), ("only once", "solo", "alone"), ("the " * 50_000, "fr", "long"), ("rare words", "pair", "a"), (None, "pair", "b")] + [rows[0]] * 3
    docs = spark.createDataFrame([(k, *r, "clash", 1) for k, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string, term string, n int")
    assert rows_of(divergence.divergence(docs, 5)) == brute_divergence(rows, 5)


def test_divergence_of_nothing(spark):
    assert divergence.divergence(documents(spark, [])).count() == 0


def test_counts_handed_on_in_parts_add_up(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    texts = ["a b c a", "b b d", "", "e f g h"]
    batch = pa.RecordBatch.from_pydict({"lang": ["x", "x", "y", "x"], "source": ["s"] * 4, "text": texts})
    got, df = Counter(), Counter()
    parts = list(divergence._counted(iter([batch, batch])))
    for r in (r for part in parts for r in part.to_pylist()):
        got[r["lang"], r["term"]] += r["n"]
        df[r["lang"], r["term"]] += r["df"]
    assert len(parts) > 2 and got["x", "b"] == 6 and df["x", "b"] == 4 and got["x", "a"] == 4 and df["x", "a"] == 2 and got["y", None] == 0


def test_shares_are_exact_beyond_64_bits():
    rng = random.Random(1)
    for _ in range(200):
        b = rng.randrange(1, 9 * 10**15)
        a = rng.randrange(0, b + 1)
        assert divergence.shares(np.array([a]), np.array([b]))[0] == 1 + 10**9 * a // b


def test_terms_of_pieces_are_those_of_the_whole():
    text = ("Été don't x1Y " * 400).encode()
    assert [w for part in divergence.terms_of(text, 16) for w in part] == [w.encode() for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "Été don't x1y " * 400)]


# ---------------------------------------------------------------- prefix trie


def brute_trie(rows):
    """rows: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), role, digest[:32], text))
    own = {c: [(t[1], t[3]) for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        cost = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += cost
    sha = lambda k: hashlib.sha256(",".join(map(str, sorted(c for c in members[k] if len(rebuilt[c]) == len(k)))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k], sha(k)) for k, m in members.items())


def trie_rows(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if r[c] is None else r[c] for c in columns) for r in df.collect())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", b"k") for r in rows], "conv_id bigint, turn bigint, role string, text string, path string, key binary")


@pytest.mark.parametrize("shard", [1 << 20, 40, 1])
def test_trie_equals_brute_force(spark, shard):
    rng = random.Random(11)
    texts = ["hi", "hi there", "", None, "a  b\tc", "\x00", "é à"]
    rows = []
    for c in [*range(90), *range(200, 230), 1_000_003]:
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(rng.randrange(1, 7))]
    rows += [(c, t, "user", f"same {t}") for c in range(300, 420) for t in range(5)]  # a group of copies
    rows += [(c, t, "user", "long") for c in (500, 501) for t in range(300 + c % 2)]
    rows += [(600, None, "user", "first"), (600, 3, None, None), (600, 3, None, None), (600, 3, "b", "x"), (600, 3, "a", "y"), (None, 1, "user", "nobody's"), rows[0]]
    assert trie_rows(prefix_trie.prefix_trie(conversations(spark, rows), shard)) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(conversations(spark, [])).count() == 0


def test_louds_tells_parents_and_degrees():
    degrees = np.array([2, 0, 3, 0, 1, 0, 0])
    trie = prefix_trie.Louds(degrees, np.zeros(6))
    assert np.unpackbits(trie.bits, count=trie.many).tolist() == [1, 0, 1, 1, 0, 0, 1, 1, 1, 0, 0, 1, 0, 0, 0]
    assert trie.parents().tolist() == [0, 0, 2, 2, 2, 4] and trie.degrees().tolist() == degrees.tolist()
