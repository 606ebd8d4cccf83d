"""Toxicity, whitening and phrase mining against brute force, held-out accuracy, and their edge cases."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import phrases, toxicity, whitening

SF = "/root/testdata/sf0.1"


# ---------------------------------------------------------------- phrases

def plain_phrases(rows, least=30, top=2000):
    """The contract read literally, over all phrases of one to four words."""
    f, n = collections.Counter(), collections.Counter()
    up = {i: i + 32 for i in range(65, 91)}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(up)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    cand = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    gone = {(k[0], *k[1 + i:1 + i + m]) for k, a in cand.items() for m in range(2, len(k) - 1) for i in range(len(k) - m)
            if 100 * a >= 80 * f[(k[0], *k[1 + i:1 + i + m])]}
    out = collections.defaultdict(list)
    for k, a in cand.items():
        if k not in gone:
            s, c = min((2000000 * a // (f[k[:1 + c]] + f[(k[0], *k[1 + c:])]), c) for c in range(1, len(k) - 1))
            out[k[0]].append((-s, -a, " ".join(k[1:]).encode(), f[k[:1 + c]], f[(k[0], *k[1 + c:])]))
    return sorted((g, i, x[2].decode(), -x[1], x[3], x[4], n[g], -x[0]) for g, v in out.items() for i, x in enumerate(sorted(v)[:top], 1))


def corpus(seed):
    """A hot pair and passage, copies, a lang that is NULL, control characters in words, tabs, odd separators, empty rows."""
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(0.7)) % 60}" for _ in range(3000)] + ["É", "a\x01b", "a", "\x00"] * 20
    rows = []
    for i in range(400):
        t = "".join(r.choice(words) + r.choice([" ", " ", " ", " ", "\t", "  ", ". ", ",", "\r\n", "\x0b"]) for _ in range(r.randrange(40)))
        rows.append(("New york CITY hall " * r.randrange(3) + t, r.choice(["en", "en", "de", None])))
    return rows + [("the the the the the the", "en")] * 60 + [(None, "en"), ("", None), (" \t\n", "fr")] + rows[:50]


@pytest.mark.parametrize("seed,budget,buffer,block", [(1, 1 << 19, 1 << 20, 8 << 20), (2, 50, 300, 400), (3, 1, 10, 50), (4, 700, 100, 2000)])
def test_phrases_equal_plain_counting(spark, monkeypatch, seed, budget, buffer, block):
    """All ways of cutting into blocks and groups give the rows of plain counting."""
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    run = phrases.nodes
    monkeypatch.setattr(phrases, "nodes", lambda b, v, n, g: run(b, v, n, g, buffer))
    rows = corpus(seed)
    df = spark.createDataFrame([(t, g, "x", 1) for t, g in rows], "text string, lang string, word string, f int").repartition(5)
    got = sorted(tuple(r) for r in phrases.mine(df, budget=budget).collect())
    assert got == plain_phrases(rows) and len(got) > 20


def test_phrases_ties_and_top(spark):
    """Equal scores go by count, then phrase in byte order; the rank ends at the limit."""
    rows = [(f"{a} {b}", "en") for a, b in (("é", "z"), ("b", "c"), ("a", "c2"), ("B", "d"))] * 40
    got = [(r["rank"], r["phrase"], r["score"]) for r in phrases.mine(spark.createDataFrame(rows, "text string, lang string"), top=3).orderBy("rank").collect()]
    assert got == [x[1:3] + (x[7],) for x in plain_phrases(rows, top=3)]


def test_phrases_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert phrases.mine(none).count() == 0
    assert phrases.mine(spark.createDataFrame([(None, None), ("a b", None)], "text string, lang string")).count() == 0
    assert phrases.mine(spark.createDataFrame([("a b",)] * 30, "text string"), lang_col=None).first()["lang"] == "und"


# ---------------------------------------------------------------- whitening

def check_whitening(got, vectors, top=32):
    """Rows against numpy: exact deviations, projections up to sign, shares, identity."""
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = int(sum(e[:top] > 1e-12 * e.sum()))
    w = c @ u[:, :k] / np.sqrt(e[:k])
    by = collections.defaultdict(dict)
    for r in got:
        by[r["vec_id"]][r["component"]] = r
    assert len(got) == n * k
    for i in range(n):
        r = by[i]
        assert sorted(r) == list(range(1, k + 1)) and r[1]["deviation"] == int(((n * x[i] - s) ** 2).sum()) and r[1]["n"] == n
        for j in range(1, k + 1):
            assert abs(abs(r[j]["whitened"]) - abs(w[i, j - 1])) < 1e-6 and abs(r[j]["explained"] - e[j - 1] / e.sum()) < 1e-9
    assert got[0]["identity_error"] < 1e-9
    return k


@pytest.mark.parametrize("n,d,cells,panel", [(300, 7, 1 << 17, 1024), (300, 40, 40 * 9, 4), (5, 7, 7, 2)])
def test_whitening_against_numpy(spark, n, d, cells, panel):
    """One or many blocks and panels; more dimensions than rows leave fewer components."""
    r = np.random.default_rng(n + d)
    v = (r.normal(size=(n, d)) * np.arange(1, d + 1)).astype(np.float32).astype(float).tolist()
    df = spark.createDataFrame([(i, x, "e", 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, x string, idx int").repartition(5)
    k = check_whitening(whitening.whiten(df, block_cells=cells, panel_blocks=panel).collect(), v)
    assert k == min(32, d, n - 1)


def test_whitening_drops_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [1.0, 2.0], [3.0, -1.0], [0.5, 0.25]]
    rows = [(i, v) for i, v in enumerate(good)] + [(9, None), (9, [1.0, None]), (9, [nan, 1.0]), (9, [1.0, -inf]), (9, [1.0]), (9, []), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert {r["vec_id"] for r in got} == {0, 1, 2, 3}
    check_whitening(got, good)
    assert [r["whitened"] for r in got if r["vec_id"] == 0] == [r["whitened"] for r in got if r["vec_id"] == 1]


def test_whitening_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])] * 5 + [(None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    out = whitening.whiten(df)
    assert out.count() == 0 and out.columns[:4] == ["vec_id", "component", "n", "deviation"]
    assert whitening.whiten(df.where("false")).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [])], "vec_id long, embedding array<double>")).count() == 0


# ---------------------------------------------------------------- toxicity

def test_grams_read_words_alone():
    s = np.concatenate([[0], toxicity.encode("ab é"), [0]]).astype(np.uint8)
    at, g = toxicity.grams(s)
    e = 27 + ord("é") % 5
    assert list(at) == [1, 2, 3, 4, 5] and list(g) == [1, 1 << 5 | 2, (1 << 5 | 2) << 5, e, e << 5]


def test_stems_are_the_word_so_far():
    s = np.concatenate([[0], toxicity.encode("abcdefg xy"), [0]]).astype(np.uint8)
    at, _ = toxicity.grams(s)
    deep, key = toxicity.stems(s, at)
    spell = lambda k, n: [(int(k) >> 5 * (n - 1 - i)) & 31 for i in range(n)]
    assert list(at[deep]) == [6, 7, 8] and spell(key[0], 6) == [1, 2, 3, 4, 5, 6] and spell(key[2], 8) == [1, 2, 3, 4, 5, 6, 7, 0]


def test_probabilities_sum_to_one():
    """Order 4 and 5 of both classes are distributions over the next symbol, in seen and unseen contexts."""
    r = random.Random(1)
    c5 = [collections.Counter(), collections.Counter()]
    for k in range(2):
        for _ in range(300):
            w = [r.randrange(1, 8 + 4 * k) for _ in range(r.randrange(1, 9))]
            s = np.array([0, *w, 0], np.uint8)
            c5[k].update(toxicity.grams(s)[1].tolist())
    keys = np.array(sorted(set(c5[0]) | set(c5[1])))
    n = [np.array([c[int(g)] for g in keys], float) for c in c5]

    def table(key):
        u, inv = np.unique(key, return_inverse=True)
        return {"key": u, **{c + "all": np.bincount(inv, n[i]) for i, c in enumerate("to")}, **{c + "kinds": np.bincount(inv, n[i] > 0) for i, c in enumerate("to")}}

    c = toxicity.Counts(table(keys >> 5), table(keys & (1 << 20) - 1), (0.6, 0.7)).open()
    for k in range(2):
        assert np.allclose(c.p4[k].reshape(-1, 32).sum(1), 1)
    for ctx in [0, 1, (1 << 5 | 2), 31 << 15 | 7, *(keys[:40] >> 5)]:
        g = np.arange(32) + (int(ctx) << 5)
        p = c.fifth(g, tuple(np.array([x[int(i)] for i in g], float) for x in c5))
        assert np.allclose(p[0].sum(), 1) and np.allclose(p[1].sum(), 1)
    # one seen string by hand: discounted count plus the rest times order 4
    g = int(keys[np.argmax(n[0])])
    same = [x for x in keys if x >> 5 == g >> 5]
    total, kinds = sum(c5[0][int(x)] for x in same), sum(c5[0][int(x)] > 0 for x in same)
    want = (c5[0][g] - 0.6) / total + 0.6 * kinds / total * c.p4[0][g & (1 << 20) - 1]
    assert abs(c.fifth(np.array([g]), (np.array([c5[0][g]]), np.array([c5[1][g]])))[0][0] - want) < 1e-12


def test_keys_find():
    k = toxicity.Keys(np.array([5, 900, 7], np.int64))
    hit, place = k.find(np.array([7, 8, 900, 7], np.int64))
    assert list(hit) == [0, 2, 3] and list(k.keys[place]) == [7, 900, 7]
    assert [len(x) for x in toxicity.Keys(np.zeros(0, np.int64)).find(np.array([1], np.int64))] == [0, 0]


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.score(docs, labels).cache()


def test_held_out_accuracy(scored):
    docs, labels, out = scored
    rows = out.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    s, y = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    rank = s.argsort().argsort()
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())
    p = np.array([r["predicted"] for r in rows])
    assert auc > 0.95 and p[y == 1].mean() > 0.8 and p[y == 0].mean() < 0.03


def test_rows_and_folds(scored):
    docs, _, out = scored
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_labels_do_not_matter(spark, scored):
    """Turning round every held-out label leaves each score as it is."""
    docs, labels, out = scored
    small = docs.where("doc_id < 1500")
    turned = labels.withColumn("toxic", F.when(toxicity.remainder("doc_id") == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.score(small, x).collect()} for x in (labels, turned))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_toxicity_edges(spark):
    """NULLs, empty and long texts, repeated rows, contradicting and NULL labels, clashing columns, one class, no labels."""
    text = ["what a lovely quiet day by the water", "you are a vile wretched grubling"]
    rows = [(i, text[i % 5 == 0] + f" number{i}", "x", 1) for i in range(300)]
    rows += [(None, text[1], "x", 1), (1000, None, "x", 1), (1001, "", "x", 1), (1002, " \n.", "x", 1), (1003, text[1] * 20_000, "x", 1), (3, rows[3][1], "x", 1),
             (1004, "日本語 текст", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, id int")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(5, 0), (1, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows)
    s = collections.defaultdict(list)
    for r in got:
        s[r["doc_id"]].append(r)
    assert [s[k][0]["score"] for k in (1000, 1001, 1002)] == [0.0, 0.0, 0.0] and s[3][0]["score"] == s[3][1]["score"]
    assert s[1003][0]["predicted"] == 1 and s[None][0]["predicted"] == 1 and s[None][0]["held_out"] is False and s[2][0]["predicted"] == 0
    assert toxicity.score(docs.where("false"), labels).count() == 0
    assert {r["score"] for r in toxicity.score(docs, labels.where("false")).collect()} == {0.0}
    one = toxicity.score(docs, labels.where("toxic = 1")).collect()
    assert {r["score"] for r in one if r["doc_id"] not in (1000, 1001, 1002)} == {1.0}


def test_queries_have_the_agreed_columns(spark):
    import __spark_entry__ as E
    small = "/root/testdata/sf0.001"
    want = {"op11_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
            "op12_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double",
                               "identity_error": "double"},
            "op13_phrases": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"}}
    for name, cols in want.items():
        df = E.queries()[name](spark, small)
        assert dict(df.dtypes) == cols
    con = duckdb.connect()
    n = con.execute(f"SELECT count(*) FROM '{small}/embeddings.parquet'").fetchone()[0]
    assert E.queries()["op12_whitening"](spark, small).count() == n * min(32, n - 1)


def test_scores_do_not_depend_on_the_parts_of_the_model(spark, monkeypatch):
    """All stems count, whatever the number of them that one part may hold."""
    r = random.Random(5)
    word = [["grub", "vile", "wretch", "scum"][i % 4] + "".join(r.choice("aeioulnrst") for _ in range(r.randrange(3, 8))) for i in range(60)]
    plain = ["".join(r.choice("aeioulnrstdm") for _ in range(r.randrange(2, 11))) for _ in range(60)]
    rows = [(i, " ".join(r.choice(word if i % 4 == 0 and r.random() < 0.4 else plain) for _ in range(12))) for i in range(240)]
    docs = spark.createDataFrame([*rows, (None, word[0]), (900, ""), (901, None), rows[0]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id long, toxic int")

    def scores():
        return sorted((-1 if x["doc_id"] is None else x["doc_id"], x["score"]) for x in toxicity.score(docs, labels).collect())

    want = scores()
    monkeypatch.setattr(toxicity, "STEMS", 150)
    got = scores()
    assert [k for k, _ in got] == [k for k, _ in want] and np.allclose([v for _, v in got], [v for _, v in want], rtol=0, atol=1e-9)


def test_words_and_stems_agree_on_their_part(spark):
    s = np.concatenate([[0], toxicity.encode("ab abcdef wonderfully inter zzzzzzzzzzzzzz"), [0]]).astype(np.uint8)
    at, _ = toxicity.grams(s)
    deep, key = toxicity.stems(s, at)
    first = at[np.flatnonzero((s[at] > 0) & (s[at - 1] == 0))]
    of = toxicity.word_part(s, first, 7)
    want = [(int(k >> 5), int(of[np.searchsorted(first, at[d], "right") - 1])) for d, k in zip(deep, key)]
    got = spark.createDataFrame([(k,) for k, _ in want], "stem long").select("stem", toxicity.stem_part(F.col("stem"), 7).alias("p"))
    assert {tuple(x) for x in got.collect()} == set(want) and len({p for _, p in want}) > 1
