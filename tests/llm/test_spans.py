import random
import time

import numpy as np
import pytest

from lexloom.llm import spans as S
from lexloom.llm.spans import Automaton, SharedSpans, Shards, only, sliding, union, winnow


def brute(texts, n):
    out = set()
    grams = {}
    for d, t in texts:
        for i in range(len(t or "") - n + 1):
            grams.setdefault(t[i : i + n], set()).add(d)
    for ds in grams.values():
        ds = sorted(ds)
        out |= {(a, b) for i, a in enumerate(ds) for b in ds[i + 1 :]}
    return out


def corpus(seed, alphabet="abcd", size=60, n=24):
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choice(alphabet) for _ in range(k))
    phrase = text(n - 4)  # a standing phrase that is too short to count
    out = []
    for d in range(size):
        t = text(rnd.randrange(0, 120))
        if d % 2:
            t += phrase + text(30)
        if d > 5 and d % 4 == 0:
            src = rnd.choice(out)[1]
            s, k = rnd.randrange(max(1, len(src))), rnd.choice([n - 1, n, n + 1, 40])
            t = t[:20] + src[s : s + k] + t[20:]
        out.append((d, t))
    out += [(size, out[3][1]), (size + 1, out[3][1]), (size + 2, "é" * 50), (size + 3, "é" * 30 + "x"), (size + 4, None), (size + 5, ""), (size + 6, "\U0001f600" * 30)]
    return out


def run(spark, texts, n):
    df = spark.createDataFrame([(d, t, 1) for d, t in texts], "doc_id bigint, text string, h int")
    return SharedSpans(df, "doc_id", "text", n)


def test_sliding():
    x = np.array([random.Random(i).randrange(100) for i in range(200)])
    for w in (1, 2, 3, 7, 8, 9, 100, 200):
        assert sliding(x, w, np.minimum).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]


def test_winnow_guarantee():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab c") for _ in range(rnd.randrange(0, 90))) for _ in range(40)]
    t, pos, h, prefix, bounds = winnow(texts, 24, 14)
    picked = {(int(a), int(p - bounds[a])) for a, p in zip(t, pos)}
    for i, x in enumerate(texts):
        for s in range(len(x) - 23):
            assert any((i, s + k) in picked for k in range(11))
    assert all(p + 14 <= len(texts[a]) for a, p in picked)


def test_automaton():
    rnd = random.Random(1)
    for _ in range(80):
        a, b = ("".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 40))) for _ in range(2))
        got = Automaton(a).spans(b, 4)
        at = {(s, e) for s in range(len(b)) for e in range(s + 4, len(b) + 1) if b[s:e] in a}
        want = {(s, e) for s, e in at if not any((x <= s and e <= y) and (x, y) != (s, e) for x, y in at)}
        assert set(got) == want


def test_shards(monkeypatch):
    rnd = random.Random(3)
    a = "".join(rnd.choice("abc") for _ in range(500))
    b = "zz" + a[100:300] + "yy" + a[400:430]
    whole = Shards(a, 20).shared(b)
    monkeypatch.setattr(S, "SHARD", 60)
    assert Shards(a, 20).shared(b) == whole and whole[2] >= 200
    assert union([(5, 9), (0, 3), (2, 6)]) == [(0, 9)]


@pytest.mark.parametrize("wide,hits,every", [(48, 12, 64), (2, 12, 64), (48, 2, 1), (2, 2, 2)])
def test_against_brute_force(spark, monkeypatch, wide, hits, every):
    for name, v in (("WIDE", wide), ("SAMPLE_HITS", hits), ("SAMPLE_ONE_IN", every)):
        monkeypatch.setattr(S, name, v)
    texts = corpus(5)
    got = [tuple(r) for r in run(spark, texts, 24).pairs().collect()]
    assert set(got) == brute(texts, 24) and len(got) == len(set(got)) > 10


def test_coverage(spark):
    texts = corpus(6)
    rows = {r.doc_id: r for r in run(spark, texts, 24).coverage().collect()}
    text, pairs = dict(texts), brute(texts, 24)
    assert set(rows) == {d for p in pairs for d in p}
    for d, r in rows.items():
        t = text[d]
        hit = [False] * len(t)
        for i in range(len(t) - 23):
            if any(d != o and t[i : i + 24] in (x or "") for o, x in texts):
                hit[i : i + 24] = [True] * 24
        assert (r.n_shared, r.n_chars) == (sum(hit), len(t)), d
        assert r.class_id == min(o for o, x in texts if x == t)


def test_edges(spark):
    assert run(spark, [], 24).pairs().count() == 0
    assert run(spark, [(1, None), (2, ""), (3, "short")], 24).pairs().count() == 0
    same = [(i, "x" * 40) for i in range(5)] + [(4, "x" * 40), (None, "x" * 40)]
    assert {tuple(r) for r in run(spark, same, 24).pairs().collect()} == {(a, b) for a in range(5) for b in range(a + 1, 5)}
    rnd = random.Random(8)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(60000))
    assert [tuple(r) for r in run(spark, [(1, long), (2, "q" + long[30000:30024] + "q"), (3, "q" + long[10:33] + "q")], 24).pairs().collect()] == [(1, 2)]


def test_only(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(1000)], "doc bigint, t string")
    got = {r.doc for r in only(docs, "doc", docs.where("doc < 10").select("doc")).collect()}
    assert set(range(10)) <= got and len(got) < 30
    assert only(docs, "doc", docs.where("false").select("doc")).count() == 0


def test_repeated_inside():
    """What stands several times in one text is covered at each place, also where it stands in part."""
    rnd = random.Random(4)
    a, b = ("".join(rnd.choice("abcdefgh") for _ in range(60)) for _ in range(2))
    mine, theirs, longest = Shards(a + "##" + a[:30] + "##" + b, 24).shared("$$" + a + "$$")
    assert (mine, theirs, longest) == ([(0, 60), (62, 92)], [(2, 62)], 60)


def test_long_texts():
    """Near copies of a million characters and a text of equal characters take time in proportion to their length."""
    rnd = random.Random(6)
    a = "".join(rnd.choice("abcdefghij klmnop") for _ in range(1_000_000))
    b = "".join("#" if i % 20011 == 0 else c for i, c in enumerate(a))
    began = time.time()
    mine, theirs, longest = Shards(a, 240).shared(b)
    assert longest == 20010 and len(theirs) == len(mine) == 50 and time.time() - began < 20
    began = time.time()
    assert Shards("x" * 50_000, 240).shared("x" * 50_000) == ([(0, 50_000)], [(0, 50_000)], 50_000) and time.time() - began < 2


def test_standing_phrase(spark, monkeypatch):
    """Many documents with one phrase: as many pairs as documents, and the reference is sent in several copies."""
    monkeypatch.setattr(S, "WIDE", 8)
    monkeypatch.setattr(S, "PARTNERS", 50)
    rnd = random.Random(7)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    phrase = word(40)
    texts = [(i, word(20) + phrase + word(20)) for i in range(400)]
    x = run(spark, texts, 24)
    assert x.candidates(one_each=True).count() < 400 * 8  # not 400 * 399 / 2
    rows = x.coverage().collect()
    assert len(rows) == 400 and all(40 <= r.n_shared < 60 and r.n_stretches == 1 for r in rows)
    assert x.pairs().count() == 400 * 399 // 2
