import random
import re
import unicodedata

import numpy as np
import pytest

from lexloom.llm import leaks
from lexloom.llm.leaks import Blocks, find_leaks, simhash_windows
from lexloom.llm.words import word_hashes


def words(s):
    return re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", s).lower()) if s else []


def brute(docs, items, n=13):
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    return {(d, i) for d, t in docs for w in [words(t)] for k in range(len(w) - n + 1) for i in grams.get(tuple(w[k : k + n]), ())}


def test_words():
    texts = ["Ａ b-c, ﬁx É", None, "", "x_y 1½", "a  b"]
    h, at = word_hashes(texts)
    assert np.diff(at).tolist() == [len(words(t)) for t in texts]
    assert h[0] == word_hashes(["a"])[0][0] and word_hashes(["fix é"])[0].tolist() == h[3:5].tolist()


def test_simhash():
    w = np.array([random.Random(i).randrange(1 << 64) for i in range(40)], np.uint64)
    got = simhash_windows(w, 13)
    for k in range(len(w) - 12):
        want = sum(1 << b for b in range(64) if sum(int(x) >> b & 1 for x in w[k : k + 13]) >= 7)
        assert int(got[k]) == want
    assert len(simhash_windows(w[:5], 13)) == 0


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_blocks(radius):
    rnd = random.Random(radius)
    items = np.array([rnd.randrange(1 << 64) for _ in range(50)], np.uint64)
    probe = [int(items[rnd.randrange(50)]) for _ in range(200)]
    for i in range(200):
        for _ in range(rnd.randrange(5)):
            probe[i] ^= 1 << rnd.randrange(64)
    a, b = Blocks(items, radius).candidates(np.array(probe, np.uint64), radius)
    want = {(i, j) for i, p in enumerate(probe) for j, q in enumerate(items.tolist()) if bin(p ^ q).count("1") <= radius}
    assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def data():
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([12, 13, 30, 30])))) for i in range(20)] + [(20, None), (21, ""), (22, "one two")]
    items.append((23, items[3][1]))
    docs = []
    for d in range(200):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(0, 120))]
        if d % 3 == 0:
            t = words(rnd.choice(items[:20])[1])
            cut = rnd.randrange(11, 31)
            s = rnd.randrange(max(1, len(t) - cut + 1))
            w[10:10] = t[s : s + cut]
        docs.append((d, rnd.choice([" ", ", ", "\n", " – "]).join(w).upper() if d % 2 else " ".join(w)))
    return [*docs, (200, None), (201, ""), (202, docs[0][1]), (203, " ".join(["w1"] * 20000))], items


@pytest.mark.parametrize("shard", [20_000_000, 300])
def test_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(leaks, "SHARD_CHARS", shard)
    docs, items = data()
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id bigint, text string, n_words int")
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id bigint, text string, n_words int")
    rows = find_leaks(d, "doc_id", "text", i, "item_id", "text").collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute(docs, items) and len(rows) == len(brute(docs, items)) > 10
    text = dict(items)
    for r in rows:
        assert r.longest_run >= 13 and 13 <= r.n_words <= r.item_words == len(words(text[r.item_id]))
    assert find_leaks(d.where("false"), "doc_id", "text", i, "item_id", "text").count() == 0
    assert find_leaks(d, "doc_id", "text", i.where("false"), "item_id", "text").count() == 0


def test_repeated_rows(spark):
    t = " ".join(f"a{i}" for i in range(20))
    d = spark.createDataFrame([(1, t), (1, t), (None, t)], "doc_id bigint, text string")
    i = spark.createDataFrame([(7, t.upper())], "item_id bigint, text string")
    assert [(r.doc_id, r.n_words, r.longest_run) for r in find_leaks(d, "doc_id", "text", i, "item_id", "text").orderBy("doc_id").collect()] == [(None, 20, 20), (1, 20, 20), (1, 20, 20)]
    with pytest.raises(ValueError):
        find_leaks(d, "doc_id", "text", i, "item_id", "text", min_words=12)


def changed(rnd, w, n):
    w = list(w)
    for k in rnd.sample(range(len(w)), n):
        w[k] = f"zq{rnd.randrange(10**6)}"
    return w


@pytest.mark.parametrize("n", [1, 2, 3])
def test_near_recall(n):
    """Of items with changed words every one is found that has a window with at most one of them; none without."""
    rnd = random.Random(n)
    vocab = [f"v{i}" for i in range(400)]
    items = [[rnd.choice(vocab) for _ in range(22)] for _ in range(60)]
    index = leaks.ItemIndex(list(range(60)), [" ".join(w) for w in items], 13, 1, near=True)
    docs = [changed(rnd, rnd.choice(items), n) for _ in range(300)]
    got = {(t, i, kind) for t, i, kind, *_ in index.leaks([" ".join(["a b c", *w]) for w in docs], 1, 0.5)}
    want = set()
    for t, w in enumerate(docs):
        for i, v in enumerate(items):
            most = max(sum(x == y for x, y in zip(w[a : a + 13], v[a : a + 13])) for a in range(10))
            if most >= 12:
                want.add((t, i, "exact" if most == 13 else "near"))
    assert {x for x in got if x in want} == want and len(got) == len(want)


def test_near_rows(spark):
    w = [f"a{i}" for i in range(30)]
    every = [x if i % 12 else f"z{i}" for i, x in enumerate(w)]
    d = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(every)), (3, " ".join(w[::-1]))], "doc_id bigint, text string")
    i = spark.createDataFrame([(7, " ".join(w))], "item_id bigint, text string")
    rows = {r.doc_id: r for r in find_leaks(d, "doc_id", "text", i, "item_id", "text", near=True).collect()}
    assert {k: r.kind for k, r in rows.items()} == {1: "exact", 2: "near"} and 0.8 <= rows[2].similarity < 1 and rows[2].n_words == 29
    assert [r.doc_id for r in find_leaks(d, "doc_id", "text", i, "item_id", "text").collect()] == [1]
