import random
import re
from collections import Counter

import numpy as np

from quarrysight.llm import decontaminate as D

from .helpers import awkward, empty

WORD = re.compile(r"[^\W_]+")
ITEMS = "item_id long, text string, key string, len long, doc_id long"


def items_of(spark, texts):
    return spark.createDataFrame([(i, t, "k", 1, 2) for i, t in enumerate(texts)], ITEMS)


def words(text):
    return WORD.findall((text or "").lower())


def brute(docs, items):
    """(doc_id, item_id) of leaks: every window of the item's size is compared."""
    out = set()
    for k, t in docs:
        w = words(t)
        for i, item in enumerate(items):
            x = words(item)
            if not x:
                continue
            m = min(len(x), 5)
            bag = Counter(tuple(x[p:p + m]) for p in range(len(x) - m + 1))
            for s in range(max(1, len(w) - len(x) + 1)):
                part = w[s:s + len(x)]
                have = Counter(tuple(part[p:p + m]) for p in range(len(part) - m + 1))
                if have and 5 * sum((bag & have).values()) >= 4 * sum((bag | have).values()):
                    out.add((k, i))
    return out


def test_against_every_window(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.randint(12, 60))) for _ in range(12)]
    items += ["four word item here", "single", "", None, "rep rep rep rep rep rep rep rep rep"]
    docs = []
    for n in range(80):
        body = [rng.choice(vocab) for _ in range(rng.randint(0, 120))]
        if n % 2:
            leak = words(items[rng.randrange(12)])
            kind = n % 8
            if kind == 3:
                leak[rng.randrange(len(leak))] = "changed"
            elif kind == 5:
                leak.insert(rng.randrange(len(leak)), "inserted")
            elif kind == 7:
                leak = leak[:len(leak) // 2]
            body[len(body) // 2:len(body) // 2] = leak
        docs.append(" ".join(body))
    docs += ["", None, items[0].upper().replace(" ", ", "), "x Four-word ITEM here!", "is single", "rep " * 40, "w1 " * 20000,
             (900, items[1]), (900, "clean text"), (900, items[1]), (None, items[2])]
    df = awkward(spark, docs)
    got = D.leaks(df, items_of(spark, items), exact=True).collect()
    truth = brute([(r.doc_id, r.text) for r in df.collect()], items)
    assert {(r.doc_id, r.item_id) for r in got} == truth
    near = D.leaks(df, items_of(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in near} <= truth and len(near) >= 0.9 * len(truth)
    assert {(r.doc_id, r.item_id) for r in got if r.similarity > 0.9} <= {(r.doc_id, r.item_id) for r in near}
    assert len(got) == len({(r.doc_id, r.item_id) for r in got}) and all(0.8 <= r.similarity <= 1 for r in got)
    kept = D.decontaminated(df, items_of(spark, items), exact=True)
    assert kept.columns == df.columns
    flagged = {r.doc_id for r in got}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in df.collect() if r.doc_id not in flagged)


def test_all_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(0)
    own = {i: (7, int(rng.integers(0, 1 << 62)) * 3 % (1 << 64)) for i in range(40)}
    items = D._Items(own, {})
    windows = []
    for n in range(400):
        f = own[n % 40][1]
        for bit in rng.choice(64, n % (D.RADIUS + 3), replace=False).tolist():
            f ^= 1 << bit
        windows.append(f)
    packed = np.array(windows, np.uint64).view(np.uint8).reshape(-1, 8)
    got = {(i, int(w)) for i, near in items.found(packed, 7) for w in near}
    assert got == {(i, w) for i, (_, f) in own.items() for w, x in enumerate(windows) if (f ^ x).bit_count() <= D.RADIUS}


def test_windows_have_the_simhash_of_their_bag(monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(D, "CHUNK", 13)
    texts = [[rng.getrandbits(64) for _ in range(n)] for n in (40, 3, 0, 12, 90)]
    items, bags = {}, {}
    for k, (t, at, n) in enumerate([(0, 5, 12), (4, 70, 20), (4, 0, 12), (3, 0, 12), (1, 0, 3)]):
        bag = Counter(texts[t][at:at + n])
        bits = sum(1 << b for b in range(64) if 2 * sum(c for h, c in bag.items() if h >> b & 1) > n)
        items[k] = (n, bits)
        bags[k] = (np.array(sorted(bag), np.uint64), np.array([bag[h] for h in sorted(bag)]))
    got = D.leaked_items(np.array([h for t in texts for h in t], np.uint64), np.cumsum([len(t) for t in texts]), D._Items(items, bags))
    assert got == {(0, 0), (4, 1), (4, 2), (3, 3), (1, 4)}


def test_recall_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    near, exact = ({(r.doc_id, r.item_id) for r in D.leaks(docs, items, exact=e).collect()} for e in (False, True))
    assert near <= exact and len(near) >= 0.9 * len(exact) > 0


def test_simhash_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(k, rng.getrandbits(64) - (1 << 63), rng.randint(1, 9)) for k in range(3) for _ in range(40)]
    got = {r.k: r.fingerprint for r in D.simhash(spark.createDataFrame(rows, "k long, hash long, c long"), ["k"]).collect()}
    for k in range(3):
        mine = [(h & (1 << 64) - 1, c) for q, h, c in rows if q == k]
        total = sum(c for _, c in mine)
        want = sum(1 << b for b in range(64) if 2 * sum(c for h, c in mine if h >> b & 1) > total)
        assert got[k] & (1 << 64) - 1 == want


def test_empty(spark):
    assert D.leaks(empty(spark), items_of(spark, ["a b c d e f"])).count() == 0
    assert D.leaks(awkward(spark, ["a b c d e f"]), items_of(spark, [])).count() == 0


def test_reordered_parts_against_every_window(spark):
    rng = random.Random(9)
    item = [f"i{k}" for k in range(100)]
    rest = [f"r{k}" for k in range(300)]
    twice = "a b c d e f g a b c d e f g h k l m n o".split()
    items = [" ".join(item), " ".join(twice), " ".join(item[:30]), "one two"]
    docs = [" ".join(rest[:150] + item[50:] + item[:50] + rest[150:])]
    for n in range(30):
        x = rng.choice([item, twice, item[:30]])
        at = sorted(rng.sample(range(1, len(x)), rng.randint(1, 2)))
        parts = [x[i:j] for i, j in zip([0, *at], [*at, len(x)])]
        rng.shuffle(parts)
        around = rest[:rng.randint(0, 40)]
        docs.append(" ".join(around + [w for p in parts for w in p] + around))
    docs += [" ".join(twice * 3), " ".join(twice[:14] * 5), "two one two one two"]
    df = awkward(spark, docs)
    got = {(r.doc_id, r.item_id): r for r in D.leaks(df, items_of(spark, items), exact=True).collect()}
    near = {(r.doc_id, r.item_id) for r in D.leaks(df, items_of(spark, items)).collect()}
    assert near <= set(got) and len(near) >= 0.9 * len(got)
    assert set(got) == brute([(r.doc_id, r.text) for r in df.collect()], items)
    assert got[0, 0].start_word == 150 and abs(got[0, 0].similarity - 92 / 100) < 1e-9


def test_possible_windows_lose_no_leak_and_are_few(spark):
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (5, 9, 14, 14, 30)] + ["rep " * 9]
    docs = []
    for n in range(40):
        x = words(items[n % 6])
        if n % 3 == 0 and len(x) > 20:
            x[rng.randrange(len(x))] = "changed"
        around = [rng.choice(vocab) for _ in range(n % 4 * 6)]
        docs.append(" ".join(around + x * (1 + n % 2) + around)[:None if n % 5 else 70])
    docs += ["rep " * 30, "w1 w2"]
    raw = spark.createDataFrame(list(enumerate(docs)), "key long, text string")
    bags = []
    for i, t in enumerate(items):
        df = D.with_shingles(spark.createDataFrame([(t,)], "text string"), 5).collect()[0]
        count = Counter(df.shingles)
        bags += [(5, i, h, c, sum(count.values())) for h, c in count.items()]
    got = {(r.key, r["size"], r.start): r.total for r in
           D.possible_windows(raw, spark.createDataFrame(bags, "m int, item long, hash long, c long, size long"), 5).collect()}
    shingles = {r.key: r.shingles for r in D.with_shingles(raw, 5).collect()}
    for size in {b[4] for b in bags}:
        known = {b[2] for b in bags if b[4] == size}
        for key, s in shingles.items():
            for start in range(max(1, len(s) - size + 1)):
                part = s[start:start + size]
                enough = part and 9 * sum(h in known for h in part) >= 4 * (size + len(part))
                assert got.get((key, size, start)) == (len(part) if enough else None)


def test_blocks_find_all_within_the_radius(spark):
    rng = random.Random(5)
    signed = [rng.getrandbits(64) - (1 << 63) for _ in range(30)]
    prints = [(5, i, 7 + i % 2, f) for i, f in enumerate(signed)]
    windows = []
    for n in range(300):
        f = signed[n % 30] & (1 << 64) - 1
        for bit in rng.sample(range(64), n % (D.RADIUS + 3)):
            f ^= 1 << bit
        windows.append((5, n, 7 + n % 30 % 2, f - (1 << 64) if f >> 63 else f))
    got = D.within_radius(spark.createDataFrame(windows, "m int, key long, size int, fingerprint long"),
                          spark.createDataFrame(prints, "m int, item long, total long, fingerprint long")).collect()
    assert {(r.key, r._item) for r in got} == {
        (k, i) for _, k, size, f in windows for _, i, total, own in prints
        if size == total and ((f ^ own) & (1 << 64) - 1).bit_count() <= D.RADIUS}


def test_no_python_on_the_executors(spark, monkeypatch):
    plans, store = [], D.written
    monkeypatch.setattr(D, "written", lambda df, name: (plans.append((name, df._jdf.queryExecution().toString())), store(df, name))[1])
    found = D.leaks(awkward(spark, ["x a b c d e f y", None]), items_of(spark, ["a b c d e f"]))
    plans.append(("leaks", found._jdf.queryExecution().toString()))
    assert {"fingerprints", "windows", "candidates", "leaks"} <= {name for name, _ in plans}
    assert not [name for name, plan in plans if "Python" in plan or "Arrow" in plan]
    assert [r.item_id for r in found.collect()] == [0]
