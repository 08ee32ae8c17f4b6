import random
import re

import numpy as np
import pytest

from quarrysight.llm import components as C
from quarrysight.llm import minhash_dedup as M

from .helpers import awkward, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) >= words:
        return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))
    return frozenset([tuple(w)] if w else [])


def brute(rows, words, percent):
    """(size, smallest doc_id reachable) per row, all pairs compared."""
    sets = [shingles(t, words) for _, t in rows]
    root = {k: k for k, _ in rows if k is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (p, _) in enumerate(rows):
        for j, (q, _) in enumerate(rows[:i]):
            both = len(sets[i] & sets[j])
            if p is not None and q is not None and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(p), find(q)))
                root[b] = a
    return sorted((k is not None, k or 0, len(s), find(k) if k is not None else None) for (k, _), s in zip(rows, sets))


def got(df, words, percent):
    rows = M.near_duplicates(df, words, percent).collect()
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in rows)
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id) for r in rows)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choice(vocab) for _ in range(12))
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            w = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = [rng.choice(vocab) for _ in range(rng.randint(30, 160))]
            if rng.random() < 0.5:
                w = line.split(" ") + w
        out.append(" ".join(w))
    return out


def test_words_are_hashed_alike():
    a, b = M.shingle_sets(["The cat  sat\non the mat".encode(), b"THE CAT SAT ON the\tmat "], 3)
    assert (a == b).all() and len(a) == 4
    one, two, none, blank = M.shingle_sets([b"a b", b"b a", b"", b" \n\x0b"], 3)
    assert len(one) == len(two) == 1 and one != two and not len(none) and not len(blank)
    assert len(M.shingle_sets([b"x " * 500], 3)[0]) == 1


def test_components_match_a_search(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    found = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert {x: find(x) for x in root if find(x) != x} == found
    assert C.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_against_all_pairs(spark):
    texts = corpus(1, 120) + ["", None, " \n", "one", "one", "two words", (500, "r p q s t"), (500, "r p q s t"), (None, "one"),
                              (501, "several texts of one document " * 3), (501, "one"), "long " * 30000, "é ü " * 300]
    df = awkward(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(df, 3, 85) == brute(rows, 3, 85)


def test_blocks_find_what_stars_leave(spark, monkeypatch):
    # a chain of edits: neighbours are linked, the ends are not
    monkeypatch.setattr(M, "BLOCK", 4)
    rng = random.Random(2)
    w = [f"v{i}" for i in range(120)]
    texts = []
    for i in range(24):
        texts.append(" ".join(w))
        w[rng.randrange(0, 120)] = f"x{i}"
    rng.shuffle(texts)
    df = awkward(spark, texts)
    assert got(df, 3, 85) == brute([(r.doc_id, r.text) for r in df.collect()], 3, 85)


def test_links_across_two_blocks():
    texts = ["a b c d e f g h", "a b c d e f g h i", "q r s t u v w x", "q r s t u v w x y"]
    assert M._links_across([1, 2, 3, 4], [1, 2, 3, 4], [0, 0, 0, 0], texts, 3, 80) == [(1, 2), (3, 4)]
    assert M._links_across([1, 2, 3, 4], [1, 2, 3, 4], [0, 0, 1, 1], texts, 3, 80) == []
    assert M._links_across([1, 2], [7, 7], [0, 0], texts[:2], 3, 80) == []


def test_empty_and_only_empty_texts(spark):
    assert M.near_duplicates(empty(spark)).count() == 0
    assert got(awkward(spark, ["", None, ""]), 5, 80) == [(True, i, 0, i) for i in range(3)]
    assert len(np.unique(M._constants(50, 1))) == 50


def test_empty_rows_of_a_repeated_doc_id_link_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "q r s t u v"), (2, ""), (3, "x y z w k"), (3, " \n"), (3, "")],
                                 "doc_id long, text string")
    stars = spark.createDataFrame([(1, 2), (1, 3)], "u long, v long")
    placed = spark.createDataFrame([], "node long, component long")
    assert M._remaining(stars, placed, docs, 3, 80).collect() == []


def test_texts_of_one_member_are_dealt_over_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e"), (3, "t3 x0 y z w k"), (3, "")] + [(2, f"t{i} x{i} y z w k") for i in range(40)],
                                 "doc_id long, text string")
    stars = spark.createDataFrame([(1, 2), (1, 3)], "u long, v long")
    placed = spark.createDataFrame([], "node long, component long")
    monkeypatch.setattr(M, "BLOCK", 4)
    assert [tuple(r) for r in M._remaining(stars, placed, docs, 2, 50).collect()] == [(2, 3)]


def test_a_threshold_without_proven_groups_is_refused():
    with pytest.raises(ValueError):
        M.near_duplicates(None, percent=79)
