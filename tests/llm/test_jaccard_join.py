import os
import random
from urllib.parse import unquote, urlparse

import numpy as np
import pytest

from quarrysight.llm import jaccard_join as J

from .helpers import awkward, empty
from .test_near_duplicates import brute, corpus


def got(df, words, percent):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id)
                  for r in J.jaccard_components(df, words, percent).collect())


def family(seed, n, words=120, edits=5):
    """Variants of one text, near the threshold of each other."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{seed}-{rng.randrange(60)}"
        out.append(" ".join(w + [f"u{seed}-{k}-{i}" for i in range(rng.randint(0, 6))]))
    return out


def test_components_match_a_search(spark):
    texts = corpus(3, 130) + ["", None, " \t", "one", "ONE", "one two", "two one", "Wort " * 3000, "wort " * 3001]
    rows = list(enumerate(texts)) + [(7, texts[40]), (7, texts[41]), (None, texts[0]), (None, None), (3, None)]
    df = awkward(spark, rows).repartition(4)
    for words, percent in ((4, 85), (5, 80)):
        assert got(df, words, percent) == brute(rows, words, percent)


@pytest.mark.parametrize("percent,longest,levels", [(85, 4, 2), (85, 3, 0), (80, 4, 1)])
def test_long_lists_lose_no_link(spark, monkeypatch, percent, longest, levels):
    """Short limits send everything through differences and blocks."""
    monkeypatch.setattr(J, "LIST", longest)
    monkeypatch.setattr(J, "LEVELS", levels)
    texts = family(1, 28) + family(2, 20, 60, 3) + corpus(5, 25)
    rows = list(enumerate(texts))
    assert got(awkward(spark, rows).repartition(3), 4, percent) == brute(rows, 4, percent)


def test_the_differences_are_used(spark, monkeypatch):
    seen = []
    plain = J._Join.differences

    def spy(self, hot):
        out = plain(self, hot)
        seen.append((hot.count(), out.count()))
        return out

    monkeypatch.setattr(J, "LIST", 4)
    monkeypatch.setattr(J._Join, "differences", spy)
    rows = list(enumerate(family(1, 40, 120, 9)))
    assert got(awkward(spark, rows), 4, 85) == brute(rows, 4, 85)
    assert seen[0][0] > 10 and seen[0][1] > 0


def test_a_hot_list_makes_no_square_of_pairs(spark, monkeypatch):
    """Texts of one common passage, pairwise just under the threshold: nothing links
    them, and nothing but the passage's own list compares them."""
    compared = []
    plain = J.compared

    def spy(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(J, "compared", spy)
    passage = " ".join(f"p{i}" for i in range(103))
    rows = [(k, passage + " " + " ".join(f"u{k}-{i}" for i in range(12))) for k in range(700)]
    out = J.jaccard_components(awkward(spark, rows), 4, 85).collect()
    assert all(r.component_id == r.doc_id and r.n_shingles == 112 for r in out)
    assert sum(compared) < 8 * len(rows)


def test_maps_never_hide_a_link(monkeypatch):
    """Maps differ in at most the tokens of only one set, at any sizes; of unlike sets in many."""
    rng = np.random.default_rng(4)
    for most in (J.MAP, 2):
        monkeypatch.setattr(J, "MAP", most)
        sets = [np.unique(rng.integers(0, 1 << 64, n, np.uint64)) for n in (1, 2, 63, 64, 65, 66, 300, 300, 1100)]
        sets += [np.concatenate([s[len(s) // 9:], rng.integers(0, 1 << 64, 3, np.uint64)]) for s in sets]
        maps = np.array([J.parity_map(s) for s in sets], object)
        i, j = (k.ravel() for k in np.indices((len(sets),) * 2))
        got = J.apart_at_least(maps, i, j)
        for k, p, q in zip(got.tolist(), i.tolist(), j.tolist()):
            assert k <= len(np.setxor1d(sets[p], sets[q]))
        if most > 2:
            assert got[6 * len(sets) + 7] > J._apart(300, 300, 85) * 3


def test_folded_maps_are_short_and_tell_unlike_sets():
    rng = np.random.default_rng(6)
    for n in (5, 300, 1100, 2313, 9000):
        sets = [rng.integers(0, 1 << 64, n, np.uint64) for _ in range(2)]
        sets.append(np.concatenate([sets[0][n // 20:], sets[1][:n // 20]]))
        maps = np.array([J.folded(J.parity_map(s), n, 85) for s in sets], object)
        unlike, like = J.apart_at_least(maps, np.array([0, 0]), np.array([1, 2])).tolist()
        assert like <= 2 * (n // 20) and 8 * len(maps[0]) <= max(512, n)
        assert unlike > J._apart(n, n, 85)


def test_unlike_sets_of_a_list_are_not_compared(spark, monkeypatch):
    """Rare words that many unlike texts share put these into common lists: neither the
    lists' centres nor pairs of the others are looked up in the texts."""
    compared = []
    plain = J.compared

    def spy(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(J, "compared", spy)
    rows = [(k, "one rare line here " + " ".join(f"u{k}-{i}" for i in range(60))) for k in range(300)]
    assert len(J.jaccard_components(awkward(spark, rows), 4, 85).where("component_id = doc_id").collect()) == 300
    assert sum(compared) == 0


def test_differences_list_shared_tokens_only_and_steps_leave_no_tables(spark, monkeypatch):
    from pyspark.sql import functions as F
    alone, stored = [], []
    plain, written = J._Join.differences, J.written

    def spy(self, hot):
        out = plain(self, hot)
        alone.append(out.groupBy("g", "token").agg(F.count("*").alias("m")).where("m = 1").count())
        return out

    def kept(df, name):
        out = written(df, name)
        stored.append((name, out.inputFiles()[0]))
        return out

    monkeypatch.setattr(J, "LIST", 4)
    monkeypatch.setattr(J._Join, "differences", spy)
    monkeypatch.setattr(J, "written", kept)
    rows = list(enumerate(family(1, 40, 120, 9)))
    assert got(awkward(spark, rows), 4, 85) == brute(rows, 4, 85)
    assert alone and not any(alone)
    left = {name for name, file in stored if os.path.exists(unquote(urlparse(file).path))}
    assert left <= {"sketches", "classes"}, left


def test_lists_and_groups_give_each_set_once(spark, monkeypatch):
    """Sets that lists hold together come out as members of a group, not as pairs; a group's
    texts, in blocks, give no more links than there are texts."""
    passed = []
    plain = J.linked
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 1 << 64, 100, np.uint64)
    entries = spark.createDataFrame([(0, t, x, 100, 100, t, 60, x) for x in range(60) for t in range(3)],
                                    "g long, token long, x long, n int, d int, pos int, m long, component long")
    maps = spark.createDataFrame([(x, bytearray(J.parity_map(tokens))) for x in range(60)], "x long, map binary")
    got_ = [(r.u, r.v) for r in J.candidates(entries, maps, 85).collect()]
    assert len(got_) <= 3 * 59 and {v for _, v in got_} | {u for u, _ in got_} == set(range(60))

    def spy(members, *rest):
        out = plain(members, *rest)
        passed.append((members.select("x").distinct().count(), members.count(), out.count()))
        return out

    monkeypatch.setattr(J, "linked", spy)
    monkeypatch.setattr(J, "BLOCK", 20)
    rows = list(enumerate(family(1, 50, 120, 3) + family(2, 20, 60, 3)))
    assert got(awkward(spark, rows).repartition(3), 4, 85) == brute(rows, 4, 85)
    assert len(passed) == 1 and passed[0][0] == passed[0][1] > 40 and passed[0][2] < 4 * passed[0][1]


def test_rows_are_joined_to_their_groups():
    rng = np.random.default_rng(5)
    for n in (1, 2, 30, 200):
        p, q = rng.integers(0, n, (2, n // 2))
        label = np.arange(n)
        J._joined(label, p[:n // 4], q[:n // 4])
        J._joined(label, p, q)
        want = np.arange(n)
        for _ in range(n):
            for i, j in zip(p, q):
                want[i] = want[j] = min(want[i], want[j])
        assert label.tolist() == want.tolist()


def test_known_links_are_links():
    rng = np.random.default_rng(2)
    for _ in range(300):
        r = set(range(100))
        x, y = (r - set(rng.choice(100, rng.integers(0, 14)).tolist()) | set(rng.integers(100, 140, rng.integers(0, 10)).tolist())
                for _ in range(2))
        score = [185 * len(s ^ r) - 15 * len(s) for s in (x, y)]
        if sum(score) <= 0:
            assert 100 * len(x & y) >= 85 * len(x | y)


def test_orders_agree(spark):
    docs = awkward(spark, corpus(1, 60) + family(3, 30))
    heavy = J.heavy_tokens(docs, 4)
    assert len(heavy[0]) and (np.diff(heavy[0].astype(object)) > 0).all()
    some = np.concatenate([heavy[0][:50], np.arange(1, 40, dtype=np.uint64)])
    all_ = J.ordered(some, heavy).tolist()
    part = J.ordered(some[::2], heavy).tolist()
    assert [t for t in all_ if t in set(part)] == part


def test_empty_tables(spark):
    assert J.jaccard_components(empty(spark), 4, 85).collect() == []
    assert got(awkward(spark, ["", None]), 4, 85) == [(True, 0, 0, 0), (True, 1, 0, 1)]
