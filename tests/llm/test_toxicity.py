import random

import numpy as np
import pytest

from quarrysight.llm import toxicity as T

from .helpers import awkward, empty

BAD = ["idiot", "moron", "scum", "loser", "stupid"]


def make(n, seed, disguise=False):
    rng = random.Random(seed)
    parts = ["the", "and", "ing", "er", "on", "st", "re", "ly", "tion", "en", "wh", "ou", "th"]
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(15, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                b = rng.choice(BAD)
                if disguise:
                    b = rng.choice([b.replace("o", "0").replace("i", "1").replace("u", "*"), " ".join(b), b[0] + b[1] * 4 + b[2:],
                                    ".".join(b)])
                w.insert(rng.randrange(len(w)), b)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def english():
    rows, _ = make(400, 1)
    counts = np.zeros((T.CLASSES,) * 3)
    for _, text in rows:
        for word in text.split():
            c = [0, 0, *map(T._class, word), 0]
            for i in range(2, len(c)):
                counts[c[i - 2], c[i - 1], c[i]] += 1
    return T.character_model(counts)


def test_restoration(english):
    for token, want in (("1d10t", "idiot"), ("m0r0n", "moron"), ("sc*m", "scum"), ("l.o.s.e.r", "loser"), ("looooser", "loser"),
                        ("$tup1d", "stupid"), ("id-iot!!", "idiot")):
        assert T.restore_token(token, english) == [want], token
    assert T.restore_token("plain", english) == T.restore_token("word,", english) == T.restore_token("", english) == []
    assert ["idiot"] in T.restore_spaced("and i d i o t the", english)
    assert T.deobfuscate("The m0r0n  and", english) == "the moron  and"
    assert T.restore_spaced("a " * 2000, english)


def test_decoding_against_all_paths(english):
    def cost(text):
        a = b = 0
        total = 0.0
        for ch in text + " ":
            c = T._class(ch)
            total += float(english[a, b, c])
            a, b = (b, c) if c else (0, 0)
        return total
    import itertools
    for token in ("1d10t", "5c0|", "th3|0"):
        lattice = T._symbols(token, False)
        paths = ((("".join(x for x, _ in p)), sum(c for _, c in p)) for p in itertools.product(*lattice))
        best = max(cost(t) - c for t, c in paths)
        got = T.decode(lattice, english)
        paid = min(sum(c for _, c in p) for p in itertools.product(*lattice) if "".join(x for x, _ in p) == got)
        assert abs(cost(got) - paid - best) < 1e-3


def test_trigram_counts(spark):
    c = T.trigram_counts(awkward(spark, ["ab A", None, "b"]))
    k = {x: T._class(x) for x in "ab"}
    assert c[0, 0, k["a"]] == 2 and c[0, k["a"], k["b"]] == 1 and c[k["a"], k["b"], 0] == 1 and c[0, k["b"], 0] == 1
    assert c.sum() == 2 * 4 + 0 - 1      # each word: its letters and the boundary after it


def test_held_out_accuracy_plain_and_disguised(spark):
    rows, labels = make(500, 2)
    more, truth = make(120, 3)
    hidden, _ = make(120, 4, disguise=True)
    docs = awkward(spark, rows + [(1000 + i, t) for i, t in more] + [(2000 + i, t) for i, t in hidden]
                   + [(3000, ""), (3001, None), (None, "idiot moron scum"), (3002, "idiot moron " * 20000), (3003, "x"), (3003, "x")])
    got = {}
    out = T.score_documents(docs, spark.createDataFrame(labels + [(None, 1), (9999, 1), (1, None)], "doc_id long, toxic int")).collect()
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        got[r.doc_id] = r.predicted
    assert len(out) == docs.count()
    assert sum(got[1000 + i] == y for i, y in truth) >= 118
    assert sum(got[2000 + i] == y for i, y in truth) >= 110
    assert got[3000] == got[3001] == got[3003] == 0 and got[None] == got[3002] == 1


def test_empty_and_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.score_documents(empty(spark), labels).count() == 0
    (r,) = T.score_documents(awkward(spark, ["some text"]), labels).collect()
    assert abs(r.score - T.BASE) < 1e-9


def test_every_labelled_row_is_learned_from(spark):
    # all share their only long word
    bad, good = ["zab", "zcd", "zef", "zgh", "zij", "zkl"], ["yab", "ycd", "yef", "ygh", "yij", "ykl"]
    texts = [f"together {w}" for w in bad + good]
    labels = [(i, int(i < len(bad))) for i in range(len(texts))]
    model = T.character_model(np.zeros((T.CLASSES,) * 3))
    shares, _ = T.learn(awkward(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"), model)
    assert {w for w in shares if w[0] == "z"} == set(bad)
    # a copy adds nothing
    more = spark.createDataFrame(labels + [(len(texts), 1)], "doc_id long, toxic int")
    assert T.learn(awkward(spark, [*texts, "Together ZAB"]), more, model)[0] == shares
