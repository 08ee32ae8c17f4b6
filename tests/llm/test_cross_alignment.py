import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarrysight.llm import cross_alignment as X
from quarrysight.llm.queries import BYTE_BPE, PIECES, vocabulary

from .helpers import awkward, empty

A_PATH, B_PATH = vocabulary(BYTE_BPE), vocabulary(PIECES)

TEXTS = [
    "The cat sat on the mat.", "", None, " ", "  two  spaces ", "tab\there\nline\r\nend ", "日本語のテキスト です", "naïve café — “quotes”",
    "😀😃 smile 👩‍👩‍👧‍👦 family", "a▁b has the mark", "<s> </s> <unk> <|endoftext|> <0x41>", "x" * 700 + " long", "nul\x00byte here",
    " nbsp  mixed", "The cat sat on the mat.", "don't can't we'll I'd", "1234567 3.14 1,000,000", "ༀ ⃟ ͸ \U000e0041 odd", "Ünïcödé Über straße",
    "a" * 3, " leading", "trailing ", "\n\n\n", "▁", "word sep word", "é combining",
]


def tokens():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = X.byte_letters()
    return (lambda t: [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids],
            lambda t: [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else
                        b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(t)])


def brute(texts):
    """What the contract says, byte by byte."""
    a_of, b_of = tokens()
    docs = []
    for t in texts:
        a, b = (a_of(t), b_of(t)) if t else ([], [])
        raw = (" " + (t or "")).encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            docs.append(([], [], [], []))
            continue
        ends_a = dict(zip(np.cumsum([len(x) for _, x in a]).tolist(), range(len(a))))
        ends_b = dict(zip(np.cumsum([len(x) for _, x in b]).tolist(), range(len(b))))
        groups, links, p, q = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a[end], ends_b[end]
            groups.append(",".join(str(x) for x, _ in a[p:i + 1]) + "|" + ",".join(str(x) for x, _ in b[q:j + 1]))
            links.append((a[i][0], b[j][0]))
            p, q = i + 1, j + 1
        docs.append((a, b, groups, links))
    counts = Counter(x for d in docs for x in d[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(len(a), len(b), len(g), len(k), sum(counts[x] == best[x[1]] for x in k), sum(counts[x] for x in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for a, b, g, k in docs]


def corpus(seed, n):
    rng = random.Random(seed)
    words = [w for t in TEXTS if t for w in t.split(" ")]
    return ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", ", ", ". ", ""]) for _ in range(rng.randint(1, 60)))
            for _ in range(n)]


@pytest.fixture(scope="module")
def parts():
    aligner = X.Aligner(A_PATH, B_PATH)
    return aligner, X.Pairs(aligner.a_bytes, aligner.b_bytes)


def test_documents_match_a_search(spark):
    texts = TEXTS + corpus(3, 60)
    got = X.cross_align(awkward(spark, texts).repartition(3), A_PATH, B_PATH).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts) and [r.doc_id for r in got] == list(range(len(texts)))


def test_repeated_and_null_ids_and_empty_tables(spark):
    docs = awkward(spark, [(None, "one two"), (1, "one two"), (1, "three")])
    got = X.cross_align(docs, A_PATH, B_PATH).collect()
    assert sorted((r.doc_id is None, r.n_links) for r in got) == [(False, 1), (False, 2), (True, 2)]
    assert X.cross_align(empty(spark), A_PATH, B_PATH).collect() == []


def test_words_put_together_are_the_whole_text(parts):
    aligner, pairs = parts
    words = X.Words(aligner, pairs)
    texts = [t for t in TEXTS if t] + corpus(8, 80)
    groups, links, sizes = X.aligned_texts(pa.array(texts), aligner, words)
    for t, g, k, n in zip(texts, groups, links, sizes):
        whole = aligner.align(t)
        assert g == ";".join(whole.groups()).encode() and tuple(n) == (len(whole.a.ids), len(whole.b.ids))
        k = np.frombuffer(k, np.int32)
        assert (k == pairs.index(*whole.links)).all() and (pairs.codes[k] == whole.links[0] * pairs.n_b + whole.links[1]).all()


def test_a_full_table_of_words_starts_anew(parts, monkeypatch):
    aligner, pairs = parts
    monkeypatch.setattr(X, "KEPT", 2000)
    words = X.Words(aligner, pairs)
    for seed in range(4):
        for t, g in zip(corpus(seed, 5), X.aligned_texts(pa.array(corpus(seed, 5)), aligner, words)[0]):
            assert g == ";".join(aligner.align(t).groups()).encode()


def test_spans_agree_with_decoded_bytes(parts, monkeypatch):
    """The coarse cuts place nearly all tokens; only parts of characters need bytes."""
    aligner, _ = parts
    for t in filter(None, TEXTS):
        got = aligner.align(t)
        for s, table in ((got.a, aligner.a_sizes), (got.b, aligner.b_sizes)):
            assert (s.ends == np.cumsum(table[s.ids])).all()
    # spans of "日" as three byte pieces, and of a word
    start, end = np.array([0, 1, 1, 1, 4]), np.array([1, 4, 4, 4, 9])
    assert X._placed(start, end, np.array([1, 1, 1, 1, 5])).tolist() == [1, 2, 3, 4, 9]
    assert X._placed(np.array([0, 1]), np.array([1, 3]), np.array([1, 4])).tolist() == [1, 5]


def test_every_link_ends_alike(parts):
    aligner, pairs = parts
    rng = np.random.default_rng(0)
    for code in rng.choice(pairs.codes, 500).tolist():
        a, b = aligner.a_bytes[code // pairs.n_b], aligner.b_bytes[code % pairs.n_b]
        assert a.endswith(b) or b.endswith(a)
    assert len(pairs) < 20 * (len(aligner.a_bytes) + len(aligner.b_bytes))


def test_the_operator_gives_the_groups_themselves(spark, parts):
    _, pairs = parts
    out = X.align_documents(awkward(spark, ["The cat"]), A_PATH, B_PATH, pairs).select(
        F.decode("groups", "UTF-8").alias("groups"), (F.octet_length("links") / 4).alias("n")).first()
    a_of, b_of = tokens()
    assert out.groups.count("|") == out.n and out.groups.replace("|", ";").split(";")[0] == str(a_of("The cat")[0][0])
