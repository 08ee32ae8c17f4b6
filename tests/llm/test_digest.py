import hashlib
from collections import Counter

import numpy as np

from quarrysight.llm import quartile_digest as Q

from .helpers import awkward, empty

TEXTS = ["", None, "abc", "abcd" * 20, "le chat noir, " * 30, "x" * 400000, (1000, "tie b"), (1000, "tie a"), (None, "null id"), "é" * 100]


def test_counts_against_a_loop():
    def slow(raw):
        n = Counter()
        for i in range(len(raw) - 3):
            for (a, b, c), salt in zip(Q.TRIPLETS, Q._SALTS.tolist()):
                v = raw[i + a] | raw[i + b] << 8 | raw[i + c] << 16
                v = (v ^ v >> 11) * salt & 0xFFFFFFFF
                v = (v ^ v >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
                n[v >> 25] += 1
        return [n[k] for k in range(Q.BUCKETS)]
    texts = [b"", b"abc", b"hello there", "é\n".encode() * 9, b"abcd" * 200]
    assert Q.bucket_counts(texts).tolist() == [slow(t) for t in texts]
    long = bytes(range(1, 251)) * 2000        # more than a block
    assert Q.bucket_counts([long, b"abcdef"]).sum() == 3 * (len(long) - 3) + 9


def test_digest_and_likeness():
    a, b = (" ".join(f"w{(i * k) % 97}" for i in range(400)).encode() for k in (3, 5))
    near = a[:-200] + b[:200]
    codes = Q.digest_codes([a, a, near, b, b"", b""])
    assert (codes[0] == codes[1]).all()
    like = Q.likeness(codes[[0, 0, 4, 0]], codes[[1, 2, 5, 4]])
    assert like[0] == 1 and like[2] == 1 and 0 <= like[3] < like[1] < 1
    for c, text in zip(codes, Q.digest_text(codes)):
        assert len(text) == 2 * (2 + Q.BUCKETS // 4)
        assert (Q.parse_digest(text) == c).all()


def test_documents_against_brute_force(spark):
    docs = awkward(spark, TEXTS + [f"document number {i} " * (i % 9 + 1) for i in range(50, 250)]).repartition(6)
    got = Q.fingerprint_documents(docs).collect()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in docs.collect())
    assert len(got) == len(rows)
    texts = [t for _, t in rows]
    if [t for t in texts if t.startswith("tie")] != ["tie a", "tie b"]:
        raise AssertionError
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, ((has, k), t) in enumerate(rows):
        if k == 1000 and has or i and rows[i - 1][0] == (True, 1000) or i + 1 < len(rows) and rows[i + 1][0] == (True, 1000):
            continue                          # equal doc_ids go in an order of their own
        after = texts[(i + 1) % len(texts)]
        n = len(t)
        edited = t[:n - n // 4] + after[:n // 4]
        c = Q.digest_codes([x.encode() for x in (t, edited, after)])
        (r,) = by_id[k if has else None]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert [r.fingerprint, r.edited_fingerprint] == Q.digest_text(c[:2])
        assert np.isclose(r.near_edited, Q.likeness(c[:1], c[1:2])[0]) and np.isclose(r.near_next, Q.likeness(c[:1], c[2:])[0])
    assert len(by_id[1000]) == 2


def test_one_and_none(spark):
    (r,) = Q.fingerprint_documents(awkward(spark, ["abcdefgh"])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1
    assert Q.fingerprint_documents(empty(spark)).count() == 0
