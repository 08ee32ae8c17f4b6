"""Document fingerprints: quartile bucket digest.

Every window of four bytes gives three byte triplets, hashed into 128 buckets.
The digest keeps, per bucket, the quartile of its count among all buckets (two
bits), the ratios of the quartiles and the logarithm of the length. Digests are
compared by a bounded difference score; ``likeness`` is 1 minus its share of the
largest score.

Defined cases: null text is empty; a text under four bytes has no triplet, so
all its buckets lie in the lowest quartile; equal texts have equal digests; very
long texts are counted in blocks and never cut; an empty table gives no rows;
rows go by doc_id (null first), rows with equal doc_id by text; other columns
are not read. A single document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty, written

BUCKETS = 128
BLOCK = 1 << 18          # bytes counted at once, about
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))   # of a window of four bytes
LENGTH_BASE = 1.2        # a step of the length code is this factor
FAR = 6                  # score of buckets three quartiles apart
MOST_LENGTH = 60         # bounds of the header's part of the score
MOST_RATIO = 15
MOST_SCORE = BUCKETS * FAR + MOST_LENGTH + 2 * MOST_RATIO

_SALTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def bucket_counts(texts: list[bytes]) -> np.ndarray:
    """Triplet counts (text, bucket). Texts are counted together, up to a block."""
    out = np.zeros((len(texts), BUCKETS), np.int64)
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK):
            size += len(texts[end])
            end += 1
        group = texts[at:end]
        # one text over the block's size is counted by pieces that share three bytes
        step = BLOCK if len(group) == 1 else max(size, 1)
        whole = b"".join(group)
        for lo in range(0, max(len(whole), 1), step):
            raw = np.frombuffer(whole[lo:lo + step + (3 if len(group) == 1 else 0)], np.uint8).astype(np.uint32)
            n = len(raw) - 3
            if n <= 0:
                continue
            lengths = [len(raw)] if len(group) == 1 else [len(t) for t in group]
            owner = np.repeat(np.arange(len(lengths)), lengths)
            inside = owner[:n] == owner[3:]
            where = owner[:n][inside] * BUCKETS
            for (a, b, c), salt in zip(TRIPLETS, _SALTS):
                code = raw[a:a + n] | raw[b:b + n] << np.uint32(8) | raw[c:c + n] << np.uint32(16)
                code = (code ^ (code >> np.uint32(11))) * salt
                code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                hit = where + (code >> np.uint32(25))[inside]
                out[at:end] += np.bincount(hit, minlength=len(group) * BUCKETS).reshape(-1, BUCKETS)
        at = end
    return out


def digest_codes(texts: list[bytes]) -> np.ndarray:
    """Rows of (length code, two quartile ratios, quartile of each bucket)."""
    counts = bucket_counts(texts)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    codes = np.empty((len(texts), 3 + BUCKETS), np.int16)
    sizes = np.array([len(t) for t in texts], float)
    codes[:, 0] = np.minimum(255, np.floor(np.log(np.maximum(sizes, 1)) / np.log(LENGTH_BASE)))
    top = np.maximum(q3, 1)
    codes[:, 1], codes[:, 2] = q1 * 100 // top % 16, q2 * 100 // top % 16
    codes[:, 3:] = (counts > q1[:, None]).astype(np.int16) + (counts > q2[:, None]) + (counts > q3[:, None])
    return codes


def digest_text(codes: np.ndarray) -> list[str]:
    """Codes as hex: length, two ratios, then four buckets to a byte."""
    two = codes[:, 3:].reshape(len(codes), -1, 4).astype(np.uint8)
    packed = two[:, :, 0] << 6 | two[:, :, 1] << 4 | two[:, :, 2] << 2 | two[:, :, 3]
    head = np.stack([codes[:, 0].astype(np.uint8), (codes[:, 1] << 4 | codes[:, 2]).astype(np.uint8)], axis=1)
    return [bytes(r).hex() for r in np.concatenate([head, packed], axis=1)]


def parse_digest(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), np.uint8)
    two = np.stack([raw[2:] >> 6 & 3, raw[2:] >> 4 & 3, raw[2:] >> 2 & 3, raw[2:] & 3], axis=1).reshape(-1)
    return np.concatenate([[raw[0], raw[1] >> 4, raw[1] & 15], two]).astype(np.int16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 for the largest difference; row by row."""
    gap = np.abs(a - b)
    far = np.where(gap[:, 3:] == 3, FAR, gap[:, 3:]).sum(axis=1)
    length = np.minimum(MOST_LENGTH, np.where(gap[:, 0] <= 1, gap[:, 0], 4 * gap[:, 0]))
    ring = np.minimum(gap[:, 1:3], 16 - gap[:, 1:3])
    ratio = np.minimum(MOST_RATIO, np.where(ring <= 1, ring, 2 * (ring - 1))).sum(axis=1)
    return 1.0 - (far + length + ratio) / MOST_SCORE


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
STAGED = FIELDS + ", part int, role string, text string"


def _compare(ids: list, texts: list[str], following: list[str], next_codes: np.ndarray | None = None) -> dict:
    """Result columns of documents, given the text that follows each."""
    sizes = [len(t) for t in texts]
    edited = [(t[:n - n // 4] + f[:n // 4]).encode() if n // 4 <= len(f) else
              (t[:n - n // 4] + f).encode() for t, f, n in zip(texts, following, sizes)]
    own = digest_codes([t.encode() for t in texts])
    after = digest_codes([f.encode() for f in following]) if next_codes is None else next_codes(own)
    changed = digest_codes(edited)
    return {
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array(sizes, pa.int64()),
        "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
        "fingerprint": digest_text(own), "edited_fingerprint": digest_text(changed),
        "near_edited": likeness(own, changed), "near_next": likeness(own, after)}


def _staged(columns: dict, n: int, part: int, role: str, texts: list | None) -> pa.RecordBatch:
    return pa.record_batch({
        **columns, "part": pa.array([part] * n, pa.int32()), "role": pa.array([role] * n, pa.string()),
        "text": pa.array(texts or [None] * n, pa.string())})


def _edge(ids: list, texts: list[str], part: int, role: str) -> pa.RecordBatch:
    n = len(ids)
    blank = {"doc_id": pa.array(ids, pa.int64()), "n_chars": pa.nulls(n, pa.int64())}
    blank |= {k: pa.nulls(n, pa.string()) for k in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    blank |= {k: pa.nulls(n, pa.float64()) for k in ("near_edited", "near_next")}
    return _staged(blank, n, part, role, texts)


SLICE = 256   # documents digested at once


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text): its digest, that of its text with the last
    quarter replaced by the start of the next document's, and the likeness of
    its digest to that one and to the next document's. Texts shuffle once, into
    doc_id ranges; only the first and last text of each range is looked at again."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: tuple[list, list[str]] = ([], [])     # the last document so far
        seen = False
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                ids, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                if not seen:
                    yield _edge(ids[:1], texts[:1], part, "head")
                    seen = True
                ids, texts = held[0] + ids, held[1] + texts
                n = len(ids) - 1
                if n:
                    whole = digest_codes([t.encode() for t in texts[n:]])
                    yield _staged(_compare(ids[:n], texts[:n], texts[1:],
                                           lambda own: np.concatenate([own[1:], whole])), n, part, "row", None)
                held = ids[n:], texts[n:]
        if seen:
            yield _edge(*held, part, "tail")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch(_compare(*(batch.column(i).to_pylist() for i in range(3))))

    staged = written(
        docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
        .mapInArrow(scan, STAGED), "digest")
    # one row per range: a short list, and without texts
    parts = staged.where("role = 'head'").select("part")
    order = Window.orderBy("part")
    follow = parts.select(
        F.col("part").alias("_part"),
        F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("_next"))
    heads = staged.where("role = 'head'").select(F.col("part").alias("_next"), F.col("text").alias("_following"))
    last = (
        staged.where("role = 'tail'").join(follow, F.col("part") == F.col("_part")).join(heads, "_next")
        .select("doc_id", "text", "_following").mapInArrow(finish, FIELDS)
    )
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return staged.where("role = 'row'").select(*names).unionByName(last)
