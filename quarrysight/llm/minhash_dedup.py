"""Near-duplicate classes by MinHash with tensored banding.

A text's set is that of its distinct word shingles. Two small collections of
MinHash groups are computed; the key of table (i, j) combines the i-th group of
one with the j-th of the other, so that G x H tables cost G and H groups, not
their product. Texts that share a key are candidates; a link counts once the
full sets confirm it.

Large buckets do not make all pairs. Texts with equal sets stand as one. First
each bucket links its members to its smallest, its centre. Texts that share a
bucket share its centre, so what these links leave apart is then compared within
each centre's members, on full sets and across components only; a large group
goes out as pairs of blocks, each a bounded task that returns no more links than
it has members. Members already joined need no comparing.

With the groups below, a pair just at the threshold misses all tables with
probability under 0.0004 (85 %) or 0.002 (80 %), falling fast above it.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of
fewer words than a shingle is one shingle, an empty or null text has none and is
linked with nothing; equal texts are linked; rows with equal doc_id are one
document with all their texts' links; a row with null doc_id is linked with
nothing and has no component; texts are never cut; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, worker_drops, written
from .components import components

ROWS_A, ROWS_B = 2, 3                # MinHashes in a group of either collection
GROUPS = {85: (7, 9), 80: (8, 10)}   # groups of either, by threshold in percent
BLOCK = 512                          # texts of a group compared at once
WORD = r"[^\x20\x09-\x0D]"          # what a text with words has
SLICE = 64                           # documents hashed at once, and at most
HASHED = 1 << 19                     # so many bytes of text, or one text

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _constants(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(_U(seed) + np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


_PLACE = _constants(64, 7)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each UTF-8 text. A word's hash
    sums mixed (byte, place) values, so no word is cut and none is looped over."""
    if len(texts) > 1 and sum(map(len, texts)) > HASHED:
        half = len(texts) // 2
        return shingle_sets(texts[:half], words) + shingle_sets(texts[half:], words)
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * 32
    letter = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.diff(letter.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return [np.empty(0, np.uint64) for _ in texts]
    sizes = ends - starts
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    each = _mix((raw[letter].astype(np.uint64) | place.astype(np.uint64) << _U(8)) + _U(0x9E3779B97F4A7C15))
    word = _mix(np.add.reduceat(each, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64) * _PLACE[63])
    # words of each document
    first = np.cumsum([0, *[len(t) + 1 for t in texts]])
    at = np.searchsorted(starts, first)
    n = len(word)
    k = min(words, n)
    run = np.zeros(n, np.uint64)
    for j in range(k):
        run[:n - j] += word[j:] * _PLACE[j]
    run = _mix(run)
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        if hi - lo >= words:
            out.append(np.unique(run[lo:hi - words + 1]))
        elif hi > lo:
            short = (word[lo:hi] * _PLACE[:hi - lo]).sum(dtype=np.uint64) + _U(hi - lo)
            out.append(_mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """MinHash (uint32) of a set under each key."""
    out = np.full(len(keys), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 4096):
        some = values[at:at + 4096]
        for j, key in enumerate(keys):
            out[j] = min(out[j], ((some ^ key) * key).min())
    return (out >> _U(32)).astype(np.uint32)


def _groups(sig: np.ndarray, g: int, h: int) -> tuple[np.ndarray, np.ndarray]:
    """The two collections: each group's MinHashes as one 64-bit value."""
    wide = sig.astype(np.uint64)
    a = _mix((wide[:g * ROWS_A].reshape(g, ROWS_A) * _PLACE[:ROWS_A]).sum(axis=1, dtype=np.uint64))
    b = _mix((wide[g * ROWS_A:].reshape(h, ROWS_B) * _PLACE[8:8 + ROWS_B]).sum(axis=1, dtype=np.uint64))
    return a.view(np.int64), b.view(np.int64)


SKETCH = "doc_id long, n long, digest binary, a array<long>, b array<long>"


def sketches(docs: DataFrame, words: int, g: int, h: int) -> DataFrame:
    """Per row: shingle count, 128-bit digest of the set and the two collections,
    these null for an empty set. No shuffle."""
    keys = _constants(g * ROWS_A + h * ROWS_B, 1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_drops()
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                sets = shingle_sets([t.encode() for t in piece.column(1).to_pylist()], words)
                rows: list = []
                for s in sets:
                    if len(s):
                        rows.append((hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                     *_groups(signature(s, keys), g, h)))
                    else:
                        rows.append((None, None, None))
                yield pa.record_batch({
                    "doc_id": piece.column(0), "n": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([r[0] for r in rows], pa.binary()),
                    "a": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                    "b": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})

    return docs.mapInArrow(sketch, SKETCH)


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v) of doc_ids whose full sets reach the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                left, right = piece.column(2).to_pylist(), piece.column(3).to_pylist()
                some = list(dict.fromkeys(left + right))
                sets = dict(zip(some, shingle_sets([t.encode() for t in some], words)))
                keep = []
                for x, y in zip(left, right):
                    p, q = sets[x], sets[y]
                    if len(p) > len(q):
                        p, q = q, p
                    if 100 * len(p) < percent * len(q) or not len(p):
                        keep.append(False)
                        continue
                    at = np.searchsorted(q, p)
                    both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                    keep.append(100 * both >= percent * (len(p) + len(q) - both))
                yield pa.record_batch({"u": piece.column(0), "v": piece.column(1)}).filter(pa.array(keep))

    # the documents' exchange is the same on either side, so Spark makes it once
    texts = docs.select("doc_id", "text")
    one = texts.select(F.col("doc_id").alias("_p"), F.col("text").alias("text_u"))
    two = texts.select(F.col("doc_id").alias("_q"), F.col("text").alias("text_v"))
    both = pairs.join(two, F.col("v") == F.col("_q")).join(one, F.col("u") == F.col("_p"))
    return both.select("u", "v", "text_u", "text_v").mapInArrow(check, "u long, v long").distinct()


def _links_across(ids: list[int], comp: list[int], own: list[int], texts: list[str], words: int,
                  percent: int) -> list[tuple[int, int]]:
    """Links that join components among the rows of one block, or of two if
    ``own`` has two values: then only those from one to the other."""
    sets: list[np.ndarray] = []
    for at in range(0, len(texts), SLICE):
        sets += shingle_sets([t.encode() for t in texts[at:at + SLICE]], words)
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    root, side = np.array(comp), np.array(own)
    two = side.min() != side.max()
    marked = np.zeros(codes.max() + 1, np.int64)
    out = []
    for i in range(len(ids)):
        near = (root != root[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        if two:
            near &= side != side[i]
        else:
            near[:i] = False
        if not near.any():
            continue
        mine = codes[starts[i]:starts[i] + sizes[i]]
        marked[mine] = 1
        both = np.add.reduceat(marked[codes], starts)
        marked[mine] = 0
        for j in np.flatnonzero(near & (100 * both >= percent * (sizes + sizes[i] - both))).tolist():
            if root[j] != root[i]:
                out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                root[root == root[j]] = root[i]
    return out


def _remaining(stars: DataFrame, placed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between members of a centre that ``placed`` (node, component) holds
    apart. ``stars`` are (u, v), centre and member."""
    rows = stars.join(placed, F.col("v") == F.col("node"), "left").select(
        F.col("u").alias("key"), "v", F.coalesce("component", "v").alias("component"))
    mixed = (
        rows.groupBy(F.col("key").alias("_key")).agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high").select("_key"))
    members = written(rows.join(mixed, F.col("key") == F.col("_key")).select("key", "v", "component"), "members")
    # each text with words of a member once; a member may have several
    texts = written(
        docs.select(F.col("doc_id").alias("_id"), "text").where(F.col("text").rlike(WORD))
        .join(members.select(F.col("v").alias("_v")).distinct(), F.col("_id") == F.col("_v"), "left_semi").distinct(),
        "texts")
    counts = texts.groupBy(F.col("_id").alias("_v")).agg(F.count("*").alias("n"))
    sizes = (
        members.join(counts, F.col("v") == F.col("_v")).groupBy(F.col("key").alias("_key"))
        .agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks")))
    out = (
        members.join(sizes, F.col("key") == F.col("_key")).join(texts, F.col("v") == F.col("_id"))
        .withColumn("own", F.pmod(F.xxhash64("v", "text"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                "v", "component", "own", "text")
        .repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []

        def links() -> Iterator[pa.RecordBatch]:
            ids, comp, own, text = zip(*group) if group else ((), (), (), ())
            if len(set(comp)) > 1:
                found = _links_across(list(ids), list(comp), list(own), list(text), words, percent)
                yield pa.record_batch({"u": pa.array([p for p, _ in found], pa.int64()),
                                       "v": pa.array([q for _, q in found], pa.int64())})

        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                for key, lo, hi, *row in zip(*(c.to_pylist() for c in batch.slice(i, SLICE).columns)):
                    if (key, lo, hi) != at:
                        yield from links()
                        at, group = (key, lo, hi), []
                    group.append(row)
        yield from links()

    return out.mapInArrow(scan, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id
    (smallest doc_id reachable over links), kept (it is that document)."""
    if percent < min(GROUPS):
        raise ValueError(f"no groups are proven for a threshold under {min(GROUPS)} percent")
    g, h = GROUPS.get(percent, GROUPS[80])
    docs = docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
    rows = written(sketches(docs, words, g, h), "sketches")
    usable = rows.where("n > 0 and doc_id is not null")
    classes = written(
        usable.groupBy("digest").agg(F.min("doc_id").alias("u"), *[F.first(c).alias(c) for c in ("a", "b")]),
        "classes")

    keys = F.flatten(F.transform("a", lambda x, i: F.transform(
        "b", lambda y, j: F.xxhash64(x, y, i * F.lit(h) + j))))
    tables = classes.select("u", F.explode(keys).alias("key"))
    buckets = (
        tables.groupBy(F.col("key").alias("_key")).agg(F.min("u").alias("low"), F.max("u").alias("high"))
        .where("low < high").select("_key", "low"))

    # first each member against its bucket's smallest, then what that leaves apart
    stars = written(
        tables.join(buckets, F.col("key") == F.col("_key")).where("u != low")
        .select(F.col("low").alias("u"), F.col("u").alias("v")).distinct(), "stars")
    links = written(confirmed(stars, docs, words, percent), "links")
    # one document with several texts holds their classes together
    several = (
        usable.groupBy(F.col("doc_id").alias("_id")).agg(
            F.min(F.xxhash64("digest")).alias("x"), F.max(F.xxhash64("digest")).alias("y"))
        .where("x != y").select("_id"))
    tied = (
        usable.select("doc_id", "digest").join(several, F.col("doc_id") == F.col("_id"))
        .join(classes.select(F.col("digest").alias("_digest"), "u"), F.col("digest") == F.col("_digest"))
        .select("u", F.col("doc_id").alias("v")))
    links = written(links.unionByName(tied), "links")
    first = components(links)

    more = written(_remaining(stars, first, docs, words, percent), "links")
    final = components(first.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))

    placed = classes.join(final, F.col("u") == F.col("node"), "left").select(
        F.col("digest").alias("_digest"), F.coalesce("component", "u").alias("_component"))
    return (
        rows.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
        .join(placed, F.col("digest") == F.col("_digest"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.coalesce("_component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )
