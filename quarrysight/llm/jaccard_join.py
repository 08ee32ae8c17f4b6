"""Jaccard self-join of n-gram sets that uses how sets relate to each other.

Two sets are linked if their Jaccard similarity reaches the threshold: with sizes N
in sum and D tokens in only one of them, (100 + P) D <= (100 - P) N.

Index lists. Every set is put in one order, tokens that tasks met often last. A linked
pair shares a token among the first n - ceil(P n / 100) + 1 of either, so these are
listed by token with the set's size and the token's position. A list's entries stand in
blocks of equal size and position; two blocks are skipped whole if what follows their
positions, or their sizes, cannot make a link with this as their first common token.

Parity maps. A set's map has a bit for each value of the lowest bits of its tokens, set
if an odd number of them have it; at least as many bits as tokens. Tokens in both of two
sets cancel out, so their maps differ in at most D bits: two sets whose maps differ in
more than a link allows are not compared, and no link is lost. A long map is folded to
the length of a short one by xor.

Candidates. A list of up to LIST sets is scanned once: what sizes, positions and maps do
not show apart is joined to groups, of which a list gives each set once, not its pairs.
Groups that share a set are one group in the end, so linked sets are always in one.

Links. A group's texts go out as pairs of blocks, each a bounded task that compares full
sets across components only and returns no more links than it has texts.

Answers from a similar set's. In a list of more than LIST sets the smallest, the centre R,
is compared with the others on full sets, and each set x is replaced by its difference from
it, D_x = x xor R, which is short where x is like R, and:

* the distance of x and y is at most |D_x| + |D_y|, so with the centre's answers alone
  some are known to be linked: s = (100 + P)|D| - (100 - P) n adds up to 0 or less. The
  set of least s is then linked to all that have such a partner;
* for all others |D_x & D_y| must be (|D_x| + |D_y| - D) / 2 >= 1, so the differences'
  first tokens are listed as before, and these lists go the same way.

After LEVELS such steps the lists that are left are scanned in blocks of LIST sets, whatever
their length, so no link is missed. Equal sets are one set throughout. Full sets decide every
link but the known.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of fewer
words than a shingle is one shingle, an empty or null text has none and is linked with
nothing; equal texts are linked; rows with equal doc_id are one document with all their
texts' links; a row with null doc_id is linked with nothing and has no component; texts
are never cut; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import removed, text_or_empty, written
from .components import components
from .minhash_dedup import _links_across, shingle_sets

SLICE = 64             # documents hashed at once, at most
CHUNK = 1 << 20        # tokens counted at once
OFTEN = 4              # times in a chunk that make a token worth reporting
HEAVY = 1 << 17        # tokens whose counts order the sets; the order decides cost, not results
LIST = 4096            # sets of a list that is scanned whole
BLOCK = 512            # texts of a group compared at once,
TOKENS = 1 << 19       # or so many tokens
MAP = 1 << 10          # words of 64 bits that a map may have; a set of more tokens has a less telling one
PAIRS = 1 << 14        # pairs whose maps are compared at once
LEVELS = 2             # differences of differences
MINUS = np.uint64(0x9E3779B97F4A7C15)   # marks tokens of the centre that a set lacks


def heavy_tokens(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that are often met, at most HEAVY, and about how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def often() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
            some = n >= OFTEN
            return pa.record_batch({"token": pa.array(tokens[some].view(np.int64)), "n": pa.array(n[some], pa.int64())})

        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                held += shingle_sets([t.encode() for t in piece.column(0).to_pylist()], words)
                if sum(map(len, held)) > CHUNK:
                    yield often()
                    held.clear()
        yield often()

    got = (
        docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        .orderBy(F.col("n").desc(), "token").limit(HEAVY).toPandas())      # HEAVY rows of two numbers
    tokens = got["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], got["n"].to_numpy(np.int64)[order]


def ordered(tokens: np.ndarray, heavy: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Distinct tokens in the order that all sets share."""
    known, n = heavy
    if not len(known):
        return np.sort(tokens)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return tokens[np.lexsort((tokens, np.where(known[at] == tokens, n[at], 0)))]


def parity_map(tokens: np.ndarray) -> bytes:
    """Parity map of a set, a power of two words long."""
    words = min(1 << max(0, (len(tokens) - 1) // 64).bit_length(), MAP)
    odd = np.bincount((tokens & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, n: int, percent: int) -> bytes:
    """The parity map of a set of ``n`` tokens as its lists carry it: a long one is folded as
    far as unlike sets of like size still differ in more bits than a link allows."""
    least = max(8, 1 << max(0, 5 * (100 - percent) * n // (100 + percent) // 64).bit_length())
    if len(bits) <= 8 * least:
        return bits
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, least), axis=0).tobytes()


def apart_at_least(maps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which ``maps[i]`` and ``maps[j]`` differ: at most the tokens in only one of
    the two sets."""
    words = np.array([len(m) // 8 for m in maps.tolist()], np.int64)
    least, out = np.minimum(words[i], words[j]), np.zeros(len(i), np.int64)
    for w in np.unique(least).tolist():
        at = np.flatnonzero(least == w)
        used, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        dense = np.empty((len(used), w), np.uint64)
        for wide in np.unique(words[used]).tolist():
            mine = np.flatnonzero(words[used] == wide)
            whole = np.frombuffer(b"".join(maps[used[mine]].tolist()), np.uint64).reshape(len(mine), wide // w, w)
            dense[mine] = np.bitwise_xor.reduce(whole, axis=1)
        for lo in range(0, len(at), PAIRS):
            p, q = place[lo:min(lo + PAIRS, len(at))], place[len(at) + lo:len(at) + min(lo + PAIRS, len(at))]
            out[at[lo:lo + PAIRS]] = np.bitwise_count(dense[p] ^ dense[q]).sum(1, dtype=np.int64)
    return out


ROWS = "doc_id long, n int, digest binary, text_digest binary, map binary, first array<long>"


def sketches(docs: DataFrame, words: int, percent: int, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per row: set size, 128-bit digests of the set and of the text, parity map, and the
    first tokens; the last four null for an empty set. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                texts = [t.encode() for t in piece.column(1).to_pylist()]
                sets = shingle_sets(texts, words)
                first = [ordered(s, shared.value)[:len(s) - (percent * len(s) + 99) // 100 + 1] if len(s) else None for s in sets]
                yield pa.record_batch({
                    "doc_id": piece.column(0), "n": pa.array(list(map(len, sets)), pa.int32()),
                    "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                                       pa.binary()),
                    "text_digest": pa.array([hashlib.md5(t).digest() if len(s) else None for t, s in zip(texts, sets)], pa.binary()),
                    "map": pa.array([folded(parity_map(s), len(s), percent) if len(s) else None for s in sets], pa.binary()),
                    "first": pa.array([None if f is None else f.view(np.int64) for f in first], pa.list_(pa.int64()))})

    return docs.select("doc_id", "text").mapInArrow(sketch, ROWS)


def _apart(n: Column | np.ndarray, m: Column | np.ndarray, percent: int):
    """Most tokens that linked sets of sizes n and m may not share (as a fraction)."""
    return (100 - percent) * (n + m) / (100 + percent)


def _may_link(left: tuple, right: tuple, percent: int):
    """Whether sets (n, d, pos) may be linked if the listed token is the first that their
    (difference) sets share; of columns or arrays."""
    (n, d, i), (m, e, j) = left, right
    apart = _apart(n, m, percent)
    least = np.minimum if isinstance(n, np.ndarray) else F.least
    return ((percent * n <= 100 * m) & (percent * m <= 100 * n)
            & (2 * least(d - i, e - j) >= d + e - apart) & (abs(d - e) <= apart if isinstance(n, np.ndarray) else F.abs(d - e) <= apart))


COMPARED = "u long, v long, n int, n_u int, d int, linked boolean, tail array<long>"


def compared(pairs: DataFrame, texts: DataFrame, words: int, percent: int, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``pairs`` (u, v) of sets on full sets: sizes, number d of tokens in only one, whether
    they are linked, and the first tokens of v's difference from u."""
    shared = pairs.sparkSession.sparkContext.broadcast(heavy)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                left, right = piece.column(2).to_pylist(), piece.column(3).to_pylist()
                some = list(dict.fromkeys(left + right))
                sets = dict(zip(some, shingle_sets([t.encode() for t in some], words)))
                out = []
                for x, y in zip(left, right):
                    p, q = sets[x], sets[y]
                    plus, minus = np.setdiff1d(q, p, assume_unique=True), np.setdiff1d(p, q, assume_unique=True)
                    d, n = len(plus) + len(minus), len(p) + len(q)
                    far = (100 - percent) * (len(q) + 100 * len(q) // percent) // (100 + percent)
                    tail = np.concatenate([ordered(plus, shared.value), np.sort(minus ^ MINUS)])[:far + 1].view(np.int64)
                    out.append((len(q), len(p), d, (100 + percent) * d <= (100 - percent) * n, tail))
                n, n_u, d, linked, tail = zip(*out)
                yield pa.record_batch({
                    "u": piece.column(0), "v": piece.column(1), "n": pa.array(n, pa.int32()), "n_u": pa.array(n_u, pa.int32()),
                    "d": pa.array(d, pa.int32()), "linked": pa.array(linked), "tail": pa.array(tail, pa.list_(pa.int64()))})

    one = texts.select(F.col("x").alias("_p"), F.col("text").alias("text_u"))
    two = texts.select(F.col("x").alias("_q"), F.col("text").alias("text_v"))
    both = pairs.join(two, F.col("v") == F.col("_q")).join(one, F.col("u") == F.col("_p"))
    return both.select("u", "v", "text_u", "text_v").mapInArrow(look, COMPARED)


def _joined(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Join the groups of rows ``p`` and ``q``: ``label`` has the first row of each row's."""
    while len(p):
        low = np.minimum(label[p], label[q])
        np.minimum.at(label, label[p], low)
        np.minimum.at(label, label[q], low)
        while (label[label] != label).any():
            label[:] = label[label]
        apart = label[p] != label[q]
        p, q = p[apart], q[apart]


def candidates(entries: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Sets that may be linked across components by lists of ``entries`` (g, token, x, n, d,
    pos, m, component) and ``maps`` (x, map), as (u, v): the first set of a list's group and
    another. A list goes out as pairs of blocks of LIST sets."""
    dealt = (
        entries.join(maps.select(F.col("x").alias("_x"), "map"), F.col("x") == F.col("_x"))
        .withColumn("blocks", F.ceil(F.col("m") / LIST).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("g", "token", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                "own", "x", "component", "n", "d", "pos", "map")
        .repartition("g", "token", "lo", "hi").sortWithinPartitions("g", "token", "lo", "hi", "n"))

    def of_lists(rows: np.ndarray, maps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups of whole lists: each row is held against the next, the one after that, and
        so on, while that is of its list and not too large."""
        of = np.cumsum(np.concatenate([[False], (rows[1:, :4] != rows[:-1, :4]).any(1)]))
        two = rows[:, 2] != rows[:, 3]
        own, x, component, n, d, pos = rows[:, 4:].T
        label = np.arange(len(rows))
        i, step = np.arange(len(rows)), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        while len(i):
            step += 1
            i = i[i + step < len(rows)]
            i = i[(of[i] == of[i + step]) & (percent * n[i + step] <= 100 * n[i])]
            j = i + step
            keep = ((component[i] != component[j]) & (~two[i] | (own[i] != own[j])) & (label[i] != label[j])
                    & _may_link((n[i], d[i], pos[i]), (n[j], d[j], pos[j]), percent))
            held.append((i[keep], j[keep]))
            if not len(i) or sum(len(p) for p, _ in held) > PAIRS:
                p, q = (np.concatenate(k) for k in zip(*held))
                held.clear()
                fits = apart_at_least(maps, p, q) <= _apart(n[p], n[q], percent)
                _joined(label, p[fits], q[fits])
        more = np.flatnonzero(label != np.arange(len(rows)))
        return np.unique(np.stack([x[label[more]], x[more]]), axis=1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: np.ndarray, maps: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(rows):
                u, v = of_lists(rows, maps)
                yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

        open_rows, open_maps = np.empty((0, 10), np.int64), np.empty(0, object)
        for batch in batches:
            rows = np.concatenate([open_rows, np.stack([c.to_numpy().astype(np.int64) for c in batch.columns[:10]], 1)])
            maps = np.concatenate([open_maps, np.array(batch.column(10).to_pylist(), object)])
            cut = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            last = cut[-1] if len(cut) else 0       # the last list may go on
            yield from out(rows[:last], maps[:last])
            open_rows, open_maps = rows[last:], maps[last:]
        yield from out(open_rows, open_maps)

    return dealt.mapInArrow(scan, "u long, v long").distinct()


def linked(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) that join components among ``members`` (key, x, n, component) of a key, on
    the full sets of ``texts`` (x, text): no more from a pair of blocks than it has texts."""
    sizes = members.groupBy(F.col("key").alias("_key")).agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / TOKENS)).cast("int").alias("blocks"))
    dealt = (
        members.join(sizes, F.col("key") == F.col("_key"))
        .join(texts.select(F.col("x").alias("_x"), "text"), F.col("x") == F.col("_x"))
        .withColumn("own", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "x", "component", "own", "text")
        .repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []

        def links() -> Iterator[pa.RecordBatch]:
            ids, comp, own, text = map(list, zip(*group)) if group else ([], [], [], [])
            if len(set(comp)) > 1:
                found = _links_across(ids, comp, own, text, words, percent)
                yield pa.record_batch({"u": pa.array([p for p, _ in found], pa.int64()), "v": pa.array([q for _, q in found], pa.int64())})

        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                for key, lo, hi, *row in zip(*(c.to_pylist() for c in batch.slice(i, SLICE).columns)):
                    if (key, lo, hi) != at:
                        yield from links()
                        at, group = (key, lo, hi), []
                    group.append(row)
        yield from links()

    return dealt.mapInArrow(scan, "u long, v long")


def _shared(entries: DataFrame) -> DataFrame:
    """``entries`` (g, token, ...) of lists with more than one, and their number m."""
    shared = (entries.groupBy(F.col("g").alias("_g"), F.col("token").alias("_token")).agg(F.count("*").alias("m"))
              .where("m > 1"))
    return entries.join(shared, (F.col("g") == F.col("_g")) & (F.col("token") == F.col("_token"))).drop("_g", "_token")


class _Join:
    """The state of one join: sets, links so far, and what they join."""

    def __init__(self, docs: DataFrame, named: DataFrame, maps: DataFrame, tied: DataFrame, words: int, percent: int,
                 heavy: tuple) -> None:
        self.docs, self.named, self.maps, self.words, self.percent, self.heavy = docs, named, maps, words, percent, heavy
        self.placed: DataFrame | None = None
        self.add(tied)

    def add(self, links: DataFrame) -> bool:
        """More links (u, v); whether there were any."""
        more = written(links, "links")
        if more.isEmpty():
            removed(more)
            return False
        links = more
        if self.placed is not None:
            links = links.unionByName(self.placed.select(F.col("node").alias("u"), F.col("component").alias("v")))
        self.placed = components(links)
        removed(more)
        return True

    def with_components(self, entries: DataFrame) -> DataFrame:
        """``entries`` with the component of x."""
        if self.placed is None:
            return entries.withColumn("component", F.col("x"))
        return entries.join(self.placed, F.col("x") == F.col("node"), "left").withColumn(
            "component", F.coalesce("component", "x")).drop("node")

    def texts(self, sets: DataFrame) -> DataFrame:
        """(x, text) of ``sets`` (x); a set's text is that of its row, found by doc_id and
        digest. A stored table."""
        some = sets.select(F.col("x").alias("_x")).distinct()
        # stored, so that its size is known and a small one goes to the documents
        wanted = written(self.named.join(some, F.col("x") == F.col("_x"), "left_semi"), "wanted")
        texts = (
            self.docs.join(wanted, F.col("doc_id") == F.col("_doc")).where(F.unhex(F.md5("text")) == F.col("_digest"))
            .select("x", "text").dropDuplicates(["x"]))      # rows may repeat both
        out = written(texts, "texts")
        removed(wanted)
        return out

    def stars(self, entries: DataFrame) -> DataFrame:
        """Compare the centres of lists that hold sets apart with the other sets; a stored
        table."""
        lists = (
            self.with_components(entries).groupBy(F.col("g").alias("_g"), F.col("token").alias("_token")).agg(
                F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.struct("n", "x")).alias("first"))
            .where("low < high").select("_g", "_token", F.col("first.x").alias("u")))
        pairs = written(
            entries.join(lists, (F.col("g") == F.col("_g")) & (F.col("token") == F.col("_token")))
            .where("x != u").select("u", F.col("x").alias("v")).distinct(), "stars")
        texts = self.texts(pairs.select(F.col("u").alias("x")).union(pairs.select("v")))
        out = written(compared(pairs, texts, self.words, self.percent, self.heavy), "compared")
        removed(pairs, texts)
        known = F.lit(100 - self.percent).cast("long")
        score = (100 + self.percent) * F.col("d").cast("long") - known * F.col("n")
        best = out.groupBy(F.col("u").alias("_u")).agg(F.least(
            F.min(F.struct(score.alias("s"), F.col("v").alias("x"))),
            F.first(F.struct((F.lit(0) - known * F.col("n_u")).alias("s"), F.col("u").alias("x")))).alias("best"))
        sure = (out.join(best, F.col("u") == F.col("_u")).where((score + F.col("best.s") <= 0) & (F.col("v") != F.col("best.x")))
                .select(F.col("best.x").alias("u"), "v"))
        self.add(out.where("linked").select("u", "v").unionByName(sure))
        return out

    def candidates(self, entries: DataFrame) -> DataFrame:
        """``candidates`` of what is still apart; a stored table."""
        return written(candidates(self.with_components(entries), self.maps, self.percent).distinct(), "candidates")

    def link(self, found: DataFrame) -> None:
        """Compare what ``found`` (u, v), candidates, puts together."""
        placed = components(found)
        both = placed.select(F.col("component").alias("key"), F.col("node").alias("x"))
        both = both.unionByName(both.select("key", F.col("key").alias("x")).distinct())
        sizes = self.maps.select(F.col("x").alias("_x"), "n")
        members = written(self.with_components(both.join(sizes, F.col("x") == F.col("_x")).select("key", "x", "n")), "members")
        mixed = (
            members.groupBy(F.col("key").alias("_key")).agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low < high").select("_key"))
        apart = members.join(mixed, F.col("key") == F.col("_key"), "left_semi")
        texts = self.texts(apart)
        self.add(linked(apart, texts, self.words, self.percent))
        removed(members, texts)

    def differences(self, hot: DataFrame) -> DataFrame:
        """Entries of the next step: the first tokens of the differences from centres that
        have sets apart."""
        members = self.with_components(hot.select(F.col("u").alias("g"), F.col("v").alias("x"), "n", "d", "tail"))
        mixed = (
            members.groupBy(F.col("g").alias("_g")).agg(
                F.min("component").alias("low"), F.max("component").alias("high"), F.min("d").alias("least"), F.max("n").alias("most"))
            .where("low < high").select("_g", "least", "most"))
        apart = F.floor(_apart(F.col("n"), F.least(F.floor(100 * F.col("n") / self.percent), F.col("most")), self.percent))
        share = F.greatest(F.lit(1), F.col("d") - apart, F.ceil((F.col("d") + F.col("least") - apart) / 2))
        return written(_shared(
            members.join(mixed, F.col("g") == F.col("_g")).withColumn("share", share)
            .select("g", "x", "n", "d", "share", F.posexplode("tail").alias("pos", "token"))
            .where(F.col("pos") <= F.col("d") - F.col("share")).select("g", "token", "x", "n", "d", "pos")), "differences")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (smallest doc_id
    reachable over links)."""
    docs = docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
    heavy = heavy_tokens(docs, words)
    rows = written(sketches(docs, words, percent, heavy).withColumn("row", F.monotonically_increasing_id()), "sketches")
    usable = rows.where("n > 0 and doc_id is not null")
    classes = written(
        usable.groupBy("digest").agg(
            F.min(F.struct("doc_id", "row", "text_digest")).alias("r"), F.first("n").alias("n"), F.first("map").alias("map"),
            F.first("first").alias("first"))
        .select("digest", F.col("r.row").alias("x"), F.col("r.doc_id").alias("doc_id"), "r.text_digest", "n", "map", "first"),
        "classes")
    slim = written(rows.select("doc_id", "n", "digest"), "sketches")
    removed(rows)
    rows, usable = slim, slim.where("n > 0 and doc_id is not null")

    # one document with several texts holds their classes together
    several = (
        usable.groupBy(F.col("doc_id").alias("_id")).agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where("low != high").select("_id"))
    held = (usable.select("doc_id", "digest").join(several, F.col("doc_id") == F.col("_id")).select("doc_id", "digest")
            .join(classes.select(F.col("digest").alias("_digest"), "x"), F.col("digest") == F.col("_digest")))
    least = held.groupBy(F.col("doc_id").alias("_doc")).agg(F.min("x").alias("u"))
    tied = held.join(least, F.col("doc_id") == F.col("_doc")).where("x != u").select("u", F.col("x").alias("v"))

    named = classes.select("x", F.col("doc_id").alias("_doc"), F.col("text_digest").alias("_digest"))
    index = classes.select(F.lit(0).cast("long").alias("g"), "x", "n", F.col("n").alias("d"),
                           F.posexplode("first").alias("pos", "token"))
    entries = written(_shared(index.select("g", "token", "x", "n", "d", "pos")), "entries")
    join = _Join(docs, named, classes.select("x", "n", "map"), tied, words, percent, heavy)
    found = []
    for level in range(LEVELS + 1):
        lists, entries = entries, None
        if lists.isEmpty():
            removed(lists)
            break
        longer = lists.where(F.col("m") > LIST)
        if level < LEVELS and not longer.isEmpty():
            centres = join.stars(longer)
            entries = join.differences(centres)
            removed(centres)
        found.append(join.candidates(lists.where(F.col("m") <= LIST) if level < LEVELS else lists))
        removed(lists)
        if entries is None:
            break
    if any([not f.isEmpty() for f in found]):
        join.link(reduce(DataFrame.unionByName, found))
    removed(*found)

    placed = join.with_components(classes.select("digest", "doc_id", "x"))
    smallest = placed.groupBy(F.col("component").alias("_component")).agg(F.min("doc_id").alias("component_id"))
    named = placed.join(smallest, F.col("component") == F.col("_component")).select(F.col("digest").alias("_digest"), "component_id")
    return (
        rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
        .join(named, F.col("digest") == F.col("_digest"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
