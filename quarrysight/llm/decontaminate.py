"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact check
(built-in expressions only).

A benchmark item is the bag of its five-word shingles (words: lower-case runs of
letters and digits). A document leaks an item if a window of the item's size has
a weighted Jaccard similarity (sum of smaller over sum of larger shingle counts)
of 0.8 or more with it.

1. Every item has a 64-bit SimHash: a bit is set if it is in more than half of the
   item's shingles. So has every window of an item's size that could leak one: of T
   shingles it must hold 8 T / 9 that are in items of T shingles. Windows with fewer, whose
   similarity with every item is below 0.8, are passed over without a fingerprint; ranges of
   starts between a text's places of such shingles give the others.
2. The items of a size are indexed by the eight bytes of their fingerprints, each as it is
   and with one bit flipped. If two fingerprints differ in RADIUS bits, at most 15, one of
   the bytes differs in one bit at most: windows look up their eight bytes, and what meets is
   kept if the whole distance is within RADIUS. All fingerprints within RADIUS are found.
3. For the texts and items found, running counts of shared shingles judge every
   window by exact counts: each place of one of the item's shingles adds one to the
   shared count of a range of windows, those that hold it, but not yet as many
   earlier places of that shingle as the item has of it. The largest count is the
   best similarity.

All steps are expressions, joins and aggregates. A window of similarity 0.8 has a distance
of about 10, so RADIUS loses few such windows and next to none above. ``exact=True`` finds
the texts without fingerprints, by the items' rarest shingles (a window of T shingles holds
ceil(0.8 T) of the item's, so one of any T - ceil(0.8 T) + 1 of them) and misses none; it is
what recall is measured by. ``leaked_items`` is steps 1 and 2 over every window of arrays in
memory, which tests hold the search against.

Defined cases: null text has no words; an item of fewer than five words is one
shingle of all its words, an item without words matches nothing; a text shorter than
an item is one window; equal rows give one result; rows that share a doc_id are checked
each on its own text; a null doc_id is reported as null; of equally similar windows the
first is reported; texts are never cut; empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, row_key, text_or_empty, written

WORDS = 5
SHARE = (4, 5)      # least similarity, as a fraction
BITS = 64
RADIUS = 15         # of the eight bytes one then differs in one bit at most
CHUNK = 1 << 14     # windows of a size that leaked_items fingerprints at once


def with_shingles(df: DataFrame, size: int) -> DataFrame:
    """``df`` with ``words`` (hashes of the words of ``text``) and ``shingles``
    (64-bit hashes of the runs of ``size`` words, by position) in its place.
    Each step is a column, as an array written inside a lambda is made anew for
    every element. Explode the result with an ``_outer`` function: from the others
    Spark derives a filter that it pushes down, lambda and array together."""
    split = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    df = df.withColumn("words", F.transform(split, lambda w: F.xxhash64(w))).drop("text")
    last = F.size("words") - size
    return df.withColumn("shingles", F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(size)]))
    ).otherwise(F.array().cast("array<bigint>")))


def simhash(bags: DataFrame, keys: list[str]) -> DataFrame:
    """``bags`` (keys, hash, c) to (keys, total, fingerprint). Two bit counters
    share a long, so that 32 sums make 64 bits."""
    half = BITS // 2

    def bit(k: int) -> Column:
        return F.shiftrightunsigned("hash", k).bitwiseAND(F.lit(1))

    sums = [F.sum(F.col("c") * (bit(k) + F.shiftleft(bit(k + half), 32))).alias(f"s{k}") for k in range(half)]
    low = (1 << 32) - 1
    fingerprint = F.lit(0).cast("long")
    for k in range(half):
        for at, count in ((k, F.col(f"s{k}").bitwiseAND(F.lit(low))), (k + half, F.shiftrightunsigned(f"s{k}", 32))):
            fingerprint = fingerprint.bitwiseOR(F.when(2 * count > F.col("total"), F.shiftleft(F.lit(1).cast("long"), at))
                                                .otherwise(F.lit(0).cast("long")))
    return bags.groupBy(*keys).agg(F.sum("c").alias("total"), *sums).select(
        *keys, "total", fingerprint.alias("fingerprint"))


class _Items:
    """Items of one shingle length, by size: fingerprints, their bytes' neighbourhoods, bags."""

    def __init__(self, fingerprints: dict[int, tuple[int, int]], bags: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        self.by_size: dict[int, list[int]] = {}
        for item, (total, _) in sorted(fingerprints.items()):
            self.by_size.setdefault(total, []).append(item)
        self.bags = bags
        self.prints = {t: np.array([fingerprints[i][1] & (1 << BITS) - 1 for i in some], np.uint64) for t, some in self.by_size.items()}
        near = [0, *[1 << k for k in range(8)]]
        self.marks = {}
        for t, prints in self.prints.items():
            self.marks[t] = np.zeros((8, 256), bool)
            for at, column in enumerate(prints.view(np.uint8).reshape(-1, 8).T):
                for flip in near:
                    self.marks[t][at, column ^ flip] = True

    def leaked(self, item: int, window: np.ndarray, size: int) -> bool:
        """Whether a window's weighted Jaccard with an item of ``size`` shingles is SHARE or more."""
        hashes, counts = self.bags[item]
        at = np.minimum(np.searchsorted(hashes, window), len(hashes) - 1)
        both = int(np.minimum(np.bincount(at[hashes[at] == window], minlength=len(hashes)), counts).sum())
        return SHARE[1] * both >= SHARE[0] * (size + len(window) - both)

    def found(self, packed: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
        """(item, windows within RADIUS) of fingerprints given as rows of eight bytes."""
        marks = self.marks[size]
        some = np.flatnonzero(np.logical_or.reduce([marks[k][packed[:, k]] for k in range(8)]))
        prints = np.ascontiguousarray(packed[some]).view(np.uint64).ravel()
        for item, own in zip(self.by_size[size], self.prints[size]):
            near = some[np.bitwise_count(prints ^ own) <= RADIUS]
            if len(near):
                yield item, near


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def leaked_items(hashes: np.ndarray, ends: np.ndarray, items: _Items) -> set[tuple[int, int]]:
    """(text, item) of texts whose shingles stand one after the other in ``hashes`` and
    end at ``ends``: every window is fingerprinted, those near an item are checked."""
    out: set[tuple[int, int]] = set()
    if not len(hashes) or not items.by_size:
        return out
    starts = np.concatenate([[0], ends[:-1]])
    own_end = np.repeat(ends, ends - starts)
    text = np.repeat(np.arange(len(ends)), ends - starts)
    longest = max(items.by_size)
    kind = np.int16 if CHUNK + longest < 1 << 15 else np.int32
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK + longest - 1]
        sums = np.zeros((len(part) + 1, BITS), kind)
        np.cumsum(_bits(part), axis=0, dtype=kind, out=sums[1:])
        for size in items.by_size:
            n = min(CHUNK, len(part) - size + 1)
            if n <= 0:
                continue
            packed = np.packbits(sums[size:size + n] - sums[:n] > size // 2, axis=1, bitorder="little")
            for item, near in items.found(packed, size):
                for p in (near + at).tolist():
                    if p + size <= own_end[p] and (int(text[p]), item) not in out and items.leaked(item, hashes[p:p + size], size):
                        out.add((int(text[p]), item))
    for i in np.flatnonzero((ends - starts < longest) & (ends > starts)).tolist():
        window = hashes[starts[i]:ends[i]]
        packed = np.packbits(2 * _bits(window).sum(axis=0, dtype=np.int64) > len(window), bitorder="little").reshape(1, 8)
        for size in items.by_size:
            if len(window) < size and SHARE[1] * len(window) >= SHARE[0] * size:
                out.update((i, item) for item, _ in items.found(packed, size) if items.leaked(item, window, size))
    return out


def possible_windows(raw: DataFrame, bags: DataFrame, m: int) -> DataFrame:
    """(key, size, start, total) of the windows of texts (key, text) that hold enough shingles
    of items of ``size`` shingles to leak one; total: the window's shingles."""
    of_items = (bags.where(F.col("m") == m).groupBy(F.col("hash").alias("_hash"))
                .agg(F.collect_set("size").alias("of")))
    marked = (
        with_shingles(raw, m).select("key", F.size("shingles").alias("n"), F.posexplode_outer("shingles").alias("pos", "hash"))
        .join(of_items, F.col("hash") == F.col("_hash"))
        .select("key", "n", "pos", F.explode(F.col("of").cast("array<int>")).alias("size"))
        # rows may repeat a text
        .groupBy("key", "size").agg(F.first("n").alias("n"), F.sort_array(F.collect_set("pos")).alias("at")))
    # both / (size + total - both) >= share, in integers
    total = F.least("size", "n")
    need = F.expr(f"cast(({SHARE[0]} * (size + total) + {sum(SHARE) - 1}) div {sum(SHARE)} as int)")
    some = (marked.withColumn("total", total).withColumn("need", need)
            .withColumn("last", F.greatest(F.lit(0), F.col("n") - F.col("size"))).where(F.size("at") >= F.col("need")))
    # starts of windows whose first such shingle is the i-th, and that hold need of them
    ranges = F.transform(F.sequence(F.lit(0), F.size("at") - F.col("need")), lambda i: F.struct(
        F.greatest(F.lit(0), F.get("at", i + F.col("need") - 1) - F.col("size") + 1,
                   F.coalesce(F.get("at", i - 1) + 1, F.lit(0))).alias("lo"),
        F.least(F.get("at", i), F.col("last")).alias("hi")))
    return (
        some.select("key", "size", "total", F.explode_outer(ranges).alias("r")).where("r.lo <= r.hi")
        .select("key", "size", "total", F.explode_outer(F.sequence("r.lo", "r.hi")).alias("start")))


def within_radius(windows: DataFrame, prints: DataFrame) -> DataFrame:
    """``windows`` (size, fingerprint and others) with the items of ``prints`` (m, item, total,
    fingerprint) of their size, equal m, and a fingerprint within RADIUS."""
    def at(block: int) -> Column:
        return F.shiftrightunsigned("fingerprint", 8 * block).bitwiseAND(F.lit(255)).cast("int")

    blocks = range(BITS // 8)
    index = prints.select(
        F.col("m").alias("_m"), F.col("total").alias("_size"), F.col("item").alias("_item"), F.col("fingerprint").alias("_print"),
        F.explode(F.array(*[F.struct(F.lit(b).alias("block"), at(b).bitwiseXOR(F.lit(flip)).alias("byte"))
                            for b in blocks for flip in (0, *[1 << k for k in range(8)])])).alias("_at"))
    asked = windows.withColumn("at", F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), at(b).alias("byte")) for b in blocks])))
    return (
        asked.join(index, (F.col("m") == F.col("_m")) & (F.col("size") == F.col("_size")) & (F.col("at") == F.col("_at")))
        .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("_print"))) <= RADIUS).drop("at", "_at", "_m", "_size", "_print"))


def _near_items(raw: DataFrame, bags: DataFrame, sizes: list[int]) -> DataFrame:
    """(m, _key, _item) of texts with a window within RADIUS of an item."""
    prints = written(simhash(bags, ["m", "item"]), "fingerprints")
    out = None
    for m in sizes:
        windows = written(possible_windows(raw, bags, m), "windows")
        # these texts are read again, and only these
        texts = (
            raw.join(windows.select(F.col("key").alias("_key")).distinct(), F.col("key") == F.col("_key"), "left_semi")
            .select(F.col("key").alias("_key"), "text").dropDuplicates(["_key"]))
        bags_of_windows = (
            windows.join(with_shingles(texts, m).select("_key", "shingles"), F.col("key") == F.col("_key"))
            .select(F.lit(m).alias("m"), "key", "size", "start",
                    F.explode_outer(F.slice("shingles", F.col("start") + 1, F.col("total"))).alias("hash"), F.lit(1).alias("c")))
        fingerprints = simhash(bags_of_windows, ["m", "key", "size", "start"])
        found = within_radius(fingerprints, prints).select("m", F.col("key").alias("_key"), "_item")
        out = found if out is None else out.unionByName(found)
    return out


def _rare_items(raw: DataFrame, bags: DataFrame, sizes: list[int]) -> DataFrame:
    """(m, _key, _item) of texts with one of an item's rarest shingles: a superset of all leaks."""
    # ceil(share * size), in integers
    need = F.expr(f"({SHARE[0]} * size + {SHARE[1] - 1}) div {SHARE[1]}")
    common = bags.groupBy("m", F.col("hash").alias("_hash")).agg(F.count("*").alias("items"))
    rarest = Window.partitionBy("item").orderBy("items", "hash").rowsBetween(Window.unboundedPreceding, -1)
    probes = written(
        bags.join(common.withColumnRenamed("m", "_m"), (F.col("m") == F.col("_m")) & (F.col("hash") == F.col("_hash")))
        .withColumn("_before", F.coalesce(F.sum("c").over(rarest), F.lit(0)))
        .where(F.col("_before") <= F.col("size") - need)
        .select("m", F.col("hash").alias("_hash"), F.col("item").alias("_item")), "probes")
    out = None
    for m in sizes:
        some = (
            with_shingles(raw, m).select("key", F.explode_outer(F.array_distinct("shingles")).alias("hash"))
            .join(probes.where(F.col("m") == m), F.col("hash") == F.col("_hash"))
            .select(F.lit(m).alias("m"), F.col("key").alias("_key"), "_item"))
        out = some if out is None else out.unionByName(some)
    return out


def _found(docs: DataFrame, items: DataFrame, exact: bool = False) -> DataFrame:
    """One row for each distinct row of ``docs`` and item it leaks: key, doc_id,
    item_id, start_word, similarity."""
    bench = written(
        with_shingles(items.select("item_id", text_or_empty("text").alias("text")), 1)
        .select("item_id", F.xxhash64("item_id", "words").alias("item"), F.size("words").alias("len"), "words")
        .where("len > 0").dropDuplicates(["item"]), "items")
    sizes = sorted(r[0] for r in bench.select(F.least("len", F.lit(WORDS))).distinct().collect())
    if not sizes:
        sizes = [WORDS]
    bags = None
    for m in sizes:
        of_size = bench.where(f"len >= {WORDS}" if m == WORDS else f"len = {m}")
        runs = F.transform(F.sequence(F.lit(0), F.col("len") - m),
                           lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(m)]))
        bag = (of_size.select("item", "len", F.explode(runs).alias("hash"))
               .groupBy("item", "len", "hash").agg(F.count("*").alias("c")).withColumn("m", F.lit(m)))
        bags = bag if bags is None else bags.unionByName(bag)
    bags = written(bags.withColumn("size", (F.col("len") - F.col("m") + 1).cast("long")), "bags")

    raw = docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"), row_key().alias("key"))
    candidates = written((_rare_items if exact else _near_items)(raw, bags, sizes).distinct(), "candidates")

    # the candidates are read again, and only these
    found = candidates.select("_key").distinct()
    hit = raw.join(found, F.col("key") == F.col("_key"), "left_semi").dropDuplicates(["key"])
    ranges = None
    for m in sizes:
        places = (
            with_shingles(hit, m).select("key", "doc_id", F.size("words").alias("n"), F.posexplode_outer("shingles").alias("pos", "hash"))
            .where("hash is not null").groupBy("key", "doc_id", "n", "hash")
            .agg(F.sort_array(F.collect_list("pos")).alias("at")))
        both = (
            places.join(candidates.where(F.col("m") == m).select("_key", "_item"), F.col("key") == F.col("_key"))
            .join(bags.where(F.col("m") == m).select(F.col("item"), F.col("hash").alias("_hash"), "c", "len", "size"),
                (F.col("_item") == F.col("item")) & (F.col("hash") == F.col("_hash"))))
        # a text shorter than the item is one window
        last = F.greatest(F.lit(0), F.col("n") - F.col("len"))
        total = F.least(F.col("size"), F.col("n") - (m - 1)).cast("long")
        each = both.select("key", "doc_id", "item", "size", total.alias("total"), last.alias("last"), F.explode(F.transform(
            "at", lambda p, i: F.struct(
                F.greatest(F.lit(0), p - F.col("size").cast("int") + 1, F.coalesce(
                    F.when(i >= F.col("c"), F.get("at", (i - F.col("c")).cast("int"))) + 1, F.lit(0))).alias("lo"),
                F.least(p, last).alias("hi")))).alias("_r")).where("_r.lo <= _r.hi")
        ranges = each if ranges is None else ranges.unionByName(each)
    pair = ["key", "doc_id", "item", "size", "total"]
    steps = (
        ranges.select(*pair, F.explode(F.array(
            F.struct(F.col("_r.lo").alias("start"), F.lit(1).alias("d")),
            F.struct((F.col("_r.hi") + 1).alias("start"), F.lit(-1).alias("d")))).alias("_s"))
        .groupBy(*pair, F.col("_s.start").alias("start")).agg(F.sum("_s.d").alias("d")))
    so_far = Window.partitionBy("key", "item").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    return (
        steps.withColumn("both", F.sum("d").over(so_far))
        .withColumn("either", F.col("total") + F.col("size") - F.col("both"))
        .where(F.lit(SHARE[1]) * F.col("both") >= F.lit(SHARE[0]) * F.col("either"))
        .groupBy("key", "doc_id", "item").agg(
            F.max(F.struct((F.col("both") / F.col("either")).alias("similarity"), (-F.col("start")).alias("_back"))).alias("_best"))
        .join(bench.select(F.col("item").alias("_item"), "item_id"), F.col("item") == F.col("_item"))
        .select("key", "doc_id", "item_id", "_best"))


def leaks(docs: DataFrame, items: DataFrame, exact: bool = False) -> DataFrame:
    """One row for each document (doc_id, text) and item (item_id, text) it leaks:
    doc_id, item_id, start_word, similarity."""
    return (
        _found(docs, items, exact).groupBy("doc_id", "item_id").agg(F.max("_best").alias("_best"))
        .select("doc_id", "item_id", (-F.col("_best._back")).alias("start_word"), F.col("_best.similarity").alias("similarity")))


def decontaminated(docs: DataFrame, items: DataFrame, exact: bool = False) -> DataFrame:
    """``docs`` without the documents that leak an item: the rows of a doc_id go
    together, a row with null doc_id by its own text."""
    bad = written(_found(docs, items, exact).select(
        "doc_id", F.when(F.col("doc_id").isNull(), F.col("key")).alias("key")).distinct(), "leaks")
    return _without(docs, bad, F.when(F.col("doc_id").isNull(), row_key()))


def clean_rows(docs: DataFrame, items: DataFrame, exact: bool = False) -> DataFrame:
    """``docs`` without the rows whose own text leaks an item."""
    return _without(docs, written(_found(docs, items, exact).select("doc_id", "key").distinct(), "leaks"), row_key())


def _without(docs: DataFrame, bad: DataFrame, key: Column) -> DataFrame:
    """``docs`` without the rows that agree with one of ``bad`` in doc_id and ``key``. Their
    columns may have any names."""
    mine, their, doc = (free_name(docs, n) for n in ("_key", "_bad_key", "_bad_doc"))
    bad = bad.select(F.col("doc_id").alias(doc), F.col("key").alias(their))
    return docs.withColumn(mine, key).join(
        bad, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & F.col(mine).eqNullSafe(F.col(their)), "left_anti").drop(mine)
