import math
import struct
import zlib

import xxhash

from quarrysight.llm import rendezvous as R

from .helpers import awkward, empty

TEXTS = ["", None, "a", "a", "é" * 5000, (7, "same"), (7, "same"), (7, "other"), (None, "x"), (None, None)]


def brute_shard(key, weights):
    def draw(i, w):
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", i), seed=seed)
        return -math.log(((h >> 11) + 0.5) / 2 ** 53) / w
    return min((draw(i, w), i) for i, w in enumerate(weights) if w > 0)[1]


def test_shards_sizes_and_slots(spark):
    docs = awkward(spark, TEXTS + [(i, f"t{i}") for i in range(100, 400)])
    weights, grown = [1.0, 2.0, 1.0], [1.0, 2.0, 1.0, 1.0]
    rows = R.shard_documents(docs, weights, grown).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.shard == brute_shard(r.doc_id, weights)
        assert r.grown_shard == brute_shard(r.doc_id, grown)
        assert r.grown_shard in (r.shard, 3)      # one more shard only takes rows
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    by_text = {(r.size, r.text_crc32) for r in rows}
    for t in ("", None, "a", "é" * 5000):
        raw = (t or "").encode()
        assert (len(raw) + 8, zlib.crc32(raw)) in by_text


def test_weights_and_zero_weight(spark):
    docs = spark.range(20000).selectExpr("id as doc_id", "'' as text")
    got = {r[0]: r[1] for r in R.shard_documents(docs, [1.0, 3.0, 0.0], [1.0, 3.0, 0.0]).groupBy("shard").count().collect()}
    assert 2 not in got and abs(got[1] / got[0] - 3) < 0.3


def test_slots_do_not_hang_on_partitions(spark):
    docs = spark.range(500).selectExpr("id as doc_id", "string(id) as text")
    one = sorted(R.shard_documents(docs.repartition(7), [1.0] * 4, [1.0] * 5).collect())
    assert one == sorted(R.shard_documents(docs.coalesce(1), [1.0] * 4, [1.0] * 5).collect())


def test_empty(spark):
    assert R.shard_documents(empty(spark), [1.0], [1.0, 1.0]).count() == 0
