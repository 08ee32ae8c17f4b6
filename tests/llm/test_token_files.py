import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarrysight.llm import token_files as T

from .helpers import awkward, empty

PATH = P.path("byte_bpe_50k.json")
WORDS = T.WordTokenizer(PATH)
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True


def want(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab ,.\n'\t_é½́\x00\x01\x03s!😀", max_size=25), min_size=1, max_size=5))
def test_words_tokenize_as_whole_texts(texts):
    got = [np.frombuffer(x, WORDS.dtype).tolist() for x in WORDS.encode(pa.array(texts, pa.string()))]
    assert got == [want(t) for t in texts]


TEXTS = ["", None, "one two, three.\nFour <|endoftext|> ", "a" * 70, " lead", (3, "tie b"), (3, "tie a"), (None, "null id"),
         "word " * 40000, "!" * 10]


def test_files_round_trip(spark, workdir):
    docs = awkward(spark, TEXTS + [f"text {i}, and more of {i}." for i in range(100, 400)]).repartition(5)
    T.write_token_files(docs, workdir + "/t", PATH)
    got = T.read_documents(spark, workdir + "/t").orderBy("start").collect()
    assert len(got) == docs.count()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in docs.collect())
    start = 0
    ties = {}
    for r in got:
        assert r.start == start
        start += r.n_tokens
        ties.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert [r.doc_id for r in got] == [k[1] if k[0] else None for k, _ in rows]
    expect = {}
    for (has, k), t in rows:
        ids = want(t) + [0]
        expect.setdefault(k if has else None, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in ties.items()} == {k: sorted(v) for k, v in expect.items()}


def test_sequences_are_equal_and_masked(spark, workdir):
    docs = awkward(spark, ["word " * 3000, "b", "c d"])
    T.write_token_files(docs.coalesce(1), workdir + "/t", PATH)
    rows = spark.read.parquet(workdir + "/t/manifest").collect()
    ids = []
    for r in sorted(rows, key=lambda r: r.part):
        f = T.TokenFile(r.file)
        n = -(-r.n_ids // T.SEQUENCE)
        pairs = [f.sequence(i) for i in range(n)]
        assert all(len(a) == len(m) == T.SEQUENCE for a, m in pairs)
        assert sum(int(m.sum()) for _, m in pairs) == r.n_ids
        ids += [int(x) for a, m in pairs for x in a[m]]
        # the buffer is the file's own: no copy was made
        batch = pa.ipc.open_file(pa.memory_map(r.file.removeprefix("file://"))).get_batch(0)
        assert batch.schema.field("ids").type == pa.list_(pa.uint16(), T.SEQUENCE)
    assert ids == [x for t in ("word " * 3000, "b", "c d") for x in want(t) + [0]]
    with pytest.raises((EOFError, ValueError)):      # past the end, in the last batch or after it
        list(f.ids(10 ** 9, 5))
    with pytest.raises(EOFError):
        list(f.ids(-(-r.n_ids // T.SEQUENCE) * T.SEQUENCE, 5))


def test_empty(spark, workdir):
    T.write_token_files(empty(spark), workdir + "/t", PATH)
    assert T.read_documents(spark, workdir + "/t").count() == 0


def test_files_are_read_by_several_tasks(spark, workdir):
    docs = awkward(spark, [f"text {i} " * 50 for i in range(600)])
    n = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # small files
    try:
        T.write_token_files(docs, workdir + "/t", PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", n)
    files = spark.read.parquet(workdir + "/t/manifest").count()
    tasks = T.read_documents(spark, workdir + "/t").select(F.spark_partition_id().alias("p")).distinct().count()
    assert files > 2 and tasks >= files // 2
