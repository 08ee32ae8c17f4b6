"""Token ids as Arrow files of equal-length sequences.

``write_token_files`` tokenizes documents in ascending doc_id order and packs
the ids into sequences of fixed length. A file holds record batches with
``ids: fixed_size_list<uint16 or uint32>`` and ``mask: fixed_size_list<bool>``
(false on the padding after the file's last id), so the n-th sequence is a
slice of a memory-mapped buffer. A second file lists the documents: doc_id,
first id in the file, number of ids. The manifest, one row per file, is a
Parquet table; only files named there belong to the set, so that those of lost
or repeated tasks do no harm.

Defined cases: null text is empty and gives the end id alone; rows go by doc_id
(null first), rows with equal doc_id by text; an empty table gives an empty
manifest; texts are never cut; other columns are not read. Special tokens'
strings inside a text are ordinary text.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty, worker_keeps
from .word_codes import WordCodes, blocks

SEQUENCE = 2048         # ids in a sequence
BATCH = 64              # sequences in a record batch
JOINED = 256            # new words tokenized in a call
MANIFEST = "part int, file string, index string, n_docs long, n_ids long"

# Where the byte-level pre-tokenizer always splits, pieces tokenize alike alone and
# in the text: before a single space between two other characters, and between a
# letter or number and a full stop or comma. Marks stand for what is not a word:
COMMA, STOP, LINE, FIRST = "\x01", "\x02", "\x03", "\x04"
MARKED = {COMMA: ",", STOP: ".", LINE: "\n", FIRST: ""}
_OWN = "[\x01-\x04]"                              # a text with these goes whole
_UNSAFE = "[^A-Za-z0-9À-ÖØ-öø-ɏ] [\x01\x02]"      # a mark after what it may join with


class WordTokenizer:
    """ids of whole texts; each distinct word, with the space before it, is
    tokenized once while it is kept. Texts with other white space than single
    spaces and line ends go to the tokenizer whole."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.codes = WordCodes(self._learn)
        # a byte that no merge touches tells joined words apart, if there is one
        mark = self._alone(["a\x00 a"])[0]
        first, rest = self._alone(["a", " a"])
        self.mark = (np.frombuffer(mark, self.dtype)[len(first) // self.dtype.itemsize]
                     if len(mark) == len(first) + len(rest) + self.dtype.itemsize else None)

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> list[bytes]:
        """ids of words after a space, many to a call and told apart by a zero
        byte after each, which joins nothing before it."""
        if self.mark is None:
            return self._alone([" " + w for w in words])
        some = ["".join(f" {w}\x00" for w in words[at:at + JOINED]) for at in range(0, len(words), JOINED)]
        got = []
        for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
            ids = np.array(e.ids, self.dtype)
            at = 0
            for end in np.flatnonzero(ids == self.mark).tolist():
                got.append(ids[at:end].tobytes())
                at = end + 1
        return got

    def _learn(self, words: list[str]) -> list[bytes | None]:
        safe = [w for w in words if w and w == w.strip() and w not in (FIRST, LINE)]
        alone = [w for w in safe if w[0] in MARKED or "\x00" in w]
        plain = [w for w in safe if not (w[0] in MARKED or "\x00" in w)]
        got = dict(zip(plain, self._joined(plain)))
        got.update(zip(alone, self._alone([MARKED[w[0]] + w[1:] if w[0] in MARKED else " " + w for w in alone])))
        return [got.get(w) for w in words]

    def encode(self, texts: pa.Array) -> list[bytes]:
        own = pc.match_substring_regex(texts, _OWN)
        marked = texts
        for text, mark in ((".\n", f" {STOP} {LINE}"), (". ", f" {STOP} "), (", ", f" {COMMA} ")):
            marked = pc.replace_substring(marked, text, mark)
        marked = pc.if_else(pc.match_substring_regex(marked, _UNSAFE), texts, marked)
        # an empty first word is not safe, so such a text is left over
        marked = pc.if_else(own, "", pc.binary_join_element_wise(FIRST, marked, ""))
        ids = self.codes.encode(marked)
        whole = [i for i, v in enumerate(ids) if v is None]
        for i, v in zip(whole, self._alone([texts[i].as_py() for i in whole])):
            ids[i] = v
        return ids


def _tokenizer(path: str) -> WordTokenizer:
    return worker_keeps(("tokenizer", path), lambda: WordTokenizer(path))


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class _SequenceFile:
    """Writes ids as full record batches; keeps less than one batch in memory."""

    def __init__(self, uri: str, dtype: np.dtype) -> None:
        self.dtype, self.rest, self.held = dtype, [], 0
        kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])
        self.kind = kind
        fs, path = _open(uri)
        self.sink = fs.open_output_stream(path)
        self.out = pa.ipc.new_file(self.sink, self.schema)

    def add(self, ids: bytes) -> None:
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= SEQUENCE * BATCH * self.dtype.itemsize:
            self._flush()

    def _flush(self) -> None:
        unit = SEQUENCE * BATCH
        flat = np.frombuffer(b"".join(self.rest), self.dtype)
        whole = len(flat) // unit * unit
        for at in range(0, whole, unit):
            self._batch(flat[at:at + unit], 0)
        self.rest, self.held = [flat[whole:].tobytes()], (len(flat) - whole) * self.dtype.itemsize

    def _batch(self, flat: np.ndarray, padding: int) -> None:
        mask = np.ones(len(flat), bool)
        mask[len(flat) - padding:] = False
        self.out.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(flat, self.kind), SEQUENCE),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), SEQUENCE)], schema=self.schema))

    def close(self) -> None:
        self._flush()    # only the last batch may be short, so ids are found by division
        left = np.frombuffer(self.rest[0], self.dtype)
        if len(left):
            padding = -len(left) % SEQUENCE
            self._batch(np.concatenate([left, np.zeros(padding, self.dtype)]), padding)
        self.out.close()
        self.sink.close()


INDEX = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n", pa.int64())])


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> None:
    """Tokenize ``docs`` (doc_id, text) into Arrow files under ``path``, one
    range of doc_ids per file, and write ``path``/manifest. ``vocabulary`` is a
    tokenizer file that every executor can open."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: tuple | None = None
        n_ids = n_docs = 0
        tok = _tokenizer(vocabulary)
        end = np.array([end_id], tok.dtype).tobytes()
        name = f"{path}/files/{uuid.uuid4().hex}"   # a repeated task takes new names
        for batch in batches:
            for part in blocks(batch, 1):
                if files is None:
                    fs, base = _open(f"{path}/files")
                    fs.create_dir(base, recursive=True)
                    fs, at = _open(f"{name}.docs.arrow")
                    sink = fs.open_output_stream(at)
                    files = _SequenceFile(f"{name}.ids.arrow", tok.dtype), pa.ipc.new_file(sink, INDEX), sink
                first, sizes = [], []
                for ids in tok.encode(part.column(1)):
                    files[0].add(ids + end)
                    first.append(n_ids)
                    sizes.append(len(ids) // tok.dtype.itemsize + 1)
                    n_ids += sizes[-1]
                files[1].write_batch(pa.record_batch(
                    [part.column(0).cast(pa.int64()), pa.array(first, pa.int64()), pa.array(sizes, pa.int64())],
                    schema=INDEX))
                n_docs += part.num_rows
        if files is not None:
            files[0].close()
            files[1].close()
            files[2].close()
            yield pa.record_batch({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "file": [f"{name}.ids.arrow"], "index": [f"{name}.docs.arrow"],
                "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([n_ids], pa.int64())})

    (
        docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
        .mapInArrow(write, MANIFEST)
        .write.parquet(f"{path}/manifest")
    )


class TokenFile:
    """Random access to one file's sequences and ids, zero-copy where the file
    can be mapped."""

    def __init__(self, uri: str) -> None:
        fs, path = _open(uri)
        local = isinstance(fs, pa.fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.at, self.flat = -1, (np.empty(0), np.empty(0))

    def _batch(self, b: int) -> tuple[np.ndarray, pa.Array]:
        if b != self.at:
            got = self.reader.get_batch(b)
            self.at, self.flat = b, (got.column(0).flatten().to_numpy(), got.column(1).flatten())
        return self.flat

    def sequence(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and mask of the n-th sequence."""
        ids, mask = self._batch(n // BATCH)
        at = n % BATCH * SEQUENCE
        return ids[at:at + SEQUENCE], mask.slice(at, SEQUENCE).to_numpy(zero_copy_only=False)

    def ids(self, first: int, n: int) -> Iterator[np.ndarray]:
        """The n ids from ``first`` on, as slices of the batches that hold them."""
        unit = SEQUENCE * BATCH
        while n > 0:
            at = first % unit
            got = self._batch(first // unit)[0][at:at + n]
            if not len(got):
                raise EOFError(f"the file ends before id {first}")
            yield got
            first, n = first + len(got), n - len(got)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian uint32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, (fs, at) = TokenFile(row["file"]), _open(row["index"])
                with fs.open_input_file(at) as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        docs: Any = index.get_batch(i)
                        crc = []
                        for first, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                            c = 0
                            for got in ids.ids(first, n):
                                c = zlib.crc32(got.astype("<u4").tobytes(), c)
                            crc.append(c)
                        yield pa.record_batch({
                            "doc_id": docs.column(0),
                            "start": pa.array(docs.column(1).to_numpy() + row["base"], pa.int64()),
                            "n_tokens": docs.column(2), "ids_crc32": pa.array(crc, pa.int64())})

    # one row per file, and a file per partition of many megabytes: a short list
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    # a given number of partitions is not folded: as many tasks read as there are files
    return (
        files.select("file", "index", "base").repartition(max(1, manifest.count()), "file")
        .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )
