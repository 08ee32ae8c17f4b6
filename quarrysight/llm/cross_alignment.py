"""Alignment of two tokenizers' tokens over the same text.

Tokenizer A (``tokenizers``, byte-level BPE) reads a space and the text, tokenizer B
(``sentencepiece``) the text, before which it puts a space itself, so both cover the
same bytes. Where do their tokens end?

1. Coarse cuts: the character offsets that A's encoding gives, and the spans of B's
   immutable proto (in this release byte offsets; a probe tells).
2. Tokens that hold a part of a character (A's byte-level pieces, B's byte-fallback
   pieces), or none of the text (the space that B adds), are placed by the length of
   their decoded bytes, from the end of the token before.
3. The joined decoded bytes must be the space and the text; they decide if a span is
   odd. If they differ the text has no tokens.

Offsets where tokens of both end cut the text into groups, and link the two tokens that
end there. A link's tokens end alike, so one's bytes end with the other's: all pairs that
can ever be linked are listed from the two vocabularies (``Pairs``), and what is counted
for each of them has that length, whatever the number of documents.

Both tokenizers start anew at a single space between two characters that are not white
space (A's pattern; B has no piece with a space after another character, which is
checked). So texts are put together from the alignments of their words: each word is
tokenized once while a worker keeps it, many in a call. Texts with other white space
at a word's end, words that do not come back from their tokens, or very long words go
through both tokenizers whole.

Defined cases: null, empty or not restorable texts have no tokens, groups or links;
special tokens' strings inside a text are ordinary text; rows with equal or null doc_id
are each aligned and counted on their own; texts are never cut; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, text_or_empty, worker_drops, worker_keeps
from .word_codes import blocks

JOINED = 1 << 14         # characters of new words tokenized in a call
LONG_WORD = 256          # characters; a text with a longer word goes whole
KEPT = 64 << 20          # bytes of words that a worker keeps
BLOCK = 1 << 20          # bytes of text handled at once, or one text
SPACE = "▁"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones
    stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


@dataclass(frozen=True)
class Spans:
    """Tokens of one tokenizer: ids and the byte offsets where they end."""

    ids: np.ndarray
    ends: np.ndarray


@dataclass(frozen=True)
class Alignment:
    a: Spans
    b: Spans

    @cached_property
    def at(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of A and of B that end together."""
        both = np.intersect1d(self.a.ends, self.b.ends, assume_unique=True)
        return np.searchsorted(self.a.ends, both), np.searchsorted(self.b.ends, both)

    @property
    def links(self) -> tuple[np.ndarray, np.ndarray]:
        i, j = self.at
        return self.a.ids[i], self.b.ids[j]

    def groups(self) -> list[str]:
        """``a1,a2|b1`` per group."""
        i, j = self.at
        a, b = list(map(str, self.a.ids.tolist())), list(map(str, self.b.ids.tolist()))
        out, p, q = [], 0, 0
        for x, y in zip((i + 1).tolist(), (j + 1).tolist()):
            left = a[p] if x == p + 1 else ",".join(a[p:x])
            out.append(f"{left}|{b[q] if y == q + 1 else ','.join(b[q:y])}")
            p, q = x, y
        return out


NOTHING = Spans(np.empty(0, np.int64), np.empty(0, np.int64))


def _placed(start: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens, of coarse spans and decoded sizes: a token that shares a
    character with the next, or has no span, is placed by its size."""
    ends = end.copy()
    vague = end == start
    vague[:-1] |= end[:-1] > start[1:]
    for i in np.flatnonzero(vague).tolist():
        ends[i] = (ends[i - 1] if i else 0) + sizes[i]
    return ends if (np.diff(ends, prepend=0) == sizes).all() else np.cumsum(sizes)


class Aligner:
    """The two tokenizers of one process."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        special = {t["content"] for t in json.loads(self.a.to_str())["added_tokens"]}
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(self.pieces)]
        self.a_sizes = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_sizes = np.array(list(map(len, self.b_bytes)), np.int64)
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.b_in_bytes = max((p.end for p in self.b.encode("é", return_type="proto").pieces), default=2) == 2

    @staticmethod
    def _bytes_at(text: str, raw: bytes) -> np.ndarray | None:
        """Byte offset of each character and of the end; None if they are alike."""
        if len(text) == len(raw):
            return None
        lead = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        return np.append(lead, len(raw))

    def align(self, text: str) -> Alignment:
        raw = b" " + text.encode()
        if len(raw) == 1:
            return Alignment(NOTHING, NOTHING)
        got = self.a.encode(" " + text, add_special_tokens=False)
        a = np.array(got.ids, np.int64)
        pieces = self.b.encode(text, return_type="proto").pieces
        ids = [p.id for p in pieces]
        if b"".join(map(self.a_bytes.__getitem__, got.ids)) != raw or b"".join(map(self.b_bytes.__getitem__, ids)) != raw:
            return Alignment(NOTHING, NOTHING)
        b = np.array(ids, np.int64)
        place = self._bytes_at(" " + text, raw)
        spans = np.array(got.offsets, np.int64).reshape(-1, 2)
        if place is not None:
            spans = place[spans]
        a_ends = _placed(spans[:, 0], spans[:, 1], self.a_sizes[a])
        # spans of the text alone: one byte, or character, behind the space
        spans = np.array([[p.begin for p in pieces], [p.end for p in pieces]], np.int64).T + 1
        if not self.b_in_bytes and place is not None:
            spans = place[spans]
        spans[0, 0] = spans[0, 0] if spans[0, 0] == spans[0, 1] else 0
        return Alignment(Spans(a, a_ends), Spans(b, _placed(spans[:, 0], spans[:, 1], self.b_sizes[b])))


class Pairs:
    """All pairs of ids that can end together: the bytes of one end with the other's."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]) -> None:
        self.n_b = len(b_bytes)

        def ends(of: list[bytes], among: list[bytes]) -> Iterator[tuple[int, int]]:
            ids: dict[bytes, list[int]] = {}
            for j, token in enumerate(among):
                if token:
                    ids.setdefault(token, []).append(j)
            for i, token in enumerate(of):
                for at in range(len(token)):
                    for j in ids.get(token[at:], ()):
                        yield i, j

        codes = {i * self.n_b + j for i, j in ends(a_bytes, b_bytes)}
        codes.update(j * self.n_b + i for i, j in ends(b_bytes, a_bytes))
        self.codes = np.array(sorted(codes), np.int64)

    def __len__(self) -> int:
        return len(self.codes)

    def index(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.codes, a * self.n_b + b).astype(np.int32)

    def best(self, counts: np.ndarray) -> np.ndarray:
        """Whether a pair's count is the highest of its B id's."""
        b = self.codes % self.n_b
        top = np.zeros(self.n_b, np.int64)
        np.maximum.at(top, b, counts)
        return counts == top[b]


class _Column:
    """Byte strings, one after the other."""

    def __init__(self) -> None:
        self.data, self.ends, self.rows = np.empty(1 << 16, np.uint8), np.zeros(1 << 12, np.int64), 0

    def put(self, flat: bytes, sizes: np.ndarray) -> None:
        used = int(self.ends[self.rows])
        while used + len(flat) > len(self.data):
            self.data = np.concatenate([self.data, np.empty(len(self.data) // 2, np.uint8)])
        while self.rows + len(sizes) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(len(self.ends) // 2, np.int64)])
        self.data[used:used + len(flat)] = np.frombuffer(flat, np.uint8)
        self.ends[self.rows + 1:self.rows + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.rows += len(sizes)

    def take(self, rows: np.ndarray, cut: np.ndarray) -> list[bytes]:
        """The strings of ``rows``, joined within each stretch that ``cut`` makes of them."""
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.rows, [None, pa.py_buffer(self.ends), pa.py_buffer(self.data)])
        got = column.take(pa.array(rows))
        at = np.frombuffer(got.buffers()[1], np.int64)[got.offset:got.offset + len(got) + 1][cut].tolist()
        line = memoryview(got.buffers()[2] or b"")
        return [bytes(line[lo:hi]) for lo, hi in zip(at, at[1:])]


class Words:
    """Alignments of words, kept by one worker up to KEPT bytes."""

    def __init__(self, aligner: Aligner, pairs: Pairs) -> None:
        self.aligner, self.pairs = aligner, pairs
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.text, self.links, self.sizes = _Column(), _Column(), np.zeros((1 << 12, 2), np.int32)

    def _keep(self, words: list[str]) -> None:
        got = self.aligner.align(" ".join(words))
        raw = np.array([len(w.encode()) + 1 for w in words], np.int64)
        last = np.cumsum(raw)
        i, j = got.at
        if not len(i) or not np.isin(last, got.a.ends[i]).all():
            # a word that does not come back: each alone, and that one never
            if len(words) == 1:
                self.known[words[0]] = -1
            else:
                half = len(words) // 2
                self._keep(words[:half])
                self._keep(words[half:])
            return
        ends = got.a.ends[i]
        cut = np.searchsorted(ends, last) + 1
        groups = got.groups()
        texts = [";".join(groups[lo:hi]).encode() + b";" for lo, hi in zip([0, *cut[:-1].tolist()], cut.tolist())]
        links = self.pairs.index(*got.links)
        sizes = np.diff(np.stack([np.searchsorted(got.a.ends, last) + 1, np.searchsorted(got.b.ends, last) + 1], 1),
                        axis=0, prepend=0)
        first = self.text.rows
        self.text.put(b"".join(texts), np.array(list(map(len, texts)), np.int64))
        self.links.put(links.tobytes(), links.itemsize * np.diff(cut, prepend=0))
        while first + len(words) > len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.sizes[first:first + len(words)] = sizes
        self.known.update(zip(words, range(first, first + len(words))))
        self.held += sum(map(len, texts)) + links.nbytes + 170 * len(words) + int(raw.sum())

    def rows(self, words: list[str]) -> np.ndarray:
        """Row of each of some distinct words; -1 of one that is not for the table."""
        if self.held > KEPT:
            self.clear()
        new, size = [], 0
        for w in words:
            if w in self.known:
                continue
            if not w or len(w) > LONG_WORD or w != w.strip():
                continue
            new.append(w)
            size += len(w) + 1
            if size > JOINED:
                self._keep(new)
                new, size = [], 0
        if new:
            self._keep(new)
        return np.array([self.known.get(w, -1) for w in words], np.int64)


def aligned_texts(texts: pa.Array, aligner: Aligner, words: Words) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """Of each text: its groups as ``a1,a2|b1;a3|b2``, its links as places in Pairs (int32),
    and how many tokens of A and B it has."""
    n = len(texts)
    lists = pc.split_pattern(texts, " ")
    cut = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    numbered = pc.dictionary_encode(lists.flatten())
    if isinstance(numbered, pa.ChunkedArray):
        numbered = numbered.combine_chunks()
    each = words.rows(numbered.dictionary.to_pylist())[numbered.indices.to_numpy()] if aligner.by_word else np.full(cut[-1], -1)
    whole = np.unique(np.searchsorted(cut, np.flatnonzero(each < 0), "right") - 1)
    fine = np.maximum(each, 0)
    if not words.text.rows:
        groups, links, sizes = [b""] * n, [b""] * n, np.zeros((n, 2), np.int64)
    else:
        groups = [g[:-1] for g in words.text.take(fine, cut)]
        links = words.links.take(fine, cut)
        total = np.concatenate([[[0, 0]], np.cumsum(words.sizes[fine], axis=0, dtype=np.int64)])
        sizes = total[cut[1:]] - total[cut[:-1]]
    for i in whole.tolist():
        got = aligner.align(texts[i].as_py())
        groups[i], links[i] = ";".join(got.groups()).encode(), words.pairs.index(*got.links).tobytes()
        sizes[i] = len(got.a.ids), len(got.b.ids)
    return groups, links, sizes


ALIGNED = "doc_id long, n_a long, n_b long, groups binary, links binary"


def align_documents(docs: DataFrame, a_path: str, b_path: str, pairs: Pairs) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): numbers of tokens, the groups as text
    (``a1,a2|b1;a3|b2``), and its links as places in ``pairs`` (int32). No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_keeps(("words", a_path, b_path), lambda: Words(Aligner(a_path, b_path), shared.value))
        aligner = words.aligner
        for batch in batches:
            for part in blocks(batch, 1, BLOCK):
                groups, links, sizes = aligned_texts(part.column(1), aligner, words)
                yield pa.record_batch({
                    "doc_id": part.column(0), "n_a": pa.array(sizes[:, 0]), "n_b": pa.array(sizes[:, 1]),
                    "groups": pa.array(groups, pa.binary()), "links": pa.array(links, pa.binary())})

    return docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(align, ALIGNED)


def _places(links: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All links of a column in a line, and where each row begins in it (and the end)."""
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(links).to_numpy(zero_copy_only=False))])
    start = np.frombuffer(links.buffers()[1], np.int32)[links.offset]
    return np.frombuffer(links.buffers()[2] or b"", np.uint8)[start:start + ends[-1]].view(np.int32), ends // 4


def pair_counts(aligned: DataFrame, pairs: Pairs) -> np.ndarray:
    """How many links hold each pair. Every task adds up its own; the driver gets one
    number for each pair of the vocabularies, at most."""
    size = len(pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_drops()
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_places(batch.column(0))[0], minlength=size)
        some = np.flatnonzero(total)
        yield pa.record_batch({"pair": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    rows = (aligned.select("links").mapInArrow(count, "pair int, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(size, np.int64)
    out[rows["pair"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def with_link_counts(aligned: DataFrame, pairs: Pairs, counts: np.ndarray) -> DataFrame:
    """``aligned`` with n_links, n_best (links whose pair has its B id's highest count)
    and count_sum (of the links' pairs' counts) in place of ``links``."""
    both = aligned.sparkSession.sparkContext.broadcast((counts, pairs.best(counts)))
    kept = [f for f in aligned.schema.fields if f.name != "links"]
    at = [aligned.columns.index(f.name) for f in kept]
    links_at = aligned.columns.index("links")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_drops()
        counts, best = both.value
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, cut = _places(batch.column(links_at))
            sums = [np.concatenate([[0], np.cumsum(v)]) for v in (best[flat].astype(np.int64), counts[flat])]
            yield pa.record_batch({
                **{f.name: batch.column(i) for f, i in zip(kept, at)}, "n_links": pa.array(np.diff(cut), pa.int64()),
                "n_best": pa.array(np.diff(sums[0][cut])), "count_sum": pa.array(np.diff(sums[1][cut]))})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return aligned.mapInArrow(look, f"{schema}, n_links long, n_best long, count_sum long")


def groups_digest(groups: Column) -> Column:
    """Hex SHA-256 of the groups; of a text without tokens ''."""
    return F.when(F.length(groups) > 0, F.sha2(groups, 256)).otherwise("")


def cross_align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256. Texts are tokenized once; what the counts need is stored in between."""
    aligner = Aligner(a_path, b_path)
    pairs = Pairs(aligner.a_bytes, aligner.b_bytes)
    once = align_documents(docs, a_path, b_path, pairs).select(
        "doc_id", "n_a", "n_b", (F.octet_length("links") / 4).cast("long").alias("n_groups"),
        groups_digest(F.col("groups")).alias("groups_sha256"), "links")
    path = scratch(docs.sparkSession, "aligned")
    once.write.option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.schema(once.schema).parquet(path)
    return with_link_counts(stored, pairs, pair_counts(stored, pairs)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
