"""SentencePiece encoding and decoding.

The pieces of a model file form an Aho-Corasick automaton. One pass over the
text follows its output links: each piece that ends at a position relaxes that
position's best score, which is the unigram Viterbi path. Characters that no
piece covers fall back to bytes. Texts are cut before spaces where no piece can
cross, so the best paths of the parts make up the best path of the whole, and a
worker keeps the ids of the parts it has met.

Defined cases: null text is empty and has no ids; ties go to the path whose last
piece is longest; a ``U+2581`` in the text, which stands for the space in
pieces, is written as bytes, so that decoding gives back every text exactly;
control pieces in a text are ordinary text; very long texts are never cut short;
an empty table gives no rows; other columns stay as they are, but for a column
with the name of a new one, which is replaced.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import worker_keeps
from .word_codes import WordCodes, blocks

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # below the lowest score

class PieceModel:
    """Vocabulary of a SentencePiece model file: automaton and decoder."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unknown = sp.unk_id()
        self.byte_id = [-1] * 256
        self.byte_of: dict[int, int] = {}
        self.hidden = {i for i in range(n) if sp.is_control(i)}
        usable = [i for i in range(n)
                  if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
        for i in range(n):
            if sp.is_byte(i):
                b = int(self.pieces[i][3:5], 16)
                self.byte_id[b], self.byte_of[i] = i, b
        self.has_bytes = min(self.byte_id) >= 0
        scores = [sp.get_score(i) for i in usable]
        self.floor = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i, s in zip(usable, scores):
            self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), s, i))
        self.automaton.make_automaton()
        # a piece with a space mark after another character forbids cutting there
        self.crossing = any(re.search(f"[^{SPACE}]{SPACE}", self.pieces[i]) for i in usable)
        self.codes = WordCodes(self._learn)
        # what a piece decodes to alone; only bytes of longer characters need their neighbours
        self.spaced = pa.array([chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else p.replace(SPACE, " ")
                                for i, p in enumerate(self.pieces)], pa.string())
        self.plain = np.array([self.byte_of.get(i, 0) < 128 and i not in self.hidden for i in range(n)])

    def viterbi(self, part: str) -> array:
        """Ids of the best path over one string of marked text."""
        n = len(part)
        floor = self.floor
        # 16 bytes a character: best score, last piece and its length (0: none yet)
        best, sizes, pieces = array("d", bytes(8 * (n + 1))), array("i", bytes(4 * (n + 1))), array("i", bytes(4 * (n + 1)))
        now, single = 0, True    # position being relaxed; whether a piece of one character ends there

        def unknown(at: int) -> None:
            value = best[at - 1] + floor
            if not sizes[at] or value > best[at]:
                best[at], sizes[at], pieces[at] = value, 1, -1

        # matches come by end position, at each the longest first along the output links
        for last, (size, score, piece) in self.automaton.iter(part):
            if last >= now:
                if not single:
                    unknown(now)
                for at in range(now + 1, last + 1):
                    unknown(at)
                now, single = last + 1, False
            value = best[now - size] + score
            if not sizes[now] or value > best[now]:
                best[now], sizes[now], pieces[now] = value, size, piece
            if size == 1:
                single = True
        if not single:
            unknown(now)
        for at in range(now + 1, n + 1):
            unknown(at)
        out = array("i")
        at = n
        while at:
            start, piece = at - sizes[at], pieces[at]
            if piece >= 0:
                out.append(piece)
            elif self.has_bytes:
                out.extend(self.byte_id[b] for b in reversed(part[start].encode("utf-8", "surrogatepass")))
            else:
                out.append(self.unknown)
            at = start
        return out[::-1]

    def marked(self, text: str) -> list[int]:
        """Ids of a text that holds the space mark itself: those go as bytes."""
        out: list[int] = []
        for i, piece in enumerate((" " + text).split(SPACE)):
            if i:
                out.extend(self.byte_id[b] for b in SPACE.encode()) if self.has_bytes else out.append(self.unknown)
            if piece:
                out.extend(self.viterbi(piece.replace(" ", SPACE)))
        return out

    def _learn(self, words: list[str]) -> list[bytes | None]:
        """ids of words after a space; an empty word is one of several spaces."""
        return [np.array(self.viterbi(SPACE + w), np.int32).tobytes() if w and SPACE not in w else None for w in words]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        # a part is a word and the space before it; the text's first space is added
        ids = [None] * len(texts) if self.crossing else self.codes.encode(texts)
        out = []
        for i, got in enumerate(ids):
            if got is None:
                text = texts[i].as_py()
                out.append(np.array(self.marked(text) if text else [], np.int32))
            else:
                out.append(np.frombuffer(got, np.int32))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: bytes that are no UTF-8 become U+FFFD, control
        pieces nothing."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.hidden:
                out.append(self.pieces[i].replace(SPACE, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of many id lists (``ends`` cut ``flat``): pieces are joined by
        Arrow's kernels; lists with byte or control pieces by ``decode``."""
        pieces = self.spaced.take(pa.array(flat, pa.int32()))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces), "")
        text = pc.if_else(pc.starts_with(joined, " "), pc.utf8_slice_codeunits(joined, 1), joined)
        odd = np.searchsorted(ends, np.flatnonzero(~self.plain[flat]), "right") - 1
        rows = sorted(set(odd.tolist()))
        if not rows:
            return text
        mask = np.zeros(len(ends) - 1, bool)
        mask[rows] = True
        return pc.replace_with_mask(text, pa.array(mask), pa.array(
            [self.decode(flat[ends[i]:ends[i + 1]].tolist()) for i in rows], pa.string()))


def model(path: str) -> PieceModel:
    return worker_keeps(("pieces", path), lambda: PieceModel(path))


NEW = ("ids", "n_tokens", "ids_crc32", "round_trip")


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int), ``n_tokens``, ``ids_crc32`` (of the
    ids as little-endian uint32) and ``round_trip`` (decoding the ids gave back
    the text). One map over the rows, no shuffle. ``path`` is a model file that
    every executor can open."""
    docs = docs.drop(*NEW)
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                           T.StructField("round_trip", T.BooleanType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for piece in blocks(batch, batch.schema.get_field_index(text_col)):
                texts = piece.column(piece.schema.get_field_index(text_col)).fill_null("")
                ids = m.encode(texts)
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                columns = [*piece.columns,
                           pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                           pa.array(np.diff(ends), pa.int64()),
                           pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
                           pc.equal(m.decode_all(flat, ends), texts)]
                yield pa.RecordBatch.from_arrays(columns, names=[*piece.schema.names, *NEW])

    return docs.mapInArrow(encode, schema)


def decode_documents(docs: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``text`` decoded from the ids."""
    docs = docs.drop("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("text", T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            text = pa.array([m.decode(i or []) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "text"])

    return docs.mapInArrow(decode, schema)
