"""Ids of texts put together from the ids of their words.

Texts are split, and their words numbered, by Arrow's kernels; Python sees each
distinct word of a block once, and a learner only those not met before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 450_000      # words a worker keeps, twice at most
LONG_WORD = 64       # longer words are not kept
BLOCK = 4 << 20      # bytes of text handled at once, or one text


def blocks(batch: pa.RecordBatch, column: int, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of a string column."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, end - at)
        at = end


class WordCodes:
    """``learn`` gives the ids (as bytes) of new words, or None for a word that
    must not be coded alone; texts with one are left to the caller."""

    def __init__(self, learn: Callable[[list[str]], list[bytes | None]]) -> None:
        self.learn = learn
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _codes(self, words: list[str]) -> list[bytes | None]:
        if len(self.known) > CACHE:
            # words not met since the last change go with the next
            self.older, self.known = self.known, {}
        got = list(map(self.known.get, words))
        missing = [i for i, v in enumerate(got) if v is None]
        new = []
        for i in missing:
            old = self.older.get(words[i])
            if old is None:
                new.append(i)
            else:
                got[i] = self.known[words[i]] = old
        for i, ids in zip(new, self.learn([words[i] for i in new])):
            got[i] = ids
            if ids is not None and len(words[i]) <= LONG_WORD:
                self.known[words[i]] = ids
        return got

    def encode(self, texts: pa.Array) -> list[bytes | None]:
        """ids of each text, its words cut at single spaces; None where a word
        has none."""
        lists = pc.split_pattern(texts, " ")
        ends = lists.offsets.to_numpy()
        numbered = pc.dictionary_encode(lists.flatten())
        if isinstance(numbered, pa.ChunkedArray):
            numbered = numbered.combine_chunks()
        codes = pa.array(self._codes(numbered.dictionary.to_pylist()), pa.large_binary())
        spread = codes.take(numbered.indices)
        at = np.frombuffer(spread.buffers()[1], np.int64)[spread.offset:spread.offset + len(spread) + 1]
        data = memoryview(spread.buffers()[2] or b"")
        bad = np.flatnonzero(spread.is_null().to_numpy(zero_copy_only=False)) + ends[0]
        whole = set((np.searchsorted(ends, bad, "right") - 1).tolist())
        cut = at[ends - ends[0]].tolist()
        return [None if i in whole else bytes(data[lo:hi]) for i, (lo, hi) in enumerate(zip(cut, cut[1:]))]
