"""Words of many texts at once, as arrays: what the operators on word sequences share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Rows of an outgoing batch; bytes of texts that are hashed at once; bytes beyond which a word is hashed by itself.
ROWS_OUT, BYTES_AT_ONCE, LONG_WORD = 512, 1 << 19, 128
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POINT = 0xD6E8FEB86659FD93
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Words:
    """Words (runs of bytes other than space and \\x09-\\x0D) of several texts, as one sequence.

    ``starts`` and ``ends`` are their places in ``data``, ``hash`` their 64-bit hashes, ``first[d]`` the
    number of the first word of text d, with the number of all words at the end.
    """

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join([*texts, b"        "])
        blank = _BLANK[np.frombuffer(self.data, np.uint8)]
        edges = np.flatnonzero(np.diff(blank.view(np.int8), prepend=np.int8(1)))
        self.starts, self.ends = edges[::2], edges[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.first = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)]))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Eight bytes at a time over all words that are long enough; very long words one by one."""
        size = self.ends - self.starts
        h = size.astype(np.uint64) * np.uint64(_POINT)
        eights = np.lib.stride_tricks.sliding_window_view(np.frombuffer(self.data, np.uint8), 8)
        some = np.flatnonzero(size <= LONG_WORD)
        for at in range(0, LONG_WORD, 8):
            left = size[some] - at
            some, left = (some[left > 0], left[left > 0]) if at else (some, left)
            if not len(some):
                break
            part = eights[self.starts[some] + at].view(np.uint64)[:, 0]
            over = (8 - np.minimum(left, 8)).astype(np.uint64) * np.uint64(8)
            x = (h[some] ^ (part << over)) * _MIX
            h[some] = x ^ (x >> np.uint64(29))
        for k in np.flatnonzero(size > LONG_WORD).tolist():
            h[k] = xxhash.xxh3_64_intdigest(self.data[self.starts[k] : self.ends[k]])
        return h


def parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of few rows and few bytes, with the texts of a column; null texts are empty."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            texts, size = [], 0
            for x in batch.column(column).slice(at, ROWS_OUT):
                texts.append((x.as_buffer().to_pybytes() if x.is_valid else b""))
                size += len(texts[-1])
                if size >= BYTES_AT_ONCE:
                    break
            yield batch.slice(at, len(texts)), texts
            at += len(texts)
