"""Packing documents into fixed-size sequences by Karmarkar-Karp differencing.

Each scan partition is packed on its own, so no text is shuffled. A document
becomes its token ids and an end id; whole windows' worth of it fill windows
of their own, and what is left is cut into pieces of at most ``piece`` tokens.
Pieces gather until they fill ``windows`` windows or are ``MOST_PIECES``, those
of few tokens in bundles that stay together; then the multiway differencing
method splits them: every piece or bundle starts as a partial partition
with one filled window; the two partial partitions with the largest spread
are merged again and again, the fullest window of one onto the emptiest of
the other, so that opposing imbalances cancel. The number of windows starts
at the least possible one and rises by one whenever a window would exceed
the capacity.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakeloom.llm.common import columns, lean, ship, text_bytes

CAPACITY, PIECE, WINDOWS = 4096, 1024, 192
#: Pieces below ``SMALL`` tokens are bundled up to ``BUNDLE`` tokens or more.
SMALL, BUNDLE, MOST_PIECES = 128, 256, 50_000

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def difference(sizes: np.ndarray, m: int) -> np.ndarray:
    """Window (0 to m - 1) of each size by multiway Karmarkar-Karp."""
    n = len(sizes)
    heap, left, right = [], [], []
    for i, s in enumerate(sizes.tolist()):
        loads, nodes = np.zeros(m, np.int64), np.full(m, -1, np.int64)
        loads[0], nodes[0] = s, i
        heap.append((-s, i, loads, nodes))
    heapq.heapify(heap)
    turn, made = n, n
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        y = y[::-1]
        loads = a + b[::-1]
        nodes = np.where(x < 0, y, x)
        both = np.flatnonzero((x >= 0) & (y >= 0))
        if len(both):
            nodes[both] = np.arange(made, made + len(both))
            left.extend(x[both].tolist())
            right.extend(y[both].tolist())
            made += len(both)
        order = np.argsort(-loads, kind="stable")
        loads, nodes = loads[order], nodes[order]
        heapq.heappush(heap, (int(loads[-1] - loads[0]), turn, loads, nodes))
        turn += 1
    window = np.zeros(made, np.int64)
    nodes = heap[0][3]
    window[nodes[nodes >= 0]] = np.flatnonzero(nodes >= 0)
    for k in range(made - 1, n - 1, -1):
        window[left[k - n]] = window[right[k - n]] = window[k]
    return window[:n]


def balance(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of near-equal load, as few as hold every load to ``capacity``."""
    m = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, m)
        if np.bincount(window, weights=sizes).max() <= capacity:
            return window
        m += 1


class _Packer:
    """Pieces of one partition, and their rows once their windows are fixed."""

    def __init__(self, part: int, capacity: int, piece: int, windows: int):
        self.next = part << 32
        self.capacity, self.piece, self.full = capacity, piece, capacity * windows
        self.small, self.bundle = min(SMALL, capacity // 32), min(BUNDLE, capacity // 16)
        self.rows: list[tuple] = []
        self.pool: list[tuple[int, list[tuple]]] = []
        self.open: list[tuple] = []
        self.held = self.open_size = self.pieces = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, cap = len(ids), self.capacity
        wide = ids.astype("<u4")
        whole = n // cap * cap
        for at in range(0, whole, cap):
            self.rows.append((doc_id, at, cap, zlib.crc32(wide[at:at + cap]), n, self.next, 0))
            self.next += 1
        rest = n - whole
        if rest:
            parts = -(-rest // self.piece)
            cuts = [whole + rest * k // parts for k in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                self._hold((doc_id, a, b - a, zlib.crc32(wide[a:b]), n))
        if self.held >= self.full or self.pieces >= MOST_PIECES:
            self.flush()

    def _hold(self, piece: tuple) -> None:
        size = piece[2]
        self.held += size
        self.pieces += 1
        if size >= self.small:
            self.pool.append((size, [piece]))
            return
        self.open.append(piece)
        self.open_size += size
        if self.open_size >= self.bundle:
            self._close()

    def _close(self) -> None:
        if self.open:
            self.pool.append((self.open_size, self.open))
        self.open, self.open_size = [], 0

    def flush(self) -> None:
        self._close()
        if not self.pool:
            return
        window = balance(np.array([size for size, _ in self.pool], np.int64), self.capacity)
        fill: dict[int, int] = {}
        for (size, pieces), w in zip(self.pool, window.tolist()):
            at = fill.get(w, 0)
            fill[w] = at + size
            for p in pieces:
                self.rows.append((*p, self.next + w, at))
                at += p[2]
        self.next += max(fill) + 1
        self.pool, self.held, self.pieces = [], 0, 0

    def take(self) -> pa.RecordBatch:
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        cols = list(zip(*self.rows)) if self.rows else [()] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(names))


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2,
         capacity: int = CAPACITY, piece: int = PIECE, windows: int = WINDOWS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    A null or empty text is its end id alone. Long texts fill windows of their
    own, so a partition holds at most ``windows`` windows of pieces at a time
    beside the text it is reading. Repeated rows are packed as often as they
    occur; a null id stays null; an empty table gives no rows. Sequence ids
    are unique across partitions and rise within one. The sequences are meant
    to be padded to ``capacity``, those of a power of two not at all.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.packing import _Packer
        from lakeloom.llm.tokens import encoder

        enc = encoder(tokenizer)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        packer = _Packer(TaskContext.get().partitionId(), capacity, piece, windows)
        try:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = np.frombuffer(enc.packed(text_bytes(text.as_py())) + end, dtype=enc.dtype)
                    packer.add(doc_id, ids)
                    if len(packer.rows) >= MOST_PIECES:
                        yield packer.take()
                yield packer.take()
            packer.flush()
            yield packer.take()
        finally:
            enc.rest()

    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(lean(run), SCHEMA)
