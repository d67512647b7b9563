"""Packing of documents into training windows by multiway differencing.

Each task packs the documents of its own input partition, so nothing is
shuffled. Full windows are cut off long documents; what is left (at most
``piece`` tokens a piece) is gathered until it fills about ``block`` windows and is then
dealt out by the Karmarkar-Karp differencing method: every piece starts as a
partial partition with one loaded window; the two partitions with the largest
imbalance are merged, the heaviest window of one with the lightest of the other,
until one partition is left. If its heaviest window exceeds the capacity, the
number of windows is raised by one and the block is dealt out again. The last pieces
of a partition are dealt out alike, however few they are, into the whole windows they fill; the tokens beyond those
windows (and a few a window, so that near-equal loads fit) are cut into windows whose sizes are powers of two.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm import blocks, tokens

CAPACITY = 1024
END = 0
#: Rows of a batch whose texts are copied at a time.
ROWS = 512
#: Tokens a window that the last block of a task leaves free, tried in this order, so that its loads fit into as many windows as it fills.
SLACKS = (8, 32, 128)


def differencing(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Item numbers by window, near-equal in total size (largest differencing, ``windows`` ways)."""
    # A partial partition: loads above its lightest window, in rising order, and the items of each window.
    heap = []
    for i, size in enumerate(sizes.tolist()):
        load = np.zeros(windows, np.int64)
        load[-1] = size
        heap.append((-size, i, load, {windows - 1: [i]}))
    heapq.heapify(heap)
    ticket = len(heap)
    while len(heap) > 1:
        _, _, load_a, items_a = heapq.heappop(heap)
        _, _, load_b, items_b = heapq.heappop(heap)
        load = load_a + load_b[::-1]
        order = np.argsort(load, kind="stable")
        place = np.empty(windows, np.int64)
        place[order] = np.arange(windows)
        items: dict[int, list[int]] = {}
        for w, own in items_a.items():
            items.setdefault(int(place[w]), []).extend(own)
        for w, own in items_b.items():
            items.setdefault(int(place[windows - 1 - w]), []).extend(own)
        load = load[order]
        load -= load[0]
        heapq.heappush(heap, (-int(load[-1]), ticket, load, items))
        ticket += 1
    return list(heap[0][3].values()) if heap else []


def balanced(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Differencing with as few windows as keep every window within ``capacity``."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        dealt = differencing(sizes, windows)
        if all(sizes[own].sum() <= capacity for own in dealt):
            return dealt
        windows += 1


class _Packer:
    """State of one task: waiting pieces and the next sequence number."""

    def __init__(self, capacity: int, piece: int, block: int, first: int):
        self.capacity, self.piece, self.block, self.sequence = capacity, piece, block, first
        self.waiting: list[tuple] = []
        self.size = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            self._emit([(doc, start, ids[start : start + self.capacity], total)])
            start += self.capacity
        while start < total:
            stop = min(start + self.piece, total)
            self.waiting.append((doc, start, ids[start:stop], total))
            self.size += stop - start
            start = stop
        if self.size >= self.block * self.capacity:
            self._deal()

    def _deal(self) -> None:
        for own in balanced(np.array([len(p[2]) for p in self.waiting]), self.capacity):
            self._emit([self.waiting[i] for i in own])
        self.waiting, self.size = [], 0

    def finish(self) -> None:
        """Deals out the last, smaller block as well; only what does not fill a window is cut into powers of two."""
        whole = self.size // self.capacity
        for slack in SLACKS if whole else ():
            head, tail = self._split(whole * (self.capacity - slack))
            dealt = balanced(np.array([len(p[2]) for p in head]), self.capacity)
            if len(dealt) == whole:
                break
        if whole:
            for own in dealt:
                self._emit([head[i] for i in own])
            self.waiting, self.size = tail, sum(len(p[2]) for p in tail)
        self._cut()

    def _split(self, size: int) -> tuple[list[tuple], list[tuple]]:
        """The waiting pieces up to ``size`` tokens, and the rest."""
        head, tail = [], []
        for doc, start, ids, total in self.waiting:
            take = min(size, len(ids))
            size -= take
            if take:
                head.append((doc, start, ids[:take], total))
            if take < len(ids):
                tail.append((doc, start + take, ids[take:], total))
        return head, tail

    def _cut(self) -> None:
        left, room, open_ = self.size, 0, []
        for doc, start, ids, total in self.waiting:
            while len(ids):
                if not room:
                    room = min(self.capacity, 1 << (left.bit_length() - 1))
                    left -= room
                take = min(room, len(ids))
                open_.append((doc, start, ids[:take], total))
                ids, start, room = ids[take:], start + take, room - take
                if not room:
                    self._emit(open_)
                    open_ = []
        self.waiting, self.size = [], 0


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY, piece: int = 256, block: int = 64) -> DataFrame:
    """Pieces of all documents in windows of at most ``capacity`` tokens.

    A document's tokens are its ids and one id 0 at its end, so a null or empty text has one token. Returns
    one row for each piece: id, ``start`` (tokens of the document before it), ``length``, ``ids`` (binary, little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (place in the window, without gaps). Repeated rows are
    packed each; a null id is kept. Other columns are not read. Sequence numbers are unique and depend only on the
    input partition and the order in it. An empty table gives no rows. ``capacity`` is a power of two.
    """
    path = vocabulary or tokens.vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What earlier tasks of this worker left in Arrow's pool.
        pa.default_memory_pool().release_unused()
        coder = tokens.encoder(path)
        task = TaskContext.get()
        packer = _Packer(capacity, piece, block, (task.partitionId() if task else 0) << 36)

        def rows() -> pa.RecordBatch:
            columns = list(zip(*packer.out))
            packer.out = []
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for part in (b.slice(low, ROWS) for b in batches for low in range(0, b.num_rows, ROWS)):
            ids = part.column(0).to_pylist()
            for chunk in blocks.chunks(part.column(1)):
                for row in range(chunk.rows):
                    packer.add(ids[chunk.low + row], np.append(coder.ids(chunk.text(row).decode()), np.uint32(END)))
                if packer.out:
                    yield rows()
        packer.finish()
        if packer.out:
            yield rows()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    packed = source.mapInArrow(run, "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("id", id_col)
