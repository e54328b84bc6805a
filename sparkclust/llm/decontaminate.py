"""Benchmark decontamination by the q-gram lemma.

Texts are compared byte by byte after folding ASCII case and turning every
blank into a space; offsets stay those of the text.  A text within ``k`` edits
of a benchmark item of ``n`` bytes shares at least ``n + 1 - q (k + 1)`` of its
q-grams with it, on at most ``k + 1`` neighbouring diagonals.  So shared q-grams
are counted in overlapping diagonal bands of width ``2 (k + 1)``; bands that
reach the bound become regions, and each region is verified by a banded
alignment of the whole item.  ``k`` is ``EDIT_SHARE`` of the item's length, less
for short items so that the bound is at least one; items shorter than ``q``
match exactly.

The benchmark is worked on in blocks of at most ``BLOCK_BYTES`` of item text
(one longer item forms a block), each broadcast and held against all documents
in one pass.  Null and empty texts or items never match.  Repeated items and
rows each give their own results.  No document leaves its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclust.llm.common import text_of
from sparkclust.llm.textarrays import IS_BLANK, prefix_hashes, slices, span_hashes

Q = 12
EDIT_SHARE = 0.05
BLOCK_BYTES = 4 << 20
BITS = 22
#: Bytes of text that a task works on at once.
SLICE_BYTES = 1 << 20
FOLD = np.where(IS_BLANK, 32, np.arange(256)).astype(np.uint8)
FOLD[65:91] += 32
FAR = np.int64(1) << 40

MATCHES = "doc_id long, item_id long, start long, end long, distance int"


class Index:
    """q-grams of the items of one block, sorted by hash, with a bit table in front."""

    def __init__(self, items: list[tuple[int, str]]):
        kept = [(i, b) for i, t in items if (b := FOLD[np.frombuffer((t or "").encode(), np.uint8)]).size and (b != 32).any()]
        # blanks at either end are not part of an item
        kept = [(i, b[np.flatnonzero(b != 32)[0] : np.flatnonzero(b != 32)[-1] + 1]) for i, b in kept]
        self.ids = [i for i, _ in kept]
        self.items = [b for _, b in kept]
        self.size = np.array([b.size for b in self.items], np.int64)
        self.edits = np.maximum(np.minimum((self.size * EDIT_SHARE).astype(np.int64), self.size // Q - 1), 0)
        self.bound = self.size + 1 - Q * (self.edits + 1)
        self.short = [k for k, b in enumerate(self.items) if b.size < Q]
        hashes, owner, place = [], [], []
        for k, b in enumerate(self.items):
            if b.size >= Q:
                at = np.arange(b.size - Q + 1)
                hashes.append(span_hashes(prefix_hashes(b), at, at + Q))
                owner.append(np.full(at.size, k, np.int64))
                place.append(at)
        none = np.empty(0, np.int64)
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.owner = (np.concatenate(owner) if owner else none)[order]
        self.place = (np.concatenate(place) if place else none)[order]
        self.table = np.zeros(1 << BITS, bool)
        self.table[(self.hash >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def regions(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, band) of the diagonal bands that reach the bound."""
        none = np.empty(0, np.int64)
        if self.hash.size == 0 or data.size < Q:
            return none, none, none
        at = np.arange(data.size - Q + 1)
        h = span_hashes(prefix_hashes(data), at, at + Q)
        at = np.flatnonzero(self.table[(h >> np.uint64(64 - BITS)).astype(np.int64)])
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + Q <= offsets[row + 1]
        at, row = at[inside], row[inside]
        lo, hi = np.searchsorted(self.hash, h[at], "left"), np.searchsorted(self.hash, h[at], "right")
        n = hi - lo
        hit = np.repeat(np.arange(at.size), n)
        entry = np.arange(hit.size) - np.repeat(np.cumsum(n) - n, n) + lo[hit]
        item, diagonal = self.owner[entry], (at - offsets[row])[hit] - self.place[entry]
        band = diagonal // (self.edits[item] + 1)
        row = row[hit]
        if row.size == 0:
            return none, none, none
        # a hit lies in the band that starts at its own step and in the one before
        row, item, band = np.tile(row, 2), np.tile(item, 2), np.concatenate((band, band - 1))
        order = np.lexsort((band, item, row))
        row, item, band = row[order], item[order], band[order]
        new = np.ones(row.size, bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, row.size))
        keep = first[count >= self.bound[item[first]]]
        return row[keep], item[keep], band[keep]

    def align(self, data: np.ndarray, offsets: np.ndarray, row: np.ndarray, item: np.ndarray, band: np.ndarray):
        """(distance, start, end) of the best alignment of each item inside its band."""
        n, k = self.size[item], self.edits[item]
        low = band * (k + 1) - k
        width = 2 * (k + 1) + 2 * k
        wide, longest, m = int(width.max()), int(n.max()), row.size
        length = (offsets[row + 1] - offsets[row])[:, None]
        lanes = np.arange(wide)[None, :]
        held = np.zeros((m, longest), np.uint8)
        for x in range(m):
            held[x, : n[x]] = self.items[item[x]]
        diagonal = low[:, None] + lanes
        outside = lanes >= width[:, None]
        begin = (diagonal >= 0) & (diagonal <= length) & ~outside
        one = np.int64(1) << 20
        cost = np.where(begin, lanes, FAR)  # cost in the high bits, starting lane in the low ones
        shift = lanes * one
        best = np.full(m, FAR)
        end = np.zeros(m, np.int64)
        source = offsets[row][:, None] + diagonal
        for i in range(1, longest + 1):
            j = diagonal + i  # end of the text side, exclusive
            ok = (j >= 0) & (j <= length) & ~outside
            at = np.clip(source + i - 1, 0, data.size - 1)
            differs = (data[at] != held[:, i - 1 : i]) | (j < 1)
            step = cost + differs * one
            step[j < 1] = FAR
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + one)
            step = np.where(ok, step, FAR)
            cost = np.minimum.accumulate(step - shift, axis=1) + shift
            cost = np.where(ok, cost, FAR)
            for x in np.flatnonzero(n == i):
                end[x] = int(np.argmin(cost[x]))
                best[x] = cost[x, end[x]]
        distance = best >> np.int64(20)
        start = low + (best & (one - 1))
        return distance, start, n + low + end

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item id, start, end, distance), byte offsets; overlapping regions of an item count once."""
        data = FOLD[data]
        row, item, band = self.regions(data, offsets)
        found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        order = np.argsort(self.size[item], kind="stable")
        for x in range(0, order.size, 2048):
            part = order[x : x + 2048]
            distance, start, end = self.align(data, offsets, row[part], item[part], band[part])
            for p, d, s, e in zip(part, distance, start, end, strict=True):
                if d <= self.edits[item[p]]:
                    found.setdefault((int(row[p]), int(item[p])), []).append((int(d), int(s), int(e)))
        body = data.tobytes() if self.short else b""
        for k in self.short:
            word, at = self.items[k].tobytes(), 0
            while (at := body.find(word, at)) >= 0:
                r = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(word) <= offsets[r + 1]:
                    s = at - int(offsets[r])
                    found.setdefault((r, k), []).append((0, s, s + len(word)))
                at += 1
        out = []
        for (r, k), spans in sorted(found.items()):
            taken: list[tuple[int, int]] = []
            for d, s, e in sorted(spans):
                if all(e <= a or s >= b for a, b in taken):
                    taken.append((s, e))
                    out.append((r, self.ids[k], s, e, d))
        return out


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[list[tuple[int, str]]]:
    """The items in lists of about ``BLOCK_BYTES`` each; only one list is on its way to the driver at a time."""
    items = benchmark.select(F.col(id_col).cast("long").alias("i"), text_of(text_col).alias("t")).where("t != ''")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = int(-(-total // BLOCK_BYTES))
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else items
        yield [(r.i, r.t) for r in part.collect()]


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per region of a document within the edit budget of an item; offsets are code points.

    Columns: doc_id, item_id, start, end, distance.  No match: no row.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    out = spark.createDataFrame([], MATCHES)
    for block in blocks(benchmark):
        index = spark.sparkContext.broadcast(Index(block))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, data, offsets in slices(batch, "_text", SLICE_BYTES):
                    rows = index.value.matches(data, offsets)
                    if rows:
                        ids = batch.column("doc_id").slice(first, offsets.size - 1)
                        # byte offsets to code points: continuation bytes do not count
                        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                        at = [(points[offsets[r] + s] - points[offsets[r]], points[offsets[r] + e] - points[offsets[r]]) for r, _, s, e, _ in rows]
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array([r[0] for r in rows])),
                                pa.array([r[1] for r in rows], pa.int64()),
                                pa.array([int(a) for a, _ in at], pa.int64()),
                                pa.array([int(b) for _, b in at], pa.int64()),
                                pa.array([r[4] for r in rows], pa.int32()),
                            ],
                            names=["doc_id", "item_id", "start", "end", "distance"],
                        )

        out = out.unionByName(docs.mapInArrow(run, MATCHES))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; nothing is shuffled."""
    spark = docs.sparkSession
    for block in blocks(benchmark):
        index = spark.sparkContext.broadcast(Index(block))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, data, offsets in slices(batch, text_col, SLICE_BYTES):
                    keep[[first + r[0] for r in index.value.matches(data, offsets)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
