"""Suffix-sort deduplication of repeated byte strings.

A byte goes if it is covered by a string of ``SPAN`` bytes that also starts
earlier: in a document with a smaller id, or earlier in the same document.
Suffixes are compared by prefix polynomial hashes: a binary search finds the
common extension of two suffixes, which orders them, so a mergesort needs a
logarithmic number of hash comparisons per step.  Suffixes with a common
extension of ``SPAN`` bytes stand next to each other; equality is verified byte
by byte before anything is removed.

To sort at scale, suffixes first meet by content.  In every string of ``SPAN``
bytes the ``GRAM``-byte piece with the least hash (the first of equals) is its
anchor; equal strings have equal anchors at the same distance.  Neighbouring
strings with one anchor form a segment.  Anchor hashes go round first, once per
bucket of documents; only segments whose anchor occurs in several buckets are
exchanged with their bytes, and equal segments of one bucket are exchanged
once.  Segments arrive in order of anchor and document, and a group is worked on
in chunks that carry only its distinct segments.  An anchor with more than
``HOT`` segments (a short passage between ever differing neighbours) is not one
group: its strings are exchanged one by one, grouped by the hash of all their
``SPAN`` bytes, so that a group carries one string; a cryptographic digest of the
bytes stands for them there and decides equality.  Inside a bucket strings and
segments are views of its bytes, never copies.

Order: doc_id, null last; rows with equal doc_id and different text by a hash
of the text.  Rows that agree in both are one document and get equal results.
Null texts are empty.  Matches never cross documents.  Extra columns are
ignored.  All exchanges carry whole inputs; nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkclust.llm.common import release, text_of
from sparkclust.llm.textarrays import mix, prefix_hashes, ranges, slices, span_hashes

SPAN = 100
GRAM = 40
BUCKET_BYTES = 3 << 20
SLICE_BYTES = 1 << 20
CHUNK_BYTES = 3 << 20
#: Strings that repeat the one up to so many bytes before them (runs of a character, short patterns) are found at once.
PERIODS = 4
#: Bytes that are compared, and strings that are sorted, at once.
PIECE = 1 << 20
STRINGS = 250_000
#: Bytes of the digest that stands for a string of a frequent anchor.
DIGEST = 16
#: Segments of an anchor above which its strings are grouped by their whole bytes: about a chunk of them.
HOT = CHUNK_BYTES // (2 * SPAN)

SEGMENTS = "bucket long, key long, doc_id long, h long, start int, off int, n int, body binary"
MARKS = "bucket long, doc_id long, h long, marks binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def own_repeats(data: np.ndarray, offsets: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Flags of the starts of strings that equal the string 1 to ``PERIODS`` bytes before them in their row."""
    out = np.zeros(data.size, bool)
    row_start = np.repeat(offsets[:-1], np.diff(offsets))
    row_end = np.repeat(offsets[1:], np.diff(offsets))
    for q in range(1, PERIODS + 1):
        if data.size < span + q:
            break
        same = np.concatenate(([0], np.cumsum(data[q:] == data[:-q], dtype=np.int32)))
        at = np.flatnonzero(same[span:] - same[:-span] == span) + q
        at = at[(at - q >= row_start[at]) & (at + span <= row_end[at])]
        out[at] = True
    return out


def segments(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM, again: np.ndarray | None = None):
    """(row, start, off, n, key): runs of n strings with one anchor, which lies ``off`` bytes after the first's start.

    Strings that start where ``again`` is set are left out.
    """
    none = np.empty(0, np.int64)
    if data.size < span:
        return none, none, none, none, np.empty(0, np.int64)
    at = np.arange(data.size - gram + 1)
    h = mix(span_hashes(prefix_hashes(data), at, at + gram))
    # hash in the high bits, place in the low ones: the least is the first of the least
    bits = np.uint64(max(24, int(data.size).bit_length()))
    least = (h >> bits << bits) | at.astype(np.uint64)
    width, reach = span - gram + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: least.size - (width - reach)], least[width - reach :])
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # strings that end inside their row
    valid = np.zeros(anchor.size + 1, np.int32)
    size = np.diff(offsets)
    long = size >= span
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, offsets[1:][long] - span + 1, -1)
    inside = np.cumsum(valid[:-1]) > 0
    if again is not None:
        inside &= ~again[: inside.size]
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    new[offsets[:-1][long]] = inside[offsets[:-1][long]]
    start = np.flatnonzero(new)
    if start.size == 0:
        return none, none, none, none, np.empty(0, np.int64)
    counted = np.concatenate(([0], np.cumsum(inside)))
    n = counted[np.append(start[1:], anchor.size)] - counted[start]
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, start, anchor[start] - start, n, h[anchor[start]].view(np.int64)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the pieces at ``a`` and ``b`` are equal byte by byte, a bounded number of bytes at once."""
    out, done = np.ones(a.size, bool), 0
    ends = np.cumsum(size)
    while done < a.size:
        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PIECE, side="right")))
        p = slice(done, stop)
        differ = data[ranges(a[p], size[p])] != data[ranges(b[p], size[p])]
        out[p] = np.add.reduceat(differ, np.cumsum(size[p]) - size[p]) == 0
        done = stop
    return out


class Suffixes:
    """Suffixes of a text, compared on their first ``span`` bytes."""

    def __init__(self, data: np.ndarray, span: int):
        self.data, self.span, self.prefix = data, span, prefix_hashes(data)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension by binary search over hashes, at most ``span``."""
        lo, hi = np.zeros(a.size, np.int64), np.full(a.size, self.span)
        while (open_ := lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = span_hashes(self.prefix, a, a + mid) == span_hashes(self.prefix, b, b + mid)
            lo = np.where(open_ & same, mid, lo)
            hi = np.where(open_ & ~same, mid - 1, hi)
        return lo

    def less(self, a: np.ndarray, b: np.ndarray, equal: bool) -> np.ndarray:
        """a < b, or a <= b with ``equal``."""
        n = self.extension(a, b)
        tie = n == self.span
        m = np.minimum(n, self.span - 1)
        return np.where(tie, equal, self.data[a + m] < self.data[b + m])

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Stable order of the suffixes within their groups (``group`` ascends): bottom-up mergesort of all groups at once."""
        order = np.arange(at.size)
        first = np.searchsorted(group, group, side="left")
        size = np.searchsorted(group, group, side="right") - first
        width = 1
        while width < (size.max() if size.size else 0):
            moving = np.flatnonzero(size > width)  # groups that have more than one run
            local = moving - first[moving]
            run = local // width
            other = first[moving] + (run ^ 1) * width  # the sibling run
            end = np.minimum(other + width, first[moving] + size[moving])
            right = (run & 1).astype(bool)
            lo, hi = np.minimum(other, end), end.copy()
            base = lo.copy()
            mine = at[order[moving]]
            while (open_ := lo < hi).any():
                w = np.flatnonzero(open_)
                mid = (lo[w] + hi[w]) // 2
                theirs = at[order[mid]]
                # left run: how many on the right are smaller; right run: how many on the left are not larger
                before = np.empty(w.size, bool)
                r = right[w]
                before[~r] = self.less(theirs[~r], mine[w][~r], False)
                before[r] = self.less(theirs[r], mine[w][r], True)
                lo[w] = np.where(before, mid + 1, lo[w])
                hi[w] = np.where(before, hi[w], mid)
            start = first[moving] + (run & ~np.int64(1)) * width
            place = start + (local - run * width) + (lo - base)
            done = order.copy()
            done[place] = order[moving]
            order = done
            width *= 2
        return order

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Byte-by-byte comparison of the first ``span`` bytes."""
        out = np.ones(a.size, bool)
        for i in range(0, a.size, 20_000):
            p = slice(i, i + 20_000)
            k = np.arange(self.span)
            out[p] = (self.data[a[p][:, None] + k] == self.data[b[p][:, None] + k]).all(axis=1)
        return out


def resolve(key: np.ndarray, off: np.ndarray, n: np.ndarray, data: np.ndarray, start: np.ndarray, span: int = SPAN):
    """(repeats, first) of segments in document order, which are views: ``n`` strings from ``start`` in ``data``.

    ``repeats``: flags of all strings of all segments, one after the other, of
    those that stand in an earlier segment; ``first``: segments that equal no
    earlier one.
    """
    m = key.size
    windows = np.concatenate(([0], np.cumsum(n)))
    flags = np.zeros(windows[-1], bool)
    if m < 2:
        return flags, np.ones(m, bool)
    text = Suffixes(data, span)
    size = n - 1 + span
    whole = mix(span_hashes(text.prefix, start, start + size) ^ mix((off * 4096 + size).astype(np.uint64)))
    # equal segments (of a run of one character all are): by hash, then byte by byte
    order = np.lexsort((np.arange(m), whole, key))
    new = np.ones(m, bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (whole[order][1:] != whole[order][:-1])
    like = np.empty(m, np.int64)
    like[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    copy = np.flatnonzero(like != np.arange(m))
    copy = copy[(size[copy] == size[like[copy]]) & (off[copy] == off[like[copy]])]
    copy = copy[same_bytes(data, start[copy], start[like[copy]], size[copy])]
    first = np.ones(m, bool)
    first[copy] = False
    flags[ranges(windows[copy], n[copy])] = True
    # strings of the other segments that share an anchor: suffix sort, some anchors at a time
    rest = np.flatnonzero(first)
    rest = rest[np.argsort(key[rest], kind="stable")]
    head = np.flatnonzero(np.concatenate(([True], key[rest][1:] != key[rest][:-1])))
    strings = np.concatenate(([0], np.cumsum(n[rest])))
    tail = np.append(head[1:], rest.size)
    group = 0
    while group < head.size:
        until = max(group + 1, int(np.searchsorted(strings[tail], strings[head[group]] + STRINGS, side="right")))
        some = rest[head[group] : tail[until - 1]]
        _sort_strings(text, key, off, n, start, windows, some, flags)
        group = until
    return flags, first


def _sort_strings(text: Suffixes, key, off, n, start, windows, some: np.ndarray, flags: np.ndarray) -> None:
    """Flags the repeats among the strings of the segments ``some``, which have whole groups of one anchor."""
    span = text.span
    _, inverse, count = np.unique(key[some], return_inverse=True, return_counts=True)
    some, number = some[count[inverse] > 1], inverse[count[inverse] > 1]
    if some.size == 0:
        return
    by = np.argsort(some)  # document order
    some, number = some[by], number[by]
    owner = np.repeat(np.arange(some.size), n[some])
    w = ranges(np.zeros(some.size, np.int64), n[some])
    at = start[some][owner] + w
    group = number[owner] * 2 * span + off[some][owner] - w + span
    by = np.lexsort((owner, group))
    at, group, flat = at[by], group[by], (windows[some][owner] + w)[by]
    order = text.sort(at, group)
    a, b = at[order][:-1], at[order][1:]
    near = np.flatnonzero(group[:-1] == group[1:])
    near = near[text.extension(a[near], b[near]) == span]
    near = near[text.equal(a[near], b[near])]
    # the sort is stable and starts in document order: all but the first of a run stand earlier elsewhere
    flags[flat[order][near + 1]] = True


def runs(flags: np.ndarray, n: np.ndarray, start: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, from, to) byte ranges that the flagged strings cover, one per run of flags in a segment."""
    owner = np.repeat(np.arange(n.size), n)
    w = np.arange(owner.size) - np.repeat(np.cumsum(n) - n, n)
    at = np.flatnonzero(flags)
    if at.size == 0:
        return at, at, at
    new = np.ones(at.size, bool)
    new[1:] = (np.diff(at) > 1) | (owner[at][1:] != owner[at][:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], at.size) - 1
    seg = owner[at[first]]
    return seg, start[seg] + w[at[first]], start[seg] + w[at[last]] + span


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (key, bucket) per slice, with the number of different segments."""
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        for at, data, offsets in slices(batch, "text", SLICE_BYTES):
            row, start, off, n, key = segments(data, offsets, again=own_repeats(data, offsets))
            if key.size:
                bucket = buckets[at + row]
                whole = span_hashes(prefix_hashes(data), start, start + n - 1 + SPAN) ^ mix((off * 4096 + n).astype(np.uint64))
                order = np.lexsort((whole, bucket, key))
                key, bucket, whole = key[order], bucket[order], whole[order]
                new = np.ones(key.size, bool)
                new[1:] = (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])
                other = new.copy()
                other[1:] |= whole[1:] != whole[:-1]
                count = np.add.reduceat(other.astype(np.int64), np.flatnonzero(new))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[new]), pa.array(bucket[new]), pa.array(count)], names=["key", "bucket", "n"]
                )


def _documents(docs: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Distinct documents of a bucket in order, and for every row its document."""
    ids = docs.column("doc_id").to_pandas()
    last = ids.isna().to_numpy()
    number, h = ids.fillna(0).to_numpy(np.int64), docs.column("h").to_numpy()
    order = np.lexsort((h, number, last))
    new = np.ones(order.size, bool)
    for i in range(1, order.size):
        a, b = order[i - 1], order[i]
        new[i] = last[a] != last[b] or number[a] != number[b] or h[a] != h[b]
    document = np.empty(order.size, np.int64)
    document[order] = np.cumsum(new) - 1
    return docs.take(pa.array(order[new])), document


def _strings(which: np.ndarray, n: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, number within it) of the strings of the segments ``which`` that are not flagged."""
    before = np.cumsum(n) - n
    flat = ranges(before[which], n[which])
    owner = np.repeat(which, n[which])
    free = ~flags[flat]
    return owner[free], (flat - before[owner])[free]


def _digests(data: np.ndarray, begin: np.ndarray) -> bytes:
    """BLAKE2b digests of the strings at ``begin``, one after the other."""
    body = memoryview(np.ascontiguousarray(data))
    return b"".join(hashlib.blake2b(body[i : i + SPAN], digest_size=DIGEST).digest() for i in begin.tolist())


def _bucket_segments(docs: pa.Table, hot: pa.Table) -> pa.Table:
    """Repeats inside one bucket, as marks, and its distinct segments whose anchors other buckets have."""
    names = [x.split()[0] for x in SEGMENTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    if docs.num_rows == 0:
        return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
    bucket = docs.column("bucket")[0].as_py()
    docs, _ = _documents(docs)
    batch = docs.combine_chunks().to_batches()[0]
    shared = np.unique(hot.column("key").to_numpy())
    parts, texts, begins, own, base = [], [], [], [], 0
    for at, data, offsets in slices(batch, "text", SLICE_BYTES):
        again = own_repeats(data, offsets)
        row, start, off, n, key = segments(data, offsets, again=again)
        # runs of them: (row, from, to) in the row
        where = np.flatnonzero(again)
        edge = np.flatnonzero(np.diff(where, prepend=-2) > 1)
        lo, of = where[edge], np.searchsorted(offsets, where[edge], side="right") - 1
        hi = where[np.append(edge[1:], where.size) - 1] + SPAN if where.size else where
        own.append((at + of, lo - offsets[of], np.minimum(hi, offsets[of + 1]) - offsets[of]))
        parts.append((at + row, start + base, off, n, key))
        texts.append(data)
        begins.append(offsets[:-1] + base)
        base += data.size
    row, start, off, n, key = (np.concatenate(x) for x in zip(*parts, strict=True))
    data, begin = np.concatenate(texts), np.concatenate(begins)
    distinct, count = np.unique(key, return_counts=True)
    keep = np.isin(key, np.union1d(shared, distinct[count > 1]))
    row, start, off, n, key = row[keep], start[keep], off[keep], n[keep], key[keep]
    flags, first = resolve(key, off, n, data, start)
    place = start - begin[row]
    ids, hs = batch.column("doc_id"), batch.column("h")
    # the marks of one document, as one row that passes through the next exchange
    seg, lo, hi = runs(flags, n, place)
    out = []
    doc, lo, hi = (np.concatenate(x) for x in zip((row[seg], lo, hi), *own, strict=True))
    by = np.argsort(doc, kind="stable")
    doc, lo, hi = doc[by], lo[by], hi[by]
    if doc.size:
        for d in np.unique(doc):
            mine = doc == d if doc.size < 1000 else slice(*np.searchsorted(doc, [d, d + 1]))
            out.append((int(d), np.stack((lo[mine], hi[mine]), axis=1).astype(np.int64).tobytes()))
    split = np.isin(key, np.unique(hot.column("key").to_numpy()[hot.column("split").to_numpy()]))
    send = np.flatnonzero(first & np.isin(key, shared) & ~split)
    # of anchors with many segments, the first of equal strings, each by its own hash and digest
    string, w = _strings(np.flatnonzero(split), n, flags)
    string_key, digests = np.empty(0, np.int64), b""
    if string.size:
        at = start[string] + w
        content = span_hashes(prefix_hashes(data), at, at + SPAN)
        string_key = mix(content ^ mix(key[string].view(np.uint64) + (off[string] - w).astype(np.uint64))).view(np.int64)
        digests = _digests(data, at)
    m, k = len(out), send.size + string.size
    docs_of = np.concatenate((np.array([d for d, _ in out], np.int64), row[send], row[string]))
    marks_key = mix(np.array([d for d, _ in out], np.uint64) + np.uint64(bucket) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    pieces = [b for _, b in out] + [data[start[i] : start[i] + n[i] - 1 + SPAN].tobytes() for i in send.tolist()]
    cuts = np.arange(0, DIGEST * (string.size + 1), DIGEST, dtype=np.int32)
    alone = pa.Array.from_buffers(pa.binary(), string.size, [None, pa.py_buffer(cuts), pa.py_buffer(digests)])
    columns = [
        pa.array(np.full(m + k, bucket)), pa.array(np.concatenate((marks_key, key[send], string_key))),
        ids.take(pa.array(docs_of)), hs.take(pa.array(docs_of)),
        pa.array(np.concatenate((np.full(m, -1), place[send], place[string] + w)).astype(np.int32)),
        pa.array(np.concatenate((np.zeros(m), off[send], off[string] - w)).astype(np.int32)),
        pa.array(np.concatenate((np.zeros(m), n[send], np.zeros(string.size))).astype(np.int32)),
        pa.chunked_array([pa.array(pieces, pa.binary()), alone]),
    ]
    del parts, texts, data, flags, string, w
    release()
    return pa.Table.from_arrays(columns, names=names)


MARK_COLUMNS = ["bucket", "doc_id", "h", "marks"]


def _marks(rows: pa.Table | pa.RecordBatch, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """The byte ranges of ``rows`` as marks."""
    marks = [x.tobytes() for x in np.stack((lo, hi), axis=1).astype(np.int64)]
    if isinstance(rows, pa.Table):
        rows = rows.combine_chunks()
    columns = [rows.column(c) for c in MARK_COLUMNS[:3]]
    columns = [(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c) if lo.size else pa.array([], pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays([*columns, pa.array(marks, pa.binary())], names=MARK_COLUMNS)


class _Seen:
    """Strings that come as digests, in order of key and document: all but the first of equal ones are repeats."""

    def __init__(self) -> None:
        self.key, self.digests = None, set()

    def repeats(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        again = []
        for i, (key, digest) in enumerate(zip(rows.column("key").to_pylist(), rows.column("body").to_pylist(), strict=True)):
            if key != self.key:
                self.key, self.digests = key, {digest}
            elif digest in self.digests:
                again.append(i)
            else:
                self.digests.add(digest)
        rows = rows.take(pa.array(again, pa.int64()))
        start = rows.column("start").to_numpy().astype(np.int64)
        return _marks(rows, start, start + SPAN)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats across buckets from segments in order of key and document; rows with marks pass through."""
    held: list[pa.Table] = []
    held_bytes, old, seen = 0, 0, _Seen()

    def work(table: pa.Table, known: int) -> tuple[pa.RecordBatch, np.ndarray]:
        key, off, n = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "off", "n"))
        start = table.column("start").to_numpy().astype(np.int64)
        column = table.column("body").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
        cut = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        body = np.frombuffer(column.buffers()[2], np.uint8)[cut[0] : cut[-1]]
        flags, first = resolve(key, off, n, body, cut[:-1] - cut[0])
        flags[: int(n[:known].sum())] = False
        seg, lo, hi = runs(flags, n, start)
        return _marks(table.take(pa.array(seg)), lo, hi), first

    for batch in batches:
        ready = batch.filter(pc.less(batch.column("start"), 0))
        if ready.num_rows:
            yield pa.RecordBatch.from_arrays([ready.column(c) for c in ("bucket", "doc_id", "h", "body")], names=MARK_COLUMNS)
        batch = batch.filter(pc.greater_equal(batch.column("start"), 0))
        strings = batch.filter(pc.equal(batch.column("n"), 0))
        if strings.num_rows:
            yield seen.repeats(strings)
        batch = batch.filter(pc.greater(batch.column("n"), 0))
        if batch.num_rows == 0:
            continue
        held.append(pa.Table.from_batches([batch]))
        held_bytes += batch.nbytes
        if held_bytes < CHUNK_BYTES:
            continue
        table = pa.concat_tables(held).combine_chunks()
        key = table.column("key").to_numpy()
        # whole groups are done; of the last group its distinct segments are carried on
        tail = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if tail:
            out, _ = work(table.slice(0, tail), old)
            yield out
            held, old = [table.slice(tail)], 0
        else:
            out, first = work(table, old)
            yield out
            held, old = [table.filter(pa.array(first))], int(first.sum())
        held_bytes = sum(t.nbytes for t in held) if tail else 0  # what is carried on does not count as new
    if held:
        table = pa.concat_tables(held).combine_chunks()
        if table.num_rows:
            yield work(table, old)[0]


def _removed(docs: pa.Table, marks: pa.Table) -> pa.Table:
    """The result rows of one bucket."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    spans: dict[tuple, list[np.ndarray]] = {}
    for d, h, m in zip(*(marks.column(c).to_pylist() for c in ("doc_id", "h", "marks")), strict=True):
        spans.setdefault((d, h), []).append(np.frombuffer(m, np.int64).reshape(-1, 2))
    rows = []
    for d, h, text in zip(docs.column("doc_id").to_pylist(), docs.column("h").to_pylist(), docs.column("text"), strict=True):
        body = text.as_buffer() if text.is_valid else b""
        body = memoryview(body) if body else memoryview(b"")
        merged: list[list[int]] = []
        if (d, h) in spans:
            ranges = np.concatenate(spans[d, h])
            for lo, hi in ranges[np.argsort(ranges[:, 0], kind="stable")].tolist():
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
        digest, at = hashlib.sha256(), 0
        for lo, hi in merged:
            digest.update(body[at:lo])
            at = hi
        digest.update(body[at:])
        out = [{"start": lo, "end": hi} for lo, hi in merged]
        rows.append((d, len(body), sum(hi - lo for lo, hi in merged), len(merged), digest.hexdigest(), out))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte ranges removed)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // BUCKET_BYTES) + 1
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "h"), F.lit(n)))
    rows = rows.select("bucket", "doc_id", "h", "text")
    anchors = rows.mapInArrow(_anchors, "key long, bucket long, n long")
    # one row per anchor and bucket: the count is of buckets, not of documents
    everywhere = Window.partitionBy("key")
    several = F.min("bucket").over(everywhere) != F.max("bucket").over(everywhere)
    split = F.sum("n").over(everywhere) > F.lit(HOT)
    hot = anchors.withColumn("several", several).withColumn("split", split).where("several").select("bucket", "key", "split")
    # the exchange of the texts by bucket is the same in both places and is reused
    by_bucket = rows.groupBy("bucket")
    parts = by_bucket.cogroup(hot.groupBy("bucket")).applyInArrow(_bucket_segments, SEGMENTS)
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 4 + 1)
    parts = parts.repartition(width, "key").sortWithinPartitions("key", F.col("doc_id").asc_nulls_last(), "h", "start")
    marks = parts.mapInArrow(_compare, MARKS)
    return by_bucket.cogroup(marks.groupBy("bucket")).applyInArrow(_removed, RESULT)
