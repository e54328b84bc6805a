"""Byte-level BPE: every distinct word of the corpus is encoded once.

Texts are cut into pre-tokens by a pattern.  In slices of about ``SLICE_BYTES``
of text a scan task numbers the distinct pre-tokens, most frequent first, and
keeps each document as the numbers in order of position.  Then

1. every slice sends each of its distinct words once, by hash bucket;
2. a bucket merges each distinct word once, whatever number of slices has it, and
   sends the ids back to the slices (the join back of ids);
3. a slice reassembles its documents from numbers and ids by position.

A frequent word so costs one entry per slice, not one per occurrence, and no
text leaves its task: numbers, words and ids go round in compressed blocks.  The
exchange by slice carries the words too, so that words and documents come from
one pass over the texts (the exchange is reused).  Slices are numbered by
partition and place, so ``docs`` must be a repeatable read (a table).

Decoding joins the table of token bytes, whose size is that of the vocabulary
and which every task gets whole, to the ids of a batch at once.

A null or empty text has no ids and decodes to nothing.  Every row gives a row;
repeated rows and null doc_ids too.  Ids are those of ranks without special
tokens.  ``decode`` gives null for null ids and raises for ids that are not in
the vocabulary.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclust.llm.common import text_of
from sparkclust.llm.textarrays import ranges

#: Bytes of text that share one numbering, and bytes of text per bucket of words.
SLICE_BYTES = 16 << 20
BUCKET_BYTES = 32 << 20
#: Characters above which a text's pre-tokens are not listed at once, and numbers that are turned into ids at once.
LONG = 1 << 20
CHUNK = 1 << 18
#: Ids that are decoded at once, but for a single longer document.
DECODED = 2 << 20

CODED = "slice long, bucket int, doc_id long, n long, body binary"
IDS = "slice long, n long, m long, body binary"
ENCODED = "doc_id long, ids array<int>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank merges first, the left one of equals."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    size = len(word)
    end = list(range(1, size + 1))  # end of the part that starts here; 0: no part starts here
    before = list(range(-1, size))  # start of the part before the one that starts here
    pairs = [(ranks[p], i, i + 2) for i in range(size - 1) if (p := word[i : i + 2]) in ranks]
    heapq.heapify(pairs)
    while pairs:
        _, i, stop = heapq.heappop(pairs)
        middle = end[i]
        if not middle or middle >= size or end[middle] != stop:
            continue  # one of the two parts has merged since
        end[i], end[middle] = stop, 0
        if stop < size:
            before[stop] = i
            rank = ranks.get(word[i : end[stop]])
            if rank is not None:
                heapq.heappush(pairs, (rank, i, end[stop]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(word[left:stop])
            if rank is not None:
                heapq.heappush(pairs, (rank, left, stop))
    out, i = [], 0
    while i < size:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def squeezed(values: np.ndarray) -> bytes:
    """Small numbers compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _coded(pattern: str, buckets: int):
    def rows(key: int, numbers: Numbers, docs: list[tuple]) -> Iterator[pa.RecordBatch]:
        line = np.concatenate([np.frombuffer(codes, np.uint32) for _, codes in docs])
        uses = np.bincount(line, minlength=len(numbers))
        rank = np.empty(uses.size, np.uint32)
        rank[np.argsort(-uses, kind="stable")] = np.arange(uses.size, dtype=np.uint32)
        out = [(key, -1, doc_id, len(codes), squeezed(rank[np.frombuffer(codes, np.uint32)] if len(codes) else rank[:0])) for doc_id, codes in docs]
        words = [w.encode("utf-8", "surrogatepass") for w in numbers]
        place = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(place, kind="stable")
        for mine in np.split(order, np.flatnonzero(np.diff(place[order])) + 1) if order.size else []:
            these = [words[i] for i in mine.tolist()]
            head = squeezed(np.concatenate(([len(w) for w in these], rank[mine])))
            body = len(head).to_bytes(4, "little") + head + pa.compress(b"".join(these), "zstd", asbytes=True)
            out.append((key, int(place[mine[0]]), None, len(these), body))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in CODED.split(", ")]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern)
        key = TaskContext.get().partitionId() << 32
        numbers, docs, held = Numbers(), [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                found = cut.findall(text) if len(text) < LONG else (m.group() for m in cut.finditer(text))
                docs.append((doc_id, array("I", map(numbers.__getitem__, found))))
                held += len(text)
                if held >= SLICE_BYTES:
                    yield from rows(key, numbers, docs)
                    key, numbers, docs, held = key + 1, Numbers(), [], 0
        if docs:
            yield from rows(key, numbers, docs)

    return run


def _words_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # not a filter of the frame: that would be pushed below the exchange and end its reuse
    for batch in batches:
        yield batch.filter(pc.greater_equal(batch.column("bucket"), 0))


def _encoded(tokens):
    """Ids of the words of one bucket, each distinct word merged once, as one row per slice."""

    def run(group: pa.Table) -> pa.Table:
        ranks = {t: i for i, t in enumerate(tokens.value)}
        known: dict[bytes, bytes] = {}
        out = []
        for key, n, body in zip(*(group.column(c).to_pylist() for c in ("slice", "n", "body")), strict=True):
            cut = 4 + int.from_bytes(body[:4], "little")
            head = unsqueezed(body[4:cut], 2 * n)
            ends = np.cumsum(head[:n], dtype=np.int64).tolist()
            text = pa.decompress(body[cut:], ends[-1], "zstd", asbytes=True)
            ids, start = [], 0
            for end in ends:
                word = text[start:end]
                got = known.get(word)
                if got is None:
                    got = known[word] = array("I", merge(word, ranks)).tobytes()
                ids.append(got)
                start = end
            sizes = np.fromiter(map(len, ids), np.uint32, n) // 4
            flat = np.frombuffer(b"".join(ids), np.uint32)
            out.append((key, n, flat.size, squeezed(np.concatenate((head[n:], sizes, flat)))))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["slice", "n", "m", "body"])

    return run


def _reassembled(coded: pa.Table, ids: pa.Table) -> pa.Table:
    """Documents of one slice: their numbers, position by position, replaced by ids."""
    total = sum(ids.column("n").to_pylist())
    size, start = np.zeros(total, np.int64), np.zeros(total, np.int64)
    parts, base = [], 0
    for n, m, body in zip(*(ids.column(c).to_pylist() for c in ("n", "m", "body")), strict=True):
        values = unsqueezed(body, 2 * n + m)
        codes, sizes = values[:n], values[n : 2 * n].astype(np.int64)
        size[codes] = sizes
        start[codes] = base + np.cumsum(sizes) - sizes
        parts.append(values[2 * n :])
        base += m
    flat = np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
    docs = coded.filter(pc.less(coded.column("bucket"), 0))
    found, ends = [], [0]
    for n, body in zip(docs.column("n").to_pylist(), docs.column("body").to_pylist(), strict=True):
        codes = unsqueezed(body, n)
        for i in range(0, n, CHUNK):
            some = codes[i : i + CHUNK]
            found.append(flat[ranges(start[some], size[some])])
        ends.append(ends[-1] + int(size[codes].sum()))
    values = pa.array(np.concatenate(found) if found else flat[:0], pa.int32())
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    return pa.Table.from_arrays([docs.column("doc_id").combine_chunks(), lists], names=["doc_id", "ids"])


def encode(docs: DataFrame, tokens: list[bytes], pattern: str, then: Callable | None = None, schema: str = ENCODED) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text): ``tokens`` by rank, pre-tokens by ``pattern``.

    ``then`` turns the encoded documents of a slice, a table (doc_id, ids), into
    one of ``schema`` where they are made, for results smaller than the ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokens)  # as large as the vocabulary
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    coded = rows.mapInArrow(_coded(pattern, int(total // BUCKET_BYTES) + 1), CODED).repartition("slice")
    words = coded.mapInArrow(_words_only, CODED)
    ids = words.groupBy("bucket").applyInArrow(_encoded(shared), IDS)

    def documents(coded: pa.Table, ids: pa.Table) -> pa.Table:
        made = _reassembled(coded, ids)
        return then(made) if then else made

    return coded.groupBy("slice").cogroup(ids.groupBy("slice")).applyInArrow(documents, schema)


def _joined(ids: pa.Array, table: pa.Array) -> pa.Array:
    """The token of every id."""
    if len(ids) and (ids.null_count or pc.min(ids).as_py() < 0 or pc.max(ids).as_py() >= len(table)):
        raise ValueError("ids that are not in the vocabulary")
    return table.take(ids)


def _body(tokens: pa.Array, first: int, last: int) -> memoryview:
    """The bytes of the tokens from ``first`` to before ``last``."""
    at = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset :]
    return memoryview(tokens.buffers()[2] or b"")[at[first] : at[last]]


def digests(tokens: list[bytes]) -> Callable[[pa.Table], pa.Table]:
    """For ``encode``: number of ids, SHA-256 of the decimal ids joined by one space, and of the bytes that they decode to."""

    def run(made: pa.Table) -> pa.Table:
        table, names = pa.array(tokens, pa.large_binary()), [b"%d" % i for i in range(len(tokens))]
        column = made.column("ids").combine_chunks()
        ends, out = column.offsets.to_numpy(), []
        for first, last in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            said, decoded = hashlib.sha256(), hashlib.sha256()
            for at in range(first, last, CHUNK):
                ids = column.values.slice(at, min(CHUNK, last - at))
                decoded.update(_body(_joined(ids, table), 0, len(ids)))
                said.update((b" " if at > first else b"") + b" ".join(map(names.__getitem__, ids.to_numpy().tolist())))
            out.append((last - first, said.hexdigest(), decoded.hexdigest()))
        n, said, decoded = zip(*out, strict=True) if out else ((), (), ())
        return pa.Table.from_arrays(
            [made.column("doc_id"), pa.array(n, pa.int64()), pa.array(said, pa.string()), pa.array(decoded, pa.string())],
            names=[x.split()[0] for x in DIGESTS.split(", ")],
        )

    return run


def _decoded(tokens):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(tokens.value, pa.large_binary())
        for batch in batches:
            column = batch.column("ids")
            ends = column.offsets.to_numpy().astype(np.int64)
            row = 0
            while row < len(column):
                stop = max(row + 1, int(np.searchsorted(ends, ends[row] + DECODED, side="right")) - 1)
                got = _joined(column.values.slice(ends[row], ends[stop] - ends[row]), table)
                at = np.frombuffer(got.buffers()[1], np.int64)[: len(got) + 1][ends[row : stop + 1] - ends[row]]
                texts = pa.Array.from_buffers(pa.binary(), stop - row, [None, pa.py_buffer(at.astype(np.int32)), got.buffers()[2]])
                part = batch.slice(row, stop - row)
                texts = pc.if_else(part.column("ids").is_valid(), texts, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, "decoded"])
                row = stop

    return run


def decode(encoded: DataFrame, tokens: list[bytes]) -> DataFrame:
    """``encoded`` (any columns with ``ids``) with ``decoded``: the token bytes of the ids, joined."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)
    rows = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", decoded binary"
    return rows.mapInArrow(_decoded(shared), schema)
