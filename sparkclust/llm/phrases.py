"""Phrase collocations by SON partitioning.

Texts are cut into pieces and words; phrases are the runs of 1 to ``longest``
words within a piece.  A phrase that occurs ``support`` times among ``n`` words
occurs ``support * n_s / n`` times in at least one shard of ``n_s`` words.  So the
corpus is dealt into ``SHARDS`` shards, however large; each is mined completely
at that lowered support; the locally frequent phrases are united; and the union
is counted exactly over all shards.

This is done length by length, as only phrases whose first and last parts are
frequent can be.  A shard is not one task's work: slices of about ``SLICE_BYTES``
of text hold words as numbers, and each sends its distinct phrases of the
current length once, with their counts, to buckets by hash.  A bucket sees the
counts of its phrases in every slice of every shard: it mines the shards, unites
what is frequent in any, sums up the union over all, numbers what reaches
``support`` and answers every slice.  A slice then cuts its runs where no frequent
phrase stands.  Phrases are pairs (number of the phrase without its last word,
number of the word), so counts are of phrases, never of hashes.  Frequent words
and languages weigh no more than one entry per slice.  What a length leaves is
written to the shared folder.

Scores, the search for longer phrases and the ranks are joins and windows over
the frequent phrases only.  A null language is ``und``; null and empty texts have
no words; every row counts, repeated ones too.  Extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkclust.llm.byte_bpe import Numbers, squeezed, unsqueezed
from sparkclust.llm.common import release, stored, text_of
from sparkclust.llm.textarrays import mix

SHARDS = 10
#: Bytes of text of the slices that a task makes at once, and bytes of text per bucket.
SLICE_BYTES = 24 << 20
BUCKET_BYTES = 16 << 20
#: Bytes of a text that are split into words at once.
BLOCK = 1 << 20

#: What cuts pieces becomes a line feed, blanks become spaces, A-Z become lower case.
CUTS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
FOLDED = bytes.maketrans(CUTS + BLANKS + bytes(range(65, 91)), b"\n" * len(CUTS) + b" " * len(BLANKS) + bytes(range(97, 123)))

SLICES = "lang string, slice long, bucket int, shard int, n long, words long, body binary"
ITEMS = "lang string, slice long, bucket int, shard int, n long, body binary"
COUNTED = "lang string, slice long, n long, body binary, id long, prefix long, word long, text string, a long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[f for f, _ in fields])


def blocks(data: bytes) -> Iterator[bytes]:
    """The folded text in blocks that end where a piece ends."""
    start = 0
    while start < len(data):
        stop = data.find(b"\n", start + BLOCK)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop]
        start = stop


class Slice:
    """Texts of one language as numbers of words; 0 is the end of a piece."""

    def __init__(self) -> None:
        self.numbers = Numbers({b"\n": 0, b"": 1})
        self.codes = array("I")

    def add(self, text: bytes) -> None:
        for block in blocks(text.translate(FOLDED)):
            self.codes.extend(map(self.numbers.__getitem__, block.replace(b"\n", b" \n ").split(b" ")))
        self.codes.append(0)

    def rows(self, lang: str, key: int, shard: int, buckets: int) -> Iterator[tuple]:
        codes = np.frombuffer(self.codes, np.uint32)
        codes = codes[codes != 1]
        uses = np.bincount(codes, minlength=len(self.numbers))
        order = np.argsort(-uses[2:], kind="stable")
        rank = np.zeros(len(self.numbers), np.uint32)
        rank[2 + order] = np.arange(1, order.size + 1, dtype=np.uint32)
        line = pruned(rank[codes])
        yield lang, key, -1, shard, line.size, int(uses[2:].sum()), squeezed(line)
        words = list(self.numbers)[2:]
        place = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        by = np.argsort(place, kind="stable")
        for mine in np.split(by, np.flatnonzero(np.diff(place[by])) + 1) if by.size else []:
            these = [words[i] for i in mine.tolist()]
            head = squeezed(np.concatenate(([len(w) for w in these], rank[2 + mine], uses[2 + mine])))
            body = len(head).to_bytes(4, "little") + head + pa.compress(b"".join(these), "zstd", asbytes=True)
            yield lang, key, int(place[mine[0]]), shard, len(these), 0, body


def pruned(line: np.ndarray) -> np.ndarray:
    """One 0 where several stand, none at the ends."""
    keep = line != 0
    keep[1:] |= line[:-1] != 0
    line = line[keep]
    return line[:-1] if line.size and line[-1] == 0 else line


def _slices(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 32
        held: dict[str, Slice] = {}
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal key, size
            for lang in list(held):
                yield _batch(list(held.pop(lang).rows(lang, key, zlib.crc32(key.to_bytes(8, "little")) % SHARDS, buckets)), SLICES)
                key += 1
            size = 0
            release()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                held.setdefault(lang, Slice()).add(text)
                size += len(text)
                if size >= SLICE_BYTES:
                    yield from rows()
        yield from rows()

    return run


def _frequent(keys: np.ndarray, shard: np.ndarray, count: np.ndarray, need: np.ndarray, support: int):
    """(number of its phrase for every entry, frequent phrases, their counts): SON over the shards of one bucket."""
    distinct, which = np.unique(keys, return_inverse=True)
    united, total = np.zeros(distinct.size, bool), np.zeros(distinct.size, np.int64)
    for s, least in enumerate(need.tolist()):
        mine = shard == s
        # a mined shard: all counts of all its phrases
        local = np.bincount(which[mine], weights=count[mine], minlength=distinct.size).astype(np.int64)
        united |= local >= least
        total += local
    total[~united] = 0
    return which, distinct, np.flatnonzero(total >= support), total


def _needs(group: pa.Table) -> np.ndarray:
    """Lowered support by shard; shards that sent nothing have none."""
    shard, need = group.column("shard").to_numpy(), group.column("need").to_numpy()
    out = np.full(int(shard.max()) + 1, np.iinfo(np.int64).max)
    out[shard] = need
    return out


def _numbered(chosen: np.ndarray, buckets: int, bucket: int) -> np.ndarray:
    """Numbers from 1 that no other bucket gives."""
    out = np.arange(chosen.size, dtype=np.int64) * buckets + bucket + 1
    if out.size and out[-1] >= 1 << 32:
        raise OverflowError("more than 2**32 frequent phrases of one length")
    return out


def _count_words(support: int, buckets: int):
    def run(group: pa.Table) -> pa.Table:
        lang, bucket = group.column("lang")[0].as_py(), group.column("bucket")[0].as_py()
        numbers, parts, sizes = Numbers(), [], []
        for n, body in zip(group.column("n").to_pylist(), group.column("body").to_pylist(), strict=True):
            cut = 4 + int.from_bytes(body[:4], "little")
            head = unsqueezed(body[4:cut], 3 * n)
            ends = np.cumsum(head[:n], dtype=np.int64).tolist()
            text = pa.decompress(body[cut:], ends[-1], "zstd", asbytes=True)
            starts = [0, *ends[:-1]]
            word = np.fromiter((numbers[text[i:j]] for i, j in zip(starts, ends, strict=True)), np.int64, n)
            parts.append((word, head[n : 2 * n], head[2 * n :].astype(np.float64)))
            sizes.append(n)
        word, code, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        shard = np.repeat(group.column("shard").to_numpy().astype(np.int64), sizes)
        which, _, chosen, total = _frequent(word, shard, count, _needs(group), support)
        number = np.zeros(len(numbers), np.int64)
        number[chosen] = _numbered(chosen, buckets, bucket)
        texts = list(numbers)
        out = [(lang, None, None, None, int(number[i]), None, None, texts[i].decode(), int(total[i])) for i in chosen.tolist()]
        out += _answers(lang, group, sizes, code.astype(np.uint64), number[which])
        del numbers, parts, word, code, count, shard, which, total, number, texts
        release()
        return pa.Table.from_batches([_batch(out, COUNTED)])

    return run


def _count_phrases(support: int, buckets: int):
    def run(group: pa.Table) -> pa.Table:
        lang, bucket = group.column("lang")[0].as_py(), group.column("bucket")[0].as_py()
        parts, sizes = [], group.column("n").to_pylist()
        for n, body in zip(sizes, group.column("body").to_pylist(), strict=True):
            values = unsqueezed(body, 3 * n)
            prefix = np.cumsum(values[:n], dtype=np.uint64)
            parts.append((prefix << np.uint64(32) | values[n : 2 * n], values[2 * n :].astype(np.float64)))
        keys, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        shard = np.repeat(group.column("shard").to_numpy().astype(np.int64), sizes)
        which, distinct, chosen, total = _frequent(keys, shard, count, _needs(group), support)
        number = np.zeros(distinct.size, np.int64)
        number[chosen] = _numbered(chosen, buckets, bucket)
        out = [
            (lang, None, None, None, int(number[i]), int(distinct[i]) >> 32, int(distinct[i]) & 0xFFFFFFFF, None, int(total[i]))
            for i in chosen.tolist()
        ]
        out += _answers(lang, group, sizes, keys, number[which])
        del parts, keys, count, shard, which, distinct, total, number
        release()
        return pa.Table.from_batches([_batch(out, COUNTED)])

    return run


def _answers(lang: str, group: pa.Table, sizes: list[int], keys: np.ndarray, number: np.ndarray) -> list[tuple]:
    """For every slice, its keys that are frequent and their numbers."""
    out, start = [], 0
    for key, n in zip(group.column("slice").to_pylist(), sizes, strict=True):
        mine = np.flatnonzero(number[start : start + n]) + start
        start += n
        if mine.size:
            k = keys[mine]
            body = squeezed(np.concatenate((k >> np.uint64(32), k & np.uint64(0xFFFFFFFF), number[mine].astype(np.uint64))))
            out.append((lang, key, int(mine.size), body, None, None, None, None, None))
    return out


def phrases_at(line: np.ndarray, prefix: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the phrases of ``length`` words whose first and last ``length - 1`` words are frequent phrases."""
    if length == 1:
        at = np.flatnonzero(line)
        return at, line[at].astype(np.uint64)
    at = np.flatnonzero((prefix[:-1] != 0) & (prefix[1:] != 0))
    return at, prefix[at].astype(np.uint64) << np.uint64(32) | line[at + length - 1]


def unpacked(n: int, body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(words, phrase that starts at each) of a slice; at length 1 both are the words."""
    values = unsqueezed(body, 2 * n)
    return values[:n], values[n:]


def _items(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, key, shard, n, body in zip(*(batch.column(c).to_pylist() for c in ("lang", "slice", "shard", "n", "body")), strict=True):
                line, prefix = unpacked(n, body)
                keys, count = np.unique(phrases_at(line, prefix, length)[1], return_counts=True)
                place = (mix(keys) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(place, kind="stable")
                rows = []
                for mine in np.split(by, np.flatnonzero(np.diff(place[by])) + 1) if by.size else []:
                    k = keys[mine]
                    values = np.concatenate((np.diff(k >> np.uint64(32), prepend=np.uint64(0)), k & np.uint64(0xFFFFFFFF), count[mine].astype(np.uint64)))
                    rows.append((lang, key, int(place[mine[0]]), shard, k.size, squeezed(values)))
                yield _batch(rows, ITEMS)

    return run


def _advance(length: int):
    """Slices with the numbers of their frequent phrases of ``length`` words, cut where none stands."""

    def run(slices: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        found = [unsqueezed(body, 3 * n).astype(np.uint64).reshape(3, n) for n, body in zip(answers.column("n").to_pylist(), answers.column("body").to_pylist(), strict=True)]
        known, number = np.empty(0, np.uint64), np.empty(0, np.uint32)
        if found:
            high, low, number = np.concatenate(found, axis=1)
            known = high << np.uint64(32) | low
            by = np.argsort(known)
            known, number = known[by], number[by].astype(np.uint32)
        for lang, key, shard, n, body in zip(*(slices.column(c).to_pylist() for c in ("lang", "slice", "shard", "n", "body")), strict=True):
            line, prefix = (unsqueezed(body, n), None) if length == 1 else unpacked(n, body)
            if known.size == 0 or line.size < length:
                continue
            at, keys = phrases_at(line, prefix, length)
            place = np.minimum(np.searchsorted(known, keys), known.size - 1)
            now = np.zeros(line.size, np.uint32)
            now[at] = np.where(known[place] == keys, number[place], 0)
            if length == 1:
                line = now
            # a word stays if a frequent phrase covers it; one 0 stands where words went
            cover = np.cumsum(np.concatenate((now != 0, np.zeros(length, bool))).astype(np.int64))
            cover[length:] -= cover[:-length].copy()
            keep = cover[: line.size] > 0
            line = np.where(keep, line, 0)
            place = np.flatnonzero(keep | np.concatenate(([False], keep[:-1])))
            out.append((lang, key, -1, shard, place.size, 0, squeezed(np.concatenate((line[place], now[place])))))
        return pa.Table.from_batches([_batch(out, SLICES)])

    return run


def frequent(docs: DataFrame, support: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """((lang, length, phrase, a) of the phrases of 1 to ``longest`` words that occur ``support`` times, (lang, n) words)."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(total // BUCKET_BYTES) + 1
    slices = stored(rows.mapInArrow(_slices(buckets), SLICES), "slices")
    lines = slices.where("bucket < 0")
    shards = lines.groupBy("lang", "shard").agg(F.sum("words").alias("words"))
    sums = stored(shards.withColumn("n", F.sum("words").over(Window.partitionBy("lang"))), "shards")
    need = sums.where("n > 0").select("lang", "shard", F.expr(f"({support}L * words + n - 1L) div n").alias("need"))
    texts: list[DataFrame] = []
    for length in range(1, longest + 1):
        items = slices.where("bucket >= 0").drop("words") if length == 1 else lines.mapInArrow(_items(length, buckets), ITEMS)
        count = _count_words if length == 1 else _count_phrases
        counted = stored(items.join(need, ["lang", "shard"]).groupBy("lang", "bucket").applyInArrow(count(support, buckets), COUNTED), f"counted-{length}")
        table = counted.where("slice IS NULL")
        if length == 1:
            texts.append(table.select("lang", "id", F.col("text").alias("phrase"), "a"))
        else:
            first = texts[-1].select("lang", F.col("id").alias("prefix"), F.col("phrase").alias("head"))
            last = texts[0].select("lang", F.col("id").alias("word"), F.col("phrase").alias("tail"))
            whole = table.select("lang", "id", "prefix", "word", "a").join(first, ["lang", "prefix"]).join(last, ["lang", "word"])
            texts.append(stored(whole.select("lang", "id", F.concat_ws(" ", "head", "tail").alias("phrase"), "a"), f"phrases-{length}"))
        if length < longest:
            answers = counted.where("slice IS NOT NULL").select("slice", "n", "body")
            lines = stored(lines.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_advance(length), SLICES), f"lines-{length}")
    found = None
    for length, t in enumerate(texts, start=1):
        t = t.select("lang", F.lit(length).alias("length"), "phrase", "a")
        found = t if found is None else found.unionByName(t)
    return found, sums.groupBy("lang").agg(F.max("n").alias("n"))


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases of two words and more with their lowest-scoring cut: lang, length, phrase, a, l, r, n, score."""
    parts = F.split("phrase", " ")
    cuts = found.where("length > 1").withColumn("parts", parts).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    halves = cuts.select(
        "lang", "length", "phrase", "a", "k",
        F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("right"),
    )
    of = found.select("lang", "phrase", "a")
    both = halves.join(of.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"]).join(
        of.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"]
    )
    # 128-bit whole numbers: a * n * 1000 div (l * r) never passes through a fraction
    exact = "CAST(1000 AS DECIMAL(6,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(16,0)) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
    graded = both.join(words, "lang").withColumn("score", F.expr(exact))
    return graded.groupBy("lang", "length", "phrase", "a", "n").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")).select(
        "lang", "length", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def maximal(found: DataFrame, share: int = 100) -> DataFrame:
    """(lang, phrase) of the phrases of two words and more that no longer one contains with ``share`` percent of their count.

    Counts fall with length, so only the parts that lack one end word are looked
    at for 100 percent; for less all parts are.
    """
    parts = F.split("phrase", " ")
    long = found.where("length > 2").select("lang", "length", "a", parts.alias("parts"))
    least = F.col("length") - 1 if share >= 100 else F.lit(2)
    sizes = long.withColumn("m", F.explode(F.sequence(least, F.col("length") - 1)))
    inner = sizes.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("m") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("parts", F.col("i"), F.col("m")), " ").alias("phrase"), "a")
    most = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = found.where("length > 1").join(most, ["lang", "phrase"], "left")
    return kept.where(f"most IS NULL OR 100L * most < {share}L * a").select("lang", "phrase")


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of every language by score, count and text: lang, rank, phrase, a, l, r, n, score."""
    found, words = frequent(docs, support, longest)
    best = scored(found, words).join(maximal(found), ["lang", "phrase"], "left_semi")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
