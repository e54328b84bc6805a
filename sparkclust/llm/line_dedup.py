"""Line or paragraph deduplication across documents.

Every unit (line, or paragraph between blank lines) is normalised (lower case,
blanks to one space, trimmed) and digested; digests are grouped over the whole
corpus; the earliest unit in the order (doc_id, row, position) stays, all
others go, with their code-point offsets in the original text.  Units of fewer
than ``min_words`` words are not units and stay: ``MIN_WORDS`` unless given; the
registered query gives 1, so that every line that is not blank is a unit.  The
digest of a unit of fewer than ``short`` code points (normalised; 0 unless given,
``SHORT`` in the query) takes in the unit before it, so a short line goes only
where both repeat: by itself it says little about what it was copied from.

Digests are summed up before the shuffle, so a unit that occurs everywhere
costs each task one row; the join back is split by the optimiser where one
digest holds much of the rows.  Texts are not shuffled until they are rebuilt.

Null and empty texts have no unit.  Null ids come last.  Repeated rows are
copies: the first keeps its units.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkclust.llm.common import stored, text_of

MIN_WORDS = 5
SHORT = 40
LINE = re.compile(r"[^\n]+")
PARAGRAPH = re.compile(r"[^\n]+(?:\n(?![ \t\r\f\v]*(?:\n|$))[^\n]+)*")
#: Code points of the windows that repeated passages are made of.
SPAN = 150
#: Where a piece ends: after a sentence or a line.
PIECE_END = re.compile(r"[.!?]+(?=\s)|[。！？]+|\n")
WINDOWS = "row long, doc_id long, unit int, from int, start int, end int, digest binary"
UNITS = "row long, doc_id long, unit int, start int, end int, digest binary"


def units_of(
    text: str, pattern: re.Pattern = LINE, min_words: int = MIN_WORDS, short: int = 0
) -> Iterator[tuple[int, int, int, bytes]]:
    """(unit number, start, end, digest) of the units with enough words; offsets without outer blanks."""
    before = ""
    for n, m in enumerate(pattern.finditer(text)):
        body = m.group()
        words = body.lower().split()
        whole = " ".join(words)
        key, before = (f"{before}\n{whole}" if len(whole) < short else whole), whole or before
        if len(words) >= min_words:
            start = m.start() + len(body) - len(body.lstrip())
            digest = hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            yield n, start, m.end() - len(body) + len(body.rstrip()), digest


def pieces_of(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised text) of the sentences of every line; offsets without outer blanks."""
    at = 0
    for end in [*(m.end() for m in PIECE_END.finditer(text)), len(text)]:
        body = text[at:end]
        whole = " ".join(body.lower().split())
        if whole:
            yield at + len(body) - len(body.lstrip()), end - len(body) + len(body.rstrip()), whole
        at = end


def windows_of(text: str, span: int = SPAN) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(last piece, first piece, start, end, digest) of every window: the fewest pieces up to one that make ``span`` code points."""
    pieces = list(pieces_of(text))
    span = min(span, sum(len(whole) for _, _, whole in pieces))
    first = size = 0
    for n, (_, end, whole) in enumerate(pieces):
        size += len(whole)
        while size - len(pieces[first][2]) >= span:
            size -= len(pieces[first][2])
            first += 1
        if size >= span:
            key = "\n".join(whole for _, _, whole in pieces[first : n + 1])
            yield n, first, pieces[first][0], end, hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _split(units, schema: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "_text")), strict=True):
                r, d = row.as_py(), doc_id.as_py()
                out += [(r, d, *u) for u in units(text.as_py())]
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=names)

    return run


def repeats(
    docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, row_col: str | None = None, short: int = 0
) -> DataFrame:
    """One row per unit to remove: row, doc_id, unit, start, end, digest, first_doc_id, first_unit.

    ``row`` is ``row_col``, or else numbers the rows of ``docs`` within this
    result, so that repeated rows stay apart.
    """
    pattern = {"line": LINE, "paragraph": PARAGRAPH}[unit]
    gone = _repeated(docs, lambda text: units_of(text, pattern, min_words, short), UNITS, row_col)
    return gone.select(
        "row", "doc_id", "unit", "start", "end", F.lower(F.hex("digest")).alias("digest"),
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.unit").alias("first_unit"),
    )


def _repeated(docs: DataFrame, units, schema: str, row_col: str | None) -> DataFrame:
    """The units whose digest occurs earlier, and ``first``: where it occurs first."""
    rows = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text")
    )
    units = stored(rows.mapInArrow(_split(units, schema), schema), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "unit", *[c for c in units.columns if c == "from"])
    firsts = units.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return units.join(firsts, "digest").where(
        ~((F.col("row") == F.col("first.row")) & (F.col("unit") == F.col("first.unit")))
    )


def repeated_passages(docs: DataFrame, span: int = SPAN, row_col: str | None = None) -> DataFrame:
    """One row per passage to remove, of windows that occur earlier: columns as of ``repeats``.

    ``unit`` and ``first_unit`` are the numbers of the first pieces of the passage
    and of the first occurrence of its first window, whose digest is ``digest``.
    """
    gone = _repeated(docs, lambda text: windows_of(text, span), WINDOWS, row_col)
    before = Window.partitionBy("row").orderBy("unit")
    parts = gone.withColumn("_new", F.coalesce(F.col("from") > F.lag("unit").over(before) + 1, F.lit(True)).cast("int"))
    parts = parts.withColumn("_passage", F.sum("_new").over(before))
    return parts.groupBy("row", "doc_id", "_passage").agg(
        F.min("from").alias("unit"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.lower(F.hex(F.min_by("digest", "unit"))).alias("digest"),
        F.min_by("first.doc_id", "unit").alias("first_doc_id"), F.min_by("first.from", "unit").alias("first_unit"),
    ).drop("_passage")


def deduplicate(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, short: int = 0) -> DataFrame:
    """``docs`` with ``text`` without its repeated units, and ``removed``: their (start, end) in the original.

    The blanks around a removed unit stay.  A text without repeats, or null,
    comes back unchanged with an empty ``removed``.
    """
    numbered = stored(docs.drop("removed", "_row").withColumn("_row", F.monotonically_increasing_id()), "numbered")
    gone = repeats(numbered, unit, min_words, row_col="_row", short=short)
    spans = gone.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))
    out = numbered.join(spans.withColumnRenamed("row", "_row"), "_row", "left").drop("_row")
    out = out.withColumn("removed", F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>")))
    text = F.col("text")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    kept = F.aggregate(
        "removed",
        begin,
        lambda acc, x: F.struct(
            x["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"])).alias("out")
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return out.withColumn("text", F.when(F.size("removed") == 0, text).otherwise(kept))
