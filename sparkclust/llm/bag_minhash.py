"""MinHash near-duplicates: BagMinHash signatures of weighted word shingles, bands, verification, classes.

A document is the multiset of its runs of five words (fewer words: the whole
text is one shingle; no word: no shingle, and a class of its own).  Weights are
the counts.  For every shingle a Poisson process runs over its discretised
weight: the cells (0,1], (1,2], (2,4], (4,8], ... form a hierarchy, each cell
group has a process whose rate is its width, a point falls into one unit cell
of it and counts where that cell is within the weight.  Points arrive in order
of time; each belongs to one register, which keeps its earliest time.  Two
multisets agree in a register with probability equal to their weighted Jaccard
similarity.  Processes stop when their time passes the latest register.

Documents with equal multisets form one node.  Nodes that agree in a band of
registers are candidates.  In a bucket each node is paired with the bucket's
most central node, and for ``ROUNDS`` rounds ``LEADERS`` more nodes, drawn anew,
are paired with the nodes of other components.  That joins most of a large class
with few pairs and leaves nothing out: then every candidate pair whose nodes are
still in different components is decided.  In buckets of up to ``SMALL`` nodes
all such pairs are verified, in larger ones those that a size, prefix and
position filter on the rarest shingles cannot rule out (what it rules out is
below the threshold).  Pairs are verified by the exact overlap of their multisets
(32-bit shingle hashes).  Classes are the connected components of all candidate
pairs that reach the threshold, found by alternating star contractions on tables
in the shared folder.

Null and empty texts never link.  Repeated rows are copies.  A null id is
replaced by a digest of the text as row key.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkclust.llm.common import stored, text_of
from sparkclust.llm.textarrays import M64, mix, prefix_hashes, slices, span_hashes, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 4
GOLDEN = 0x9E3779B97F4A7C15

SLICE_BYTES = 2 << 20
#: Rounds before all remaining pairs are decided, and the nodes of a bucket that are compared with the others in each.
ROUNDS = 2
LEADERS = 3
#: Buckets of up to so many nodes pair them directly.
SMALL = 16
#: Added to counts before they are compared with fractions, so that rounding rules no pair out.
SLACK = 1e-6

SIGNED = "doc_id long, row_key string, node binary, n_shingles long, bands array<long>"
BAGS = "row_key string, node binary, bag binary"


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of every shingle; rows ascend."""
    row, start, end = words(data, offsets)
    if row.size == 0:
        return row, np.empty(0, np.uint64)
    prefix = prefix_hashes(data)
    word = mix(span_hashes(prefix, start, end) ^ (end - start).astype(np.uint64) * np.uint64(GOLDEN))
    n_rows = offsets.size - 1
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(count)))
    # rolling polynomial over the word hashes, then cut where a run would leave its row
    out = np.zeros(word.size, np.uint64)
    index = np.arange(word.size)
    left = first[row + 1] - index  # words from here to the end of the row
    for k in range(width):
        inside = left > k
        at = index[inside] + k
        out[inside] = mix(out[inside] * np.uint64(31) + word[at] + np.uint64(k + 1))
    whole = (left >= width) | ((index == first[row]) & (left < width))
    return row[whole], out[whole]


def bags(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, weight): distinct shingles of each row with their counts, sorted."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(row.size, bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return row[at], value[at], np.diff(np.append(at, row.size))


def signatures(row: np.ndarray, value: np.ndarray, weight: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """n_rows x m registers (times of the earliest points); rows without shingles stay infinite."""
    registers = np.full(n_rows * m, np.inf)
    # one process per shingle and level: level 0 is the cell (0,1], level j the cells (2**(j-1), 2**j]
    level, rows, seeds, cells, limits = 0, [], [], [], []
    alive = np.arange(row.size)
    while alive.size:
        width = 1 if level == 0 else 1 << (level - 1)
        rows.append(row[alive])
        seeds.append(mix(value[alive] + np.uint64((level + 1) * GOLDEN & M64)))
        cells.append(np.full(alive.size, width, np.int64))
        limits.append(weight[alive] - (0 if level == 0 else width))
        alive = alive[weight[alive] > (1 << level)]
        level += 1
    if not rows:
        return registers.reshape(n_rows, m)
    rows, seeds = np.concatenate(rows), np.concatenate(seeds)
    cells, limits = np.concatenate(cells), np.concatenate(limits)
    time, step = np.zeros(rows.size), 0
    while rows.size:
        step += 1
        draw = mix(seeds + np.uint64(step * GOLDEN & M64))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / cells
        place = mix(draw ^ np.uint64(0xD6E8FEB86659FD93))
        valid = ((place >> np.uint64(32)) % cells.astype(np.uint64)).astype(np.int64) < limits
        slot = rows * m + (place & np.uint64(0xFFFFFFFF)).astype(np.int64) % m
        np.minimum.at(registers, slot[valid], time[valid])
        latest = registers.reshape(n_rows, m).max(axis=1)
        keep = time < latest[rows]
        if not keep.all():
            rows, seeds, cells, limits, time = rows[keep], seeds[keep], cells[keep], limits[keep], time[keep]
    return registers.reshape(n_rows, m)


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """n x bands hashes of groups of ``rows`` registers."""
    bits = mix(registers.view(np.uint64).reshape(-1, bands, rows))
    out = np.zeros(bits.shape[:2], np.uint64)
    for k in range(rows):
        out = mix(out * np.uint64(31) + bits[:, :, k] + np.uint64(k + 1))
    return mix(out + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(GOLDEN)).view(np.int64)


def node_keys(row: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> list[bytes | None]:
    """128-bit digest of every row's multiset; None for rows without shingles."""
    key = np.zeros((n, 2), np.uint64)
    first = np.searchsorted(row, np.arange(n + 1))
    full = first[1:] > first[:-1]
    if row.size:
        w = weight.astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for k, salt in enumerate((0xA24BAED4963EE407, 0x9FB21C651E98DF25)):
            key[full, k] = mix(np.add.reduceat(mix(value ^ np.uint64(salt)) * w, first[:-1][full]))
    return [key[i].tobytes() if full[i] else None for i in range(n)]


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in slices(batch, "_text", SLICE_BYTES):
                n = offsets.size - 1
                srow, svalue = shingles(data, offsets)
                row, value, weight = bags(srow, svalue)
                hashes = band_hashes(signatures(row, value, weight, n, bands * rows), bands, rows)
                total = np.bincount(srow, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, n),
                        batch.column("row_key").slice(at, n),
                        pa.array(node_keys(row, value, weight, n), pa.binary()),
                        pa.array(total.astype(np.int64)),
                        pa.array([hashes[i] if total[i] else None for i in range(n)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "row_key", "node", "n_shingles", "bands"],
                )

    return run


def _bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted 32-bit shingle hashes, repeats included, of every row that has shingles."""
    for batch in batches:
        for at, data, offsets in slices(batch, "_text", SLICE_BYTES):
            n = offsets.size - 1
            srow, svalue = shingles(data, offsets)
            nodes = node_keys(*bags(srow, svalue), n)
            small = (svalue >> np.uint64(32)).astype(np.uint32)
            small, cut = small[np.lexsort((small, srow))], np.concatenate(([0], np.cumsum(np.bincount(srow, minlength=n))))
            some = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key").slice(at, n).take(pa.array(some)),
                    pa.array([nodes[i] for i in some], pa.binary()),
                    pa.array([small[cut[i] : cut[i + 1]].tobytes() for i in some], pa.binary()),
                ],
                names=["row_key", "node", "bag"],
            )


def _ranked(v: np.ndarray) -> np.ndarray:
    """The k-th of equal values matches the k-th: sorted values with their rank among equals."""
    start = np.searchsorted(v, v, side="left")
    return v.astype(np.uint64) << np.uint64(32) | (np.arange(v.size) - start).astype(np.uint64)


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two sorted arrays of 32-bit shingle hashes."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    if min(x.size, y.size) < THRESHOLD * max(x.size, y.size) - 1:
        return min(x.size, y.size) / max(x.size, y.size)  # an upper bound below the threshold
    common = np.intersect1d(_ranked(x), _ranked(y), assume_unique=True).size
    return common / (x.size + y.size - common)


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("bag_a"), batch.column("bag_b")
            sim = [overlap(x.as_py(), y.as_py()) for x, y in zip(left, right, strict=True)]
            keep = pa.array([s >= threshold for s in sim], pa.bool_())
            out = pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(sim, pa.float64())], names=["a", "b", "similarity"]
            )
            yield out.filter(keep)

    return run


def verified(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose multisets overlap by ``threshold``.

    Sizes alone rule a pair out before any multiset is moved.
    """
    sizes = nodes.select("node", "n_shingles")
    near = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    near = near.where(F.least("na", "nb") >= threshold * F.greatest("na", "nb")).select("a", "b")
    bag = nodes.select("node", "bag")
    both = near.join(bag.toDF("b", "bag_b"), "b").join(bag.toDF("a", "bag_a"), "a").select("a", "b", "bag_a", "bag_b")
    return both.mapInArrow(_verify(threshold), "a binary, b binary, similarity double")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of a node's multiset; the k-th of equal shingles is an element of its own."""
    for batch in batches:
        for i, bag in enumerate(batch.column("bag")):
            elements = _ranked(np.frombuffer(bag.as_py(), np.uint32)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(np.full(elements.size, i))), pa.array(elements)], names=["node", "element"]
            )


def filtered_pairs(open_: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the pairs of ``open_`` (node, root) with different roots that sizes and shared elements do not rule out.

    Elements are ordered by the number of nodes that have them, the rarest
    first.  If ``rest`` elements of a node stand at and after the first one that
    it shares with another node, their overlap is at most ``rest``, and that of
    the other node.  A true pair meets at its first shared element.
    """
    bags_ = open_.join(nodes, "node")
    elements = stored(bags_.select("node", "bag").mapInArrow(_elements, "node binary, element long"), "elements")
    common = elements.groupBy("element").agg(F.count(F.lit(1)).alias("n_nodes")).where("n_nodes > 1")
    # elements of one node only come first in the order and are never shared: rest counts from the end
    from_end = Window.partitionBy("node").orderBy(F.desc("n_nodes"), F.desc("element"))
    ranked = elements.join(common, "element").withColumn("rest", F.row_number().over(from_end))
    ranked = ranked.join(bags_.select("node", "root", "n_shingles"), "node")
    prefix = stored(ranked.where(F.col("rest") + SLACK >= threshold * F.col("n_shingles")).drop("n_nodes"), "prefixes")
    # an element within one component makes no pair
    across = prefix.groupBy("element").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    prefix = prefix.join(across.select("element"), "element", "left_semi")
    x = prefix.select("element", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n_shingles").alias("na"), F.col("rest").alias("xa"))
    y = prefix.select("element", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n_shingles").alias("nb"), F.col("rest").alias("xb"))
    possible = (
        (x["element"] == y["element"]) & (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))
        & (F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
        & ((F.least("xa", "xb") + SLACK) * (1 + threshold) >= threshold * (F.col("na") + F.col("nb")))
    )
    return x.join(y, possible).select("a", "b").distinct()


def undecided(members: DataFrame, roots: DataFrame, nodes: DataFrame, tried: DataFrame, threshold: float) -> DataFrame:
    """(a, b): all pairs that share a bucket, have not been tried, are in different components and may reach the threshold."""
    here = members.select("bucket", "size", "node").join(roots, "node", "left")
    here = here.select("bucket", "size", "node", F.coalesce("root", "node").alias("root"))
    apart = here.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    here = stored(here.join(apart.select("bucket"), "bucket", "left_semi"), "apart")
    few = here.where(F.col("size") <= SMALL)
    x = few.select("bucket", F.col("node").alias("a"), F.col("root").alias("ra"))
    y = few.select("bucket", F.col("node").alias("b"), F.col("root").alias("rb"))
    direct = x.join(y, (x["bucket"] == y["bucket"]) & (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))).select("a", "b")
    many = here.where(F.col("size") > SMALL)
    pairs = filtered_pairs(many.select("node", "root").distinct(), nodes, threshold)
    shared = many.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
    pairs = pairs.join(shared.toDF("a", "buckets_a"), "a").join(shared.toDF("b", "buckets_b"), "b")
    pairs = pairs.where(F.arrays_overlap("buckets_a", "buckets_b")).select("a", "b")
    return direct.union(pairs).distinct().join(tried, ["a", "b"], "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component, for nodes that have an edge.

    Alternating large and small stars; every round is a table in the shared
    folder.  A node's neighbours meet only in an aggregate (its least one) and
    a join that may be split.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    while True:
        # large star: of each node, the larger neighbours go to its least one
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # small star: of each node, the smaller neighbours and itself go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u != v").distinct()
        new = stored(small, "edges")
        # done when every node has one edge, to a node that has none of its own
        many = new.groupBy("u").count().where("count > 1")
        chained = new.select(F.col("v").alias("u")).join(new.select("u"), "u", "left_semi")
        same = not many.take(1) and not chained.take(1)
        edges = new
        if same:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id as text, or for a null id a digest of the text."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.sha2(text_of(text_col), 256)))


def links(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, key: Column | None = None):
    """(signed rows, nodes that share a bucket, verified links between nodes, their components)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (row_key() if key is None else key).alias("row_key"), text_of().alias("_text"))
    signed = stored(texts.mapInArrow(_sign(bands, rows), SIGNED), "signatures")
    # copies have equal multisets and bands: one row per node, that of the least row key
    signs = F.min(F.struct("row_key", "n_shingles", "bands")).alias("s")
    nodes = signed.where("node is not null").groupBy("node").agg(signs).select("node", "s.*")
    banded = stored(nodes.select("node", "row_key", "n_shingles", F.explode("bands").alias("bucket")), "banded")
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = banded.join(sizes, "bucket")
    # a node in large buckets is alike to many: it leads
    central = members.groupBy("node").agg(F.sum("size").alias("score"))
    members = stored(members.join(central, "node"), "buckets")
    leads = members.groupBy("bucket").agg(F.max_by("node", F.struct("score", "node")).alias("leader"))
    # multisets are made again for the nodes that share a bucket, and for no others
    needed = members.select("node", "row_key", "n_shingles").distinct()
    made = texts.select("row_key", "_text").mapInArrow(_bag, BAGS)
    nodes = stored(needed.join(made, ["node", "row_key"]).dropDuplicates(["node"]).select("node", "n_shingles", "bag"), "bags")
    stars = members.join(leads, "bucket").where("node != leader")
    stars = stored(stars.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct(), "pairs")
    found = stored(verified(stars, nodes, threshold), "links")
    tried = stars
    roots = components(found)
    for turn in range(1, ROUNDS + 1):
        here = members.select("bucket", "node").join(roots, "node", "left")
        here = here.select("bucket", "node", F.coalesce("root", "node").alias("root"))
        # buckets whose nodes are still apart: a few new leaders against the nodes of other components
        apart = here.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
        here = here.join(apart.select("bucket"), "bucket", "left_semi")
        draw = F.xxhash64("node", F.lit(turn))
        drawn = here.groupBy("bucket", F.pmod(draw, F.lit(LEADERS)).alias("slot")).agg(
            F.min_by(F.struct(F.col("node").alias("leader"), F.col("root").alias("lead_root")), draw).alias("l")
        )
        again = here.join(drawn.select("bucket", "l.*"), "bucket").where("root != lead_root")
        again = again.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
        again = stored(again.join(tried, ["a", "b"], "left_anti"), "pairs")
        more = stored(verified(again, nodes, threshold), "links")
        tried = tried.union(again)
        if not more.take(1):
            break
        found = found.union(more)
        roots = components(found)
    last = stored(undecided(members, roots, nodes, tried, threshold), "pairs")
    more = stored(verified(last, nodes, threshold), "links")
    if more.take(1):
        found = found.union(more)
        roots = components(found)
    return signed, nodes, found, roots


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, key: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key, class_id, class_key, class_size, n_links, kept.

    ``class_id`` is the least id of the class; ``n_links`` counts the verified
    links of the document's text to different texts that were found; ``kept``
    marks the class's representative (all rows of its row key).  ``key`` tells
    documents apart, :func:`row_key` unless given; give one that takes in the text
    where different texts may share an id.
    """
    signed, _, found, roots = links(docs, threshold, bands, rows, key)
    degree = found.select(F.col("a").alias("node")).union(found.select(F.col("b").alias("node"))).groupBy("node").count()
    rows_ = signed.select("doc_id", "row_key", "node").join(roots, "node", "left").join(
        degree.withColumnRenamed("count", "n_links"), "node", "left"
    )
    own = F.concat(F.lit("row:"), F.col("row_key"))
    rows_ = rows_.withColumn("_class", F.coalesce(F.hex("root"), F.hex("node"), own))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_key"))
    per = rows_.groupBy("_class").agg(first.alias("f"), F.count(F.lit(1)).alias("class_size"))
    return rows_.join(per, "_class").select(
        "doc_id", "row_key", F.col("f.doc_id").alias("class_id"), F.col("f.row_key").alias("class_key"), "class_size",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), (F.col("row_key") == F.col("f.row_key")).alias("kept"),
    )
