import random
from collections import Counter

import numpy as np
from llm_cases import EDGES, SF001, docs

from sparkclust.llm import bag_minhash as bm


def bag(text):
    w = (text or "").replace("\x1c", "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    both, either = sum((a & b).values()), sum((a | b).values())
    return both / either if either else 0.0


def brute_classes(rows):
    """Connected components of similarity of 0.8 or more, as a partition of row numbers."""
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n, m = sum(bags[i].values()), sum(bags[j].values())
            if n and m and min(n, m) >= 0.8 * max(n, m) and similarity(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def check(spark, rows):
    roots = brute_classes(rows)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, (True, 0)), (i is None, i or 0))
    size = Counter(roots)
    want = sorted(((str(i), str(None if least[r][0] else least[r][1]), size[r]) for (i, _), r in zip(rows, roots)))
    got = bm.near_duplicates(docs(spark, [(i, t, "s") for i, t in rows])).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in got) == want
    return got


def test_equals_brute_force_on_the_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_equals_brute_force_on_planted_copies(spark):
    rng = random.Random(4)
    prose = lambda k: [f"w{rng.randint(0, 400)}" for _ in range(k)]
    rows = []
    for base in range(8):
        words = prose(rng.randint(60, 200))
        for _ in range(rng.randint(1, 12)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "edit%d" % rng.randint(0, 9)
            rows.append((len(rows) * 7 % 501, " ".join(copy)))
    rows += [(600 + i, " ".join(prose(50))) for i in range(30)]
    rows += [(700, "a b c"), (701, "a b c"), (702, "a b"), (703, "x " * 300), (704, "x " * 310), (705, "x " * 90)]
    check(spark, rows)


def test_edges(spark):
    rows = [(i, t) for i, t, _ in EDGES]
    got = bm.near_duplicates(docs(spark, EDGES)).collect()
    assert len(got) == len(rows)
    by = {r.row_key: r for r in got}
    assert by["1"].class_size == 3 and by["2"].class_size == 1 and by["3"].class_size == 1
    copy = next(r for r in got if r.doc_id is None and r.class_size == 3)
    assert copy.class_id == 1 and not copy.kept
    assert bm.near_duplicates(docs(spark, [])).count() == 0


def test_registers_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    values = rng.integers(1, 2**62, 300).astype(np.uint64)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    row = np.concatenate((np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)))
    sig = bm.signatures(row, np.concatenate((values[a > 0], values[b > 0])), np.concatenate((a[a > 0], b[b > 0])), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_one_point_process_serves_every_weight():
    value = np.array([12345], np.uint64)
    low, high = (bm.signatures(np.zeros(1, int), value, np.array([w]), 1, 64) for w in (3, 11))
    assert (high <= low).all() and 0.1 < (high == low).mean() < 0.5  # 3 / 11


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"\x80", bytes([129 + i])) for i in range(50)]
    df = spark.createDataFrame(edges, "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in bm.components(df).collect()}
    assert got == {bytes([i]): b"\x00" for i in range(41)} | {b"\x80": b"\x80"} | {bytes([129 + i]): b"\x80" for i in range(50)}


def crowded_bucket(n, n_pairs, seed=9):
    """n texts of which any two agree to 0.7 or less, and for the first n_pairs of them another one that agrees to 0.8 or a bit more."""
    rng = random.Random(seed)
    frame = [f"f{i}" for i in range(300)]
    rows = [(i, frame + [f"o{i}_{k}" for k in range(rng.randint(66, 72) if i < n_pairs else rng.randint(66, 160))]) for i in range(n)]
    rows += [(n + j, rows[j][1][: -rng.randint(34, 38)]) for j in range(n_pairs)]
    rows[n:] = [(i, w + [f"c{i}_{k}" for k in range(len(rows[i - n][1]) - len(w))]) for i, w in rows[n:]]
    return [(i, " ".join(w)) for i, w in rows]


def test_every_true_pair_of_a_crowded_bucket_is_found(spark):
    n, n_pairs = 900, 100
    rows = crowded_bucket(n, n_pairs)
    df = docs(spark, [(i, t, "s") for i, t in rows])
    text = [t.encode() for _, t in rows]
    data, offsets = np.frombuffer(b"".join(text), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in text])))
    registers = bm.signatures(*bm.bags(*bm.shingles(data, offsets)), len(rows), bm.BANDS * bm.ROWS)
    bands = [set(b) for b in bm.band_hashes(registers, bm.BANDS, bm.ROWS).tolist()]
    size = Counter(b for own in bands for b in own)
    shared = [bands[j] & bands[n + j] for j in range(n_pairs)]
    assert max(size.values()) > n / 4
    assert sum(bool(s) and min(size[b] for b in s) > 16 for s in shared) >= 3  # pairs that meet in crowded buckets only
    assert all(similarity(bag(rows[j][1]), bag(rows[n + j][1])) >= 0.8 for j in range(n_pairs))
    got = {r.doc_id: (r.class_id, r.class_size) for r in bm.near_duplicates(df).collect()}
    want = {i: (i, 1) for i, _ in rows} | {i: (j, 2) for j in range(n_pairs) if shared[j] for i in (j, n + j)}
    assert got == want
