import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from llm_cases import EDGES, SF001, docs

from sparkclust.llm import suffix_dedup as sd


def brute(rows, span=sd.SPAN):
    """{(id, text): (bytes, removed, spans, digest)}: every string of ``span`` bytes that starts earlier."""
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is None, x[0] or 0)):
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - span + 1):
            w = b[p : p + span]
            if w in seen:
                gone[p : p + span] = b"\1" * span
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i, t] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows):
    got = sd.repeated_bytes(docs(spark, [(i, t, "s") for i, t in rows])).drop("spans").collect()
    want = brute(rows)
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted((str(i), *want[i, t or ""]) for i, t in rows)


def planted(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(2, 8)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(rng.randint(10, 60)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice([prose(rng.randint(1, 80)), rng.choice(passages), "ab" * rng.randint(1, 150), "x" * rng.randint(1, 250)]) for _ in range(rng.randint(1, 6))]
        text = "".join(parts)
        if rows and rng.random() < 0.3:  # an edited copy
            old = rng.choice(rows)[1]
            at = rng.randint(0, len(old))
            text = old[:at] + rng.choice("xyz") + old[at + 1 :]
        rows.append((i * 3, text))
    rng.shuffle(rows)
    return rows


def test_equals_brute_force_on_planted_repeats(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_BYTES", 4_000)  # several buckets
    for seed in (1, 2):
        check(spark, planted(seed))


def test_equals_brute_force_on_the_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_edges(spark):
    rows = [(i, t) for i, t, _ in EDGES] + [(7, "y" * 99), (8, "y" * 99), (9, "z" * 100), (10, "z" * 100), (11, "z" * 101)]
    check(spark, rows)
    assert sd.repeated_bytes(docs(spark, [])).count() == 0


def test_chunks_of_one_group_agree_with_the_whole(monkeypatch, spark):
    monkeypatch.setattr(sd, "CHUNK_BYTES", 500)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 2_000)
    check(spark, planted(5))


def test_mergesort_orders_suffixes():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    text = sd.Suffixes(data, 20)
    at = rng.integers(0, 370, 200)
    group = np.sort(rng.integers(0, 5, 200))
    order = text.sort(at, group)
    want = sorted(range(200), key=lambda k: (group[k], bytes(data[at[k] : at[k] + 20]), k))
    assert order.tolist() == want


def test_runs_and_short_patterns_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_BYTES", 1_000)
    rows = [(i, p * k + tail) for i, (p, k, tail) in enumerate(
        [("-", 450, ""), ("-", 99, "x"), ("ab", 80, "c" * 120), ("abc", 60, "-" * 130), ("abcde", 50, ""), ("-", 101, "y"), ("é", 90, "z"), ("ba", 70, "-" * 100)]
    )]
    check(spark, rows + [(50, "q" + rows[2][1][1:]), (51, "-" * 100 + rows[4][1])])


def test_spans_are_the_removed_ranges(spark):
    body = "".join(chr(97 + i * i % 23) for i in range(150))
    rows = sd.repeated_bytes(docs(spark, [(1, body, "s"), (2, "__" + body + "!!", "s")])).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].spans == [] or by[1].n_removed == sum(s.end - s.start for s in by[1].spans)
    assert [tuple(s) for s in by[2].spans] == [(2, 152)]


def passage_rows(n, seed=5):
    """A passage of 60 bytes between neighbours that differ in every text, two of them alike."""
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))
    passage = noise(60)
    rows = [(i, noise(80) + passage + noise(80)) for i in range(n)]
    return rows + [(n, noise(30) + rows[1][1][40:190] + noise(30))]


def test_strings_of_frequent_anchors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_BYTES", 4_000)
    monkeypatch.setattr(sd, "HOT", 3)
    check(spark, planted(3))
    check(spark, passage_rows(80))


def test_no_group_holds_all_neighbours_of_a_frequent_passage():
    rows = passage_rows(300)
    text = pa.array([t for _, t in rows])
    columns = {"bucket": pa.array([0] * len(rows)), "doc_id": pa.array([i for i, _ in rows]), "h": pa.array(range(len(rows))), "text": text}
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for _, t in rows])))
    keys, count = np.unique(sd.segments(data, offsets)[4], return_counts=True)
    assert count.max() > 50
    anchors = next(iter(sd._anchors([pa.RecordBatch.from_pydict(columns)])))
    assert max(anchors.column("n").to_pylist()) == count.max() - 1  # the copied segment counts once
    hot = pa.table({"key": keys, "split": count > 50})
    out = sd._bucket_segments(pa.table(columns), hot)
    sent = out.filter(pa.compute.greater_equal(out.column("start"), 0)).column("key").to_numpy()
    assert np.unique(sent, return_counts=True)[1].max() <= 50  # anchors that are not split


def _peak(call):
    """MB that ``call`` holds at once, in arrays and objects."""
    import tracemalloc

    sd.prefix_hashes(np.zeros(sd.BUCKET_BYTES + 200, np.uint8))  # the tables of powers are kept
    tracemalloc.start()
    out = call()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, peak


def _bucket(texts):
    columns = {"bucket": [0] * len(texts), "doc_id": list(range(len(texts))), "h": list(range(len(texts))), "text": texts}
    return pa.table(columns)


def test_a_bucket_of_one_character_is_worked_on_as_views():
    docs_ = _bucket(["-" * sd.BUCKET_BYTES])
    hot = pa.table({"key": pa.array([], pa.int64()), "split": pa.array([], pa.bool_())})
    out, peak = _peak(lambda: sd._bucket_segments(docs_, hot))
    assert peak < 500
    assert out.num_rows == 1
    marks = np.frombuffer(out.column("body")[0].as_py(), np.int64).reshape(-1, 2)
    assert marks[:, 0].min() == 1 and marks[:, 1].max() == sd.BUCKET_BYTES


def test_a_bucket_of_strings_with_split_anchors_is_worked_on_as_views():
    rng = np.random.default_rng(0)
    texts = ["".join(map(chr, rng.integers(97, 123, 1500))) for _ in range(sd.BUCKET_BYTES // 1500)]
    docs_ = _bucket(texts)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.arange(0, data.size + 1, 1500)
    keys = np.unique(sd.segments(data, offsets)[4])
    hot = pa.table({"key": keys, "split": np.ones(keys.size, bool)})
    out, peak = _peak(lambda: sd._bucket_segments(docs_, hot))
    assert peak < 700 and out.nbytes < 60 * data.size  # a string is a row with a digest
    assert out.num_rows == len(texts) * (1500 - sd.SPAN + 1)
