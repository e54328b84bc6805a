import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import EDGES, SF001, docs

from sparkclust.llm import phrases as ph


def brute(rows, support, longest=5, top=2000):
    """{lang: [(phrase, a, l, r, n, score)]} of (lang, text) rows."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang or "und", text or ""
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f[lang].update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = {}
    for lang, counts in f.items():
        kept = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        inside = defaultdict(int)
        for p, a in kept.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        found = []
        for p, a in kept.items():
            if 100 * inside[p] >= 100 * a and p in inside and inside[p] > 0:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((" ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        out[lang] = sorted(found, key=lambda x: (-x[5], -x[1], x[0].encode()))[:top]
    return {k: v for k, v in out.items() if v}


def got(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.lang, r["rank"])):
        out[r.lang].append(tuple(r)[2:])
        assert r["rank"] == len(out[r.lang])
    return dict(out)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, 2) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n long, slice long")


def planted(seed, docs_n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "ÀB", "the", "The", "a-b", " "]
    fixed = ["Licensed under the terms", "new york city hall now", "aa aa aa aa aa aa aa", "x\ty  z"]
    rows = []
    for _ in range(docs_n):
        parts = [rng.choice([rng.choice(words), rng.choice(fixed)]) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice(["en", "de", None, "en"]), "".join(p + rng.choice([" ", " ", " ", ". ", "\n", "!!"]) for p in parts)))
    return rows


def small(monkeypatch, slice_bytes, bucket_bytes):
    make = ph._slices

    def slices(buckets):
        inner = make(buckets)

        def run(batches):
            from sparkclust.llm import phrases

            phrases.SLICE_BYTES = slice_bytes
            try:
                yield from inner(batches)
            finally:
                phrases.SLICE_BYTES = 24 << 20

        return run

    monkeypatch.setattr(ph, "_slices", slices)
    monkeypatch.setattr(ph, "BUCKET_BYTES", bucket_bytes)


@pytest.mark.parametrize(("seed", "support", "top"), [(1, 5, 2000), (2, 20, 7)])
def test_equals_brute_force_over_many_shards(spark, monkeypatch, seed, support, top):
    small(monkeypatch, 2_000, 4_000)
    rows = planted(seed)
    assert got(ph.collocations(table(spark, rows), support, top=top)) == brute(rows, support, top=top)


def test_equals_brute_force_on_the_table(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in df.select("lang", "text").collect()]
    assert got(ph.collocations(df, 20)) == brute(rows, 20)


def test_edges(spark):
    df = docs(spark, [(i, t, s) for i, t, s in EDGES])
    assert got(ph.collocations(df, 2)) == brute([("en", t) for _, t, _ in EDGES], 2)
    assert ph.collocations(docs(spark, []), 2).count() == 0
    assert ph.collocations(docs(spark, [(1, None, "s"), (2, "", "s"), (3, " .", "s")]), 1).count() == 0


def test_scores_past_64_bits_are_exact(spark):
    big = [("en", 1, "a", 6 * 10**11), ("en", 1, "b", 7 * 10**11), ("en", 2, "a b", 5 * 10**11), ("en", 1, "c", 3), ("en", 2, "a c", 3)]
    found = spark.createDataFrame(big, "lang string, length int, phrase string, a long")
    words = spark.createDataFrame([("en", 9_999_999_999_999)], "lang string, n long")
    rows = {r.phrase: r.score for r in ph.scored(found, words).collect()}
    assert rows == {
        "a b": 1000 * 5 * 10**11 * 9_999_999_999_999 // (6 * 10**11 * 7 * 10**11),
        "a c": 1000 * 3 * 9_999_999_999_999 // (6 * 10**11 * 3),
    }


def test_no_frequent_phrase_is_missed_at_the_lowered_support():
    rng = np.random.default_rng(0)
    for _ in range(50):
        words = rng.integers(1, 1000, 6)
        need = -(-20 * words // words.sum())
        keys, shard = rng.integers(0, 30, 400), rng.integers(0, 6, 400)
        _, distinct, chosen, total = ph._frequent(keys, shard, np.ones(400), need, 20)
        # local counts below every lowered support sum up to less than the support
        count = Counter(keys.tolist())
        least = sum(n - 1 for n in need)
        assert all(count[int(distinct[i])] == total[i] for i in chosen)
        assert {k for k, v in count.items() if v > least and v >= 20} <= {int(distinct[i]) for i in chosen}


def test_blocks_end_at_pieces(monkeypatch):
    monkeypatch.setattr(ph, "BLOCK", 5)
    text = b"one two\nthree four five\nsix"
    assert b"".join(ph.blocks(text)) == text
    assert all(b.startswith(b"\n") for b in list(ph.blocks(text))[1:])
