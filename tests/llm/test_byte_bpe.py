import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from llm_cases import EDGES, SF001, docs

from sparkclust.llm import byte_bpe as bb
from sparkclust.llm.queries import op13_byte_bpe

TOKENS = bb.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
RANKS = {t: i for i, t in enumerate(TOKENS)}
PLAIN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = [
    "it's  we'll x y \u0085z\x1cq\x1fr\n\n \t tab", "<|endoftext|> 12345 ½ Ⅷ १२३ 漢字かな交じり文 عربي ไทย", "áë 👩‍👩‍👧 \U0001f1e9\U0001f1ea",
    "   ", "\n", " x ", "don'T 'S 's's", "=" * 3000, "ab" * 2000, "z" * 1500, "​﻿\x00\x7f",
]


def encoded(spark, rows):
    df = docs(spark, [(i, t, "s") for i, t in rows])
    return bb.encode(df, TOKENS, public_tokenizers.PATTERN)


def check(spark, rows):
    got = bb.decode(encoded(spark, rows), TOKENS).collect()
    want = sorted((str(i), tuple(PLAIN.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), tuple(r.ids), bytes(r.decoded)) for r in got) == want


def with_slices(size, make=bb._coded):
    def coded(pattern, buckets):
        inner = make(pattern, buckets)

        def run(batches):
            from sparkclust.llm import byte_bpe

            byte_bpe.SLICE_BYTES = size
            try:
                yield from inner(batches)
            finally:
                byte_bpe.SLICE_BYTES = 16 << 20

        return run

    return coded


def test_words_merge_as_the_library_merges_them():
    rng = random.Random(4)
    words = [bytes(rng.choice(b"abcdehlnorst ") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    words += [bytes(rng.randrange(256) for _ in range(rng.randint(1, 30))) for _ in range(500)] + [b"ab" * 3000, b"a" * 5000, b"the" * 700]
    for word in words:
        assert bb.merge(word, RANKS) == PLAIN._encode_single_piece(word)


def test_edges_and_odd_texts(spark):
    check(spark, [(i, t) for i, t, _ in EDGES] + list(enumerate(ODD)) + [(99, " ".join(ODD) * 40)])
    assert encoded(spark, []).count() == 0


def test_many_slices_buckets_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(bb, "BUCKET_BYTES", 5_000)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "a", "naïve", "x1", "\n\n", "zebra" * rng.randint(1, 3)]) for _ in range(rng.randint(0, 300)))) for i in range(200)]
    # tasks import the module anew, so small slices are set in the function that they get
    monkeypatch.setattr(bb, "_coded", with_slices(3_000))
    check(spark, rows)


def test_query_on_the_table(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for i, t in rows:
        ids = PLAIN.encode_ordinary(t or "")
        want[i] = (len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))
    got = {r[0]: tuple(r)[1:] for r in op13_byte_bpe(spark, SF001).collect()}
    assert got == want


def test_decode_of_other_ids(spark):
    df = spark.createDataFrame([(1, [0, 50255], "x"), (2, None, "y"), (3, [], "z")], "doc_id long, ids array<int>, decoded string")
    got = {r.doc_id: r.decoded for r in bb.decode(df, TOKENS).collect()}
    assert got == {1: bytearray(TOKENS[0] + TOKENS[50255]), 2: None, 3: bytearray()}
    bad = spark.createDataFrame([(1, [50256])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bb.decode(bad, TOKENS).collect()


def test_the_words_and_the_documents_share_one_pass(spark):
    df = bb.encode(spark.read.parquet(f"{SF001}/documents.parquet"), TOKENS, public_tokenizers.PATTERN)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or plan.count("Scan parquet") == 1
