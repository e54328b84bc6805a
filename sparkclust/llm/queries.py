"""Queries and SQL of the operators of this subpackage, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclust.llm import (
    bag_minhash,
    byte_bpe,
    chat_repair,
    cube_mixing,
    decontaminate,
    html_extract,
    line_dedup,
    phrases,
    quality_rules,
    secret_scan,
    suffix_dedup,
    toxicity,
    warc,
)
from sparkclust.llm.common import table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: fixed patterns and what the randomness battery adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.learn_null(docs))

    def count(kind: int):
        return F.size(F.filter("_base", lambda x: x["k"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.written(F.col("_base")), 256).alias("base_sha256"),
        secret_scan.written(F.array_sort(F.concat("_base", "_random"))).alias("spans"),
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents with the targets of their sources."""
    mixed = cube_mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back through the index."""
    index = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated byte strings of all documents."""
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents")).drop("spans")


def op5_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_size", "n_links", "kept"
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of every document and the verdict of the learned decision list."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated passage of the documents, of lines and their sentences, with its place and the one that stays."""
    return line_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("row")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn(pages))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of the documents within the edit budget of a benchmark item."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of every language, of phrases that occur 100 times or more."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the stated damage."""
    rows, dropped = chat_repair.damaged(table(spark, sf_dir, "conversations"))
    return chat_repair.audits(rows, dropped)


def op13_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Byte-level BPE ids of every document by the ranks of a file, and the bytes that they decode to, as digests."""
    tokens = byte_bpe.read_ranks(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.encode(table(spark, sf_dir, "documents"), tokens, pattern, byte_bpe.digests(tokens), byte_bpe.DIGESTS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_source_mixing": op2_source_mixing,
    "op3_warc_archive": op3_warc_archive,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_bag_minhash": op5_bag_minhash,
    "op6_quality_rules": op6_quality_rules,
    "op7_line_dedup": op7_line_dedup,
    "op8_html_extract": op8_html_extract,
    "op9_decontaminate": op9_decontaminate,
    "op10_toxicity": op10_toxicity,
    "op11_phrases": op11_phrases,
    "op12_chat_repair": op12_chat_repair,
    "op13_byte_bpe": op13_byte_bpe,
}

#: Where SQL gives the same rows (the others learn, draw, align, merge or search for the least audit).
ORACLES: dict[str, str] = {
    "op11_phrases": r"""
        WITH folded AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), pieces AS (
            SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM folded
        ), worded AS (
            SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[ \t]+') IF x <> ''] AS w FROM pieces
        ), sums AS (
            SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM worded GROUP BY lang
        ), grams AS (
            SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
                  FROM worded, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)
        ), f AS (
            SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
        ), split AS (
            SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1
        ), inside AS (
            SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS most
            FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM split))
            GROUP BY ALL
        ), cuts AS (
            SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS lp, array_to_string(w[k + 1 : m], ' ') AS rp
            FROM (SELECT *, unnest(range(1, m)) AS k FROM split)
        ), graded AS (
            SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, n,
                   (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp
                 JOIN sums s ON s.lang = c.lang
        ), lowest AS (
            SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM graded
        ), ranked AS (
            SELECT g.*, row_number() OVER (PARTITION BY g.lang ORDER BY score DESC, a DESC, g.phrase) AS rank
            FROM lowest g LEFT JOIN inside i ON i.lang = g.lang AND i.phrase = g.phrase
            WHERE place = 1 AND (most IS NULL OR 100 * most < 100 * a)
        )
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
               CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked WHERE rank <= 2000
    """,
    "op3_warc_archive": """
        WITH p AS (
            SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url
        FROM f
    """,
}
