import random

from llm_cases import EDGES, SF01, docs

from sparkclust.llm import line_dedup as ld
from sparkclust.llm import queries


def brute(rows, min_words=ld.MIN_WORDS, short=0):
    """Set of (id, unit, start, end) to remove; rows in order of id, null last."""
    seen, gone = set(), []
    for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        at, n, before = 0, 0, ""
        for line in (t or "").split("\n"):
            if line:
                key = " ".join(line.lower().split())
                enough = len(key.split()) >= min_words
                key, before = ((before, key) if len(key) < short else key), key or before
                if enough:
                    if key in seen:
                        start = at + len(line) - len(line.lstrip())
                        gone.append((i, n, start, at + len(line.rstrip())))
                    seen.add(key)
                n += 1
            at += len(line) + 1
    return gone


def as_rows(df):
    return sorted((str(r.doc_id), r.unit, r.start, r.end) for r in df.collect())


def test_equals_brute_force_on_the_table(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = ld.repeats(df)
    assert as_rows(got) == sorted((str(i), *x) for i, *x in brute(rows))
    assert got.where("first_doc_id > doc_id or (first_doc_id = doc_id and first_unit >= unit)").count() == 0


def test_offsets_point_at_the_text(spark):
    text = "First line has five words\n  The SAME line twice  here \nthe same line  TWICE here\n😀 a b c d e"
    got = ld.repeats(docs(spark, [(1, text, "s"), (2, "x\n😀 A b c d e\n", "s")])).orderBy("doc_id").collect()
    assert [text[r.start : r.end] for r in got if r.doc_id == 1] == ["the same line  TWICE here"]
    assert [(r.start, r.end, r.first_doc_id, r.first_unit) for r in got if r.doc_id == 2] == [(2, 13, 1, 3)]


def test_edges(spark):
    rows = [(i, t) for i, t, _ in EDGES]
    assert as_rows(ld.repeats(docs(spark, EDGES))) == sorted((str(i), *x) for i, *x in brute(rows))
    assert ld.repeats(docs(spark, [])).count() == 0


def test_texts_are_rebuilt_with_the_removed_ranges(spark):
    line = "one two three four five"
    out = {r.doc_id: r for r in ld.deduplicate(docs(spark, [(1, f"{line}\nkeep me", "s"), (2, f"a\n  {line} \nb", "s"), (3, None, "s")])).collect()}
    assert out[1].text == f"{line}\nkeep me" and out[1].removed == []
    assert out[2].text == "a\n   \nb" and [tuple(x) for x in out[2].removed] == [(4, 27)]
    assert out[3].text is None


def test_paragraphs(spark):
    para = "one two three\nfour five six"
    got = ld.repeats(docs(spark, [(1, f"{para}\n\nrest of the first text here", "s"), (2, f"intro\n \n{para}\n\n\nend", "s")]), unit="paragraph").collect()
    assert [(r.doc_id, r.unit, r.first_doc_id) for r in got] == [(2, 1, 1)]


def test_hot_line(spark):
    rng = random.Random(1)
    rows = [(i, f"this very line is everywhere\nown {rng.random()} a b c d", "s") for i in range(500)]
    got = ld.repeats(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == list(range(1, 500)) and {r.first_doc_id for r in got} == {0}


def lines_with_context(df):
    return ld.repeats(df, min_words=1, short=ld.SHORT)


def test_short_and_unspaced_lines_go_with_the_line_before(spark):
    rows = [
        (1, "All rights reserved.\n \n版权所有不得转载", "s"),
        (2, "own\n all  RIGHTS reserved. \n \n版权所有不得转载\nend", "s"),
        (3, "Own\nend", "s"),
        (4, "版权所有不得转载\nEnd", "s"),
    ]
    got = as_rows(lines_with_context(docs(spark, rows)))
    assert got == sorted((str(i), *x) for i, *x in brute([r[:2] for r in rows], 1, ld.SHORT))
    # a short line goes where the line before it repeats too
    assert [r[:2] for r in got] == [("2", 3), ("3", 0), ("4", 1)]


def test_lines_equal_brute_force_without_a_floor(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert as_rows(lines_with_context(df)) == sorted((str(i), *x) for i, *x in brute(rows, 1, ld.SHORT))


def pieces(text):
    """(start, end, normalised) of the sentences of every line, character by character."""
    out, at = [], 0
    for i, c in enumerate(text):
        last = i + 1 == len(text)
        if last or c in "\n" or (c in "。！？" and text[i + 1] not in "。！？") or (c in ".!?" and text[i + 1].isspace()):
            body = text[at : i + 1]
            if body.strip():
                out.append((at + len(body) - len(body.lstrip()), at + len(body.rstrip()), " ".join(body.lower().split())))
            at = i + 1
    return out


def brute_passages(rows, span):
    """Rows (id, first piece, start, end) of the query; ``rows`` in order of id, null last."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        found, gone = pieces(t or ""), set()
        need = min(span, sum(len(p[2]) for p in found))
        for n in range(len(found)):
            first = max((f for f in range(n + 1) if sum(len(p[2]) for p in found[f : n + 1]) >= need), default=None)
            if first is not None:
                key = tuple(p[2] for p in found[first : n + 1])
                if key in seen:
                    gone |= set(range(first, n + 1))
                seen.add(key)
        for n in sorted(gone):
            if n - 1 not in gone:
                last = next(k for k in range(n, len(found)) if k + 1 not in gone)
                out.append((i, n, found[n][0], found[last][1]))
    return out


def test_query_finds_passages_across_changed_lines_and_leaves_lone_short_lines(spark, tmp_path):
    said = [f"Sentence number {n} of a passage that was copied from one text into another." for n in range(6)]
    own = [f"Here document {n} speaks for itself, in words which no other text in this table has: {n * n}." for n in range(8)]
    rows = [
        (1, f"{own[0]} {said[0]} {said[1]} {said[2]}\nAll rights reserved.\n{own[1]}", "s"),
        (2, f"{own[2]} {said[0]} {said[1]} {said[2]} {own[3]}", "s"),
        (3, f"{own[4]}\nAll rights reserved.\n{own[5]}", "s"),
        (4, "版权所有。" * 3 + "不得转载本页面的任何文字或者图片" * 10 + "\n短", "s"),
        (5, "前言。" + "版权所有。" * 3 + "不得转载本页面的任何文字或者图片" * 10 + "\n短", "s"),
        (6, "All rights reserved.", "s"),
        (7, "all  rights\treserved.", "s"),
    ]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op7_line_dedup(spark, str(tmp_path)).collect()
    by = {r.doc_id: r for r in got}
    assert sorted(by) == [2, 5, 7] and len(got) == 3
    assert rows[1][1][by[2].start : by[2].end] == " ".join(said[:3]) and (by[2].first_doc_id, by[2].first_unit) == (1, 1)
    assert sorted((str(r.doc_id), r.unit, r.start, r.end) for r in got) == sorted((str(i), *x) for i, *x in brute_passages([r[:2] for r in rows], ld.SPAN))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    assert as_rows(queries.op7_line_dedup(spark, SF01)) == sorted((str(i), *x) for i, *x in brute_passages(rows, ld.SPAN))


def test_passages_of_odd_rows(spark):
    rows = [(i, t) for i, t, _ in EDGES]
    assert as_rows(ld.repeated_passages(docs(spark, EDGES))) == sorted((str(i), *x) for i, *x in brute_passages(rows, ld.SPAN))
    assert ld.repeated_passages(docs(spark, [])).count() == 0
