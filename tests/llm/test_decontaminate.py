import random

import numpy as np
from llm_cases import EDGES, SF01, docs

from sparkclust.llm import decontaminate as dc

ITEMS = "item_id long, text string, doc_id long, start int"


def items(spark, rows):
    return spark.createDataFrame([(i, t, 9, 9) for i, t in rows], ITEMS)


def distance(item, text):
    """Least edit distance of the item to any substring."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def fold(t):
    return dc.FOLD[np.frombuffer((t or "").encode(), np.uint8)].tobytes()


def edited(rng, t, k):
    for _ in range(k):
        at = rng.randrange(len(t))
        t = rng.choice([t[:at] + t[at + 1 :], t[:at] + rng.choice("abcxyz ") + t[at:], t[:at] + rng.choice("abcxyz") + t[at + 1 :]])
    return t


def test_equals_edit_distance_on_planted_items(spark):
    rng = random.Random(6)
    prose = lambda k: " ".join("".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(k))
    bench = [(i, prose(rng.randint(8, 30))) for i in range(8)] + [(50, "short one"), (51, "ab")]
    rows = []
    for i in range(70):
        text = prose(rng.randint(1, 25))
        if i % 2:
            item = rng.choice(bench[:8])[1]
            text = text[:30] + " " + edited(rng, item, rng.randint(0, len(item) // 12)) + " " + text[30:]
        rows.append((i, text, "s"))
    rows += [(100, "has a Short\tONE inside", "s"), (101, bench[0][1].upper(), "s"), (102, bench[1][1] * 2, "s")]
    got = dc.find(docs(spark, rows), items(spark, bench)).collect()
    best = {}
    for r in got:
        best[r.doc_id, r.item_id] = min(best.get((r.doc_id, r.item_id), 999), r.distance)
    index = dc.Index(bench)
    want = {}
    for i, t, _ in rows:
        for k, item in enumerate(index.items):
            d = distance(item.tobytes(), fold(t))
            if d <= index.edits[k]:
                want[i, index.ids[k]] = d
    assert best == want and len(want) > 15
    assert sum(r.doc_id == 102 and r.item_id == 1 for r in got) == 2


def test_verbatim_items_of_the_table(spark):
    d, b = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    text, bench = d.select("doc_id", "text").collect(), b.collect()
    want = {(r.doc_id, x.item_id) for r in text for x in bench if x.text in r.text}
    got = dc.find(d, b).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want
    by = {r.doc_id: r.text for r in text}
    held = {x.item_id: x.text for x in bench}
    assert all(by[r.doc_id][r.start : r.end] == held[r.item_id] for r in got if r.distance == 0)
    left = {r.doc_id for r in dc.clean(d, b).select("doc_id").collect()}
    assert left == set(by) - {i for i, _ in want}


def test_edges(spark):
    bench = items(spark, [(1, None), (2, ""), (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (3, " \t "), (4, "word29999"), (4, "word29999")])
    got = dc.find(docs(spark, EDGES), bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == [("1", "None"), ("1", "None"), ("5", "4"), ("5", "4"), ("None", "None")]
    assert dc.find(docs(spark, []), bench).count() == 0
    assert dc.find(docs(spark, EDGES), items(spark, [])).count() == 0
    assert dc.clean(docs(spark, EDGES), items(spark, [])).count() == len(EDGES)
    assert sorted(str(r.doc_id) for r in dc.clean(docs(spark, EDGES), bench).collect()) == ["2", "3", "4", "6", "None"]


def test_blocks_hold_every_item(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 200)
    bench = [(i, f"item number {i} of the benchmark with its own text {i * i}") for i in range(20)]
    rows = [(i, f"before {t} after", "s") for i, t in bench]
    got = dc.find(docs(spark, rows), items(spark, bench)).where("distance = 0").collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(i, i) for i, _ in bench}
