import hashlib
import itertools
import random
import re
import zlib

from llm_cases import SF01

from sparkclust.llm import chat_repair as cr
from sparkclust.llm.queries import op12_chat_repair

GOOD = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, kind int, digest string, code string"


def brute_edits(rows):
    """(cost, audit, repaired lines) by trying every edit of every row and up to two inserts anywhere."""
    best = None
    options = []
    for role, text, gone, cut in rows:
        one = [("D", 2, None)]
        if not gone:
            one += [("K", 5 * cut, (role, text))] + [("R", 1 + 5 * cut, (r, text)) for r in ("user", "assistant")]
        options.append(one)
    for edits in itertools.product(*options):
        cost = sum(e[1] for e in edits)
        for n in range(3):
            if best is not None and cost + 5 * n > best[0]:
                continue
            for places in itertools.combinations_with_replacement(range(len(edits) + 1), n):
                for roles in itertools.product(("user", "assistant"), repeat=n):
                    audit, lines = "", []
                    for i in range(len(edits) + 1):
                        for p, r in zip(places, roles):
                            if p == i:
                                audit, lines = audit + "I", lines + [(r, "")]
                        if i < len(edits):
                            audit += edits[i][0]
                            lines += [edits[i][2]] if edits[i][2] else []
                    if GOOD.match("".join(r[:1] or "?" for r, _ in lines)):
                        found = (cost + 5 * n, audit, "\n".join(f"{r}:{t}" for r, t in lines))
                        best = found if best is None or found[:2] < best[:2] else best
    return best


def plain(rows, edits=brute_edits):
    """Result columns of one conversation's rows (turn, role, text), in the stated order."""
    blank = duplicate = truncated = 0
    seen, marked = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        gone = cut = False
        if not bare:
            blank, gone = blank + 1, True
        elif (role, text) in seen:
            duplicate, gone = duplicate + 1, True
        elif bare[-1] not in ".!?":
            truncated, cut = truncated + 1, True
        seen.add((role, text))
        marked.append((role, text, gone, cut))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit, lines = edits(marked)
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()


def hurt(rows):
    """{conv_id: rows after damage} of (conv_id, turn, role, text)."""
    out = {}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        mine = out.setdefault(c, [])
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        mine += [(t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}:{t}".encode()).digest()
    return {c: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1], x[2]))) for c, v in out.items()}


def random_rows(seed, n, size, turns=None):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "Why? ", "Go!", "é。", "Yes."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", ""]
    return [
        (c, rng.choice([None, rng.randint(-2, 6)]) if turns is None else t, rng.choice(roles), rng.choice(texts))
        for c in range(n) for t in range(rng.randint(0, size))
    ]


def test_audits_equal_brute_force(spark):
    rows = random_rows(1, 120, 5) + [(None, 1, "user", "a."), (None, None, None, None), (7, 2, "user", None)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    left, dropped = cr.damaged(df)
    got = {r[0]: tuple(r)[1:] for r in cr.audits(left, dropped).collect()}
    assert got == {c: plain(v) for c, v in hurt(rows).items()}


def dp(rows):
    """The same by a plain table of whole strings."""
    best = {0: (0, "", "")}

    def least(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value

    def insert():
        for s in (0, 1, 3, 2):
            if s in best:
                c, a, lines = best[s]
                least(best, cr.WRITES[s][0], (c + 5, a + "I", lines + f"\n{cr.WRITES[s][1]}:"))

    insert()
    for role, text, gone, cut in rows:
        after = {}
        for s, (c, a, lines) in best.items():
            least(after, s, (c + 2, a + "D", lines))
            if not gone:
                kept = cr.KEEPS[s].get({"s": 0, "u": 1, "a": 2}.get(role[:1], 3))
                if kept is not None:
                    least(after, kept, (c + 5 * cut, a + "K", lines + f"\n{role}:{text}"))
                least(after, cr.WRITES[s][0], (c + 1 + 5 * cut, a + "R", lines + f"\n{cr.WRITES[s][1]}:{text}"))
        best = after
        insert()
    cost, audit, lines = min(best[s] for s in (0, 3) if s in best)
    return cost, audit, lines[1:]


def test_long_conversations_settle_as_they_stream(spark, monkeypatch):
    rows = random_rows(2, 3, 700, turns=True)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    want = {c: plain(v, dp) for c, v in hurt(rows).items()}
    for hold in (3, 40, 4096):
        conversations = {}
        monkeypatch.setattr(cr, "HOLD", hold)
        stream = cr._stream(False)  # here, so that HOLD holds
        left, dropped = cr.damaged(df)
        batches = cr._sorted_rows(left, dropped).coalesce(1).sortWithinPartitions("conv_id", "turn", "digest", "kind").toArrow().to_batches(97)
        for b in stream(iter(batches)):
            conversations |= {r["conv_id"]: tuple(r.values())[1:] for r in b.to_pylist()}
        assert conversations == want


def test_ties_between_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(cr, "BASE", 0)  # every string hashes to its last letter
    rng = random.Random(3)
    for _ in range(200):
        rows = [("system user assistant tool".split()[rng.randint(0, 3)], "x", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 12))]
        audit = cr.Audit()
        for role, _, gone, cut in rows:
            audit.push({"s": 0, "u": 1, "a": 2}.get(role[0], 3) | (cr.GONE if gone else cr.CUT if cut else 0))
        cost, letters = audit.end()
        want = dp([(r, t, g, c and not g) for r, t, g, c in rows])
        assert (cost, letters) == want[:2]


def test_repaired_turns_spell_the_audit(spark):
    rows = random_rows(5, 30, 6, turns=True)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    audits = {r.conv_id: r for r in cr.audits(df).collect()}
    turns = {}
    for r in sorted(cr.repaired(df).collect(), key=lambda r: (r.conv_id, r.position)):
        turns.setdefault(r.conv_id, []).append(r)
    for c, a in audits.items():
        mine = turns.get(c, [])
        assert [r.position for r in mine] == list(range(len(mine)))
        assert "".join(r.edit for r in mine) == a.audit.replace("D", "")
        assert GOOD.match("".join(r.role[0] for r in mine))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest() == a.repaired_sha256


def test_query_on_the_table_and_empty_tables(spark):
    table = spark.read.parquet(f"{SF01}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in op12_chat_repair(spark, SF01).collect()}
    want = hurt([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert got == {c: plain(v, dp) for c, v in want.items()}
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.audits(*cr.damaged(empty)).count() == 0 and cr.repaired(empty).count() == 0
