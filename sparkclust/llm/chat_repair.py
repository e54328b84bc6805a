"""Conversation structure repair with the cheapest audit of edits.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles: an
optional system turn, then user and assistant in turn, or nothing.  Every row
is kept (cost 0), rerolled to user or assistant (1) or deleted (2); empty user
or assistant turns may be inserted anywhere (5).  Blank rows and repeats of an
earlier role and text must be deleted; a truncated row that stays costs 5 more.
The audit is the string of the edits' initials (K, R, D, I); of the cheapest
audits the one that is least in ASCII wins.

Persistent audit DP: for each of the four states (nothing yet, after s, u, a)
the best audit is a node that links to the audit it extends, so prefixes are
shared.  Nodes know their ancestors 1, 2, 4, ... steps up and a rolling hash of
their string; ties are decided by the letter after the longest common prefix,
which a binary search over the ancestors finds; equal hashes are verified by
walking both links until they meet.  What all four audits have in common is
final: it is written out and its nodes go, so a conversation of any length
streams through with what is still open.

The first of equal rows is found by an aggregate of 16-byte digests per
conversation, whose rows then meet the turns in one sorted exchange by
conversation: no set of seen texts is held.  The texts of one conversation pass
through one task in order, since a digest of its repaired lines needs that.

Rows are taken by turn, nulls first; rows of one turn by their digest.  A null
role or text is one space; null ids are one conversation.  Repeated rows are
duplicates.  An empty role has no initial and fits nowhere.  Extra columns are
ignored, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclust.llm.common import BLANKS

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows that a conversation holds back before its audit is settled as far as possible.
HOLD = 4096
#: Codes of a row: its initial (s, u, a, other), and what is wrong with it.
S, U, A, OTHER = range(4)
GONE, CUT = 4, 8
#: States: nothing yet, after s, after u, after a.  What a kept initial leads to, and what any other edit writes.
KEEPS = ({S: 1, U: 2}, {U: 2}, {A: 3}, {U: 2})
WRITES = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
BASE, PRIME = 0x1F3D5B79A, (1 << 61) - 1

AUDITS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
TURNS = "conv_id long, position long, edit string, role string, text string"


class Links:
    """Strings as linked nodes that share their prefixes; node 0 is the empty string."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(letter)) % PRIME)
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(up)
        return node

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor at ``depth``."""
        while self.depth[node] > depth:
            k = (self.depth[node] - depth).bit_length() - 1
            node = self.up[node][k]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth spell one string, letter by letter up to where they meet."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lifted(a, depth), self.lifted(b, depth)
        if self.hash[x] == self.hash[y] and self.same(x, y):
            return self.depth[a] < self.depth[b]
        # to the nodes just below the longest common prefix
        for k in range(max(len(self.up[x]), 1) - 1, -1, -1):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if self.letter[x] != self.letter[y] and self.same(self.up[x][0], self.up[y][0]):
            return self.letter[x] < self.letter[y]
        return self.text(a, 0) < self.text(b, 0)  # unequal strings with one hash

    def text(self, node: int, top: int) -> str:
        """The letters from below the ancestor ``top`` to ``node``."""
        out = []
        while node != top:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def meet(self, nodes: list[int]) -> int:
        """The deepest common ancestor."""
        depth = min(self.depth[n] for n in nodes)
        nodes = [self.lifted(n, depth) for n in nodes]
        if len(set(nodes)) == 1:
            return nodes[0]
        for k in range(depth.bit_length() - 1, -1, -1):
            above = [self.up[n][k] if k < len(self.up[n]) else 0 for n in nodes]
            if len(set(above)) > 1:
                nodes = above
        return self.up[nodes[0]][0]


class Audit:
    """Best audits of a conversation so far, by state."""

    def __init__(self) -> None:
        self.links = Links()
        self.best: dict[int, tuple[int, int]] = {0: (0, 0)}
        self._insert()

    def _offer(self, to: dict, state: int, cost: int, parent: int, letter: str) -> None:
        held = to.get(state)
        if held is None or cost < held[0]:
            to[state] = (cost, self.links.add(parent, letter))
        elif cost == held[0]:
            node = self.links.add(parent, letter)
            if self.links.less(node, held[1]):
                to[state] = (cost, node)

    def _insert(self) -> None:
        for state in (0, 1, 3, 2):
            if state in self.best:
                cost, node = self.best[state]
                self._offer(self.best, WRITES[state][0], cost + INSERT, node, "I")

    def push(self, code: int) -> None:
        """The next row."""
        after: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in self.best.items():
            self._offer(after, state, cost + DELETE, node, "D")
            if not code & GONE:
                stays = cost + (TRUNCATED if code & CUT else 0)
                kept = KEEPS[state].get(code & 3)
                if kept is not None:
                    self._offer(after, kept, stays, node, "K")
                self._offer(after, WRITES[state][0], stays + REROLE, node, "R")
        self.best = after
        self._insert()

    def settle(self) -> str:
        """The letters that all audits share; they are dropped here and the links rebuilt."""
        old, top = self.links, self.links.meet([node for _, node in self.best.values()])
        out, self.links, moved = old.text(top, 0), Links(), {top: 0}
        for state, (cost, node) in self.best.items():
            path = []
            while node not in moved:
                path.append(node)
                node = old.up[node][0]
            at = moved[node]
            for n in reversed(path):
                at = moved[n] = self.links.add(at, old.letter[n])
            self.best[state] = (cost, at)
        return out

    def end(self) -> tuple[int, str]:
        """Cost of the cheapest audit and its letters that are not settled yet."""
        ends = [self.best[s] for s in (0, 3) if s in self.best]
        cost, node = ends[0]
        for c, n in ends[1:]:
            if c < cost or (c == cost and self.links.less(n, node)):
                cost, node = c, n
        return cost, self.links.text(node, 0)


@lru_cache(maxsize=1 << 16)
def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation; short ones repeat, so the results are kept."""
    audit = Audit()
    for code in codes:
        audit.push(code)
    return audit.end()


class Conversation:
    """One conversation that streams through: counts, audit and repaired turns."""

    def __init__(self, conv_id: int | None, turns: bool):
        self.conv_id, self.turns = conv_id, turns
        self.rows: list[tuple[str, str, int]] = []
        self.audit: Audit | None = None
        self.letters: list[str] = []
        self.digest, self.lines, self.state = hashlib.sha256(), 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.last = self.fresh = None

    def row(self, turn, digest, first: bool, role: str | None, text: str | None, code: int) -> Iterator[tuple]:
        """Takes an entry that announces a first occurrence, or a row."""
        if first:
            self.fresh = (turn, digest)
            return
        if self.last is not None and (self.last, code & 3) not in ((S, U), (U, A), (A, U)):
            self.illegal += 1
        self.last = code & 3
        if turn is not None:
            if self.low is None:
                self.low = turn
            if self.high is None or turn != self.high:
                self.high, self.distinct = turn, self.distinct + 1
        if code & GONE:
            self.blank += 1
        elif self.fresh != (turn, digest):
            self.duplicate += 1
            code |= GONE
        else:
            self.fresh = None
            self.truncated += code >> 3
        self.rows.append((role, text, code))
        if len(self.rows) >= HOLD * (1 if self.audit is None else 2):
            self.audit = self.audit or Audit()
            yield from self._written(self._push())

    def _push(self) -> str:
        """All rows held go through the audit; those whose letters settle can be written."""
        for _, _, code in self.rows[getattr(self, "pushed", 0) :]:
            self.audit.push(code)
        self.pushed = len(self.rows)
        return self.audit.settle()

    def _written(self, letters: str) -> Iterator[tuple]:
        """The repaired turns of the next letters."""
        self.letters.append(letters)
        at = 0
        for edit in letters:
            if edit == "I":
                self.state, role = WRITES[self.state]
                text = ""
            else:
                role, text, code = self.rows[at]
                at += 1
                if edit == "D":
                    continue
                if edit == "K":
                    self.state = KEEPS[self.state][code & 3]
                else:
                    self.state, role = WRITES[self.state]
            if self.turns:
                yield self.conv_id, self.lines, edit, role, text
            else:
                self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
            self.lines += 1
        del self.rows[:at]
        self.pushed = getattr(self, "pushed", 0) - at

    def end(self) -> Iterator[tuple]:
        if self.audit is None:
            cost, letters = cheapest(bytes(code for _, _, code in self.rows))
        else:
            settled = self._push()
            yield from self._written(settled)
            cost, letters = self.audit.end()
        yield from self._written(letters)
        if not self.turns:
            gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
            yield (
                self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.letters),
                self.digest.hexdigest(),
            )


def _stream(turns: bool):
    schema = pa.schema(
        [(c.split()[0], {"long": pa.int64(), "string": pa.string()}[c.split()[1]]) for c in (TURNS if turns else AUDITS).split(", ")]
    )

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "digest", "kind", "role", "text", "code")]
            for conv_id, turn, digest, kind, role, text, code in zip(*columns, strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out += now.end()
                    now = Conversation(conv_id, turns)
                if kind >= 0:
                    out += now.row(turn, digest, kind == 0, role, text, code)
            if out:
                yield table(out)
                out = []
        if now is not None:
            out += now.end()
        if out:
            yield table(out)

    return run


def _sorted_rows(rows: DataFrame, also: DataFrame | None) -> DataFrame:
    """Turns with their codes, an entry before each first occurrence, and a marker for every id of ``also``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    base = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    initial = F.substring("role", 1, 1)
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    blank = bare == ""
    code = (
        F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
        + F.when(blank, GONE).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0)
    )
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    told = base.select("conv_id", "turn", digest.alias("digest"), F.lit(1).alias("kind"), "role", "text", code.alias("code"))
    # of equal rows the least turn, nulls first: fixed-width values, so partial sums meet before the exchange
    firsts = told.where((F.col("code").bitwiseAND(GONE)) == 0).groupBy("conv_id", "digest").agg(
        F.bool_or(F.col("turn").isNull()).alias("none"), F.min("turn").alias("turn")
    )
    nothing = [F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("code")]
    all_rows = told.unionByName(
        firsts.select("conv_id", F.when(~F.col("none"), F.col("turn")).alias("turn"), "digest", F.lit(0).alias("kind"), *nothing)
    )
    if also is not None:
        all_rows = all_rows.unionByName(
            also.select(
                F.col("conv_id").cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"),
                F.lit(b"").alias("digest"), F.lit(-1).alias("kind"), *nothing,
            )
        )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "digest", "kind"]
    return all_rows.repartition("conv_id").sortWithinPartitions(*order)


def audits(rows: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): its faults, the cheapest audit and the digest of the repaired lines.

    Ids of ``also`` get a row even if they have no turns: zeros, an empty audit
    and the digest of nothing.
    """
    return _sorted_rows(rows, also).mapInArrow(_stream(False), AUDITS)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, position from 0, the edit that made the turn (K, R, I), role, text."""
    return _sorted_rows(rows, None).mapInArrow(_stream(True), TURNS)


def damaged(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows after damage, dropped rows) by the CRC-32 of ``conv_id:turn`` modulo 20, nulls written as one space."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    hurt = F.pmod(F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", said[2].alias("role"), said[3].alias("text"), hurt.alias("hurt"))
    text = F.when(F.col("hurt") == 1, "").when(F.col("hurt") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("hurt") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("hurt") == 3, 2).otherwise(1)))
    left = rows.where("hurt <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")
    return left, rows.where("hurt = 0").select("conv_id")
