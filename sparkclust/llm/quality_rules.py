"""Quality rules: a learned decision list over text statistics, applied as one SQL expression.

Sequential covering: a rule is a conjunction of threshold tests on statistics.
It is grown on two thirds of the labelled rows by FOIL gain, pruned on the
other third, and kept while it is more often right than wrong there; the rows
that it covers leave, and the next rule is learned.  The result is an ordered
list that becomes a CASE expression: the first rule that holds rejects the
document, a document that no rule covers is kept.

Statistics, binning and counting are DataFrame expressions; the driver sees
only one count per (statistic, threshold, label).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclust.llm.common import drawn, text_of, words_of

WINDOW_WORDS = 8
#: Labelled rows used for fitting, at most about this many (chosen by a hash of the id).
FIT_ROWS = 20_000
#: Thresholds tried per statistic (quantiles of the labelled rows).
THRESHOLDS = 24
MAX_RULES = 12
MAX_TESTS = 4
MIN_PRECISION = 0.7

#: Statistics that tests may use: name -> SQL over the columns of ``statistics``.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "symbol_words": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "shout_words": "n_shouts / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}


@dataclass
class Rule:
    """A conjunction of (feature, '<=' or '>', threshold) that rejects."""

    tests: list[tuple[str, str, float]]

    def condition(self) -> Column:
        out = F.lit(True)
        for name, op, value in self.tests:
            c = F.col(f"_f_{name}")
            out = out & ((c <= value) if op == "<=" else (c > value))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {o} {v:.4g}" for n, o, v in self.tests)


@dataclass
class DecisionList:
    """Ordered rejecting rules; ``rule_number`` is null where none holds."""

    rules: list[Rule] = field(default_factory=list)

    def rule_number(self) -> Column:
        out = F.lit(None).cast("int")
        for i, rule in reversed(list(enumerate(self.rules))):
            out = F.when(rule.condition(), F.lit(i)).otherwise(out)
        return out


def _count(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _paired(hashes: str, step: int) -> Column:
    """Hashes of (element, element ``step`` later); shorter by ``step``."""
    left = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - step, F.lit(0)))
    right = F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.zip_with(left, right, lambda x, y: F.xxhash64(x, y))


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the statistics of the whole text and the ``_f_`` features.

    A null text counts as empty: all counts 0.  ``n_repeat_words`` compares
    8-word windows by 64-bit hashes within one text.  Columns of ``docs`` that
    carry the name of a statistic are replaced.
    """
    n = WINDOW_WORDS
    df = docs.withColumn("_text", text_of(text_col)).withColumn("_words", words_of(F.col("_text")))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"\S")))
    # 64-bit hashes of all 8-word windows by doubling: 1, 2, 4, then 8 words
    df = df.withColumn("_windows", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        df = df.withColumn("_windows", _paired("_windows", step))
    df = df.select(
        "*",
        F.size("_words").cast("long").alias("_n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("_word_chars"),
        _count(r"[#*$%&|<>]", F.col("_text")).alias("_n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_n_dup_lines"),
        F.size("_lines").cast("long").alias("_n_lines"),
        _count(r"\p{Lu}", F.col("_text")).alias("_n_upper"),
        _count(r"[0-9]", F.col("_text")).alias("_n_digits"),
        (F.length("_text") - F.length(F.replace("_text", F.lit("!")))).cast("long").alias("_n_shouts"),
        # (hash, position) in order of the hash, only where some window repeats
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        )
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias("_sorted"),
    ).drop("_text", "_words", "_lines", "_windows")
    at = F.col("_sorted")
    twice = F.filter(
        at,
        lambda x, i: F.coalesce(F.get(at, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(at, i + 1)["h"] == x["h"], F.lit(False)),
    )
    df = df.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_sorted")
    starts = F.col("_starts")
    covered = F.transform(
        starts, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(starts, i + 1) - x, F.lit(n))).cast("long")
    )
    # the id (never negative) keeps the optimiser from moving later filters below, where they would
    # evaluate the arrays again for every element
    once = F.when(F.monotonically_increasing_id() < 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("_n_repeat_words", total + once).drop("_starts")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
             "n_shouts"]
    df = df.drop(*names)
    for c in names:
        df = df.withColumnRenamed(f"_{c}", c)
    return df.select("*", *[F.expr(sql).cast("double").alias(f"_f_{name}") for name, sql in FEATURES.items()])


def base_failed() -> Column:
    """The fixed rule: fewer than 20 words, or over 30 % of the words in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _edges(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds per feature: quantiles of all rows that are left and of the rejected ones."""
    steps = [i / (THRESHOLDS + 1) for i in range(1, THRESHOLDS + 1)]
    bad = F.col("_bad") == 1
    row = rows.agg(
        *[F.percentile_approx(f"_f_{n}", steps, 1000).alias(n) for n in FEATURES],
        *[F.percentile_approx(F.when(bad, F.col(f"_f_{n}")), steps, 1000).alias(f"{n}_bad") for n in FEATURES],
    ).first()
    return {n: sorted({*(row[n] or []), *(row[f"{n}_bad"] or [])}) for n in FEATURES}


def _with_bins(rows: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Adds ``_bins``: per feature the number of its thresholds below the value."""

    def below(name: str, cuts: list[float]) -> Column:
        if not cuts:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(float(e)) for e in cuts]), lambda e: e < F.col(f"_f_{name}")))

    bins = [below(n, cuts) for n, cuts in edges.items()]
    return rows.withColumn("_bins", F.array(*bins))


def _counts(rows: DataFrame) -> dict:
    """{(position of the feature, bin): (kept rows, rejected rows)}: all features in one job."""
    got = rows.select("_bad", F.posexplode("_bins").alias("f", "b")).groupBy("f", "b").agg(
        F.sum(1 - F.col("_bad")).alias("good"), F.sum("_bad").alias("bad")
    )
    return {(r.f, r.b): (r.good, r.bad) for r in got.collect()}  # at most features x (thresholds + 1) rows


def _best_test(rows: DataFrame, edges: dict, good: float, bad: float):
    """The test with the largest FOIL gain on ``rows``, or None."""
    counts, best = _counts(rows), None
    before = math.log2(bad / (bad + good))
    for f, (name, cuts) in enumerate(edges.items()):
        cells = [counts.get((f, b), (0, 0)) for b in range(len(cuts) + 1)]
        for j, cut in enumerate(cuts):
            low = tuple(sum(x[k] for x in cells[: j + 1]) for k in (0, 1))
            for op, (g, b) in (("<=", low), (">", (good - low[0], bad - low[1]))):
                if b and (gain := b * (math.log2(b / (b + g)) - before)) > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, (name, op, cut), g, b)
    return best


def fit(labelled: DataFrame, max_rules: int = MAX_RULES, max_tests: int = MAX_TESTS) -> DecisionList:
    """Learn the list from rows with ``_bad`` (1: reject), ``_part`` (0, 1: grow; 2: prune) and features.

    No labelled rows, or only one class: an empty list, which keeps everything.
    """
    out, rest = DecisionList(), labelled
    while len(out.rules) < max_rules:
        edges = _edges(rest)
        rest = _with_bins(rest, edges)
        grow, prune = rest.where("_part < 2"), rest.where("_part = 2")
        totals = grow.agg(F.sum(1 - F.col("_bad")), F.sum("_bad")).first()
        good, bad = (float(x or 0) for x in totals)
        if bad < 1:
            break
        rule, inside = Rule([]), grow
        while good > 0 and bad > 0 and len(rule.tests) < max_tests:
            found = _best_test(inside, edges, good, bad)
            if found is None:
                break
            _, test, good, bad = found
            rule.tests.append(test)
            inside = grow.where(rule.condition())
        if not rule.tests:
            break
        # prune: the shortest beginning of the rule with the best (bad - good) / (bad + good)
        ends = [Rule(rule.tests[: i + 1]) for i in range(len(rule.tests))]
        row = prune.agg(
            *[F.sum(F.when(r.condition(), F.lit(k) + (1 - 2 * k) * (1 - F.col("_bad"))).otherwise(0)).alias(f"{'bg'[k]}{i}")
              for i, r in enumerate(ends) for k in (0, 1)]
        ).first()
        marks = []
        for i, r in enumerate(ends):
            # b{i}: sum of (1 - _bad) = rejected wrongly; g{i}: sum of 1 - (1 - _bad) = rejected rightly
            wrong, right = float(row[f"b{i}"] or 0), float(row[f"g{i}"] or 0)
            marks.append(((right - wrong) / (right + wrong) if right + wrong else -1.0, -i, right, wrong, r))
        worth, _, right, wrong, rule = max(marks, key=lambda x: x[:2])
        if right + wrong == 0 or right / (right + wrong) < MIN_PRECISION:
            break
        out.rules.append(rule)
        rest = rest.where(~rule.condition())
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Statistics of about ``fit_rows`` labelled documents at most, with ``_bad`` and ``_part``.

    Null ids and null labels are left out; an id with several labels counts as
    rejected if any of them says so.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0).cast("int")).alias("_bad")
    )
    n = marks.count()
    share = min(1.0, fit_rows / max(n, 1))
    h = F.xxhash64(F.col("doc_id"), F.lit("fit"))
    marks = marks.where(drawn(h, share)).withColumn(
        "_part", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(3)).cast("int")
    )
    # the ids are bounded by fit_rows, so the texts are not shuffled
    chosen = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    return statistics(chosen).select("_bad", "_part", *[f"_f_{n}" for n in FEATURES])


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DecisionList:
    """Fit the list on a bounded sample of the labelled documents."""
    rows = labelled_rows(docs, labels, fit_rows).repartition(4).persist()
    try:
        return fit(rows)
    finally:
        rows.unpersist()


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` with statistics, ``base_failed``, ``rule`` (first rule that holds) and ``kept``.

    Works on any number of rows, none included; each row is judged by itself,
    so repeated rows get equal verdicts.
    """
    out = statistics(docs).drop("base_failed", "kept", "rule")
    out = out.withColumn("base_failed", base_failed()).withColumn("rule", rules.rule_number())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop(*[f"_f_{n}" for n in FEATURES])
