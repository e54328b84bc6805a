"""Secret scans: fixed patterns plus a battery of randomness tests, as native expressions.

Fixed patterns give the base spans.  The battery looks at every token of 20 or
more key characters, infers its encoding (decimal, hex, base32, base64) and
tests two things:

* Is it consistent with uniform draws from the alphabet of that encoding?
  Chi-squared uniformity (Wilson-Hilferty), a runs test about the middle of the
  alphabet and the lag-1 serial correlation must all stay below a critical z.
* Is it inconsistent with the corpus's own text?  The numbers of digits and of
  character-class changes are held against the rates measured over all
  documents; Chernoff bounds give an upper bound of the p-value.

Tokens that pass the first are ranked by the second, and Benjamini-Hochberg
control is run for each range of token lengths by itself, over a histogram of
the log p-values of the whole corpus.  Discoveries become spans of kind
``random`` unless they overlap a base span.

Offsets are code points, ends exclusive.  Null and empty texts have no span.
Repeated rows give repeated results.  Positions are summed along one document's
own matches; documents never meet in a group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclust.llm.common import text_of

#: Kinds in their order, patterns, index of the measured group, its least length.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Starts of the ranges of token lengths that are controlled separately.
LENGTHS = (20, 32, 48, 80)
FALSE_DISCOVERY = 0.01
#: Two-sided critical value of the three uniformity tests (about 1 in 1,000).
CRITICAL_Z = 3.3
#: Log p-values at or below -TOP share the last cell of the histogram.
TOP = 200

ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
CLASS_CHANGE = r"[a-z](?=[A-Z0-9])|[0-9](?=[A-Za-z])|[A-Z](?=[a-z0-9])"


@dataclass
class Null:
    """The corpus's rates per character and, per range of lengths, the least -log p that is a discovery."""

    digits: float
    changes: float
    cuts: dict[int, int] = field(default_factory=dict)


def _found(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """array<struct<s,k,e>> of the matches of ``pattern`` whose ``group`` has ``least`` characters."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(hits)),
        hits,
        lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("len"), F.length(h).alias("got")),
    )
    if group:
        steps = F.zip_with(
            steps,
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
            lambda x, m: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), F.length(m).alias("got")),
        )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,k:int,e:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + x["len"]
        span = F.struct(s.alias("s"), F.lit(kind).alias("k"), e.alias("e"))
        return F.struct(e.alias("at"), F.when(x["got"] >= least, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    return F.when(text.rlike(pattern), F.aggregate(steps, start, step, lambda acc: acc["out"])).otherwise(none)


def _encoding(token: Column) -> Column:
    return (
        F.when(token.rlike("^[0-9]+$"), "decimal")
        .when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(token.rlike("^[A-Z2-7]+=*$"), "base32")
        .otherwise("base64")
    )


def _normal(token: Column, encoding: Column) -> Column:
    """The token's symbols in the spelling of its alphabet, without padding."""
    bare = F.rtrim(F.translate(token, "-_", "+/"), F.lit("="))
    return F.when(encoding == "hex", F.lower(bare)).otherwise(F.replace(bare, F.lit("="), F.lit("")))


def _tested(df: DataFrame) -> DataFrame:
    """Adds ``_tokens`` from ``_text``: array of struct(s, k, e, n, digits, changes, uniform).

    ``uniform``: chi-squared, runs and serial correlation all accept uniform
    draws from the alphabet of the token's encoding.  Every step is a transform
    of the array that the step before made, so no step repeats another's work.
    """
    text, plus = F.col("_text"), lambda a, x: a + x

    def step(df: DataFrame, make) -> DataFrame:
        return df.withColumn("_tokens", F.transform("_tokens", make))

    def keep(x: Column, *names: str) -> list[Column]:
        return [x[c].alias(c) for c in ("s", "k", "e", *names)]

    def symbols(x: Column) -> Column:
        encoding = _encoding(x["t"])
        alphabet = F.lit(ALPHABETS["base64"])
        for name in ("decimal", "hex", "base32"):
            alphabet = F.when(encoding == name, F.lit(ALPHABETS[name])).otherwise(alphabet)
        return F.struct(
            *keep(x), F.length(x["t"]).alias("n"),
            F.length(F.regexp_replace(x["t"], "[^0-9]+", "")).alias("digits"),
            F.regexp_count(x["t"], F.lit(CLASS_CHANGE)).alias("changes"),
            alphabet.alias("alphabet"), _normal(x["t"], encoding).alias("symbols"),
        )

    def codes(x: Column) -> Column:
        one = x["symbols"]
        count = lambda c: (F.length(one) - F.length(F.replace(one, c, F.lit("")))).cast("double")
        return F.struct(
            *keep(x, "n", "digits", "changes"), F.length(x["alphabet"]).cast("double").alias("size"),
            F.greatest(F.length(one), F.lit(2)).cast("double").alias("m"),
            F.aggregate(F.array_distinct(F.split(one, "")), F.lit(0.0), lambda a, c: a + F.pow(count(c), 2)).alias("squares"),
            F.transform(F.split(one, ""), lambda c: F.instr(x["alphabet"], c).cast("double")).alias("codes"),
        )

    def pairs(x: Column) -> Column:
        less = F.greatest(F.size(x["codes"]) - 1, F.lit(0))
        return F.struct(
            *keep(x, "n", "digits", "changes", "size", "m", "squares", "codes"),
            F.slice(x["codes"], F.lit(1), less).alias("earlier"), F.slice(x["codes"], F.lit(2), less).alias("later"),
            (F.aggregate(x["codes"], F.lit(0.0), plus) / x["m"]).alias("mean"), (x["size"] / 2).alias("half"),
        )

    def sums(x: Column) -> Column:
        return F.struct(
            *keep(x, "n", "digits", "changes", "size", "m", "squares"),
            F.aggregate(x["codes"], F.lit(0.0), lambda a, c: a + (c > x["half"]).cast("double")).alias("high"),
            F.aggregate(x["codes"], F.lit(0.0), lambda a, c: a + (c - x["mean"]) * (c - x["mean"])).alias("around"),
            F.aggregate(
                F.zip_with(x["earlier"], x["later"], lambda c, d: ((c > x["half"]) != (d > x["half"])).cast("double")),
                F.lit(1.0), plus,
            ).alias("runs"),
            F.aggregate(
                F.zip_with(x["earlier"], x["later"], lambda c, d: (c - x["mean"]) * (d - x["mean"])), F.lit(0.0), plus
            ).alias("along"),
        )

    def verdict(x: Column) -> Column:
        n, df_ = x["m"], x["size"] - 1
        chi = F.greatest(x["size"] / n * x["squares"] - n, F.lit(0.0)) / df_
        z_chi = (F.pow(chi, 1 / 3) - (1 - 2 / (9 * df_))) / F.sqrt(2 / (9 * df_))
        both = 2 * x["high"] * (n - x["high"])
        spread = both * (both - n) / (n * n * (n - 1))
        z_runs = F.when(spread > 0, F.abs(x["runs"] - both / n - 1) / F.sqrt(spread)).otherwise(99.0)
        z_serial = F.when(x["around"] > 0, F.abs(x["along"] / x["around"]) * F.sqrt(n)).otherwise(99.0)
        accepts = (z_chi < CRITICAL_Z) & (z_runs < CRITICAL_Z) & (z_serial < CRITICAL_Z)
        return F.struct(*keep(x, "n", "digits", "changes"), accepts.alias("uniform"))

    df = df.withColumn("_tokens", _found(text, len(BASE_KINDS), TOKEN, 0, 1))
    df = step(df, lambda x: F.struct(*keep(x), F.substring(text, x["s"] + 1, x["e"] - x["s"]).alias("t")))
    for make in (symbols, codes, pairs, sums, verdict):
        df = step(df, make)
    return df


def _tail(seen: Column, mean: Column) -> Column:
    """Chernoff bound of -log P(count >= seen) for a Poisson count."""
    return F.when(seen > mean, seen * F.log(seen / mean) - seen + mean).otherwise(0.0)


def _surprise(token: Column, null: Null) -> Column:
    """Whole part of a lower bound of -log p that ordinary text made the token (two tests: minus log 2).

    0 where the token is not uniform.
    """
    n = token["n"].cast("double")
    bound = F.greatest(
        _tail(token["digits"].cast("double"), n * null.digits), _tail(token["changes"].cast("double"), n * null.changes)
    )
    whole = F.least(F.floor(F.greatest(bound - math.log(2), F.lit(0.0))), F.lit(TOP)).cast("int")
    return F.when(token["uniform"], whole).otherwise(0)


def _range_of(length: Column) -> Column:
    out = F.lit(LENGTHS[0])
    for start in LENGTHS[1:]:
        out = F.when(length >= start, F.lit(start)).otherwise(out)
    return out


def learn_null(docs: DataFrame, text_col: str = "text", q: float = FALSE_DISCOVERY) -> Null:
    """Rates and discovery thresholds over all documents (two passes, each a sum or a histogram).

    An empty table gives the rates 1e-6 and no threshold, hence no discovery.
    """
    text = text_of(text_col)
    row = docs.select(
        F.length(text).alias("n"),
        F.length(F.regexp_replace(text, "[^0-9]+", "")).alias("d"),
        F.regexp_count(text, F.lit(CLASS_CHANGE)).alias("c"),
    ).agg(F.sum("n"), F.sum("d"), F.sum("c")).first()
    n = float(row[0] or 0)
    null = Null(max(float(row[1] or 0) / n, 1e-6) if n else 1e-6, max(float(row[2] or 0) / n, 1e-6) if n else 1e-6)
    tokens = _tested(docs.select(text.alias("_text"))).select(F.explode("_tokens").alias("t"))
    cells = (
        tokens.select(_range_of(F.col("t.n")).alias("range"), _surprise(F.col("t"), null).alias("cell"))
        .groupBy("range", "cell")
        .count()
        .collect()  # at most len(LENGTHS) * (TOP + 1) rows
    )
    for start in LENGTHS:
        here = {r.cell: r["count"] for r in cells if r.range == start}
        total, above = sum(here.values()), 0
        for cell in sorted(here, reverse=True):
            above += here[cell]
            if cell > 0 and math.exp(-cell) <= q * above / total:
                null.cuts[start] = cell  # the last one that holds is the largest p-value
    return null


def scan(docs: DataFrame, null: Null, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_base`` and ``_random``: arrays of struct(s, k, e), each in order of start and kind."""
    text = F.col("_text")
    df = docs.withColumn("_text", text_of(text_col))
    base = [_found(text, k, pattern, group, least) for k, (_, pattern, group, least) in enumerate(BASE_KINDS)]
    df = df.withColumn("_base", F.array_sort(F.concat(*base)))
    df = _tested(df)

    def chosen(x: Column) -> Column:
        cut = F.lit(None).cast("int")
        for start in LENGTHS:
            if start in null.cuts:
                cut = F.when(_range_of(x["n"]) == start, F.lit(null.cuts[start])).otherwise(cut)
        free = ~F.exists("_base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
        return free & F.coalesce(_surprise(x, null) >= cut, F.lit(False))

    found = F.transform(F.filter("_tokens", chosen), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return df.withColumn("_random", found).drop("_text", "_tokens")


def written(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string")),
        ),
        ",",
    )


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """Replace every span by ``mark``; overlapping spans become one.  A null text stays null."""
    text = F.col(text_col)
    spans = F.array_sort(F.concat("_base", "_random"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark))
        out = F.when(x["s"] >= acc["at"], piece).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    clean = F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    )
    return scanned.withColumn(text_col, F.when(F.size(spans) == 0, text).otherwise(clean)).drop("_base", "_random")
