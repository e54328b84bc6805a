"""Frames that every operator must take: nulls, empty and long texts, ties, repeated rows, no rows, clashing columns."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"

#: Extra columns with names that operators use inside.
CLASH = "size long, kept boolean, bucket long, node string, _text string, copies int, `_p` double, row int, h string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


def docs(spark, rows):
    """documents from (doc_id, text, source), with the clashing columns."""
    full = [(i, t, "en", s, None if t is None else len(t), 7, True, 3, "n", "x", 5, 0.5, 9, "h") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


LONG = " ".join(f"word{i}" for i in range(30_000))
EDGES = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "a"),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \t\n\x0b\x0c\r ", "b"),
    (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa", None),
    (None, None, None),
    (5, LONG, "b"),
    (6, "é ü 漢字 😀 " * 12, "c"),
]


def collect(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
