"""Small tables with the awkward rows that every operator must survive."""

from __future__ import annotations

LONG = "long words in a row " * 20_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog."),
    (2, None),
    (3, ""),
    (4, " \t\n\v\f\r "),
    (5, LONG),
    (5, LONG),
    (6, "ÀÉÎ 你好 \x00     <|endoftext|> it's 123"),
    (None, "no identifier"),
    (None, None),
    (7, "The quick brown fox jumps over the lazy dog."),
    (8, "a a a a a a a a a a a a"),
    (9, "x"),
    (10, "line one\nline one\n\nline two"),
]


def documents(spark, texts=TEXTS):
    """Columns that clash with those the operators use inside are part of the table."""
    rows = [
        (i, t, "en" if n % 2 else None, "src", n, n, "r", 7, n, "x", None, 1.5, [n])
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, row string, hash int, "
        "`a b` bigint, `x-y` string, `d.o.t` string, `tick``s` double, `p: q, <r>` array<bigint>",
    )


def empty(spark):
    return documents(spark, [])
