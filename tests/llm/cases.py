"""Small inputs with the awkward rows that every operator must take."""

import pandas as pd

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LINE = "The quick brown fox jumps over the lazy dog while nineteen owls watch from the old oak tree. "


def documents(n=60):
    """Rows of the smallest table, and null, empty, repeated, tied, very long and overlapping ones."""
    d = pd.read_parquet(f"{SF}/documents.parquet").head(n)
    rows = [tuple(r) for r in d[["doc_id", "text", "lang", "source", "n_chars"]].itertuples(index=False)]
    top = max(r[0] for r in rows) + 1
    long_ = " ".join(f"w{i * 7919 % 100003} {LINE if i % 400 == 0 else ''}" for i in range(8000))
    extra = [None, "", " ", LINE, LINE * 3, "x" * 300, "ab" * 150, rows[0][1], rows[0][1] + " tail", long_,
             "\x00nul " + LINE, "É" * 80, "a\nb\tc", "🙂" * 30, rows[3][1][:200] + rows[4][1][:200]]
    rows += [(top + i, t, "en", None, None) for i, t in enumerate(extra)]
    rows += [(None, LINE + "no id", None, None, None), (top, "second row of one id " + LINE, "en", "s", 3), rows[2], rows[2]]
    return [(None if r[0] is None else int(r[0]), r[1], r[2], r[3], None if r[4] is None or r[4] != r[4] else int(r[4])) for r in rows]


def frame(spark, rows=None, parts=3):
    """The rows with an extra column whose name clashes with those of operators."""
    rows = documents() if rows is None else rows
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "doc_id as n_tokens", "text as row", "1 as key", "text as words").repartition(parts)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def key(r):
    return tuple((x is None, str(x)) for x in r)
