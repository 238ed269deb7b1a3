"""Small tables that the tests of this folder share."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=""):
    """(doc_id, text, source) rows as documents, with a column of an inner name if asked for."""
    full = [(i, t, "en", s, None if t is None else len(t)) + (("x",) if extra else ()) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS + (f", {extra} string" if extra else ""))


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
