"""Bounded samples of labelled texts, on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows at most that a classifier is fitted on.
SAMPLE_ROWS = 4000
#: Longer texts aren't used for fitting; they are scored whole like all others.
SAMPLE_CHARS = 20_000


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    usable: Column,
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
) -> list[tuple[bytes, int]]:
    """(text, label) of at most ``rows`` documents, collected: ``rows * chars`` characters bound it.

    ``usable`` is a condition on the labels' doc_id. The choice follows a hash of the
    doc_id, so it is the same for every layout of the tables. Labels other than 0 and
    1, ids without a document and texts over ``chars`` characters give no example; a
    null text is an empty one; a document or label that is there twice counts twice.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    chosen = known.select(F.col("doc_id").alias("labelled_id"), F.col(label).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("labelled_id"), "labelled_id", "label").limit(rows)
    texts = docs.select(F.col("doc_id").alias("text_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.filter(F.length("text") <= chars).join(
        F.broadcast(chosen), F.col("text_id") == F.col("labelled_id")
    )
    found = joined.select("text_id", F.col("text").cast("binary").alias("text"), "label")
    examples = found.orderBy(F.xxhash64("text_id"), "text_id", "label", "text").limit(rows).collect()
    return [(bytes(r["text"]), int(r["label"])) for r in examples]
