"""Labelled documents, bounded samples of them, and folds by document id."""

from pyspark.sql import functions as F


def fold(key, parts):
    """Fold of a document: crc32 of its id as text, modulo `parts`; null ids have none."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def one_label(labels, label):
    """doc_id and label, one row per labelled document: of several labels, the largest."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias(label))
        .where(F.col(label).isin(0, 1))
    )


def balanced_sample(docs, labels, label, per_class, max_chars, columns=("doc_id", "text")):
    """Up to `per_class` documents with label 1 and with label 0, chosen by a hash of their ids.

    Returns a DataFrame of `columns` and `label`: at most 2 * per_class labelled ids. A document with
    several labels has their maximum. Null ids, labels and texts and texts of more than
    `max_chars` characters are not sampled; this bounds the sample's size for any table.
    """
    clean = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias(label))
    )
    order = F.xxhash64(F.lit(label), "doc_id")
    chosen = None
    for value in (0, 1):
        part = clean.where(F.col(label) == value).orderBy(order, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    one_each = (
        docs.select(*columns)
        .where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
        .join(F.broadcast(chosen), "doc_id")
    )
    return one_each.select(*columns, label)


def label_share(labels, label):
    """Share of rows with label 1 among all labelled rows; a half if there are none."""
    row = labels.where(F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("double"))).first()
    return 0.5 if row[0] is None else float(row[0])
