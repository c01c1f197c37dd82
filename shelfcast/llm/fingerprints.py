"""I-Match fingerprints of documents, with DataFrame functions only.

A document's fingerprint hashes its sorted distinct terms, of those whose document frequency lies
in a band, once for each of several random subsets of that lexicon. The lexicon reaches every row
as a hash table in one array, from a scalar subquery; its size is bounded by the lower end of
the band, since all document frequencies add up to the number of terms of all documents.
"""

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.common import keep

# Rows with neighbouring ids of one group of the order, as a power of two.
GROUP_BITS = 12
# A table of at most so many rows (two longs each) is sent to all tasks.
SMALL_ROWS = 500_000


@dataclass(frozen=True)
class MatchParams:
    """Band of document frequencies (shares of all documents), subset rates and copies.

    Each rate divides the next one.

    The lower end rises where needed to keep the lexicon within `lexicon` terms.
    """

    rarest: float = 0.001
    commonest: float = 0.1
    rates: tuple = (4, 16, 64, 256)
    copies: int = 12
    lexicon: int = 1 << 18
    slots: int = 1 << 15


def terms(text):
    """Sorted-ready distinct term hashes of a text column, lower-cased."""
    words = F.filter(F.split(F.lower(text), r"[\s\p{Punct}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon_table(docs, params):
    """One-row DataFrame: the lexicon as an array of slots, each an array of term hashes."""
    spark = docs.sparkSession
    each = docs.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term"))
    counts = keep(each.groupBy("term").agg(F.count("*").alias("df")), "df")
    n_docs = docs.count()
    total = counts.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    least = max(2.0, params.rarest * n_docs, total / params.lexicon)
    chosen = counts.where((F.col("df") >= least) & (F.col("df") <= params.commonest * n_docs))
    slots = chosen.groupBy(F.pmod("term", F.lit(params.slots)).alias("slot")).agg(
        F.collect_list("term").alias("terms")
    )
    every = spark.range(params.slots).select(F.col("id").alias("slot")).join(slots, "slot", "left")
    filled = F.coalesce("terms", F.array().cast("array<bigint>")).alias("terms")
    in_order = F.sort_array(F.collect_list(F.struct("slot", filled)))
    return keep(every.agg(F.transform(in_order, lambda s: s["terms"]).alias("lexicon")), "lexicon")


def settled(df, name, value):
    """`df` with a column computed once per row, however often later expressions use it.

    The one-element generator keeps the optimizer from copying `value` into its users.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, value.alias(name)).select(
        *others, F.explode(F.array(name)).alias(name)
    )


def with_fingerprint(docs, text, lexicon, params, name):
    """`docs` with an array column: one int per subset, null where it has no term of the text.

    A text with terms of which none is in the lexicon is fingerprinted by all of its terms.
    """
    slot = F.lit(params.slots)
    columns = docs.columns
    rows = settled(docs, "_terms", terms(F.col(text)))
    rows = rows.withColumn("_lexicon", lexicon.scalar())
    known = F.filter(
        "_terms", lambda t: F.array_contains(F.get("_lexicon", F.pmod(t, slot).cast("int")), t)
    )
    rows = settled(rows.select(*columns, "_terms", known.alias("_known")), "_known", F.col("_known"))
    used = F.sort_array(F.when(F.size("_known") > 0, F.col("_known")).otherwise(F.col("_terms")))
    rows = settled(rows.select(*columns, used.alias("_used")), "_used", F.col("_used"))
    # The subset of a copy at one rate lies inside of its subset at the rate before.
    copies = F.array(*[F.lit(c) for c in range(params.copies)])
    prints, inner = [], None
    for rate in params.rates:
        if inner is None:
            parts = F.transform(copies, lambda c: F.filter("_used", lambda t: _drawn(t, c, rate)))
        else:
            parts = F.transform(
                inner, lambda part, c: F.filter(part, lambda t: _drawn(t, c, rate))
            )
        inner = f"_rate{rate}"
        rows = settled(rows.select("*", parts.alias(inner)), inner, F.col(inner))
        prints.append(F.transform(inner, lambda part: F.when(F.size(part) > 0, F.hash(part))))
    return settled(rows.select(*columns, F.concat(*prints).alias(name)), name, F.col(name))


def _drawn(term, copy, rate):
    return F.pmod(F.xxhash64(term, copy), F.lit(rate)) == 0


def as_text(prints):
    """A fingerprint as text: eight hex digits per subset, dots for an empty one."""
    part = F.transform(
        prints, lambda p: F.coalesce(F.lpad(F.hex(p.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0"), F.lit("."))
    )
    return F.array_join(part, "")


def likeness(one, two):
    """Share of equal subset hashes among the subsets that either document has terms in.

    Documents without any term are fully alike.
    """
    pairs = F.arrays_zip(one.alias("one"), two.alias("two"))
    used = F.size(F.filter(pairs, lambda p: p["one"].isNotNull() | p["two"].isNotNull()))
    equal = F.size(F.filter(pairs, lambda p: p["one"] == p["two"]))
    return F.when(used == 0, 1.0).otherwise(equal / used)


def successors(ids):
    """id and next (the next smaller id; after the smallest comes the largest) of distinct ids.

    Ids are ordered inside groups of neighbouring ids, then the groups in the same way, so no task
    holds more than two groups of 4096 ids.
    """
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return ids.select("id", F.col("id").alias("next"))

    def level(part, low, high):
        last_level = high - low < 2 << GROUP_BITS
        group = F.lit(0) if last_level else F.shiftright("id", GROUP_BITS)
        grouped = part.select("id", group.alias("in_group"))
        inside = Window.partitionBy("in_group").orderBy(F.desc("id"))
        linked = grouped.withColumn("next", F.lead("id").over(inside))
        if last_level:
            return linked.select("id", F.coalesce("next", F.lit(high)).alias("next"))
        heads = keep(grouped.groupBy("in_group").agg(F.max("id").alias("head")), "heads")
        above = level(
            heads.select(F.col("in_group").alias("id")), low >> GROUP_BITS, high >> GROUP_BITS
        )
        ahead = above.join(heads.withColumnRenamed("in_group", "next"), "next").select(
            F.col("id").alias("in_group"), "head"
        )
        return linked.join(ahead, "in_group", "left").select(
            "id", F.coalesce("next", "head").alias("next")
        )

    return level(ids, low, high)


def with_next(docs, columns, ids):
    """`docs` with next_<column>: values of the next document by descending doc_id.

    `ids` is a table of the same documents' ids (doc_id) that is cheap to read.

    After the smallest id comes the largest. Rows with the same id follow each other in the order
    of their texts. Rows without an id have no next document (null values).
    """
    ids = ids.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    group = F.shiftright("doc_id", GROUP_BITS)
    heads = ids.groupBy(F.shiftright("id", GROUP_BITS).alias("in_group")).agg(
        F.max("id").alias("head")
    )
    # The first document of a group also visits the group in front of it, as its last one's next.
    visits = keep(
        successors(heads.select(F.col("in_group").alias("id")))
        .withColumnRenamed("id", "visited")
        .join(heads.withColumnRenamed("in_group", "next"), "next")
        .select(F.col("head").alias("doc_id"), "visited"),
        "visits",
    )
    small = visits.count() <= SMALL_ROWS
    placed = (
        docs.join(F.broadcast(visits) if small else visits, "doc_id", "left")
        .withColumn("own", F.coalesce(group, F.xxhash64("text")))
        .withColumn("stays", F.explode(F.array(F.lit(True), F.lit(False))))
        .where(F.col("stays") | F.col("visited").isNotNull())
        .withColumn("place", F.when(F.col("stays"), F.col("own")).otherwise(F.col("visited")))
        .withColumn("anonymous", F.col("doc_id").isNull())
    )
    order = Window.partitionBy("place", "anonymous").orderBy(
        F.desc("stays"), F.desc("doc_id"), "text"
    )
    known = F.col("doc_id").isNotNull()
    following = [
        F.when(known, F.lead(c).over(order)).alias(f"next_{c}") for c in columns
    ]
    return placed.select("*", *following).where("stays").select(
        *docs.columns, *[f"next_{c}" for c in columns]
    )


def compare_with_edits(docs, params=MatchParams()):
    """Fingerprints of every document and of its edited text, and their likenesses.

    The edited text ends in the beginning of the next document by descending doc_id: a third of the
    characters, rounded down, are replaced. Null texts are empty. Rows without an id have no next
    document; their edited text just loses its end. Repeated rows stay.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lexicon = lexicon_table(docs, params)
    marked = with_fingerprint(docs, "text", lexicon, params, "prints")
    n_chars = F.length("text")
    third = F.floor(n_chars / 3).cast("int")
    following = F.coalesce("next_text", F.lit(""))
    edited = F.concat(F.left("text", n_chars - third), F.left(following, third))
    rows = with_next(marked, ["text", "prints"], docs).select(
        "doc_id",
        n_chars.cast("long").alias("n_chars"),
        "prints",
        "next_prints",
        edited.alias("edited"),
    )
    both = with_fingerprint(rows, "edited", lexicon, params, "edited_prints")
    nothing = F.lit(0.0)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("prints")).alias("fingerprint"),
        as_text(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        F.coalesce(likeness(F.col("prints"), F.col("next_prints")), nothing).alias("near_next"),
    )
