"""Mixing sources to target weights, with DataFrame functions only.

Weights are the sources' token shares to the power of an exponent between 0 (all equal) and 1 (as
they are). The exponent is bisected, several values per pass, to the largest for which the weights
reach a target entropy, or the smallest that keeps the repetition of every source within a limit;
where both are asked for, the limit wins. The weights are realised with a token budget: every
source repeats its documents whole, and the rest of its share is filled in the order of
a permutation of blocks, then of the documents inside a block.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.common import keep

# A table of at most so many rows, a few numbers each, is sent to all tasks.
SMALL_ROWS = 200_000
# A source's blocks are ordered in at most 2 ** SLAB_BITS slabs, and inside one of them.
SLAB_BITS = 16


@dataclass(frozen=True)
class MixParams:
    """entropy: target share of the largest possible entropy of the weights, or None.

    repeats: how often a document may occur at most. budget: tokens to emit; None is the largest
    budget at which no source loses a document, that is, the source with the smallest
    weight for its size is emitted once.
    """

    entropy: float | None = 0.95
    repeats: float = 2.0
    budget: float | None = None
    block_rows: int = 1024
    probes: int = 15
    rounds: int = 5
    seed: int = 1


def token_estimate(text):
    """Tokens of a text, estimated as the blocks between white space; null has none."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.coalesce(F.size(words), F.lit(0)).cast("long")


def source_sizes(slim):
    """_source, n_tokens and n_docs of rows with _source, _draw and mix_tokens."""
    return slim.groupBy("_source").agg(
        F.sum("mix_tokens").alias("n_tokens"), F.count("*").alias("n_docs")
    )


def _measures(sizes, exponents, params, total, count):
    """Per exponent: entropy of the weights as a share of the largest, and the most repetitions."""
    share = F.col("n_tokens") / F.lit(total)
    aggregates = []
    for k, exponent in enumerate(exponents):
        power = F.pow(share, F.lit(float(exponent)))
        aggregates += [
            F.sum(power).alias(f"sum{k}"),
            F.sum(power * F.log(power)).alias(f"log{k}"),
            F.max(power / share).alias(f"most{k}"),
            F.min(power / share).alias(f"least{k}"),
        ]
    row = sizes.agg(*aggregates).first()
    for k in range(len(exponents)):
        entropy = math.log(row[f"sum{k}"]) - row[f"log{k}"] / row[f"sum{k}"]
        repeats = row[f"most{k}"] / row[f"least{k}"]
        if params.budget is not None:
            repeats = row[f"most{k}"] / row[f"sum{k}"] * params.budget / total
        yield entropy / math.log(count) if count > 1 else 1.0, repeats


def find_exponent(sizes, params):
    """The exponent of the source weights; `sizes` holds the sources with tokens.

    Entropy and repetition both fall as the exponent grows. The result is the largest exponent
    with the target entropy, or the smallest one within the repetition limit if that is larger.
    """
    total, count = sizes.agg(F.sum("n_tokens"), F.count("*")).first()

    def bisect(holds_below):
        """Border between the exponents for which holds_below is true and those above."""
        low, high = 0.0, 1.0
        for _ in range(params.rounds):
            step = (high - low) / (params.probes + 1)
            points = [low + step * k for k in range(1, params.probes + 1)]
            below = 0
            for measure in _measures(sizes, points, params, float(total), count):
                below += holds_below(*measure)
            low, high = low + step * below, low + step * (below + 1)
        return low, high

    exponent = 0.0 if params.entropy is not None else 1.0
    if params.entropy is not None:
        (least, _), *_ = _measures(sizes, [1.0], params, float(total), count)
        exponent = 1.0
        if least < params.entropy:
            exponent = bisect(lambda entropy, _: entropy >= params.entropy)[0]
    (_, most), *_ = _measures(sizes, [exponent], params, float(total), count)
    if most > params.repeats:
        exponent = bisect(lambda _, repeats: repeats > params.repeats)[1]
    return exponent


def _small(table, limit=SMALL_ROWS):
    """The table, marked to be sent to all tasks if it has few rows."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def mix_sources(docs, params=MixParams(), source="source"):
    """`docs` with columns mix_tokens, mix_weight (of its source) and mix_copies of every row.

    mix_copies is how often the document occurs in the mixture. A null source is a source of its
    own. Sources without any token belong to no share and occur once. The same row always has the
    same place, so equal rows are taken or left together. Columns of these names are replaced.
    """
    docs = docs.drop("mix_tokens", "mix_weight", "mix_copies")
    rows = docs.select(
        "*",
        token_estimate(F.col("text")).alias("mix_tokens"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-")).alias("_source"),
        F.xxhash64(F.lit(params.seed), "doc_id", "text").alias("_draw"),
    )
    slim = keep(rows.select("_source", "_draw", "mix_tokens"), "draws")
    sizes = keep(source_sizes(slim).where("n_tokens > 0"), "sources")
    exponent = 1.0 if sizes.isEmpty() else find_exponent(sizes, params)
    power = F.pow(F.col("n_tokens").cast("double"), F.lit(exponent))
    norm, least = sizes.agg(F.sum(power), F.min(power / F.col("n_tokens"))).first()
    budget = params.budget if params.budget is not None else (norm or 1.0) / (least or 1.0)
    # Shares of a whole number are kept whole in spite of rounding.
    tokens = power / F.lit(norm or 1.0) * F.lit(float(budget)) * (1 + 1e-12)
    whole = F.floor(tokens / F.col("n_tokens")).cast("long")
    planned = _small(
        keep(
            sizes.select(
                "_source",
                (power / F.lit(norm or 1.0)).alias("mix_weight"),
                whole.alias("_whole"),
                (tokens - whole * F.col("n_tokens")).alias("_rest"),
                F.ceil(F.col("n_docs") / params.block_rows).cast("long").alias("_blocks"),
            ),
            "plan",
        )
    )
    # Blocks of a source in a random order, and the one that holds the end of the share.
    block = F.pmod(F.col("_draw"), F.col("_blocks")).alias("_block")
    turn = F.xxhash64(F.lit(params.seed), "_source", "_block")
    drawn = slim.join(planned, "_source").select("_source", "_draw", "mix_tokens", "_rest", block)
    borders = _small(keep(_borders(drawn, turn), "borders"))
    inside = F.xxhash64(F.lit(params.seed + 1), "_draw")
    # Equal rows share a draw: they are counted before the block is ordered.
    order = Window.partitionBy("_source").orderBy("_turn")
    split = (
        drawn.drop("_rest")
        .join(borders.select("_source", "_block", "start", "_rest"), ["_source", "_block"])
        .groupBy("_source", "start", "_rest", inside.alias("_turn"))
        .agg(F.sum("mix_tokens").alias("size"))
        .withColumn("reached", F.col("start") + F.sum("size").over(order))
        .where((F.col("start") < F.col("_rest")) & (F.col("reached") <= F.col("_rest")))
        .groupBy("_source")
        .agg(F.max("_turn").alias("_last"))
    )
    borders = borders.join(split, "_source", "left").select(
        "_source", F.struct("turn", "_block").alias("_border"), "_last"
    )
    planned = _small(keep(planned.join(borders, "_source", "left"), "shares"))
    placed = rows.join(planned, "_source", "left").withColumn("_block", block)
    place = F.struct(turn.alias("turn"), "_block")
    taken = (
        F.col("_border").isNull()
        | (place < F.col("_border"))
        | ((place == F.col("_border")) & F.coalesce(inside <= F.col("_last"), F.lit(False)))
    )
    copies = F.when(F.col("_whole").isNull(), 1).otherwise(F.col("_whole") + taken.cast("long"))
    return placed.select(
        *docs.columns,
        "mix_tokens",
        F.coalesce("mix_weight", F.lit(0.0)).alias("mix_weight"),
        copies.cast("long").alias("mix_copies"),
    )


def _borders(drawn, turn):
    """Per source the block in which its tokens, in the order of turns, reach _rest: _block, turn,
    start (the tokens before it) and _rest.

    Turns are cut into at most 2 ** SLAB_BITS slabs of equal width. Slabs are summed up first, and
    only the blocks of the slab that holds the border are ordered.
    """
    slab = F.shiftright("turn", 64 - SLAB_BITS).alias("slab")
    sized = drawn.groupBy("_source", "_block", "_rest").agg(F.sum("mix_tokens").alias("size"))
    blocks = keep(sized.select("*", turn.alias("turn")).select("*", slab), "blocks")

    def reaching(parts, *order):
        """The first of the ordered parts of each source that reaches _rest, and what it starts at."""
        so_far = Window.partitionBy("_source").orderBy(*order)
        ends = F.col("before") + F.sum("size").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
        found = parts.withColumn("end", ends).where(F.col("end") >= F.col("_rest"))
        first = found.groupBy("_source", "_rest").agg(
            F.min(F.struct(*order, (F.col("end") - F.col("size")).alias("start"))).alias("first")
        )
        return first.select("_source", "_rest", "first.*")

    slabs = blocks.groupBy("_source", "_rest", "slab").agg(F.sum("size").alias("size"))
    slabs = reaching(slabs.withColumn("before", F.lit(0).cast("long")), "slab")
    inner = blocks.join(
        _small(keep(slabs.select("_source", "slab", F.col("start").alias("before")), "slabs")),
        ["_source", "slab"],
    )
    return reaching(inner, "turn", "_block")


def mixture(docs, params=MixParams(), source="source"):
    """The mixture itself: each row of `docs` as often as its source's share asks for."""
    mixed = mix_sources(docs, params, source)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))).alias("_copy")
    return mixed.where("mix_copies > 0").select(*docs.columns, copies).drop("_copy")
