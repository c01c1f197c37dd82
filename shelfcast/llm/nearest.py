"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking.

Each table hashes a vector by floors of random projections. A query visits buckets in the order of
the probability that a neighbour at the usual distance lies there, until the tables together
would find it with the wanted probability. Buckets are dealt to blocks of bounded size; a query
travels once to each block that holds one of its buckets, and only its best rows leave it. Queries
left with too few rows, or with rows farther away than the index reaches, search again with wider
buckets.
"""

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.common import keep, ship
from shelfcast.llm.pieces import mix


@dataclass(frozen=True)
class SearchParams:
    """`success` is the wanted chance to find a neighbour at the usual distance of the k-th one.

    A query whose k-th row would be found with a chance below `least` searches again. `sample` vectors, chosen by a hash, are used to estimate that distance and nothing else.
    """

    k: int = 10
    tables: int = 6
    functions: int = 8
    width: float = 1.36  # in usual neighbour distances
    success: float = 0.97
    least: float = 0.9
    sample: int = 3000
    block_rows: int = 8192
    seed: int = 3


@dataclass(frozen=True)
class Hashing:
    """The fitted index: projections, offsets and the distance it is tuned for."""

    params: SearchParams
    radius: float
    axes: np.ndarray  # tables x dimension x functions
    shifts: np.ndarray  # tables x functions
    distances: np.ndarray  # between sampled vectors, sorted

    def share(self, radius):
        """Share of all rows within a distance of a vector, by the sample."""
        return np.searchsorted(self.distances, radius, "right") / max(1, len(self.distances))

    def places(self, vectors):
        """Projections in units of bucket widths: tables x vectors x functions."""
        width = self.params.width * self.radius
        return np.matmul(vectors[None], self.axes) / width + self.shifts[:, None, :]

    @staticmethod
    def keys(cells):
        """64-bit names of buckets, from their whole numbers."""
        out = np.zeros(cells.shape[:-1], np.uint64)
        for k in range(cells.shape[-1]):
            out = mix(out + cells[..., k].astype(np.int64).view(np.uint64) + np.uint64(k + 1))
        return out.view(np.int64)

    def chances(self, inside, times=1.0):
        """Per function, the chance that a neighbour at `times` the radius lies 3 buckets before
        to 3 behind a query that lies `inside` its own."""
        sigma = times / self.params.width  # of a projected difference, in bucket widths
        edges = (np.arange(-3, 5)[None] - inside[:, None]) / sigma / 2**0.5
        return np.diff(np.vectorize(math.erf)(edges), axis=1) / 2

    def reach(self, groups=8):
        """The distance, in radii, at which neighbours are still found with the chance `least`.

        Estimated over `groups` random places in all tables.
        """
        rng = np.random.default_rng(self.params.seed)
        shape = groups * self.params.tables, self.params.functions
        visits = [(inside, self.moves(inside).astype(int) + 3) for inside in rng.uniform(size=shape)]
        functions = np.arange(self.params.functions)

        def success(times):
            masses = [
                self.chances(inside, times)[functions, moves].prod(axis=1).sum()
                for inside, moves in visits
            ]
            missed = 1 - np.array(masses).reshape(groups, -1)
            return 1 - missed.prod(axis=1).mean()

        low, high = 0.25, 4.0
        while high - low > 0.01:
            middle = (low + high) / 2
            low, high = (middle, high) if success(middle) >= self.params.least else (low, middle)
        return low

    def probes(self, place):
        """Names of the buckets that a query at `place` (functions) visits in one table."""
        cell = np.floor(place)
        return self.keys(cell + self.moves(place - cell))

    def moves(self, inside):
        """Buckets to visit, as steps from the query's own, likeliest first."""
        wanted = 1 - (1 - self.params.success) ** (1 / self.params.tables)
        steps = np.arange(-3, 4)
        chance = self.chances(inside)
        best_rest = np.append(np.cumprod(chance.max(axis=1)[::-1])[::-1], 1)
        least = best_rest[0] / 30
        while True:
            total, moves = np.ones(1), np.zeros((1, 0))
            for k, options in enumerate(chance):
                total = (total[:, None] * options[None]).ravel()
                moves = np.concatenate(
                    [np.repeat(moves, len(steps), axis=0), np.tile(steps, len(moves))[:, None]], axis=1
                )
                good = total * best_rest[k + 1] >= least
                total, moves = total[good], moves[good]
            if total.sum() >= wanted or least < 1e-9:
                break
            least /= 3
        order = np.argsort(-total, kind="stable")
        enough = int(np.searchsorted(np.cumsum(total[order]), wanted)) + 1
        return moves[order[:enough]]


def fit_hashing(vectors, rows, params):
    """Random projections, and the usual distance of the k-th neighbour among `rows` vectors.

    In a sample the neighbour of the same distance has a smaller rank, one at least.
    """
    vectors = np.asarray(vectors, float)
    dimension = vectors.shape[1] if vectors.ndim == 2 and len(vectors) else 1
    radius, distances = 0.0, np.zeros((0, 0))
    if len(vectors) > 1:
        ask = vectors[: max(2, min(200, len(vectors)))]
        squares = (ask**2).sum(1)[:, None] + (vectors**2).sum(1)[None] - 2 * ask @ vectors.T
        distances = np.sort(np.sqrt(np.maximum(squares, 0)), axis=1)
        rank = min(len(vectors) - 1, max(1, round(params.k * len(vectors) / max(rows, 1))))
        radius = float(np.quantile(distances[:, rank], 0.75))
        if radius <= 1e-9:
            radius = float(distances.max())
    rng = np.random.default_rng(params.seed)
    axes = rng.normal(size=(params.tables, dimension, params.functions))
    shifts = rng.uniform(size=(params.tables, params.functions))
    return Hashing(params, radius or 1.0, axes, shifts, np.sort(distances, axis=None))


def usable_vectors(table, key="vec_id", vector="embedding"):
    """id and vec (array of double) of the rows that take part in searches.

    Null ids and vectors, vectors with null or non-finite components and zero vectors are left out,
    and so are vectors that don't have the commonest length (of several, the largest).
    """
    infinite = float("inf")
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x != infinite) & (x != -infinite)
    ) & F.exists(vector, lambda x: x != 0)
    sound = table.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine)
    commonest = (
        sound.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    ).first()
    length = commonest["size"] if commonest else 0
    return sound.where(F.size(vector) == length).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")
    )


def _matrix(column):
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def nearest(table, is_query, params=SearchParams(), key="vec_id", vector="embedding"):
    """query_id, rank, vec_id and score (Euclidean distance) of each query's k nearest rows found.

    Queries are the rows for which `is_query` (a Column of `id`) holds; candidates are all other
    rows. Ties go to the smaller id. Repeated ids are one row each; an id is never its own
    candidate. Rows that usable_vectors() leaves out take no part; an empty table gives no rows.
    Equal vectors are indexed once, with the k + 1 smallest of their ids, so that a vector shared by
    many rows is no hot bucket and no row is lost.
    A query with fewer than k rows (where there are as many candidates), or whose k-th row is farther
    away than the index reaches, is searched again with buckets of at least twice the width, until
    its k-th row is within reach. Where that distance holds so many rows that all tables together
    would read more than the whole table, the queries left search all blocks, which is exact;
    column exact says so.
    """
    ship(table.sparkSession)
    rows = usable_vectors(table, key, vector).select(
        "*", F.xxhash64("vec").alias("one"), F.xxhash64(F.lit(1), "vec").alias("two")
    )
    same = Window.partitionBy("one", "two").orderBy("id")
    first = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= params.k + 1)
    classes = keep(
        first.groupBy("one", "two").agg(
            F.sort_array(F.collect_list("id")).alias("ids"), F.min_by("vec", "nth").alias("vec")
        ),
        "vectors",
    )
    count = classes.count()
    sample = classes.orderBy("one", "two").limit(params.sample).select("vec").collect()
    hashing = fit_hashing([r["vec"] for r in sample], count, params)
    n_blocks = max(1, math.ceil(count / params.block_rows))
    queries = keep(rows.where(is_query).select("id", "vec").dropDuplicates(["id", "vec"]), "queries")
    k = params.k
    # Candidates of a query, as far as k.
    wanted = classes.select(F.explode("ids").alias("id")).distinct().limit(k + 1).count() - 1
    found = keep(_best(_in_buckets(classes, queries, hashing, n_blocks), k), "found")
    reach = hashing.reach()
    searched_all = None
    while searched_all is None:
        reached = found.groupBy(F.col("query_id").alias("id")).agg(
            F.count("*").alias("n"), F.max("score").alias("far")
        )
        short = queries.join(reached, "id", "left").where(
            (F.coalesce("n", F.lit(0)) < wanted) | (F.col("far") > reach * hashing.radius)
        )
        short = keep(short.select("id", "vec", "far"), "short")
        left, nearest_far = short.agg(F.count("*"), F.min("far")).first()
        if not left:
            break
        radius = max(2 * hashing.radius, (nearest_far or 0.0) / reach)
        if params.tables * hashing.share(radius) < 1:
            hashing = replace(hashing, radius=radius)
            more = _in_buckets(classes, short.drop("far"), hashing, n_blocks)
        else:
            searched_all = short.select(F.col("id").alias("query_id"), F.lit(True).alias("exact"))
            more = _in_all_blocks(classes, short.drop("far"), n_blocks, params)
        found = keep(_best(found.select("query_id", "vec_id", "score").union(more), k), "found")
    rows = found.select("query_id", "rank", "vec_id", "score")
    if searched_all is None:
        return rows.withColumn("exact", F.lit(False))
    rows = rows.join(searched_all.distinct(), "query_id", "left")
    return rows.withColumn("exact", F.coalesce("exact", F.lit(False)))


def _best(found, k):
    """The k nearest of the rows (query_id, vec_id, score), with their rank."""
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# A group meets one part of a block's rows and one share of its queries.
KEYS = ["table_no", "block", "part", "share"]
# Queries of one task that lists buckets; kept tables are read in few large parts.
TASK_QUERIES = 256


def _in_all_blocks(classes, queries, n_blocks, params):
    """query_id, vec_id and score of the k nearest rows in each block, of all rows.

    A group meets block_rows rows and about as many queries.
    """
    parts = max(1, math.ceil(queries.count() / params.block_rows))
    bucket = F.lit(0).cast("long")
    stored = classes.select(
        F.lit(0).alias("table_no"),
        F.pmod(F.xxhash64("one", "two"), F.lit(n_blocks)).alias("block"),
        F.lit(0).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("share"),
        "ids",
        "vec",
        bucket.alias("bucket"),
    )
    asked = queries.select(
        F.lit(0).alias("table_no"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"),
        F.lit(0).alias("part"),
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("share"),
        "id",
        F.col("vec").alias("query_vec"),
        F.array(bucket).alias("buckets"),
    )
    return _searched(asked, stored, params.k)


def _in_buckets(classes, queries, hashing, n_blocks):
    """query_id, vec_id and score of the k nearest rows in each block, of the buckets visited."""
    params = hashing.params
    shared = classes.sparkSession.sparkContext.broadcast(hashing)

    def index(batches):
        fitted = shared.value
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(fitted.places(_matrix(batch.column("vec"))))
                for number, keys in enumerate(fitted.keys(cells)):
                    yield _extended(
                        batch, number, (keys.view(np.uint64) % np.uint64(n_blocks)).astype(int), keys
                    )

    def visits(batches):
        fitted = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            found = []
            for number, places in enumerate(fitted.places(_matrix(batch.column("vec")))):
                for row, place in enumerate(places):
                    keys = fitted.probes(place)
                    at = (keys.view(np.uint64) % np.uint64(n_blocks)).astype(int)
                    order = np.argsort(at, kind="stable")
                    blocks, starts = np.unique(at[order], return_index=True)
                    for block, part in zip(blocks, np.split(keys[order], starts[1:])):
                        found.append((row, number, block, part))
            row, number, block, part = zip(*found)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [
                    *taken.columns,
                    pa.array(number, pa.int32()),
                    pa.array(block, pa.int64()),
                    pa.array(part, pa.list_(pa.int64())),
                ],
                names=[*taken.schema.names, "table_no", "block", "buckets"],
            )

    indexed = keep(
        classes.select("ids", "vec").mapInArrow(
            index, "ids array<long>, vec array<double>, table_no int, block long, bucket long"
        ),
        "index",
    )
    tasks = max(1, math.ceil(queries.count() / TASK_QUERIES))
    asked = keep(
        queries.repartition(tasks, "id").mapInArrow(
            visits, "id long, vec array<double>, table_no int, block long, buckets array<long>"
        ),
        "asked",
    )
    # A block with more rows or queries than planned is split: queries visit every part of its rows,
    # and rows every share of its queries.
    def pieces(table, name):
        count = F.ceil(F.count("*") / params.block_rows).cast("int")
        return table.groupBy("table_no", "block").agg(count.alias(name))

    cuts = keep(pieces(indexed, "parts").join(pieces(asked, "shares"), ["table_no", "block"]), "cuts")
    stored = indexed.join(cuts, ["table_no", "block"]).select(
        "*",
        F.pmod(F.xxhash64(F.col("ids")[0]), "parts").cast("int").alias("part"),
        F.explode(F.expr("sequence(0, shares - 1)")).alias("share"),
    )
    asked = asked.join(cuts, ["table_no", "block"]).select(
        "*",
        F.pmod(F.xxhash64("id"), "shares").cast("int").alias("share"),
        F.explode(F.expr("sequence(0, parts - 1)")).alias("part"),
    )
    asked = asked.select(*KEYS, "id", F.col("vec").alias("query_vec"), "buckets")
    return _searched(asked, stored.select(*KEYS, "ids", "vec", "bucket"), params.k)


def _searched(asked, stored, k):
    """query_id, vec_id and score of the k nearest rows that each query finds in each group."""

    def search(_, ask, hold):
        if not len(ask) or not len(hold):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        vectors = np.stack(hold["vec"].to_numpy())
        buckets = hold["bucket"].to_numpy()
        ids = hold["ids"].to_numpy()
        order = np.argsort(buckets, kind="stable")
        names, starts = np.unique(buckets[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        out = []
        for query, vec, wanted in zip(ask["id"], ask["query_vec"], ask["buckets"]):
            at = np.searchsorted(names, wanted)
            at = at[(at < len(names))]
            at = at[np.isin(names[at], wanted)]
            if not len(at):
                continue
            chosen = np.concatenate([order[starts[n] : ends[n]] for n in np.unique(at)])
            difference = vectors[chosen] - np.asarray(vec)[None]
            distance = np.sqrt((difference * difference).sum(axis=1))
            near = np.arange(len(chosen))
            if len(chosen) > 2 * k:
                limit = np.partition(distance, k)[k]  # one more: a class may hold the query alone
                near = np.flatnonzero(distance <= limit)
            for n in near:
                for i in ids[chosen[n]]:
                    if i != query:
                        out.append((distance[n], int(i), int(query)))
        best, seen = [], {}
        for score, vec_id, query in sorted(out):
            if seen.get(query, 0) < k:
                seen[query] = seen.get(query, 0) + 1
                best.append((query, vec_id, score))
        return pd.DataFrame(best, columns=["query_id", "vec_id", "score"])

    by_block = asked.groupBy(*KEYS).cogroup(stored.groupBy(*KEYS))
    return by_block.applyInPandas(search, "query_id long, vec_id long, score double")


def _extended(batch, number, block, bucket):
    return pa.RecordBatch.from_arrays(
        [
            *batch.columns,
            pa.array(np.full(batch.num_rows, number), pa.int32()),
            pa.array(block, pa.int64()),
            pa.array(bucket, pa.int64()),
        ],
        names=[*batch.schema.names, "table_no", "block", "bucket"],
    )
