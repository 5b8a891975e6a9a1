"""Approximate nearest neighbours over balanced posting lists.

1. Equal vectors are one node with its smallest ids, however many rows they have.
2. Centroids come from a bounded sample, chosen by a hash: clusters are split until all
   are small, so that posting lists are about equally long. Their number grows with the
   data up to ``MAX_CENTROIDS``, which bounds what is sent to the tasks.
3. Every node is put into the list of its nearest centroid; one near a boundary, where
   others are at most ``CLOSE`` times as far, also into theirs, up to ``REPLICAS``.
   Centroids are searched over a neighbour graph held in memory.
4. A query takes the lists whose centroid is at most a ratio times as far as the nearest,
   however many: where the search over the graph does not get beyond the ratio, all
   centroids are measured. The ratio is fitted: sampled vectors whose neighbours in the sample are known must find
   ``TARGET`` of them. Where data have no clusters it becomes large, and most lists are
   read; it never gives recall away. More lists are read while these hold too few vectors.
5. Lists go to tasks in bundles of bounded size, lists of near centroids together; a vector
   goes once to a bundle, however many of its lists are there, and so does a query. A task
   compares its queries with the lists they chose, by matrix products, and gives out the best
   of each query; exact distances in double precision decide, ties go to the smaller id.

Vectors that are null, zero, or hold a null or a non-finite component take no part;
nor do rows without an id, or of another length than the most frequent one.
Repeated rows are candidates of their own; a query that is repeated is answered
once. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import discard, stored
from tidemark.session import scratch_path

LIST = 100  # vectors that a list should hold
MAX_CENTROIDS = 8192
SAMPLE_PER_CENTROID = 24
SAMPLE_DOUBLES = 1 << 24  # bound of the sample: 128 MB on the driver
REPLICAS = 4
CLOSE = 1.1  # a replica's centroid may be so many times as far as the nearest
TARGET = 0.9  # share of known neighbours that the fitted ratio must find
FITTED = 256  # sampled vectors that the ratio is fitted on
DEGREE = 24
BEAM = 24  # of a query at first
POST_BEAM = 8  # of a vector to be posted
AHEAD = 4  # centroids of a beam that a step looks behind at once
BUNDLE = 20_000  # entries of lists that a task holds
QUERIES = 2_000  # queries that are compared with them at once,
ROUND = 20_000  # and queries that a task holds


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``; small negative errors are cut."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def balanced_centroids(sample: np.ndarray, leaf: int, seed: int = 7) -> np.ndarray:
    """Means of clusters of at most ``leaf`` sampled vectors each."""
    rng = np.random.default_rng(seed)
    found, work = [], [np.arange(len(sample))]
    while work:
        rows = work.pop()
        if len(rows) <= leaf:
            found.append(sample[rows].mean(0))
            continue
        k = min(8, -(-len(rows) // leaf))
        centres = sample[rng.choice(rows, k, replace=False)]
        for _ in range(8):
            near = distances(sample[rows], centres).argmin(1)
            for c in range(k):
                if (near == c).any():
                    centres[c] = sample[rows[near == c]].mean(0)
        parts = [rows[near == c] for c in range(k) if (near == c).any()]
        if len(parts) == 1:
            parts = np.array_split(rows, k)
        work += parts
    return np.array(found)


@dataclass
class Graph:
    """Centroids, their neighbours, and where a search starts."""

    points: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @staticmethod
    def over(points: np.ndarray, degree: int = DEGREE, seed: int = 7) -> Graph:
        n = len(points)
        rng = np.random.default_rng(seed)
        near = min(degree, n - 1)
        links = np.empty((n, near + min(4, n)), np.int64)
        for at in range(0, n, 1024):
            d = distances(points[at : at + 1024], points)
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            links[at : at + 1024, :near] = np.argpartition(d, max(near - 1, 0), axis=1)[:, :near]
        links[:, near:] = rng.integers(0, n, (n, links.shape[1] - near))  # a few far links keep it connected
        entries = rng.choice(n, min(n, max(64, int(2 * n**0.5))), replace=False)
        return Graph(points, links, entries)

    def search(self, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of each query's beam, nearest first; best-first, all queries in step."""
        n = len(self.points)
        beam = min(beam, n)
        d = distances(queries, self.points[self.entries])
        keep = min(beam, d.shape[1])
        first = np.argsort(d, axis=1, kind="stable")[:, :keep]
        ids = np.full((len(queries), beam), -1)
        best = np.full((len(queries), beam), np.inf)
        ids[:, :keep], best[:, :keep] = self.entries[first], np.take_along_axis(d, first, 1)
        done = np.zeros(ids.shape, bool) | (ids < 0)
        rows = np.arange(len(queries))
        while len(rows):
            # The nearest that nothing was looked behind of yet, a few at once.
            open_first = np.argsort(done[rows], axis=1, kind="stable")[:, :AHEAD]
            alive = ~done[rows, open_first[:, 0]]
            rows, open_first = rows[alive], open_first[alive]
            if not len(rows):
                break
            ahead = np.where(done[rows[:, None], open_first], open_first[:, :1], open_first)
            done[rows[:, None], ahead] = True
            new = self.links[ids[rows[:, None], ahead]].reshape(len(rows), -1)
            gap = self.points[new] - queries[rows][:, None, :]
            nd = np.einsum("qkd,qkd->qk", gap, gap)
            all_ids = np.concatenate([ids[rows], new], axis=1)
            all_d = np.concatenate([best[rows], nd], axis=1)
            all_done = np.concatenate([done[rows], np.zeros(new.shape, bool)], axis=1)
            # The same centroid may come again: keep its first, which knows if it was expanded.
            order = np.argsort(all_ids, axis=1, kind="stable")
            by_id = np.take_along_axis(all_ids, order, 1)
            again = np.zeros(by_id.shape, bool)
            again[:, 1:] = by_id[:, 1:] == by_id[:, :-1]
            twice = np.zeros_like(again)
            np.put_along_axis(twice, order, again, 1)
            all_d[twice] = np.inf
            top = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            ids[rows] = np.take_along_axis(all_ids, top, 1)
            best[rows] = np.take_along_axis(all_d, top, 1)
            done[rows] = np.take_along_axis(all_done, top, 1) | np.isinf(best[rows])
        return ids, np.sqrt(best)

    def within(self, queries: np.ndarray, ratio: float, held: np.ndarray, least: int) -> list[np.ndarray]:
        """The lists of each query: those within the ratio, and more while they hold too few vectors.

        All centroids are measured for the queries whose search has not gone beyond the ratio:
        a beam that holds a share of them costs more, by its square.
        """
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        todo = np.arange(len(queries))
        for everything in (False, True):
            left = []
            for part in np.array_split(todo, -(-len(todo) // 256)) if len(todo) else []:
                for q, row, far in zip(part.tolist(), *(self.measured(queries[part]) if everything else self.search(queries[part]))):
                    row, far = row[row >= 0], far[: (row >= 0).sum()]
                    n = max(int(np.searchsorted(far, ratio * far[0], "right")), int(np.searchsorted(np.cumsum(held[row]), least)) + 1)
                    if n < len(row) or everything:
                        out[q] = row[:n] if held[row[:n]].sum() >= least else np.flatnonzero(held)
                    else:
                        left.append(q)
            todo = np.array(left, np.int64)
        return out

    def measured(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of each query, all of them, nearest first."""
        d = distances(queries, self.points)
        ids = np.argsort(d, axis=1, kind="stable")
        return ids, np.sqrt(np.take_along_axis(d, ids, 1))


@dataclass
class Bundles:
    """Where lists are compared: each in the bundle of its neighbours, a long one in several of its own."""

    first: np.ndarray
    parts: np.ndarray

    @staticmethod
    def of(entries: np.ndarray) -> Bundles:
        """For the number of entries of each list; a bundle has about ``BUNDLE``, twice as many at most."""
        parts = np.maximum(-(-entries // BUNDLE), 1)
        short = parts == 1
        place = (np.cumsum(np.where(short, entries, 0)) - np.where(short, entries, 0)) // BUNDLE
        after = np.cumsum(np.where(short, 0, parts)) - np.where(short, 0, parts)
        return Bundles(np.where(short, place, (int(place[short].max()) + 1 if short.any() else 0) + after), parts)

    def __len__(self) -> int:
        return int((self.first + self.parts).max())

    def split(self, lists: pa.ListArray, node: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
        """(row, bundle, lists there) of what has these lists: a vector, by its hash, or a query, which asks all parts of a list."""
        flat = lists.flatten().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
        if node is None:
            times = self.parts[flat]
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            flat, row = np.repeat(flat, times), np.repeat(row, times)
        else:
            part = np.mod(node[row], self.parts[flat])
        bundle = self.first[flat] + part
        order = np.lexsort((flat, bundle, row))
        flat, row, bundle = flat[order], row[order], bundle[order]
        fresh = np.ones(len(flat), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (bundle[1:] != bundle[:-1])
        begin = np.flatnonzero(fresh)
        offsets = np.append(begin, len(flat)).astype(np.int32)
        return row[begin], bundle[begin], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def lists_of(ids: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
    """The lists of each vector: the nearest, and near ones where it lies at a boundary."""
    n = (d[:, :REPLICAS] <= CLOSE * d[:, :1]).sum(axis=1)
    return [row[:k] for row, k in zip(ids, np.maximum(n, 1).tolist())]


def fitted_ratio(graph: Graph, sample: np.ndarray, k: int) -> float:
    """The distance ratio within which the sample's vectors find ``TARGET`` of their neighbours in the sample.

    A neighbour is found if one of its lists is within the ratio of the query. The sample
    is sparser than the data, its neighbours are farther apart, so the ratio is no smaller
    than needed for the data.
    """
    asked = sample[: min(FITTED, len(sample))]
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1.0
    d = distances(asked, sample)
    d[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    places, inverse = np.unique(near, return_inverse=True)
    homes = lists_of(*graph.search(sample[places], POST_BEAM))
    to = np.sqrt(distances(asked, graph.points))
    to /= np.maximum(to.min(axis=1), 1e-300)[:, None]
    inverse = inverse.reshape(near.shape)
    need = [to[q, homes[p]].min() for q in range(len(asked)) for p in inverse[q]]
    return float(np.quantile(need, TARGET, method="higher")) * (1 + 1e-9)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part; v holds floats if the vectors do, else doubles."""
    v = F.col("v")
    floats = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>" if floats else "array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("v") == (sizes["size"] if sizes else 0))


def _rows(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy().reshape(len(lists), -1).astype(np.float64)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, id and score of the ``k`` nearest found of every row that ``is_query`` (a condition on ``id``)."""
    spark = vectors.sparkSession
    id_kind = vectors.schema[id_col].dataType.simpleString()
    rows = usable(vectors, id_col, vector_col)
    v_kind = rows.schema["v"].dataType.simpleString()
    hashed = F.xxhash64(F.col("v").cast("array<double>"))
    # The k + 1 smallest ids of each vector: no answer needs more. The limit is also applied before the shuffle.
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    nodes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("node", hashed)
    folder, schema = scratch_path(spark, "vectors"), nodes.schema
    nodes.write.parquet(folder)
    nodes = spark.read.schema(schema).parquet(folder)
    n = nodes.count()
    empty = spark.createDataFrame([], f"query_id {id_kind}, rank int, `{id_col}` {id_kind}, score double")
    if not n:
        return empty
    asked = rows.where(is_query).distinct()
    count = int(min(MAX_CENTROIDS, max(1, n // LIST)))
    size = int(nodes.agg(F.max(F.size("v"))).first()[0])
    wanted_rows = min(count * SAMPLE_PER_CENTROID, max(2, SAMPLE_DOUBLES // size))
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    drawn = nodes.where(place < int(min(1.0, wanted_rows / n) * (1 << 30)) + 1).orderBy(F.xxhash64("node"), "node").select("v").toArrow()
    if not drawn.num_rows:
        drawn = nodes.limit(1).select("v").toArrow()
    sample = _rows(drawn.combine_chunks().to_batches()[0], "v")
    graph = Graph.over(balanced_centroids(sample, max(1, -(-len(sample) // count))))
    ratio = fitted_ratio(graph, sample, k)
    shared = spark.sparkContext.broadcast(graph)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                lists = pa.array(lists_of(*graph.search(_rows(part, "v"), POST_BEAM)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "lists"])

    posted = stored(nodes.mapInArrow(post, f"v {v_kind}, ids array<{id_kind}>, node long, lists array<int>"), "postings")
    discard(spark, folder)  # the postings have all of it
    # Two counts per centroid.
    held, total = np.zeros(len(graph.points), np.int64), np.zeros(len(graph.points), np.int64)
    for found, chosen in ((held, F.array(F.get("lists", F.lit(0)))), (total, F.col("lists"))):
        counts = dict(posted.select(F.explode(chosen).alias("list")).groupBy("list").count().collect())
        found[list(counts)] = list(counts.values())
    bundles = Bundles.of(total)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                lists = pa.array(graph.within(_rows(part, "v"), ratio, held, k + 1), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "lists"])

    wanted = asked.groupBy("v").agg(F.count(F.lit(1)).alias("n")).select(hashed.alias("q"), "v")
    wanted = stored(wanted.mapInArrow(ask, f"q long, v {v_kind}, lists array<int>"), "asked")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(bundles), np.int64)
        for batch in batches:
            n += np.bincount(bundles.split(batch.column("lists"))[1], minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], ["bundle", "n"])

    asking = np.zeros(len(bundles), np.int64)
    for r in wanted.select("lists").mapInArrow(count, "bundle long, n long").groupBy("bundle").agg(F.sum("n").alias("n")).collect():
        asking[r["bundle"]] = r["n"]
    blocks = -(-asking // ROUND)  # none where nobody asks

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                row, bundle, lists = bundles.split(part.column("lists"), part.column("node").to_numpy())
                at = np.repeat(np.arange(len(row)), blocks[bundle])
                block = np.arange(len(at)) - np.searchsorted(at, at)
                row = pa.array(row[at])
                columns = [pa.array(bundle[at]), pa.array(block), *(part.column(c).take(row) for c in ("node", "first", "v")), lists.take(pa.array(at))]
                yield pa.RecordBatch.from_arrays(columns, ["bundle", "block", "node", "first", "v", "lists"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                row, bundle, lists = bundles.split(part.column("lists"))
                key = part.column("q").to_numpy()[row]
                columns = [pa.array(x) for x in (bundle, np.mod(key, blocks[bundle]), key)]
                yield pa.RecordBatch.from_arrays([*columns, part.column("v").take(pa.array(row)), lists], ["bundle", "block", "q", "v", "lists"])

    entries = posted.select("node", F.col("ids")[0].alias("first"), "v", "lists").mapInArrow(spread, f"bundle long, block long, node long, first {id_kind}, v {v_kind}, lists array<int>")
    sent = wanted.mapInArrow(send, f"bundle long, block long, q long, v {v_kind}, lists array<int>")

    def compare(posts: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["q", "node", "first", "score"]
        first = posts.column("first").combine_chunks()
        if not posts.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), first[:0], pa.array([], pa.float64())], names)
        posts, queries = posts.combine_chunks().to_batches()[0], queries.combine_chunks().to_batches()[0]
        points, node, own = _rows(posts, "v"), posts.column("node").to_numpy(), posts.column("lists")
        row = np.repeat(np.arange(len(points)), own.value_lengths().to_numpy())
        lists, out = own.flatten().to_numpy(), []
        for part in (queries.slice(i, QUERIES) for i in range(0, queries.num_rows, QUERIES)):
            at, far = best_in_lists(points, lists, node, _rows(part, "v"), part.column("lists"), k + 1, row)
            rows = np.concatenate(at)
            q = np.repeat(part.column("q").to_numpy(), [len(a) for a in at])
            out.append(pa.table([pa.array(q), pa.array(node[rows]), first.take(pa.array(rows)), pa.array(np.concatenate(far))], names))
        return pa.concat_tables(out)

    pairs = entries.groupBy("bundle", "block").cogroup(sent.groupBy("bundle", "block")).applyInArrow(compare, f"q long, node long, first {id_kind}, score double")
    pairs = pairs.groupBy("q", "node").agg(F.min("first").alias("first"), F.min("score").alias("score"))
    # No answer needs more nodes than k + 1, by distance and their smallest ids: only these meet their other ids.
    few = F.row_number().over(Window.partitionBy("q").orderBy("score", "first"))
    pairs = pairs.withColumn("r", few).where(F.col("r") <= k + 1).drop("r", "first")
    found = pairs.join(posted.select("node", F.explode("ids").alias("id")), "node")
    order = [F.col("score"), F.col("id")]
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("r") <= k + 1)
    queries = asked.select(F.col("id").alias("query_id"), hashed.alias("q"))
    # One row with the query's own id and vector is the query itself.
    own = F.row_number().over(Window.partitionBy("query_id", "q", "id").orderBy("score"))
    pairs = queries.join(best, "q").withColumn("own", (F.col("id") == F.col("query_id")) & (F.col("score") == 0) & (own == 1)).where("not own")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "q").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def best_in_lists(
    points: np.ndarray, lists: np.ndarray, node: np.ndarray, asked: np.ndarray, wanted: pa.ListArray, k: int, row: np.ndarray | None = None
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(rows of ``points``, exact distances) of each query's ``k`` nearest nodes in its lists, and all that tie with the last.

    ``lists`` has the list of each point, or of the points that ``row`` names.
    """
    order = np.argsort(lists, kind="stable")
    names, begin = np.unique(lists[order], return_index=True)
    members = dict(zip(names.tolist(), np.split(order if row is None else row[order], begin[1:])))
    flat = wanted.flatten().to_numpy()
    query = np.repeat(np.arange(len(asked)), wanted.value_lengths().fill_null(0).to_numpy())
    by_list = np.argsort(flat, kind="stable")
    held, start = np.unique(flat[by_list], return_index=True)
    # Products round: what may tie with the last, or be nearer, is measured exactly below.
    slack = 1e-12 * ((asked**2).sum(1) + (points**2).sum(1).max(initial=0))
    last = np.full(len(asked), np.inf)  # no more than this is the k-th of a list already seen
    qs, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for name, who in zip(held.tolist(), np.split(query[by_list], start[1:])):
        here = members.get(name)
        if here is None:
            continue
        d = distances(asked[who], points[here])
        near = d <= (last[who] + slack[who])[:, None]
        many = np.flatnonzero(near.sum(axis=1) > k)
        if len(many):
            last[who[many]] = np.minimum(last[who[many]], np.partition(d[many], k - 1, axis=1)[:, k - 1])
            near[many] = d[many] <= (last[who[many]] + slack[who[many]])[:, None]
        q, at = np.nonzero(near)
        qs.append(who[q])
        rows.append(here[at])
    q, at = np.concatenate(qs), np.concatenate(rows)
    order = np.lexsort((at, node[at], q))
    q, at = q[order], at[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (node[at[1:]] != node[at[:-1]])
    q, at = q[fresh], at[fresh]
    score = np.empty(len(q))
    for i in range(0, len(q), 1 << 16):
        score[i : i + (1 << 16)] = np.sqrt(((points[at[i : i + (1 << 16)]] - asked[q[i : i + (1 << 16)]]) ** 2).sum(1))
    ends = np.searchsorted(q, np.arange(len(asked) + 1))
    # The k-th score of each query, or its last.
    ranked = score[np.lexsort((score, q))]
    kth = np.minimum(ends[:-1] + k, ends[1:]) - 1
    limit = ranked[kth] if len(ranked) else np.zeros(len(asked))
    keep = score <= limit[q]
    cuts = np.searchsorted(q[keep], np.arange(1, len(asked)))
    return np.split(at[keep], cuts), np.split(score[keep], cuts)
