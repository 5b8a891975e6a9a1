"""N-gram Jaccard join: documents linked by similar shingle sets, as components.

1. Each document becomes its set of hashed word shingles. Documents with the same
   set are one node from here on, however many they are.
2. Blocking by pigeonhole. Two sets of similar size that reach the threshold differ
   in at most d elements. The hash range is cut into more than d parts, so at least
   one part is the same in both, and with spare parts more than those. A key is the
   content of one part for one size class. A set gives up as many keys as it has
   spare parts, in one order for all sets: empty parts first, then those that hold only
   shingles known to be common, then the keys that most of all sets have. So the last
   in that order of the keys that two similar sets share is given up by neither, and a
   passage that many documents share makes no key. Nodes that share one of their other
   keys, directly or over others, form a family.
3. Inside a family: grouped prefix join. Elements are ordered rarest first, and
   nodes with identical prefixes and size are collapsed into one group; groups
   meet over an index of prefix elements, pairs of groups are filtered by size and
   position, then expanded, and their members verified exactly. Families beyond
   ``BLOCK`` nodes are joined block against block in separate tasks; what leaves a
   task are links that join two parts, at most one per node, never all pairs.
4. Components of the links, brought back to the documents.

Hashes have 64 bits. Null texts and texts without words have the empty set: size
0, linked with nothing, a component of their own. Repeated rows are copies of each
other. A null id never becomes a component's id. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytehash import mix, per_row, portions, shingles
from tidemark.llm.graph import components, stored

BLOCK = 1024  # nodes of a family that one side of a task holds
SAMPLE = 4096  # texts, and
COMMON = 65_536  # shingles at most, that tell which keys are given up first
BITS = 24  # of a hash of rows that are looked for; one bit of a broadcast for each of their values
NONE = np.zeros(0, np.uint64)
BLOCK_SHINGLES = 1_500_000  # and their shingles; a task has two sides, and under 100 bytes a shingle at its peak


def parts_of(size_class: int, percent: int) -> tuple[int, int]:
    """(number of parts, spare parts) for pairs whose smaller set is of a class.

    Sets x, y with 100 |x and y| >= percent |x or y| differ in at most
    (|x| + |y|) (100 - percent) / (100 + percent) elements, and the larger one has at
    most 100 / percent as many as the smaller: |x| (100 - percent) / percent together.
    There are spare parts for nearly all sets' empty ones, and others for passages that
    many documents share.
    """
    top = (100 / percent) ** (size_class + 1)
    most = math.floor(top * (100 - percent) / percent + 1e-6)
    empty = (most + 1) * math.exp(-(percent**2) / (100 * (100 - percent)))  # of the smallest sets of the class
    spare = int(1.25 * empty + 1.5 * math.sqrt(empty) + 1) + most // 4 if most else 0
    return most + 1 + spare, spare


def size_class(n: int, percent: int) -> int:
    return int(math.log(n) / math.log(100 / percent) + 1e-9)


def keys(tokens: np.ndarray, percent: int, common: np.ndarray = NONE) -> np.ndarray:
    """Blocking keys of a sorted set: for pairs in which it is the larger one of the next class below, and for those of its own.

    The smaller set of a pair that reaches the threshold gives the class, and the larger
    one is of that class or the next. More parts than the spare ones are the same in
    both. Empty parts, and those that hold only ``common`` (sorted) tokens, are left out
    while there are no more of them than spare parts; then at least one of the others is
    among the same ones. Else the empty ones alone are left out, as far as spare parts go.
    The lowest bit of a key tells the class (odd or even), the next one if its part has
    only ``common`` tokens.
    """
    own = size_class(len(tokens), percent)
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(mix(tokens), out=sums[1:])
    rare = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum(common[np.searchsorted(common[:-1], tokens)] != tokens if len(common) else np.ones(len(tokens), bool), out=rare[1:])
    high = tokens >> np.uint64(32)
    found = []
    for c in (own - 1, own):
        m, spare = parts_of(c, percent)
        cuts = np.searchsorted((high * np.uint64(m)) >> np.uint64(32), np.arange(m + 1))
        key = mix(mix(sums[cuts[1:]] - sums[cuts[:-1]] + np.arange(m, dtype=np.uint64)) + np.uint64((c + 1) * 0x9E3779B97F4A7C15 % 2**64))
        telling, full = rare[cuts[1:]] > rare[cuts[:-1]], cuts[1:] > cuts[:-1]
        key = key & np.uint64(2**64 - 4) | np.uint64(c & 1) | (~telling).astype(np.uint64) << np.uint64(1)
        if m - telling.sum() <= spare:
            key = key[telling]
        else:
            key = np.concatenate([key[full], np.sort(key[~full])[spare:]])
        found.append(key)
    return np.concatenate(found)


def surplus(found: np.ndarray, n: int, percent: int) -> list[int]:
    """How many of the ``keys`` of a set of ``n`` its spare parts still allow to give up: of even classes, of odd ones."""
    own, left = size_class(n, percent), [0, 0]
    for c in (own - 1, own):
        m, spare = parts_of(c, percent)
        left[c & 1] = int(np.count_nonzero(found & np.uint64(1) == np.uint64(c & 1))) - (m - spare)
    return left


def node_of(tokens: np.ndarray) -> int:
    """One hash for a whole set."""
    return int(mix(np.array([mix(tokens).sum(dtype=np.uint64)]) + np.uint64(len(tokens)))[0].view(np.int64))


def common_shingles(docs: DataFrame, k: int, text_col: str) -> np.ndarray:
    """Hashes, sorted, that occur in two or more of about ``SAMPLE`` different texts, the most frequent ones.

    Any hashes give the same links; these keep unlike texts in different families.
    """
    texts = docs.select(F.col(text_col).alias("text")).where("text is not null").withColumn("h", F.xxhash64("text"))
    share = max(1, docs.count() // SAMPLE)
    # A text that many rows hold is taken once.
    some = texts.where(F.pmod("h", F.lit(share)) == 0).groupBy("h").agg(F.first("text").alias("text")).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 0):
                for tokens in per_row(*shingles(part.column(0), k), part.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], ["token"])

    counts = some.mapInArrow(run, "token long").groupBy("token").count().where("count > 1")
    found = counts.orderBy(F.desc("count"), "token").limit(COMMON).select("token").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))


def signatures(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """id, spot (hash of id and text), set size, node (hash of the set; null if empty), the node's keys and their ``surplus``.

    A task gives the keys of a node once; copies that follow have none.
    """
    common = common_shingles(docs, k, text_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in portions(batch, 1):
                sizes, nodes, found, left = [], [], [], []
                for tokens in per_row(*shingles(part.column(1), k), part.num_rows):
                    sizes.append(len(tokens))
                    node = node_of(tokens) if len(tokens) else None
                    nodes.append(node)
                    if node is None or node in seen:
                        found.append([])
                        left.append((None, None))
                        continue
                    own = keys(tokens, percent, common)
                    found.append(own.view(np.int64))
                    left.append(surplus(own, len(tokens), percent))
                    seen.add(node)
                lists = [pa.array(found, pa.list_(pa.int64())), *(pa.array([x[i] for x in left], pa.int32()) for i in (0, 1))]
                arrays = [part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "spot", "n", "node", "keys", "left0", "left1"])

    out = f"id {kind}, spot long, n long, node long, keys array<long>, left0 int, left1 int"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), spot_of(id_col, text_col)).mapInArrow(run, out)


def spot_of(id_col: str, text_col: str) -> Column:
    """A hash of a row's id and text, by which the text of a node is found again, whatever its id."""
    return F.xxhash64(F.col(id_col), F.col(text_col)).alias("spot")


def key_links(keyed: DataFrame, left: DataFrame) -> DataFrame:
    """(a, b) for nodes that share a key which neither gives up; ``keyed`` has node and key, ``left`` node, left0 and left1.

    Keys are given up in one order for all nodes, the most frequent of all texts first.
    Keys of one node only are the rarest and link nothing, so no more is done with them.
    """
    each = Window.partitionBy("key")
    seen = keyed.select("node", "key", F.count(F.lit(1)).over(each).alias("times"), F.min("node").over(each).alias("low"), F.max("node").over(each).alias("high"))
    # Several tasks may give the keys of a node.
    shared = seen.where("low <> high").select("node", "key", "times").join(left, "node").dropDuplicates(["node", "key"])
    odd, common = F.col("key").bitwiseAND(F.lit(1)), F.col("key").bitwiseAND(F.lit(2))
    order = Window.partitionBy("node", odd).orderBy(common.desc(), F.desc("times"), "key")
    given = F.row_number().over(order) <= F.when(odd == 0, F.col("left0")).otherwise(F.col("left1"))
    kept = shared.withColumn("given", given).where("not given")
    return kept.select("node", F.min("node").over(each).alias("head")).where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))


def likely_among(rows: DataFrame, members: DataFrame, spot: str = "spot") -> DataFrame:
    """``rows`` with ``likely``: false only if no ``members`` row has that spot, true if one has its lower ``BITS`` bits.

    The bits are sent to the tasks, 2 MB at most, so that other rows need no shuffle.
    """
    low = F.pmod(spot, F.lit(1 << BITS))
    maps = members.groupBy(F.shiftright(low, 15).alias("bucket")).agg(F.bitmap_construct_agg(low.bitwiseAND(F.lit(32767))).alias("map"))
    bits = np.zeros(1 << BITS - 15, "V4096")
    for r in maps.collect():
        bits[r["bucket"]] = bytes(r["map"])
    shared = rows.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    # Only the hashes go to Python.
    @F.pandas_udf("boolean")
    def likely(at: pd.Series) -> pd.Series:
        return pd.Series((shared.value[at.to_numpy() >> 3] >> (at.to_numpy() & 7)) & 1 == 1)

    return rows.withColumn("likely", likely(low))


class Links:
    """Union-find over the rows of one task; remembers the links that joined two parts."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))
        self.made: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[b] = a
            self.made.append((i, j))


def grouped_prefix_join(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all sets connected by similar pairs, at most one per set.

    With ``side``, only pairs of different sides are looked at. Pairs that are
    already connected need no verification.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, count))] = np.arange(len(values))  # rarest first
    starts = np.concatenate([[0], np.cumsum(size)])
    flat = rank[place].astype(np.int32)
    del rank, place
    ranked = np.split(flat, starts[1:-1])  # views of one array
    for r in ranked:
        r.sort()
    least = -(-size * percent // 100)  # elements that a partner must share at least
    prefix = size - least + 1

    groups: dict[tuple[int, bytes], list[int]] = defaultdict(list)
    for i in range(n):
        groups[int(size[i]), ranked[i][: prefix[i]].tobytes()].append(i)
    members = [np.array(g) for _, g in sorted(groups.items())]  # by size
    links, index = Links(n), defaultdict(list)
    held = np.zeros(len(values), bool)
    for g, group in enumerate(members):
        head = int(group[0])
        s, p = int(size[head]), ranked[head][: prefix[head]]
        met: dict[int, int] = {}
        for at, token in enumerate(p.tolist()):
            for packed in index[token]:
                other, there = packed >> 32, packed & 0xFFFFFFFF
                small = int(size[members[other][0]])
                if small * 100 < percent * s:
                    continue
                # What can still be shared, from the first common element on.
                need = -(-percent * (small + s) // (100 + percent))
                if other not in met:
                    met[other] = 1 if min(s - at, small - there) >= need else 0
            index[token].append(g << 32 | at)
        near = [members[o] for o, ok in met.items() if ok]
        if len(group) > 1:
            near.append(group)
        if not near:
            continue
        others = np.concatenate(near)
        for i in group.tolist():
            mine = links.root(i)
            todo = [j for j in others.tolist() if j != i and links.root(j) != mine and (side is None or side[j] != side[i])]
            if not todo:
                continue
            held[ranked[i]] = True
            todo_at = np.array(todo)
            lengths = size[todo_at]
            spots = np.repeat(starts[todo_at] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            shared = np.add.reduceat(held[flat[spots]].astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
            held[ranked[i]] = False
            union = size[i] + lengths - shared
            for j in todo_at[100 * shared >= percent * union].tolist():
                links.join(i, j)
    return links.made


def links_in_families(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes; ``members`` has node, n, family and a spot of each, ``texts`` spot and text."""
    per_class = members.withColumn("c", F.floor(F.log("n") / math.log(100 / percent) + 1e-9))
    whole = members.groupBy("family").agg(F.count(F.lit(1)).alias("f_n"), F.sum("n").alias("f_s"))
    one = (F.col("f_n") <= BLOCK) & (F.col("f_s") <= BLOCK_SHINGLES)
    counts = per_class.join(whole, "family").where(~one).groupBy("family", "c").agg(F.count(F.lit(1)).alias("c_n"), F.sum("n").alias("c_s"))
    blocks = counts.select("family", "c", F.ceil(F.greatest(F.col("c_n") / BLOCK, F.col("c_s") / BLOCK_SHINGLES)).cast("long").alias("nb"))
    before = blocks.select("family", (F.col("c") + 1).alias("c"), F.col("nb").alias("nb_before"))
    after = blocks.select("family", (F.col("c") - 1).alias("c"), F.col("nb").alias("nb_after"))
    plan = blocks.join(before, ["family", "c"], "left").join(after, ["family", "c"], "left").na.fill(0, ["nb_before", "nb_after"])
    placed = per_class.join(plan, ["family", "c"], "left").withColumn("mine", F.pmod(F.xxhash64("node"), F.coalesce("nb", F.lit(1))))
    # The tasks a node takes part in: (class, block) against (class, block), the lower one first.
    span = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))
    c, mine = F.col("c"), F.col("mine")
    spot = lambda c1, i, c2, j: F.struct(c1.alias("c1"), i.alias("i"), c2.alias("c2"), j.alias("j"))
    tasks = F.concat(
        F.transform(span(F.col("nb")), lambda j: spot(c, F.least(mine, j), c, F.greatest(mine, j))),
        F.transform(span(F.col("nb_after")), lambda j: spot(c, mine, c + 1, j)),
        F.transform(span(F.col("nb_before")), lambda j: spot(c - 1, j, c, mine)),
    )
    alone = F.array(spot(F.lit(-1).cast("long"), F.lit(0).cast("long"), F.lit(-1).cast("long"), F.lit(0).cast("long")))
    rows = placed.select("node", "spot", "family", "c", "mine", F.explode(F.when(F.col("nb").isNull(), alone).otherwise(tasks)).alias("task"))
    # Which side of its task a node is on; null where the task is one block with itself.
    same = (F.col("task.c1") == F.col("task.c2")) & (F.col("task.i") == F.col("task.j"))
    second = (F.col("c") == F.col("task.c2")) & (F.col("mine") == F.col("task.j"))
    rows = rows.select("node", "spot", F.xxhash64("family", "task").alias("task"), F.when(~same, second).alias("second"))

    def run(table: pa.Table) -> pa.Table:
        # The arrays behind shingles are many times as large as their text: a few texts at a time.
        parts = [p for b in table.select(["text"]).to_batches() for p in portions(b, 0)]
        sets = [s for p in parts for s in per_row(*shingles(p.column(0), k), p.num_rows)]
        nodes, second = table.column("node").to_pylist(), table.column("second").to_pylist()
        del table, parts
        # Two texts may share a hash: only a node's own text stands for it.
        chosen = [i for i, s in enumerate(sets) if len(s) and node_of(s) == nodes[i]]
        sets = [sets[i] for i in chosen]
        side = None if any(second[i] is None for i in chosen) else np.array([second[i] for i in chosen], bool)
        made = grouped_prefix_join(sets, percent, side) if len(sets) > 1 else []
        ends = [pa.array([nodes[chosen[m[e]]] for m in made], pa.int64()) for e in (0, 1)]
        return pa.table(ends, ["a", "b"])

    # One text per spot, folded before the shuffle: rows that repeat id and text are no more than one. A merge
    # join at every size: the plan does not change as the families grow.
    single = likely_among(texts, members).where("likely").groupBy("spot").agg(F.first("text").alias("text"))
    return single.join(rows.hint("merge"), "spot").select("node", "task", "second", "text").groupBy("task").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id (the smallest id reachable by links) of every row.

    Two documents link when 100 * |intersection| >= percent * |union| of their
    sets of ``k``-word shingles.
    """
    # Made twice: the keys of all sets are several times as large as all else, and are on disk once this way.
    found = signatures(docs, k, percent, id_col, text_col)
    sets = stored(found.drop("keys"), "shingle-sets")
    # A null id is the last choice, but a node of null ids only has its text and its links, too.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "spot")).alias("first")
    nodes = sets.where("node is not null").groupBy("node").agg(first, F.first("n").alias("n"), F.max("left0").alias("left0"), F.max("left1").alias("left1"))
    nodes = nodes.select("node", "n", F.col("first.id").alias("rep"), F.col("first.spot").alias("spot"), "left0", "left1")
    keyed = found.where("size(keys) > 0").select("node", F.explode("keys").alias("key"))
    families = components(key_links(keyed, nodes.select("node", "left0", "left1")))
    nodes = nodes.drop("left0", "left1")
    members = families.withColumnRenamed("label", "family").join(nodes.drop("rep"), "node")
    texts = docs.select(spot_of(id_col, text_col), F.col(text_col).alias("text"))
    links = links_in_families(stored(members, "families"), texts, k, percent)
    labels = components(links).withColumnRenamed("label", "component")
    lowest = labels.join(nodes, "node").groupBy("component").agg(F.min("rep").alias("lowest"))
    reached = labels.join(lowest, "component").select("node", "lowest")
    by_node = nodes.join(reached, "node", "left").select("node", F.coalesce("lowest", "rep").alias("component_id"))
    return sets.select("id", "n", "node").join(by_node, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )


def one_per_group(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is their component's, columns as they were.

    Rows with that id and the same text are copies too: one of them stays.
    """
    found = near_duplicates(docs, k, percent, id_col, text_col).where(F.col(id_col).isNotNull())
    ids = found.groupBy(id_col).agg(F.count(F.lit(1)).alias("times"), F.max(F.col(id_col) == F.col("component_id")).alias("keep"))
    ids = stored(ids.select(F.col(id_col).alias("__keep"), "times", "keep"), "kept-ids")
    # Most documents have an id of their own and stay: only the others are shuffled.
    other = ids.where("times > 1 or not keep").select(F.xxhash64("__keep").alias("__spot"))
    rows = likely_among(docs.where(F.col(id_col).isNotNull()).withColumn("__spot", F.xxhash64(id_col)), other, "__spot").drop("__spot")
    alone, some = (rows.where(c).drop("likely") for c in ("not likely", "likely"))
    some = some.join(ids.where("keep"), F.col(id_col) == F.col("__keep"), "left_semi").dropDuplicates([id_col, text_col])
    return alone.unionByName(some).unionByName(docs.where(F.col(id_col).isNull()))
