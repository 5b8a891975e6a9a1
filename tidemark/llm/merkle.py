"""A Merkle manifest of a table: a tree per source, a tree over the sources, and a proof per row.

1. A leaf is the hash of a row's fields. Only leaves travel, never texts.
2. Leaves are ranked inside their source without a window over it: a range sort gives
   each row its place, and one count per partition and source says where a source's
   ranks begin there.
3. The rank's base-16 digits are columns. Inside a block of 16**3 consecutive ranks they
   are grouped away one after the other, from the lowest on, and every group becomes a
   struct that holds its children. One partitioning serves all three groupings. The
   blocks' hashes are the leaves of the next tier, until every source is one node.
4. Downwards, a block's hash siblings are put in front of what lies above it. Blocks and
   what lies above them meet by grouping, and a transform and an explode per digit emit
   the proofs: no join.

A block holds at most 4,096 leaves whatever the size of its source, so no task depends on
a source's rows. Nodes: 16 consecutive ones (the last run: fewer, even one) become the
hash of their concatenation, as long as there is more than one node.

Any column may be null and is then written ``-``. Leaves ascend by id, null ids first;
rows that share an id follow their leaves, so repeated rows have a leaf each and proofs
that differ in place only. A null source is a source, the first. An empty table has no
proofs. Columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import stored

FAN = 16
DIGITS = 3  # digits of a rank that one block groups away: 4,096 leaves

PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field as it enters a leaf: its length in UTF-8 bytes, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return digest(*[field(f) for f in fields])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def siblings(path: Column) -> Column:
    """All siblings of a path in one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def ranked(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``rank`` (from 0, inside ``group``) and ``levels`` of the group's tree.

    The last part of the sort key is the row's place in the input, so that equal rows
    can lie in different partitions.
    """
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    placed = df.withColumn("__tie", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*keys, F.col("__tie")).sortWithinPartitions(*keys, F.col("__tie")).drop("__tie")
    # Partition and place in it, in one number.
    placed = stored(placed.withColumn("__at", F.monotonically_increasing_id()), "ranks")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    runs = placed.groupBy("__part", group).agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("__first"))
    # One row per partition and source: a source has no more of them than there are partitions.
    held = runs.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("__part", "n", "__first"))).alias("runs"))
    total = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["n"])
    levels = sum((F.when(total > FAN**k, 1).otherwise(0) for k in range(15)), F.lit(0))
    before = lambda r: F.aggregate("runs", F.lit(0).cast("long"), lambda s, x: s + F.when(x["__part"] < r["__part"], x["n"]).otherwise(0))
    held = held.select(F.col(group).alias("__group"), levels.alias("levels"), "runs")
    starts = held.select("__group", "levels", F.inline(F.transform("runs", lambda r: F.struct(r["__part"].alias("__p"), (before(r) - r["__first"]).alias("__shift")))))
    same = (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__group"))
    return placed.join(starts, same).select(*df.columns, (F.col("__at") + F.col("__shift")).alias("rank"), "levels")


def blocks(nodes: DataFrame, group: str, tier: int, payload: Sequence[str]) -> DataFrame:
    """(group, levels, rank, h, kids): each run of 16**3 nodes as one row of nested structs.

    ``nodes`` has group, levels, rank, h and the payload of the lowest structs.
    """
    digits = [f"d{i}" for i in range(DIGITS)]
    split = {d: F.shiftright("rank", 4 * i).bitwiseAND(FAN - 1).cast("int") for i, d in enumerate(digits)}
    df = nodes.withColumns(split).withColumn("rank", F.shiftright("rank", 4 * DIGITS)).repartition(group, "rank")
    inside = [F.col(c) for c in payload]
    for i, digit in enumerate(digits):
        left = digits[i + 1 :]
        kids = F.sort_array(F.collect_list(F.struct(F.col(digit).alias("d"), "h", *inside)))
        df = df.groupBy(group, "levels", "rank", *left).agg(kids.alias("kids"))
        joined = digest(F.array_join(F.transform("kids", lambda k: k["h"]), ""))
        # A tree that is one node already passes through.
        df = df.withColumn("h", F.when(F.col("levels") > DIGITS * tier + i, joined).otherwise(F.col("kids")[0]["h"]))
        inside = [F.col("kids")]
    return df


def tree(nodes: DataFrame, group: str, payload: Sequence[str]) -> list[DataFrame]:
    """The tiers of blocks over ranked nodes, lowest first; the last has one row per group."""
    nodes = stored(nodes, "leaves")
    top = nodes.agg(F.max("levels")).first()[0] or 0
    tiers = [stored(blocks(nodes, group, 0, payload), "tier")]
    for tier in range(1, -(-top // DIGITS)):
        below = tiers[-1].select(group, "levels", "rank", "h", F.col("rank").alias("below"))
        tiers.append(stored(blocks(below, group, tier, ["below"]), "tier"))
    return tiers


def opened(block_rows: DataFrame, group: str, tier: int, payload: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """One row per lowest node of the blocks, with ``path``: its siblings, level by level, up to the root.

    ``block_rows`` has ``path`` (what lies above the block) and the columns ``extra``, which are passed on.
    """
    df = block_rows.select(group, "levels", "path", "kids", *extra)
    for i in reversed(range(DIGITS)):
        hashes = F.transform("kids", lambda k: k["h"])
        step = lambda k, at: F.struct(
            k.alias("node"),
            F.array_join(F.slice(hashes, 1, at), "").alias("left"),
            F.array_join(F.slice(hashes, at + 2, FAN), "").alias("right"),
        )
        df = df.select(group, "levels", "path", *extra, F.inline(F.transform("kids", step)))
        up = F.concat(F.array(F.struct("left", "right")), F.col("path"))
        path = F.when(F.col("levels") > DIGITS * tier + i, up).otherwise(F.col("path"))
        inner = ["node.kids"] if i else ["node.h", *[f"node.{c}" for c in payload]]
        df = df.select(group, "levels", path.alias("path"), *extra, *inner)
    return df


def met(block_rows: DataFrame, above: DataFrame, group: str, extra: Sequence[str]) -> DataFrame:
    """Blocks with the path above them: both sides are put together by grouping on (group, rank)."""
    upper = above.select(group, "rank", "path", *extra)
    both = block_rows.drop("h").unionByName(upper, allowMissingColumns=True)
    one = [F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "path", *extra)]
    return both.groupBy(group, "rank").agg(*one)


def descended(tiers: Sequence[DataFrame], above: DataFrame, group: str, payload: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """The lowest nodes with their paths. ``above`` has (group, rank 0, path, extra) of every top block."""
    for tier in reversed(range(1, len(tiers))):
        nodes = opened(met(tiers[tier], above, group, extra), group, tier, ["below"], extra)
        above = nodes.withColumnRenamed("below", "rank")
    return opened(met(tiers[0], above, group, extra), group, 0, payload, extra)


def proofs(leaves: DataFrame, id_col: str, source_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """id, leaf, subroot, root and path of every row; ``leaves`` has the id, the source and ``leaf``.

    ``path`` lists the siblings left and right of the node on each level, from the leaf
    over the subroot to the root; ``fold(leaf, path)`` is the root. Columns in ``carry``
    are passed on. The two lists of hashes on a level have 15 digests at most.
    """
    spark = leaves.sparkSession
    own = [F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.col("leaf").alias("h")]
    rows = stored(leaves.select(*own, *[F.col(c).alias(f"__{i}") for i, c in enumerate(carry)]), "leaves")
    payload = ["__id", *[f"__{i}" for i in range(len(carry))]]
    tiers = tree(ranked(rows, "__source", ["__id", "h"]), "__source", payload)
    sources = tiers[-1].select(F.lit(0).alias("__all"), F.col("__source").alias("__name"), "h")
    upper = tree(ranked(sources, "__all", ["__name"]), "__all", ["__name"])
    top = upper[-1].select("h").first()
    root = F.lit(top["h"] if top else None).cast("string")
    start = spark.range(1).select(F.lit(0).alias("__all"), F.col("id").alias("rank"), F.array().cast(PATH).alias("path"))
    over = descended(upper, start, "__all", ["__name"], [])
    over = over.select(F.col("__name").alias("__source"), F.lit(0).cast("long").alias("rank"), "path", F.col("h").alias("subroot"))
    found = descended(tiers, over, "__source", payload, ["subroot"])
    passed = [F.col(f"__{i}").alias(c) for i, c in enumerate(carry)]
    return found.select(F.col("__id").alias(id_col), F.col("h").alias("leaf"), "subroot", root.alias("root"), "path", *passed)


# The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, capitals, capitals.lower())


def checked(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, and what becomes of the root where texts are tampered with.

    Rows whose id's crc32 is divisible by 5 are tampered with (a null id is not): their
    texts lose their capitals. ``folded_root`` is the root by that leaf and the siblings.
    """
    columns = [F.col(c) for c in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    # Only every fifth text is hashed twice.
    other = F.when(hit, leaf_of(*columns[:-1], lowered(columns[-1])))
    leaves = docs.select("doc_id", "source", leaf_of(*columns).alias("leaf"), other.alias("tampered"))
    rows = proofs(leaves, "doc_id", "source", ["tampered"])
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
