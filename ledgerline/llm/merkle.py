"""Merkle manifest of a table by a nested-struct rollup.

Leaves have a rank in their group. The rank's last digits (base 3) become
columns and are grouped away one after the other, the last digit first: each
grouping hashes a run of nodes and nests them in their parent's struct. Six
digits make a block of at most 729 nodes, one row that holds its whole subtree;
the blocks' own nodes are the leaves of the next rollup, until one is left a
group, and the groups' nodes are rolled up likewise. One exchange by block
serves all its six groupings.

Proofs go the other way: ``transform`` hands a node's siblings down to its
children level by level and ``explode`` emits the children. What a block's own
node has above it comes as a row with the block's key, and is grouped in with
the block's row: no join is needed, and no row grows with the table.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import global_prefix, small_side

FAN = 3
DIGITS = 6  # levels of a block
PROOF = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(names: list[str], text_col: str, text: Column) -> Column:
    return digest(*(field(text if c == text_col else F.col(c).cast("string")) for c in names))


def levels_of(count: Column) -> Column:
    """Number of levels above ``count`` nodes: the least d with FAN ** d >= count."""
    return sum((F.when(count > FAN ** d, 1).otherwise(0) for d in range(1, 40)), F.when(count > 1, 1).otherwise(0))


def roll_up(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, block, depth, node of every block of ``nodes`` (keys, rank, depth,
    node). ``depth`` is the number of levels above a node of ``nodes``; a block
    has at most DIGITS of them, and where there are fewer its lone node is
    passed on as it is."""
    digits = [f"d{j}" for j in range(DIGITS)]
    now = nodes.select(*keys, "depth", F.expr(f"rank div {FAN ** DIGITS}").alias("block"), "node",
                       *(F.expr(f"cast(rank div {FAN ** j} % {FAN} as int)").alias(d) for j, d in enumerate(digits))) \
        .repartition(*keys, "block")
    for j, d in enumerate(digits):
        run = F.array_sort(F.collect_list(F.struct(F.col(d).alias("digit"), "node")))
        now = now.groupBy(*keys, "block", "depth", *digits[j + 1:]).agg(F.transform(run, lambda x: x["node"]).alias("kids"))
        own = F.when(F.col("depth") > j, F.sha2(F.array_join(F.transform("kids", lambda k: k["digest"]), ""), 256)) \
            .otherwise(F.col("kids")[0]["digest"])
        now = now.withColumn("node", F.struct(own.alias("digest"), "kids")).drop("kids")
    return now


def steps(kid_digests: Column, i: Column) -> Column:
    """The siblings before and after the i-th of a run."""
    return F.struct(F.array_join(F.slice(kid_digests, F.lit(1), i), "").alias("left"),
                    F.array_join(F.slice(kid_digests, i + 2, F.lit(FAN)), "").alias("right"))


def hand_down(blocks: DataFrame) -> DataFrame:
    """Each node at the foot of ``blocks`` (block, depth, node, ...) with its
    siblings up to the block's own node, the lowest first: columns ``child``, ``proof``."""
    def kids_at(j: int, parent: Column) -> Column:
        digests = F.transform(parent["node"]["kids"], lambda k: k["digest"])
        return F.transform(parent["node"]["kids"], lambda kid, i: F.struct(kid.alias("node"), F.when(
            F.col("depth") > j, F.concat(F.array(steps(digests, i)), parent["proof"])).otherwise(parent["proof"]).alias("proof")))

    now = F.array(F.struct(F.col("node"), F.expr(f"cast(array() as {PROOF})").alias("proof")))
    for level in reversed(range(DIGITS)):
        now = F.flatten(F.transform(now, partial(kids_at, level)))
    return blocks.select("*", F.explode(now).alias("_child")).select("*", F.col("_child.node").alias("child"), F.col("_child.proof").alias("proof")) \
        .drop("_child", "node")


def with_above(blocks: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """``blocks`` with what ``above`` (keys, block, proof above, roots) says of
    them: the two rows of a block are grouped, not joined."""
    extra = [c for c in above.columns if c not in (*keys, "block")]
    types = dict(above.dtypes)
    rows = blocks.select(*keys, "block", "depth", "node", *(F.lit(None).cast(types[c]).alias(c) for c in extra)) \
        .unionByName(above, allowMissingColumns=True)
    return rows.groupBy(*keys, "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("depth", "node", *extra)))


def tower(nodes: DataFrame, keys: list[str], most: int, name: str) -> list[DataFrame]:
    """Rollups of ``nodes`` until one block a group is left, ``most`` being the largest group's number of nodes."""
    out = []
    while True:
        out.append(materialize(roll_up(nodes, keys), f"merkle-{name}"))
        most = -(-most // FAN ** DIGITS)
        if most <= 1:
            return out
        nodes = out[-1].select(*keys, F.col("block").alias("rank"), F.greatest(F.col("depth") - DIGITS, F.lit(0)).alias("depth"),
                               F.struct(F.col("node.digest").alias("digest"), F.col("block").alias("block")).alias("node"))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rank`` of each row in its group, from 0, and the group's ``size``. Rows
    are dealt into ranges of (group, order), so a large group lies in many;
    counts a range and group, summed up, are the ranks' starts."""
    ranged = materialize(rows.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()), "merkle-ranges")
    counts = ranged.groupBy("_range", group).agg(F.count(F.lit(1)).alias("_n"))
    by = Window.partitionBy(group)
    starts = counts.select(F.col("_range").alias("_r"), F.col(group).alias("_g"), F.sum("_n").over(by).alias("size"),
                           F.coalesce(F.sum("_n").over(by.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = ranged.withColumn("_nth", F.row_number().over(Window.partitionBy("_range", group).orderBy(*order)))
    return inside.join(small_side(starts, "merkle-starts"), (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g"))) \
        .withColumn("rank", F.col("_start") + F.col("_nth") - 1).drop("_range", "_r", "_g", "_start", "_nth")


def manifest(docs: DataFrame, tampered: Column | None = None, names: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             id_col: str = "doc_id", group_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    A leaf is the digest of the fields ``names``. Leaves of a group ascend by
    id (null first; equal ids by digest, and rows alike in all fields have equal
    leaves); groups ascend by their name's bytes, the null group first.
    ``tampered`` is the text that a row is claimed to have when it is verified;
    null means the row's own. The proof is folded from the claimed leaf, and
    ``verified`` says whether it ends in the root. Null fields differ from empty
    ones. A lone row is its own subroot, and a lone group's subroot is the root.
    Texts of any length are hashed where they are read and not moved. An empty
    table gives no rows. Columns beyond ``names`` are not read.
    """
    text = F.col(text_col).cast("string")
    own = leaf_of(list(names), text_col, text)
    claim = F.lit(None).cast("string") if tampered is None else F.when(
        tampered.isNotNull() & ~tampered.eqNullSafe(text), leaf_of(list(names), text_col, tampered))
    leaves = materialize(docs.select(F.col(group_col).cast("string").alias("group"), F.col(id_col).alias("id"), own.alias("leaf"), claim.alias("claim")), "merkle-leaves")
    rows = materialize(ranked(leaves, "group", ["id", "leaf"]), "merkle-ranked")
    most = rows.agg(F.max("size")).first()[0] or 0
    nodes = rows.select("group", "rank", levels_of(F.col("size")).alias("depth"), F.struct(F.col("leaf").alias("digest"), "id", "claim").alias("node"))
    inner = tower(nodes, ["group"], most, "inner")

    roots = inner[-1].select("group", F.col("node.digest").alias("digest"), F.lit(1).alias("one"))
    placed = materialize(global_prefix(roots, ["group"], "one", "merkle-groups"), "merkle-placed")
    groups = placed.count()
    nodes = placed.select(F.lit(0).alias("all"), F.col("_rank").alias("rank"), levels_of(F.lit(groups)).alias("depth"),
                          F.struct("digest", "group").alias("node"))
    outer = tower(nodes, ["all"], groups, "outer")

    above = outer[-1].select("all", "block", F.expr(f"cast(array() as {PROOF})").alias("above"), F.col("node.digest").alias("root"))
    for i, blocks in reversed(list(enumerate(outer))):
        below = hand_down(with_above(blocks, above, ["all"])).withColumn("above", F.concat("proof", "above"))
        if i:
            above = below.select("all", F.col("child.block").alias("block"), "above", "root")
    above = below.select(F.col("child.group").alias("group"), F.lit(0).cast("bigint").alias("block"), "above", F.col("child.digest").alias("subroot"), "root")
    for i, blocks in reversed(list(enumerate(inner))):
        below = hand_down(with_above(blocks, above, ["group"])).withColumn("above", F.concat("proof", "above"))
        if i:
            above = below.select("group", F.col("child.block").alias("block"), "above", "subroot", "root")
    return below.select(
        F.col("child.id").alias("doc_id"), F.col("child.digest").alias("leaf"), "subroot", "root",
        F.sha2(F.array_join(F.transform("above", lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"),
        F.aggregate("above", F.coalesce("child.claim", "child.digest"), lambda now, s: F.sha2(F.concat(s["left"], now, s["right"]), 256)).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_feeds(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text without its line feeds, for every second id by crc32; null otherwise."""
    return F.when(F.crc32(F.col(id_col).cast("string")) % 2 == 0, F.translate(F.col(text_col).cast("string"), "\n", ""))
