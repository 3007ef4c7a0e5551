"""Merkle dataset manifest: leaves rolled up into nested structs inside bounded blocks, proofs unfolded from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.session import stage

#: Children of a node, and levels that one block rolls up: a block holds 3 ** 6 = 729 nodes.
FAN, LEVELS = 3, 6
#: Rows of one range while ranks are counted.
RANGE_ROWS = 200_000

STEPS = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of the fields in order: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(steps, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def proof_text(steps: Column) -> Column:
    """All siblings of a proof, level by level and from left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def _ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Replace ``spread`` by ``at``, the place from 0 of each row in its group ``g`` by ``order``.

    Rows are dealt by range over (g, order, spread), so a group of any size, or rows that repeat each other, spread over many ranges. A
    row's place is its place in its range less that of the group's first row there, plus the group's rows in earlier ranges.
    """
    keys = ["g", *order, "spread"]
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    dealt = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    # The number holds the range in its upper bits and the place in the range in the lower 33; it is fixed once written.
    dealt = stage(dealt.withColumn("spread", F.monotonically_increasing_id()), label)
    dealt = dealt.withColumn("range", F.shiftright("spread", 33)).withColumn("place", F.col("spread").bitwiseAND((1 << 33) - 1))
    held = dealt.groupBy("range", "g").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = held.select("range", "g", (earlier - F.col("first")).alias("shift"))
    return dealt.join(shifts, ["range", "g"]).withColumn("at", F.col("place") + F.col("shift")).drop("range", "place", "shift", "spread")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (g, at, hash, item) to one row (g, block, tree) for each block of 729 places.

    The digits of the place are grouped away from the lowest to the highest, each time nesting up to three children in a
    struct with their hash. All groups lie within a block, so one shuffle by block serves all of them. A node that is alone on its level in
    the whole group is its own parent and is not hashed again.
    """
    digits = [F.expr(f"cast((at div {FAN**d}) % {FAN} as int) as d{d}") for d in range(LEVELS)]
    level = nodes.select("g", F.expr(f"at div {FAN**LEVELS} as block"), *digits, F.struct("hash", "item").alias("node")).repartition("g", "block")
    for d in range(LEVELS):
        rest = [f"d{j}" for j in range(d + 1, LEVELS)]
        level = level.groupBy("g", "block", *rest).agg(F.array_sort(F.collect_list(F.struct(f"d{d}", "node"))).alias("kids"))
        level = level.withColumn("kids", F.transform("kids", lambda k: k["node"]))
        alone = (F.size("kids") == 1) & (F.col("block") == 0)
        for name in rest:
            alone &= F.col(name) == 0
        below = F.transform("kids", lambda k: k["hash"])
        node = F.struct(F.when(alone, below[0]).otherwise(digest(F.array_join(below, ""))).alias("hash"), (~alone).alias("hashed"), "kids")
        level = level.select("g", "block", *rest, node.alias("node"))
    return level.withColumnRenamed("node", "tree")


def _tiers(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Blocks of the nodes, blocks of these blocks' hashes, and so on until each group is one block."""
    tiers = []
    while True:
        tiers.append(stage(_blocks(nodes), label))
        if not tiers[-1].agg(F.max("block")).first()[0]:
            return tiers
        nodes = tiers[-1].select("g", F.col("block").alias("at"), F.col("tree.hash").alias("hash"), F.struct(F.col("block").alias("at")).alias("item"))


def _unfold(tree: Column, steps: Column) -> Column:
    """All bottom nodes of a tree as an array of (item, hash, steps); steps lead from the node up and end with the given ones."""
    none = F.array().cast(STEPS)

    def under(node: Column, depth: int, above: Column) -> Column:
        kids = node["kids"]

        def each(kid: Column, i: Column) -> Column:
            side = lambda part: F.array_join(F.transform(part, lambda k: k["hash"]), "")
            step = F.struct(side(F.slice(kids, F.lit(1), i)).alias("left"), side(F.slice(kids, i + 2, F.lit(FAN))).alias("right"))
            path = F.concat(F.when(node["hashed"], F.array(step)).otherwise(none), above)
            return F.struct(kid["item"].alias("item"), kid["hash"].alias("hash"), path.alias("steps")) if depth == 1 else under(kid, depth - 1, path)

        found = F.transform(kids, each)
        return found if depth == 1 else F.flatten(found)

    return under(tree, LEVELS, steps)


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Bottom nodes (g, item, hash, up) of all tiers, where ``above`` gives (g, up) for the top block of each group.

    ``up`` is a struct whose field ``steps`` is extended on the way down. A block and what is above it meet in one group of two rows.
    """
    names = [f.name for f in above.schema["up"].dataType.fields if f.name != "steps"]
    above = above.select("g", F.lit(0).cast("long").alias("block"), "up")
    for n, tier in reversed(list(enumerate(tiers))):
        both = tier.select("g", "block", "tree").unionByName(above, allowMissingColumns=True)
        both = both.groupBy("g", "block").agg(F.first("tree", ignorenulls=True).alias("tree"), F.first("up", ignorenulls=True).alias("up"))
        found = both.select("g", "up", F.explode(_unfold(F.col("tree"), F.col("up.steps"))).alias("node"))
        up = F.struct(F.col("node.steps").alias("steps"), *[F.col(f"up.{c}").alias(c) for c in names])
        found = found.select("g", "node.item", "node.hash", up.alias("up"))
        above = found.select("g", F.col("item.at").alias("block"), "up") if n else found
    return above


def manifest(df: DataFrame, leaf: Column, key: str = "doc_id", group: str = "source", seen: Column | None = None) -> DataFrame:
    """Rows (key, group, ``leaf``, ``seen``, ``subroot``, ``root``, ``steps``): the Merkle tree of a table with each row's proof.

    Leaves of a group ascend by key; every three consecutive nodes (fewer at the end, even one) hash to their parent until one is left, the
    subroot; a lone leaf is its own. Subroots, ordered by group, lead to the root in the same way. ``steps`` holds, from the
    leaf up, the hashes left and right of the path: ``fold(leaf, steps)`` is the root. ``seen`` is a leaf hash to be tested
    against the manifest (null: the leaf's own), passed through.

    A null key or group comes first and is a value like any other. Rows of equal group and key are ordered by leaf hash; repeated
    rows are leaves of their own. An empty table gives no rows. Other columns go only into the hashes; texts are hashed where they are
    read and never shuffled, however long. No group is gathered: ranks are counted by ranges and trees held in blocks of 729
    nodes, whose hashes are the nodes of the next tier.
    """
    null_first = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("g")
    seen = leaf if seen is None else F.coalesce(seen, leaf)
    rows = df.select(null_first, F.col(key).alias("key"), F.col(group).alias("name"), leaf.alias("hash"), seen.alias("seen"))
    rows = stage(rows.withColumn("seen", F.nullif("seen", "hash")).withColumn("spread", F.monotonically_increasing_id()), "manifest-leaves")
    ranked = _ranked(rows, ["key", "hash"], "manifest-ranked")
    leaves = _tiers(ranked.select("g", "at", "hash", F.struct("key", "name", "seen").alias("item")), "manifest-blocks")
    subroots = leaves[-1].select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("tree.hash").alias("hash"), F.monotonically_increasing_id().alias("spread"))
    groups = _tiers(_ranked(subroots, ["of"], "manifest-subroots").select("g", "at", "hash", F.struct("of").alias("item")), "manifest-groups")
    top = groups[-1].select("g", F.struct(F.array().cast(STEPS).alias("steps"), F.col("tree.hash").alias("root")).alias("up"))
    tops = _descend(groups, top).select(F.col("item.of").alias("g"), F.struct("up.steps", "up.root", F.col("hash").alias("subroot")).alias("up"))
    return _descend(leaves, tops).select(
        F.col("item.key").alias(key), F.col("item.name").alias(group), F.col("hash").alias("leaf"), F.coalesce("item.seen", "hash").alias("seen"),
        "up.subroot", "up.root", "up.steps",
    )
