"""Merkle manifest of a dataset, with a membership proof for each row by pointer jumping: nodes hold the siblings on the way to
an ancestor, and a self-join doubles the way until it ends at the root."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellquant.llm.common import fresh, materialize

#: levels of a tree that one grouping of neighbouring nodes makes
LEVELS = 8
#: trees whose sizes are broadcast; more are joined
BROADCAST_TREES = 200_000
#: ways (up to 32 bytes a level) that are broadcast; more are joined
BROADCAST_NODES = 10_000
_NONE = "0" * 64


def hashed(*parts: Column | str) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(*values: Column | str) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value, of every value."""
    texts = [(F.col(v) if isinstance(v, str) else v).cast("string") for v in values]
    return hashed(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts))


def ordinals(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` as a stored table with ``name``, their place by ``keys``, from 0 (nulls first, ties in any order).

    Ranges are sorted each by itself; their sizes, one row a range, are summed up and added."""
    tie, at = fresh(rows, "tie"), fresh(rows, "at")
    made = rows.withColumn(tie, F.monotonically_increasing_id())  # many equal rows need not share a range
    ranged = made.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)
    stored = materialize(ranged.drop(tie).withColumn(at, F.monotonically_increasing_id()), "merkle-sorted")
    part, row = F.shiftright(at, 33), F.col(at).bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    return stored.join(F.broadcast(before), part == F.col("part")).withColumn(name, F.col("before") + row).drop("part", "before", at)


def _height(n: Column) -> Column:
    """Levels above the leaves: 0 for one leaf."""
    return F.length(F.ltrim(F.bin(n - 1), F.lit("0"))).cast("int")


def _parents(row: Column) -> Column:
    """Every two neighbours become their hash, a last one alone as well."""
    return F.transform(F.sequence(F.lit(1), F.size(row), F.lit(2)), lambda i: hashed(F.element_at(row, i.cast("int")), F.coalesce(F.get(row, i.cast("int")), F.lit(""))))


def tree_nodes(leaves: DataFrame) -> DataFrame:
    """tree, height, level, place, digest and sibling (null: none) of all nodes, stored. Leaves have tree, place, n (leaves of
    the tree) and digest.

    A block of 2 ** ``LEVELS`` neighbours makes its levels in one grouping, so there are few rounds and no group grows."""
    out, base = None, 0
    nodes = leaves.select("tree", "place", _height(F.col("n")).alias("height"), "digest")
    while True:
        row = F.array_sort(F.collect_list(F.struct("place", "digest")))
        blocks = nodes.groupBy("tree", F.shiftright("place", LEVELS).alias("block")).agg(F.first("height").alias("height"), row.alias("row"))
        steps = F.least(F.col("height") - base, F.lit(LEVELS))
        ups = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
        levels = F.aggregate(ups, F.array(F.col("row.digest")), lambda made, _: F.concat(made, F.array(_parents(F.element_at(made, -1)))))
        stored = materialize(blocks.select("tree", "block", "height", levels.alias("levels")), "merkle-blocks")
        rows = stored.select("tree", "block", "height", F.posexplode("levels").alias("up", "row"))
        begun = (F.col("up") == LEVELS) & (F.col("height") > base + LEVELS)  # the leaves of the next round
        made = rows.where(~begun).select("tree", "block", "height", "up", "row", F.posexplode("row").alias("i", "digest"))
        made = made.select(
            "tree",
            "height",
            (F.col("up") + base).alias("level"),
            F.expr(f"shiftright(shiftleft(block, {LEVELS}), up) + i").alias("place"),
            "digest",
            F.get("row", F.col("i").bitwiseXOR(1)).alias("sibling"),
        )
        out = made if out is None else out.unionByName(made)
        nodes = rows.where(begun).select("tree", F.col("block").alias("place"), "height", F.get("row", F.lit(0)).alias("digest"))
        if nodes.isEmpty():
            return out
        base += LEVELS


def proofs(nodes: DataFrame) -> DataFrame:
    """tree, place, sides and segment of each leaf that is not the root itself: for each level up to the root the side of the
    sibling (L, R, or - for none) and its digest (32 bytes, zero for none).

    Each node begins with the way to its parent; where an ancestor has a way of its own, both ways make one of twice the
    length. Only nodes whose ways a later round asks for are kept: all leaves, and 1 in 4, 16, 256 of the others."""
    side = F.when(F.col("sibling").isNull(), "-").when(F.col("place").bitwiseAND(1) == 1, "L").otherwise("R")
    way = F.unhex(F.coalesce("sibling", F.lit(_NONE)))
    held = nodes.where("level < height").select("tree", "height", "level", "place", (F.col("level") + 1).alias("upto"), side.alias("sides"), way.alias("segment"))
    top, hop = nodes.agg(F.max("height")).first()[0] or 0, 1
    while hop < top:
        from_here = held.where(F.col("level") % (2 * hop) == 0)
        on = held.where(F.col("level") % (2 * hop) == hop)
        on = on.select(F.col("tree").alias("on_tree"), F.col("level").alias("on_level"), F.col("place").alias("on_place"), F.col("upto").alias("on_upto"), F.col("sides").alias("on_sides"), F.col("segment").alias("on_segment"))
        on = F.broadcast(on) if on.count() <= BROADCAST_NODES else on
        met = (F.col("tree") == F.col("on_tree")) & (F.col("upto") == F.col("on_level")) & (F.expr("shiftright(place, upto - level)") == F.col("on_place"))
        both = from_here.join(on, met, "left").select(
            "tree",
            "height",
            "level",
            "place",
            F.coalesce("on_upto", "upto").alias("upto"),
            F.concat("sides", F.coalesce("on_sides", F.lit(""))).alias("sides"),
            F.concat("segment", F.coalesce("on_segment", F.lit(b""))).alias("segment"),
        )
        held, hop = materialize(both, "merkle-ways"), 2 * hop
    return held.where("level = 0").select("tree", "place", "sides", "segment")


def manifest(leaves: DataFrame, group: str, keys: list[str], leaf: str) -> DataFrame:
    """``leaves`` with subroot, root, sides and segment (as in ``proofs``, through the subroot to the root).

    Rows of one ``group`` are the leaves of a tree, ordered by ``keys``, then by ``leaf``; the subroots, ordered by group,
    are the leaves of the tree above. A null group is one of its own and first, null keys come first, rows that repeat are
    leaves each; an empty table gives an empty result. Columns with these new names are replaced, others stay.
    """
    leaves = leaves.drop("subroot", "root", "sides", "segment")
    own = {n: fresh(leaves, n) for n in ("ordinal", "tree", "place", "n", "group_of")}
    placed = ordinals(materialize(leaves, "merkle-leaves"), [group, *keys, leaf], own["ordinal"])  # ranges are found by reading twice
    trees = materialize(placed.groupBy(F.col(group).alias(own["group_of"])).agg(F.min(own["ordinal"]).alias(own["tree"]), F.count(F.lit(1)).alias(own["n"])), "merkle-trees")
    count = trees.count()
    few = F.broadcast if count <= BROADCAST_TREES else lambda df: df
    sized = placed.join(few(trees), F.col(group).eqNullSafe(F.col(own["group_of"]))).withColumn(own["place"], F.col(own["ordinal"]) - F.col(own["tree"]))

    low = tree_nodes(sized.select(F.col(own["tree"]).alias("tree"), F.col(own["place"]).alias("place"), F.col(own["n"]).alias("n"), F.col(leaf).alias("digest")))
    subroots = low.where("level = height").select(F.col("tree").alias("of_tree"), F.col("digest").alias("subroot"))
    subroots = materialize(ordinals(subroots, ["of_tree"], "place"), "merkle-subroots")
    high = tree_nodes(subroots.select(F.lit(0).cast("long").alias("tree"), "place", F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest")))
    root = high.where("level = height").select("digest").first()

    above = proofs(high).select(F.col("place").alias("of_place"), F.col("sides").alias("high_sides"), F.col("segment").alias("high_segment"))
    above = subroots.join(above, F.col("place") == F.col("of_place"), "left").select("of_tree", "subroot", "high_sides", "high_segment")
    below = proofs(low).select(F.col("tree").alias("low_tree"), F.col("place").alias("low_place"), F.col("sides").alias("low_sides"), F.col("segment").alias("low_segment"))
    here = (F.col(own["tree"]) == F.col("low_tree")) & (F.col(own["place"]) == F.col("low_place"))
    whole = sized.join(below, here, "left").join(few(above), F.col(own["tree"]) == F.col("of_tree"))
    empty = F.lit("")
    return whole.select(
        *leaves.columns,
        "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"),
        F.concat(F.coalesce("low_sides", empty), F.coalesce("high_sides", empty)).alias("sides"),
        F.concat(F.coalesce("low_segment", empty.cast("binary")), F.coalesce("high_segment", empty.cast("binary"))).alias("segment"),
    )


def siblings(sides: str = "sides", segment: str = "segment") -> Column:
    """A proof's digests as an array of lowercase hex, null where a node has no sibling."""
    at = F.when(F.length(sides) > 0, F.sequence(F.lit(1), F.length(sides))).otherwise(F.array().cast("array<int>"))
    digest = lambda i: F.lower(F.hex(F.substring(segment, i * 32 - 31, F.lit(32))))
    return F.transform(at, lambda i: F.when(F.substring(sides, i, F.lit(1)) != "-", digest(i)))


def folded(leaf: Column, sides: str = "sides", found: str = "siblings") -> Column:
    """The root that a leaf and its proof lead to."""
    steps = F.transform(found, lambda d, i: F.struct(d.alias("d"), F.substring(sides, i + 1, F.lit(1)).alias("side")))
    up = lambda h, s: F.when(s.side == "L", hashed(s.d, h)).when(s.side == "R", hashed(h, s.d)).otherwise(hashed(h))
    return F.aggregate(steps, leaf, up)
