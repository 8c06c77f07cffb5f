"""Merkle dataset manifest with proofs by pointer jumping.

Every row is a leaf; the leaves of a group (a language, say) form a tree, and the roots of the groups form one more tree
whose root stands for the dataset. Trees grow some levels at a time: bounded runs of neighbouring nodes meet in a row.
Every node then holds the siblings on the way to its parent. A self-join with the nodes ``span`` levels up, which hold the
siblings of the next ``span`` levels, doubles the distance; after as many joins as the logarithm of the height every leaf
holds all siblings up to its root. Only nodes on levels that are multiples of the span take part in a join, so the right
side of the joins shrinks from n nodes to a handful.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavault.llm.base import salted_join
from stratavault.operators.ordering import with_slices
from stratavault.session import materialise

FANOUT = 2
#: Neighbouring nodes that meet in one row while a tree grows.
RUN = 256
#: From this number of leaves below one node on, its row is met by leaves of several tasks.
SPREAD = 256
_BYTES = 32
_POWERS_BELOW = 1 << 62


def entry(column: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its number of UTF-8 bytes, ``:`` and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """Lower-case hex SHA-256 of the values, in order."""
    return F.sha2(F.concat(*[entry(c) for c in columns]), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def placed(leaves: DataFrame, order: Sequence[str], fanout: int = FANOUT, name: str = "merkle-leaves") -> DataFrame:
    """``leaves`` (tree: string, digest, ...) with pos (from 0 within the tree, by ``order``) and height of the tree.

    Rows are numbered slice by slice, and a tree or an order value that holds a third of all rows is cut into slices; rows
    that are equal in ``order`` follow one another as they were stored.
    """
    stored = materialise(leaves.withColumn("_tie", F.monotonically_increasing_id()), name)
    ordered = stored.withColumn("_order", F.struct("tree", *order, "_tie"))
    sliced = with_slices(ordered, ["_order"])
    inside = F.row_number().over(Window.partitionBy("tree", "_slice").orderBy("_order"))
    sizes = sliced.groupBy("tree", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    along = Window.partitionBy("tree").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # as many rows as slices and trees
    offsets = sizes.select("tree", "_slice", F.coalesce(F.sum("_rows").over(along), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(Window.partitionBy("tree")).alias("_n"))
    powers = F.array(*[F.lit(fanout ** k).cast("bigint") for k in range(62) if fanout ** k < _POWERS_BELOW])
    return sliced.withColumn("_rn", inside).join(offsets, ["tree", "_slice"]).select(
        *leaves.columns, (F.col("_rn") - 1 + F.col("_before")).alias("pos"), F.size(F.filter(powers, lambda p: p < F.col("_n"))).alias("height"))


def _parents(nodes: Column, fanout: int) -> Column:
    """Digests (hex) of the next level from those of a whole one, or of a run that starts with a first child."""
    runs = F.ceil(F.size(nodes) / fanout).cast("int")
    return F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.array_join(F.slice(nodes, i * fanout + 1, F.lit(fanout)), ""), 256))


def _held(nodes: Column, i: Column, fanout: int) -> tuple[Column, Column]:
    """Step (place among its siblings, and their number, a hex digit each) and siblings (bytes) of the i-th node."""
    place = i % fanout
    run = F.slice(nodes, i - place + 1, F.lit(fanout))
    others = F.concat(F.slice(run, F.lit(1), place), F.slice(run, place + 2, F.lit(fanout)))
    return F.lower(F.concat(F.hex(place), F.hex(F.size(others)))), F.unhex(F.array_join(others, ""))


def _grown(leaves: DataFrame, payload: Sequence[str], fanout: int, run: int, name: str) -> tuple[DataFrame, DataFrame, int]:
    """``leaves`` (tree, pos, height, digest, payload) -> nodes, one stored row each (tree, level, pos, height, step, siblings,
    digest, row), where the digest is kept of roots only and row holds the payload of leaves; the roots; the largest height."""
    levels = 1
    while fanout ** (levels + 1) <= run:
        levels += 1
    block = fanout ** levels
    highest = leaves.agg(F.max("height")).first()[0] or 0
    row = F.struct(*payload)
    current = leaves.select("tree", "pos", "height", "digest", row.alias("row"))
    kind = current.schema["row"].dataType
    alone = current.where("height = 0").select("tree", F.lit(0).alias("level"), "pos", "height", F.lit("").alias("step"),
                                               F.unhex(F.lit("")).alias("siblings"), "digest", "row")
    made, roots, level = alone, alone.select("tree", "digest"), 0
    while level < highest:
        met = current.where(F.col("height") > level).groupBy("tree", "height", F.floor(F.col("pos") / block).cast("bigint").alias("_block")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", "row"))).alias("_nodes"))
        upto = F.least(F.lit(levels), F.col("height") - level)
        first = F.transform("_nodes", lambda n: _hex(n["digest"]))
        tower = met.withColumn("_levels", F.aggregate(F.sequence(F.lit(1), upto), F.array(first), lambda found, _: F.concat(
            found, F.array(_parents(F.element_at(found, -1), fanout)))))

        def of_level(j: Column) -> Column:
            nodes = F.get("_levels", j)
            base = F.col("_block") * F.get(F.array(*[F.lit(fanout ** (levels - k)).cast("bigint") for k in range(levels + 1)]), j)

            def node(i: Column) -> Column:
                step, siblings = _held(nodes, i, fanout)
                return F.struct((j + level).alias("level"), (base + i).alias("pos"), step.alias("step"), siblings.alias("siblings"),  # noqa: B023
                                F.lit(None).cast("binary").alias("digest"),
                                F.when(j == 0, F.get("_nodes", i)["row"]).otherwise(F.lit(None).cast(kind)).alias("row"))
            return F.transform(F.sequence(F.lit(0), F.size(nodes) - 1), node)

        below = F.flatten(F.transform(F.sequence(F.lit(0), upto - 1), of_level))
        top = F.struct((upto + level).alias("level"), F.col("_block").alias("pos"), F.lit(None).cast("string").alias("step"),
                       F.lit(None).cast("binary").alias("siblings"), F.unhex(F.get(F.get("_levels", upto), F.lit(0))).alias("digest"),
                       F.lit(None).cast(kind).alias("row"))
        out = tower.select("tree", "height", F.explode(F.concat(below, F.array(top))).alias("_e"))
        stored = materialise(out.select("tree", "_e.level", "_e.pos", "height", "_e.step", "_e.siblings", "_e.digest", "_e.row"), f"{name}-{level}")
        made = made.unionByName(stored.where("step IS NOT NULL"))
        tops = stored.where("step IS NULL")
        roots = roots.unionByName(tops.where("level = height").select("tree", "digest"))
        current, level = tops.where("level < height").select("tree", "pos", "height", "digest", "row"), level + levels
    return made, roots, highest


def _jumped(nodes: DataFrame, highest: int, payload: Sequence[str], fanout: int, name: str) -> DataFrame:
    """The leaves among ``nodes`` (tree, payload) with the steps and siblings of the whole way to the root of their tree."""
    paths = nodes.where("level = 0").select("tree", "pos", "step", "siblings", *[F.col(f"row.`{c}`").alias(c) for c in payload])
    upper = nodes.where("level > 0").select("tree", "level", "pos", "step", "siblings")
    span = 1
    while span < highest:
        ahead = upper.where(F.col("level") % (2 * span) == span)
        low = fanout ** span  # nodes below one of the nodes that are joined

        def longer(rows: DataFrame, joined_level: Column) -> DataFrame:
            right = ahead.select(F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("pos").alias("_pos"),  # noqa: B023
                                 F.col("step").alias("_step"), F.col("siblings").alias("_siblings"))
            left = rows.withColumns({"_level": joined_level, "_pos": F.floor(F.col("pos") / low).cast("bigint"), "_tree": F.col("tree")})  # noqa: B023
            if low >= SPREAD:  # noqa: B023
                met = salted_join(left, right, ["_tree", "_level", "_pos"], F.xxhash64("tree", "pos"))
            else:
                met = left.join(right, ["_tree", "_level", "_pos"], "left")
            return met.select(*[c for c in rows.columns if c not in ("step", "siblings")],
                              F.concat("step", F.coalesce("_step", F.lit(""))).alias("step"),
                              F.concat("siblings", F.coalesce("_siblings", F.unhex(F.lit("")))).alias("siblings"))

        paths = longer(paths, F.lit(span))
        rest = upper.where(F.col("level") % (2 * span) == 0)
        upper = materialise(longer(rest, F.col("level") + span), f"{name}-span{2 * span}") if 2 * span < highest else rest
        span *= 2
    return paths


def manifest(leaves: DataFrame, group: str, order: str, fanout: int = FANOUT, run: int = RUN) -> DataFrame:
    """``leaves`` (``group``, ``order``, leaf: hex digest, and columns that are carried along) with subroot, root (hex), steps and
    siblings: the proof of each row.

    Groups are ordered by their UTF-8 bytes, the null group first; leaves within a group by ``order`` (nulls first), then by
    digest. Every ``fanout`` consecutive nodes, or what is left of them at the end, become the SHA-256 of their hex digests,
    until one node is left. ``siblings`` are the digests (32 bytes each) of the other nodes of each run from the leaf's to
    the one below the root, left to right; ``steps`` has two hex digits for each run, the place of the own node and the
    number of the others. An empty table gives no rows; equal rows are leaves of their own.
    """
    if not 2 <= fanout <= 16:
        raise ValueError("a fanout from 2 to 16 is needed")
    payload = [c for c in leaves.columns if c != "leaf"] + ["leaf"]
    # '-' sorts before '=', so the null group comes first
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    rows = leaves.select(tree.alias("tree"), F.unhex("leaf").alias("digest"), *payload)
    at = materialise(placed(rows, [order, "digest"], fanout), "merkle-placed")
    nodes, roots, highest = _grown(at, payload, fanout, run, "merkle-nodes")
    paths = _jumped(nodes, highest, payload, fanout, "merkle-paths")

    # the same over the roots of the groups
    roots = materialise(roots, "merkle-subroots")
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest", _hex(F.col("digest")).alias("subroot"))
    at_top = materialise(placed(tops, ["group"], fanout, "merkle-groups"), "merkle-groups-placed")
    top_nodes, root, top_height = _grown(at_top, ["group", "subroot"], fanout, run, "merkle-top")
    top_paths = _jumped(top_nodes, top_height, ["group", "subroot"], fanout, "merkle-top-paths")
    facts = materialise(top_paths.join(root.select("tree", _hex(F.col("digest")).alias("root")), "tree").select(
        F.col("group").alias("tree"), "subroot", "root", F.col("step").alias("_top_step"), F.col("siblings").alias("_top_siblings")), "merkle-facts")
    whole = salted_join(paths, facts, ["tree"], F.xxhash64("tree", "pos"))
    return whole.select(*payload, "subroot", "root", F.concat("step", "_top_step").alias("steps"),
                        F.concat("siblings", "_top_siblings").alias("siblings"))


def folded(start: Column, steps: Column, siblings: Column) -> Column:
    """The root (hex) to which a leaf (hex) leads with these siblings."""
    count = (F.length(steps) / 2).cast("int")
    places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))

    def digit(k: Column) -> Column:
        return F.conv(F.substr(steps, k, F.lit(1)), 16, 10).cast("int")

    def up(state: Column, k: Column) -> Column:
        place, others = digit(2 * k - 1), digit(2 * k)
        left = _hex(F.substr(siblings, state["at"] * _BYTES + 1, place * _BYTES))
        right = _hex(F.substr(siblings, (state["at"] + place) * _BYTES + 1, (others - place) * _BYTES))
        return F.struct(F.sha2(F.concat(left, state["digest"], right), 256).alias("digest"), (state["at"] + others).alias("at"))
    return F.aggregate(places, F.struct(start.alias("digest"), F.lit(0).alias("at")), up, lambda s: s["digest"])


def proof_digest(siblings: Column) -> Column:
    """SHA-256 over the hex digests of all siblings."""
    return F.sha2(_hex(siblings), 256)
