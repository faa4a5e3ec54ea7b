"""Hierarchy operators: layered BOM deduplication, multi-level explosion, ancestors of ragged trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.session import stored

#: A component with a revision: digits, then one letter.
REVISION_PATTERN = r"^([0-9]+)([A-Z])$"


def dedup_bom(direct: DataFrame, scope: str = "bom", tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Four deduplication layers over direct BOM items, in this order:

    1. lowest alternative BOM per (parent, plant, usage) - all its items kept;
    2. highest revision per numbered component of a BOM; components without a revision stay;
    3. latest valid-from per (BOM, alternative, component, quantity, unit);
    4. highest item node per (BOM, alternative, item number).

    ``scope='bom'`` judges layers 2-4 within a BOM number (one shared by two plants then keeps
    one plant's row); ``scope='bom_plant'`` within BOM number, plant and parent. ``tiebreak``
    completes each order so the kept row is deterministic.

    The input is evaluated once. Layer 1 is a minimum over its group; layers 2-4 share one
    exchange on the scope columns, which all their groups contain.
    """
    scopes = {"bom": ["bom_number"], "bom_plant": ["bom_number", "plant", "parent_matnr"]}
    if scope not in scopes:
        raise ValueError("scope must be 'bom' or 'bom_plant'")
    within = scopes[scope]
    lowest = F.min("alt_bom").over(Window.partitionBy("parent_matnr", "plant", "bom_usage"))
    kept = direct.withColumn("_lowest", lowest).where(F.col("alt_bom") == F.col("_lowest")).drop("_lowest")
    part = F.regexp_extract("component_matnr", REVISION_PATTERN, 1)
    kept = kept.withColumn("_part", F.when(part != "", part)).repartition(*within)
    layers = [
        (["_part"], F.regexp_extract("component_matnr", REVISION_PATTERN, 2).desc(), F.col("_part").isNull()),
        (["alt_bom", "component_matnr", "qty", "uom"], F.col("valid_from").desc(), F.lit(False)),
        (["alt_bom", "item_number"], F.col("item_node").desc(), F.lit(False)),
    ]
    for group, best, exempt in layers:
        place = F.row_number().over(Window.partitionBy(*within, *group).orderBy(best, *tiebreak))
        kept = kept.withColumn("_place", place).where((F.col("_place") == 1) | exempt).drop("_place")
    return kept.drop("_part")


def prepare_edges(edges: DataFrame, parent: str, child: str, same: Sequence[str]) -> DataFrame:
    """Edge list with ``expands``: whether the child is itself a parent under equal ``same`` columns.

    Stored, so the edge pipeline runs once for the roots and all levels.
    """
    edges = stored(edges, "edges")
    parents = edges.select(F.col(parent).alias(child), *same, F.lit(True).alias("expands")).distinct()
    return stored(edges.join(parents, [child, *same], "left").select(*edges.columns, F.coalesce("expands", F.lit(False)).alias("expands")), "marked-edges")


def _open_paths() -> Column:
    """Whether a path goes on: its component is a parent and does not stand on the path already."""
    return F.col("expands") & ~F.array_contains("trail", F.col("component_material"))


def explode_all(roots: DataFrame, match: Sequence[str], path_item: str, max_levels: int | None = None) -> DataFrame:
    """All levels below all parents, by doubling: paths of up to 2k levels from paths of up to k.

    ``roots`` holds the level-1 rows of every parent, as for :func:`explode_hierarchy`. A path longer than
    k levels is one of exactly k levels, continued by a path of at most k levels that starts at its last
    component under equal ``match`` columns. So the paths below a sub-assembly are built once and joined to
    whatever stands above it, and n levels take log2(n) rounds. Each path comes out of one pair only; pairs
    whose materials meet twice run into a cycle and are left out. Rows and order as from
    :func:`explode_hierarchy`; roots without ``sort_path`` give rows without it.
    """
    step = F.lpad(F.col(path_item).cast("string"), 8, "0")
    pieces, depth = [stored(roots.withColumn("steps", step) if "sort_path" in roots.columns else roots, "paths")], 1
    while max_levels is None or depth < max_levels:
        front = pieces[-1].where((F.col("bom_level") == depth) & _open_paths())
        if front.isEmpty():
            break
        upper, lower = front.alias("u"), reduce(DataFrame.unionByName, pieces).alias("l")
        both = upper.join(lower, reduce(Column.__and__, [F.col("u.component_material") == F.col("l.top_material"),
                                                         *[F.col(f"u.{c}") == F.col(f"l.{c}") for c in match]]))
        level = F.col("u.bom_level") + F.col("l.bom_level")
        if max_levels is not None:
            both = both.where(level <= max_levels)
        joined = {**{c: F.col(f"u.{c}") for c in ("top_material", "top_plant")}, "bom_level": level.cast("int"),
                  "sort_path": F.concat_ws("|", "u.sort_path", "l.steps"), "trail": F.concat("u.trail", "l.trail"),
                  "steps": F.when(F.col("u.steps").isNull(), F.col("l.steps")).when(F.col("l.steps").isNull(), F.col("u.steps"))
                            .otherwise(F.concat_ws("|", "u.steps", "l.steps"))}
        pieces.append(stored(both.where(~F.arrays_overlap("u.trail", "l.trail")).select(
            *[joined.get(c, F.col(f"l.{c}")).alias(c) for c in pieces[0].columns]), "paths"))
        depth *= 2
    return reduce(DataFrame.unionByName, pieces).drop("expands", "trail", "steps")


def explode_hierarchy(edges: DataFrame, roots: DataFrame, parent: str, child: str, match: Mapping[str, str],
                      carry: Sequence[str], path_item: str, max_levels: int | None = None) -> DataFrame:
    """All levels below ``roots`` (level-1 rows), until nothing is left to expand.

    ``roots`` holds ``top_material, top_plant, parent_material, component_material, bom_level``,
    ``sort_path`` (if the rows are to have it), ``carry``, ``expands`` and ``trail`` (the materials from the top down to the
    parent). Level k+1 joins the expandable rows of level k to the edges (from
    :func:`prepare_edges`) whose ``parent`` is their component and whose ``match`` columns equal
    theirs. A component that stands on its own trail closes a cycle: its row is kept and not
    expanded. Quantities are per parent, not multiplied through levels. ``max_levels`` is for a
    report that asks for so many levels; by default every level is returned.

    Each level is one join of the level before it, stored once; leaves never enter a join. This walk is
    for chosen roots; :func:`explode_all` takes all parents as roots.
    """
    found, level, depth = [], roots, 1
    while max_levels is None or depth < max_levels:
        front = level.where(_open_paths())
        if depth > 1 and front.isEmpty():
            break
        f, e = front.alias("f"), edges.alias("e")
        joined = f.join(e, reduce(Column.__and__, [F.col("f.component_material") == F.col(f"e.{parent}"),
                                                   *[F.col(f"f.{a}") == F.col(f"e.{b}") for a, b in match.items()]]))
        step = F.lpad(F.col(f"e.{path_item}").cast("string"), 8, "0")
        new = {"top_material": F.col("f.top_material"), "top_plant": F.col("f.top_plant"),
               "parent_material": F.col(f"e.{parent}"), "component_material": F.col(f"e.{child}"),
               "bom_level": F.lit(depth + 1).cast("int"), "sort_path": F.concat_ws("|", "f.sort_path", step),
               "expands": F.col("e.expands"), "trail": F.array_append("f.trail", F.col(f"e.{parent}")),
               **{c: F.col(f"e.{c}") for c in carry}}
        level = stored(joined.select(*[new[c].alias(c) for c in roots.columns]), "level")
        found.append(level)
        depth += 1
    return reduce(DataFrame.unionByName, found, roots).drop("expands", "trail")


def childless_nodes(nodes: DataFrame, level: str = "LEVEL", child: str = "CHILD", parent: str = "PARENT") -> DataFrame:
    """Nodes that no node of the next level names as its parent (left anti join)."""
    below = nodes.select((F.col(level).cast("int") - 1).alias("_above"), F.col(parent).alias("_named"))
    return nodes.join(below, (F.col(level).cast("int") == F.col("_above")) & (F.col(child) == F.col("_named")), "left_anti")


def ragged_hierarchy(nodes: DataFrame, tiers: Mapping[int, tuple[str, str]], first_leaf: int = 3, level: str = "LEVEL",
                     child: str = "CHILD", desc: str = "CHILD_DESC", parent: str = "PARENT") -> DataFrame:
    """Ancestors of the leaves of a ragged tree, one column pair per tier.

    ``tiers`` maps a level to the names of its id and text columns; the deepest leaves stand one
    level below the deepest tier. Leaves are the childless nodes from level ``first_leaf`` on.
    Every leaf follows its parent pointer one level up per step, through any number of levels;
    from a missing ancestor on, its tiers stay NULL. Returns ``node`` and the tier columns, deepest
    tier first.
    """
    depth = max(tiers) + 1
    at = F.col(level).cast("int")
    known = nodes.where(at.between(1, depth))
    leaves = childless_nodes(known, level, child, parent).where(at >= first_leaf)
    names = [n for k in sorted(tiers, reverse=True) for n in tiers[k]]
    walk = leaves.select(F.col(child).alias("node"), (at - 1).alias("_level"), F.col(parent).alias("_up"),
                         *[F.lit(None).cast("string").alias(n) for n in names])
    above = known.select(at.alias("_k"), F.col(child).alias("_id"), F.col(desc).alias("_text"), F.col(parent).alias("_next"))
    for _ in range(depth - 1):
        walk = walk.join(above, (F.col("_level") == F.col("_k")) & (F.col("_up") == F.col("_id")), "left")
        filled = {n: F.when(F.col("_k") == k, F.col(c)).otherwise(F.col(n)) for k, pair in tiers.items()
                  for n, c in zip(pair, ("_id", "_text"), strict=True)}
        walk = walk.select("node", (F.col("_level") - 1).alias("_level"), F.col("_next").alias("_up"), *[filled[n].alias(n) for n in names])
    return walk.select("node", *names)
