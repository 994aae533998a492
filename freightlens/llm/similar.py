"""Components of similar nodes from shared band keys, with exact verification and without all pairs of a band."""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.components import components
from freightlens.operators.joins import small_enough
from freightlens.session import Workspace

STARS = 1  # every further round is some thirty jobs, whose records stay in the driver; the join on rare elements finds the same links
ROUNDING = 1e-6


def by_elements(threshold: float) -> Callable[[DataFrame], DataFrame]:
    """Keeps the pairs (a, b, ea, eb) whose arrays of distinct elements have a Jaccard similarity of `threshold` or more."""
    common = F.size(F.array_intersect("ea", "eb"))
    return lambda pairs: pairs.where(common >= threshold * (F.size("ea") + F.size("eb") - common))


def _leader(turn: int, *more: str):
    """The order that picks a band's leader: most shared at first, then by a hash, another one in every band."""
    by = F.col("rank") if turn == 0 else F.xxhash64("node", "band", F.lit(turn))
    return F.min(F.struct(by.alias("by"), "node", *more)).alias("lead")


def _sized_bands(threshold: float):
    """The two parts of its band that a node of n elements belongs to; sizes that allow the similarity have a part in common.

    Sizes fall into classes so wide that two of a ratio of `threshold` or more are in one or in neighbouring ones; a part holds two classes.
    """
    of_size = F.floor(F.log("n") / (log(1 / threshold) + ROUNDING))
    return F.array(F.xxhash64("band", of_size), F.xxhash64("band", of_size + 1))


def _rare_pairs(ws: Workspace, nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): every pair of `nodes` (node, component) of different components that can reach the similarity, and few others.

    The elements of each set are put in one order, the rarest first. With n elements, of which the first one that two sets share is
    followed by left - 1 others, at most `left` are common; so a pair meets at one of the rare elements in front, where both have
    enough left, or is not similar. An element's most frequent component is only set against the others. Elements of one
    component, and those of one set alone, are not joined.
    """
    each = nodes.join(sets, "node").select("node", "component", F.size("e").alias("n"), F.explode("e").alias("element"))
    spread = each.groupBy("element").agg(F.count("*").alias("sets")).where("sets > 1")
    by_rarity = Window.partitionBy("node").orderBy(F.desc("sets"), F.desc("element"))  # the commonest has one left, itself
    counted = each.join(spread, "element").withColumn("left", F.row_number().over(by_rarity))
    early = counted.where(F.col("left") >= threshold * F.col("n") - ROUNDING).select("element", "node", "component", "n", "left")
    early = ws.write(early, ws.fresh("early"))
    held = early.groupBy("element", "component").agg(F.count("*").alias("rows")).groupBy("element")
    several = held.agg(F.max(F.struct("rows", "component"))["component"].alias("main"), F.count("*").alias("parts")).where("parts > 1")
    placed = early.join(several.drop("parts"), "element")
    one = placed.where("component <> main").select("element", F.col("node").alias("a"), "component", "n", "left")
    two = placed.select("element", F.col("node").alias("b"), F.col("component").alias("theirs"), F.col("n").alias("m"), F.col("left").alias("right"), "main")
    enough = F.least("left", "right") * (1 + threshold) >= (F.col("n") + F.col("m")) * threshold - ROUNDING
    once = F.expr("component <> theirs and (theirs = main or a < b)")
    return one.join(two, "element").where(once & enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def similar_components(
    ws: Workspace,
    banded: DataFrame,
    content_of: Callable[[DataFrame], DataFrame],
    threshold: float,
    similar: Callable[[DataFrame], DataFrame] | None = None,
    stars: int = STARS,
    sets_of: Callable[[DataFrame], DataFrame] = lambda content: content,
    banded_done: Callable[[], None] = lambda: None,
) -> DataFrame | None:
    """(node, component) of nodes linked by a Jaccard similarity of `threshold` or more; None if nothing is linked.

    `banded` (band, node, n) has a row per band key of a node with n elements; `content_of` turns a
    table of nodes into (node, e), whose e `similar` compares: arrays of distinct elements, unless it is given; then `sets_of` turns
    (node, e) into such arrays. Bands are counted first, by their keys alone, and only nodes of shared ones are looked at again. Each member of a
    band is compared with one leader of the band: the member whose bands have most members in sum, as the original of many edited
    copies has. A leader has then met its whole band and leaves it; bands whose other members are still in several components get
    another leader. `banded_done` is called when `banded` is not read any more. After `stars` rounds the members left are compared with those of other components that they share one of
    their rarest elements with, which leaves out no similar pair. Sizes that rule the similarity out are not compared,
    and bands are parted by size, so that members of very different size do not hold each other back.
    """
    counted = ws.fresh("shared")
    shared = ws.write(banded.groupBy("band").agg(F.count("*").alias("rows")).where("rows > 1"), counted)
    together = F.sum("rows").over(Window.partitionBy("node"))  # as many rows as a node has bands
    members = banded.join(F.broadcast(shared) if small_enough(shared) else shared, "band")
    named = ws.fresh("members")
    members = members.select("band", "node", "n", (-together).alias("rank"), F.col("node").alias("component"))
    members = ws.write(members.select(F.explode(_sized_bands(threshold)).alias("band"), "node", "n", "rank", "component"), named)
    ws.drop(counted)
    banded_done()
    if members.isEmpty():
        return None
    content = ws.write(content_of(ws.write(members.select("node").distinct(), ws.fresh("wanted"))), ws.fresh("content"))
    linked: DataFrame | None = None
    for turn in range(stars + 1):
        if turn < stars:
            leaders = members.groupBy("band").agg(_leader(turn, "n", "component"))
            pairs = members.join(leaders, "band").where("component <> lead.component").select(
                F.col("node").alias("a"), F.col("lead.node").alias("b"), "n", F.col("lead.n").alias("m")
            )
            pairs = pairs.where(F.least("n", "m") >= threshold * F.greatest("n", "m") - ROUNDING)
        else:
            left = members.select("node", "component").distinct()
            pairs = _rare_pairs(ws, left, sets_of(content.join(left.select("node"), "node", "left_semi")), threshold)
        compared = ws.fresh("pairs")
        pairs = ws.write(pairs.select("a", "b").distinct(), compared)
        one, two = (content.select(F.col("node").alias(x), F.col("e").alias(f"e{x}")) for x in "ab")
        two = two.join(pairs.select("b").distinct(), "b", "left_semi")  # leaders are few
        alike = (similar or by_elements(threshold))(pairs.join(one, "a").join(two, "b"))
        found = ws.write(alike.select("a", "b"), ws.fresh("links"))
        ws.drop(compared)
        linked = found if linked is None else linked.unionByName(found)
        joined = components(ws, linked)
        linked = joined.where("node <> component").toDF("a", "b")  # stars take the next call fewer rounds than the links themselves
        if turn == stars:
            break
        labelled = members.drop("component").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        leaders = labelled.groupBy("band").agg(_leader(turn))
        rest = labelled.join(leaders, "band").where("node <> lead.node").drop("lead")
        several = rest.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("band")
        old, named = named, ws.fresh("members")
        members = ws.write(rest.join(several, "band").select("band", "node", "n", "rank", "component"), named)
        ws.drop(old)
        if members.isEmpty():
            break
    return joined
