"""Links between nodes that meet under a common key, without all pairs.

Nodes (classes of equal texts, distinct lines) carry keys; two nodes may be
linked only if they share one.  ``linked_groups`` finds the connected groups
of confirmed links:

1. In ``ROUNDS`` rounds, every key gets a hub and members are paired with hubs
   only, so g nodes under one key give g pairs and not g * g.  The hub is the
   smallest node after an exclusive-or with a constant that differs by round
   and between four kinds of keys: a keyed minimum, combined before the
   shuffle, that picks several nodes of a group.  The join back to the hubs is one that
   adaptive execution splits where a key is hot.
2. Pairs that pass a cheap test on carried columns are confirmed; components
   of the links decide which keys go on to the next round: those whose
   members still belong to several.
3. What is left is compared exhaustively: pairs across components under a
   common key (the members outside its largest component with all others),
   each pair once (at the first key both share), same test, same confirmation.  No link is lost that could change the groups: in the end
   every two nodes under a key are in one component, have failed the cheap
   test, or have been compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from weatherlake.llm import textarrays as ta
from weatherlake.llm.components import connected_components
from weatherlake.llm.shared import Bloom, cut, stored

UNIT = 64  # members confirmed against one hub at a time
ROUNDS = 1
HUBS = 4  # per group of nodes and round


def _turned(node: str, turn: int) -> Column:
    """The node with some bits flipped; applied twice it is the node again."""
    flips = ta.constants(71 + turn, HUBS).astype("int64").tolist()
    return F.col(node).bitwiseXOR(F.array(*[F.lit(f) for f in flips])[F.pmod("key", F.lit(HUBS)).cast("int")])


def linked_groups(keys: DataFrame, info: DataFrame, plausible: Callable[[str, str], Column],
                  first_meeting: Callable[[str, str, str], Column], confirm: Callable[[DataFrame, DataFrame], DataFrame],
                  texts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keys``: key (a hash), place (of the key among a node's keys), node.  ``info``:
    node and what the tests read.  Both may hold a node more than once.  ``plausible`` gets the names of two struct
    columns with an info row each, ``first_meeting`` the name of the place
    column as well: whether the two nodes share no key at an earlier place.
    ``texts`` gets the nodes that share a key and prepares what ``confirm``
    reads, once; ``confirm`` maps pairs (src, dst) to those that are links.
    Returns ``node``, ``component`` for nodes with a link."""
    several = cut(keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key"))
    likely = keys.filter(Bloom(several, "key").condition(F.col("key")))
    live = stored(likely.join(several.hint("shuffle_hash"), "key").select("key", "place", "node").distinct())
    nodes = cut(live.select("node").distinct())
    known = info.join(nodes.hint("shuffle_hash"), "node", "left_semi").dropDuplicates(["node"])
    known = stored(known.select("node", F.struct(*[c for c in info.columns if c != "node"]).alias("info")))
    material = texts(nodes)
    links = groups = None
    for turn in range(ROUNDS):
        hubs = live.groupBy("key").agg(F.min(_turned("node", turn)).alias("least")).select("key", _turned("least", turn).alias("hub"))
        pairs = (live.join(hubs.hint("shuffle_hash"), "key").filter("node <> hub")
                 .select(F.greatest("node", "hub").alias("src"), F.least("node", "hub").alias("dst")).distinct())
        if groups is not None:
            of = groups.select(F.col("node").alias("src"), F.col("component").alias("c"))
            to = groups.select(F.col("node").alias("dst"), F.col("component").alias("d"))
            pairs = (pairs.join(of, "src", "left").join(to, "dst", "left")
                     .filter(F.coalesce("c", "src") != F.coalesce("d", "dst")).select("src", "dst"))
        near = (pairs.join(known.select(F.col("node").alias("src"), F.col("info").alias("p")), "src")
                .join(known.select(F.col("node").alias("dst"), F.col("info").alias("q")), "dst")
                .filter(plausible("p", "q")).select("src", "dst"))
        found = cut(confirm(cut(near), material))
        links = found if links is None else links.unionByName(found)
        groups = connected_components(links)
        member = live.join(groups, "node", "left").select("key", "place", "node", F.coalesce("component", "node").alias("component"))
        mixed = member.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
        member = cut(member.join(mixed.select("key").hint("shuffle_hash"), "key"))
        live = member.select("key", "place", "node")

    # the largest component of a key is paired with the others only, not with itself
    sizes = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m")).select("key", F.col("m.component").alias("main"))
    member = stored(member.join(main, "key").join(known, "node"))
    left = member.filter("component <> main").select(
        "key", "place", F.col("node").alias("src"), F.col("component").alias("c"), F.col("info").alias("p"))
    right = member.select(F.col("key").alias("k"), F.col("node").alias("dst"), F.col("component").alias("d"), "main", F.col("info").alias("q"))
    across = left.join(right, (F.col("key") == F.col("k")) & (F.col("c") != F.col("d")) & ((F.col("d") == F.col("main")) | (F.col("c") > F.col("d")))
                       & plausible("p", "q") & first_meeting("p", "q", "place")).select("src", "dst")
    more = cut(confirm(cut(across.distinct()), material))
    return groups if more.isEmpty() else connected_components(links.unionByName(more))


def in_units(pairs: DataFrame) -> DataFrame:
    """Pairs (src, dst) as rows (hub, part, node) for a confirmation that
    reads each node's text once per unit: the members of one hub (dst) are
    dealt into units of about ``UNIT`` and the hub itself goes to each, so
    no text is copied per pair and a hub with many members spreads out."""
    units = pairs.groupBy("dst").agg(F.ceil(F.count(F.lit(1)) / UNIT).alias("parts"))
    dealt = pairs.join(units, "dst").select(
        F.col("dst").alias("hub"), F.pmod(F.xxhash64("src"), "parts").alias("part"), F.col("src").alias("node"))
    return dealt.unionByName(dealt.select("hub", "part", F.col("hub").alias("node")).distinct())


def hub_first(rows: DataFrame) -> DataFrame:
    """Rows (hub, part, node, ...) brought together by unit, the hub's row first."""
    return (rows.withColumn("later", F.col("node") != F.col("hub")).repartition("hub", "part")
            .sortWithinPartitions("hub", "part", "later").drop("later"))
