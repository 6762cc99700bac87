"""Groups of similar sets, found through postings and verified exactly; shared by the set-similarity operators.

Postings are rows (token, node): two nodes may be similar only if they share tokens. A few thousand near copies share
most of theirs, so their pairs are never listed. First each node is compared with one pivot only, the most
popular node it shares tokens with; what links forms groups. Only nodes of different groups are compared from then on,
which loses no connection. Where many of them meet at one key, they are compared in blocks of bounded size inside
tasks, and nothing but links leaves the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tarnlake.llm.common import stored


def similar(a: str, b: str, percent: int) -> Column:
    """Exact Jaccard similarity of two arrays of distinct hashes, in integers; empty sets are similar to nothing."""
    both = F.size(F.array_intersect(a, b))
    return (both > 0) & (both * 100 >= (F.size(a) + F.size(b) - both) * percent)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar; sets: (node, tokens)."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("_b"))
    near = (F.size("_a") * 100 >= F.size("_b") * percent) & (F.size("_b") * 100 >= F.size("_a") * percent)
    return pairs.join(left, "a").join(right, "b").filter(near & similar("_a", "_b", percent)).select("a", "b").distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable over links (a, b), for every node that has one.

    Large-star and small-star steps alternate until nothing changes; each is stored, so that the plan stays short and
    a lost executor costs one step. A node with very many links meets only its own minimum.
    """
    spark = links.sparkSession
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour points to the smallest node around.
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large, label)
        # Small star: the smaller neighbours of a node, and itself, point to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        small = stored(small, label)
        if small.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(small, ["u", "v"], "left_anti").isEmpty():
            break
        edges = small
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stored(nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct(), label)


def shared_postings(postings: DataFrame) -> DataFrame:
    """The postings (token, node, ...) whose token occurs with two nodes or more, with that number as ``n``.

    A node has many tokens and each at most once, so one token's rows are a small share of all."""
    return postings.withColumn("n", F.count("*").over(W.Window.partitionBy("token"))).filter("n > 1")


def differ(a: Column, b: Column, percent: int) -> Column:
    """Most tokens in which similar sets of these sizes can differ."""
    return F.floor((a + b) * (100 - percent) / (100 + percent))


def pivot_links(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes and the most popular node they share most tokens with.

    postings: stored rows (token, node, m, free, size, n); sets: stored rows (node, tokens). Of the m tokens that a node has
    of one kind, each token in which two sets differ spoils one at most; ``free`` of a node's m are not in the postings. So
    similar nodes share m less the most they can differ, but for the smaller ``free``. Postings without such a bound have m = 1
    and size 0: one shared token makes a candidate.
    """
    weight = postings.groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = stored(postings.join(weight, "node"), "weighed")
    pivots = weighed.groupBy("token").agg(F.max(F.struct("weight", "node", "size", "free")).alias("p"))
    chosen = weighed.join(pivots, "token").filter(F.col("p.node") != F.col("node")).groupBy("node", "m", "size", "free", "p").agg(
        F.count("*").alias("shared")).filter(
        F.col("shared") + F.least("free", "p.free") >= F.col("m") - differ(F.col("size"), F.col("p.size"), percent))
    pairs = chosen.groupBy("node").agg(F.max(F.struct("shared", "p")).alias("best")).select(
        F.col("node").alias("a"), F.col("best.p.node").alias("b"))
    return stored(verified(pairs, sets, percent), "pivot-links")


# Comparisons at one key beyond which they are made in blocks, and nodes on each side of a block.
MANY, BLOCK = 1024, 256
# Tokens up to which a group's union is kept as one array.
SHORT = 2000


def cross_links(asks: DataFrame, answers: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes that meet at a key and are in different groups; both sides: (key, node, root).

    Keys with few comparisons list their pairs. The others deal both sides into blocks by a hash of the node; a task
    compares one block with another and returns no more links than it takes to connect the groups in them.
    """
    meet = asks.groupBy("key").agg(F.count("*").alias("na")).join(answers.groupBy("key").agg(F.count("*").alias("nb")), "key")
    few, many = meet.filter(F.col("na") * F.col("nb") <= MANY), stored(meet.filter(F.col("na") * F.col("nb") > MANY), "many")
    left = asks.join(few.select("key"), "key").select("key", F.col("node").alias("a"), F.col("root").alias("ra"))
    right = answers.select("key", F.col("node").alias("b"), F.col("root").alias("rb"))
    listed = verified(left.join(right, "key").filter("ra <> rb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sets, percent)
    if many.isEmpty():
        return listed
    dealt = many.select("key", F.ceil(F.col("na") / BLOCK).cast("int").alias("qa"), F.ceil(F.col("nb") / BLOCK).cast("int").alias("qb"))

    def side(rows: DataFrame, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        block = F.pmod(F.xxhash64("node", F.lit(1)), F.col(own)).cast("int")
        dealt_rows = rows.join(dealt, "key").select(
            "key", "node", F.xxhash64("root").alias("root"), block.alias(names[0]),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(names[1])).join(sets, "node")
        # New names for the columns, as both sides come from the same tables.
        return dealt_rows.select(*(F.col(c).alias(c) for c in dealt_rows.columns))

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        found = matches(one.column("tokens"), one.column("root").to_numpy(), two.column("tokens"), two.column("root").to_numpy(), percent)
        a, b = (np.array([f[k] for f in found], dtype=np.int64) for k in (0, 1))
        return pa.Table.from_arrays([one.column("node").take(pa.array(a)), two.column("node").take(pa.array(b))], names=["a", "b"])

    node = next(f for f in sets.schema.fields if f.name == "node").dataType.simpleString()
    blocks = side(asks, "qa", "qb", ("x", "y")).groupBy("key", "x", "y").cogroup(
        side(answers, "qb", "qa", ("y", "x")).groupBy("key", "x", "y")).applyInArrow(compare, f"a {node}, b {node}")
    return listed.unionByName(blocks)


def matches(one: pa.ChunkedArray, roots: np.ndarray, two: pa.ChunkedArray, others: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Similar sets of two blocks, as many pairs as connect the roots they are under; connected ones are not compared again."""
    if not len(one) or not len(two):
        return []
    first, second = one.combine_chunks(), two.combine_chunks()
    values, place = np.unique(second.flatten().to_numpy(), return_inverse=True)
    ends = second.offsets.to_numpy() - second.offsets[0].as_py()
    sizes, out, roots, others = np.diff(ends), [], roots.copy(), others.copy()
    mine, at = first.flatten().to_numpy(), first.offsets.to_numpy() - first.offsets[0].as_py()
    for i in range(len(first)):
        tokens = mine[at[i] : at[i + 1]]
        near = (sizes * 100 >= len(tokens) * percent) & (len(tokens) * 100 >= sizes * percent) & (others != roots[i])
        if not near.any():
            continue
        where = np.searchsorted(values, tokens)
        where = where[where < len(values)]
        mark = np.zeros(len(values), np.int32)
        mark[where[np.isin(values[where], tokens)]] = 1
        both = np.add.reduceat(mark[place], ends[:-1])
        hit = np.flatnonzero(near & (both > 0) & (both * 100 >= (len(tokens) + sizes - both) * percent))
        for k in hit:
            old, new = others[k], roots[i]
            if old != new:
                out.append((i, int(k)))
                others[others == old] = new
                roots[roots == old] = new
    return out


# Groups at one token beyond which the nodes there are met by their rarest elements.
CROWD = 32


def met_by_rarest(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root, group): the larger groups with a member that a node may be similar to, by what they hold of these nodes.

    nodes: stored rows (node, root, members). All sets are put in one order, rare elements first. Two sets that must share T elements
    share one of the first |a| - T + 1 and |b| - T + 1. T is ``percent`` of the larger set at least, and more of the
    smaller one, so a short prefix of one meets a long one of the other. What many copies have in common comes last and what one of
    them has for itself comes first: copies that are too far apart to be similar hardly meet, however many there are.
    """
    size = F.size("tokens")
    rows = stored(nodes.join(sets, "node").select(
        "node", "root", "members", size.alias("size"), (size - F.ceil(size * percent / 100) + 1).alias("long"),
        (size - F.ceil(size * 2 * percent / (100 + percent)) + 1).alias("short"), F.explode("tokens").alias("token")), "elements")
    of = W.Window.partitionBy("node")
    placed = shared_postings(rows).withColumn(
        "rank", F.row_number().over(of.orderBy("n", "token")) + F.col("size") - F.count("*").over(of)).filter(F.col("rank") <= F.col("long"))
    rare = stored(placed.select("token", "node", "root", "members", (F.col("rank") <= F.col("short")).alias("first")), "rare")
    held = stored(rare.groupBy("token", F.col("root").alias("group")).agg(
        F.max("first").alias("group_first"), F.first("members").alias("group_members")), "held")
    asks = F.struct("members", "root") < F.struct(F.col("group_members").alias("members"), F.col("group").alias("root"))
    by_short = rare.filter("first").join(held, "token").filter(asks)
    by_long = rare.filter("not first").join(held.filter("group_first"), "token").filter(asks)
    return by_short.unionByName(by_long).select("node", "root", "group").distinct()


def link_by_matrix(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of groups of similar nodes by a token-group matrix; nodes without a link are absent.

    postings: stored rows (token, node, m, free, size, all, guest, n); ``all``: the node's tokens of this kind, shared or not;
    ``guest``: the node has tokens of another kind too, where all guests meet each other.
    """
    links = pivot_links(postings, sets, percent)
    groups = components(links, "pivot-groups")
    # A node that must share T of its tokens shares one of the rarest all - T + 1, and so does its partner.
    of = W.Window.partitionBy("node", "m")
    must = F.greatest(F.lit(1), F.col("m") - differ(F.col("size"), F.floor(F.col("size") * 100 / percent), percent) - F.col("free"))
    placed = postings.withColumns({
        "rank": F.row_number().over(of.orderBy("n", "token")) + F.col("all") - F.count("*").over(of)}).withColumn(
        "early", F.col("rank") <= F.col("all") - must + 1)
    placed = stored(placed.join(groups, "node", "left").select(
        "token", "node", "m", "free", "size", "guest", "early", F.coalesce("root", "node").alias("root")), "placed")
    members = stored(placed.select("root", "node", "size").distinct(), "members")
    sizes = members.groupBy("root").agg(F.count("*").alias("members"), F.max("size").alias("largest"))
    placed = stored(placed.join(sizes, "root"), "placed")

    # Token-group matrix: the union of each group's tokens, as rows.
    matrix = stored(placed.groupBy("token", "m", F.col("root").alias("group")).agg(
        F.max("early").alias("early"), F.max(F.col("early") & ~F.col("guest")).alias("host"), F.first("members").alias("group_members"), F.first("largest").alias("group_largest")), "matrix")
    # The smaller group's nodes ask the larger; equal ones in one direction. At a token of many groups, as of copies that no pivot
    # links, every node would ask every other.
    asks = F.struct("members", "root") < F.struct(F.col("group_members").alias("members"), F.col("group").alias("root"))
    columns = ["node", "m", "free", "size", "root", "group", "group_largest"]
    early, hosts = placed.filter("early"), matrix.filter("early").drop("early", "m")
    crowded = stored(hosts.groupBy("token").agg(F.count("*").alias("groups")).filter(F.col("groups") > CROWD).select("token"), "crowded")
    asked = early.join(hosts.join(crowded, "token", "left_anti"), "token").filter(asks & (~F.col("guest") | F.col("host"))).select(*columns)
    if not crowded.isEmpty():
        there = stored(early.join(crowded, "token", "left_semi").select("node", "root", "members").distinct(), "crowd")
        kinds = placed.select("node", "m", "free", "size").distinct()
        asked = asked.unionByName(met_by_rarest(there, sets, percent).join(kinds, "node").join(
            sizes.select(F.col("root").alias("group"), F.col("largest").alias("group_largest")), "group").select(*columns))
    asked = stored(asked.distinct(), "asked")
    # The overlap with short unions is counted on the rows as they are, with long ones token by token.
    widths = matrix.groupBy("group", "m").agg(F.count("*").alias("width"))
    short = matrix.join(widths.filter(F.col("width") <= SHORT), ["group", "m"]).groupBy("group", "m").agg(F.collect_list("token").alias("union"))
    own = placed.groupBy("node", "m").agg(F.collect_list("token").alias("own"))
    by_row = asked.join(short, ["group", "m"]).join(own, ["node", "m"]).select(*columns, F.size(F.array_intersect("own", "union")).cast("long").alias("shared"))
    by_token = asked.join(widths.filter(F.col("width") > SHORT).select("group", "m"), ["group", "m"]).join(
        placed.select("node", "m", "token"), ["node", "m"]).join(
        matrix.select("token", "group"), ["token", "group"], "left_semi").groupBy(*columns).agg(F.count("*").alias("shared"))
    overlap = by_row.unionByName(by_token)
    partner = F.least("group_largest", F.floor(F.col("size") * 100 / percent))
    opened = stored(overlap.filter(
        F.col("shared") + F.col("free") >= F.col("m") - differ(F.col("size"), partner, percent)).select(
        F.col("group").alias("key"), "node", "root").distinct(), "opened")
    inside = members.join(opened.select(F.col("key").alias("root")).distinct(), "root", "left_semi").select(
        F.col("root").alias("key"), "node", "root")
    more = stored(cross_links(opened, inside, sets, percent), "group-links")
    return components(links.unionByName(more), "groups")


def link_by_buckets(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of groups of similar nodes among those that share a bucket; nodes without a link are absent.

    postings: stored rows (token, node, n), one for each bucket a node is in.
    """
    bounds = {"m": F.lit(1), "free": F.lit(0), "size": F.lit(0).cast("long")}
    links = pivot_links(postings.withColumns(bounds), sets, percent)
    placed = stored(postings.join(components(links, "pivot-groups"), "node", "left").select(
        F.col("token").alias("key"), "node", F.coalesce("root", "node").alias("root")), "placed")
    mixed = placed.groupBy("key").agg((F.min("root") != F.max("root")).alias("mixed")).filter("mixed").select("key")
    placed = stored(placed.join(mixed, "key", "left_semi"), "mixed")
    more = stored(cross_links(placed, placed, sets, percent), "bucket-links")
    return components(links.unionByName(more), "groups")
