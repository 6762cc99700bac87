"""Conversations as a prefix trie, packed shard by shard into double arrays.

Conversations are rebuilt as the contract of ``rebuilt`` says and cut into segments of ``BAND`` turns. A prefix is known by an
exclusive-or over hashes of its turns and their places (128 bits), so the prefix before any segment follows from whole segments.
Equal segments after the same prefix are one row, however many conversations share it. Rows are dealt into shards
by prefix and first turn; a prefix with more turns than a shard should hold is dealt on by its segment's end. A shard numbers its turns
densely, packs BASE and CHECK arrays (the child of state s by turn t is BASE[s] + t, if CHECK there says s) and walks its
segments through them; the states met are nodes. Nodes near the root are met in several shards and segments are met in bands: counts
and smallest members are merged over all shards by prefix.

Sums over subtrees need no walk from level to level. A node belongs to its smallest member. What one conversation owns is one
path down to its end, so its own nodes are summed along that path, and the whole sum is added to every node above the path, in a second
walk of the shards. All of it grows with the number of turns.

``conversations`` are ordered by turn, nulls first, ties by role and text; null role or text is empty text. Rows without ``conv_id`` belong to no
conversation and are left out. Repeated rows are turns of their own. An empty table gives an empty result, otherwise there is a
root. Other columns are ignored. A turn of any length counts by its code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tarnlake.llm.common import need, small, stored

# Turns of a segment, and turns that a shard holds by and large.
BAND, SHARD = 64, 20_000
# Members whose ids are joined into one text before they are hashed: 2 to this power.
CHUNK_BITS = 14
KEY = ["p1", "p2", "depth"]
# What CHECK says of a slot without a state, and of the root, which is nobody's child.
FREE, ROOT = -1, -2


class DoubleArray:
    """BASE and CHECK over dense symbols; state 0 is the root."""

    def __init__(self, nodes: int, symbols: int):
        self.base = np.zeros(nodes + 2 * symbols + 64, np.int64)
        self.check = np.full(len(self.base), FREE)
        self.check[0] = ROOT
        self.symbols, self.low = symbols, 1

    def room(self, slots: int) -> None:
        if slots >= len(self.check):
            more = max(slots + 1 - len(self.check), len(self.check) // 2)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, FREE))

    def free(self, many: int) -> np.ndarray:
        """The first free slots."""
        while True:
            found = self.low + np.flatnonzero(self.check[self.low :] == FREE)
            if len(found) >= many:
                self.low = int(found[0])
                return found
            self.room(len(self.check) + many)

    def fit(self, codes: np.ndarray) -> int:
        """The first base at which every one of the codes has a free slot; codes ascend."""
        at = 0
        while True:
            # Beyond the last used slot anything fits, so the search ends.
            self.room(len(self.check) + self.symbols - 1 if at >= len(self.check) - self.symbols else 0)
            first = self.free(1)
            first = first[first >= at][:256]
            first = first[first + (codes[-1] - codes[0]) < len(self.check)]
            if not len(first):
                at = len(self.check)
                self.room(len(self.check) + self.symbols + 256)
                continue
            open_ = (self.check[first[:, None] + (codes - codes[0])] == FREE).all(axis=1)
            if open_.any():
                return int(first[open_.argmax()] - codes[0])
            at = int(first[-1]) + 1

    def grow(self, states: np.ndarray, codes: np.ndarray) -> None:
        """Give states their children: distinct pairs (state, code), in order."""
        new = np.flatnonzero(np.append(True, states[1:] != states[:-1]))
        counts = np.diff(np.append(new, len(states)))
        for k in np.flatnonzero(counts > 1)[np.argsort(-counts[counts > 1], kind="stable")]:
            own = codes[new[k] : new[k] + counts[k]]
            state, base = states[new[k]], self.fit(own)
            self.base[state] = base
            self.check[base + own] = state
        # A single child fits anywhere: these fill the holes.
        single = new[counts == 1]
        if len(single):
            slots = self.free(len(single))[: len(single)]
            self.base[states[single]] = slots - codes[single]
            self.check[slots] = states[single]

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children by these codes; each must be there."""
        to = self.base[states] + codes
        if ((to < 0) | (to >= len(self.check))).any() or (self.check[to] != states).any():
            raise ValueError("the trie lacks a prefix")
        return to


def dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers 0, 1, ... of distinct pairs, the most frequent first."""
    _, number, counts = np.unique(np.rec.fromarrays([first, second]), return_inverse=True, return_counts=True)
    place = np.empty(len(counts), np.int64)
    place[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    return place[number.reshape(-1)]


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


class Shard:
    """Segments of one shard, their double array and the state after each turn."""

    def __init__(self, table: pa.Table):
        turns = table.column("turns").combine_chunks()
        if isinstance(turns, pa.ChunkedArray):
            turns = turns.chunk(0)
        flat = turns.flatten()
        self.field = {f.name: flat.field(f.name).to_numpy() for f in flat.type}
        self.at = turns.offsets.to_numpy()[:-1] - turns.offsets[0].as_py()
        self.size = np.diff(turns.offsets.to_numpy())
        self.band, start = column(table, "band").astype(np.int64), [column(table, c) for c in ("s1", "s2")]
        # The first symbol is the prefix before the segment, the others are its turns.
        prefix = dense(start[0] ^ self.band, start[1])
        code = dense(self.field["h1"], self.field["h2"]) if len(flat) else np.zeros(0, np.int64)
        self.trie = DoubleArray(len(flat) + len(prefix) + 1, int(max(prefix.max(initial=0), code.max(initial=0))) + 1)
        state, self.steps = np.zeros(len(prefix), np.int64), []
        for level in range(int(self.size.max(initial=0)) + 1):
            rows = np.flatnonzero(self.size >= level)
            by = prefix if level == 0 else code[self.at[rows] + level - 1]
            pairs = np.unique(np.stack([state[rows], by], axis=1), axis=0)
            self.trie.grow(pairs[:, 0], pairs[:, 1])
            state[rows] = self.trie.step(state[rows], by)
            self.steps.append((rows, by))
        # Prefix keys after each turn.
        self.start, self.keys = start, []
        owner = np.repeat(np.arange(len(prefix)), self.size)
        for s, g in zip(start, ("g1", "g2")):
            run = np.append(0, np.bitwise_xor.accumulate(self.field[g]) if len(flat) else []).astype(np.int64)
            self.keys.append(run[1:] ^ run[self.at[owner]] ^ s[owner])

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(turns so far, segments still there, their states) from the prefix on."""
        state = np.zeros(len(self.size), np.int64)
        for level, (rows, by) in enumerate(self.steps):
            state[rows] = self.trie.step(state[rows], by)
            # The place before a later band's first turn is the end of a segment of the band before.
            yield level, rows if level else rows[self.band[rows] == 0], state

    def key(self, level: int, rows: np.ndarray) -> list[np.ndarray]:
        return [s[rows] if level == 0 else k[self.at[rows] + level - 1] for s, k in zip(self.start, self.keys)]


def shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of a shard: smallest member and number of members in this shard, length of the turn, key of the parent."""
    shard, out = Shard(table), []
    conv, copies = column(table, "conv_id"), column(table, "copies")
    for level, rows, state in shard.walk():
        if not len(rows):
            continue
        nodes, first, number = np.unique(state[rows], return_index=True, return_inverse=True)
        least, members = np.full(len(nodes), np.iinfo(np.int64).max), np.zeros(len(nodes), np.int64)
        np.minimum.at(least, number.reshape(-1), conv[rows])
        np.add.at(members, number.reshape(-1), copies[rows])
        at = rows[first]
        own, above = shard.key(level, at), shard.key(max(level - 1, 0), at)
        length = shard.field["len"][shard.at[at] + level - 1].astype(np.int64) if level else np.zeros(len(at), np.int64)
        out.append([*own, shard.band[at] * BAND + level, least, members, length, *above])
    return pa.Table.from_arrays(
        [pa.array(np.concatenate(c)) if out else pa.array([], pa.int64()) for c in (zip(*out) if out else [[]] * 8)],
        names=[*KEY, "conv_id", "n_convs", "len", "q1", "q2"])


def shard_sums(table: pa.Table) -> pa.Table:
    """What the segments bring to the nodes of a shard that lie above their cut."""
    shard, out = Shard(table), []
    cut, weights = column(table, "cut"), [column(table, c) for c in ("leaves", "saved")]
    for level, rows, state in shard.walk():
        rows = rows[shard.band[rows] * BAND + level < cut[rows]]
        if not len(rows):
            continue
        _, first, number = np.unique(state[rows], return_index=True, return_inverse=True)
        sums = [np.zeros(len(first), np.int64) for _ in weights]
        for s, w in zip(sums, weights):
            np.add.at(s, number.reshape(-1), w[rows])
        out.append([*shard.key(level, rows[first]), shard.band[rows[first]] * BAND + level, *sums])
    return pa.Table.from_arrays(
        [pa.array(np.concatenate(c)) if out else pa.array([], pa.int64()) for c in (zip(*out) if out else [[]] * 5)],
        names=[*KEY, "leaves", "saved"])


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, i, h1, h2, len: every turn with its place in its conversation from 0 and two hashes.

    Turns are range-partitioned and numbered through, so that one very long conversation is no task of its own."""
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first()]
    placed = stored(turns.repartitionByRange(*by).sortWithinPartitions(*by, "role", "text").select(
        "conv_id", F.monotonically_increasing_id().alias("at"), F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit(1), "text", "role").alias("h2"), F.length("text").cast("long").alias("len")), "turns")
    part, local = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    # One row for each partition.
    before = F.coalesce(F.sum("n").over(W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", before.alias("before")))
    numbered = placed.withColumn("part", part).join(offsets, "part").withColumn("number", F.col("before") + local).drop("part", "before", "at")
    first = numbered.groupBy("conv_id").agg(F.min("number").alias("first"))
    return stored(numbered.join(first, "conv_id").select("conv_id", (F.col("number") - F.col("first")).alias("i"), "h1", "h2", "len"), "ordered")


def rebuilt(turns: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, ...) of every rebuilt turn, d from 1, and the conversations without any.

    Conversation c begins with the first h turns of conversation c - c % every, h = crc32 of c's digits % most; its own turns after
    its first h follow."""
    columns = ["h1", "h2", "len"]
    heads = turns.filter((F.col("conv_id") % every == 0) & (F.col("i") < most - 1)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("i", *columns))).alias("head")).withColumnRenamed("conv_id", "base")
    plans = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumns({
        "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"), "base": F.col("conv_id") - F.col("conv_id") % every})
    plans = stored(plans.join(heads, "base", "left").select(
        "conv_id", "own", "h", F.slice(F.coalesce("head", F.expr("array()").cast("array<struct<i:bigint,h1:bigint,h2:bigint,len:bigint>>")), 1, F.col("h")).alias("head")), "plans")
    begun = plans.select("conv_id", F.explode("head").alias("x")).select("conv_id", (F.col("x.i") + 1).alias("d"), *(F.col(f"x.{c}").alias(c) for c in columns))
    follow = turns.join(plans.select("conv_id", "h", F.size("head").alias("k")), "conv_id").filter(F.col("i") >= F.col("h")).select(
        "conv_id", (F.col("i") - F.col("h") + F.col("k") + 1).alias("d"), *columns)
    return begun.unionByName(follow), plans.filter((F.size("head") == 0) & (F.col("own") <= F.col("h"))).select("conv_id")


def segments_of(turns: DataFrame, silent: DataFrame) -> DataFrame:
    """conv_id, band, the key before (s1, s2) and after (p1, p2, depth), turns and whether the conversation ends there."""
    placed = turns.withColumns({
        "band": F.floor((F.col("d") - 1) / BAND).cast("int"), "g1": F.xxhash64("h1", "d"), "g2": F.xxhash64("d", "h2")})
    cut = placed.groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(F.struct("d", "h1", "h2", "g1", "g2", "len"))).alias("turns"), F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"))
    kind = dict(cut.dtypes)["turns"]
    zero = F.lit(0).cast("long")
    cut = cut.unionByName(silent.select(
        "conv_id", F.lit(0).alias("band"), F.expr("array()").cast(kind).alias("turns"), zero.alias("x1"), zero.alias("x2")))
    along = W.Window.partitionBy("conv_id").orderBy("band")
    before = along.rowsBetween(W.Window.unboundedPreceding, -1)
    keyed = cut.withColumns({
        "s1": F.coalesce(F.bit_xor("x1").over(before), zero), "s2": F.coalesce(F.bit_xor("x2").over(before), zero),
        "last": F.lead("band").over(along).isNull()})
    return keyed.select(
        "conv_id", "band", "s1", "s2", F.col("s1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("s2").bitwiseXOR(F.col("x2")).alias("p2"),
        (F.col("band") * BAND + F.size("turns")).cast("long").alias("depth"), "turns", "last")


def dealt(segments: DataFrame, shard_turns: int) -> DataFrame:
    """Distinct segments with their smallest conversation, number of copies and shard."""
    distinct = segments.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"), F.first("band").alias("band"),
        F.first("s1").alias("s1"), F.first("s2").alias("s2"), F.first("turns").alias("turns"))
    distinct = stored(distinct.withColumn("prefix", F.xxhash64(
        "band", "s1", "s2", F.coalesce(F.get("turns", F.lit(0))["h1"], F.lit(0)))), "distinct-segments")
    turns = F.sum(F.size("turns") + 1)
    total = distinct.agg(turns).first()[0] or 0
    shards = max(1, -(-total // shard_turns))
    # No more of these than shards.
    hot = small(stored(distinct.groupBy("prefix").agg(turns.alias("n")).filter(F.col("n") > shard_turns).select(
        "prefix", F.ceil(F.col("n") / shard_turns).alias("parts")), "hot-prefixes"), 100_000)
    salt = F.coalesce(F.pmod(F.xxhash64("p1", "p2"), F.col("parts")), F.lit(0))
    return stored(distinct.join(hot, "prefix", "left").withColumn(
        "shard", F.pmod(F.xxhash64("prefix", salt), F.lit(shards)).cast("int")).drop("prefix", "parts"), "shards")


def end_digests(ends: DataFrame) -> DataFrame:
    """Key and ends_sha256 of every node at which conversations end: ids in order, comma-joined, hashed as a stream."""
    chunks = ends.groupBy(*KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, pa.schema([(c, pa.int64()) for c in KEY] + [("ends_sha256", pa.string())]))

        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append({**dict(zip(KEY, now)), "ends_sha256": state.hexdigest()})
                now, state = key, hashlib.sha256(ids.encode())
            yield done(out)
        if now is not None:
            yield done([{**dict(zip(KEY, now)), "ends_sha256": state.hexdigest()}])

    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids").mapInArrow(
        hashed, "p1 long, p2 long, depth long, ends_sha256 string")


def prefix_nodes(conversations: DataFrame, every: int = 100, most: int = 6, shard_turns: int = SHARD) -> DataFrame:
    """Every node of the trie of rebuilt conversations; see the module."""
    need(conversations, "conv_id", "turn", "role", "text")
    turns, silent = rebuilt(ordered(conversations), every, most)
    segments = stored(segments_of(turns, silent), "segments")
    shards = dealt(segments, shard_turns)
    merged = shards.groupBy("shard").applyInArrow(
        shard_nodes, "p1 long, p2 long, depth long, conv_id long, n_convs long, len long, q1 long, q2 long")
    nodes = stored(merged.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("len").alias("len"),
        F.first("q1").alias("q1"), F.first("q2").alias("q2")), "nodes")
    zero = F.lit(0).cast("long")
    children = nodes.filter("depth > 0").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(parents, ["q1", "q2", "depth"], "left").join(children, KEY, "left").select(
        *KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("len")).alias("value"),
        F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / BAND).cast("int").alias("band"))
    nodes = stored(nodes, "linked-nodes")

    # Along the path that a conversation owns: first in a band, then the bands after it.
    bands = nodes.groupBy("conv_id", "band").agg(F.min("depth").alias("top"), F.sum("leaf").alias("leaves"), F.sum("value").alias("saved"))
    after = W.Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(W.Window.unboundedPreceding, -1)
    later = bands.select("conv_id", "band", *(F.coalesce(F.sum(c).over(after), zero).alias(f"later_{c}") for c in ("leaves", "saved")))
    down = W.Window.partitionBy("conv_id", "band").orderBy(F.desc("depth")).rowsBetween(W.Window.unboundedPreceding, 0)
    owned = nodes.withColumns({"own_leaves": F.sum("leaf").over(down), "own_saved": F.sum("value").over(down)}).join(later, ["conv_id", "band"])

    # Above it: the whole of the path counts for every node there.
    chains = bands.groupBy("conv_id").agg(F.min("top").alias("top"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).filter("top > 0")
    above = segments.select("conv_id", "band", *KEY).join(chains, "conv_id").filter(F.col("band") * BAND < F.col("top")).groupBy(
        *KEY, F.least("top", F.col("depth") + 1).alias("cut")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    weighed = shards.select("shard", *KEY, "band", "s1", "s2", "turns").join(above, KEY)
    added = weighed.groupBy("shard").applyInArrow(shard_sums, "p1 long, p2 long, depth long, leaves long, saved long").groupBy(*KEY).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    ends = end_digests(segments.filter("last").select(*KEY, "conv_id"))
    return owned.join(added, KEY, "left").join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("own_leaves") + F.col("later_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("own_saved") + F.col("later_saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


ORACLE = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, CAST(row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS BIGINT) AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), CAST(4294967295 AS BIGINT)) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i < c.h
  UNION ALL SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i >= c.h),
s AS (SELECT c.conv_id, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY r.i) FILTER (WHERE r.i IS NOT NULL), []) AS turns
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, d, turns[1 : d] AS path, len(turns) AS n FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM s)),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256 FROM m GROUP BY path, d),
k AS (SELECT path[1 : d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.path[n.d].text) END AS value
  FROM n LEFT JOIN k ON n.d = k.d AND n.path = k.path),
u AS (SELECT path[1 : up] AS path, up AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(value) AS saved
  FROM (SELECT path, n_children, value, unnest(range(0, d + 1)) AS up FROM v) GROUP BY ALL)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children,
  CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN u ON v.d = u.d AND v.path = u.path LEFT JOIN n p ON p.d = v.d - 1 AND p.path = v.path[1 : v.d - 1]"""
