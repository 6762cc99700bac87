"""The trie of rebuilt conversations against prefixes listed in plain Python."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from tarnlake.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        full[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = collections.Counter(p[:-1] for p in members if p), collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(full[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS and {t for _, t in df.dtypes} == {"bigint", "string"}
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark):
    def make(rows):
        full = [(*r, 1, "x", 2) for r in rows]
        return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, depth int, p1 string, band int")
    return make


def talk(seed, convs, turns, ids):
    """Conversations of few different turns, so that prefixes are shared at all depths."""
    r, rows = random.Random(seed), []
    for _ in range(convs):
        c = ids(r)
        rows += [(c, t, r.choice(["user", "assistant"]), r.choice(["a", "bé", "long \U0001F600 text"])) for t in range(r.randrange(turns + 1))]
    return rows


def odd_rows():
    rows = talk(1, 150, 9, lambda r: r.randrange(400))
    rows += [(None, 0, "user", "a"), (7, None, "user", "first"), (7, None, None, None), (7, 3, None, "x"), (7, 3, "b", "x"), (7, 3, "b", "x")]
    rows += [(c, t, "user", f"t{t}") for c in (-5, -105, -100, 0) for t in range(8)]
    rows += [(900 + k, 0, "user", "") for k in range(7)]  # shorter than h, without a base: no turns are left
    rows += [(c, t, "user", "ab" if t < 150 or c % 2 else "abc") for c in (1000, 1003, 1004, 2001, 2005) for t in range(200)]  # several bands
    return rows


@pytest.mark.parametrize("shard_turns", [prefix_trie.SHARD, 40])
def test_nodes_equal_all_prefixes(spark, table, shard_turns):
    rows = odd_rows()
    want = plain(rows)
    assert len(want) > 500 and any(r[1] > 3 * prefix_trie.BAND for r in want)
    assert found(prefix_trie.prefix_nodes(table(rows).repartition(5), shard_turns=shard_turns)) == want


def test_one_conversation_in_thousands_of_copies(spark, table):
    """Most conversations are equal, the others part from them late; ids are longer than one chunk of the digest."""
    rows = [(c, t, "user", f"turn {t}" if c % 50 or t < 6 else f"own {c}") for c in range(3000) for t in range(7)]
    rows += [(c << 14, 0, "user", "turn 0") for c in range(1, 6)]
    assert found(prefix_trie.prefix_nodes(table(rows).repartition(3), shard_turns=100)) == plain(rows)


def test_tables_without_conversations(spark, table):
    assert found(prefix_trie.prefix_nodes(table([]))) == []
    assert found(prefix_trie.prefix_nodes(table([(None, 1, "user", "a")]))) == []
    empty = hashlib.sha256(b"").hexdigest()
    assert found(prefix_trie.prefix_nodes(table([(1, None, None, None)]))) in (
        [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())], sorted([(1, 0, None, 1, 1, 1, 0, empty), (1, 1, 1, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())], key=str))
    with pytest.raises(ValueError, match="turn"):
        prefix_trie.prefix_nodes(table([]).drop("turn"))


def test_double_array_finds_what_was_put_in_and_nothing_else():
    for seed in range(6):
        r = np.random.default_rng(seed)
        paths = r.integers(0, (2, 5, 40, 300)[seed % 4], (400, 5))
        trie, state = prefix_trie.DoubleArray(4, 4), np.zeros(len(paths), np.int64)
        trie.symbols, seen = int(paths.max()) + 1, {(): 0}
        for level in range(paths.shape[1]):
            pairs = np.unique(np.stack([state, paths[:, level]], axis=1), axis=0)
            trie.room(len(trie.check) + trie.symbols)
            trie.grow(pairs[:, 0], pairs[:, 1])
            state = trie.step(state, paths[:, level])
            seen.update({tuple(p[: level + 1]): s for p, s in zip(paths.tolist(), state.tolist())})
        assert len(set(seen.values())) == len(seen)
        for path, s in list(seen.items())[:200]:
            inside = {c for c in range(trie.symbols) if (path + (c,)) in seen}
            slots = trie.base[s] + np.arange(trie.symbols)
            real = (slots > 0) & (slots < len(trie.check))
            hit = {int(c) for c in np.flatnonzero(real) if trie.check[slots[c]] == s}
            assert hit == inside or not inside
        absent = [c for c in range(trie.symbols + 2) if (c,) not in seen]
        for c in absent:
            with pytest.raises(ValueError, match="lacks"):
                trie.step(np.zeros(1, np.int64), np.array([c]))
