"""One-permutation MinHash against all pairs compared in plain Python."""

import random
import re

import numpy as np
import pytest

from tarnlake.llm import linking, minhash_dedup, textvec
from tarnlake.llm.common import bounded_batches

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(rows):
    """Components by all pairs; a row without id stands alone."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            e, b = sets[j]
            both = len(a & b)
            if d is not None and e is not None and both and 100 * both >= 85 * (len(a) + len(b) - both):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    out = []
    for i, (d, s) in enumerate(sets):
        c = low.get(find(i)) if d is not None else None
        out.append((d, len(s), c, d is None or c == d))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(text, seed, n):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def corpus(prose):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, prose(1, 80)), (None, prose(1, 80))]
    at = 10
    for k in range(40):
        n = 12 + 9 * k
        text = prose(k, n)
        rows.append((at, text))
        for e in range(4):
            rows.append((at + e + 1, edited(text, at + e, 1 + e * n // 120)))
        at += 5
    # A chain: neighbours are similar, its ends are not.
    w = prose(999, 260).split()
    for k in range(8):
        rows.append((at + k, " ".join(w[k * 12 : k * 12 + 170])))
    at += 10
    # A passage that many documents share, alone no reason to link.
    common = prose(500, 60)
    rows += [(at + k, prose(600 + k, 90) + " " + common) for k in range(30)]
    at += 40
    # Repeated rows, and two texts of one id.
    rows += [(at, prose(1, 84)), (at, prose(1, 84)), (at + 1, prose(1, 84)), (at + 2, prose(77, 90)), (at + 2, prose(78, 90)), (at + 3, prose(78, 90) + " end")]
    return rows


def test_components_equal_all_pairs(spark, docs, prose):
    bounded_batches(spark)
    rows = corpus(prose)
    want = plain(rows)
    assert 20 < sum(not r[3] for r in want) < len(want) - 20
    assert found(minhash_dedup.near_copies(docs(rows).repartition(5))) == want


def test_large_groups_of_different_near_copies(spark, docs, prose, monkeypatch):
    """Pairs of a bucket go beyond the list, so they are compared in blocks."""
    monkeypatch.setattr(linking, "MANY", 8)
    monkeypatch.setattr(linking, "BLOCK", 8)
    rows = []
    for g in range(3):
        text = prose(40 + g, 120)
        rows += [(1000 * g + k, edited(text, 7000 + 1000 * g + k, 1 + k % 3)) for k in range(60)]
    assert found(minhash_dedup.near_copies(docs(rows).repartition(5))) == plain(rows)


def test_empty_tables_and_missing_columns(spark, docs):
    assert found(minhash_dedup.near_copies(docs([]))) == []
    assert found(minhash_dedup.near_copies(docs([(1, None), (None, None)]))) == [(1, 0, 1, True), (None, 0, None, True)]
    with pytest.raises(ValueError, match="text"):
        minhash_dedup.near_copies(docs([]).drop("text"))


def test_bins_agree_as_often_as_sets_are_similar():
    """Densified bins too: sets far smaller than the number of bins."""
    r = np.random.default_rng(3)
    for size, share in ((8, 7), (20, 18), (60, 30), (500, 450)):
        hits = []
        for _ in range(200):
            x = textvec.mix(r.integers(0, 2**63, 2 * size - share, dtype=np.uint64))
            a, b = x[:size], x[size - share :]
            both = minhash_dedup.bins_of(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 168)
            assert (both != minhash_dedup.EMPTY).all()
            hits.append((both[0] == both[1]).mean())
        assert abs(np.mean(hits) - share / (2 * size - share)) < 0.04


def test_recall_of_buckets_at_the_wanted_similarity():
    """Pairs just above the bound, of all sizes, share a bucket."""
    r, missed, tried = np.random.default_rng(4), 0, 0
    for size in (6, 7, 9, 13, 20, 40, 100, 400):
        for _ in range(150):
            x = textvec.mix(r.integers(0, 2**63, 2 * size, dtype=np.uint64))
            # As many strangers as the bound allows, on one side or on both.
            for drop in range(size, -1, -1):
                inter, union = size - drop, size + drop
                if 100 * inter >= 85 * union:
                    break
            a, b = x[:size], x[drop : size + drop]
            if drop == 0:
                b = x[: size + 1]
                if 100 * size < 85 * (size + 1):
                    continue
            tried += 1
            both = minhash_dedup.bins_of(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 168)
            marks = minhash_dedup.band_marks(both, 28, 6)
            missed += not (marks[0] == marks[1]).any()
    assert tried > 900 and missed <= 2
