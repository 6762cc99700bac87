"""Operators that compare documents or fit models: against brute force, round trips and held-out labels."""

import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import decontaminate, domain_mix, linking, neighbour_quality, paragraph_dedup, shingle_join, textvec, token_shards
from tarnlake.llm.common import bounded_batches, stored
from tarnlake.session import fresh_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def edited(text, seed, n):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_batches_of_words_and_sets_equal_plain_python(prose):
    texts = [None, "", " a", "a", "a b", "A b\x0bC", "x\x85y z", prose(1, 50), "q" * 3000, "e", "", "a b c a b c a b c"]
    for size in (1, 1 << 20):
        for k in (1, 3, 5):
            found = []
            for rows, data, offsets in textvec.pieces(pa.array(["skip", *texts]).slice(1), size):
                h, t = textvec.words(data, offsets)
                assert np.bincount(t, minlength=len(offsets) - 1).tolist() == [len(words(x)) for x in texts[rows]]
                h, ends = textvec.sets(*textvec.shingles(h, t, k), len(offsets) - 1)
                found += [set(h[a:b].tolist()) for a, b in zip(ends, ends[1:])]
            plain = [shingle_set(x, k) for x in texts]
            assert [len(f) for f in found] == [len(p) for p in plain]
            assert [[len(a & b) for b in found] for a in found] == [[len(a & b) for b in plain] for a in plain]


def test_similar_sets_always_share_blocks():
    r = np.random.default_rng(0)
    for percent, size in ((90, 9), (90, 10), (90, 14), (90, 15), (90, 60), (90, 163), (80, 4), (80, 40), (80, 500)):
        for _ in range(40):
            a = np.unique(r.integers(0, 2**63, size, dtype=np.uint64))
            drop = r.integers(0, max(1, len(a) * (100 - percent) // 100) + 1)
            b = np.unique(np.concatenate([a[drop:], r.integers(0, 2**63, r.integers(0, drop + 1), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both == len(a) == len(b) or 100 * both < percent * (len(a) + len(b) - both):
                continue
            kinds = {m: (e, set(t)) for m, e, t in shingle_join.blocks_of(a, percent)}
            most = (len(a) + len(b)) * (100 - percent) // (100 + percent)
            ok = False
            for m, e, t in shingle_join.blocks_of(b, percent):
                if m in kinds:
                    shared = len(kinds[m][1] & set(t))
                    ok |= shared >= 1 and shared + min(e, kinds[m][0]) >= m - most
            assert ok, (percent, len(a), len(b), both)


def test_jaccard_join_equals_brute_force(spark, docs, prose):
    bounded_batches(spark)
    base = [prose(s, n) for s, n in ((1, 200), (2, 90), (3, 40), (4, 12))]
    texts = [*base, None, "", " \n", "one", "One", "one two", base[0], base[0].upper()]
    for s in range(60):
        texts.append(edited(base[s % 3], s, s % 9))
    passage = prose(9, 60)
    texts += [f"{prose(100 + s, 30)} {passage} {prose(200 + s, 30)}" for s in range(40)]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    sets = {i: shingle_set(t, 3) for i, t in rows}
    links = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and x and 100 * len(x & y) >= 90 * len(x | y)]
    assert len(links) > 60
    want = roots(sets, links)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.join_documents(docs(rows)).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}
    left = shingle_join.representatives(docs([*rows, rows[0], (None, base[0])]), 90, 3)
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert left.filter("doc_id is null").count() == 1 and left.columns == docs(rows).columns
    assert shingle_join.join_documents(docs(rows).limit(0)).count() == 0


def test_an_id_with_two_texts_loses_only_the_copy(docs, prose):
    a, u, v = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a), (2, a), (2, u), (3, u), (3, v), (4, a.upper()), (4, a), (4, a), (5, None), (5, ""), (6, "x"), (6, "y")]
    for percent, size in ((80, 5), (90, 3)):
        left = sorted(((r.doc_id, r.text) for r in shingle_join.representatives(docs(rows), percent, size).collect()), key=str)
        assert left == sorted([(1, a), (2, u), (3, v), (5, None), (5, ""), (6, "x"), (6, "y")], key=str)
    found = shingle_join.join_documents(docs([(9, u), *rows]))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == sorted(
        [(9, 2), (1, 1), (2, 1), (2, 2), (3, 2), (3, 3), (4, 1), (4, 1), (4, 1), (5, 5), (5, 5), (6, 6), (6, 6)])


def test_hot_groups_are_compared_in_blocks(spark, prose, monkeypatch):
    monkeypatch.setattr(linking, "MANY", 4)
    monkeypatch.setattr(linking, "BLOCK", 3)
    r = random.Random(5)
    sets = {i: sorted(r.sample(range(30), 20)) for i in range(40)}
    rows = stored(spark.createDataFrame([(i, s) for i, s in sets.items()], "node long, tokens array<long>"), "s")
    meet = stored(spark.createDataFrame([(1, i, i) for i in sets], "key int, node long, root long"), "m")
    found = [(a, b) for a, b in linking.cross_links(meet, meet, rows, 60).collect()]
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len({*sets[a]} & {*sets[b]}) >= 60 * len({*sets[a]} | {*sets[b]})]
    assert roots(sets, found) == roots(sets, links) and all((min(x), max(x)) in links for x in found)


def test_copies_that_no_pivot_links_ask_few_groups(spark, docs, prose, monkeypatch):
    bounded_batches(spark)
    base, asked = prose(1, 120), []
    # Too far from the text and from each other, but for some that have a near copy of their own.
    rows = [(i, edited(base, i, 4)) for i in range(160)] + [(1000 + i, edited(edited(base, i, 4), 5000 + i, 1)) for i in range(0, 160, 10)]

    def counted(df, label, *more, **named):
        out = stored(df, label, *more, **named)
        if label == "asked":
            asked.append(out.count())
        return out

    monkeypatch.setattr(linking, "stored", counted)
    monkeypatch.setattr(linking, "CROWD", 8, raising=False)
    got = {r.doc_id: r.component_id for r in shingle_join.join_documents(docs(rows), 80, 5).collect()}
    sets = {i: shingle_set(t, 5) for i, t in rows}
    links = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and 100 * len(x & y) >= 80 * len(x | y)]
    assert got == roots(sets, links) and 16 <= len(links) < 40
    # All pairs of them would be some 15,000.
    assert sum(asked) < 10 * len(rows)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_similar_sets_meet_by_their_rarest_elements(spark, monkeypatch, percent):
    r = random.Random(percent)
    base, sets = r.sample(range(10**6), 40), {}
    for i in range(150):
        kept = r.sample(base, r.randrange(20, 41)) if i % 3 else base[: r.randrange(1, 41)]
        sets[i] = sorted({*kept, *(r.randrange(10**6 if i % 2 else 60) for _ in range(r.randrange(8)))})
    table = stored(spark.createDataFrame(list(sets.items()), "node long, tokens array<long>"), "s")
    # Every third node is in the group of a neighbour.
    groups = {i: i - (i % 3 == 2) for i in sets}
    members = collections.Counter(groups.values())
    nodes = stored(spark.createDataFrame([(i, g, members[g]) for i, g in groups.items()], "node long, root long, members long"), "n")
    got = {(x.node, x.root, x.group) for x in linking.met_by_rarest(nodes, table, percent).collect()}
    want = {
        (a, groups[a], groups[b]) for a in sets for b in sets if (members[groups[a]], groups[a]) < (members[groups[b]], groups[b])
        and 100 * len({*sets[a]} & {*sets[b]}) >= percent * len({*sets[a]} | {*sets[b]})}
    assert len(want) > 5 and want <= got


def test_the_join_is_whole_if_all_nodes_meet_by_their_rarest_elements(spark, docs, prose, monkeypatch):
    monkeypatch.setattr(linking, "CROWD", 0)
    test_jaccard_join_equals_brute_force(spark, docs, prose)


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = dict(linking.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {n: v for n, v in roots({x for e in edges for x in e}, edges).items() if n in got}
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_contamination_equals_brute_force(spark, docs, prose):
    item = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII))
    a, b = prose(1, 14), prose(2, 30)
    items = [(1, a), (2, b), (3, "Tiny item"), (4, None), (5, " -- "), (6, a), (10, "solo"), (None, b), (2, b), (11, "one two three four five six")]
    texts = [None, "", "--", prose(3, 50), f"{prose(4, 20)} {a.upper()}! {prose(5, 9)}", " ".join(a.split()[:9]), " ".join(b.split()[4:16]),
             f"{a} {a} {b}", "x tiny, ITEM solo", "solo solo", "tiny", "one two three four five six seven"]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, th int")
    rows = [*enumerate(texts), (7, texts[7]), (7, texts[3]), (None, texts[4])]
    got = collections.Counter(map(tuple, decontaminate.digest(decontaminate.contamination(docs(rows), bench)).collect()))
    want = collections.Counter()
    import hashlib

    for i, t in rows:
        w, hit, ids = item(t), set(), set()
        for name, x in items:
            v = item(x)
            n = min(10, len(v))
            for s in range(len(v) - n + 1) if name is not None and v else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[s : s + n]:
                        hit.update(range(p, p + n))
                        ids.add(str(name))
        want[(i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))] += 1
    assert got == want
    assert sorted(r.doc_id for r in decontaminate.clean_documents(docs(rows), bench).collect()) == [0, 1, 2, 3, 5, 7, 10]
    assert decontaminate.contamination(docs(rows).limit(0), bench).count() == 0
    none = decontaminate.contamination(docs(rows), bench.limit(0))
    assert none.count() == len(rows) and none.filter(F.size("spans") > 0).count() == 0


def test_repeated_paragraphs(docs, prose):
    long, other = prose(1, 70), prose(2, 60)
    rows = [(1, f"{prose(11, 50)}\n{long}"), (2, f"{edited(long, 1, 1)}\nshort line"), (3, prose(3, 200)), (4, None), (5, ""), (6, f"{long}\n\n{other}"),
            (7, f"\n{other}\n"), (8, "short line"), (9, "short line"), (None, long)]
    found = paragraph_dedup.repeated_paragraphs(docs(rows))
    got = {(r.doc_id, r.paragraph): (r.first_doc_id, r.first_paragraph, r.cluster_size, r.removed) for r in found.collect()}
    assert got == {(1, 1): (1, 1, 3, False), (2, 0): (1, 1, 3, True), (6, 0): (1, 1, 3, True), (6, 2): (6, 2, 2, False), (7, 1): (6, 2, 2, True)}
    left = {r.doc_id: r.text for r in paragraph_dedup.without_repeats(docs(rows), found).collect()}
    assert left[2] == "short line" and left[6] == f"\n{other}" and left[7] == "\n" and left[1] == rows[0][1] and left[4] is None
    assert paragraph_dedup.repeated_paragraphs(docs(rows).limit(0)).count() == 0
    bands, size = paragraph_dedup.tune(0.8, 0.9998)
    assert 1 - (1 - 0.8**size) ** bands >= 0.9998


def test_passages_equal_brute_force_over_all_windows(docs, prose):
    a, b, c = (prose(s, n).split() for s, n in ((1, 99), (2, 50), (3, 140)))
    lines = lambda w, n: "\n".join(" ".join(w[k : k + n]) for k in range(0, len(w), n))
    rows = [(1, f"{prose(20, 30)}\n{lines(a, 12)}"), (2, f"{prose(21, 200)} {' '.join(a[10:90]).upper()} {prose(22, 150)}"), (3, lines(b, 9)),
            (4, f"{prose(23, 80)} {' '.join(b)} {prose(24, 5)}\n{' '.join(b)}"), (5, " ".join(b[:49])), (6, lines(c, 30)), (7, lines(c, 25)), (8, lines(c[60:], 7)),
            (9, "go on and " * 60), (10, f"on and {'go on and ' * 30}"), (11, None), (12, ""), (6, lines(c, 30)), (None, lines(a, 12)), (13, prose(25, 400)),
            (14, edited(" ".join(c), 5, 2)), (15, f"{lines(a[:60], 20)} {lines(c[:70], 11)} {lines(a[40:], 8)}")]
    first, covered = {}, collections.defaultdict(set)
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for p in range(len(w) - 49):
            if first.setdefault(tuple(w[p : p + 50]), (i, p)) != (i, p):
                covered[i].update(range(p, p + 50))
    found = paragraph_dedup.repeated_passages(docs(rows)).collect()
    got, text = collections.defaultdict(set), {i: words(t) for i, t in rows}
    for r in found:
        at, start = -1 - r.paragraph, -1 - r.first_paragraph
        assert text[r.doc_id][at : at + r.n_words] == text[r.first_doc_id][start : start + r.n_words] and r.n_words >= 50
        assert (r.doc_id, r.paragraph) == (r.first_doc_id, r.first_paragraph) or r.removed
        if r.removed:
            got[r.doc_id].update(range(at, at + r.n_words))
    assert got == covered and {2, 4, 7, 8, 9, 10, 14, 15} == set(got)
    assert len({(r.doc_id, r.paragraph) for r in found}) == len(found)
    assert sum(not r.removed for r in found) == len({(r.first_doc_id, r.first_paragraph) for r in found})
    left = {r.doc_id: words(r.text) for r in paragraph_dedup.without_repeats(docs(rows), paragraph_dedup.repeated_passages(docs(rows))).collect()}
    assert all(left[i] == [w for k, w in enumerate(text[i]) if k not in covered[i]] for i in text if i is not None)
    assert paragraph_dedup.repeated_passages(docs(rows).limit(0)).count() == 0


@pytest.mark.parametrize("span,parts,nulls", [(1, 1, False), (1, 1, True), (2, 1, False), (3, 5, True), (1, 300, True), (257, 1, False), (700, 9, True)])
def test_the_network_permutes(span, parts, nulls):
    places = token_shards.Places(span, parts, nulls)
    whole = [(0, n, p) for n in range(span) for p in range(parts)] + [(1, 0, p) for p in range(parts) if nulls]
    out = {}
    for key in ("a", "b"):
        halves = places.halves(*np.array(whole, np.uint64).T)
        assert places.inside(*halves).all()
        out[key] = list(zip(*(x.tolist() for x in places.permute(*halves, key))))
        assert sorted(out[key]) == sorted(zip(*(x.tolist() for x in halves)))
    assert len(whole) < 100 or out["a"] != out["b"]


def test_shards_hold_ids_as_far_apart_as_they_may_be(spark, docs, prose):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    r = random.Random(1)
    rows = [(-(2**63), "lowest"), (2**63 - 1, "highest"), (None, "nobody"), (0, prose(1, 900)), *((r.randrange(-(2**63), 2**63), prose(k, 20)) for k in range(60))]
    folder = fresh_folder(spark, "shards")
    sequences, shards = token_shards.write_shards(docs(rows), folder, path, public_tokenizers.PATTERN, length=16, shard_text=3000)
    manifest = shards.collect()
    read = [(s, d, p) for s, d, p, _ in token_shards.read_sequences(folder, manifest, 16)]
    assert {d for _, d, _ in read} == {d for d, _ in rows} and [s for s, *_ in read] == list(range(len(read)))
    assert {(x.slot, x.doc_id, x.part) for x in sequences.collect()} == set(read)
    # Shards are ranges of a scattered order: none is empty or holds most.
    assert len(manifest) >= 3 and max(m.n_rows for m in manifest) < 0.75 * len(read)
    assert token_shards.id_type(65535) == "<u2" and token_shards.id_type(65536) == "<u4"


def test_shards_round_trip_and_resume(spark, docs, prose):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=token_shards.load_ranks(path), special_tokens={})
    rows = [(i * 7, prose(i, 5 + 13 * i)) for i in range(30)] + [(500, None), (501, ""), (None, "no id"), (7, prose(1, 18)), (7, "other")]
    out = []
    for parts in (1, 5):
        folder = fresh_folder(spark, "shards")
        sequences, shards = token_shards.write_shards(
            docs(rows).repartition(parts), folder, path, public_tokenizers.PATTERN, length=16, shard_text=2000)
        manifest = shards.collect()
        assert len(manifest) > 3 and sum(m.n_rows for m in manifest) == sequences.count()
        read = [(s, d, p, t.tolist()) for s, d, p, t in token_shards.read_sequences(folder, manifest, 16)]
        assert [r[0] for r in read] == list(range(len(read)))
        later = [(s, d, p, t.tolist()) for s, d, p, t in token_shards.read_sequences(folder, manifest, 16, start=40)]
        assert later == read[40:]
        listed = {(r.slot, r.doc_id, r.part, r.n_tokens) for r in sequences.collect()}
        assert listed == {(s, d, p, len(t)) for s, d, p, t in read}
        out.append(read)
    assert out[0] == out[1]  # the order does not depend on partitions
    by_doc = collections.defaultdict(list)
    for _, d, p, t in out[0]:
        by_doc[d].append((p, t))
    for i, t in rows[:33]:
        if i != 7:
            ids = [x for _, part in sorted(by_doc[i]) for x in part]
            assert ids == [*encoding.encode_ordinary(t or ""), len(token_shards.load_ranks(path))]
    assert [s for s, *_ in out[0]] != sorted(range(len(out[0])), key=lambda k: str(out[0][k][1:3]))
    empty, none = token_shards.write_shards(docs(rows).limit(0), fresh_folder(spark, "e"), path, public_tokenizers.PATTERN)
    assert empty.count() == none.count() == 0


def test_neighbours_tell_quality(spark, docs, prose):
    good = [(i, f"The {prose(i, 60)}. And so on.") for i in range(120)]
    bad = [(1000 + i, " | ".join(w.upper() + "!!" for w in prose(i, 40).split())) for i in range(60)]
    rows = docs([*good, *bad, (5000, None), (5001, ""), (5001, "")])
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(None, 1), (5, None)], "doc_id long, quality int")
    fitted = neighbour_quality.fit(neighbour_quality.training_rows(rows, labels, "quality", 80), "quality", sample=80, axes=8)
    assert 40 < len(fitted.labels) <= 80
    got = {r.doc_id: r.score for r in neighbour_quality.score(rows, fitted).filter(neighbour_quality.held_out(F.col("doc_id"))).collect()}
    assert len(got) > 20 and all((s >= 0.7) == (i < 1000) for i, s in got.items() if i < 5000)
    assert {r.score for r in neighbour_quality.score(rows.filter("doc_id >= 5000"), fitted).collect()} == {0.0}
    again = {r.doc_id: r.score for r in neighbour_quality.score(rows.repartition(7), fitted).collect()}
    assert all(abs(again[i] - s) < 1e-6 for i, s in got.items())
    blank = neighbour_quality.fit(rows.limit(0).withColumn("quality", F.lit(1)), "quality")
    assert {r.score for r in neighbour_quality.score(rows.limit(3), blank).collect()} == {0.0}


def plain_terms(text):
    """Term counts of a text, letter by letter and word by word."""
    data, counts = (text or "").encode(), collections.Counter()
    kinds = [int(neighbour_quality.CLASS[b]) for b in data]
    for a, b in zip(kinds, kinds[1:]):
        counts[a * neighbour_quality.CLASSES + b] += 1
    hashed = []
    for w in re.findall(rb"[^\x20\x09-\x0D]+", data):
        hashes, _ = textvec.words(np.frombuffer(w, np.uint8), np.array([0, len(w)]))
        hashed.append(int(hashes[0]))
        counts[neighbour_quality.CLASSES**2 + hashed[-1] % neighbour_quality.HASHED] += 1
    out = np.zeros(neighbour_quality.TERMS)
    for k, n in counts.items():
        out[k] = np.log1p(n)
    again = sum(a == b for a, b in zip(hashed, hashed[1:])) / max(len(hashed), 1)
    out[-len(neighbour_quality.STEPS) :] = 3 * (again > neighbour_quality.STEPS)
    return out


def test_votes_equal_a_plain_search_of_all_labelled_texts(spark, docs, prose):
    """Every labelled vector compared one by one, in double precision."""
    texts = [(i, f"{prose(i, 5 + i % 70)}. {'! ' * (i % 9)}" if i % 4 else " ".join([f"w{i}"] * (i % 30))) for i in range(200)]
    rows = docs([*texts, (900, None), (901, ""), (902, "Only One")])
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i, _ in texts], "doc_id long, quality int")
    training = neighbour_quality.training_rows(rows, labels, "quality", 90)
    space = neighbour_quality.fit(training, "quality", sample=90, axes=12)
    known = sorted(((r.doc_id, r.quality, r.text) for r in training.collect()))
    assert [y for _, y, _ in known] == space.labels.tolist()
    weights, axes = space.weights.astype(float), space.axes.astype(float)

    def vector(text):
        z = (plain_terms(text) * weights) @ axes
        return z / max(np.linalg.norm(z), 1e-9)

    vectors = [vector(t) for _, _, t in known]
    assert np.abs(np.array(vectors) - space.vectors).max() < 1e-4
    got = {r.doc_id: r.score for r in neighbour_quality.score(rows, space, neighbours=7, power=4).collect()}
    for i, t in [*texts, (900, None), (901, ""), (902, "Only One")]:
        mine = vector(t)
        near = sorted(((float(mine @ v), y) for v, (_, y, _) in zip(vectors, known)), reverse=True)
        bar = near[6][0] - 1e-6
        votes = [(max(s, 0) ** 4, y) for s, y in near if s >= bar]
        want = sum(w * y for w, y in votes) / sum(w for w, _ in votes) if t and sum(w for w, _ in votes) else 0.0
        assert abs(got[i] - want) < 5e-3, (i, got[i], want)


def test_recall_of_near_copies_among_the_given_paragraphs(spark):
    """All pairs of paragraphs whose sets reach 80 %, counted on the given documents: nine in ten at least are one cluster."""
    from pathlib import Path

    folder = Path("/root/testdata/sf0.01/documents.parquet")
    if not folder.exists():
        pytest.skip("test tables absent")
    bounded_batches(spark)
    given = spark.read.parquet(str(folder))
    sets = {}
    for r in given.select("doc_id", "text").collect():
        for k, line in enumerate((r.text or "").split("\n")):
            if len(words(line)) >= 40:
                sets[r.doc_id, k] = frozenset(hash(x) for x in shingle_set(line, 5))
    holders = collections.defaultdict(list)
    for place, found in sets.items():
        for g in found:
            holders[g].append(place)
    shared = collections.Counter(p for places in holders.values() if 1 < len(places) < 400 for p in itertools.combinations(places, 2))
    pairs = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n) and sets[a] != sets[b]]
    cluster = {(r.doc_id, r.paragraph): (r.first_doc_id, r.first_paragraph) for r in paragraph_dedup.repeated_paragraphs(given).collect()}
    met = sum(a in cluster and cluster.get(a) == cluster.get(b) for a, b in pairs)
    print("pairs", len(pairs), "in one cluster", met)
    assert len(pairs) >= 10 and met >= 0.9 * len(pairs)


def test_mixing_reaches_the_targets(spark, docs, prose):
    plain = [(i, f"{prose(i, 40)} fine") for i in range(150)]
    odd = [(1000 + i, f"{prose(i, 40)} horrid nasty") for i in range(50)]
    rows = docs([*plain, *odd, (3000, None), (3001, "")])
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in plain + odd if i % 3], "doc_id long, domain int")
    mixed = domain_mix.mix(rows, labels, (0.95, 0.05), sample=100)
    got = mixed.select("doc_id", "n_tokens", "posteriors", "rate").collect()
    held = [r for r in got if r.doc_id < 3000 and r.doc_id % 3 == 0]
    assert np.mean([(r.posteriors[1] > 0.5) == (r.doc_id >= 1000) for r in held]) > 0.9
    t, p, rate = (np.array([r[k] for r in got]) for k in ("n_tokens", "posteriors", "rate"))
    assert (rate >= 0).all() and np.abs(p.sum(axis=1) - 1).max() < 1e-9
    assert np.abs((t * rate) @ p / t.sum() - [0.95, 0.05]).max() < 1e-3
    # The same steps in plain numpy.
    r, now = np.ones(len(t)), t @ p
    present, goal = now.copy(), np.array([0.95, 0.05]) * t.sum()
    for _ in range(60):
        if np.abs(now - goal).sum() <= 1e-4 * goal.sum():
            break
        r = np.maximum(0, r - p @ ((now - goal) / present))
        now = (t * r) @ p
    assert np.abs(r - rate).max() < 1e-6
    drawn = collections.Counter(x.doc_id for x in domain_mix.drawn(mixed).select("doc_id").collect())
    assert all(int(x.rate) <= drawn[x.doc_id] <= int(x.rate) + 1 for x in got)
    assert domain_mix.mix(rows.limit(0), labels, (0.95, 0.05)).count() == 0
    even = domain_mix.mix(rows, labels.limit(0), (0.5, 0.5)).select("posteriors").distinct().collect()
    assert [list(x.posteriors) for x in even] == [[0.5, 0.5]]
