import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stemma.llm import exact_dedup, simhash
from stemma.llm.components import connected_components
from tests.llm.tables import ROWS, documents, empty


def test_exact_groups(spark):
    got = exact_dedup.exact_duplicates(documents(spark)).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in ROWS:
        groups.setdefault(hashlib.sha256(norm(t).encode()).hexdigest(), []).append(i)
    assert sorted((str(r.doc_id), r.text_sha256) for r in got) == sorted((str(i), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in ROWS)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    for h in groups:
        (kept,) = [r for r in got if r.text_sha256 == h and r.kept]
        assert kept.doc_id == kept.keep_id
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("fan_in", [2, 4, 16])
def test_exact_rounds_agree(spark, fan_in):
    draw = random.Random(1)
    rows = [(i, draw.choice(["hot"] * 3 + [f"t{k}" for k in range(40)])) for i in range(600)]
    got = exact_dedup.exact_duplicates(documents(spark, rows).repartition(17), fan_in=fan_in).collect()
    first = {}
    for i, t in rows:
        first.setdefault(t, i)
    assert {r.doc_id: r.keep_id for r in got} == {i: first[t] for i, t in rows}


def test_drop_exact(spark):
    docs = documents(spark)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.where("_key <> 'other'").count() == 0
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id) == [1, 3, 5, 6, 7, 9]
    assert kept.where("doc_id IS NULL").count() == 1
    assert exact_dedup.drop_exact_duplicates(empty(spark)).count() == 0


def plain_fingerprint(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, radius):
    ids, root = sorted(marks), {i: i for i in marks}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if bin(marks[a] ^ marks[b]).count("1") <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints_and_components(spark):
    got = simhash.near_duplicates(documents(spark)).collect()
    assert len(got) == len(ROWS)
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{plain_fingerprint(t):016x}") for i, t in ROWS)
    by_id = {r.doc_id: r.component_id for r in got if r.doc_id}
    assert by_id == plain_components({i: plain_fingerprint(t) for i, t in ROWS if i}, 3)
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize(("radius", "leaf"), [(3, 1024), (3, 4), (7, 1024), (7, 40)])
def test_forest_is_exact(spark, radius, leaf):
    """Chains and dense balls of fingerprints, with leaves so small that trees grow below trees."""
    draw = random.Random(radius)
    centres = [draw.getrandbits(64) for _ in range(4)]
    marks = {}
    for i in range(260):
        x = draw.choice(centres)
        for _ in range(draw.randint(0, 9)):
            x ^= 1 << draw.randrange(64)
        marks[i] = x
    rows = [(i, int(np.uint64(x).astype(np.int64))) for i, x in marks.items()]
    fps = spark.createDataFrame(rows, "_id bigint, fp bigint")
    want = plain_components(marks, radius)
    for hot in (simhash.HOT, 60):
        got = {r.fp: r.component_id for r in simhash.components(fps, leaf, radius, hot).collect()}
        assert all(got[fp] == want[i] for i, fp in rows)


def dense(draw, n, flips):
    """Fingerprints around a few centres and alone."""
    centres = draw.integers(0, 1 << 63, 5, dtype=np.uint64)
    marks = draw.choice(centres, n)
    for _ in range(flips):
        marks ^= np.uint64(1) << draw.integers(0, 64, n, dtype=np.uint64)
    return np.unique(np.concatenate([marks, draw.integers(0, 1 << 63, n // 2, dtype=np.uint64)]).view(np.int64))


def stars_of(fp, radius):
    """Component minima by all pairs."""
    marks, root = fp.view(np.uint64), np.arange(len(fp))
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(marks ^ marks[i]) <= radius).tolist():
            a, b = sorted((root[i], root[j]))
            root[root == b] = a
    return {int(fp[i]): int(fp[root[i]]) for i in range(len(fp)) if root[i] != i}


@pytest.mark.parametrize("flips", [2, 5, 9])
@pytest.mark.parametrize("split", [True, False])
def test_links_of_a_leaf_are_exact(flips, split, monkeypatch):
    """By local trees, and around pivots where no split is taken."""
    monkeypatch.setattr(simhash, "SMALL", 16)
    if not split:
        monkeypatch.setattr(simhash, "SHRINK", 0.0)
    fp = dense(np.random.default_rng(flips), 1200, flips)
    u, v = simhash.link(fp)
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == stars_of(fp, 3)


def test_trees_prune_and_lose_no_link():
    """Ends of every link meet in a leaf of a half's tree, though the tree has seen a sample; most branches are pruned."""
    draw = np.random.default_rng(3)
    fp = dense(draw, 4000, 4).view(np.uint64)
    masks, inner = simhash.halves(3)
    made = [simhash.Tree(draw.choice(fp, 900, replace=False), m, inner, 8) for m in masks]
    assert all(t.leaves > 50 for t in made)
    meets = []
    for t in made:
        where, leaf = t.descend(fp)
        of = [set() for _ in fp]
        for i, k in zip(where.tolist(), leaf.tolist(), strict=True):
            of[i].add(k)
        meets.append(of)
        assert len(where) < 12 * len(fp)  # of more than 50 leaves
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 3).tolist():
            assert any(of[i] & of[j] for of in meets)


def test_connected_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)]
    got = {r.u: r.v for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got.get(node, node) == min(seen)
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_a_hub_is_dealt_over_parts(spark):
    from stemma.llm import components

    star = spark.range(1, 100_001).select(F.lit(0).cast("bigint").alias("u"), F.col("id").alias("v"))
    got = connected_components(star)
    assert got.count() == 100_000 and got.where("v <> 0").count() == 0
    dealt = star.select("u", F.pmod(F.xxhash64("v"), F.lit(components.SALTS)).alias("s")).groupBy("u", "s").count().agg(F.max("count")).first()[0]
    assert dealt < 2 * 100_000 / components.SALTS


def test_near_copies_go_and_others_stay(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(300)]
    copy = [*base[:150], "changed", *base[151:]]
    other = [word() for _ in range(300)]
    rows = [(10, " ".join(base)), (11, " ".join(copy)), (12, " ".join(other)), (13, " ".join(base[:100] + other[:200])), (14, None), (None, " ".join(base)), (15, "")]
    docs = documents(spark, rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [10, 12, 13, 14, None, 15]))
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def plain_jaccard(a, b):
    x, y = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def edited_pairs(draw, n, scattered, least, most):
    """Pairs of texts with a similarity from ``least`` to below ``most``; the edits are single words or one passage."""
    word = lambda: f"w{draw.getrandbits(30)}"
    while n:
        base = [word() for _ in range(draw.randint(60, 400))]
        copy, k = list(base), int(len(base) * draw.uniform(0.01, 0.3))
        if scattered:
            for i in draw.sample(range(len(base)), max(1, k // 5)):
                copy[i] = word()
        else:
            at = draw.randrange(len(base) - k + 1)
            copy[at : at + k] = [word() for _ in range(draw.choice((0, k, 2 * k)))]
        if least <= plain_jaccard(" ".join(base), " ".join(copy)) < most:
            n -= 1
            yield " ".join(base), " ".join(copy)


def stays(spark, pairs):
    """Of each pair, whether both texts stay."""
    rows = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    kept = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}
    assert {2 * i for i in range(len(pairs))} <= kept
    return [2 * i + 1 in kept for i in range(len(pairs))]


@pytest.mark.parametrize("scattered", [True, False])
def test_every_near_copy_is_found(spark, scattered):
    pairs = list(edited_pairs(random.Random(11), 150, scattered, 0.8, 0.9))
    assert not any(stays(spark, pairs))


def test_near_copies_of_a_dense_group_are_single_linkage(spark):
    """Copies of a few texts, edited again and again: components against all pairs."""
    draw = random.Random(12)
    texts = {}
    for g in range(3):
        words = [f"w{g}x{i}" for i in range(80)]
        for i in range(40):
            texts[100 * g + i] = " ".join(words)
            words = list(words)
            words[draw.randrange(80)] = f"v{g}x{i}"
    ids, root = sorted(texts), {i: i for i in texts}
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if plain_jaccard(texts[a], texts[b]) >= 0.8 and root[a] != root[b]:
                x, y = sorted((root[a], root[b]))
                root = {i: x if r == y else r for i, r in root.items()}
    kept = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)).collect()}
    assert kept == {i for i in texts if root[i] == i}


def test_sets_of_a_band_against_all_pairs():
    draw = np.random.default_rng(8)
    base = draw.integers(0, 1 << 40, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([draw.choice(base, 200 - k, replace=False), draw.integers(0, 1 << 40, k).astype(np.uint64)])) for k in draw.integers(0, 60, 80)]
    root = np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if simhash.similar(sets[i].tobytes(), sets[j].tobytes()):
                a, b = sorted((root[i], root[j]))
                root[root == b] = a
    got = np.arange(len(sets))
    for u, v in simhash.link_sets(sets, np.arange(len(sets))):
        assert simhash.similar(sets[u].tobytes(), sets[v].tobytes())
        a, b = sorted((got[u], got[v]))
        got[got == b] = a
    assert got.tolist() == root.tolist() and len(set(root.tolist())) > 1


@pytest.mark.parametrize("scattered", [True, False])
def test_texts_below_the_similarity_stay(spark, scattered):
    pairs = list(edited_pairs(random.Random(13), 100, scattered, 0.7, 0.8))
    assert all(stays(spark, pairs))


def plain_prints(shingles):
    """The same SimHashes hash by hash and bit by bit, as 32-bit halves."""
    most, made = (1 << 64) - 1, []
    for factor in simhash._factors()[0].tolist():
        ones = [0] * 64
        for h in map(int, shingles):
            x = h * factor & most
            x ^= x >> 32
            x = x * 0xBF58476D1CE4E5B9 & most
            x ^= x >> 29
            ones = [n + (x >> b & 1) for b, n in enumerate(ones)]
        bits = sum(1 << b for b, n in enumerate(ones) if 2 * n > len(shingles))
        made += [bits & 0xFFFFFFFF, bits >> 32]
    return made


@pytest.mark.parametrize("n", [1, 16, 255, 400])
def test_fingerprints_of_near_copies_against_a_plain_version(n):
    shingles = np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64)
    assert simhash.prints(shingles).tolist() == plain_prints(shingles)
    plain, short = simhash.plain_and_short(shingles)
    assert (plain is None) == (n < 32) and (short is None) == (n > 40)
    assert simhash.plain_and_short(shingles[:0]) == [None, None]


@pytest.mark.parametrize(("common", "a", "b"), [(4, 0, 1), (12, 0, 3), (32, 0, 8), (36, 0, 9), (40, 5, 5), (160, 20, 20)])
def test_pairs_of_the_least_similarity_meet(common, a, b):
    """Of 200 pairs at 0.8, sizes on both sides of SHORT, at most two have no half within one bit; 0.003 is what is expected."""
    draw, missed = np.random.default_rng(common), 0
    for _ in range(200):
        shared, x, y = (draw.integers(0, 1 << 64, n, dtype=np.uint64) for n in (common, a, b))
        pair = zip(*(simhash.plain_and_short(np.concatenate([shared, own])) for own in (x, y)), strict=True)
        near = [np.bitwise_count(np.frombuffer(p, "<u4") ^ np.frombuffer(q, "<u4")) <= 1 for p, q in pair if p and q]
        missed += not any(n.any() for n in near)
    assert missed <= 2


@pytest.mark.parametrize(("leaf", "hot"), [(None, simhash.NEAR_HOT), (8, simhash.NEAR_HOT), (8, 40)])
def test_texts_meet_by_trees_over_their_fingerprints(spark, leaf, hot):
    """Two sets with a half within one bit are in a group; a member of a group has such a half in common with another."""
    draw = random.Random(21)
    rows = []
    for g in range(30):
        words = [f"w{g}x{i}" for i in range(draw.choice((7, 30, 42, 90)))]
        for i in range(4):
            rows.append((10 * g + i, " ".join(words)))
            words = [*words[:-2], f"v{g}x{i}", words[-1]]
    made = simhash.printed(spark.createDataFrame(rows, "key bigint, text string").repartition(3)).dropDuplicates(["fp"]).cache()
    held = made.collect()
    node = [r.fp & 0xFFFFFFFF for r in held]
    assert len(set(node)) == len(held) > 100
    met = set()
    for kind in ("plain", "short"):
        has = [i for i, r in enumerate(held) if r[kind]]
        marks = np.array([np.frombuffer(held[i][kind], "<u4") for i in has])
        for k, i in enumerate(has):
            near = (np.bitwise_count(marks ^ marks[k]) <= 1).any(axis=1)
            met |= {(node[i], node[j]) for j, n in zip(has, near.tolist(), strict=True) if n and i != j}
    groups = {}
    for r in simhash.met_in_leaves(made.unionByName(made), len(held), leaf, hot).collect():
        groups.setdefault(r.band, []).append(r.node)
    together = {(x, y) for g in groups.values() for x in g for y in g if x != y}
    assert met <= together and len(met) > 100
    assert all(any((x, y) in met for y in g) for g in groups.values() for x in g)


def test_the_near_stage_gets_its_copies_from_the_trees(spark, monkeypatch):
    """Texts that no tree brings together stay, so nothing beside the trees decides."""
    words = [f"w{i}" for i in range(100)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:50], "x", *words[51:]]))], "doc_id bigint, text string")
    assert [r.doc_id for r in simhash.drop_near_duplicates(docs).collect()] == [1]
    none = spark.createDataFrame([], "band bigint, node bigint")
    monkeypatch.setattr(simhash, "met_in_leaves", lambda rows, n: none)
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect()) == [1, 2]


def test_bands_with_much_in_common_are_searched_once(spark):
    """40 bands of 50 of the same 60 sets become one; a band of its own stays; each two of a band are in one of what is searched."""
    draw = random.Random(31)
    bands = {b: draw.sample(range(60), 50) for b in range(40)} | {100: [70, 71, 72]}
    rows = [(b, i, 10, i, min(m), 1) for b, m in bands.items() for i in m]
    got = simhash._searched(spark.createDataFrame(rows, "band bigint, fp bigint, size bigint, root bigint, first bigint, n int")).collect()
    held = {}
    for r in got:
        held.setdefault(r.band, set()).add(r.fp)
    assert len(got) == 63 and all(any(set(m) <= h for h in held.values()) for m in bands.values())


def test_a_few_edges_are_joined_on_the_driver(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    given = spark.createDataFrame(edges, "u bigint, v bigint")
    want = sorted(map(tuple, connected_components(given).collect()))
    assert sorted(map(tuple, connected_components(given, few=200).collect())) == want and len(want) > 50
    assert connected_components(given.limit(0), few=200).count() == 0


def test_only_sets_of_different_classes_meet(spark):
    """Each two of different classes with a half within one bit, and no others."""
    draw = np.random.default_rng(41)
    centres = np.repeat(draw.integers(0, 1 << 32, (6, simhash.HALVES), dtype=np.uint64), 10, axis=0)
    flipped = centres ^ (np.arange(60) % 2).astype(np.uint64)[:, None] << draw.integers(0, 32, centres.shape, dtype=np.uint64)
    halves = np.where(draw.random(centres.shape) < 0.03, flipped, draw.integers(0, 1 << 32, centres.shape, dtype=np.uint64)).astype("<u4")
    classes = [None if i % 3 == 0 else 1 + 10 * (i // 20) for i in range(60)]
    rows = [(i, halves[i].tobytes(), None, c) for i, c in enumerate(classes)]
    own = [i if c is None else c for i, c in enumerate(classes)]
    want = {(i, j) for j in range(60) for i in range(j) if own[i] != own[j] and (np.bitwise_count(halves[i] ^ halves[j]) <= 1).any()}
    got = simhash.met_in_leaves(spark.createDataFrame(rows, "fp bigint, plain binary, short binary, class bigint").repartition(3), 60).collect()
    assert {(r.band, r.node) for r in got} == want and len(got) == len(want) > 10


def test_a_dense_group_costs_few_rows_and_loses_no_link(spark, monkeypatch):
    """300 texts of which most are 0.7 similar and some 0.8: what meets is a few rows for each text, not one for each half."""
    draw = random.Random(42)
    words = [f"w{i}" for i in range(200)]
    texts = {}
    for i in range(300):
        edited = list(texts[draw.randrange(i)].split() if i % 6 == 5 else words)
        for at in draw.sample(range(200), 2 if i % 6 == 5 else 8):
            edited[at] = f"v{i}x{at}"
        texts[i] = " ".join(edited)
    sets = {i: set(zip(*(t.split()[k:] for k in range(5)))) for i, t in texts.items()}
    root = {i: i for i in texts}
    for b in texts:
        for a in range(b):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                x, y = sorted((root[a], root[b]))
                root = {i: x if r == y else r for i, r in root.items()}
    met, plain = [], simhash.met_in_leaves

    def counted(rows, n):
        found = plain(rows, n).cache()
        met.append(found.count())
        return found

    monkeypatch.setattr(simhash, "met_in_leaves", counted)
    kept = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)).collect()}
    assert kept == {i for i in texts if root[i] == i} and 200 < len(kept) < 290
    assert sum(met) < 25 * len(texts), met
