"""SimHash near-dedup: exact search for fingerprints at 3 or fewer differing bits, by vantage-point trees.

Two fingerprints at 3 or fewer differing bits differ in at most one bit of one of their two halves. The Hamming distance
over a half is a metric, so each half has a vantage-point tree, searched with radius 1. A node splits at a radius: its near
shard holds what is up to that radius from the vantage point, its far shard what is beyond the radius less 1. By the
triangle bound both ends of a link meet in one of the two shards; fingerprints in the band between go to both, and all
others to one, the other branch being pruned. Over all 64 bits a radius of 3 would put most fingerprints in that band, since
distances concentrate near 32 within 4; over 32 bits and a radius of 1 it holds about a seventh of them. Vantage points and
radii are chosen from a sample of ``SAMPLE`` different fingerprints at most for the least work, so trees also split where
the data are dense. All fingerprints descend the trees.

A leaf is linked in one task by the exact distance of all 64 bits: small ones pair by pair, larger ones by local trees, and
where nothing splits (dense balls of near copies) around pivots. A ball of 3 around a pivot is linked at once; what lies
beyond 6 of the pivot is pruned by the triangle bound, and the ring between is compared with the ball until it is linked. A
leaf of more than ``HOT`` fingerprints is dealt into blocks, and each pair of blocks is a leaf of its own, so no task grows
with the group.

Copies collapse first: the trees hold different fingerprints only, so a group of equal texts is one row. Inside a leaf
the links are reduced to a star on its smallest member, so a dense group of n fingerprints gives n - 1 rows, not n * n.

Near copies whose five-word shingles are 0.8 similar lie about 10 bits apart, where no tree prunes (a band of 10 around a
radius of 32 holds nearly all). ``drop_near_duplicates`` therefore takes many SimHash fingerprints of a text, each from
other hashes of its five-word shingles, and searches the 32-bit halves of each by a vantage-point tree with radius 1, as
above. Texts meet if one of the HALVES halves differs in at most one bit, and the exact Jaccard similarity of the sets
decides. Whether a pair meets depends on its similarity only, not on where the edits are. Sets of one class, made from what
the first halves bring together, don't meet again in all others; their class is searched once (see ``near_links``).
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.llm.cluster import cut, release, unused
from stemma.llm.components import SALTS, connected_components

BITS = 64
#: Differing bits up to which fingerprints link.
RADIUS = 3
#: Near copies: words in a shingle, and the Jaccard similarity of the sets (4 / 5) from which two texts link.
SHINGLE, SIMILAR = 5, (4, 5)
#: Fingerprints of a text that find the pairs to compare, and their halves. Bits of a pair of similarity s differ with a
#: probability of acos(2 s / (1 + s)) / pi at most, 0.15 at 0.8; none of the halves is within 1 bit with one of 0.003 at 0.8.
PRINTS = 84
HALVES = 2 * PRINTS
#: Sets of up to SHORT shingles have fingerprints from FOLD hashes of each shingle, since one of each makes bits too uneven;
#: those of SHORT * 4 / 5 shingles and more have the plain ones. Similar sets have one kind in common.
SHORT, FOLD = 40, 9
#: Leaves of a half's tree that are aimed at, and entries in a leaf at least and at most (then there are more leaves).
NEAR_LEAVES, NEAR_LEAF = 4, (1024, 1 << 18)
#: Texts in the sample of the halves' tree, halves of each, and entries above which a leaf is dealt into pairs of blocks.
NEAR_SAMPLE, NEAR_EACH, NEAR_HOT = 2048, 8, 1 << 20
#: Bytes of shingle sets, and sets, that a block of a band holds.
BLOCK_BYTES, BLOCK_SETS = 8 << 20, 1024
#: Halves that classes are made from, and the share of different bits up to which texts are of one: 0.31 is a similarity of 0.4.
FIRST, ALIKE = 24, 0.31
#: Links of texts up to which the driver joins them (1 MB).
FEW = 1 << 16
#: Fingerprints that the trees are fitted on at most, and the share of all at most.
SAMPLE, SAMPLE_SHARE = 16_384, 0.25
#: Different fingerprints in a leaf that the trees aim at, and those of the sample in one at least.
LEAF, LEAF_SAMPLE = 1024, 4
#: Different fingerprints in a leaf above which it is dealt into pairs of blocks of half as many.
HOT = 40_000
#: Vantage points tried for each node; a split whose larger shard holds more than this share is none.
VANTAGES, SHRINK = 6, 0.85
#: Fingerprints compared pair by pair inside a leaf.
SMALL = 512
#: Shingles hashed at once; bounds memory for very long texts.
_CHUNK = 1 << 16


def _ones(words: list[bytes], width: int) -> tuple[np.ndarray, int]:
    """How many of the shingles' XXH64 have each bit, and how many shingles there are."""
    buf = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1]
    ends = ends[width - 1 :]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _CHUNK):
        pairs = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist(), strict=True)
        made = np.fromiter((xxhash.xxh64_intdigest(buf[a:b], 42) for a, b in pairs), "<u8")
        ones += np.unpackbits(made.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return ones, len(starts)


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """SimHash of a text: ASCII letters lowered, words between ASCII white space, ``width``-word shingles with repeats.

    A shingle hashes to XXH64 with seed 42; a bit is 1 if it is 1 in over half the hashes. Fewer words than ``width``
    give one shingle of all; no words (null, empty or white text) give 0.
    """
    words = _words(text)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42) if words else 0
    ones, n = _ones(words, width)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): fp as a signed 64-bit number."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = np.array([fingerprint(t, width) for t in b.column(1).cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks)], ["_id", "fp"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(of, f"_id {rows.schema['_id'].dataType.simpleString()}, fp bigint")


# ---------- vantage-point trees ----------


def halves(radius: int) -> tuple[list[int], int]:
    """Masks of the two halves, and the radius within one of them that no link exceeds in both."""
    low = (1 << BITS // 2) - 1
    return [low, low << BITS // 2], radius // 2


def _split(points: np.ndarray, mask: int, radius: int, draw: np.random.Generator) -> tuple[int, int, np.ndarray] | None:
    """(vantage point, radius of the near shard, distances) with the least work, None if no split shrinks the larger shard enough."""
    best, most = None, (SHRINK * len(points)) ** 2
    for v in draw.choice(points, min(VANTAGES, len(points)), replace=False):
        away = np.bitwise_count((points ^ v) & np.uint64(mask))
        upto = np.bincount(away, minlength=BITS + 1).cumsum()
        near, far = upto[: BITS + 1], len(points) - np.concatenate([np.zeros(radius + 1, np.int64), upto])[: BITS + 1]  # far: beyond the split less the radius
        work = np.maximum(near, far) ** 2
        at = int(work.argmin())
        if work[at] < most:
            best, most = (int(v), at, away), work[at]
    return best


class Tree:
    """A vantage-point tree over the bits of a mask, searched with a radius. Leaves have numbers from 0."""

    def __init__(self, sample: np.ndarray, mask: int, radius: int, leaf: int, seed: int = 0) -> None:
        self.mask, self.radius, self.leaves = mask, radius, 0
        self.nodes: list[tuple[int, int, int, int]] = []  # vantage point, radius of the near shard, near and far child; children below 0 are leaves
        draw = np.random.default_rng(seed)
        todo: list[tuple[np.ndarray, int, int]] = [(sample, -1, 0)]  # points, parent, which child of it
        while todo:
            points, parent, side = todo.pop()
            got = _split(points, mask, radius, draw) if len(points) > leaf else None
            if got is None:
                self.leaves += 1
                number = -self.leaves
            else:
                vantage, at, away = got
                number = len(self.nodes)
                self.nodes.append((vantage, at, 0, 0))
                todo += [(points[away <= at], number, 2), (points[away > at - radius], number, 3)]
            if parent >= 0:
                node = list(self.nodes[parent])
                node[side] = number
                self.nodes[parent] = tuple(node)
        self.root = 0 if self.nodes else -1

    def descend(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the point, leaf) for all leaves that a link of the point can reach."""
        where, leaves, todo = [], [], [(self.root, np.arange(len(points)))]
        while todo:
            number, own = todo.pop()
            if number < 0:
                where.append(own)
                leaves.append(np.full(len(own), -number - 1, np.int64))
                continue
            vantage, at, near, far = self.nodes[number]
            away = np.bitwise_count((points[own] ^ np.uint64(vantage)) & np.uint64(self.mask)).astype(np.int16)
            todo += [(child, part) for child, part in ((near, own[away <= at]), (far, own[away > at - self.radius])) if len(part)]
        return np.concatenate(where), np.concatenate(leaves)


def trees(fps: DataFrame, n: int, leaf_size: int = LEAF, radius: int = RADIUS, sample: int = SAMPLE) -> list[Tree]:
    """The trees of the two halves, fitted on a sample by hash of the ``n`` different fingerprints."""
    rate = min(SAMPLE_SHARE, sample / max(n, 1))
    some = fps.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(rate * (1 << 30))).select("fp").collect() if n > leaf_size else []
    points = np.sort(np.array([r["fp"] for r in some], np.int64)).view(np.uint64)
    masks, inner = halves(radius)
    return [Tree(points, m, inner, max(LEAF_SAMPLE, int(leaf_size * rate))) for m in masks]


def shards(fps: DataFrame, leaf_size: int = LEAF, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """(fp, leaf): every different fingerprint in each leaf where it can link."""
    forest = trees(fps, fps.count(), leaf_size, radius)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = b.column(0).to_numpy(zero_copy_only=False)
            for k, tree in enumerate(forest):
                where, leaves = tree.descend(marks.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(marks[where]), pa.array(leaves * len(forest) + k)], ["fp", "leaf"])

    rows = cut(fps.select("fp").mapInArrow(of, "fp bigint, leaf bigint"))
    full = cut(rows.groupBy("leaf").count().where(F.col("count") > hot))
    if full.isEmpty():
        return rows
    apart = _in_blocks(rows.join(full, "leaf"), hot // 2)
    return rows.join(full, "leaf", "left_anti").unionByName(apart)


def _in_blocks(rows: DataFrame, size: int) -> DataFrame:
    """From rows with the ``count`` of their leaf to leaves of pairs of blocks, so that each two rows meet in one."""
    n = F.ceil(F.col("count") / size).cast("int")
    block = F.pmod(F.xxhash64("fp"), n).cast("int")
    met = rows.select("fp", "leaf", block.alias("a"), F.explode(F.sequence(F.lit(0), n - 1)).alias("b"))
    return met.select("fp", F.xxhash64("leaf", F.least("a", "b"), F.greatest("a", "b")).alias("leaf"))


class _Roots:
    """Union-find over positions; the smallest position is the root."""

    def __init__(self, n: int) -> None:
        self.of = np.arange(n)

    def find(self, i: int) -> int:
        of = self.of
        while of[i] != i:
            of[i] = of[of[i]]
            i = int(of[i])
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.find(i), self.find(j)
            self.of[max(x, y)] = min(x, y)

    def flat(self) -> np.ndarray:
        while (up := self.of[self.of]).tobytes() != self.of.tobytes():
            self.of = up
        return self.of


def _link_balls(marks: np.ndarray, own: np.ndarray, roots: _Roots, radius: int) -> None:
    """Links around pivots, for points that no split separates."""
    while len(own) > 1:
        away = np.bitwise_count(marks[own] ^ marks[own[0]])
        ball, ring = own[away <= radius], own[(away > radius) & (away <= 2 * radius)]
        roots.join(ball, np.full(len(ball), own[0]))
        for at in range(0, len(ball), SMALL):
            some = ball[at : at + SMALL]
            for to in range(0, len(ring), 1 << 13):
                part = ring[to : to + (1 << 13)]
                near = (np.bitwise_count(marks[part][:, None] ^ marks[some]) <= radius).any(axis=1)
                roots.join(part[near], np.full(int(near.sum()), own[0]))
                ring[to : to + (1 << 13)] = np.where(near, -1, part)
            ring = ring[ring >= 0]
        own = own[away > radius]


def link(fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links within one leaf, its fingerprints ascending, as stars: each linked member and its group's smallest."""
    marks, roots, draw = fp.view(np.uint64), _Roots(len(fp)), np.random.default_rng(0)
    todo = [np.arange(len(fp))]
    while todo:
        own = todo.pop()
        if len(own) <= SMALL:
            a, b = np.nonzero(np.bitwise_count(marks[own][:, None] ^ marks[own]) <= radius)
            later = a < b
            roots.join(own[a[later]], own[b[later]])
        elif (got := _split(marks[own], (1 << BITS) - 1, radius, draw)) is not None:
            todo += [own[got[2] <= got[1]], own[got[2].astype(np.int16) > got[1] - radius]]
        else:
            _link_balls(marks, own, roots, radius)
    flat = roots.flat()
    moved = np.flatnonzero(flat != np.arange(len(flat)))
    return fp[moved], fp[flat[moved]]


def links(leaves: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): stars over the linked fingerprints of each leaf."""

    def out(fp: np.ndarray) -> pa.RecordBatch:
        u, v = link(fp, radius)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, parts = None, []
        for b in batches:
            names, marks = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            cuts = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if a == z:
                    continue
                if names[a] != leaf and parts:
                    yield out(np.concatenate(parts))
                    parts = []
                leaf = names[a]
                parts.append(marks[a:z])
        if parts:
            yield out(np.concatenate(parts))

    dealt = leaves.select("leaf", "fp").repartition("leaf").sortWithinPartitions("leaf", "fp")
    return dealt.mapInArrow(of, "u bigint, v bigint")


def components(fps: DataFrame, leaf_size: int = LEAF, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """From (id, fp) rows to (fp, component_id): the smallest identifier of all fingerprints that links reach."""
    reps = cut(fps.groupBy("fp").agg(F.min("_id").alias("rep")))
    return _smallest(reps, connected_components(links(shards(reps, leaf_size, radius, hot), radius)))


def _smallest(reps: DataFrame, stars: DataFrame) -> DataFrame:
    """From rows (fp, rep) and stars (u, v) of fingerprints to (fp, component_id): the smallest ``rep`` of a component."""
    member = stars.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    tied = reps.join(member, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = tied.join(member.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("rep").alias("component_id"))
    return tied.join(least, "root", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = RADIUS, leaf_size: int = LEAF) -> DataFrame:
    """One row per input row: id, fingerprint (16 lowercase hex digits) and component_id.

    Null, empty and white texts have fingerprint zero and link like any other. Rows without identifier take part; their
    component's id is the smallest identifier there, null if there is none. Repeated rows stay. Other columns of the
    input are not read.
    """
    fps = cut(fingerprints(docs, id_col, text_col, width))
    return fps.join(components(fps, leaf_size, radius), "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# ---------- near copies by the similarity of their shingle sets ----------


def shingle_set(text: bytes | None) -> np.ndarray:
    """The different shingles of SHINGLE words as sorted 64-bit hashes. Fewer words give one shingle of all, none an empty set."""
    words = _words(text)
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))] if words else [], np.uint64)
    buf = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - SHINGLE + 1].tolist()
    made = (xxhash.xxh3_64_intdigest(buf[a:b]) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True))
    return np.unique(np.fromiter(made, np.uint64, len(starts)))


@lru_cache(maxsize=1)
def _factors() -> tuple[np.ndarray, np.ndarray]:
    draw = random.Random(20_250_607)
    odd, fold = (np.array([draw.getrandbits(64) | 1 for _ in range(n)], np.uint64) for n in (PRINTS, FOLD))
    return odd, fold


def _sums(x: np.ndarray, lanes: int) -> np.ndarray:
    """Sums of ``lanes`` rows at a time, as many rows as there are groups of so many."""
    m = len(x) // lanes
    out = x[:m].copy()
    for k in range(1, lanes):
        out += x[k * m : (k + 1) * m]
    return out


def prints(shingles: np.ndarray) -> np.ndarray:
    """SimHash of shingle hashes, PRINTS times with other hashes of them, as HALVES numbers of 32 bits.

    A bit is 1 if it is 1 in over half the hashes. Bits are added up in lanes of 2, 4 and 8 bits, in 15 x 17 rows.
    """
    odd, _ = _factors()
    one = [np.uint64(m) for m in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F)]
    shift = lambda x, k: x >> np.uint64(k)
    ones = np.zeros((PRINTS, BITS), np.int64)
    for at in range(0, len(shingles), 255):
        x = shingles[at : at + 255, None] * odd
        x ^= shift(x, 32)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= shift(x, 29)
        if len(x) % 15:
            x = np.concatenate([x, np.zeros((-len(x) % 15, PRINTS), np.uint64)])
        for a in (0, 1):
            two = _sums(shift(x, a) & one[0], 3)
            for b in (0, 2):
                four = _sums(shift(two, b) & one[1], 5)
                for c in (0, 4):
                    eight = (shift(four, c) & one[2]).sum(axis=0)
                    ones[:, a + b + c :: 8] += eight.astype("<u8").view(np.uint8).reshape(PRINTS, 8)
    return np.packbits(2 * ones > len(shingles), axis=1, bitorder="little").view("<u4").ravel()


def plain_and_short(shingles: np.ndarray) -> list[bytes | None]:
    """The plain fingerprints of a set and those of a short one, each None if the set is too small or too large for it."""
    n = len(shingles)
    plain = prints(shingles).tobytes() if n * SIMILAR[1] >= SHORT * SIMILAR[0] else None
    if not 0 < n <= SHORT:
        return [plain, None]
    return [plain, prints((shingles[:, None] * _factors()[1] ^ (shingles[:, None] >> np.uint64(31))).ravel()).tobytes()]


def printed(docs: DataFrame) -> DataFrame:
    """From (key, text) to (key, fp, size, plain, short): fp is a digest of the shingle set, size its number of shingles."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            marks = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            made = [plain_and_short(s) for s in sets]
            both = [pa.array([m[k] for m in made], pa.binary()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks), pa.array(list(map(len, sets)), pa.int64()), *both], ["key", "fp", "size", "plain", "short"])

    return docs.select("key", "text").mapInArrow(of, f"key {docs.schema['key'].dataType.simpleString()}, fp bigint, size bigint, plain binary, short binary")


def half_tree(rows: DataFrame, n: int, leaf_size: int | None = None) -> Tree:
    """The tree for halves of fingerprints, fitted on a sample by hash of the ``n`` different sets."""
    leaf = leaf_size or min(max(n // NEAR_LEAVES, NEAR_LEAF[0]), NEAR_LEAF[1])
    rate = min(1.0, NEAR_SAMPLE / max(n, 1))
    drawn = rows.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(rate * (1 << 30))).groupBy("fp").agg(F.first(F.coalesce("plain", "short")).alias("m"))
    some = drawn.collect() if n > leaf else []
    picks = [np.frombuffer(r["m"], "<u4")[(np.arange(NEAR_EACH) + i * NEAR_EACH) % (len(r["m"]) // 4)] for i, r in enumerate(sorted((r for r in some if r["m"]), key=lambda r: r["fp"]))]
    points = np.sort(np.concatenate(picks)).astype(np.uint64) if picks else np.empty(0, np.uint64)
    return Tree(points, halves(RADIUS)[0][0], 1, max(LEAF_SAMPLE, int(leaf * len(points) / max(n, 1))))


def _entries(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(leaf, half, node, class) of all halves of the sets (fp, plain, short and maybe class), in the order of leaves. A node
    is 32 bits of fp, a class a node; a set without is its own.

    Of equal sets in a batch one is taken.
    """
    for b in (whole.slice(at, 2048) for whole in batches for at in range(0, len(whole), 2048)):
        b = b.take(pa.array(np.unique(b.column(0).to_numpy(zero_copy_only=False), return_index=True)[1]))
        nodes = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).astype(np.uint32)
        classes = nodes
        if b.num_columns > 3:
            classes = np.where(b.column(3).is_null(), nodes, b.column(3).fill_null(0).to_numpy(zero_copy_only=False)).astype(np.uint32)
        for kind in range(2):
            held = [(i, m) for i, m in enumerate(b.column(1 + kind).to_pylist()) if m]
            if not held:
                continue
            each, marks = len(held[0][1]) // 4, np.frombuffer(b"".join(m for _, m in held), "<u4")
            where, leaf = tree.descend(marks.astype(np.uint64))
            leaf = (kind * HALVES + where % each) * tree.leaves + leaf
            order = np.argsort(leaf, kind="stable")
            where = where[order]
            own = np.array([i for i, _ in held])[where // each]
            yield leaf[order], marks[where], nodes[own], classes[own]


def _runs(sorted_: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    cuts = [0, *(np.flatnonzero(np.diff(sorted_)) + 1).tolist(), len(sorted_)]
    return ((a, z) for a, z in zip(cuts, cuts[1:], strict=False) if a < z)


def _all_of(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each position of a range with each of another: ranges of ``n_a`` from ``a`` and of ``n_b`` from ``b``, in pairs."""
    n = n_a * n_b
    k, at = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return a[k] + at // n_b[k], b[k] + at % n_b[k]


def _across(marks: np.ndarray, nodes: np.ndarray, classes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(smaller, larger) node of each two of different classes whose halves differ in one bit at most, some at a time."""
    order = np.lexsort((nodes, classes, marks))
    marks, nodes, classes = marks[order], nodes[order], classes[order]
    fresh = np.ones(len(marks), bool)
    fresh[1:] = (marks[1:] != marks[:-1]) | (classes[1:] != classes[:-1])
    run = np.flatnonzero(fresh)  # of one half and class
    n_run = np.diff(np.append(run, len(marks)))
    values, at, n_at = np.unique(marks[run], return_index=True, return_counts=True)
    near = [(np.arange(len(values)),) * 2]
    for bit in range(BITS // 2):
        other = values ^ np.uint32(1 << bit)
        to = np.minimum(np.searchsorted(values, other), len(values) - 1)
        i = np.flatnonzero((values[to] == other) & (values < other))
        near.append((i, to[i]))
    i, j = (np.concatenate([x[k] for x in near]) for k in range(2))
    x, y = _all_of(at[i], n_at[i], at[j], n_at[j])
    apart = (classes[run[x]] != classes[run[y]]) & ((marks[run[x]] != marks[run[y]]) | (x < y))
    x, y = x[apart], y[apart]
    step = np.cumsum(n_run[x] * n_run[y]) >> 20
    for a, z in _runs(step):
        u, v = (nodes[p] for p in _all_of(run[x[a:z]], n_run[x[a:z]], run[y[a:z]], n_run[y[a:z]]))
        both = np.unique(np.minimum(u, v).astype(np.uint64) << np.uint64(32) | np.maximum(u, v))
        yield both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)


def bands_of_leaf(marks: np.ndarray, nodes: np.ndarray, classes: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(band, node) of a leaf, where links of one bit at most between halves make groups.

    Without classes: the nodes of each group, in the band that its smallest node names. With classes: in the band of a node
    those larger ones of other classes that it links with itself.
    """
    values, at = np.unique(marks, return_inverse=True)
    root = np.arange(len(values))
    u, v = link(values.astype(np.int64), 1)
    root[np.searchsorted(values, u)] = np.searchsorted(values, v)
    of = root[at]
    own = np.flatnonzero(np.bincount(of)[of] > 1)
    own = own[np.lexsort((nodes[own], of[own]))]
    runs, label = _runs(of[own]), nodes if classes is None else classes
    mixed = [g for g in (own[a:z] for a, z in runs) if (label[g] != label[g[0]]).any()]
    if classes is None:
        for g in mixed:
            yield np.full(len(g), nodes[g[0]]), nodes[g]
    elif mixed:
        own = np.concatenate(mixed)
        yield from _across(marks[own], nodes[own], classes[own])


def met_in_leaves(rows: DataFrame, n: int, leaf_size: int | None = None, hot: int = NEAR_HOT) -> DataFrame:
    """(band, node): the ``n`` different sets (fp, plain, short), which may repeat, that are within one bit of another in a half of a fingerprint.

    A band has the number of its smallest node, so those that many halves have in common are one. If the rows have a
    ``class`` (null: their own), only sets of different classes meet, each two by themselves.
    """
    tree = half_tree(rows, n, leaf_size)
    classed = "class" in rows.columns
    asked = rows.select("fp", "plain", "short")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * HALVES * tree.leaves, np.int64)
        for leaf, *_ in _entries(batches, tree):
            total += np.bincount(leaf, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["leaf", "n"])

    full = asked.mapInArrow(count, "leaf bigint, n bigint").groupBy("leaf").agg(F.sum("n").alias("n")).where(F.col("n") > hot)
    blocks = {r["leaf"]: -(-r["n"] // max(1, hot // 2)) for r in full.collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, marks, nodes, classes in _entries(batches, tree):
            names, of = [], ([], [], [])

            def put(name: int, m: np.ndarray, n: np.ndarray, c: np.ndarray) -> None:
                for some, held in ((n == c, [m, n]), (n != c, [m, n, c])):  # classes are written where they aren't the node
                    if some.any():
                        names.append(name)
                        for k in range(3):
                            of[k].append(held[k][some].tobytes() if k < len(held) else b"")

            for a, z in _runs(leaf):
                name, m, n, c = int(leaf[a]), marks[a:z], nodes[a:z], classes[a:z]
                if name not in blocks:
                    put(name, m, n, c)
                    continue
                own = (n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[name]
                for x in np.unique(own).tolist():
                    for y in range(blocks[name]):
                        pair = np.array([name, min(x, y), max(x, y)]).tobytes()
                        put(-1 - (xxhash.xxh3_64_intdigest(pair) >> 1), m[own == x], n[own == x], c[own == x])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), *(pa.array(o, pa.binary()) for o in of)], ["leaf", "marks", "nodes", "classes"])

    def out(held: list[tuple[bytes, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        marks, nodes, classes = (np.frombuffer(b"".join(h[k] or h[1] for h in held), "<u4") for k in range(3))
        for found in bands_of_leaf(marks, nodes, classes if classed else None):
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], ["band", "node"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, held = None, []
        for b in batches:
            for name, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if name != leaf and held:
                    yield from out(held)
                    held = []
                leaf = name
                held.append(row)
        if held:
            yield from out(held)

    if classed:
        asked = rows.select("fp", "plain", "short", "class")
    dealt = asked.mapInArrow(deal, "leaf bigint, marks binary, nodes binary, classes binary").repartition("leaf").sortWithinPartitions("leaf")
    return dealt.mapInArrow(linked, "band bigint, node bigint").distinct()


def alike(stars: DataFrame, rows: DataFrame) -> DataFrame:
    """Those pairs (u, v) of nodes whose fingerprints differ in at most a share of ALIKE of their bits."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for *x, in zip(*(b.column(k).to_pylist() for k in range(2, 6)), strict=True):
                a, z = (x[0], x[1]) if x[0] and x[1] else (x[2], x[3])
                keep.append(bool(a and z) and int(np.bitwise_count(np.frombuffer(a, "<u4") ^ np.frombuffer(z, "<u4")).sum()) <= ALIKE * 8 * len(a))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    ends = stars.select(F.col("u").alias("node")).unionByName(stars.select(F.col("v").alias("node"))).distinct()
    held = rows.select(_node().alias("node"), "plain", "short").join(ends, "node", "left_semi").dropDuplicates(["node"])
    left, right = (held.select(F.col("node").alias(n), F.col("plain").alias(f"plain_{n}"), F.col("short").alias(f"short_{n}")) for n in "uv")
    return stars.join(left, "u").join(right, "v").select("u", "v", "plain_u", "plain_v", "short_u", "short_v").mapInArrow(of, "u bigint, v bigint")


def _node() -> Column:
    return F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, shingles) of the rows (fp, key) that are ``wanted``, one key for each fp. Repeated rows meet by the key they are joined by."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [shingle_set(t).tobytes() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], ["fp", "shingles"])

    return docs.join(wanted, "key").dropDuplicates(["key"]).select("fp", "text").mapInArrow(of, "fp bigint, shingles binary")


def similar(a: bytes, b: bytes) -> bool:
    """Whether two shingle sets have a Jaccard similarity of SIMILAR or more."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common * SIMILAR[1] >= (len(x) + len(y) - common) * SIMILAR[0]


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (u, v) whose sets are similar."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.select(["u", "v"]).filter(pa.array([similar(x.as_py(), y.as_py()) for x, y in zip(b.column(2), b.column(3), strict=True)], pa.bool_()))

    left, right = (sets.select(F.col("fp").alias(n), F.col("shingles").alias(f"of_{n}")) for n in "uv")
    return pairs.join(left, "u").join(right, "v").select("u", "v", "of_u", "of_v").mapInArrow(of, "u bigint, v bigint")


def _close(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(a, b) * SIMILAR[1] >= F.greatest(a, b) * SIMILAR[0]


def link_sets(sets: list[np.ndarray], roots: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of positions whose sets are similar, as many as join what can be joined. Sets with one root are joined already.

    The members that hold each shingle are listed once; a set's overlaps with all others are counts over these lists.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), sizes)
    by_code = np.argsort(code, kind="stable")
    first = np.searchsorted(code[by_code], np.arange(code.max() + 2))
    holder = holder[by_code]
    ends, found, group = np.cumsum(sizes), [], _Roots(len(sets))
    same = np.unique(roots, return_inverse=True)[1]
    for r in range(same.max() + 1):
        members = np.flatnonzero(same == r)
        group.join(members[1:], np.full(len(members) - 1, members[0]))
    for i in range(len(sets) - 1):
        flat = group.flat()
        ask = np.flatnonzero(flat[i + 1 :] != flat[i]) + i + 1
        ask = ask[(np.minimum(sizes[ask], sizes[i]) * SIMILAR[1] >= np.maximum(sizes[ask], sizes[i]) * SIMILAR[0])]
        if not len(ask):
            continue
        common = np.zeros(len(sets), np.int64)
        for c in code[ends[i] - sizes[i] : ends[i]].tolist():
            common[holder[first[c] : first[c + 1]]] += 1
        near = ask[common[ask] * SIMILAR[1] >= (sizes[ask] + sizes[i] - common[ask]) * SIMILAR[0]]
        for j in near.tolist():
            if group.find(i) != group.find(j):
                group.join(np.array([i]), np.array([j]))
                found.append((j, i))
    return found


def _links_of_bands(tied: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v) of similar sets of a band, from rows (band, fp, root, n) of the bands to search, dealt into ``n`` blocks.

    Each pair of blocks is searched on its own.
    """
    block = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    met = tied.select("fp", "root", "band", "n", block.alias("a"))
    one = met.where("n = 1").select("fp", "root", F.col("band").alias("leaf"))
    more = met.where("n > 1").select("fp", "root", "band", "a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("b"))
    rows = one.unionByName(more.select("fp", "root", F.xxhash64("band", F.least("a", "b"), F.greatest("a", "b")).alias("leaf")))
    dealt = rows.join(sets, "fp").select("leaf", "fp", "root", "shingles").repartition("leaf").sortWithinPartitions("leaf", "fp")

    def out(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        fps = np.array([h[0] for h in held], np.int64)
        found = link_sets([np.frombuffer(h[2], np.uint64) for h in held], np.array([h[1] for h in held], np.int64))
        u, v = (fps[[f[k] for f in found]] if found else np.empty(0, np.int64) for k in range(2))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, held = None, []
        for b in (whole.slice(at, 256) for whole in batches for at in range(0, len(whole), 256)):
            for name, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if name != leaf and held:
                    yield out(held)
                    held = []
                leaf = name
                held.append(row)
        if held:
            yield out(held)

    return dealt.mapInArrow(of, "u bigint, v bigint")


def _with_band(rows: DataFrame, of_part: dict[str, Column], of_band: dict[str, Column]) -> DataFrame:
    """Rows with aggregates of their band: taken within SALTS parts of it, then over the parts, and joined back to the parts
    that exist, so that no task reads all rows of a band."""
    dealt = rows.withColumn("_s", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    parts = dealt.groupBy("band", "_s").agg(*(c.alias(n) for n, c in of_part.items()))
    whole = parts.groupBy("band").agg(*(c.alias(n) for n, c in of_band.items()), F.collect_list("_s").alias("_s"))
    return dealt.join(whole.withColumn("_s", F.explode("_s")), ["band", "_s"]).drop("_s")


def near_links(rows: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v): links that join all sets which meet in a leaf and are similar, as components.

    ``rows`` (fp, plain, short) have the fingerprints, ``reps`` (fp, rep, size) the key of one text for each set. In a dense
    group each set would meet most others, over and over. So what meets in the FIRST halves and is somewhat alike makes
    classes, and in the search of all halves only sets of different classes meet, which are compared pair by pair. Classes
    that similar stars leave with several components are then searched whole, in blocks, without a row for a pair that is
    not similar. So every two sets that meet are compared or joined, whatever the classes are; there is no cap.
    """
    own, n = reps.select("fp", "size", _node().alias("node")), reps.count()
    first = rows.select("fp", *(F.substring(c, 1, 4 * FIRST).alias(c) for c in ("plain", "short")))
    ends = lambda met: met.where("node <> band").select(F.col("node").alias("u"), F.col("band").alias("v"))
    stars = cut(alike(cut(ends(met_in_leaves(first, n))), rows))
    release(reps.sparkSession)
    classes = cut(connected_components(stars, FEW).select(F.col("u").alias("node"), F.col("v").alias("class")))
    classed = cut(rows.withColumn("node", _node()).join(classes, "node", "left").select("fp", "plain", "short", "class"))
    pairs = cut(stars.unionByName(ends(met_in_leaves(classed, n))))
    del classed
    release(reps.sparkSession)
    for end in "uv":
        pairs = pairs.join(own.select(F.col("node").alias(end), F.col("fp").alias(f"fp_{end}"), F.col("size").alias(f"size_{end}")), end)
    pairs = cut(pairs.where(_close(F.col("size_u"), F.col("size_v"))).select(F.col("fp_u").alias("u"), F.col("fp_v").alias("v")))
    members = classes.unionByName(classes.select(F.col("class").alias("node"), "class").distinct())
    members = cut(own.join(members, "node").select("fp", "size", F.col("class").alias("band")))
    wanted = members.select("fp").unionByName(pairs.select(F.col("u").alias("fp"))).unionByName(pairs.select(F.col("v").alias("fp"))).distinct()
    sets = cut(_sets(docs, reps.join(wanted, "fp", "left_semi").select("fp", F.col("rep").alias("key"))))
    release(reps.sparkSession)
    found = cut(_near(pairs, sets))
    release(reps.sparkSession)
    joined = connected_components(found, FEW).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    tied = members.join(joined, "fp", "left").select("band", "fp", "size", F.coalesce("root", "fp").alias("root"))
    sums = {"least": F.min("root"), "most": F.max("root"), "bytes": F.sum("size") * 8, "count": F.count(F.lit(1))}
    whole = {"least": F.min("least"), "most": F.max("most"), "bytes": F.sum("bytes"), "count": F.sum("count")}
    tied = cut(_with_band(tied, sums, whole).where("least < most").select("band", "fp", "root", _blocks().alias("n")))
    return found.unionByName(cut(_links_of_bands(tied, sets)))


def _blocks() -> Column:
    """Blocks of a band with this count and bytes."""
    return F.greatest(F.ceil(F.col("bytes") / BLOCK_BYTES), F.ceil(F.col("count") / BLOCK_SETS)).cast("int")


def _searched(tied: DataFrame) -> DataFrame:
    """(band, fp, root, n): the bands, or where it is less work, all sets that bands join as one band in their place.

    A dense group meets in many halves, each time with somewhat other members; together they are searched once. Every pair
    of a band is in either. Classes have no sets in common, so the near stage doesn't need it.
    """
    joined = connected_components(tied.select(F.col("fp").alias("u"), F.col("first").alias("v"))).select(F.col("u").alias("fp"), F.col("v").alias("all"))
    own = tied.groupBy("fp").agg(F.first("size").alias("size"), F.first("root").alias("root"), F.sum("n").alias("rows"))
    own = own.join(joined, "fp", "left").select("fp", "size", "root", "rows", F.coalesce("all", "fp").alias("band"))
    sums = {"bytes": F.sum("size") * 8, "count": F.count(F.lit(1)), "apart": F.sum("rows")}
    own = _with_band(own, sums, {n: F.sum(n) for n in sums})
    own = cut(own.select("band", "fp", "root", _blocks().alias("n"), (F.col("count") * _blocks() <= F.col("apart")).alias("once")))
    rest = tied.join(own.where("NOT once").select("fp"), "fp", "left_semi")
    return own.where("once").select("band", "fp", "root", "n").unionByName(rest.select("band", "fp", "root", "n"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of each group of near copies the one with the smallest identifier.

    Near copies are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and groups are what
    such links reach. Rows without identifier, and texts without words, have nothing to compare by and stay. Rows that repeat an identifier
    are told apart by their texts; rows that repeat both stay or go together.
    """
    some = F.col(text_col).rlike(r"[^\x20\x09-\x0D]") & F.col(id_col).isNotNull()
    name, key = unused(docs, "_key"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"))
    marked = docs.where(some).select(key.alias("key"), F.col(text_col).alias("text"))
    rows = cut(printed(marked))
    reps = cut(rows.groupBy("fp").agg(F.min("key").alias("rep"), F.first("size").alias("size")))
    least = _smallest(reps, connected_components(near_links(rows, reps, marked), FEW))
    gone = rows.join(least, "fp").where(F.col("component_id") != F.col("key")).select(F.col("key").alias(name)).distinct()
    return docs.withColumn(name, key).join(gone, name, "left_anti").select(*docs.columns)
