"""Exact n-gram Jaccard join by partitioning the universe of shingles.

Two sets of a similarity of at least ``percent`` per cent differ in at most H
elements, H given by their sizes. Sizes fall into bands; in a band's scheme the
universe is hashed into segments whose weights add up to H + 1 + slack. An exact
segment (weight 1) is unequal only if it holds a difference, a wide one (weight
2), indexed with its one-deletion neighbourhood, is missed only if it holds two;
so the segments on which a similar pair meets weigh more than the slack. How
many segments are wide is chosen by cost. The slack pays for segments that are
empty in a document: they are not indexed unless they weigh more.

Buckets of the index are not expanded into pairs. Buckets of the same members
count as one. In each the members are tried along a shallow tree first, and
members of large ones with the centre of their largest bucket, its member in
most large buckets; what that links is contracted. In buckets that still hold
several components every member names one member of another component, of which
a size bound and a parity sketch, both exact, rule out most, or all of them
where they are few; rounds go on while many of these are linked, over the
buckets in which something is left to try. What is open then is searched for
every pair. Each member carries the least buckets that it is in;
a pair that shares one of these below the present bucket is left to that one, so
a pair comes from one bucket, not from all that both are in. A large bucket is
dealt out as pairs of blocks. Every link is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import ceil, exp, sqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm.common import Staging, drop, text_of, unused

#: Ratio of the largest to the smallest size of a band.
BAND_RATIO = 1.4
#: What a segment that is empty by chance costs, in signatures.
EMPTY_COST = 100.0
#: Cells of a sketch, by element, and least 64-bit words of one.
SKETCH_CELLS, SKETCH_WORDS = 2, 4
#: Members of a bucket that are tried against the same one at first.
FANOUT = 32
#: Rows that are broadcast at most; beyond it a shuffled join is used.
BROADCAST_ROWS = 500_000
#: Members of a bucket in one block, and pairs of one document in one task.
BLOCK, SHARE = 2048, 64
#: Least buckets of a member that it carries, to tell where a pair belongs.
FIRST = 8
#: A bucket gives all its pairs where they are at most so many for each named one.
FEW = 8
#: Rounds end when fewer than one in so many named pairs are linked.
SETTLED = 10
#: Signatures gathered for one reduce task.
TASK_SIGNATURES = 1_000_000
GROUP_BYTES = 3 << 20
SIGNATURE_BITS = 40


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a whole text.

    Words are runs of anything but ASCII white space, A-Z in lower case. Fewer
    than k words are one shingle; no words are none.
    """
    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    width = min(k, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, width, np.uint64)
        for i in range(width):
            out = mix(out * np.uint64(0x9FB21C651E98DF25) + h[i : n - width + 1 + i], i)
    return np.unique(out)


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed integers."""
    with np.errstate(over="ignore"):
        return int(mix(tokens, 101).sum(dtype=np.uint64).astype(np.int64)), int(mix(tokens, 202).sum(dtype=np.uint64).astype(np.int64))


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of its cells, a power of two of them: two
    sketches differ in at most as many cells as their sets do in elements, and
    so do they when the longer one is folded to the length of the other."""
    cells = 64 * SKETCH_WORDS
    while cells < SKETCH_CELLS * len(tokens):
        cells *= 2
    at = (mix(tokens, 303) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(words: np.ndarray, to: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) as those with ``to`` words would be."""
    while words.shape[1] > to:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


class Scheme(NamedTuple):
    """Segments of a band: the first ``wide`` ones have deletion neighbourhoods."""

    exact: int
    wide: int
    slack: int


def most_differences(a: int, b: int, percent: int) -> int:
    """Elements in which sets of sizes a and b differ at most when linked."""
    return (a + b) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=64)
def bands(percent: int, upto: int = 1 << 40) -> tuple[int, ...]:
    """Least sizes of bands. Linked sets lie in one band or in adjoining ones."""
    out = [1]
    while out[-1] < upto:
        low = out[-1]
        out.append(max(low + 1, int(low * BAND_RATIO), (low - 1) * 100 // percent + 1))
    return tuple(out)


@lru_cache(maxsize=4096)
def allocate(band: int, percent: int) -> Scheme | None:
    """Exact and wide segments of a band's scheme, of least cost.

    None where linked sets can only be equal. The cost of a choice is its
    number of signatures and the chance that segments are empty; the slack is
    what all but about one document in ten thousand lose by empty segments.
    """
    low, high = bands(percent)[band], bands(percent)[band + 1] - 1
    differences = most_differences(high, high, percent)
    if differences < 1:
        return None
    least = max(1, low * percent // 100)
    typical = (low + high) / 2
    best = None
    for share in range(11):
        slack = 0
        for _ in range(40):
            weight = differences + 1 + slack
            wide = round(share / 10 * (weight // 2))
            exact = weight - 2 * wide
            segments = exact + wide
            per = least / segments
            lost = exact * exp(-per) + 2 * wide * exp(-per) * (1 + per)
            need = ceil(lost + 4 * sqrt(lost) + 0.5)
            if need <= slack:
                break
            slack = need
        per = typical / segments
        cost = exact + wide * (1 + per) + EMPTY_COST * (exact * exp(-per) + wide * exp(-max(0.0, per - 1)))
        if best is None or cost < best[0]:
            best = (cost, Scheme(exact, wide, slack))
    return best[1]


def schemes_of(size: int, percent: int) -> list[int]:
    """Bands whose scheme a set of this size is indexed in: its own, and the next
    if a linked set can lie there."""
    limits = bands(percent)
    band = int(np.searchsorted(np.array(limits), size, side="right")) - 1
    return [band, band + 1] if size * 100 >= percent * limits[band + 1] else [band]


def signatures(tokens: np.ndarray, percent: int) -> list[np.ndarray]:
    """The index keys of a set in each of its schemes, its own band's first."""
    out = []
    for band in schemes_of(len(tokens), percent):
        scheme = allocate(band, percent)
        if scheme is None:
            out.append(np.empty(0, np.uint64))
            continue
        segments = scheme.exact + scheme.wide
        mixed = mix(tokens, 1000 + band)
        place = ((mixed >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, mixed = place[order], mix(mixed[order], 7)
        sizes = np.bincount(place, minlength=segments)
        filled = np.flatnonzero(sizes)
        starts = np.concatenate(([0], np.cumsum(sizes[filled])[:-1]))
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(mixed, starts)
            tag = mix(np.arange(segments, dtype=np.uint64), 5000 + band)
            keys = [mix(sums + tag[filled])]
            if scheme.wide:
                inside = place < scheme.wide
                at = np.searchsorted(filled, place[inside])
                without = sums[at] - mixed[inside]
                keys.append(mix(without + tag[place[inside]])[sizes[place[inside]] > 1])
            lost = int((sizes[scheme.wide :] == 0).sum()) + 2 * int((sizes[: scheme.wide] <= 1).sum())
            if lost > scheme.slack:  # too many to do without
                exact = np.flatnonzero(sizes == 0)
                short = np.flatnonzero(sizes[: scheme.wide] == 1)
                keys.append(mix(tag[np.concatenate((exact, short))]))
        out.append(np.unique(np.concatenate(keys)))
    return out


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str]]]:
    rows, held = [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            rows.append((key.as_py(), text.as_py()))
            held += len(rows[-1][1])
            if held >= GROUP_BYTES:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _describe(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 4 + [pa.binary()]
    for rows in _texts(batches):
        out = []
        for key, text in rows:
            tokens = shingles(text, k)
            out.append((key, len(tokens), *set_key(tokens), sketch(tokens)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["doc_id", "n", "key1", "key2", "sketch"])


def _index(batches: Iterable[pa.RecordBatch], k: int, percent: int, labels: list[int]) -> Iterator[pa.RecordBatch]:
    """Signatures by part, packed: (part, keys, nodes). A set that the task has
    met before is not indexed again. A node's lowest bit tells whether the
    scheme is its own band's (0) or the next (1)."""
    parts = len(labels)
    seen: set[int] = set()
    for rows in _texts(batches):
        keys, nodes = [], []
        for _, text in rows:
            tokens = shingles(text, k)
            node = set_key(tokens)[0]
            if not len(tokens) or node in seen:
                continue
            if len(seen) < 1_000_000:
                seen.add(node)
            for role, found in enumerate(signatures(tokens, percent)):
                keys.append(found)
                nodes.append(np.full(len(found), node & -2 | role, np.int64))
        if not sum(map(len, keys)):
            continue
        key, node = np.concatenate(keys), np.concatenate(nodes)
        part = ((key >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        key, node, part = key[order], node[order], part[order]
        key = key.view(np.uint8).reshape(-1, 8)[:, : SIGNATURE_BITS // 8]
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=parts + 1))
        out = [(labels[int(part[a])], key[a:b].tobytes(), _pack_nodes(node[a:b])) for a, b in zip(edges, edges[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary())], names=["part", "keys", "nodes"])


def _pack_nodes(node: np.ndarray) -> bytes:
    """Runs of equal nodes as their lengths and values; runs over 65,535 are split."""
    edges = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    runs = np.diff(np.append(edges, len(node)))
    pieces = (runs + 65534) // 65535
    lengths = np.full(pieces.sum(), 65535, np.uint16)
    lengths[np.cumsum(pieces) - 1] = runs - 65535 * (pieces - 1)
    return np.uint64(len(lengths)).tobytes() + np.repeat(node[edges], pieces).tobytes() + lengths.tobytes()


def _unpack_nodes(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.uint64, 1)[0])
    return np.repeat(np.frombuffer(data, np.int64, n, 8), np.frombuffer(data, np.uint16, n, 8 + 8 * n))


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of buckets of two nodes or more, one of them of the scheme's own
    band: (bucket, node, lead, size). ``bucket`` is a hash of all its members, so
    that buckets of the same members are one; ``lead`` stands above the member in
    a tree over them; ``size`` counts them."""
    width = SIGNATURE_BITS // 8
    by_part: dict[int, list[tuple[bytes, bytes]]] = {}
    for batch in batches:
        for part, keys, nodes in zip(*batch.columns, strict=True):
            by_part.setdefault(part.as_py(), []).append((keys.as_py(), nodes.as_py()))
    for part in sorted(by_part):
        packed = by_part.pop(part)
        raw = np.frombuffer(b"".join(x[0] for x in packed), np.uint8).reshape(-1, width)
        key = np.zeros((len(raw), 8), np.uint8)
        key[:, :width] = raw
        key = key.view(np.int64).ravel()
        node = np.concatenate([_unpack_nodes(x[1]) for x in packed])
        del raw, packed
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node = key[new], node[new]
        own, node = node & 1 == 0, node & -2
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(start, len(key)))
        with np.errstate(over="ignore"):
            bucket = mix(np.add.reduceat(mix(node.view(np.uint64), 404), start) + size.astype(np.uint64), 405)
        many = np.flatnonzero((size > 1) & np.logical_or.reduceat(own, start))
        many = many[np.unique(bucket[many], return_index=True)[1]]
        if not len(many):
            continue
        count = size[many]
        rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        first = np.repeat(start[many], count)
        above = first + np.maximum(rank - 1, 0) // FANOUT
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(bucket[many], count).view(np.int64)), pa.array(node[first + rank]), pa.array(node[above]), pa.array(np.repeat(count, count))], names=["bucket", "node", "lead", "size"])


def _sets(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
    for rows in _texts(batches):
        out = [(key, len(tokens), tokens.view(np.int64)) for key, tokens in ((key, shingles(text, k)) for key, text in rows)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["id", "n", "tokens"])


def _allowed(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b) with sizes and sketches, those that these do not rule out."""
    for batch in batches:
        na, nb = (batch.column(k).to_numpy() for k in (2, 3))
        keep = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
        limit = (na + nb) * (100 - percent) // (100 + percent)
        for i in np.flatnonzero(keep).tolist():
            x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64)[None] for k in (4, 5))
            to = min(x.shape[1], y.shape[1])
            keep[i] = np.bitwise_count(fold(x, to) ^ fold(y, to)).sum() <= limit[i]
        yield batch.filter(pa.array(keep)).select(["a", "b"])


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    The pairs of an ``a`` that is in many are dealt out in shares, each with a
    copy of its set. ``pairs`` is a staged table."""
    few = pairs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    hint = F.broadcast if few else lambda x: x
    shares = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
    dealt = pairs.join(hint(shares), "a").select("a", "b", F.pmod(F.hash("b"), F.col("shares")).alias("share"))
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")).join(hint(shares), "a").select("a", "na", "ta", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    close = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    found = right.join(hint(dealt), "b").join(left, ["a", "share"]).filter(close)
    return found.filter(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """id and label (the least id that can be reached) of all ends of ``edges``,
    as a staged table.

    Each round takes the least label among neighbours and then the label of
    that label; both are partial minimums over joins, so a node with very many
    edges is no large group. Rounds end when no label changes. Ends that are
    null link nothing; edges may repeat and may join a node to itself; without
    edges the result is empty.
    """
    edges = edges.filter("a is not null and b is not null")
    with Staging() as own:
        both = own.stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
        labels = own.stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label"), F.lit(True).alias("moved")), f"{name}-labels")
        while not labels.filter("moved").isEmpty():
            near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
            step = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "near").alias("next"))
            jump = step.join(labels.select(F.col("id").alias("of"), F.col("label").alias("far")), F.col("next") == F.col("of"), "left")
            new = F.least("next", "far")
            after = own.stage(jump.select("id", new.alias("label"), (F.col("label") != new).alias("moved")), f"{name}-labels")
            own.drop(labels)
            labels = after
        kept = own.keep(labels)
    out = kept.select("id", "label")
    out.staged_at = kept.staged_at
    return out


class Found(NamedTuple):
    """Pairs (a, b) named in one bucket, with the components of both, and
    whether others belong to the bucket."""

    a: np.ndarray
    b: np.ndarray
    comp_a: np.ndarray
    comp_b: np.ndarray
    more: bool


def _levels(bits: list[np.ndarray], width: np.ndarray) -> dict[int, tuple[int, np.ndarray]]:
    """For each width that occurs: the first member with it, and the words (one
    row each) of that and all later members, folded to this width."""
    out = {}
    for w in np.unique(width).tolist():
        first = int(np.searchsorted(width, w))
        parts = [fold(np.stack(bits[x:y]), w) for x, y in ((int(np.searchsorted(width, v)), int(np.searchsorted(width, v, side="right"))) for v in np.unique(width[first:]).tolist())]
        out[w] = (first, np.ascontiguousarray(np.concatenate(parts).T))
    return out


def _near(words: np.ndarray, own: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Which columns of ``words`` differ from ``own`` in at most ``limit`` cells;
    a quarter of the words is looked at first, as it rules out most."""
    quarter = len(words) // 4
    hit = np.flatnonzero(np.bitwise_count(words[:quarter] ^ own[:quarter, None]).sum(axis=0, dtype=np.int64) <= limit)
    if len(hit):
        hit = hit[np.bitwise_count(words[:, hit] ^ own[:, None]).sum(axis=0, dtype=np.int64) <= limit[hit]]
    return hit


def _open_pairs(side: np.ndarray, ids: np.ndarray, comp: np.ndarray, n: np.ndarray, bits: list[np.ndarray], percent: int, every: bool, first: np.ndarray | None = None, bucket: int = 0, few: int = 0) -> Iterator[Found]:
    """Pairs of one bucket in different components that size and sketch allow.

    With ``every`` all of them; else each member names the one of the least
    component (and id) among those below its own, and again all come out if they
    are at most ``few`` for each that is named. Members of the largest component
    are not compared with each other. With ``first``, the least buckets of each member (a row each), pairs that have one below ``bucket`` in
    common belong to that one and are passed over here: the least bucket that
    two members share never passes them over.
    """
    order = np.argsort(n, kind="stable")
    side, ids, comp, n, bits = side[order], ids[order], comp[order], n[order], [bits[k] for k in order.tolist()]
    first = None if first is None else first[order]
    labels, place, sizes = np.unique(comp, return_inverse=True, return_counts=True)
    if len(labels) == 1:
        return
    main = (place == np.argmax(sizes)) & (sizes.max() > 1)
    mains = np.flatnonzero(main)
    width = np.array([len(x) for x in bits])  # it rises with n
    levels = _levels(bits, width)
    low, high = np.searchsorted(n, -(-n * percent // 100)).tolist(), np.searchsorted(n, n * 100 // percent, side="right").tolist()
    best, allowed, held = np.full(len(ids), -1), 0, []

    def pairs(i: int, j: np.ndarray) -> Found:
        below = comp[j] < comp[i]
        a, b = np.where(below, j, i), np.where(below, i, j)
        return Found(ids[a], ids[b], comp[a], comp[b], False)

    rank = np.empty(len(ids), np.int64)  # by component and id
    rank[np.lexsort((ids, comp))] = np.arange(len(ids))
    for i in np.flatnonzero(~main).tolist():
        hits = []
        if i + 1 < high[i]:
            at, words = levels[width[i]]
            hits.append(_near(words[:, i + 1 - at : high[i] - at], words[:, i - at], (n[i + 1 : high[i]] + n[i]) * (100 - percent) // (100 + percent)) + i + 1)
        earlier = mains[np.searchsorted(mains, low[i]) : np.searchsorted(mains, i)]
        for w in np.unique(width[earlier]).tolist() if len(earlier) else ():
            at, words = levels[w]
            j = earlier[width[earlier] == w]
            hits.append(j[_near(words[:, j - at], words[:, i - at], (n[j] + n[i]) * (100 - percent) // (100 + percent))])
        j = np.concatenate(hits) if hits else np.empty(0, np.int64)
        if len(j):
            j = j[(comp[j] != comp[i]) & ((side[j] != side[i]) | (side[j] == 2))]
        if len(j) and first is not None:
            j = j[~np.isin(first[j], first[i][first[i] < bucket]).any(axis=1)]
        if not len(j):
            continue
        if every:
            yield pairs(i, j)
            continue
        lower, higher = j[comp[j] < comp[i]], j[comp[j] > comp[i]]
        allowed += len(j)
        if allowed <= few * len(ids):
            held.append((i, j))
        if len(lower):
            least = lower[np.argmin(rank[lower])]
            if best[i] < 0 or rank[least] < rank[best[i]]:
                best[i] = least
        better = higher[(best[higher] < 0) | (rank[i] < rank[best[higher]])]
        best[better] = i
    if allowed:
        b = np.flatnonzero(best >= 0)
        if len(b) < allowed <= few * len(b):
            yield from (pairs(i, j) for i, j in held)
            return
        a = best[b]
        yield Found(ids[a], ids[b], comp[a], comp[b], allowed > len(b))


def _search(batches: Iterable[pa.RecordBatch], percent: int, every: bool) -> Iterator[pa.RecordBatch]:
    """:func:`_open_pairs` of sorted buckets (key, bucket, side, id, comp, n,
    sketch, first), as rows (bucket, a, b, comp_a, comp_b): pairs, without a
    bucket, and buckets to which others belong than they named."""
    names = ["a", "b", "comp_a", "comp_b"]
    pairs: list[Found] = []
    buckets: list[int] = []
    held, carried = 0, None

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal pairs, buckets, held
        if pairs:
            table = pd.DataFrame({c: np.concatenate([getattr(x, c) for x in pairs]) for c in names}).drop_duplicates()
            yield pa.RecordBatch.from_arrays([pa.nulls(len(table), pa.int64()), *[pa.array(table[c].to_numpy(np.int64)) for c in names]], names=["bucket", *names])
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), *[pa.nulls(len(buckets), pa.int64())] * 4], names=["bucket", *names])
        pairs, buckets, held = [], [], 0

    def search(table: pa.Table, last: bool) -> None:
        nonlocal carried, held
        key = table.column(0).to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        ends = np.append(edges[1:], len(key))
        if not last:
            carried = table.slice(edges[-1])
            edges, ends = edges[:-1], ends[:-1]
        bucket, side, ids, comp, n = (table.column(k).to_numpy() for k in range(1, 6))
        sketches, first = table.column(6), pc.list_flatten(table.column(7)).to_numpy().reshape(-1, FIRST)
        for a, b in zip(edges.tolist(), ends.tolist(), strict=True):
            if b - a > 1 and (comp[a:b] != comp[a]).any():
                bits = [np.frombuffer(x.as_buffer(), np.uint64) for x in sketches.slice(a, b - a)]
                for x in _open_pairs(side[a:b], ids[a:b], comp[a:b], n[a:b], bits, percent, every, first[a:b], bucket[a:b].min(), FEW):
                    pairs.append(x)
                    held += len(x.a)
                    if x.more:
                        buckets.extend(set(bucket[a:b].tolist()))

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if carried is None else pa.concat_tables([carried, table])
        carried = None
        if table.num_rows:
            search(table, False)
            if held > 500_000:
                yield from flush()
    if carried is not None:
        search(carried, True)
    yield from flush()


def _members(open_: DataFrame, sketches: DataFrame) -> DataFrame:
    """Members of open buckets with their sketches and least buckets, by block
    pair of a bucket.

    A bucket of ``blocks`` blocks is as many as their pairs: a member goes to
    the pairs that its block is in, on one side of them (0 or 1), and on both
    (2) in the pair of its block with itself.
    """
    dealt = open_.withColumn("mine", F.pmod(F.hash("id"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other"))
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1)
    slim = dealt.select(key.alias("key"), "bucket", side.cast("long").alias("side"), "id", "comp")
    return slim.join(sketches, "id").select("key", "bucket", "side", "id", "comp", "n", "sketch", "first")


def _few(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows with an id of ``ids``: broadcast if they are few, else shuffled."""
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(ids) if few else ids, column, "left_semi")


def _best_lead(rows: DataFrame) -> DataFrame:
    """Of (id, lead), the lead that most buckets name for each id, as (a, b)."""
    counted = rows.groupBy("id", "lead").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("id").agg(F.max_by("lead", F.struct("n", -F.col("lead"))).alias("a")).select("a", F.col("id").alias("b"))


def _centres(placed: DataFrame) -> DataFrame:
    """For each member of buckets of more than FANOUT, the centre of the largest
    of these: the one of its members that is in most, as (a, b)."""
    wide = placed.filter(F.col("size") > FANOUT)
    centre = wide.groupBy("bucket").agg(F.max_by("id", F.struct("degree", -F.col("id"))).alias("a"))
    largest = wide.groupBy("id").agg(F.max_by("bucket", F.struct("size", "bucket")).alias("bucket"))
    return largest.join(centre, "bucket").select("a", F.col("id").alias("b"))


def _least_buckets(placed: DataFrame) -> DataFrame:
    """id and ``first``: the least FIRST of its buckets, filled up with the
    largest integer, below which no bucket looks."""
    least = F.slice(F.array_sort(F.collect_set("bucket")), 1, FIRST)
    return placed.groupBy("id").agg(F.concat(least, F.array_repeat(F.lit(2**63 - 1), FIRST)).alias("first")).select("id", F.slice("first", 1, FIRST).alias("first"))


def part_labels(spark, tasks: int) -> list[int]:
    """For each of ``tasks`` shuffle partitions an integer that is dealt to it."""
    rows = spark.range(40 * tasks).select(F.col("id").cast("int").alias("label")).groupBy(F.expr(f"pmod(hash(label), {tasks})").alias("part")).agg(F.min("label").alias("label")).collect()
    found = {r["part"]: r["label"] for r in rows}
    return [found.get(i, i) for i in range(tasks)]


class Join(NamedTuple):
    """docs: doc_id, n, rep (least id of the same set); edges: verified links
    between representatives, enough to connect what is linked."""

    docs: DataFrame
    edges: DataFrame


def join(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> Join:
    """Links of all documents of ``docs``; see :func:`similar`. Its two tables
    are staged."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    with Staging() as own:
        described = own.stage(texts.mapInArrow(lambda x: _describe(x, k), "doc_id long, n long, key1 long, key2 long, sketch binary"), "jaccard-sets")
        keys = ["key1", "key2", "n"]
        classes = own.stage(described.filter("n > 0 and doc_id is not null").groupBy(*keys).agg(F.min("doc_id").alias("rep")), "jaccard-classes")
        members = own.keep(own.stage(described.join(classes, keys, "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "jaccard-members"))
        links = own.keep(_links(own, texts, described, classes, k, percent))
    return Join(members, links)


def _links(own: Staging, texts: DataFrame, described: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links between the representatives of ``classes``."""
    spark = texts.sparkSession
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * total // (2 * TASK_SIGNATURES) + 1)  # about 1.5 signatures a shingle
    labels = part_labels(spark, tasks)
    packed = texts.mapInArrow(lambda x: _index(x, k, percent, labels), "part int, keys binary, nodes binary").repartition(tasks, "part")
    buckets = own.stage(packed.mapInArrow(_buckets, "bucket long, node long, lead long, size long").distinct(), "jaccard-buckets")
    reps = classes.select(F.expr("key1 & -2L").alias("node"), F.col("rep").alias("id"))
    leads = _best_lead(buckets.filter("node <> lead").select(F.col("node").alias("id"), "lead"))
    tried = leads.join(reps.select(F.col("node").alias("a"), F.col("id").alias("a_id")), "a").join(reps.select(F.col("node").alias("b"), F.col("id").alias("b_id")), "b")
    degrees = buckets.filter(F.col("size") > FANOUT).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    placed = own.stage(buckets.select("bucket", "node", "size").join(reps.join(degrees, "node", "left"), "node").select("bucket", "id", "size", "degree"), "jaccard-placed")
    tried = own.stage(tried.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).union(_centres(placed)).filter("a <> b"), "jaccard-tried")
    own.drop(buckets)
    ids = own.stage(_least_buckets(placed), "jaccard-ids")
    sketches = own.stage(_few(described.select(F.col("doc_id").alias("id"), "n", "sketch"), ids.select("id"), "id").join(ids, "id"), "jaccard-sketches")
    sketches = sketches.distinct() if _repeats(sketches) else sketches  # the rows of a repeated id

    def sets(wanted: DataFrame) -> DataFrame:
        """The token sets of the ids ``wanted``, staged."""
        few = _few(texts, wanted.select(F.col("id").alias("doc_id")), "doc_id").mapInArrow(lambda x: _sets(x, k), "id long, n long, tokens array<long>")
        table = own.stage(few, "jaccard-tokens")
        return table.distinct() if _repeats(table) else table

    of = lambda side: sketches.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}"))
    hinted = own.stage(tried.join(of("b"), "b").join(of("a"), "a").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(lambda x: _allowed(x, percent), "a long, b long").distinct(), "jaccard-hinted")
    own.drop(tried)
    tokens = sets(own.stage(hinted.select(F.col("a").alias("id")).union(hinted.select("b")).distinct(), "jaccard-ids"))
    links = own.stage(_verify(hinted, tokens, percent), "jaccard-links")
    comps = components(links, "jaccard-contracted")
    placed = own.stage(placed.join(comps.select("id", F.col("label").alias("comp")), "id", "left").select("bucket", "id", F.coalesce("comp", "id").alias("comp")), "jaccard-placed")
    drop(comps)
    every = False
    while True:
        several = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("size")).filter("low <> high").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
        open_ = own.stage(placed.join(several, "bucket"), "jaccard-open")
        search = _members(open_, sketches).repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(lambda x, e=every: _search(x, percent, e), "bucket long, a long, b long, comp_a long, comp_b long")
        found = own.stage(search, "jaccard-found")
        named = own.stage(found.filter("bucket is null").drop("bucket").distinct(), "jaccard-named")
        tokens = sets(own.stage(named.select(F.col("a").alias("id")).union(named.select("b")).distinct(), "jaccard-ids"))
        new = own.stage(_verify(named.select("a", "b"), tokens, percent), "jaccard-links")
        links = links.union(new)
        left = own.stage(found.filter("bucket is not null").select("bucket").distinct(), "jaccard-left")
        if left.isEmpty():
            break
        every = SETTLED * new.count() < named.count()
        merged = own.stage(new.join(named, ["a", "b"]).select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct(), "jaccard-merged")
        moved = components(merged, "jaccard-contracted")
        own.tables.append(moved)
        rest = open_.select("bucket", "id", "comp").join(left, "bucket")
        placed = own.stage(rest.join(moved.select(F.col("id").alias("comp"), "label"), "comp", "left").select("bucket", "id", F.coalesce("label", "comp").alias("comp")), "jaccard-placed")
    return own.stage(links.distinct(), "jaccard-links")


def _repeats(rows: DataFrame) -> bool:
    """Whether several rows share an id (documents that repeat one)."""
    return not rows.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").isEmpty()


def similar(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Documents whose sets of k-word shingles have a Jaccard similarity of at
    least ``percent`` per cent are linked; a component's id is the least id
    that links reach. Null and empty texts have no shingles and link with
    nothing; equal sets share a component; rows that repeat an id are one
    document with several sets; a null id stays null; an empty table gives an
    empty result; other columns are ignored.
    """
    found = join(docs, k, percent, id_col, text_col)
    labels = components(found.edges, "jaccard-components")
    drop(found.edges)
    return found.docs.join(labels, found.docs["rep"] == labels["id"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its least id.

    Rows without shingles all stay, and so do rows that repeat a kept id and
    rows without one; all columns are kept, whatever their names.
    """
    gone = similar(docs, k, percent, id_col, text_col).filter("doc_id <> component_id").select("doc_id").distinct()
    name = unused(docs, "gone")
    return docs.join(gone.withColumnRenamed("doc_id", name), F.col(f"`{id_col}`") == F.col(name), "left_anti")
