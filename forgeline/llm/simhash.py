"""Near duplicates by SimHash fingerprints, found with the generalised pigeonhole principle.

Fingerprints are cut into partitions of bits, correlated bits together. A pair within distance
D agrees, in at least one partition i, up to t_i bits, whenever the sum of (t_i + 1) is D + 1;
t_i = -1 leaves a partition out. Dynamic programming hands out the t_i so that the estimated
number of candidates is least. Both sides of a pair are probed alike: with all keys that differ
from their own in up to ceil(t_i / 2) bits, so that two keys within t_i meet in one of them.
Candidates are verified on the whole fingerprint.

For large distances (similarity 0.8 on longer fingerprints) no exact allocation is affordable.
There the least certain bits of each partition are flipped instead, those whose sum is nearest to
the majority threshold; the same dynamic programme deals the flips out, so that pairs at the
wanted similarity meet with the wanted probability at the least estimated cost. What is near by
fingerprint, and by 32 one-bit minima of the shingle set that the buckets carry along, is then filtered by sketches
of the sets and verified on the sets themselves.

Equal fingerprints (with flips: of equal sets of shingles) are one class from the start, so copies cost
nothing. Buckets that many
different fingerprints share are not compared pairwise: see ``_dense_links``, and ``_crossed`` for what
is left where the links to leaders do not already join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import by_slices, packed, unpacked
from .graph import components

SEED = 42
#: Buckets with more members than this, and more links a member, are first linked through leaders.
PAIRWISE = 32
#: Units of the logarithm of a miss in the allocation of flips.
UNITS = 20
#: Rows of one bucket that a task holds before it reduces them to leaders.
HELD = 20_000
#: Members of a dense bucket that are compared with as many others in one cell.
BLOCK = 4_096
#: Second and further 64 bits of a fingerprint: steps of the splitmix64 mixer over the hash.
GOLDEN, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
PRINT = pa.struct([("w", pa.list_(pa.int64())), ("margin", pa.binary()), ("sketch", pa.binary())])
#: Bytes of a sketch: one per bin of shingle hashes, from the smallest of the bin; 0 if it is empty.
SKETCH = 256
#: Of the signs, one bit each from the least shingle hash under so many orders, this many differ at most at the wanted
#: similarity of 0.8 (one in ten on average, more than these with odds of 1 in 20,000); of unlike texts, half do.
ORDERS = np.random.default_rng(SEED).integers(0, 1 << 63, 32, np.uint64) * np.uint64(2) + np.uint64(1)
UNLIKE = 11
#: Rounds in which each class is held against the nearest of those it may be linked to, before all are compared.
ROUNDS = 2
#: What a sketch's estimate may be short of the wanted similarity: four of its deviations at 0.8.
SLACK = 0.1


@dataclass(frozen=True)
class SimHash:
    """Parameters of fingerprints and links."""

    shingle: int = 3
    longs: int = 1  #: 64 bits each
    distance: int = 2
    flips: int = 0  #: most of the least certain bits flipped in a partition; 0 probes exactly
    similarity: float = 0.8  #: with flips: Jaccard similarity of shingles at which pairs are to meet
    recall: float = 0.96  #: with flips: and how probably
    partitions: tuple[int, ...] = (1, 2, 3)  #: numbers of partitions to choose from

    @property
    def bits(self) -> int:
        return 64 * self.longs

    @property
    def width(self) -> int:
        """Longs that tell classes apart: with flips, the last is made of the signs and of a hash of the set of shingles."""
        return self.longs + (self.flips > 0)


#: As the contract of op2 has it.
THREE_WORDS = SimHash()
#: Five-word shingles at a similarity of 0.8 or more: two texts of Jaccard similarity 0.8 have
#: fingerprints at an angle of 27 degrees, 19.5 of 128 bits on average with a deviation of 4.
FIVE_WORDS = SimHash(shingle=5, longs=2, distance=27, flips=5, partitions=(4, 5, 6))


def _sketch(h: np.ndarray) -> bytes:
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, (h % np.uint64(SKETCH)).astype(np.intp), h)
    values = ((least >> np.uint64(32)) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    return np.where(least == np.iinfo(np.uint64).max, np.uint8(0), values).tobytes()


def _signs(h: np.ndarray) -> np.uint64:
    """One bit of the least hash in each of the ORDERS, of distinct hashes."""
    least = np.full(len(ORDERS), np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(h), 1 << 14):
        least = np.minimum(least, (ORDERS[:, None] * h[None, first : first + (1 << 14)]).min(1))
    return ((np.bitwise_count(least).astype(np.uint64) & np.uint64(1)) << np.arange(len(ORDERS), dtype=np.uint64)).sum(dtype=np.uint64)


def _shingles(text: str, how: SimHash) -> np.ndarray:
    """The hashes of a text's shingles, as often as they occur; none without words."""
    body = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, gaps 09-0D and 20
    if not body:
        return np.zeros(0, np.uint64)
    joined, k = b" ".join(body), min(how.shingle, len(body))
    lengths = np.fromiter(map(len, body), np.int64, len(body))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(body) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())], np.uint64)


def _print_of(text: str, how: SimHash) -> tuple[list[int], bytes | None, bytes | None]:
    h = _shingles(text, how)
    count = len(h)
    if not count:
        return [0] * how.width, *((bytes(how.bits), bytes(SKETCH)) if how.flips else (None, None))
    of_set = []
    if how.flips:
        distinct = np.unique(h)
        of_set = [_signs(distinct) << np.uint64(32) | np.uint64(xxhash.xxh32_intdigest(distinct.tobytes(), SEED))]
        of_set = np.array(of_set, "<u8").view("<i8").tolist()
    counts, sketch = [], _sketch(h) if how.flips else None
    for _ in range(how.longs):
        padded = np.zeros((-len(h) % 255 + len(h)), np.uint64)
        padded[: len(h)] = h
        bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts.append(bits.reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64))
        h = h * GOLDEN
        h = (h ^ (h >> np.uint64(29))) * MIX
        h = h ^ (h >> np.uint64(32))
    over = 2 * np.concatenate(counts) - count
    margin = np.minimum(255, np.abs(over) * (64 / np.sqrt(count))).astype(np.uint8).tobytes() if how.flips else None
    return np.packbits(over > 0, bitorder="little").view("<i8").tolist() + of_set, margin, sketch


def fingerprint(text: Column, how: SimHash = THREE_WORDS) -> Column:
    """struct<w array<bigint>, margin binary, sketch binary> of a whole text; null counts as empty.

    Shingles repeat as often as they occur. A text with fewer words than a shingle is one
    shingle; one without words has fingerprint zero.
    """

    def prints(texts: list[str]) -> pa.Array:
        found = [_print_of(t, how) for t in texts]
        columns = [pa.array([f[k] for f in found], PRINT[k].type) for k in range(3)]
        return pa.StructArray.from_arrays(columns, fields=list(PRINT))

    return F.arrow_udf(by_slices(prints, PRINT), "w array<bigint>, margin binary, sketch binary")(text)


def _hex(longs: list[Column]) -> Column:
    """A fingerprint's name: 16 lowercase hex digits per 64 bits, the first 64 first."""
    return F.concat(*[F.lower(F.lpad(F.hex(w), 16, "0")) for w in longs])


# -- allocation -----------------------------------------------------------------------------


def _bit_sums(classes: DataFrame, how: SimHash) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many of them each pair of bits is set."""
    n = how.bits

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((n, n)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            longs = batch.column("w").flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(-1, how.width)
            longs = np.ascontiguousarray(longs[:, : how.longs])
            bits = np.unpackbits(longs.view(np.uint8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            count += len(bits)
        yield pa.RecordBatch.from_pydict({"count": [count], "sums": [total.ravel()]})

    each = classes.select("w").mapInArrow(sums, "count bigint, sums array<double>")
    cells = each.select("count", F.posexplode("sums").alias("at", "v"))
    rows = cells.groupBy("at").agg(F.sum("v").alias("v"), F.sum("count").alias("count")).collect()  # bits squared
    out = np.zeros(n * n)
    for r in rows:
        out[r["at"]] = r["v"]
    return (rows[0]["count"] if rows else 0), out.reshape(n, n)


def bit_groups(count: int, sums: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits of nearly the same size, each grown by the bit most correlated with it."""
    n = len(sums)
    mean = np.diag(sums) / max(count, 1)
    cov = sums / max(count, 1) - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    near = np.abs(cov / np.outer(sd, sd))
    free, groups = list(range(n)), []
    for k in range(m):
        size = n // m + (k < n % m)
        seed = max(free, key=lambda b: (near[b, free].sum(), -b))
        group = [seed]
        free.remove(seed)
        while len(group) < size:
            best = max(free, key=lambda b: (near[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _meetings(count: int, sums: np.ndarray, group: list[int]) -> tuple[float, np.ndarray]:
    """Estimated pairs that agree on a group, and the odds of each bit to differ."""
    p = np.diag(sums)[group] / max(count, 1)
    differ = np.clip(2 * p * (1 - p), 1e-6, 0.5)
    return count * count / 2 * float(np.prod(1 - differ)), differ / (1 - differ)


def _within(odds: np.ndarray, t: int) -> float:
    """Sum of the elementary symmetric polynomials up to degree t."""
    e = np.zeros(t + 1)
    e[0] = 1
    for o in odds:
        e[1:] += o * e[:-1]
    return float(e.sum())


def allocate(costs: list[list[float]], budget: int) -> tuple[list[int], float]:
    """costs[i][s]: of giving partition i the share s. Shares that add up to ``budget`` at the least
    cost, or as near to it as there are."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:  # what goes beyond the budget counts as the budget
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, shares) in best.items():
            for s, c in enumerate(row):
                to = min(used + s, budget)
                if c < np.inf and (to not in step or cost + c < step[to][0]):
                    step[to] = (cost + c, shares + [s])
        best = step
    cost, shares = best.get(budget) or best[max(best)]
    return shares, cost


@dataclass(frozen=True)
class Plan:
    groups: tuple[tuple[int, ...], ...]
    radius: tuple[int, ...]  #: probed flips per partition; -1 leaves it out


def plan(classes: DataFrame, how: SimHash) -> Plan:
    """The cheapest allocation over all allowed numbers of partitions.

    A probe costs one, like a candidate. Without flips the shares are t + 1 and add up to the
    distance and one. With flips they are logarithms of the probability to miss.
    """
    count, sums = _bit_sums(classes, how)
    found = []
    for m in how.partitions:
        groups = bit_groups(count, sums, m)
        costs, radii = [], []
        for group in groups:
            pairs, odds = _meetings(count, sums, group)
            row, radius = [0.0], [-1]
            if how.flips:
                budget = math.ceil(-math.log(1 - how.recall) * UNITS)
                met = _met(len(group), how)
                for v in range(1, how.flips + 1):
                    share = min(budget, int(-math.log(max(1 - met[v - 1], 1e-9)) * UNITS))
                    row += [np.inf] * (share + 1 - len(row))
                    radius += [v] * (share + 1 - len(radius))
                    row[share], radius[share] = count * 2**v + pairs * 4**v, v
            else:
                budget = how.distance + 1
                for t in range(how.distance + 1):
                    r = -(-t // 2)
                    row.append(count * sum(math.comb(len(group), k) for k in range(r + 1)) + pairs * _within(odds, 2 * r))
                    radius.append(r)
            costs.append(row)
            radii.append(radius)
        shares, cost = allocate(costs, budget)
        found.append((cost, m, Plan(tuple(map(tuple, groups)), tuple(r[s] for r, s in zip(radii, shares)))))
    return min(found, key=lambda f: f[:2])[2]


def _met(width: int, how: SimHash) -> list[float]:
    """How probably a pair at the wanted similarity meets in a partition of ``width`` bits when
    each side flips its 1, 2, ... least certain ones; by simulation, with bit sums as normal
    variables whose correlation is the cosine that belongs to the similarity."""
    rho = 2 * how.similarity / (1 + how.similarity)
    noise = np.random.default_rng(SEED).standard_normal((2, 4000, width))
    a, b = noise[0], rho * noise[0] + math.sqrt(1 - rho * rho) * noise[1]
    differ = (a > 0) != (b > 0)
    rank_a, rank_b = (np.argsort(np.argsort(np.abs(x), axis=1), axis=1) for x in (a, b))
    return [float((~(differ & (rank_a >= v) & (rank_b >= v))).all(1).mean()) for v in range(1, how.flips + 1)]


# -- probing ----------------------------------------------------------------------------------


def _masks(group: tuple[int, ...], radius: int, margins: np.ndarray | None, rows: int) -> np.ndarray:
    """What is flipped in a partition's key: per row, or the same for all rows."""
    places = np.uint64(1) << np.arange(len(group), dtype=np.uint64)
    if margins is None:
        flat = [sum(int(places[i]) for i in c) for r in range(radius + 1) for c in combinations(range(len(group)), r)]
        return np.broadcast_to(np.array(flat, np.uint64), (rows, len(flat)))
    weak = np.argsort(margins[:, list(group)], axis=1, kind="stable")[:, :radius]
    choose = np.array(list(product((0, 1), repeat=radius)), np.uint64)
    return (places[weak][:, None, :] * choose[None]).sum(2, dtype=np.uint64)


def _probe(classes: DataFrame, how: SimHash, chosen: Plan) -> DataFrame:
    """(key, a0.., b0..): the buckets in which each class is looked for; the partition is in the
    key's topmost bits. Nothing is left out here, so the buckets do not depend on batches (b null)."""
    nbits, width = how.bits, how.width

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 10_000):
                batch = whole.slice(at, 10_000)
                prints = batch.column("w").flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(-1, width)
                rows = len(prints)
                bits = np.unpackbits(np.ascontiguousarray(prints[:, : how.longs]).view(np.uint8), axis=1, bitorder="little")
                margins = None
                if how.flips:
                    margins = np.frombuffer(b"".join(batch.column("margin").to_pylist()), np.uint8).reshape(rows, nbits)
                for part, (group, radius) in enumerate(zip(chosen.groups, chosen.radius)):
                    if radius < 0:
                        continue
                    places = np.uint64(1) << np.arange(len(group), dtype=np.uint64)
                    keys = (bits[:, list(group)] * places).sum(1, dtype=np.uint64)
                    masks = _masks(group, radius, margins, rows)
                    probed = (keys[:, None] ^ masks).ravel()
                    if len(chosen.groups) > 1:  # a single partition uses all 64 bits
                        probed |= np.uint64(part) << np.uint64(60)
                    members = prints[np.repeat(np.arange(rows), masks.shape[1])]
                    yield _bucket_rows(probed, members, None)

    return classes.select("w", "margin").mapInArrow(probes, _kinds(width))


def _kinds(longs: int) -> str:
    return ", ".join(["key bigint", *[f"a{k} bigint" for k in range(longs)], *[f"b{k} bigint" for k in range(longs)]])


def _bucket_rows(keys: np.ndarray | None, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    longs = a.shape[1]
    none = pa.nulls(len(a), pa.int64())
    columns = [none if keys is None else pa.array(keys.view(np.int64))]
    columns += [pa.array(a[:, k]) for k in range(longs)] + [none if b is None else pa.array(b[:, k]) for k in range(longs)]
    names = ["key", *[f"a{k}" for k in range(longs)], *[f"b{k}" for k in range(longs)]]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(1)


def _close(x: np.ndarray, y: np.ndarray, distance: int, longs: int) -> np.ndarray:
    """Whether fingerprints are near each other, and the signs, if these follow the fingerprints."""
    far = np.bitwise_count((x ^ y).view(np.uint64))
    near = far[:, :longs].sum(1) <= distance
    if x.shape[1] > longs:
        near &= np.bitwise_count((x[:, longs] ^ y[:, longs]).view(np.uint64) >> np.uint64(32)) <= UNLIKE
    return near


def _reduced(keys: np.ndarray, prints: np.ndarray, distance: int, longs: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted bucket members to the places that stay, and links (a, b) of those that leave.

    In a run of more than PAIRWISE members the first is the leader, members near it are linked to it and
    leave, and the first of the others is the next leader. The links are not all there are: pairs that
    the verified ones leave in different components are compared by ``_crossed``.
    """
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, int)
    stay, a, b = np.ones(len(keys), bool), [], []
    for k in np.flatnonzero(np.diff(edges) > PAIRWISE):
        left = np.arange(edges[k], edges[k + 1])
        while len(left):
            near = _close(prints[left], prints[left[:1]], distance, longs or prints.shape[1])
            near[0] = False
            gone = left[near]
            stay[gone] = False
            a.append(gone)
            b.append(np.full(len(gone), left[0]))
            near[0] = True
            left = left[~near]
    empty = np.zeros(0, int)
    return np.flatnonzero(stay), np.concatenate([empty, *a]), np.concatenate([empty, *b])


def _met_in_buckets(buckets: DataFrame, how: SimHash) -> DataFrame:
    """Links (a0.., b0.., no key) between members of a bucket, and the members (key, a0..) of the
    buckets whose links are not all here, in one pass over the sorted buckets.

    Buckets are compared pairwise. One of over PAIRWISE members with more than PAIRWISE links a member, or of
    over HELD members, gives the links to its leaders only, and its members for ``_crossed``. It is
    held as leaders if it goes over many batches, so memory does not follow its size.
    """
    width, names = how.width, [f"a{k}" for k in range(how.width)]

    def close(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return _close(x, y, how.distance, how.longs)

    def linked(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lag in range(1, len(keys)):
            at = np.flatnonzero(keys[lag:] == keys[:-lag])
            if not len(at):
                break
            near = at[close(prints[at], prints[at + lag])]
            if len(near):
                yield _bucket_rows(None, prints[near], prints[near + lag])

    def all_pairs(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The links of one bucket, or None if there are too many."""
        a, b, count = [], [], 0
        for i in range(len(prints) - 1):
            near = np.flatnonzero(close(prints[i + 1 :], prints[i : i + 1])) + i + 1
            count += len(near)
            if count > PAIRWISE * len(prints):
                return None
            a.append(np.full(len(near), i))
            b.append(near)
        return np.concatenate(a), np.concatenate(b)

    def settled(keys: np.ndarray, prints: np.ndarray, known: int, whole: bool) -> Iterator[pa.RecordBatch | np.ndarray]:
        """What runs of keys give; then, unless the last is ``whole``, the places of it that are held. The
        first ``known`` rows are leaders of a bucket whose members have been given."""
        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, int)
        small, dense = np.ones(len(keys), bool), np.zeros(len(keys), bool)
        open_at = len(keys) if whole else edges[-2]
        sizes = np.diff(edges)
        for k in np.flatnonzero((sizes > PAIRWISE) | (edges[:-1] >= open_at) | ((edges[:-1] == 0) & (known > 0))):
            start, end = edges[k], edges[k + 1]
            if start >= open_at and end - start < HELD and not (known and start == 0):
                small[start:end] = False  # is held as it is
                continue
            small[start:end] = False
            pairs = None if end - start >= HELD or (known and start == 0) else all_pairs(prints[start:end])
            if pairs is None:
                dense[start:end] = True
            elif len(pairs[0]):
                yield _bucket_rows(None, prints[start:end][pairs[0]], prints[start:end][pairs[1]])
        yield from linked(keys[small], prints[small])
        fresh = np.flatnonzero(dense)
        fresh = fresh[fresh >= known]
        yield _bucket_rows(keys[fresh], prints[fresh], None)
        led = np.flatnonzero(dense)
        stay, a, b = _reduced(keys[led], prints[led], how.distance, how.longs)
        yield _bucket_rows(None, prints[led[a]], prints[led[b]])
        if not whole:
            held = np.arange(open_at, len(keys))
            yield led[stay][led[stay] >= open_at][: HELD // 2] if dense[open_at] else held

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints, known = np.zeros(0, np.int64), np.zeros((0, width), np.int64), 0
        for batch in batches:
            keys = np.r_[keys, batch.column("key").to_numpy()]
            prints = np.concatenate([prints, np.stack([batch.column(c).to_numpy() for c in names], 1)])
            if len(keys) < HELD:
                continue
            first = keys[0]
            *given, held = settled(keys, prints, known, False)
            yield from given
            same = known and keys[held[0]] == first
            known = len(held) if same or len(keys) - held[0] >= HELD else 0
            keys, prints = keys[held], prints[held]
        yield from settled(keys, prints, known, True)

    sorted_buckets = buckets.repartition("key").sortWithinPartitions("key", *names)
    return sorted_buckets.mapInArrow(meet, _kinds(width))


def _crossed(members: DataFrame, roots: DataFrame, classes: DataFrame, how: SimHash) -> DataFrame:
    """(a, b, apart): names of the members of a dense bucket that are near each other and have no common root yet.

    With these, every pair of a dense bucket is either compared or in one component
    already. Members are dealt into blocks of about BLOCK and each pair of blocks is a task's cell, so that
    memory and tasks do not follow the size of a bucket.
    """
    longs = how.longs
    members = members.select("key", _hex([F.col(f"a{k}") for k in range(how.width)]).alias("node")).distinct()
    members = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = materialize(members, "near-dense")
    count = members.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("one"), F.max("root").alias("other"))
    count = count.where("one <> other").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    cells = members.join(count, "key").join(classes.select("node", "w", "sketch"), "node")
    cells = cells.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = cells.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("key", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"), "block", "node", "root", "w", "sketch")

    def compared(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        cell = cell.combine_chunks()
        n, apart = cell.num_rows, cell["x"][0] != cell["y"][0]
        prints = np.array(cell["w"].to_pylist(), np.int64).reshape(n, -1)
        sketches = np.frombuffer(b"".join(cell["sketch"].to_pylist()), np.uint8).reshape(n, SKETCH)
        block, names = cell["block"].to_numpy(), cell["node"]
        root = np.unique(np.array(cell["root"].to_pylist()), return_inverse=True)[1]
        for i in range(n - 1):
            other = root[i + 1 :] != root[i]
            if apart:
                other &= block[i + 1 :] != block[i]
            at = np.flatnonzero(other) + i + 1
            at = at[_close(prints[at], prints[i : i + 1], how.distance, longs)]
            at = at[_alike(sketches[at], sketches[i : i + 1], how)]
            if len(at):
                a = pa.array([names[i].as_py()] * len(at), pa.string())
                far = pa.array(_apart(prints[at, :longs], prints[i : i + 1, :longs]), pa.int32())
                yield pa.RecordBatch.from_arrays([a, names.take(pa.array(at)).combine_chunks(), far], names=["a", "b", "apart"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            at = np.stack([held[c].to_numpy() for c in ("key", "x", "y")], 1)
            edges = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist()]
            for start, end in zip(edges[:-1], edges[1:]):
                yield from compared(held.slice(start, end - start))
            held = held.slice(edges[-1])
        if held is not None and held.num_rows:
            yield from compared(held)

    dealt = cells.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    pairs = dealt.mapInArrow(compare, "a string, b string, apart int")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "apart").distinct()


def _named(links: DataFrame, how: SimHash) -> DataFrame:
    """Links as (a, b) of fingerprint names; with flips, a < b, and ``apart`` says how many bits differ."""
    side = lambda c: _hex([F.col(f"{c}{k}") for k in range(how.width)]).alias(c)
    if not how.flips:
        return links.select(side("a"), side("b")).where("a <> b").distinct()
    apart = F.lit(0)
    for k in range(how.longs):
        apart = apart + F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}")))
    named = links.select(side("a"), side("b"), apart.alias("apart")).where("a <> b")
    return named.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "apart").distinct()


def _pairs(buckets: DataFrame, how: SimHash) -> DataFrame:
    """Pairs of a bucket within the distance; the condition is part of the join."""
    left = buckets.select("key", *[f"a{k}" for k in range(how.longs)])
    right = buckets.select("key", *[F.col(f"a{k}").alias(f"b{k}") for k in range(how.longs)])
    apart = F.lit(0)
    for k in range(how.longs):
        apart = apart + F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}")))
    return left.alias("x").join(right.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("a0") >= F.col("b0")) & (apart <= how.distance))


def _dense_links(nodes: DataFrame) -> DataFrame:
    """Links that join all fingerprints within distance 2 of each other, one hub per centre.

    Two fingerprints are within distance 2 exactly when some centre is within 1 of both: 65 rows
    per fingerprint, at most 65 fingerprints per centre, however dense they lie.
    """
    flips = F.array(F.lit(0), *[F.lit((1 << b) - (1 << 64) * (b == 63)) for b in range(64)]).cast("array<bigint>")
    spread = nodes.repartition("a0").select("a0", F.explode(F.transform(flips, lambda f: f.bitwiseXOR(F.col("a0")))).alias("centre"))
    return spread.select("a0", F.min("a0").over(Window.partitionBy("centre")).alias("b0"))


def _alike(a: np.ndarray, b: np.ndarray, how: SimHash) -> np.ndarray:
    """Whether sketches, row by row, say that the shingles may be as similar as wanted."""
    used = np.maximum(((a > 0) | (b > 0)).sum(1), 1)
    equal = ((a == b) & (a > 0)).sum(1) / used
    return (equal - 1 / 255) / (1 - 1 / 255) >= how.similarity - SLACK


def _similar(near: DataFrame, of: DataFrame, how: SimHash) -> DataFrame:
    """The links whose sketches (node, sketch), too, say that the shingles may be as similar as wanted."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, SKETCH) for c in ("as", "bs"))
            yield batch.select(["a", "b"]).filter(pa.array(_alike(a, b, how)))

    rows = near.join(of.withColumnsRenamed({"node": "a", "sketch": "as"}), "a").join(of.withColumnsRenamed({"node": "b", "sketch": "bs"}), "b")
    return rows.select("a", "b", "as", "bs").mapInArrow(verified, "a string, b string")


def _exact(pairs: DataFrame, texts: DataFrame, how: SimHash) -> DataFrame:
    """The pairs (a, b) whose texts' sets of shingles have the wanted Jaccard similarity.

    Sets are made of the texts in some pair only, once per class; ``pairs`` and ``texts`` are stored tables.
    """
    binary = pa.binary()

    def sets(part: list[str]) -> pa.Array:
        return pa.array([np.unique(_shingles(t, how)).tobytes() for t in part], binary)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("as"), batch.column("bs")):
                one, other = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(one, other, assume_unique=True))
                alike.append(common / max(len(one) + len(other) - common, 1) >= how.similarity)
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    of = texts.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    of = of.select("node", F.arrow_udf(by_slices(sets, binary), "binary")("text").alias("set"))
    of = materialize(of, "near-sets")
    rows = pairs.join(of.withColumnsRenamed({"node": "a", "set": "as"}), "a").join(of.withColumnsRenamed({"node": "b", "set": "bs"}), "b")
    return rows.select("a", "b", "as", "bs").mapInArrow(verified, "a string, b string")


def _verified(near: DataFrame, classes: DataFrame, texts: DataFrame, how: SimHash, sure: DataFrame | None = None) -> DataFrame:
    """Links that join what ``sure`` and all pairs (a, b, apart) of ``near`` with similar texts join; ``near`` has none
    that ``sure`` joins.

    First each class is held against the nearest of those near it. Of the other pairs only those matter then that
    go from one component of what was found to another, and so again, for ROUNDS; what is left is compared as it is. So
    the classes of a large group of near copies, most pairs of which are similar, are not compared pair by pair.
    """
    nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    sketches = materialize(classes.select("node", "sketch").join(nodes, "node", "left_semi"), "near-sketches")
    found = sure
    for k in range(ROUNDS + 1):
        wanted = near.select("a", "b")
        if k < ROUNDS:
            both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
            nearest = both.groupBy("a").agg(F.min(F.struct("apart", "b")).getField("b").alias("b"))
            wanted = nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            wanted = materialize(wanted, "near-nearest")
        alike = _exact(materialize(_similar(wanted, sketches, how), "near-alike"), texts, how)
        alike = materialize(alike, "near-links")
        found = alike if found is None else found.unionByName(alike)
        if k == ROUNDS:
            break
        roots = materialize(components(found), "near-joined")
        found = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        rest = near.join(wanted, ["a", "b"], "left_anti")
        for side in ("a", "b"):
            of = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
            rest = rest.join(of, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
        near = materialize(rest.where("root_a <> root_b").select("a", "b", "apart"), "near-apart")
        if near.isEmpty():
            break
    return found


def links(classes: DataFrame, how: SimHash, texts: DataFrame | None = None) -> DataFrame:
    """(a, b): names of classes that are linked; classes have w and margin. With flips, ``texts``
    has node and text of their members."""
    buckets = _probe(classes, how, plan(classes, how))
    if how.flips:
        met = materialize(_met_in_buckets(buckets, how), "near-met")
        near = materialize(_named(met.where("key is null"), how), "near-named")
        sure = _verified(near, classes, texts, how)
        members = met.where("key is not null")
        if members.isEmpty():
            return sure
        crossed = materialize(_crossed(members, components(sure), classes, how), "near-crossed")
        return sure if crossed.isEmpty() else _verified(crossed, classes, texts, how, sure)
    buckets = materialize(buckets, "near-buckets")
    if how.distance != 2 or how.longs != 1:
        return _named(_pairs(buckets, how), how)
    large = buckets.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > PAIRWISE)
    large = materialize(large.drop("members"), "near-large")
    pairs = _pairs(buckets.join(large, "key", "left_anti"), how)
    dense = buckets.join(large, "key", "left_semi").select("a0").distinct()
    return _named(pairs.select("a0", "b0").unionByName(_dense_links(dense)), how)


def grouped(docs: DataFrame, how: SimHash = THREE_WORDS, text: str = "text", doc_id: str = "doc_id", keep_rows: bool = True) -> DataFrame:
    """Every row of ``docs`` (as ``row``, or only ``id``) with ``fingerprint``, ``component_id`` and ``component``.

    Rows are in one component when links of at most ``how.distance`` differing bits lead from
    one to the other. ``component_id`` is the smallest id of the component (null if none of its rows
    has an id); ``component`` names it always. Null, empty and blank texts have fingerprint zero
    and are linked like any other. Repeated rows share everything. An empty table gives no rows.
    """
    prints, of_class = _classed(docs, how, text, doc_id, keep_rows)
    rows = prints.drop("text", "w", "margin", "sketch", "place").join(of_class, "node")
    rows = rows.withColumnsRenamed({"node": "fingerprint", "root": "component"})
    return rows.withColumn("fingerprint", F.substring("fingerprint", 1, 16 * how.longs)) if how.flips else rows


def _classed(docs: DataFrame, how: SimHash, text: str, doc_id: str, keep_rows: bool) -> tuple[DataFrame, DataFrame]:
    """The stored rows with the name of their class (``node``), with ``keep_rows`` numbered (``place``); the component
    of each class (node, root, component_id)."""
    base = packed(docs, id=f"{doc_id}:bigint", text=text)
    base = base.withColumn("place", F.monotonically_increasing_id()) if keep_rows else base.drop("row")
    prints = base.withColumn("print", fingerprint(F.col("text"), how)).select("*", "print.*").drop("print")
    in_row = keep_rows and text in docs.columns
    prints = prints if how.flips and not in_row else prints.drop("text")  # rows have it already
    prints = materialize(prints.withColumn("node", _hex([F.get("w", k) for k in range(how.width)])), "near-prints")
    texts = prints.select("node", F.col("row").getField(text).alias("text") if in_row else "text") if how.flips else None
    classes = prints.groupBy("node").agg(
        F.first("w").alias("w"), F.max("margin").alias("margin"), F.max("sketch").alias("sketch"), F.min("id").alias("least")
    )
    classes = materialize(classes, "near-classes")
    found = components(links(classes, how, texts))
    found = classes.select("node", "least").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = materialize(found, "near-roots")
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, materialize(found.drop("least").join(least, "root"), "near-components")


def distinct_documents(docs: DataFrame, how: SimHash = FIVE_WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each component, the one with its smallest id (any of them if rows repeat it, or
    have none), with the columns of ``docs``. Which ones is settled on their numbers, so that the rows
    themselves are moved once at most."""
    prints, of_class = _classed(docs, how, text, doc_id, True)
    least = prints.select("node", "id", "place").join(of_class, "node").where(F.col("id").eqNullSafe(F.col("component_id")))
    kept = materialize(least.groupBy("root").agg(F.min("place").alias("place")).select("place"), "near-kept")
    return unpacked(prints.select("place", "row").join(kept, "place", "left_semi"))


def op2(docs: DataFrame) -> DataFrame:
    rows = grouped(docs, THREE_WORDS, keep_rows=False)
    return rows.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")
