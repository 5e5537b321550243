"""SimHash near-duplicates, with pairs discarded by a table of distances to pivots.

1. One pass over the texts gives a 64-bit fingerprint per document (Python on Arrow batches). Everything after
   works on distinct fingerprints.
2. Fingerprints that differ in at most three of their bits agree in at least three of six blocks, so each is
   dealt under 20 keys of three blocks (about 32 bits). Keys that one fingerprint alone has are dropped. This
   deals the pairs to tasks without losing any.
3. Inside a key, each fingerprint has its distances to many reference fingerprints (pivots). By the triangle
   inequality, a pair whose distances to any pivot differ by more than three cannot be a link and is discarded;
   what survives is verified bit by bit. Members close to a pivot taken from the key itself are linked to it,
   and pairs inside one such star need no look. Only a spanning forest leaves a key, never its pairs.
4. Components of the links give every document the smallest doc_id reachable.

A key with more members than ``TILE`` is cut into tiles, and each pair of tiles is a unit of its own, so that
one key is spread over many tasks and no link is lost.

Defined results: texts without words (null too) have fingerprint zero and are linked like any other; a null
doc_id gets a component like any other row but names none unless the whole component has no doc_id; repeated
rows share their component; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import raw_texts, slices, text_key, written
from tidemill.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
# Six blocks of a 64-bit fingerprint as (first bit, width).
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
PIVOTS = 48
TILE = 8192
STARS = 16


def fingerprint(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SimHash of runs of 64-bit hashes; ``ends`` closes each run, an empty run gives zero."""
    out = np.zeros(len(ends), dtype=np.uint64)
    starts = np.concatenate(([0], ends[:-1]))
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    lo = 0
    while lo < len(ends):  # as many runs as fit a block of bits, one at least
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 65536, "right")))
        sizes = ends[lo:hi] - starts[lo:hi]
        full = np.flatnonzero(sizes)
        if len(full) == 1:  # maybe a very long run: add up pieces of it
            i = lo + full[0]
            ones = np.zeros(64, dtype=np.int64)
            for a in range(starts[i], ends[i], 65536):
                ones += _bits(hashes[a:min(a + 65536, ends[i])]).sum(axis=0, dtype=np.int64)
            out[i] = ((ones * 2 > sizes[full[0]]) * weights).sum(dtype=np.uint64)
        elif len(full):
            bits = _bits(hashes[starts[lo]:ends[hi - 1]])
            ones = np.add.reduceat(bits, starts[lo:hi][full] - starts[lo], axis=0, dtype=np.int32)
            out[lo + full] = ((ones * 2 > sizes[full][:, None]) * weights).sum(axis=1, dtype=np.uint64)
        lo = hi
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    flat = np.unpackbits(np.ascontiguousarray(hashes).astype("<u8").view(np.uint8), bitorder="little")
    return flat.reshape(-1, 64)


def shingle_hashes(text: bytes) -> list[int]:
    """Hashes of the three-word shingles of a text, repeats included; fewer words count as one shingle."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six white-space characters
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return [digest(joined, SEED)]
    ends = list(itertools.accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *[e + 1 for e in ends]]
    return [digest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1:])]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ``text_key`` (32 bits of the text) and ``fp`` (the fingerprint as a signed long), one row per row."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ends, parts, n = [], [], 0
            for t in raw_texts(batch.column("text")):
                hashes = np.array(shingle_hashes(t), dtype=np.uint64)
                parts.append(hashes)
                n += len(hashes)
                ends.append(n)
            fps = fingerprint(np.concatenate(parts), np.array(ends, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_key", "fp"],
            )

    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def block_keys() -> list[Column]:
    """For every three of the six blocks: their number, and their bits."""
    out = []
    for k, chosen in enumerate(itertools.combinations(BLOCKS, 3)):
        bits = F.lit(0).cast("long")
        for first, width in chosen:
            part = F.shiftrightunsigned(F.col("fp"), first).bitwiseAND(F.lit((1 << width) - 1))
            bits = F.shiftleft(bits, width).bitwiseOR(part)
        out.append(F.shiftleft(F.lit(k).cast("long"), 40).bitwiseOR(bits))
    return out


def dealt(prints: DataFrame, tile: int) -> DataFrame:
    """unit columns (``key``, ``a``, ``b``), ``tile`` and ``fp`` for every key that two or more fingerprints share."""
    keyed = prints.select(F.explode(F.array(*block_keys())).alias("key"), "fp")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    members = keyed.join(shared, "key").withColumn("tiles", tiles).withColumn("tile", mine)
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    return members.select("key", "tile", "fp", others).select(
        "key", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "fp",
    )


def references(n: int = PIVOTS) -> np.ndarray:
    """The pivots: fixed fingerprints, spread by a hash."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), SEED) for i in range(n)], dtype=np.uint64)


def distances(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table: a row per fingerprint, a column per pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def close_pairs(fps: np.ndarray, table: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the pairs (left, right) are links: coordinates first, a few pivots at a time, bits last."""
    alive = np.arange(len(left))
    for c in range(0, table.shape[1], 8):
        gap = np.abs(table[left[alive], c:c + 8] - table[right[alive], c:c + 8]).max(axis=1)
        alive = alive[gap <= DISTANCE]
        if not len(alive):
            return alive
    return alive[np.bitwise_count(fps[left[alive]] ^ fps[right[alive]]) <= DISTANCE]


class Forest:
    """Union by smallest index; ``links`` are those that joined two trees."""

    def __init__(self, n: int):
        self.parent, self.links = list(range(n)), []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.parent))])


def unit_links(fps: np.ndarray, pivots: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, as pairs of places.

    First stars: a member is taken as a pivot, and what is within reach of it is linked to it. Then every
    member is held against the later ones of other trees, so a group around a few centres costs little.
    """
    n = len(fps)
    forest = Forest(n)
    free = np.ones(n, dtype=bool)
    for _ in range(STARS):
        centre = int(np.argmax(free))
        if not free[centre]:
            break
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[centre]) <= DISTANCE)
        for i in near.tolist():
            forest.join(centre, i)
        free[near] = False
    table = distances(fps, pivots)
    order = np.argsort(table[:, 0], kind="stable")  # along one coordinate, partners lie in a narrow band
    first = table[order, 0].astype(np.int16)
    stop = np.searchsorted(first, first + DISTANCE, "right")
    roots = forest.roots()
    for i in range(n):
        band = order[i + 1:stop[i]]
        band = band[roots[band] != roots[order[i]]]
        if not len(band):
            continue
        found = close_pairs(fps, table, np.full(len(band), order[i]), band)
        if len(found):
            for j in band[found].tolist():
                forest.join(int(order[i]), j)
            roots = forest.roots() if n <= 64 else _relabel(roots, forest, band[found], int(order[i]))
    return forest.links


def _relabel(roots: np.ndarray, forest: Forest, found: np.ndarray, i: int) -> np.ndarray:
    """Roots after the trees of ``found`` and ``i`` became one."""
    old = np.unique(np.append(roots[found], roots[i]))
    return np.where(np.isin(roots, old), forest.root(i), roots)


def links(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints ``fp``: enough of them to connect what is connected."""
    units = dealt(prints, tile).repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = references()
        held = np.empty((4, 0), dtype=np.int64)

        def solved(block: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero((block[:3, 1:] != block[:3, :-1]).any(axis=0)) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [block.shape[1]]))
            fps, size = block[3].view(np.uint64), ends - starts
            two = starts[size == 2]
            got = close_pairs(fps, distances(fps, pivots[:8]), two, two + 1) if len(two) else two
            left, right = [block[3, two[got]]], [block[3, two[got] + 1]]
            for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist()):
                if pairs := unit_links(fps[s:e], pivots):
                    at = np.array(pairs) + s
                    left.append(block[3, at[:, 0]])
                    right.append(block[3, at[:, 1]])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["u", "v"]
            )

        for batch in batches:
            new = np.stack([batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False)
                            for c in ("key", "a", "b", "fp")]) if batch.num_rows else held[:, :0]
            held = np.concatenate((held, new), axis=1)
            if not held.shape[1]:
                continue
            last = np.flatnonzero((held[:3] != held[:3, -1:]).any(axis=0))  # the last unit may go on
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield solved(held[:, :cut])
                held = held[:, cut:]
        if held.shape[1]:
            yield solved(held)

    return units.select("key", "a", "b", "fp").mapInArrow(run, "u long, v long").distinct()


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """doc_id, text_key, fp, ``root`` (the group as the fingerprint that names it) and ``component_id``."""
    marks = written(fingerprints(docs, doc_id, text), "fingerprints")
    prints = written(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    near = written(components(links(prints.select("fp"), tile)), "components")
    placed = prints.join(near.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    # Only groups of several fingerprints need another look for their smallest id.
    named = placed.join(near.select("root").distinct(), "root").groupBy("root").agg(F.min("least").alias("named"))
    ids = placed.join(named, "root", "left").select(
        "fp", "root", F.coalesce("named", "least").alias("component_id"))
    return marks.join(ids, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def labelled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per document."""
    return groups(docs, doc_id, text).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose id names their group: one of each group, with the columns they came with.

    Of rows that share id and text, or that have no id, one of a group stays as well.
    """
    found = written(groups(docs, doc_id, text), "groups")
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = written(kept.groupBy("root").agg(
        F.min(F.struct("doc_id", "text_key")).alias("one"), F.count(F.lit(1)).alias("n")
    ).select("one.doc_id", "one.text_key", "n", "root"), "chosen")
    rows = docs.select(
        F.struct(*docs.columns).alias("__row"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("__id"),
        F.col(doc_id).isNull().alias("__none"), text_key(F.col(text)).alias("__key"),
    )
    one = chosen.select(
        F.coalesce("doc_id", F.lit(-1)).alias("__id"), F.col("doc_id").isNull().alias("__none"),
        F.col("text_key").alias("__key"), F.col("n").alias("__n"), F.col("root").alias("__root"),
    )
    stay = rows.join(one, ["__id", "__none", "__key"])
    if chosen.where("n > 1").isEmpty():
        return stay.select("__row.*")
    single, several = stay.where("__n = 1"), stay.where("__n > 1")
    return single.select("__row").unionByName(several.dropDuplicates(["__root"]).select("__row")).select("__row.*")
