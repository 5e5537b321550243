"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Seeds are pairs of words that follow each other in a test item, directly or with one word between, and that come so in a
   passage. If a passage reaches the similarity s to an item of n words, m words match and there are at most 2m - 2sn
   edits, so at least sn - 1 of the m - 1 neighbouring matches have one edit at most between them: each is a seed with a
   start of its own in the item. Of an item's starts the most frequent ones, fewer than half of that bound, are left
   out (by how often their words come in all documents), and a passage has to hold as many of the others as the bound then
   still asks for. So seeds are the rare ones, and no passage of that similarity is lost, however it is edited.
2. A passage that holds too few of an item's words (each as often as the item has it) to reach the similarity even
   if all of them matched in order is passed over, which loses nothing. That is what most passages that share
   only everyday words with an item come to.
3. Each passage and item left is aligned word by word (local alignment, linear gaps). The score over the best score
   the item can have is the similarity, which edits and paraphrase lower gradually.

All of it happens where the document lies: nothing is shuffled by seed, so a seed in a third of the documents is
work in proportion to its documents.

The items are a stated query set: they are taken in blocks of a proven size, each block is sent to the tasks and
held against all documents, so any number of items works. Words are lower-cased runs between ASCII punctuation
and white space.

Defined results: null texts and items have no words; items without an id are left out, those of fewer than ``LEAST_WORDS``
words seed nothing; a similarity of 1/3 or less is refused, as one word can then be enough; rows of equal
doc_id are one document; of several copies in a document the best counts, at ties the earliest; empty tables give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.common import slices, text_key, written

LEAST_WORDS = 3
REACH = 2  # words of a seed are so far apart at most
SIMILARITY = 0.5
MATCH, OTHER, GAP = 2, -1, -1
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32 << 20
PAIRS = 256
# Lower-cases A-Z and makes blanks of ASCII punctuation and control characters; other bytes stay.
TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(TABLE).split()


class Seeds:
    """Word numbers, sorted seed codes and word counts of a block of items; ``counts``: how often each word comes."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY):
        if similarity * LEAST_WORDS <= 1:
            raise ValueError("the similarity must be above 1/3")
        self.similarity = similarity
        self.items = [(i, words(t)) for i, t in items]
        self.number = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in self.items for w in ws))}
        self.base = len(self.number) + 1
        self.numbered = [self.numbers(ws) for _, ws in self.items]
        self.lengths = np.array([len(n) for n in self.numbered], dtype=np.int64)
        self.longest = int(self.lengths.max(initial=0))
        counted = [np.unique(n, return_counts=True) for n in self.numbered]
        self.word = np.concatenate([np.empty(0, dtype=np.int64), *[w for w, _ in counted]])
        self.times = np.concatenate([np.empty(0, dtype=np.int64), *[n for _, n in counted]])
        self.begin = np.cumsum([0, *[len(w) for w, _ in counted]])
        self.choose(np.ones(len(self.number)))

    def choose(self, counts: np.ndarray) -> None:
        """Leave out the most frequent starts of each item, and set what a passage has to hold of the others."""
        self.need = np.zeros(len(self.items), dtype=np.int64)
        codes, holders = [], []
        for k, n in enumerate(self.numbered):
            if len(n) < LEAST_WORDS:
                continue
            bound = max(int(np.ceil(self.similarity * len(n) - 1 - 1e-9)), 1)
            out = (bound - 1) // 2
            self.need[k] = bound - out
            pairs = [(n[:-d] * self.base + n[d:], np.arange(len(n) - d), counts[n[:-d]] * counts[n[d:]]) for d in range(1, REACH + 1)]
            often = np.zeros(len(n))
            for _, start, expected in pairs:
                often[start] += expected
            rare = np.ones(len(n), dtype=bool)
            rare[np.argsort(-often[:-1], kind="stable")[:out]] = False
            for code, start, _ in pairs:
                codes.append(code[rare[start]])
                holders.append((k * (self.longest + 1) + start)[rare[start]])
        flat = np.concatenate([np.empty(0, dtype=np.int64), *codes])
        order = np.argsort(flat, kind="stable")
        self.sorted, first = np.unique(flat[order], return_index=True)
        # Items and starts with each seed.
        self.holders = np.concatenate([np.empty(0, dtype=np.int64), *holders])[order]
        self.held = np.append(first, len(flat))

    def numbers(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.get, ws, repeat(-1)), dtype=np.int64, count=len(ws))

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and seeds (by place in ``sorted``), places in order."""
        at, seeds = [], []
        for d in range(1, REACH + 1):
            if len(numbers) <= d or not len(self.sorted):
                continue
            a, b = numbers[:-d], numbers[d:]
            here = np.flatnonzero((a >= 0) & (b >= 0))
            codes = a[here] * self.base + b[here]
            seed = np.minimum(np.searchsorted(self.sorted, codes), len(self.sorted) - 1)
            found = self.sorted[seed] == codes
            at.append(here[found])
            seeds.append(seed[found])
        if not at:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        at, seeds = np.concatenate(at), np.concatenate(seeds)
        order = np.argsort(at, kind="stable")
        return at[order], seeds[order]

    def near(self, passage: np.ndarray, seed: np.ndarray, similarity: float) -> np.ndarray:
        """Items with enough of the seeds whose words in the passage are enough for the similarity."""
        seed = np.unique(seed)
        starts = np.unique(self.holders[_ranges(self.held[seed], self.held[seed + 1])])
        items, n = np.unique(starts // (self.longest + 1), return_counts=True)
        items = items[n >= self.need[items]]
        if not len(items):
            return items
        among, n = np.unique(passage[passage >= 0], return_counts=True)
        first, last = self.begin[items], self.begin[items + 1]
        every = _ranges(first, last)
        at = np.minimum(np.searchsorted(among, self.word[every]), len(among) - 1)
        both = np.where(among[at] == self.word[every], np.minimum(n[at], self.times[every]), 0)
        most = np.add.reduceat(both, np.cumsum(last - first) - (last - first))
        return items[most >= similarity * self.lengths[items] - 1e-6]


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges, one behind the other."""
    size = last - first
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


def blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded count and size, as they pass through the driver one by one."""
    block: list[tuple[int, str]] = []
    size = 0
    rows = items.select(F.col(item_id).cast("long"), F.col(text)).where(F.col(item_id).isNotNull())
    for i, t in rows.toLocalIterator():
        t = t or ""
        if block and (len(block) >= BLOCK_ITEMS or size + len(t) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((i, t))
        size += len(t)
    if block:
        yield block


def align(passages: list[list[bytes]], items: list[list[bytes]]) -> np.ndarray:
    """Best local alignment score of each pair, all pairs of a block at once: a row of the table per item word."""
    number: dict[bytes, int] = {}
    code = lambda ws: [number.setdefault(w, len(number) + 1) for w in ws]
    width, height = max(map(len, passages)), max(map(len, items))
    text = np.zeros((len(passages), width), dtype=np.int32)
    item = np.full((len(items), height), -1, dtype=np.int32)
    for k, (p, q) in enumerate(zip(passages, items)):
        text[k, :len(p)] = code(p)
        item[k, :len(q)] = code(q)
    slope = -GAP * np.arange(width, dtype=np.int32)
    row = np.zeros((len(passages), width), dtype=np.int32)
    best = np.zeros(len(passages), dtype=np.int32)
    for i in range(height):
        step = np.where(text == item[:, i:i + 1], MATCH, OTHER)
        new = step.copy()
        new[:, 1:] += row[:, :-1]
        np.maximum(new, row + GAP, out=new)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new + slope, axis=1) - slope  # gaps along the passage
        row = np.where(item[:, i:i + 1] >= 0, new, 0)
        best = np.maximum(best, row.max(axis=1))
    return best


def _aligned(rows: DataFrame, shared, similarity: float) -> DataFrame:
    """doc_id, text_key, item_id, ``start`` (word place of the passage) and ``similarity`` where it is reached."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        step = 2 * max(seeds.longest, 8)
        pairs: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            for k in range(0, len(pairs), PAIRS):
                doc, key, start, passage, item = zip(*pairs[k:k + PAIRS])
                right = [seeds.items[i][1] for i in item]
                score = align(list(passage), right) / (MATCH * np.array([len(w) for w in right]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc, pa.int64()), pa.array(key, pa.int64()),
                    pa.array([seeds.items[i][0] for i in item], pa.int64()), pa.array(start, pa.int64()), pa.array(score),
                ], names=["doc_id", "text_key", "item_id", "start", "similarity"])
            pairs.clear()

        for batch in slices(batches, "text"):
            for doc, key, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
                ws = words(t)
                numbers = seeds.numbers(ws)
                at, seed = seeds.hits(numbers)
                tiles = at // step
                for tile in np.union1d(tiles, np.maximum(tiles - 1, 0)).tolist():
                    within = slice(*np.searchsorted(tiles, [tile, tile + 2]))
                    place = slice(tile * step, (tile + 2) * step)
                    for item in seeds.near(numbers[place], seed[within], similarity).tolist():
                        pairs.append((doc, key, tile * step, ws[place], item))
                    if len(pairs) >= PAIRS:
                        yield from flush()
        yield from flush()

    found = rows.mapInArrow(run, "doc_id long, text_key long, item_id long, start long, similarity double")
    return found.where(F.col("similarity") >= similarity)


def word_counts(rows: DataFrame, shared) -> np.ndarray:
    """How often each word of a block of items comes in all documents: one number per word of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        sums = np.zeros(len(seeds.number), dtype=np.int64)
        for batch in slices(batches, "text"):
            for t in batch.column("text").to_pylist():
                numbers = seeds.numbers(words(t))
                np.add.at(sums, numbers[numbers >= 0], 1)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(sums[some])], names=["word", "n"])

    counts = np.ones(len(shared.value.number))
    for r in rows.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[r["word"]] += r["n"]
    return counts


def alignments(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, item_id, start and ``similarity`` of the passages that are similar enough."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    out = spark.createDataFrame([], "doc_id long, text_key long, item_id long, start long, similarity double")
    for block in blocks(items, item_id, item_text):
        seeds = Seeds(block, similarity)
        if len(seeds.sorted):
            seeds.choose(word_counts(rows, spark.sparkContext.broadcast(seeds)))
            out = out.unionByName(_aligned(rows, spark.sparkContext.broadcast(seeds), similarity))
    return out


def leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, ``similarity`` and ``passage_start`` (word place of the passage), one row per pair found."""
    best = alignments(docs, items, **options).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("start"))).alias("best"))
    return best.select("doc_id", "item_id", "best.similarity", (-F.col("best.start")).alias("passage_start"))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without a leak, with the columns they came with. Id and text together name a document."""
    keyed = docs.select(
        F.struct(*docs.columns).alias("__row"), F.col(doc_id).cast("long").alias("__id"),
        text_key(F.col(text)).alias("__key"))
    found = written(alignments(
        docs, items, doc_id=doc_id, text=text, **options).select("doc_id", "text_key").distinct(), "leaks")
    same = F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__key") == F.col("text_key"))
    return keyed.join(found, same, "left_anti").select("__row.*")
