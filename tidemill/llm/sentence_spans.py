"""Substring de-duplication by sliding spans of sentences.

A run is some consecutive sentences with enough words. From every sentence the shortest run is hashed, and up to
every sentence the shortest run too: together they cover each longer run, up to both its ends, and are repeated
where it is (runs are equal sentence by sentence). A hash has 128 bits of a run's words
joined by blanks. A run's first place is the smallest (document, sentence) in the whole table; every other place
is a repeat, and the sentences it covers are removed. Each batch of texts keeps one place per run and marks the
others as repeats at once, so a passage that a third of the documents share sends one row per batch to the join.

Defined results: documents are ordered by doc_id (null first), then by a checksum of the text; rows equal in both
count as one document and get the same result; a null text stays null; white space between sentences goes with
the sentence before it; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.common import slices, text_key, written

MIN_WORDS = 20
MIN_SENTENCES = 2
LONE_WORDS = 40
# A sentence ends behind a full stop and the like, at a line end, and before a capital letter.
CUT = re.compile(r"(?<=[.!?\n])[^\S\n]*(?=[^\s])|\n\s*|(?<=[^\s.!?])[^\S\n]+(?=[A-ZÀ-ÖØ-Þ])")


def sentences(text: str) -> list[str]:
    """A text as consecutive sentences; joined they are the text again."""
    ends = [m.end() for m in CUT.finditer(text)]
    bounds = [0, *[e for e in ends if 0 < e < len(text)], len(text)]
    return [text[a:b] for a, b in zip(bounds, bounds[1:]) if a < b]


def runs(parts: list[str], min_words: int, min_sentences: int, lone_words: int) -> list[tuple[bytes, int, int]]:
    """(hash, first, last) of the shortest long enough runs from and up to every sentence, by their first."""
    words = [p.split() for p in parts]
    if sum(map(len, words)) < min(min_words, lone_words):
        return []
    kept = [k for k, w in enumerate(words) if w]
    counts = [len(words[k]) for k in kept]
    joined = [" ".join(words[k]) for k in kept]
    stops, stop, total = [], 0, 0  # end of the shortest run from each sentence
    for i in range(len(kept)):
        if stop <= i:
            stop, total = i, 0
        long = lambda: total >= min_words and stop - i >= min_sentences or stop > i and total >= lone_words
        while stop < len(kept) and not long():
            total += counts[stop]
            stop += 1
        if not long():
            break
        stops.append(stop)
        total -= counts[i]
    out = []
    for i, (stop, after) in enumerate(zip(stops, [*stops[1:], len(kept) + 1])):
        for end in range(stop, max(after, stop + 1)):  # longer ones are the shortest up to their last sentence
            digest = xxhash.xxh3_128_digest(" ".join(joined[i:end]).encode("utf-8", "surrogatepass"))
            out.append((digest, kept[i], kept[end - 1]))
    return out


RUN = "doc_id long, text_key long, first int, last int, a long, b long, repeat boolean"


def hashed_runs(docs: DataFrame, min_words: int, min_sentences: int, lone_words: int) -> DataFrame:
    """A row per run of ``docs`` (doc_id, text_key, text); ``repeat`` where its batch holds an earlier place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16 << 20):
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            keys = batch.column("text_key").to_numpy(zero_copy_only=False)
            digests, places = [], []
            document, seen = None, set()
            for row in np.lexsort((keys, ids, known)).tolist():
                text = batch.column("text")[row].as_py()
                if document != (known[row], ids[row], keys[row]):
                    document, seen = (known[row], ids[row], keys[row]), set()
                if text and text not in seen:  # rows of one document are one place
                    seen.add(text)
                    for digest, first, last in runs(sentences(text), min_words, min_sentences, lone_words):
                        digests.append(digest)
                        places.append((row, first, last))
            if not places:
                continue
            hashes = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            rows, first, last = np.array(places, dtype=np.int64).T
            order = np.lexsort((np.arange(len(rows)), hashes[:, 1], hashes[:, 0]))
            repeat = np.zeros(len(rows), dtype=bool)
            repeat[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]).all(axis=1)
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(taken), batch.column("text_key").take(taken),
                pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), pa.array(repeat),
            ], names=["doc_id", "text_key", "first", "last", "a", "b", "repeat"])

    return docs.mapInArrow(run, RUN)


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
            min_sentences: int = MIN_SENTENCES, lone_words: int = LONE_WORDS) -> DataFrame:
    """doc_id, text_key and ``spans`` (first and last sentence) of the repeated runs of each document."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    found = written(hashed_runs(rows, min_words, min_sentences, lone_words), "runs")
    place = Window.partitionBy("a", "b").orderBy("doc_id", "text_key", "first")
    # Rows of equal document and sentence are one place: rank, not row_number.
    later = found.where("not repeat").withColumn("place", F.rank().over(place)).where("place > 1")
    marked = later.select("doc_id", "text_key", "first", "last").unionByName(
        found.where("repeat").select("doc_id", "text_key", "first", "last"))
    return marked.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                    min_sentences: int = MIN_SENTENCES, lone_words: int = LONE_WORDS) -> DataFrame:
    """doc_id, ``n_removed`` (sentences) and ``text`` without them, one row per document."""
    spans = repeats(docs, doc_id, text, min_words, min_sentences, lone_words).select(
        F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none"),
        F.col("text_key").alias("__key"), "spans")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("__id"), F.col(doc_id).isNull().alias("__none"),
        text_key(F.col(text)).alias("__key"))
    joined = rows.join(spans, ["__id", "__none", "__key"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, removed = [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                gone: set[int] = set()
                if found:
                    for s in found:
                        gone.update(range(s["first"], s["last"] + 1))
                    text = "".join(p for k, p in enumerate(sentences(text)) if k not in gone)
                texts.append(text)
                removed.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_removed", "text"])

    return joined.mapInArrow(run, "doc_id long, n_removed long, text string")
