"""Spelling variants: every word with its near words (one edit away) and the far more frequent word it stands for.

Words are counted with DataFrame functions. Near words are found with FM-indexes of the delimited vocabulary in both
directions. A word matches one half exactly, from the delimiter at that end inwards, and the search is then extended
across the other half, allowing one error; intervals of suffix ranks say which words are left. As each half starts at
a delimiter, the right half is searched in the index of the words and the left half in that of the reversed words.
Only the shorter word of a pair searches (replaced and inserted code points); deletions are the same pairs, turned.

Spark deals the vocabulary to indexes: two words of least length L that differ in the right part share their first
L // 2 code points, otherwise their last L - L // 2, so a word goes to four groups (both ends, its own length and the
one below), and a task builds indexes over whole groups of about ``BLOCK`` bytes. A group of more than ``MOST``
words is cut into tiles: each word is indexed in one and asked in all of them, so no pair is lost.

Defined results: null texts have no words; a null id counts as an empty one in the damage; repeated rows count again;
empty tables give no rows; other columns are not read. Words have code points up to U+00FF by their pattern.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import written

LEAST_LENGTH = 6
LEAST_COUNT = 5
FACTOR = 5  # a form is at least so many times as frequent
DAMAGED = 199  # one run of so many, by its hash, loses a code point
MOST = 100_000  # words in one index group before it is cut into tiles
BLOCK = 2 << 20
WORDS_A_TASK = 40_000
WIDE = 48  # intervals up to this width are listed, wider ones are asked for every letter


def runs(text: Column, least: int = LEAST_LENGTH) -> Column:
    """Maximal runs of letters of at least ``least`` code points, A-Z in lower case."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{least},}}"), F.lit(0))


def damaged(run: Column, doc_id: Column) -> Column:
    """The run, or for one of ``DAMAGED`` hashes the run without one code point."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    cut = (h % F.length(run)).cast("int")
    return F.when(h % DAMAGED == 0, F.concat(run.substr(F.lit(1), cut), run.substr(cut + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough. Shorter runs cannot become such words."""
    found = docs.select(F.col(doc_id).alias("doc_id"), F.explode(runs(F.col(text))).alias("run"))
    words = found.select(damaged(F.col("run"), F.col("doc_id")).alias("word"))
    return (words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


def dealt(words: DataFrame, most: int = MOST) -> DataFrame:
    """One row for each index that a word (``word``, ``n``) belongs to.

    ``left``: the shared part is the start; ``asks``: the word is the shorter one and searches; ``held``: it is in the index.
    """
    size = F.length("word")

    def group(left: bool, length: Column) -> Column:
        half = F.floor(length / 2).cast("int")
        part = F.col("word").substr(F.lit(1), half) if left else F.substring("word", half - length, length - half)
        return F.struct(
            F.lit(left).alias("left"), (length == size).alias("asks"),
            F.xxhash64(F.lit(left), length, part).alias("key"))

    groups = F.array(*[group(left, size - short) for left in (True, False) for short in (0, 1)])
    rows = words.select("word", "n", F.explode(F.filter(groups, lambda g: g["asks"] | (size > LEAST_LENGTH))).alias("g"))
    rows = rows.select("word", "n", "g.*")
    hot = rows.groupBy("key").count().where(F.col("count") > most).select(
        "key", F.ceil(F.col("count") / most).cast("int").alias("tiles"))
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("word"), tiles).cast("int")
    spread = rows.join(hot, "key", "left").withColumn("own", own).withColumn(
        "tile", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), tiles - 1)).otherwise(F.array("own"))))
    return spread.select("left", "key", "tile", "word", "n", "asks", (F.col("own") == F.col("tile")).alias("held"))


class Index:
    """FM-index of distinct words given as Latin-1 bytes; a delimiter (0) ends each word and sorts before all letters."""

    def __init__(self, words: list[bytes]):
        self.n_words = len(words)
        text = np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8)
        n = len(text)
        self.word_at = np.cumsum(text == 0) - (text == 0)
        # Suffixes are ordered up to their delimiter, equal ones by word: prefix doubling ends with the longest word.
        rank = np.where(text == 0, self.word_at, self.n_words + text.astype(np.int64))
        step = 1
        while True:
            order = np.lexsort((np.concatenate((rank[step:], np.full(min(step, n), -1))), rank))
            a, b = rank[order], np.concatenate((rank[step:], np.full(min(step, n), -1)))[order]
            new = np.concatenate(([0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            rank = np.empty(n, dtype=np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                break
            step *= 2
        self.suffixes = order
        self.bwt = text[order - 1]
        self.n = n
        by_letter = np.argsort(self.bwt, kind="stable")
        self.starts = by_letter[:self.n_words]  # ranks of whole words, as the delimiter of the word before precedes them
        self.keys = self.bwt[by_letter].astype(np.int64) * (n + 1) + by_letter
        self.letters = np.unique(text[text > 0])

    def step(self, letter: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with ``letter`` put before them."""
        at = letter.astype(np.int64) * (self.n + 1)
        return np.searchsorted(self.keys, at + lo), np.searchsorted(self.keys, at + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the interval, letter) of all letters that precede something in an interval."""
        width = hi - lo
        few, many = np.flatnonzero(width <= WIDE), np.flatnonzero(width > WIDE)
        size = width[few]
        which = np.repeat(few, size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[which]
        pairs = np.unique(which * 256 + self.bwt[at])
        pairs = pairs[pairs % 256 > 0]
        if len(many):
            pairs = np.concatenate((pairs, (many[:, None] * 256 + self.letters[None, :]).ravel()))
        return pairs >> 8, (pairs & 255).astype(np.uint8)

    def words(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the interval, word) of intervals whose matches begin a word."""
        none = np.zeros(len(lo), dtype=np.uint8)
        lo, hi = self.step(none, lo, hi)
        size = hi - lo
        which = np.repeat(np.arange(len(lo)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[which]
        return which, self.word_at[self.suffixes[self.starts[at]]]


def one_error(index: Index, asked: list[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``asked``, word of the index, inserted or not) of all words that equal an asked one on its last
    ``exact`` letters, and elsewhere but for one letter replaced or one put in."""
    flat = np.frombuffer(b"".join(asked), dtype=np.uint8)
    sizes = np.array([len(w) for w in asked], dtype=np.int64)
    last = np.cumsum(sizes) - 1

    def letter(q: np.ndarray, t: np.ndarray) -> np.ndarray:  # 0 beyond the first letter
        return np.where(t < sizes[q], flat[np.maximum(last[q] - t, 0)], 0).astype(np.uint8)

    q = np.arange(len(asked))
    t = np.zeros(len(asked), dtype=np.int64)
    lo, hi = np.zeros(len(asked), dtype=np.int64), np.full(len(asked), index.n_words)
    while (going := t < exact[q]).any():
        lo[going], hi[going] = index.step(letter(q[going], t[going]), lo[going], hi[going])
        t += going
        q, t, lo, hi = (x[hi > lo] for x in (q, t, lo, hi))
    found = []
    rest = [np.empty(0, dtype=np.int64)] * 4 + [np.empty(0, dtype=bool)]  # searches that had their error
    while len(q) or len(rest[0]):
        if len(q):
            now = letter(q, t)
            which, c = index.branches(lo, hi)
            other = c != now[which]  # the same letter put in here is found one step on
            which, c = which[other], c[other]
            low, high = index.step(c, lo[which], hi[which])
            replaced = (t < sizes[q])[which]
            rest = [np.concatenate(x) for x in zip(rest, (
                np.concatenate((q[which], q[which][replaced])), np.concatenate((t[which], t[which][replaced] + 1)),
                np.concatenate((low, low[replaced])), np.concatenate((high, high[replaced])),
                np.concatenate((np.ones(len(which), dtype=bool), np.zeros(replaced.sum(), dtype=bool)))))]
            lo, hi = index.step(now, lo, hi)
            more = (hi > lo) & (t < sizes[q])
            q, t, lo, hi = q[more], t[more] + 1, lo[more], hi[more]
        rest = [x[rest[3] > rest[2]] for x in rest]
        done = rest[1] == sizes[rest[0]]
        if done.any():
            which, word = index.words(rest[2][done], rest[3][done])
            found.append((rest[0][done][which], word, rest[4][done][which]))
        rest = [x[~done] for x in rest]
        if len(rest[0]):
            rest[2], rest[3] = index.step(letter(rest[0], rest[1]), rest[2], rest[3])
            rest[1] = rest[1] + 1
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
    return tuple(np.concatenate(x) for x in zip(*found))


PAIRS = "word string, near string, near_n long"


def _search(rows: list[tuple], left: bool) -> pa.RecordBatch:
    """Near pairs among the rows (word, n, asks, held) of whole groups, both ways where a letter is put in."""
    turn = (lambda w: w.encode("latin-1")[::-1]) if left else (lambda w: w.encode("latin-1"))
    count = {w: n for w, n, _, _ in rows}
    held = sorted({w for w, _, _, h in rows if h})
    asked = sorted({w for w, _, a, _ in rows if a})
    words, near = [], []
    if held and asked:
        size = np.array([len(w) for w in asked])
        place, word, put_in = one_error(
            Index([turn(w) for w in held]), [turn(w) for w in asked], size // 2 if left else size - size // 2)
        for p, w, more in zip(place.tolist(), word.tolist(), put_in.tolist()):
            words.append(asked[p])
            near.append(held[w])
            if more:
                words.append(held[w])
                near.append(asked[p])
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array(near, pa.string()), pa.array([count[w] for w in near], pa.int64())],
        names=["word", "near", "near_n"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group: whole groups are gathered up to ``BLOCK`` bytes, then searched together."""
    rows, size, last = [], 0, None
    for batch in batches:
        for left, key, tile, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (left, key, tile) != last:
                if rows and (size > BLOCK or left != last[0]):
                    yield _search(rows, last[0])
                    rows, size = [], 0
                last = (left, key, tile)
            rows.append(row)
            size += len(row[0]) + 1
    if rows:
        yield _search(rows, last[0])


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """``word``, ``near``, ``near_n``: all pairs of words one edit apart, both ways; a pair can come twice."""
    tasks = max(-(-4 * words.count() // WORDS_A_TASK), 1)
    groups = dealt(words, most).repartition(tasks, "left", "key", "tile").sortWithinPartitions("left", "key", "tile")
    return groups.mapInArrow(_blocks, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of rows (word, form): the last form, by doubling. A form is ``FACTOR`` times as frequent as its
    word, so chains are short and cannot close; rounds end when no form has a form of its own."""
    links = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(links.join(on, "root", "left"), "forms")
        links = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where(F.col("next").isNotNull()).isEmpty():
            return links


def variants(docs: DataFrame, most: int = MOST) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``docs`` (doc_id, text)."""
    words = written(vocabulary(docs), "words")
    pairs = near_pairs(words, most).repartition("word").groupBy("word", "near").agg(F.first("near_n").alias("near_n"))
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near", "near_n")).alias("best"))
    strong = F.col("best.near_n") >= FACTOR * F.col("n")
    rows = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, F.col("best.near_n")).alias("form_n")), "variants")
    last = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
