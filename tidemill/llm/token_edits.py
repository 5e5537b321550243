"""Token counts that follow edits.

A document is cut into pre-tokens. Its segment tree has one leaf per pre-token with its characters and its
tokens, and sums above them. An edit finds the leaves it touches by character offset, steps back over the
boundary context that the cutting pattern can look at, cuts the new text again from there until a cut falls on
an old boundary behind the edit, counts only these pre-tokens, and updates the sums above the touched leaves.
Everything else is kept. All work on a document is in its row; nothing is shuffled unless edits come as a table.

``trees`` keeps the leaves of every document as a table. ``apply_edits`` joins a table of edits to it, takes the trees
up without counting anything again, and returns the touched rows only; ``write_trees`` and ``read_trees`` keep them as
versions of a folder, in which a repeated version takes the place of its first try.

Defined results: null is an empty text; edits apply one after the other to the text as it then is; positions
are code points and are clipped to the text; null positions mean the end, a null insert inserts nothing; a null
list has no edits; repeated rows are counted each. Edits of an id that no document has, and of a null id, change nothing;
documents of one id all get its edits.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.llm.common import slices

# The published cutting pattern of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A pre-token that ends so many characters before an edit cannot see it: a contraction is at most three
# characters from its start, and white space looks at one character behind its run.
CONTEXT = 3
KNOWN = 500_000
EDIT = "array<struct<start:bigint,stop:bigint,insert:string>>"


def read_ranks(path: str) -> bytes:
    """The rank file of a byte-level vocabulary, read on the driver."""
    with open(path, "rb") as file:
        return file.read()


class Counter:
    """Pre-tokens of a text, and the tokens of each; counts of pre-tokens are kept up to a bound."""

    def __init__(self, ranks: bytes):
        import regex
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def tokens(self, pre_tokens: list[str]) -> list[int]:
        counts = list(map(self.known.get, pre_tokens))
        if None in counts:
            if len(self.known) > KNOWN:
                self.known.clear()
            for i, n in enumerate(counts):
                if n is None:
                    p = pre_tokens[i]
                    n = self.known.get(p)
                    if n is None:
                        n = self.known[p] = len(self.encoding._encode_single_piece(p))
                    counts[i] = n
        return counts


class Tree:
    """Segment tree over pre-tokens: rows of ``sums`` are characters and tokens, node 1 is the root.

    Every leaf holds one pre-token or nothing. What an edit cuts again is written back as leaves of its own: into
    the places of the old ones if there is room, else the leaves of the smallest stretch around them that has
    room are spread anew; a full tree doubles. No leaf's count is computed again for that.
    """

    def __init__(self, text: str, counter: Counter, leaves: tuple[np.ndarray, np.ndarray] | None = None):
        """``leaves``: characters and tokens of each pre-token, where they are known."""
        self.text, self.counter = text, counter
        if leaves is None:
            pre = counter.pattern.findall(text)
            leaves = list(map(len, pre)), counter.tokens(pre)
        self.leaves = len(leaves[0])
        self.width = 1 << max(self.leaves - 1, 0).bit_length()
        self.sums = np.zeros((2, 2 * self.width), dtype=np.int64)
        self.sums[:, self.width:self.width + self.leaves] = leaves
        self._add_up(0, self.width)
        self.encoded = 0

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def stored(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of each pre-token."""
        rows = self.sums[:, self.width:]
        return tuple(rows[:, rows[0] > 0])

    def _add_up(self, start: int, stop: int) -> None:
        """Sums above the leaves from ``start`` up to ``stop``."""
        start, stop = start + self.width, stop + self.width
        while start > 1:
            start, stop = start // 2, (stop + 1) // 2
            self.sums[:, start:stop] = self.sums[:, 2 * start:2 * stop].reshape(2, -1, 2).sum(axis=2)

    def _leaf(self, offset: int) -> tuple[int, int]:
        """The leaf that holds a character of the text, and where the leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if offset - begin >= self.sums[0, node]:
                begin += int(self.sums[0, node])
                node += 1
        return node - self.width, begin

    def _replace(self, start: int, stop: int, chars: list[int], tokens: list[int]) -> None:
        """Put new leaves in the places from ``start`` up to ``stop``."""
        size, full, height = len(chars), self.sums[0, self.width:] > 0, self.width.bit_length()
        self.leaves += size - int(np.count_nonzero(full[start:stop]))
        for level in range(height):
            # Stretches of 2^level places; the longer they are, the emptier they have to be, half at most at the top.
            step = 1 << level
            low, high = start // step * step, min(-(-stop // step) * step, self.width)
            count = size + int(np.count_nonzero(full[low:start]) + np.count_nonzero(full[stop:high]))
            if count <= (high - low) * (1 - level / (2 * height)):
                room = True
                break
        else:
            low, high, count, room = 0, self.width, self.leaves, False
        old = self.sums[:, self.width + low:self.width + high]
        before, after = old[:, :start - low], old[:, stop - low:]
        rows = np.concatenate([
            before[:, before[0] > 0], np.array([chars, tokens], dtype=np.int64).reshape(2, -1), after[:, after[0] > 0]], axis=1)
        if not room:
            self.width = 1 << (2 * count - 1).bit_length()
            self.sums = np.zeros((2, 2 * self.width), dtype=np.int64)
            high = self.width
        places = self.sums[:, self.width + low:self.width + high]
        places[:] = 0
        places[:, np.arange(count) * (high - low) // max(count, 1)] = rows
        self._add_up(low, high)

    def edit(self, start: int | None, stop: int | None, insert: str | None) -> None:
        size = len(self.text)
        start = size if start is None else min(max(start, 0), size)
        stop = min(max(size if stop is None else stop, start), size)
        insert = insert or ""
        self.text = self.text[:start] + insert + self.text[stop:]
        shift = len(insert) - (stop - start)
        first, begin = self._leaf(max(start - CONTEXT, 0)) if size else (0, 0)
        # Leaves from ``first`` up to ``last`` are cut again; they end at ``old`` in the old text.
        last, old = first + 1, begin + int(self.sums[0, first + self.width])
        if old < stop:
            leaf, at = self._leaf(stop - 1)
            last, old = leaf + 1, at + int(self.sums[0, leaf + self.width])
        position, pre = begin, []
        for match in self.counter.pattern.finditer(self.text, begin):
            while old < size and old + shift < position:
                leaf, at = self._leaf(old)
                last, old = leaf + 1, at + int(self.sums[0, leaf + self.width])
            if pre and old + shift == position:
                break
            pre.append(match.group())
            position = match.end()
        else:
            if old < size:
                last = self._leaf(size - 1)[0] + 1
        self.encoded += len(pre)
        self._replace(first, last, list(map(len, pre)), self.counter.tokens(pre))


def edited(docs: DataFrame, ranks: bytes, edits: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, tokens before and after the edits, pre-tokens before, how many were encoded again, characters after."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), edits.cast(EDIT).alias("edits"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks)
        for batch in slices(batches, "text"):
            out = []
            for t, changes in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist()):
                tree = Tree(t or "", counter)
                before, pre = tree.tokens, tree.leaves
                for e in changes or ():
                    if e is not None:
                        tree.edit(e["start"], e["stop"], e["insert"])
                out.append((pre, before, tree.tokens, tree.encoded, len(tree.text)))
            columns = np.array(out, dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(columns[:, k]) for k in range(5)]], names=NAMES)

    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in NAMES[1:]))


NAMES = ["doc_id", "n_pretokens", "n_tokens", "n_tokens_after", "n_encoded_again", "n_chars_after"]


def with_edits(docs: DataFrame, edits: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the rows of ``edits`` (doc_id, seq, start, stop, insert) as an ordered array ``edits``.

    The edits of one document must be applied in order anyway, so they meet in its row.
    """
    lists = edits.groupBy(F.col("doc_id").alias("__id")).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "insert"))),
        lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"), e["insert"].alias("insert")),
    ).alias("edits"))
    return docs.drop("edits").join(lists, F.col(doc_id) == F.col("__id"), "left").drop("__id")


def _trees_of(batches: Iterator[pa.RecordBatch], ranks: bytes) -> Iterator[pa.RecordBatch]:
    """A row per tree after the edits of its row; known leaves are taken up."""
    counter = Counter(ranks)
    for batch in slices(batches, "text", 4 << 20):
        names = batch.schema.names
        known = "chars" in names
        edits = batch.column("edits").to_pylist() if "edits" in names else [()] * batch.num_rows
        texts, found, encoded = [], [], []
        for k, text in enumerate(batch.column("text").to_pylist()):
            leaves = tuple(batch.column(c)[k].values.to_numpy() for c in ("chars", "tokens")) if known else None
            tree = Tree(text or "", counter, leaves)
            for e in edits[k] or ():
                if e is not None:
                    tree.edit(e["start"], e["stop"], e["insert"])
            texts.append(tree.text)
            found.append(tree.stored())
            encoded.append(tree.encoded)
        ends = np.cumsum([0, *[len(chars) for chars, _ in found]], dtype=np.int32)
        lists = [
            pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([f[k] for f in found]).astype(np.int32)))
            for k in (0, 1)]
        totals = np.array([tokens.sum() for _, tokens in found], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string()), *lists, pa.array(totals), pa.array(encoded, pa.int64())],
            names=["doc_id", "text", "chars", "tokens", "n_tokens", "n_encoded_again"])


def _tree_type(kind: str) -> str:
    return f"doc_id {kind}, text string, chars array<int>, tokens array<int>, n_tokens long, n_encoded_again long"


def trees(docs: DataFrame, ranks: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, the leaves of its tree (characters and tokens of each pre-token) and their sum."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda batches: _trees_of(batches, ranks), _tree_type(dict(rows.dtypes)["doc_id"]))


def apply_edits(kept: DataFrame, edits: DataFrame, ranks: bytes) -> DataFrame:
    """The rows of ``kept`` that ``edits`` (doc_id, seq, start, stop, insert) touch, as they are after them."""
    touched = with_edits(kept.select("doc_id", "text", "chars", "tokens"), edits).where("edits is not null")
    touched = touched.withColumn("edits", F.col("edits").cast(EDIT))
    return touched.mapInArrow(lambda batches: _trees_of(batches, ranks), _tree_type(dict(kept.dtypes)["doc_id"]))


def write_trees(rows: DataFrame, folder: str, version: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/version={version}")


def read_trees(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """Each document's rows of its last version (of those ``before`` one)."""
    rows = spark.read.parquet(folder)
    if before is not None:
        rows = rows.where(F.col("version") < before)
    last = rows.groupBy(F.col("doc_id").alias("__id")).agg(F.max("version").alias("__last"))
    is_last = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__last"))
    return rows.join(last, is_last).drop("__id", "__last", "version")


def update_trees(spark: SparkSession, folder: str, edits: DataFrame, ranks: bytes, version: int) -> None:
    """Apply a table of edits to the kept trees; only touched documents are written."""
    write_trees(apply_edits(read_trees(spark, folder, version), edits, ranks), folder, version)
