"""SentencePiece encoding and decoding by suffix-array matching.

A text is a blank and the text itself (blanks stand for the meta symbol), cut into units that no piece crosses:
a run of blanks with the word behind it, or a line feed. The distinct units of a batch that were not met before
are laid end to end and indexed by a suffix array; every piece of the vocabulary is searched in it by bisection,
which gives all its occurrences as one range; the edges (position, length, piece) are sorted by position and
relaxed: in every round each unit joins its best-ranked neighbouring pair that an edge covers, the leftmost among
equals, until none is left. That is the merge order of the model, so ids equal the library's. Characters without
a piece fall back to bytes. The index is bounded by the batch, not the corpus; known units are kept up to a bound.

Defined results: null and empty texts have no ids (a null text decodes to null); a meta symbol in a text is read
as a blank, so it decodes to one; repeated rows are encoded each; texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.common import slices

META = "▁"
MOST = 16  # the longest piece that the packed keys can hold
KNOWN_UNITS = 700_000
INDEX_CHARS = 400_000
LONG_UNIT = 64
NONE = np.iinfo(np.int32).max
UNITS = re.compile(r" +[^ \n]*|[^ \n]+|\n")


def read_model(path: str) -> bytes:
    """The model file; read on the driver, and sent to the tasks as it is (half a megabyte)."""
    with open(path, "rb") as file:
        return file.read()


class Pieces:
    """The vocabulary as arrays: what a search and a merge need."""

    def __init__(self, model: bytes):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) for i in range(n)]
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        self.texts = [b"" if s else p.replace(META, " ").encode() for p, s in zip(names, special)]
        self.texts[lib.unk_id()] = " ⁇ ".encode()
        for b, i in enumerate(self.byte_ids):
            self.texts[i] = bytes([b])
        plain = [i for i in range(n) if not special[i]]
        words = {i: names[i].replace(META, " ") for i in plain}
        if max(map(len, words.values())) > MOST or any(" " in w.lstrip(" ") or "\n" in w for w in words.values()):
            raise ValueError("pieces must have at most 16 characters, blanks only in front and no line feed")
        self.code = {c: k + 1 for k, c in enumerate(sorted({c for w in words.values() for c in w}))}
        self.codes = np.zeros(0x110000, dtype=np.int16)
        self.codes[[ord(c) for c in self.code]] = list(self.code.values())
        self.single = np.full(len(self.code) + 1, -1, dtype=np.int32)
        rank = np.full(n, NONE, dtype=np.int32)
        rank[sorted(plain, key=lambda i: (-lib.get_score(i), i))] = np.arange(len(plain), dtype=np.int32)
        self.rank = rank
        for i, w in words.items():
            if len(w) == 1:
                self.single[self.code[w]] = i
        longer = [i for i in plain if len(words[i]) > 1]
        self.ids = np.array(longer, dtype=np.int32)
        self.lengths = np.array([len(words[i]) for i in longer], dtype=np.int32)
        cells = np.zeros((len(longer), MOST), dtype=np.int64)
        for k, i in enumerate(longer):
            cells[k, :len(words[i])] = [self.code[c] for c in words[i]]
        self.low = packed(cells)
        beyond = np.arange(MOST)[None, :] >= self.lengths[:, None]
        self.high = packed(np.where(beyond, (1 << 15) - 1, cells))
        sizes = np.array([len(t) for t in self.texts])
        self.flat = np.frombuffer(b"".join(self.texts), dtype=np.uint8)
        self.starts, self.sizes = np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes


def packed(cells: np.ndarray) -> np.ndarray:
    """Sixteen character codes a row as four numbers that sort alike."""
    return sum(cells[:, k::4] << (15 * (3 - k)) for k in range(4))


class Index:
    """Suffix array by the first twelve characters of every suffix, and sixteen of them for looking."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        wide = np.concatenate((codes.astype(np.int64), np.zeros(MOST, dtype=np.int64)))
        four = sum(wide[k:n + MOST - 3 + k] << (15 * (3 - k)) for k in range(4))
        self.words = [four[4 * k:4 * k + n] for k in range(4)]
        if n < 1 << 20:
            rank = np.unique(np.concatenate((four, np.zeros(8, dtype=np.int64))), return_inverse=True)[1]
            self.order = np.argsort((rank[:n] << 42) | (rank[4:n + 4] << 21) | rank[8:n + 8])
        else:  # a unit of over a million characters
            self.order = np.lexsort(self.words[2::-1])
        self.words = [w[self.order] for w in self.words]

    def bisect(self, keys: np.ndarray, after: bool) -> np.ndarray:
        """For every key, the first suffix not below it (``after``: the first above it)."""
        low = np.searchsorted(self.words[0], keys[:, 0], "left")
        high = np.searchsorted(self.words[0], keys[:, 0], "right")
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high) >> 1
            at = np.minimum(mid, len(self.order) - 1)
            less, same = np.zeros(len(keys), dtype=bool), np.ones(len(keys), dtype=bool)
            for k in range(3):
                word = self.words[k][at]
                less |= same & (word < keys[:, k])
                same &= word == keys[:, k]
            right = open_ & (less | same if after else less)
            low = np.where(right, mid + 1, low)
            high = np.where(open_ & ~right, mid, high)


def edges(pieces: Pieces, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, length and id of every occurrence of a piece of two or more characters, by position."""
    index = Index(codes)
    low, high = index.bisect(pieces.low, False), index.bisect(pieces.high, True)
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    at = low[which] + within
    long = np.flatnonzero(pieces.lengths[which] > 12)  # their last characters are beyond the order
    last = index.words[3][at[long]]
    wrong = long[(last < pieces.low[which[long], 3]) | (last > pieces.high[which[long], 3])]
    at, which = np.delete(at, wrong), np.delete(which, wrong)
    packed_edges = (index.order[at] * (MOST + 1) + pieces.lengths[which]) * (1 << 20) + pieces.ids[which]
    packed_edges.sort()
    place, ids = packed_edges >> 20, packed_edges & ((1 << 20) - 1)
    return place // (MOST + 1), place % (MOST + 1), ids


def relax(pieces: Pieces, grid: np.ndarray, starts: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the tokens of all units. ``starts``: places of their characters; ``units``: whose they are."""
    begin, end, unit = starts.copy(), starts + 1, units
    done = []
    while len(begin):
        rank = np.full(len(begin), NONE, dtype=np.int32)
        width = end[1:] - begin[:-1]
        pair = np.flatnonzero((unit[1:] == unit[:-1]) & (width <= MOST))
        found = grid[begin[pair], width[pair]]
        rank[pair] = np.where(found >= 0, pieces.rank[found], NONE)
        heads = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
        best = np.minimum.reduceat(rank, heads)
        sizes = np.diff(np.append(heads, len(begin)))
        over = np.repeat(best == NONE, sizes)
        if over.any():
            done.append((begin[over], end[over]))
        hit = np.flatnonzero((rank == np.repeat(best, sizes)) & ~over)
        hit = hit[np.concatenate(([True], unit[hit[1:]] != unit[hit[:-1]]))] if len(hit) else hit
        end[hit] = end[hit + 1] if len(hit) else end[hit]
        stay = ~over
        stay[hit + 1] = False
        begin, end, unit = begin[stay], end[stay], unit[stay]
    if not done:
        return begin, end
    begin, end = np.concatenate([b for b, _ in done]), np.concatenate([e for _, e in done])
    order = np.argsort(begin, kind="stable")
    return begin[order], end[order]


def relax_long(pieces: Pieces, grid: np.ndarray, first: int, n: int) -> tuple[list[int], list[int]]:
    """The same for one very long unit, with a heap of pairs in place of rounds."""
    begin, end = list(range(first, first + n)), list(range(first + 1, first + n + 1))
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (width := end[j] - begin[i]) <= MOST and (found := grid[begin[i], width]) >= 0:
            heapq.heappush(heap, (int(pieces.rank[found]), i, end[i], end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or end[i] != middle or end[j] != stop:
            continue
        end[i], after[i], alive[j] = end[j], after[j], False
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [b for b, a in zip(begin, alive) if a], [e for e, a in zip(end, alive) if a]


class Encoder:
    """Encodes batches, keeping the ids of units it has met (forgotten together when there are too many)."""

    def __init__(self, model: bytes, known: int = KNOWN_UNITS, index_chars: int = INDEX_CHARS):
        self.pieces, self.most, self.index_chars = Pieces(model), known, index_chars
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.flat, self.count = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)

    def units(self, text: str) -> list[str]:
        return UNITS.findall(" " + text.replace(META, " ")) if text else []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        every: list[str] = []
        ends = [0]
        for t in texts:
            every += self.units(t)
            ends.append(len(every))
        at = np.fromiter(map(self.place.get, every, repeat(-1)), dtype=np.int64, count=len(every))
        unknown = np.flatnonzero(at < 0).tolist()
        new = dict.fromkeys([every[i] for i in unknown])
        if len(self.place) + len(new) > self.most and self.place:
            self._forget()
            unknown = range(len(every))
            new = dict.fromkeys(every)
        if new:
            self._learn(list(new))
            at[unknown] = [self.place[every[i]] for i in unknown]
        n = self.count[at]
        starts = (np.cumsum(self.count) - self.count)[at]
        flat = self.flat[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        total = np.concatenate(([0], np.cumsum(n)))[ends]
        return flat, np.diff(total)

    def _learn(self, new: list[str]) -> None:
        group: list[str] = []
        size = 0
        for u in new:
            if group and size + len(u) >= self.index_chars:
                self._solve(group)
                group, size = [], 0
            group.append(u)
            size += len(u) + 1
        if group:
            self._solve(group)
        if self.parts:
            self.flat = np.concatenate([self.flat, *self.parts])
            self.count = np.concatenate([self.count, *self.counts])
            self.parts, self.counts = [], []

    def _solve(self, units: list[str]) -> None:
        pieces = self.pieces
        joined = "\0".join(units) + "\0"
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = pieces.codes[chars]
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        codes[first + sizes] = 0
        grid = np.full((len(codes), MOST + 1), -1, dtype=np.int32)
        position, length, ids = edges(pieces, codes)
        grid[position, length] = ids
        grid[:, 1] = pieces.single[codes]
        short = sizes <= LONG_UNIT
        owner = np.repeat(np.arange(len(units)), sizes)
        places = np.arange(len(owner)) + owner  # one separator after each unit before
        plain = short[owner]
        begin, end = relax(pieces, grid, places[plain], owner[plain])
        for u in np.flatnonzero(~short).tolist():
            b, e = relax_long(pieces, grid, int(first[u]), int(sizes[u]))
            begin, end = np.concatenate((begin, b)), np.concatenate((end, e))
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order].astype(np.int64), end[order].astype(np.int64)
        ids = grid[begin, end - begin]
        unit = np.searchsorted(first, begin, "right") - 1
        ids, unit = self._bytes(ids, unit, chars[begin])
        for u in units:
            self.place[u] = len(self.place)
        self.parts.append(ids)
        self.counts.append(np.bincount(unit, minlength=len(units)).astype(np.int64))

    def _bytes(self, ids: np.ndarray, unit: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put byte ids in place of characters that have no piece."""
        lost = np.flatnonzero(ids < 0)
        if not len(lost):
            return ids, unit
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars[lost].tolist()]
        n = np.ones(len(ids), dtype=np.int64)
        n[lost] = [len(r) for r in raw]
        out = np.repeat(ids, n)
        out[np.repeat(ids < 0, n)] = self.pieces.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return out, np.repeat(unit, n)

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each run of ids, without the blank put in front."""
        p = self.pieces
        n = p.sizes[flat]
        out = p.flat[np.repeat(p.starts[flat] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes()
        ends = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        cut = [out[a:b] for a, b in zip(ends, ends[1:])]
        return [t[1:] if t[:1] == b" " else t for t in cut]


def encode(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ``n_tokens``, ``ids`` and ``round_trip``: whether decoding the ids gives the text again."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in slices(batches, "text", 6 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            flat, counts = encoder.encode(texts)
            same = [back == t.replace(META, " ").encode("utf-8", "surrogatepass")
                    for back, t in zip(encoder.decode(flat, counts), texts)]
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array(same),
            ], names=["doc_id", "n_tokens", "ids", "round_trip"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: bytes, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and ``text`` from arrays of ids; null ids give a null text, bytes that are no UTF-8 are replaced."""
    rows = encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part.column("ids").to_pylist()
                flat = np.array([i for ids_ in lists for i in ids_ or ()], dtype=np.int32)
                back = encoder.decode(flat, np.array([len(x or ()) for x in lists], dtype=np.int64))
                texts = [None if x is None else b.decode("utf-8", "replace") for b, x in zip(back, lists)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {kind}, text string")
