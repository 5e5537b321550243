"""Repair of conversation structure: the cheapest edits that make roles alternate, by an auction over a lattice.

Rows of a conversation are levels of a lattice, the roles accepted so far its four states, edits its arcs with small
integer costs. Each node has a price. A path is extended along an arc whose price difference equals its cost, or
contracted when its end has none, which raises that node's price; when it arrives, the prices are dual values that show all
cheapest paths as tight arcs, and a search in label order takes the least of these. Long conversations start further auctions at
every ``STRIDE``-th level, last ones first, so that a path ends at nodes whose prices have converged.

Spark groups the rows by conversation. One with more than ``MOST`` rows or ``MOST_CHARS`` characters is never one group: its rows
are dealt in order over tasks and cut into segments; auctions give each segment's costs between states, these few numbers
are chained per conversation, each segment is traced for the four states it can be entered in, and the repaired text is
hashed as a stream (SHA-256 needs its bytes in order). Both ways give the same rows.

Defined results: null roles and texts are one space, also in the hash of the damage; a null conv_id is a conversation;
equal turns go by role and then by MD5 of the text; repeated rows are duplicates; conversations without rows left get zeros; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
MOST = 1024
MOST_CHARS = 8 << 20
SEGMENT = 10  # bits of a place that lie in one segment
STRIDE = 64
FAR = 1 << 40
BLANK = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}

# States: nothing yet, a system row, a user row, a complete pair. What may follow, and the one role that edits can put there.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
PUT = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
END = (0, FAR, FAR, 0)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies``: 0 for a dropped row, 2 for a repeated one."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(filled("role")).alias("role"),
        text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def fault(text: Column) -> Column:
    """1 for a blank text, 2 for one that does not end its sentence."""
    kept = F.rtrim(text, F.lit(BLANK))
    return F.when(kept == "", 1).when(~F.substring(kept, -1, 1).isin(".", "!", "?"), 2).otherwise(0)


# ---- the lattice -------------------------------------------------------------------

@lru_cache(maxsize=None)
def arcs(symbol: str, state: int) -> tuple[tuple[int, str, int, int], ...]:
    """(cost, label, levels onward, state) of the edits at a row, in label order. Symbols: ``D`` for a row that must go,
    else the role's initial (``o`` for any other), a capital if truncated; an empty symbol stands behind the last row."""
    found = [(INSERT, "I", 0, PUT[state][1])]
    if symbol:
        found.append((DELETE, "D", 1, state))
    if symbol and symbol != "D":
        more = TRUNCATED if symbol.isupper() else 0
        if symbol.lower() in FOLLOWS[state]:
            found.append((KEEP + more, "K", 1, FOLLOWS[state][symbol.lower()]))
        found.append((REROLE + more, "R", 1, PUT[state][1]))
    return tuple(sorted(found, key=lambda a: a[1]))


class Lattice:
    """Prices of the nodes (level, state) of one run of rows. ``end`` gives the cost behind it by state; a run that others
    follow leaves inserts at its end to the next one."""

    def __init__(self, symbols: str, end: tuple[int, ...] = END, last: bool = True):
        self.symbols, self.end, self.n = symbols, end, len(symbols)
        self.behind = [arcs("", q) if last else () for q in range(4)]
        least = min(end)
        floor = [least] * (self.n + 1)
        for k in range(self.n - 1, -1, -1):
            c = symbols[k]
            floor[k] = floor[k + 1] + (DELETE if c == "D" else TRUNCATED if c.isupper() else 0)
        # No arc costs less than what it passes; FAR where no way leads to a finite end, as states are never returned to.
        system = max(symbols.rfind("s"), symbols.rfind("S"))
        reached = [end[2] < FAR or end[3] < FAR] * 4
        reached[1] |= end[1] < FAR
        reached[0] |= end[0] < FAR
        self.price = [floor[k] if reached[q] or (q == 0 and end[1] < FAR and k <= system) else FAR
                      for k in range(self.n + 1) for q in range(4)]
        if not last:
            self.price[-4:] = end
        self.settled: set[int] = set()

    def best(self, node: int) -> tuple[int, int]:
        """Least cost of an arc plus the price behind it, and that arc's head; -1 is the end."""
        k, q = node >> 2, node & 3
        least, head = (self.end[q], -1) if k == self.n else (FAR << 1, -1)
        for cost, _, on, state in (self.behind[q] if k == self.n else arcs(self.symbols[k], q)):
            to = ((k + on) << 2) | state
            if cost + self.price[to] < least:
                least, head = cost + self.price[to], to
        return least, head

    def auction(self, origin: int) -> int:
        """Extend and contract a path from ``origin`` until it arrives; its price is then its distance to the end."""
        path = [origin]
        while self.price[origin] < FAR:
            node = path[-1]
            if node in self.settled:
                break
            least, head = self.best(node)
            if self.price[node] < least:
                self.price[node] = least
                if len(path) > 1:
                    path.pop()
            elif head < 0:
                break
            else:
                path.append(head)
        self.settled.add(origin)
        return self.price[origin]

    def solve(self, entries: tuple[int, ...] = (0,)) -> list[int]:
        """Distance to the end from each entry state, FAR if there is no way."""
        for k in range(self.n - self.n % STRIDE, 0, -STRIDE):
            for q in range(4):
                self.auction((k << 2) | q)
        return [self.auction(q) for q in entries]

    def trace(self, entry: int = 0) -> tuple[str, int]:
        """Labels of the least tight path from ``entry`` to the end, and the state it ends in."""
        node, labels, choices, dead = entry, [], [], set()
        moves = self._tight(entry)
        while True:
            step = next(moves, None)
            if step is None:  # no tight way on: go back and never come here again
                dead.add(node)
                node, moves = choices.pop()
                labels.pop()
                continue
            label, to = step
            if to < 0:
                return "".join(labels), node & 3
            if to not in dead:
                choices.append((node, moves))
                labels.append(label)
                node, moves = to, self._tight(to)

    def _tight(self, node: int) -> Iterator[tuple[str, int]]:
        k, q = node >> 2, node & 3
        if k == self.n and self.price[node] == self.end[q]:
            yield "", -1
        for cost, label, on, state in (self.behind[q] if k == self.n else arcs(self.symbols[k], q)):
            to = ((k + on) << 2) | state
            if self.price[node] == cost + self.price[to]:
                yield label, to


@lru_cache(maxsize=1 << 16)
def repaired(symbols: str) -> tuple[int, str]:
    """Least cost and audit of a whole conversation."""
    lattice = Lattice(symbols)
    return lattice.solve()[0], lattice.trace()[0]


def symbol(initial: str, fault: int, duplicate: bool) -> str:
    if fault == 1 or duplicate:
        return "D"
    known = initial if initial in ("s", "u", "a") else "o"
    return known.upper() if fault == 2 else known


class Speech:
    """SHA-256 of repaired ``role:text`` lines, fed one row or audit at a time."""

    def __init__(self):
        self.hash, self.state, self.first = hashlib.sha256(), 0, True

    def _line(self, role: str, text: str) -> None:
        if not self.first:
            self.hash.update(b"\n")
        self.first = False
        self.hash.update(f"{role}:".encode("utf-8", "surrogatepass"))
        self.hash.update(text.encode("utf-8", "surrogatepass"))

    def put(self, label: str, role: str = "", text: str = "") -> None:
        if label in "IR":
            role, self.state = PUT[self.state]
            self._line(role, text)
        elif label == "K":
            self.state = FOLLOWS[self.state][role[:1]]
            self._line(role, text)


# ---- conversations in one group ----------------------------------------------------

RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole conversations (conv_id, list of turn, role, digest, text, fault) to results."""
    for batch in batches:
        lists = batch.column("rows")
        bounds = lists.offsets.to_pylist()
        flat = lists.values
        turn, role, digest, text, faults = (flat.field(i).to_pylist() for i in (0, 1, 2, 3, 4))
        out = []
        for a, b in zip(bounds, bounds[1:]):
            seen, symbols, counts = set(), [], [0, 0, 0]
            for i in range(a, b):
                key = (role[i], digest[i])
                repeat = key in seen
                seen.add(key)
                if faults[i] == 1:
                    counts[0] += 1
                elif repeat:
                    counts[1] += 1
                elif faults[i] == 2:
                    counts[2] += 1
                symbols.append(symbol(role[i][:1], faults[i], repeat))
            cost, audit = repaired("".join(symbols))
            turns = [t for t in turn[a:b] if t is not None]
            gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
            illegal = sum(role[i][:1] + role[i + 1][:1] not in LEGAL for i in range(a, b - 1))
            speech, i = Speech(), a
            for label in audit:
                if label == "I":
                    speech.put("I")
                else:
                    speech.put(label, role[i], text[i])
                    i += 1
            out.append((gaps, *counts, illegal, cost, audit, speech.hash.hexdigest()))
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *columns], names=["conv_id", *(f.split()[0] for f in RESULT.split(", "))])


def _short(rows: DataFrame) -> DataFrame:
    """Damaged rows of conversations that fit into a group."""
    item = F.struct("turn", "role", "digest", "text", "fault")
    each = F.when(F.col("copies") > 0, item)
    lists = rows.groupBy("conv_id").agg(
        F.collect_list(each).alias("once"), F.collect_list(F.when(F.col("copies") == 2, item)).alias("again"))
    lists = lists.select("conv_id", F.array_sort(F.concat("once", "again"), _by_place).alias("rows"))
    return lists.mapInArrow(_whole, f"conv_id {dict(rows.dtypes)['conv_id']}, {RESULT}")


def _by_place(a: Column, b: Column) -> Column:
    key = lambda r: F.struct(r["turn"], r["role"], r["digest"])
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


# ---- conversations over many tasks -------------------------------------------------

def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment: symbols, counts, and costs from each state before it to each state after it."""
    for batch in batches:
        out = []
        for items, firsts in zip(batch.column("items").to_pylist(), batch.column("firsts").to_pylist()):
            items.sort(key=lambda r: r["pos"])
            new = set(firsts)
            symbols = "".join(symbol(r["initial"], r["fault"], r["pos"] not in new) for r in items)
            blank = sum(r["fault"] == 1 for r in items)
            double = sum(r["fault"] != 1 and r["pos"] not in new for r in items)
            cut = sum(r["fault"] == 2 and r["pos"] in new for r in items)
            illegal = sum(x["initial"] + y["initial"] not in LEGAL for x, y in zip(items, items[1:]))
            costs = [FAR] * 16
            for q in range(4):
                to = tuple(0 if k == q else FAR for k in range(4))
                costs[q::4] = Lattice(symbols, to, last=False).solve((0, 1, 2, 3))
            out.append((items[0]["pos"], symbols, blank, double, cut, illegal, items[0]["initial"], items[-1]["initial"], costs))
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.list_(pa.int64())]
        names = ["start", "symbols", "blank", "duplicate", "truncated", "illegal", "head", "tail", "costs"]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names=["conv_id", *names])


SEGMENTS = ("start long, symbols string, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
            "costs array<bigint>")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation, from the last segment to the first: the cost behind each segment by state."""
    for batch in batches:
        starts, ends = [], []
        for segments in batch.column("segments").to_pylist():
            behind = [Lattice("", END).solve((q,))[0] for q in range(4)]
            for s in reversed(segments):
                starts.append(s["start"])
                ends.append(behind)
                behind = [min(s["costs"][4 * p + q] + behind[q] for q in range(4)) for p in range(4)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(starts, pa.int64()), pa.array(ends, pa.list_(pa.int64()))], names=["start", "behind"])


def _traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment: audit, exit and cost for each state it can be entered in."""
    for batch in batches:
        out = []
        for symbols, behind in zip(batch.column("symbols").to_pylist(), batch.column("behind").to_pylist()):
            lattice = Lattice(symbols, tuple(behind), last=False)
            costs = lattice.solve((0, 1, 2, 3))
            audits, exits = zip(*(lattice.trace(q) if costs[q] < FAR else (None, None) for q in range(4)))
            out.append((list(audits), list(exits), costs))
        kinds = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("start"), *columns], names=["conv_id", "start", "audits", "exits", "costs"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation: the audits of its segments in order, each for the state that the one before it left."""
    for batch in batches:
        out = []
        for segments in batch.column("segments").to_pylist():
            state, parts = 0, []
            for s in segments:
                parts.append({"start": s["start"], "audit": s["audits"][state]})
                state = s["exits"][state]
            tail = Lattice("", END)
            tail.solve((state,))
            parts.append({"start": None, "audit": tail.trace(state)[0]})
            out.append((segments[0]["costs"][0], parts))
        kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("audit", pa.string())]))]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names=["conv_id", "cost", "parts"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, the first of a segment with its audit, and a last row with the audit behind them all: the hash of each
    conversation, in memory of one row."""
    speech, todo, conv = Speech(), iter(()), None
    for batch in batches:
        ids, hashes = [], []
        for conv, role, text, audit, closes in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit", "closes"))):
            if audit is not None:  # the audit of a segment ends at its last row
                todo = iter(audit)
            for label in todo:
                speech.put(label, *(() if closes or label == "I" else (role, text)))
                if label != "I" and not closes:
                    break
            if closes:
                ids.append(conv)
                hashes.append(speech.hash.hexdigest())
                speech, todo = Speech(), iter(())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.schema.field("conv_id").type), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])


def _long(rows: DataFrame) -> DataFrame:
    """Damaged rows of conversations that are too long for a group."""
    kind = dict(rows.dtypes)["conv_id"]
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).withColumn("salt", F.rand(7))
    place = ["conv_id", "turn", "role", "digest", "salt"]  # equal rows may lie in any order, over any number of tasks
    ordered = each.repartitionByRange(*place).sortWithinPartitions(*place)
    placed = written(ordered.select(
        "conv_id", "turn", "role", "digest", "text", "fault", F.monotonically_increasing_id().alias("pos")), "long-rows")
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("conv_id", "pos")
    item = F.struct("pos", F.substring("role", 1, 1).alias("initial"), "fault")
    marked = placed.select("conv_id", "pos", item.alias("item"), F.lit(None).cast("long").alias("first")).unionByName(
        firsts.select("conv_id", "pos", F.lit(None).cast(_type(item, placed)).alias("item"), F.col("pos").alias("first")))
    lists = marked.groupBy("conv_id", F.shiftright("pos", SEGMENT).alias("segment")).agg(
        F.collect_list("item").alias("items"), F.collect_list("first").alias("firsts"))
    segments = written(lists.mapInArrow(_segments, f"conv_id {kind}, {SEGMENTS}"), "long-segments")

    def chained(df: DataFrame, *columns: str) -> DataFrame:
        return df.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", *columns))).alias("segments"))

    behind = chained(segments, "costs").select("segments").mapInArrow(_chain, "start long, behind array<bigint>")
    traced = segments.join(behind, "start").select("conv_id", "start", "symbols", "behind").mapInArrow(
        _traces, f"conv_id {kind}, start long, audits array<string>, exits array<bigint>, costs array<bigint>")
    audits = written(chained(traced, "audits", "exits", "costs").mapInArrow(
        _joined, f"conv_id {kind}, cost long, parts array<struct<start: bigint, audit: string>>"), "long-audits")
    parts = audits.select("conv_id", F.explode("parts").alias("p")).select("conv_id", "p.start", "p.audit")
    closing = parts.where("start is null").select(
        "conv_id", F.lit(None).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), "audit", F.lit(True).alias("closes"))
    told = placed.join(parts.where("start is not null").select(F.col("start").alias("pos"), "audit"), "pos", "left").select(
        "conv_id", "pos", "role", "text", "audit", F.lit(False).alias("closes")).unionByName(closing)
    hashes = told.repartition("conv_id").sortWithinPartitions("conv_id", "closes", "pos").mapInArrow(
        _hashed, f"conv_id {kind}, repaired_sha256 string")
    turns = placed.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    # Where one segment meets the next, their roles meet too.
    meets = F.expr("""aggregate(slice(segments, 2, size(segments)), named_struct('n', 0L, 'tail', segments[0].tail),
        (s, x) -> named_struct('n', s.n + if(concat(s.tail, x.head) in ('su', 'ua', 'au'), 0L, 1L), 'tail', x.tail), s -> s.n)""")
    total = lambda c: F.aggregate("segments", F.lit(0).cast("long"), lambda a, s: a + s[c]).alias(c)
    sums = chained(segments, "blank", "duplicate", "truncated", "illegal", "head", "tail").select(
        "conv_id", *map(total, ("blank", "duplicate", "truncated", "illegal")), meets.alias("met"))
    out = audits.select("conv_id", "cost", F.concat_ws("", "parts.audit").alias("audit"))
    for other in (hashes, turns, sums):
        other = other.withColumnRenamed("conv_id", "other_id")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col("other_id"))).drop("other_id")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("met")).alias("illegal"),
                      "cost", "audit", "repaired_sha256")


def _type(column: Column, df: DataFrame):
    return df.select(column.alias("c")).schema["c"].dataType


def repair(conversations: DataFrame, most: int = MOST, most_chars: int = MOST_CHARS) -> DataFrame:
    """Damage the rows, then one row per conv_id with its faults, least cost, audit and the hash of the repaired text."""
    rows = damage(conversations).withColumn("digest", F.md5(F.col("text").cast("binary"))).withColumn("fault", fault(F.col("text")))
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.length("text") * F.col("copies")).alias("chars"))
    # At most one id for each ``most`` rows or ``most_chars`` characters of the input.
    big = written(sizes.where((F.col("n") > most) | (F.col("chars") > most_chars)).select(
        F.col("conv_id").alias("big_id"), F.lit(True).alias("big")), "long-ids")
    if big.isEmpty():
        return _short(rows)
    sorted_out = rows.join(big, F.col("conv_id").eqNullSafe(F.col("big_id")), "left").drop("big_id")
    return _short(sorted_out.where("big is null").drop("big")).unionByName(
        _long(sorted_out.where("big and copies > 0").drop("big")))
