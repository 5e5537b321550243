"""Each operator against brute force, and on nulls, empty and very long texts, ties, repeated rows and empty tables."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm import (
    catalog, components, decontaminate, licenses, line_dedup, pieces, quality_rules, sentence_spans, simhash_pivots,
    token_edits, toxicity, warc,
)

# Extra columns have names that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, fp string, host string, row string, n_words long"
WORDS = "the of and house river stone light paper green walk seven mountain window silver garden letter summer engine".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(n):
        w = rng.choice(WORDS) + rng.choice(["", "s", "ing", "er", "ed", "ly", "en", "ath"])
        out.append((w.capitalize() if k % 9 == 0 else w) + ("." if k % 9 == 8 else "") + ("\n" if k % 27 == 26 else " "))
    return "".join(out).strip()


def rows_of(*pairs):
    return [(i, t, "en", s, None if t is None else len(t), True, "x", "h", "r", 1) for i, t, s in pairs]


EDGES = [
    (1, prose(1, 80), "a"), (2, prose(1, 80), "a"), (2, prose(1, 80), "a"), (3, None, "a"), (4, "", None), (None, prose(4, 60), "b"),
    (None, None, None), (5, " \n\t ", "b"), (6, prose(5, 60000), "b"), (7, "x" * 120000, "b"), (8, "é日本 😀 a b\0c ▁", "c"),
    (9, prose(9, 40) + "\n" + prose(1, 80), "c"), (10, "same line here\n" * 30, "c"), (6, prose(6, 30), "d"),
    (11, prose(11, 50) + " loser", "d"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(rows_of(*EDGES), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return [t for _, t, _ in EDGES]


def plain_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# ---- quality rules -----------------------------------------------------------------

def measure(t):
    w = plain_words(t)
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if plain_words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(edges, nothing):
    got = [tuple(r[m] for m in quality_rules.MEASURES) for r in quality_rules.judge(edges).collect()]
    assert sorted(got) == sorted(measure(t) for t in texts())
    assert quality_rules.judge(nothing).count() == 0 and quality_rules.keep_good(nothing).count() == 0


def test_rejected_host_takes_its_documents_along(spark):
    junk = [(i, "# $ " * 30 + prose(i, 25), "bad") for i in range(40)] + [(99, prose(99, 60), "bad")]
    good = [(i, prose(i, 60), f"h{i % 5}") for i in range(100, 200)] + [(300, prose(300, 60), None)]
    docs = spark.createDataFrame(rows_of(*junk, *good), SCHEMA)
    kept = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert kept == {i for i, _, _ in good}
    stay = quality_rules.keep_good(docs)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == kept


def test_one_bad_page_does_not_reject_a_small_host(spark):
    docs = spark.createDataFrame(rows_of(
        *[(i, prose(i, 60), f"h{i % 20}") for i in range(400)], (900, " ".join(f"a{k}#" for k in range(40)), "tiny")), SCHEMA)
    assert {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}[900]


# ---- line dedup --------------------------------------------------------------------

def test_lines(spark, edges, nothing):
    rows = [(i, f"menu home\n{prose(i, 30)}" if i % 3 else prose(i, 30), "s" if i % 2 else "t") for i in range(60)]
    rows += [(100, "menu home", "rare"), (101, "menu home\n\nmenu home", None)]
    docs = spark.createDataFrame(rows_of(*rows), SCHEMA)
    got = {r.row.doc_id: (r.clean, r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(docs).collect()}
    for i, t, s in rows:
        lines = t.split("\n")
        left = [x for x in lines if x != "menu home" or s in ("rare", None)]
        assert got[i] == ("\n".join(left), len(lines), len(lines) - len(left))
    assert line_dedup.drop_boilerplate(edges).count() == len(EDGES) and line_dedup.drop_boilerplate(nothing).count() == 0


def test_copies_keep_their_lines_in_the_pipeline(spark):
    copied = {k: f"menu home\n{prose(k, 60)}" for k in range(3)}
    rows = [(10 * k + j, t, h) for k, t in copied.items() for j in range(5) for h in ("s" if k else "u",)]
    rows += [(100 + k, f"menu home\n{prose(100 + k, 40)}", "s") for k in range(4)] + [(200 + k, None, "s") for k in range(9)]
    docs = spark.createDataFrame(rows_of(*rows), SCHEMA).repartition(3)
    got = {r.doc_id: r.text for r in corpus_pipeline.without_boilerplate(spark, docs, "").collect()}
    # On s the menu is on six distinct pages of seven; u holds one page, given five times.
    assert got == {i: t if t is None or h == "u" else t.removeprefix("menu home\n") for i, t, h in rows}


# ---- simhash -----------------------------------------------------------------------

def brute_print(t):
    w = (t or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_groups(prints):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    every = sorted(prints)
    for k, a in enumerate(every):
        for b in every[k + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[root(b)] = root(a)
    return {p: root(p) for p in prints}


def test_simhash_edges(edges, nothing):
    got = simhash_pivots.labelled(edges).collect()
    small = [(i, t) for i, t, _ in EDGES if not t or len(t) < 20000 or i == 7]
    prints = {i: f"{brute_print(t):016x}" for i, t in small if i is not None and i != 6}
    assert all(r.fingerprint == prints[r.doc_id] for r in got if r.doc_id in prints)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {3}
    assert len(got) == len(EDGES) and simhash_pivots.labelled(nothing).count() == 0
    kept = simhash_pivots.keep_one(edges)
    assert kept.columns == edges.columns
    assert collections.Counter(r.doc_id for r in kept.collect())[2] == 0 and kept.where("doc_id = 1").count() == 1


@pytest.mark.parametrize("tile", [simhash_pivots.TILE, 7])
def test_links_connect_what_brute_force_connects(spark, tile):
    rng = random.Random(tile)
    centres = [rng.getrandbits(64) for _ in range(20)]
    prints = set(centres)
    for c in centres[:6]:
        for _ in range(60):  # chains away from a centre
            c ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(c)
    prints |= {centres[7] ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(300)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.root for r in components.components(simhash_pivots.links(frame, tile)).collect()}
    want = brute_groups(prints)
    mine = {p: found.get(s, s) for p, s in zip(prints, signed)}
    pairs = lambda g: sorted(sorted(p for p in g if g[p] == r) for r in set(g.values()))
    assert pairs(mine) == pairs(want)


# ---- decontamination ---------------------------------------------------------------

def brute_align(a, b):
    best, row = 0, [0] * (len(a) + 1)
    for y in b:
        new = [0]
        for j, x in enumerate(a):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best


def test_alignment():
    rng = random.Random(3)
    pairs = [([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 30))],
              [rng.choice([b"a", b"b", b"d"]) for _ in range(rng.randint(1, 20))]) for _ in range(200)]
    got = decontaminate.align([p for p, _ in pairs], [q for _, q in pairs])
    assert got.tolist() == [brute_align(p, q) for p, q in pairs]


def test_leaks(spark, edges, nothing, monkeypatch):
    items = [(k, " ".join(f"w{k}x{j}" if j % 4 else "the" for j in range(30))) for k in range(5)] + [(8, None), (9, "of the")]
    edited = " ".join(w for j, w in enumerate(items[1][1].split()) if j % 7 != 3).replace("w1x9", "other")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, prose(1, 60) + " " + items[0][1] + " " + prose(2, 60)), (2, prose(3, 500) + " " + edited.upper()),
            (3, prose(4, 90)), (4, " ".join(items[2][1].split()[:8])), (5, items[3][1]), (5, items[3][1]), (None, items[4][1]),
            (None, prose(5, 50))]
    rows += [(100 + k, items[3][1] + " " + prose(k, 20)) for k in range(300)]  # a passage that very many documents hold
    docs = spark.createDataFrame(rows_of(*[(i, t, "s") for i, t in rows]), SCHEMA)
    want = {(1, 0), (2, 1), (5, 3), (None, 4)} | {(100 + k, 3) for k in range(300)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == want
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 4]
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)  # several blocks give the same
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == want
    assert decontaminate.leaks(nothing, bench).count() == 0
    assert decontaminate.leaks(edges, bench.where("false")).count() == 0


def test_edited_and_partial_copies_in_many_documents(spark):
    """Neither a seed that very many documents hold nor broken seeds hide a leak; brute force over all pairs."""
    items = [(k, " ".join(f"v{k}x{j}" for j in range(30))) for k in range(3)]
    w = [t.split() for _, t in items]
    edited = " ".join("changed" if j in (5, 15, 25) else x for j, x in enumerate(w[0]))
    first, last = " ".join(w[1][:16]), " ".join(w[1][14:])
    texts = [prose(k, 12) + " " + edited + " " + prose(k + 1, 12) for k in range(200)]
    texts += [prose(k, 12) + " " + first for k in range(200)] + [last + " one document"]
    texts += [" ".join(w[2][:9]) + " " + prose(k, 30) for k in range(50)]  # too little of the item
    docs = spark.createDataFrame(rows_of(*[(k, t, "s") for k, t in enumerate(texts)]), SCHEMA)
    score = lambda t, i: brute_align(decontaminate.words(t), decontaminate.words(i)) / (2 * len(i.split()))
    want = {(k, i): score(t, x) for k, t in enumerate(texts) for i, x in items}
    want = {p: s for p, s in want.items() if s >= decontaminate.SIMILARITY}
    assert len(want) == 401 and want[0, 0] == pytest.approx(0.85)
    got = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(want)
    kept = decontaminate.clean(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == list(range(401, 451))


def edited_copy(rng, ws, insert, drop, replace):
    out = []
    for w in ws:
        r = rng.random()
        out += [] if r < drop else ["changed"] if r < drop + replace else [w]
        if rng.random() < insert:
            out.append(rng.choice(["added", "the", w]))
    return out


def test_no_leak_is_lost_at_any_rate_of_edits(spark):
    """Inserted, dropped and replaced words at every rate, items with repeated words, against brute force."""
    rng = random.Random(8)
    items = [(k, " ".join(rng.choice(["the", "of", "and", f"q{k}x{j}"]) for j in range(rng.choice([3, 4, 7, 12, 30])))) for k in range(12)]
    items += [(20, " ".join(f"z{j}" for j in range(30)))]
    z = items[-1][1].split()
    texts = [" ".join(x for j, w in enumerate(z) for x in ([w, "added"] if j % 2 else [w]))]  # the three probes
    texts += [" ".join("changed" if j % 3 == 2 else w for j, w in enumerate(z)), " ".join(w for j, w in enumerate(z) if j % 3 != 2)]
    texts += [" ".join(x for w in z for x in (w, "added"))]  # no two words of the item are left together
    for k in range(260):
        rates = [rng.choice([0, 0.1, 0.3, 0.5]) for _ in range(3)]
        copy = edited_copy(rng, rng.choice(items)[1].split(), *rates)
        texts.append(" ".join(prose(k, rng.randint(0, 12)).split() + copy + prose(k + 1, rng.randint(0, 12)).split()))
    texts += [prose(k, 30) for k in range(50)] + ["the of and " * 40]
    docs = spark.createDataFrame(rows_of(*[(k, t, "s") for k, t in enumerate(texts)]), SCHEMA)
    want = {(k, i) for k, t in enumerate(texts) for i, x in items
            if brute_align(decontaminate.words(t), decontaminate.words(x)) >= decontaminate.SIMILARITY * 2 * len(x.split())}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and len(want) > 150 and {(k, 20) for k in range(4)} <= got
    with pytest.raises(ValueError):
        decontaminate.Seeds(items, 0.3)


def test_rare_seeds_are_kept():
    seeds = decontaminate.Seeds([(0, " ".join(f"w{j}" for j in range(20)))])
    counts = np.array([1000.0 if j < 8 else 1.0 for j in range(20)])
    seeds.choose(counts)
    kept = set((seeds.holders % (seeds.longest + 1)).tolist())
    assert seeds.need.tolist() == [5] and kept == set(range(4, 19))  # bound 9: four starts are left out, five needed


# ---- sentences ---------------------------------------------------------------------

def test_sentences_join_to_the_text():
    for t in [t for t in texts() if t] + ["A b. C d! E f", "x\n\ny. Z", " lead Word. "]:
        assert "".join(sentence_spans.sentences(t)) == t


def test_repeated_passage_goes_from_all_but_the_first(spark, edges, nothing):
    passage = " ".join(f"Shared phrase number {k} of the passage stands here." for k in range(8))
    own = lambda k: f"Opening{k} of a text that is its own. Closing{k} words that come once."
    rows = [(k, own(k) + " " + passage + " " + own((k or 0) + 50), "s") for k in (5, 3, 8, None)]
    got = {r.doc_id: r.text for r in sentence_spans.without_repeats(spark.createDataFrame(rows_of(*rows), SCHEMA)).collect()}
    assert passage in got[None]  # no id comes first
    for k in (3, 5, 8):
        assert "Shared" not in got[k] and own(k) in got[k] and own(k + 50) in got[k]
    out = {(r.doc_id, r.n_removed > 0) for r in sentence_spans.without_repeats(edges).collect()}
    assert (1, False) in out and (2, True) in out and (3, False) in out
    assert sentence_spans.without_repeats(nothing).count() == 0


@pytest.mark.parametrize("partitions", [1, 2])
def test_a_document_given_twice_is_one_place(spark, partitions):
    lone = " ".join(f"Sentence {k} of the only text that says so here." for k in range(8))
    docs = spark.createDataFrame(rows_of((1, lone, "s"), (1, lone, "s"), (None, prose(2, 60), "s"), (None, prose(2, 60), "s")), SCHEMA)
    got = sentence_spans.without_repeats(docs.coalesce(1) if partitions == 1 else docs.repartition(2)).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.text) for r in got) == sorted(
        [(1, 0, lone)] * 2 + [(0, 0, prose(2, 60))] * 2)


def test_spans_against_all_runs(spark):
    """Every run of enough words that stands at an earlier place goes, up to both its ends."""
    rng = random.Random(11)
    sentence = lambda n: " ".join(["Word", *(rng.choice(WORDS) + str(rng.randint(0, 9999)) for _ in range(n - 1))]) + "."
    shared = [[sentence(n) for n in sizes] for sizes in ((45, 30), (45, 5, 5), (5, 5, 45), (12, 12, 12, 3), (45,), (30,), (3, 50, 4, 9, 30, 1))]
    pool = [sentence(rng.choice([1, 3, 9, 15, 22, 41])) for _ in range(25)]
    docs = {k: [sentence(15), *shared[k % 7], sentence(8), sentence(25)] for k in range(14)}
    docs |= {k: [rng.choice(pool) for _ in range(rng.randint(1, 25))] + rng.choice(shared) for k in range(14, 60)}
    found = [(tuple(d[a:b]), k, a, b) for k, d in docs.items() for a in range(len(d)) for b in range(a + 1, len(d) + 1)
             for n in [sum(len(s.split()) for s in d[a:b])] if n >= 20 and b - a >= 2 or n >= 40]
    first = {}
    for run, k, a, _ in found:
        first.setdefault(run, (k, a))
    gone = collections.defaultdict(set)
    for run, k, a, b in found:
        if first[run] != (k, a):
            gone[k].update(range(a, b))
    want = {k: (len(gone[k]), " ".join(s for j, s in enumerate(d) if j not in gone[k])) for k, d in docs.items()}
    assert gone[7] == {1, 2} and gone[8] == {1, 2, 3} and 5 not in gone[12]
    rows = spark.createDataFrame(rows_of(*[(k, " ".join(d), "s") for k, d in docs.items()]), SCHEMA)
    got = sentence_spans.without_repeats(rows.repartition(3)).collect()
    assert {r.doc_id: (r.n_removed, r.text.strip()) for r in got} == want


# ---- tokens ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def counter():
    return token_edits.Counter(token_edits.read_ranks(catalog.BYTE_RANKS))


def test_edited_counts_equal_full_counts(counter):
    rng = random.Random(5)
    parts = ["a", "b", "'", "l", "s", "re", "  ", " ", "\n", "1", "!", "é", "日", "\t", "the ", "n't"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        tree = token_edits.Tree(text, counter)
        for _ in range(4):
            a = rng.randint(0, len(text) + 1)
            b, new = a + rng.choice([0, 1, 2, 5]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 4)))
            tree.edit(a, b, new)
            a, b = min(a, len(text)), max(min(b, len(text)), min(a, len(text)))
            text = text[:a] + new + text[b:]
            assert tree.text == text and tree.tokens == len(counter.encoding.encode_ordinary(text))


def test_edits_on_edges(spark, edges, nothing, counter):
    ranks = token_edits.read_ranks(catalog.BYTE_RANKS)
    edits = spark.createDataFrame([(1, 1, 3, 9, "new"), (1, 2, None, None, " end"), (3, 1, 0, 0, "was null")],
                                  "doc_id long, seq long, start long, stop long, insert string")
    docs = token_edits.with_edits(edges, edits)
    got = token_edits.edited(docs, ranks, F.col("edits")).collect()
    size = lambda t: len(counter.encoding.encode_ordinary(t))
    assert sorted(r.n_tokens for r in got) == sorted(size(t or "") for t in texts())
    one, three = (next(r for r in got if r.doc_id == k) for k in (1, 3))
    assert one.n_tokens_after == size(texts()[0][:3] + "new" + texts()[0][9:] + " end") and one.n_encoded_again < 20
    assert three.n_tokens_after == size("was null")
    assert token_edits.edited(nothing, ranks, F.lit(None)).count() == 0


def test_leaves_stay_pre_tokens(counter):
    """An edit inside a large insert, and many edits beside one another, cost their region only."""
    tree = token_edits.Tree("some words. " * 50, counter)
    tree.edit(30, 30, "more words, " * 1000)
    tree.encoded = 0
    tree.edit(6000, 6003, "abc")
    assert tree.encoded < 10
    for k in range(200):
        tree.encoded = 0
        tree.edit(100 + 4 * k, 100 + 4 * k, "new ")
        assert tree.encoded < 10
    pre = counter.pattern.findall(tree.text)
    assert tree.leaves == len(pre) and tree.tokens == len(counter.encoding.encode_ordinary(tree.text))
    assert [a.tolist() for a in tree.stored()] == [list(map(len, pre)), counter.tokens(pre)]
    tree.edit(0, len(tree.text), "")
    assert (tree.text, tree.tokens, tree.leaves) == ("", 0, 0)
    tree.edit(0, 0, "back again")
    assert tree.tokens == len(counter.encoding.encode_ordinary("back again"))


def test_trees_are_kept_as_a_table(spark, edges, nothing, counter, tmp_path):
    ranks, folder = token_edits.read_ranks(catalog.BYTE_RANKS), str(tmp_path / "trees")
    token_edits.write_trees(token_edits.trees(edges, ranks), folder, 0)
    first = [(r.doc_id, r.text) for r in token_edits.read_trees(spark, folder).collect()]
    assert len(first) == edges.count()
    kind = "doc_id long, seq long, start long, stop long, insert string"
    batches = [
        [(1, 2, None, None, " end"), (1, 1, 0, 4, "Begin"), (3, 1, 0, 0, "was null"), (10 ** 9, 1, 0, 0, "no document")],
        [(1, 1, 2, 3, ""), (None, 1, 0, 0, "no id")],
    ]
    for version, edits in enumerate(batches, 1):
        for _ in range(2):  # a repeated version takes the place of its first try
            token_edits.update_trees(spark, folder, spark.createDataFrame(edits, kind), ranks, version)
    written = {v: spark.read.parquet(f"{folder}/version={v}") for v in (1, 2)}
    assert {r.doc_id for r in written[1].collect()} == {1, 3} and {r.doc_id for r in written[2].collect()} == {1}
    assert all(r.n_encoded_again < 20 for v in written.values() for r in v.collect())

    def after(doc_id, text):
        for edits in batches:
            for e in sorted((e for e in edits if e[0] == doc_id and doc_id is not None), key=lambda e: e[1]):
                start = len(text) if e[2] is None else min(e[2], len(text))
                stop = max(len(text) if e[3] is None else min(e[3], len(text)), start)
                text = text[:start] + e[4] + text[stop:]
        return text

    got = token_edits.read_trees(spark, folder).collect()
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == sorted(((i, after(i, t)) for i, t in first), key=key)
    for r in got:
        pre = counter.pattern.findall(r.text)
        assert (list(r.chars), list(r.tokens)) == (list(map(len, pre)), counter.tokens(pre)) and r.n_tokens == sum(r.tokens)
    token_edits.write_trees(token_edits.trees(nothing, ranks), str(tmp_path / "none"), 0)
    assert token_edits.read_trees(spark, str(tmp_path / "none")).count() == 0


# ---- pieces ------------------------------------------------------------------------

def test_pieces_equal_the_library(edges, nothing):
    import sentencepiece

    model = pieces.read_model(catalog.PIECE_MODEL)
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = pieces.encode(edges, model)
    want = collections.Counter((i, tuple(lib.encode(t or ""))) for i, t, _ in EDGES)
    rows = got.collect()
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in rows) == want and all(r.round_trip for r in rows)
    back = pieces.decode(got, model).collect()
    assert collections.Counter((r.doc_id, r.text) for r in back) == collections.Counter(
        (i, (t or "").replace("▁", " ")) for i, t, _ in EDGES)
    assert pieces.encode(nothing, model).count() == 0
    rng = random.Random(1)
    odd = ["".join(rng.choice("ab cde\n▁ éßthing  .,;(){}\r=") for _ in range(rng.randint(0, 200))) for _ in range(800)]
    flat, n = pieces.Encoder(model, known=50, index_chars=300).encode(odd)
    ends = np.concatenate(([0], np.cumsum(n)))
    assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [lib.encode(t) for t in odd]


# ---- toxicity ----------------------------------------------------------------------

def test_toxicity_words_cover_runs_of_any_length():
    run = "".join(random.Random(3).choices("abcdef", k=1000))
    assert "".join(toxicity.tokens(run)) == run and max(map(len, toxicity.tokens(run))) == 64
    assert toxicity.tokens("One two_2, é日本!") == ["one", "two_2", "é日本"]


def test_toxicity_on_the_given_tables(spark):
    """Held-out rows of the 0.01 tables, and what the score is on rows the labels of which it may not see."""
    folder = "/root/testdata/sf0.01"
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    rows = toxicity.classify(read("documents"), read("labels")).join(read("labels"), "doc_id").where("held_out").collect()
    bad, good = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert len(bad) == 6 and sum(s >= 0.5 for s in bad) >= 4 and sum(s >= 0.5 for s in good) <= 3
    assert sum(b > g for b in bad for g in good) / (len(bad) * len(good)) > 0.95


def test_toxicity_on_held_out_and_unseen_spellings(spark, edges, nothing):
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        rows.append((i, prose(i, 40 + i % 200) + (" you horrible nastyword, horribl" if bad else ""), "s"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows_of(*rows), SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    out = toxicity.scored(docs, model).collect()
    held = [(r.score >= 0.5, r.doc_id % 4 == 0) for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.97
    assert model.score(prose(7, 60) + " nastywordz") > model.score(prose(7, 60))
    empty = toxicity.scored(edges, model).collect()
    assert len(empty) == len(EDGES) and all(0 <= r.score <= 1 for r in empty)
    assert {r.score for r in toxicity.classify(edges, marks.where("false")).collect()} <= {r.score for r in toxicity.scored(
        edges, toxicity.train(edges, marks.where("false"))).collect()}
    assert toxicity.classify(nothing, marks).count() == 0


# ---- licences ----------------------------------------------------------------------

def test_licences(spark, nothing):
    rows = [(1, prose(1, 30) + "\nReleased under the MIT License.\n" + prose(2, 30), "a/x/own.txt"),
            (2, prose(3, 30), "a/x/plain.txt"), (3, "Licensed under the Apache License, Version 2.0.", "a/LICENSE"),
            (4, prose(4, 30), "a/x/y/deep.txt"), (5, "Licensed under CC BY-NC 4.0.", "a/x/y/LICENSE.md"), (6, None, "b/none.txt"),
            (7, "", None), (8, prose(5, 20), "top.txt"), (8, prose(5, 20), "top.txt")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string").withColumn("license", F.lit("x"))
    got = {r.doc_id: (r.license, r.inherited_from) for r in licenses.inherit(licenses.scan(docs)).collect()}
    assert got == {1: ("MIT", None), 2: ("Apache-2.0", "a"), 3: ("Apache-2.0", None), 4: ("CC-BY-NC-4.0", "a/x/y"),
                   5: ("CC-BY-NC-4.0", None), 6: (None, None), 7: (None, None), 8: (None, None)}
    assert licenses.inherit(licenses.scan(docs)).count() == len(rows)
    assert licenses.inherit(licenses.scan(docs.where("false"))).count() == 0


SHARES = {"license": 0.03, "the": 0.9, "under": 0.1, "version": 0.01, "of": 0.9, "and": 0.9, "to": 0.8, "or": 0.5, "this": 0.5}


def brute_licence(scanner, text):
    """The best cosine over all windows of all templates."""
    found, ws = None, licenses.terms(text)
    for t in scanner.templates:
        for k in range(len(ws)):
            c = scanner.cosine(t, ws[k:k + t.size])
            if c >= scanner.threshold and (found is None or (-c, t.name) < (-found[0], found[1])):
                found = (c, t.name)
    return found


def test_no_window_is_lost():
    scanner = licenses.Scanner(SHARES, 0.0001, 0.7)
    rng = random.Random(2)
    notices = [x for xs in licenses.TEMPLATES.values() for x in xs if len(x) < 400]
    for k in range(40):
        notice = " ".join(w for w in rng.choice(notices).split() if rng.random() < 0.85)
        text = prose(k, rng.randint(0, 30)) + rng.choice([" ", "\n"]) + notice + " " + prose(k + 1, rng.randint(0, 20))
        assert scanner.best(text) == brute_licence(scanner, text)


def wrapped(text, width, start):
    import textwrap

    return "\n".join(start + line for line in textwrap.wrap(text, width))


def test_headers_bodies_and_versions():
    scanner = licenses.Scanner(SHARES, 0.0001, 0.7)
    best = lambda text: (scanner.best(text) or (0, None))[1]
    for name, notices in licenses.TEMPLATES.items():
        for notice in notices:
            assert best(notice) == name
            assert best(prose(1, 20) + "\n" + wrapped(notice, 40, " * ") + "\n" + prose(2, 20)) == name  # a source header
            assert best(prose(1, 60).replace("\n", " ") + " " + notice + " " + prose(2, 60).replace("\n", " ")) == name  # in one line
    gpl = licenses.license_texts._FREE.format(kind="", v="{}")
    assert [best(gpl.format(v)) for v in (2, 3)] == ["GPL-2.0", "GPL-3.0"]
    mit, bsd = licenses.TEMPLATES["MIT"][-1], licenses.TEMPLATES["BSD-3-Clause"][2]
    assert best("Copyright (c) 2020 Somebody\n\n" + wrapped(mit, 78, "")) == "MIT"
    assert best(wrapped(bsd, 78, "")) == "BSD-3-Clause" and best(wrapped(licenses.TEMPLATES["BSD-2-Clause"][0], 78, "")) == "BSD-2-Clause"
    assert best(prose(5, 400)) is None and best("the license of the program and the work") is None


def test_licences_in_very_long_texts_and_ties(spark):
    long = prose(1, 120_000)
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, f"{long} {notice} {long}", "a/one"), (2, notice + "\nReleased under the MIT License.", "a/LICENSE"),
            (3, "Released under the MIT License.", "b/LICENSE"), (4, "Licensed under the MIT License.", "b/COPYING"),
            (5, "Licensed under CC BY 4.0.", "b/LICENCE.txt"), (6, prose(2, 9), "b/c/d.txt"), (None, None, None)]
    out = licenses.inherit(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, path string"))).collect()
    got = {r.doc_id: (r.license, r.inherited_from) for r in out}
    assert got[1] == ("Apache-2.0", None) == got[2]  # equal cosines: by name
    assert got[6] == ("CC-BY-4.0", "b") and got[None] == (None, None)


# ---- archives ----------------------------------------------------------------------

def test_archives(spark):
    big, odd = "<p>" + "é" * 600 + "</p>", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40
    rows = [(1, "http://a/x", big), (7, "http://a/y", big), (3, "https://b.c/z?q", big), (4, "u", "short"), (5, "u", "short"),
            (6, None, None), (8, "http://a/w", odd), (9, "http://a/w", odd), (9, "http://a/w", odd), (None, "http://n", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0))
    got = [tuple(r) for r in warc.round_trip(pages, file_records=7).select(
        "page_id", "payload_bytes", "record_type", "refers_to").collect()]
    n, m = len(big.encode()), len(odd)
    want = [(1, n, "revisit", 7), (7, n, "response", None), (3, n, "revisit", 7), (4, 5, "response", None),
            (5, 5, "response", None), (6, 0, "response", None), (8, m, "revisit", 9), (9, m, "response", None),
            (9, m, "response", None), (None, n, "revisit", 7)]
    assert collections.Counter(got) == collections.Counter(want)
    assert warc.round_trip(pages.where("page_id = 4")).first().payload_digest == "a0f4ea7d91495df92bbac2e2149dfb850fe81396"


def test_nested_captures_hold_the_payload(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/x", "one"), (2, "http://a/y", "zwei ü")], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    got = {r.metadata["head"]: r for r in warc.captures(warc.read(spark, str(tmp_path / "w"))).collect()}
    two = got["pageId: 2\r\n"]
    assert two.response["payload"] == "zwei ü".encode() and two.request["head"].startswith("GET /y HTTP/1.1")


def rewritten(folder, change):
    """The archives of a folder with their texts changed."""
    import gzip

    for file in folder.rglob("*.gz"):
        file.write_bytes(gzip.compress(change(gzip.decompress(file.read_bytes()))))
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def test_what_is_read_is_measured(spark, tmp_path):
    big = "<p>" + "x" * 2000 + "</p>"
    pages = spark.createDataFrame([(1, "http://a/x", big), (2, "http://a/y", big), (3, "u", "tiny")], "page_id long, url string, html string")
    import hashlib

    warc.write(pages, str(tmp_path / "a"))
    # The payload and every digest that records tell are changed alike: the result follows the payload.
    new = big.replace("xxxx", "yyyy", 1)
    old_sum, new_sum = (hashlib.sha1(t.encode()).hexdigest().encode() for t in (big, new))
    rewritten(tmp_path / "a", lambda data: data.replace(b"xxxx", b"yyyy", 1).replace(old_sum, new_sum) if b"xxxx" in data else data)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.refers_to) for r in warc.digests(warc.read(spark, str(tmp_path / "a"))).collect()}
    assert got[2] == (len(new), new_sum.decode(), None) and got[1] == (len(new), new_sum.decode(), 2)
    for name, change in (("b", lambda data: data.replace(b"xxxx", b"yyyy", 1)), ("c", lambda data: data.replace(
            b"revisit", b"revisit", 1).replace(old_sum, new_sum, 1))):
        warc.write(pages, str(tmp_path / name))
        rewritten(tmp_path / name, change)
        with pytest.raises(Exception, match="damaged archive"):
            warc.digests(warc.read(spark, str(tmp_path / name))).collect()


def test_archives_of_large_pages_and_of_none(spark, tmp_path):
    rows = [(k, "u", chr(97 + k % 26) * n) for k, n in enumerate((10, 70_000, 70_001, 1_200_000, 9_000_000, 9_000_000))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write(pages, str(tmp_path / "w"))
    got = {r.page_id: r.payload_bytes for r in warc.digests(warc.read(spark, str(tmp_path / "w"), payloads=False)).collect()}
    assert got == {k: len(t) for k, _, t in rows}
    assert len(list((tmp_path / "w").rglob(f"below-{warc.CLASSES[-1]}/*.gz"))) == 2  # one page a file
    assert warc.round_trip(pages.where("false")).count() == 0


# ---- pipeline ----------------------------------------------------------------------

def test_pipeline_against_brute_force(spark, tmp_path):
    """The stages on a small table, each checked on what the one before it kept."""
    bench = [(0, " ".join(f"item{j}word" for j in range(30)))]
    rows = [(i, f"menu home\n{prose(i, 90)}", "en", "s", 0) for i in range(30)]
    rows += [(100, f"menu home\n{prose(3, 90)}", "en", "s", 0), (101, "too short", "en", "s", 0),
             (102, prose(200, 60) + " " + bench[0][1], "en", "s", 0), (103, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=catalog.PIECE_MODEL)
    kept = {i: t.removeprefix("menu home\n") for i, t, *_ in rows if t and len(plain_words(t)) >= 20}
    prints = {i: brute_print(t) for i, t in kept.items()}
    groups = brute_groups(set(prints.values()))
    one = {min(i for i in kept if groups[prints[i]] == g) for g in set(groups.values())}
    assert out == {i: lib.encode(kept[i]) for i in one if bench[0][1] not in kept[i]}
    assert 100 not in out and 102 not in out and len(out) == 30


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls in every column, empty, repeated and very long texts, and extra columns named as those the stages make."""
    long = prose(7, 60_000)
    rows = [(1, prose(1, 90), "en", "s", 0), (1, prose(1, 90), "en", "s", 0), (2, "", "en", "s", 0), (None, prose(3, 90), None, None, None),
            (4, None, None, None, None), (5, long, "en", "t", 0), (6, "a b c", "en", "t", None)]
    names = ["n_words", "base_failed", "__row", "__host", "kept", "host", "clean", "row"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.select("*", *[F.lit("own").alias(n) for n in names]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stay = quality_rules.keep_good(spark.read.parquet(str(tmp_path / "documents.parquet")))
    assert stay.columns == [*docs.columns, *names] and stay.where("host <> 'own' or __row <> 'own'").isEmpty()
    assert sorted((r.doc_id or 0, len(r.text)) for r in stay.collect()) == sorted((i or 0, len(t)) for i, t, *_ in rows if t and len(t) > 5)
    docs.where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("name", ["op2_quality_rules", "op6_line_dedup", "op10_warc"])
def test_sql_gives_the_same(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    theirs = con.execute(catalog.ORACLE[name])
    columns = [d[0] for d in theirs.description]
    mine = [tuple(r) for r in catalog.QUERIES[name](spark, folder).select(*columns).collect()]
    assert collections.Counter(mine) == collections.Counter(theirs.fetchall())
