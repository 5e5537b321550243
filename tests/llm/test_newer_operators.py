"""Main text, conversation repair and spelling variants against brute force, on held-out layouts and on hard rows."""

from __future__ import annotations

import collections
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import boosting, catalog, layouts, main_text, repair, spelling
from tidemill.llm.dom import Blocks

# ---- spelling variants -------------------------------------------------------------

SCHEMA = "doc_id long, text string, word string, n long, near string, key string"


def brute_words(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


def brute_variants(rows):
    count = brute_words(rows)
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, vs in near.items():
        if vs and count[best := min(vs, key=lambda v: (-count[v], v))] >= 5 * count[w]:
            form[w] = best
    out = set()
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, count[w], len(near[w]), count[form[w]] if w in form else None))
    return out


@pytest.fixture(scope="module")
def words():
    """Words that differ at ends, middle, doubled letters and accents, chains of forms, ties, and one very long word."""
    rng = random.Random(4)
    base = ["summer", "garden", "letter", "bookkeeper", "aaaaaaa", "übergröße", "straßen", "ÀÉTUDES", "mississippi", "z" * 3000]
    counts = collections.Counter()
    for b in base:
        counts[b] += 130
        for k in range(6):
            i, c = rng.randrange(len(b) + 1), rng.choice("aesß")
            for v in (b[:i] + c + b[i:], b[:i] + b[i + 1:], b[:i] + c + b[i + 1:]):
                counts[v] += rng.choice([1, 5, 26])
    counts.update({"wonder": 250, "wondery": 40, "wonderyy": 6})
    rows, doc = [], 0
    for w, n in counts.items():
        for _ in range(n):
            rows.append((doc // 20, w.upper() if doc % 7 == 0 and w.isascii() else w))
            doc += 1
    rows.sort()
    joined = collections.defaultdict(list)
    for d, w in rows:
        joined[d].append(w)
    return [(d, " - ".join(ws)) for d, ws in joined.items()] + [(None, "garden Garden x " * 9), (7, None), (8, ""), (9, "summer\n" * 9), (9, "summer\n" * 9)]


@pytest.mark.parametrize("most", [spelling.MOST, 3])
def test_variants_equal_brute_force(spark, words, most):
    df = spark.createDataFrame([(d, t, "x", 1, "y", "z") for d, t in words], SCHEMA).repartition(3)
    got = [tuple(r) for r in spelling.variants(df, most).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_variants(words)
    assert any(f and r != f for _, f, r, *_ in got)  # a chain of forms


def test_no_words_no_variants(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "short words only", "", 1, "", "")], SCHEMA)).count() == 0


def test_index_finds_every_word_with_one_error():
    rng = random.Random(1)
    held = sorted({"".join(rng.choices("abc", k=rng.randint(6, 9))) for _ in range(400)})
    index = spelling.Index([w.encode("latin-1") for w in held])
    size = np.array([len(w) for w in held])
    place, word, put_in = spelling.one_error(index, [w.encode("latin-1") for w in held], size - size // 2)
    got = collections.Counter(zip(place.tolist(), word.tolist()))
    want = {(i, j) for i, a in enumerate(held) for j, b in enumerate(held) if one_edit(a, b) and len(b) - len(a) in (0, 1)
            and any(a[len(a) // 2:] == b[k:] for k in [len(b) - (len(a) - len(a) // 2)])}
    assert set(got) == want and set(got.values()) == {1}


# ---- conversation repair -----------------------------------------------------------

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def brute_conversation(rows):
    """Least (cost, audit) by trying all edits row by row."""
    seen, faults, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        kept = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = 0 if not kept else 1 if (role, text) in seen else 2 if kept[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        faults.append((fault, bool(kept) and kept[-1] not in ".!?"))

    def put(into, state, cost, audit, out):
        if state is not None and (state not in into or (cost, audit) < into[state][:2]):
            into[state] = (cost, audit, out)

    def insert(into):
        for _ in range(4):
            for q, (c, a, o) in list(into.items()):
                for role in ("user", "assistant"):
                    put(into, NEXT.get((q, role[0])), c + 2, a + "I", o + [(role, "")])

    best = {0: (0, "", [])}
    insert(best)
    for (_, role, text), (fault, cut) in zip(rows, faults):
        new = {}
        for q, (c, a, o) in best.items():
            put(new, q, c + 3, a + "D", o)
            if fault not in (0, 1):
                put(new, NEXT.get((q, role[:1])), c + cut, a + "K", o + [(role, text)])
                for r in ("user", "assistant"):
                    put(new, NEXT.get((q, r[0])), c + 2 + cut, a + "R", o + [(r, text)])
        insert(new)
        best = new
    cost, audit, out = min(best[q] for q in (0, 3) if q in best)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def brute_repair(rows):
    found = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest())
    return {c: brute_conversation(sorted(rs, key=order)) for c, rs in found.items()}


def talk(seed, conv, n, turns=None):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", None, "user ", "Assistant"]
    out = []
    for k in range(n):
        role = ["user", "assistant"][k % 2] if rng.random() < 0.7 else rng.choice(roles)
        text = rng.choice(["Yes.", "no", "Why? ", " \n", "", None, f"Answer {k}.", f"cut {k}", f"So {k}!\t", "é. ñ?"])
        out.append((conv, rng.choice(turns) if turns else k, role, text))
    return out


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TALK = "conv_id long, turn long, role string, text string, kind string, rows string, big string"


def talks():
    rows = [r for c in range(60) for r in talk(c, c, c % 13 + 1)]
    rows += talk(90, None, 9) + talk(91, 91, 8, [None]) + talk(92, 92, 12, [1, 2, None, 7]) + talk(93, 93, 90, [3, 4])
    rows += [(94, 0, "user", "w " * 200000 + "."), (94, 1, "assistant", "x" * 100000)] + [(95, 1, "user", "Same.")] * 40
    return rows + [(96, k, "system", "Only system.") for k in range(9)] + [(97, 10 ** 12, "user", "Far."), (97, -5, "assistant", "Early.")]


def repaired(spark, rows, *limits):
    df = spark.createDataFrame([(*r, "k", "r", "b") for r in rows], TALK).repartition(3)
    found = repair.repair(df, *limits).collect()
    out = {r.conv_id: tuple(r[c] for c in RESULT) for r in found}
    assert len(out) == len(found)
    return out


@pytest.mark.parametrize("most", [repair.MOST, 6, 0])
def test_repair_equals_brute_force(spark, most):
    assert repaired(spark, talks(), most) == brute_repair(talks())


def test_a_conversation_over_many_segments(spark):
    rows = talk(5, 1, 1500) + talk(6, 2, 20) + [(3, 0, "user", "Same.")] * 700
    want = brute_repair(rows)
    assert repaired(spark, rows, 100) == want and repaired(spark, rows) == want
    assert repaired(spark, rows, repair.MOST, 1000) == want  # too many characters


def test_segments_of_any_length_give_one_audit(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 2)
    rows = [r for c in range(40) for r in talk(c + 500, c, c)]
    assert repaired(spark, rows, 0) == brute_repair(rows)


def test_no_conversations(spark):
    assert repair.repair(spark.createDataFrame([], TALK)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_prices_are_distances(seed):
    rng = random.Random(seed)
    for _ in range(60):
        symbols = "".join(rng.choices("DsuaoSUAO", k=rng.randint(0, 150)))
        lattice = repair.Lattice(symbols)
        cost = lattice.solve()[0]
        audit, _ = lattice.trace()
        price = {"K": 0, "R": 2, "D": 3, "I": 2}
        own = iter(symbols)
        total = sum(price[x] + (x != "I" and next(own).isupper() and x != "D") for x in audit)
        assert total == cost and next(own, None) is None
        assert all(lattice.price[v] <= lattice.best(v)[0] for v in range(4 * len(symbols) + 4) if lattice.price[v] < repair.FAR)


# ---- main text ---------------------------------------------------------------------

def page_texts(pages, model):
    blocks = Blocks()
    for p in pages:
        blocks.add(p)
    return main_text.texts(blocks, model)


def scores(pages, model):
    """Precision and recall by characters."""
    blocks, labels = main_text.labelled(pages)
    kept = main_text.decode(blocks, model.log_shares(main_text.features(blocks)))
    size = np.array([len(t) for t in blocks.text])
    mine, kept = labels == main_text.ARTICLE, np.array(kept)
    return (size * (mine & kept)).sum() / (size * kept).sum(), (size * (mine & kept)).sum() / (size * mine).sum()


def test_new_pages_of_known_layouts():
    precision, recall = scores(layouts.pages(200, seed=77), main_text.train())
    assert precision > 0.98 and recall > 0.99


@pytest.mark.parametrize("layout", ["main", "soup", "table"])
def test_layouts_never_seen(layout):
    rest = tuple(k for k in layouts.LAYOUTS if k != layout)
    precision, recall = scores(layouts.pages(100, seed=78, layouts=(layout,)), main_text.train(300, rest))
    assert precision > 0.9 and recall > 0.9


def test_no_contradictions():
    blocks, _ = main_text.labelled(layouts.pages(40, seed=3))
    rng = np.random.default_rng(0)
    shares = np.log(rng.dirichlet([0.3] * 3, len(blocks.tag)))
    kept = main_text.decode(blocks, shares)
    for k, p in enumerate(blocks.parent):
        assert kept[k] or not kept[p] or p == k


def test_decoding_is_the_best_assignment():
    blocks = Blocks()
    blocks.add("<div>a<p>b</p><section>c<p>d</p></section></div>")
    n = len(blocks.tag)
    rng = np.random.default_rng(2)
    for _ in range(50):
        shares = np.log(rng.dirichlet([0.5] * 3, n))

        def best(k, up):  # (score, texts) of the subtree under a parent's choice
            options = [up] if up != 2 else [0, 1] + [2] * bool(blocks.tag[k])
            below = [c for c in range(n) if blocks.parent[c] == k and c != k]
            found = []
            for o in options if k else [2]:
                parts = [best(c, o) for c in below]
                found.append((shares[k, o] + sum(s for s, _ in parts), [k] * (o == 1) + [x for _, t in parts for x in t]))
            return max(found)

        assert [k for k in range(n) if main_text.decode(blocks, shares)[k]] == sorted(best(0, 2)[1])


def test_reader():
    blocks = Blocks()
    blocks.add("<body><P>One&nbsp; &amp;\n two<br>three<p>Four <b>five<!-- x --> six</p><script>var a='</p>'</script>"
               "<ul><li>a<li>b <a href=x>link</a></ul><td>cell<textarea><p>no</textarea><p title='a>b'>last &#x41;")
    assert [t for t in blocks.text if t] == ["One & two three", "Four five six", "a", "b link", "cell", "last A"]
    assert blocks.tag[blocks.parent[blocks.text.index("b link")]] == "li" and max(blocks.linked) == 4
    for bad in ("", "<", "<p", "</p></div>", "<!-- open", "<script>x", "<a href='x>y", "&#xFFFFFF;&bogus;", "<div>" * 3000 + "deep"):
        blocks.add(bad)
    assert len(blocks.pages) == 10 and blocks.text[-1] == "deep"


def test_pages_with_everything_around_the_article(spark):
    article = ["Title of it", "First <b>paragraph</b>, which is long enough to look like prose &amp; says so.", "Short.", "Second one, with a few more words in it."]
    inner = f"<h1>{article[0]}</h1>" + "".join(f"<p>{p}</p>" for p in article[1:])
    around = ('<header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>'
              '<div class="cookie-notice"><p>We use cookies, and this is a notice about them all.</p></div>')
    after = ('<aside class="sidebar"><h3>Related</h3><ul><li><a href="/x">Other story</a></li></ul></aside>'
             '<section class="comments"><h3>Comments</h3><div class="comment"><p>I agree with every word of this text.</p></div></section>'
             '<form class="search"><label>Search</label><input><button>Go</button></form><footer>&copy; example</footer>')
    want = "\n\n".join(html.unescape(re.sub("<.*?>", "", p)) for p in article)
    long = "".join(f"<p>Paragraph number {k} of a very long page, with some words.</p>" for k in range(20000))
    rows = [(1, "u", f"<html><body>{around}<article>{inner}</article>{after}</body></html>", "x", 3),
            (2, "u", f"<body>{around}<div class='post-content'>{inner}</div>{after}", "x", 3),
            (3, "u", None, "x", 3), (3, None, "", "x", 3), (None, None, inner, None, None),
            (4, "u", f"<body>{around}<article>{long}</article>{after}", "x", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long").repartition(2)
    out = main_text.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in out.collect()), key=lambda r: r[:3])
    assert [g[:3] for g in got[:5]] == [(0, "", want), (1, "u", want), (2, "u", want), (3, "", ""), (3, "u", "")]
    assert got[5][2].count("\n\n") == 19999 and all(n == len(t) for *_, t, n in got)
    assert main_text.extract(df.limit(0)).count() == 0


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    rows = rng.random((3000, 5))
    labels = (rows[:, 0] > 0.5).astype(int) + ((rows[:, 1] > 0.7) & (rows[:, 0] > 0.5))
    model = boosting.fit(rows[:2000], labels[:2000], 3, rounds=15, depth=3)
    assert (model.logits(rows[2000:]).argmax(axis=1) == labels[2000:]).mean() > 0.97
    assert np.allclose(np.exp(model.log_shares(rows)).sum(axis=1), 1)


# ---- SQL ---------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_main_text", "op12_conversation_repair", "op13_spelling_variants"])
def test_sql_gives_the_same(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    theirs = con.execute(catalog.ORACLE[name])
    columns = [d[0] for d in theirs.description]
    mine = [tuple(r) for r in catalog.QUERIES[name](spark, folder).select(*columns).collect()]
    assert collections.Counter(mine) == collections.Counter(theirs.fetchall())
