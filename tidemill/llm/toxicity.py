"""Toxicity of texts: a bag of subword vectors, averaged, into a linear softmax.

A word is the mean of the vectors of its character n-grams (with word ends marked) and a passage of about
``PASSAGE`` words the mean of its words; a linear softmax gives the label. Vectors and softmax are trained together in
numpy on a bounded sample of labelled documents (``SAMPLE`` of each class, chosen by a hash of the id, of at most ``LONGEST``
characters each; documented bounds): first on all passages with the label of their document, then on the worst passage of
each. A text scores by a logistic regression on its worst passage, the mean of its ``TOP`` worst ones, the average of the whole
text and its number of words: an average alone hides a few words in a long text. The regression is fitted on a fifth of
the sample that the vectors have not seen. The sample is the only
thing that reaches the driver. Unseen misspellings share n-grams with words that were seen.

Scoring uses all documents and all their passages. As the average and the softmax are linear up to the last step, a
word's share of the logit is one number; tasks keep those of words they have met.

Defined results: null and empty texts get the score of an average of nothing (the bias); without labelled rows of
both classes every score is the share of label 1 (0 without any); rows of equal doc_id in the labels: a document
counts as toxic if one of them says so; repeated documents are scored each.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import slices

SAMPLE = 2_000
LONGEST = 65_536
PASSAGE = 2
TOP = 4
LEAST_SHARE = 0.005  # of the sample must hold an n-gram
BUCKETS = 1 << 18
WIDTH = 4
GRAMS = (3, 5)
ROUNDS = (12, 28)  # on all passages, then on the worst ones
RATE = 0.1
SCALE = 16.0
KNOWN = 400_000
SHRINK = 0.1
WORDS = re.compile(r"\w{1,64}")  # a longer run of letters is several words, so a text without blanks counts whole


def tokens(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def grams(word: str) -> set[str]:
    """Character n-grams of a word with its ends marked, and the word itself."""
    marked = f"<{word}>"
    out = {marked[i:i + n] for n in range(GRAMS[0], GRAMS[1] + 1) for i in range(len(marked) - n + 1)}
    out.add(marked)
    return out


def bucket(gram: str) -> int:
    return xxhash.xxh32_intdigest(gram.encode("utf-8", "surrogatepass")) % BUCKETS


def buckets(word: str) -> list[int]:
    return [bucket(g) for g in sorted(grams(word))]


def passages(n: int) -> np.ndarray:
    """Bounds that cut n words into passages of about equal length."""
    return np.linspace(0, n, max(round(n / PASSAGE), 1) + 1).astype(np.int64)


class Model:
    """``share``: what a bucket adds to the logit of label 1; ``slopes`` and ``bias`` turn a text's features to a logit."""

    def __init__(self, share: np.ndarray, bias: float, slopes: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0)):
        self.share, self.bias, self.slopes = share, bias, slopes
        self.known: dict[str, float] = {}
        self.met: dict[str, float] = {}

    def word(self, word: str) -> float:
        """Mean share of the n-grams of a word; n-grams that were met are kept, as words are."""
        found = grams(word)
        try:
            return sum(map(self.met.__getitem__, found)) / len(found)
        except KeyError:
            if len(self.met) > KNOWN:
                self.met.clear()
            for g in found:
                if g not in self.met:
                    self.met[g] = float(self.share[bucket(g)])
            return sum(map(self.met.__getitem__, found)) / len(found)

    def words(self, found: list[str]) -> np.ndarray:
        shares = np.fromiter(map(self.known.get, found, repeat(np.nan)), dtype=np.float64, count=len(found))
        unknown = np.flatnonzero(np.isnan(shares)).tolist()
        if unknown:
            if len(self.known) > KNOWN:
                self.known.clear()
            for i in unknown:
                w = found[i]
                if w not in self.known:
                    self.known[w] = self.word(w)
                shares[i] = self.known[w]
        return shares

    def features(self, found: list[str]) -> tuple[float, float, float, float]:
        """Worst passage average, mean of the ``TOP`` worst, average of the text, logarithm of its length.

        A word counts once in a passage, whose average is over all its words.
        """
        if not found:
            return 0.0, 0.0, 0.0, 0.0
        shares = self.words(found) * SCALE
        bounds = passages(len(found))
        sizes = np.diff(bounds)
        once, owner = shares.copy(), np.repeat(np.arange(len(sizes)), sizes)
        for d in range(1, int(sizes.max())):  # equal words have equal shares
            for i in np.flatnonzero((shares[d:] == shares[:-d]) & (shares[d:] != 0) & (owner[d:] == owner[:-d])).tolist():
                if found[i] == found[i + d]:
                    once[i + d] = 0.0
        scores = np.add.reduceat(once, bounds[:-1]) / sizes
        top = min(TOP, len(scores))
        return (float(scores.max()), float(np.partition(scores, len(scores) - top)[-top:].mean()), float(shares.mean()),
                float(np.log1p(len(found))))

    def score(self, text: str | None) -> float:
        logit = sum(a * b for a, b in zip(self.slopes, self.features(tokens(text)))) + self.bias
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def _once(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a word is the first of its kind in its passage."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    once = np.ones(len(ids), dtype=bool)
    for d in range(1, int(np.diff(bounds).max())):
        once[d:] &= (ids[d:] != ids[:-d]) | (owner[d:] != owner[:-d])
    return once


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray, seed: int = 7) -> Model:
    """Train vectors and softmax together by full-batch Adam on the passages of the sample.

    Only the difference of the two classes' logits matters, and it is a sum over n-grams: it is summed up as such,
    and the vectors of words and passages are never laid out.
    """
    place: dict[str, int] = {}
    ids, shares, passage, owner, total = [], [], [], [], 0
    for k, t in enumerate(texts):
        ws = tokens(t)
        if not ws:
            continue
        bounds = passages(len(ws))
        found = np.fromiter((place.setdefault(w, len(place)) for w in ws), dtype=np.int32, count=len(ws))
        once, sizes = _once(found, bounds), np.diff(bounds)
        of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        ids.append(found[once])
        shares.append((SCALE / sizes).astype(np.float32)[of[once]])
        passage.append(of[once] + total)
        owner.append(np.full(len(sizes), k, dtype=np.int32))
        total += len(sizes)
    if not ids:
        return Model(np.zeros(BUCKETS), 0.0)
    words_, share, passage, owner = map(np.concatenate, (ids, shares, passage, owner))
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    widths = np.diff(np.append(starts, total))
    weights = weights / weights.sum()
    even = (weights / np.maximum(np.bincount(owner, minlength=len(texts)), 1))[owner]
    heavy, target = weights[owner], labels[owner]
    packed, lengths = array("i"), array("i")
    for w in place:
        found = buckets(w)
        packed.extend(found)
        lengths.append(len(found))
    flat, sizes = np.frombuffer(packed, dtype=np.int32), np.frombuffer(lengths, dtype=np.int32).astype(np.int64)
    word_of = np.repeat(np.arange(len(place), dtype=np.int32), sizes)
    # N-grams of a few documents alone would only be learnt by heart: they stay out of the averages.
    met = np.unique(words_.astype(np.int64) * len(texts) + owner[passage]) // len(texts)
    spread = np.bincount(flat, weights=np.bincount(met, minlength=len(place))[word_of], minlength=BUCKETS)
    least = max(LEAST_SHARE * len(texts), 3)
    common = spread[flat] >= least
    flat, word_of = flat[common], word_of[common]
    inverse = (1 / sizes)[word_of]  # an average over all n-grams of the word, rare ones counting as zero
    used, flat = np.unique(flat, return_inverse=True)
    rng = np.random.default_rng(seed)
    params = {"vectors": rng.normal(0, 0.1, (len(used), WIDTH)), "out": rng.normal(0, 0.1, (WIDTH, 2)), "bias": np.zeros(2)}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    rounds = sum(ROUNDS)
    for step in range(1, rounds + 1):
        way = params["out"][:, 1] - params["out"][:, 0]
        word = np.bincount(word_of, (params["vectors"] @ way)[flat] * inverse, len(place))
        gap = np.bincount(passage, word[words_] * share, total) + params["bias"][1] - params["bias"][0]
        if step > ROUNDS[0]:  # the passage of each document that the model finds worst
            top = np.flatnonzero(gap == np.repeat(np.maximum.reduceat(gap, starts), widths))
            worst = top[np.concatenate(([True], owner[top[1:]] != owner[top[:-1]]))]
            use = np.zeros(total)
            use[worst] = heavy[worst]
        else:
            use = even
        error = (1 / (1 + np.exp(-np.clip(gap, -60, 60))) - target) * use
        to_word = np.bincount(words_, error[passage] * share, len(place))
        to_bucket = np.bincount(flat, to_word[word_of] * inverse, len(used))
        turn = params["vectors"].T @ to_bucket
        grads = {
            "vectors": to_bucket[:, None] * way, "out": np.stack((-turn, turn), axis=1),
            "bias": error.sum() * np.array([-1.0, 1.0]),
        }
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            rate = RATE * (1 - 0.9 * step / rounds)
            params[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-9)
    whole = np.zeros(BUCKETS, dtype=np.float64)
    whole[used] = params["vectors"] @ (params["out"][:, 1] - params["out"][:, 0])
    return Model(whole, float(params["bias"][1] - params["bias"][0]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents of each class that are not held out, weighted to their true shares."""
    marked = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
    marked = marked.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    shares = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    n = sum(shares.values())
    if not shares.get(0) or not shares.get(1):
        p = shares.get(1, 0) / n if n else 0.0
        return Model(np.zeros(BUCKETS), 500.0 if p == 1 else -500.0)
    order = F.xxhash64("doc_id")
    chosen = None
    for k in (0, 1):  # at most 2 x sample ids
        part = marked.where(F.col("label") == k).orderBy(order, "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    short = texts.where(F.length("text") <= LONGEST)
    rows = short.join(F.broadcast(chosen), "doc_id").orderBy(order, "doc_id").limit(2 * sample).collect()
    if len({r["label"] for r in rows}) < 2:
        return Model(np.zeros(BUCKETS), float(np.log(shares[1] / shares[0])))
    y = np.array([r["label"] for r in rows])
    weights = np.where(y == 1, shares[1] / max((y == 1).sum(), 1), shares[0] / max((y == 0).sum(), 1))
    texts, spare = [r["text"] for r in rows], np.arange(len(rows)) % 5 == 0
    own = ~spare if len({*y[spare].tolist()}) == 2 == len({*y[~spare].tolist()}) else np.ones(len(y), dtype=bool)
    model = fit([t for t, o in zip(texts, own) if o], y[own], weights[own])
    # Slope and bias come from the part of the sample that was not trained on.
    rest = ~own if len(y) > own.sum() else own
    return calibrated(model, [t for t, r in zip(texts, rest) if r], y[rest], weights[rest])


def calibrated(model: Model, texts: list[str], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Logistic regression of the label on the features of a text, by Newton steps with a little shrinkage."""
    x = np.array([model.features(tokens(t)) for t in texts])
    spot, size = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.concatenate(((x - spot) / size, np.ones((len(x), 1))), axis=1)
    w, theta = weights / weights.mean(), np.zeros(z.shape[1])
    shrink = np.array([SHRINK] * x.shape[1] + [0.01])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        grad = z.T @ (w * (p - labels)) + shrink * theta
        hess = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(shrink)
        theta -= np.clip(np.linalg.solve(hess, grad), -2, 2)
    slopes = theta[:-1] / size
    return Model(model.share, float(theta[-1] - slopes @ spot), tuple(slopes.tolist()))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``score`` of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.share, model.bias, model.slopes))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in slices(batches, "text"):
            scores = [own.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per document."""
    return scored(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
