"""Licence scan: sparse TF-IDF against templates, and inheritance from the nearest ancestor directory.

Headers, titles and bodies of licences are templates; terms are lower-case words and version numbers, which count
``NUMBER`` times as they tell siblings apart. A term's weight falls with the share of documents that hold it (counted
over all of them). A template is held against every window of as many terms as it has, wherever the window begins:
notices wrapped over lines, within a long line, or a licence file without its title are found alike. Windows without any
of a template's anchors could at most reach a lower cosine than the threshold; they are passed over without scoring, and so
are documents without anchors, whose texts stay in the JVM. The best template of a document's windows is its
own licence; a file named as a licence file passes it on to the directory it lies in. A document without a licence
takes that of its nearest ancestor directory, found by joining the ancestors of its path with the licensed
directories.

Defined results: null and empty texts have no notice; of several notices the best cosine counts, then the template
name; several licence files in one directory: the same order decides; rows without a path inherit nothing; repeated
rows are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm import license_texts
from tidemill.llm.common import slices, written

TEMPLATES = license_texts.TEMPLATES
THRESHOLD = 0.7
NUMBER = 2.0
# The same terms for Python and the JVM: runs of letters and digits, and what version numbers go on with.
TERMS = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
JVM_TERMS = r"[\p{L}\p{N}]+(?:\.[0-9]+)*"
WANTED = sorted({t for notices in TEMPLATES.values() for n in notices for t in TERMS.findall(n.lower())})


def terms(line: str) -> list[str]:
    return TERMS.findall(line.lower())


class Template:
    def __init__(self, name: str, found: list[str], scanner: Scanner):
        self.name, self.size = name, len(found)
        raw = {t: n * scanner.weight(t) for t, n in Counter(found).items()}
        self.norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
        self.vector = {t: w / self.norm for t, w in raw.items()}
        self.anchors: set[str] = set()
        rest = 0.0  # the lightest terms, as long as all of them together stay below the threshold
        for t, w in sorted(self.vector.items(), key=lambda x: (x[1], x[0])):
            if math.sqrt(rest + w * w) < scanner.threshold:
                rest += w * w
            else:
                self.anchors.add(t)


class Scanner:
    """Weighted templates, and what a window must hold to be worth scoring."""

    def __init__(self, share: dict[str, float], unseen: float, threshold: float):
        self.share, self.unseen, self.threshold = share, unseen, threshold
        self.templates = [
            Template(name, terms(notice), self) for name, notices in sorted(TEMPLATES.items()) for notice in dict.fromkeys(notices)]
        self.anchors: set[str] = set().union(*(t.anchors for t in self.templates))

    def weight(self, term: str) -> float:
        idf = -math.log(self.share.get(term, self.unseen)) + 0.1
        return idf * NUMBER if term[0].isdigit() else idf

    def cosine(self, template: Template, window: list[str]) -> float:
        raw = {t: n * self.weight(t) for t, n in Counter(window).items()}
        norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
        return round(sum(w * template.vector[t] for t, w in raw.items() if t in template.vector) / norm, 6)

    def best(self, text: str) -> tuple[float, str] | None:
        """The best cosine over the windows of a text, and its template."""
        number: dict[str, int] = {}
        numbers = array("i", (number.setdefault(m.group(), len(number)) for m in TERMS.finditer(text.lower())))
        if self.anchors.isdisjoint(number):
            return None
        ids, names = np.frombuffer(numbers, dtype=np.int32), list(number)
        weights = np.array([self.weight(t) for t in names])
        squares = np.concatenate(([0.0], np.cumsum(weights[ids] ** 2)))
        found = None
        for template in self.templates:
            here = [number[t] for t in template.anchors if t in number]
            if not here:
                continue
            size = template.size
            at = np.flatnonzero(np.isin(ids, here))
            starts = np.unique((at[:, None] - np.arange(min(size, int(at[-1]) + 1))[None, :]).ravel()) if len(at) * size < 1 << 20 else (
                np.arange(len(ids)))
            starts = starts[starts >= 0]
            stops = np.minimum(starts + size, len(ids))
            shares = np.array([template.vector.get(t, 0.0) for t in names]) * weights
            dots = np.concatenate(([0.0], np.cumsum(shares[ids])))
            # A window is at least as long as if each of its terms came once.
            most = (dots[stops] - dots[starts]) / np.sqrt(squares[stops] - squares[starts])
            for k in np.argsort(-most, kind="stable").tolist():
                least = self.threshold if found is None else found[0]
                if most[k] < least - 1e-6:
                    break
                value = self.cosine(template, [names[i] for i in ids[starts[k]:stops[k]].tolist()])
                if value >= self.threshold and (found is None or (-value, template.name) < (-found[0], found[1])):
                    found = (value, template.name)
        return found


def present(text: Column) -> Column:
    """The template terms that a text holds."""
    return F.array_intersect(F.regexp_extract_all(F.lower(text), F.lit(JVM_TERMS), F.lit(0)), F.array(*map(F.lit, WANTED)))


def term_shares(docs: DataFrame, text: str = "text") -> tuple[dict[str, float], float]:
    """Share of all documents that hold each template term (a bounded list), and the share given to other terms."""
    rows = docs.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(present(F.col(text)), F.array()))).alias("term"))
    counts = {r["term"]: r["count"] for r in rows.groupBy("term").count().collect()}
    n = counts.pop("", 0)
    return {t: (c + 1) / (n + 2) for t, c in counts.items()}, 1 / (n + 2)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "path",
         threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, own ``license`` and its ``similarity`` (null without a notice)."""
    share, unseen = term_shares(docs, text)
    anchors = sorted(Scanner(share, unseen, threshold).anchors)
    worth = F.arrays_overlap(present(F.col(text)), F.array(*map(F.lit, anchors)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(path).alias("path"), F.when(worth, F.col(text)).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(share, unseen, threshold)
        for batch in slices(batches, "text"):
            found = [scanner.best(t) if t else None for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("path"),
                pa.array([f and f[1] for f in found], pa.string()), pa.array([f and f[0] for f in found], pa.float64()),
            ], names=["doc_id", "path", "license", "similarity"])

    return rows.mapInArrow(run, f"doc_id {kind}, path string, license string, similarity double")


def ancestors_of(directory: str) -> Column:
    """A directory and those above it, nearest first, as an array of (directory, steps up); the root is empty."""
    parts = F.filter(F.split(F.col(directory), "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.size(parts), F.lit(0), F.lit(-1)),
        lambda n: F.struct(F.array_join(F.slice(parts, 1, n), "/").alias("directory"), (F.size(parts) - n).alias("up")),
    )


def inherit(scanned: DataFrame, is_licence_file: str = r"(^|/)(LICENSE|LICENCE|COPYING)(\.\w+)?$") -> DataFrame:
    """doc_id, path, license, similarity and ``inherited_from`` (the directory, null for an own notice).

    Paths are narrow. Files without a notice meet licensed directories by each directory above them; directories
    are distinct first, so a directory with a third of all files is looked up once.
    """
    files = written(scanned, "scanned")
    split = files.withColumn("directory", F.regexp_replace("path", r"(^|/)[^/]*$", ""))
    order = F.struct((-F.col("similarity")).alias("cosine"), "license")
    licensed = written(
        split.where(F.col("license").isNotNull() & F.col("path").rlike(is_licence_file))
        .groupBy(F.col("directory").alias("held")).agg(F.min(order).alias("best"))
        .select("held", F.col("best.license").alias("given")), "licensed")
    places = split.where("license is null and path is not null").select("directory").distinct().select(
        "directory", F.explode(ancestors_of("directory")).alias("step"))
    nearest = places.join(licensed, F.col("step.directory") == F.col("held")).groupBy("directory").agg(
        F.min(F.struct("step.up", "held", "given")).alias("near")).select("directory", "near.held", "near.given")
    own = split.where("license is not null or path is null").select(
        "doc_id", "path", "license", "similarity", F.lit(None).cast("string").alias("inherited_from"))
    rest = split.where("license is null and path is not null").join(nearest, "directory", "left").select(
        "doc_id", "path", F.col("given").alias("license"), "similarity", F.col("held").alias("inherited_from"))
    return own.unionByName(rest)
