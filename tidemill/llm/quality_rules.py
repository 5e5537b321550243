"""Quality rules that judge whole hosts.

Every document is measured by rules. Failures are summed by host, the failure rate of each host and rule is
shrunk towards the rate of all hosts with a beta prior fitted to the hosts themselves (method of moments), and
hosts whose shrunken rate is too high are rejected. A document goes if it fails the base rule, or if its host
is rejected. DataFrame functions only: words, windows and lines of a document are arrays of its own row, so
measuring shuffles nothing; one small sum per host is shuffled.

Defined results: a null text has no words and fails the base rule; a row without a host is judged by the base
rule alone and counts for no host; repeated rows count as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import WORD, has_word, written

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rules:
    """A host is rejected when the shrunken rate of its documents failing one rule is above ``max_rate``.

    The prior counts as ``least_weight`` documents at least, so a few pages alone never condemn a host.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    max_symbols_per_100_words: int = 10
    max_dup_line_percent: int = 30
    max_rate: float = 0.5
    least_weight: float = 10.0


def _covered(places: Column) -> Column:
    """Words that the windows starting at ``places`` cover."""
    steps = F.transform(
        places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1), p + WINDOW) - p)
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def measured(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``docs`` with the measures and ``base_failed`` (columns of these names are replaced).

    Windows of words are compared by a 64-bit hash. Sorting them by hash puts equal windows side by side; the
    places of those with an equal neighbour, in order, tell how many words they cover. Steps are separate
    projections, each used by the next, so that no array is computed twice.
    """
    words = F.coalesce(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), has_word)
    step = docs.withColumns({"__words": words, "__lines": lines})
    step = step.withColumns({"__hashed": F.transform("__words", lambda w: F.xxhash64(w))})
    n = F.size("__hashed")
    step = step.withColumn("__windows", F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__hashed", i, WINDOW))),
    ))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    step = step.withColumn("__sorted", F.when(
        repeats, F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    same = lambda x, k: F.coalesce(F.get("__sorted", k)["h"] == x["h"], F.lit(False))
    step = step.withColumn("__places", F.array_sort(F.transform(
        F.filter("__sorted", lambda x, k: same(x, k + 1) | ((k > 0) & same(x, k - 1))), lambda x: x["i"]
    )))
    step = step.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.coalesce(
            F.length(F.col(text)) - F.length(F.regexp_replace(F.col(text), SYMBOLS, "")), F.lit(0)
        ).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.coalesce(_covered(F.col("__places")), F.lit(0)).cast("long"),
    }).drop("__words", "__lines", "__hashed", "__windows", "__sorted", "__places")
    return step.withColumn("base_failed", base_rule(rules))


def base_rule(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )


def failures(rules: Rules) -> dict[str, Column]:
    """What is summed by host."""
    return {
        "base": F.col("base_failed"),
        "symbols": 100 * F.col("n_symbols") > rules.max_symbols_per_100_words * F.col("n_words"),
        "dup_lines": 100 * F.col("n_dup_lines") > rules.max_dup_line_percent * F.col("n_lines"),
    }


def host_verdicts(marked: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """host, n_docs, a shrunken failure rate per rule and ``rejected``, from measured documents.

    The prior of a rule: mean m of the pooled rate, and the variance between hosts that is left after taking
    off the binomial noise, v. Its weight is m(1-m)/v - 1 documents, or the least weight if that is more; without
    variance every host gets m.
    Only these two numbers per rule pass through the driver.
    """
    fails = failures(rules)
    hosts = written(
        marked.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n_docs"), *[F.sum(c.cast("long")).alias(f"k_{r}") for r, c in fails.items()]
        ), "hosts",
    )
    rate = lambda r: F.col(f"k_{r}") / F.col("n_docs")
    moments = hosts.agg(
        F.avg(1 / F.col("n_docs")).alias("noise"),
        *[F.sum(f"k_{r}").alias(f"k_{r}") for r in fails], F.sum("n_docs").alias("n"),
        *[F.var_pop(rate(r)).alias(f"v_{r}") for r in fails],
    ).first()
    shrunk = {}
    for r in fails:
        if not moments["n"]:
            shrunk[r] = F.lit(0.0)
            continue
        m = moments[f"k_{r}"] / moments["n"]
        v = (moments[f"v_{r}"] or 0.0) - m * (1 - m) * moments["noise"]
        weight = max(m * (1 - m) / v - 1, rules.least_weight) if v > 1e-9 else None
        shrunk[r] = F.lit(m) if weight is None else (F.col(f"k_{r}") + m * weight) / (F.col("n_docs") + weight)
    return hosts.select(
        "host", "n_docs", *[c.alias(f"rate_{r}") for r, c in shrunk.items()],
        F.greatest(*[c for c in shrunk.values()]).alias("worst_rate"),
    ).withColumn("rejected", F.col("worst_rate") > rules.max_rate)


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          rules: Rules = Rules()) -> DataFrame:
    """One row per document: its id, the measures, ``base_failed``, ``kept`` and the worst rate of its host.

    The narrow measures are written once, summed by host, and joined with the verdicts of rejected hosts; the
    written sizes let the planner broadcast the verdicts, or else split a hot host.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("source"))
    marks = written(measured(narrow, "text", rules).drop("text"), "measures")
    bad = host_verdicts(marks, "source", rules).where("rejected").select(F.col("host").alias("source"), "rejected")
    joined = marks.join(bad, "source", "left")
    return joined.select(
        "doc_id", *MEASURES, "base_failed",
        (~F.col("base_failed") & F.col("rejected").isNull()).alias("kept"), "n_lines",
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The documents that ``judge`` keeps, with the columns they came with.

    Each document is measured once: the marks are written with the whole row beside them, for documents that pass the
    base rule only. The sums by host read the narrow columns; the rows are read again to meet the few rejected hosts, so
    no text is shuffled for that.
    """
    own = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text"), F.col(host).alias("__host"))
    marks = written(measured(own, "__text", rules).select(
        "__host", *MEASURES, "n_lines", "base_failed", F.when(~F.col("base_failed"), F.col("__row")).alias("__row")), "measures")
    bad = host_verdicts(marks, "__host", rules).where("rejected").select(F.col("host").alias("__host"))
    return marks.where("not base_failed").join(bad, "__host", "left_anti").select("__row.*")
