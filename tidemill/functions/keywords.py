"""Splitting search phrases into words."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD_RUN = r"[\p{L}\p{N}]+"


def keyword_split(text: Column | str) -> Column:
    """Array of lower-case words, null for null text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(f"({WORD_RUN})"), 1)


def word_list_split(words: Iterable[str]):
    """Longest-match splitter for scripts written without spaces (an Arrow UDF).

    A run is first split where the script changes; only its Han parts are cut by the list, the other parts
    are words already. The list is a broadcast variable: each executor holds it once, whatever its length.
    """
    known = frozenset(w.lower() for w in words)
    shared = SparkSession.getActiveSession().sparkContext.broadcast((known, max(map(len, known), default=1)))
    scripts = regex.compile(r"\p{Han}+|\P{Han}+")

    def cut(run: str) -> list[str]:
        known, longest = shared.value
        out = []
        for part in scripts.findall(run):
            if not regex.match(r"\p{Han}", part):
                out.append(part)
                continue
            i = 0
            while i < len(part):
                step = next((n for n in range(min(longest, len(part) - i), 1, -1) if part[i:i + n] in known), 1)
                out.append(part[i:i + step])
                i += step
        return out

    @F.pandas_udf("array<string>")
    def split(runs: pd.Series) -> pd.Series:
        return runs.map(lambda rs: None if rs is None else [w for r in rs for w in cut(r)])

    return split


def word_pattern(words: Iterable[str], letters: str = r"\p{IsHan}") -> str:
    """A pattern whose matches cut a lower-case text by a word list: longest match from the left.

    Words that consist of ``letters`` (a character class) count; a letter that begins none is a word alone, and runs of
    other word characters stay whole. The list is a tree of its beginnings, so a place in the text is compared
    with one letter of each branch and not with every word.
    """
    whole, tree = regex.compile(f"(?:{letters})+"), {}
    for word in words:
        if whole.fullmatch(word.lower()):
            node = tree
            for letter in word.lower():
                node = node.setdefault(letter, {})
            node[""] = {}

    def branches(node: dict) -> str:
        parts = [regex.escape(c, special_only=True) + branches(below) for c, below in sorted(node.items()) if c]
        if not parts:
            return ""
        one = parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
        return f"(?:{one})?" if "" in node else one  # greedy: the longest is tried first

    listed = [branches(tree)] if tree else []
    return "|".join([*listed, letters, f"[\\p{{L}}\\p{{N}}&&[^{letters}]]+"])


def listed_words(words: Iterable[str], letters: str = r"\p{IsHan}"):
    """Splitter of word runs by a word list, in columns alone; for lists of some ten thousand words (longer ones: ``word_list_split``)."""
    pattern = F.lit(word_pattern(words, letters))
    return lambda runs: F.flatten(F.transform(runs, lambda run: F.regexp_extract_all(run, pattern, 0)))


def create_split_function(
    spark: SparkSession, name: str = "split_words", words: Iterable[str] = (), letters: str = r"\p{IsHan}"
) -> None:
    """Make a table function of SQL for this session: one row ``word`` per word of a phrase, none for a null one.

    ``select t.id, w.word from t, lateral split_words(t.phrase) w``
    """
    if not name.isidentifier():
        raise ValueError("the name of a function is one identifier")
    pattern = word_pattern(words, letters).replace("\\", "\\\\").replace("'", "\\'")
    runs = f"regexp_extract_all(lower(phrase), '{pattern}', 0)"
    spark.sql(f"create or replace temporary function {name}(phrase string) returns table(word string) "
              f"return select col as word from explode({runs})")


def explode_words(df: DataFrame, text: str, word: str = "word", splitter=None) -> DataFrame:
    """One row per word of ``text``; the other columns are kept."""
    words = keyword_split(text)
    if splitter is not None:
        words = splitter(words)
    return df.select("*", F.explode(words).alias(word))
