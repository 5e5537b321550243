"""The operators as queries over a folder of tables, with production parameters, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm import (
    decontaminate, licenses, line_dedup, main_text, oracles, pieces, quality_rules, repair, sentence_spans, simhash_pivots, spelling,
    token_edits, toxicity, warc,
)
from tidemill.llm.common import table

TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
BYTE_RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("n_lines")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits per document, at a quarter, half and three quarters of it."""
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    at = lambda k: F.floor(n * k / 4)
    change = lambda start, stop, insert: F.struct(
        start.alias("start"), stop.alias("stop"), F.lit(insert).alias("insert"))
    edits = F.array(
        change(at(1), at(1) + 7, "edited "), change(at(2), at(2) + 11, ""), change(at(3), at(3), " and one more sentence."))
    return token_edits.edited(table(spark, sf_dir, "documents"), token_edits.read_ranks(BYTE_RANKS), edits)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivots.labelled(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths come from the table: source and language, then blocks of ids; each block's first file is its LICENSE."""
    key = F.col("doc_id")
    block, part = F.floor(key / 1024), F.floor(key / 32) % 32
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.concat(F.lit("b"), block.cast("string")))
    leaf = F.concat_ws("/", top, F.concat(F.lit("p"), part.cast("string")))
    path = F.when(key % 1024 < 32, F.concat(top, F.lit("/LICENSE."), key.cast("string"))).otherwise(
        F.concat(leaf, F.when(key % 32 < 2, "/LICENSE.").otherwise("/text."), key.cast("string")))
    docs = table(spark, sf_dir, "documents").withColumn("path", path)
    return licenses.inherit(licenses.scan(docs))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "row.source", "n_lines", "n_dropped", F.col("clean").alias("text"))


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.without_repeats(table(spark, sf_dir, "documents"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.read_model(PIECE_MODEL))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def _reachable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Python workers import this package too: name the folder it lies in."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _reachable(q) for q in (
        op1_decontaminate, op2_quality_rules, op3_token_counts, op4_simhash, op5_licenses, op6_line_dedup,
        op7_sentence_spans, op8_pieces, op9_toxicity, op10_warc, op11_main_text, op12_conversation_repair,
        op13_spelling_variants,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op11_main_text": oracles.MAIN_TEXT,
    "op12_conversation_repair": oracles.REPAIR,
    "op13_spelling_variants": oracles.SPELLING,
    "op2_quality_rules": rf"""
with d as (
  select row_number() over () as rid, doc_id, source, text, {_WORDS} as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents),
win as (
  select rid, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') as w
  from (select rid, words, unnest(range(1, len(words) - 6)) as i from d where len(words) >= 8)),
rep as (select rid, i, count(*) over (partition by rid, w) as n from win),
cov as (select rid, count(distinct i + k) as n from rep, (select unnest(range(0, 8)) as k) where n > 1 group by rid),
m as (
  select d.rid, doc_id, source, len(words)::bigint as n_words,
         coalesce(length(array_to_string(words, '')), 0)::bigint as word_chars,
         (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         len(lines) as n_lines, coalesce(cov.n, 0)::bigint as n_repeat_words
  from d left join cov using (rid)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m),
h as (
  select source, count(*) as n, sum(base_failed::int) as k1, sum((100 * n_symbols > 10 * n_words)::int) as k2,
         sum((100 * n_dup_lines > 30 * n_lines)::int) as k3
  from b where source is not null group by source),
r as (
  select source, n, unnest([1, 2, 3]) as rule, unnest([k1, k2, k3]) as k from h),
p as (
  select rule, sum(k) / sum(n) as m,
         var_pop(k / n) - sum(k) / sum(n) * (1 - sum(k) / sum(n)) * avg(1 / n) as v
  from r group by rule),
s as (
  select source, max(case when v > 1e-9
    then (k + m * greatest(m * (1 - m) / v - 1, 10)) / (n + greatest(m * (1 - m) / v - 1, 10)) else m end) > 0.5 as rejected
  from r join p using (rule) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce(rejected, false) as kept
from b left join s using (source)""",
    "op6_line_dedup": r"""
with d as (select row_number() over () as rid, doc_id, source, text, string_split(text, chr(10)) as lines from documents),
t as (select source, count(*) as pages from d where source is not null group by source),
c as (
  select source, line, count(*) as n
  from (select distinct rid, source, unnest(lines) as line from d where source is not null)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by source, line),
x as (select source, list(line) as gone from c join t using (source) where n >= 3 and n > 0.1 * pages group by source)
select doc_id, source, coalesce(len(lines), 0)::bigint as n_lines,
       (coalesce(len(lines), 0) - coalesce(len(list_filter(lines, lambda l: gone is null or not list_contains(gone, l))), 0))::bigint
         as n_dropped,
       case when text is not null then coalesce(array_to_string(
         list_filter(lines, lambda l: gone is null or not list_contains(gone, l)), chr(10)), '') end as text
from d left join x using (source)""",
    "op10_warc": """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
         sha1(coalesce(html, '')) as payload_digest from pages),
l as (
  select payload_digest, max(page_id) as last from p where payload_bytes >= 1000 group by payload_digest having count(*) > 1)
select page_id, payload_bytes, payload_digest,
       case when last is not null and page_id is distinct from last then 'revisit' else 'response' end as record_type,
       case when last is not null and page_id is distinct from last then last end as refers_to
from p left join l using (payload_digest)""",
}
