"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartweave.session import load


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.llm.pieces import split_oversized

    return split_oversized(load(spark, d, "clinical_note"), "row_id", "text", limit=2000, least=1000, overlap=200)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.llm.near_duplicates import similar_rows, title_and_text

    notes = load(spark, d, "clinical_note")
    pairs = similar_rows(notes, "row_id", title_and_text(F.col("title"), F.col("text")), words=3, threshold=0.7)
    return pairs.select(F.col("a").alias("row_id_a"), F.col("b").alias("row_id_b"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.llm.pii import find_items

    return find_items(spark, load(spark, d, "clinical_note"), "row_id", ["text", "author"], load(spark, d, "staff_roster"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.llm.tokens import encode_corpus

    return encode_corpus(load(spark, d, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.llm.leaks import leaked_items

    leaks = leaked_items(spark, load(spark, d, "documents"), "doc_id", "text", load(spark, d, "eval_passage"), "item_id", "passage", run=12, seed=6)
    return leaks.where(F.col("longest") >= 12).select("doc_id", "item_id")


def p8_scored(spark: SparkSession, d: str) -> DataFrame:
    """Edited and paraphrased copies, too: what shares six rare 4-word seeds and aligns with the score of 20 words in common or more."""
    from chartweave.llm.leaks import leaked_items

    leaks = leaked_items(spark, load(spark, d, "documents"), "doc_id", "text", load(spark, d, "eval_passage"), "item_id", "passage", run=8, seed=4, edited=6)
    return leaks.where(F.col("score") >= 40).select("doc_id", "item_id", "score", "longest")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.llm.encodings import garbled_texts

    return garbled_texts(spark, load(spark, d, "documents"), "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p2_found, p3_found, p4_found, p7_ids, p8_found, p8_scored, p9_found)}


def _last(pattern: str, back: int) -> str:
    """End of the last match in the window of a piece that starts at s, null if there is none."""
    at = f"length(regexp_extract(substring(text, s + {1001 - back}, {1000 + back}), '(?s)^.*{pattern}'))"
    return f"case when {at} > {back} then s + {1000 - back} + {at} end"


_END = f"case when length(text) - s <= 2000 then length(text) else coalesce({_last(r'\n\r?\n', 2)}, {_last(r'\n', 0)}, {_last('[.!?] ', 1)}, {_last(r'[ \t]', 0)}, s + 2000) end"
_WORDS = r"'[\p{L}\p{N}]+'"

SQL: dict[str, str] = {
    "p2_found": f"""
with recursive p as (
  select row_id, text, s, {_END} as e from (select row_id, text, cast(0 as bigint) as s from clinical_note where length(text) > 2000)
  union all
  select row_id, text, s, {_END} from (select row_id, text, e - 200 as s from p where e < length(text)))
select row_id, s as char_start, cast(e as bigint) as char_end from p""",
    "p3_found": f"""
with w as (select row_id, regexp_extract_all(lower(case when title is null then text else title || ' ' || text end), {_WORDS}) as w from clinical_note where regexp_matches(text, '\\S')),
s as (select distinct row_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from w, unnest(range(1, len(w) - 1)) t(i)),
n as (select row_id, count(*) as n from s group by 1),
p as (select a.row_id as x, b.row_id as y, count(*) as k from s a join s b on a.g = b.g and a.row_id < b.row_id group by all)
select x as row_id_a, y as row_id_b from p join n a on a.row_id = x join n b on b.row_id = y where k >= 0.7 * (a.n + b.n - k) - 1e-9""",
    "p8_found": f"""
with d as (select doc_id, regexp_extract_all(lower(text), {_WORDS}) as w from documents),
g as (select distinct doc_id, array_to_string(w[i:i + 11], ' ') as g from d, unnest(range(1, len(w) - 10)) t(i)),
e as (select item_id, regexp_extract_all(lower(passage), {_WORDS}) as w from eval_passage),
h as (select distinct item_id, array_to_string(w[i:i + 11], ' ') as g from e, unnest(range(1, len(w) - 10)) t(i))
select distinct doc_id, item_id from g join h on g.g = h.g""",
}
