"""Evidence packets: blocks of text with their headers, token totals and a ceiling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartweave.functions.text import estimated_tokens, is_blank

CEILING = 200_000
DASH = "—"


def block_header(rank: Column, chunk_id: Column, title: Column, doc_type: Column, date: Column, author: Column, linked: Column, source: Column, record: Column, chunk: Column, score: Column) -> Column:
    """One line that names a block, as prompts refer to it; a dash stands for what is missing."""
    show = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(DASH))
    named = [F.concat(F.lit("[Evidence "), rank.cast("string")), F.concat(F.lit("chunk_id="), show(chunk_id))]
    named += [F.concat(F.lit(f"{n}="), show(c)) for n, c in (("title", title), ("doc_type", doc_type), ("date", date), ("author", author), ("linked_author", linked))]
    named += [show(source), F.concat(F.lit("record "), show(record)), F.concat(F.lit("chunk "), show(chunk)), F.concat(F.lit("score "), show(score.cast("decimal(18,3)")), F.lit("]"))]
    return F.concat_ws(" | ", *named)


def blocks(candidates: DataFrame, rank: str = "final_rank", text: str = "text", direct: DataFrame | None = None) -> DataFrame:
    """Candidates as blocks ``rendered`` with ``tokens``; those without text are dropped.  ``direct`` blocks (the same columns)
    come before them (``ord`` 0 and 1).  ``linked_author``, ``record_index`` and ``chunk_index`` may be missing."""
    every = candidates.withColumn("ord", F.lit(1))
    if direct is not None:
        every = direct.withColumn("ord", F.lit(0)).unionByName(every)
    c = lambda n: F.col(n) if n in every.columns else F.lit(None)
    header = block_header(F.col(rank), *map(c, ("chunk_id", "title", "doc_type", "document_date", "author", "linked_author", "source", "record_index", "chunk_index", "score")))
    made = every.where(~is_blank(F.col(text))).withColumn("rendered", F.concat(header, F.lit("\n"), F.col(text)))
    return made.withColumn("tokens", estimated_tokens(F.col("rendered")))


def tokens_by_type(made: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, doc_type, tokens)``; no type is ``unknown``."""
    return made.groupBy(*by, F.coalesce("doc_type", F.lit("unknown")).alias("doc_type")).agg(F.sum("tokens").alias("tokens"))


def packets(made: DataFrame, by: list[str], rank: str = "final_rank", ceiling: int = CEILING) -> DataFrame:
    """One row per group: the text of its blocks in order, how many, the total and ``status`` (ok or over_ceiling; nothing is
    cut).  A packet is bounded by the candidates' limit before it, not by the corpus."""
    item = F.struct("ord", rank, "rendered", "tokens")
    out = made.groupBy(*by).agg(F.sort_array(F.collect_list(item)).alias("__b"), F.sum("tokens").alias("total_tokens"), F.count("*").alias("n_blocks"))
    out = out.withColumn("packet", F.array_join(F.transform("__b", lambda b: b["rendered"]), "\n\n")).drop("__b")
    return out.withColumn("status", F.when(F.col("total_tokens") > ceiling, "over_ceiling").otherwise("ok"))


def refused(packed: DataFrame) -> DataFrame:
    """The packets, or an error as soon as one is over the ceiling."""
    return packed.withColumn("status", F.when(F.col("status") == "over_ceiling", F.raise_error(F.lit("an evidence packet is over its ceiling"))).otherwise(F.col("status")))


def combined_packets(per_row: DataFrame, by: list[str]) -> DataFrame:
    """Totals of the packets of several rows; the ceiling holds for each row, not for their sum."""
    return per_row.groupBy(*by).agg(F.sum("total_tokens").alias("total_tokens"), F.sum("n_blocks").alias("n_blocks"), F.count("*").alias("n_packets"), F.bool_and(F.col("status") == "ok").alias("all_ok"))
