"""Recipes run over a corpus: their steps in order for every group (patient, source) at once, as DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.functions.text import is_blank
from chartweave.operators import packing, ranking, retrieval
from chartweave.operators.chunks import rendered_row
from chartweave.plans import filters
from chartweave.plans.filters import Filter
from chartweave.plans.recipes import HANDLERS, Provider, Recipe, Step, last_answer, planned
from chartweave.session import cut_lineage

#: What a step's result holds beside the group.
RESULT = ["data", "ok", "error", "rejected", "calls", "input_tokens"]


@dataclass(frozen=True)
class Corpus:
    """``groups``: one row per group; ``docs``: ``chunk_id, text, title, doc_type, document_date, author, source`` and the
    group; ``tables``: name -> (rows with the group, their id column)."""

    group: str
    groups: DataFrame
    docs: DataFrame
    tables: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)


def table_part(corpus: Corpus, name: str, settings: dict) -> tuple[DataFrame, str, list[str]]:
    """A table's rows under ``filter``, ``columns`` and ``max_rows`` with their ``__text``: blank rows are left out, then each
    group keeps its first ``max_rows`` by id."""
    if name not in corpus.tables:
        raise ValueError(f"no table {name!r}; known: {sorted(corpus.tables)}")
    df, row_id = corpus.tables[name]
    kept = df.where(retrieval.clause(df, settings["filter"])) if settings.get("filter") else df
    columns = [c for c in dict.fromkeys(settings.get("columns") or df.columns) if c in df.columns and c not in (corpus.group, row_id)]
    out = kept.select(corpus.group, row_id, *columns).withColumn("__text", rendered_row(columns)).where(~is_blank(F.col("__text")))
    if settings.get("max_rows") is not None:
        out = retrieval.ranked(out, [corpus.group], [F.asc(row_id)], int(settings["max_rows"])).drop("rank")
    return out, row_id, columns


def evidence(corpus: Corpus, live: DataFrame, settings: dict) -> DataFrame:
    """Retrieved, filtered, reranked and packed: ``(group, packet, shown)``, null where a group has no evidence.  Rows of
    ``also_include_tables`` come first; a table that isn't there is left out."""
    g, r = corpus.group, settings["retrieval"]
    docs, query, k, own = corpus.docs.join(live.select(g), g, "left_semi"), r.get("query"), int(r.get("k", 10)), r.get("query_from")
    one = {"bm25": retrieval.bm25, "exact": retrieval.exact}
    if own and own not in live.columns:
        raise ValueError(f"query_from: no earlier step or recipe {own!r}")
    if own:  # each group asks what an earlier step or recipe answered for it
        asked = live.select(g, F.col(own).alias("__query"))
        found = retrieval.bm25_queries(docs, g, "chunk_id", "text", asked, g, "__query", k)
    elif r["kind"] == "hybrid":
        names, deep = r.get("members", ["bm25", "exact"]), retrieval.member_depth(k)
        members, _ = retrieval.run_members([(n, lambda n=n: one[n](docs, g, "chunk_id", "text", query, deep)) for n in names], cut_lineage)
        found = retrieval.fused(members, [g], k, r.get("method", "reciprocal_rank"), r.get("weights"))
    else:
        found = one[r["kind"]](docs, g, "chunk_id", "text", query, k)
    found = found.join(docs, [g, "chunk_id"])
    found = found.join(asked, g) if own else found
    if settings.get("filters"):
        found = filters.kept(found, [Filter(f["field"], f["op"], f["value"], f.get("keep_if_missing", False)) for f in settings["filters"]], filters.KINDS)
    over = settings.get("reranking", {})
    found = ranking.rerank(found, [g], F.col("__query") if own else F.lit(query), "text", "doc_type", "document_date", int(over.get("top_n", k)), chronological=bool(over.get("chronological_order")))
    columns = list(dict.fromkeys([g, "chunk_id", "text", "title", "doc_type", "document_date", "author", "source", "score", "final_rank", "read_pos"]))
    found, direct = found.withColumn("chunk_id", F.col("chunk_id").cast("string")).select(*columns), None
    for at, spec in enumerate(settings.get("also_include_tables", [])):
        if spec["name"] not in corpus.tables:
            continue
        rows, row_id, _ = table_part(corpus, spec["name"], spec)
        rows = retrieval.ranked(rows.join(live.select(g), g, "left_semi"), [g], [F.asc(row_id)])
        none = F.lit(None).cast("string")
        made = {"chunk_id": F.concat_ws(":", F.col(g).cast("string"), F.lit(spec["name"]), F.col(row_id).cast("string"), F.lit("TABLE")), "text": F.col("__text"), "title": none, "doc_type": F.lit("builder_table"), "document_date": none, "author": none, "source": F.lit(spec["name"]), "score": F.lit(1.0), "final_rank": F.col("rank"), "read_pos": F.lit(at) * 1_000_000_000 + F.col("rank")}
        made[g] = F.col(g)
        part = rows.select(*(made[c].alias(c) for c in columns))
        direct = part if direct is None else direct.unionByName(part)
    made = packing.blocks(found, direct=direct)
    shown = made.groupBy(g).agg(F.sort_array(F.collect_list("chunk_id")).alias("shown"))
    return live.select(g).join(packing.packets(made, [g], "read_pos").join(shown, g), g, "left").select(g, "packet", "shown")


def _listed(rows: DataFrame, g: str, row_id: str, item: list[str], answers: bool) -> DataFrame:
    """Rows of a group as one JSON list in the order of their ids."""
    n = [F.bool_and("ok").alias("ok"), F.max("error").alias("error"), F.sum("rejected").alias("rejected"), F.sum("calls").alias("calls"), F.sum("input_tokens").alias("input_tokens")] if answers else []
    listed = F.to_json(F.transform(F.sort_array(F.collect_list(F.struct(F.col(row_id).alias("__id"), F.struct(row_id, *item).alias("__row")))), lambda x: x["__row"]))
    return rows.groupBy(g).agg(listed.alias("data"), *n)


def step_result(corpus: Corpus, live: DataFrame, step: Step, provider: Provider | None) -> DataFrame:
    """``(group, *RESULT)`` of one step, a row for each live group; without evidence or rows the data are null."""
    g, s, run = corpus.group, step.settings, HANDLERS[step.kind]
    if step.kind == "retrieve_and_prompt":
        out = run(evidence(corpus, live, s), [g], s, provider)
    elif step.kind == "llm_only":
        out = run(live, [g], s, provider)
    else:
        rows, row_id, columns = table_part(corpus, s["table"], s)
        rows = rows.drop("__text").join(live.select(g), g, "left_semi")
        if step.kind == "map_table_rows_and_prompt":
            out = _listed(run(rows, [g, row_id], s, provider), g, row_id, ["data"], True)
        else:
            made = run(rows, [g, row_id], {k: v for k, v in s.items() if k != "filter"} | {"columns": columns} if step.kind == "direct_parquet" else s)
            out = _listed(made, g, row_id, [c for c in made.columns if c not in (g, row_id)], False)
    out = live.select(g).join(out, g, "left")
    fill = {"data": F.nullif("data", F.lit("null")), "ok": F.lit(True), "error": F.when(F.col("data").isNull(), "empty_evidence"), "rejected": F.lit(0), "calls": F.lit(0), "input_tokens": F.lit(0)}
    return out.select(g, *((F.coalesce(F.col(c), fill[c]) if c in out.columns and c not in ("data", "error") else F.col("error") if c == "error" and "error" in out.columns else fill[c]).alias(c) for c in RESULT))


def run_recipes(recipes: dict[str, Recipe], requested: list[str], corpus: Corpus, provider: Provider | None, keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> tuple[DataFrame, DataFrame]:
    """``(steps, answers)`` of the requested recipes and those they depend on, in the order of ``planned``.

    ``steps`` has a row per group, recipe and step: ``status`` is complete, failed, stopped (its ``stop_if`` held, so the later
    steps are ``skipped``) or skipped.  ``stop_if`` is a SQL condition over the result, earlier steps' answers by step id and
    the answers of the recipes it depends on by name; a failed step isn't judged.  ``answers`` has the last answer that any
    step gave.  Every step's result is kept (a checkpoint), so that no model is asked twice for one.
    """
    order, missing = planned(recipes, requested)
    if missing:
        raise ValueError(f"no recipes {missing}")
    g, log, answers = corpus.group, None, {}
    for name in order:
        recipe, mine = recipes[name], None
        live = corpus.groups.select(g)
        for d in recipe.depends_on:
            live = live.join(answers[d].select(g, F.col("data").alias(d)), g, "left")
        for n, step in enumerate(recipe.steps):
            result = keep(step_result(corpus, live, step, provider))
            after = live.join(result, g)
            go = filters.stop_gate(after, f"ok and ({step.settings['stop_if']})") if step.settings.get("stop_if") else after
            status = F.when(F.col("ok").isNull(), "skipped").when(~F.col("ok"), "failed").when(F.col("__on").isNull(), "stopped").otherwise("complete")
            seen = corpus.groups.select(g).join(result, g, "left").join(go.select(g, F.lit(True).alias("__on")), g, "left")
            part = seen.select(g, F.lit(name).alias("recipe"), F.lit(n).alias("ord"), F.lit(step.id).alias("step"), F.lit(step.kind).alias("kind"), status.alias("status"), *RESULT)
            mine = part if mine is None else mine.unionByName(part)
            live = keep(go.withColumnRenamed("data", step.id).drop(*[c for c in RESULT if c != "data"]))
        mine = keep(mine)
        answers[name] = last_answer(mine, [g, "recipe"], "ord", "data", "step")
        log = mine if log is None else log.unionByName(mine)
    every = None
    for a in answers.values():
        every = a if every is None else every.unionByName(a)
    return log, every
