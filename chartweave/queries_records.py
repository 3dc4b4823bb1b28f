"""Further registered queries of the core: sources and sinks, files, recipes, checks and comparisons, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartweave.functions import dates, text
from chartweave.operators import answers, chunks, deid, evaluation, ingest, intervals, packing, ranking, retrieval, runs, validation
from chartweave.plans import filters, recipes
from chartweave.plans.filters import Filter
from chartweave.queries import _WILSON, _bm25, _docs, query
from chartweave.session import load, scratch
from chartweave.sources import readers, sinks

# --- sources and sinks ---

_CELLS = ["row_id", "patient_id", "date_of_birth", "comment", "language", "zipcode", "smoking_hx"]
_NULLS = "('', 'NA', 'N/A', 'n/a', 'na', 'null', 'NULL', 'None', 'none', 'nan', 'NaN', 'NAN')"
_READ = ", ".join(f"case when cast({c} as varchar) not in {_NULLS} then cast({c} as varchar) end as {c}" for c in _CELLS)


@query(f"select {_READ} from demographics")
def source_csv(spark: SparkSession, d: str) -> DataFrame:
    """Written as CSV and read as text: null spellings are no value."""
    path = scratch(spark, "csv")
    load(spark, d, "demographics").select(*_CELLS).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return readers.read_source(spark, path + "/*.csv")


@query(r"""select cast(row_id as varchar) as row_id, title, case when text <> '' then text end as text from clinical_note where text is not null and title is not null""")
def source_csv_multiline(spark: SparkSession, d: str) -> DataFrame:
    """Texts with line ends and quotes come back as they were."""
    path = scratch(spark, "notes_csv")
    n = load(spark, d, "clinical_note").where(F.col("text").isNotNull() & F.col("title").isNotNull()).select("row_id", "title", "text")
    n.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_source(spark, path + "/*.csv")


@query(f"select {_READ} from demographics")
def source_jsonl(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "jsonl")
    load(spark, d, "demographics").select(*_CELLS).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return readers.read_json(spark, path, lines=True).select(*_CELLS)


@query(f"select {_READ} from demographics")
def source_xlsx(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "xlsx")
    table = load(spark, d, "demographics").select(*_CELLS)
    sinks.write_workbook({"demographics": table}, table.limit(0), path + ".xlsx")
    return readers.read_source(spark, path + ".xlsx")


@query("select row_id, patient_id, medication, start_date from med_orders")
def source_parquet(spark: SparkSession, d: str) -> DataFrame:
    """The table sink, read again; its record tells the rows."""
    path = scratch(spark, "parquet")
    sinks.write_table(load(spark, d, "med_orders").select("row_id", "patient_id", "medication", "start_date"), path)
    return readers.read_source(spark, path + "/*.parquet")


@query("select count(*) as rows, 3 as columns, count(*) filter (medication is null) as no_medication from med_orders")
def sink_table_record(spark: SparkSession, d: str) -> DataFrame:
    """The metadata row of a written table."""
    path, o = scratch(spark, "recorded"), load(spark, d, "med_orders").select("row_id", "patient_id", "medication")
    sinks.write_table(o, path)
    none = spark.read.parquet(path).agg(F.count_if(F.col("medication").isNull()).alias("no_medication"))
    return sinks.table_record(spark, path).select("rows", "columns", F.lit(none.first().no_medication).cast("long").alias("no_medication"))


@query("""with f as (select distinct cast(row_id % 10 as varchar) as patient_id, 'table' || row_id % 3 as stem, case row_id % 2 when 0 then 'csv' else 'json' end as extension from demographics)
select patient_id, stem, min(extension) as extension from f group by all""")
def source_discover(spark: SparkSession, d: str) -> DataFrame:
    """One file per patient folder and stem; csv goes before json."""
    path, r = scratch(spark, "charts"), F.col("row_id")
    files = load(spark, d, "demographics").select((r % 10).cast("string").alias("p"), F.concat(F.lit("table"), r % 3).alias("stem"), F.when(r % 2 == 0, "csv").otherwise("json").alias("ext")).distinct()
    sinks.touch(spark, files.select(F.concat_ws("/", F.lit(path), "p", F.concat_ws(".", "stem", "ext")).alias("path"), F.lit("x\n").alias("content")))
    return readers.discovered(spark, path).select("patient_id", "stem", "extension")


@query("select event_type, count(*) filter (event_id % 10 <> 3) as rows from events group by 1")
def sink_compaction(spark: SparkSession, d: str) -> DataFrame:
    """JSON-lines shards, a tenth of the lines broken, as one table."""
    from pyspark.sql import types as T

    path, e = scratch(spark, "shards"), load(spark, d, "events")
    line = F.when(F.col("event_id") % 10 == 3, "{broken").otherwise(F.to_json(F.struct("event_id", "event_type")))
    e.select(line.alias("value")).write.mode("overwrite").text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    sinks.compacted(spark, path, schema, path + "_table")
    return spark.read.parquet(path + "_table").groupBy("event_type").agg(F.count("*").alias("rows"))


@query("select user_id, event_type, count(*) as n from events group by all")
def sink_log(spark: SparkSession, d: str) -> DataFrame:
    """Two writers append to one log; entries that both wrote count once."""
    path, e = scratch(spark, "log"), load(spark, d, "events").select("event_id", "user_id", "event_type")
    sinks.append_log(e.where(F.col("event_id") % 3 < 2), path, "a")
    sinks.append_log(e.where(F.col("event_id") % 3 > 0), path, "b")
    return runs.state_counts(runs.merged_log([spark.read.parquet(path).drop("writer")]), "user_id", "event_type")


@query("select query_id, variable, item_id from eval_passage")
def source_gold(spark: SparkSession, d: str) -> DataFrame:
    path, e = scratch(spark, "gold"), load(spark, d, "eval_passage")
    lines = F.explode(F.array(F.lit("# a comment"), F.lit("  "), F.to_json(F.struct("query_id", "variable", "item_id"))))
    e.select(lines.alias("value")).write.mode("overwrite").text(path)
    return readers.read_gold(spark, path, "query_id string, variable string, item_id long")


@query("""select row_id, case when row_id % 4 = 3 then null when row_id % 2 = 0 then 'second ' || row_id else null end as response from med_orders""")
def sink_response_cache(spark: SparkSession, d: str) -> DataFrame:
    """The latest entry of a key counts; one of another model, or none, is a miss."""
    path, o, r = scratch(spark, "cache"), load(spark, d, "med_orders"), F.col("row_id")
    cache = sinks.ResponseCache(spark, path)
    key = F.sha2(r.cast("string"), 256).alias("key")
    spark.createDataFrame([], cache.SCHEMA).write.mode("overwrite").parquet(path)
    some = o.where(r % 4 != 3)
    cache.put(some.select(key, F.lit("m1").alias("fingerprint"), F.concat(F.lit("first "), r).alias("response"), F.lit(1).cast("long").alias("seq")))
    cache.put(some.select(key, F.when(r % 2 == 0, "m1").otherwise("m2").alias("fingerprint"), F.concat(F.lit("second "), r).alias("response"), F.lit(2).cast("long").alias("seq")))
    return cache.get(o.select("row_id", key, F.lit("m1").alias("fingerprint"))).select("row_id", "response")


# --- ingest ---


@query(r"""
with f as (select patient_id, 't' || row_id % 3 as stem, case when row_id % 7 = 0 then 'ValueError' end as error, row_id % 3 = 0 as has_text, row_id % 2 as odd from clinical_note where patient_id is not null qualify row_number() over (partition by patient_id, row_id % 3 order by row_id) = 1),
p as (select distinct patient_id from demographics where patient_id is not null union select distinct patient_id from f)
select patient_id, 'no_files' as issue, null as file, true as blocking, null as detail from p where patient_id not in (select patient_id from f)
union all select distinct patient_id, 'missing_required_file', 't1', true, null from f where patient_id not in (select patient_id from f where stem = 't1')
union all select patient_id, 'unreadable', stem, true, error from f where error is not null
union all select distinct patient_id, 'no_text_to_embed', null, true, null from f where patient_id not in (select patient_id from f where error is null and has_text)
union all select patient_id, 'metadata_column_not_found', stem, false, case odd when 1 then 'age, encounter_id, linked_author, title, specialty' else 'age, encounter_id, author, linked_author, title, specialty' end from f where error is null
union all select patient_id, 'ambiguous_columns', stem, false, 'date' from f where error is null and odd = 1""")
def ingest_file_issues(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    n = load(spark, d, "clinical_note").where(F.col("patient_id").isNotNull()).withColumn("stem", F.concat(F.lit("t"), r % 3))
    first = n.groupBy("patient_id", "stem").agg(F.min("row_id").alias("row_id"))
    names = F.when(r % 2 == 1, F.array(F.lit("Date"), F.lit("date "), F.lit("TYPE"), F.lit("Author"))).otherwise(F.array(F.lit("note date"), F.lit("type")))
    files = first.select("patient_id", "stem", F.when(r % 7 == 0, "ValueError").alias("error"), (r % 3 == 0).alias("has_text"), names.alias("columns"))
    people = load(spark, d, "demographics").select("patient_id").where(F.col("patient_id").isNotNull()).unionByName(files.select("patient_id"))
    return ingest.file_issues(files, people, "patient_id", ["t1"], ["text"], "has_text")


@query("""
with t as (select row_id, source_text_sha256 as h from chunk_index), c as (
  select case when comment in ('', 'NA', 'N/A', 'n/a', 'na', 'null', 'NULL', 'None', 'none', 'nan', 'NaN', 'NAN') then null else comment end as comment,
         case when language in ('', 'NA', 'N/A', 'n/a', 'na', 'null', 'NULL', 'None', 'none', 'nan', 'NaN', 'NAN') then null else language end as language, row_id from demographics)
select row_id, comment, language from c where (comment is not null or language is not null) and row_id not in (select row_id from t where row_id is not null)""")
def ingest_builder_table(spark: SparkSession, d: str) -> DataFrame:
    """An upstream table is cleaned; rows that were taken in before are left out."""
    table = load(spark, d, "demographics").select("row_id", "comment", "language")
    return ingest.normalised_table(table, "row_id", [], load(spark, d, "chunk_index"), "row_id").select("row_id", "comment", "language")


@query("select distinct m.patient_id, case when true then 'quarantine' end as action from med_admin m where m.patient_id not in (select patient_id from chunk_index where patient_id is not null)")
def ingest_orphaned_charts(spark: SparkSession, d: str) -> DataFrame:
    """Administrations of patients without any indexed chunk: here there are some."""
    derived = load(spark, d, "med_admin").select("patient_id").where(F.col("patient_id").isNotNull()).distinct()
    return ingest.orphans(derived, load(spark, d, "chunk_index"), ["patient_id"])


@query("select chunk_id, case when parent_tokens <= 0 then 0 when parent_tokens <= 300 then 1 else cast(ceil((parent_tokens - 300) / 250.0) as int) + 1 end as windows from chunk_index")
def chunk_window_count(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "chunk_index").select("chunk_id", chunks.window_count(F.col("parent_tokens"), 300, 50).alias("windows"))


# --- retrieval and filters ---


@query(r"""
with q as (select query_id as qid, unnest(regexp_extract_all(lower(query_text), '([a-z0-9]+)')) as word from (select query_id, min(query_text) as query_text from eval_passage group by 1)),
qw as (select qid, word, count(*) as times from q group by all),
t as (select lang, doc_id, regexp_extract_all(lower(text), '([a-z0-9]+)') as toks from documents where lang is not null),
z as (select lang, count(*) as n, avg(coalesce(len(toks), 0)) as avgdl from t group by 1),
e as (select lang, doc_id, len(toks) as dl, unnest(toks) as word from t),
f as (select lang, word, count(distinct doc_id) as df from e group by all),
i as (select f.lang, word, df, n, avgdl, ln(n - df + 0.5) - ln(df + 0.5) as raw from f join z on f.lang = z.lang),
m as (select lang, avg(raw) as mean from i group by 1),
w as (select i.lang, i.word, avgdl, case when raw < 0 then 0.25 * mean else raw end as idf from i join m on m.lang = i.lang where i.word in (select word from qw)),
c as (select lang, doc_id, dl, word, count(*) as tf from e where word in (select word from qw) group by all),
s as (select qid, c.lang, c.doc_id, sum(times * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))) as score from c join w on w.lang = c.lang and w.word = c.word join qw on qw.word = c.word group by all),
r as (select *, cast(row_number() over (partition by qid, lang order by round(score, 9) desc, doc_id) as int) as rank from s where score > 0)
select qid as query_id, lang, doc_id as chunk_id, rank, round(score, 6) as score from r where rank <= 5""")
def retrieve_bm25_queries(spark: SparkSession, d: str) -> DataFrame:
    """Every question of the held-out items in every language, as one plan."""
    asked = load(spark, d, "eval_passage").groupBy("query_id").agg(F.min("query_text").alias("query_text"))
    out = retrieval.bm25_queries(_docs(spark, d), "lang", "doc_id", "text", asked, "query_id", "query_text", 5)
    return out.select("query_id", "lang", "chunk_id", "rank", F.round("score", 6).alias("score"))


_ASKED = [round(((7 * i) % 13 - 6) / 10, 1) for i in range(64)]


@query(f"""with {_bm25()},
v as (select d.source, d.doc_id as chunk_id, list_dot_product(cast(e.embedding as double[]), {_ASKED}::double[]) as score from documents d join embeddings e on e.vec_id = d.doc_id where d.source is not null),
vr as (select *, row_number() over (partition by source order by round(score, 9) desc, chunk_id) as rank from v),
u as (select source, chunk_id, 1.0::double / (60 + rank) as part, 0 as o from rk where rank <= 20 union all select source, chunk_id, 1.0::double / (60 + rank), 1 from vr where rank <= 20),
g as (select source, chunk_id, sum(part) as score, case when min(o) = 0 then 'bm25' else 'embedding' end as retriever from u group by all),
h as (select *, cast(row_number() over (partition by source order by round(score, 9) desc, chunk_id) as int) as rank from g)
select source, chunk_id, rank, round(score, 6) as score, retriever from h where rank <= 10""")
def retrieve_hybrid_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The default hybrid, keyword and vector search, built from a configuration."""
    from chartweave.queries import QUESTION

    ask = retrieval.build_retriever({"kind": "hybrid", "k": 10})
    vectors = load(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    out = ask(_docs(spark, d), "source", "doc_id", "text", QUESTION, vectors=(vectors, "embedding", _ASKED), keep=None)
    return out.select("source", "chunk_id", "rank", F.round("score", 6).alias("score"), "retriever")


@query("select chunk_id, lower(trim(doc_type)) as kind from chunk_index where lower(trim(doc_type)) in (select lower(trim(doc_type)) from chunk_index where doc_type is not null group by 1 order by count(*) desc, 1 limit 2) or nullif(trim(doc_type), '') is null")
def filter_in(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "chunk_index")
    kind = F.lower(F.trim("doc_type"))
    top = [r.k for r in c.where(F.col("doc_type").isNotNull()).groupBy(kind.alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "k").limit(2).collect()]
    return filters.kept(c, [Filter("doc_type", "in", [f" {t.upper()} " for t in top], True)]).select("chunk_id", kind.alias("kind"))


@query(r"""
with v as (select row_id, nullif(trim("date"), '') as x from clinical_note), d as (select *, try_cast(regexp_extract(x, '^(\d{4}-\d{2}-\d{2})(?:$|[T ])', 1) as date) as day from v)
select row_id, coalesce(lower(x) = 'may 2023', false) as verbatim, coalesce(case when x is null then null when day is null then null else day >= date '2023-01-01' end, false) as since from d""")
def filter_unparseable(spark: SparkSession, d: str) -> DataFrame:
    """What is no date is compared verbatim by ==, and answers nothing by >=."""
    n = load(spark, d, "clinical_note").select("row_id", F.col("date").alias("document_date"))
    x = filters.field_value("document_date")
    ask = lambda f: F.coalesce(F.when(x.isNotNull(), filters.answer(f)), F.lit(False))
    return n.select("row_id", ask(Filter("document_date", "==", "May 2023")).alias("verbatim"), ask(Filter("document_date", ">=", "2023-01-01")).alias("since"))


@query("""
with p as (select row_id, try_cast(substr(trim(start_date), 1, 10) as date) as a, try_cast(substr(trim(end_date), 1, 10) as date) as b from med_orders), o as (select * from p where a <= b)
select x.row_id, count(y.row_id) as overlapping from o x left join o y on x.a <= y.b and y.a <= x.b and x.row_id <> y.row_id group by 1""")
def interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    """With how many other intervals each one shares a day."""
    o = load(spark, d, "med_orders").select("row_id", intervals.day_of(F.col("start_date")).alias("a"), intervals.day_of(F.col("end_date")).alias("b")).where("a <= b")
    return intervals.overlap_counts(o, o, "row_id", "a", "b").select("row_id", "overlapping")


# --- ranking and packing ---


@query(f"""with {_bm25()}, ca as (select rk.*, length(d.text) as n from rk join documents d on d.doc_id = rk.chunk_id where rank <= 20),
sl as (select *, round((n % 97) / 97.0::double, 6) as logit from ca)
select source, chunk_id, rank as prior_rank, cast(row_number() over (partition by source order by logit desc, rank, chunk_id) as int) as new_rank, logit from sl""")
def rank_cross_encoder(spark: SparkSession, d: str) -> DataFrame:
    """A scorer of pairs plugged in: here one that SQL can say, too."""
    from chartweave.queries import QUESTION, _candidates

    out = ranking.cross_scored(_candidates(spark, d), ["source"], F.lit(QUESTION), "text", lambda q, t: [(len(x) % 97) / 97 for x in t])
    return out.select("source", "chunk_id", "prior_rank", "new_rank", F.round("logit", 6).alias("logit"))


_ROWS = """
b as (select site_code, row_id, 'medication: ' || medication || case when regexp_matches(route, '\\S') then chr(10) || 'route: ' || route else '' end as text, row_number() over (partition by site_code order by row_id) as rank from med_orders where regexp_matches(medication, '\\S') and site_code is not null),
h as (select site_code, rank, 0 as ord, '[Evidence ' || rank || ' | chunk_id=' || row_id || ' | title=— | doc_type=builder_table | date=— | author=— | linked_author=— | med_orders | record — | chunk — | score 1.000]' || chr(10) || text as rendered from b where rank <= 3),
n as (select site_code, row_id, text, title, row_number() over (partition by site_code order by row_id) as rank from clinical_note where regexp_matches(text, '\\S') and site_code is not null),
m as (select site_code, rank, 1 as ord, '[Evidence ' || rank || ' | chunk_id=' || row_id || ' | title=' || coalesce(nullif(title, ''), '—') || ' | doc_type=note | date=— | author=— | linked_author=— | notes | record — | chunk — | score 0.500]' || chr(10) || text as rendered from n where rank <= 2),
u as (select *, greatest(1, length(rendered) // 4) as tokens from (select * from h union all select * from m))"""


def _row_blocks(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    kept = lambda df, k, field: retrieval.ranked(df.where(~text.is_blank(F.col(field)) & F.col("site_code").isNotNull()), ["site_code"], [F.asc("row_id")], k)
    shown = lambda df, body, title, kind, source, score: df.select("site_code", F.col("row_id").cast("string").alias("chunk_id"), F.col("rank").alias("final_rank"), body.alias("text"), title.alias("title"), F.lit(kind).alias("doc_type"), none.alias("document_date"), none.alias("author"), F.lit(source).alias("source"), F.lit(score).alias("score"))
    rows = shown(kept(load(spark, d, "med_orders"), 3, "medication"), chunks.rendered_row(["medication", "route"]), none, "builder_table", "med_orders", 1.0)
    notes = shown(kept(load(spark, d, "clinical_note"), 2, "text"), F.col("text"), F.col("title"), "note", "notes", 0.5)
    return packing.blocks(notes, direct=rows)


@query(f"with {_ROWS} select site_code, count(*) as n_blocks, cast(sum(tokens) as bigint) as total_tokens, md5(string_agg(rendered, chr(10) || chr(10) order by ord, rank)) as packet_md5 from u group by 1")
def pack_direct_first(spark: SparkSession, d: str) -> DataFrame:
    """Table rows, at most three of a group and blank ones left out before, come in front of the passages."""
    return packing.packets(_row_blocks(spark, d), ["site_code"]).select("site_code", "n_blocks", "total_tokens", F.md5("packet").alias("packet_md5"))


@query(f"with {_ROWS}, p as (select site_code, count(*) as b, sum(tokens) as t from u group by 1) select cast(sum(t) as bigint) as total_tokens, cast(sum(b) as bigint) as n_blocks, count(*) as n_packets, bool_and(t <= 500) as all_ok from p")
def pack_combined(spark: SparkSession, d: str) -> DataFrame:
    made = packing.packets(_row_blocks(spark, d), ["site_code"], ceiling=500).withColumn("all", F.lit(1))
    return packing.combined_packets(made, ["all"]).drop("all")


# --- recipes ---


@query("""
with s as (select patient_id, row_id % 3 as ord, case when row_id % 4 <> 0 then sig end as data, row_id from med_orders where patient_id is not null),
l as (select * from s where data is not null qualify row_number() over (partition by patient_id order by row_id desc) = 1)
select p.patient_id, l.data, cast(l.ord as varchar) as answered_by from (select distinct patient_id from s) p left join l on l.patient_id = p.patient_id""")
def recipe_last_answer(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    steps = load(spark, d, "med_orders").where(F.col("patient_id").isNotNull()).select("patient_id", "row_id", F.when(r % 4 != 0, F.col("sig")).alias("data"), (r % 3).cast("string").alias("step"))
    return recipes.last_answer(steps, ["patient_id"], "row_id", "data", "step")


@query("select row_id, 'Patient ' || coalesce(patient_id, '') || ' takes ' || coalesce(medication, '') || ' (' || coalesce(sig, '') || ').' as prompt from med_orders")
def recipe_rendered_prompt(spark: SparkSession, d: str) -> DataFrame:
    made = recipes.rendered("Patient {{ patient_id }} takes {{ medication }} ({{ sig }}).", {c: F.col(c) for c in ("patient_id", "medication", "sig")})
    return load(spark, d, "med_orders").select("row_id", made.alias("prompt"))


@query("""
with d as (select row_id, case when row_id % 3 = 0 then substr(start_date, 1, 7) || '-XX' when row_id % 3 = 1 then substr(start_date, 1, 4) || '-XX-XX' else substr(start_date, 1, 10) end as a, case when row_id % 2 = 0 then substr(end_date, 1, 10) else substr(end_date, 1, 7) || '-XX' end as b from med_orders),
n as (select *, case when a is null then 3 else (length(a) - length(replace(a, 'XX', ''))) / 2 end as x, case when b is null then 3 else (length(b) - length(replace(b, 'XX', ''))) / 2 end as y from d)
select row_id, case when y < x then b else a end as best from n""")
def recipe_merged_passes(spark: SparkSession, d: str) -> DataFrame:
    """Of two passes the date that is more complete."""
    r, a, b = F.col("row_id"), F.col("start_date"), F.col("end_date")
    first = F.when(r % 3 == 0, F.concat(F.substring(a, 1, 7), F.lit("-XX"))).when(r % 3 == 1, F.concat(F.substring(a, 1, 4), F.lit("-XX-XX"))).otherwise(F.substring(a, 1, 10))
    second = F.when(r % 2 == 0, F.substring(b, 1, 10)).otherwise(F.concat(F.substring(b, 1, 7), F.lit("-XX")))
    return load(spark, d, "med_orders").select("row_id", recipes.merged_passes(first, second).alias("best"))


@query("""
with c as (select row_id, list(chunk_id order by chunk_id) as shown from chunk_index where row_id is not null group by 1)
select row_id, case when row_id % 2 = 0 then shown[1] end as strict, case when row_id % 2 = 0 then shown[1] else shown[1] end as lenient from c""")
def recipe_grounding_chunk(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "chunk_index").where(F.col("row_id").isNotNull()).groupBy("row_id").agg(F.sort_array(F.collect_list("chunk_id")).alias("shown"))
    cited = F.when(F.col("row_id") % 2 == 0, F.col("shown")[0]).otherwise("made up")
    return c.select("row_id", recipes.grounding_chunk(F.col("shown"), cited).alias("strict"), recipes.grounding_chunk(F.col("shown"), cited, True).alias("lenient"))


# --- checks of answers ---

_SCHEMA = {
    "type": "object", "required": ["sex", "born"], "additionalProperties": False,
    "$defs": {"text": {"type": ["string", "null"], "maxLength": 40}},
    "properties": {"sex": {"anyOf": [{"enum": ["Male", "Female"]}, {"type": "null"}]}, "born": {"type": "string", "format": "date"}, "said": {"$ref": "#/$defs/text"}, "evidence_chunk_id": {"type": "string"}},
}


def _judged(spark: SparkSession, d: str) -> DataFrame:
    r, c = F.col("row_id"), F.col
    g = load(spark, d, "demographics").select("row_id", F.to_json(F.struct(c("legal_sex").alias("sex"), c("date_of_birth").alias("born"), c("comment").alias("said"), F.when(r % 2 == 0, F.concat(F.lit("c"), r)).alias("evidence_chunk_id")), {"ignoreNullFields": "true"}).alias("data"))
    return validation.checked_json(g, ["row_id"], "data", _SCHEMA)


_JUDGED = r"""
j as (select row_id, legal_sex is not null and legal_sex in ('Male', 'Female') as sex_ok, legal_sex is null as no_sex, date_of_birth is null as no_born,
        coalesce(regexp_matches(date_of_birth, '^\d{4}-\d{2}-\d{2}$') and try_cast(date_of_birth as date) is not null, false) as born_ok, coalesce(length(comment) <= 40, true) as said_ok,
        (case when coalesce(lower(trim(legal_sex)), '') not in ('', 'unknown') then 1 else 0 end) + (case when coalesce(lower(trim(date_of_birth)), '') not in ('', 'unknown') then 1 else 0 end) + (case when coalesce(lower(trim(comment)), '') not in ('', 'unknown') then 1 else 0 end) as found from demographics),
k as (select *, not no_sex and sex_ok and born_ok and said_ok as schema_ok, (case when no_sex or not sex_ok then 1 else 0 end) + (case when no_born or not born_ok then 1 else 0 end) + (case when said_ok then 0 else 1 end) as n_errors, row_id % 2 = 1 and found > 0 as unsourced from j)"""


@query(f"with {_JUDGED} select row_id, schema_ok, cast(n_errors as int) as n_errors from k")
def validate_schema(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select("row_id", "schema_ok", F.size("errors").alias("n_errors"))


@query(f"with {_JUDGED} select row_id, schema_ok and not unsourced and row_id % 5 <> 0 as ok from k")
def validate_ok(spark: SparkSession, d: str) -> DataFrame:
    """Fits its schema, no step failed, and every value has its source."""
    return _judged(spark, d).select("row_id", validation.is_ok(F.col("schema_ok"), F.when(F.col("row_id") % 5 == 0, 1).otherwise(0), F.size("unprovenanced")).alias("ok"))


@query(f"with {_JUDGED} select row_id, cast(found as int) as found from k")
def validate_found_count(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select("row_id", "found")


@query(f"""with {_JUDGED}, t as (select case row_id % 3 when 0 then 'result' when 1 then 'result' else 'other' end as artifact_type, schema_ok from k)
select artifact_type, count(*) as rows, count(*) filter (artifact_type = 'other' or not schema_ok) as invalid from t group by 1""")
def validate_artifacts(spark: SparkSession, d: str) -> DataFrame:
    r, c = F.col("row_id"), F.col
    payload = F.to_json(F.struct(c("legal_sex").alias("sex"), c("date_of_birth").alias("born"), c("comment").alias("said"), F.when(r % 2 == 0, F.concat(F.lit("c"), r)).alias("evidence_chunk_id")))
    g = load(spark, d, "demographics").select(F.when(r % 3 == 2, "other").otherwise("result").alias("kind"), payload.alias("payload"))
    return validation.artifact_report(g, "kind", "payload", {"result": _SCHEMA}).select("artifact_type", "rows", "invalid")


@query(r"""
with j as (select row_id, patient_id, medication, route, sha256('{"medication":' || coalesce(to_json(medication)::varchar, 'null') || ',"route":' || coalesce(to_json(route)::varchar, 'null') || '}') as h from med_orders where patient_id is not null)
select row_id, patient_id || ':structured:f1:row:' || h || ':column:route' as pointer from j where regexp_matches(coalesce(medication, '') || coalesce(route, ''), '^[ -.0-~]*$')""")
def validate_cell_pointers(spark: SparkSession, d: str) -> DataFrame:
    """A cell is named by its row's hash, over the row as JSON with sorted keys."""
    o = load(spark, d, "med_orders").where(F.col("patient_id").isNotNull() & F.concat(F.coalesce("medication", F.lit("")), F.coalesce("route", F.lit(""))).rlike("^[ -.0-~]*$"))
    return o.select("row_id", validation.cell_pointer(F.col("patient_id"), F.lit("f1"), validation.row_hash(["route", "medication"]), "route").alias("pointer"))


_RESULTS = "r as (select patient_id, variable, max(v) as v from (" + " union all ".join(f"select patient_id, '{c}' as variable, {c} as v from demographics" for c in ("date_of_birth", "recent_encounter_date", "date_of_death", "smoking_history_taken")) + ") where patient_id is not null group by all)"


@query(f"""with {_RESULTS} select patient_id, max(v) filter (variable = 'date_of_birth') as born, coalesce(max(v) filter (variable = 'date_of_death'), max(v) filter (variable = 'recent_encounter_date'), max(v) filter (variable = 'smoking_history_taken')) as last_seen from r group by 1""")
def invariants_gathered(spark: SparkSession, d: str) -> DataFrame:
    """Several variables of a patient in one row, each role with the variables that it falls back to."""
    long = answers.long_table(load(spark, d, "demographics").where(F.col("patient_id").isNotNull()), ["patient_id"], ["date_of_birth", "recent_encounter_date", "date_of_death", "smoking_history_taken"])
    return validation.gathered(long, "patient_id", "field", "value", {"born": ("date_of_birth",), "last_seen": ("date_of_death", "recent_encounter_date", "smoking_history_taken")})


@query(r"""
with d as (select row_id, try_cast(regexp_extract(trim(start_date), '^(\d{4}-\d{2}-\d{2})($|[T ])', 1) as date) as s, try_cast(regexp_extract(trim(end_date), '^(\d{4}-\d{2}-\d{2})($|[T ])', 1) as date) as e from med_orders),
w as (select *, date '2021-03-01' as a, date '2024-06-30' as b from d)
select row_id, case when s is null then 'did_not_run' when s < a or s > b then 'failed' else 'passed' end as outcome, case when s is null then 'did_not_run' when s < a or coalesce(s > e, false) then 'failed' else 'passed' end as to_end from w""")
def invariants_window(spark: SparkSession, d: str) -> DataFrame:
    """A day lies within two others, which may be partial or missing."""
    o = load(spark, d, "med_orders").select("row_id", "start_date", "end_date", F.lit("2021-03-XX").alias("first"), F.lit("2024-06-XX").alias("last"))
    o = validation.with_intervals(o, s="start_date", e="end_date", a="first", b="last")
    said = lambda v: F.when(v, "passed").when(~v, "failed").otherwise("did_not_run")
    c = F.col
    return o.select("row_id", said(validation.within(c("s"), c("a"), c("b"))).alias("outcome"), said(validation.within(c("s"), c("a"), c("e"))).alias("to_end"))


# --- answers ---


@query("""
with s as (select row_id, ingredients as raw, case when ingredients is not null then string_split(ingredients, '; ') end as a, case when row_id % 2 = 0 then [route, frequency] end as b from med_orders)
select row_id, case when a is not null then '[' || list_aggregate(list_transform(a, lambda x: '"' || x || '"'), 'string_agg', ',') || ']' end as a,
       nullif(concat_ws('; ', case when len(a) > 0 then 'a' end, case when len(b) > 0 then 'b' end), '') as axis_note from s where not coalesce(contains(raw, '"') or contains(raw, '/') or contains(raw, '\\'), false)""")
def answers_ambiguous_axis(spark: SparkSession, d: str) -> DataFrame:
    """With two lists of records neither makes the rows; both become cells."""
    plain = ~F.coalesce(F.col("ingredients").rlike(r'["/\\]'), F.lit(False))
    rows = load(spark, d, "med_orders").where(plain).select("row_id", F.split("ingredients", "; ").alias("a"), F.when(F.col("row_id") % 2 == 0, F.array("route", "frequency")).alias("b"))
    return answers.by_only_axis(rows, ["a", "b"]).select("row_id", "a", "axis_note")


_STEPS = """
s as (select patient_id, row_id, 's' || row_id % 5 as step_id, length(coalesce(sig, '')) % 3 as found, length(coalesce(route, '')) % 4 as rejected from med_orders where patient_id is not null)"""


@query(f"with {_STEPS} select patient_id, cast(sum(rejected) as int) as rejected_citations, coalesce(string_agg(step_id, '; ' order by row_id) filter (found = 0), '') as steps_returning_nothing, coalesce(string_agg(step_id, '; ' order by row_id) filter (found > 0), '') as steps_with_findings from s group by 1")
def answers_trust(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    o = load(spark, d, "med_orders").where(F.col("patient_id").isNotNull())
    step = F.struct(r, F.concat(F.lit("s"), r % 5).alias("step_id"), (F.length(F.coalesce("sig", F.lit(""))) % 3).alias("found"), (F.length(F.coalesce("route", F.lit(""))) % 4).alias("rejected"))
    return o.groupBy("patient_id").agg(F.sort_array(F.collect_list(step)).alias("steps")).select("patient_id", *answers.trust_columns())


@query("""select row_id, case when language is not null or race is not null then '{' || concat_ws(',', case when language is not null then '"language":"' || language || '"' end, case when race is not null then '"race":"' || race || '"' end) || '}' end as extra from demographics
where not coalesce(regexp_matches(language, '["\\\\/]'), false) and not coalesce(regexp_matches(race, '["\\\\/]'), false)""")
def answers_undeclared(spark: SparkSession, d: str) -> DataFrame:
    """Keys that the schema doesn't declare end up in one cell."""
    g = load(spark, d, "demographics").where(~F.coalesce(F.col("language").rlike(r'["\\/]'), F.lit(False)) & ~F.coalesce(F.col("race").rlike(r'["\\/]'), F.lit(False)))
    pairs = F.filter(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in ("legal_sex", "language", "race")]), lambda x: x["v"].isNotNull())
    return g.select("row_id", F.map_from_entries(pairs).alias("data")).select("row_id", answers.undeclared(g, "data", ["legal_sex"]).alias("extra"))


@query(f"""with {_STEPS}, t as (select patient_id, step_id, row_id, found, case when rejected > 0 then 'c' || rejected end as p from s), u as (select patient_id, p, min(row_id) as pos from t where p is not null group by all)
select t.patient_id, string_agg(step_id || '=' || found, '; ' order by row_id) as summary, max(found) / 100.0::double as confidence, coalesce((select string_agg(p, '; ' order by pos) from u where u.patient_id = t.patient_id), '') as pointers from t group by 1""")
def answers_display(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    rejected = F.length(F.coalesce("route", F.lit(""))) % 4
    o = load(spark, d, "med_orders").where(F.col("patient_id").isNotNull()).select("patient_id", "row_id", F.concat(F.lit("s"), r % 5).alias("f"), (F.length(F.coalesce("sig", F.lit(""))) % 3).alias("v"), F.when(rejected > 0, F.concat(F.lit("c"), rejected)).alias("p"))
    return answers.display_summary(o, ["patient_id"], "f", "v", "v", "p", "row_id")


# --- evaluation and runs ---


@query("""
with l as (select row_id, string_split(lower(ingredients), '; ') as a, case when row_id % 3 = 0 then string_split(upper(ingredients), '; ') when row_id % 3 = 1 then list_reverse(string_split(ingredients, '; ')) else string_split(ingredients, '; ') || ['more'] end as b from med_orders where ingredients is not null)
select row_id, list_sort(list_transform(a, lambda x: trim(x))) = list_sort(list_transform(b, lambda x: lower(trim(x)))) as matches from l""")
def eval_list_match(spark: SparkSession, d: str) -> DataFrame:
    """Lists match if their members can be paired, in any order; texts are folded."""
    r, given = F.col("row_id"), F.split("ingredients", "; ")
    expected = F.when(r % 3 == 0, F.split(F.upper("ingredients"), "; ")).when(r % 3 == 1, F.reverse(given)).otherwise(F.concat(given, F.array(F.lit("more"))))
    o = load(spark, d, "med_orders").where(F.col("ingredients").isNotNull())
    return o.select("row_id", evaluation.json_match(F.to_json(F.split(F.lower("ingredients"), "; ")), F.to_json(expected)).alias("matches"))


@query("""
with f as (select patient_id, route as field, row_id, frequency as v, row_id % 3 <> 0 as agreed from med_orders where patient_id is not null and route is not null)
select patient_id, field, v as correct_value from (select * from f where agreed qualify row_number() over (partition by patient_id, field order by row_id desc) = 1)""")
def eval_corrections(spark: SparkSession, d: str) -> DataFrame:
    """The last agreed entry of a field counts."""
    o = load(spark, d, "med_orders").where(F.col("patient_id").isNotNull() & F.col("route").isNotNull()).withColumn("agreed", F.col("row_id") % 3 != 0).where("agreed")
    return evaluation.latest_entries(o.select("patient_id", F.col("route").alias("field"), "row_id", F.col("frequency").alias("correct_value")), ["patient_id", "field"], "row_id", "correct_value")


@query(f"""
with c as (select patient_id, route as field, frequency = 'daily' or length(frequency) > 8 as ok from med_orders where patient_id is not null and route is not null),
t as (select count(*) as m from (select distinct patient_id from demographics where patient_id is not null and patient_id not in (select patient_id from c))),
a as (select field, count(ok) + max(m) as n, count(*) filter (ok) + max(m) as k from c, t where ok is not null group by 1), {_WILSON}
select field, n, k, round(p, 4) as accuracy, lo as ci_low, hi as ci_high, case when n < 5 or hi - lo > 0.35 then 'underpowered' else 'adequate' end as power from u""")
def eval_field_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Corrected cases count for the field they name, confirmed ones for every field."""
    o = load(spark, d, "med_orders").where(F.col("patient_id").isNotNull() & F.col("route").isNotNull())
    made = o.select("patient_id", F.col("route").alias("field"), ((F.col("frequency") == "daily") | (F.length("frequency") > 8)).alias("ok"))
    people = load(spark, d, "demographics").where(F.col("patient_id").isNotNull())
    return evaluation.field_accuracy(made, people, "patient_id", "field", "ok")


@query("select site_code, patient_id, row_id, case when row_id % 2 = 0 then 1 else 0 end as label from demographics where row_id % 3 <> 0")
def eval_feedback_labels(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    entry = F.struct(F.when(r % 3 != 0, "chunk_relevance").otherwise("extraction_correction").alias("type"), (r % 2 == 0).alias("agreed"))
    g = load(spark, d, "demographics").select("site_code", "patient_id", "row_id", F.array(entry, F.struct(F.lit("other").alias("type"), F.lit(True).alias("agreed"))).alias("feedback"))
    return evaluation.feedback_labels(g, "chunk_relevance").select("site_code", "patient_id", "row_id", "label")


@query("select patient_id, string_agg(distinct chunk_id, ',' order by chunk_id) as chunk_ids from chunk_index where patient_id is not null group by 1")
def eval_fed_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "chunk_index").where(F.col("patient_id").isNotNull())
    steps = c.groupBy("patient_id", (F.col("chunk_idx") % 3).alias("step")).agg(F.collect_list("chunk_id").alias("ids"))
    twice = steps.unionByName(steps)
    return evaluation.fed_chunks(twice, ["patient_id"], "ids").select("patient_id", F.array_join("chunk_ids", ",").alias("chunk_ids"))


@query("select patient_id, min(row_id) as position, 'by row' as rule from med_orders where patient_id is not null group by 1")
def run_sampling_frame(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "med_orders").where(F.col("patient_id").isNotNull()).select("patient_id", F.col("row_id").alias("position"), F.lit("by row").alias("rule"))
    return runs.sampling_frame(o, "patient_id", "position", "rule")


@query("select site_code, count(*) as answers, count(*) filter (deceased = 'FALSE') as failures, count(*) filter (deceased is null) as unjudged from demographics group by 1")
def run_extraction_failures(spark: SparkSession, d: str) -> DataFrame:
    return runs.extraction_failures(load(spark, d, "demographics").withColumn("ok", F.col("deceased") != "FALSE"), ["site_code"], "ok")


@query("""
with k as (select medication as key, max(sig) as v from (select case when row_id % 2 = 0 then medication else medication || '_v' || row_id % 4 end as medication, sig from med_admin where medication is not null and sig is not null) group by 1)
select o.row_id, coalesce(a.v, b.v) as code_hash from med_orders o left join k a on a.key = o.medication || '_v' || o.row_id % 4 left join k b on b.key = o.medication where o.medication is not null""")
def run_versioned_lookup(spark: SparkSession, d: str) -> DataFrame:
    """By key and version first, then by the bare key."""
    r = F.col("row_id")
    known = load(spark, d, "med_admin").where(F.col("medication").isNotNull() & F.col("sig").isNotNull())
    known = known.select(F.when(r % 2 == 0, F.col("medication")).otherwise(F.concat("medication", F.lit("_v"), r % 4)).alias("medication"), F.col("sig").alias("code_hash"))
    wanted = load(spark, d, "med_orders").where(F.col("medication").isNotNull()).select("row_id", "medication", (r % 4).alias("version"))
    return runs.versioned(wanted, known, "medication", "version", "code_hash").select("row_id", "code_hash")


@query("""
with l as (select user_id, event_id % 4 as step, arg_max(event_type, (ts, event_id)) as last_state, min(ts) as a, max(ts) as z from events group by all), c as (select event_id % 4 as step, sum(event_id % 7) as chunks from events group by 1)
select l.step, count(*) as entities, count(*) filter (last_state = 'purchase') as completed, count(*) filter (last_state = 'error') as failed, cast(min(a) as varchar) as earliest, cast(max(z) as varchar) as latest, cast(max(c.chunks) as bigint) as chunks from l join c on c.step = l.step group by 1""")
def run_rollup(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").withColumn("step", F.col("event_id") % 4)
    out = runs.rollup(e, ["user_id"], "step", "event_type", "ts", "event_id", "purchase", "error", e.select("step", (F.col("event_id") % 7).alias("chunks")))
    return out.withColumn("earliest", F.col("earliest").cast("timestamp_ntz").cast("string")).withColumn("latest", F.col("latest").cast("timestamp_ntz").cast("string"))


@query("select count(*) filter (event_id % 10 = 3) as dropped, count(distinct event_id) filter (event_id % 10 <> 3) as entries from events")
def run_read_log(spark: SparkSession, d: str) -> DataFrame:
    """A log of JSON lines with broken ones and repeats."""
    path, e = scratch(spark, "lines"), load(spark, d, "events")
    line = F.when(F.col("event_id") % 10 == 3, "{broken").otherwise(F.to_json(F.struct("event_id", "event_type")))
    e.select(line.alias("value")).write.mode("overwrite").text(path)
    e.where(F.col("event_id") % 10 == 4).select(line.alias("value")).write.mode("append").text(path)
    log, dropped = runs.read_log(spark, path, "event_id long, event_type string")
    return dropped.select("dropped", F.lit(log.count()).cast("long").alias("entries"))


@query("""
select row_id, '$.a' as path, legal_sex as "left", language as "right", case when legal_sex is null or language is null then 'type_changed' else 'changed' end as change from demographics where legal_sex is distinct from language
union all select row_id, '$.l.length', '1', '2', 'length_changed' from demographics union all select row_id, '$.l[1]', null, '2', 'added' from demographics
union all select row_id, '$.n', cast(row_id as varchar), cast(row_id as varchar), 'type_changed' from demographics""")
def diff_json(spark: SparkSession, d: str) -> DataFrame:
    r, keep = F.col("row_id"), {"ignoreNullFields": "false"}
    made = lambda a, l, n: F.to_json(F.struct(F.col(a).alias("a"), l.alias("l"), n.alias("n")), keep)  # noqa: E731, E741
    g = load(spark, d, "demographics").select("row_id", made("legal_sex", F.array(F.lit(1)), r).alias("x"), made("language", F.array(F.lit(1), F.lit(2)), r.cast("string")).alias("y"))
    return evaluation.json_diff(g, ["row_id"], "x", "y")


@query("""
with g as (select user_id, count(*) filter (event_type = 'purchase') as done, count(*) as total, avg(value) as s from events group by 1)
select user_id, round((total - done) * s / 4, 3) as eta_seconds from g""")
def run_time_left(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("done"), F.count("*").alias("total"), F.avg("value").alias("s"))
    return runs.time_left(g, "done", "total", "s", 4).select("user_id", "eta_seconds")


@query("""
with s as (select chunk_id, row_id, chunk_idx from chunk_index where row_id is not null), l as (select chunk_id, case chunk_idx % 2 when 0 then 'relevant' else 'unsure' end as label from s where row_id % 2 = 0)
select s.chunk_id, l.label from s join l on l.chunk_id = s.chunk_id""")
def deid_labels_join(spark: SparkSession, d: str) -> DataFrame:
    """Labels meet the selected chunks by surrogates of one domain, without any id."""
    mint = deid.surrogate(F.col("chunk_id"), b"test key", "study", "evidence_chunk", "chunk_id")
    c = load(spark, d, "chunk_index").where(F.col("row_id").isNotNull()).select("chunk_id", "row_id", "chunk_idx", mint.alias("chunk_surrogate"), F.lit("r1").alias("run_id"), F.lit("q1").alias("recipe_id"), F.lit("s1").alias("step_id"))
    labels = c.where(F.col("row_id") % 2 == 0).select("run_id", "recipe_id", "step_id", "chunk_surrogate", F.when(F.col("chunk_idx") % 2 == 0, "relevant").otherwise("unsure").alias("label"))
    return deid.labelled_selections(c, labels).select("chunk_id", "label")


@query(r"""
with d as (select row_id, trim(start_date) as t from med_orders), m as (select row_id, regexp_matches(t, '^\d{4}-\d{2}-\d{2}($|[T ])') as ok, t from d)
select row_id, case when ok then try_cast(substr(t, 1, 4) as int) * 12 + try_cast(substr(t, 6, 2) as int) - 1 end as month_number, case when ok then cast(replace(substr(t, 1, 10), '-', '') as int) end as sort_key from m""")
def date_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Helpers that rules use: months since year 0, and a sortable number."""
    t = F.col("start_date")
    return load(spark, d, "med_orders").select("row_id", dates.month_number(t).alias("month_number"), dates.sort_key(t).alias("sort_key"))
