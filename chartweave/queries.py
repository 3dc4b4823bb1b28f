"""The registered queries of the core, each with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartweave.functions import dates, text
from chartweave.operators import answers, chunks, deid, evaluation, ingest, packing, ranking, retrieval, runs, validation
from chartweave.plans import filters
from chartweave.plans.filters import Filter
from chartweave.session import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function under its name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- normalising ---


@query()
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.operators.timestamps import chart_timestamps

    fields = {"clinical_note": ("date", False), "med_orders": ("order_date", False), "med_admin": ("taken_date", False), "demographics": ("date_of_birth", True)}
    return chart_timestamps(spark, {t: (load(spark, d, t), f, day) for t, (f, day) in fields.items()}, load(spark, d, "care_site"))


# The islands are found the other way here: a new one begins where a start lies beyond the greatest end before it.
@query(r"""
with o as (
  select patient_id, trim(regexp_replace(upper(medication), '\s+', ' ', 'g')) as medication,
         try_cast(substr(trim(start_date), 1, 10) as date) as s, try_cast(substr(trim(end_date), 1, 10) as date) as e
  from med_orders),
k as (select * from o where patient_id is not null and medication <> '' and s <= e),
m as (select *, max(e) over (partition by patient_id, medication order by s, e rows between unbounded preceding and 1 preceding) as before from k),
g as (select *, sum(case when before is null or s > before + 1 then 1 else 0 end) over (partition by patient_id, medication order by s, e rows unbounded preceding) as island from m),
p as (select patient_id, medication, island, min(s) as a, max(e) as b from g group by all),
n as (select *, lead(a) over (partition by patient_id, medication order by a) as next_a from p)
select patient_id, medication, 'period' as kind, cast(a as varchar) as first_day, cast(b as varchar) as last_day from n
union all
select patient_id, medication, 'gap', cast(b + 1 as varchar), cast(next_a - 1 as varchar) from n where next_a is not null
""")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.operators.intervals import order_periods

    return order_periods(load(spark, d, "med_orders"))


def _quantity_sql() -> str:
    from chartweave.operators.units import ALIASES, AMOUNT_FACTORS, TIME_FACTORS

    words = {(k, u): "|".join(sorted(w.split(), key=len, reverse=True)) for (k, u), w in ALIASES.items()}
    every = lambda *kinds: "|".join(w for (k, _), w in words.items() if k in kinds)
    amount, drop, time, ml = every("mass", "volume"), every("drop"), every("time"), words["volume", "mL"]
    factor = " ".join(f"when regexp_full_match(a, '{words[k, u]}') then {n * 1.0 / d!r}::double" for k, u in words for v, _, n, d in AMOUNT_FACTORS if u == v and k in ("mass", "volume"))
    hours = " ".join(f"when regexp_full_match(t, '{words['time', u]}') then {p * 1.0 / h!r}::double" for u, p, h in TIME_FACTORS)
    mass = every("mass")
    return rf"""
with v as (
  select 'med_admin' as source_table, row_id, 'dose' as field_name, sig as v, dose_unit as u, false as rate from med_admin
  union all select 'med_admin', row_id, 'infusion_rate', infusion_rate, infusion_rate_unit, true from med_admin
  union all select 'med_orders', row_id, 'disp', disp, unit, false from med_orders),
n as (select *, regexp_extract(trim(v), '^([+]?(?:\d{{1,3}}(?:,\d{{3}})+(?:\.\d+)?|\d+,\d+|\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d{{1,3}})?)(?:[^\d,.].*)?$', 1) as num from v),
r as (select *, trim(substr(trim(v), length(num) + 1)) as rest from n where num <> ''),
x as (select *, trim(regexp_replace(replace(replace(lower(case when rest <> '' then rest else coalesce(u, '') end), 'µ', 'u'), 'μ', 'u'), '\.$', '')) as w,
             cast(case when regexp_matches(num, '^[+]?\d{{1,3}}(,\d{{3}})+(\.\d+)?([eE].*)?$') then replace(num, ',', '') else replace(num, ',', '.') end as double) as x from r),
y as (select *, regexp_extract(w, '^({amount})(?: *(?:/|per) *(\d*) *({time}))?$', 1) as a, regexp_extract(w, '^({amount}) *(?:/|per) *(\d*) *({time})$', 2) as c,
             case when regexp_matches(w, '^({amount}) *(?:/|per) *\d* *({time})$') then regexp_extract(w, '({time})$', 1) else regexp_extract(w, '^(?:{drop}) *(?:/|per) *({time})[ ,(@]', 1) end as t,
             regexp_extract(w, '^(?:{drop}) *(?:/|per) *(?:{time})[ ,(@]+(\d+) *(?:{drop}) *(?:/|per) *(?:{ml})\)?$', 1) as f from x),
z as (select *, case {factor} when f <> '' then 1 / cast(f as double) end as amount_factor, case {hours} end / coalesce(nullif(try_cast(c as double), 0), 1) as hour_factor, regexp_full_match(a, '{mass}') as mass from y),
o as (select source_table, row_id, field_name, v, u, case when mass then 'mg' else 'mL' end || case when rate then '/hr' else '' end as common_unit,
             cast(round(x * amount_factor * 1000 * case when rate then hour_factor else 1 end) as bigint) as value_thousandths
      from z where amount_factor is not null and (rate = (t <> '')))
select source_table, row_id, field_name, common_unit, value_thousandths from o
where not coalesce(regexp_full_match(v, '[0-9]+(\.[0-9]+)?') and u = common_unit, false)"""


@query(_quantity_sql())
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.operators.units import common_units

    admin, orders = load(spark, d, "med_admin"), load(spark, d, "med_orders")
    return common_units(spark, [
        (admin, "med_admin", "dose", "sig", "dose_unit", False),
        (admin, "med_admin", "infusion_rate", "infusion_rate", "infusion_rate_unit", True),
        (orders, "med_orders", "disp", "disp", "unit", False),
    ])


# --- ingest ---

OPTIONAL = ["date_of_death", "age_at_death", "marital_status", "occupation", "smoking_started", "smoking_quit", "alcohol_use", "comment"]


@query(f"select row_id, patient_id from demographics where {' or '.join(c + ' is not null' for c in OPTIONAL)}")
def ingest_strip_empty(spark: SparkSession, d: str) -> DataFrame:
    return ingest.strip_empty(load(spark, d, "demographics"), OPTIONAL).select("row_id", "patient_id")


# The SQL has patterns and lists of its own, so that a slip in the operators' shows.
_NULLS = "'', 'NA', 'N/A', 'n/a', 'na', 'null', 'NULL', 'None', 'none', 'nan', 'NaN', 'NAN'"
_CLOCK = r"([T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?"
_SHAPE = rf"^\s*([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}/[0-9]{{1,2}}/([0-9]{{2}}|[0-9]{{4}})){_CLOCK}\s*$"
_SHORT_YEAR = r"^\s*[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}(\s.*)?$"
_SAFE = "^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$"


@query(f"""
select row_id, case when date_of_death not in ({_NULLS}) then date_of_death end as date_of_death,
       case when comment not in ({_NULLS}) then comment end as comment, case when language not in ({_NULLS}) then language end as language
from demographics""")
def ingest_null_tokens(spark: SparkSession, d: str) -> DataFrame:
    return ingest.nulled(load(spark, d, "demographics").select("row_id", "date_of_death", "comment", "language"))


@query(r"""
with v as (select row_id, "date" as raw, regexp_replace("date", '^\s+|\s+$', '', 'g') as t from clinical_note),
k as (select *, regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$') as iso,
             regexp_matches(t, '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(\s+[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?)?$') as slash from v),
p as (select *, case when iso then substr(t, 1, 10) when slash then regexp_extract(t, '/([0-9]{4})', 1) || '-' || lpad(regexp_extract(t, '^([0-9]{1,2})/', 1), 2, '0') || '-' || lpad(regexp_extract(t, '/([0-9]{1,2})/', 1), 2, '0') end as ds,
             lpad(nullif(regexp_extract(t, '([0-9]{1,2}):[0-9]{2}', 1), ''), 2, '0') as h, regexp_extract(t, '[T ][0-9]{1,2}:([0-9]{2})', 1) as mi, coalesce(nullif(regexp_extract(t, '[T ][0-9]{1,2}:[0-9]{2}:([0-9]{2})', 1), ''), '00') as s,
             rpad(left(regexp_extract(t, '\.([0-9]+)', 1), 6), 6, '0') as f, case when iso then regexp_extract(substr(t, 11), '(Z|[+-][0-9]{2}:?[0-9]{2})$', 1) else '' end as z from k),
q as (select *, try_cast(ds as date) as d, regexp_matches(t, '[T ][0-9]{1,2}:[0-9]{2}') or regexp_matches(t, '\s[0-9]{1,2}:') as timed from p)
select row_id, raw, case when d is null then raw when not timed and z = '' then cast(d as varchar) when not timed then raw when h > '23' or mi > '59' or s > '59' then raw
  else cast(d as varchar) || 'T' || h || ':' || mi || ':' || s || case when f in ('', '000000') then '' else '.' || f end || case when z in ('', 'Z') then '+00:00' else left(z, 3) || ':' || right(z, 2) end end as iso from q""")
def ingest_iso_dates(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "clinical_note").select("row_id", F.col("date").alias("raw"), dates.canonical(F.col("date")).alias("iso"))


SHAPED = ["date_of_birth", "recent_encounter_date", "zipcode", "recent_height_cm", "date_of_death", "smoking_history_taken", "insurance_type"]
_LONG = lambda cols, t, row="row_id": " union all ".join(f"""select {row} as r, '{c}' as "column", cast("{c}" as varchar) as value from {t} where "{c}" is not null""" for c in cols)


@query(f"""
with l as ({_LONG(SHAPED, 'demographics')}), f as (select *, row_number() over (partition by "column" order by r) as n from l)
select "column", count(*) as sampled, count(*) filter (regexp_matches(value, '{_SHAPE}')) as shaped,
       count(*) filter (regexp_matches(value, '{_SHAPE}')) >= count(*) * 0.6 as is_date from f where n <= 100 group by 1""")
def ingest_date_column_detect(spark: SparkSession, d: str) -> DataFrame:
    return ingest.date_columns(load(spark, d, "demographics"), "row_id", SHAPED)


@query(f"""
with l as ({_LONG(['date', 'age'], 'clinical_note')}), c as (select "column", value, count(*) as n from l where regexp_matches(value, '{_SHORT_YEAR}') group by all),
r as (select *, row_number() over (partition by "column" order by value) as k from c)
select "column", cast(sum(n) as bigint) as offenders, string_agg(value, '; ' order by value) filter (k <= 5) as examples from r group by 1""")
def ingest_two_digit_year(spark: SparkSession, d: str) -> DataFrame:
    return ingest.two_digit_years(load(spark, d, "clinical_note"), "row_id", ["date", "age"])


@query(rf"""
with l as ({_LONG(['sig', 'infusion_rate', 'pat_enc_csn_id'], 'med_admin')}), f as (select *, row_number() over (partition by "column" order by r) as n from l)
select "column", arg_min(value, n) as example from f where n <= 200 and regexp_matches(trim(value), '^[0-9](\.[0-9]+)?[eE]\+[0-9]{{2,}}$') group by 1""")
def ingest_excel_mangle(spark: SparkSession, d: str) -> DataFrame:
    return ingest.mangled_columns(load(spark, d, "med_admin"), "row_id", ["sig", "infusion_rate", "pat_enc_csn_id"])


def _preflight(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return ingest.preflight(load(spark, d, "clinical_note"), "patient_id", "row_id", [
        ("blank_text", False, text.is_blank(c("text"))),
        ("no_date", False, text.is_blank(c("date"))),
        ("no_author", False, text.is_blank(c("author"))),
        ("two_digit_year", True, F.coalesce(dates.has_two_digit_year(c("date")), F.lit(False))),
        ("unsafe_id", True, ~F.coalesce(c("patient_id").rlike(ingest.SAFE_ID), F.lit(False))),
    ])


_PREFLIGHT = rf"""
with i as (
  select patient_id, row_id, 'blank_text' as issue, false as blocking from clinical_note where text is null or not regexp_matches(text, '\S')
  union all select patient_id, row_id, 'no_date', false from clinical_note where "date" is null or not regexp_matches("date", '\S')
  union all select patient_id, row_id, 'no_author', false from clinical_note where author is null or not regexp_matches(author, '\S')
  union all select patient_id, row_id, 'two_digit_year', true from clinical_note where regexp_matches("date", '{_SHORT_YEAR}')
  union all select patient_id, row_id, 'unsafe_id', true from clinical_note where not coalesce(regexp_matches(patient_id, '{_SAFE}'), false)),
g as (select patient_id, issue, blocking, count(*) as occurrences, min(row_id) as first_row from i group by all)"""


@query(_PREFLIGHT + " select * from g")
def ingest_preflight_issues(spark: SparkSession, d: str) -> DataFrame:
    return _preflight(spark, d)


@query(_PREFLIGHT + " select patient_id, bool_or(blocking) as blocked, count(*) filter (not blocking) as advisories, count(*) filter (blocking) as blockers from g group by 1")
def ingest_preflight_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return ingest.patient_verdicts(_preflight(spark, d), "patient_id")


@query("""
with a as (select row_id, min(source_text_sha256) as h from chunk_index group by 1), b as (select row_id, sha256(text) as h from clinical_note)
select coalesce(a.row_id, b.row_id) as row_id, case when a.row_id is null then 'added' when b.row_id is null then 'removed' else 'changed' end as change
from a full join b on a.row_id = b.row_id where a.row_id is null or b.row_id is null or a.h is distinct from b.h""")
def ingest_snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    before = load(spark, d, "chunk_index").groupBy("row_id").agg(F.min("source_text_sha256").alias("content_hash"))
    return ingest.snapshot_changes(before, ingest.snapshot(load(spark, d, "clinical_note"), ["row_id"], "text"), ["row_id"])


@query("select distinct patient_id, 'quarantine' as action from med_admin m where not exists (select 1 from demographics g where g.patient_id = m.patient_id)")
def ingest_orphans(spark: SparkSession, d: str) -> DataFrame:
    derived = load(spark, d, "med_admin").select("patient_id").distinct()
    return ingest.orphans(derived, load(spark, d, "demographics"), ["patient_id"])


@query(f"select title, count(*) as rows from clinical_note group by 1 having not coalesce(regexp_matches(title, '{_SAFE}'), false)")
def ingest_unsafe_ids(spark: SparkSession, d: str) -> DataFrame:
    return ingest.unsafe_ids(load(spark, d, "clinical_note"), "title")


@query(r"""
select row_id, patient_id, source_column, cast(length(text) as int) as n_chars, nullif("date", '') as document_date, nullif("type", '') as doc_type from (
  select row_id, patient_id, 'title' as source_column, title as text, "date", "type" from clinical_note
  union all select row_id, patient_id, 'text', text, "date", "type" from clinical_note) where regexp_matches(text, '\S')""")
def ingest_corpus_cells(spark: SparkSession, d: str) -> DataFrame:
    cells = ingest.corpus_cells(load(spark, d, "clinical_note"), "row_id", "patient_id", ["title", "text"], {"document_date": "date", "doc_type": "type"})
    return cells.select("row_id", "patient_id", "source_column", F.length("text").alias("n_chars"), "document_date", "doc_type")


# --- chunks ---

_SPANS = r"""
with t as (select row_id, regexp_extract_all(text, '[ \t\r\n]*[^ \t\r\n]+') as r from clinical_note where regexp_matches(text, '\S')),
u as (select row_id, unnest(r) as x, generate_subscripts(r, 1) as i from t),
s as (select row_id, i - 1 as i, sum(length(x)) over (partition by row_id order by i) as hi, length(regexp_replace(x, '^[ \t\r\n]+', '')) as n, count(*) over (partition by row_id) as total from u),
c as (select distinct row_id, total, case when total <= 300 then 1 else cast(ceil((total - 300) / 250.0) as int) + 1 end as k from s),
w as (select row_id, total, k, unnest(range(k)) as chunk_idx from c)"""


@query(_SPANS + """
select w.row_id, cast(w.chunk_idx as int) as chunk_idx, cast(min(s.hi - s.n) as bigint) as char_start, cast(max(s.hi) as bigint) as char_end, cast(count(*) as int) as token_count,
       cast(w.total as int) as parent_tokens, cast(w.k as int) as num_chunks
from w join s on s.row_id = w.row_id and s.i >= w.chunk_idx * 250 and s.i < w.chunk_idx * 250 + 300 group by w.row_id, w.chunk_idx, w.total, w.k""")
def chunk_windows(spark: SparkSession, d: str) -> DataFrame:
    return chunks.token_windows(load(spark, d, "clinical_note"), ["row_id"], "text", 300, 50, r"[^ \t\r\n]+")


@query(_SPANS + """
select row_id, cast(0 as int) as chunk_idx, cast(min(hi - n) as bigint) as char_start, cast(max(hi) as bigint) as char_end, cast(count(*) as int) as token_count,
       cast(max(total) as int) as parent_tokens, cast(1 as int) as num_chunks from s where i < 256 group by row_id""")
def chunk_single(spark: SparkSession, d: str) -> DataFrame:
    return chunks.single_windows(load(spark, d, "clinical_note"), ["row_id"], "text", 256).withColumn("chunk_idx", F.col("chunk_idx").cast("int"))


@query("select doc_id, 'sha256:' || sha256(text) as source_text_sha256 from documents")
def chunk_row_hash(spark: SparkSession, d: str) -> DataFrame:
    return chunks.row_hashes(load(spark, d, "documents"), ["doc_id"], "text")


@query("""
select c.chunk_id, case when n.row_id is null or n.text is null then 'gone' when c.source_text_sha256 <> sha256(n.text) then 'stale' else 'ok' end as status,
       case when c.source_text_sha256 = sha256(n.text) then md5(substring(n.text, c.char_start + 1, c.char_end - c.char_start)) end as text_md5
from chunk_index c left join clinical_note n on n.row_id = c.row_id""")
def chunk_text_resolve(spark: SparkSession, d: str) -> DataFrame:
    out = chunks.resolved(load(spark, d, "chunk_index"), load(spark, d, "clinical_note"), ["row_id"], "text")
    return out.select("chunk_id", "status", F.md5("chunk_text").alias("text_md5"))


@query("select chunk_id, cast(count(*) over (partition by patient_id, source_stem, row_id, source_column) as int) as num_chunks from chunk_index")
def chunk_num_chunks(spark: SparkSession, d: str) -> DataFrame:
    out = chunks.chunk_counts(load(spark, d, "chunk_index").drop("num_chunks"), ["patient_id", "source_stem", "row_id", "source_column"])
    return out.select("chunk_id", "num_chunks")


@query("select source_file || ':' || row_id as chunk_id, count(*) as copies from chunk_index group by 1 having count(*) > 1")
def chunk_duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "chunk_index").select(F.concat_ws(":", "source_file", F.col("row_id").cast("string")).alias("chunk_id"))
    return chunks.duplicate_ids(rows)


@query("select chunk_id, patient_id || ':' || source_stem || ':' || row_id || ':' || chunk_idx as built_id from chunk_index")
def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "chunk_index").withColumnRenamed("chunk_id", "given")
    return chunks.addressed(c, "patient_id", "source_stem", "row_id").select(F.col("given").alias("chunk_id"), F.col("chunk_id").alias("built_id"))


RENDERED = ["medication", "route", "dose_unit", "sig", "infusion_rate", "mar_action"]


@query("select row_id, concat_ws(chr(10), " + ", ".join(f"case when regexp_matches({c}, '\\S') then '{c}: ' || {c} end" for c in RENDERED) + ") as rendered from med_admin")
def table_row_render(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "med_admin").select("row_id", chunks.rendered_row(RENDERED).alias("rendered"))


@query("""
select chunk_id, nullif(document_date, '') as document_date, nullif(age, '') as age, nullif(doc_type, '') as doc_type, nullif(author, '') as author from chunk_index
union all select patient_id || ':med_orders:' || row_id || ':TABLE', nullif(order_date, ''), nullif(order_age, ''), null, nullif(prescribing_provider, '') from med_orders""")
def chunk_metadata(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "med_orders").withColumn("id", F.concat(F.col("patient_id"), F.lit(":med_orders:"), F.col("row_id").cast("string"), F.lit(":TABLE")))
    names = {"document_date": "order_date", "age": "order_age", "doc_type": None, "author": "prescribing_provider"}
    return chunks.chunk_metadata(load(spark, d, "chunk_index"), ["document_date", "age", "doc_type", "author"], [(orders, "id", names)])


@query("""
with n as (select label, sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[]))) as norm, embedding is null as missing,
             coalesce(len(list_filter(embedding, lambda x: isnan(x))) > 0, false) as nan, coalesce(len(list_filter(embedding, lambda x: isinf(x))) > 0, false) as inf from (
    select label, case when vec_id % 11 = 3 then list_transform(embedding, lambda x: x * 'nan'::float) when vec_id % 11 = 5 then list_transform(embedding, lambda x: 'inf'::float) when vec_id % 11 = 7 then list_transform(embedding, lambda x: 0::float) when vec_id % 11 = 8 then list_transform(embedding, lambda x: x * 2) when vec_id % 11 = 9 then null else embedding end as embedding from embeddings))
select label, count(*) as rows, count(*) filter (missing) as missing, count(*) filter (nan) as nan, count(*) filter (inf) as infinite, count(*) filter (not nan and norm < 1e-12) as zero,
       count(*) filter (not nan and not inf and norm >= 1e-12 and abs(norm - 1) > 1e-3) as off_norm,
       count(*) filter (missing or nan or inf or norm < 1e-12 or abs(norm - 1) > 1e-3) = 0 as ok from n group by 1""")
def embed_validate(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of which some are spoilt in each way."""
    e, k = F.col("embedding"), F.col("vec_id") % 11
    each = lambda f: F.transform(e, lambda x: f(x).cast("float"))
    spoilt = F.when(k == 3, each(lambda x: x * float("nan"))).when(k == 5, each(lambda x: F.lit(float("inf")))).when(k == 7, each(lambda x: F.lit(0.0))).when(k == 8, each(lambda x: x * 2)).when(k != 9, e)
    return chunks.embedding_report(load(spark, d, "embeddings").withColumn("embedding", spoilt), "label")


@query("""
with t as (select vec_id // 8 as text_id, vec_id, cast(embedding as double[]) as v, vec_id % 3 <> 0 as shown from embeddings),
x as (select text_id, vec_id, shown, generate_subscripts(v, 1) as i, unnest(v) as x from t),
m as (select text_id, i, avg(x) filter (shown) as mean, arg_min(x, vec_id) as first from x group by all),
n as (select text_id, sqrt(sum(mean * mean)) as a, sqrt(sum(first * first)) as b from m group by 1)
select m.text_id, round(sum(mean / a * i), 4) as mean_pooled, round(sum(first / b * i), 4) as cls_pooled from m join n on n.text_id = m.text_id group by 1""")
def embed_pooling(spark: SparkSession, d: str) -> DataFrame:
    """Eight vectors as the tokens of a text, some of them masked, pooled to one of unit length."""
    t = load(spark, d, "embeddings").groupBy(F.floor(F.col("vec_id") / 8).alias("text_id")).agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))).alias("t"))
    t = t.select("text_id", F.transform("t", lambda x: x["embedding"]).alias("tokens"), F.transform("t", lambda x: (x["vec_id"] % 3 != 0).cast("int")).alias("mask"))
    told = lambda v: F.round(F.aggregate(F.transform(v, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x), 4)
    made = t.select("text_id", chunks.pooled(F.col("tokens"), F.col("mask")).alias("a"), chunks.pooled(F.col("tokens"), F.col("mask"), "cls").alias("b"))
    return made.select("text_id", told(F.col("a")).alias("mean_pooled"), told(F.col("b")).alias("cls_pooled"))


@query()
def embed_batch(spark: SparkSession, d: str) -> DataFrame:
    return chunks.embedded(load(spark, d, "documents"), "doc_id", "text", 64)


# --- retrieval ---

QUESTION = "ankle swelling after the third infusion"
NEEDLE = "third infusion"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents")


def _bm25(where: str = "true", question: str = QUESTION) -> str:
    words = sorted(set(question.split()))
    wanted = ", ".join(f"('{w}', {question.split().count(w)})" for w in words)
    return f"""
t as (select source, doc_id, regexp_extract_all(lower(text), '([a-z0-9]+)') as toks from documents where {where}),
z as (select source, count(*) as n, avg(coalesce(len(toks), 0)) as avgdl from t group by 1),
e as (select source, doc_id, len(toks) as dl, unnest(toks) as word from t),
f as (select source, word, count(distinct doc_id) as df from e group by all),
i as (select f.source, word, avgdl, ln(n - df + 0.5) - ln(df + 0.5) as raw from f join z on f.source = z.source),
m as (select source, avg(raw) as mean from i group by 1),
w(word, times) as (values {wanted}),
q as (select i.source, i.word, times, avgdl, case when raw < 0 then 0.25 * mean else raw end as idf from i join w on i.word = w.word join m on m.source = i.source),
c as (select source, doc_id, dl, word, count(*) as tf from e group by all),
sc as (select c.source, c.doc_id, sum(times * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))) as score from c join q on q.source = c.source and q.word = c.word group by all),
rk as (select source, doc_id as chunk_id, cast(row_number() over (partition by source order by round(score, 9) desc, doc_id) as int) as rank, score from sc where score > 0)"""


_EXACT = f"""
xh as (select source, doc_id, cast((length(lower(text)) - length(replace(lower(text), '{NEEDLE}', ''))) // {len(NEEDLE)} as double) as score from documents),
xr as (select source, doc_id as chunk_id, cast(row_number() over (partition by source order by score desc, doc_id) as int) as rank, score from xh where score > 0)"""


@query(f"with {_EXACT} select source, chunk_id, rank, score from xr where rank <= 20")
def retrieve_exact(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.exact(_docs(spark, d), "source", "doc_id", "text", NEEDLE, 20).select("source", "chunk_id", "rank", "score")


@query(f"with {_bm25()} select source, chunk_id, rank, round(score, 6) as score from rk where rank <= 20")
def retrieve_bm25(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.bm25(_docs(spark, d), "source", "doc_id", "text", QUESTION, 20).select("source", "chunk_id", "rank", F.round("score", 6).alias("score"))


LANG = "en"


@query(f"with {_bm25(f'''lang = '{LANG}' ''')} select source, chunk_id, rank, round(score, 6) as score from rk where rank <= 20")
def retrieve_bm25_source_filtered(spark: SparkSession, d: str) -> DataFrame:
    some = _docs(spark, d).where(F.col("lang") == LANG)
    return retrieval.bm25(some, "source", "doc_id", "text", QUESTION, 20).select("source", "chunk_id", "rank", F.round("score", 6).alias("score"))


def _knn(k: int, more: str = "") -> str:
    return f"""
s as (select q.vec_id as query_id, v.vec_id as chunk_id, list_dot_product(cast(q.embedding as double[]), cast(v.embedding as double[])) as score
      from embeddings q join embeddings v on q.vec_id % 50 = 0 and q.vec_id <> v.vec_id {more}),
r as (select *, cast(row_number() over (partition by query_id order by round(score, 9) desc, chunk_id) as int) as rank from s), k as (select * from r where rank <= {k})"""


def _queries(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    v = load(spark, d, "embeddings")
    return v, v.where(F.col("vec_id") % 50 == 0)


@query(f"with {_knn(10)} select query_id, chunk_id, rank, round(score, 6) as score from k")
def retrieve_knn(spark: SparkSession, d: str) -> DataFrame:
    v, q = _queries(spark, d)
    return retrieval.knn(spark, v, "vec_id", "embedding", q, "vec_id", 10).select("query_id", "chunk_id", "rank", F.round("score", 6).alias("score"))


@query(f"""
with {_knn(40)}, f as (select k.query_id, k.chunk_id, k.score from k join embeddings e on e.vec_id = k.chunk_id where e.label in (1, 3, 5)),
g as (select *, cast(row_number() over (partition by query_id order by round(score, 9) desc, chunk_id) as int) as rank from f)
select query_id, chunk_id, rank, round(score, 6) as score from g where rank <= 10""")
def retrieve_knn_postfilter(spark: SparkSession, d: str) -> DataFrame:
    v, q = _queries(spark, d)
    out = retrieval.knn_then_filter(spark, v, "vec_id", "embedding", q, "vec_id", 10, 4, v.where(F.col("label").isin(1, 3, 5)))
    return out.select("query_id", "chunk_id", "rank", F.round("score", 6).alias("score"))


@query()
def retrieve_knn_index(spark: SparkSession, d: str) -> DataFrame:
    """The same by an index of 16 bytes a vector, its 200 nearest scored again by their vectors."""
    v, q = _queries(spark, d)
    index, book = retrieval.pq_index(v, "vec_id", "embedding")
    return retrieval.pq_knn(index, book, v, "vec_id", "embedding", q, "vec_id", 10).select("query_id", "chunk_id", "rank", F.round("score", 6).alias("score"))


def _hybrid(spark: SparkSession, d: str, method: str, weights: dict[str, float]) -> DataFrame:
    docs, k = _docs(spark, d), 10
    depth = retrieval.member_depth(k)
    members, _ = retrieval.run_members([
        ("bm25", lambda: retrieval.bm25(docs, "source", "doc_id", "text", QUESTION, depth)),
        ("exact", lambda: retrieval.exact(docs, "source", "doc_id", "text", NEEDLE, depth)),
    ])
    out = retrieval.fused(members, ["source"], k, method, weights)
    return out.select("source", "chunk_id", "rank", F.round("score", 6).alias("score"), "retriever")


def _fusion(a: str, b: str) -> str:
    return f"""with {_bm25()}, {_EXACT},
u as (select source, chunk_id, {a} as part, 0 as o from rk where rank <= 20 union all select source, chunk_id, {b}, 1 from xr where rank <= 20),
g as (select source, chunk_id, sum(part) as score, case when min(o) = 0 then 'bm25' else 'exact' end as retriever from u group by all),
h as (select *, cast(row_number() over (partition by source order by round(score, 9) desc, chunk_id) as int) as rank from g)
select source, chunk_id, rank, round(score, 6) as score, retriever from h where rank <= 10"""


@query(_fusion("1.0::double / (60 + rank)", "2.0::double / (60 + rank)"))
def retrieve_hybrid_rrf(spark: SparkSession, d: str) -> DataFrame:
    return _hybrid(spark, d, "reciprocal_rank", {"bm25": 1.0, "exact": 2.0})


@query(_fusion("0.5::double * score", "0.25::double * score"))
def retrieve_hybrid_weighted(spark: SparkSession, d: str) -> DataFrame:
    return _hybrid(spark, d, "weighted_sum", {"bm25": 0.5, "exact": 0.25})


@query("""
with r as (select site_code, row_id as chunk_id, cast(row_number() over (partition by site_code order by row_id) as int) as rank from med_orders where contains(medication, 'TABLET'))
select site_code, chunk_id, rank, 1.0::double as score from r where rank <= 10""")
def retrieve_direct_rows(spark: SparkSession, d: str) -> DataFrame:
    out = retrieval.table_rows(load(spark, d, "med_orders"), "site_code", "row_id", "medication contains 'TABLET'", 10)
    return out.select("site_code", "chunk_id", "rank", "score")


@query(f"""
with {_bm25()}, a as (select * from rk where rank <= 5), l as (select source, max(rank) as last from a group by 1),
n as (select source, doc_id as chunk_id, row_number() over (partition by source order by document_date desc nulls last, case when document_date is not null then doc_id end desc nulls last, doc_id) as r
      from documents d where not exists (select 1 from a where a.source = d.source and a.chunk_id = d.doc_id))
select source, chunk_id, rank, round(score, 6) as score, 'bm25' as retriever from a
union all select n.source, n.chunk_id, cast(coalesce(last, 0) + r as int), 0.0, 'recent' from n left join l on l.source = n.source where r <= 5""")
def retrieve_recent_union(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    out = retrieval.with_recent(retrieval.bm25(docs, "source", "doc_id", "text", QUESTION, 5), docs, "source", "doc_id", "document_date", 5, 5)
    return out.withColumn("rank", F.col("rank").cast("int")).withColumn("score", F.round("score", 6))


@query(f"with {_bm25()} select source, string_agg(chunk_id, ',' order by rank) as selected, count(*) as n from rk where rank <= 10 group by 1")
def retrieve_record(spark: SparkSession, d: str) -> DataFrame:
    out = retrieval.retrieval_record(retrieval.bm25(_docs(spark, d), "source", "doc_id", "text", QUESTION, 10), ["source"], "bm25 k=10")
    return out.select("source", F.array_join(F.transform("selected_chunk_ids", lambda x: x.cast("string")), ",").alias("selected"), F.size("candidates").cast("long").alias("n"))


# --- filters ---


@query("""
select chunk_id from chunk_index
where contains(lower(trim(doc_type)), 'notes') and trim(doc_type) <> '' and coalesce(not contains(lower(trim(author)), 'pool'), true) and coalesce(lower(trim(title)) <> 'surgical - weekly check', true)""")
def filter_text_ops(spark: SparkSession, d: str) -> DataFrame:
    fs = [Filter("doc_type", "contains", "notes"), Filter("author", "not_contains", "pool", True), Filter("title", "!=", "Surgical - weekly check", True)]
    return filters.kept(load(spark, d, "chunk_index"), fs).select("chunk_id")


@query("select chunk_id, age from chunk_index where try_cast(trim(age) as double) >= 50 and try_cast(trim(age) as double) < 70 and isfinite(try_cast(trim(age) as double))")
def filter_number_ops(spark: SparkSession, d: str) -> DataFrame:
    return filters.kept(load(spark, d, "chunk_index"), [Filter("age", ">=", 50), Filter("age", "<", "70")]).select("chunk_id", "age")


_LOHI = r"""
d as (select chunk_id, nullif(trim(document_date), '') as x from chunk_index),
i as (select chunk_id, x, case when regexp_matches(x, '^\d{4}-(\d{2}|XX)-(\d{2}|XX)([T ].*)?$') then try_cast(replace(replace(substr(x, 1, 7), '-XX', '-01'), 'XX', '01') || '-' || replace(substr(x, 9, 2), 'XX', '01') as date) end as day from d)"""


@query(f"with {_LOHI} select chunk_id, x as document_date from i where x is not null and day >= date '2022-03-01' and day <= date '2023-12-31'")
def filter_partial_dates(spark: SparkSession, d: str) -> DataFrame:
    out = filters.kept(load(spark, d, "chunk_index"), [Filter("document_date", ">=", "2022-03-XX"), Filter("document_date", "<=", "2023-XX-XX")])
    return out.select("chunk_id", F.trim("document_date").alias("document_date"))


STATS = [Filter("author", "not_contains", "desk"), Filter("document_date", ">", "2022-06-15"), Filter("age", "<=", 80)]


@query(f"""
with {_LOHI}, v as (
  select c.chunk_id, nullif(trim(c.author), '') as a, i.x, i.day, nullif(trim(c.age), '') as g from chunk_index c join i on i.chunk_id = c.chunk_id),
w as (select chunk_id, case when a is null then 0 when contains(lower(a), 'desk') then 0 when x is null or day is null or not day > date '2022-06-15' then 1
                            when g is null or try_cast(g as double) is null or not try_cast(g as double) <= 80 then 2 end as k,
             case when a is null then 'missing' when contains(lower(a), 'desk') then 'no_match' when x is null then 'missing' when day is null then 'unanswerable'
                  when not day > date '2022-06-15' then 'no_match' when g is null then 'missing' when try_cast(g as double) is null then 'unanswerable' else 'no_match' end as why from v)
select cast(k as int) as filter_index, count(*) as dropped, count(*) filter (why = 'missing') as dropped_missing, count(*) filter (why = 'unanswerable') as dropped_unparseable, min(chunk_id) as example
from w where k is not null group by 1""")
def filter_drop_stats(spark: SparkSession, d: str) -> DataFrame:
    return filters.drop_statistics(load(spark, d, "chunk_index"), STATS, "chunk_id")


@query("""
with p as (select chunk_id, patient_id, coalesce(try_cast(trim(age) as double) > 70, false) as ok from chunk_index), s as (select patient_id from p where ok group by 1)
select p.chunk_id, s.patient_id is null as fell_back from p left join s on s.patient_id = p.patient_id where ok or s.patient_id is null""")
def filter_fallback(spark: SparkSession, d: str) -> DataFrame:
    out = filters.kept_or_all(load(spark, d, "chunk_index"), [Filter("age", ">", 70)], ["patient_id"])
    return out.select("chunk_id", "fell_back")


@query("""
with v as (select patient_id, nullif(trim(min(legal_sex)), '') as s from demographics where patient_id is not null group by 1)
select c.chunk_id, s is null or lower(s) = 'unknown' as filter_skipped from chunk_index c left join v on v.patient_id = c.patient_id
where s is null or lower(s) = 'unknown' or (nullif(trim(c.title), '') is not null and contains(lower(trim(c.title)), lower(left(s, 1))))""")
def filter_template_value(spark: SparkSession, d: str) -> DataFrame:
    values = load(spark, d, "demographics").where(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(F.min("legal_sex").alias("v"))
    values = values.select("patient_id", F.when(F.lower(F.trim("v")) == "unknown", F.col("v")).otherwise(F.substring(F.trim("v"), 1, 1)).alias("v"))
    out = filters.with_template_values(load(spark, d, "chunk_index"), Filter("title", "contains", None), values, ["patient_id"], "v")
    return out.select("chunk_id", "filter_skipped")


@query("select chunk_id from chunk_index where not coalesce(num_chunks > 4 and chunk_idx >= 2, false)")
def filter_stop_if(spark: SparkSession, d: str) -> DataFrame:
    return filters.stop_gate(load(spark, d, "chunk_index"), "num_chunks > 4 and chunk_idx >= 2").select("chunk_id")


# --- ranking and packing ---

SOURCE_WEIGHTS = {"discharge summary": 1.0, "pathology report": 0.5}


def _candidates(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    docs = _docs(spark, d)
    found = retrieval.bm25(docs, "source", "doc_id", "text", QUESTION, k)
    meta = docs.select(F.col("doc_id").alias("chunk_id"), "text", "doc_type", "title", "document_date", F.lit(None).cast("string").alias("author"))
    return found.join(meta, "chunk_id")


_CAND = f"{_bm25()}, cd as (select rk.*, d.text, d.doc_type, d.title, d.document_date from rk join documents d on d.doc_id = rk.chunk_id where rank <= 20)"
_WORDS = ", ".join(f"'{w}'" for w in sorted(set(QUESTION.split())))
_COMBINED = rf"""{_CAND}, cb as (
  select *, 0.4::double / (60 + rank) + 0.4::double * len(list_intersect([{_WORDS}], list_distinct(regexp_extract_all(lower(text), '([\p{{L}}\p{{N}}_]+)')))) / {len(set(QUESTION.split()))}
         + 0.2::double * case doc_type when 'discharge summary' then 1.0 when 'pathology report' then 0.5 else 0.0 end as combined from cd),
cn as (select *, cast(row_number() over (partition by source order by round(combined, 6) desc, rank, chunk_id) as int) as new_rank from cb)"""


def _with_combined(spark: SparkSession, d: str) -> DataFrame:
    return ranking.combined(_candidates(spark, d), ["source"], F.lit(QUESTION), "text", "doc_type", SOURCE_WEIGHTS)


@query(f"with {_COMBINED} select source, chunk_id, rank as prior_rank, new_rank, round(combined, 6) as combined from cn")
def rank_combined(spark: SparkSession, d: str) -> DataFrame:
    return _with_combined(spark, d).select("source", "chunk_id", "prior_rank", "new_rank", F.round("combined", 6).alias("combined"))


def _by_date(order: str) -> str:
    return f"""with {_CAND}, dd as (select *, try_cast(document_date as date) as day from cd),
r as (select *, cast(row_number() over (partition by source order by day {order} nulls last, rank, chunk_id) as int) as new_rank from dd)
select source, chunk_id, new_rank, round(1.0::double / new_rank, 6) as date_score from r"""


@query(_by_date("desc"))
def rank_newest(spark: SparkSession, d: str) -> DataFrame:
    return ranking.by_date(_candidates(spark, d), ["source"], "document_date", True).select("source", "chunk_id", "new_rank", F.round("date_score", 6).alias("date_score"))


@query(_by_date("asc"))
def rank_oldest(spark: SparkSession, d: str) -> DataFrame:
    return ranking.by_date(_candidates(spark, d), ["source"], "document_date", False).select("source", "chunk_id", "new_rank", F.round("date_score", 6).alias("date_score"))


_SAME = r"replace(lower(trim(regexp_replace(text, '[ \t\r\n\f\v]+', ' ', 'g'))), 'ß', 'ss')"
_DEDUP = rf"""{_COMBINED}, cs as (select *, case when regexp_matches(text, '\S') then sha256({_SAME}) else chr(1) || chunk_id end as same from cn),
cu as (select * from cs qualify row_number() over (partition by source, same order by new_rank, chunk_id) = 1)"""


@query(f"with {_DEDUP} select source, chunk_id, new_rank from cu")
def rank_dedup(spark: SparkSession, d: str) -> DataFrame:
    return ranking.without_copies(_with_combined(spark, d), ["source"], "text").select("source", "chunk_id", "new_rank")


_TRIM = f"{_DEDUP}, ct as (select *, cast(row_number() over (partition by source order by new_rank, chunk_id) as int) as final_rank from cu), cf as (select * from ct where final_rank <= 5)"


@query(f"with {_TRIM} select source, chunk_id, final_rank from cf")
def rank_composed(spark: SparkSession, d: str) -> DataFrame:
    out = ranking.rerank(_candidates(spark, d), ["source"], F.lit(QUESTION), "text", "doc_type", "document_date", 5, source_weights=SOURCE_WEIGHTS)
    return out.select("source", "chunk_id", "final_rank")


@query(f"""with {_TRIM} select source, chunk_id, final_rank,
cast(row_number() over (partition by source order by try_cast(document_date as date) asc nulls last, final_rank) as int) as read_pos from cf""")
def rank_chronological(spark: SparkSession, d: str) -> DataFrame:
    out = ranking.rerank(_candidates(spark, d), ["source"], F.lit(QUESTION), "text", "doc_type", "document_date", 5, source_weights=SOURCE_WEIGHTS, chronological=True)
    return out.select("source", "chunk_id", "final_rank", "read_pos")


@query(rf"""
with n as (select doc_id, sha256({_SAME}) as h from documents where regexp_matches(text, '\S'))
select left(h, 12) as text_hash, count(*) as copies, count(*) - 1 as dropped, min(doc_id) as kept_id from n group by h having count(*) > 1""")
def rank_copy_statistics(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d).withColumn("best", F.lit(0))
    return ranking.copy_statistics(docs, "doc_id", "text", "best")


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    out = ranking.rerank(_candidates(spark, d), ["source"], F.lit(QUESTION), "text", "doc_type", "document_date", 5, source_weights=SOURCE_WEIGHTS)
    return packing.blocks(out)


_PACK = f"""{_TRIM}, bl as (
  select source, doc_type, final_rank, '[Evidence ' || final_rank || ' | chunk_id=' || chunk_id || ' | title=' || coalesce(nullif(title, ''), '—') || ' | doc_type=' || coalesce(nullif(doc_type, ''), '—') || ' | date='
         || coalesce(nullif(document_date, ''), '—') || ' | author=— | linked_author=— | ' || coalesce(nullif(source, ''), '—') || ' | record — | chunk — | score ' as head, text, score from cf where regexp_matches(text, '\\S')),
bk as (select *, head || cast(cast(score as decimal(18, 3)) as varchar) || ']' || chr(10) || text as rendered from bl),
bt as (select *, greatest(1, length(rendered) // 4) as tokens from bk)"""


@query(f"with {_PACK} select source, coalesce(doc_type, 'unknown') as doc_type, cast(sum(tokens) as bigint) as tokens from bt group by all")
def pack_tokens_by_type(spark: SparkSession, d: str) -> DataFrame:
    return packing.tokens_by_type(_blocks(spark, d), ["source"])


@query(f"""with {_PACK} select source, count(*) as n_blocks, cast(sum(tokens) as bigint) as total_tokens,
case when sum(tokens) > 1000 then 'over_ceiling' else 'ok' end as status, md5(string_agg(rendered, chr(10) || chr(10) order by final_rank)) as packet_md5 from bt group by 1""")
def pack_blocks(spark: SparkSession, d: str) -> DataFrame:
    out = packing.packets(_blocks(spark, d), ["source"], ceiling=1000)
    return out.select("source", "n_blocks", "total_tokens", "status", F.md5("packet").alias("packet_md5"))


# --- answers ---

ANSWER_FIELDS = ["legal_sex", "date_of_birth", "smoking_hx", "language", "deceased"]


@query("""
select row_id, legal_sex as "person.sex", date_of_birth as "person.birth.date", upper(cast(deceased = 'TRUE' as varchar)) as "status.dead",
       coalesce(race, '') || case when race is not null and ethnicity is not null then '; ' else '' end || coalesce(ethnicity, '') as "person.groups" from demographics""")
def answers_flatten(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    data = F.struct(
        F.struct(c("legal_sex").alias("sex"), F.struct(c("date_of_birth").alias("date")).alias("birth"), F.filter(F.array("race", "ethnicity"), lambda x: x.isNotNull()).alias("groups")).alias("person"),
        F.struct((c("deceased") == "TRUE").alias("dead")).alias("status"),
    )
    return answers.flat(load(spark, d, "demographics").withColumn("data", data), ["row_id"], "data")


@query(" union all ".join(f"select row_id, '{c}' as field, {c} as value from demographics" for c in ANSWER_FIELDS))
def answers_long(spark: SparkSession, d: str) -> DataFrame:
    return answers.long_table(load(spark, d, "demographics"), ["row_id"], ANSWER_FIELDS)


@query("select patient_id, " + ", ".join(f"coalesce((select string_agg(v, '; ' order by v) from (select distinct {c} as v from demographics i where i.patient_id is not distinct from o.patient_id and {c} is not null)), '') as {c}" for c in ANSWER_FIELDS) + " from (select distinct patient_id from demographics) o")
def answers_wide(spark: SparkSession, d: str) -> DataFrame:
    long = answers.long_table(load(spark, d, "demographics"), ["patient_id"], ANSWER_FIELDS)
    return answers.wide_table(long, ["patient_id"], "field", "value", ANSWER_FIELDS)


@query("""
with e as (select row_id, patient_id, unnest(regexp_split_to_array(coalesce(ingredients, ''), ';\\s*')) as pointer, generate_subscripts(regexp_split_to_array(coalesce(ingredients, ''), ';\\s*'), 1) as pos from med_orders where ingredients is not null),
f as (select * from e where regexp_matches(pointer, '\\S')), p as (select medication as pointer, min(sig) as passage from med_orders where medication is not null group by 1)
select f.row_id, string_agg(coalesce(passage, '(not shown: ' || f.pointer || ')'), ' ;; ' order by pos) as evidence_text, count(*) filter (passage is null) as not_shown from f left join p on p.pointer = f.pointer group by 1""")
def answers_evidence_join(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "med_orders")
    passages = orders.where(F.col("medication").isNotNull()).groupBy(F.col("medication").alias("chunk_id")).agg(F.min("sig").alias("passage"))
    out = answers.with_evidence(orders.select("row_id", "ingredients"), passages, ["row_id"], "ingredients")
    return out.where(F.col("evidence_text").isNotNull()).select("row_id", "evidence_text", "not_shown")


@query("select row_id, " + " or ".join(f"coalesce(regexp_matches({c}, '\\S'), false)" for c in OPTIONAL) + " as any_value_found from demographics")
def answers_any_value(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "demographics").select("row_id", answers.any_value(OPTIONAL).alias("any_value_found"))


@query("""
with s as (select row_id, case when ingredients is null then null else string_split(ingredients, '; ') end as l from med_orders)
select row_id, cast(i - 1 as int) as row_index, l[i] as record from (select row_id, l, unnest(range(1, len(l) + 1)) as i from s where len(l) > 0)
union all select row_id, null, null from s where l is null or len(l) = 0""")
def answers_row_axis(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "med_orders").select("row_id", F.split("ingredients", "; ").alias("records"))
    return answers.by_row_axis(rows, "records").select("row_id", "row_index", "record")


@query("select variable, count(*) as n_rows, count(distinct query_id) as n_patients from eval_passage group by 1")
def answers_run_metadata(spark: SparkSession, d: str) -> DataFrame:
    return answers.run_metadata(load(spark, d, "eval_passage"), "variable", "query_id")


# --- evaluation ---

_GOLD = f"gd as (select source, doc_id as chunk_id from documents where doc_type = 'nursing handover' and contains(lower(text), 'infusion'))"


def _gold(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return docs.where((F.col("doc_type") == "nursing handover") & F.contains(F.lower("text"), F.lit("infusion"))).select("source", F.col("doc_id").alias("chunk_id"))


_RECALL = ", ".join(f"round(coalesce(sum(case when rank <= {k} then 1 end), 0)::double / max(n), 6) as recall_at_{k}" for k in evaluation.K_VALUES)
_NDCG = ", ".join(f"round(coalesce(sum(case when rank <= {k} then 1 / log2(rank + 1) end), 0) / list_sum([1 / log2(i + 1) for i in range(1, least({k}, max(n)) + 1)]), 6) as ndcg_at_{k}" for k in evaluation.K_VALUES)


@query(f"""with {_bm25()}, {_GOLD}, gn as (select source, count(*) as n from gd where source is not null group by 1),
hit as (select gd.source, rank from gd join rk on rk.source = gd.source and rk.chunk_id = gd.chunk_id and rank <= 20)
select gn.source, cast(max(n) as int) as n_relevant, round(coalesce(1.0::double / min(rank), 0), 6) as mrr, {_RECALL}, {_NDCG} from gn left join hit on hit.source = gn.source group by 1""")
def eval_recall_mrr_ndcg(spark: SparkSession, d: str) -> DataFrame:
    found = retrieval.bm25(_docs(spark, d), "source", "doc_id", "text", QUESTION, 20)
    return evaluation.retrieval_metrics(found, _gold(spark, d).where(F.col("source").isNotNull()), ["source"])


@query(f"""with {_bm25()}, se as (select source, list(chunk_id::varchar order by rank) filter (rank <= 10) as sel, list(chunk_id::varchar order by rank) filter (rank <= 3) as s3,
  list(chunk_id::varchar order by rank) filter (rank between 2 and 12) as s12 from rk group by 1),
ok as (select source, sel, s3, s12, len(list_filter(s12, lambda x: not list_contains(sel, x))) = 0 and len(s12) > 0 as a, len(list_filter(s3, lambda x: not list_contains(sel, x))) = 0 as b from se)
select source, a or b as sufficient, case when a then 0 when b then 1 end as first_set,
       cast(len(list_filter(sel, lambda x: not list_contains(case when a then s12 when b then s3 else []::varchar[] end, x))) as int) as unnecessary from ok""")
def eval_bundle(spark: SparkSession, d: str) -> DataFrame:
    found = retrieval.bm25(_docs(spark, d), "source", "doc_id", "text", QUESTION, 12).withColumn("id", F.col("chunk_id").cast("string"))
    pick = lambda c: F.sort_array(F.collect_list(F.when(c, F.struct("rank", "id"))))
    r = F.col("rank")
    g = found.groupBy("source").agg(pick(r <= 10).alias("sel"), pick(r.between(2, 12)).alias("s12"), pick(r <= 3).alias("s3"))
    ids = lambda c: F.transform(c, lambda x: x["id"])
    # a set without members isn't a set anybody asked for
    sets = F.array(F.when(F.size("s12") > 0, ids("s12")).otherwise(F.array(F.lit("none"))), ids("s3"))
    b = evaluation.bundle_sufficiency(ids("sel"), sets)
    return g.select("source", b.alias("b")).select("source", "b.sufficient", "b.first_set", "b.unnecessary")


_WILSON = """
w as (select *, 1.959963984540054 as z, k::double / nullif(n, 0) as p from a),
v as (select *, (p + z * z / (2 * n)) / (1 + z * z / n) as mid, z / (1 + z * z / n) * sqrt(p * (1 - p) / n + z * z / (4.0 * n * n)) as half from w),
u as (select *, case when n > 0 then round(greatest(0, mid - half), 4) else 0 end as lo, case when n > 0 then round(least(1, mid + half), 4) else 0 end as hi from v)"""


@query(f"""
with a as (select site_code, count(case when legal_sex is not null and language is not null then 1 end) as n, count(*) filter (legal_sex is not null and language is not null and language = 'English') as k from demographics group by 1), {_WILSON}
select site_code, n, k, case when n > 0 then round(p, 4) end as accuracy, lo as ci_low, hi as ci_high, case when n < 5 or hi - lo > 0.35 then 'underpowered' else 'adequate' end as power from u""")
def eval_wilson(spark: SparkSession, d: str) -> DataFrame:
    v = load(spark, d, "demographics").withColumn("correct", F.when(F.col("legal_sex").isNotNull() & F.col("language").isNotNull(), F.col("language") == "English"))
    return evaluation.accuracy(v, ["site_code"], "correct")


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    """Two snapshots of a patient as an extraction and its review: field, extracted, expected."""
    g = load(spark, d, "demographics").where(F.col("patient_id").isNotNull())
    first = g.groupBy("patient_id").agg(*[F.min_by(c, "row_id").alias(f"a_{c}") for c in ANSWER_FIELDS], *[F.max_by(c, "row_id").alias(f"b_{c}") for c in ANSWER_FIELDS])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"a_{c}").alias("extracted"), F.col(f"b_{c}").alias("expected")) for c in ANSWER_FIELDS])
    return first.select("patient_id", F.explode(pairs).alias("p")).select("patient_id", "p.*")


_REVIEWS = "rv as (" + " union all ".join(f"select patient_id, '{c}' as field, (array_agg({c} order by row_id))[1] as extracted, (array_agg({c} order by row_id desc))[1] as expected from demographics where patient_id is not null group by 1" for c in ANSWER_FIELDS) + ")"
_RIGHT = "case when extracted is not null and expected is not null then lower(trim(extracted)) = lower(trim(expected)) end"


@query(f"""with {_REVIEWS}, a as (select field, count({_RIGHT}) as n, count(*) filter ({_RIGHT}) as k from rv group by 1), {_WILSON}
select field, n, k, case when n > 0 then round(p, 4) end as accuracy, lo as ci_low, hi as ci_high, case when n < 5 or hi - lo > 0.35 then 'underpowered' else 'adequate' end as power from u""")
def eval_per_field(spark: SparkSession, d: str) -> DataFrame:
    r = _reviews(spark, d)
    right = F.when(F.col("extracted").isNotNull() & F.col("expected").isNotNull(), F.lower(F.trim("extracted")) == F.lower(F.trim("expected")))
    return evaluation.accuracy(r.withColumn("right", right), ["field"], "right")


@query(f"""with {_REVIEWS} select field, extracted, expected, count(distinct patient_id) as patients, count(distinct patient_id) >= 2 as systematic from rv where {_RIGHT} = false group by 1, 2, 3""")
def eval_patterns(spark: SparkSession, d: str) -> DataFrame:
    r = _reviews(spark, d)
    return evaluation.mismatch_patterns(r.where(F.lower(F.trim("extracted")) != F.lower(F.trim("expected"))), "patient_id")


@query(f"with {_REVIEWS} select field, count(*) as confirmed, count({_RIGHT}) as scorable, count(*) filter ({_RIGHT}) as still_right from rv group by 1")
def eval_rescored(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.rescored(_reviews(spark, d), ["field"], "extracted", "expected")


@query(f"""with {_bm25()}, {_GOLD}, fed as (select source, list(chunk_id order by rank) as ids from rk where rank <= 10 group by 1), rel as (select source, list(chunk_id) as ids from gd where source is not null group by 1),
x as (select f.source, coalesce(len(r.ids), 0) as n, len(list_intersect(r.ids, f.ids)) as hit from fed f left join rel r on r.source = f.source)
select source, case when n = 0 then 'no_retrieval_gold' when hit = 0 then 'retrieval_miss' when hit = n then 'extraction_miss' else 'both' end as miss from x""")
def eval_decompose(spark: SparkSession, d: str) -> DataFrame:
    fed = retrieval.bm25(_docs(spark, d), "source", "doc_id", "text", QUESTION, 10).groupBy("source").agg(F.collect_set("chunk_id").alias("fed"))
    rel = _gold(spark, d).where(F.col("source").isNotNull()).groupBy("source").agg(F.collect_set("chunk_id").alias("relevant"))
    j = fed.join(rel, "source", "left")
    return j.select("source", evaluation.miss_kind(F.col("relevant"), F.col("fed"), F.lit(True)).alias("miss"))


_RUNS = "rn as (select event_type as run, user_id % 5 as metric, round(avg(value), 6) as value from events group by all)"


@query(f"""with {_RUNS} select run, metric, value, round(value - first_value(value) over (partition by metric order by run), 6) as delta,
row_number() over (partition by metric order by value desc, run) = 1 as best from rn""")
def eval_compare_runs(spark: SparkSession, d: str) -> DataFrame:
    m = load(spark, d, "events").groupBy(F.col("event_type").alias("run"), (F.col("user_id") % 5).alias("metric")).agg(F.round(F.avg("value"), 6).alias("value"))
    return evaluation.compared_runs(m, "run", "run", "metric", "value")


@query("""
with s as (select event_type, value, case when event_type = 'error' and value > 50 then 'failed' when value < 5 then 'unannotated' else 'scored' end as status from events)
select event_type, count(*) filter (status = 'scored') as scored, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'unannotated') as unannotated,
       round(avg(value) filter (status = 'scored'), 4) as value from s group by 1""")
def eval_scored_means(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events")
    status = F.when((F.col("event_type") == "error") & (F.col("value") > 50), "failed").when(F.col("value") < 5, "unannotated").otherwise("scored")
    return evaluation.means_over_scored(e.withColumn("status", status), ["event_type"], ["value"], "status")


@query("""
with a as (select patient_id, min(row_id) as i, max(row_id) as j from demographics where patient_id is not null group by 1),
l as (""" + " union all ".join(f"select a.patient_id, '{c}' as path, x.{c} as l, y.{c} as r from a join demographics x on x.row_id = a.i join demographics y on y.row_id = a.j" for c in ANSWER_FIELDS) + """)
select patient_id, path, l as "left", r as "right", 'changed' as change from l where l is distinct from r""")
def diff_deep(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "demographics").where(F.col("patient_id").isNotNull())
    ends = g.groupBy("patient_id").agg(F.min("row_id").alias("i"), F.max("row_id").alias("j"))
    side = lambda end: evaluation.flattened(g.join(ends.select(F.col(end).alias("row_id")), "row_id", "left_semi"), ["patient_id"], ANSWER_FIELDS)
    return evaluation.deep_diff(side("i"), side("j"), ["patient_id"])


# --- runs ---


def _log(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events")


@query("""
select user_id, (array_agg(event_type order by ts desc, event_id desc))[1] as last_state, cast(max(ts) as varchar) as last_ts, count(*) as transitions from events group by 1""")
def run_last_state(spark: SparkSession, d: str) -> DataFrame:
    out = runs.last_states(_log(spark, d), ["user_id"], "event_type", "ts", "event_id")
    return out.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz").cast("string"))


@query("select user_id, event_type, count(*) as n from events group by all")
def run_state_counts(spark: SparkSession, d: str) -> DataFrame:
    return runs.state_counts(_log(spark, d), "user_id", "event_type")


@query("""
with g as (select user_id, count(*) filter (event_type = 'error' and value > 99) as failed, count(*) filter (event_type = 'purchase') as worked, bool_or(event_type = 'signup') as tables,
           count(*) filter (event_type = 'error' and value > 80) as bad, count(*) filter (event_type = 'view' and value < 1) as skipped from events group by 1)
select user_id, case when failed > 0 then 'failed' when worked = 0 then 'no_work' when not tables then 'tables_missing' when bad > 0 then 'extraction_failures' when skipped > 0 then 'skipped' else 'completed' end as status from g""")
def run_status(spark: SparkSession, d: str) -> DataFrame:
    e, v = F.col("event_type"), F.col("value")
    g = _log(spark, d).groupBy("user_id").agg(
        F.count_if((e == "error") & (v > 99)).alias("failed"), F.count_if(e == "purchase").alias("worked"), F.bool_or(e == "signup").alias("tables"),
        F.count_if((e == "error") & (v > 80)).alias("bad"), F.count_if((e == "view") & (v < 1)).alias("skipped"),
    )
    return g.select("user_id", runs.run_status(F.col("failed"), F.col("worked"), F.col("tables"), F.col("bad"), F.col("skipped")).alias("status"))


@query("""
with o as (select user_id, event_type, ts, event_id, coalesce(sum(case when event_type = 'purchase' then 1 else 0 end) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as k
           from events where event_type in ('view', 'purchase')),
p as (select user_id, k, max(ts) filter (event_type = 'view') as a, max(ts) filter (event_type = 'purchase') as z from o group by all),
s as (select user_id, (epoch_us(z) - epoch_us(a)) / 1e6 as s from p where a is not null and z is not null)
select user_id, count(*) as pairs, round(avg(s) filter (s > 0.05), 3) as mean_seconds from s group by 1""")
def run_progress(spark: SparkSession, d: str) -> DataFrame:
    return runs.durations(_log(spark, d).withColumn("ts", F.col("ts").cast("timestamp")), ["user_id"], "event_type", "ts", "event_id", "view", "purchase")


@query("select user_id, count(*) as calls, sum(cast(event_id % 97 as bigint))::bigint as input_tokens, sum(cast(event_id % 13 as bigint))::bigint as output_tokens, bool_and(value > 1) as all_cached from events group by 1")
def run_economics(spark: SparkSession, d: str) -> DataFrame:
    calls = _log(spark, d).select("user_id", (F.col("event_id") % 97).alias("input_tokens"), (F.col("event_id") % 13).alias("output_tokens"), (F.col("value") > 1).alias("cached"))
    return runs.economics(calls, ["user_id"])


@query("select event_type, count(*) as entries, count(distinct user_id) as entities from (select distinct user_id, event_type, props from events) group by 1")
def state_merge_dedup(spark: SparkSession, d: str) -> DataFrame:
    e = _log(spark, d).select("user_id", "event_type", "props")
    late, merged = e.where(F.col("event_type") == "error"), e
    log = runs.merged_log([merged, late], F.concat_ws("|", F.col("user_id").cast("string"), "event_type", "props"))
    return log.groupBy("event_type").agg(F.count("*").alias("entries"), F.count_distinct("user_id").alias("entities"))


@query("""
select m.patient_id, m.medication from (select distinct patient_id, medication from med_orders) m
where not exists (select 1 from med_admin a where a.patient_id = m.patient_id and a.medication = m.medication and a.mar_action = 'Given')""")
def run_unfinished(spark: SparkSession, d: str) -> DataFrame:
    wanted = load(spark, d, "med_orders").select("patient_id", "medication").distinct()
    done = load(spark, d, "med_admin").select("patient_id", "medication", (F.col("mar_action") == "Given").alias("ok"))
    return runs.unfinished(wanted, done, ["patient_id"], ["medication"])


# --- validation ---


@query(r"""
with o as (select row_id, nullif(regexp_extract(trim(start_date), '^(\d{4}-\d{2}-\d{2})(?:[T ].*)?$', 1), '') as a, nullif(regexp_extract(trim(end_date), '^(\d{4}-\d{2}-\d{2})(?:[T ].*)?$', 1), '') as b from med_orders),
p as (select row_id, try_cast(a as date) as a, try_cast(b as date) as b from o)
select row_id, 'start_before_end' as rule, case when a is null or b is null then 'did_not_run' when b < a then 'failed' else 'passed' end as outcome from p
union all select row_id, 'within_a_month', case when a is null or b is null then 'did_not_run' when abs((year(b) * 12 + month(b)) - (year(a) * 12 + month(a))) > 1 then 'failed' else 'passed' end from p""")
def invariants_dates(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("__a"), F.col("__b")
    o = validation.with_intervals(load(spark, d, "med_orders").select("row_id", "start_date", "end_date"), __a="start_date", __b="end_date")
    return validation.outcomes(o, ["row_id"], {"start_before_end": lambda: validation.ordered(a, b), "within_a_month": lambda: ~validation.not_adjacent(a, b)})


@query("""
with o as (select patient_id, row_id, row_number() over (partition by patient_id order by row_id) as line, substr(start_date, 1, 10) as s from med_orders where start_date is not null),
p as (select *, lag(s) over (partition by patient_id order by line, s) as previous from o)
select patient_id, cast(line as int) as line, s as start_day, previous, coalesce(previous <= s, true) as ok from p""")
def invariants_line_order(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "med_orders").where(F.col("start_date").isNotNull())
    o = o.select("patient_id", F.row_number().over(W.partitionBy("patient_id").orderBy("row_id")).alias("line"), F.substring("start_date", 1, 10).alias("start_day"))
    return validation.lines_in_order(o, ["patient_id"], "line", "start_day")


@query(r"""
with l as (select row_id, 'order' as parent, bool_or(regexp_matches(medication, '\S')) as v, bool_or(trim(prescribing_provider) <> '') as p from med_orders group by 1
  union all select row_id, 'dose', bool_or(trim(disp) <> '' and lower(trim(disp)) <> 'unknown'), bool_or(trim(number_of_times) <> '') from med_orders group by 1)
select row_id, parent from l where coalesce(v, false) and not coalesce(p, false)""")
def provenance_paths(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(p).alias("parent"), F.lit(k).alias("key"), F.col(c).alias("value")) for p, k, c in [("order", "medication", "medication"), ("order", "evidence_chunk_id", "prescribing_provider"), ("dose", "amount", "disp"), ("dose", "evidence_chunk_id", "number_of_times")]])
    leaves = load(spark, d, "med_orders").select("row_id", F.explode(pairs).alias("p")).select("row_id", "p.*")
    return validation.unpointed_groups(leaves, ["row_id"], "parent", "key", "value")


@query("""
select row_id, '$.sex' as path from demographics where lower(trim(legal_sex)) not in ('', 'unknown') and coalesce(patient_id, '') = ''
union all select row_id, '$.language' from demographics where lower(trim(language)) not in ('', 'unknown')""")
def validate_provenance_json(spark: SparkSession, d: str) -> DataFrame:
    made = F.to_json(F.struct(F.struct(F.col("legal_sex").alias("value"), F.col("patient_id").alias("evidence_chunk_id")).alias("sex"), F.struct(F.col("language").alias("value")).alias("language")))
    return validation.unprovenanced(load(spark, d, "demographics").select("row_id", made.alias("data")), ["row_id"], "data")


# --- de-identification ---

# Written out by hand, so that a slip in the operator's own tables shows.
_DOC_TYPE = """case
  when t in ('pathology','radiology','progress_note','clinical_note','discharge_summary','operative_note','consult','laboratory','medication','diagnosis','demographics','encounter','procedure','order','flowsheet','immunization','unknown') then t
  when t like '%patholog%' then 'pathology' when t like '%radiolog%' or t like '%imaging%' then 'radiology'
  when t like '%discharge%' then 'discharge_summary' when t like '%operative%' or t like '%op note%' then 'operative_note'
  when t like '%consult%' then 'consult' when t like '%immuniz%' then 'immunization' when t like '%flowsheet%' then 'flowsheet'
  when t like '%med\\_admin%' escape '\\' or t like '%med\\_order%' escape '\\' or t like '%medication%' then 'medication' when t like '%laborator%' then 'laboratory'
  when t like '%diagnos%' then 'diagnosis' when t like '%demographic%' then 'demographics' when t like '%encounter%' then 'encounter'
  when t like '%procedure%' then 'procedure' when t like '%progress%' then 'progress_note' when t like '%order%' then 'order'
  when t like '%clinical%' or t like '%note%' then 'clinical_note' when t like '%lab%' then 'laboratory' else 'unknown' end"""


@query(f"with d as (select doc_id, doc_type as raw, lower(trim(doc_type)) as t from documents), c as (select *, {_DOC_TYPE} as k from d) select doc_id, k as doc_type, coalesce(trim(raw) <> '', false) and k = 'unknown' as unmapped from c")
def deid_doc_type(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", deid.canonical_doc_type(F.col("doc_type")).alias("doc_type"), deid.is_unmapped(F.col("doc_type")).alias("unmapped"))


@query(f"""with c as (select title as raw, lower(trim(title)) as t from clinical_note union all select type, lower(trim(type)) from clinical_note),
k as (select {_DOC_TYPE} as doc_type, raw from c) select doc_type, count(*) as n, count(*) filter (trim(raw) <> '' and doc_type = 'unknown') as unmapped from k group by 1""")
def deid_doc_types_of_notes(spark: SparkSession, d: str) -> DataFrame:
    n = load(spark, d, "clinical_note")
    every = n.select(F.col("title").alias("raw")).unionByName(n.select(F.col("type").alias("raw")))
    marked = every.select(deid.canonical_doc_type(F.col("raw")).alias("doc_type"), deid.is_unmapped(F.col("raw")).alias("u"))
    return marked.groupBy("doc_type").agg(F.count("*").alias("n"), F.count_if("u").alias("unmapped"))


@query("""
with c as (select site_code, language, count(*) as n from demographics group by all)
select site_code, language, case when n >= 11 then n end as n, case when n < 11 then '<11' end as band from c""")
def deid_small_cells(spark: SparkSession, d: str) -> DataFrame:
    return deid.small_cells(load(spark, d, "demographics").groupBy("site_code", "language").agg(F.count("*").alias("n")), "n", "band")


@query("select site_code, language, count(*) as n from demographics group by all having count(*) >= 11")
def deid_small_cells_dropped(spark: SparkSession, d: str) -> DataFrame:
    return deid.small_cells(load(spark, d, "demographics").groupBy("site_code", "language").agg(F.count("*").alias("n")), "n")


def _forbidden(c: str, field: str = "") -> str:
    """The rule in SQL, written out by hand: no safe shape, or a file's name or forbidden content in one."""
    m = lambda p: f"regexp_matches({c}, '{p}')"
    capitals = "" if field in ("site_id", "study_id") else f"and not ({m('^[A-Za-z]+$')} and {m('[A-Z]')})"
    safe = f"""{c} = '' or {m('^surr:v1:(run|study|site):[a-z][a-z0-9_]*:[0-9a-f]{24}$')} or {m('^sha256:[0-9a-f]{3,64}$')}
  or ({m('^([0-9a-f]{16}|[0-9a-f]{64})$')} and {m('[a-f]')}) or {m('^([0-9]{4}-[0-9]{2}|unknown)$')}
  or {m('^(v[0-9]+([.][0-9]+)*|[0-9]+[.][0-9]+([.][0-9]+)*|[A-Za-z0-9_]+/v[0-9]+)$')} {"or " + m('^[0-9]{8}_[A-Za-z0-9_]+$') if field == "run_id" else ""}
  or (length({c}) <= 80 and {m('^[A-Za-z0-9_./-]+$')} and not {m('[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}')} and not {m('[0-9]{5}')} {capitals})"""
    bad = "|".join([
        r"\.(csv|tsv|xls|xlsx|xlsm|json|jsonl|parquet|txt|pdf|doc|docx|htm|html|xml|rtf|dat|dcm|out|log)\b", r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", r"\bmrn\s*[:=]?\s*[0-9]", r"\bdob\s*[:=]?\s*[0-9]",
        r"date\s+of\s+birth\s*:", r"patient_name\s*[:=]", r"chief\s+complaint", r"history\s+of\s+present\s+illness", r"assessment\s+and\s+plan", r"patient\s+present", r"physical\s+exam",
        r"/ehr/", r"/mrn/", r"/mrns/", r"clarity[_/-]", r"ssn[:=]", r"\b(gs|id|mrn)[0-9]+\b", r"\bpt[_-]?[0-9]+\b",
    ])
    return f"coalesce(not ({safe}) or regexp_matches({c}, '(?i){bad}'), false)"


# Ids and months are there to show what passes; names, prose and bare numbers don't.
_SCANNED = """(select cast(row_id as varchar) as row_id, author, title, text, site_code, 'surr:v1:study:patient_id:' || substr(sha256(patient_id), 1, 24) as surrogate, substr(sha256(text), 1, 16) as fingerprint, patient_id from clinical_note)"""


@query(f"select row_id, {', '.join(f'{_forbidden(c)} as {c}_forbidden' for c in ('text', 'author', 'title', 'surrogate', 'fingerprint', 'patient_id'))}, {_forbidden('site_code', 'site_id')} as site_id_forbidden, {_forbidden('site_code')} as site_code_forbidden from {_SCANNED}")
def deid_forbidden_scan(spark: SparkSession, d: str) -> DataFrame:
    n = load(spark, d, "clinical_note").select(
        F.col("row_id").cast("string").alias("row_id"), "author", "title", "text", "patient_id", "site_code", F.col("site_code").alias("site_id"),
        F.concat(F.lit("surr:v1:study:patient_id:"), F.substring(F.sha2("patient_id", 256), 1, 24)).alias("surrogate"), F.substring(F.sha2("text", 256), 1, 16).alias("fingerprint"),
    )
    return n.select("row_id", *[deid.is_forbidden(F.col(c), c).alias(f"{c}_forbidden") for c in ("text", "author", "title", "surrogate", "fingerprint", "patient_id", "site_id", "site_code")])


@query(f"""with w as (select case row_id % 6 when 0 then author when 1 then 'row_' || row_id % 100 when 2 then '2024-05' when 3 then 'note_' || substr(date, 1, 10) when 4 then 'report.csv' else 'MRN ' || row_id end as value from clinical_note),
l as (select unnest(['no safe shape', 'file name', 'absolute date', 'record number']) as label)
select label, count(*) as n from w, l where value is not null and case label when 'no safe shape' then not regexp_matches(value, '^([A-Za-z0-9_./-]+)$') or regexp_matches(value, '[0-9]{{1,4}}[-/][0-9]{{1,2}}[-/][0-9]{{1,4}}|[0-9]{{5}}') or regexp_matches(value, '^[A-Za-z]+$') and regexp_matches(value, '[A-Z]')
  when 'file name' then value = 'report.csv' when 'absolute date' then regexp_matches(value, '\\b[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\b') else regexp_matches(value, '(?i)\\bMRN [0-9]') end
  and value <> '' and not value = '2024-05' group by 1""")
def deid_violation_labels(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    value = (
        F.when(r % 6 == 0, F.col("author")).when(r % 6 == 1, F.concat(F.lit("row_"), r % 100)).when(r % 6 == 2, "2024-05")
        .when(r % 6 == 3, F.concat(F.lit("note_"), F.substring("date", 1, 10))).when(r % 6 == 4, "report.csv").otherwise(F.concat(F.lit("MRN "), r))
    )
    return load(spark, d, "clinical_note").select(F.explode(deid.violations(value)).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query(f"""with g as (select *, {_forbidden('author')} as a, {_forbidden('title')} as t, {_forbidden('site_code', 'site_id')} as s from clinical_note)
select count(*) filter (not a and not t and not s) as written, count(*) filter (a or t or s) as rejected, count(*) filter (a) as for_author from g""")
def deid_write_gate(spark: SparkSession, d: str) -> DataFrame:
    good, bad = deid.gated(load(spark, d, "clinical_note").select("author", "title", F.col("site_code").alias("site_id")), ["author", "title", "site_id"])
    sides = good.select(F.lit(True).alias("ok"), F.lit(False).alias("a")).unionByName(bad.select(F.lit(False).alias("ok"), F.array_contains("rejected_for", "author").alias("a")))
    return sides.agg(F.count_if("ok").alias("written"), F.count_if(~F.col("ok")).alias("rejected"), F.count_if("a").alias("for_author"))


@query(f"""with p as (select distinct patient_id from demographics where trim(patient_id) <> ''),
c as (select 'pointer' as k, patient_id || ':note:' || row_id as v from clinical_note union all select 'title', title from clinical_note
  union all select 'site_id', site_code from clinical_note),
m as (select k, {_forbidden('v')} and not (k = 'site_id' and not {_forbidden('v', 'site_id')}) as bad, exists (select 1 from p where contains(v, p.patient_id)) as hit from c where v is not null)
select k as "column", count(*) filter (bad) as forbidden, count(*) filter (hit) as with_id from m group by 1 having count(*) filter (bad or hit) > 0""")
def deid_egress(spark: SparkSession, d: str) -> DataFrame:
    n = load(spark, d, "clinical_note").select(F.concat_ws(":", F.when(F.col("patient_id").isNotNull(), F.col("patient_id")), F.lit("note"), "row_id").alias("pointer"), "title", F.col("site_code").alias("site_id"), "patient_id")
    n = n.withColumn("pointer", F.when(F.col("patient_id").isNotNull(), F.col("pointer")))
    return deid.verified_export(n, ["pointer", "title", "site_id"], load(spark, d, "demographics"), "patient_id")


@query("""select row_id, site_code is not null and (case row_id % 4 when 0 then 'bm25' when 1 then 'embedding' when 2 then 'hybrid' else 'vector' end) in ('bm25', 'embedding', 'hybrid', 'exact', 'direct_parquet', 'unknown')
  and (row_id % 5 = 0 or row_id % 5 = 1) as valid from clinical_note""")
def deid_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    rows = load(spark, d, "clinical_note").select(
        "row_id", "site_code", F.when(r % 4 == 0, "bm25").when(r % 4 == 1, "embedding").when(r % 4 == 2, "hybrid").otherwise("vector").alias("retriever"),
        F.when(r % 5 == 0, "stop").when(r % 5 == 1, "length").otherwise("Stop").alias("finish_reason"),
    )
    return deid.constrained(rows, {c: deid.VOCABULARIES[c] for c in ("retriever", "finish_reason")}, ["site_code", "retriever"]).select("row_id", "valid")


@query("""select row_id, (row_id % 7 <> 0) and row_id % 3 in (0, 1) and patient_id is not null and regexp_matches(case when row_id % 11 = 0 then date else '2024-05' end, '^([0-9]{4}-[0-9]{2}|unknown)$') as valid from clinical_note
where row_id is not null""")
def deid_records(spark: SparkSession, d: str) -> DataFrame:
    r, lit = F.col("row_id"), F.lit
    fixed = {c: lit("x") for c in deid.REVIEW_HEADER.split()} | {"record_type": lit("relevance_label"), "reviewer_surrogate": lit("x"), "chunk_surrogate": lit("x")}
    fixed |= {
        "emitted_month": F.when(r % 11 == 0, F.col("date")).otherwise("2024-05"), "patient_surrogate": F.sha2("patient_id", 256),
        "reviewer_tier": F.when(r % 7 == 0, None).otherwise("expert"), "label": F.when(r % 3 == 0, "relevant").when(r % 3 == 1, "unsure").otherwise("maybe"), "step_id": r.cast("string"),
    }
    n = load(spark, d, "clinical_note").select(*[v.alias(k) for k, v in fixed.items()])
    return deid.valid_record(n, "relevance_label").select(F.col("step_id").cast("long").alias("row_id"), F.coalesce("valid", lit(False)).alias("valid"))


@query(f"with {_bm25()} select source, count(*) as n, count(*) filter (rank <= 5) as n_selected, md5(string_agg(sha256(chunk_id::varchar), ',' order by rank)) as hashes from rk where rank <= 20 group by 1")
def deid_selection_rows(spark: SparkSession, d: str) -> DataFrame:
    found = retrieval.bm25(_docs(spark, d), "source", "doc_id", "text", QUESTION, 20).withColumn("selected", F.col("rank") <= 5)
    out = deid.selection_rows(found, ["source"])
    hashes = F.md5(F.array_join(F.transform("candidates", lambda c: c["chunk_hash"]), ","))
    return out.select("source", F.size("candidates").cast("long").alias("n"), "n_selected", hashes.alias("hashes"))


@query("""with t as (select row_id, row_id % 6 = 5 as passed, case row_id % 6 when 0 then 'JSONDecodeError: line ' || row_id when 1 then 'Empty content in ' || sig when 2 then 'answer was not a JSON object' when 3 then 'EMPTY_EVIDENCE' else coalesce(order_status, 'crashed') end as m from med_orders)
select row_id, case when m like 'JSONDecode%' then 'parse_failure' when m like 'Empty content%' then 'parse_failure' when m like '%not a JSON%' then 'parse_failure' when m = 'EMPTY_EVIDENCE' then 'empty_evidence' when passed or m is null then 'unknown' else 'validation_failure' end as error_kind,
  case when m like 'JSONDecode%' then 'json_decode_error' when m like 'Empty content%' then 'empty_content' when m like '%not a JSON%' then 'not_a_json_object' else 'none' end as parse_failure_kind from t""")
def deid_error_buckets(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("row_id")
    message = (
        F.when(r % 6 == 0, F.concat(F.lit("JSONDecodeError: line "), r)).when(r % 6 == 1, F.concat(F.lit("Empty content in "), "sig")).when(r % 6 == 2, "answer was not a JSON object")
        .when(r % 6 == 3, "EMPTY_EVIDENCE").otherwise(F.coalesce("order_status", F.lit("crashed")))
    )
    return load(spark, d, "med_orders").select("row_id", deid.error_bucket(message, r % 6 == 5).alias("b")).select("row_id", "b.*")


_PADS = [bytes(x ^ y for x in b"test key".ljust(64, b"\0")).hex() for y in (0x36, 0x5C)]


# HMAC by its definition: two hashes over the key's pads.
@query(f"select chunk_id, 'surr:v1:study:chunk_id:' || left(sha256(unhex('{_PADS[1]}') || unhex(sha256(unhex('{_PADS[0]}') || encode('v1|study|evidence_chunk|chunk_id|' || chunk_id)))), 24) as surrogate from chunk_index")
def deid_surrogate(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "chunk_index")
    return c.select("chunk_id", deid.surrogate(F.col("chunk_id"), b"test key", "study", "evidence_chunk", "chunk_id").alias("surrogate"))


@query("select chunk_id, regexp_extract(document_date, '(\\d{4})-?(\\d{2})', 1) || '-' || regexp_extract(document_date, '(\\d{4})-?(\\d{2})', 2) as month from chunk_index where regexp_matches(document_date, '\\d{4}-?\\d{2}')")
def deid_month_stamp(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "chunk_index").where(F.col("document_date").rlike(r"\d{4}-?\d{2}"))
    return c.select("chunk_id", deid.month_stamp(F.col("document_date")).alias("month"))


# --- recipes ---


_ECHO = """'{"evidence_chunk_id": ' || coalesce('"' || nullif(regexp_extract(u, 'chunk_id=(\\S+)', 1), '') || '"', 'null') || ', "value": "' || left(sha256(sys || u), 12) || '"}'"""


# What the echoing provider says is a hash of the prompt, so SQL can say it, too.
@query(f"""with {_PACK}, pk as (select source, 'Answer from the passages.' as sys, string_agg(rendered, chr(10) || chr(10) order by final_rank) as u from bt group by 1)
select source, {_ECHO} as data, true as ok, cast(null as varchar) as error, 0 as rejected, 1 as calls, cast(greatest(1, length(u) // 4) as int) as input_tokens from pk""")
def recipe_retrieve_and_prompt(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.plans.recipes import HANDLERS, EchoProvider

    made = _blocks(spark, d)
    packed = packing.packets(made, ["source"]).join(made.groupBy("source").agg(F.collect_set("chunk_id").alias("shown")), "source")
    return HANDLERS["retrieve_and_prompt"](packed, ["source"], {"prompt": "Answer from the passages."}, EchoProvider(200_000))


@query()
def recipe_run(spark: SparkSession, d: str) -> DataFrame:
    """Two recipes with all kinds of step but python, one over the other's answer; a row per patient, recipe and step."""
    from chartweave.plans.recipes import EchoProvider, parse_recipe
    from chartweave.plans.runner import Corpus, run_recipes

    docs = _docs(spark, d).select("patient_id", F.col("doc_id").alias("chunk_id"), "text", "title", "doc_type", "document_date", F.lit(None).cast("string").alias("author"), "source").where("patient_id is not null")
    orders = load(spark, d, "med_orders").where("patient_id is not null")
    found = {"id": "find", "kind": "retrieve_and_prompt", "prompt": "Answer from the passages.", "retrieval": {"kind": "hybrid", "query": QUESTION, "k": 10}, "filters": [{"field": "document_date", "op": ">=", "value": "2000-01-01", "keep_if_missing": True}], "reranking": {"top_n": 5, "chronological_order": True}, "also_include_tables": [{"name": "med_orders", "filter": "medication contains 'TABLET'", "columns": ["medication", "route"], "max_rows": 3}], "stop_if": "data is not null"}
    rows = {"table": "med_orders", "columns": ["medication", "route"], "max_rows": 2}
    made = [
        {"name": "evidence", "version": 1, "steps": [found, {"id": "rows", "kind": "direct_parquet", **rows}]},
        {"name": "summary", "version": 1, "depends_on": ["evidence"], "steps": [{"id": "each", "kind": "map_table_rows_and_prompt", "prompt": "One answer per row.", **rows}, {"id": "sum", "kind": "llm_only", "prompt": "{{ evidence }} {{ each }}"}]},
    ]
    groups = docs.select("patient_id").union(orders.select("patient_id")).distinct()
    steps, _ = run_recipes({r["name"]: parse_recipe(r) for r in made}, ["summary"], Corpus("patient_id", groups, docs, {"med_orders": (orders, "row_id")}), EchoProvider(200_000))
    return steps


@query(f"""with r as (select item_id, 'One answer per row.' as sys, concat_ws(chr(10), case when regexp_matches(variable, '\\S') then 'variable: ' || variable end, case when regexp_matches(query_text, '\\S') then 'query_text: ' || query_text end) as u from eval_passage)
select item_id, {_ECHO} as data, true as ok, cast(null as varchar) as error, 0 as rejected, 1 as calls, cast(greatest(1, length(u) // 4) as int) as input_tokens from r""")
def recipe_map_rows(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.plans.recipes import HANDLERS, EchoProvider

    rows = load(spark, d, "eval_passage").select("item_id", "variable", "query_text")
    return HANDLERS["map_table_rows_and_prompt"](rows, ["item_id"], {"prompt": "One answer per row."}, EchoProvider())


@query(f"""
with g as (select distinct patient_id from demographics where patient_id is not null),
o as (select patient_id, row_id, medication, route from med_orders where patient_id is not null and (regexp_matches(medication, '\\S') or regexp_matches(route, '\\S'))),
j as (select *, '{{"row_id":' || row_id || coalesce(',"medication":' || to_json(medication)::varchar, '') || coalesce(',"route":' || to_json(route)::varchar, '') || '}}' as js,
        concat_ws(chr(10), case when regexp_matches(medication, '\\S') then 'medication: ' || medication end, case when regexp_matches(route, '\\S') then 'route: ' || route end) as u, 'One answer per row.' as sys from o),
a as (select patient_id, '[' || string_agg(js, ',' order by row_id) || ']' as data from (select * from j where contains(medication, 'TABLET') qualify row_number() over (partition by patient_id order by row_id) <= 2) group by 1),
b as (select patient_id, '[' || string_agg('{{"row_id":' || row_id || ',"data":' || to_json({_ECHO})::varchar || '}}', ',' order by row_id) || ']' as data, count(*) as calls, sum(greatest(1, length(u) // 4)) as tokens
      from (select * from j qualify row_number() over (partition by patient_id order by row_id) <= 2) group by 1),
c as (select a.patient_id, '' as sys, a.data || ' / ' || coalesce(b.data, '') as u from a join g on g.patient_id = a.patient_id left join b on b.patient_id = a.patient_id)
select g.patient_id, 'rows' as step, case when a.data is null then 'stopped' else 'complete' end as status, a.data, case when a.data is null then 'empty_evidence' end as error, cast(0 as bigint) as calls, cast(0 as bigint) as input_tokens from g left join a on a.patient_id = g.patient_id
union all select g.patient_id, 'each', case when a.data is null then 'skipped' else 'complete' end, case when a.data is not null then b.data end, null, case when a.data is not null then b.calls end, case when a.data is not null then b.tokens end from g left join a on a.patient_id = g.patient_id left join b on b.patient_id = g.patient_id
union all select g.patient_id, 'sum', case when c.u is null then 'skipped' else 'complete' end, case when c.u is not null then {_ECHO} end, null, case when c.u is not null then 1 end, case when c.u is not null then greatest(1, length(c.u) // 4) end from g left join c on c.patient_id = g.patient_id""")
def recipe_steps(spark: SparkSession, d: str) -> DataFrame:
    """Three steps one after the other: rows of a table, which stop a patient who has none, an answer for each row, and one over both."""
    from chartweave.plans.recipes import EchoProvider, parse_recipe
    from chartweave.plans.runner import Corpus, run_recipes

    orders = load(spark, d, "med_orders").where("patient_id is not null")
    rows = {"table": "med_orders", "columns": ["medication", "route"], "max_rows": 2}
    recipe = {"name": "tablets", "version": 1, "steps": [
        {"id": "rows", "kind": "direct_parquet", **rows, "filter": "medication contains 'TABLET'", "stop_if": "data is null"},
        {"id": "each", "kind": "map_table_rows_and_prompt", "prompt": "One answer per row.", **rows},
        {"id": "sum", "kind": "llm_only", "prompt": "{{ rows }} / {{ each }}"},
    ]}
    groups = load(spark, d, "demographics").select("patient_id").where("patient_id is not null").distinct()
    docs = spark.createDataFrame([], "patient_id string, chunk_id string, text string, title string, doc_type string, document_date string, author string, source string")
    steps, _ = run_recipes({"tablets": parse_recipe(recipe)}, ["tablets"], Corpus("patient_id", groups, docs, {"med_orders": (orders, "row_id")}), EchoProvider(200_000))
    return steps.select("patient_id", "step", "status", "data", "error", F.col("calls").cast("long").alias("calls"), F.col("input_tokens").cast("long").alias("input_tokens"))


@query("select distinct row_id, medication, route from med_orders where contains(medication, 'TABLET')")
def recipe_direct_rows(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.plans.recipes import HANDLERS

    return HANDLERS["direct_parquet"](load(spark, d, "med_orders"), ["row_id"], {"filter": "medication contains 'TABLET'", "columns": ["medication", "route"]})


@query("select row_id, cast(cast(substr(trim(recent_encounter_date), 1, 4) as int) - floor(try_cast(age_at_death as double)) as int) as birth_year from demographics where try_cast(substr(trim(recent_encounter_date), 1, 4) as int) is not null")
def recipe_birth_year(spark: SparkSession, d: str) -> DataFrame:
    from chartweave.plans.recipes import birth_year

    g = load(spark, d, "demographics").where(F.substring(F.trim("recent_encounter_date"), 1, 4).try_cast("int").isNotNull())
    return g.select("row_id", birth_year(F.col("recent_encounter_date"), F.col("age_at_death")).alias("birth_year"))
