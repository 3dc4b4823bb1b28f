"""Recipes: declared steps with dependencies, model calls behind a provider, and the assembly of their answers."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartweave.operators.validation import is_pointer
from chartweave.plans.filters import Filter
from chartweave.sources.sinks import ResponseCache

STEP_KEYS = {"id", "kind", "prompt", "retrieval", "reranking", "filters", "table", "columns", "filter", "stop_if", "max_rows", "also_include_tables", "function", "schema"}
#: What a step of each kind reads beside its id, kind and ``stop_if``; anything else would be without effect and is refused.
_ROWS = {"table", "filter", "columns", "max_rows"}
READS = {"retrieve_and_prompt": {"prompt", "retrieval", "reranking", "filters", "also_include_tables"}, "map_table_rows_and_prompt": _ROWS | {"prompt"}, "llm_only": {"prompt"}, "direct_parquet": _ROWS, "python": _ROWS | {"function", "schema"}}
RETRIEVAL = {"bm25": {"kind", "query", "query_from", "k"}, "exact": {"kind", "query", "k"}, "hybrid": {"kind", "query", "k", "members", "method", "weights"}}
TABLE_KEYS = {"name", "filter", "columns", "max_rows"}
RECIPE_KEYS = {"name", "version", "archetype", "depends_on", "steps", "draft", "output_schema", "validation"}
ARCHETYPES = {"single_value", "list_of_records", "table_lookup"}
OVERRIDES = {"top_n", "chronological_order"}


@dataclass(frozen=True)
class Step:
    id: str
    kind: str
    settings: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Recipe:
    name: str
    version: int
    steps: tuple[Step, ...]
    depends_on: tuple[str, ...] = ()
    archetype: str = "single_value"


HANDLERS: dict[str, Callable] = {}


def handler(kind: str) -> Callable[[Callable], Callable]:
    """Registers a step's function under its kind; a kind has one."""

    def add(f: Callable) -> Callable:
        if kind in HANDLERS:
            raise ValueError(f"{kind} has a handler already")
        HANDLERS[kind] = f
        return f

    return add


def parse_recipe(raw: dict, folder: str | None = None) -> Recipe:
    """A checked recipe: closed key sets, known kinds and archetypes, name and version as its folder says, no draft."""
    if unknown := set(raw) - RECIPE_KEYS:
        raise ValueError(f"unknown keys {sorted(unknown)}")
    if raw.get("draft"):
        raise ValueError("a draft isn't run")
    name, version = raw["name"], int(raw["version"])
    if folder is not None and folder != f"{name}_v{version}":
        raise ValueError(f"folder {folder} isn't {name}_v{version}")
    if raw.get("archetype", "single_value") not in ARCHETYPES:
        raise ValueError(f"unknown archetype {raw['archetype']!r}")
    steps, seen = [], set()
    for s in raw["steps"]:
        if unknown := set(s) - STEP_KEYS:
            raise ValueError(f"unknown keys in step {s.get('id')}: {sorted(unknown)}")
        if s["kind"] not in HANDLERS:
            raise ValueError(f"unknown kind {s['kind']!r}; known: {sorted(HANDLERS)}")
        if unread := set(s) - READS.get(s["kind"], STEP_KEYS) - {"id", "kind", "stop_if"}:
            raise ValueError(f"a step of kind {s['kind']} doesn't read {sorted(unread)}")
        if (r := s.get("retrieval")) is not None and (r.get("kind") not in RETRIEVAL or len({"query", "query_from"} & set(r)) != 1 or not set(r) <= RETRIEVAL[r["kind"]]):
            raise ValueError(f"step {s['id']}: retrieval is a query by one of {sorted(RETRIEVAL)} with its own keys, not {r}")
        for t in s.get("also_include_tables", []):
            if not {"name"} <= set(t) <= TABLE_KEYS:
                raise ValueError(f"step {s['id']}: a table has a name and {sorted(TABLE_KEYS - {'name'})}, not {sorted(t)}")
        if s["id"] in seen:
            raise ValueError(f"step {s['id']} twice")
        if unknown := set(s.get("reranking", {})) - OVERRIDES:
            raise ValueError(f"a step can't override {sorted(unknown)}")
        for f in s.get("filters", []):
            Filter(f["field"], f["op"], f["value"], f.get("keep_if_missing", False)).checked()
        seen.add(s["id"])
        steps.append(Step(s["id"], s["kind"], {k: v for k, v in s.items() if k not in ("id", "kind")}))
    return Recipe(name, version, tuple(steps), tuple(raw.get("depends_on", ())), raw.get("archetype", "single_value"))


def planned(recipes: dict[str, Recipe], requested: list[str]) -> tuple[list[str], list[str]]:
    """``(order, missing)``: the requested recipes with all they depend on, dependencies first, ties by name; a cycle is an error."""
    need, missing, todo = set(), set(), list(requested)
    while todo:
        n = todo.pop()
        if n in need or n in missing:
            continue
        if n not in recipes:
            missing.add(n)
            continue
        need.add(n)
        todo += recipes[n].depends_on
    left = {n: {d for d in recipes[n].depends_on if d in need} for n in need}
    order = []
    while left:
        ready = sorted(n for n, deps in left.items() if not deps)
        if not ready:
            raise ValueError(f"these depend on each other: {sorted(left)}")
        order.append(ready[0])
        del left[ready[0]]
        for deps in left.values():
            deps.discard(ready[0])
    return order, sorted(missing)


def highest_version(names: list[str]) -> dict[str, str]:
    """recipe -> its folder of the highest version, numerically."""
    best: dict[str, tuple[int, str]] = {}
    for n in names:
        if m := re.fullmatch(r"(.+)_v(\d+)", n):
            best[m[1]] = max(best.get(m[1], (0, "")), (int(m[2]), n))
    return {k: v[1] for k, v in best.items()}


def newest_run(ids: list[str]) -> str | None:
    return max(ids, default=None)


def loaded_prompt(text: str) -> dict[str, Any]:
    """Front matter of ``key: value`` lines, and the SYSTEM and USER parts."""
    meta = {}
    if m := re.match(r"---\n(.*?)\n---\n", text, re.S):
        meta = {k.strip(): v.strip() for k, v in (line.split(":", 1) for line in m[1].splitlines() if ":" in line)}
        text = text[m.end() :]
    parts = re.split(r"^(SYSTEM|USER):\s*$", text, flags=re.M)
    named = {k: v.strip() for k, v in zip(parts[1::2], parts[2::2])}
    return {"meta": meta, "system": named.get("SYSTEM", ""), "user": named.get("USER", text.strip() if not named else "")}


SLOT = re.compile(r"\{\{\s*([\w.]+)\s*\}\}")


def render(template: str, context: dict) -> str:
    """``{{ a.b }}`` filled from nested dicts; an undefined name is an error."""

    def value(m: re.Match) -> str:
        now: Any = context
        for part in m[1].split("."):
            if not isinstance(now, dict) or part not in now:
                raise KeyError(f"undefined: {m[1]}")
            now = now[part]
        return str(now)

    return SLOT.sub(value, template)


def rendered(template: str, columns: dict[str, Column]) -> Column:
    """The same for column values, as one expression."""
    parts, at = [], 0
    for m in SLOT.finditer(template):
        if m[1] not in columns:
            raise KeyError(f"undefined: {m[1]}")
        parts += [F.lit(template[at : m.start()]), F.coalesce(columns[m[1]].cast("string"), F.lit(""))]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def salvaged_json(content: str) -> Any:
    """The JSON of a model's answer: a fenced block, else from the first { to the last }, else the whole; the text ``null``
    is no value.  None if nothing of it is JSON."""
    tries = [m[1] for m in re.finditer(r"```(?:json)?\s*(.*?)```", content or "", re.S)]
    a, z = (content or "").find("{"), (content or "").rfind("}")
    if 0 <= a < z:
        tries.append(content[a : z + 1])
    tries.append(content or "")
    for t in tries:
        try:
            return without_null_word(json.loads(t))
        except ValueError:
            continue
    return None


def without_null_word(x: Any) -> Any:
    if isinstance(x, dict):
        return {k: without_null_word(v) for k, v in x.items()}
    if isinstance(x, list):
        return [without_null_word(v) for v in x]
    return None if isinstance(x, str) and x.strip().lower() == "null" else x


def ungrounded(data: Any, shown: set[str], path: str = "$") -> list[str]:
    """Paths of pointers that name neither a shown chunk nor a structured cell."""
    out = []
    if isinstance(data, dict):
        for k, v in data.items():
            if is_pointer(k):
                for x in v if isinstance(v, list) else [v]:
                    if x not in (None, "") and str(x) not in shown and ":structured:" not in str(x):
                        out.append(f"{path}.{k}")
            else:
                out += ungrounded(v, shown, f"{path}.{k}")
    elif isinstance(data, list):
        for i, v in enumerate(data):
            out += ungrounded(v, shown, f"{path}[{i}]")
    return out


def without_fabricated(data: Any, shown: set[str]) -> tuple[Any, int]:
    """The answer with fabricated pointers nulled (dropped from lists), and how many there were."""
    n = 0
    good = lambda x: x in (None, "") or str(x) in shown or ":structured:" in str(x)

    def clean(d: Any) -> Any:
        nonlocal n
        if isinstance(d, dict):
            out = {}
            for k, v in d.items():
                if is_pointer(k) and isinstance(v, list):
                    kept = [x for x in v if good(x)]
                    n += len(v) - len(kept)
                    out[k] = kept
                elif is_pointer(k):
                    n += not good(v)
                    out[k] = v if good(v) else None
                else:
                    out[k] = clean(v)
            return out
        return [clean(x) for x in d] if isinstance(d, list) else d

    return clean(data), n


@dataclass(frozen=True)
class Request:
    system: str
    user: str
    max_tokens: int = 512


@dataclass(frozen=True)
class Response:
    text: str
    truncated: bool = False
    input_tokens: int = 0
    output_tokens: int = 0


class Provider(Protocol):
    def chat(self, request: Request) -> Response: ...


class EchoProvider:
    """A deterministic provider for tests: answers with the hash of the prompt and the first chunk id in it."""

    def __init__(self, ceiling: int = 8000):
        self.ceiling = ceiling

    def chat(self, request: Request) -> Response:
        tokens = max(1, (len(request.system) + len(request.user)) // 4)
        if tokens > self.ceiling:
            raise ValueError(f"a prompt of {tokens} tokens is over the ceiling of {self.ceiling}")
        first = re.search(r"chunk_id=(\S+)", request.user)
        answer = {"value": hashlib.sha256((request.system + request.user).encode()).hexdigest()[:12], "evidence_chunk_id": first[1] if first else None}
        return Response(json.dumps(answer), False, tokens, 16)


def allowed_endpoint(entries: list[dict], name: str) -> dict:
    """The named entry of an allowlist; its attestation must be of the known ones."""
    for e in entries:
        if e.get("name") == name:
            if e.get("attestation") not in ("local", "contracted", "test"):
                raise ValueError(f"{name}: unknown attestation")
            return e
    raise ValueError(f"{name} isn't on the allowlist")


def chat_with_retries(provider: Provider, request: Request, attempts: int = 5, growths: int = 2, pause: float = 0.0) -> Response:
    """A transport error is tried again, at most ``attempts`` times; a truncated answer again with half as many tokens more,
    at most ``growths`` times."""
    grown = 0
    for k in range(attempts):
        try:
            r = provider.chat(request)
        except (ConnectionError, TimeoutError):
            if k == attempts - 1:
                raise
            time.sleep(pause * 2**k)
            continue
        if r.truncated and grown < growths:
            grown += 1
            request = Request(request.system, request.user, int(request.max_tokens * 1.5))
            continue
        return r
    return r


def ask_until_grounded(provider: Provider, request: Request, shown: set[str], retries: int = 2) -> tuple[Any, int]:
    """The parsed answer and how many calls it took: asked again, with a word of correction, while pointers aren't shown ones."""
    data = None
    for k in range(retries + 1):
        data = salvaged_json(chat_with_retries(provider, request).text)
        bad = ungrounded(data, shown)
        if not bad:
            return data, k + 1
        request = Request(request.system, request.user + f"\nCite only the passages shown. Not shown: {', '.join(bad)}", request.max_tokens)
    return data, retries + 1


ANSWER = T.StructType([T.StructField(n, t) for n, t in [("data", T.StringType()), ("ok", T.BooleanType()), ("error", T.StringType()), ("rejected", T.IntegerType()), ("calls", T.IntegerType()), ("input_tokens", T.IntegerType())]])


@dataclass(frozen=True)
class Cached:
    """A provider behind a table of its answers; ``fingerprint`` names the model, another one is a miss."""

    provider: Provider
    cache: ResponseCache
    fingerprint: str

    def chat(self, request: Request) -> Response:
        return self.provider.chat(request)


#: Errors that a second call would meet again: a request that failed so stays in quarantine, all others are asked once more.
DETERMINISTIC = ("ValueError", "KeyError", "TypeError")


def prompted(df: DataFrame, keys: list[str], system: str, prompt: str, shown: str | None, provider: Provider) -> DataFrame:
    """One model call per row, in Arrow batches: ``(*keys, data, ok, error, rejected, calls, input_tokens)``.  An empty prompt
    isn't sent.  An error becomes a row with its class; no row is lost.

    A ``Cached`` provider is asked only for what its table doesn't hold, equal requests once; what it says is written there and
    read back, so that a task that is run again, or another run, doesn't pay twice.
    """
    if not isinstance(provider, Cached):
        return _asked(df, keys, system, prompt, shown, provider)
    ids = F.sort_array(F.col(shown).cast("array<string>")) if shown else F.array().cast("array<string>")
    key = F.sha2(F.to_json(F.struct(F.lit(system).alias("s"), F.col(prompt).alias("p"), ids.alias("i"))), 256)
    wanted = df.select(*keys, F.col(prompt).alias("__prompt"), ids.alias("__shown"), key.alias("key"), F.lit(provider.fingerprint).alias("fingerprint"))
    said = F.from_json("response", ANSWER)
    first = wanted.dropDuplicates(["key"])
    done = F.col("__said").isNotNull() & (F.col("__said.ok") | F.col("__said.error").isin(*DETERMINISTIC))
    open_ = provider.cache.get(first).withColumn("__said", said).where(~F.coalesce(done, F.lit(False)))
    made = _asked(open_.select("key", "fingerprint", "__prompt", "__shown"), ["key", "fingerprint"], system, "__prompt", "__shown", provider.provider)
    provider.cache.put(made.select("key", "fingerprint", F.to_json(F.struct(*ANSWER.names)).alias("response"), F.unix_micros(F.current_timestamp()).alias("seq")))
    return provider.cache.get(wanted).select(*keys, said.alias("__said")).select(*keys, "__said.*")


def _asked(df: DataFrame, keys: list[str], system: str, prompt: str, shown: str | None, provider: Provider) -> DataFrame:
    schema = T.StructType([*(df.schema[k] for k in keys), *ANSWER.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, s in zip(pdf["__p"], pdf["__s"]):
                if p is None or not p.strip():
                    rows.append((None, True, "empty_evidence", 0, 0, 0))
                    continue
                seen = set(map(str, s)) if s is not None else set()
                try:
                    data, calls = ask_until_grounded(provider, Request(system, p), seen)
                    data, n = without_fabricated(data, seen)
                    rows.append((json.dumps(data, sort_keys=True), data is not None, None, n, calls, max(1, len(p) // 4)))
                except Exception as e:
                    rows.append((None, False, type(e).__name__, 0, 1, 0))
            yield pd.concat([pdf[keys].reset_index(drop=True), pd.DataFrame(rows, columns=ANSWER.names)], axis=1)

    ids = F.col(shown).cast("array<string>") if shown else F.lit(None).cast("array<string>")
    return df.select(*keys, F.col(prompt).alias("__p"), ids.alias("__s")).mapInPandas(run, schema)


def last_answer(steps: DataFrame, by: list[str], order: str, data: str, step: str) -> DataFrame:
    """Per group the answer of the last step that gave one, and that step."""
    some = F.col(data).isNotNull()
    return steps.groupBy(*by).agg(F.max_by(F.when(some, F.col(data)), F.when(some, F.col(order))).alias("data"), F.max_by(F.when(some, F.col(step)), F.when(some, F.col(order))).alias("answered_by"))


def matched_tables(files: list[tuple[str, str | None]], name: str | None = None, contains: str | None = None, doc_type: str | None = None, doc_type_contains: str | None = None) -> list[str]:
    """Source files by exact name, part of the name, document type or part of it (all that are given must hold)."""
    out = []
    for f, t in files:
        ok = (name is None or f == name) and (contains is None or contains.lower() in f.lower())
        ok = ok and (doc_type is None or (t or "").lower() == doc_type.lower()) and (doc_type_contains is None or doc_type_contains.lower() in (t or "").lower())
        if ok:
            out.append(f)
    return sorted(set(out))


@handler("retrieve_and_prompt")
def retrieve_and_prompt(packets: DataFrame, keys: list[str], settings: dict, provider: Provider) -> DataFrame:
    return prompted(packets, keys, settings.get("prompt", ""), "packet", "shown" if "shown" in packets.columns else None, provider)


@handler("map_table_rows_and_prompt")
def map_table_rows_and_prompt(rows: DataFrame, keys: list[str], settings: dict, provider: Provider) -> DataFrame:
    """One call per table row; the source's identity comes from the keys, not from the model."""
    from chartweave.operators.chunks import rendered_row

    return prompted(rows.withColumn("__rendered", rendered_row([c for c in rows.columns if c not in keys])), keys, settings.get("prompt", ""), "__rendered", None, provider)


@handler("llm_only")
def llm_only(results: DataFrame, keys: list[str], settings: dict, provider: Provider) -> DataFrame:
    return prompted(results.withColumn("__made", rendered(settings["prompt"], {c: F.col(c) for c in results.columns})), keys, "", "__made", None, provider)


@handler("direct_parquet")
def direct_parquet(rows: DataFrame, keys: list[str], settings: dict, provider: Provider | None = None) -> DataFrame:
    """Filter and projection, distinct rows; no model."""
    from chartweave.operators.retrieval import clause

    kept = rows.where(clause(rows, settings["filter"])) if settings.get("filter") else rows
    return kept.select(*keys, *[c for c in dict.fromkeys(settings.get("columns", rows.columns)) if c not in keys]).distinct()


@handler("python")
def python_step(rows: DataFrame, keys: list[str], settings: dict, provider: Provider | None = None) -> DataFrame:
    """A user's function of a pandas frame, per batch; ``schema`` tells what it returns."""
    f = settings["function"]
    return rows.mapInPandas(lambda it: (f(p) for p in it), settings["schema"])


def merged_passes(best: Column, candidate: Column, protect: bool = True) -> Column:
    """The date that two passes agree on best: a complete one before a partial one; a protected original stays where both
    are complete."""
    n = lambda c: F.when(c.isNull(), 3).otherwise((F.length(c) - F.length(F.replace(c, F.lit("XX"), F.lit("")))) / 2)
    better = n(candidate) < n(best)
    return F.when(better if protect else n(candidate) <= n(best), candidate).otherwise(best)


def vital_status(death_date: Column, said_dead: Column, last_seen: Column) -> Column:
    return F.when(death_date.isNotNull() | F.coalesce(said_dead, F.lit(False)), "deceased").when(last_seen.isNotNull(), "alive").otherwise("unknown")


def stage_basis(pathologic: Column, clinical: Column) -> Column:
    """The stage to go by: the pathologic one, else the clinical one, with its basis."""
    return F.when(pathologic.isNotNull(), F.struct(pathologic.alias("stage"), F.lit("pathologic").alias("basis"))).when(clinical.isNotNull(), F.struct(clinical.alias("stage"), F.lit("clinical").alias("basis")))


def birth_year(document_date: Column, age: Column) -> Column:
    """Estimated from an age at a dated document."""
    return (F.substring(F.trim(document_date), 1, 4).try_cast("int") - F.floor(age.try_cast("double"))).cast("int")


def grounding_chunk(shown: Column, cited: Column, fallback: bool = False) -> Column:
    """The cited id if it was shown; a fallback to the first shown one only where it is asked for."""
    return F.when(F.array_contains(shown, cited), cited).otherwise(F.get(shown, F.lit(0)) if fallback else F.lit(None))
