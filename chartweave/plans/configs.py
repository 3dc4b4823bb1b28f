"""Checks of step configurations, made before any work starts: a wrong shape is told by its key."""

from __future__ import annotations

from typing import Any

from chartweave.operators.retrieval import build_retriever
from chartweave.plans.filters import Filter

AUTO = (None, "auto")


def required(config: dict, key: str, kind: type | tuple[type, ...] = object) -> Any:
    if key not in config or config[key] in (None, ""):
        raise ValueError(f"{key} is missing")
    if not isinstance(config[key], kind):
        raise ValueError(f"{key} can't be a {type(config[key]).__name__}")
    return config[key]


def optional(config: dict, key: str, kind: type | tuple[type, ...]) -> Any:
    return None if config.get(key) is None else required(config, key, kind)


def _files(config: dict, keys: dict[str, type]) -> list[dict]:
    """The listed files, each a mapping with a stem and the given optional keys; none where they are discovered."""
    files = config.get("files")
    if files in AUTO:
        return []
    if not isinstance(files, list):
        raise ValueError("files is a list, or auto")
    for i, entry in enumerate(files):
        if not isinstance(entry, dict) or not isinstance(entry.get("stem"), str):
            raise ValueError(f"files[{i}] needs a stem")
        for key, kind in keys.items():
            if key in entry and not isinstance(entry[key], kind):
                raise ValueError(f"files[{i}].{key} can't be a {type(entry[key]).__name__}")
    return files


def checked_ingest(config: dict) -> dict:
    """Source files are kept whole, so a choice of columns has no place here."""
    required(config, "run_id", str)
    for key in ("source_root", "project"):
        optional(config, key, str)
    for i, entry in enumerate(_files(config, {"optional": bool})):
        if entry.get("columns") not in AUTO:
            raise ValueError(f"files[{i}].columns: ingest keeps whole files; choose text columns where they are embedded")
    return config


def checked_embed(config: dict) -> dict:
    """The encoder must be named, a window must fit it, and a file has one text column: chunk ids don't name the column."""
    required(config, "run_id", str)
    encoder = required(config, "encoder", dict)
    required(encoder, "model_id", str)
    chunker = optional(config, "chunker", dict) or {}
    if chunker.get("kind") == "token_window" and int(chunker.get("window", 0)) > int(encoder.get("max_tokens", 512)):
        raise ValueError(f"chunker.window of {chunker['window']} tokens is more than the encoder reads ({encoder.get('max_tokens', 512)})")
    optional(config, "text_column", str)
    for i, entry in enumerate(_files(config, {"embed": bool, "text_columns": list})):
        columns = entry.get("text_columns") or []
        if not all(isinstance(c, str) for c in columns):
            raise ValueError(f"files[{i}].text_columns holds names")
        if len(columns) > 1:
            raise ValueError(f"files[{i}].text_columns: one column a file, or the ids of its chunks clash")
    return config


def checked_index(config: dict) -> dict:
    required(config, "run_id", str)
    optional(config, "index", dict)
    return config


def checked_retrieval(config: dict) -> dict:
    """A known kind with a whole k, and filters that can be answered."""
    build_retriever(config.get("retriever") or {"kind": "bm25"})
    k = (config.get("retriever") or {}).get("k", 10)
    if isinstance(k, bool) or not isinstance(k, int) or k < 1:
        raise ValueError("retriever.k is a whole number from 1 on")
    for f in optional(config, "filters", list) or []:
        Filter(f["field"], f["op"], f["value"], f.get("keep_if_missing", False)).checked()
    return config
