"""Readers of source files into text-first tables."""

from __future__ import annotations

import os
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartweave.operators.ingest import nulled

#: The extensions that are read, best first where two files share a stem.
EXTENSIONS = ["csv", "tsv", "xlsx", "json", "jsonl", "parquet"]


def discovered(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, patient_id, stem, extension, length, modified)``: one winner per patient folder and stem, hidden files and
    other extensions left out, extensions in any case.  Only names and sizes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", F.col("modificationTime").alias("modified"))
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.lower(F.element_at(F.split(name, r"\."), -1))
    out = files.withColumn("name", name).withColumn("extension", ext).withColumn("stem", F.regexp_replace("name", r"\.[^.]*$", "")).withColumn("patient_id", F.element_at(F.split("path", "/"), -2))
    out = out.where(~F.col("name").startswith(".") & F.col("extension").isin(EXTENSIONS))
    order = F.array_position(F.array(*map(F.lit, EXTENSIONS)), F.col("extension"))
    best = F.row_number().over(W.partitionBy("patient_id", "stem").orderBy(order, "name"))
    return out.withColumn("__r", best).where("__r = 1").select("path", "patient_id", "stem", "extension", "length", "modified")


def read_delimited(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """All text, quoted line ends kept, a row of another width is an error; null spellings become null.

    Column pruning is switched off for this reader, as with it a ragged row passes unnoticed when few columns are read.
    """
    df = spark.read.option("columnPruning", "false").csv(path, header=True, sep=separator, inferSchema=False, multiLine=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=False)
    return nulled(df)


def _texts(df: DataFrame) -> DataFrame:
    flat = lambda t: not isinstance(t, (T.StructType, T.ArrayType, T.MapType))
    return nulled(df.select([F.col(f"`{f.name}`").cast("string").alias(f.name) if flat(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields]))


def read_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Scalars as text, nested values as they are."""
    return _texts(spark.read.json(path, multiLine=not lines, primitivesAsString=True, mode="FAILFAST"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _sheet(content: bytes) -> list[list[str | None]]:
    import io

    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        first = sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]
        rows = []
        for row in ElementTree.fromstring(z.read(first)).iter(f"{{{ns['m']}}}row"):
            cells: dict[int, str | None] = {}
            for k, c in enumerate(row.findall("m:c", ns)):
                letters = re.match(r"[A-Z]+", c.get("r", ""))
                at = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters[0]))) - 1 if letters else k
                v, kind = c.find("m:v", ns), c.get("t")
                if kind == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
                elif v is not None:
                    cells[at] = shared[int(v.text)] if kind == "s" else v.text
            rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
        return rows


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of a workbook as text; its header comes from one file, the rows are read where the file lies."""
    files = spark.read.format("binaryFile").load(path)
    names = [str(x) for x in _sheet(bytes(files.select("content").first()[0]))[0]]
    width = len(names)

    def rows(content: pd.Series) -> pd.Series:
        return pd.Series([[(r + [None] * width)[:width] for r in _sheet(bytes(c))[1:]] for c in content])

    cells = files.select(F.explode(F.pandas_udf(rows, T.ArrayType(T.ArrayType(T.StringType())))("content")).alias("r"))
    return nulled(cells.select(*[F.col("r")[i].alias(n) for i, n in enumerate(names)]))


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv": read_delimited,
    "tsv": lambda s, p: read_delimited(s, p, "\t"),
    "xlsx": read_xlsx,
    "json": read_json,
    "jsonl": lambda s, p: read_json(s, p, True),
    "parquet": read_parquet,
}
if set(READERS) != set(EXTENSIONS):
    raise ImportError("every extension that is discovered needs a reader, and the other way round")


def read_source(spark: SparkSession, path: str) -> DataFrame:
    ext = os.path.splitext(path)[1].lstrip(".").lower()
    if ext not in READERS:
        raise ValueError(f"no reader for .{ext}; known: {EXTENSIONS}")
    return READERS[ext](spark, path)


def header_of(spark: SparkSession, path: str) -> list[str]:
    return read_source(spark, path).columns


def row_count(spark: SparkSession, path: str) -> int:
    return read_source(spark, path).count()


def read_gold(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines without blank lines and ``#`` comments."""
    lines = spark.read.text(path).where(~F.trim("value").startswith("#") & (F.trim("value") != ""))
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
