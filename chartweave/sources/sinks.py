"""Writers: tables, artifacts, append-only logs, compaction, answer tables, exports and the response cache."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartweave.operators.deid import export_hash, is_forbidden
from chartweave.operators.validation import canonical_hash, schema_errors

CELL_LIMIT = 32_767


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Snappy parquet; the commit protocol makes the table appear as a whole.  Only the partitions in ``df`` are replaced."""
    writer = df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def table_record(spark: SparkSession, path: str) -> DataFrame:
    """``(path, rows, columns, files, bytes, content_hash)``: the metadata row of a table that was written.  Rows are counted from
    the files' footers, the hash is over the names and contents of its files, each hashed where it lies."""
    df = spark.read.parquet(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    total = files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return df.agg(F.count("*").alias("rows")).withColumn("__one", F.lit(1)).join(total.withColumn("__one", F.lit(1)), "__one").select(F.lit(path).alias("path"), "rows", F.lit(len(df.columns)).alias("columns"), "files", "bytes", F.lit(export_hash(spark, path)).alias("content_hash"))


class _Stream:
    """A file to write to in the cluster's file system, for ``zipfile`` and ``json``; a megabyte goes out at a time."""

    def __init__(self, out):
        self.out, self.buffer = out, bytearray()

    def write(self, data: bytes) -> int:
        self.buffer += data
        if len(self.buffer) >= 1 << 20:
            self.flush()
        return len(data)

    def flush(self) -> None:
        if self.buffer:
            self.out.write(self.buffer)
            self.buffer = bytearray()


@contextmanager
def published(spark: SparkSession, path: str) -> Iterator[_Stream]:
    """A file that appears as a whole under its path, on whatever file system that names, or not at all after an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, draft = hadoop.Path(path), hadoop.Path(path + ".tmp")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, True)
    stream = _Stream(out)
    try:
        yield stream
        stream.flush()
        out.hsync()
        out.close()
    except BaseException:
        out.close()
        fs.delete(draft, False)
        raise
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"{path} can't be put in place")


def write_artifact(path: str, kind: str, payload: dict, parents: list[str], created_at: str, schema: dict | None = None) -> dict:
    """A small JSON record with its hash, checked against a schema, put in place by renaming."""
    envelope = {"artifact_type": kind, "parents": sorted(parents), "payload": payload, "created_at": created_at}
    if schema and (errors := schema_errors(payload, schema)):
        raise ValueError("; ".join(errors))
    envelope["content_hash"] = canonical_hash(envelope, ("content_hash", "created_at"))
    with published(SparkSession.active(), path) as f:
        f.write(json.dumps(envelope, sort_keys=True).encode())
    return envelope


def touch(spark: SparkSession, files: DataFrame) -> None:
    """Writes small files, ``(path, content)``, one after another on the driver: for drafts and tests, a few files each."""
    for r in files.toLocalIterator():
        with published(spark, r.path) as f:
            f.write(r.content.encode())


def append_log(df: DataFrame, path: str, writer: str = "0") -> None:
    """Entries join the fragment of their writer, so that writers never touch each other's files; reading the path gives all."""
    df.write.mode("append").parquet(f"{path.rstrip('/')}/writer={writer}")


def compacted(spark: SparkSession, shards: str, schema: T.StructType, path: str) -> dict:
    """JSON-lines shards as one parquet table with a manifest beside it; lines that don't fit the schema are counted, not written."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(shards).persist()
    try:
        n, bad = rows.count(), rows.where(F.col("_corrupt").isNotNull()).count()
        rows.where(F.col("_corrupt").isNull()).drop("_corrupt").write.mode("overwrite").parquet(path)
    finally:
        rows.unpersist()
    said = {"rows": n - bad, "failed": bad}
    with published(spark, f"{path.rstrip('/')}.manifest.json") as f:
        f.write(json.dumps(said | {"sha256": export_hash(spark, path)}, sort_keys=True).encode())
    return said


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').csv(path)


def cut_cells(df: DataFrame) -> DataFrame:
    """``(column, cut)``: cells longer than a spreadsheet can hold, which a workbook cuts."""
    long = [F.count_if(F.length(F.col(f"`{c}`").cast("string")) > CELL_LIMIT).alias(c) for c in df.columns]
    counts = df.agg(*long)
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("cut")) for c in df.columns])).alias("x")).select("x.*").where("cut > 0")


def write_workbook(tables: dict[str, DataFrame], metadata: DataFrame, path: str) -> None:
    """One sheet per variable and one with the run's metadata; cells are text, cut at a spreadsheet's cell limit (``cut_cells``
    counts these).  Rows are streamed to the driver one partition at a time; a sheet has its format's million rows at most,
    more is an error."""
    sheets = [*tables.items(), ("run", metadata)]
    col = lambda i: (col(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)
    with published(metadata.sparkSession, path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1)) + "</Types>")
        z.writestr("_rels/.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", '<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{escape(n[:31])}" sheetId="{i}" r:id="s{i}"/>' for i, (n, _) in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="s{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, (_, df) in enumerate(sheets, 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                f.write(b'<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                for r, row in enumerate([df.columns], 1):
                    f.write(_row(r, row, col).encode())
                for r, row in enumerate(df.select([F.col(f"`{c}`").cast("string") for c in df.columns]).toLocalIterator(), 2):
                    if r > 1_048_576:
                        raise ValueError("more rows than a sheet can hold")
                    f.write(_row(r, row, col).encode())
                f.write(b"</sheetData></worksheet>")


def _row(r: int, values, col) -> str:
    cells = "".join(f'<c r="{col(i)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(_legal(str(v))[:CELL_LIMIT])}</t></is></c>' for i, v in enumerate(values) if v is not None)
    return f'<row r="{r}">{cells}</row>'


def _legal(text: str) -> str:
    return "".join(c for c in text if c in "\t\n\r" or ord(c) >= 32 and ord(c) not in (0xFFFE, 0xFFFF))


def export_zip(df: DataFrame, columns: list[str], path: str) -> None:
    """A zip of the table's CSV, made only after a clean scan of the named columns."""
    dirty = F.lit(False)
    for c in columns:
        dirty = dirty | is_forbidden(F.col(c).cast("string"), c)
    if df.where(dirty).limit(1).count():
        raise ValueError("the export holds content that may not leave")
    with published(df.sparkSession, path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open("metadata.csv", "w") as f:
        import csv
        import io

        for row in ([df.columns], df.toLocalIterator()):
            for r in row:
                buffer = io.StringIO()
                csv.writer(buffer).writerow(list(r))
                f.write(buffer.getvalue().encode())


class ResponseCache:
    """Responses by request hash, as an append-only table; the latest entry of a key counts, another model is a miss."""

    SCHEMA = "key string, fingerprint string, response string, seq long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @staticmethod
    def key(request: dict, config: dict) -> str:
        return canonical_hash({"request": request, "config": config})

    def put(self, rows: DataFrame) -> None:
        rows.select("key", "fingerprint", "response", "seq").write.mode("append").parquet(self.path)

    def get(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (key, fingerprint, ...) with ``response``, null where nothing fits."""
        try:
            known = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except Exception:
            return wanted.withColumn("response", F.lit(None).cast("string"))
        last = known.withColumn("__r", F.row_number().over(W.partitionBy("key").orderBy(F.desc("seq")))).where("__r = 1")
        last = last.select("key", F.col("fingerprint").alias("__f"), F.col("response").alias("__x"))
        j = wanted.join(last, "key", "left")
        return j.withColumn("response", F.when(F.col("__f") == F.col("fingerprint"), F.col("__x"))).drop("__f", "__x")
