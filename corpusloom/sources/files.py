"""Files in and out: JSON lines, mixed folders, results, tables in text, manifests."""

from __future__ import annotations

import json
import math

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names anything, in whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    got = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return got is not None and len(got) > 0


def _schema(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A row for each line that isn't blank; a missing file is an empty table, a broken line a row of nulls."""
    if not exists(spark, path):
        return spark.createDataFrame([], _schema(schema))
    return spark.read.schema(schema).json(path)


def read_records(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    """Records of every .jsonl and .json file under a folder, with ``path``.

    A .json file is a list of records or an object whose ``rows`` is one. Order by path for the order of files.
    """
    kind = _schema(schema)
    if not exists(spark, folder):
        return spark.createDataFrame([], StructType(kind.fields)).withColumn("path", F.lit(""))
    reader = lambda glob: spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    path = F.col("_metadata.file_path").alias("path")
    lines = reader("*.jsonl").schema(kind).json(folder).select(*kind.names, path)
    whole = reader("*.json").schema("value string").text(folder, wholetext=True).select("value", path)
    listed = F.from_json("value", ArrayType(kind))
    inside = F.from_json("value", StructType().add("rows", ArrayType(kind)))["rows"]
    rows = whole.select("path", F.explode(F.when(F.col("value").rlike(r"^\s*\["), listed).otherwise(inside)).alias("r"))
    return lines.unionByName(rows.select("r.*", "path"))


def read_results(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    """A job's results: its first kind of file of .jsonl, .json, .csv, Parquet under ``dataset``, any Parquet."""
    for glob, read in (
        ("*.jsonl", lambda p: spark.read.schema(schema).json(p)),
        ("*.json", lambda p: spark.read.schema(schema).option("multiLine", True).json(p)),
        ("*.csv", lambda p: spark.read.schema(schema).option("multiLine", True).option("escape", '"').csv(p, header=True)),
        ("dataset/*.parquet", lambda p: read_parquet(spark, p)),
        ("*.parquet", lambda p: read_parquet(spark, p)),
    ):
        if exists(spark, f"{folder}/{glob}"):
            return read(f"{folder}/{glob}")
    return spark.createDataFrame([], _schema(schema))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Files whose columns differ come together by name."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(loc, lastmod) of each page that a sitemap lists."""
    return spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path).select(F.trim("loc").alias("loc"), F.trim("lastmod").alias("lastmod")).where("loc <> ''")


def read_sitemap_index(spark: SparkSession, path: str) -> DataFrame:
    """(loc) of each sitemap that an index lists."""
    return spark.read.format("xml").option("rowTag", "sitemap").schema("loc string").load(path).select(F.trim("loc").alias("loc")).where("loc <> ''")


def read_markdown_rows(spark: SparkSession, path: str, prefix: str, columns: list[str]) -> DataFrame:
    """Rows of Markdown tables whose first cell starts with ``prefix``, one for each first cell; rows with fewer cells go."""
    cells = F.transform(F.slice(F.split(F.trim("value"), r"\|"), 2, len(columns)), lambda x: F.trim(x))
    rows = spark.read.text(path).where(F.trim("value").startswith("|")).select(cells.alias("c")).where((F.size("c") == len(columns)) & F.col("c")[0].startswith(prefix))
    return rows.select(*(F.col("c")[i].alias(name) for i, name in enumerate(columns))).groupBy(columns[0]).agg(*(F.min(x).alias(x) for x in columns[1:]))


def run_columns(path: Column, names: tuple[str, ...] = ("dataset", "base", "target", "rank", "run")) -> list[Column]:
    """The folders above a file as columns, the nearest last."""
    parts = F.split(path, "/")
    return [F.element_at(parts, -1 - len(names) + i).alias(name) for i, name in enumerate(names)]


def file_manifest(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, bytes, sha256, rows) of each file; rows counts the lines of .jsonl that aren't blank. A file is held whole in one task, up to 2 GB; Spark doesn't list files of 0 bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    lines = F.size(F.filter(F.split(F.col("content").cast("string"), "\n"), lambda x: F.trim(x) != "")).cast("long")
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.when(F.col("path").endswith(".jsonl"), lines).alias("rows"))


#: Columns of ``tensor_headers``.
_TENSORS = "path string, error string, header_bytes long, dtypes map<string,long>, tensors long, elements long, down long, up long, keys array<string>"


def tensor_headers(paths: DataFrame, most: int = 100_000_000) -> DataFrame:
    """(path, error, header_bytes, dtypes, tensors, elements, down, up, keys) of each file of tensors in column ``path``.

    Such a file begins with a little-endian 64-bit length and a JSON header of that many bytes, which is all that is read.
    ``dtypes`` counts tensors by type, ``down`` and ``up`` those of the two adapter factors, ``keys`` are the first eight.
    A file that is missing, short, cut or longer in its header than ``most`` gives a row with an error. Paths are read where
    tasks run, so they must lie in a shared place; a scheme that Arrow knows may lead.
    """

    def scan(path: str) -> tuple:
        system, place = fs.FileSystem.from_uri(path)
        with system.open_input_stream(place) as f:
            lead = f.read(8)
            if len(lead) != 8:
                raise ValueError("too short for a header length")
            size = int.from_bytes(lead, "little")
            if size > most:
                raise ValueError("header is too long")
            raw = f.read(size)
        if len(raw) != size:
            raise ValueError("header is cut")
        header = json.loads(raw)
        if not isinstance(header, dict):
            raise ValueError("header is not an object")
        tensors = {k: v for k, v in header.items() if k != "__metadata__"}
        dtypes: dict[str, int] = {}
        for v in tensors.values():
            dtypes[str(v.get("dtype"))] = dtypes.get(str(v.get("dtype")), 0) + 1
        elements = sum(math.prod(v.get("shape", [])) for v in tensors.values())
        down, up = (sum(part in k for k in tensors) for part in ("lora_A", "lora_B"))
        return None, size, dtypes, len(tensors), elements, down, up, list(tensors)[:8]

    names = [x.split()[0] for x in _TENSORS.split(", ")]

    def run(frames):
        for frame in frames:
            out = []
            for path in frame["path"]:
                try:
                    out.append((path, *scan(path)))
                except Exception as e:  # noqa: BLE001 - whatever is wrong with a file is its row's error
                    out.append((path, str(e) or type(e).__name__, None, None, None, None, None, None, None))
            yield pd.DataFrame(out, columns=names, dtype=object)

    return paths.select(F.col("path").cast("string")).mapInPandas(run, _TENSORS)


def adapter_status(scanned: DataFrame) -> DataFrame:
    """Scanned files with ``errors``, ``warnings`` and ``status``: error, warn or ok."""
    one_sided = F.col("error").isNull() & ((F.col("down") == 0) | (F.col("up") == 0))
    rest = F.col("tensors") - F.col("down") - F.col("up")
    errors = F.array_compact(F.array(F.when(F.col("error").isNotNull(), F.concat(F.lit("unreadable header: "), "error")), F.when(one_sided, "not both adapter factors")))
    warnings = F.array_compact(F.array(F.when(rest > 0, F.concat(rest.cast("string"), F.lit(" other tensors")))))
    return scanned.withColumns({"errors": errors, "warnings": warnings}).withColumn("status", F.when(F.size("errors") > 0, "error").when(F.size("warnings") > 0, "warn").otherwise("ok"))


def sse_response(body: Column) -> Column:
    """struct(content, id, model) of a streamed answer: the deltas put together, the last id and model that aren't empty."""
    data = F.filter(F.transform(F.split(body, r"\r?\n"), lambda x: F.trim(x)), lambda x: x.startswith("data:"))
    chunk = "struct<id:string,model:string,choices:array<struct<delta:struct<content:string>>>>"
    chunks = F.filter(F.transform(data, lambda x: F.from_json(F.trim(F.substring(x, 6, 1 << 30)), chunk)), lambda x: x.isNotNull())
    content = F.array_join(F.transform(chunks, lambda x: F.coalesce(F.get(x["choices"], F.lit(0))["delta"]["content"], F.lit(""))), "")
    last = lambda field: F.try_element_at(F.filter(F.transform(chunks, lambda x: x[field]), lambda x: x != ""), F.lit(-1))
    return F.struct(content.alias("content"), last("id").alias("id"), last("model").alias("model"))


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def write_csv(rows: DataFrame, folder: str, columns: list[str], overwrite: bool = False) -> None:
    """CSV with a header and the columns in that order; lists, maps and structs as JSON. An existing folder is refused unless ``overwrite``."""
    kinds = {f.name: f.dataType for f in rows.schema}
    cells = [F.to_json(c).alias(c) if isinstance(kinds[c], (ArrayType, MapType, StructType)) else F.col(c) for c in columns]
    rows.select(*cells).write.mode(_mode(overwrite)).option("escape", '"').csv(folder, header=True)


def write_jsonl(rows: DataFrame, folder: str, overwrite: bool = False) -> None:
    """JSON lines with keys in order of name; nulls are written."""
    rows.select(*sorted(rows.columns)).write.mode(_mode(overwrite)).option("ignoreNullFields", False).json(folder)


def write_runs(rows: DataFrame, folder: str, keys: list[str], overwrite: bool = False) -> None:
    """A folder for each run's keys."""
    rows.write.mode(_mode(overwrite)).partitionBy(*keys).parquet(folder)
