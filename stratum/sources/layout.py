"""Sources and sinks of fixed-width, delimited and tagged records, described by layouts."""

from __future__ import annotations

import re
import sqlite3
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from io import BytesIO
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: type names of layout files and what they are read as
KINDS = {"NUMBER": "long", "INTEGER": "long", "INT": "long", "VARCHAR": "string", "VARCHAR2": "string", "CHAR": "string"}


@dataclass(frozen=True)
class Field:
    """A field at [start, end) of a line."""

    name: str
    start: int
    end: int
    kind: str = "string"

    def column(self, line: str = "value") -> Column:
        text = F.substring(line, self.start + 1, self.end - self.start)
        return (text if self.kind == "string" else F.trim(text).try_cast(self.kind)).alias(self.name)


def fixed_width(spark: SparkSession, path: str, fields: list[Field], tag: str | None = None) -> DataFrame:
    """Lines of a record type (by their first characters) cut into fields."""
    return cut(spark.read.text(path), fields, tag)


def cut(lines: DataFrame, fields: list[Field], tag: str | None = None) -> DataFrame:
    if tag is not None:
        lines = lines.where(F.col("value").startswith(tag))
    return lines.select(*(f.column() for f in fields))


def join_fixed(fields: list[Field], blank: str = " ") -> Column:
    """The line of a record: numbers are zero-filled, strings left-justified, gaps blank."""
    parts, at = [], 0
    for f in sorted(fields, key=lambda f: f.start):
        if f.start > at:
            parts.append(F.lit(blank * (f.start - at)))
        text, width = F.coalesce(F.col(f.name).cast("string"), F.lit("")), f.end - f.start
        parts.append(F.lpad(text, width, "0") if f.kind != "string" else F.rpad(text, width, blank))
        at = f.end
    return F.concat(*parts).alias("value")


def formatted(column: str, kind: str, width: int, override: str | None = None) -> Column:
    """CSV value by layout: numbers zero-filled, CHAR right-justified; an override replaces the value."""
    if override is not None:
        return F.lit(override).alias(column)
    return F.lpad(F.col(column).cast("string"), width, "0" if KINDS.get(kind, kind) == "long" else " ").alias(column)


def delimited(lines: DataFrame, names: list[str], separator: str = "|") -> DataFrame:
    """Delimited lines by position; '#' lines are comments, and another number of fields is an error."""
    parts = F.split("value", re.escape(separator))
    bad = F.raise_error(F.concat(F.lit(f"not {len(names)} fields: "), F.col("value")))
    checked = F.when(F.size(parts) == len(names), parts).otherwise(F.split(bad.cast("string"), "x"))
    return lines.where(~F.col("value").startswith("#")).select(checked.alias("p")).select(*(F.col("p")[i].alias(n) for i, n in enumerate(names)))


def geography(spark: SparkSession, path: str, parts: list[str], key: str, prefix: str = "") -> DataFrame:
    """(key as a 22-digit decimal, geocode) of a piped reference file with a header."""
    rows = spark.read.csv(path, sep="|", header=True)
    return rows.select(F.col(key).cast(T.DecimalType(22, 0)).alias(key), F.concat(*parts).alias("geocode")).where(F.col("geocode").startswith(prefix))


def declared(spark: SparkSession, path: str, columns: dict[str, str], header: bool = True, sep: str = ",") -> DataFrame:
    """CSV with a declared schema of int and str columns."""
    schema = T.StructType([T.StructField(n, {"int": T.IntegerType(), "str": T.StringType()}[k]) for n, k in columns.items()])
    return spark.read.csv(path, schema=schema, header=header, sep=sep)


def sniffed(spark: SparkSession, path: str) -> DataFrame:
    """Text with a header and the separator that its first line uses: '|', tab or ','."""
    first = spark.read.text(path).first()["value"]
    return spark.read.csv(path, sep=next((s for s in "|\t," if s in first), ","), header=True)


def register(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Temp view under a name that must be free."""
    if spark.catalog.tableExists(name):
        raise ValueError(f"a table {name} is registered already")
    df.createOrReplaceTempView(name)
    return df


def from_create_table(sql: str) -> T.StructType:
    """Schema of ``CREATE TABLE name (column TYPE(width), ...)``."""
    body = re.search(r"\((.*)\)", sql, re.S)
    if not body:
        raise ValueError("no CREATE TABLE statement")
    fields = []
    for part in re.split(r",(?![^()]*\))", body[1]):
        name, kind = part.split()[:2]
        fields.append(T.StructField(name, {"long": T.LongType(), "string": T.StringType()}[KINDS[re.sub(r"\(.*", "", kind).upper()]]))
    return T.StructType(fields)


def from_sas_input(text: str) -> list[Field]:
    """Fields of the INPUT statement of a .sas layout: ``name [$] first-last``, 1-based and inclusive."""
    found = re.findall(r"^\s*(\w+)\s+(\$?)\s*(\d+)(?:\s*-\s*(\d+))?(?:\s+\.\d+)?\s*$", text, re.M)
    return [Field(n.lower(), int(a) - 1, int(b or a), "string" if s else "long") for n, s, a, b in found]


SLICE_ROWS = 50_000
# fixed values: affinities of SQLite's declared types, tried in this order
_AFFINITY = (("INT", "long"), ("CHAR", "string"), ("CLOB", "string"), ("TEXT", "string"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double"))


def sqlite_tables(spark: SparkSession, path: str, out: str, skip: Iterable[str] = ()) -> list[str]:
    """Every table of a SQLite file, which all executors must see, as Parquet.

    The driver reads names, declared types and row numbers' ends only; slices of SLICE_ROWS row numbers are read by tasks under one
    declared schema, so a table without rows or with a null column is written too.  Numbers of other types are strings."""
    done = []
    with sqlite3.connect(path) as db:
        for (name,) in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name").fetchall():
            if name in skip:
                continue
            kinds = [(c[1], next((k for key, k in _AFFINITY if key in (c[2] or "").upper()), "string")) for c in db.execute(f'PRAGMA table_info("{name}")')]
            low, high = db.execute(f'SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM "{name}"').fetchone()  # noqa: S608
            sqlite_rows(spark, path, name, kinds, low, high).write.mode("overwrite").parquet(f"{out}/{name}")
            done.append(name)
    return done


def sqlite_rows(spark: SparkSession, path: str, name: str, kinds: list[tuple[str, str]], low: int, high: int) -> DataFrame:
    """Rows of one table by slices of row numbers."""
    as_kind = {"long": int, "double": float, "string": str}

    def read(slices: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
            for part in slices:
                for first in part["first"]:
                    rows = db.execute(f'SELECT * FROM "{name}" WHERE rowid BETWEEN ? AND ?', (int(first), int(first) + SLICE_ROWS - 1)).fetchall()  # noqa: S608
                    columns = zip(*rows, strict=True) if rows else ((),) * len(kinds)
                    made = {c: [None if v is None else as_kind[k](v) for v in col] for (c, k), col in zip(kinds, columns, strict=True)}
                    yield pd.DataFrame({c: pd.Series(v, dtype={"long": "Int64", "double": "Float64", "string": "object"}[k]) for (c, k), v in zip(kinds, made.values(), strict=True)})

    firsts = spark.range(low, high + 1, SLICE_ROWS, max(1, -(-(high + 1 - low) // SLICE_ROWS))).withColumnRenamed("id", "first")
    return firsts.mapInPandas(read, ", ".join(f"`{c}` {k}" for c, k in kinds))


def sas_table(spark: SparkSession, path: str, out: str) -> DataFrame:
    """.sas7bdat or .xpt files of one layout (a path or pattern that Spark can list) as Parquet.

    Spark reads the files, of 2 GB at most each, and a task reads one from its start, as the format asks, in chunks of SLICE_ROWS rows that go straight to the
    output; the driver sees column names only.  A first small job reads these: texts are strings, everything else is a double."""
    files = spark.read.format("binaryFile").load(path).select("path", "content").repartition("path")

    def opened(name: str, content: bytes, rows: int) -> Iterator[pd.DataFrame]:
        return iter(pd.read_sas(BytesIO(content), format="xport" if name.lower().endswith(".xpt") else "sas7bdat", chunksize=rows, encoding="utf-8"))

    def columns(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                if (part := next(opened(name, content, 100), None)) is not None:
                    yield pd.DataFrame({"schema": [", ".join(f"`{c}` {'double' if t.kind == 'f' else 'string'}" for c, t in part.dtypes.items())]})

    found = files.mapInPandas(columns, "schema string").distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError("the files differ in their columns" if found else f"no rows in {path}")

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                yield from opened(name, content, SLICE_ROWS)

    files.mapInPandas(rows, found[0]["schema"]).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def write_lines(lines: DataFrame, path: str, parts: int = 100) -> None:
    """One text column in at most ``parts`` files."""
    lines.coalesce(parts).write.text(path)


def one_file(folder: str, target: str, comments: dict[str, str] | None = None) -> None:
    """Part files of a finished local write in one file, with '#' comment lines in front."""
    if not (Path(folder) / "_SUCCESS").exists():
        raise FileNotFoundError(f"{folder} isn't finished")
    with Path(target).open("wb") as out:
        for k, v in (comments or {}).items():
            out.write(f"# {k}: {v}\n".encode())
        for part in sorted(Path(folder).glob("part-*")):
            out.write(part.read_bytes())


def save_levels(rows: DataFrame, folder: str, parts: int = 100) -> None:
    """Histograms or estimates with one folder for each geolevel."""
    rows.repartition(parts, "geolevel", "geocode").write.partitionBy("geolevel").parquet(folder)


def save_units(rows: DataFrame, folder: str, config: dict[str, dict[str, str]], flags: DataFrame, keep: Iterable[str] | None = None, kind: str = "parquet", parts: int = 100) -> None:
    """Units with the columns ``keep`` alone (all if not given) as Parquet or JSON, their configuration and (geolevel, slack) of each level.

    ``config`` and the flags, one row a level, are small files of their own in the same folder."""
    spark = rows.sparkSession
    chosen = rows.select(*keep) if keep else rows
    chosen.repartition(parts).write.format(kind).save(f"{folder}/units")
    settings = [(s, k, v) for s, items in config.items() for k, v in items.items()]
    spark.createDataFrame(settings, "section string, name string, value string").coalesce(1).write.json(f"{folder}/config")
    flags.coalesce(1).write.json(f"{folder}/slack")


def write_plain(lines: DataFrame, path: str, split_by_state: bool = False, parts: int = 100) -> None:
    """Lines (value) of persons in at most ``parts`` files, or with a folder for the first two characters of each geocode."""
    if split_by_state:
        lines.withColumn("state", F.substring("value", 1, 2)).write.partitionBy("state").text(path)
    else:
        write_lines(lines.select("value"), path, parts)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics as JSON lines in one file: a few rows for each level."""
    metrics.coalesce(1).write.json(path)
