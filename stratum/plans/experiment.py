"""Experiments: configuration with inclusion, loops over parameters, and runs that read their input once."""

from __future__ import annotations

import configparser
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import reduce
from itertools import product
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.estimate import settle


def load_config(path: str) -> configparser.ConfigParser:
    """INI file; ``include=FILE`` of a section (or of [DEFAULT]) brings in that file's values where this one has none."""
    own = configparser.ConfigParser()
    own.read(path)
    for section in [own.default_section, *own.sections()]:
        part = own[section]
        name = part.get("include")
        if not name or section != own.default_section and name == own.defaults().get("include"):
            continue
        base = load_config(str(Path(path).parent / name))
        for s in [base.default_section, *base.sections()] if section == own.default_section else [section]:
            if s != own.default_section and s not in own:
                own.add_section(s)
            for k, v in (base.defaults() if s == base.default_section else base._sections.get(s, {})).items():  # noqa: SLF001
                have = own.defaults() if s == own.default_section else own._sections[s]  # noqa: SLF001
                if k not in have:
                    own.set(s, k, v.replace("%", "%%") if "%(" not in v else v)
    return own


def fingerprint(df: DataFrame) -> str:
    """Of what a frame computes: its resolved plan, and the path, size and time of change of every file that it reads."""
    files = sorted(df.inputFiles())
    seen = []
    if files:
        seen = df.sparkSession.read.format("binaryFile").load(files).select("path", "length", F.col("modificationTime").cast("double")).collect()  # one row a file
    return hashlib.sha256(repr((df.semanticHash(), df.schema.simpleString(), sorted(map(tuple, seen)))).encode()).hexdigest()


def cached(df: DataFrame, folder: str) -> DataFrame:
    """The frame's rows from ``folder``, where a run that computed the same of the same files has left them, else computed and left there for others.

    A table counts once its write has ended and its entry names it, so a run that was lost leaves nothing that is read.  ``folder`` must be shared by driver and executors."""
    spark, entry = df.sparkSession, f"{folder}/{fingerprint(df)}"
    try:
        found = spark.read.schema("path string").parquet(entry).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    path = found["path"] if found else f"{entry}-{uuid.uuid4().hex}"
    if not found:
        df.write.parquet(path)
        spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").parquet(entry)
    return spark.read.schema(df.schema).parquet(path)


_LOOP = re.compile(r"FOR\s+(\w+)\.([\w.]+)\s*(?:=\s*(\S+)\s+TO\s+(\S+)(?:\s+(MUL)?STEP\s+(\S+))?|IN\s+(.+))\s*", re.I)


def parse_loop(text: str) -> tuple[str, str, list[str]]:
    """(section, variable, values) of ``FOR s.v = a TO b [STEP x | MULSTEP x]`` or ``FOR s.v IN a,b,...``."""
    m = _LOOP.fullmatch(text.strip())
    if not m:
        raise ValueError(f"no loop: {text}")
    if m[7]:
        return m[1], m[2], [x.strip() for x in m[7].split(",")]
    at, end, step, values = Decimal(m[3]), Decimal(m[4]), Decimal(m[6] or 1), []
    while at <= end:
        values.append(str(at))
        at = at * step if m[5] else at + step
    return m[1], m[2], values


def states(loops: list[tuple[str, str, list[str]]]) -> Iterator[dict[tuple[str, str], str]]:
    """All combinations, the first loop fastest."""
    names = [(s, v) for s, v, _ in loops]
    for values in product(*(x for _, _, x in reversed(loops))):
        yield dict(zip(names, reversed(values), strict=True))


def run_all(loops: list[tuple[str, str, list[str]]], source: DataFrame, run: Callable[[DataFrame, dict], DataFrame], will: Callable[[dict], None] | None = None, did: Callable[[dict, DataFrame], None] | None = None) -> DataFrame:
    """Results of every state with its parameters as columns; the input is computed once, stored, and read by all runs.

    ``will`` and ``did`` are called before and after the plan of each run is made."""
    source = settle(source)
    parts = []
    for state in states(loops):
        if will:
            will(state)
        result = run(source, state)
        if did:
            did(state, result)
        for (section, name), value in state.items():
            result = result.withColumn(f"{section}_{name}", F.lit(value))
        parts.append(result)
    return reduce(DataFrame.unionByName, parts)


def substitute(config: configparser.ConfigParser, state: dict[tuple[str, str], str]) -> configparser.ConfigParser:
    """A copy of a configuration with a state's values."""
    out = configparser.ConfigParser()
    out.read_dict({s: dict(config.items(s, raw=True)) for s in config.sections()})
    for (section, name), value in state.items():
        if not out.has_section(section):
            out.add_section(section)
        out.set(section, name, value.replace("%", "%%"))
    return out


class Registry:
    """Callables by name, for plans that name their reader, engine and writer in a configuration."""

    def __init__(self) -> None:
        self.known: dict[str, Callable] = {}

    def add(self, name: str) -> Callable[[Callable], Callable]:
        def put(f: Callable) -> Callable:
            if name in self.known:
                raise ValueError(f"{name} is registered already")
            self.known[name] = f
            return f

        return put

    def of(self, config: configparser.ConfigParser, section: str, name: str) -> Callable:
        wanted = config.get(section, name)
        if wanted not in self.known:
            raise KeyError(f"{section}.{name}: nothing is registered as {wanted}")
        return self.known[wanted]


def setting(config: configparser.ConfigParser, section: str, name: str, kind: type, default: object = None) -> object:
    """A typed value: int, float, bool, str, or list of words separated by commas; without it the default, and without one an error."""
    if not config.has_option(section, name):
        if default is None:
            raise KeyError(f"no {section}.{name}")
        return default
    if kind is bool:
        return config.getboolean(section, name)
    text = config.get(section, name)
    return [x.strip() for x in text.split(",") if x.strip()] if kind is list else kind(text)


def average_by(results: DataFrame, x: str, y: str) -> DataFrame:
    return results.groupBy(x).agg(F.avg(y).alias(y))
