"""Steps of record migration: defaults, overrides, SQL recodes, look-ups, statistics and checksums."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.noise import hash_uniform
from stratum.operators.validate import intervals, merged


def migrate(records: DataFrame, body: dict[str, str], defaults: dict[str, object] | None = None, overrides: dict[str, object] | None = None, where: str | None = None) -> DataFrame:
    """Output records: defaults first, then SQL expressions over the input, then overrides; ``where`` filters the input."""
    if where:
        records = records.where(where)
    made = {k: F.lit(v) for k, v in (defaults or {}).items()} | {k: F.expr(v) for k, v in body.items()} | {k: F.lit(v) for k, v in (overrides or {}).items()}
    return records.select(*(v.alias(k) for k, v in made.items()))


def statistics(records: DataFrame) -> DataFrame:
    """(variable, n, uniques, low, high, total, squares, mean) of every column in one pass; strings have no sums."""
    aggs, names = [], []
    for f in records.schema:
        number = f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte") or f.dataType.typeName().startswith("decimal")
        x = F.col(f.name)
        total = F.sum(x.cast("double")) if number else F.lit(None).cast("double")
        squares = F.sum((x * x).cast("double")) if number else F.lit(None).cast("double")
        mean = F.avg(x.cast("double")) if number else F.lit(None).cast("double")
        aggs.append(F.struct(F.lit(f.name).alias("variable"), F.count(x).alias("n"), F.countDistinct(x).alias("uniques"), F.min(x).cast("string").alias("low"), F.max(x).cast("string").alias("high"), total.alias("total"), squares.alias("squares"), mean.alias("mean")).alias(f"s_{f.name}"))
        names.append(f"s_{f.name}")
    return records.agg(*aggs).select(F.explode(F.array(*names)).alias("s")).select("s.*")


def random_records(keys: DataFrame, variables: dict[str, str], seed: int = 1, key: str = "id") -> DataFrame:
    """``keys(key)`` with a legal value of every variable, each as likely as the others: ``variables`` gives legal lists such as "0-99,999" or "A-F".

    Values come from a hash of the seed, the variable and the key, so they are the same in any partitions and on every run.  Ranges of single letters give
    letters, others integers; ranges that touch or overlap count once."""
    made = {}
    for name, text in variables.items():
        ends = intervals(text)
        letters = all(len(x) == 1 and not x.isdigit() for e in ends for x in e)
        ranges = merged([(ord(a), ord(b)) if letters else (int(a), int(b)) for a, b in ends])
        size = sum(b - a + 1 for a, b in ranges)
        place = F.floor(hash_uniform(F.lit(str(seed)), F.lit(name), F.col(key).cast("string")) * size)
        value, past = F, 0
        for a, b in ranges:
            value = value.when(place < past + b - a + 1, place + (a - past))
            past += b - a + 1
        made[name] = F.char(value) if letters else value.cast("long")
    return keys.select(key, *(v.alias(k) for k, v in made.items()))


# fixed values: factors of the record checksum
CHECKSUM = {"YEAR": 1, "PERNUM": 3, "RELATE": 5, "SEX": 7, "AGE": 11, "RACE": 13}


def checksum(records: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Weighted sum of record fields; ``columns`` names the field for each factor."""
    return records.agg(F.sum(sum((F.col(c) * CHECKSUM[k] for k, c in columns.items()), F.lit(0))).cast("long").alias("checksum"))


def lookup(records: DataFrame, table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Each record with the columns of the first table row of its key (the least row, if several)."""
    first = table.groupBy(key).agg(F.min(F.struct(*columns)).alias("found"))
    return records.join(first, key, "left").select(*records.columns, *(F.col(f"found.{c}").alias(c) for c in columns))


def by_description(ranges: dict[str, list[tuple[str, str]]], text: str) -> dict[str, str]:
    """{variable: value} of the first range of each variable whose description contains ``text``; ``ranges``: variable -> (value, description)."""
    found = {}
    for name, options in ranges.items():
        value = next((v for v, said in options if text.lower() in said.lower()), None)
        if value is not None:
            found[name] = value
    return found


def with_defaults(records: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Blank and null fields get their defaults."""
    return records.withColumns({c: F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(v)).otherwise(F.col(c).cast("string")) for c, v in defaults.items() if c in records.columns})


def with_overrides(records: DataFrame, overrides: dict[str, str]) -> DataFrame:
    return records.withColumns({c: F.lit(v) for c, v in overrides.items() if c in records.columns})


def named_commands(spark: SparkSession, ranges: dict[str, list[tuple[str, str]]] | None = None) -> dict[str, Callable[[dict[str, DataFrame], dict[str, str]], DataFrame | None]]:
    """The commands of a migration: BULK_LOAD(file, layout | sep), PROCESS(of, where), APPLY_DEFAULTS(of, text), OVERRIDE(of, text),
    TABLE_STATS(of), CHECKSUM(of), OUTPUT_RECORDS(of, file), COLLECT(of, ...): rows of several frames under one another."""
    from stratum.sources.records import read_records

    def load(frames: dict[str, DataFrame], a: dict[str, str]) -> DataFrame:
        if "layout" in a:
            return read_records(spark, a["file"], a["layout"])
        return spark.read.csv(a["file"], header=True, sep=a.get("sep", ","))

    def output(frames: dict[str, DataFrame], a: dict[str, str]) -> None:
        frames[a["of"]].write.mode("errorifexists").parquet(a["file"])

    def collect(frames: dict[str, DataFrame], a: dict[str, str]) -> DataFrame:
        names = a["of"].split("+")
        out = frames[names[0]]
        for n in names[1:]:
            out = out.unionByName(frames[n], allowMissingColumns=True)
        return out

    return {
        "BULK_LOAD": load,
        "PROCESS": lambda frames, a: frames[a["of"]].where(a["where"]) if "where" in a else frames[a["of"]],
        "APPLY_DEFAULTS": lambda frames, a: with_defaults(frames[a["of"]], by_description(ranges or {}, a["text"])),
        "OVERRIDE": lambda frames, a: with_overrides(frames[a["of"]], by_description(ranges or {}, a["text"])),
        "TABLE_STATS": lambda frames, a: statistics(frames[a["of"]]),
        "CHECKSUM": lambda frames, a: checksum(frames[a["of"]], {k: k for k in CHECKSUM}),
        "OUTPUT_RECORDS": output,
        "COLLECT": collect,
    }


_STEP = re.compile(r"\s*(?:(\w+)\s*=\s*)?(\w+)\s*\(([^()]*)\)\s*")


def parse_step(text: str) -> tuple[str | None, str, dict[str, str]]:
    """(target, command, arguments) of ``[target=]COMMAND(k=v,...)``."""
    m = _STEP.fullmatch(text)
    if not m:
        raise ValueError(f"no step: {text}")
    args = dict(a.split("=", 1) if "=" in a else (a, "") for a in map(str.strip, m[3].split(",")) if a)
    return m[1], m[2], args


@dataclass
class Steps:
    """Named steps run in order of name; each command is a function (frames, arguments) -> frame or None."""

    commands: dict[str, Callable[[dict[str, DataFrame], dict[str, str]], DataFrame | None]]
    frames: dict[str, DataFrame] = field(default_factory=dict)

    def run(self, steps: dict[str, str]) -> dict[str, DataFrame]:
        for name in sorted(steps):
            target, command, args = parse_step(steps[name])
            if command not in self.commands:
                raise ValueError(f"step {name}: no command {command}")
            if target in self.frames:
                raise ValueError(f"step {name}: {target} is made twice")
            result = self.commands[command](self.frames, args)
            if target is not None and result is not None:
                self.frames[target] = result
        return self.frames
