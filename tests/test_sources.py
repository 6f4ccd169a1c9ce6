"""Layouts, readers and writers on small files."""

import sqlite3
import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratum.operators import metrics
from stratum.plans import etl, experiment
from stratum.sources import layout


def test_fixed_width_by_tag(spark, tmp_path):
    (tmp_path / "t.txt").write_text("jack10\nmary25\n#skip\nmaryxx\n")
    fields = [layout.Field("name", 0, 4), layout.Field("age", 4, 6, "long")]
    got = layout.fixed_width(spark, str(tmp_path / "t.txt"), fields, "mary").collect()
    assert [tuple(r) for r in got] == [("mary", 25), ("mary", None)]


def test_join_fixed_fills_gaps(spark):
    fields = [layout.Field("n", 0, 4, "long"), layout.Field("s", 6, 9)]
    rows = spark.createDataFrame([(7, "a"), (None, None)], "n long, s string").select(layout.join_fixed(fields))
    assert [r["value"] for r in rows.collect()] == ["0007  a  ", "0000     "]


def test_delimited_counts_fields(spark):
    lines = spark.createDataFrame([("# c",), ("a|b",)], "value string")
    assert [tuple(r) for r in layout.delimited(lines, ["x", "y"]).collect()] == [("a", "b")]
    with pytest.raises(PySparkException):
        layout.delimited(lines, ["x", "y", "z"]).collect()


def test_geography_prefix(spark, tmp_path):
    (tmp_path / "g.txt").write_text("A|B|OID\n44|007|2103510917869541\n45|001|1\n")
    got = layout.geography(spark, str(tmp_path / "g.txt"), ["A", "B"], "OID", "44").collect()
    assert [(str(r["OID"]), r["geocode"]) for r in got] == [("2103510917869541", "44007")]


def test_create_table_and_layout_statements():
    schema = layout.from_create_table("CREATE TABLE students (name VARCHAR(10), age INTEGER)")
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [("name", "string"), ("age", "bigint")]
    fields = layout.from_sas_input("  YEAR  1-4\n  NAME $ 5-8\n  SEX 9\n")
    assert [(f.name, f.start, f.end, f.kind) for f in fields] == [("year", 0, 4, "long"), ("name", 4, 8, "string"), ("sex", 8, 9, "long")]


def test_sniffed_separator(spark, tmp_path):
    for i, sep in enumerate("|\t,"):
        (tmp_path / f"{i}.txt").write_text(f"a{sep}b\n1{sep}2\n")
        assert layout.sniffed(spark, str(tmp_path / f"{i}.txt")).columns == ["a", "b"]


def test_sqlite_to_parquet(spark, tmp_path):
    with sqlite3.connect(tmp_path / "d.db") as db:
        db.execute("CREATE TABLE t (a INTEGER, b TEXT)")
        db.executemany("INSERT INTO t VALUES (?, ?)", [(1, "x"), (2, "y")])
        db.execute("CREATE TABLE u (a INTEGER)")
    assert layout.sqlite_tables(spark, str(tmp_path / "d.db"), str(tmp_path / "out"), ["u"]) == ["t"]
    assert spark.read.parquet(str(tmp_path / "out" / "t")).count() == 2


def test_one_file_needs_a_finished_write(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        layout.one_file(str(tmp_path), str(tmp_path / "x.dat"))
    layout.write_lines(spark.createDataFrame([("b",), ("a",)], "value string"), str(tmp_path / "out"), 1)
    layout.one_file(str(tmp_path / "out"), str(tmp_path / "x.dat"), {"records": "2"})
    lines = (tmp_path / "x.dat").read_text().splitlines()
    assert lines[0] == "# records: 2" and sorted(lines[1:]) == ["a", "b"]


def test_register_needs_a_free_name(spark):
    df = spark.range(1)
    layout.register(spark, "once_only", df)
    with pytest.raises(ValueError, match="once_only"):
        layout.register(spark, "once_only", df)
    spark.catalog.dropTempView("once_only")


def test_loops_and_states():
    assert experiment.parse_loop("FOR a.b = 1 TO 3")[2] == ["1", "2", "3"]
    assert experiment.parse_loop("FOR a.b = 0.1 TO 0.3 STEP 0.1")[2] == ["0.1", "0.2", "0.3"]
    assert experiment.parse_loop("FOR a.b IN 0.02,0.05,0.1")[2] == ["0.02", "0.05", "0.1"]
    assert len(experiment.parse_loop("FOR a.b = 0.1 TO 10 MULSTEP 3.16")[2]) == 5
    made = list(experiment.states([("s", "x", ["1", "2"]), ("s", "y", ["3", "4"])]))
    assert [tuple(m.values()) for m in made] == [("1", "3"), ("2", "3"), ("1", "4"), ("2", "4")]


def test_runs_of_an_experiment(spark):
    loops = [experiment.parse_loop("FOR g.k = 1 TO 2")]
    out = experiment.run_all(loops, spark.range(4), lambda df, s: df.select((F.col("id") * int(s["g", "k"])).alias("y")))
    got = {r["g_k"]: r["y"] for r in experiment.average_by(out, "g_k", "y").collect()}
    assert got == {"1": 1.5, "2": 3.0}


def test_config_inclusion(tmp_path):
    (tmp_path / "base.ini").write_text("[a]\nx=1\ny=2\n[b]\nz=3\n")
    (tmp_path / "own.ini").write_text("[a]\ninclude=base.ini\nx=9\n")
    config = experiment.load_config(str(tmp_path / "own.ini"))
    assert config["a"]["x"] == "9" and config["a"]["y"] == "2" and "b" not in config


def test_steps(spark):
    steps = etl.Steps({"READ": lambda frames, args: spark.range(int(args["n"])), "COUNT": lambda frames, args: frames[args["of"]].groupBy().count()})
    frames = steps.run({"1": "A=READ(n=3)", "2": "B=COUNT(of=A)"})
    assert frames["B"].first()["count"] == 3
    with pytest.raises(ValueError, match="NOPE"):
        etl.Steps({}).run({"1": "A=NOPE()"})


def ibm(value):
    """A number as eight bytes of base 16."""
    if value is None:
        return b"." + bytes(7)
    if not value:
        return bytes(8)
    sign, value, power = 128 if value < 0 else 0, abs(value), 64
    while value >= 1:
        value, power = value / 16, power + 1
    while value < 1 / 16:
        value, power = value * 16, power - 1
    return bytes([sign | power]) + int(value * 2**56).to_bytes(7, "big")


def transport(path, names, rows):
    """A transport file of numbers and of texts of eight characters."""
    pad = lambda b: b + b" " * (-len(b) % 80)
    head = lambda kind, tail: b"HEADER RECORD*******" + kind.ljust(8) + b"HEADER RECORD!!!!!!!" + tail
    stamp = b"16FEB11:10:07:55"
    out = head(b"LIBRARY", b"0" * 30 + b"  ") + b"SAS     SAS     SASLIB  9.1     WIN     " + b" " * 24 + stamp + pad(stamp)
    out += head(b"MEMBER", b"000000000000000001600000000140  ") + head(b"DSCRPTR", b"0" * 30 + b"  ")
    out += b"SAS     DATA    SASDATA 9.1     WIN     " + b" " * 24 + stamp + pad(stamp)
    out += head(b"NAMESTR", b"000000" + f"{len(names):04}".encode() + b"0" * 20 + b"  ")
    body = b""
    for k, (name, text) in enumerate(names):
        body += struct.pack(">hhhh8s40s8shhh2s8shhl52s", 2 if text else 1, 0, 8, k + 1, name.encode().ljust(8), b" " * 40, b" " * 8, 0, 0, 0, b"  ", b" " * 8, 0, 0, 8 * k, bytes(52))
    out += pad(body) + head(b"OBS", b"0" * 30 + b"  ")
    data = b"".join(v.encode().ljust(8) if text else ibm(v) for r in rows for v, (_, text) in zip(r, names, strict=True))
    path.write_bytes(out + pad(data))


def test_sas_files(spark, tmp_path, monkeypatch):
    rows = [[(float(i * 1000 + k), f"n{k}", None if k % 5 == 0 else -k / 4) for k in range(1, 120)] for i in range(3)]
    names = [("ID", False), ("NAME", True), ("X", False)]
    for i, part in enumerate(rows):
        transport(tmp_path / f"{i}.xpt", names, part)
    monkeypatch.setattr(layout, "SLICE_ROWS", 50)
    got = layout.sas_table(spark, str(tmp_path / "*.xpt"), str(tmp_path / "out"))
    assert [f.dataType.simpleString() for f in got.schema] == ["double", "string", "double"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((r for part in rows for r in part), key=str)
    transport(tmp_path / "other.xpt", [("ID", False), ("AGE", False)], [(1.0, 2.0)])
    with pytest.raises(ValueError, match="differ"):
        layout.sas_table(spark, str(tmp_path / "*.xpt"), str(tmp_path / "out2"))


def test_declared_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,y\n")
    got = layout.declared(spark, str(tmp_path / "a.csv"), {"id": "int", "name": "str"})
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, "x"), (2, "y")] and got.schema["id"].dataType.simpleString() == "int"


def test_quantiles_of_many_units(spark):
    """Beyond EXACT_UNITS quantiles are within 0.001 of the rank."""
    from stratum.operators import metrics

    values = spark.range(60_000).selectExpr("'leaf' AS geolevel", "'L1' AS metric", "cast(pmod(id * 7919, 60000) AS double) AS value")
    got = {r["quantile"]: r["value"] for r in metrics.quantiles(values, [0.0, 0.25, 0.5, 0.9, 1.0], 60_000, "geolevel").collect()}
    assert all(abs(v / 59_999 - q) <= 0.0011 for q, v in got.items()) and len(got) == 5
    few = {r["quantile"]: r["value"] for r in metrics.quantiles(values.where("value < 101"), [0.25, 0.5], 101, "geolevel").collect()}
    assert few == {0.25: 25.0, 0.5: 50.0}


def test_quantiles_of_many_units_are_exact(spark, monkeypatch):
    """Ranked by ranges, with ties across them and nulls: the values that sorting everything gives."""
    monkeypatch.setattr(metrics, "SPLITS", 20)
    values = spark.range(60_000).select(F.lit("x").alias("geolevel"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("metric"), F.when(F.col("id") % 5 == 0, 7.0).when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 60_000) / 7).alias("value"))
    at = [0.0, 0.1, 0.3337, 0.5, 0.9, 1.0]
    got = {(r["metric"], r["quantile"]): r["value"] for r in metrics.quantiles(values, at, 60_000, "geolevel").collect()}
    frame = values.toPandas().dropna()
    assert len(got) == 12
    for (metric, q), v in got.items():
        assert v == pytest.approx(frame[frame["metric"] == metric]["value"].quantile(q), abs=1e-9)
