"""Operator 13 - fill-in-middle transformation by DuckDB inside ``mapInArrow``.

A text of n code points is cut at two seeded places into prefix, middle and suffix, and put together again in another order with
the marks ``<P>``, ``<S>`` and ``<M>``: psm ``<P>``prefix``<S>``suffix``<M>``middle, spm ``<S>``suffix``<P>``prefix``<M>``middle.  Texts that are empty or hold
a mark stay plain, as does a share of the rest.  All numbers come from the hex sha256 of ``seed:doc_id`` in groups of eight digits, so a row
gets the same form wherever and however often it is computed.

Each Arrow batch is a DuckDB view, taken in pieces of about CHUNK_BYTES; one SQL statement gives the result as Arrow.  A text is a list of
pieces of up to BLOCK code points, and the piece that holds a cut a list of code points, so that lists stay small beside
the text.  ``restore`` is the way back: the marks don't stand in the text, nor can a text's end and a mark's beginning make one, so a cut at
the marks gives exactly the three parts.

Null texts count as empty.  A null doc_id is the empty string in the hash.  Repeated rows come out alike, as often as they came in;
nothing is compared between rows, so there are no ties.  Texts of any length are cut whole; a row is never split.  Other columns of the input
are neither read nor returned.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t

SEED = 1
PLAIN_FROM = 90  # of 100: the share of texts that are transformed
SPM_BELOW = 20  # of 100: the share of these with the suffix first
BLOCK = 64  # code points of a piece; patterns with longer repeats fall back to a slow matcher

_TO = "array_to_string({0}, '')"


def _cut(whole: str, first: str, past: str) -> str:
    """SQL for the code points [first, past) of a text given as its list of pieces ``whole``: the list from the piece of the one
    to the piece of the other, the ends cut by code point."""
    points = lambda at: f"regexp_extract_all(coalesce({whole}[({at}) // {BLOCK} + 1], ''), '(?s).')"
    left = f"list_slice({points(first)}, ({first}) % {BLOCK} + 1, {BLOCK})"
    between = f"list_slice({whole}, ({first}) // {BLOCK} + 2, ({past}) // {BLOCK})"
    right = f"list_slice({points(past)}, 1, ({past}) % {BLOCK})"
    inside = f"list_slice({points(first)}, ({first}) % {BLOCK} + 1, ({past}) % {BLOCK})"
    return f"CASE WHEN ({first}) // {BLOCK} = ({past}) // {BLOCK} THEN {_TO.format(inside)} ELSE concat({_TO.format(left)}, {_TO.format(between)}, {_TO.format(right)}) END"


def cut_sql(seed: int, plain_from: int, spm_below: int) -> str:
    """One statement over the view ``batch(doc_id, text)``."""
    group = lambda k: f"('0x' || substring(hex, {8 * k + 1}, 8))::UBIGINT::BIGINT"
    return f"""
WITH cut AS (SELECT doc_id, text, regexp_extract_all(text, '(?s).{{1,{BLOCK}}}') AS pieces, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM batch),
sized AS (SELECT doc_id, text, pieces, coalesce((len(pieces) - 1) * {BLOCK} + length(pieces[-1]), 0)::BIGINT AS n, {", ".join(f"{group(k)} AS h{k + 1}" for k in range(4))} FROM cut),
placed AS (SELECT doc_id, text, pieces, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {plain_from} THEN 'plain' WHEN h4 % 100 < {spm_below} THEN 'spm' ELSE 'psm' END AS form FROM sized),
parts AS (SELECT doc_id, text, n, form, a, b, CASE WHEN form <> 'plain' THEN {_cut("pieces", "0", "a")} END AS p, CASE WHEN form <> 'plain' THEN {_cut("pieces", "a", "b")} END AS m,
  CASE WHEN form <> 'plain' THEN {_cut("pieces", "b", "n")} END AS s FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END AS output FROM parts
"""


RESTORE_SQL = """
WITH cut AS (SELECT * , CASE WHEN form <> 'plain' THEN regexp_split_to_array(output, '<[PSM]>') END AS parts FROM batch)
SELECT * EXCLUDE (parts), CASE form WHEN 'plain' THEN output WHEN 'psm' THEN array_to_string([parts[2], parts[4], parts[3]], '') ELSE array_to_string([parts[3], parts[4], parts[2]], '') END AS restored FROM cut
"""
DIGEST_SQL = f"SELECT doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM ({RESTORE_SQL})"


class _Engine:
    """An in-memory database of one thread, in the task that uses it; nothing is written to a disk of its own."""

    def __init__(self) -> None:
        self.db = duckdb.connect(":memory:", config={"threads": 1, "temp_directory": "", "preserve_insertion_order": True})

    def __call__(self, batch: pa.Table, *statements: str) -> pa.Table:
        for sql in statements:
            self.db.register("batch", batch)
            batch = self.db.sql(sql).to_arrow_table()
            self.db.unregister("batch")
        return batch


def _run(rows: DataFrame, column: str, statements: tuple[str, ...], schema: str, names: list[str]) -> DataFrame:
    """The statements over all batches of ``rows``, in pieces by the bytes of ``column``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = _Engine()
        for b in batches:
            for i, j, _, _ in t.chunks(b.column(column)):
                yield from engine(pa.Table.from_batches([b.slice(i, j - i)]), *statements).select(names).to_batches()

    return rows.mapInArrow(each, schema)


def _given(docs: DataFrame) -> tuple[DataFrame, str]:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), docs.schema["doc_id"].dataType.simpleString()


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``."""
    rows, kind = _given(docs)
    return _run(rows, "text", (cut_sql(seed, plain_from, spm_below),), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string", ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restore(made: DataFrame) -> DataFrame:
    """(doc_id, restored): the texts of rows with doc_id, form and output."""
    kind = made.schema["doc_id"].dataType.simpleString()
    return _run(made.select("doc_id", "form", "output"), "output", (RESTORE_SQL,), f"doc_id {kind}, restored string", ["doc_id", "restored"])


def digest(docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """The sizes and forms with the sha256 of the output and of the text rebuilt from it, texts left inside the tasks."""
    rows, kind = _given(docs)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    return _run(rows, "text", (cut_sql(seed, plain_from, spm_below), DIGEST_SQL), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string", names)
