"""Packed shuffles: tasks exchange numpy arrays in binary columns, dealt by a partition number, and read them in runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def deal(part: np.ndarray, parts: int, **columns: np.ndarray) -> Iterator[tuple[int, dict[str, bytes]]]:
    """(partition, packed columns) of the items of each partition that has any."""
    order = np.argsort(part, kind="stable")
    at = np.searchsorted(part[order], np.arange(parts + 1))
    columns = {k: v[order] for k, v in columns.items()}
    for p in np.flatnonzero(np.diff(at)):
        yield int(p), {k: v[at[p] : at[p + 1]].tobytes() for k, v in columns.items()}


def unpack(batches: Iterator[pa.RecordBatch], **kinds: type) -> dict[str, np.ndarray]:
    """All packed items of a partition, by column."""
    parts: dict[str, list[np.ndarray]] = {k: [] for k in kinds}
    for b in batches:
        for k, kind in kinds.items():
            parts[k] += [np.frombuffer(x, kind) for x in b.column(k).to_pylist()]
    return {k: np.concatenate(v) if v else np.zeros(0, kinds[k]) for k, v in parts.items()}


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows with equal ``key`` from batches sorted by it; null keys form a run."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(key).to_pylist()
        start = 0
        if held and held[-1].column(key)[0].as_py() != col[0]:
            yield pa.Table.from_batches(held)
            held = []
        for i in range(1, len(col)):
            if col[i] != col[i - 1]:
                held.append(b.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, start = [], i
        held.append(b.slice(start))
    if held:
        yield pa.Table.from_batches(held)
