"""Bounded samples that a model is fitted on, in one Spark task; the driver sees the model alone."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def below(place: Column, share: float) -> Column:
    """A share of all values of a hash."""
    return F.pmod(place, F.lit(1 << 40)) < F.lit(int(min(1.0, share) * (1 << 40)))


def fit_in_task(rows: DataFrame, order: list[str], fit) -> bytes:
    """``fit`` of all rows, an Arrow table in the order of ``order``: it returns the model's bytes."""

    def run(batches):
        held = list(batches)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([fit(pa.Table.from_batches(held))], pa.binary())], ["model"])

    found = rows.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "model binary").first()
    return bytes(found[0]) if found else b""


def parts(text: bytes, limit: int, piece: int = 4096) -> bytes:
    """A text of ``limit`` bytes at most as it is, of others evenly spaced pieces of that size together."""
    if len(text) <= limit:
        return text
    n = max(1, limit // piece)
    return b"\n".join(text[len(text) * i // n :][: min(piece, limit)] for i in range(n))
