"""Bars: resampling, pivots and cross-sections."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Rows of a square of moments that are put out together.
ROWS_AT_ONCE = 128
#: Blocks that there should be for the sake of the cores; bytes of a block's dates and values at most, and of one date with its value.
BLOCKS, BLOCK_BYTES, PAIR_BYTES = 16, 32 << 20, 12


def bucket(day: Column, freq: str) -> Column:
    """The label of the period of a date: D; W is the Friday that ends it, WM the Monday that begins it; MS, QS the first day."""
    if freq == "D":
        return day.cast("date")
    if freq == "W":
        return F.date_add(F.trunc(F.date_add(day, 2), "week"), 4)
    return F.trunc(day, {"WM": "week", "MS": "month", "QS": "quarter"}[freq])


def resample(bars: DataFrame, freq: str, by: str = "ticker", event: str = "event", known: str | None = None) -> DataFrame:
    """First open, highest high, lowest low, last close, summed volume; empty periods have no row."""
    out = [
        F.min_by("open", event).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", event).alias("close"), F.sum("volume").alias("volume"),
    ]
    if known:
        out.append(F.max(known).alias(known))
    return bars.groupBy(by, bucket(F.col(event), freq).alias("period")).agg(*out)


def pivot_long(df: DataFrame, index: str, names: str, value: str, wanted: list, order: str | None = None) -> DataFrame:
    """Long to wide for an explicit list of names; with ``order`` the last value wins."""
    pick = F.max_by(value, order) if order else F.first(value)
    return df.where(F.col(names).isin(*wanted)).groupBy(index).pivot(names, wanted).agg(pick)


def resample_prices(df: DataFrame, freq: str, by: str = "ticker", event: str = "event", columns: tuple[str, ...] = ("close",)) -> DataFrame:
    """The last value of each price and the summed volume of every period, in long form."""
    last = [F.max_by(c, event).alias(c) for c in columns]
    return df.groupBy(by, bucket(F.col(event), freq).alias("period")).agg(*last, F.sum("volume").alias("volume"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _packed(kind: pa.DataType):
    """One row of a block's names: how many values each has, and all dates and values, which are moved to a mean of 0."""

    def run(batches):
        held = [batch for batch in batches if batch.num_rows]
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            names, at, x = (rows.column(c).chunk(0) for c in ("name", "at", "x"))
            n = pc.list_value_length(at).to_numpy()
            days, values = at.flatten().to_numpy(), x.flatten().to_numpy() - np.repeat(rows.column("mean").to_numpy(), n)
            yield pa.RecordBatch.from_arrays(
                [rows.column("block").chunk(0).slice(0, 1), pa.array([names], pa.list_(kind)), pa.array([n], pa.list_(pa.int32())), pa.array([days.tobytes()]), pa.array([values.tobytes()])],
                ["block", "names", "n", "at", "x"])

    return run


def _correlated(kind: pa.DataType, edge: int, days: int):
    """(a, b, corr, n) of the pairs of two packed blocks, one square of ``edge`` names after the other; moments add up over the spans of dates."""

    def side(names, n, at, x):
        """The block in parts of ``edge`` names, each made when it is asked for."""
        names, ends = names.values, np.concatenate(([0], np.cumsum(n.values.to_numpy())))
        at, x = np.frombuffer(at.as_buffer(), np.int32), np.frombuffer(x.as_buffer(), np.float64)

        def part(a):
            cut = slice(ends[a], ends[min(a + edge, len(names))])
            own = names.slice(a, edge)
            place = np.repeat(np.arange(len(own)), np.diff(ends[a : a + edge + 1]))
            order = np.argsort(at[cut] // days, kind="stable")
            day, place, value = at[cut][order], place[order], x[cut][order]
            spans, first = np.unique(day // days, return_index=True)
            ranges = dict(zip(spans.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(day)])))

            def dense(span):
                a, b = ranges[span]
                made, seen = (np.zeros((days, len(own))) for _ in range(2))
                made[day[a:b] - span * days, place[a:b]], seen[day[a:b] - span * days, place[a:b]] = value[a:b], 1.0
                return made, seen, made * made

            return own, ranges, dense

        return range(0, len(names), edge), part

    def moments(left, right, own):
        (first, spans, dense), (second, others, other) = left, right
        total = [np.zeros((len(first), len(second))) for _ in range(6)]
        for span in sorted(spans.keys() & others.keys()):
            x, s, xx = dense(span)
            y, t, yy = (x, s, xx) if own else other(span)
            for m, u, v in zip(total, (s, x, s, xx, s, x), (t, t, y, t, yy, y)):
                m += u.T @ v
        return total

    def close(total, first, second, own):
        # Blocks are in no order of names: of a pair the smaller name comes first.
        order = {v: i for i, v in enumerate(sorted({*first.to_pylist(), *second.to_pylist()}))}
        ranks = [np.array([order[v] for v in names.to_pylist()], np.int64) for names in (first, second)]
        for a in range(0, len(first), ROWS_AT_ONCE):
            n, sx, sy, sxx, syy, sxy = (m[a : a + ROWS_AT_ONCE] for m in total)
            i, j = np.nonzero((n > 0) & (ranks[0][a : a + ROWS_AT_ONCE, None] <= ranks[1][None, :]) if own else n > 0)
            n, sx, sy, sxx, syy, sxy = (m[i, j] for m in (n, sx, sy, sxx, syy, sxy))
            under = (n * sxx - sx * sx) * (n * syy - sy * sy)
            with np.errstate(invalid="ignore", divide="ignore"):
                corr = (n * sxy - sx * sy) / np.sqrt(under)
            i += a
            turn = pa.array(ranks[0][i] > ranks[1][j])
            one, two = first.take(pa.array(i)), second.take(pa.array(j))
            yield pa.RecordBatch.from_arrays([pc.if_else(turn, two, one), pc.if_else(turn, one, two), pa.array(corr, mask=~(under > 0)), pa.array(n.astype(np.int64))], ["a", "b", "corr", "n"])

    def run(batches):
        for batch in batches:
            for row in zip(*batch.columns):
                own = row[0].as_py() == row[5].as_py()
                (firsts, part), (seconds, other) = side(*row[1:5]), side(*row[6:])
                for a in firsts:
                    left = part(a)
                    for b in seconds:
                        if not own or a <= b:
                            same = own and a == b
                            right = left if same else other(b)
                            yield from close(moments(left, right, same), left[0], right[0], same)

    return run


def correlation_matrix(returns: DataFrame, by: str = "ticker", at: str = "event", value: str = "ret", block_size: int = 1536, span_days: int = 512) -> DataFrame:
    """Pearson correlation of each pair (a <= b) over the dates that both have.

    Tickers are dealt into blocks, each of which becomes one row of at most about BLOCK_BYTES. These rows are shuffled once: a pair of
    blocks, each pair once, is one task's, which reads both from where they lie, so nothing is written for a pair and what is
    shuffled grows with the table. The task takes squares of ``block_size`` tickers and one span of dates after the other as matrix
    products, adds the moments up and gives the pairs' correlations. It holds two blocks, six squares and one span of two
    squares' sides. Values are moved to a mean of 0 first, for precision.
    """
    known = returns.where(F.col(by).isNotNull())
    names, rows = known.agg(F.count_distinct(by), F.count(F.lit(1))).first()
    blocks = max(1, -(-rows * PAIR_BYTES // BLOCK_BYTES), min(BLOCKS, -(-names // block_size)))
    day = F.datediff(F.col(at).cast("date"), F.lit("1970-01-01").cast("date"))
    rows = known.where(F.col(value).isNotNull() & F.col(at).isNotNull()).groupBy(F.col(by).alias("name"))
    rows = rows.agg(F.collect_list(day).alias("at"), F.collect_list(F.col(value).cast("double")).alias("x"), F.avg(value).alias("mean"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("name"), F.lit(blocks)).cast("int")).repartitionById(blocks, F.col("block"))
    name = rows.schema["name"].dataType
    kind = to_arrow_type(name)
    packed = rows.mapInArrow(_packed(kind), f"block int, names array<{name.simpleString()}>, n array<int>, at binary, x binary").repartitionById(blocks, F.col("block"))
    one, two = (packed.select(*[F.col(c).alias(f"{side}_{c}") for c in packed.columns]) for side in ("of", "by"))
    pairs = one.hint("shuffle_replicate_nl").join(two, F.col("of_block") <= F.col("by_block"))
    return pairs.mapInArrow(_correlated(kind, block_size, span_days), f"a {name.simpleString()}, b {name.simpleString()}, corr double, n long")
