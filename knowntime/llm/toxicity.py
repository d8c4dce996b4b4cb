"""Toxicity: a bidirectional GRU with attention pooling over character and word inputs.

Words are runs of bytes other than ASCII punctuation and white space, A-Z in
lower case. A word's inputs are a learned embedding of its hash and the largest
values, over its runs of four and of five bytes (its two ends included), of learned
embeddings of those runs: a one-layer convolution over characters in their order.
Two GRUs read a window of words from either end, attention pools their states, and a
logistic unit scores the window. All windows of a text are scored, each overlapping
the next, and the text has the score of its worst window, calibrated. All weights are
learnt from labels by back-propagation: first every window of a toxic text counts as
toxic, then the one that scores worst.

The fit is a classifier's on a bounded sample: at most ``label_sample`` labelled rows
(those with the smallest hash of their id), which bounds what is broadcast, and about
``fit_bytes`` bytes of texts of either label, chosen by a hash. A text over a 32nd of
that is fitted on evenly spaced parts of it. The fit is one Spark task whose row of weights is
all that the driver sees. Scores see every row and the whole text.

Scale: one scan for the labelled rows, one map over the documents; nothing of the
corpus is shuffled but the sample.

Edge cases: null and empty texts are fitted and scored as a window without words. Rows
whose label is null are not used; without labels of both kinds every score is
the prior. Repeated rows are repeated in the result. Columns keep their names,
whatever they are.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import below, fit_in_task, parts
from .staging import stage, tidy
from .vectortext import mix, slabs, words

WINDOW, STRIDE = 32, 16
#: Everything in ASCII that is neither a letter nor a digit.
BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
HIDDEN, WORD_DIM, RUN_DIM = 12, 8, 12
WORD_SLOTS, RUN_SLOTS = 1 << 14, 1 << 16
RUNS, BATCH = (4, 5), 128


def _lines(batch, column: int):
    for a, b, texts in slabs(batch.column(column)):
        yield a, b, [t.lower() for t in texts]


class Inputs:
    """The distinct words of several texts, with their runs of bytes, and the windows over them."""

    def __init__(self, texts: list[bytes]):
        w = words(texts, BREAK)
        self.first = w.first
        hashes, lead, self.of = np.unique(w.hash, return_index=True, return_inverse=True)
        self.slot = (hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
        start, size = w.start[lead], w.end[lead] - w.start[lead]
        # Each distinct word with a blank at either end, one after the other, and blanks to spare.
        begin = np.concatenate(([0], np.cumsum(size + 2)))
        spot = np.arange(begin[-1]) - np.repeat(begin[:-1], size + 2)
        inner = (spot > 0) & (spot <= np.repeat(size, size + 2))
        data = np.full(begin[-1] + max(RUNS), 32, np.uint64)
        data[: begin[-1]][inner] = w.data[(np.repeat(start, size + 2) + spot - 1)[inner]]
        word = np.repeat(np.arange(len(lead)), size + 2)
        left = np.repeat(size + 2, size + 2) - spot
        slots, owners = [], []
        for n in RUNS:
            run = np.zeros(begin[-1], np.uint64)
            for k in range(n):
                run |= data[k : k + begin[-1]] << np.uint64(8 * k)
            whole = (left >= n) | ((spot == 0) & (n == RUNS[0]))
            slots.append((mix(run + np.uint64(n)) % np.uint64(RUN_SLOTS)).astype(np.int64)[whole])
            owners.append(word[whole])
        self.run, self.owner = np.concatenate(slots), np.concatenate(owners)
        order = np.argsort(self.owner, kind="stable")
        self.run, self.owner = self.run[order], self.owner[order]
        self.cut = np.searchsorted(self.owner, np.arange(len(lead)))

    def part(self, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word slots, run slots, owners and cuts of some of the distinct words."""
        ends = np.append(self.cut, len(self.run))
        n = ends[used + 1] - ends[used]
        cut = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(ends[used] - cut[:-1], n) + np.arange(cut[-1])
        return self.slot[used], self.run[at], np.repeat(np.arange(len(used)), n), cut[:-1]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words of each window (-1 past the end) and the text of each window."""
        first = self.first
        n = np.diff(first)
        count = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
        doc = np.repeat(np.arange(len(n)), count)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        at = nth[:, None] * STRIDE + np.arange(WINDOW)
        real = at < n[doc][:, None]
        of = np.append(self.of, -1)
        return of[np.where(real, at + first[doc][:, None], len(of) - 1)], doc


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Net:
    """The network; parameters in a dict, so that the optimiser can walk them."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        e, h = RUN_DIM + WORD_DIM, HIDDEN

        def normal(*shape):
            return (rng.normal(size=shape) * 0.3).astype(np.float32)

        self.p = {"words": normal(WORD_SLOTS, WORD_DIM) * 0.1, "runs": normal(RUN_SLOTS, RUN_DIM) * 0.1}
        for d in "fb":
            self.p |= {f"W{d}": normal(e, 3 * h), f"U{d}": normal(h, 3 * h), f"c{d}": np.zeros(3 * h, np.float32)}
        self.p |= {"A": normal(2 * h, h), "v": normal(h), "o": normal(2 * h), "k": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def to_bytes(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, scale=self.scale, shift=self.shift, **self.p)
        return held.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Net:
        net, held = cls.__new__(cls), dict(np.load(io.BytesIO(data)))
        net.scale, net.shift = float(held.pop("scale")), float(held.pop("shift"))
        net.p = held
        return net

    def inputs(self, slot, run, owner, cut):
        """A row a word: the largest value of each run dimension, and the word's embedding."""
        if not len(slot):
            return np.zeros((0, RUN_DIM + WORD_DIM), np.float32)
        return np.concatenate((np.maximum.reduceat(self.p["runs"][run], cut), self.p["words"][slot]), 1)

    def forward(self, x: np.ndarray, at: np.ndarray, keep: bool = False):
        """Logit of each window; ``x`` has a row a word, ``at`` word numbers or -1."""
        p, H = self.p, HIDDEN
        n, T = at.shape
        real = at >= 0
        index = np.where(real, at, len(x))
        states, tape = np.zeros((T, n, 2 * H), np.float32), {}
        for j, d in enumerate("fb"):
            proj = np.concatenate((x @ p[f"W{d}"] + p[f"c{d}"], np.zeros((1, 3 * H), np.float32)))
            h, U = np.zeros((n, H), np.float32), p[f"U{d}"]
            for t in range(T) if d == "f" else reversed(range(T)):
                g, u = proj[index[:, t]], h @ U
                zr = sigmoid(g[:, : 2 * H] + u[:, : 2 * H])
                z, r = zr[:, :H], zr[:, H:]
                c = np.tanh(g[:, 2 * H :] + r * u[:, 2 * H :])
                new = np.where(real[:, t, None], c + z * (h - c), h)
                if keep:
                    tape[d, t] = (h, z, r, c, u[:, 2 * H :])
                h = states[t, :, j * H : (j + 1) * H] = new
        att = np.tanh(states @ p["A"])
        e = np.where(real.T, att @ p["v"], np.float32(-1e9))
        a = np.exp(e - e.max(0))
        a = np.where(real.T, a, 0)
        a = a / np.maximum(a.sum(0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", a, states)
        logit = pooled @ p["o"] + p["k"]
        return (logit, (tape, states, att, a, pooled, real, index)) if keep else logit

    def gradients(self, part, at, y):
        """Logistic loss on windows, back through attention, both GRUs and the convolution."""
        p, H = self.p, HIDDEN
        slot, run, owner, cut = part
        x = self.inputs(*part)
        logit, (tape, states, att, a, pooled, real, index) = self.forward(x, at, True)
        g = {}
        dl = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
        g["o"], g["k"] = pooled.T @ dl, dl.sum(keepdims=True)
        dpool = dl[:, None] * p["o"]
        da = np.einsum("nh,tnh->tn", dpool, states)
        de = a * (da - (a * da).sum(0))
        datt = de[:, :, None] * p["v"] * (1 - att * att)
        g["v"] = np.einsum("tn,tnh->h", de, att)
        g["A"] = np.einsum("tni,tnj->ij", states, datt)
        dstates = a[:, :, None] * dpool + datt @ p["A"].T
        dx = np.zeros_like(x)
        n, T = at.shape
        for j, d in enumerate("fb"):
            U, dh = p[f"U{d}"], np.zeros((n, H), np.float32)
            into, dU = np.empty((T, n, 3 * H), np.float32), np.zeros_like(U)
            for t in reversed(range(T)) if d == "f" else range(T):
                h, z, r, c, uc = tape[d, t]
                dh = dh + dstates[t, :, j * H : (j + 1) * H]
                live = dh * real[:, t, None]
                dc = live * (1 - z) * (1 - c * c)
                dz = live * (h - c) * z * (1 - z)
                dr = dc * uc * r * (1 - r)
                into[t] = np.concatenate((dz, dr, dc), 1)
                du = np.concatenate((dz, dr, dc * r), 1)
                dU += h.T @ du
                dh = np.where(real[:, t, None], live * z + du @ U.T, dh)
            dproj = np.zeros((len(x) + 1, 3 * H), np.float32)
            at_rows, summed = _sum_rows(index.T.ravel(), into.reshape(-1, 3 * H))
            dproj[at_rows] = summed
            dproj, g[f"U{d}"] = dproj[:-1], dU
            g[f"W{d}"], g[f"c{d}"] = x.T @ dproj, dproj.sum(0)
            dx += dproj @ p[f"W{d}"].T
        g["words"] = _sum_rows(slot, dx[:, RUN_DIM:])
        # The largest value of a dimension has its gradient.
        value = p["runs"][run]
        g["runs"] = _sum_rows(run, np.where(value == x[owner, :RUN_DIM], dx[owner, :RUN_DIM], np.float32(0)))
        return g


def _sum_rows(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct entries of ``index`` and the sum of ``values`` at each."""
    if not len(index):
        return index, values
    order = np.argsort(index, kind="stable")
    cut = np.flatnonzero(np.diff(index[order], prepend=index[order[0]] - 1))
    return index[order[cut]], np.add.reduceat(values[order], cut)


class Adam:
    """Gradients are arrays, or (rows, values) of the rows of a table that they touch."""

    def __init__(self, params: dict, rate: float):
        self.p, self.rate, self.n = params, rate, 0
        self.m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}

    def step(self, grads: dict) -> None:
        self.n += 1
        rate, level = np.float32(self.rate / (1 - 0.9**self.n)), np.float32(1 - 0.999**self.n)
        for k, g in grads.items():
            rows, g = g if isinstance(g, tuple) else (slice(None), g)
            m, v = (x[rows] for x in self.m[k])
            m = m + np.float32(0.1) * (g - m)
            v = v + np.float32(0.001) * (g * g - v)
            self.m[k][0][rows], self.m[k][1][rows] = m, v
            self.p[k][rows] -= rate * m / (np.sqrt(v / level) + np.float32(1e-8))


def _chosen(toxic, rank, count, first: bool, rng) -> np.ndarray:
    """Windows to learn from: at first some of every text, then the worst of each and a tenth of the clean ones."""
    lot = rng.random(len(rank))
    if first:
        return np.flatnonzero(lot < 6 / count)
    return np.flatnonzero(np.where(toxic, rank == 0, (rank == 0) | (lot < 0.1)))


def train(net: Net, texts: list[bytes], y: np.ndarray, seed: int = 1, warm: int = 3, epochs: int = 6, rate: float = 0.015) -> None:
    rng = np.random.default_rng(seed)
    ends, sets, at = np.cumsum([len(t) for t in texts]), [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 18), "right")))
        inputs = Inputs(texts[at:to])
        windows, doc = inputs.windows()
        sets.append((inputs, windows, doc + at))
        at = to
    opt = Adam(net.p, rate)
    for epoch in range(epochs):
        for inputs, at, doc in sets:
            first = epoch < warm
            strength = rng.random(len(doc)) if first else _logits(net, inputs, at)
            order = np.lexsort((-strength, doc))
            begin = np.searchsorted(doc[order], doc[order])
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - begin
            count = np.bincount(doc - doc[0])[doc - doc[0]]
            chosen = _chosen(y[doc] == 1, rank, count, first, rng)
            rng.shuffle(chosen)
            for i in range(0, len(chosen), BATCH):
                part = chosen[i : i + BATCH]
                used, inverse = np.unique(at[part], return_inverse=True)
                skip = int(len(used) > 0 and used[0] < 0)
                opt.step(net.gradients(inputs.part(used[skip:]), inverse.reshape(len(part), -1) - skip, y[doc[part]]))
    logit, labels = [], []
    for inputs, at, doc in sets:
        cut = np.flatnonzero(np.diff(doc, prepend=-1))
        logit.append(np.maximum.reduceat(_logits(net, inputs, at), cut))
        labels.append(y[doc[cut]])
    net.scale, net.shift = _calibrate(np.concatenate(logit).astype(float), np.concatenate(labels))


def _logits(net: Net, inputs: Inputs, at: np.ndarray) -> np.ndarray:
    x = net.inputs(inputs.slot, inputs.run, inputs.owner, inputs.cut)
    return np.concatenate([net.forward(x, at[i : i + 2048]) for i in range(0, len(at), 2048)])


def worst(net: Net, texts: list[bytes]) -> np.ndarray:
    """The logit of the worst window of every text."""
    inputs = Inputs(texts)
    at, doc = inputs.windows()
    return np.maximum.reduceat(_logits(net, inputs, at).astype(float), np.searchsorted(doc, np.arange(len(texts))))


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A logistic fit of the label on the worst window's logit, lightly held back."""
    a, b = 1.0, 0.0
    for _ in range(50):
        q = sigmoid(np.clip(a * x + b, -30, 30))
        w = q * (1 - q) + 1e-6
        grad = np.array([((q - y) * x).sum() + 0.1 * (a - 1), (q - y).sum() + 0.1 * b])
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return float(max(a, 0.05)), float(b)


def _excerpts(limit: int):
    """Long texts in evenly spaced parts; null is empty."""

    def run(batches):
        for batch in batches:
            for a, b, texts in _lines(batch, 0):
                made = [parts(t, limit) for t in texts]
                size = pa.array([len(t) for t in made], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), *(c.slice(a, b - a) for c in batch.columns[1:]), size], [*batch.schema.names, "size"])

    return run


def fit(labelled: DataFrame, fit_bytes: int = 8 << 20, seed: int = 1) -> Net:
    """The network from rows (text, label 0/1, place); ``place`` is a hash that chooses rows."""
    rows = labelled.select("text", "label", F.xxhash64("place", "text").alias("place"))
    rows = stage(rows.mapInArrow(_excerpts(fit_bytes // 32), "text binary, label int, place long, size long"), "labelled")
    sums = {r.label: (r.n, r.size) for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).collect()}
    all0, all1 = (sums.get(k, (0, 0))[0] for k in (0, 1))
    if not (all0 and all1):
        net = Net(seed)
        net.p["o"][:] = 0
        net.shift = float(np.log((all1 + 0.5) / (all0 + 0.5)))
        return net

    def learn(table: pa.Table) -> bytes:
        net, y = Net(seed), table.column("label").to_numpy().astype(np.int64)
        if 0 < y.sum() < len(y):
            train(net, table.column("text").to_pylist(), y, seed)
        # The sample need not hold both labels as often as all rows do; scores are for texts as they come.
        net.shift += float(np.log(all1 / all0) - np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        return net.to_bytes()

    taken = F.lit(False)
    for label, (_, size) in sums.items():
        taken = taken | ((F.col("label") == label) & below(F.col("place"), fit_bytes / max(size, 1)))
    made = fit_in_task(rows.where(taken).select("text", "label", "place"), ["place", "text"], learn)
    return Net.from_bytes(made) if made else Net(seed)


def _score(net: Net, text_at: int):
    def run(batches):
        for batch in batches:
            for a, b, texts in _lines(batch, text_at):
                score = pa.array(sigmoid(np.clip(net.scale * worst(net, texts) + net.shift, -30, 30)))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), score], [*batch.schema.names, "score"])

    return run


def _scored(docs: DataFrame, labels: DataFrame, train: Column | None, label_sample: int, id_col: str, text_col: str, label_col: str, options: dict) -> DataFrame:
    """``docs`` under plain names c0, c1, ... with ``score``."""
    usable = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"), F.xxhash64(F.lit("fit"), F.col(id_col)).alias("place"))
    usable = usable.where("label in (0, 1)")
    if train is not None:
        usable = usable.where(train)
    # At most label_sample narrow rows.
    sample = usable.orderBy("place", "_id").limit(label_sample)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain, text = docs.toDF(*names), names[docs.columns.index(text_col)]
    of = F.col(names[docs.columns.index(id_col)]) == F.col("_id")
    net = fit(plain.join(F.broadcast(sample), of).select(F.col(text).alias("text"), "label", "place"), **options)
    return plain.mapInArrow(_score(net, docs.columns.index(text_col)), plain.select("*", F.lit(0.0).alias("score")).schema)


@tidy
def with_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None, label_sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", score_col: str = "toxicity", **options) -> DataFrame:
    """``docs`` with a score column; ``train`` selects the rows of ``labels`` (id as ``_id``) that may be learnt from."""
    return _scored(docs, labels, train, label_sample, id_col, text_col, label_col, options).toDF(*docs.columns, score_col)


@tidy
def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5, train: Column | None = None, label_sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> DataFrame:
    """The rows that score under ``limit``, with all their columns."""
    return _scored(docs, labels, train, label_sample, id_col, text_col, label_col, options).where(F.col("score") < limit).drop("score").toDF(*docs.columns)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, score) of every row of ``docs``."""
    return with_toxicity(docs.select(id_col, text_col), labels, id_col=id_col, text_col=text_col, score_col="score", **options).select(id_col, "score")
