"""Language-model scores: a gated recurrent network over a corpus-wide unigram.

Tokens are words (A-Z in lower case) and one end mark a text. Counts, tokens and
distinct tokens come from every training text. The network reads a text token
by token and predicts the class of the next one, then the token in its class:
tokens that make up ``least_share`` of the corpus or more have classes of their own by
frequency, all others fall into a few classes by form (length, last mark, script), inside
which a token has its smoothed share of the corpus counts, with one share for
tokens never seen. So probabilities of all tokens sum to one, and every text of any
length has a finite log-likelihood. The state is carried from window to window
to the end of the text.

The weights are learnt in Spark by truncated back-propagation on all training texts, whole
(a ``fit_share`` below 1 takes that share of them by a hash), each in one round. In
each of ``rounds`` rounds every task carries the common weights through its part of the
round's texts, and the common weights become the mean of the tasks', weighted by
tokens. The driver sees one set of weights a round.

Scale: texts are dealt by a hash of their id into blocks of about
``block_bytes``; a block asks for the counts of its distinct tokens in one join
by token (a token has one row a block there, however frequent), and is scored in one task. A
block is a number of whole texts, so its size is bounded by ``block_bytes`` and the
longest text. Each block is a set of lanes that numpy advances together. The shortlist has at
most 1 / ``least_share`` words; a learning task reads its texts as a stream, and at
most ``learners`` tasks learn at once, whose weights are averaged in groups.

Edge cases: a null or empty text is its end mark alone. Without training texts
every base score is 0 and the network is untrained. A null id is in training and
not held out. Repeated rows are repeated in the result and counted each.
"""

from __future__ import annotations

import copy
import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import below
from .staging import drop, stage, stage_at, tidy
from .toxicity import Adam
from .vectortext import as_bytes, slabs

END = "\n"
HIDDEN, EMBED, CLASS_SIZE, FORMS = 24, 16, 32, 18
HELD_WORDS = 300_000


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), b"\n"]


def form(word: bytes) -> int:
    """The class of a token outside the shortlist; as :func:`form_of`."""
    mark = 1 if word.endswith(b".") else 2 if word.endswith(b",") else 0
    size = 0 if len(word) <= 5 else 1 if len(word) <= 9 else 2
    return (mark * 2 + (not word.isascii())) * 3 + size


def form_of(word: Column) -> Column:
    mark = F.when(F.endswith(word, F.lit(".")), 1).when(F.endswith(word, F.lit(",")), 2).otherwise(0)
    size = F.when(F.octet_length(word) <= 5, 0).when(F.octet_length(word) <= 9, 1).otherwise(2)
    return (mark * 2 + (F.octet_length(word) != F.char_length(word)).cast("int")) * 3 + size


def _count(batches):
    held: Counter = Counter()

    def rows():
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for _, _, texts in slabs(batch.column(0)):
            for t in texts:
                held.update(tokens(t))
            if len(held) > HELD_WORDS:
                yield rows()
    yield rows()


def token_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the one column ``text``."""
    return texts.select("text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Model:
    """Weights and vocabulary: ids below ``k`` are the shortlist, then one id a form."""

    def __init__(self, shortlist: list[tuple[str, int]], forms: dict[int, tuple[int, int]], total: int, distinct: int, seed: int):
        self.words = {w.encode(): i for i, (w, _) in enumerate(shortlist)}
        self.k, self.total, self.distinct = len(shortlist), total, distinct
        self.classes = -(-self.k // CLASS_SIZE)
        self.form_size = np.array([sum(forms.get(f, (0, 0))) + 1 for f in range(FORMS)], float)
        rng = np.random.default_rng(seed)

        def normal(*shape):
            return (rng.normal(size=shape) * 0.15).astype(np.float32)

        n = np.array([c for _, c in shortlist], float) + 0.5
        mass = [n[i * CLASS_SIZE : (i + 1) * CLASS_SIZE].sum() for i in range(self.classes)] + [forms.get(f, (0, 0))[0] + 0.5 for f in range(FORMS)]
        inside = np.full((self.classes, CLASS_SIZE), -1e9, np.float32)
        inside.ravel()[: self.k] = np.log(n)
        self.p = {
            "E": normal(self.k + FORMS, EMBED), "W": normal(EMBED, 3 * HIDDEN), "U": normal(HIDDEN, 3 * HIDDEN), "c": np.zeros(3 * HIDDEN, np.float32),
            "C": normal(HIDDEN, self.classes + FORMS) * 0.1, "d": np.log(np.array(mass) / sum(mass)).astype(np.float32),
            "V": normal(self.classes, HIDDEN, CLASS_SIZE) * 0.1, "w": inside,
        }

    def weights(self) -> bytes:
        return np.concatenate([v.ravel() for v in self.p.values()]).tobytes()

    def take(self, weights: bytes) -> None:
        flat, at = np.frombuffer(weights, np.float32), 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).copy()
            at += v.size

    def code(self, word: bytes) -> int:
        i = self.words.get(word)
        return self.k + form(word) if i is None else i

    def codes(self, words: list[bytes]) -> list[int]:
        known, k = self.words.get, self.k
        return [k + form(w) if (i := known(w)) is None else i for w in words]

    def step(self, g: np.ndarray, h: np.ndarray):
        H, u = HIDDEN, h @ self.p["U"]
        zr = g[:, : 2 * H] + u[:, : 2 * H]
        # The logistic function, in place.
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        c = zr[:, H:] * u[:, 2 * H :]
        c += g[:, 2 * H :]
        np.tanh(c, out=c)
        new = h - c
        new *= zr[:, :H]
        new += c
        return new, zr, c, u[:, 2 * H :]

    def output(self, h: np.ndarray, target: np.ndarray, keep: bool = False):
        """log P(class) + log P(token in class) of each target; the share inside a form is added by the caller."""
        p = self.p
        cls = np.where(target < self.k, target // CLASS_SIZE, self.classes + target - self.k)
        logits = h @ p["C"]
        logits += p["d"]
        logits -= logits.max(1, keepdims=True)
        row = np.arange(len(h))
        out = logits[row, cls]
        soft = np.exp(logits, out=logits)
        norm = soft.sum(1)
        out -= np.log(norm)
        # Targets of the shortlist by class: a product a class, all else at once.
        order = np.argsort(cls.astype(np.int16), kind="stable")
        cuts = np.searchsorted(cls[order], np.arange(self.classes + 1))
        order = order[: cuts[-1]]
        near, x = h[order], np.empty((len(order), CLASS_SIZE), h.dtype)
        for c, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                np.matmul(near[a:b], p["V"][c], out=x[a:b])
        x += p["w"][cls[order]]
        x -= x.max(1, keepdims=True)
        at = target[order] - cls[order] * CLASS_SIZE
        own = x[row[: len(x)], at]
        e = np.exp(x, out=x)
        s = e.sum(1)
        out[order] += own - np.log(s)
        if not keep:
            return out
        soft /= norm[:, None]
        e /= s[:, None]
        return out, cls, soft, (order, cuts, near, e, at)

    def train(self, stream: np.ndarray, starts: np.ndarray, lanes: int = 64, window: int = 32, epochs: int = 1, rate: float = 0.004) -> None:
        """Truncated back-propagation over ``stream``; ``starts`` marks where a text begins."""
        # Short streams have fewer lanes, so that they still make about a hundred steps.
        lanes = max(1, min(lanes, len(stream) // (100 * window)))
        n = (len(stream) - 1) // lanes
        if n < 1:
            return
        inputs = stream[: n * lanes].reshape(lanes, n).T
        targets = stream[1 : n * lanes + 1].reshape(lanes, n).T
        fresh = starts[: n * lanes].reshape(lanes, n).T
        opt = Adam(self.p, rate)
        for _ in range(epochs):
            h = np.zeros((lanes, HIDDEN), np.float32)
            for a in range(0, n, window):
                h = self._update(inputs[a : a + window], targets[a : a + window], fresh[a : a + window], h, opt)

    def _update(self, inputs, targets, fresh, h, opt):
        p, H, T = self.p, HIDDEN, len(inputs)
        x = p["E"][inputs]
        g_in = x @ p["W"] + p["c"]
        # What each step of the window had and made, over all lanes; a state is dropped where a text begins.
        before, after = np.empty((T, *h.shape), h.dtype), np.empty((T, *h.shape), h.dtype)
        zr, c, uc = np.empty((T, len(h), 2 * H), h.dtype), np.empty_like(before), np.empty_like(before)
        stays = np.where(fresh, 0, 1).astype(h.dtype)[:, :, None]
        for t in range(T):
            np.multiply(h, stays[t], out=before[t])
            after[t], zr[t], c[t], uc[t] = self.step(g_in[t], before[t])
            h = after[t]
        hs, flat = after.reshape(-1, H), targets.ravel()
        _, cls, soft, (order, cuts, near, q, at) = self.output(hs, flat, True)
        m = h.dtype.type(1 / len(flat))
        soft[np.arange(len(flat)), cls] -= 1
        soft *= m
        q[np.arange(len(q)), at] -= 1
        q *= m
        grads = {"V": np.zeros_like(p["V"]), "w": np.zeros_like(p["w"]), "C": hs.T @ soft, "d": soft.sum(0)}
        dhs, dnear = soft @ p["C"].T, np.empty_like(near)
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                np.matmul(near[a:b].T, q[a:b], out=grads["V"][k])
                np.matmul(q[a:b], p["V"][k].T, out=dnear[a:b])
        some = np.flatnonzero(np.diff(cuts))
        if len(some):
            grads["w"][some] = np.add.reduceat(q, cuts[some], 0)
        dhs[order] += dnear
        dhs, dg, dh = dhs.reshape(T, -1, H), np.empty_like(g_in), np.zeros_like(h)
        # All factors of the chain but the gradient that is carried back.
        z, r, back = zr[:, :, :H], zr[:, :, H:], np.ascontiguousarray(p["U"].T)
        by_c = (1 - z) * (1 - c * c)
        by_z, by_r = (before - c) * z * (1 - z), uc * r * (1 - r)
        pass_on, du = z * stays, np.empty((len(h), 3 * H), h.dtype)
        for t in reversed(range(T)):
            dh += dhs[t]
            dz, dr, dc = dg[t, :, :H], dg[t, :, H : 2 * H], dg[t, :, 2 * H :]
            np.multiply(dh, by_c[t], out=dc)
            np.multiply(dh, by_z[t], out=dz)
            np.multiply(dc, by_r[t], out=dr)
            du[:, : 2 * H] = dg[t, :, : 2 * H]
            np.multiply(dc, r[t], out=du[:, 2 * H :])
            dh *= pass_on[t]
            dh += (du @ back) * stays[t]
        flat_g = dg.reshape(-1, 3 * H)
        by_u = flat_g.copy()
        by_u[:, 2 * H :] *= r.reshape(-1, H)
        grads["U"] = before.reshape(-1, H).T @ by_u
        grads["W"], grads["c"] = x.reshape(-1, EMBED).T @ flat_g, flat_g.sum(0)
        grads["E"] = np.zeros_like(p["E"])
        by_word = np.argsort(inputs.ravel(), kind="stable")
        words, first = np.unique(inputs.ravel()[by_word], return_index=True)
        grads["E"][words] = np.add.reduceat((flat_g @ p["W"].T)[by_word], first, 0)
        size = np.sqrt(sum(float(np.vdot(v, v)) for v in grads.values()))
        if size > 1:
            grads = {k: v / h.dtype.type(size) for k, v in grads.items()}
        opt.step(grads)
        return h

    def log_likelihoods(self, codes: list[np.ndarray], lanes: int = 128, chunk: int = 16) -> np.ndarray:
        """Natural log-likelihood of every text (codes end with the end mark), without shares inside forms."""
        end = self.words[END.encode()]
        load = [(0, i) for i in range(min(lanes, len(codes)))]
        held: list[list[int]] = [[] for _ in load]
        for d in sorted(range(len(codes)), key=lambda d: -len(codes[d])):
            n, i = heapq.heappop(load)
            held[i].append(d)
            heapq.heappush(load, (n + len(codes[d]), i))
        # Longest lanes first, so that those still running are the first ones.
        held.sort(key=lambda docs: -sum(len(codes[d]) for d in docs))
        length = np.array([sum(len(codes[d]) for d in docs) for docs in held])
        T = int(length[0])
        target, owner = np.full((len(held), T), -1), np.zeros((len(held), T), np.int64)
        inputs, fresh = np.full((len(held), T), end), np.zeros((len(held), T), bool)
        for i, docs in enumerate(held):
            at = 0
            for d in docs:
                c = codes[d]
                target[i, at : at + len(c)], owner[i, at : at + len(c)] = c, d
                inputs[i, at + 1 : at + len(c)], fresh[i, at] = c[:-1], True
                at += len(c)
        table = self.p["E"] @ self.p["W"] + self.p["c"]
        inputs, fresh, out = inputs.T.copy(), fresh.T[:, :, None], np.zeros(len(codes))
        h = np.zeros((len(held), HIDDEN), np.float32)
        for a in range(0, T, chunk):
            states, live = [], int((length > a).sum())
            h = h[:live]
            for t in range(a, min(T, a + chunk)):
                h = self.step(table[inputs[t, :live]], np.where(fresh[t, :live], np.float32(0), h))[0]
                states.append(h)
            want = target[:live, a : a + chunk].T.ravel()
            real = want >= 0
            got = self.output(np.concatenate(states)[real], want[real])
            out += np.bincount(owner[:live, a : a + chunk].T.ravel()[real], got, len(codes))
        return out


def untrained(counts: DataFrame, least_share: float, seed: int) -> Model:
    """The vocabulary and first weights; ``counts`` as of :func:`token_counts`."""
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total = total or 0
    frequent = (F.col("n") >= F.lit(least_share * total)) & (F.col("word") != END)
    # At most 1 / least_share rows, and one a form.
    words = [(r.word, r.n) for r in counts.where(frequent).orderBy(F.desc("n"), "word").collect()]
    end = counts.where(F.col("word") == END).first()
    words.append((END, end.n if end else 0))
    rest = counts.where(~frequent & (F.col("word") != END)).groupBy(form_of(F.col("word")).alias("form"))
    forms = {r.form: (r.n, r.v) for r in rest.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    return Model(words, forms, total, distinct, seed)


def _learn(model: Model, chunk: int):
    """Carry the weights through all texts of a task, about ``chunk`` tokens at a time."""

    def run(batches):
        own, seen = copy.deepcopy(model), 0
        end, held, size = own.words[END.encode()], [], 0

        def learn():
            stream = np.concatenate(held)
            own.train(stream, np.concatenate([np.arange(len(c)) == 0 for c in held]))
            return len(stream)

        for batch in batches:
            for _, _, texts in slabs(batch.column(0)):
                for t in texts:
                    held.append(np.array([end, *own.codes(tokens(t))]))
                    size += len(held[-1])
                    if size >= chunk:
                        seen += learn()
                        held, size = [], 0
        if held:
            seen += learn()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([own.weights()], pa.binary())], ["tokens", "weights"])

    return run


def _mean(table: pa.Table) -> pa.Table:
    share, total = table.column("tokens").to_numpy().astype(float), None
    for n, w in zip(share, table.column("weights")):
        part = np.frombuffer(w.as_buffer(), np.float32) * np.float32(n / share.sum())
        total = part if total is None else total + part
    return pa.table({"tokens": pa.array([int(share.sum())], pa.int64()), "weights": pa.array([total.tobytes()], pa.binary())})


def learn(model: Model, texts: DataFrame, fit_share: float = 1.0, rounds: int = 3, task_bytes: int = 2 << 20, learners: int = 1024, chunk: int = 1 << 18) -> None:
    """Fit the weights; ``texts`` has text and place, a hash."""
    taken, path = stage_at(texts.where(below(F.col("place"), fit_share)).select("text", "place"), "lessons")
    size = taken.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, min(learners, -(-size // (rounds * task_bytes))))
    for r in range(rounds):
        own = taken.where(F.pmod(F.xxhash64(F.lit("round"), "place"), F.lit(rounds)) == r)
        made = own.repartition(tasks, "place").sortWithinPartitions("place", "text").select("text").mapInArrow(_learn(model, chunk), "tokens long, weights binary")
        groups = made.withColumn("part", F.spark_partition_id() % 32).groupBy("part").applyInArrow(_mean, "tokens long, weights binary")
        mean = groups.groupBy().applyInArrow(_mean, "tokens long, weights binary").first()
        if mean:
            model.take(bytes(mean.weights))
    drop(texts.sparkSession, path)


def _asked(table: pa.Table) -> pa.Table:
    """The distinct tokens of a block."""
    found: set[bytes] = set()
    for t in as_bytes(table.column("text").combine_chunks()):
        found.update(tokens(t))
    block = table.column("block")[0].as_py()
    return pa.table({"block": pa.array([block] * len(found), pa.int64()), "word": pa.array(list(found), pa.binary()).cast(pa.string())})


def _score(model: Model):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
        words = as_bytes(known.column("word").combine_chunks())
        index = {w: i for i, w in enumerate(words)}
        seen = known.column("n").to_numpy()
        code = known.column("code").to_numpy()
        base = np.log10((seen + 1) / (model.total + model.distinct + 1))
        share = np.where(code >= model.k, np.log((seen + 1) / model.form_size[np.maximum(code - model.k, 0)]), 0.0)
        codes, n, n_known, base_score, shares = [], [], [], [], []
        for t in as_bytes(docs.column("text").combine_chunks()):
            at = np.fromiter(map(index.__getitem__, tokens(t)), np.int64)
            codes.append(code[at])
            n.append(len(at))
            n_known.append(int((seen[at] > 0).sum()))
            base_score.append(float(base[at].sum()))
            shares.append(float(share[at].sum()))
        score = (model.log_likelihoods(codes) + np.array(shares)) / np.log(10)
        return pa.table({"id": docs.column("id"), "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base_score, pa.float64()), "score": pa.array(score, pa.float64())})

    return run


@tidy
def likelihoods(
    docs: DataFrame, train: Column | None = None, block_bytes: int = 8 << 20, least_share: float = 1e-4, seed: int = 1,
    id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row; ids are integers."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    learnt = rows if train is None else docs.where(train).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = stage(token_counts(learnt), "counts")
    model = untrained(counts, least_share, seed)
    learn(model, learnt.withColumn("place", F.xxhash64(F.lit("fit"), "id", "text")), **options)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "id", "text"), F.lit(blocks)))
    # Both uses of the dealt texts read the same exchange.
    asked = dealt.groupBy("block").applyInArrow(_asked, "block long, word string")
    short = docs.sparkSession.createDataFrame([(w.decode(), i) for w, i in model.words.items()], "word string, place int")
    known = asked.join(counts, "word", "left").join(F.broadcast(short), "word", "left")
    known = known.select("block", "word", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("place", model.k + form_of(F.col("word"))).cast("long").alias("code"))
    scored = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_score(model), "id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
