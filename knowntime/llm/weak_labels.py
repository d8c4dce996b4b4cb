"""Quality by weak labels: heuristic labellers, EM over their votes, a hashed linear scorer.

Each labeller votes 1 (good), -1 (poor) or 0 (no opinion) on a text, as a column
expression. The votes of all documents are counted by pattern, of which there
are at most 3 ** labellers, and expectation-maximisation on those counts gives
every labeller's behaviour under either class, and a posterior to every pattern.
The posteriors of a sample, about ``fit_bytes`` bytes of texts of either side chosen by a
hash, train a logistic scorer on hashed words, word shapes and word ends. The bound is a
classifier's; a text over a 24th of it is fitted on evenly spaced parts of it.

Scale: one scan for the counts, one for the sample and one for the scores;
nothing but patterns and the sample is shuffled. The counts cover all documents. The
scorer is trained in one Spark task, and the driver sees its weights alone.

Edge cases: a null text counts as empty; an empty text gets the votes of its
empty measures and the scorer's intercept. If all documents agree in every vote
the prior decides. Repeated rows are repeated in the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import below, fit_in_task, parts
from .staging import tidy
from .toxicity import sigmoid
from .vectortext import mix, slabs, words

SLOTS = 1 << 16
KINDS = 4


def _vote(poor: Column, good: Column) -> Column:
    return F.when(poor, -1).when(good, 1).otherwise(0)


def _flaw(poor: Column) -> Column:
    """A labeller that knows a flaw and has no opinion on a text without it."""
    return F.when(poor, -1).otherwise(0)


def labellers(text: Column) -> dict[str, Column]:
    """Votes on form alone, for texts in any language with spaces."""
    length = F.greatest(F.char_length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))) / length

    tokens = F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    n, n_lines = F.size(tokens), F.size(lines)
    distinct = F.size(F.array_distinct(tokens)) / F.greatest(n, F.lit(1))
    repeats = 1 - F.size(F.array_distinct(lines)) / F.greatest(n_lines, F.lit(1))
    ended = F.size(F.filter(lines, lambda x: F.trim(x).rlike(r"[.!?:;,\"')]$"))) / F.greatest(n_lines, F.lit(1))
    symbols, upper = share(r"[|#$%&*<>{}~^=_\\\\!]+"), share("[A-Z]+")
    average = F.char_length(text) / F.greatest(n, F.lit(1))
    return {
        "symbols": _vote(symbols > 0.03, symbols < 0.01),
        "marks": _flaw(F.regexp_count(text, F.lit(r"[!%&*$#=~]{2,}|\|")) / F.greatest(n, F.lit(1)) > 0.05),
        "upper": _flaw(upper > 0.25),
        # Long clean texts repeat words too: the longer, the lower the mark.
        "distinct": _vote((n >= 40) & (distinct < 0.25) & (n < 2000), (n >= 20) & (distinct > 0.5)),
        "repeats": _flaw((n_lines >= 3) & (repeats > 0.3)),
        "ends": _vote((n_lines >= 1) & (ended < 0.5), ended >= 0.9),
        "size": _flaw(n < 3),
        "word_length": _flaw((average < 2.5) | (average > 15)),
    }


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior by pattern, accuracy by labeller, share of good) from vote patterns and their counts.

    Votes are independent given the class, and a labeller without an opinion
    says nothing. Every labeller has a share of good votes under either class;
    the start is that labellers are right in four of five cases, so that the
    classes cannot swap.
    """
    m = votes.shape[1]
    total = max(counts.sum(), 1)
    up, down = (votes == 1).astype(float), (votes == -1).astype(float)
    good = np.stack((np.full(m, 0.2), np.full(m, 0.8)))  # share of good votes by class and labeller
    prior, post = 0.8, np.zeros(len(counts))
    for _ in range(rounds):
        logs = [up @ np.log(good[y]) + down @ np.log(1 - good[y]) for y in (0, 1)]
        post = sigmoid(np.clip(logs[1] - logs[0] + np.log(prior / (1 - prior)), -500, 500))
        weight = np.stack((counts * (1 - post), counts * post))
        for y in (0, 1):
            good[y] = (weight[y] @ up + 1) / (weight[y] @ (up + down) + 2)
        prior = float(np.clip((weight[1].sum() + 1) / (total + 2), 0.01, 0.99))
    right = prior * good[1] + (1 - prior) * (1 - good[0])
    return post, right, prior


def _slots(w) -> np.ndarray:
    """Per word: itself, its shape, and its last two bytes; KINDS - 1 slots each."""
    letter = np.zeros(256, np.uint8)
    letter[[*range(65, 91)]], letter[[*range(97, 123)]], letter[[*range(48, 58)]], letter[128:] = 1, 2, 3, 2
    data = np.concatenate((w.data, np.full(1, 32, np.uint8)))
    first, last, before = data[w.start], data[w.end - 1], data[np.maximum(w.end - 2, w.start)]
    shape = letter[first].astype(np.uint64) * np.uint64(4) + letter[last]
    shape = shape * np.uint64(4) + letter[before]
    own = np.where(letter[last] == 0, last, 0).astype(np.uint64)
    shape = mix((shape << np.uint64(8)) | own)
    ends = mix((before.astype(np.uint64) << np.uint64(8)) | last | np.uint64(1 << 20))
    return np.stack([(h % np.uint64(SLOTS)).astype(np.int64) + k * SLOTS for k, h in enumerate((w.hash, shape, ends))])


def _text_slots(w, n_texts: int) -> np.ndarray:
    """Per text: a slot for its share of distinct words and its length, both in steps."""
    out = np.zeros(n_texts, np.int64)
    for d in range(n_texts):
        h = w.hash[w.first[d] : w.first[d + 1]]
        step = int(10 * len(np.unique(h)) / len(h)) if len(h) else 11
        out[d] = (KINDS - 1) * SLOTS + 16 * step + min(15, len(h).bit_length())
    return out


def _margins(weights: np.ndarray, texts: list[bytes]) -> np.ndarray:
    w = words(texts)
    value = weights[_slots(w)].sum(0) if len(w.start) else np.zeros(0)
    total = np.concatenate(([0.0], np.cumsum(value)))
    n = np.diff(w.first)
    return 10 * (total[w.first[1:]] - total[w.first[:-1]]) / np.maximum(n, 1) + weights[_text_slots(w, len(texts))] + weights[-1]


def _slotted(texts: list[bytes], limit: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots of every word, words of every text, slot of every text); about ``limit`` bytes are hashed at a time, as that takes some 60 times their memory."""
    ends = np.cumsum([len(t) for t in texts])
    kinds, n, own, at = [np.zeros((KINDS - 1, 0), np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        w = words(texts[at:to])
        kinds.append(_slots(w).astype(np.int32))
        n.append(np.diff(w.first))
        own.append(_text_slots(w, to - at))
        at = to
    return np.concatenate(kinds, 1), np.concatenate(n), np.concatenate(own)


def train_scorer(texts: list[bytes], posterior: np.ndarray, rounds: int = 150, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights of a logistic scorer on soft labels: mean over words, full-batch Adam with decay."""
    slots, n, own = _slotted(texts)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), n)
    per_word = (10 / np.maximum(n, 1))[doc]
    place = np.zeros(KINDS * SLOTS, np.int32)
    place[slots], place[own] = 1, 1
    used = np.flatnonzero(place)
    place[used] = np.arange(len(used))
    of_words, of_texts = place[slots], place[own]
    x, bias = np.zeros(len(used)), 0.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    balance = np.where(posterior >= 0.5, 1 / max((posterior >= 0.5).sum(), 1), 1 / max((posterior < 0.5).sum(), 1)) / 2
    for t in range(1, rounds + 1):
        value = x[of_words[0]]
        for k in range(1, KINDS - 1):
            value += x[of_words[k]]
        value *= per_word
        margin = np.bincount(doc, value, len(texts)) + x[of_texts] + bias
        g = (sigmoid(margin) - posterior) * balance
        grad = np.bincount(of_texts, g, len(used)) + decay * x
        gw = g[doc] * per_word
        for k in range(KINDS - 1):
            grad += np.bincount(of_words[k], gw, len(used))
        grad = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        x, bias = x - step[:-1], bias - step[-1]
    out = np.zeros(KINDS * SLOTS + 1)
    out[used], out[-1] = x, bias
    return out


def _score(weights: np.ndarray):
    def run(batches):
        for batch in batches:
            others = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
            names = [x for x in batch.schema.names if x != "text"]
            for a, b, texts in slabs(batch.column("text")):
                score = sigmoid(np.clip(_margins(weights, texts), -30, 30))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in others), pa.array(score)], [*names, "score"])

    return run


@tidy
def quality_scores(docs: DataFrame, fit_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, votes, posterior, score, keep): the weak labels and the learnt score of every row."""
    text, limit = F.coalesce(F.col(text_col), F.lit("")), fit_bytes // 24
    made = labellers(text)
    votes = F.concat_ws(",", *[v.cast("string") for v in made.values()]).alias("votes")
    place = F.xxhash64(F.lit("fit"), F.col(id_col), text)
    # At most 3 ** len(labellers) patterns.
    patterns = docs.select(votes, F.least(F.octet_length(text), F.lit(limit)).alias("size")).groupBy("votes").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).orderBy("votes").collect()
    cast = np.array([[int(x) for x in r.votes.split(",")] for r in patterns], int).reshape(-1, len(made))
    post, _, _ = expectation_maximisation(cast, np.array([r.n for r in patterns], float))
    table = F.broadcast(docs.sparkSession.createDataFrame([(r.votes, float(p)) for r, p in zip(patterns, post)], "votes string, posterior double"))
    share = [fit_bytes / max(1, sum(r.size for r, p in zip(patterns, post) if (p >= 0.5) == side)) for side in (False, True)]
    # The hash first: votes are counted only where a text can be in the sample.
    sample = docs.where(below(place, max(share))).select(text.alias("text"), votes, place.alias("place")).join(table, "votes")
    sample = sample.where(below(F.col("place"), share[0]) & (F.col("posterior") < 0.5) | below(F.col("place"), share[1]) & (F.col("posterior") >= 0.5))

    def learn(rows: pa.Table) -> bytes:
        texts = [parts(t.encode(), limit) for t in rows.column("text").to_pylist()]
        return train_scorer(texts, rows.column("posterior").to_numpy()).astype(np.float32).tobytes()

    found = fit_in_task(sample.select("text", "posterior", "place"), ["place", "text"], learn)
    weights = np.frombuffer(found, np.float32).astype(float) if found else np.zeros(KINDS * SLOTS + 1)
    voted = docs.select(F.col(id_col).alias("id"), text.alias("text"), votes).join(table, "votes")
    schema = voted.select("id", "votes", "posterior", F.lit(0.0).alias("score")).schema
    scored = voted.select("id", "votes", "posterior", "text").mapInArrow(_score(weights), schema)
    return scored.withColumn("keep", F.col("score") >= 0.5).withColumnRenamed("id", id_col)
