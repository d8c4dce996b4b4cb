"""Exact merge-type (BPE) encoding of a SentencePiece vocabulary by backtracking, and its decoding.

Merging always joins the pair whose piece has the best score, the leftmost of equals. A
sequence of pieces is what merging a text ends with exactly if merging any two neighbours
by themselves ends with these two: the first merge across a border would have happened there
too. So the encoder walks from the left and takes the longest piece that starts where it
stands, found by an Aho-Corasick automaton, and is compatible with the piece before, which is
tried by merging the two anew and remembered. If it does not fit, the next shorter piece that begins
it is tried; if none does, the position is marked in a bitfield as failed and the last piece gives way to the next shorter
one. The pieces up to a position are determined by it, so no position fails twice.

Characters that are in no piece are never merged; they end a search and become their UTF-8
bytes. Nor is anything merged across two neighbours that are together in no piece. If that holds,
as is checked, wherever letters meet other characters or a run of spaces begins, a text is
encoded by the stretches between, and a bounded table remembers those met before.

Scale: one pass over the rows, without a shuffle; the vocabulary goes to the tasks as a
broadcast of its file, whose size is the vocabulary's.

Edge cases: a null text is an empty one; an empty text has no pieces (an end id only).
Rows are encoded one by one, so repeated rows, null ids and ties need no rule; an empty
table gives an empty one. Other columns are not read. Ids outside the vocabulary are an error in decoding.
"""

from __future__ import annotations

import codecs
import itertools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from .vectortext import slabs

#: How SentencePiece writes a space, and what it decodes its unknown piece to.
SPACE, UNKNOWN = "▁", " ⁇ "
#: Remembered stretches of either generation, and remembered pairs, at most.
REMEMBERED, PAIRS = 200_000, 500_000
NEVER = float("-inf")
LETTER = re.compile(r"[^\W\d_]")
_loaded: dict[int, Codec] = {}


def _cut(neighbours: set[str]) -> re.Pattern | None:
    """A pattern of stretches that no piece goes beyond, given the neighbours within pieces: letters, other characters, and before spaces."""
    # A letter that pieces join with other characters counts as one of these.
    joined = {c for x, y in neighbours if SPACE not in (x, y) and bool(LETTER.match(x)) != bool(LETTER.match(y)) for c in (x, y) if LETTER.match(c)}
    letter = f"[^\\W\\d_{re.escape(''.join(sorted(joined)))}]"
    cuts = [f"{SPACE}*(?:{letter}+|(?:(?!{letter})[^{SPACE}])+)|{SPACE}+", f"{SPACE}*[^{SPACE}]+|{SPACE}+"]
    return next((cut for cut in map(re.compile, cuts) if all(len(cut.findall(pair)) == 1 for pair in neighbours)), None)


codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Codec:
    """The pieces of one model file (BPE with byte fallback, no normalisation but a leading space)."""

    def __init__(self, model: bytes):
        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        rules = spec.normalizer_spec
        if spec.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE or not spec.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback can be encoded here")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models without normalisation of texts can be encoded here")
        if any(p.type == p.USER_DEFINED for p in spec.pieces):
            raise ValueError("models with pieces of the user's own cannot be encoded here")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.pieces = {p.piece: i for i, p in enumerate(spec.pieces) if p.type in (p.NORMAL, p.UNUSED)}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type in (p.NORMAL, p.UNUSED)}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == p.BYTE}
        self.value = {i: bytes([b]) for b, i in self.bytes.items()}
        self.control = frozenset(i for i, p in enumerate(spec.pieces) if p.type == p.CONTROL)
        self.end = spec.trainer_spec.eos_id
        self.surface = ["" if p.type == p.CONTROL else UNKNOWN if p.type == p.UNKNOWN else p.piece.replace(SPACE, " ") for p in spec.pieces]
        self.stretches = _cut({p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)})
        # Tokens: pieces, and characters that occur in pieces only.
        self.text = sorted({*self.pieces, *"".join(self.pieces)})
        token = {t: i for i, t in enumerate(self.text)}
        self.size, self.longest = [len(t) for t in self.text], max(map(len, self.text))
        self.ids = [[self.pieces[t]] if t in self.pieces else [self.bytes[b] for b in t.encode()] for t in self.text]
        # Of every beginning of a token the longest token that begins it, and of every token the next shorter one.
        self.begins: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in token.items():
            self.automaton.add_word(t, i)
            at = -1
            for n in range(1, len(t) + 1):
                at = token.get(t[:n], at)
                self.begins[t[:n]] = at
        self.shorter = [self.begins.get(t[:-1], -1) for t in self.text]
        self.automaton.make_automaton()
        self.met: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.pairs: dict[int, bool] = {}
        # The bytes of all pieces, for decoding.
        written = [self.value[i] if i in self.value else t.encode() for i, t in enumerate(self.surface)]
        self.blob = np.frombuffer(b"".join(written), np.uint8)
        self.width = np.array([len(w) for w in written])
        self.begin = np.concatenate(([0], np.cumsum(self.width)[:-1]))
        self.spaced = np.array([t.startswith(" ") and t != UNKNOWN and i not in self.value for i, t in enumerate(self.surface)])

    def kept_apart(self, last: str, token: str) -> bool:
        """Whether merging ``last`` and ``token`` together, from single characters, ends with just these two."""
        have = [*last, *token]
        left, right, get = len(last), len(token), self.scores.get
        scores = [get(x + y, NEVER) for x, y in zip(have, have[1:])]
        while scores and (best := max(scores)) > NEVER:
            i = scores.index(best)
            if i == left - 1:
                return False
            if i < left:
                left -= 1
            else:
                right -= 1
            have[i : i + 2] = [have[i] + have[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(have[i - 1] + have[i], NEVER)
            if i < len(scores):
                scores[i] = get(have[i] + have[i + 1], NEVER)
        return left <= 1 and right == 1

    def compatible(self, last: int, token: int) -> bool:
        """Try a pair of tokens and remember it; ``last`` is -1 where nothing is before."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        found = self.pairs[last * len(self.text) + token] = self.kept_apart(self.text[last] if last >= 0 else "", self.text[token])
        return found

    def tokens(self, text: str) -> list[int]:
        """What merging ``text`` ends with, by backtracking; -1 for a character of no piece."""
        # About half the time the longest matches one after the other, as the automaton finds them, are it.
        out = [token for _, token in self.automaton.iter_long(text)]
        if sum(map(self.size.__getitem__, out)) != len(text):
            return self._search(text, [], -1)
        known, tokens, last = self.pairs.get, len(self.text), -1
        for i, token in enumerate(out):
            fits = known(last * tokens + token)
            if not fits and (fits is not None or not self.compatible(last, token)):
                return self._search(text, out[:i], token)
            last = token
        return out

    def _search(self, text: str, out: list[int], token: int) -> list[int]:
        """Go on from ``out``; ``token`` is the longest match there, -1 if it is yet to be found."""
        size, shorter, begins, prefix, longest = self.size, self.shorter, self.begins, self.automaton.longest_prefix, self.longest
        known, tokens, n, failed = self.pairs.get, len(self.text), len(text), 0 if len(text) < 64 else bytearray(len(text) // 8 + 1)
        pos = sum(map(size.__getitem__, out))
        # Behind a character of no piece a search of its own begins.
        origin = 0
        while pos < n:
            if token < 0:
                ahead = text[pos : pos + longest]
                token = begins.get(ahead[: prefix(ahead)], -1)
                if token < 0:
                    out.append(-1)
                    pos = origin = pos + 1
                    continue
            last = out[-1] if pos > origin else -1
            while token >= 0:
                end = pos + size[token]
                # The bitfield of a short text is one number.
                if not (failed >> end if n < 64 else failed[end >> 3] >> (end & 7)) & 1:
                    fits = known(last * tokens + token)
                    if fits or (fits is None and self.compatible(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos, token = end, -1
            elif pos == origin:
                raise ValueError("the vocabulary has no encoding of this text")
            else:
                if n < 64:
                    failed |= 1 << pos
                else:
                    failed[pos >> 3] |= 1 << (pos & 7)
                token = out.pop()
                pos -= size[token]
        return out

    def _stretch(self, text: str) -> list[int]:
        ids: list[int] = []
        pos = 0
        for token in self.tokens(text):
            if token >= 0:
                ids += self.ids[token]
                pos += self.size[token]
            else:
                ids += [self.bytes[b] for b in text[pos].encode()]
                pos += 1
        return ids

    def encode(self, text: str, end: bool = False) -> list[int]:
        ids: list[int] = []
        if text:
            text = self.prefix + text.replace(" ", SPACE)
            met = self.met
            for part in self.stretches.findall(text) if self.stretches else [text]:
                found = met.get(part)
                if found is None:
                    found = self.old.get(part) or self._stretch(part)
                    if len(part) <= 64:
                        if len(met) >= REMEMBERED:
                            self.old, self.met = met, {}
                            met = self.met
                        met[part] = found
                ids += found
        return [*ids, self.end] if end else ids

    def decode(self, ids: list[int]) -> str:
        """One leading space of the first visible piece goes; bytes that are no UTF-8 become U+FFFD one by one."""
        if ids and min(ids) < 0:
            raise IndexError("ids are not negative")
        first = next((i for i in ids if i not in self.control), None)
        if self.value.keys().isdisjoint(ids):
            text = "".join(map(self.surface.__getitem__, ids))
        else:
            # Runs of bytes are read together, what is between them as it is.
            parts, run = [], b""
            for i in ids:
                if i in self.value:
                    run += self.value[i]
                else:
                    parts += [run.decode("utf-8", "each_byte"), self.surface[i]]
                    run = b""
            text = "".join(parts) + run.decode("utf-8", "each_byte")
        strip = self.prefix and first is not None and first not in self.value and self.surface[first].startswith(" ") and self.surface[first] != UNKNOWN
        return text[1:] if strip else text

    def decode_all(self, ends: np.ndarray, ids: np.ndarray) -> list[str]:
        """The texts of many lists of ids, that end at ``ends``."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.width):
            raise IndexError("an id is not in the vocabulary")
        width = self.width[ids]
        stop = np.concatenate(([0], np.cumsum(width)))
        data = self.blob[np.repeat(self.begin[ids] - stop[:-1], width) + np.arange(stop[-1])].tobytes()
        out = []
        for a, b in zip(ends[:-1], ends[1:]):
            first = a
            while first < b and ids[first] in self.control:
                first += 1
            try:
                out.append(data[stop[a] + bool(self.prefix and first < b and self.spaced[ids[first]]) : stop[b]].decode())
            except UnicodeDecodeError:
                out.append(self.decode(ids[a:b].tolist()))
        return out


def _codec(model: bytes) -> Codec:
    """One a worker, kept from task to task."""
    key = hash(model)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Codec(model)
    return _loaded[key]


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver; a vocabulary bounds its size."""
    return sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto()


def _lists(lists: list[list[int]]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(ids) for ids in lists])))
    flat = np.fromiter(itertools.chain.from_iterable(lists), np.int32, ends[-1])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encoded(spark: SparkSession, docs: DataFrame, model: str, end: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids of every text, with the end id if ``end``."""
    shared = spark.sparkContext.broadcast(model_bytes(model))

    def run(batches):
        codec = _codec(shared.value)
        for batch in batches:
            for a, b, texts in slabs(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _lists([codec.encode(t.decode(), end) for t in texts])], ["id", "ids"])

    made = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return made.mapInArrow(run, f"id {made.schema['id'].dataType.simpleString()}, ids array<int>").toDF(id_col, "ids")


def decoded(spark: SparkSession, rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text): the text that every list of ids stands for; null stands for an empty list."""
    shared = spark.sparkContext.broadcast(model_bytes(model))

    def run(batches):
        codec = _codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                count = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False)
                texts = codec.decode_all(np.concatenate(([0], np.cumsum(count))), part.column(1).flatten().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["id", "ids", "text"])

    made = rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return made.mapInArrow(run, f"id {made.schema['id'].dataType.simpleString()}, ids array<int>, text string").toDF(id_col, "ids", "text")
