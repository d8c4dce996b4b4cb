import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from knowntime.llm import piece_codec, q_op11

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path(q_op11.MODEL)
ALPHABET = "abcdeéßñ 漢字執벨ゼ▁\n\t\x00 😀\U0010ffff   <0x41>s1290.,-_'²³ᄀĦтак"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return piece_codec.Codec(piece_codec.model_bytes(MODEL))


def test_random_texts_and_ids_are_the_librarys(codec, library):
    rng = random.Random(1)
    common = ["the", " the", "tion", " and", "\n\n", "    ", "ing", "é"]
    for _ in range(6000):
        text = "".join(rng.choice(ALPHABET) if rng.random() < 0.6 else rng.choice(common) for _ in range(rng.randint(0, 40)))
        ids = codec.encode(text, True)
        assert ids == library.encode(text, add_eos=True)
        assert codec.decode(ids) == library.decode(ids)
        ids = [rng.randrange(32_000) if rng.random() < 0.5 else rng.randrange(262) for _ in range(rng.randint(0, 9))]
        assert codec.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 30_000, " " * 50_001, "thethethe" * 9_000, "▁" * 7 + "x" * 5_000, "�" * 5_000, ""])
def test_long_stretches(codec, library, text):
    assert codec.encode(text) == library.encode(text)


def _model(pieces, rules=()):
    spec = sentencepiece_model_pb2.ModelProto()
    spec.trainer_spec.model_type, spec.trainer_spec.byte_fallback = sentencepiece_model_pb2.TrainerSpec.BPE, True
    for key, value in {"add_dummy_prefix": True, "remove_extra_whitespaces": False, "escape_whitespaces": True, **dict(rules)}.items():
        setattr(spec.normalizer_spec, key, value)
    for i, (piece, score) in enumerate([("<unk>", 0), ("<s>", 0), ("</s>", 0), *[(f"<0x{b:02X}>", 0) for b in range(256)], *pieces]):
        spec.pieces.add(piece=piece, score=score, type=2 if i == 0 else 3 if i < 3 else 6 if i < 259 else 1)
    return spec.SerializeToString()


def test_any_vocabulary(codec):
    """Vocabularies that no training gives: equal scores, pieces that cannot be reached, parts that score less than the whole."""
    rng = random.Random(4)
    for _ in range(60):
        pieces = {"".join(rng.choices("ab▁c", k=rng.randint(2, 5))) for _ in range(rng.randint(1, 14))} | set(rng.sample("ab▁", rng.randint(0, 3)))
        model = _model([(p, -float(rng.randint(0, 12))) for p in sorted(pieces)])
        own, library = piece_codec.Codec(model), sentencepiece.SentencePieceProcessor(model_proto=model)
        for _ in range(60):
            text = "".join(rng.choices("ab cd", k=rng.randint(0, 24)))
            assert own.encode(text) == library.encode(text), (pieces, text)


def test_backtracking_marks_failed_positions():
    """Longest matches run into a dead end that only shorter ones avoid."""
    model = _model([("▁", -9), ("a", -9), ("b", -9), ("c", -9), ("bc", -1), ("ab", -2), ("abb", -3), ("▁a", -4)])
    own, library = piece_codec.Codec(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in ("abbc", "ababbc", "abb" * 50 + "c", "bcabc"):
        assert own.encode(text) == library.encode(text)


@pytest.mark.parametrize("rule", [("remove_extra_whitespaces", True), ("escape_whitespaces", False)])
def test_other_rules_are_refused(rule):
    with pytest.raises(ValueError):
        piece_codec.Codec(_model([("a", -1)], [rule]))


def test_rows(spark, library):
    """Nulls, empty and long texts, repeated rows, null ids, clashing columns, and no rows."""
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, " x  y\n\t"), (4, "".join(random.Random(2).choices(ALPHABET, k=200_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("own")).withColumn("id", F.lit(0))
    out = piece_codec.decoded(spark, piece_codec.encoded(spark, df, MODEL), MODEL)
    assert out.columns == ["doc_id", "ids", "text"]
    want = [(i, library.encode(t or "", add_eos=True)) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.ids, r.text) for r in out.collect()), key=key) == sorted(((i, ids, library.decode(ids)) for i, ids in want), key=key)
    assert piece_codec.decoded(spark, piece_codec.encoded(spark, df.limit(0), MODEL), MODEL).count() == 0
    named = df.select(F.col("doc_id").alias("text"), F.col("text").alias("ids"))
    assert piece_codec.encoded(spark, named, MODEL, False, "text", "ids").where("text = 3 and size(ids) = 2").count() == 2


def test_query_is_the_librarys(spark, library):
    sf = "/root/testdata/sf0.001"
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_eos=True)
        want[r.doc_id] = (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))
    assert {r[0]: tuple(r[1:]) for r in q_op11.query(spark, sf).collect()} == want
