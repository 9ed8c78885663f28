import random

import numpy as np
import pytest
import sentencepiece

from barlake.llm.pieces import Codec, Vocabulary, round_trip
from barlake.llm.queries import model_path

RAW = open(model_path(), "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=RAW)
ALPHABET = [*"abcdefghij  ▁\n\t éüñ12,.<>-ßçèTHEthe", "日", "本", "한", "😀", "\0", "\u200b", "ﬀ"]


def ids_of(raw):
    return np.frombuffer(raw, "<i4").tolist()


def test_encodes_and_decodes_as_the_library():
    rng, codec = random.Random(3), Codec(RAW, remembered=300)
    for _ in range(60):
        texts = ["".join(rng.choices(ALPHABET, k=rng.choice([0, 1, 2, 5, 30, 300]))) for _ in range(20)]
        texts += ["<s>", "</s> <unk>", "<0x0A>", " ", "   a   b ", "a" * 3000, " " * 500, "hello   world  "]
        rows = codec.encode(texts, "texts")
        for text, row, back in zip(texts, rows, codec.decode(rows)):
            assert ids_of(row) == LIBRARY.encode(text)
            assert back == LIBRARY.decode(LIBRARY.encode(text))


def test_decodes_any_ids():
    rng, codec = random.Random(4), Codec(RAW)
    rows = [[rng.randrange(rng.choice([400, 32000])) for _ in range(rng.choice([0, 1, 3, 20]))] for _ in range(1000)]
    got = codec.decode([np.array(r, "<i4").tobytes() for r in rows])
    assert got == [LIBRARY.decode(r) for r in rows]
    with pytest.raises(ValueError):
        codec.decode([np.array([32000], "<i4").tobytes()])


def test_a_difference_is_noticed():
    codec = Codec(RAW)
    codec.vocabulary.merge = lambda part: [5]
    with pytest.raises(ValueError):
        codec.encode(["some words"])


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(RAW)
    proto.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        Vocabulary(proto.SerializeToString())


def test_unused_pieces_and_unknown_runs():
    """A vocabulary of its own: an unused piece is taken apart, unknown symbols in a row are one."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(RAW)
    del proto.pieces[:]
    for piece, score, kind in [
        ("<unk>", 0, 2), ("a", -9, 1), ("b", -9, 1), ("c", -9, 1), ("▁", -9, 1), ("ab", -1, 5), ("abc", -2, 1), ("▁a", -3, 1),
    ]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    proto.trainer_spec.byte_fallback = False
    raw = proto.SerializeToString()
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=raw), Codec(raw)
    texts = ["abc", "ab", "abab c", "xyz a", "a??b", "cab", "aabb"]
    assert [ids_of(r) for r in codec.encode(texts, "none")] == [library.encode(t) for t in texts]


def test_round_trip_of_odd_rows(spark, odd):
    rows = round_trip(odd, model_path(), check="texts").collect()
    assert len(rows) == odd.count()
    want = sorted(str((r.doc_id, LIBRARY.encode(r.text or ""), r.text or "")) for r in odd.collect())
    assert sorted(str((r.doc_id, list(r.ids), r.decoded)) for r in rows) == want
    assert round_trip(odd.limit(0), model_path()).count() == 0
    broken = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert round_trip(broken, model_path()).first().decoded == "a\ufffdb"
