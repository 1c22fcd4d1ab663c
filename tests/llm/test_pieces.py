"""Viterbi against the library's unigram search on the same pieces and scores, and exact round trips."""

import random
import tracemalloc

import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb2

from cytoloom.llm import pieces
from tests.llm.cases import ODD_TEXTS, empty_docs, odd_docs


def test_same_score_as_the_library(spark):
    model = pieces.read_model()
    own = pieces.Pieces(model)
    proto = pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = pb2.TrainerSpec.UNIGRAM
    for p in proto.pieces:
        p.score = own.score.get(p.piece, p.score)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    lines = sorted({line for r in rows for line in r.text.split("\n") if line})
    known = own.ids
    lines = [x for x in lines if all(c in known or c == " " for c in x)]
    assert len(lines) > 300
    score = lambda ids: sum(own.score[own.text[i]] for i in ids)
    equal = 0
    for line, ids in zip(lines, pieces.Encoder(own).encode(lines)):
        want = library.encode(line)
        equal += ids == want
        assert abs(score(ids) - score(want)) < 1e-2 * len(want) ** 0.5  # the library adds in single precision
    assert equal > 0.95 * len(lines)


def test_best_of_all_segmentations():
    own = pieces.Pieces(pieces.read_model())
    rng = random.Random(1)

    def best(word):
        if not word:
            return 0.0
        return max(own.score[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in own.ids)

    words = ["▁" + "".join(rng.choice("theandor") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    for word, ids in own.segment(words).items():
        assert "".join(own.text[i] for i in ids) == word
        assert abs(sum(own.score[own.text[i]] for i in ids) - best(word)) < 1e-9


def test_round_trip(spark):
    model = pieces.read_model()
    docs = odd_docs(spark)
    out = pieces.encode(docs, model)
    rows = out.collect()
    assert len(rows) == docs.count() and all(r.text_sha256 == r.decoded_sha256 and r.n_tokens == len(r.token_ids) for r in rows)
    texts = {r.doc_id: r.text for r in pieces.decode(out, model).collect()}
    assert all(texts[i * 10] == (t or "") for i, t in enumerate(ODD_TEXTS) if i != 12)
    assert pieces.encode(empty_docs(spark), model).count() == 0


def test_memory_of_a_long_word():
    own = pieces.Pieces(pieces.read_model())
    rng = random.Random(8)
    own.segment(["".join(rng.choice("acgt") for _ in range(200))])
    peak = []
    for size in (10_000, 40_000):
        word = "".join(rng.choice("acgt") for _ in range(size))
        tracemalloc.start()
        ids = own.segment([word, word[: size // 2]])[word]
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert "".join(own.text[i] for i in ids) == word
    # four times the letters: in proportion, not by the square
    assert peak[1] < 6 * peak[0] and peak[1] < 50e6
