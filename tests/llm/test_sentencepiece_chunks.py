"""Chunks of a text that are encoded on their own, and what is remembered of them."""

import random

import public_tokenizers
import pytest
import sentencepiece

from claimledger.llm import sentencepiece_codec
from claimledger.llm.queries import PIECES
from claimledger.llm.sentencepiece_codec import SPACE, Codec, Vocabulary, marks

MODEL = public_tokenizers.path(PIECES)


@pytest.fixture
def codec():
    return Codec(Vocabulary.load(MODEL))


def test_a_word_is_one_chunk_whatever_follows_it(codec):
    walked = []
    real = codec._walk
    codec._walk = lambda text: walked.append(text) or real(text)
    codec.encode("zorvenquil zorvenquil. zorvenquil, (zorvenquil)\nzorvenquil")
    # with the space mark before it, and at the begin of a line or after a bracket without
    assert sorted(text for text in walked if "z" in text) == ["zorvenquil", f"{SPACE}zorvenquil"]


def test_marks_take_in_what_pieces_join_to_them():
    pieces = ["ab", "a", "''", ".”", "”«", "x_y", f"{SPACE}.", f"{SPACE}a"]
    found = marks(pieces)
    assert {"'", ".", "”", "«", "_", "x", "y", "\n"} <= found
    assert not found & {"a", "b"}


def test_chunks_encode_like_the_library(codec, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "REMEMBERED_CHUNKS", 20)  # both halves fill up and go
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice("ab thé. ,…”«²_\n\t\0▁  ’-()/9漢Ж😀") for _ in range(draw.randrange(16)))
        assert codec.encode(text) == library.encode(text), repr(text)
        assert len(codec._chunks) <= 10 and len(codec._older) <= 10
