import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stakefold.llm import queries, sentencepieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepieces.encoder(MODEL)


def test_equals_the_library_on_documents(spark, folder, documents, model):
    got = {r["doc_id"]: r for r in queries.op8_sentencepiece(spark, folder).collect()}
    for doc, text, _ in documents:
        ids = [*model.library.encode(text or ""), model.end]
        assert got[doc]["n_tokens"] == len(ids)
        assert got[doc]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc]["decoded_sha256"] == hashlib.sha256(model.library.decode(ids).encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="  ▁abcdetheinrs\n\t.<>0xA①你ﬁ\x00", max_size=60))
def test_equals_the_library_on_any_text(text):
    model = sentencepieces.encoder(MODEL)
    assert model.encode(text) == model.library.encode(text)


@pytest.mark.parametrize("text", ["</s> <unk> <0x0A>", " " * 300, "a" * 20_000, "thethe" * 2000, "▁▁x ▁", "\n\n\r\n"])
def test_equals_the_library_on_odd_texts(model, text):
    assert model.encode(text) == model.library.encode(text)


def test_incompatible_pieces_are_taken_back(model):
    text = "▁unhelpfulness"
    greedy = []
    at = 0
    while at < len(text):
        size = max(n for n in range(1, len(text) - at + 1) if text[at:at + n] in model.id)
        greedy.append(model.id[text[at:at + size]])
        at += size
    words = [w for w in ["▁unhelpfulness", "▁thereinafterwards", "▁ontheothers"] if model.encode_word(w)]
    for word in words:
        assert [model.piece[i] for i in model.encode_word(word)] == model.merged(word)


def test_messy_and_empty_tables(messy, nothing, model):
    rows = sentencepieces.encode_documents(messy, MODEL).collect()
    assert len(rows) == messy.count()
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[2] == 1  # null: the end id alone
    assert sentencepieces.encode_documents(nothing, MODEL).collect() == []
