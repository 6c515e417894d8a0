import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stakefold.llm import packing, queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_librarys(library, documents):
    encode = packing.encoder(RANKS)
    odd = ["<|endoftext|> a", "  x\n\n\ty ", "naïve ①你好\x00", "a" * 3000, "don't 'll 1234567 $$$", "　 \xa0x"]
    for text in [t for _, t, _ in documents] + odd:
        assert encode(text) == library(text)


def check(rows, texts, library):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, pieces in by_doc.items():
        ids = np.array([*library(texts[doc] or ""), packing.END_ID], "<u4")
        copies = sum(r["start"] == 0 for r in pieces)
        assert sum(r["length"] for r in pieces) == copies * len(ids)
        for r in pieces:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.r_[0, np.cumsum([r["length"] for r in pieces])[:-1]].tolist()
        total = sum(r["length"] for r in pieces)
        assert total <= 1024
        padding += 0 if total & (total - 1) == 0 else 1024 - total
    return padding


def test_every_id_lies_in_one_piece(spark, folder, documents, library):
    rows = queries.op1_packing(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == {d for d, _, _ in documents}
    assert check(rows, {d: t for d, t, _ in documents}, library) == 0


def test_messy_and_empty_tables(messy, nothing, library):
    rows = packing.pack_documents(messy, RANKS).collect()
    assert check(rows, {r["doc_id"]: r["text"] for r in messy.collect()}, library) == 0
    assert sum(r["start"] == 0 for r in rows) == messy.count()
    assert packing.pack_documents(nothing, RANKS).collect() == []


def test_whole_examples_respect_all_three_limits():
    rng = np.random.default_rng(3)
    limits = packing.Limits(tokens=100, segments=4, loss=40, pool=32)
    examples = [(i, np.arange(n), rng.random(n) < 0.35) for i, n in enumerate(rng.integers(1, 90, 300)) ]
    examples = [(i, ids, mask & (np.cumsum(mask) <= 40)) for i, ids, mask in examples]
    rows = packing.pack_examples(examples, limits)
    assert sorted(r[0] for r in rows) == list(range(300))
    sequences = defaultdict(list)
    for doc, start, length, _, total, sequence, _, loss in rows:
        assert start == 0 and length == total
        sequences[sequence].append((length, loss))
    for items in sequences.values():
        assert len(items) <= 4 and sum(n for n, _ in items) <= 100 and sum(k for _, k in items) <= 40
    tokens = sum(len(ids) for _, ids, _ in examples)
    loss = sum(int(m.sum()) for _, _, m in examples)
    least = max(-(-tokens // 100), -(-loss // 40), 75)
    assert len(sequences) <= 1.25 * least + 2


def test_dot_product_choice():
    caps = np.array([100.0, 4, 100])
    demand = np.array([[60.0, 1, 10], [50, 1, 50], [90, 1, 0]])
    assert packing.choose(demand, np.array([80.0, 2, 60]), caps) == 1  # the third does not fit, the second uses more of what is left
    assert packing.choose(demand, np.array([10.0, 2, 60]), caps) == -1


def test_a_loss_limit_below_the_tokens_still_cuts_documents():
    limits = packing.Limits(tokens=64, segments=8, loss=20, pool=4)
    packer = packing.Packer(limits, 0)
    rows = []
    for doc in range(9):
        rows += packer.add(doc, np.arange(70, dtype="<u4"), np.ones(70, np.int64))
    rows += packer.finish()
    assert sum(r[2] for r in rows) == 9 * 70
    loss = defaultdict(int)
    for r in rows:
        loss[r[5]] += r[7]
    assert max(loss.values()) <= 20


def test_an_example_beyond_a_limit_is_refused():
    with pytest.raises(ValueError, match="exceeds"):
        packing.pack_examples([(1, np.arange(200), np.ones(200))], packing.Limits(tokens=100))


def test_added_tokens_in_the_text_have_the_ids_of_the_plain_library_call(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"  x \n{end}\n\ny  {end}", f"don't{end}'ll", "<|endoftext", f"<|{end}|>",
             f"naïve {end}①", documents[0][1] + end + documents[1][1], "", "plain text"]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    encode = packing.document_encoder(RANKS)
    assert [encode(t) for t in texts] == expected
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack_documents(docs, RANKS).collect()
    by_doc = dict(enumerate(expected))
    assert check(rows, by_doc, lambda ids: ids) == 0
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == {d: len(ids) + 1 for d, ids in by_doc.items()}


def test_instructions_are_packed_whole_under_limits_that_bind(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        n = int(rng.integers(1, 120))
        answer = int(rng.integers(0, n + 1))
        rows.append((i, [int(x) for x in rng.integers(1, 50_000, n)], [0] * (n - answer) + [1] * answer, "extra"))
    rows += [(900, [7] * 1300, None, "too long"), (901, None, None, None), (902, [], [1], ""), (903, [5, 6, 7], [1, None], "")]
    examples = spark.createDataFrame(rows, "doc_id long, ids array<int>, loss_mask array<int>, length string").repartition(3)
    limits = packing.Limits(tokens=512, segments=6, loss=200, pool=128)
    pieces = packing.pack_instructions(examples, limits).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert sorted(by_doc) == list(range(904))
    for doc, ids, mask, _ in rows:
        own, ids = sorted(by_doc[doc], key=lambda p: p["start"]), ids or []
        assert len(own) == 1 or doc == 900
        at = 0
        for p in own:
            part = np.array(ids[at:at + p["length"]], "<u4")
            bears = np.ones(len(ids)) if mask is None else np.array([*(m or 0 for m in mask), *[0] * len(ids)])
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(part.tobytes()) and p["doc_tokens"] == len(ids)
            assert p["loss_tokens"] == bears[at:at + p["length"]].sum()
            at += p["length"]
        assert at == len(ids)
    full = {"tokens": 0, "segments": 0, "loss": 0}
    for own in by_sequence.values():
        sums = {"tokens": sum(p["length"] for p in own), "segments": len(own), "loss": sum(p["loss_tokens"] for p in own)}
        assert all(sums[k] <= getattr(limits, k) for k in sums)
        offsets = sorted((p["offset"], p["length"]) for p in own)
        assert all(a + n == b for (a, n), (b, _) in zip(offsets, offsets[1:], strict=False))
        for k in sums:
            full[k] += sums[k] >= 0.97 * getattr(limits, k)
    assert full["segments"] > 0 and full["loss"] > 0
    assert packing.pack_instructions(examples.where("false"), limits).collect() == []
