"""Files of packed token ids: blocks, any range, ids of the library, order, damaged files."""

import random
import zlib

import numpy as np
import pytest

from stakefold.llm import common, queries, token_files

VOCABULARY = queries.tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def test_blocks_round_trip_and_outliers_are_listed():
    rng = np.random.default_rng(7)
    rows = [rng.integers(0, 1 << b, 128, dtype=np.uint64).astype(np.uint32) for b in (1, 3, 9, 16, 31, 32)]
    rows += [np.full(128, 77, np.uint32), np.zeros(128, np.uint32), np.arange(128, dtype=np.uint32) + 49_000]
    rare = rng.integers(100, 116, 128).astype(np.uint32)
    rare[[3, 90]] = (2**32 - 1, 5_000_000)
    ids = np.stack([*rows, rare])
    data, sizes = token_files.packed(ids)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    assert (token_files.unpacked(data, starts, 128) == ids).all()
    assert sizes[-1] == token_files.HEAD.itemsize + 128 * 4 // 8 + 2 * 6  # 4 bits an id, two exceptions
    assert sizes[6] == token_files.HEAD.itemsize  # one value: no bits at all


def test_any_range_is_read_from_its_blocks(tmp_path):
    rng = np.random.default_rng(3)
    writer = token_files.Writer(f"file://{tmp_path}/a.ids", block=64)
    texts = [rng.integers(0, 50_000, n).astype("<u4") for n in (1, 63, 64, 65, 40_000, 1, 7)]
    for key, ids in zip((None, 1, 2, 2, 3, 4, 5), texts, strict=True):
        writer.add(key, ids)
    uri, ids, documents, size = writer.close()
    whole = np.concatenate(texts)
    assert (ids, documents, size) == (len(whole), 7, (tmp_path / "a.ids").stat().st_size)
    with token_files.Reader(uri) as file:
        assert [k for k, _, _ in file.documents()] == [None, 1, 2, 2, 3, 4, 5]
        assert all((a == b).all() and len(a) == len(b) for (_, _, a), b in zip(file.documents(), texts, strict=True))
        for start, stop in [(0, 1), (63, 65), (500, 500), (12_345, 23_456), (0, ids), (ids - 1, ids)]:
            assert (file.range(start, stop) == whole[start:stop]).all()
    (tmp_path / "b.ids").write_bytes((tmp_path / "a.ids").read_bytes()[:-9])
    with pytest.raises(ValueError, match="not a whole file"):
        token_files.Reader(f"file://{tmp_path}/b.ids")


def test_encoder_gives_the_ids_of_the_library(library):
    letters = list("abcXYZÉé ÅİΣσς'-_.,!?0123456789\t\n\r\x1c\x85  　́̈한글漢字") + [
        "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "don't ", "  ", "\n\n", "Å", "ﬁ", "👍🏽", "\x00"]
    chance = random.Random(11)
    texts = ["".join(chance.choices(letters, k=chance.randrange(60))) for _ in range(3_000)]
    encoder = token_files.Encoder(VOCABULARY)
    for text in [*texts, "", " ", "x" * 5_000]:
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    plain = [chr(c) for c in range(33, 256)] + ["'ll", "<|", "|>", " "]
    for text in ("".join(chance.choices(plain, k=12)) for _ in range(5_000)):
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_character_and_other_vocabularies(library):
    from tokenizers import Tokenizer

    encoder = token_files.Encoder(VOCABULARY)
    assert encoder.known
    for code in range(0x3000):
        text = f"aB{chr(code)}Cd {chr(code)} '{chr(code)}s"
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(code)
    other = queries.tokenizer_path("byte_bpe_50k.json")
    encoder, whole = token_files.Encoder(other), Tokenizer.from_file(other)
    assert not encoder.known
    assert encoder.encode("Two  words\n<|endoftext|> é").tolist() == whole.encode("Two  words\n<|endoftext|> é").ids


def expected(library, rows):
    start = 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        yield key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_query_is_the_library_in_order(spark, folder, documents, library):
    found = queries.op13_token_files(spark, folder)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected(library, [d[:2] for d in documents]))


def test_small_files_keep_the_order(spark, folder, documents, library):
    docs = common.documents(spark, folder)
    manifest = token_files.write_files(docs, VOCABULARY, common.new_folder(spark, "ids"), block=32, file_ids=2_000)
    assert manifest.count() > 20
    found = token_files.read_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected(library, [d[:2] for d in documents]))


def test_messy_and_empty_tables(spark, messy, nothing, library):
    manifest = token_files.write_files(messy, VOCABULARY, common.new_folder(spark, "ids"))
    found = [tuple(r) for r in token_files.read_files(manifest).collect()]
    assert sorted(found, key=lambda r: r[1]) == list(expected(library, [(r.doc_id, r.text) for r in messy.collect()]))
    manifest = token_files.write_files(nothing, VOCABULARY, common.new_folder(spark, "ids"))
    assert token_files.read_files(manifest).collect() == []
