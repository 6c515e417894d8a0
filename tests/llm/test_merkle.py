"""Merkle manifest: logs, positions, proofs of every leaf, tampered rows, and the query by brute force."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stakefold.llm import merkle, queries


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def proof_of(levels, i):
    found = []
    for level in levels[:-1]:
        found += [(i ^ 1 < i, level[i ^ 1])] if i ^ 1 < len(level) else [None]
        i //= 2
    return found


def naive(rows):
    """Rows of (doc_id, lang, leaf, shown) in hex to the query's rows."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    for lang in by:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3] or ""))
    order = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: levels_of([r[2] for r in by[lang]]) for lang in by}
    top = levels_of([trees[lang][-1][0] for lang in order]) if by else []
    for lang in by:
        above = proof_of(top, order.index(lang))
        for i, (doc, _, leaf, shown) in enumerate(by[lang]):
            proof, node = proof_of(trees[lang], i) + above, shown or leaf
            for step in proof:
                node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
            root = top[-1][0]
            yield doc, leaf, trees[lang][-1][0], root, h(*(s[1] for s in proof if s)), node, node == root


def fields(row, more=0):
    doc, source, lang, n_chars, text = row
    values = (doc, source, lang, None if n_chars is None else n_chars + more, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def of_documents(rows):
    for row in rows:
        tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
        yield row[0], row[2], fields(row), fields(row, 1) if tampered else None


def shape(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("leaves", [1, 2, 3, 4, 5, 7, 8, 9, 31, 32, 33])
def test_logs_are_postorder_and_positions_are_closed(leaves):
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(leaves)]
    levels = levels_of([d.hex() for d in digests])
    log = merkle.append_log(digests, merkle.height_of(leaves))
    assert len(log) == sum(map(len, levels)) and len(levels) == merkle.height_of(leaves) + 1
    for level, nodes in enumerate(levels):
        for index, node in enumerate(nodes):
            assert log[merkle.position(level, index, leaves)].hex() == node
    for i, leaf in enumerate(digests):
        path = merkle.siblings(b"".join(log), leaves, merkle.height_of(leaves), i)
        assert merkle.folded(leaf, path).hex() == levels[-1][0]
        assert [s and s.hex() for _, s in merkle.steps(path)] == [s and s[1] for s in proof_of(levels, i)]


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_tiers_of_small_blocks_by_brute_force(spark, bits):
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "ä": 5, "zz": 130, "Z": 64, "y": 65}
    rows = [(i * 7 % 1000, lang, h(f"{lang}{i}"), h(f"?{lang}{i}") if i % 5 == 0 else None) for lang, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "key long, grp string, leaf string, shown string")
    frame = frame.withColumns({c: F.unhex(c) for c in ("leaf", "shown")})
    found = merkle.checked(merkle.manifest(frame, bits))
    assert shape(found.collect()) == shape(naive(rows))


def test_query_by_brute_force(spark, folder):
    import duckdb

    rows = duckdb.sql(f"select doc_id, source, lang, n_chars, text from '{folder}/documents.parquet'").fetchall()
    found = queries.op12_merkle(spark, folder)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = found.collect()
    assert shape(found) == shape(naive(list(of_documents(rows))))
    assert {r.verified for r in found} == {True, False}


def test_messy_and_empty_tables(spark, messy, nothing):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in messy.collect()]
    for bits in (1, 8):
        found = merkle.checked(merkle.documents_manifest(messy, tampered, bits)).collect()
        assert shape(found) == shape(naive(list(of_documents(rows))))
    assert merkle.checked(merkle.documents_manifest(nothing, tampered)).collect() == []
