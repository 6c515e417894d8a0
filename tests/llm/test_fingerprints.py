import hashlib
import math
from collections import Counter

import numpy as np
import xxhash

from stakefold.llm import fingerprints, queries


def test_edits_and_fingerprints_by_brute_force(spark, folder, documents):
    band = fingerprints.Band()
    texts = {text for _, text, _ in documents}
    df = Counter(t for text in texts for t in fingerprints.terms(text))
    least, most = max(2, math.ceil(len(texts) / math.exp(band.upper))), math.floor(len(texts) / math.exp(band.lower))
    kept = [t for t, n in df.items() if least <= n <= most]
    lexicon = fingerprints.Lexicon.of(np.array([xxhash.xxh64_intdigest(t) for t in kept], np.uint64).view(np.int64), band)
    rates = [r for r in band.rates for _ in range(band.subsets_per_rate)]
    number = {int(k): i for i, k in enumerate(lexicon.keys)}

    def naive(text):
        own = sorted(h for t in fingerprints.terms(text) if (h := xxhash.xxh64_intdigest(t)) in number)
        out = []
        for k in range(len(rates)):
            chosen = [h for h in own if int(lexicon.members[number[h]]) >> k & 1]
            out.append(hashlib.blake2b(np.array(chosen, np.uint64).tobytes(), digest_size=4).hexdigest() if chosen else "-")
        return " ".join(out)

    got = {r["doc_id"]: r for r in queries.op9_fingerprints(spark, folder).collect()}
    assert len(got) == len(documents)
    for i, (doc, text, _) in enumerate(documents):
        following = documents[(i + 1) % len(documents)][1]
        size = len(text) // 4
        edited = text[:len(text) - size] + following[:size]
        r = got[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for value, of in ((r["fingerprint"], text), (r["edited_fingerprint"], edited)):
            if not value.startswith("="):
                assert value == naive(of)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by_text = {}
    for doc, text, _ in documents:
        assert by_text.setdefault(text, got[doc]["fingerprint"]) == got[doc]["fingerprint"]


def test_edited_texts_are_nearer_than_the_next_document(spark):
    rows = queries.op9_fingerprints(spark, "/root/testdata/sf0.01").collect()
    assert np.mean([r["near_edited"] for r in rows]) > 0.4
    assert np.mean([r["near_next"] for r in rows]) < 0.05
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.95


def test_subsets_take_their_share():
    band = fingerprints.Band()
    lexicon = fingerprints.Lexicon.of(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 40_000), band)
    shares = [float((lexicon.members >> np.uint64(k) & np.uint64(1)).mean()) for k in range(64)]
    for k, rate in enumerate(r for r in band.rates for _ in range(16)):
        assert abs(shares[k] - rate) < 0.15 * rate + 0.001


def test_successors_over_many_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ids = [5, 900_000, 17, 18, 19, 3_000_000, 20, 21, 22] + list(range(100, 160))
        docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
        rows = fingerprints.with_successors(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    order, place = sorted(ids), {r["doc_id"]: r["place"] for r in rows if not r["tail"]}
    assert len(place) == len(ids)
    tails = {r["place"]: r["doc_id"] for r in rows if r["tail"]}
    for one, following in zip(order, order[1:] + order[:1], strict=True):
        assert place[one] == place[following] or tails[place[one]] == following


def test_messy_and_empty_tables(messy, nothing, spark):
    rows = fingerprints.fingerprint_documents(messy).collect()
    assert len(rows) == messy.count()
    assert sum(r["doc_id"] is None for r in rows) == 1
    assert fingerprints.fingerprint_documents(nothing).collect() == []
    one = spark.createDataFrame([(7, "only document here")], "doc_id long, text string")
    r = fingerprints.fingerprint_documents(one).first()
    assert r["edited_sha256"] == hashlib.sha256(b"only document only").hexdigest()
    assert r["near_next"] == 1.0


def crowded_rows():
    """900 texts of common words, a third of them copies of one text, under ids of their own."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{w}" for w in rng.integers(0, 400, 60))) for i in range(600)]
    return rows + [(1000 + i, rows[0][1]) for i in range(299)]


def test_document_frequencies_count_distinct_texts(spark):
    rows = crowded_rows()
    docs = spark.createDataFrame(rows + [(5000, None), (5001, "")], "doc_id long, text string")
    texts = docs.selectExpr("coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as digest").repartition(5)
    copies = fingerprints.find_copies(texts)
    assert copies.texts == len({t for _, t in rows}) + 1
    got = {r["term"]: r["df"] for r in fingerprints.document_frequencies(texts, copies).collect()}
    df = Counter(t for text in {t for _, t in rows} for t in fingerprints.terms(text))
    assert got == {int(np.uint64(xxhash.xxh64_intdigest(t)).view(np.int64)): n for t, n in df.items()}


def test_a_text_that_fills_a_third_of_the_rows_has_its_subsets(spark):
    rows = crowded_rows()
    crowd = rows[0][1]
    docs = spark.createDataFrame([*rows, (2000, crowd + " rareword")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs).collect()}
    assert len(got) == len(rows) + 1
    members = [got[i] for i in range(1000, 1299)]
    assert not any(r["fingerprint"].startswith("=") for r in members)
    assert all(0.4 < r["near_edited"] < 1 for r in members)
    assert all(r["near_next"] == 1.0 for r in members[:-1])
    assert members[-1]["near_next"] > 0.8  # the next one has a rare word more
