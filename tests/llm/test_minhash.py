import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from stakefold.llm import common, minhash, queries


def naive_sets(rows, k):
    out = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        out[doc] = frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])
    return out


def naive_groups(sets, percent=80):
    """Exact join by prefixes of rare shingles, and components."""
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    df = Counter(s for own in sets.values() for s in own)
    index = defaultdict(list)
    for doc in sorted(sets):
        order = sorted(sets[doc], key=lambda s: (df[s], s))
        prefix = order[:len(order) - math.ceil(percent * len(order) / 100) + 1] if order else []
        for other in {o for s in prefix for o in index[s]}:
            both = len(sets[doc] & sets[other])
            if 100 * both >= percent * (len(sets[doc]) + len(sets[other]) - both):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
        for s in prefix:
            index[s].append(doc)
    return {d: root(d) for d in sets}


def check(rows, texts, k):
    sets = naive_sets(texts, k)
    want = naive_groups(sets)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {
        d: (len(sets[d]), want[d], want[d] == d) for d in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_documents_by_brute_force(spark, k):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = minhash.groups(docs, minhash.Settings(words=k)).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], k)


def test_a_family_over_several_blocks(spark):
    """Near copies of one text at every distance, in blocks far smaller than the family."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    texts = []
    for i in range(260):
        own = list(base)
        for _ in range(rng.randrange(0, 14)):
            own[rng.randrange(120)] = f"x{rng.randrange(10_000)}"
        texts.append((i * 3, " ".join(own)))
    texts += [(1000 + i, texts[i % 7][1].upper()) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check(minhash.groups(docs, minhash.Settings(words=2, block=64)).collect(), texts, 2)


def test_query_uses_two_words(spark, folder, documents):
    check(queries.op2_minhash(spark, folder).collect(), [(d, t) for d, t, _ in documents], 2)


def test_estimates_are_near_the_similarity():
    rng = np.random.default_rng(1)
    factors, n = minhash.multipliers(1024), 1000
    for share in (0.2, 0.5, 0.8, 0.95, 1.0):
        both = int(2 * n * share / (1 + share))
        common_ = rng.integers(0, 1 << 63, both, dtype=np.uint64)
        a, b = (np.r_[common_, rng.integers(0, 1 << 63, n - both, dtype=np.uint64)] for _ in range(2))
        one, other = (minhash.packed(minhash.minima(x, factors)) for x in (a, b))
        assert abs(minhash.estimates(one, other[None], 1024)[0] - share) < 0.06


def test_exact_groups_connects_only_by_links():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a[:90], a[10:], np.arange(500, 600, dtype=np.uint64), a[:70]]
    groups = minhash.exact_groups(sets, 80)
    assert groups[0] == groups[1] == groups[2]
    assert groups[4] not in (groups[3],) and len({groups[0], groups[3], groups[4]}) == (3 if 70 / 90 < 0.8 else 2)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 400)] + [(7, 1000 + i) for i in range(200)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 401)) and all(got[1000 + i] == 7 for i in range(200)) and 5 not in got
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_messy_and_empty_tables(messy, nothing):
    rows = minhash.groups(messy).collect()
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(rows) == messy.count()
    assert got[6]["component_id"] == 1 and not got[6]["kept"] and got[1]["kept"]
    assert all(got[i]["kept"] and got[i]["n_shingles"] == 0 for i in (2, 3, 4))
    assert [r["kept"] for r in rows if r["doc_id"] is None] == [True]
    assert [r["kept"] for r in rows if r["doc_id"] == 7] == [True, True]
    assert minhash.groups(nothing).collect() == []


def test_the_estimate_loses_no_more_pairs_than_the_bands():
    settings = minhash.Settings()
    similarity, n = settings.percent / 100, settings.hashes

    def passes(equal):
        signature = np.zeros((2, -(-n // minhash.LANES)), np.uint64)
        for lane in range(n - equal):
            signature[1, lane // minhash.LANES] |= np.uint64(1 << lane % minhash.LANES * minhash.LANE_BITS)
        groups = minhash.estimated_groups(signature, np.array([100, 100]), settings)
        return groups[0] == groups[1]

    agree = similarity + (1 - similarity) * 2.0 ** -minhash.LANE_BITS
    lost = sum(math.comb(n, k) * agree ** k * (1 - agree) ** (n - k) for k in range(n + 1) if not passes(k))
    assert lost <= (1 - similarity ** settings.rows) ** settings.bands
