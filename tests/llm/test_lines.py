import math
import random
import re
from collections import Counter, defaultdict

import pytest

from stakefold.llm import lines, queries


def naive(rows, percent=80):
    """Numbers of the lines an earlier line matches, comparing along prefixes of rare words."""
    found = []
    for doc, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for no, line in enumerate(text.split("\n")):
            words = frozenset(w for w in re.split("[ \t\x0b\f\r]+", line.lower()) if w)
            if words:
                found.append((doc, no, words))
    df = Counter(w for _, _, own in found for w in own)
    index, out = defaultdict(list), defaultdict(list)
    for at, (doc, no, own) in enumerate(found):
        order = sorted(own, key=lambda w: (df[w], w))
        prefix = order[:len(order) - math.ceil(percent * len(order) / 100) + 1]
        for other in {o for w in prefix for o in index[w]}:
            both = len(own & found[other][2])
            if 100 * both >= percent * (len(own) + len(found[other][2]) - both):
                out[doc].append(no)
                break
        for w in prefix:
            index[w].append(at)
    return out


def check(rows, texts):
    want = naive(texts)
    by_doc = dict(texts)
    for r in rows:
        own = want.get(r["doc_id"], [])
        assert r["removed"] == ",".join(map(str, own)), r["doc_id"]
        assert r["n_removed"] == len(own)
        assert r["n_lines"] == (0 if by_doc[r["doc_id"]] is None else by_doc[r["doc_id"]].count("\n") + 1)


def test_documents_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(lines.counted(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("words", [6, 60])
def test_lines_at_every_distance(spark, words):
    rng = random.Random(words)
    base = [[f"w{rng.randrange(40 * words)}" for _ in range(words)] for _ in range(12)]
    texts = []
    for doc in range(150):
        own = []
        for _ in range(4):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(0, max(2, words // 4))):
                line[rng.randrange(len(line))] = f"w{rng.randrange(40 * words)}"
            own.append(" ".join(line[rng.randrange(2):]))
        texts.append((doc, "\n".join(own)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check(lines.counted(docs).collect(), texts)


def test_query_against_duckdb(spark, folder):
    import duckdb

    duckdb.sql(f"create or replace view documents as select * from '{folder}/documents.parquet'")
    want = duckdb.sql(queries.ORACLES["op10_line_dedup"]).fetchall()
    got = queries.op10_line_dedup(spark, folder).select("doc_id", "n_lines", "n_removed", "removed").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_only_native_operators(spark, folder, capsys):
    lines.deduplicate(spark.read.parquet(f"{folder}/documents.parquet")).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_messy_and_empty_tables(messy, nothing):
    rows = lines.counted(messy).collect()
    got = {r["doc_id"]: r["removed"] for r in rows}
    assert len(rows) == messy.count()
    assert got[6] == "0,1" and got[1] == "" and got[2] == got[3] == got[4] == got[None] == got[7] == ""
    kept = lines.deduplicate(messy)
    assert kept.columns == messy.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in messy.collect() if r["doc_id"] != 6)
    assert lines.counted(nothing).collect() == [] and lines.deduplicate(nothing).collect() == []


def test_texts_lose_their_removed_lines(spark):
    docs = spark.createDataFrame([(2, "one two three four five\nown line\n\none two three four five", 50), (1, "One two three  four five\n", 1)],
                                 "doc_id long, text string, n_chars long")
    assert sorted(map(tuple, lines.deduplicate(docs).collect())) == [(1, "One two three  four five\n", 25), (2, "own line\n", 9)]


def test_candidate_ids_have_no_false_negatives(spark):
    ids = spark.createDataFrame([(i * 7919,) for i in range(300)], "doc_id long")
    every = spark.range(0, 300 * 7919, 13).withColumnRenamed("id", "doc_id").unionAll(ids)
    kept = every.where(lines.may_be_in(ids, ["doc_id"], 1 << 12))
    assert kept.join(ids, "doc_id", "left_semi").distinct().count() == 300
    assert kept.count() < 0.2 * every.count()


@pytest.mark.parametrize("crowd", [1, 3, 64])
def test_families_of_nearly_alike_lines_by_brute_force(spark, crowd):
    """Variants of a few lines, most of them just too far from each other; crowded pairs and others find the same."""
    rng = random.Random(8)
    base = [[f"w{rng.randrange(3000)}" for _ in range(20)] for _ in range(4)]
    texts = []
    for doc in range(120):
        own = []
        for _ in range(3):
            line = list(rng.choice(base))
            for at in rng.sample(range(20), rng.randrange(0, 6)):
                line[at] = f"v{rng.randrange(3000)}"
            own.append(" ".join(line))
        texts.append((doc, "\n".join(own)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check(lines.counted(docs, lines.Settings(crowd=crowd)).collect(), texts)


def test_marks_that_words_share_lose_no_match(spark):
    """With marks of two bits nearly all words of a line share theirs; the shortfall makes up for it."""
    texts = [(d, " ".join(f"w{(i * 7 + (d if i > 17 else 0)) % 900}" for i in range(20))) for d in range(12)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check(lines.counted(docs, lines.Settings(crowd=1, mark_bits=2)).collect(), texts)


@pytest.mark.parametrize("percent", [60, 70, 80, 90])
def test_matching_sets_share_a_gram_of_their_prefixes(percent):
    """Random sets of words numbered in the order of rarity, of all small sizes; the tiers say which grams the prefixes hold."""
    rng = random.Random(percent)
    tiers = lines.tiers(percent)

    def grams(words):
        n, found = len(words), set()
        for q, low, high in tiers:
            if n * 100 // percent >= low and (high is None or n <= high):
                found |= {(q, *words[i:i + q]) for i in range(min(n - q + 1, q * (100 - percent) * n // 100 + 1))}
        return found

    seen = 0
    for _ in range(60000):
        own = sorted(rng.sample(range(60), rng.randrange(1, 30)))
        lost = rng.sample(own, rng.randrange(0, len(own) // 3 + 1))
        other = sorted((set(own) - set(lost)) | set(rng.sample(range(60), rng.randrange(0, len(own) // 4 + 2))))
        both = len(set(own) & set(other))
        if own != other and 100 * both >= percent * (len(own) + len(other) - both):
            seen += 1
            assert grams(own) & grams(other), (own, other)
    assert seen > 500


def test_a_family_gives_no_more_rows_than_it_has(spark, capsys):
    """All variants match all others and share crowded grams: the join ends with the first match of each."""
    crowd = spark.createDataFrame([(g, d, 0, 10, -1, -1, False) for g in range(5) for d in range(40)],
                                  "gram long, d long, l int, n int, s0 long, s1 long, settled boolean")
    texts = spark.createDataFrame([(d, 0, [f"w{i}" for i in range(9)] + [f"v{d}"]) for d in range(40)], "d long, l int, words array<string>")
    found = lines.crowd_matches(crowd, texts, lines.Settings())
    assert sorted(map(tuple, found.collect())) == [(d, 0) for d in range(1, 40)]
    found.explain()
    assert "LeftSemi" in capsys.readouterr().out


def test_only_fitting_sizes_share_a_gram(spark):
    """The two long lines have three rare words in common with the short one, which fits none in size, and others with a third."""
    rare = [f"r{i}" for i in range(6)]
    texts = [(0, " ".join(rare))] + [(d, " ".join(rare + [f"c{i}" for i in range(30)] + [f"x{d}"])) for d in (1, 2)]
    texts += [(d, " ".join(f"c{i}" for i in range(30))) for d in range(3, 9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = lines.classes(lines.line_table(docs, lines.Settings())).cache()
    settings = lines.Settings(rounds=1)
    shared = lines.shared_grams(sets, settings).join(sets.select("h1", "d"), "h1")
    assert {r["d"] for r in shared.select("d").distinct().collect()} == {1, 2, 3}
