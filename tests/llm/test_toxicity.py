import zlib

import numpy as np
import pytest

from stakefold.llm import queries, toxicity
from stakefold.llm.toxicity import Settings


def naive_kernel(one, other, settings):
    """Shared gapped subsequences of three characters, divided by the norms of the lengths."""
    def counted(word):
        word = f"\x01{word}\x01"
        out, norm = {}, 0.0
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + settings.stretch + 1)):
                    weight = settings.decay ** (k - i + 1)
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0.0) + weight
                    norm += weight ** 2
        return out, norm ** 0.5

    (a, na), (b, nb) = counted(one), counted(other)
    return sum(v * b.get(k, 0.0) for k, v in a.items()) / na / nb


def test_kernel_is_the_definition():
    settings, words = Settings(), ["idiot", "idxiot", "table", "ab", "worthless", "i", "anna"]
    alphabet = toxicity.Alphabet.of(words)
    got = toxicity.features(alphabet, words, words, settings)
    want = [[naive_kernel(a, b, settings) for b in words] for a in words]
    assert np.allclose(got, want, atol=1e-5)


def test_table_is_the_machine():
    settings = Settings(landmarks=8)
    positive, negative = ["idiot", "moron", "idiott"], ["table", "chair", "window", "motion", "idea", "more"]
    alphabet = toxicity.Alphabet.of(positive + negative)
    machine = toxicity.fit_machine(positive, negative, alphabet, settings)
    assert (machine.words(positive) > 0).all() and (machine.words(negative) < 0).all()
    words = ["idixot", "lamp", "i", "moronic"]
    for word, value in zip(words, machine.words(words), strict=True):
        triples, weight = alphabet.triples([word], settings)
        assert np.isclose(value, (machine.table[triples[0]] * weight).sum() + machine.bias)


def test_an_alphabet_of_any_size():
    settings = Settings(landmarks=8)
    scripts = ["grumbolt", "жабандур", "κρανιδωσ", "հաբեթուկ"]
    many = ["".join(chr(0x4E00 + 7 * i + j) for j in range(4)) for i in range(900)]
    words = [*scripts, "window", "дорогами", "λογισμοσ", "պատուհան", *many]
    alphabet = toxicity.Alphabet.of(words)
    assert len(alphabet.codes) == len(set("".join(words))) > 3000
    got = toxicity.features(alphabet, words[:12], words[:12], settings)
    assert np.allclose(got, [[naive_kernel(a, b, settings) for b in words[:12]] for a in words[:12]], atol=1e-5)
    machine = toxicity.fit_machine(scripts, words[4:], alphabet, settings)
    for insult, word in zip(scripts, words[4:8], strict=True):
        values = machine.words([insult[:3] + insult[2:], word])
        assert values[0] > values[1] and values[0] != values[1]


@pytest.fixture(scope="module")
def machine():
    rng = np.random.default_rng(2)
    syllables = "an er on ti le ra mo su ke ni po da".split()
    words = ["".join(rng.choice(syllables, 3)) for _ in range(900)]
    insults = ["grumbolt", "vexnarsk", "plodwick"]
    rows = []
    for i in range(900):
        own = list(rng.choice(words, 40))
        if i % 6 == 0:
            own[int(rng.integers(40))] = insults[i // 6 % 3]
            own[20] = insults[(i // 6 + 1) % 3]
        rows.append((" ".join(own[:20]) + ". " + " ".join(own[20:]), int(i % 6 == 0)))
    return toxicity.fit(rows)


@pytest.mark.parametrize("text", ["well vexnarsk you", "gruumbolt moti", "g.r.u.m.b.o.l.t", "so p l o d w i c k er", "vexxnarsk!!", "PLODWICK"])
def test_finds_gapped_and_inserted_forms(machine, text):
    assert machine.scores([text])[0] > 0.5


def test_leaves_clean_texts(machine):
    scores = machine.scores(["anerti lerako sukeni", "", "   ", "123 ... $$$", "popoda " * 4000, "a b"])
    assert (scores < 0.5).all() and (scores >= 0).all()


def test_a_very_long_token_is_read_whole(machine):
    assert machine.scores(["anerti" * 50 + "vexnarsk" + "lerako" * 50])[0] > machine.scores(["anerti" * 50 + "lerako" * 50])[0]


def test_copies_do_not_make_an_insult():
    rows = [("an rare otherword here", 1)] * 50 + [(f"clean text number {'abcdefghij'[i % 10]}", 0) for i in range(50)]
    assert toxicity.fit(rows) is None
    assert toxicity.fit([]) is None


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = {r["doc_id"]: r for r in queries.op3_toxicity(spark, folder).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for d, r in rows.items())
    held = [(rows[r["doc_id"]]["score"], r["toxic"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    scores, truth = np.array([s for s, _ in held]), np.array([t for _, t in held])
    order = scores.argsort().argsort()
    ties = np.array([order[scores == s].mean() for s in scores])
    auc = (ties[truth == 1].mean() - (truth.sum() - 1) / 2) / (len(truth) - truth.sum())
    assert auc > 0.9
    assert (scores[truth == 0] >= 0.5).mean() < 0.01


def test_messy_and_empty_tables(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    machine = toxicity.train(messy, labels)
    rows = toxicity.score_documents(messy, machine).collect()
    assert len(rows) == messy.count()
    kept = toxicity.scored(messy, machine, "new")
    assert kept.columns == [*messy.columns, "new"] and kept.count() == messy.count()
    assert toxicity.score_documents(nothing, toxicity.train(nothing, labels.where("false"))).collect() == []
