import zlib

import numpy as np

from stakefold.llm import languages, queries


def naive(rows, order, lang, text):
    """Interpolated Kneser-Ney by its recursive definition."""
    from collections import Counter

    grams = [{g: n for at, g, n in rows if at == lang}]
    for _ in range(order - 1):
        grams.insert(0, Counter(g[1:] for g in grams[0]))
    alphabet = len({g[-1] for _, g, _ in rows}) + 1

    def chance(context, char):
        table = grams[len(context)]
        of = Counter(table.values())
        d = of[1] / (of[1] + 2 * of[2]) if of[1] and of[2] else 0.75
        here = {g: n for g, n in table.items() if g[:-1] == context}
        lower = chance(context[1:], char) if context else 1 / alphabet
        if not here:
            return lower
        total = sum(here.values())
        return max(here.get(context + char, 0) - d, 0) / total + d * len(here) / total * lower

    out = 0.0
    for word in languages.WORD.findall(text.lower()):
        shown = languages.START * (order - 1) + word + languages.END
        for i in range(order - 1, len(shown)):
            out += np.log(chance(shown[i - order + 1:i], shown[i]))
    return out


def test_scores_are_the_definitions():
    from collections import Counter

    rows = []
    for lang, text in (("aa", "the then there other that"), ("bb", "der die das dieser oder")):
        counts = Counter()
        for word in text.split():
            shown = languages.START * 3 + word + languages.END
            counts.update(shown[i:i + 4] for i in range(len(word) + 1))
        rows += [(lang, g, n) for g, n in counts.items()]
    model = languages.fit(rows, 4)
    text = "The other der xyz"
    table = languages.WordTable(model)
    sums = table.sums([languages.WORD.findall(text.lower())])[0]
    for column, lang in enumerate(model.languages):
        assert np.isclose(sums[column], naive(rows, 4, lang, text))
    for keys in model.keys:
        assert (np.diff(keys.astype(object)) > 0).all()


def test_held_out_accuracy(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op4_language(spark, "/root/testdata/sf0.01").collect()}
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [d for d in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(rows[d]["held_out"] == (d in set(held)) for d in rows)
    assert sum(rows[d]["lang_pred"] == truth[d] for d in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_messy_and_empty_tables(spark, messy, nothing):
    model = languages.train(messy)
    rows = languages.predict(messy, model).collect()
    assert len(rows) == messy.count()
    assert {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 4)} == {1: "en", 2: "und", 3: "und", 4: "und"}
    assert languages.train(nothing) is None
    assert {r["lang_pred"] for r in languages.predict(messy, None).collect()} == {"und"}
    assert languages.predict(nothing, model).collect() == []
    digits = spark.createDataFrame([(1, "123 ² 456 ...")], "doc_id long, text string")
    assert languages.predict(digits, model).first()["lang_pred"] == "und"


def test_rejects_text_of_no_learned_language(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = languages.train(docs)
    strange = spark.createDataFrame([(1, "xqzw jkvvx qqpzt wkrrg " * 20), (2, docs.where("lang = 'de'").first()["text"])], "doc_id long, text string")
    rejected = {r["doc_id"]: r["rejected"] for r in languages.predict(strange, model).collect()}
    assert rejected == {1: True, 2: False}


def test_calibration_rows_are_judged_by_a_model_without_them():
    from collections import Counter

    texts = [("aa", "the then there other that"), ("bb", "der die das dieser oder"), ("aa", "this thing then"), ("bb", "dies das")]

    def grams(rows):
        counts = Counter()
        for lang, text in rows:
            counts.update({(lang, g): n for g, n in languages.grams_of(Counter(text.split()), 4).items()})
        return [(lang, g, n) for (lang, g), n in sorted(counts.items())]

    lang, gram, n = zip(*grams(texts), strict=True)
    own = np.array([["aa", "bb"].index(at) for at in lang])
    other = languages.without(texts[2:], ["aa", "bb"], own, languages.gram_codes(list(gram), 4), np.array(n))
    want = languages.fit(grams(texts[:2]), 4)
    for a, b in zip(other.logs + other.weights + other.keys, want.logs + want.weights + want.keys, strict=True):
        assert np.array_equal(a, b)
    assert languages.without(texts, ["aa", "bb"], own, languages.gram_codes(list(gram), 4), np.array(n)) is None
    model = languages.calibrated(languages.fit(grams(texts), 4), other, [("aa", texts[2][1] * 4), ("bb", texts[3][1] * 6)], languages.Settings())
    sums = languages.WordTable(other).sums([languages.WORD.findall(texts[2][1] * 4)])[0]
    assert np.isclose(model.bounds[0], -sums[0] / sums[-1]) and model.confident_chars in languages.Settings().confident_chars


def test_all_rows_held_out_set_the_bounds(spark):
    """More than 2,000 of them, of which the first by their hash used to do."""
    rng = np.random.default_rng(3)
    words = {"aa": "the then there other that this thing than those with".split(), "bb": "der die das dieser oder und nicht ein".split()}
    texts = [(i, lang, " ".join(rng.choice(words[lang], 12))) for i in range(26_000) for lang in [("aa", "bb")[i % 2]]]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(4)
    ids = {r["doc_id"] for r in docs.where("pmod(xxhash64(doc_id), 10) = 0").select("doc_id").collect()}
    assert len(ids) > 2_400
    own = [(lang, text) for i, lang, text in texts if i in ids]
    rest = spark.createDataFrame([r for r in texts if r[0] not in ids], docs.schema)
    counts = languages.ngram_counts(rest.selectExpr("lang", "text", "false as held"), languages.Settings()).collect()
    other = languages.fit([(r["lang"], r["gram"], r["n"]) for r in counts], 4)
    model = languages.train(docs)
    want = languages.calibrated(languages.train(docs), other, own, languages.Settings())
    assert np.all(np.abs(model.bounds - want.bounds) <= 1e-4) and model.confident_chars == want.confident_chars


def test_every_ngram_of_a_large_alphabet_counts(spark):
    from collections import Counter

    rng = np.random.default_rng(7)
    words = ["".join(map(chr, w)) for w in rng.integers(0x4E00, 0x9000, (140_000, 4))]
    words += words[:3000] + words[:500]
    texts = [("zh", " ".join(words[i:i + 500])) for i in range(0, len(words), 500)] + [("en", "the then there other that")] * 2
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(texts)], "doc_id long, lang string, text string")
    model = languages.train(docs)
    counts = Counter()
    for lang, text in texts:
        for word in text.split():
            shown = languages.START * 3 + word + languages.END
            counts.update((lang, shown[i:i + 4]) for i in range(len(word) + 1))
    assert len(counts) > 550_000  # beyond 500,000, where n-grams used to be dropped
    for order in range(1, 5):  # and the context of starts alone
        assert len(model.keys[order - 1]) == len({g[4 - order:] for _, g in counts} | ({"\x02" * order} if order < 4 else set()))
    table, rows = languages.WordTable(model), [(lang, gram, n) for (lang, gram), n in counts.items()]
    for text in (words[100], words[100_000][:2]):  # counted three times; a singleton's beginning
        sums = table.sums([[text]])[0]
        assert model.languages == ["en", "zh"]
        assert np.isclose(sums[1], naive(rows, 4, "zh", text))
