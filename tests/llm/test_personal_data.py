import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stakefold.llm import boosting, personal_data, queries
from stakefold.llm.personal_data import KINDS, Detector, base_spans, redacted, shown


def plain(text):
    """The patterns as they are stated, by the regular expression engine alone."""
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and personal_data.luhn(digits):
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab@@.. -+()01239%_é\n", max_size=70))
def test_base_spans_are_the_patterns(text):
    assert base_spans(text) == plain(text)


def test_parts_of_any_length():
    zeros = "0" * 5000
    assert base_spans(f"1.{zeros}.2.3") == [(0, 5006, "ip")]
    assert base_spans(f"1.{zeros}255.{zeros}.3 x") == [(0, 10008, "ip")]
    assert base_spans(f"1.{zeros}256.2.3") == [] and base_spans("9" * 6000 + ".1.2.3") == []


def test_base_spans_on_documents(spark):
    rows = queries.op7_personal_data(spark, "/root/testdata/sf0.01").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    import hashlib

    for r in rows:
        base = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[2] == k for s in base) for k in KINDS]
        assert set(shown(base).split(",")) <= set(r["spans"].split(",")) or not base


def test_luhn():
    assert personal_data.luhn("4111111111111111") and not personal_data.luhn("4111111111111112")


@pytest.fixture(scope="module")
def taught(spark):
    """Documents with strict spans and decoys to learn from."""
    rng = np.random.default_rng(5)
    words = "the order was sent with note and then again under that name for them".split()
    rows = []
    for i in range(600):
        own = [words[j] for j in rng.integers(0, len(words), 30)]
        kind = i % 4
        digits = "".join(map(str, rng.integers(0, 10, 16)))
        own[15] = (f"user{i}@mail{i % 7}.example.com" if kind == 0 else f"+1 ({digits[:3]}) 555-{digits[3:7]}" if kind == 1
                   else f"id {digits}" if kind == 2 else f"build {digits[:2]}.{digits[2:5]}.{digits[5:9]}.{digits[9:10]}")
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return personal_data.train(docs)


def test_disguised_spans_are_added_and_decoys_are_not(taught):
    assert taught.model is not None and "email" in taught.thresholds
    found = taught.spans("the note for user77 [at] mail3 [dot] example [dot] com was sent with that")[1]
    assert [s[2] for s in found] == ["email"]
    base, every = taught.spans("the order was under build 12.345.6789.1 and id 1234567812345678 then")
    assert base == [] and [s for s in every if s[2] in ("ip", "card")] == []
    base, every = taught.spans("a@b.co or +1 (234) 555-7890")
    assert set(base) <= set(every)


def test_a_rare_kind_is_learned(spark):
    """Addresses stand in one of 5,000 documents; one document is full of numbers."""
    from pyspark.sql import functions as F

    n = F.col("id").cast("string")
    address = F.concat(F.lit("please write to user"), n, F.lit("@mail.example.com when it came"))
    plain_text = F.concat(F.lit("build 12.345.6789."), n, F.lit(" was sent"))
    docs = spark.range(150_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5000 == 17, address).when(
        F.col("id") == 3, F.repeat(F.lit("serial 555 0001234 and 41.112.3.4567 "), 4000)).otherwise(plain_text).alias("text"))
    detector = personal_data.train(docs)
    assert "email" in detector.thresholds
    found = detector.spans("please write to user5 [at] mail [dot] example [dot] com when it came")[1]
    assert [s[2] for s in found] == ["email"]


def test_one_document_gives_a_bounded_number_of_rows():
    text = "call 555 000 1234 or a@b.co, " * 300
    kinds = [r[1] for r in personal_data.training_rows(1, text, 50)]
    assert kinds.count("phone") == 50 and 50 <= kinds.count("email") <= 200


def test_every_candidate_of_a_document_teaches():
    """Fifty of a kind in a document used to, the others were left out."""
    text = " ".join(f"call 555 000 {i}" for i in range(1000, 1300))
    assert sum(r[1] == "phone" for r in personal_data.training_rows(1, text)) == 300


def test_trees_on_a_table_are_those_on_rows_in_hand(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 3)), 1)
    y = (x[:, 0] + x[:, 1] > 0.3).astype(float)
    rows = spark.createDataFrame([(int(b), 1, a.tolist()) for a, b in zip(x, y)], "label int, n long, x array<double>").repartition(3)
    got, want = boosting.fit_on(rows, rounds=3), boosting.fit(x, y, rounds=3)
    assert got.start == want.start and np.allclose(got.probability(x), want.probability(x), atol=1e-6)


def test_redaction_merges_overlapping_spans():
    assert redacted("call +1 555 000 1111 now", [(5, 20, "phone"), (8, 20, "card")]) == "call [PHONE] now"
    assert redacted("no data", []) == "no data"


def test_messy_and_empty_tables(messy, nothing):
    detector = personal_data.train(messy)
    rows = personal_data.find(messy, detector).collect()
    assert len(rows) == messy.count() and all(r["spans"] == "" for r in rows if r["doc_id"] in (2, 3, 4))
    assert personal_data.find(nothing, personal_data.train(nothing)).collect() == []
    same = personal_data.redact(messy, detector)
    assert same.columns == messy.columns
    assert sorted(map(str, same.select("doc_id", "text").collect())) == sorted(map(str, messy.select("doc_id", "text").collect()))


def test_long_runs_of_digits_take_linear_time():
    assert base_spans("1" * 200_000 + " " + "1." * 50_000 + "@" * 5_000 + "+1" * 20_000) is not None


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = boosting.fit(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == (y[1500:] > 0.5)).mean() > 0.95


def test_a_detector_without_model_gives_base_spans():
    assert Detector().spans("a@b.co")[1] == [(0, 6, "email")]
