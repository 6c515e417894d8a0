import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stakefold.llm import common, lines, queries, toxicity
from test_minhash import naive_groups, naive_sets


def test_names_and_statements():
    names = list(queries.QUERIES)
    assert sorted(int(n.split("_")[0][2:]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash", "personal_data", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    folder = "/root/testdata/sf0.01"
    docs, out = common.documents(spark, folder), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs))
        docs = common.stored(stage(spark, docs, folder), f"test-{name}")
    return [*out, ("end", docs)]


def test_every_stage_on_its_own_input(stages, spark):
    frames = [df for _, df in stages]
    rows = [{r["doc_id"]: r for r in df.collect()} for df in frames[:-1]]
    for df in frames[:-1]:
        assert df.columns == frames[0].columns and dict(df.dtypes) == dict(frames[0].dtypes)
    machine = toxicity.train(frames[0], common.table(spark, "/root/testdata/sf0.01", "labels"))
    toxic = {d for d, s in zip(rows[0], machine.scores([r["text"] or "" for r in rows[0].values()]), strict=True) if s >= 0.5}
    assert toxic and set(rows[1]) == set(rows[0]) - toxic
    con = duckdb.connect()
    con.register("documents", frames[1].toPandas())
    gone = {d: (n, k, r) for d, n, k, r in con.sql(queries.ORACLES["op10_line_dedup"]).fetchall()}
    for d, r in rows[1].items():
        left = [x for i, x in enumerate(r["text"].split("\n")) if str(i) not in gone[d][2].split(",")]
        if d in rows[2]:
            assert rows[2][d]["text"] == "\n".join(left) and rows[2][d]["n_chars"] == len("\n".join(left))
        else:
            assert gone[d][1] and not "".join(left).strip()
    group = naive_groups(naive_sets([(d, r["text"]) for d, r in rows[2].items()], 5))
    assert set(rows[3]) == {d for d in group if group[d] == d}
    assert set(rows[4]) == set(rows[3])
    assert {r["doc_id"] for r in frames[5].collect()} == set(rows[4])
    from test_personal_data import plain

    assert sum(bool(plain(r["text"])) for r in rows[3].values()) > 10
    assert not any(plain(r["text"]) for r in rows[4].values())
    assert all(rows[4][d]["text"] == r["text"] for d, r in rows[3].items() if not any(c in r["text"] for c in "@0123456789"))


def test_messy_and_empty_documents_pass_all_stages(spark, messy, nothing, tmp_path):
    spark.createDataFrame([(1, 0, 1), (6, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (messy, nothing):
        docs = common.stored(docs, "test-messy")
        for name, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = common.stored(stage(spark, docs, str(tmp_path)), f"test-{name}")
            assert name == "packing" or docs.columns == before
        assert docs.count() >= 0


def test_lines_settings_are_the_contracts():
    assert lines.Settings().percent == 80
