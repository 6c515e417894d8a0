import numpy as np
import pytest

from stakefold.llm import queries, vectors


def naive(rows, cosine=0.98):
    """(n_links, component) by row number, comparing all pairs."""
    n = len(rows)
    links, parent = np.zeros(n, int), list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def usable(x):
        return x is not None and len(x) and None not in x and np.isfinite(np.array(x, float)).all() and np.any(x)

    for i in range(n):
        for j in range(i):
            (_, x, lx), (_, y, ly) = rows[i], rows[j]
            if lx is None or lx != ly or not usable(x) or not usable(y) or len(x) != len(y):
                continue
            x, y = np.array(x, float), np.array(y, float)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                if rows[a][0] > rows[b][0]:
                    a, b = b, a
                parent[b] = a
    return {rows[i][0]: (links[i], rows[root(i)][0]) for i in range(n)}


def clustered(n, d=64, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, d))
    out = []
    for i in range(n):
        x = centres[i % 12] + rng.choice([0.02, 0.1, 0.15, 1.0]) * rng.standard_normal(d)
        out.append((i * 5, [float(v) for v in x.astype(np.float32)], i % 3))
    return out + [(9000 + i, out[i][1], out[i][2]) for i in range(30)]


SCHEMA = "vec_id long, embedding array<float>, label int, key string, bucket long, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("block", [2048, 16])
def test_all_links_by_brute_force(spark, block):
    rows = clustered(500)
    got = vectors.groups(frame(spark, rows), vectors.Settings(block=block)).collect()
    want = naive(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_query_by_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.op6_embeddings(spark, folder).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == naive(rows)


def test_decoding_finds_all_exceeding_directions():
    settings = vectors.Settings(codewords=128, filters=6.0)
    code = vectors.code(24, 0, settings)
    x = vectors.units(np.random.default_rng(5), 40, 24)
    left, right = code.halves(x)
    for row, own in enumerate(code.decode(x)):
        scores = (left[row][:, None] + right[row][None, :]).ravel()
        assert own.tolist() == np.flatnonzero(scores > code.threshold).tolist()


def test_recall_of_the_filters():
    rng, settings = np.random.default_rng(8), vectors.Settings()
    x = vectors.units(rng, 1000, 64)
    noise = rng.standard_normal((1000, 64))
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * noise
    shared = [len(np.intersect1d(a, b)) > 0 for a, b in zip(vectors.filters_of(x, settings), vectors.filters_of(y, settings), strict=True)]
    assert np.mean(shared) >= 0.995  # at the threshold itself; closer pairs share more


def test_messy_and_empty_tables(spark):
    x = [1.0] + [0.5] * 9
    rows = [(1, x, 0), (2, x, None), (3, None, 0), (4, [0.0] * 10, 0), (5, [float("nan")] * 10, 0), (6, [*x[:9], None], 0), (7, [], 0),
            (8, [v * 3 for v in x], 0), (9, x[:9], 0), (10, [float("inf")] * 10, 0), (None, x, 0), (11, x, 1), (12, [2.0, 1.0], 0), (13, [4.0, 2.0], 0),
            (14, x, 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.groups(frame(spark, rows)).collect()}
    want = naive([r for r in rows if r[0] is not None])
    assert {k: v[:2] for k, v in got.items() if k is not None} == want
    assert got[None] == (0, None, True) and got[8][1] == 1 and got[14][0] == 2
    assert vectors.groups(frame(spark, [])).collect() == []
