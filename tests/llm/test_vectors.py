import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from sievekit.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    ok = {}
    for i, (vid, e, label) in enumerate(rows):
        if vid is None or e is None or label is None or not e or any(x is None or not np.isfinite(x) for x in e) or not any(e):
            continue
        x = np.asarray(e, np.float32).astype(float)
        ok[i] = x / np.linalg.norm(x)
    up = {r[0]: r[0] for r in rows if r[0] is not None}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v
    n = {i: 0 for i in range(len(rows))}
    for i in ok:
        for j in ok:
            if i != j and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.98:
                n[i] += 1
                a, b = root(rows[i][0]), root(rows[j][0])
                up[max(a, b)] = min(a, b)
    return sorted(((r[0] is None, r[0] or 0), n[i], None if r[0] is None else root(r[0])) for i, r in enumerate(rows))


def vectors(seed, n=300, dim=32):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((40, dim))
    rows = []
    for i in range(n):
        c = centres[min(39, int(r.exponential(6)))]
        v = c + r.standard_normal(dim) * r.choice([0, 0.03, 0.08, 0.11, 0.6])
        rows.append((i * 2, [float(x) for x in (v * r.uniform(0.1, 9)).astype(np.float32)], int(r.integers(3))))
    return rows


@pytest.mark.parametrize("seed,block,window", [(1, 2048, 24), (2, 7, 5)])
def test_matches_brute_force(spark, seed, block, window):
    rows = vectors(seed)
    rows += [(1001, rows[0][1], rows[0][2]), (1003, rows[0][1], rows[0][2]), (1005, None, 1), (1007, [], 1), (1009, [0.0] * 32, 1),
             (1011, [float("nan")] + [1.0] * 31, 1), (1013, [None] + [1.0] * 31, 1), (1015, rows[0][1], None), (1017, [1.0, 2.0], 0),
             (1019, [2.0, 4.0], 0), (1021, [float("inf")] * 32, 0)]
    got = V.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), block=block, window=window).collect()
    assert sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_edges(spark):
    assert V.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    e = [1.0, 0.5, 0.25]
    odd = [(None, e, 1, 9), (4, e, 1, 9), (4, e, 1, 9), (2, None, None, 9)]
    got = V.near_duplicates(spark.createDataFrame(odd, SCHEMA + ", component int")).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None) == [
        (False, 2, 0, 2, True), (False, 4, 1, 4, True), (False, 4, 1, 4, True)]
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]


def test_hot_group_larger_than_every_window(spark):
    r = np.random.default_rng(8)
    c = r.standard_normal(16)
    rows = [(i, [float(x) for x in c + r.standard_normal(16) * 0.02], 0) for i in range(400)]
    rows += [(1000 + i, [float(x) for x in r.standard_normal(16)], 0) for i in range(100)]
    got = sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, r.component_id)
                 for r in V.near_duplicates(spark.createDataFrame(rows, SCHEMA), window=4, block=64).collect())
    assert got == brute(rows)


def test_passes_follow_the_number_of_vectors():
    assert V.passes_for(100) <= V.passes_for(10**5) <= V.passes_for(10**9) < 200


def test_vectors_in_a_cone(spark):
    """Isolated pairs are found where far more rows than a window share their hash prefixes."""
    r = np.random.default_rng(5)
    n, dim = 3000, 64
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    axis = unit(r.standard_normal(dim))
    x = unit(np.sqrt(0.9) * axis + np.sqrt(0.1) * unit(r.standard_normal((n, dim))))
    step = r.standard_normal((n, dim))
    step = unit(step - (step * x).sum(axis=1, keepdims=True) * x)
    y = 0.981 * x + np.sqrt(1 - 0.981 ** 2) * step
    rows = [(i, [float(v) for v in e.astype(np.float32)], 0) for i, e in enumerate(np.concatenate([x, y]))]
    e = unit(np.array([r_[1] for r_ in rows], np.float32).astype(float))
    links = ((e @ e.T >= 0.98).sum(axis=1) - 1).tolist()
    got = {r_.vec_id: r_ for r_ in V.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), block=512).collect()}
    missed = sum(got[i].component_id != got[n + i].component_id for i in range(n))
    assert missed <= 12 and sum(got[i].n_links != k for i, k in enumerate(links)) <= 2 * missed


@pytest.mark.parametrize("size", [17, 250, 4000])
def test_runs_are_compared_whole_across_batches(size):
    """Every link between rows that share a run's prefix is found, however the rows are dealt into batches."""
    r = np.random.default_rng(size)
    bits = 3
    centres = r.standard_normal((30, 16))
    x = centres[r.integers(30, size=900)] + r.standard_normal((900, 16)) * 0.06
    rows = pa.record_batch([pa.array(range(900), pa.int64()), pa.array(["a"] * 900), pa.array([v.tobytes() for v in x], pa.binary()),
                            pa.array(range(900), pa.int64())], names=["cls", "label", "vec", "component"])
    of_pass = next(iter(V._hashed(1)(iter([rows]))))
    of_pass = of_pass.take(pa.compute.sort_indices(of_pass, [("hash", "ascending"), ("cls", "ascending")]))
    batches = [of_pass.slice(at, size) for at in range(0, 900, size)]
    up = list(range(900))

    def root(v):
        while up[v] != v:
            v = up[v]
        return v
    for out in V._run_pairs(0.98, 4, V.BITS - bits)(iter(batches)):
        for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            up[root(a)] = root(b)
    run = dict(zip(of_pass.column("cls").to_pylist(), (of_pass.column("hash").to_numpy() >> (V.BITS - bits)).tolist(), strict=True))
    e = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = np.argwhere(np.triu(e @ e.T >= 0.98, 1)).tolist()
    inside = [(i, j) for i, j in near if run[i] == run[j]]
    assert len(inside) > 1000 and all(root(i) == root(j) for i, j in inside)
