import numpy as np
import pytest

from modlake.llm.lattice import cells_of, near_vectors, nearest_e8, neighbours, signs_apart, sketches, unit_rows


def test_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 2
    got = nearest_e8(x)
    twice = 2 * got
    assert np.array_equal(twice, np.rint(twice)) and (twice.astype(int) % 2 == (twice.astype(int) % 2)[:, :1]).all() and (got.sum(1) % 2 == 0).all()
    steps = neighbours()
    assert len(np.unique(steps, axis=0)) == 240 and np.allclose((steps**2).sum(1), 2)
    # no neighbour of the point is nearer, which for this lattice's cells means that no point is
    own = ((x - got) ** 2).sum(1)
    assert (((x[:, None] - got[:, None] - steps) ** 2).sum(2) >= own[:, None] - 1e-9).all()


@pytest.mark.parametrize("tables,probes,cell,blocks,least", [(1, 8, 1.0, 1, 0.93), (5, 8, 1.0, 1, 0.9999), (1, 16, 1.5, 2, 0.85)])
def test_pairs_at_the_threshold_meet(tables, probes, cell, blocks, least):
    rng = np.random.default_rng(1)
    x, z = unit_rows(list(rng.normal(size=(3000, 64)))), rng.normal(size=(3000, 64))
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * unit_rows(list(z))
    labels = np.zeros(3000, np.int64)
    a, b = (cells_of(v, labels, tables, probes, cell, blocks, 20).reshape(3000, tables, -1) for v in (x, y))
    met = ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).any(1)
    assert met.mean() >= least
    apart = np.bitwise_count((sketches(x, 20) ^ sketches(y, 20)).view(np.uint64)).sum(1)
    assert (apart <= signs_apart(0.98)).all()


def plain(rows, cosine=0.98):
    n = len(rows)
    good = [r[1] is not None and r[2] is not None and None not in r[1] and bool(np.isfinite(r[1]).all()) and any(r[1]) for r in rows]
    links = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = unit_rows([np.array(rows[i][1]), np.array(rows[j][1])])
                if a @ b >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


def made(rng, size=24):
    rows, base = [], rng.normal(size=(12, size))
    for k in range(240):
        v = base[k % 12] * rng.uniform(0.5, 2) + rng.normal(size=size) * rng.choice([0.02, 0.1, 0.2, 2])
        rows.append((k if k % 31 else None, v.tolist(), int(k % 12 % 3)))
    chain = [np.cos(t) * base[0] / np.linalg.norm(base[0]) + np.sin(t) * base[1] / np.linalg.norm(base[1]) for t in np.arange(0, 1.5, 0.15)]
    rows += [(1000 - k, v.tolist(), 5) for k, v in enumerate(chain)]
    rows += [(2000 + k, base[3].tolist(), 7) for k in range(9)] + [(2000, base[4].tolist(), 7), (2000, (base[3] * 1e-200).tolist(), 7), (3000, (base[3] * 1e200).tolist(), 7)]
    odd = [None, [0.0] * size, [float("nan")] + [1.0] * (size - 1), [float("inf")] + [1.0] * (size - 1), [None] + [1.0] * (size - 1), [], [1.0, 2.0], [1.0, 2.0], [-0.0, 1.0], [0.0, 1.0]]
    return rows + [(4000 + k, v, 7) for k, v in enumerate(odd)] + [(5000, base[3].tolist(), None), (None, None, None)]


@pytest.mark.parametrize("tile,size", [(2048, 4096), (16, 20), (3, 8)])
def test_against_all_pairs(spark, monkeypatch, tile, size):
    monkeypatch.setattr("modlake.llm.lattice.TILE", tile)
    monkeypatch.setattr("modlake.llm.lattice.BIN", size)
    rows = made(np.random.default_rng(2))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, node string, k int").repartition(4)
    got = sorted((tuple(r) for r in near_vectors(df).collect()), key=repr)
    want = plain(rows)
    assert got == want and sum(r[1] for r in want) > 300


def test_floats_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 0.1], 0), (2, [1.0, 0.1], 0), (3, [-1.0, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in near_vectors(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert near_vectors(df.limit(0)).count() == 0
