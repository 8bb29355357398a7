import numpy as np
import pytest
from pyspark.sql import functions as F

from modlake.llm.topk import CoverTree, bound, dual_search, top_k


def brute(rows, k, query, scale=64):
    kept = {}
    for d, v in rows:
        if d is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ints = [int(np.floor(scale * np.float64(np.float32(x)))) for x in v]
            kept[d] = min(kept.get(d, ints), ints)
    width = max(map(len, kept.values()), default=0)
    full = {d: v + [0] * (width - len(v)) for d, v in kept.items()}
    out = []
    for d, v in full.items():
        if query(d):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), e) for e, w in full.items() if e != d)[:k]
            out += [(d, r + 1, e, -s) for r, (s, e) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("shard,group,k", [(8192, 1024, 20), (40, 8, 5), (16, 3, 500)])
def test_top_k_against_brute_force(spark, shard, group, k):
    rng = np.random.default_rng(shard)
    centres = rng.normal(size=(4, 6))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 4] + 0.2 * rng.normal(size=6)]) for i in range(300)]
    rows += [(i, rows[8][1]) for i in range(300, 360)]  # a group of equal vectors, so ties
    rows += [(400, None), (405, [1.0, None]), (410, [float("nan")] * 6), (420, [float("inf")] * 6), (None, [1.0] * 6), (430, [0.5, 0.5]), (435, []), (20, [9.0] * 6)]
    df = spark.createDataFrame([(d, v, 1) for d, v in rows], "vec_id long, embedding array<float>, score int")
    out = top_k(df, F.col("vec_id") % 5 == 0, k=k, shard_rows=shard, group_rows=group, batch_groups=2, sample=64)
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, out.collect())) == brute(rows, k, lambda d: d % 5 == 0)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("vec_id") == 1).count() == 0


def test_bounds_cover_all_pairs_and_the_search_prunes():
    rng = np.random.default_rng(1)
    x = np.floor(64 * (rng.normal(size=(3, 8))[rng.integers(0, 3, 900)] + 0.05 * rng.normal(size=(900, 8))))
    tree, other = CoverTree(x, 32), CoverTree(x[:100], 16)
    for a in tree.nodes:
        points = tree.x[a[3] : a[4]]
        assert np.sqrt(((points - a[0]) ** 2).sum(axis=1)).max() <= a[2] + 1e-9
        for b in other.nodes:
            assert (points @ other.x[b[3] : b[4]].T).max() <= bound(a, b)
    ids = np.arange(900)
    place, found, scores = dual_search(x[:50], ids[:50], np.full(50, -np.inf), x, ids, 7)
    for q in range(50):
        want = sorted((-float(x[q] @ x[j]), j) for j in range(900) if j != q)[:7]
        assert sorted(zip(-scores[place == q], found[place == q])) == want
    # a limit that nothing reaches ends the search at the roots
    assert len(dual_search(x[:50], ids[:50], np.full(50, np.inf), x, ids, 7)[0]) == 0


@pytest.mark.parametrize("kind", ["clusters", "none", "copies", "line"])
def test_cover_tree_keeps_its_invariants(kind):
    rng = np.random.default_rng(2)
    x = {
        "clusters": np.floor(64 * (rng.normal(size=(5, 8))[rng.integers(0, 5, 700)] + 0.01 * rng.normal(size=(700, 8)))),
        "none": np.floor(64 * rng.normal(size=(400, 40))),
        "copies": np.floor(rng.normal(size=(6, 4)) * 9)[rng.integers(0, 6, 500)],
        "line": np.arange(600.0)[:, None] ** 2,
    }[kind]
    tree = CoverTree(x, 8, block=32)
    apart = lambda a, b: np.sqrt(((x[a][:, None] - x[b][None, :]) ** 2).sum(axis=2))
    for above, (scale, n) in zip([None, *tree.levels], tree.levels):
        net = tree.centres[:n]  # nesting: a level is a prefix of the finer one
        assert (apart(net, net) + np.diag(np.full(n, np.inf))).min() > scale or n == 1
        assert apart(np.arange(len(x)), net).min(axis=1).max() <= scale + 1e-6
        if above:
            for c in range(above[1], n):
                assert tree.parent[c] < above[1] and apart([tree.centres[c]], [tree.centres[tree.parent[c]]]).item() <= above[0] + 1e-6
    assert sorted(tree.rows) == list(range(len(x)))
    leaves = [node for node in tree.nodes if not node[5]]
    assert sorted(r for node in leaves for r in range(node[3], node[4])) == list(range(len(x)))
    for node in tree.nodes:
        assert np.sqrt(((tree.x[node[3] : node[4]] - node[0]) ** 2).sum(axis=1)).max() <= node[2]
        ends = sorted((tree.nodes[c][3], tree.nodes[c][4]) for c in node[5])
        assert not ends or (ends[0][0], ends[-1][1]) == (node[3], node[4]) and all(p[1] == q[0] for p, q in zip(ends, ends[1:]))


@pytest.mark.parametrize("k", [1, 20, 2000])
def test_dual_search_over_several_blocks_with_ties(k):
    rng = np.random.default_rng(3)
    x = np.floor(4 * rng.normal(size=(5000, 12)))
    x[4000:] = x[:10].repeat(100, axis=0)
    ids = rng.permutation(5000)
    place, found, scores = dual_search(x[:150], ids[:150], np.full(150, -np.inf), x, ids, k)
    all_scores = x[:150] @ x.T
    for q in range(150):
        order = [j for j in np.lexsort((ids, -all_scores[q])) if j != q][:k]
        assert found[place == q].tolist() == ids[order].tolist() and scores[place == q].tolist() == all_scores[q][order].tolist()


def test_components_beyond_64_bits_are_refused(spark):
    df = spark.createDataFrame([(k, [1e20, 1.0]) for k in range(5)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        top_k(df, F.col("vec_id") == 1)
