import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modlake.llm import lm_scoring as lm

WORDS = [f"w{i}" for i in range(30)]


def rows_of(n):
    rng = np.random.default_rng(2)
    texts = [" ".join(WORDS[min(29, int(rng.exponential(6)))] for _ in range(rng.integers(0, 60))) for _ in range(n)]
    texts[3], texts[5], texts[8] = None, "", "  Mixed CASE\twords\n É é  "
    return [(k, t, "x") for k, t in enumerate(texts)] + [(11, texts[11], "x"), (None, "w1 w2 w2", "x")]


def words(t):
    return (t or "").encode().lower().split() + [b""]


def brute(rows, order):
    kind = {}
    for d, _, _ in rows:
        c = zlib.crc32(b"" if d is None else str(d).encode())
        kind[d] = 0 if c % 10 == 0 else 1 if c // 10 % 10 == 0 else 2
    def model(kinds):
        grams = [Counter() for _ in range(order + 1)]
        docs = 0
        for d, t, _ in rows:
            if kind[d] in kinds:
                docs += 1
                seq = ["<s>"] * (order - 1) + words(t)
                for i in range(order - 1, len(seq)):
                    for k in range(1, order + 1):
                        grams[k][tuple(seq[i - k + 1 : i + 1])] += 1
        return grams, docs
    def p_and_bucket(m, seq, i):
        grams, docs = m
        n = sum(grams[1].values())
        p, ctx = [1 / (len(grams[1]) + 1)], n
        for k in range(1, order + 1):
            if k > 1:
                c = tuple(seq[i - k + 1 : i])
                ctx = docs if all(x == "<s>" for x in c) else grams[k - 1][c]
            p.append(grams[k][tuple(seq[i - k + 1 : i + 1])] / ctx if ctx else 0.0)
        return p, min(int(math.log2(ctx + 1) + 1e-12), lm.BUCKETS - 1)
    kept, full = model({2}), model({1, 2})
    found = Counter()
    for d, t, _ in rows:
        if kind[d] == 1:
            seq = ["<s>"] * (order - 1) + words(t)
            for i in range(order - 1, len(seq)):
                p, b = p_and_bucket(kept, seq, i)
                found[(b, *p[1:])] += 1
    w, seen = {}, {b for b, *_ in found}
    uniform = 1 / (len(kept[0][1]) + 1)
    for b in seen:
        w[b] = [1 / (order + 1)] * (order + 1)
        for _ in range(25):
            got = [1.0] + [0.0] * order
            for (c, *p), n in found.items():
                if c == b:
                    share = [x * y for x, y in zip(w[b], [uniform, *p])]
                    got = [g + n * x / sum(share) for g, x in zip(got, share)]
            w[b] = [g / sum(got) for g in got]
    for b in range(lm.BUCKETS):
        if b not in seen:
            w[b] = w[max((x for x in seen if x < b), default=min(seen))]
    n, v = sum(full[0][1].values()), len(full[0][1])
    out = []
    for d, t, _ in rows:
        seq = ["<s>"] * (order - 1) + words(t)
        at = range(order - 1, len(seq))
        c = [full[0][1][(seq[i],)] for i in at]
        base = sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in c)
        total = 0.0
        for i in at:
            p, b = p_and_bucket(full, seq, i)
            total += math.log10(float(np.dot(w[b], p)))
        out.append((d, kind[d] == 0, len(at), sum(x > 0 for x in c), n, round(base, 6), round(total, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("order,block,entries,hot", [(3, 1 << 20, 1 << 20, 1 << 15), (2, 700, 40, 3), (3, 300, 100, 5), (1, 500, 50, 0), (4, 400, 100, 8)])
def test_scores_against_brute_force(spark, order, block, entries, hot, monkeypatch):
    for name, value in {"RANGE": entries, "BLOCK": block, "HOT": hot, "SETTLED": 0.0, "ROUNDS": 25}.items():
        monkeypatch.setattr(lm, name, value)
    rows = rows_of(300)
    df = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(3)
    got = sorted(((*list(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in lm.score(df, order=order).collect()), key=str)
    want = brute(rows, order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], atol=2e-4)


def test_squeezed_arrays_come_back():
    rng = np.random.default_rng(3)
    for kind in ("<u8", "<u4", "<u1", "<f4"):
        for n in (0, 1, 1000):
            values = rng.integers(0, 200, n).astype(kind)
            assert (lm.unsqueezed(lm.squeezed(values), kind) == values).all() and len(lm.unsqueezed(lm.squeezed(values), kind)) == n


def test_em_prefers_what_predicts(spark):
    p, n, bucket = np.array([[0.5, 1e-12], [0.5, 0.25]], "<f4"), np.array([10, 90], "<u8"), np.array([3, 3], "<u1")
    row = tuple(bytearray(lm.squeezed(x)) for x in (bucket, p.ravel(), n))
    schema = "bucket binary, p binary, n binary"
    w = lm.learn_weights(spark.createDataFrame([row], schema), 1e-6, 2)
    assert w[3, 2] > 0.9 and np.allclose(w.sum(axis=1), 1)
    assert np.allclose(lm.learn_weights(spark.createDataFrame([], schema), 0.1, 2)[:, 0], 1)


def test_scores_of_an_empty_table_and_without_training_rows(spark):
    df = spark.createDataFrame(rows_of(20), "doc_id long, text string, block string")
    assert lm.score(df.limit(0)).count() == 0
    only = df.where(lm.split_of(F.col("doc_id")) == lm.HELD_OUT)
    for r in lm.score(only).collect():
        assert r.n_known == 0 and r.train_tokens == 0 and r.score == 0.0
