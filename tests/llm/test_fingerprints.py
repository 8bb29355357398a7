import hashlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from modlake.llm.fingerprints import HEAVIEST, compare_with_edits, fingerprints, mark, mixed, near_groups
from tests.llm.test_dedup import brute_classes

TEXTS = ["One two three\nfour", None, "", "  ", "single", "ÉA b é", " lead and trail ", "the same " * 50, "x" * 3000, "a b", "A B", *(f"doc {k} " + " ".join(f"w{(k * j) % 97}" for j in range(k)) for k in range(40))]


def slow(text):
    words = (text or "").encode().lower().split()
    votes = np.zeros(64)
    for k in range(max(len(words) - 1, min(len(words), 1))):
        pair = words[k : k + 2]
        h = [xxhash.xxh64_intdigest(w, 0) for w in pair] + [0]
        with np.errstate(over="ignore"):
            x = int(mixed(np.array([(h[0] * 0x9E3779B97F4A7C15 + h[1]) % 2**64], np.uint64))[0])
        w = sum(min(len(p), HEAVIEST) for p in pair)
        votes += [w if x >> b & 1 else -w for b in range(64)]
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_fingerprints_against_brute_force():
    assert fingerprints(pa.array(TEXTS, pa.string())).tolist() == [slow(t) for t in TEXTS]
    long = [" ".join(f"w{j % 70001}" for j in range(140_000)), "b c"]
    assert fingerprints(pa.array(long)).tolist() == [slow(t) for t in long]
    assert len(fingerprints(pa.array([], pa.string()))) == 0
    many = TEXTS * 40
    for at in (1, 7, 300):
        assert fingerprints(pa.array(many, pa.string()).slice(at, 200)).tolist() == [slow(t) for t in many[at : at + 200]]


@pytest.mark.parametrize("part_bytes", [1 << 20, 900])
def test_compare_with_edits_against_brute_force(spark, part_bytes):
    rows = [((k * 17) % 60 if k % 13 else None, t, "x") for k, t in enumerate(TEXTS)] + [(7, "dup", "x"), (7, "dup", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
    got = sorted((tuple(r) for r in compare_with_edits(df, part_bytes).collect()), key=str)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = []
    for k, (d, t, _) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        a, b, c = slow(t), slow(e), slow(n)
        s = lambda x: x - 2**64 if x >= 2**63 else x
        like = lambda x, y: 1 - (x ^ y).bit_count() / 64
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), s(a), s(b), like(a, b), like(a, c)))
    assert got == sorted(want, key=str)
    assert compare_with_edits(df.limit(0)).count() == 0
    one = compare_with_edits(df.where("doc_id = 7 AND text <> 'dup'").limit(1)).collect()
    assert len(one) <= 1


def test_near_groups_of_permuted_tables(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    marked = mark(df)
    fps = [r.fp for r in sorted(marked.collect())]
    got = {r.fp: r.class_id for r in near_groups(marked).collect()}
    assert [got[x] for x in fps] == brute_classes(fps, 3)
