import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from modlake.llm.divergence import count_slice, divergence, from_planes, gallop, merged, planes, share

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, min_docs, digits=9, top=10):
    scale, held, counts, groups = 10**digits, defaultdict(Counter), defaultdict(Counter), set()
    for source, lang, text in rows:
        source, lang = source or "", lang or ""
        terms = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + scale * (c[t] + 2) // (n + 2 * v) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p = shares(counts[lang, source])
        whole = shares(sum((c for (x, _), c in counts.items() if x == lang), Counter()))
        pairs = [(s, sum(f(p[t], q) for t, q in shares(counts[lang, s]).items())) for x, s in groups if x == lang and s != source]
        terms = [(t, f(p[t], whole[t])) for t in kept if counts[lang, source][t] and p[t] > whole[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


WORDS = ["Alpha", "beta", "Über", "été", "gamma-delta", "x1y", "İi", "日本", "don't", "z\x85w", "a\x00b"]


@pytest.mark.parametrize("min_docs,block,tile", [(1, 1 << 15, 512), (3, 4, 2), (10, 2, 1)])
def test_against_plain_counts(spark, monkeypatch, min_docs, block, tile):
    monkeypatch.setattr("modlake.llm.divergence.BLOCK", block)
    monkeypatch.setattr("modlake.llm.divergence.TILE", tile)
    rng = np.random.default_rng(3)
    rows = [(f"s{rng.integers(4)}" if k % 9 else None, ["en", "de", None][rng.integers(3)], " ".join(rng.choice(WORDS, rng.integers(0, 30)))) for k in range(120)]
    rows += [("only", "en", None), ("marks", "en", "123 ... !"), ("alone", "fr", "word"), ("none", "xx", ""), ("other", "xx", "..."), ("long", "de", "word " * 20000)]
    df = spark.createDataFrame([(s, g, t, 1, 2) for s, g, t in rows], "source string, lang string, text string, n int, term int").repartition(3)
    got = sorted(tuple(r) for r in divergence(df, min_docs=min_docs).collect())
    assert got == plain(rows, min_docs)


def test_ties_and_many_terms_keep_ten(spark):
    rows = [("a", "en", " ".join(f"w{chr(97 + k)}" for k in range(25)))] * 3 + [("b", "en", "other")] * 3
    df = spark.createDataFrame(rows, "source string, lang string, text string")
    got = sorted(tuple(r) for r in divergence(df, min_docs=2).collect())
    assert got == plain(rows, 2) and [r[3] for r in got if r[1] == "a" and r[2] == "term"] == [f"w{c}" for c in "abcdefghij"]


def test_empty_table(spark):
    assert divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_galloping_finds_what_both_hold():
    rng = np.random.default_rng(1)
    for _ in range(200):
        few, many = (np.unique(rng.integers(0, 400, n)) for n in rng.integers(0, 300, 2))
        i, j = gallop(few, many, step=int(rng.integers(1, 9)))
        assert few[i].tolist() == np.intersect1d(few, many).tolist() == many[j].tolist()


def test_shares_are_exact_beyond_64_bit_products():
    total = 8 * 10**15
    for c in (0, 1, 10**15, total - 2):
        assert share(np.array([c]), total, 9)[0] == 1 + 10**9 * (c + 2) // total
    a, b = (np.array([1, 5]), np.array([3, 10**12])), (np.array([5, 9, 11]), np.array([1, 2, 3]))
    assert merged(a, b, 10**13, 20, 9) == merged(b, a, 20, 10**13, 9)


def test_planes_round_trip():
    for x in ([], [0], [255, 256, 0], [2**40, 1]):
        assert from_planes(planes(np.array(x, np.int64)), len(x)).tolist() == x


def test_counts_of_a_slice():
    got = count_slice(pa.array(["en", None]), pa.array(["a", "a"]), pa.array(["b B c", None])).to_pylist()
    assert sorted((r["lang"], r["term"] or "", r["n"], r["docs"]) for r in got) == [("", "", 0, 1), ("en", "", 0, 1), ("en", "b", 2, 1), ("en", "c", 1, 1)]
