import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from modlake.llm.hamming import block_masks, components, covering_masks, near_classes
from modlake.llm.line_dedup import drop_repeated_lines
from modlake.llm.simhash_dedup import drop_near_copies, fingerprint, near_components, word_fingerprints

SCHEMA = "doc_id long, text string, line string, __x int"


def brute_lines(rows, min_chars=10, min_docs=2):
    strip = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(strip).translate(low)
    held = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        ids = lambda x: {i for i in held.get(key(x), ()) if i is not None}
        gone = [len(held.get(key(x), ())) >= min_docs and bool(ids(x)) and min(ids(x)) != d for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((d, len(lines), sum(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_against_brute_force(spark, min_docs):
    long = "A shared passage of text"
    rows = [
        (3, f"{long}\nown line number three\n\n short "),
        (1, f"  {long.upper()}\t\nfirst"),
        (1, f"  {long.upper()}\t\nfirst"),
        (2, None), (4, ""), (5, "ÉCOLE DES LIGNES"), (6, "école des lignes"), (7, long), (8, long),
        (None, long), (9, "\n".join([long] * 300 + ["tail of nine"] + [long] * 3)), (10, "own line number three\ntail of nine"),
    ]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    out = drop_repeated_lines(df, min_docs=min_docs)
    assert out.columns == ["doc_id", "text", "line", "__x", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in out.collect()), key=str)
    assert got == brute_lines(rows, min_docs=min_docs)


def test_line_dedup_of_an_empty_table(spark):
    assert drop_repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_covering_masks_meet_every_pair_within_the_radius():
    rng = np.random.default_rng(1)
    for radius in (1, 2, 4):
        masks = covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            flips = sum(1 << int(i) for i in rng.choice(64, radius, replace=False))
            assert any(m & flips == 0 for m in masks)
    masks = block_masks(3, 6)
    assert len(masks) == 20
    for _ in range(2000):
        flips = sum(1 << int(i) for i in rng.choice(64, 3, replace=False))
        assert any(m & flips == 0 for m in masks)


def brute_classes(fps, radius):
    low = list(range(len(fps)))
    def top(i):
        while low[i] != i:
            i = low[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                low[b] = a
    return [top(i) for i in range(len(fps))]


@pytest.mark.parametrize("tile", [2048, 16])
def test_near_classes_against_brute_force(spark, tile, monkeypatch):
    import modlake.llm.hamming as hamming

    monkeypatch.setattr(hamming.near_links, "__defaults__", (tile,))
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 12, dtype=np.int64)
    fps = []
    for k in range(300):  # chains and clouds whose ends are far apart
        x = int(base[k % 12]) if k < 12 or rng.random() < 0.4 else fps[rng.integers(len(fps))]
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            x ^= 1 << int(b)
        fps.append(x - 2**64 if x >= 2**63 else x)
    want = brute_classes(fps, 4)
    df = spark.createDataFrame(list(enumerate(fps)), "doc_id long, fp long")
    got = {r.fp: r.class_id for r in near_classes(df, covering_masks(4), 4).collect()}
    assert [got[x] for x in fps] == want
    assert len(set(want)) > 12


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(60))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text, width=4):
    words = text.lower().encode().split() if text else []
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_fingerprints_and_components(spark):
    words = [f"w{i}" for i in range(400)]
    near = words[:200] + ["other"] + words[201:]
    texts = [" ".join(words), " ".join(near), "  ", None, "", "one two", "ONE\ttwo", " ".join(reversed(words)), "a b c d e", " ".join(words)]
    df = spark.createDataFrame([(i + 1, t, "x", 2) for i, t in enumerate(texts)], SCHEMA)
    rows = {r.doc_id: r for r in near_components(df).collect()}
    want = [slow_fingerprint(t) for t in texts]
    assert [rows[i + 1].fp % 2**64 for i in range(len(texts))] == want
    signed = [x - 2**64 if x >= 2**63 else x for x in want]
    assert [rows[i + 1].component_id - 1 for i in range(len(texts))] == brute_classes(signed, 4)
    assert rows[10].component_id == 1 and rows[4].component_id == 3 and rows[7].component_id == 6
    # Spark's own hash is the same function
    assert spark.range(1).select(F.xxhash64(F.lit("one two"))).first()[0] % 2**64 == fingerprint(b"one two", 4)
    kept = drop_near_copies(df.union(df), width=4, radius=4)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in rows.values()})
    assert drop_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def slow_word_fingerprint(text):
    words = (text or "").encode().lower().split()
    if len(words) < 24:
        h = [xxhash.xxh64_intdigest(w, 42) for w in words]
        return xxhash.xxh64_intdigest(np.array(h, np.uint64).tobytes(), 42) if h else 0
    votes = [0] * 64
    for w in set(words):
        h, k = xxhash.xxh64_intdigest(w, 42), min(max(len(w) - 3, 1), 9)
        votes = [v + (k if h >> b & 1 else -k) for b, v in enumerate(votes)]
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_near_copies_at_a_similarity_of_four_fifths_go(spark):
    rng = np.random.default_rng(8)
    text = lambda: [f"word{rng.integers(0, 4000)}" if rng.random() < 0.7 else "the" for _ in range(300)]
    groups, rows = [], []
    for g in range(40):
        base = text()
        copies = [base]
        for _ in range(3):  # five words changed in a row of three hundred: a similarity of 0.85 on five-word shingles
            edited = list(base)
            for at in rng.choice(300, 5, replace=False):
                edited[at] = "changed"
            copies.append(edited)
        groups.append([len(rows) + k for k in range(4)])
        rows += [" ".join(c) for c in copies]
    short = ["Erinst resh.", "erinst  RESH.", "Erinst of.", "", None, "the of", "of the"]
    rows += short
    assert word_fingerprints(pa.array(rows, pa.string())).tolist() == [slow_word_fingerprint(t) for t in rows]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(rows)], SCHEMA)
    kept = {r.doc_id for r in drop_near_copies(df).collect()}
    assert all(g[0] in kept for g in groups)
    assert sum(d in kept for g in groups for d in g[1:]) <= 6
    n = len(rows) - len(short)
    assert [n + k in kept for k in range(len(short))] == [True, False, True, True, False, True, True]


def slow_shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def slow_kept(texts):
    """Places that stay where all pairs at a similarity of 0.8 are linked and the first of each component stays."""
    sets = [slow_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {find(i) for i in range(len(texts))}


def edited_texts(seed=4):
    """Texts of many lengths with copies edited in a row, whose words and fingerprints change the most."""
    rng = np.random.default_rng(seed)
    texts = []
    for n in rng.integers(5, 160, 60).tolist():
        base = [f"word{rng.integers(0, 3000)}" for _ in range(n)]
        texts.append(" ".join(base))
        for share in (0.05, 0.09, 0.1, 0.15):
            k, at = max(1, int(n * share)), int(rng.integers(0, n))
            texts.append(" ".join(base[:at] + [f"longerword{rng.integers(0, 3000)}" for _ in range(k)] + base[at + k :]))
    return texts


def test_every_pair_at_a_similarity_of_four_fifths_is_found(spark):
    texts = edited_texts()
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], SCHEMA)
    kept = {r.doc_id for r in drop_near_copies(df).collect()}
    assert kept <= slow_kept(texts)


@pytest.mark.parametrize("small", [2, 10_000])
def test_large_groups_of_near_copies_in_tiles_and_joins(spark, small, monkeypatch):
    import modlake.llm.similar as similar

    monkeypatch.setattr(similar, "SMALL", small)
    monkeypatch.setattr(similar, "TILE", 16)
    rng = np.random.default_rng(12)
    base, texts = [f"word{k}" for k in range(120)], []
    for _ in range(150):  # a chain of edits, so that the ends are far apart
        edited = list(texts[rng.integers(max(0, len(texts) - 20), len(texts))]) if texts else base
        for at in rng.choice(120, 1):
            edited[int(at)] = f"other{rng.integers(0, 9)}"
        texts.append(edited)
    texts = [" ".join(t) for t in texts] + [" ".join(base[k:] + base[:k]) for k in range(0, 120, 40)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in drop_near_copies(df).collect()} == slow_kept(texts)


def test_texts_below_a_similarity_of_four_fifths_stay(spark):
    words = [f"word{k}" for k in range(60)]
    table = [" ".join(words), " ".join(reversed(words)), " ".join(words[k * 7 % 60] for k in range(60))]
    texts = table + edited_texts(9) + [table[0].upper()]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], SCHEMA)
    kept = {r.doc_id for r in drop_near_copies(df).collect()}
    assert {0, 1, 2} <= kept
    assert kept == slow_kept(texts)


def test_components_of_a_path_of_thousands(spark):
    n = 3001
    edges = [(i, i + 1) for i in range(n - 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(got) == n and set(got.values()) == {0}


def test_rows_that_share_an_id_or_have_none_go_by_their_text(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "wz")
    rows = [(1, a, "x", 1), (1, b, "x", 2), (2, a.upper(), "x", 3), (None, b, "x", 4), (None, a + " more", "x", 5), (None, "short", "x", 6), (None, "short", "y", 7), (7, None, "x", 8), (8, "", "x", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, stays string, hash int")
    kept = [tuple(r) for r in drop_near_copies(df).collect()]
    assert sorted(r[3] for r in kept if r[1] != "short") == [1, 2, 8]
    assert sum(r[1] == "short" for r in kept) == 1
    assert drop_near_copies(df).columns == df.columns


def test_line_dedup_keeps_columns_of_clashing_names(spark):
    rows = [(1, "a shared passage\nfirst of all", 7, "r", "p", 1), (2, "a shared passage", 8, "r", "p", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, row_hash string, hot string, N_dropped int")
    out = drop_repeated_lines(df)
    assert out.columns == [*df.columns, "n_lines_", "n_dropped_"]
    assert sorted(map(tuple, out.collect())) == [(1, rows[0][1], 7, "r", "p", 1, 2, 0), (2, "", 8, "r", "p", 2, 1, 1)]


@pytest.mark.parametrize("share", [1, 2, 1 << 40])
def test_hot_lines_are_dropped_like_any_other(spark, share, monkeypatch):
    import modlake.llm.line_dedup as line_dedup

    monkeypatch.setattr(line_dedup, "HOT_SHARE", share)
    rows = [(k, "\n".join(["the common line of all"] * (k % 3 + 1) + [f"line number {k % 9} of few", f"only one has {k}"])) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in drop_repeated_lines(df).collect()), key=str)
    assert got == brute_lines(rows)


def test_cross_links_count_the_highest_bit():
    from modlake.llm.hamming import _cross_links

    bits = [0, 1 << 63, (1 << 63) | 1, (1 << 63) | 0b1111, (1 << 62) | 3, (1 << 64) - 1]
    fp = np.array(bits, np.uint64).view(np.int64)
    group = pa.table({"fp": fp, "comp": np.arange(len(fp)), "t": np.zeros(len(fp), np.int64)})
    key = (pa.scalar(1), pa.scalar(0), pa.scalar(0))
    got = {tuple(sorted(p)) for p in zip(*_cross_links(4)(key, group).to_pydict().values())}
    assert got == {(i, j) for j in range(len(bits)) for i in range(j) if (bits[i] ^ bits[j]).bit_count() <= 4}
