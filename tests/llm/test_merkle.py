import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from modlake.llm.merkle import fold, hex_of, manifest, proof_digest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def plain(rows, arity):
    """{(key, leaf): [(subroot, root, proof digest)]} of rows (key, group, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, h(*map(field, r)), r[0]))
    groups = {g: sorted(rs) for g, rs in groups.items()}

    def tree(nodes):
        ways = [[] for _ in nodes]
        at, level = list(range(len(nodes))), nodes
        while len(level) > 1:
            for i, k in enumerate(at):
                run = k - k % arity
                ways[i] += [level[s] for s in range(run, min(run + arity, len(level))) if s != k]
                at[i] = k // arity
            level = [h(*level[s : s + arity]) for s in range(0, len(level), arity)]
        return level[0], ways

    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in groups[g]]) for g in order}
    root, upper = tree([trees[g][0] for g in order])
    out = defaultdict(list)
    for g, up in zip(order, upper):
        for x, way in zip(groups[g], trees[g][1]):
            out[x[3], x[2]].append((trees[g][0], root, h(*way, *up)))
    return out


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_against_plain_trees(spark, arity):
    rows = [(k, "en", f"text {k} Ä") for k in range(70)] + [(k, "de", "x" * k) for k in range(9)] + [(5, "fr", None), (None, "de", ""), (None, None, None), (7, "", "one"), (7, "en", "again"), (3, "en", "text 3 Ä")]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "k long, g string, t string, tree string, digest int").repartition(5)
    got = manifest(df, ["k", "g", "t"], "g", "k", arity).withColumn("p", proof_digest(F.col("proof"))).withColumn("back", fold(F.col("leaf"), F.col("proof"))).withColumn("l", hex_of(F.col("leaf"))).collect()
    want = plain(rows, arity)
    found = defaultdict(list)
    for r in got:
        found[r.k, r.l].append((r.subroot, r.root, r.p))
        assert r.back == r.root
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, None, "a")], "k long, g string, t string")
    r = manifest(one, ["k", "t"], "g", "k").first()
    assert r.subroot == r.root == h("1:1", "1:a") and r.proof == []
    assert manifest(one.limit(0), ["k", "t"], "g", "k").count() == 0


def test_a_changed_row_does_not_fold_to_the_root(spark):
    df = spark.createDataFrame([(k, "a", "Text" if k % 2 else "text") for k in range(20)], "k long, g string, t string")
    from modlake.llm.merkle import leaf_of

    out = manifest(df, ["k", "t"], "g", "k", keep={"other": leaf_of([F.col("k"), F.lower("t")])})
    got = {r.k: r.ok for r in out.select("k", (fold(F.col("other"), F.col("proof")) == F.col("root")).alias("ok")).collect()}
    assert got == {k: k % 2 == 0 for k in range(20)}


def test_several_ranges(spark, monkeypatch):
    monkeypatch.setattr("modlake.llm.merkle.RANGE", 2048)
    rows = [(k * 37 % 500, "en" if k % 3 else "de", f"t{k}") for k in range(500)]
    df = spark.createDataFrame(rows, "k long, g string, t string")
    want = plain(rows, 8)
    got = manifest(df, ["k", "g", "t"], "g", "k").withColumn("p", proof_digest(F.col("proof"))).withColumn("l", hex_of(F.col("leaf"))).collect()
    assert len(got) == 500 and all(want[r.k, r.l] == [(r.subroot, r.root, r.p)] for r in got)


def test_query_tampers_every_third_checksum(spark, tmp_path):
    from modlake.llm.queries import op13_merkle_manifest

    rows = [(k, "TEXT" if k != 3 else None, "en", "s", 4) for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op13_merkle_manifest(spark, str(tmp_path)).collect():
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.doc_id != 3
        assert r.verified is not changed and (r.folded_root == r.root) is not changed
        text = field(None if r.doc_id == 3 else "TEXT")
        assert r.leaf == h(field(r.doc_id), "1:s", "2:en", "1:4", text)
