import io
from contextlib import redirect_stdout

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from modlake.operators import layout
from modlake.sources import footers


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_overlaps_in_several_parts_against_pairs(spark, monkeypatch):
    monkeypatch.setattr(layout, "ENDS", 20)
    rng = np.random.default_rng(4)
    rows = [(f"u{k}", int(a), int(a + b)) for k, (a, b) in enumerate(zip(rng.integers(0, 60, 90), rng.choice([0, 1, 5, 40], 90)))] + [("none", None, None)]
    out = layout.overlaps(spark.createDataFrame(rows, "unit string, low long, high long"))
    want = {u: sum(o != u and c <= b and d >= a for o, c, d in rows[:-1]) for u, a, b in rows[:-1]}
    assert {r.unit: r.overlaps for r in out.collect()} == want
    assert "SinglePartition" not in plan_of(out)


def test_ranges_come_from_footers_and_else_from_the_column(spark, tmp_path):
    for k in range(6):
        t = pa.table({"n": pa.array([k * 10, None, k * 10 + 5], pa.int64()), "d": pa.array([k, k + 1, None], pa.date32()), "x": [1.0, float("nan"), k + 0.5], "s": ["a", f"b{k}", None], "z": pa.array([None] * 3, pa.int32())})
        pq.write_table(t, f"{tmp_path}/part-{k}.parquet", row_group_size=2, write_statistics=k % 3 != 2)
    path = f"file://{tmp_path}"
    for col in ("n", "d", "x", "s", "z"):
        found, want = (sorted(map(tuple, df.select("path", "low", "high", "n_rows").collect()), key=str) for df in (footers.file_ranges(spark, path, col), footers.scanned(spark.read.parquet(path), col)))
        assert str(found) == str(want), col
    known = footers.footers(spark, path, "n")
    assert known.where("known").select("path").distinct().count() == 4 and known.where("footer_bytes > 0").count() == 12
    assert footers.latest(spark, path, "n") == 55
    groups = layout.row_group_profile(spark, path, "n").where("file = 'part-1.parquet'").orderBy("row_group").collect()
    assert [(g.low, g.high, g.n_rows, g.overlaps) for g in groups] == [(10, 10, 2, 0), (15, 15, 1, 0)]


def test_files_that_cannot_be_opened_are_read_by_spark(spark, tmp_path, monkeypatch):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/t")
    path, want = f"file://{tmp_path}/t", sorted(map(tuple, footers.scanned(spark.read.parquet(f"{tmp_path}/t"), "id").collect()))
    assert sorted(map(tuple, footers.file_ranges(spark, path, "id").collect())) == want
    with monkeypatch.context() as m:
        m.setattr(footers, "footers", lambda *a: footers.listed(spark, path).select("path", *[F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in footers.FOOTER.split(", ")[1:]) if c != "known"], F.lit(False).alias("known")))
        for most in (footers.NAMED, 1):
            m.setattr(footers, "NAMED", most)
            assert sorted(map(tuple, footers.file_ranges(spark, path, "id").collect())) == want


@pytest.mark.parametrize("kind", ["long", "string"])
def test_key_summaries_open_the_files_that_hold_keys(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(layout, "KEYS", 3)
    monkeypatch.setattr(layout, "SUMMARY_BYTES", 8192)
    key = F.col("id").cast(kind) if kind == "long" else F.format_string("k%05d", "id")
    spark.range(4000).select(key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(16)).alias("g")).repartition("g").write.partitionBy("g").parquet(f"{tmp_path}/t")
    path = f"{tmp_path}/t"
    summaries = layout.key_summaries(spark, path, "k").cache()
    piece = spark.range(9).select((F.col("id") * 401 + 7).alias("id")).select(key.alias("k")).union(spark.createDataFrame([(None,)], f"k {kind}")).repartition(3)
    placed = spark.read.parquet(path).select("k", F.col("_metadata.file_path").alias("p"))
    holding = {r.p for r in placed.join(piece, "k").collect()}
    found = {r.path for r in layout.files_that_may_hold(summaries, piece, "k").collect()}
    assert holding <= found and len(found) <= len(holding) + 1 < 16
    rows, cost = layout.probe(spark, path, piece, "k", summaries)
    whole, all_files = layout.probe(spark, path, piece, "k")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, whole.collect())) and sum(r.n_rows for r in rows.collect()) == 9
    c, a = cost.first(), all_files.first()
    assert c.files_opened == len(found) and a.files_opened == a.files == c.files == 16 and c.bytes_opened < a.bytes_opened == c.bytes
    assert layout.files_that_may_hold(summaries, piece.limit(0), "k").count() == 0
    none = spark.createDataFrame([(str(10**6) if kind == "string" else 10**6,)], "k string").select(F.col("k").cast(kind).alias("k"))
    rows, cost = layout.probe(spark, path, none, "k", summaries)
    assert rows.count() == 0 and cost.first().files_opened == 0
