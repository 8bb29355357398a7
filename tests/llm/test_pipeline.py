import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver tables")


def test_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    from modlake.llm.store import stored

    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, DATA), "test")
        assert docs.columns == corpus_pipeline.COLUMNS
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] < counts[2] and 0 < counts[4] < counts[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    ends = pieces.where("start + length = doc_tokens").count()
    assert ends == counts[4]
    assert pieces.where("length > 4096 OR octet_length(ids) <> 4 * length").count() == 0


def test_each_stage_against_brute_force(spark):
    """Every stage on the input that it really gets, against a plain version of what it is to do."""
    import hashlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    import math

    from modlake.llm import quality
    from modlake.llm.store import stored
    from tests.llm.test_dedup import brute_lines, slow_kept
    from tests.llm.test_quality_mixing_chat import slow_mix, slow_statistics

    inputs = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        inputs.append(stored(stage(spark, inputs[-1], DATA), "test"))
    texts = [{r.doc_id: r.text for r in df.select("doc_id", "text").collect()} for df in inputs[:5]]

    model = quality.fit(quality.labelled(quality.measured(inputs[0]), spark.read.parquet(f"{DATA}/labels.parquet")))

    def slow_score(text):
        value, logit = slow_statistics(text), model.intercept
        for rule, w in zip(model.rules, model.weights):
            logit += w * all((value[n] > t) == above for n, above, t in rule.conditions)
        return 1 / (1 + math.exp(-logit))

    assert len(model.rules) > 3 and set(texts[1]) == {d for d, t in texts[0].items() if slow_score(t) >= 0.7}

    assert texts[2] == {d: t for d, _, _, t in brute_lines(sorted(texts[1].items()))}

    ids = sorted(texts[2])
    assert sorted(texts[3]) == [ids[k] for k in sorted(slow_kept([texts[2][d] for d in ids]))]

    cell, size = {}, {}
    for r in inputs[3].collect():
        t = r.text or ""
        n = len(t.encode().split())
        form = "table" if " | " in t else "links" if "://" in t else "note" if n < 100 else "article" if n < 400 else "essay"
        cell[r.doc_id] = (r.source or "", r.lang or "", form)
        size[cell[r.doc_id]] = size.get(cell[r.doc_id], 0) + n
    probability = slow_mix(size, [0.5] * 3, 0.8)
    number = lambda d: int(hashlib.md5(f"8:{d}".encode()).hexdigest()[:8], 16) / 2**32
    assert sorted(texts[4]) == sorted(d for d in texts[3] if number(d) < probability[cell[d]])

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got: dict[int, list] = {}
    for r in inputs[5].collect():
        got.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    want = {d: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for d, t in texts[4].items()}
    assert {d: b"".join(x for _, x in sorted(p)) for d, p in got.items()} == want


def test_stages_of_odd_tables(spark):
    """Empty tables, repeated and null ids, null texts and further columns of clashing names go through every stage."""
    import corpus_pipeline
    from modlake.llm.store import stored

    schema = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, topic string, stays string, error string"
    rows = [(k % 7 if k % 5 else None, None if k == 3 else f"Some words of row {k // 2}. And more of them.", None, "s", 1, "own", None, "x", "y") for k in range(20)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, DATA), "test")
            assert name == "packing" or docs.columns == corpus_pipeline.COLUMNS


def test_queries_of_the_entry_point():
    import __spark_entry__ as entry

    found = set(entry.queries())
    assert "pipeline" in found and all(any(q.startswith(f"op{n}_") for q in found) for n in range(1, 11))
    assert set(entry.oracle_sql()) <= found
