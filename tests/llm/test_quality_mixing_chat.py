import itertools
import math
import unicodedata
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from modlake.llm import mixing, quality
from modlake.llm.preference import format_preferences, paired_with_next_answered

GOOD = ["The plain words of this text make sentences, and they end. So it goes on for a while.", "Another text of ordinary words is here. It has commas, too."]
BAD = ["BUY!! NOW!! CHEAP!! OFFER!! LAST!! CALL!!", "alpha*** beta&&& gamma%%% delta### eps*** zeta$$$ eta&&&", "one | two | three | four | five | six | seven | eight"]


def corpus(n):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        good = i % 3 > 0
        words = (GOOD if good else BAD)[i % 2].split(" ")
        rows.append((i, " ".join(rng.permutation(words).tolist() * int(rng.integers(1, 4))), int(good)))
    return rows


def test_rules_are_the_paths_of_a_tree():
    text = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=14
  If (feature 0 <= 1.5)
   If (feature 3 <= 0.25)
    Predict: 0.0
   Else (feature 3 > 0.25)
    Predict: 1.0
  Else (feature 0 > 1.5)
   Predict: 1.0
"""
    found = [r.conditions for r in quality.rules_of(text, quality.NAMES)]
    a, b = ("log_chars", False, 1.5), ("upper_share", False, 0.25)
    assert found == [(a,), (a, b), (a, ("upper_share", True, 0.25)), (("log_chars", True, 1.5),)]


def test_statistics_are_never_null(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("\n\n",), ("É " * 9000,), ("Two words.",)], "text string")
    stats = quality.statistics(F.col("text"))
    assert list(stats) == quality.NAMES
    rows = df.select(*[c.alias(n) for n, c in stats.items()]).collect()
    assert all(x is not None and np.isfinite(x) for r in rows for x in r)


def slow_statistics(text):
    t = text or ""
    words, lines = regex.split("[ \\n]+", t), t.split("\n")
    n, c = len(words), max(len(t), 1)
    count = lambda p: len(regex.findall(p, t))
    return {
        "log_chars": math.log1p(len(t)), "word_length": len(t) / n, "line_length": math.log1p(len(t) / len(lines)), "upper_share": sum(unicodedata.category(x) == "Lu" for x in t) / c,
        "digit_share": sum(x in "0123456789" for x in t) / c, "symbol_share": sum(x in "#$%&*|<>{}=+~^_@\\/[]" for x in t) / c, "exclaimed": t.count("!") / n, "stops": t.count(".") / n,
        "commas": t.count(",") / n, "bars": t.count("|") / n, "repeated_marks": count(r"([!-/:-@])\1") / n,
        "short_words": sum(0 < len(w) < 4 and all(unicodedata.category(x)[0] == "L" for x in w) for w in words) / n, "distinct_words": len(set(words)) / n, "distinct_lines": len(set(lines)) / len(lines),
    }


def test_statistics_and_rule_scores_against_plain_python(spark):
    texts = ["Plain words, and a stop. Another one!", "BUY!! N0W ### 10% | a | b\n\nsame\nsame", "  É à ñandú  x", "", None, "a " * 5000 + "B??"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    rules = (quality.Rule((("upper_share", True, 0.1), ("stops", False, 0.2))), quality.Rule((("log_chars", True, 3.0),)), quality.Rule((("bars", True, 0.0),)))
    model = quality.RuleModel(rules, (1.5, -0.75, 0.25), 0.3)
    stats = df.select("k", *[c.alias(n) for n, c in quality.statistics(F.col("text")).items()])
    for r in stats.withColumn("score", model.score()).collect():
        want = slow_statistics(texts[r.k])
        assert {n: r[n] for n in quality.NAMES} == pytest.approx(want)
        logit = 0.3 + 1.5 * (want["upper_share"] > 0.1 and want["stops"] <= 0.2) - 0.75 * (want["log_chars"] > 3) + 0.25 * (want["bars"] > 0)
        assert r.score == pytest.approx(1 / (1 + math.exp(-logit)))


def test_keep_good_keeps_columns_named_like_statistics(spark):
    rows = corpus(120)
    docs = spark.createDataFrame([(d, t, f"own{d}", 2.5) for d, t, _ in rows], "doc_id long, text string, stops string, BARS double")
    kept = quality.keep_good(docs, spark.createDataFrame([(d, q) for d, _, q in rows], "doc_id long, quality int"))
    assert kept.columns == docs.columns and all(r.stops == f"own{r.doc_id}" and r.BARS == 2.5 for r in kept.collect())


def test_classifier_on_held_out_rows_and_compiled_form(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(d, t, "x") for d, t, _ in rows] + [(900, None, "x"), (None, "A null id. It is scored.", "x"), (1, rows[1][1], "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(d, q) for d, _, q in rows] + [(901, None), (902, 7)], "doc_id long, quality int")
    out = {(r.doc_id): r for r in quality.classify(docs, labels).collect()}
    assert len(out) == 402
    for d, _, q in rows:
        assert out[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
    held = [(out[d].predicted, q) for d, _, q in rows if out[d].held_out]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.values())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    good = sorted(str(r.doc_id) for r in kept.collect())
    assert good == sorted([str(d) for d, r in out.items() if r.predicted] + ["1"] * out[1].predicted)


def test_classifier_without_both_classes(spark):
    docs = spark.createDataFrame([(k, "text") for k in range(9)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(k, 1) for k in range(9)], "doc_id long, quality int")
    assert all(r.score > 0.7 for r in quality.classify(docs, ones).collect())
    assert quality.classify(docs.limit(0), ones.limit(0)).count() == 0


def doc_rows(n):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(n):
        s, g = ("big" if rng.random() < 0.6 else f"s{i % 3}"), ("en" if rng.random() < 0.7 else "de")
        rows.append((i, "w " * int(rng.integers(1, 300)) + ("a | b" if i % 4 == 0 else ""), g, s, "clash"))
    return rows + [(None, "x y", None, None, "clash"), (5000, None, "en", "big", "clash"), (5001, "", "en", "big", "clash")]


def test_raking_reaches_the_marginals_and_the_sample_the_budget(spark):
    schema = "doc_id long, text string, lang string, source string, tokens string"
    docs = spark.createDataFrame(doc_rows(3000), schema)
    targets = {"source": {"big": 1, "s0": 1, "s1": 1, "s2": 1}, "lang": 0.0, "topic": 1.0}
    out = mixing.mix(docs, targets, fraction=0.5).toPandas()
    assert list(out.columns[:5]) == docs.columns
    assert "" not in set(out["source"].fillna(""))  # the null source has no weight
    total = sum(len((t or "").split()) for _, t, *_ in doc_rows(3000))
    assert abs(out["n_tokens"].sum() / total - 0.5) < 0.05
    mass = out["n_tokens"] * out["weight"]
    for column, want in (("source", 0.25), ("lang", 0.5)):
        share = mass.groupby(out[column]).sum() / mass.sum()
        assert (share - want).abs().max() < 0.05
    again = mixing.mix(docs.repartition(7), targets, fraction=0.5).toPandas()
    assert sorted(map(str, again["doc_id"])) == sorted(map(str, out["doc_id"]))
    assert mixing.mix(docs.limit(0)).count() == 0


def slow_mix(cells, targets, fraction, rounds=500):
    """Probabilities of cells {(source, lang, topic): tokens} by plain loops."""
    total, raked = sum(cells.values()), dict(cells)
    shares = []
    for d, t in enumerate(targets):
        own = {}
        for c, n in cells.items():
            own[c[d]] = own.get(c[d], 0) + n
        weight = {v: (t.get(v, 0) if isinstance(t, dict) else n**t if n else 0) for v, n in own.items()}
        shares.append({v: w / sum(weight.values()) for v, w in weight.items()})
    for _ in range(rounds):
        for d in range(3):
            held = {}
            for c, x in raked.items():
                held[c[d]] = held.get(c[d], 0) + x
            raked = {c: x * shares[d][c[d]] / held[c[d]] if held[c[d]] else 0 for c, x in raked.items()}
    lo, hi = 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(cells[c], mid * x) for c, x in raked.items()) < fraction * total else (lo, mid)
    return {c: min(1.0, hi * raked[c] / n) if n else 1.0 for c, n in cells.items()}


@pytest.mark.parametrize("few", [100_000, 0])
def test_probabilities_against_plain_raking(spark, few, monkeypatch):
    monkeypatch.setattr(mixing, "FEW_CELLS", few)
    rng = np.random.default_rng(9)
    rows = [(k, "w " * int(rng.integers(1, 50)), ["en", "de", None][k % 3 if k % 7 else 0], f"s{k % 4}", f"t{k * k % 5}") for k in range(400)] + [(900, None, "xx", "s0", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    cells = {}
    for _, t, g, s, o in rows:
        c = (s or "", g or "", o or "")
        cells[c] = cells.get(c, 0) + len((t or "").split())
    targets = {"source": {"s0": 3, "s1": 1, "s2": 1, "s3": 1}, "lang": 0.5, "topic": 0.0}
    want = slow_mix(cells, list(targets.values()), 0.7)
    out = mixing.mix(docs, targets, fraction=0.7, rounds=60 if not few else 500, tolerance=1e-9)
    assert out.columns == [*docs.columns, "n_tokens", "probability", "weight"]
    for r in out.collect():
        assert abs(r.probability - want[(r.source or "", r.lang or "", r.topic or "")]) < 1e-5
    assert out.count() > 200


def test_columns_of_clashing_names_stay(spark):
    docs = spark.createDataFrame([(k, "w " * 30, "en", "s", f"own{k % 2}", "n", "p", 1.5) for k in range(50)], "doc_id long, text string, lang string, source string, topic string, n_tokens string, probability string, W double")
    out = mixing.mix(docs, {"topic": {"own0": 1}}, fraction=0.5)
    assert out.columns == [*docs.columns, "n_tokens_", "probability_", "weight"]
    rows = out.collect()
    assert {r.topic for r in rows} == {"own0"} and {(r.n_tokens, r.probability, r.W, r.n_tokens_) for r in rows} == {("n", "p", 1.5, 30)}


def test_targets_that_cannot_be_met_are_logged(spark, caplog):
    docs = spark.createDataFrame([(1, "a b", "en", "s0", "x"), (2, "a b", "de", "s1", "y")], "doc_id long, text string, lang string, source string, topic string")
    mixing.mix(docs, {"source": {"s0": 1, "s1": 3}, "lang": {"en": 1, "de": 1}}).count()
    assert "cannot all be met" in caplog.text


def test_calibration_against_a_search_for_the_scale():
    rng = np.random.default_rng(2)
    for fraction in (0.1, 0.6, 0.95):
        tokens, raked = rng.integers(1, 100, 12).astype(float), rng.random(12) * 50
        probability, weight = mixing.calibrate(tokens, raked, fraction)
        lo, hi = 0.0, 1e9
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (tokens * np.minimum(1, mid * raked / tokens)).sum() < fraction * tokens.sum() else (lo, mid)
        want = np.minimum(1, hi * raked / tokens)
        assert np.allclose(probability, want, atol=1e-6) and np.allclose(weight, np.maximum(1, hi * raked / tokens), atol=1e-6)


def turns(rows):
    return [(p, s, k, r, t) for p, s, conv in rows for k, (r, t) in enumerate(conv)]


def test_preferences_share_their_prefix_once(spark):
    a, b = [("user", "Hi"), ("assistant", "Yes"), ("user", "Why?"), ("assistant", "So.")], [("user", "Hi"), ("assistant", "Yes"), ("user", "Why?"), ("assistant", "No"), ("user", "ok")]
    rows = turns([(1, "chosen", a), (1, "rejected", b), (2, "chosen", a), (2, "rejected", a), (3, "chosen", a), (4, "chosen", [(None, None)]), (4, "rejected", [("", "")]), (5, "chosen", a), (5, "rejected", a[:2]), (None, "chosen", a), (None, "rejected", b)])
    df = spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string").withColumn("prompt", F.lit(1)).repartition(3)
    got = {r.pair_id: r for r in format_preferences(df).collect()}
    show = lambda conv: "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in conv)
    assert set(got) == {1, 2, 3, 4, 5}
    for p, c, r in [(1, a, b), (2, a, a), (3, a, []), (4, [(None, None)], [("", "")]), (5, a, a[:2])]:
        same = lambda x, y: (x[0] or "", x[1] or "") == (y[0] or "", y[1] or "")
        n = sum(1 for _ in itertools.takewhile(lambda z: same(*z), zip(c, r)))
        assert (got[p].n_prompt_turns, got[p].prompt, got[p].chosen, got[p].rejected) == (n, show(c[:n]), show(c[n:]), show(r[n:]))
        for text, mask, rest in ((got[p].chosen, got[p].chosen_mask, c[n:]), (got[p].rejected, got[p].rejected_mask, r[n:])):
            assert sum(m.length for m in mask) == len(text)
            at, parts = 0, []
            for m in mask:
                parts += [text[at : at + m.length]] if m.trained else []
                at += m.length
            assert parts == [f"{t}<|end|>\n" for role, t in rest if role == "assistant"]


def test_every_answered_conversation_makes_a_pair(spark):
    rows = [(3, 0, "user", "only")] + [(k * k * 7 + 5, t, "assistant" if t else "user", f"{t}-{k}") for k in range(40) for t in range(2)] + [(None, 0, "assistant", "n"), (10**9, 0, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    want = {k * k * 7 + 5: f"1-{(k + 1) % 40}" for k in range(40)}
    for part_bytes in (1, 30, 1 << 20):
        got = [r for r in paired_with_next_answered(df, part_bytes).collect() if r.role == "assistant" and r.side == "rejected"]
        assert len(got) == 40 and {r.pair_id: r.text for r in got} == want
    assert [r.text for r in paired_with_next_answered(df.where("conv_id = 5")).where("role = 'assistant'").collect()] == ["1-0", "1-0"]
    assert paired_with_next_answered(df.limit(0)).count() == 0


def test_preferences_of_very_long_texts_and_clashing_columns(spark):
    long = "word " * 200_000
    rows = [(1, s, k, r, t, "own", "own") for s, end in (("chosen", "yes"), ("rejected", long)) for k, (r, t) in enumerate([("user", long), ("assistant", end)])]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string, c string, n_prompt_turns string")
    r = format_preferences(df).first()
    assert r.n_prompt_turns == 1 and len(r.prompt) > 1_000_000 and r.chosen.startswith("<|assistant|>") and len(r.rejected) > 1_000_000


def test_op5_sql_pairs_across_gaps_of_ids(spark):
    duckdb = pytest.importorskip("duckdb")
    from modlake.llm import queries

    rows = [(k, t, "assistant" if t else "user", f"{t}-{k}") for k in (10, 20, 30, 47) for t in range(2)] + [(25, 0, "user", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = con.sql(queries.OP5_SQL)
    place = {c: k for k, c in enumerate(want.columns)}
    import tempfile

    folder = tempfile.mkdtemp(prefix="modlake-test-")
    df.write.parquet(f"{folder}/conversations.parquet")
    got = queries.op5_preference_format(spark, folder)
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[place[c]] for c in got.columns) for r in want.fetchall())
    assert got.count() == 4


def test_token_count_makes_no_array_of_words(spark):
    from modlake.llm.mixing import token_count

    texts = [None, "", " ", "\n\t ", "a", " a", "a ", "a b\x0bc\x0cd\re", "\x0b", "x x  ", "日本 語\u3000 z", " \x85 a\x1cb", "word " * 9000]
    counted = spark.createDataFrame([(t,) for t in texts], "text string").select("text", token_count(F.col("text")).alias("n"))
    assert [r.n for r in counted.collect()] == [len(regex.findall(r"[^ \t-\r]+", r.text or "")) for r in counted.collect()]
    assert "regexp_count" not in str(token_count(F.col("text")))
