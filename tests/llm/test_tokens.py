import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from modlake.llm.encode import SegmentEncoder, text_slices, with_end  # noqa: E402
from modlake.llm.packing import best_cuts, pack, powers_of_two  # noqa: E402
from modlake.llm.token_store import file_bytes, pack_bits, parse, read_ids, read_tokens, unpack_bits, width, write_tokens  # noqa: E402

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "One two, three.\nFour  five", None, "", " ", "\n", "a\n\nb", "a \n b", " lead", "trail ", "tab\tin\x0bside\r\nx", "no break 　wide sep",
    "naïve Éa é İ ß", "<|endoftext|> x<|endoftext|>y", "mark  in", "x" * 5000, "don't it's 'tis 123 4,5", "日本 語 テキスト", "a\nb\nc d", "Ω\x1cfoo \x85bar",
    "word " * 3000, "end.\nNext one! And? Yes.",
]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_segments_give_the_ids_of_whole_texts(path, monkeypatch):
    tok = Tokenizer.from_file(path)
    enc = SegmentEncoder(path)
    assert enc.drops_space == (path == WORD)
    for texts in (TEXTS, TEXTS[::-1], [], [None, ""], ["a b"]):
        ids, offsets = enc.encode(pa.array(texts, pa.string()))
        assert len(offsets) == len(texts) + 1
        for k, t in enumerate(texts):
            assert ids[offsets[k] : offsets[k + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids, repr(t)
    many = pa.array(TEXTS * 30, pa.string()).slice(31, 200)
    ids, offsets = enc.encode(many)
    for k, t in enumerate(many.to_pylist()):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids, repr(t)
    monkeypatch.setattr("modlake.llm.encode.REMEMBERED", 3)  # forgetting changes nothing
    ids, offsets = enc.encode(pa.array(["p q r s t", "p q"]))
    assert ids[offsets[1] :].tolist() == tok.encode("p q", add_special_tokens=False).ids


def test_byte_level_segments_are_encoded_in_few_calls():
    tok = Tokenizer.from_file(BYTE)
    enc = SegmentEncoder(BYTE)

    class Counting:
        texts = 0

        def encode_batch_fast(self, texts, **how):
            Counting.texts += len(texts)
            return tok.encode_batch_fast(texts, **how)

    enc.tok = Counting()
    words = [f"{a}{k}{b}" for k in range(3000) for a, b in (("x", ""), ("é'", "'s"), ("(", "-!"))]
    text = " ".join(words[:6000]) + "\n" + "\n".join(words[6000:])
    ids, _ = enc.encode(pa.array([text]))
    assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids
    assert Counting.texts < 20
    enc.tok = tok
    segments = ["a", "", " b", " ", "\n", "c ", "  d", "\x1ce", "ß", " \u3000", "f\tg"]
    lengths = [len(tok.encode(s, add_special_tokens=False).ids) for s in segments]
    flat, found = enc._run(segments)
    assert found.tolist() == lengths and flat.tolist() == [x for s in segments for x in tok.encode(s, add_special_tokens=False).ids]


def test_with_end_and_slices():
    ids, offsets = with_end(np.array([5, 6, 7], np.uint32), np.array([0, 2, 2, 3]), 2)
    assert ids.tolist() == [5, 6, 2, 2, 7, 2] and offsets.tolist() == [0, 3, 4, 6]
    batch = pa.record_batch([pa.array(["aa", None, "b" * 50, "", "c"])], names=["text"])
    parts = [s.column(0).to_pylist() for s in text_slices(batch, size=10)]
    assert sum(parts, []) == batch.column(0).to_pylist() and len(parts) > 2


def test_best_cuts_against_all_plans():
    rng = np.random.default_rng(0)
    for _ in range(200):
        length = 8
        steps = rng.integers(1, 6, rng.integers(1, 9))
        pos, costs = np.cumsum(steps).tolist(), rng.choice([0, 2, 9], len(steps)).tolist()
        total = pos[-1] + int(rng.integers(0, 5))

        def price(plan):
            ends = [0, *(pos[k] for k in plan)]
            if any(b - a > length for a, b in zip(ends, ends[1:])) or total - ends[-1] >= length:
                return None
            return sum(length - (b - a) for a, b in zip(ends, ends[1:])) + sum(costs[k] for k in plan) + ends[-1]

        prices = [p for n in range(len(pos) + 1) for plan in itertools.combinations(range(len(pos)), n) if (p := price(plan)) is not None]
        if not prices:
            continue
        cuts = best_cuts(pos, costs, length, total, True)
        assert price([pos.index(c) for c in cuts]) == min(prices)


def test_powers_of_two():
    assert powers_of_two(10, 13) == [18, 22, 23] and powers_of_two(0, 0) == []


@pytest.mark.parametrize("segment", [1 << 19, 300])
def test_packing_keeps_every_id_once(spark, segment):
    texts = [*TEXTS, "A sentence of some words here. " * 40, "many! " * 500] * 2
    rows = [(k % 30 if k % 11 else None, t, "x", k) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, row int").coalesce(2)
    got = pack(df, WORD, length=256, segment=segment, sentence_cost=1, inner_cost=8).toPandas()
    tok = Tokenizer.from_file(WORD)
    want = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    streams = {}
    for s, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        ids = b"".join(part["ids"])
        assert part["offset"].tolist() == [0, *np.cumsum(part["length"])[:-1]]
        assert len(ids) == 4 * part["length"].sum() <= 4 * 256
        streams.setdefault(s >> 33, []).append((s, ids))
    stream = b"".join(ids for p in sorted(streams) for _, ids in sorted(streams[p]))
    assert stream == np.array(sum(want, []), "<u4").tobytes()
    fill = got.groupby("sequence_id")["length"].sum()
    padding = sum(256 - n for n in fill if n & (n - 1))
    assert padding < 0.03 * fill.sum()
    ends = (got["start"] + got["length"] == got["doc_tokens"]).sum()
    assert ends == len(texts)
    assert pack(df.limit(0), WORD).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 8, 11, 16, 17, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1003, dtype=np.uint64).astype(np.uint32)
    data = pack_bits(ids, bits)
    assert len(data) == -(-1003 * bits // 8)
    assert (unpack_bits(data, bits, 1003) == ids).all()
    assert width(2**bits) == bits


def test_file_round_trip_and_random_access(tmp_path):
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 5000, 1000).astype(np.uint32)
    content = file_bytes(np.array([4, -(1 << 63)]), np.array([True, False]), np.array([0, 300, 1000]), ids, 13, 128)
    docs, nulls, starts, back = parse(content)
    assert docs.tolist() == [4, -(1 << 63)] and nulls.tolist() == [True, False] and starts.tolist() == [0, 300, 1000] and (back == ids).all()
    (tmp_path / "x.ids").write_bytes(content)
    for a, n in [(0, 1000), (127, 2), (128, 128), (999, 1), (500, 0), (300, 333)]:
        assert (read_ids(f"file://{tmp_path}/x.ids", a, n) == ids[a : a + n]).all()
    with pytest.raises(ValueError):
        read_ids(f"file://{tmp_path}/x.ids", 990, 11)


def test_token_store_round_trip(spark):
    rows = [((k * 7) % 40 if k % 9 else None, t, "x") for k, t in enumerate(TEXTS + TEXTS)] + [(-(1 << 63), "the least id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string").repartition(3)
    manifest = write_tokens(df, BYTE, file_ids=3000, part_bytes=4000)
    assert manifest.count() > 2
    tok = Tokenizer.from_file(BYTE)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for d, t, _ in order:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for limit in (100, 0):
        got = sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in read_tokens(spark, manifest, limit).collect()), key=lambda r: r[1])
        assert got == want
    assert read_tokens(spark, write_tokens(df.limit(0), BYTE)).count() == 0


def test_files_of_lost_attempts_do_not_count(spark):
    df = spark.createDataFrame([(k, f"text number {k}") for k in range(50)], "doc_id long, text string")
    manifest = write_tokens(df, BYTE, file_ids=100, part_bytes=300)
    want = sorted(map(tuple, read_tokens(spark, manifest).collect()))
    file = manifest.first()["file"].removeprefix("file:")
    with open(file, "rb") as f, open(file.replace(".ids", "9.ids"), "wb") as lost:
        lost.write(f.read())
    assert sorted(map(tuple, read_tokens(spark, manifest).collect())) == want and len(want) == 50


def test_token_store_refuses_ids_that_are_no_whole_numbers(spark):
    with pytest.raises(TypeError):
        write_tokens(spark.createDataFrame([("a", "text")], "doc_id string, text string"), BYTE)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_odd_letters_before_marks(path):
    rng = np.random.default_rng(7)
    # letters whose lower case or composed form is several code points, combining marks, digits of other scripts
    letters = [*"abcZÉéİıßſǅΣσςŉẞﬁΐὰ日本٣½Ⅷ aA1 .,!?;:*$%&#|'-_\n", "̇", "́", "क़", "ਲ਼", "שׁ", "གྷ", " "]
    texts = ["GAZİ, geldi", "İ.", "ALİ! dedi", *("".join(rng.choice(letters, rng.integers(1, 24))) for _ in range(12000))]
    enc = SegmentEncoder(path)
    ids, offsets = enc.encode(pa.array(texts))
    for k, want in enumerate(enc.tok.encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == want.ids, ascii(texts[k])


def whole(df, got, length):
    """Each id of the documents in exactly one piece, each window gapless from 0 and full or a power of two."""
    tok = Tokenizer.from_file(WORD)
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append(r)
    for rows in windows.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0, *(r.length for r in rows)])[:-1].tolist()
        assert sum(r.length for r in rows) <= length
    held = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.ids, r.doc_tokens) for r in got)
    want = []
    for d, t in df.collect():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        mine = [h for h in held if h[:2] == (d is not None, d or 0)]
        assert b"".join(h[3] for h in mine) == ids and all(h[4] == len(ids) // 4 for h in mine), (d, t)
        want.append(d)
    assert {r.doc_id for r in got} == set(want)
    return windows


@pytest.mark.parametrize(
    "texts", [[None], [None, ""], ["plain text."], ["a", None], [""], ["word " * 15], ["word " * 31], ["word " * 63, "word " * 63], ["word " * 4096 * 3], ["a"] * 8, ["a b c"] * 4]
)
def test_packing_of_one_window(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    windows = whole(df, pack(df, WORD, length=64).collect(), 64)
    assert all(n & (n - 1) == 0 for n in [sum(r.length for r in windows[max(windows)])])


@pytest.mark.parametrize("parts", [2, 7, 40])
def test_packing_of_tiny_partitions(spark, parts):
    rows = [(k, None if k % 5 == 0 else "word " * (k % 17)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    whole(df, pack(df, WORD, length=64).collect(), 64)


def test_packing_with_little_memory_keeps_ids_and_cuts(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{i * 7 + j}" for j in range(20)) + ".") for i in range(60)], "doc_id long, text string").coalesce(1)
    ample = pack(df, WORD, length=64).collect()
    assert pack(df, WORD, length=64, times=5 / 800_000, slice_bytes=200).collect() == ample
