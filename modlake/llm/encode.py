"""Token ids of many texts by a tokenizers file, each distinct segment encoded once per worker.

A text is cut only where no token can span the cut, so the ids are those of the whole text:
at white space for tokenizers that drop it, and before a single space, or around a single line
feed, between other characters for byte-level ones, which attach the space to the word that
follows; and between a letter or digit and the marks at the end of a segment, if the tokenizer's normal form of that
letter still ends in a letter or digit (the capital I with a dot is lower-cased to an i and a combining mark, which
the tokenizer joins to the marks that follow). A text with any other white space, or with the string of a special
token, is encoded whole.
"""

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct segments that a worker remembers before it starts afresh (about 150 bytes each).
REMEMBERED = 800_000
#: Marks that are cut off the end of a word, so that a word is encoded once whatever follows it.
MARKS = ".,!?;:*$%&#|"
#: Stands for a line feed between segments, or apart from them between two; what holds it itself is encoded by itself.
LINE_MARK = "\ue000"

_encoders: dict[tuple[str, float], "SegmentEncoder"] = {}


def encoder(path: str, times: float = 1) -> "SegmentEncoder":
    """The encoder of this worker process for a tokenizers file; it remembers `times` the usual number of segments."""
    if (path, times) not in _encoders:
        _encoders[path, times] = SegmentEncoder(path, times)
    return _encoders[path, times]


class SegmentEncoder:
    def __init__(self, path: str, times: float = 1):
        self.times = times
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        config = json.loads(self.tok.to_str())
        self.special = [t["content"] for t in config["added_tokens"]]
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.drops_space = r"\s+" in json.dumps(config["normalizer"], ensure_ascii=False).replace("\\\\", "\\")
        self.lowers = "Lowercase" in json.dumps(config["normalizer"])
        self.open_ends = self._open_ends()
        self.mark_ids = self.tok.encode(LINE_MARK, add_special_tokens=False).ids
        self.id_bytes = None if self.drops_space else self._id_bytes()
        self._forget()

    def _open_ends(self) -> str:
        """Letters and digits whose normal form ends in something else, so that marks after them may belong to it."""
        if self.tok.normalizer is None:
            return ""
        normal, kind = self.tok.normalizer.normalize_str, unicodedata.category
        solid = (c for c in map(chr, range(0x80, 0x110000)) if kind(c)[0] in "LN")
        return "".join(c for c in solid if kind((normal(c) or " ")[-1])[0] not in "LN")

    def _id_bytes(self) -> np.ndarray:
        """How many bytes of a text each id stands for, in a byte-level vocabulary, whose tokens have one character a byte."""
        sizes = np.zeros(self.size, np.int64)
        for token, at in self.tok.get_vocab(with_added_tokens=True).items():
            sizes[at] = len(token.encode()) if token in self.special else len(token)
        return sizes

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(8192, np.uint32), 0

    def _segment_numbers(self, segments: list[str]) -> np.ndarray:
        """Places of segments in the table of known ones; new ones are encoded."""
        if len(self.known) + len(segments) > REMEMBERED * self.times:
            self._forget()
        known = self.known
        places = [*map(known.get, segments)]
        new = list(dict.fromkeys(s for s, place in zip(segments, places) if place is None))
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            flat, lengths = (self._joined(part) if self.drops_space else self._run(part)) or self._one_by_one(part)
            n = len(known)
            self.starts, self.lengths = _grown(self.starts, n + len(part)), _grown(self.lengths, n + len(part))
            self.flat = _grown(self.flat, self.used + len(flat))
            self.flat[self.used : self.used + len(flat)] = flat
            self.starts[n : n + len(part)] = self.used + np.cumsum(lengths) - lengths
            self.lengths[n : n + len(part)] = lengths
            self.used += len(flat)
            known.update(zip(part, range(n, n + len(part))))
        return np.array([known[s] if place is None else place for s, place in zip(segments, places)] if new else places, np.int64)

    def _one_by_one(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids of each) of segments."""
        ids = [e.ids for e in self.tok.encode_batch_fast(segments, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for y in ids for x in y), np.uint32, int(lengths.sum())), lengths

    def _joined(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same by one call, for tokenizers that drop white space: segments apart by a mark between spaces, whose ids tell where each ends.

        None where that cannot be told, as a segment holds the mark itself.
        """
        ids = np.array(self.tok.encode_batch_fast([f" {LINE_MARK} ".join(segments)], add_special_tokens=False)[0].ids, np.uint32)
        mark = self.mark_ids
        at = np.flatnonzero(np.all([ids[k : len(ids) - len(mark) + 1 + k] == m for k, m in enumerate(mark)], axis=0)) if len(ids) >= len(mark) else np.zeros(0, np.int64)
        if len(at) != len(segments) - 1:
            return None
        lengths = np.diff(np.concatenate([[0], at + len(mark), [len(ids)]]))
        lengths[:-1] -= len(mark)
        kept = np.ones(len(ids), bool)
        kept[(at[:, None] + np.arange(len(mark))).ravel()] = False
        return ids[kept], lengths

    def _run(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same by one call, for byte-level tokenizers: each segment after a line feed, whose ids' bytes tell where each ends.

        None where white space at the ends of a segment would join the line feed, or ids end elsewhere than segments.
        """
        if any(not s or s.removeprefix(" ") != s.strip() for s in segments):
            plain = [bool(s) and s.removeprefix(" ") == s.strip() for s in segments]
            return self._apart(segments, plain) if any(plain) else None
        text = "\n" + "\n".join(segments)
        ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        sizes = np.fromiter((len(s.encode()) for s in segments), np.int64, len(segments))
        ends, wanted = np.cumsum(self.id_bytes[ids]), np.cumsum(sizes + 1)
        last = np.searchsorted(ends, wanted)  # of each segment
        feeds = np.searchsorted(ends, wanted - sizes)
        if not len(ids) or ends[-1] != wanted[-1] or (ends[last] != wanted).any() or (ends[feeds] != wanted - sizes).any():
            return None
        kept = np.ones(len(ids), bool)
        kept[feeds] = False
        return ids[kept], last - feeds

    def _apart(self, segments: list[str], plain: list[bool]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of segments of which only the plain ones can stand in one text."""
        of = [np.flatnonzero(plain), np.flatnonzero(~np.array(plain))]
        parts = [[segments[k] for k in at] for at in of]
        run = self._run(parts[0])
        if run is None:
            return None
        found = [run, self._one_by_one(parts[1])]
        lengths = np.zeros(len(segments), np.int64)
        starts = np.zeros(len(segments), np.int64)
        base = 0
        for at, (flat, n) in zip(of, found):
            lengths[at], starts[at] = n, base + np.cumsum(n) - n
            base += len(flat)
        flat = np.concatenate([f for f, _ in found])
        ends = np.cumsum(lengths)
        return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(lengths.sum())], lengths

    def _pieces(self, segments: pa.Array) -> np.ndarray:
        """For each segment the numbers of its stem and of the marks after it, either of which may be empty."""
        stems = pc.utf8_rtrim(segments, MARKS)
        cut = pc.match_substring_regex(stems, r"[\p{L}\p{N}]$")
        if self.open_ends:
            cut = pc.and_not(cut, pc.match_substring_regex(stems, f"[{self.open_ends}]$"))
        tails = pc.extract_regex(segments, f"(?P<t>[{MARKS}]+)$").field(0)
        tails = pc.fill_null(pc.if_else(cut, tails, pa.scalar(None, tails.type)), "").dictionary_encode()
        stems = pc.if_else(cut, stems, segments).to_numpy(zero_copy_only=False).tolist()
        numbers = self._segment_numbers(stems + tails.dictionary.to_pylist())
        return np.stack([numbers[: len(stems)], numbers[len(stems) :][tails.indices.to_numpy()] if len(stems) else numbers], axis=1)

    def _expand(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known segments in a row, and where each begins, and the end."""
        lengths = self.lengths[numbers]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.flat[np.repeat(self.starts[numbers] - ends[:-1], lengths) + np.arange(ends[-1])], ends

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of text k are ids[offsets[k]:offsets[k + 1]]. A null is empty."""
        texts = own_texts(texts)
        odd = np.zeros(len(texts), bool)
        for s in self.special + ([] if self.drops_space else [LINE_MARK]):
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if self.drops_space:
            lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if self.lowers else texts)
        else:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", f" {LINE_MARK} "), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes, segments = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        starts, counts = offsets[:-1] - offsets[0], np.diff(offsets)
        if self.drops_space:
            keys = codes
        else:
            blank = pc.match_substring_regex(segments, r"^$|^[\s\p{Z}\x0b\x1c-\x1f\x{85}]|[\s\p{Z}\x0b\x1c-\x1f\x{85}]$").to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(counts)), counts)
            odd[doc[blank[codes]]] = True
            at = pc.index(segments, LINE_MARK).as_py()
            mark = codes == at
            first = np.zeros(len(codes), bool)
            first[starts[counts > 0]] = True
            first[1:] |= mark[:-1]
            keys = codes * 2 + (first | mark)
            keys[odd[doc]] = keys[0] if len(keys) else 0  # whole texts come below
            # the pieces that occur, with the space before them where there is one
            present = np.flatnonzero(np.bincount(keys, minlength=2 * len(segments)))
            spaced = pc.if_else(pa.array(present & 1 == 1), "", " ").cast(pa.large_string())
            words = pc.replace_with_mask(segments, pc.equal(segments, LINE_MARK), pa.scalar("\n", pa.large_string())) if at >= 0 else segments
            segments = pc.binary_join_element_wise(spaced, words.take(pa.array(present >> 1)), pa.scalar("", pa.large_string()))
            place = np.zeros(2 * len(coded.dictionary), np.int64)
            place[present] = np.arange(len(present))
            keys = place[keys]
        pieces = self._pieces(segments)
        flat, ends = self._expand(pieces.ravel())
        starts_of, lengths_of = ends[:-1:2], self.lengths[pieces].sum(axis=1)
        lengths = lengths_of[keys]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.repeat(starts_of[keys] - ends[:-1], lengths) + np.arange(ends[-1])]
        out = np.concatenate([ends[starts], ends[-1:]]) if len(starts) else np.zeros(1, np.int64)
        if odd.any():
            parts = [ids[a:b] for a, b in zip(out[:-1], out[1:])]
            for k in np.flatnonzero(odd):
                parts[k] = np.array(self.tok.encode(texts[int(k)].as_py(), add_special_tokens=False).ids, np.uint32)
            ids = np.concatenate(parts)
            out = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, out


def own_texts(texts: pa.Array) -> pa.Array:
    """Texts as large strings without nulls, in buffers of their own.

    A cast of a slice keeps the slice's offset, which some Arrow kernels for large strings then misread.
    """
    if texts.offset:
        texts = texts.take(pa.array(np.arange(len(texts))))
    return pc.fill_null(texts, "").cast(pa.large_string())


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    more = np.zeros(max(size, 2 * len(array)), array.dtype)
    more[: len(array)] = array
    return more


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each with end_id after its last id."""
    return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))


def text_slices(batch: pa.RecordBatch, column: str = "text", size: int = 4 << 20, rows: int = 4096):
    """Slices of a batch of about `size` bytes of text at most (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        upto = np.cumsum(lengths[at : at + rows])
        n = max(1, int(np.searchsorted(upto, size, "right")))
        yield batch.slice(at, n)
        at += n
