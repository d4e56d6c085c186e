"""Token ids of whole texts, with the public tokenizer files.

The tokenizer is a file given by path (a parameter); it is used, never
trained. For a tokenizer that drops white space before it splits (checked on
its own configuration) a text's ids are the ids of its white-space-separated
pieces one after another. Texts are looked at ``PART`` bytes at a time: Arrow
splits them and finds the distinct pieces, each distinct piece is cut into a
lower-case word and marks, the library encodes the words it has not encoded
lately, and the ids are dealt back to the texts. The last ``most`` to twice as
many words of up to ``LONG`` bytes are remembered, which only saves time. Any
other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from clickvault.llm.common import batched, map_texts, pick

END_ID = 1
LONG = 64
FEW_MARKS = 1000  # runs of marks that are remembered
PART = 2 << 20  # bytes of text looked at together
#: Letters whose lower case and normal form are one code point each, and marks
#: that stay one run (no apostrophe; no '<', with which the added tokens begin).
LETTERS = "A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ž"
EACH_LETTER = "".join(c for c in map(chr, range(0x180)) if re.match(f"[{LETTERS}]", c))
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'<")
_PLAIN = re.compile(f"([{LETTERS}]*)([{re.escape(MARKS)}]*)")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for code points from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, n = [], 0
    for b in range(256):
        out.append(chr(b) if b in own else chr(256 + n))
        n += b not in own
    return out


class Pieces(dict):
    """Ids of the pieces seen lately; a new piece is encoded when it is asked
    for. Pieces longer than ``LONG`` bytes are not remembered, so the memory
    is bounded in bytes; ``before``: what was remembered up to the last turn."""

    def __init__(self, encode, before: dict):
        self.encode, self.before = encode, before

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= LONG:
            self[piece] = ids
        return ids


def _strings(raw: pa.Array) -> pa.Array:
    """The same bytes as strings, which a text may hold that is no UTF-8."""
    n = len(raw)
    return pa.Array.from_buffers(pa.large_string(), n, raw.buffers(), 0, raw.offset)


def _gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``pool`` one after another, and where each begins in the result (its end last)."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    kind = np.int32 if max(bounds[-1], len(pool)) < 1 << 31 else np.int64
    at = np.repeat((starts - bounds[:-1]).astype(kind), lengths)
    at += np.arange(len(at), dtype=kind)
    return pool.take(at), bounds


class Encoder:
    """Ids of texts; ``dtype`` is the smallest that holds every id."""

    def __init__(self, path: str, most: int = 250_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        norm, pre, model = conf.get("normalizer") or {}, conf.get("pre_tokenizer") or {}, conf["model"]
        kinds = [x["type"] for x in norm.get("normalizers", [])]
        split = (pre.get("pretokenizers") or [{}])[0]
        self.pieces = (kinds == ["NFC", "Replace", "Lowercase"] and split.get("type") == "Split"
                       and split.get("behavior") == "Removed" and split.get("invert") is True
                       and r"[^\s\p{L}\p{N}]+" in split["pattern"].get("Regex", "")
                       and not any(re.search(r"\s", a["content"]) or a["lstrip"] or a["rstrip"]
                                   for a in conf.get("added_tokens", [])))
        self.plain = (self.pieces and model["type"] == "BPE" and not model.get("dropout")
                      and [x["type"] for x in pre["pretokenizers"]] == ["Split", "ByteLevel"] and sys.byteorder == "little"
                      and all(a["content"][:1] == "<" for a in conf.get("added_tokens", [])))
        self.letters, self.code = _byte_letters(), "H" if self.dtype.itemsize == 2 else "I"
        self.most, self.known, self.marks = most, Pieces(self._piece, {}), {}

    def _library(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, raw: bytes) -> bytes:
        text = raw.decode("utf-8", "replace")
        m = _PLAIN.fullmatch(text) if self.plain else None
        if not m:
            return self._library(text)
        word, marks = m[1].lower(), m[2]
        bare = word.encode()
        ids = None if bare == raw else self.known.get(bare) or self.known.before.get(bare)
        if ids is None:
            ids = self._word(bare)
        return ids + self._marks(marks.encode()) if marks else ids

    def _word(self, raw: bytes, model=None) -> bytes:
        """Ids of a run of lower-case letters, or of marks (``model``: the tokenizer's, which is dear to ask for)."""
        if not raw:
            return b""
        part = raw.decode() if raw.isascii() else "".join([self.letters[b] for b in raw])
        return array(self.code, [t.id for t in (model or self.tok.model).tokenize(part)]).tobytes()

    def _marks(self, marks: bytes) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            ids = self._word(marks)
            if len(marks) <= LONG and len(self.marks) < FEW_MARKS:
                self.marks[marks] = ids
        return ids

    def _words(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of lower-case words, which stand for themselves among the remembered pieces."""
        known, get, before, model = self.known, self.known.get, self.known.before.get, self.tok.model
        for word in words:
            ids = get(word)
            if ids is None:
                ids = before(word)
                if ids is None:
                    ids = self._word(word, model)
                if len(word) <= LONG:
                    known[word] = ids
            yield ids

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces one after another, and their bounds."""
        bare = pc.ascii_rtrim(pieces, characters=MARKS)
        plain = pc.match_substring_regex(bare, rf"\A[{LETTERS}]*\z") if self.plain else pa.repeat(pa.scalar(False), len(pieces))
        mask = plain.to_numpy(zero_copy_only=False)
        words = pc.utf8_lower(bare.filter(plain)).dictionary_encode()
        marks = pc.utf8_ltrim(pieces.filter(plain), characters=EACH_LETTER).dictionary_encode()
        ids: list[bytes] = []
        slots = np.full((len(pieces), 2), -1)  # which ids each piece takes; the last are empty
        for column, runs, of in ((0, words, self._words), (1, marks, lambda few: map(self._marks, few))):
            slots[mask, column] = runs.indices.to_numpy() + len(ids)
            ids.extend(of(runs.dictionary.cast(pa.large_binary()).to_pylist()))
        rest = pieces.filter(pc.invert(plain)).cast(pa.large_binary()).to_pylist()
        slots[~mask, 0] = np.arange(len(rest)) + len(ids)
        ids.extend(map(self.known.__getitem__, rest))
        ids.append(b"")
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        starts, slots = np.cumsum(lengths) - lengths, slots.reshape(-1)
        out, bounds = _gather(np.frombuffer(b"".join(ids), self.dtype), starts.take(slots, mode="wrap"), lengths.take(slots, mode="wrap"))
        return out, bounds[::2]

    def _part(self, texts: pa.Array) -> Iterator[np.ndarray]:
        self._turn()
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        ids, bounds = self._distinct(coded.dictionary)
        code = coded.indices.to_numpy()
        out, at = _gather(ids, bounds.take(code), np.diff(bounds).take(code))
        ends = split.offsets.to_numpy()
        ends = at.take(ends - ends[0])
        for i in range(len(texts)):
            yield out[ends[i]:ends[i + 1]]

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of an Arrow array of strings (null: none), in order."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        if not self.pieces:
            yield from (np.frombuffer(self.encode(t), self.dtype) for t in texts.to_pylist())
            return
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + PART, "right")))
            if ends[at] - before > PART:
                yield np.concatenate(list(self._long(texts[at].as_py())))
            else:
                yield from self._part(_strings(texts.slice(at, to - at)))
            at = to

    def _long(self, raw: bytes) -> Iterator[np.ndarray]:
        """A text of more than ``PART`` bytes, cut at white space."""
        at = 0
        while at < len(raw):
            cut = _SPACE.search(raw, at + PART)
            to = cut.start() if cut else len(raw)
            yield np.frombuffer(self.encode(raw[at:to]), self.dtype)
            at = to

    def _turn(self) -> None:
        if len(self.known) > self.most:  # pieces that are asked for again move on to the new turn
            self.known = Pieces(self._piece, dict(self.known))

    def encode(self, raw: bytes) -> bytes:
        """Ids of one text given in UTF-8, piece by piece, as bytes of ``dtype``."""
        if not self.pieces:
            return self._library(raw.decode("utf-8", "replace"))
        self._turn()
        return b"".join(map(self.known.__getitem__, raw.split()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def id_type(path: str) -> np.dtype:
    return encoder(path).dtype


def encode_texts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``: the ids of the whole text (null: empty) and the
    end id, as little-endian unsigned integers of the tokenizer's width.

    One pass over the scan, no shuffle; a text's length is bounded by a row's
    only. Repeated rows stay repeated, null ids stay null.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.asarray([END_ID], enc.dtype).tobytes()

        def rows():
            for batch in batches:
                docs, texts = (batch.column(batch.schema.get_field_index(c)) for c in (id_col, text_col))
                for i, ids in zip(docs.to_pylist(), enc.each(texts), strict=True):
                    yield {"doc_id": i, "ids": ids.tobytes() + end}

        yield from batched(rows(), schema, weigh="ids")

    return map_texts(pick(docs, id_col, text_col), run, "doc_id long, ids binary")
