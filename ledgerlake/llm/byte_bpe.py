"""Byte-level BPE by forced-boundary splitting.

Every merge makes a token of the vocabulary, so two neighbouring bytes that stand side by side in no token are never
merged: the place between them is a certain cut. A table of 256 x 256 flags holds these pairs. Texts are cut there and the
fragments are encoded independently, each different one once; the ids of a text are those of its fragments, one after the other.

The tokenizer first splits a text by a pattern, and a fragment alone must be split as it is inside the text. So a cut is
only used where that is sure: between ASCII letters, digits and signs, and before ASCII white space, but not after white
space (the pattern looks ahead there) and not where an apostrophe would begin a contraction that it does not begin in
the text. Bytes of added tokens and of contractions count as inside a token.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.columns import beside, pieces, strings

BREAK = b"\xff"  # stands in no UTF-8 text
# fixed values: the contractions that the pattern of byte-level tokenizers splits off
CONTRACTIONS = [b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d"]
# fixed values: white space beyond ASCII, and neighbours that some tables count as such
SPACES = [chr(c) for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
LETTER, DIGIT, SIGN, SPACE, WIDE, OTHER = range(6)
FRAGMENTS = 1 << 17  # fragments that are looked up at once
KEPT, LONGEST = 1 << 19, 64  # encoded fragments that a worker remembers, and the bytes of the longest of them


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 characters stand for
    themselves, the others in their order for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_classes() -> np.ndarray:
    classes = np.full(256, OTHER, np.uint8)
    classes[33:127] = SIGN
    classes[48:58] = DIGIT
    classes[65:91] = classes[97:123] = LETTER
    classes[9:14] = classes[32] = SPACE
    classes[128:] = WIDE
    return classes


def pairs_of(tokens) -> np.ndarray:
    """Which pairs of bytes stand side by side in a token."""
    inside = np.zeros((256, 256), bool)
    for token in tokens:
        data = np.frombuffer(token, np.uint8)
        inside[data[:-1], data[1:]] = True
    return inside


def cut_table(tokens: list[bytes]) -> np.ndarray:
    """Pairs of bytes between which every text may be cut. After a byte beyond ASCII it depends on its character, too."""
    forced = ~pairs_of([*tokens, *CONTRACTIONS])
    kinds = byte_classes()
    left, right = kinds[:, None], kinds[None, :]
    solid = (left == LETTER) | (left == DIGIT) | (left == SIGN)
    sure = (solid & (right <= SPACE)) | ((left == WIDE) & (right == SPACE))
    quote = ord("'")
    sure[quote, kinds == LETTER] = False
    sure[kinds == SIGN, quote] = False
    return forced & sure


class Coder:
    """A byte-level tokenizer of one file, its cut table and the fragments it has met."""

    loaded: dict[str, Coder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        form = json.loads(self.tokenizer.to_str())
        split, added = form["pre_tokenizer"] or {}, form["added_tokens"]
        if form["normalizer"] or form["model"]["type"] != "BPE" or form["model"].get("dropout") or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space"):
            raise ValueError(f"not a byte-level BPE tokenizer that splits texts by the usual pattern: {path}")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"added tokens that depend on their neighbours: {path}")
        chars = byte_of_char()
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {t["content"] for t in added}
        self.bytes_of = [b""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.bytes_of[number] = bytes(chars[c] for c in name) if all(c in chars for c in name) and name not in special else name.encode()
        self.cuts = cut_table([self.bytes_of[n] for n in names.values()])
        self.met: dict[bytes, bytes] = {}
        spaces = [s.encode() for s in SPACES]
        self.two = np.array([int.from_bytes(s) for s in spaces if len(s) == 2], np.int64)
        self.three = np.array([int.from_bytes(s) for s in spaces if len(s) == 3], np.int64)

    @classmethod
    def of(cls, path: str) -> Coder:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def places(self, data: np.ndarray) -> np.ndarray:
        """Where fragments may begin in one text, its first byte not counted."""
        at = np.flatnonzero(self.cuts[data[:-1], data[1:]]) + 1 if len(data) > 1 else np.empty(0, np.int64)
        wide = data[at - 1] >= 128
        if wide.any():  # not after white space beyond ASCII
            last = at[wide] - 1
            one, two = data[last].astype(np.int64), data[np.maximum(last - 1, 0)].astype(np.int64) << 8
            three = data[np.maximum(last - 2, 0)].astype(np.int64) << 16
            wide[wide] = np.isin(one + two, self.two) | np.isin(one + two + three, self.three)
            at = at[~wide]
        return at

    def _encoded(self, fragments: list[bytes]) -> list[bytes]:
        """Ids of each fragment, as bytes of 32-bit numbers."""
        codes = list(map(self.met.get, fragments))
        holes = [i for i, code in enumerate(codes) if code is None]
        new = list(dict.fromkeys([fragments[i] for i in holes]))
        own: dict[bytes, bytes] = {}
        for first in range(0, len(new), 8192):
            some = new[first : first + 8192]
            for fragment, code in zip(some, self.tokenizer.encode_batch_fast([f.decode() for f in some], add_special_tokens=False), strict=True):
                own[fragment] = array("i", code.ids).tobytes()
        for i in holes:
            codes[i] = own[fragments[i]]
        if len(self.met) + len(new) > KEPT:
            self.met.clear()
        self.met.update((f, own[f]) for f in new[:KEPT] if len(f) <= LONGEST)
        return codes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a batch, and where each text's ids begin."""
        begins = np.zeros(len(data), bool)
        begins[self.places(data)] = True
        begins[offsets[:-1][np.diff(offsets) > 0]] = True  # each text begins a fragment
        cuts = np.flatnonzero(begins)
        parts, counts = [], []
        for first in range(0, len(cuts), FRAGMENTS):
            some = cuts[first : first + FRAGMENTS]
            end = cuts[first + FRAGMENTS] if first + FRAGMENTS < len(cuts) else len(data)
            fragments = np.insert(data[some[0] : end], some[1:] - some[0], BREAK[0]).tobytes().split(BREAK)
            codes = self._encoded(fragments)
            counts.append(np.fromiter(map(len, codes), np.int64, len(codes)) // 4)
            parts.append(b"".join(codes))
        ends = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int64), *counts]))])
        return np.frombuffer(b"".join(parts), "i4"), ends[np.searchsorted(cuts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each list of ids; unknown ids stand for nothing, bytes that are no UTF-8 for the replacement character."""
        have = self.bytes_of
        parts = [have[i] if 0 <= i < len(have) else b"" for i in ids.tolist()]
        return [b"".join(parts[a:b]).decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the list of ids of each whole text, as the tokenizers library encodes it without special tokens at its
    ends, truncation or padding; an added token's string in a text is that token, as it is there.

    A null text is empty and has no ids. Repeated rows are encoded alike. Texts of any length are encoded whole. An empty
    table gives no rows. Other columns are kept; one that is called as the new one is replaced.
    """

    def run(batch: pa.RecordBatch):
        coder = Coder.of(path)
        for _, _, data, offsets in pieces(batch.column(0)):
            found, ends = coder.encode(data, offsets)
            yield [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.int32()))]

    return beside(docs, [F.col(f"`{text}`")], {ids: "array<int>"}, run)


def decoded(codes: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``codes`` with the text that the ids stand for, special tokens included. A null list is an empty text."""

    def run(batch: pa.RecordBatch):
        coder, column = Coder.of(path), batch.column(0)
        for first in range(0, len(column), 256):
            some = column.slice(first, 256)
            sizes = some.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            yield [pa.array(coder.decode(some.flatten().fill_null(-1).to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])), pa.string())]

    return beside(codes, [F.col(f"`{ids}`").cast("array<int>")], {text: "string"}, run)


def ids_digest(ids) -> F.Column:
    """Hash of the decimal ids, joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")).cast("binary"), 256)
