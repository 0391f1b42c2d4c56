"""Byte-level BPE by dynamic programming over prefixes, and back.

BPE merges the pair of lowest rank first, again and again.  Its result can be found without merging: of all tokens that end a
prefix of a piece, exactly one is the last token of the prefix's encoding.  It is the one whose own predecessor, the last token of the prefix that it
leaves over, is compatible with it: encoding the two together gives the two again.  The automaton of all tokens, with its suffix links, lists
the tokens that end at each place; the test takes both tokens apart along their common border.  One token is stored for a prefix,
and the ids are read back from the end.  The work is linear in the length of a piece, a run of a million equal letters included.

A text is cut at the added tokens of the file, then into pieces by the pattern of byte-level vocabularies; pieces are encoded on their
own, and short ones are remembered within bounds.

Cases: a NULL or empty text has no ids and decodes to an empty text.  Repeated rows and NULL ids are encoded each on their own.  An
empty table gives no rows.  Texts are encoded whole, whatever their length.  Extra columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from loanpanel.llm.common import bound_batches, map_texts

ID_TYPE = "<u4"  # an id as bytes: unsigned, little-endian
KEPT_PIECES, KEPT_CHARS = 150_000, 32  # pieces that a worker remembers, twice as many at most, and the longest of them
KEPT_PAIRS = 500_000  # compatible and other pairs that a worker remembers
# White space as the pattern of byte-level vocabularies has it (fixed value).
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, by letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def code_points(major: str) -> str:
    """Character class body of all code points of a general category, as ranges.

    Letters newer than Python's Unicode version count as marks here; no token joins one to a neighbour, so the ids are the same (tested).
    """
    of_kind = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == major]
    runs = [[c for _, c in run] for _, run in groupby(enumerate(of_kind), lambda item: item[1] - item[0])]
    return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs)


def piece_pattern() -> re.Pattern:
    """The pieces of a text (fixed pattern of byte-level vocabularies): endings, letters, numbers, marks, white space."""
    letters, numbers = code_points("L"), code_points("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACE}{letters}{numbers}]+"
                      f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class Vocabulary:
    """Tokens of a byte-level tokenizer file, and how each was merged."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        added, model, letters = stored.get("added_tokens") or [], stored["model"], byte_letters()
        if any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in added):
            raise ValueError("added tokens that take their surroundings along are not supported")
        self.added = {token["content"]: token["id"] for token in added}
        by_word = {word: number for word, number in model["vocab"].items() if word not in self.added}
        self.size = max([*by_word.values(), *self.added.values()]) + 1
        self.bytes = [b""] * self.size
        for word, number in by_word.items():
            self.bytes[number] = bytes(letters[c] for c in word)
        for word, number in self.added.items():
            self.bytes[number] = word.encode()
        if {self.bytes[k] for k in by_word.values() if len(self.bytes[k]) == 1} != {bytes([b]) for b in range(256)}:
            raise ValueError("every byte must be a token")
        self.rank, self.left, self.right = [-1] * self.size, [-1] * self.size, [-1] * self.size
        self.merges: dict[int, int] = {}  # rank by pair of ids
        for rank, pair in enumerate(model["merges"]):
            a, b = (by_word[word] for word in (pair.split(" ") if isinstance(pair, str) else pair))
            made = by_word["".join(pair) if not isinstance(pair, str) else pair.replace(" ", "")]
            if self.left[made] >= 0:
                raise ValueError(f"token {made} has two merges")
            self.merges[a * self.size + b] = rank
            self.rank[made], self.left[made], self.right[made] = rank, a, b
        self.words = sorted(by_word.values(), key=lambda k: self.rank[k])

    def splits(self, left: int, right: int, before: float = float("inf")) -> bool:
        """True if encoding both tokens together keeps the border between them, in merges of ranks below ``before``.

        Goes back in time along the border: of the two tokens there, the one made last is taken apart.  A pair that could merge
        while both were there did so, unless one of them was merged away first.  At equal ranks the leftmost merge comes first.
        """
        rank, until_left, until_right = self.rank, before, before
        while True:
            merge = self.merges.get(left * self.size + right)
            if merge is not None and merge < until_left and merge <= until_right and merge < before:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] >= rank[right]:
                until_left, left = rank[left], self.right[left]
            else:
                until_right, right = rank[right], self.left[right]


class Pieces(dict):
    """Ids of the pieces met so far, within bounds."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.encoder.encode_piece(text)
        if len(text) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Encoder:
    """Encodes texts; one per Python worker."""

    def __init__(self, path: str):
        self.words = words = Vocabulary(path)
        self.pieces = piece_pattern()
        self.added = re.compile("|".join(f"({re.escape(w)})" for w in sorted(words.added, key=len, reverse=True))) \
            if words.added else None
        self.length = [len(b) for b in words.bytes]
        whole: set[int] = set()  # tokens that their own bytes are encoded as
        self.ending = ahocorasick.Automaton()
        for k in words.words:
            if words.rank[k] < 0 or (words.left[k] in whole and words.right[k] in whole
                                     and words.splits(words.left[k], words.right[k], words.rank[k])):
                whole.add(k)
                self.ending.add_word(words.bytes[k].decode("latin-1"), k)
        self.ending.make_automaton()
        self.fit: dict[int, bool] = {}
        self.known = Pieces(self)

    def _fits(self, pair: int) -> bool:
        if len(self.fit) >= KEPT_PAIRS:
            self.fit.clear()
        fits = self.fit[pair] = self.words.splits(*divmod(pair, self.words.size))
        return fits

    def last_tokens(self, piece: bytes) -> list[int]:
        """The last token of every prefix's encoding, by the length of the prefix."""
        last, fit, length, size = [-1] * (len(piece) + 1), self.fit, self.length, self.words.size
        for end, token in self.ending.iter(piece.decode("latin-1")):
            end += 1
            if last[end] < 0:
                start = end - length[token]
                if start:
                    pair = last[start] * size + token
                    fits = fit.get(pair)
                    if fits is None:
                        fits = self._fits(pair)
                    if not fits:
                        continue
                last[end] = token
        return last

    def encode_piece(self, text: str) -> bytes:
        piece = text.encode("utf-8", "replace")
        last, at, back, length = self.last_tokens(piece), len(piece), [], self.length
        while at:
            token = last[at]
            back.append(token)
            at -= length[token]
        return struct.pack(f"<{len(back)}I", *reversed(back))

    def encode(self, text: str) -> bytes:
        """The ids of a text, as bytes."""
        out = []
        for k, part in enumerate(self.added.split(text) if self.added else [text]):
            if not part:
                continue
            if self.added and k % (self.added.groups + 1):  # split() gives the groups of each match between the parts
                out.append(np.array([self.words.added[part]], ID_TYPE).tobytes())
            else:
                out.extend(map(self.known.__getitem__, self.pieces.findall(part)))
        return b"".join(out)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """Loaded once a worker; the same ids whatever it has met before."""
    return Encoder(path)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids``: the ids of every text, four bytes each, in one pass and without a shuffle.

    ``tokenizer`` is the path of a byte-level tokenizer file on every executor.
    """
    def begin():
        encoder = encoder_of(tokenizer)

        def work(doc_ids, texts):
            return doc_ids, [encoder.encode(text.as_py() or "") for text in texts]
        return lambda columns: work(*columns)

    bound_batches(docs.sparkSession)
    return map_texts(docs.select("doc_id", "text"), "doc_id long, ids binary", begin)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids, text``: the texts that ids stand for.  Bytes that are no UTF-8 become U+FFFD."""
    def begin():
        words = Vocabulary(tokenizer).bytes

        def work(doc_ids, packed):
            texts = [b"".join(map(words.__getitem__, np.frombuffer(ids.as_buffer() or b"", ID_TYPE).tolist()))
                     .decode("utf-8", "replace") for ids in packed]
            return doc_ids, packed, texts
        return lambda columns: work(*columns)

    bound_batches(encoded.sparkSession)
    return map_texts(encoded.select("doc_id", "ids"), "doc_id long, ids binary, text string", begin)
