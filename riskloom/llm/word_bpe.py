"""Word-end BPE ids at corpus speed: distinct words are encoded once and remembered."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# White space as the tokenizer's pattern sees it (the Unicode property), unlike str.split().
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_WORDS = re.compile(f"[^{_SPACE}]+")
_CONTROLS = re.compile("[\x1c-\x1f]")
# Beyond the Latin letters the libraries' Unicode tables differ in age; the tokenizer itself judges such words.
_FAMILIAR = 0x250
# Marks that are a piece of their own behind letters.
_MARKS = ".,;:!?"
# Stands for the end of a word; never part of UTF-8.
_END = b"\xff"
# Words remembered per generation; two generations bound a worker's memory.
REMEMBERED = 300_000


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def merge(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Plain BPE on a few symbols: merge the first pair of the lowest rank until none is left."""
    while len(parts) > 1:
        rank, at = min((ranks.get(p, len(ranks)), i) for i, p in enumerate(zip(parts, parts[1:])))
        if rank == len(ranks):
            break
        parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
    return parts


def _lowered(word: str) -> str:
    """Composed and in lower case, letter by letter as the tokenizer does: no final sigma."""
    return word if word.isascii() else unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()


class WordBpe(dict):
    """Ids of `tokenizers` for a lower-casing BPE with word ends; a map from a word to its packed ids.

    White space separates words and leaves no trace, so each word's ids stand for
    themselves. The merges run in tiktoken, which merges any neighbours whose
    concatenation has a rank. That is the same as the file's merge list for every token
    that the merge list itself builds from its letters; others, which it can never
    produce, get no rank.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as lines:
            file = json.load(lines)
        model, split = file["model"], file["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in file["normalizer"]["normalizers"]]
        if (kinds, model["end_of_word_suffix"], split["behavior"]) != (["NFC", "Replace", "Lowercase"], "</w>", "Removed"):
            raise ValueError(f"not a lower-casing BPE with word ends: {path}")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        vocab, letters = model["vocab"], _byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        order = {p: i for i, p in enumerate(pairs)}

        def raw(token: str) -> bytes:
            end = token.endswith("</w>")
            return bytes(letters[c] for c in (token[:-4] if end else token)) + _END * end

        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([b]) + _END: 256 + b for b in range(256)}
        for rank, (left, right) in enumerate(pairs):
            token = left + right
            symbols = [*token[:-5], token[-5:]] if token.endswith("</w>") else [*token]
            if merge(symbols, order) == [token]:
                ranks[raw(token)] = 512 + rank
        self.packed = [b""] * (512 + len(pairs))
        for token, number in vocab.items():
            if (rank := ranks.get(raw(token))) is not None:
                self.packed[rank] = number.to_bytes(4, "little")
        self.path = path
        self.encoder = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            stem = word[:-1]
            if word[-1] in _MARKS and stem.isalpha():
                value = self[stem] + self[word[-1]]
            elif ord(max(word + (plain := _lowered(word)))) < _FAMILIAR:
                one = self.encoder._core_bpe.encode_single_piece
                found = [r for piece in self.pieces.findall(plain) for r in one(piece.encode() + _END)]
                value = b"".join([self.packed[r] for r in found])
            else:
                value = np.array(tokenizer(self.path).encode(word, add_special_tokens=False).ids, np.uint32).tobytes()
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value

    def encode(self, text: str) -> bytes:
        """The ids of a text, four little-endian bytes each."""
        # Words with other letters stay as they are: the tokenizer composes and lowers them itself, once.
        if text.isascii():
            text = text.lower()
        words = _WORDS.findall(text) if _CONTROLS.search(text) else text.split()
        if not text.isascii():
            words = [w.lower() if w.isascii() else w for w in words]
        return b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One per Python worker."""
    return WordBpe(path)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """The library's own tokenizer for the file, as the reference to test against."""
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made
