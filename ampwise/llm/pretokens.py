"""Splitting of a text into the pre-tokens of ``word_bpe_49k.json``.

The tokenizer file normalises (NFC, lower case) and splits with one pattern;
white space is dropped. Texts whose characters lie in a set on which these
rules are plain (below U+0250, and with a lower case below U+0250) are split
with ``re``; any other text goes through the library's own normaliser and the
pattern's Unicode form. The two added tokens are matched before normalisation,
as the file says. No pre-token, special string or normalised sequence spans
white space, so :func:`pieces` of a text can be split one by one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The special strings and the split pattern of the tokenizer file.
SPECIALS = re.compile(r"(<\|startoftext\|>|<\|endoftext\|>)")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# letters there whose lower case lies above (or is more than a letter) are not plain: Ə, Ɛ, Ɔ, İ and others
_LATIN = "".join(c for c in map(chr, range(0xA0, 0x250)) if len(c.lower()) == 1 and ord(c.lower()) < 0x250)
_PLAIN = re.compile(f"[\\t\\n\\r\\x20-\\x7e{_LATIN}]*\\Z")
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼½¾"
_PLAIN_SPLIT = re.compile(f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\\s{_LETTERS}{_DIGITS}]+").findall


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The stretches between ASCII white space of all texts (null: none), and where each text's begin
    (one more entry than texts). A to Z are lower-cased, as the tokenizer does later (a letter and
    its mark join to the same letter before and after), unless a special string may be among them."""
    texts = pc.fill_null(texts, "")
    if not pc.any(pc.match_substring(texts, "<|")).as_py():
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    return lists.flatten(), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()


def encoded(texts: pa.Array, table) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, where each text's begin). ``table`` has each piece's ids as bytes; it
    is asked once for each distinct piece of ``texts``."""
    flat, begin = pieces(texts)
    known = flat.dictionary_encode()
    which = known.indices.to_numpy()
    got = table.take(known.dictionary.to_numpy(zero_copy_only=False).tolist())
    size = np.fromiter(map(len, got), np.int64, len(got)) // 4
    ids, start = np.frombuffer(b"".join(got), "<u4"), np.cumsum(size) - size
    n = size[which]
    ends = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(start[which] - ends[:-1], n) + np.arange(ends[-1])
    return ids[at], ends[begin]


#: Bytes of text that are cut into pieces at once.
AT_ONCE = 2_000_000
#: Entries of each generation of a worker's tables of pieces and of pre-tokens, and the longest key kept.
PIECES, WORDS, SHORT = 150_000, 100_000, 64


class Recent(dict):
    """A table that computes what it misses and keeps what is in use, in bounded memory: when it is
    full it becomes the old generation, and what is asked for again comes back from there.
    ``make`` gives the values of a list of distinct keys."""

    def __init__(self, make: Callable[[list[str]], list[bytes]], size: int) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def take(self, keys: list[str]) -> list[bytes]:
        got = list(map(self.get, keys))
        if None not in got:
            return got
        old, new = self.old.get, {}
        lacking = [i for i, g in enumerate(got) if g is None]
        for i in lacking:
            k = keys[i]
            new[k] = got[i] = old(k)
        unknown = [k for k, g in new.items() if g is None]
        if unknown:
            new.update(zip(unknown, self.make(unknown)))
            for i in lacking:
                if got[i] is None:
                    got[i] = new[keys[i]]
        for k, g in new.items():
            if len(k) <= SHORT:
                if len(self) >= self.size:
                    self.old = self.copy()
                    self.clear()
                self[k] = g
        return got


def piece_table(split: "Splitter", words: Callable[[list[str]], list[bytes]], size: int = PIECES) -> Recent:
    """piece -> ids of its pre-tokens, whose ids ``words`` gives for a list of distinct ones. New
    pieces are split together."""
    known = Recent(words, WORDS)

    def make(new: list[str]) -> list[bytes]:
        said = split.lines(new)
        ids = known.take(said) if said else []
        ends = [i for i, w in enumerate(said) if w == "\n"]
        size = np.concatenate(([0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))))
        at = size[np.array([0, *ends, len(ids)], np.int64)].tolist()
        blob = b"".join(ids)
        return [blob[a:b] for a, b in zip(at, at[1:])]

    return Recent(make, size)


class Splitter:
    """``split(text)`` gives the pre-tokens in order; a special string is its own pre-token."""

    def __init__(self, tokenizer) -> None:
        self.normalize = tokenizer.normalizer.normalize_str
        self.pre_split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.unmap = {c: b for b, c in enumerate(byte_chars())}

    def split(self, text: str) -> list[str]:
        if "<|" not in text:
            return self._plain(text)
        out: list[str] = []
        for i, part in enumerate(SPECIALS.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out += self._plain(part)
        return out

    def lines(self, texts: list[str]) -> list[str]:
        """The pre-tokens of texts without line ends, with ``"\\n"`` between those of two texts."""
        whole = "\n".join(texts)
        if "<|" not in whole and _PLAIN.match(whole):
            return _PLAIN_SPLIT(whole.lower())
        out: list[str] = []
        for i, t in enumerate(texts):
            if i:
                out.append("\n")
            out += self.split(t)
        return out

    def _plain(self, text: str) -> list[str]:
        if _PLAIN.match(text):
            return [w for w in _PLAIN_SPLIT(text.lower()) if w != "\n"]
        unmap = self.unmap
        return [bytes(unmap[c] for c in w).decode("utf-8") for w, _ in self.pre_split(self.normalize(text))]


def byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, more = [], 0x100
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(more))
            more += 1
    return out
