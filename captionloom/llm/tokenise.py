"""Token ids of the word-end BPE vocabulary, through a table of distinct words.

The tokenizer drops white space and no pre-token spans it, so a text's ids are the ids of its white-space
words in order. A worker keeps a bounded table of words and one of pre-tokens, and asks the library's BPE
model only for pre-tokens that it has not met.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import regex

#: Distinct words, and distinct pre-tokens, that a worker keeps.
TABLE = 600_000
LONG_WORD = 64
#: Beyond these, lower case and composition are left to the library; so are words with its special tokens.
UNUSUAL = regex.compile("[^\x00-\u024f]|\u0130")
#: Python's split() takes these as white space, the tokenizer does not.
SEPARATORS = regex.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """Letter by byte of byte-level vocabularies: printable bytes stand for themselves, others for U+0100 and on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(0x100 + n) for n, b in enumerate(rest)}


class WordTokenizer:
    """ids(texts): for each text, the ids that the tokenizer file at path gives, without special tokens around it."""

    def __init__(self, path: str, table: int = TABLE):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        # what the word table relies on; a tokenizer of another kind goes to the library text by text
        self.by_word = (
            kinds == ["NFC", "Replace", "Lowercase"]
            and split["type"] == "Split"
            and split["invert"]
            and split["behavior"] == "Removed"
            and level["type"] == "ByteLevel"
            and not level["add_prefix_space"]
            and not level["use_regex"]
            and spec["post_processor"] is None
            and all(x["content"].startswith("<|") for x in spec["added_tokens"])
        )
        self.pattern = regex.compile(split["pattern"]["Regex"]) if self.by_word else None
        self.letters = _byte_letters()
        self.table, self.parts, self.limit = {}, {}, table

    def part(self, part: str) -> bytes:
        """ids of a lower-case pre-token, as little-endian 32-bit numbers."""
        found = self.parts.get(part)
        if found is None:
            letters = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
            found = packed([t.id for t in self.whole.model.tokenize(letters)])
            if len(part) <= LONG_WORD:
                if len(self.parts) >= self.limit:
                    self.parts.clear()
                self.parts[part] = found
        return found

    def word(self, word: str) -> bytes:
        """ids of a word without white space."""
        if "<|" in word or UNUSUAL.search(word):
            return packed(self.whole.encode(word, add_special_tokens=False).ids)
        low = word.lower()
        if low.isalpha():
            return self.part(low)
        if low[-1] in ".," and low[:-1].isalpha():
            return self.part(low[:-1]) + self.part(low[-1])
        return b"".join(map(self.part, self.pattern.findall(low)))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            found = self.whole.encode_batch(texts, add_special_tokens=False)
            return [np.array(x.ids, np.uint32) for x in found]
        if len(self.table) >= self.limit:
            self.table.clear()
        table, out = self.table, []
        for text in texts:
            if SEPARATORS.search(text):
                out.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            rows = []
            for word in text.split():
                found = table.get(word)
                if found is None:
                    found = self.word(word)
                    if len(word) <= LONG_WORD:
                        table[word] = found
                rows.append(found)
            out.append(np.frombuffer(b"".join(rows), "<u4"))
        return out


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
