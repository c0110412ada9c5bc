"""Token ids of whole texts with a public tokenizer file, word by word with a bounded memory of words."""

from __future__ import annotations

import os
import re

import numpy as np

#: Words in each of two generations that a Python worker remembers, and the longest; about 120 MB at most.
CACHE_WORDS, CACHE_CHARS = 200_000, 40
#: A run of letters that lower-case one to one and are in composed form, then ASCII marks: two tokens' worth of text.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:$%&*#|()\-]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """ids of texts as little-endian unsigned 32-bit bytes, equal to encoding each text whole.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its
    words one after the other. Texts are cut at spaces and newlines only, which every reading
    of white space includes; repeated words are looked up. A word of plain letters and marks
    is the lower-cased letters' ids and the marks' ids; other words take the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        # what was used since a memory was last full, and what was used before
        self.known: dict[str, bytes] = {}
        self.old_known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _word(self, word: str) -> bytes:
        plain = PLAIN.fullmatch(word)
        if not plain:
            return self._ids([word])[0]
        letters, marks = plain[1].lower(), plain[2]
        raw = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.letters)
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(raw)])
        if not marks:
            return ids
        known = self.marks.get(marks)
        if known is None:
            known = self._ids([marks])[0]
            if len(marks) <= 4:  # so there are few
                self.marks[marks] = known
        return ids + known

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.known, self.old_known = {}, self.known
        known, old, done = self.known, self.old_known, []
        for t in texts:
            words = (t or "").replace("\n", " ").split(" ")
            parts = list(map(known.get, words))
            if None in parts:
                for i, ids in enumerate(parts):
                    if ids is None:
                        word = words[i]
                        parts[i] = ids = old.get(word) or self._word(word)
                        if len(word) <= CACHE_CHARS:
                            known[word] = ids
            done.append(b"".join(parts))
        return done


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
