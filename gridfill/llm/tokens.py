"""Token ids of a word-wise BPE tokenizer, with words known from earlier texts looked up."""

from __future__ import annotations

import re

import numpy as np

from gridfill.llm.common import only

CACHE = 400_000
"""Entries of a worker's word tables; a full table is emptied."""

# Latin-1 text, one byte a character: capitals to small letters, and the white space outside ASCII to a space.
_CAPITALS = {*range(0x41, 0x5B), *range(0xC0, 0xDF)} - {0xD7}
_LOW = bytes(b + 32 if b in _CAPITALS else 0x20 if b in (0x85, 0xA0) else b for b in range(256))
_LETTER, _NUMBER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}\x1c-\x1f]+|[\x1c-\x1f]+")
_CONTROL = re.compile(rb"[\x1c-\x1f]")


class WordTokens:
    """Ids of texts under a tokenizer that lower-cases, drops white space and works on each word for itself.

    Latin-1 texts are split into words here; a word is tokenized once and then looked up. Other texts (and such with
    separators that libraries disagree on, or with a literal that the tokenizer knows as one token of its own, like
    ``<|endoftext|>``) go to the tokenizer whole. Either way the ids are the tokenizer's own, as its file sets it up.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added)) or b"(?!)")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def packed(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit numbers."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return self._whole(text)
        if _CONTROL.search(raw):
            return self._whole(text)
        raw = raw.translate(_LOW)
        if self.added.search(raw):
            return self._whole(text)
        only(self.words, self.pieces, limit=CACHE)
        words = raw.split()
        parts = list(map(self.words.get, words))
        if None in parts:
            self._learn({w for w, p in zip(words, parts, strict=True) if p is None})
            parts = [self.words[w] if p is None else p for w, p in zip(words, parts, strict=True)]
        return b"".join(parts)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        split = {w: _PIECES.findall(w.decode("latin-1")) for w in words}
        new = list({p for pieces in split.values() for p in pieces if p not in self.pieces})
        if new:
            ids = np.array(self.tokenizer.encode(" ".join(new), add_special_tokens=False).ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(new):
                raw, cut = ids.tobytes(), (cut * 4).tolist()
                self.pieces.update(zip(new, (raw[a:b] for a, b in zip([0, *cut], cut, strict=False)), strict=True))
            else:
                self.pieces.update((p, self._whole(p)) for p in new)
        for w, pieces in split.items():
            self.words[w] = b"".join([self.pieces[p] for p in pieces])


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of a file, loaded once in each worker."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
