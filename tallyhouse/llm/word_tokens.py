"""Token ids of whole texts by the tokenizers library, each distinct word encoded once.

The word tokenizer drops white space and never merges across it or across a word's end,
so for plain Latin text the ids of a text are the ids of its words in a row. The library
encodes each word not seen yet; texts with other characters or with the string of a
special token go through the library whole. Both ways give the same ids.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
from tokenizers import Tokenizer

#: Characters on which every Unicode table agrees: ASCII without odd controls, and Latin-1 letters.
_OTHER = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]")
#: Byte-level tokenizers write a byte that is no visible character as the next free letter from 256 on.
_HIDDEN = [byte for byte in range(256) if not (33 <= byte <= 126 or 161 <= byte <= 255 and byte != 173)]
BYTE_LETTERS = {byte: chr(256 + at) for at, byte in enumerate(_HIDDEN)}
#: The library's own split of a lower-cased chunk, for the characters above.
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
#: A lone full stop or comma is a word of its own; beside another sign it is not.
_SIGNS = re.compile("[^\\sa-zß-öø-ÿ0-9]{2}")
#: Chunks and words remembered in one worker (about 90 MB); when full it starts anew.
MEMORY = 400_000


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts to arrays of little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    @property
    def vocabulary(self) -> int:
        return self.library.get_vocab_size(with_added_tokens=True)

    def encode(self, text: str) -> np.ndarray:
        if _OTHER.search(text) or any(special in text for special in self.specials):
            whole = self.library.encode(text, add_special_tokens=False)
            return np.array(whole.ids, "<u4")
        text = text.lower()
        if not _SIGNS.search(text):  # set off common signs, so that fewer distinct chunks remain
            text = text.replace(".", " . ").replace(",", " , ")
        chunks = text.split()
        known = self.known
        try:
            return np.frombuffer(b"".join(map(known.__getitem__, chunks)), "<u4")
        except KeyError:
            pass
        if len(known) > MEMORY:
            known.clear()
        for chunk in chunks:
            if chunk not in known:
                known[chunk] = b"".join([known.get(word) or self._learn(word) for word in _WORD.findall(chunk)])
        return np.frombuffer(b"".join(map(known.__getitem__, chunks)), "<u4")

    def _learn(self, word: str) -> bytes:
        """Encode one word by the library's merges, over the characters its byte level writes bytes as."""
        written = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        found = array("I", [token.id for token in self.library.model.tokenize(written)])
        self.known[word] = ids = found.tobytes()
        return ids


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker; workers are reused, so it is built once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
