"""Token ids of whole texts, with the ids of each word looked up rather than computed twice."""

from __future__ import annotations

import hashlib
from itertools import compress
from pathlib import Path

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyhall.llm.common import process_state

END = 1  # id appended to each document
VOCABULARY = "word_bpe_49k.json"
MAX_WORDS = 400_000  # words as they stand in texts that a worker remembers
MAX_CORES = 400_000  # lower-case words without punctuation that it remembers
MAX_WORD_CHARS = 64  # longer ones are encoded each time
TAIL = ".,;:!?"
LATIN = 0x100  # below, case and composition are the same to every library


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer's file, read on the driver; some megabytes, sent along with the task."""
    return Path(path or public_tokenizers.path(VOCABULARY)).read_text(encoding="utf-8")


def byte_letters() -> dict[int, int]:
    """Bytes without a sign of their own stand as letters from 256 on, in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}


class WordEncoder:
    """Encodes texts word by word, with the same ids as encoding each text whole.

    The tokenizer drops white space before it merges, so no token spans a blank and the
    ids of a text are those of its words in a row. A word that is Latin letters and then,
    perhaps, punctuation is one or two units to the tokenizer: its letters in lower case
    go to the tokenizer's model directly and are remembered apart. Any other word goes
    through the whole tokenizer. A text that spells a special token is encoded whole.
    """

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.plain = self._by_model("Straße,") == self.whole("Straße,")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _by_model(self, word: str) -> bytes | None:
        """Ids by way of the letters alone; none where the word has another form."""
        core = word.rstrip(TAIL)
        if not core.isalpha() or (not core.isascii() and ord(max(core)) >= LATIN):
            return None
        core, tail = core.lower(), word[len(core) :]
        ids = self.cores.get(core)
        if ids is None:
            spelt = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt)])
            if len(self.cores) >= MAX_CORES:
                self.cores.clear()
            if len(core) <= MAX_WORD_CHARS:
                self.cores[core] = ids
        if tail:
            ends = self.tails.get(tail)
            if ends is None:
                ends = self.whole(tail)
                if len(self.tails) < 10_000 and len(tail) <= MAX_WORD_CHARS:
                    self.tails[tail] = ends
            ids += ends
        return ids

    def word(self, word: str) -> bytes:
        ids = self._by_model(word) if self.plain else None
        if ids is None:
            ids = self.whole(word)
        if len(word) <= MAX_WORD_CHARS:
            if len(self.words) >= MAX_WORDS:
                self.words.clear()
                self.words[""] = b""
            self.words[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, without an end id."""
        out, special, learn = [], self.special, self.word
        for text in texts:
            if any(s in text for s in special):
                out.append(self.whole(text))
                continue
            words = text.replace("\n", " ").split(" ")
            found = list(map(self.words.get, words))
            if None in found:
                fresh = [f is None for f in found]
                learnt = map(learn, compress(words, fresh))
                found = [next(learnt) if f is None else f for f in found]
            out.append(b"".join(found))
        return out


def word_encoder(spec: str) -> WordEncoder:
    """One encoder for each worker process."""
    key = "words-" + hashlib.sha256(spec.encode()).hexdigest()
    return process_state(key, lambda: WordEncoder(spec), large=True)
