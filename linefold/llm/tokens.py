"""Token ids of whole texts, by a byte-level BPE tokenizer file.

The split pattern of such a tokenizer never joins a character with white
space after it, so a text's ids are those of its space-led words and of its
line breaks, one after the other. Words repeat, so each worker remembers the
ids of the words it has met (a bounded number) and asks the tokenizer for new
ones only; a new word of Latin letters, digits and ASCII marks is split by the
pattern here, and the tokenizer's model merges the parts not met before. Texts with white space other than single blanks and line breaks
between words take a slower way with the same result, and so do texts that hold the string of
an added token, such as ``<|endoftext|>``.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

from linefold.llm.common import worker_cache

RUNS = re.compile(r"(\s*)(\S+)|(\s+)")
ODD_SPACE = re.compile(r"[^\S \n\t\r]")
MOST_WORDS = 600_000
#: the tokenizer's split pattern, for words of these characters only
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
SIMPLE = re.compile(f" ?[{LATIN}!-~]+")
PARTS = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{LATIN}]+| ?[0-9]+| ?[^{LATIN}0-9 ]+")
#: byte -> character of the model's alphabet: printable ones stand for
#: themselves, the others for the code points from 256 on
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
ALPHABET = dict(zip([b for b in range(256) if b not in PRINTABLE], range(256, 512)))


class Encoder:
    """Texts to ids, little-endian unsigned 32-bit.

    path: a tokenizers JSON file of a byte-level BPE. as_text: whether the
    strings of special tokens in a text are ordinary text; if not, they get
    the tokens' ids, as the tokenizer gives by default.
    """

    def __init__(self, path: str, as_text: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = as_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: strings that the tokenizer looks for before it splits a text
        self.added = None if as_text or not added else re.compile("|".join(map(re.escape, added)))
        self.parts: dict[str, bytes] = {}
        self.plain = Words(self, "")
        self.spaced = Words(self, " ")

    def ids(self, text: str) -> bytes:
        """Ids of any text."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word_ids(self, word: str) -> bytes:
        """Ids of a word, with or without a blank before it."""
        if not SIMPLE.fullmatch(word):
            return self.ids(word)
        out = []
        for part in PARTS.findall(word):
            ids = self.parts.get(part)
            if ids is None:
                if len(self.parts) >= MOST_WORDS:
                    self.parts.clear()
                letters = part.encode().decode("latin-1").translate(ALPHABET)
                ids = self.parts[part] = array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added and self.added.search(text):
            return self.ids(text)
        plain, spaced = self.plain, self.spaced.__getitem__
        words = text.split()
        if len(text) - len("".join(words)) == len(words) - 1 == text.count(" ") + text.count("\n"):
            lines = []
            for line in text.split("\n"):
                first, _, rest = line.partition(" ")
                lines.append(plain[first] + b"".join(map(spaced, rest.split(" "))) if rest else plain[first])
            return plain["\n"].join(lines)
        if ODD_SPACE.search(text):
            return self.ids(text)
        out = []
        for m in RUNS.finditer(text):
            space, word, end = m.groups()
            if end:
                out.append(plain[end])
            elif space.endswith(" "):
                out += [plain[space[:-1]], spaced(word)]
            else:  # the last character of the run is a token of its own
                out += [plain[space[:-1]], plain[space[-1:]], plain[word]]
        return b"".join(out)


class Words(dict):
    def __init__(self, encoder: Encoder, lead: str) -> None:
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MOST_WORDS:
            self.clear()
        ids = self[word] = self.encoder.word_ids(self.lead + word) if word else b""
        return ids


def encoder(path: str) -> Encoder:
    """This worker's encoder of a vocabulary, with the tokenizer's defaults."""
    kept = worker_cache("encoders")
    if path not in kept:
        kept[path] = Encoder(path, as_text=False)
    return kept[path]


__all__ = ["Encoder", "encoder"]
