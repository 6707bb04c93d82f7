"""Token ids of whole texts.

Where a vocabulary file says that characters are never joined across a space and
that spaces leave no trace, as the default one does, a text's ids are those of its
space-separated words. Each distinct word then goes through the tokenizer once per
worker; ``tests/llm`` holds that against encoding whole texts. With any other
vocabulary whole texts are encoded.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Sequence

import numpy as np

# Appended to every document.
END_ID = 1
# Words a worker remembers in each of two generations; one that is met again
# moves to the young one, and the old one is forgotten when the young one is full.
WORDS_KEPT = 350_000
# Letters that lower-case one to one and are already composed, perhaps with
# closing marks: the tokenizer cuts such words just there.
_PLAIN = re.compile(r"""([A-Za-zÀ-ÖØ-öø-ÿ]+)([-.,!|*$#%&;:?"()=]*)""")

# Fixed value: how the default vocabulary cuts a text that is in lower case.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Normalising that acts alike on a text and on its words.
_WORDWISE = ("NFC", "NFD", "NFKC", "NFKD", "Lowercase")
# Cutting that drops white space, whatever else it does.
_DROPS_SPACE = ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")

_ENCODERS: dict[str, WordEncoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the rest follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


def _steps(part: dict | None, inner: str) -> list[dict]:
    """A component of a vocabulary file as the list of its steps."""
    if part is None:
        return []
    return part[inner] if part["type"] == "Sequence" else [part]


def _cuts_by_letters(spec: dict) -> bool:
    """Whether cutting is just that of the default vocabulary."""
    steps = _steps(spec.get("pre_tokenizer"), "pretokenizers")
    if len(steps) != 2 or steps[0]["type"] != "Split" or steps[1]["type"] != "ByteLevel":
        return False
    split, letters = steps
    plain = split["pattern"] == {"Regex": _CUT} and split["behavior"] == "Removed" and split["invert"]
    return plain and not letters["add_prefix_space"] and not letters["use_regex"]


def cuts_at_spaces(spec: dict) -> bool:
    """Whether a vocabulary file's ids of a text are known to be those of its words."""
    for step in _steps(spec.get("normalizer"), "normalizers"):
        spaces = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if not spaces and step["type"] not in _WORDWISE:
            return False
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
        return False
    steps = _steps(spec.get("pre_tokenizer"), "pretokenizers")
    return _cuts_by_letters(spec) or (len(steps) == 1 and steps[0]["type"] in _DROPS_SPACE)


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        import os

        # Spark already runs a worker per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_words = cuts_at_spaces(spec)
        self._by_letters = self.by_words and _cuts_by_letters(spec) and any(
            step["type"] == "Lowercase" for step in _steps(spec.get("normalizer"), "normalizers")
        )
        self._tokenizer = Tokenizer.from_file(path)
        # Whole texts, whatever the file says.
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._model = self._tokenizer.model
        letters = byte_letters()
        self._letters = {code: "".join(letters[b] for b in chr(code).encode()) for code in range(256)}
        self._words_kept = words_kept
        self._young: dict[str, bytes] = {"": b""}
        self._old: dict[str, bytes] = {}

    def _whole(self, part: str) -> bytes:
        return array("I", self._tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _stem(self, stem: str) -> bytes:
        """Lower-case letters pass the tokenizer's normalising and cutting as they are."""
        return array("I", [token.id for token in self._model.tokenize(stem.translate(self._letters))]).tobytes()

    def _part(self, part: str, encode) -> bytes:
        found = self._young.get(part)
        if found is None:
            found = self._old.get(part)
            if found is None:
                found = encode(part)
            self._young[part] = found
        return found

    def _learn(self, words: set[str]) -> None:
        for word in words:
            if word in self._old:
                self._young[word] = self._old[word]
            elif self._by_letters and (match := _PLAIN.fullmatch(word)):
                stem, marks = match.groups()
                self._young[word] = self._part(stem.lower(), self._stem) + self._part(marks, self._whole)
            else:
                self._young[word] = self._whole(word)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        if not self.by_words:
            return [self._whole(text) for text in texts]
        split = [text.replace("\n", " ").split(" ") for text in texts]
        words: set[str] = set()
        for one in split:
            words.update(one)
        if len(self._young) > self._words_kept:
            self._young, self._old = {"": b""}, self._young
        self._learn(words.difference(self._young))
        known = self._young.__getitem__
        return [b"".join(map(known, one)) for one in split]


def encoder(path: str) -> WordEncoder:
    """This worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def document_ids(path: str, texts: Sequence[str]) -> list[np.ndarray]:
    """The ids of each text with the end id."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    return [np.frombuffer(ids + end, dtype="<u4") for ids in encoder(path).encode(texts)]
