"""Word-level use of a tokenizers vocabulary file, shared by the token operators.

The vocabulary's normaliser and splitter drop white space and never look across it, so
what a text gives is what its white-space separated words give, in order. Workers keep
results per distinct word in a two-generation cache bounded by bytes: when the young generation
is full it becomes the old one, and words met again move back; a long word is kept for the
texts it came with alone. A worker holds the caches of one operator at a time: those of
an earlier stage go as soon as another operator runs in it.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

CACHE_BYTES = 64 << 20  # of one generation, as words and their entries
ENTRY_BYTES, LONG_WORD = 220, 64

# Words of these characters alone need no normalisation beyond lower case, and the
# splitting pattern of the vocabulary file can be applied by ``re`` directly.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

# The normaliser and splitter of the vocabulary files that can be used word by word like this.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, the others from U+0100 on in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordCache:
    """word → value; ``fill`` computes the values of words met for the first time."""

    def __init__(self, fill: Callable[[list], list], most: int = CACHE_BYTES):
        self.fill, self.most, self.young, self.old = fill, most, {}, {}
        self.held = 0
        self.passing: list = []

    def values(self, texts: list[list]) -> Callable:
        """A lookup that holds every word of these texts."""
        for w in self.passing:
            del self.young[w]
        if self.held > self.most:
            self.young, self.old, self.held = {}, self.young, 0
        new = set().union(*texts).difference(self.young)
        known = [w for w in new if w in self.old] if self.old else []  # a set operation would walk the whole dict
        for w in known:
            self.young[w] = self.old[w]
        new = new.difference(known)
        if new:
            words = list(new)
            self.young.update(zip(words, self.fill(words), strict=True))
        self.passing = [w for w in new if len(w) > LONG_WORD]
        self.held += ENTRY_BYTES * (len(known) + len(new))
        return self.young.__getitem__

    def of(self, words: list) -> list:
        """The values of distinct words, in order, by one walk of the cache."""
        if self.held > self.most:
            self.young, self.old, self.held = {}, self.young, 0
        found = list(map(self.young.get, words))
        new = [k for k, v in enumerate(found) if v is None]
        for k in new:
            found[k] = self.old.get(words[k])
        unknown = [k for k in new if found[k] is None]
        for k, v in zip(unknown, self.fill([words[k] for k in unknown]), strict=True):
            found[k] = v
        self.young.update((words[k], found[k]) for k in new if len(words[k]) <= LONG_WORD)
        self.held += ENTRY_BYTES * len(new)
        return found


_KEPT: dict = {}


def of_worker(operator: str, key, make: Callable):
    """What ``make()`` gives, kept in this Python worker for ``operator`` under ``key``; what another
    operator kept is dropped, as workers live on into the next stages."""
    if _KEPT.get("operator") != operator:
        _KEPT.clear()
        _KEPT["operator"] = operator
    if (operator, key) not in _KEPT:
        _KEPT[operator, key] = make()
    return _KEPT[operator, key]


def supported(spec: dict, path: str) -> dict:
    """The vocabulary file's content; raises where it splits texts otherwise than word by word."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if norm.get("normalizers") != NORMALIZERS or pre.get("pretokenizers") != [SPLIT, BYTES]:
        raise ValueError(f"{path}: its normalizer or pre_tokenizer is not the one that the token operators apply word by word")
    if (model := spec["model"])["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
        raise ValueError(f"{path}: not a plain byte-pair model")
    return spec


class Vocabulary:
    """The parts of a vocabulary file: pre-tokens as bytes, special strings, the model."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.spec = supported(json.load(f), path)
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.at_special = re.compile("(" + ("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)") + ")")
        self.letters = byte_letters()
        self.as_letters = dict(enumerate(self.letters))
        self.byte_of = {c: b for b, c in enumerate(self.letters)}

    def pieces(self, word: bytes) -> list[bytes | int]:
        """Pre-tokens (bytes) and special tokens (their ids) of a word, in order."""
        if word.isalpha():  # ASCII letters only
            return [word.lower()]
        text = word.decode("utf-8", "replace")
        if PLAIN.fullmatch(text) and "<|" not in text:
            return [p.encode() for p in PIECES.findall(text.lower())]
        out: list[bytes | int] = []
        for k, part in enumerate(self.at_special.split(text)):
            if k % 2:
                out.append(self.special[part])
            elif part:
                out += [bytes(map(self.byte_of.__getitem__, p)) for p, _ in
                        self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)) if p]
        return out

    def ids(self, piece: bytes) -> list[int]:
        """The library's ids of one pre-token."""
        return [t.id for t in self.library.model.tokenize(piece.decode("latin-1").translate(self.as_letters))]
