"""Whole texts to token ids by the tokenizers library, each distinct word encoded once per worker.

Most words of a corpus repeat, so the library sees only words that a worker has not met lately, many joined in one call.
A text is cut into units before a space or line feed that stands alone between two characters that are not white
space. Neither byte-level nor word-end BPE ever joins characters across such a place, whatever follows, and special
strings hold no white space; so ids of a text are the ids of its units in order. Everything else stays inside one unit.

Most units are Latin letters, perhaps with marks behind them. The library's normalizers leave such letters as they are (in small ones, where
it lower-cases), and its patterns cut between letters and marks; so the letters go straight to the library's BPE model, which takes half the
time, and the few kinds of marks are encoded once. Vocabularies with other normalizers or patterns do without that.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Callable

import numpy as np

from wardflow.llm.common import quiet_tokenizers

_ADJACENT = re.compile(r"\s\s")
_PLACES = re.compile(r"(?<=\S)(?=[ \n]\S)")
LONGEST_CACHED = 64
#: The library is fastest on short texts: 9 microseconds a word at 1,000 characters, 14 at 20,000.
JOINED_CHARS = 1_000
WORDS_TOGETHER = 8_000
#: Latin letters that no normalizer changes but for their case, and the ASCII marks after them.
_PLAIN = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)").fullmatch
_LATIN = [chr(c) for c in range(0xC0, 0x100)]
MOST_MARKS = 20_000


def keys(text: str) -> list[str]:
    """A short key for each unit of a text, in order (see ``unit_of``).

    The common unit, a space and a word, has the word as its key, so that splitting is all the work.
    """
    if not text:
        return []
    if _ADJACENT.search(text) or text[0].isspace() or text[-1].isspace():
        return [u[1:] if u[0] == " " and len(u) > 1 and not u[1].isspace()
                else u if u[0] == "\n" and len(u) > 1 and not u[1].isspace() else "\r" + u
                for u in _PLACES.split(text)]
    found = text.replace("\n", " \n").split(" ")
    found[0] = "\r" + found[0]
    return found


def unit_of(key: str) -> str:
    return key[1:] if key[0] == "\r" else key if key[0] == "\n" else " " + key


def _places_of_none(values: list) -> list[int]:
    places, at = [], -1
    try:
        while True:
            at = values.index(None, at + 1)
            places.append(at)
    except ValueError:
        return places


class Remembered:
    """A bounded memory of what ``make`` gave for each unit: two generations, the older one dropped when full."""

    def __init__(self, make: Callable[[list[str]], list], most: int = 250_000):
        self.make, self.most = make, most
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def of(self, parts: list[str]) -> list:
        young = self.young
        found = list(map(young.get, parts))
        gaps = _places_of_none(found)
        if not gaps:
            return found
        here, unknown = {}, []
        for u in {parts[i] for i in gaps}:
            if (was := self.old.get(u)) is None:
                unknown.append(u)
            else:
                here[u] = was
        if unknown:
            here.update(zip(unknown, self.make([unit_of(k) for k in unknown]), strict=True))
        for i in gaps:
            found[i] = here[parts[i]]
        if len(young) > self.most:
            self.old, self.young = young, {}
        self.young.update((u, v) for u, v in here.items() if len(u) <= LONGEST_CACHED)
        return found


def _cuts_at_letters(tokenizer) -> bool:
    """Whether the normalizers change nothing but case in Latin letters and the patterns cut between them and marks: what is known of two set-ups."""
    said = json.loads(tokenizer.to_str())
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
    if said["model"]["type"] != "BPE" or any(not a["special"] or a["content"][:2] != "<|" for a in said["added_tokens"]):
        return False
    if said["normalizer"] is None:
        return said["pre_tokenizer"] == byte_level | {"use_regex": True}
    words = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    return said["normalizer"] == {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]} and (
        said["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": words}, "behavior": "Removed", "invert": True}, byte_level | {"use_regex": False}]})


class Encoder:
    """Little-endian 32-bit ids of texts, without special tokens added."""

    def __init__(self, path: str, most: int = 500_000):
        quiet_tokenizers()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        #: The vocabulary lower-cases, so texts may be lower-cased before words are looked up.
        self.folds = '"Lowercase"' in self.tokenizer.to_str()[:4000]
        self.memory = Remembered(self._encode, most)
        self.cuts_at_letters = _cuts_at_letters(self.tokenizer)
        if self.cuts_at_letters:
            from tokenizers import pre_tokenizers
            as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.tokenize, self.marks = self.tokenizer.model.tokenize, {}
            self.latin = {ord(c): as_bytes.pre_tokenize_str(c)[0][0] for c in _LATIN}
            self.space = "" if self.folds else as_bytes.pre_tokenize_str(" ")[0][0]
            self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of each unit: of plain ones by the model alone, of others by all of the library."""
        if not self.cuts_at_letters:
            return self._by_library(parts)
        found, here, others = [], {}, []
        young, old, packed, tokenize, folds = self.memory.young, self.memory.old, self.packed, self.tokenize, self.folds
        for u in parts:
            if not (plain := _PLAIN(u)):
                found.append(None)
                others.append(u)
                continue
            lead, letters, marks = plain.groups()
            if folds:
                letters = letters.lower()
            key = letters if folds or lead == " " else "\r" + letters  # without marks the letters are a unit themselves
            ids = here.get(key) or young.get(key) or old.get(key)
            if ids is None:
                word = letters if letters.isascii() else letters.translate(self.latin)
                ids = here[key] = b"".join([packed[t.id] for t in tokenize(self.space + word if lead == " " else word)])
            if marks:
                ids += self._of_marks(marks)
            found.append(self._of_marks(lead) + ids if lead == "\n" and not folds else ids)
        rest = iter(self._by_library(others))
        return [next(rest) if ids is None else ids for ids in found]

    def _of_marks(self, marks: str) -> bytes:
        if (ids := self.marks.get(marks)) is None:
            if len(self.marks) >= MOST_MARKS:
                self.marks.clear()
            ids = self.marks[marks] = np.array(self.tokenizer.encode(marks, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return ids

    def _by_library(self, parts: list[str]) -> list[bytes]:
        """Ids of each unit. Units that start with white space, as nearly all do, are encoded joined."""
        out: dict[str, bytes] = {}
        joined = [u for u in parts if u[0] in " \n" and len(u) > 1 and not u[1].isspace() and not u[-1].isspace()]
        group, size = [], 0
        for u in [*joined, None]:
            if group and (u is None or size > JOINED_CHARS):
                out.update(zip(group, self._together(group), strict=True))
                group, size = [], 0
            if u is not None:
                group.append(u)
                size += len(u)
        for u in parts:
            if u not in out:
                out[u] = np.array(self.tokenizer.encode(u, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return [out[u] for u in parts]

    def _together(self, group: list[str]) -> list[bytes]:
        said = self.tokenizer.encode("".join(group), add_special_tokens=False)
        ids = np.array(said.ids, dtype="<u4").tobytes()
        starts = [start for start, _ in said.offsets]
        ends, cuts = 0, [0]
        for u in group:
            ends += len(u)
            cuts.append(bisect_right(starts, ends - 1))
        return [ids[4 * a:4 * b] for a, b in zip(cuts, cuts[1:])]

    def ids(self, text: str | None) -> bytes:
        return b"".join(self.memory.of(self._keys(text)))

    def many(self, texts: list[str | None]) -> list[bytes]:
        """``ids`` of each text; the words of several short texts are looked up together."""
        out, parts, ends = [], [], []
        for k, text in enumerate(texts):
            parts += self._keys(text)
            ends.append(len(parts))
            if len(parts) > WORDS_TOGETHER or k == len(texts) - 1:
                found = self.memory.of(parts)
                out += [b"".join(found[a:b]) for a, b in zip([0, *ends], ends)]
                parts, ends = [], []
        return out

    def _keys(self, text: str | None) -> list[str]:
        if text and self.folds and "<|" not in text:  # a special string is matched before lower-casing
            text = text.encode("utf-8").lower().decode("utf-8")  # bytes: A-Z alone
        return keys(text or "")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
