"""Cuts texts into the pieces that a word tokenizer file encodes one by one.

The kind of file: normal form, white space as blanks and lower case; pieces by one
split pattern, white space dropped; bytes written as characters; merges with a mark at
the end of a word. Pieces of such a file never see their neighbours, so the ids of a
text are those of its pieces one after the other.
"""

from __future__ import annotations

import json
import re
from functools import cached_property
from pathlib import Path

# Texts of these characters only, without the opening of a special token, are cut by a
# pattern of our own: lower-casing and normal forms are plain for them.
_PLAIN_CHARACTERS = "[\t\n\r\\x20-;=-~¡-įı-ſ]"
_PLAIN = re.compile(rf"{_PLAIN_CHARACTERS}*+(?:<(?!\|){_PLAIN_CHARACTERS}*+)*+")
# The split pattern of the tokenizer, for lower-case plain texts.
_LETTER = "a-zªµºß-öø-ſ"
_NUMBER = "0-9²³¹¼-¾"
_PIECE = re.compile(f"[{_LETTER}]+|[{_NUMBER}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{_LETTER}{_NUMBER}]+")

# What a file must state for its texts to be cut here.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_MODEL = {
    "type": "BPE",
    "dropout": None,
    "unk_token": None,
    "continuing_subword_prefix": None,
    "fuse_unk": False,
    "byte_fallback": False,
    "ignore_merges": False,
}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is printed, else one from 256 on."""
    printed = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in printed else chr(next(others)) for b in range(256)]


def unsupported(file: dict) -> str | None:
    """What a tokenizer file has that the cutting and merging here does not cover."""
    normalizer, split = file.get("normalizer") or {}, file.get("pre_tokenizer") or {}
    if normalizer.get("type") != "Sequence" or normalizer.get("normalizers") != _NORMALIZERS:
        return "normalizer"
    steps = split.get("pretokenizers") or []
    if split.get("type") != "Sequence" or [s.get("type") for s in steps] != ["Split", "ByteLevel"]:
        return "pre_tokenizer"
    by, level = steps
    if by.get("pattern") != {"Regex": _SPLIT} or by.get("behavior") != "Removed" or not by.get("invert"):
        return "pre_tokenizer"
    if level.get("add_prefix_space") or level.get("use_regex"):
        return "pre_tokenizer"
    model = file.get("model") or {}
    if any(model.get(name) != value for name, value in _MODEL.items()) or not model.get("end_of_word_suffix"):
        return "model"
    for token in file.get("added_tokens") or []:
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            return "added_tokens"
        if not token["content"].startswith("<|"):
            return "added_tokens"
    return None


class Pieces:
    """Cuts texts as the tokenizer file at ``path`` does; a file of another kind is an error."""

    def __init__(self, path: str):
        self.path = path
        self.file = json.loads(Path(path).read_text(encoding="utf-8"))
        other = unsupported(self.file)
        if other:
            raise ValueError(f"{path}: its {other} is not that of a word tokenizer with merges and word ends")
        self.special = {t["content"]: t["id"] for t in self.file["added_tokens"]}
        longest = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, longest))) if longest else None
        self._bytes = {ord(c): b for b, c in enumerate(byte_characters())}

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def cut(self, text: str) -> list[str | int]:
        """Pieces in lower case, and the ids of the special tokens between them."""
        if _PLAIN.fullmatch(text):
            return _PIECE.findall(text.lower())
        out: list[str | int] = []
        at = 0
        for match in self._special.finditer(text) if self._special else ():
            out += self._general(text[at : match.start()])
            out.append(self.special[match.group()])
            at = match.end()
        return out + self._general(text[at:])

    def _general(self, text: str) -> list[str]:
        """Normal form and split by the rules of the file, as the library reads them."""
        if not text:
            return []
        formed = self.library.normalizer.normalize_str(text)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(formed)
        return [bytes(p.translate(self._bytes), "latin-1").decode("utf-8") for p, _ in pieces]
