"""What a tokenizer file holds, and how it cuts text into the pieces that it merges."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache
from pathlib import Path

import regex

# The split patterns that the tokenizer files name, with the white
# space that the tokenizers library means by \s (Python's adds U+001C to U+001F).
SPACE = "\t-\r \x85\xa0  -     　"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

# Up to U+024F the classes are spelled out, since Python's own engine is faster;
# `RECENT` holds the characters on which Unicode versions may differ.
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN_DIGITS = "0-9²³¹¼½¾"
LATIN_SPACE = "\t-\r \x85\xa0"
SEPARATORS = re.compile("[\x1c-\x1f]")
BEYOND_LATIN = re.compile("[^\x00-ɏ]")
RECENT = re.compile(
    "[՘֋֌࢏౜೜Ᲊ₏₝-₟Ɤ-ꟿ꭬꭭\U00010000-\U0010ffff]"
)


spaced_out = re.compile(f"[^{SPACE}]+").findall


def byte_level(letters: str, digits: str, space: str, engine):
    """Byte-level pieces: an optional blank goes with the letters, digits or marks after it."""
    return engine.compile(
        rf"{CONTRACTIONS}| ?[{letters}]+| ?[{digits}]+| ?[^{space}{letters}{digits}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def word_level(letters: str, digits: str, space: str, engine):
    """Words, single digits and runs of marks; white space is dropped."""
    return engine.compile(rf"{CONTRACTIONS}|[{letters}]+|[{digits}]|[^{space}{letters}{digits}]+")


@cache
def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def read_file(path: str) -> str:
    """The tokenizer file's text, a few MB of fixed size, read once by the driver."""
    return Path(path).read_text(encoding="utf-8")


class Splitter:
    """Cuts text into pieces exactly as the tokenizer of the file does.

    Text with characters of recent Unicode versions is cut by the library itself.
    """

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        parsed = json.loads(source)
        self.specials = {token["content"]: token["id"] for token in parsed["added_tokens"]}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))))
        self.normalizes = parsed["normalizer"] is not None
        make = word_level if self.normalizes else byte_level
        self.latin = make(LATIN_LETTERS, LATIN_DIGITS, LATIN_SPACE, re).findall
        self.any = make(r"\p{L}", r"\p{N}", SPACE, regex).findall

    def normalized(self, text: str) -> str:
        """The text as the tokenizer's normalizer leaves it."""
        if not self.normalizes:
            return text
        if RECENT.search(text):
            return self.library.normalizer.normalize_str(text)
        text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def cut(self, text: str) -> list[str]:
        """The pieces of normalized text without special strings."""
        if not BEYOND_LATIN.search(text):
            return self.latin(text)
        if not RECENT.search(text):
            return self.any(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """The pieces of text without special strings."""
        return self.cut(self.normalized(text))

    def words(self, text: str) -> list[str]:
        """Normalized text between white space, which word-level pieces never cross."""
        text = self.normalized(text)
        return spaced_out(text) if SEPARATORS.search(text) else text.split()

    def parts(self, text: str) -> list[tuple[str, str | None]]:
        """Stretches of ordinary text, each with the special string that ends it, if any."""
        found, at = [], 0
        if self.specials:
            for match in self.special_pattern.finditer(text):
                found.append((text[at : match.start()], match.group()))
                at = match.end()
        found.append((text[at:], None))
        return found
