"""A public tokenizer file as tasks need it: the file's content, its words' ids, its pieces."""

import functools
import json
import re

from tokenizers import Tokenizer


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


@functools.lru_cache(maxsize=4)
def loaded(content: str) -> Tokenizer:
    """One per Python worker and file."""
    return Tokenizer.from_str(content)


@functools.cache
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the letters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


@functools.cache
def letter_bytes() -> dict[str, int]:
    return {letter: byte for byte, letter in byte_letters().items()}


def spelled(word: str) -> str:
    """A word in the letters of a byte-level vocabulary."""
    return word.encode("utf-8").decode("latin-1").translate(byte_letters())


def model_ids(tokenizer: Tokenizer, word: str) -> list[int]:
    """Ids of one pre-token: merges only, without normaliser or pre-tokenizer."""
    return [token.id for token in tokenizer.model.tokenize(spelled(word))]


def special_strings(content: str) -> dict[str, int]:
    """Special tokens that the library takes out of a raw text before anything else."""
    found = {}
    for token in json.loads(content)["added_tokens"]:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"special token {token['content']!r} has rules that are not supported")
        if token["content"][:1].isalnum() or token["content"][:1].isspace():
            raise ValueError(f"special token {token['content']!r} begins like a word")
        found[token["content"]] = token["id"]
    return found


def special_pattern(content: str) -> str:
    """Longest first, as a regular expression that both Java and Python read alike."""
    names = sorted(special_strings(content), key=lambda s: (-len(s), s))
    return "|".join(re.sub(r"([^A-Za-z0-9_])", r"\\\1", name) for name in names)


def piece_bytes(content: str) -> list[bytes | None]:
    """Bytes of every id; None for ids that the file does not have."""
    known = json.loads(content)["model"]["vocab"] | special_strings(content)
    pieces: list[bytes | None] = [None] * (max(known.values()) + 1)
    back = letter_bytes()
    for piece, number in known.items():
        pieces[number] = (
            bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode("utf-8")
        )
    return pieces
