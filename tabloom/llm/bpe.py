"""Byte-level BPE from a tokenizer file, for Python workers."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import tiktoken

_LOADED: dict[str, ByteBpe] = {}

#: How the byte-level pre-tokenizer cuts a text; a fixed value of the file format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The pattern's engine keeps a state for each character of a run of white space and gives up at 1,000,000 of them.
# Longer runs than this are cut out before. The characters are the pattern's white space, which is not Python's.
_LONG = 100_000
_RUN = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{_LONG},}}")


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the others follow from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _check_merges(model: dict, special: dict[str, int], path: str) -> None:
    """Refuse a file whose ids are not the order of its merges: the merge loop here goes by ids alone.

    Every token but the single bytes must be made by one merge, and later merges must make larger ids.
    """
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    made = [model["vocab"].get("".join(pair), -1) for pair in pairs]
    rising = all(a < b for a, b in zip(made, made[1:]))
    if not rising or -1 in made[:1] or len(made) + len(_byte_of()) != len(model["vocab"].keys() - special.keys()):
        raise ValueError(f"the ids of {path} do not follow its merges")


class ByteBpe:
    """Encodes as the file's own library does with default settings, special tokens in a text included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] or spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is no plain byte-level BPE")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = _byte_of()
        ranks = {
            bytes(byte_of[c] for c in token): number
            for token, number in spec["model"]["vocab"].items()
            if token not in special
        }
        _check_merges(spec["model"], special, path)
        self.core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = re.compile(f"({'|'.join(map(re.escape, special))})" if special else "(?!)")

    def encode(self, text: str) -> np.ndarray:
        if len(text) < _LONG or not _RUN.search(text):
            return self.core.encode_to_numpy(text, allowed_special="all")
        return np.concatenate([ids for part in self.special.split(text) for ids in self._around_runs(part)])

    def encode_plain(self, text: str) -> np.ndarray:
        """As ``encode``, with special tokens in the text read as plain text."""
        if len(text) < _LONG or not _RUN.search(text):
            return self.core.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        return np.concatenate(list(self._around_runs(text, set())))

    def _around_runs(self, text: str, special: set[str] | str = "all") -> Iterator[np.ndarray]:
        """The ids of a special token or of text without one.

        The pattern cuts before a run of white space, and before its last character if text follows. What
        lies between is one piece, whatever its length.
        """
        at = 0
        for run in _RUN.finditer(text):
            end = run.end() - (run.end() < len(text))
            yield self.core.encode_to_numpy(text[at : run.start()], allowed_special=special, disallowed_special=())
            yield np.array(self.core._encode_single_piece(text[run.start() : end]), np.uint32)
            at = end
        yield self.core.encode_to_numpy(text[at:], allowed_special=special, disallowed_special=())

    def decode(self, ids: np.ndarray) -> str:
        return self.core.decode_bytes(ids.tolist()).decode("utf-8", errors="replace")


def load(path: str) -> ByteBpe:
    """The tokenizer, read once per worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]
