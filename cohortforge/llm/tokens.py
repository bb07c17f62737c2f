"""Token ids of whole texts, with a cache of space-separated chunks.

A byte-level BPE with the usual pattern never joins text across a single space
between two other characters: each chunk (a space and what follows it up to
the next one) has the same ids by itself as in its text.  Chunks repeat, so
their ids are kept; only new ones go to the tokenizer.  Texts with other
white space next to a space, or a zero character, are encoded whole, as are
all texts if the tokenizer is of another kind.

The vocabulary is the JSON file of the ``tokenizers`` library.  If its merges
are in the order of their ids, as byte-level vocabularies have them, the same
ids come faster from ``tiktoken`` with that file's tokens as ranks; the tests
hold both against each other.  Texts that hold the string of an added token
(such as an end-of-text mark) go whole to the tokenizer as it is in the file,
which gives that string the token's own id.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import cached_property

import numpy as np

# fixed: the pattern of byte-level pre-tokenizers
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHE = 600_000         # chunks kept in a worker, about 130 MB; then the cache starts anew


def _bytes_of_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks(parts: dict) -> dict[bytes, int] | None:
    """The tokens of a byte-level BPE file by their bytes, if ids grow in the order of the merges."""
    model, letters = parts["model"], _bytes_of_letters()
    special = {t["content"] for t in parts.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in merged or merged != sorted(merged) or len(vocabulary) != 256 + len(set(merged)):
        return None
    try:
        return {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
    except KeyError:
        return None


class Encoder:
    """``ids(texts)``: for each text its ids as little-endian unsigned 32-bit bytes.

    ``added``: the strings of special tokens in a text become their ids, as in
    the tokenizer's own default; otherwise they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # one core per task
        self.path, self.added = path, added
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        pre = parts.get("pre_tokenizer") or {}
        self.chunked = (parts.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        self.cache: dict[str, bytes | bool] = {}            # False: can't stand by itself
        # strings that the tokenizer takes out of a text before anything else
        self.taken = [t["content"] for t in parts.get("added_tokens", []) if t["content"] and (added or not t.get("special"))]
        self.fast = None
        found = ranks(parts) if self.chunked else None
        if found:
            import tiktoken

            self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=found, special_tokens={}).encode_ordinary

    @cached_property
    def tokenizer(self):
        """The file's own tokenizer, loaded when a text needs it."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.encode_special_tokens = not self.added
        return found

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.fast:
            return [array("I", self.fast(t)).tobytes() for t in texts]
        return self._by_file(texts)

    def _by_file(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, chunks: set[str]) -> None:
        if len(self.cache) + len(chunks) > CACHE:
            self.cache.clear()
        good = []
        for c in chunks:
            body = c[1:] if c[:1] == " " else c
            if not body or body[0].isspace() or body[-1].isspace():
                self.cache[c] = False
            else:
                good.append(c)
        self.cache.update(zip(good, self._encode(good)))

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.chunked:
            return self._by_file(texts)
        out: list[bytes | None] = [None] * len(texts)
        whole = []
        marked = []
        split = {}
        known = self.cache.get
        missing: set[str] = set()
        for i, text in enumerate(texts):
            if not text:
                out[i] = b""
            elif any(t in text for t in self.taken):
                marked.append(i)
            elif "\0" in text:
                whole.append(i)
            else:
                split[i] = chunks = text.replace(" ", "\0 ").split("\0")
                found = list(map(known, chunks))
                if None in found:
                    missing.update(c for c, f in zip(chunks, found) if f is None)
                elif False in found:
                    whole.append(i)
                    del split[i]
                else:
                    out[i] = b"".join(found)
                    del split[i]
        if missing:
            self._learn(missing)
            for i, chunks in split.items():
                found = list(map(self.cache.get, chunks))
                if None in found:       # the cache started anew meanwhile
                    whole.append(i)
                elif False in found:
                    whole.append(i)
                else:
                    out[i] = b"".join(found)
        for i, e in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = e
        for i, e in zip(marked, self._by_file([texts[i] for i in marked])):
            out[i] = e
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file (kept from task to task)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, added=True)
    return _encoders[path]


def cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else pieces of ``most`` after a shorter first one."""
    if n <= most:
        return [(0, n)] if n else []
    first = n % most
    return ([(0, first)] if first else []) + [(s, most) for s in range(first, n, most)]
