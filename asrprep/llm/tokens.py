"""Token ids of whole texts inside Python workers, by public tokenizer files.

The files are named by path; each worker loads a file once.
"""

from __future__ import annotations

import base64
import json
import os
import re
import unicodedata
import numpy as np

def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEndIds:
    """Ids by a ``tokenizers`` file of byte-level BPE with word ends, lower case, white space dropped.

    Texts of Latin letters take a faster way with the same ids: they are cut into the file's words
    here and a zero byte is put at each word's end; ``tiktoken`` then merges by the file's own merges, with
    "letter and word end" as the first merges of all. Other texts, and texts that hold a zero byte, go to the
    ``tokenizers`` library. So do texts that hold an added token such as ``<|endoftext|>``, which there is one id.
    """

    _made: dict = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(re.escape(t.lower()) for t in added) or r"(?!)").search  # in lower case
        with open(path, encoding="utf-8") as f:
            bpe = json.load(f)["model"]
        byte_of = _byte_alphabet()
        char_of = {b: c for c, b in byte_of.items()}

        def raw(token: str) -> bytes:
            body = token.removesuffix("</w>")
            return bytes(byte_of[c] for c in body) + (b"\0" if body != token else b"")

        ranks, ids = {}, []
        tokens = [(bytes([b]), char_of[b]) for b in range(256)]
        tokens += [(bytes([b, 0]), char_of[b] + "</w>") for b in range(1, 256)]
        tokens += [(raw(t), t) for t in ("".join(m if isinstance(m, list) else m.split(" ")) for m in bpe["merges"])]
        for b, t in tokens:
            if b not in ranks:
                ranks[b] = len(ranks)
                ids.append(bpe["vocab"][t])
        self.ids = np.array(ids, "<u4")
        self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        letter, number, space = _latin_classes()
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+").findall
        self.other = re.compile(f"[^\\u0001-\\u{_LATIN - 1:04x}]").search

    @classmethod
    def of(cls, path: str) -> "WordEndIds":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit numbers."""
        if not text:
            return np.zeros(0, "<u4")
        lower = text.lower()
        if self.other(text) or self.other(lower) or self.added(lower):
            return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4")
        words = self.words(lower)
        return self.ids[np.array(self.fast.encode_ordinary("\0".join(words) + "\0"), np.int64)] if words else np.zeros(0, "<u4")


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabulary files: printable bytes for
    themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


_ENCODINGS: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_encoding(path: str):
    """The ``tiktoken`` encoding of a rank file, without special tokens."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        _ENCODINGS[path] = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN,
                                             mergeable_ranks=read_ranks(path), special_tokens={})
    return _ENCODINGS[path]


_LATIN = 0x250


def _latin_classes() -> tuple[str, str, str]:
    """Letters, numbers and white space below U+0250 as bodies of character classes."""
    def body(test) -> str:
        return "".join(f"\\u{c:04x}" for c in range(_LATIN) if test(c))

    return (body(lambda c: unicodedata.category(chr(c))[0] == "L"), body(lambda c: unicodedata.category(chr(c))[0] == "N"),
            body(lambda c: c in (0x20, 0x85, 0xA0) or 9 <= c <= 13))


def splitter():
    """The function that lists a text's matches of ``public_tokenizers.PATTERN``.

    Texts of Latin letters go through the standard library's faster matcher, with the classes of
    the pattern written out for those code points; others through ``regex``.
    """
    import public_tokenizers
    import regex

    letter, number, space = _latin_classes()
    latin = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                       rf"|[{space}]+(?![^{space}])|[{space}]+").findall
    whole = regex.compile(public_tokenizers.PATTERN).findall
    beyond = re.compile(f"[^\\u0000-\\u{_LATIN - 1:04x}]").search
    return lambda text: whole(text) if beyond(text) else latin(text)
