"""Token ids by a public byte-level BPE file."""
from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

TOKENIZER = "byte_bpe_50k.json"
SLICE = 1 << 20  # characters encoded at once
LONE_BLANK = re.compile(r" (?<=\S )(?=\S)")
LONG_BLANK = re.compile(r"\s{5000}")  # such runs are too long for the faster library's patterns


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def text_encoder(path: str, dtype: str = "<u4") -> TextEncoder:
    """One per worker process, so that its tasks read the vocabulary once."""
    return TextEncoder(path, dtype)


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [i for i in range(256) if i not in set(plain)]
    return {chr(i): i for i in plain} | {chr(256 + k): i for k, i in enumerate(rest)}


def units(text: str) -> list[str] | None:
    """The text cut before each blank, the blanks left out, and before each line feed; None where that is no plain cut.

    Plain texts are printable, and their blanks and line feeds stand alone between other characters. There the splitting
    rule of the vocabulary always starts a piece at a blank and around a line feed, so ids of a text are those of its units.
    """
    if not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n " in text or " \n" in text or "\n\n" in text:
        return None
    return text.replace("\n", " \n").split(" ") if text.replace("\n", "").isprintable() else None


class ByteBPE:
    """Ids of texts as lists. Byte-level files whose merges are in the order of their ids are read into the faster of two
    libraries; both give the same ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        letters, names = byte_letters(), self.slow.get_vocab()
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        special = {t["content"] for t in data.get("added_tokens", ())}
        #: bytes of each id
        self.bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes[i] = name.encode() if name in special or not all(c in letters for c in name) else bytes(letters[c] for c in name)
        self.fast = None
        pre = data.get("pre_tokenizer") or {}
        merged = [names.get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1), -1) for m in data["model"].get("merges", ())]
        if data["model"]["type"] == "BPE" and not data.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and merged == sorted(merged):
            ranks = {self.bytes[i]: i for name, i in names.items() if name not in special}
            self.fast = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or (len(text) > 5000 and LONG_BLANK.search(text)):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class TextEncoder:
    """Ids of texts as little-endian bytes of `dtype`.

    Texts are encoded as they come: looking up known words costs more than the faster library takes for them.
    """

    def __init__(self, path: str, dtype: str = "<u4", size: int = SLICE):
        self.bpe, self.dtype, self.size = ByteBPE(path), np.dtype(dtype), size

    def encode(self, text: str) -> bytes:
        """In slices of about `size` characters, cut where the splitting rule always cuts, so that memory beside the ids is bounded."""
        out, at = [], 0
        while at < len(text):
            cut = LONE_BLANK.search(text, at + self.size) if len(text) - at > self.size else None
            stop = cut.start() if cut else len(text)
            out.append(np.array(self.bpe.ids(text[at:stop]), self.dtype).tobytes())
            at = stop
        return b"".join(out)
