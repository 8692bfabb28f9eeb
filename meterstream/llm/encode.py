"""Encoding of whole texts with a public tokenizer file."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

RUN = re.compile(r"\s\s")
#: A run of white space (as Unicode has it) too long for a pattern that looks ahead from its end.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{5000,}")
#: The pretokens of the byte-level vocabulary where no white space character follows another: the
#: published pattern without its look-ahead, which then changes nothing and costs a third more time.
SINGLE_SPACED = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"


class Encoder:
    """The ids of a text; strings of special tokens give those tokens.

    A ``.json`` file is read by tokenizers.  A ``.tiktoken`` file (ranks; the
    end-of-text token has the next free id) is read by tiktoken, which gives
    the same ids for the same vocabulary in a fifth of the time.
    """

    def __init__(self, path: str):
        if not path.endswith(".tiktoken"):
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            self.ids = lambda text: t.encode(text, add_special_tokens=False).ids
            return
        import base64

        import tiktoken
        from public_tokenizers import PATTERN
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = {"<|endoftext|>": len(ranks)}
        spaced, single = (tiktoken.Encoding(name, pat_str=p, mergeable_ranks=ranks, special_tokens=special)
                          for name, p in (("any", PATTERN), ("single", SINGLE_SPACED)))

        def some(text: str) -> list[int]:
            e = spaced if RUN.search(text) else single
            return e.encode(text, allowed_special="all") if "<|" in text else e.encode_ordinary(text)

        def ids(text: str) -> list[int]:
            """A long run of white space is a pretoken of its own, but for its last character where more follows."""
            out, at = [], 0
            for run in LONG_SPACE.finditer(text) if len(text) > 5000 else ():
                end = run.end() - (run.end() < len(text))
                out += some(text[at:run.start()])
                out += spaced._core_bpe.encode_single_piece(text[run.start():end].encode())
                at = end
            return out + some(text[at:]) if at else some(text)

        self.ids = ids

    def packed(self, text: str) -> bytes:
        """The ids as unsigned 32-bit numbers, little-endian."""
        a = array("I", self.ids(text))
        if array("H", [1]).tobytes()[0] == 0:
            a.byteswap()
        return a.tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and worker."""
    return Encoder(path)
