import struct

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from meterstream.llm.encode import Encoder

TEXTS = ["", " ", "a  b", "a\n\n b", " \n x", "tab\t here\t\tx", "a \x1c b!\x1c", "x<|endoftext|> y <|endoftext|>",
         "a b  c", "don't 's  're", "é\r\n\r\nü ²½ Ⅷ 12", "can't won't. x' y'' a5 5a a_ é.́ 's.", "a\nb \n", "  x"]


@pytest.fixture(scope="module")
def encoders():
    return Encoder(P.path("byte_bpe_50k.tiktoken")), Encoder(P.path("byte_bpe_50k.json"))


def test_ids_are_those_of_tokenizers(encoders, spark):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()
    for text in TEXTS + [r.text for r in docs]:
        want = t.encode(text, add_special_tokens=False).ids
        for e in encoders:
            assert e.ids(text) == want, text
            assert e.packed(text) == struct.pack(f"<{len(want)}I", *want)


LONG = [c * 2_000_000 for c in (" ", "\n", "\t", "a", "\u00a0")] + [" \n\t\r" * 300_000, "ab " * 400_000, "a  \n" * 300_000]


@pytest.mark.parametrize("run", LONG, ids=lambda t: ascii(t[:4]))
def test_long_runs(encoders, run):
    """White space of any length, which a pattern that looks ahead can't take at once."""
    fast, slow = encoders
    for text in (run, f"word{run}word"):
        assert fast.ids(text) == slow.ids(text)


@pytest.mark.parametrize("n", [4999, 5000, 5001, 10_000])
def test_runs_around_the_limit(encoders, n):
    fast, slow = encoders
    for c in " \n\u3000\x1c":
        for text in (c * n, c * n + "x", f"x{c * n}", f"a{c * n}b{c * (n - 1)} <|endoftext|>{c * n}"):
            assert fast.ids(text) == slow.ids(text)
