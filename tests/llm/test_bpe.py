import random
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import regex
from tokenizers import Tokenizer

from quarryline.llm import bpe

ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\nfoo  bar\n", "a\n b", "aaa aaaa aaaaa", "don't we'll I'VE", "x<|endoftext|>y",
    "a  <|endoftext|>  b", "<|startoftext|>hi<|endoftext|>", "Éàü ß ñ 中文字 🙂🙂 é ΣΑΣ İ", "1234567 8.9", "\t\tx y　z",
    " ́x", "a\x1cb \x85 c", "!!! ??? ...---", "word " * 3000, "z" * 5000, "ab" * 2000, "<| x |>", "line\r\nline\r\n",
    "One, two. Three; four: five! Six? it's, a.b .c, d,, É, x1. 9, ª.", "Wörd, word,\nword. end.", " , . ; a,",
]


def sample(n):
    rng = random.Random(5)
    alphabet = list("abcdefgh  \n'") + [" the", " and", "ing", "É", "ß", "9", ".", "!", "  ", "\t"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_same_as_library(name):
    library, own = Tokenizer.from_file(bpe.public_file(name)), bpe.Bpe(bpe.public_file(name))
    for batch in (ODD, sample(800), ODD[::-1]):
        expected = [e.ids for e in library.encode_batch(batch, add_special_tokens=False)]
        got = [np.frombuffer(x, "<u2").tolist() for x in own.encode(batch)]
        for text, a, b in zip(batch, expected, got):
            assert a == b, repr(text[:60])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("entries", [bpe.MEMO_ENTRIES, 5])
def test_columns_same_as_library(name, entries, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", entries)
    library, own = Tokenizer.from_file(bpe.public_file(name)), bpe.Bpe(bpe.public_file(name))
    accents = ["Été où, naïve. ŁÓDŹ; Ĳsselmeer ſo ŉ ǅ İstanbul Ёлка, мир! ΣΑΣ e\u0301te\u0301 ﬁn q\u0323\u0307x"]
    for texts in (ODD, sample(400), ODD[::-1], accents, [""], ["<|endoftext|>"], ["a<|endoftext|>", "b", ""], []):
        ids, counts = own.encode_column(pa.array(["skipped", *texts], pa.string())[1:])
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in expected]
        assert ids.tolist() == [i for x in expected for i in x]


def test_plain_letters():
    """Arrow's lower case, normal form and the pattern agree with Python's for every letter of a plain word."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    letters = pa.array(every).filter(pc.match_substring_regex(pa.array(every), bpe.PLAIN))
    for letter, lower in zip(letters.to_pylist(), pc.utf8_lower(letters).to_pylist()):
        assert lower == letter.lower() and unicodedata.normalize("NFC", letter) == letter
        assert not unicodedata.combining(letter) and regex.fullmatch(r"\p{L}", lower)


def test_decode_is_the_text():
    own = bpe.Bpe(bpe.public_file("byte_bpe_50k.json"))
    assert [own.decode(np.frombuffer(x, "<u2")) for x in own.encode(ODD)] == ODD


def test_small_memo(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 5)
    own, other = bpe.Bpe(bpe.public_file("byte_bpe_50k.json")), bpe.Bpe(bpe.public_file("byte_bpe_50k.json"))
    assert [own.encode([t])[0] for t in sample(50)] == other.encode(sample(50))


def test_frame(spark):
    rows = [(1, "a b", "x"), (None, None, "y"), (1, "a b", "x"), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encode_decode(docs, bpe.public_file("byte_bpe_50k.json")).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in got) == [(0, 0, ""), (1, 2, "a b"), (1, 2, "a b"), (2, 0, "")]
    assert bpe.digests(docs.limit(0), bpe.public_file("byte_bpe_50k.json")).count() == 0
