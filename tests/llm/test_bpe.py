import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from qmeasures.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


TEXTS = ["", " \n\t", "<|endoftext|>", "a<|startoftext|> <|endoftext|>b  c", "x" * 5000, "the" * 3000,
         "İstanbul ΑΣ ΣΑΣ é", "don't'll 've I'M", "日本語 ١٢٣ ՘\U0001F600 🏳️‍🌈", "\x00\x1c\x85​ a"]


def test_words_against_library(library):
    encoder, rng = bpe.Encoder(bpe.load(PATH)), random.Random(3)
    texts = TEXTS + ["".join(rng.choices("abcdefghinorstu'sl 1é!?.ßñ日Σ", k=rng.randint(1, 70))) for _ in range(1500)]
    texts += [chr(c) + "a" + chr(c) for c in range(1, 0x3000)]
    for text in texts:
        assert encoder.text(text) == expected(library, text), text[:60]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_STEPS", 3)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    encoder = bpe.Encoder(bpe.load(PATH))
    for text in ["therefore nothing another therefore antidisestablishmentarianism"] * 2:
        assert encoder.text(text) == expected(library, text)


def test_query_rows(spark, library):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "none"), (99, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, bpe.encode_decode(df, PATH, tokens=True).collect()), key=str)
    want = []
    for i, t in rows:
        n, ids, back = expected(library, t or "")
        want.append((i, n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(),
                     [int(x) for x in ids.split()], back))
    assert got == sorted(want, key=str)
    assert bpe.encode_decode(df.limit(0), PATH).collect() == []


def test_unsupported_file(tmp_path):
    with pytest.raises(ValueError):
        bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
