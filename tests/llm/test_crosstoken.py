import hashlib
import random
from bisect import bisect_right
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from qmeasures.llm import crosstoken

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "Hello world  foo", "a\tb\nc", "<|endoftext|> x <s></s> <unk>", "ﬁ ½ é", "日本語のテキスト",
         "\u2581 lower block", "🏳️‍🌈 \U0001F600", "x" * 3000, "word " * 2000, "a\x00b", "don't I'LL", "\u2581", "  two  spaces ",
         "\n" * 4000, " " * 3000 + "x", "the cat", "the cat", "dup dup dup"]


class Slow:
    """Groups and links of one text from byte offsets of single tokens, without windows."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def spans(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
                   for i, p in zip(b, map(self.b.id_to_piece, b))]
        want = b" " + text.encode()
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            return None
        out = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            at, spans = 0, []
            for i, part in zip(ids, parts):
                spans.append((i, at, at + len(part)))
                at += len(part)
            out.append(spans)
        return out

    def text(self, text):
        found = self.spans(text) if text else None
        if not found:
            return (0, 0, 0, 0, ""), []
        a, b = found
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [([], []) for _ in ends]
        for side, spans in enumerate(found):
            for i, start, _ in spans:
                groups[bisect_right(ends, start)][side].append(str(i))
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        told = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        return (len(a), len(b), len(groups), len(links), hashlib.sha256(told.encode()).hexdigest()), links


def expected(rows):
    slow = Slow()
    docs = [(i, *slow.text(t)) for i, t in rows]
    count = Counter(pair for _, _, links in docs for pair in links)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return sorted(((i, *plain, sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links))
                   for i, plain, links in docs), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, block long, pairs int")
    return sorted(map(tuple, crosstoken.align_corpus(df, A, B).collect()), key=str)


def random_texts(rng, n):
    words = ["".join(rng.choices("abehinorst日éß'1", k=rng.randint(1, 12))) for _ in range(150)]
    return ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", ". ", ""]) for _ in range(rng.randint(0, 60)))
            for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    texts = TEXTS + random_texts(random.Random(9), 120)
    return [*enumerate(texts), (3, TEXTS[3]), (None, "no id"), (7, "other text of an id")]


def test_against_slow(spark, rows):
    want = expected(rows)
    assert got(spark, rows) == want
    assert sum(r[1] == 0 for r in want) >= 3 and sum(r[1] > 0 for r in want) > 100


def test_remembered_windows_change_nothing(rows):
    """Driven without Spark: each text in a block of its own, and all in one."""
    aligner = crosstoken.Aligner(crosstoken.load(A, B))
    whole = crosstoken._Block(0, crosstoken._Numbers(aligner))
    whole.add([i for i, _ in rows], [t for _, t in rows])
    for (i, text), doc in zip(rows, whole.docs):
        single = crosstoken._Block(1, crosstoken._Numbers(aligner))
        single.add([i], [text])
        assert single.docs[0][:5] == doc[:5], text
    assert len(whole.windows) < sum(len(d[5]) for d in whole.docs) / 2


def test_many_blocks_share_counts(spark, rows, monkeypatch):
    many = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(23)
    assert sorted(map(tuple, crosstoken.align_corpus(many, A, B).collect()), key=str) == expected(rows)


def test_empty_table_and_texts_without_tokens(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None), (2, "")]) == [(1, 0, 0, 0, 0, "", 0, 0), (2, 0, 0, 0, 0, "", 0, 0)]


def test_without_ranks_the_library_encodes(rows):
    v = crosstoken.load(A, B)
    assert v.a_ranked
    fast = crosstoken.Aligner(v)
    v.a_ranked = False
    plain = crosstoken.Aligner(v)
    texts = [t for _, t in rows]
    assert plain.fast is None and plain.tokens(texts) == fast.tokens(texts)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        crosstoken.load(public_tokenizers.path("word_bpe_49k.json"), B)
