"""Operator 8: exact BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a word there is exactly one token that ends its BPE encoding.  A
suffix automaton of the vocabulary yields the tokens that are suffixes of the prefix,
longest first; the first one that is compatible with the last token of the prefix
before it is the answer and is stored.  Back-pointers from the end of the word then
spell the ids.  Two neighbouring tokens are compatible when BPE on their joined text
gives back just these two; undoing merges from the latest on decides it.

Normalisation and word splitting follow the tokenizer file (NFC, white space runs,
lower case, a split pattern, bytes as printable characters, an end-of-word mark); a
file that needs anything else is refused.  Without a decoder, decoding joins token
strings by one space, as the library does.

Defined results: a null text is encoded as the empty one (no tokens, digests of the
empty string); special tokens inside a text are single ids; very long words cost time
in proportion to their length; repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qmeasures.llm.common import as_texts, bound_batches

#: Below this character, Unicode tables of different age agree on letters, digits and case.
SETTLED = regex.compile("[\\u0530-\\U0010FFFF]")
CACHE_WORDS = 300_000
CACHE_STEPS = 400_000
HEAD = 6  # bytes of a word whose table is kept for the words that begin alike
_SYMBOLS = 1 << 10  # more than the base symbols of a byte vocabulary with word ends


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@dataclass
class Vocabulary:
    """What a task needs to encode: bounded by the tokenizer file, never by the corpus."""

    strings: list[str]
    pattern: str
    normalizer: str    # JSON, for texts beyond SETTLED
    special: dict[str, int]
    lower: bool
    symbol_of_byte: list[int]
    final_of_byte: list[int]
    order: array       # rank of the merge that makes a token, -1 for base symbols
    left: array        # the two parts of a token, itself for base symbols
    right: array
    keys: array        # automaton: state * _SYMBOLS + symbol, sorted
    targets: array
    link: array
    tokens_at: dict[int, tuple[tuple[int, int], ...]]  # state -> (length, token), longest first


def _spec(spec: dict) -> tuple[str, bool]:
    """Split pattern and lower-casing of a supported file."""
    model, normal, split = spec["model"], spec["normalizer"], spec["pre_tokenizer"]
    steps = [x["type"] for x in normal["normalizers"]] if normal and normal["type"] == "Sequence" else None
    cuts = split["pretokenizers"] if split and split["type"] == "Sequence" else [{}, {}]
    if (model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or model["continuing_subword_prefix"]
            or model["dropout"] or model["byte_fallback"] or model.get("ignore_merges") or spec["post_processor"]
            or spec["decoder"] or steps not in (["NFC", "Replace"], ["NFC", "Replace", "Lowercase"])
            or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"} or normal["normalizers"][1]["content"] != " "
            or [c.get("type") for c in cuts] != ["Split", "ByteLevel"] or not cuts[0]["invert"]
            or cuts[0]["behavior"] != "Removed" or cuts[1]["use_regex"] or cuts[1]["add_prefix_space"]
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
        raise ValueError("the tokenizer file has parts that this operator doesn't support")
    return cuts[0]["pattern"]["Regex"], len(steps) == 3


def merge_by_rank(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Plain BPE: apply the earliest merge, leftmost first, until none applies."""
    symbols = list(symbols)
    while len(symbols) > 1:
        best = min((pairs[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in pairs) \
            if any(p in pairs for p in zip(symbols, symbols[1:])) else None
        if best is None:
            break
        i = best[1]
        symbols[i:i + 2] = [pairs[symbols[i], symbols[i + 1]][1]]
    return symbols


class _Builder:
    """Suffix automaton of several strings over small integers."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, symbol: int) -> int:
        """The state for the step from ``at`` by ``symbol`` with exactly one symbol more."""
        target = self.next[at][symbol]
        if self.length[target] == self.length[at] + 1:
            return target
        copy = self._state(self.length[at] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while at >= 0 and self.next[at].get(symbol) == target:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def add(self, string: list[int]) -> None:
        last = 0
        for symbol in string:
            if symbol in self.next[last]:
                last = self._split(last, symbol)
                continue
            new, at = self._state(self.length[last] + 1, {}, 0), last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, symbol)
            last = new

    def walk(self, string: list[int]) -> int:
        at = 0
        for symbol in string:
            at = self.next[at][symbol]
        return at


def load(path: str) -> Vocabulary:
    """Read a tokenizer file on the driver and build its tables."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pattern, lower = _spec(spec)
    ids, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    strings = [""] * (max([*ids.values(), *added.values()]) + 1)
    for text, at in [*ids.items(), *added.items()]:
        strings[at] = text
    order, left = array("i", [-1] * len(strings)), array("i", range(len(strings)))
    right, pairs = array("i", left), {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        a, b = (ids[x] for x in (merge if isinstance(merge, list) else merge.split(" ")))
        made = ids[strings[a] + strings[b]]
        pairs[a, b] = (rank, made)
        if order[made] < 0:
            order[made], left[made], right[made] = rank, a, b
    base: dict[int, list[int]] = {}

    def symbols(token: int) -> list[int]:
        if token not in base:
            base[token] = [token] if order[token] < 0 else symbols(left[token]) + symbols(right[token])
        return base[token]

    whole = [t for t in ids.values() if merge_by_rank(symbols(t), pairs) == [t]]
    characters = byte_characters()
    symbol_of_byte, final_of_byte = [ids[c] for c in characters], [ids[c + "</w>"] for c in characters]
    number = {s: k for k, s in enumerate(sorted({*symbol_of_byte, *final_of_byte}))}
    builder = _Builder()
    for token in sorted(whole, key=lambda t: (len(symbols(t)), t)):
        builder.add([number[s] for s in symbols(token)])
    found: dict[int, list[tuple[int, int]]] = {}
    for token in whole:
        found.setdefault(builder.walk([number[s] for s in symbols(token)]), []).append((len(symbols(token)), token))
    moves = sorted((at * _SYMBOLS + symbol, to) for at, step in enumerate(builder.next) for symbol, to in step.items())
    return Vocabulary(strings, pattern, json.dumps(spec["normalizer"]), added, lower, [number[s] for s in symbol_of_byte],
                      [number[s] for s in final_of_byte], order, left, right, array("q", [k for k, _ in moves]),
                      array("i", [to for _, to in moves]), array("i", builder.link),
                      {at: tuple(sorted(x, reverse=True)) for at, x in found.items()})


class Encoder:
    """Encodes words; keeps bounded tables of automaton steps, pair tests and words."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.rank = {(v.left[t], v.right[t]): v.order[t] for t in range(len(v.order)) if v.order[t] >= 0}
        self.lengths = self._state_lengths()
        self.split = regex.compile(v.pattern)
        self.special = regex.compile("|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) or r"(?!)")
        self.size = self._token_sizes()
        self.fit: dict[int, bool] = {}
        self._forget()
        self.words: dict[str, tuple[str, str, int]] = {}
        self.library: tuple | None = None

    def _state_lengths(self) -> np.ndarray:
        """Longest string of each state: one more than that of a state before it, breadth first."""
        v = self.v
        length = np.zeros(len(v.link), dtype=np.int32)
        keys, targets = np.frombuffer(v.keys, dtype=np.int64) // _SYMBOLS, np.frombuffer(v.targets, dtype=np.int32)
        while True:  # as many rounds as the longest token has symbols
            longer = length.copy()
            np.maximum.at(longer, targets, length[keys] + 1)
            if (longer == length).all():
                return length
            length = longer

    def _token_sizes(self) -> list[int]:
        """Base symbols in each token."""
        v, out = self.v, [1] * len(self.v.order)
        for token in sorted(range(len(v.order)), key=v.order.__getitem__):
            if v.order[token] >= 0:
                out[token] = out[v.left[token]] + out[v.right[token]]
        return out

    def _step(self, state: int, matched: int, symbol: int) -> tuple:
        """(state, matched length, tokens that end here longest first) after one more symbol."""
        v = self.v
        while True:
            key = state * _SYMBOLS + symbol
            at = bisect_left(v.keys, key)
            if at < len(v.keys) and v.keys[at] == key:
                state, matched = v.targets[at], matched + 1
                break
            if state == 0:
                matched = 0
                break
            state = v.link[state]
            matched = int(self.lengths[state])
        ends, up = [], state
        while up > 0:
            ends += [(n, t) for n, t in v.tokens_at.get(up, ()) if n <= matched]
            up = v.link[up]
        return state, matched, tuple(ends)

    def compatible(self, one: int, two: int) -> bool:
        """BPE keeps ``one`` next to ``two``: no merge across the border comes early enough.

        The latest merge of either side is undone first; a merge across the border must
        come before the merge just undone (on the right side: not after it, since the
        leftmost of equal merges is applied first).
        """
        v, limit = self.v, len(self.v.order)
        while True:
            if self.rank.get((one, two), limit) < limit:
                return False
            a, b = v.order[one], v.order[two]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, one = a, v.right[one]
            else:
                limit, two = b + 1, v.left[two]

    def ids(self, word: bytes) -> list[int]:
        v, fit, size = self.v, self.fit, self.size
        symbols = [v.symbol_of_byte[b] for b in word]
        symbols[-1] = v.final_of_byte[word[-1]]
        head = word[:HEAD] if len(word) > HEAD + 1 else None  # its prefixes are the same in all words
        at, node, last = self.heads.get(head, self.start)
        last = last[:]  # for each prefix its last token
        for symbol in symbols[at:] if at else symbols:
            at += 1
            step = node[2].get(symbol)
            if step is None:
                step = self._move(node, symbol)
            node, ends = step
            for n, token in ends:
                before = last[at - n]
                if before < 0:
                    if at == n:
                        break
                    continue
                pair = before << 20 | token
                ok = fit.get(pair)
                if ok is None:
                    if len(fit) > CACHE_STEPS:
                        fit.clear()
                    ok = fit[pair] = self.compatible(before, token)
                if ok:
                    break
            else:
                raise ValueError("the vocabulary does not cover all bytes")
            last.append(token)
            if at == HEAD and head is not None:
                if len(self.heads) >= CACHE_WORDS:
                    self.heads.clear()
                self.heads[head] = at, node, last[:]
        out, at = [], len(symbols)
        while at:
            out.append(last[at])
            at -= size[last[at]]
        return out[::-1]

    def _move(self, node: tuple, symbol: int) -> tuple:
        """The node after one more symbol, with the tokens that end there; remembered in the node."""
        state, matched, ends = self._step(node[0], node[1], symbol)
        if self.known > CACHE_STEPS:
            self._forget()
        key = state << 20 | matched
        if key not in self.nodes:
            self.nodes[key] = (state, matched, {})
        node[2][symbol] = found = (self.nodes[key], ends)
        self.known += 1
        return found

    def _forget(self) -> None:
        root = (0, 0, {})
        self.nodes: dict[int, tuple] = {0: root}
        self.heads: dict[bytes, tuple] = {}
        self.start, self.known = (0, root, [-1]), 0

    def word(self, word: str) -> tuple[str, str, int]:
        """(ids, token strings, count) of a word, the first two joined by spaces."""
        found = self.ids(word.encode())
        made = (" ".join(map(str, found)), " ".join([self.v.strings[t] for t in found]), len(found))
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        self.words[word] = made
        return made

    def _split_by_library(self, text: str) -> list[str]:
        """Normalise and split with the library's own Unicode tables."""
        whole = json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [],
                            "normalizer": json.loads(self.v.normalizer), "pre_tokenizer": None, "post_processor": None,
                            "decoder": None, "model": {"type": "BPE", "vocab": {}, "merges": []}})
        if self.library is None:
            cut = tokenizers.pre_tokenizers.Split(tokenizers.Regex(self.v.pattern), "removed", invert=True)
            self.library = tokenizers.Tokenizer.from_str(whole).normalizer, cut
        normal, cut = self.library
        return [w for w, _ in cut.pre_tokenize_str(normal.normalize_str(text))]

    def _plain(self, text: str) -> list[tuple[str, str, int]]:
        words = self.words
        if SETTLED.search(text):
            return [words.get(w) or self.word(w) for w in self._split_by_library(text)]
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if self.v.lower:
                text = text.replace("Σ", "σ")  # each capital sigma by itself, not the word-final form
        if self.v.lower:
            text = text.lower()
        return [words.get(w) or self.word(w) for w in self.split.findall(text)]

    def text(self, text: str) -> tuple[int, str, str]:
        """(token count, decimal ids, decoded text) of a whole text."""
        parts, at = [], 0
        for hit in self.special.finditer(text):
            parts += self._plain(text[at:hit.start()])
            parts.append((str(self.v.special[hit[0]]), hit[0], 1))
            at = hit.end()
        parts += self._plain(text[at:] if at else text)
        return sum([p[2] for p in parts]), " ".join([p[0] for p in parts]), " ".join([p[1] for p in parts])


_ENCODERS: dict[str, Encoder] = {}  # of this Python worker, by vocabulary


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  tokens: bool = False) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 digests of ids and decoded text; with ``tokens`` also both themselves."""
    spark = docs.sparkSession
    bound_batches(spark)
    vocabulary = load(tokenizer_path)
    shipped = spark.sparkContext.broadcast(vocabulary)
    mark = hashlib.sha256("\0".join(vocabulary.strings).encode()).hexdigest()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[mark] = Encoder(shipped.value)
        encoder = _ENCODERS[mark]
        for batch in batches:
            counts, ids, back, more = [], [], [], ([], [])
            for text in as_texts(batch.column(1)):
                n, numbers, decoded = encoder.text(text)
                counts.append(n)
                ids.append(sha(numbers))
                back.append(sha(decoded))
                if tokens:
                    more[0].append([int(x) for x in numbers.split()])
                    more[1].append(decoded)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if tokens:
                columns += [pa.array(more[0], pa.list_(pa.int32())), pa.array(more[1], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, schema + (", ids array<int>, decoded string" if tokens else ""))
