"""Byte-level BPE encoding over a trie of distinct words, and decoding.

Two neighbouring tokens stay apart if the merges, replayed on the bytes of both, never cross the border between
them. A sequence of tokens is the encoding of its bytes exactly if all its neighbours stay apart. So the last token
of a prefix is the one vocabulary token that ends the prefix and stays apart from the last token of what comes
before it, and a whole encoding is read off last tokens from right to left.

Distinct words are inserted into a trie in byte order, which is the order of a depth-first traversal, so of the trie
no more is held than the path to the current word. A node gets its last token from the nodes above it; the nodes of
a prefix shared with the word before are still on the path and are never worked out again. Tokens come from the
vocabulary, the ranks of merges and this recurrence alone; the tokenizer library only splits texts that hold rarely
used scripts into words.

Scale: a map over the scan, nothing is shuffled. A worker keeps a bounded memo of words from task to task; when it is
full it starts anew, which costs time and changes nothing. Long texts are cut where a
single space stands between two characters that are no white space, where a word always begins.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallymart.llm.units import tokenizer

#: Words a worker remembers per generation, and pairs of tokens.
WORDS, PAIRS = 300_000, 400_000
#: Characters of text whose words are looked up together, and at which a long text is cut.
GROUP, PART = 2_000_000, 65_536
SLICE = 1024
BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
#: Fixed value: how a byte-level tokenizer cuts a text into words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Scripts in which two versions of Unicode may disagree on letters and digits; the library cuts texts that hold them.
UNSURE = re.compile("[՘-೿₀-₟꜀-꯿\U00010000-\U0010ffff]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Vocabulary:
    """Tokens as bytes, the two tokens each is merged from, and which neighbours stay apart."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, split = whole["model"], whole.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or whole.get("normalizer") or not split.get("use_regex", True):
            raise ValueError("the file is no byte-level BPE without normalizer and prefix space")
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("the file has a BPE option that has no counterpart here")
        letters = byte_letters()
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in whole.get("added_tokens", [])}
        if any(t.get(k) for t in whole.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")) or any(c.isspace() for s in self.special for c in s):
            raise ValueError("an added token has a rule that has no counterpart here")
        size = 1 + max([*ids.values(), *self.special.values()])
        self.bytes = [b""] * size
        for text, n in [*ids.items(), *self.special.items()]:
            known = all(c in letters for c in text)
            self.bytes[n] = bytes(letters[c] for c in text) if known else text.encode()
        self.size = list(map(len, self.bytes))
        self.left, self.right, self.rank = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made = ids[a + b]
            if self.rank[made] >= 0:
                raise ValueError("two merges make the same token")
            self.left[made], self.right[made], self.rank[made] = ids[a], ids[b], rank
            self.merge[ids[a] << 32 | ids[b]] = rank
        self.known: dict[int, bool] = {}
        self.ids = {self.bytes[n]: n for n in self.genuine(ids.values())}
        # Of the tokens of four bytes or more that end in the same four bytes, the longest.
        self.longest: dict[bytes, int] = {}
        for token in sorted(self.ids, key=len):
            if len(token) > 3:
                self.longest[token[-4:]] = len(token)

    def uncrossed(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge of rank below ``limit`` crosses the border of a and b while they are still being merged.

        Time runs backwards: of the tokens at the border, the one made last is taken apart first. A merge across
        them would have come first if its rank is below that of what was made; of two equal merges the left one
        comes first.
        """
        while True:
            if self.rank[a] > self.rank[b]:
                limit, a = self.rank[a], self.right[a]
            elif self.rank[b] >= 0:
                limit, b = self.rank[b] + 1, self.left[b]
            else:
                return True
            if self.merge.get(a << 32 | b, limit) < limit:
                return False

    def apart(self, a: int, b: int) -> bool:
        """Whether a and b stay apart when their bytes are encoded together."""
        key = a << 32 | b
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            found = self.known[key] = key not in self.merge and self.uncrossed(a, b, len(self.merge))
        return found

    def genuine(self, tokens: Iterable[int]) -> list[int]:
        """Tokens that the encoding of their own bytes gives; others never occur."""
        good: dict[int, bool] = {}
        for n in sorted(tokens, key=self.size.__getitem__):
            a, b = self.left[n], self.right[n]
            good[n] = self.size[n] == 1 if a < 0 else good[a] and good[b] and self.uncrossed(a, b, self.rank[n])
        return [n for n, yes in good.items() if yes]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, once per worker process."""
    return Vocabulary(path)


class Trie:
    """Nodes are prefixes of words; each has the last token of its encoding. Held is the path to the current word."""

    def __init__(self, tokens: Vocabulary) -> None:
        self.tokens = tokens
        self.word, self.path = b"", [-1]

    def extend(self, word: bytes, shared: int) -> None:
        """Add the nodes of ``word`` below its first ``shared`` bytes, whose nodes are on the path."""
        path, ids, longest, known = self.path, self.tokens.ids, self.tokens.longest, self.tokens.known
        for end in range(shared + 1, len(word) + 1):
            span = longest.get(word[end - 4 : end], 3) if end > 3 else end
            for start in range(end - span if span < end else 0, end):
                t = ids.get(word[start:end])
                if t is None:
                    continue
                if not start:
                    break
                apart = known.get(path[start] << 32 | t)
                if apart or apart is None and self.tokens.apart(path[start], t):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            path.append(t)

    def descend(self, word: bytes) -> list[int]:
        """The path to a word that is not before the current one: shared nodes stay, new ones are worked out."""
        shared = 0
        for x, y in zip(self.word, word, strict=False):
            if x != y:
                break
            shared += 1
        del self.path[shared + 1 :]
        self.extend(word, shared)
        self.word = word
        return self.path

    def insert(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Encodings of words, in byte order."""
        size = self.tokens.size
        self.word, self.path = b"", [-1]
        for word in sorted(words):
            path, ids, end = self.descend(word), [], len(word)
            while end:
                t = path[end]
                ids.append(t)
                end -= size[t]
            yield word, ids[::-1]
        self.word, self.path = b"", [-1]


class Encoder:
    """Ids of texts as little-endian numbers of four bytes. The memo of words has two generations."""

    def __init__(self, path: str) -> None:
        self.path, self.tokens = path, vocabulary(path)
        self.trie = Trie(self.tokens)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.tokens.special, key=len, reverse=True))) + ")") if self.tokens.special else None

    def words(self, text: str) -> list[str]:
        """The words of a text; the string of a special token is a word of its own."""
        if self.marks and self.marks.search(text):
            return [w for k, part in enumerate(self.marks.split(text)) for w in ([part] if k % 2 else self.words(part))]
        if UNSURE.search(text):
            return [text[a:b] for _, (a, b) in tokenizer(self.path).pre_tokenizer.pre_tokenize_str(text)]
        return WORD.findall(text)

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > WORDS:
            self.older, self.known = self.known, {}
        new = {}
        for w in words.difference(self.known):
            if w in self.older:
                self.known[w] = self.older[w]
            elif w in self.tokens.special:
                self.known[w] = array("I", [self.tokens.special[w]]).tobytes()
            else:
                new[w.encode("utf-8", "surrogatepass")] = w
        for word, ids in self.trie.insert(new):
            self.known[new[word]] = array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [(n, part) for n, t in enumerate(texts) for part in parts_of(t)]
        out: list[list[bytes]] = [[] for _ in texts]
        at = 0
        while at < len(parts):
            end, held = at, 0
            while end < len(parts) and held < GROUP:
                held += len(parts[end][1])
                end += 1
            some = [self.words(p) for _, p in parts[at:end]]
            self.learn(set().union(*some))
            for (n, _), words in zip(parts[at:end], some, strict=True):
                out[n].append(b"".join(map(self.known.__getitem__, words)))
            at = end
        return [b"".join(x) for x in out]


def parts_of(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of about ``size`` characters that are encoded apart."""
    at = 0
    while len(text) - at > size:
        m = BOUNDARY.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def decode(tokens: Vocabulary, ids: bytes) -> str:
    """The text of ids; unknown ids stand for nothing, bytes that are no UTF-8 for replacement characters."""
    numbers, known = np.frombuffer(ids, "<u4"), tokens.bytes
    found = []
    for at in range(0, len(numbers), GROUP):
        some = numbers[at : at + GROUP]
        found.append(b"".join(map(known.__getitem__, some[some < len(known)].tolist())))
    return b"".join(found).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a worker process, kept from task to task."""
    return Encoder(path)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary, four bytes each, little-endian) for every row of ``docs`` (doc_id, text).

    Equal to the library's encoding without added special tokens; strings of special tokens inside a text are
    their ids. NULL and empty texts have no ids. NULL or repeated ids of documents stay as they are, an empty
    table gives no rows, very long texts are encoded whole, part by part, other columns are ignored. ``path`` is a
    byte-level BPE file that every worker can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = encoder(path).encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, text for every row (doc_id, ids as ``encode_texts`` gives them); NULL ids are the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = [decode(vocabulary(path), ids or b"") for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, text string")
