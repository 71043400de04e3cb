"""Encoding by a public tokenizer file, with a memo of the pieces between stable boundaries.

Invented or rare words overflow the small cache inside the library, so pieces are remembered here: a piece is what
stands between two positions where the tokenizer always starts anew, whatever surrounds it. Its tokens come from
the library itself. The memo has two generations: when the newer one is full it becomes the older, and what is
asked for again moves back to the newer one. So memory is bounded, frequent pieces stay, and results do not change.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces per generation.
MEMO = 1_000_000
#: Unknown pieces that are encoded as one text.
JOINED = 1024


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, once per worker process; threads belong to Spark."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def word_tokenizer(path: str):
    """The tokenizer of a file for words of small letters with spaces between: without the steps that leave such words
    as they are. Its tokens, and which of them end a word."""
    from tokenizers import pre_tokenizers

    whole = tokenizer(path)
    lean = type(whole).from_str(whole.to_str())
    lean.normalizer = None
    lean.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    last = np.zeros(whole.get_vocab_size(), bool)
    suffix = whole.model.end_of_word_suffix
    last[[i for token, i in whole.get_vocab().items() if suffix and token.endswith(suffix)]] = True
    return lean, last


def word_ids(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words end to end, and how many each has.

    The tokenizer works on bytes, folds case, keeps letters together and marks the end of a word; the words are of
    small letters that no normal form changes.
    """
    lean, last = word_tokenizer(path)
    cuts = pa.array([*range(0, len(words), JOINED), len(words)], pa.int32())
    texts = pc.binary_join(pa.ListArray.from_arrays(cuts, words), " ").to_pylist()
    ids = [np.zeros(0, np.int64), *(np.array(lean.encode(t, add_special_tokens=False).ids, np.int64) for t in texts)]
    flat = np.concatenate(ids)
    ends = np.flatnonzero(last[flat])
    if len(ends) != len(words):
        raise ValueError("the tokenizer does not mark the end of every word")
    return flat, np.diff(ends, prepend=-1)


@lru_cache(maxsize=4)
def memo(path: str, kind: str, prefix: str = "", fold: bool = False) -> Memo:
    """The memo of a worker process, kept from task to task: numbers of tokens for the kind "count", else ids as an
    array of that type code."""
    return Memo(path, kind, prefix, fold)


class Memo:
    """Values of pieces as the library encodes ``prefix + piece``: numbers of tokens, or ids as bytes.

    Values of neighbours add up. ASCII letters followed by a full stop or comma are two parts for every pattern
    that keeps letters and punctuation apart, so only the letters are encoded; ``fold`` says that the tokenizer
    drops white space and reads capitals as small letters. Where a space between pieces is a stable boundary, many
    unknown pieces are encoded as one text and told apart by the tokens' offsets.
    """

    def __init__(self, path: str, kind: str, prefix: str = "", fold: bool = False) -> None:
        self.tokenizer, self.kind, self.prefix, self.fold = tokenizer(path), kind, prefix, fold
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}
        self.tails = {t: self.value(self.tokenizer.encode(t, add_special_tokens=False).ids) for t in ("", ".", ",")}

    def value(self, ids: list[int]) -> object:
        return len(ids) if self.kind == "count" else array(self.kind, ids).tobytes()

    def encode(self, pieces: list[str]) -> None:
        """Add pieces to the memo."""
        alone = pieces
        if self.fold or self.prefix == " ":
            together = [p for p in pieces if p and not p[0].isspace() and not p[-1].isspace()]
            alone = [p for p in pieces if not p or p[0].isspace() or p[-1].isspace()]
            for at in range(0, len(together), JOINED):
                some = together[at : at + JOINED]
                found = self.tokenizer.encode(self.prefix + " ".join(some), add_special_tokens=False)
                # A piece owns what starts from the space before it on.
                begin = np.cumsum([0, *[len(p) + 1 for p in some[:-1]]]) - (0 if self.prefix else 1)
                owner = np.searchsorted(begin, [a for a, _ in found.offsets], side="right") - 1
                ends = np.cumsum(np.bincount(owner, minlength=len(some))).tolist()
                ids = found.ids
                self.known.update(zip(some, [self.value(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        for at in range(0, len(alone), 4096):
            some = alone[at : at + 4096]
            texts = [self.prefix + p for p in some] if self.prefix else some
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            self.known.update((p, self.value(e.ids)) for p, e in zip(some, found, strict=True))

    def learn(self, pieces: Iterable[str]) -> Callable[[str], object]:
        """Encode the pieces not known yet; what is returned looks them up."""
        asked = set(pieces)
        if len(self.known) + len(asked) > MEMO:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new, parts = [], []
        for p in asked:
            if p in known:
                continue
            if p in older:
                known[p] = older[p]
                continue
            tail = p[-1:] if p[-1:] in (".", ",") else ""
            head = p[: len(p) - len(tail)]
            if head.isascii() and head.isalpha():
                stem = head.lower() if self.fold else head
                if stem != p:
                    parts.append((p, stem, tail))
                    if stem in known:
                        continue
                    if stem in older:
                        known[stem] = older[stem]
                        continue
                    p = stem
            new.append(p)
        self.encode(list(dict.fromkeys(new)))
        for p, stem, tail in parts:
            known[p] = known[stem] + self.tails[tail]
        return known.__getitem__
