import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from corpus_cases import docs_frame, text_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import prefix_bpe
from tallymart.llm.units import tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "  a  b", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>y z", "\n a\t b c  d'll 's", "a" * 3000, "ab " * 9000]
ODD += [" " * 3000, "<|endoftext", "　 é 12 34 \x1c x", "İ ß ΣΑΣ é́ ԱԲ", "日本語 テスト 한국어 😀😀 ՙ", "=-" * 500, text_of(3, 30_000, 3000), "\x85a\xa0b"]


def library(text):
    return tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def ours(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in prefix_bpe.encoder(PATH).encode([t or "" for t in texts])]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aab1 .\n\t'élerin<|>!?-=", max_size=200))
def test_ids_match_the_library(text):
    assert ours([text]) == [library(text)]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_characters(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert ours([text]) == [library(text)]


def test_random_words():
    r = random.Random(4)
    letters = ["theer", "aaab", "xyz019", "in ton", "!?.,", "äöüß", "日本語のテ"]
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 120))) for _ in range(3000) for a in [r.choice(letters)]]
    assert ours(texts) == [library(t) for t in texts]


def test_words_agree_where_the_library_is_not_asked():
    """All characters that may be cut by the pattern are cut as the library cuts them."""
    cut = tokenizer(PATH).pre_tokenizer.pre_tokenize_str
    chars = [c for c in map(chr, range(1, 0x10000)) if not 0xD800 <= ord(c) < 0xE000 and not prefix_bpe.UNSURE.search(c)]
    assert len(chars) > 50_000
    for at in range(0, len(chars), 64):
        text = "".join(f"a{c}b 1{c}2 ,{c}; {c}{c} x" for c in chars[at : at + 64])
        assert prefix_bpe.WORD.findall(text) == [text[a:b] for _, (a, b) in cut(text)]


def test_neighbours_stay_apart_as_the_library_says():
    r, tokens = random.Random(9), prefix_bpe.vocabulary(PATH)
    letters = {b: c for c, b in prefix_bpe.byte_letters().items()}
    model = tokenizer(PATH).model
    spell = lambda n: "".join(letters[b] for b in tokens.bytes[n])
    for _ in range(20_000):
        a, b = r.randrange(3000), r.randrange(3000)
        assert tokens.apart(a, b) == ([t.id for t in model.tokenize(spell(a) + spell(b))] == [a, b])


def test_shared_prefixes_are_worked_out_once():
    trie = prefix_bpe.Trie(prefix_bpe.vocabulary(PATH))
    asked, extend = [], trie.extend
    trie.extend = lambda word, shared: asked.extend(word[:k] for k in range(shared + 1, len(word) + 1)) or extend(word, shared)
    words = [w.encode() for w in ("inter", "internal", "internet", "interne", "in", "external", "internet")]
    assert {w: ids for w, ids in trie.insert(words)} == {w: library(w.decode()) for w in words}
    assert len(asked) == len(set(asked)) == len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_full_memories_change_nothing(monkeypatch):
    texts = [text_of(k, 300, 3000) for k in range(40)]
    monkeypatch.setattr(prefix_bpe, "WORDS", 20)
    monkeypatch.setattr(prefix_bpe, "GROUP", 100)
    monkeypatch.setattr(prefix_bpe, "PART", 64)
    encoder = prefix_bpe.Encoder(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [library(t) for t in texts]


def test_any_ids_decode_as_the_library_says():
    r = random.Random(2)
    for _ in range(300):
        ids = [r.randrange(50_300) for _ in range(r.randint(0, 30))]
        assert prefix_bpe.decode(prefix_bpe.vocabulary(PATH), np.array(ids, "<u4").tobytes()) == tokenizer(PATH).decode(ids, skip_special_tokens=False)


def test_rows(spark, edges, nothing):
    rows = [(k, t, "en", "a") for k, t in enumerate(ODD)]
    for frame in (docs_frame(spark, rows), edges):
        back = prefix_bpe.decode_ids(prefix_bpe.encode_texts(frame, PATH), PATH).collect()
        found = sorted(((x["doc_id"], hashlib.sha256(x["ids"]).hexdigest(), x["text"]) for x in back), key=repr)
        want = [(x["doc_id"], hashlib.sha256(np.array(library(x["text"]), "<u4").tobytes()).hexdigest(), x["text"] or "") for x in frame.collect()]
        assert found == sorted(want, key=repr)
    assert prefix_bpe.decode_ids(prefix_bpe.encode_texts(nothing, PATH), PATH).collect() == []


def test_files_of_other_kinds_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        prefix_bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    path = tmp_path / "t.json"
    path.write_text(json.dumps({"model": {"type": "BPE", "byte_fallback": True}, "pre_tokenizer": {"type": "ByteLevel"}}))
    with pytest.raises(ValueError, match="option"):
        prefix_bpe.Vocabulary(str(path))
