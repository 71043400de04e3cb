import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus_cases import docs_frame, text_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import grammar, token_counts
from tallymart.llm.token_counts import Chunks
from tallymart.llm.units import tokenizer

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", None, " ", "  a  b", "a <|endoftext|> b", "x<|endoftext|>y z", "\n a\t b c  d'll 's", "a" * 3000, "ab " * 9000, "　 é 12 34 \x1c x"]
ODD += [" " * 3000, "x" * 700 + " y" * 50 + "<|endoftext|>" * 300, "İ ß ΣΑΣ é́", text_of(3, 9000, 3000)]


@pytest.mark.parametrize("chunks", [Chunks(), Chunks(200, 16)])
def test_counts_match_the_library(spark, chunks):
    r = random.Random(8)
    texts = ODD + ["".join(r.choice("ab 1.\n'é😀<|> ") for _ in range(r.randint(0, 900))) for _ in range(200)]
    frame = docs_frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    found = {x["doc_id"]: (x["n_bytes"], x["n_tokens"], x["over_limit"]) for x in token_counts.token_report(frame, BYTES, chunks=chunks).collect()}
    for i, t in enumerate(texts):
        n = len(tokenizer(BYTES).encode(t or "", add_special_tokens=False).ids)
        assert found[i] == (len((t or "").encode()), n, n > 1024), repr(t)[:80]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1 .\n\t'é ", max_size=400), st.integers(4, 40), st.integers(1, 8))
def test_splices_equal_one_encoding(text, chunk, overlap):
    whole = tokenizer(BYTES).encode(text, add_special_tokens=False).ids
    parts = list(token_counts.encode_long(BYTES, text, Chunks(chunk, overlap)))
    assert np.concatenate(parts).tolist() == whole


def test_files_return_every_document(spark):
    texts = ODD + [text_of(i, 50 + i, 300) for i in range(60)]
    rows = [(900 - 7 * i, t, "en", "a") for i, t in enumerate(texts)]
    found = {x["doc_id"]: (x["start"], x["n_tokens"], x["ids_crc32"]) for x in grammar.grammar_report(docs_frame(spark, rows), WORDS).collect()}
    at = 0
    for i, t, *_ in sorted(rows):
        ids = np.array([*tokenizer(WORDS).encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert found[i] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def encoded(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    return [x for b in grammar.encoder(WORDS, 1, "<u2")(iter([batch])) for x in b.column(1).to_pylist()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="abSTÀÿßéµŁ.,'1 \n\t\r\x1c\u0301中<|>", max_size=60), max_size=8), st.sampled_from([1, 40, 1 << 25]))
def test_pieces_are_encoded_as_their_texts(texts, portion):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(grammar, "PORTION", portion)
        found = encoded(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [[*tokenizer(WORDS).encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def test_more_texts_of_the_same_words_cost_no_calls():
    texts = [f"The {w}, of {w.title()}. and {w}" for w in ("heron", "élan", "straße", "x1", "'ll")]
    encoded(texts)  # loads the tokenizer

    def calls(times):
        seen = []
        sys.setprofile(lambda frame, event, arg: seen.append(1) if event in ("call", "c_call") else None)
        try:
            encoded(texts * times)
        finally:
            sys.setprofile(None)
        return len(seen)

    assert calls(2000) < calls(50) + 5000  # 10,000 texts; an occurrence or a text costs none, a slice some


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=600), st.data())
def test_grammar_round_trip(ids, data):
    whole = np.array(ids, np.int64)
    s, r = grammar.repair(whole, 100, least=2)
    size = grammar.expansion_lengths(r, 100)
    assert (grammar.expand(s, r, 100) == whole).all()
    assert all(len(grammar.expand(np.array([100 + k]), r, 100)) == n for k, n in enumerate(size))
    low = data.draw(st.integers(0, len(ids)))
    high = data.draw(st.integers(low, len(ids)))
    assert grammar.between(s, r, size, 100, low, high).tolist() == ids[low:high]


def test_grammar_shortens_repetition():
    whole = np.tile(np.arange(50), 400)
    s, _ = grammar.repair(whole, 1 << 24)
    assert len(s) < len(whole) / 8


def test_long_passages_become_one_symbol():
    passage = np.random.default_rng(1).integers(0, 40_000, 5000)
    whole = np.concatenate([np.concatenate((passage, [50_000 + k])) for k in range(60)])
    s, rules = grammar.repair(whole, 1 << 17)
    assert (grammar.expand(s, rules, 1 << 17) == whole).all()
    assert grammar.expansion_lengths(rules, 1 << 17).max() > 1024


@pytest.mark.parametrize("named", [2000, 0])
def test_documents_are_decoded_alone(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(grammar, "NAMED", named)
    monkeypatch.setattr(grammar, "BLOCK", 3000)
    texts = ODD + [text_of(k % 7, 200, 300) for k in range(120)]
    rows = [(5 * k, t, "en", "a") for k, t in enumerate(texts)] + [(35, text_of(8, 90), "en", "a"), (None, "no id", "en", "a")]
    path = str(tmp_path / "ids")
    grammar.write_ids(docs_frame(spark, rows), WORDS, path, 1)
    assert spark.read.parquet(path).count() > 5
    wanted = [None, 0, 5, 35, 40, 300, 301, 615]
    asked = spark.createDataFrame([(i,) for i in [*wanted, 0]], "doc_id bigint")
    found = sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in grammar.read_documents(spark, path, asked).collect()), key=repr)
    want = [(i, [*tokenizer(WORDS).encode(t or "", add_special_tokens=False).ids, 1]) for i, t, *_ in rows if i in wanted]
    assert found == sorted(want, key=repr)
    plan = grammar.read_documents(spark, path, asked)._jdf.queryExecution().toString()
    assert ("In(block" in plan or "EqualTo(block" in plan) == bool(named)
    assert grammar.read_documents(spark, path, asked.limit(0)).collect() == []


def test_few_symbols_are_expanded_for_a_stretch(monkeypatch):
    whole = np.tile(np.arange(50), 400)
    s, rules = grammar.repair(whole, 1 << 17)
    size, seen, expand = grammar.expansion_lengths(rules, 1 << 17), [], grammar.expand
    monkeypatch.setattr(grammar, "expand", lambda s, *rest: seen.append(len(s)) or expand(s, *rest))
    assert grammar.between(s, rules, size, 1 << 17, 7777, 7999).tolist() == whole[7777:7999].tolist()
    assert seen[0] <= 2 + len(s) * 222 // len(whole) + 1
