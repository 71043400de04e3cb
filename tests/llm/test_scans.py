"""Licenses and personal data."""

import hashlib
import re

import pytest
from corpus_cases import docs_frame, text_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import licenses, pii
from tallymart.llm.licenses import TEMPLATES, Index, Scan

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    digits = lambda m: [int(c) for c in m[0] if c.isdigit()]
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab@.1234567890 +-()_%", max_size=60))
def test_base_spans_match_the_patterns(text):
    assert pii.detect(text) == base(text)


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail joe (at) example [dot] com now", "email", "joe (at) example [dot] com"),
        ("ask joe at example dot com", "email", "joe at example dot com"),
        ("jоe@exаmple.com x", "email", "jоe@exаmple.com"),
        ("call plus one two three four five six seven eight nine zero now", "phone", "plus one two three four five six seven eight nine zero"),
        ("ip one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
        ("pay ４１１１ 1111 1111 1111.", "card", "４１１１ 1111 1111 1111"),
        ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "card", None),
    ],
)
def test_disguises(text, kind, span):
    _, added = pii.find(text)
    assert [text[a:b] for a, b in added[kind]] == [span or text]
    assert all(not v for k, v in added.items() if k != kind)


@pytest.mark.parametrize("hidden", ["\u200b", "\u00ad", "\u200c", "\u200d", "\u2060", "\ufeff", "\u200b\u00ad"])
@pytest.mark.parametrize(
    ("kind", "left", "right"),
    [("email", "john@exam", "ple.com"), ("card", "4111", "1111 1111 1111"), ("ip", "192.168", ".0.1"), ("phone", "+49", " 171 2345678")],
)
def test_invisible_characters_inside(hidden, kind, left, right):
    text = f"so {left}{hidden}{right} it is{hidden}"
    base, added = pii.find(text)
    assert not base[kind]
    assert {k: [text[a:b] for a, b in v] for k, v in added.items() if v} == {kind: [f"{left}{hidden}{right}"]}


@pytest.mark.parametrize(
    ("kind", "hidden"),
    [
        ("email", "john@example dot com"),
        ("email", "joe (at) example dot com"),
        ("email", "john dot smith@mail dot example dot com"),
        ("email", "joe at example dot com"),
        ("ip", "192 dot 168 dot 0 dot 1"),
        ("ip", "192 punkt 168 punkt 0 punkt 1"),
        ("ip", "192 dot one six eight dot 0 dot 1"),
        ("ip", "192.168.0.one"),
        ("phone", "+49 one seven six 1234567"),
        ("phone", "+49 (one seven six) 1234567"),
        ("card", "4111 1111 1111 111 one"),
        ("card", "4111, one one one one, 1111 1111"),
    ],
)
@pytest.mark.parametrize("around", ["see {} now", "we meet at noon; {} now", "a dot b, x@y.zz; {} now", "dot, one; {} now. So {} too"])
def test_disguises_do_not_hang_on_the_rest_of_the_text(around, kind, hidden):
    text = around.format(*[hidden] * 2)
    _, added = pii.find(text)
    assert {k: [text[a:b] for a, b in v] for k, v in added.items() if v} == {kind: [hidden] * around.count("{}")}


def test_a_spelled_digit_beside_a_number_hides_nothing():
    text = "pay ４１１１ 1111 1111 1111 one time; ask a@b dot com dot joe@c dot de"
    _, added = pii.find(text)
    assert [text[a:b] for a, b in added["card"]] == ["４１１１ 1111 1111 1111"]
    assert [text[a:b] for a, b in added["email"]] == ["a@b dot com", "joe@c dot de"]


@pytest.mark.parametrize("text", ["meet at noon dot the i", "one two three four five", "Größe ünd é", "a@b.cd and at once", "[at] last (dot)"])
def test_nothing_is_added_to_plain_text(text):
    assert not any(pii.find(text)[1].values())


def test_report(spark):
    text = "a@b.cc, 10.0.0.1, +1 (325) 555-8094, 4111 1111 1111 1111, x [at] y [dot] org"
    rows = {r["doc_id"]: r for r in pii.pii_report(docs_frame(spark, [(1, text, "en", "a"), (2, None, "en", "a")])).collect()}
    r = rows[1]
    want = ",".join(f"{k}:{a}:{b}" for k, v in base(text).items() for a, b in v)
    assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["n_added"]) == (1, 1, 1, 1, 1)
    assert r["spans"].startswith("email:0:6,email:")
    assert (rows[2]["spans"], rows[2]["base_sha256"]) == ("", hashlib.sha256(b"").hexdigest())
    assert "@" not in pii.redact(text) and "[at]" not in pii.redact(text)


def test_licenses_are_found_where_they_stand(spark):
    rows, want = [], set()
    for i, (name, notice) in enumerate(TEMPLATES.items()):
        before = text_of(i, 30 + i)
        rows.append((i, f"{before}.\n{notice.upper()}\n{text_of(90 + i, 40)}", "en", "a"))
        want.add((i, name))
    found = licenses.license_report(docs_frame(spark, rows)).collect()
    assert want <= {(r["doc_id"], r["license"]) for r in found}
    for r in found:
        if (r["doc_id"], r["license"]) in want:
            notice = TEMPLATES[r["license"]].upper().strip(".")
            assert rows[r["doc_id"]][1][r["start"] : r["end"]].strip("/).") == notice.strip("/).")
            assert r["coverage"] == 1.0


def test_edited_licenses_report_their_coverage():
    index = Index(TEMPLATES, Scan())
    words = TEMPLATES["MIT permission"].split()
    del words[10]
    words[20] = "altered"
    words.insert(30, "inserted")
    (match,) = [m for m in licenses.scan_text(" ".join([*text_of(1, 50).split(), *words]), index) if m[0] == "MIT permission"]
    total = len(licenses.WORD.findall(TEMPLATES["MIT permission"]))
    assert match[4] == pytest.approx((total - 2) / total)
    half = " ".join(words[: len(words) // 2])
    assert not [m for m in licenses.scan_text(half, index) if m[0] == "MIT permission"]


@pytest.mark.parametrize("name", ["MIT notice", "CC-BY-NC-4.0 notice", "Apache-2.0 notice"])
@pytest.mark.parametrize("between", [0, 1, 3, 20])
@pytest.mark.parametrize("times", [2, 5, 300])
def test_notices_close_together_are_rows_of_their_own(name, between, times):
    notice, filler = TEMPLATES[name], " ".join(["word"] * between)
    text = f" {filler} ".join([notice] * times)
    found = [m for m in licenses.scan_text(text, Index(TEMPLATES, Scan())) if m[0] == name]
    size = len(notice.rstrip("."))
    assert [(a, b) for _, a, b, _, _ in found] == [(k * (len(notice) + len(filler) + 2), k * (len(notice) + len(filler) + 2) + size) for k in range(times)]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 7, 8, 10, 15, 20, 25, 26, 29, 40, 64, 120])
def test_changed_words_within_the_coverage_lose_no_match(size):
    words = [f"t{k}" for k in range(size)]
    index = Index({"it": " ".join(words)}, Scan())
    spread = size // 5
    for first in range(size):
        changed = {(first + k * 5) % size for k in range(spread)}
        text = " ".join(["so", *["other" if k in changed else w for k, w in enumerate(words)], "on"])
        (match,) = licenses.scan_text(text, index)
        assert match[3] == size - len(changed)


def test_every_shared_stretch_has_a_fingerprint():
    import numpy as np

    scan = Scan()
    numbers = np.random.default_rng(1).integers(1, 2**62, 60).astype(np.uint64)
    whole = set(licenses.fingerprints(numbers, scan)[0].tolist())
    for at in range(50):
        part = np.concatenate([np.array([5, 6, 7], np.uint64), numbers[at : at + scan.gram + scan.window - 1], np.array([8, 9], np.uint64)])
        assert whole & set(licenses.fingerprints(part, scan)[0].tolist())


@pytest.mark.parametrize(("coverage", "window"), [(0.8, 2), (0.9, 7), (0.95, 8)])
def test_long_templates_are_winnowed(coverage, window):
    """Fewer fingerprints than runs, in templates and in texts; short templates keep every run."""
    import numpy as np

    scan = Scan(coverage=coverage)
    assert licenses.winnowing(400, scan)[:2] == (3, window)
    assert licenses.winnowing(5, Scan())[1] == 1
    numbers = np.random.default_rng(1).integers(1, 2**62, 4000).astype(np.uint64)
    kept = len(licenses.fingerprints(numbers, licenses.replace(scan, window=window))[0])
    assert kept / 3998 == pytest.approx(2 / (window + 1), rel=0.1)
    index = Index({"long": text_of(1, 400, 10**6)}, scan)
    assert sum(map(len, index.parts[3, window].values())) < 0.75 * 398


@pytest.mark.parametrize("coverage", [0.8, 0.9])
@pytest.mark.parametrize("size", [22, 64, 150, 400])
def test_even_changes_within_the_coverage_are_met(size, coverage):
    words = [f"t{k}" for k in range(size)]
    index, step = Index({"it": " ".join(words)}, Scan(coverage=coverage)), round(1 / (1 - coverage))
    for first in range(step):
        changed = set(range(first, size, step)) if len(range(first, size, step)) <= size * (1 - coverage) + 1e-9 else set(range(first + step, size, step))
        (match,) = licenses.scan_text(" ".join("other" if k in changed else w for k, w in enumerate(words)), index)
        assert match[3] == size - len(changed)


def test_matches_equal_a_full_alignment():
    """Against an alignment of every template with the whole text, without fingerprints or bands."""
    import random

    r = random.Random(6)
    templates = {f"t{k}": text_of(k, n, 60) for k, n in enumerate([4, 7, 12, 25, 40, 70])}
    index, scan = Index(templates, Scan()), Scan()
    met = 0
    for k in range(120):
        name = f"t{k % 6}"
        words = templates[name].split()
        for _ in range(r.randint(0, len(words) // 4)):
            at = r.randrange(len(words))
            words[at : at + 1] = r.choice([[], ["other"], [words[at], "more"]])
        before, after = text_of(500 + k, r.randint(0, 60), 60).split(), text_of(900 + k, r.randint(0, 60), 60).split()
        text = " ".join([*before, *words, *after])
        numbers = [index.vocabulary.get(w, 0) for w in text.split()]
        found = {m[0]: m for m in licenses.scan_text(text, index)}
        for t, template in enumerate(templates.values()):
            own = [index.vocabulary[w] for w in template.split()]
            matched, a, z = licenses.align(own, numbers, 0, len(numbers) + len(own))
            full = matched >= scan.coverage * len(own) - 1e-9
            if f"t{t}" in found:
                assert full and found[f"t{t}"][3] == matched
                assert text[found[f"t{t}"][1] : found[f"t{t}"][2]] == " ".join(text.split()[a : z + 1])
                met += 1
            elif full and f"t{t}" == name:  # only words put in may hide a match
                assert "more" in words
    assert met > 60


def test_a_notice_inside_a_header_is_no_match_of_its_own():
    index = Index(TEMPLATES, Scan())
    header = TEMPLATES["Apache-2.0 header"]
    found = licenses.scan_text(f"x {header} y {TEMPLATES['Apache-2.0 notice']}", index)
    assert [m[0] for m in found] == ["Apache-2.0 header", "Apache-2.0 notice"]
    assert found[0][2] < found[1][1]
    both = {("a", 0, 9, 3, 1.0), ("b", 0, 9, 3, 1.0), ("c", 0, 9, 3, 0.9), ("d", 2, 5, 1, 1.0), ("e", 5, 12, 2, 1.0)}
    assert [m[0] for m in licenses.outermost(both)] == ["a", "b", "e"]


def test_whole_licenses_from_files(spark, tmp_path):
    long = {f"L{k}-1.0": "\n".join(text_of(10 * k + j, 300, 5000) for j in range(4)) for k in range(3)}
    (tmp_path / "licenses").mkdir()
    for name, text in long.items():
        (tmp_path / "licenses" / f"{name}.txt").write_text(text)
    (tmp_path / "licenses" / "empty.txt").write_text("")
    templates = licenses.read_templates(spark, str(tmp_path / "licenses"))
    changed = long["L1-1.0"].split()
    changed[100:110] = ["edited"] * 10
    rows = [(1, f"{text_of(77, 50)} {long['L0-1.0']}", "en", "a"), (2, " ".join(changed), "en", "a"), (3, long["L2-1.0"][:2000], "en", "a")]
    found = {r["doc_id"]: r for r in licenses.license_report(docs_frame(spark, rows), templates).collect()}
    assert {i: r["license"] for i, r in found.items()} == {1: "L0-1.0", 2: "L1-1.0"}
    assert found[1]["coverage"] == 1.0 and found[2]["matched_words"] == 1190
    with pytest.raises(ValueError, match="templates"):
        licenses.license_report(docs_frame(spark, rows), templates, Scan(most_words=100))


def test_too_many_templates_are_refused():
    with pytest.raises(ValueError, match="templates"):
        Index({"a": "b " * 20}, Scan(most_words=10))


@pytest.mark.parametrize("unit", [" ", "\n", "1", "( ", "one ", "1 ", "a at b dot ", "+1 ", "\u200b", ". ", "a@", "(at) ", "[dot]"])
def test_long_runs_take_time_in_proportion(unit):
    import time

    text = unit * (1_000_000 // len(unit))
    began = time.process_time()
    pii.find(text)
    assert time.process_time() - began < 8


def test_white_space_around_brackets_belongs_to_them():
    text = "x joe  (at)\n example [dot] [dot] com"
    assert pii._bracketed(text, pii.AT_BRACKETS, "@") == [(5, 13, "@")]
    assert [text[a:b] for a, b, _ in pii._bracketed(text, pii.DOT_BRACKETS, ".")] == [" [dot] ", "[dot] "]
