"""Copies of a license in one text, close together, with other words around them."""

import random
import re

import pytest

from riskframe.llm.license import NOTICES, SPREAD, TEMPLATES, Scanner, _by_bits, _word_by_word, align

SCANNER = Scanner(TEMPLATES)


def places(found, name):
    return [(s, e) for k, c, s, e in found if k == name and c == 1.0]


@pytest.mark.parametrize("copies", [2, 10])
@pytest.mark.parametrize("name", sorted(NOTICES))
def test_all_copies_with_words_around_them(name, copies):
    size = len(re.findall(r"[^\W_]+", TEMPLATES[name]))
    t = re.search(r"(?s)\w.*\w", TEMPLATES[name])[0]
    for gap in (0, 1, size // 2, size - 1, size + 3):
        text, want = "notice of parts ", []
        for k in range(copies):
            want.append((len(text), len(text) + len(t)))
            text += t + " " + "".join(f"part{k}x{i} " for i in range(gap))
        assert places(SCANNER.scan(text + "end of notice"), name) == want, gap


def test_copies_with_changed_words():
    rng = random.Random(4)
    for name in ("Apache-2.0-header", "GPL-3.0-header", "ISC", "MIT-text"):
        words = re.findall(r"[^\W_]+", TEMPLATES[name])
        text, want = "before ", []
        for k in range(5):
            w = list(words)
            for i in rng.sample(range(1, len(w) - 1), len(w) // 10):
                w[i] = f"y{k}x{i}"
            one = " ".join(w)
            want.append((len(text), len(text) + len(one)))
            text += one + " some other words "
        assert [(s, e) for k, c, s, e in SCANNER.scan(text + "after") if k == name and c >= 0.8] == want


def test_gap_without_anchors_has_its_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randrange(1, 30))] for _ in range(2))
        got = _by_bits(a, b)
        assert len(got) == len(_word_by_word(a, b)) and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    t = [f"w{k}" for k in range(100)]
    assert len(align(t, ["x", *t, "y", *t, "z"])) == 100


def at_the_limit(name):
    """The template's words with as many replaced as the coverage allows, its rarest words first, both ends kept."""
    words, rare = SCANNER.words[name], SCANNER.rare[name]
    lose = len(words) - SCANNER.least(name)
    order = sorted(range(1, len(words) - 1), key=lambda i: (words[i] not in rare, rare[words[i]], i))[:lose]
    return [f"y{i}z" if i in set(order) else w for i, w in enumerate(words)], lose


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_copy_at_the_limit_with_its_rarest_words_gone(name):
    words, lose = at_the_limit(name)
    one, size = " ".join(words), len(words)
    for text, want in ((one, True), (f"before all {one} and after it", True), (one + " q " * (2 * size) + one, True),
                       (one.replace(words[0] + " ", "q ", 1), False)):
        found = [c for k, c, _, _ in SCANNER.scan(text) if k == name]
        assert bool(found) == want and all(c >= 0.8 for c in found), (text[:80], found)
    assert SCANNER.scan(one + " q " * (2 * size) + one).count((name, round(1 - lose / size, 6), 0, len(one))) == 1


@pytest.mark.parametrize("name", sorted(NOTICES))
def test_words_put_in_between(name):
    """A copy spread over SPREAD template lengths, also with words missing."""
    for words in (SCANNER.words[name], at_the_limit(name)[0]):
        text = " ".join(w + f" p{i}q" * (SPREAD - 1 if i + 1 < len(words) else 0) for i, w in enumerate(words))
        assert [k for k, _, _, _ in SCANNER.scan(f"x y {text} z")].count(name) == 1


def test_scan_against_brute_force():
    """Every stretch of SPREAD template lengths or less that holds enough of a template in order is found, and nothing else."""
    rng = random.Random(8)
    found = 0
    for _ in range(400):
        letters = "abcdefgh"[:rng.randint(3, 8)]
        templates = {"t": " ".join(rng.choice(letters) + "w" for _ in range(rng.randint(3, 9)))}
        scanner = Scanner(templates)
        t = scanner.words["t"]
        words = [rng.choice(letters + "xyz") + "w" for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(words))
            words[at:at] = [w for w in t if rng.random() < 0.9]
        need, span = scanner.least("t"), SPREAD * len(t)
        want = any(len(_word_by_word(t, words[i:i + span])) >= need for i in range(len(words)))
        text = " ".join(words)
        got = scanner.scan(text)
        if want:
            assert got
        for _, c, s, e in got:
            assert c >= 0.8 and len(_word_by_word(t, text[s:e].split())) >= need
        found += bool(got)
    assert 50 < found < 390


def test_whole_texts_are_told_apart():
    for name in ("Apache-2.0-text", "GPL-2-text", "GPL-3-text", "LGPL-2.1-text", "LGPL-3-text", "MPL-2.0-text", "CC0-1.0-text", "Artistic-text"):
        got = SCANNER.scan("Some words. " + TEMPLATES[name] + " More words.")
        assert (name, 1.0) in {x[:2] for x in got} and not any(k.endswith("-text") and c == 1.0 for k, c, _, _ in got if k != name)
    assert not any(k == "GPL-3-text" for k, *_ in SCANNER.scan(TEMPLATES["GPL-3-text"][:20000]))
