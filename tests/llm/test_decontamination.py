"""Decontamination against brute force, in both join forms."""

import hashlib
import re

import pytest

from stride.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(D.UPPER, D.LOWER)

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "two words"), (3, "single"), (4, None), (5, ""), (None, "item without any id but words"),
    (6, "the quick brown fox jumps over the lazy dog near the RIVER"), (6, "two words"), (10, "a a a a a a a a a a a a"),
    (7, "É accents É stay as they are in every one of them"),
]
LONG = "filler " * 3000 + "Single. " + "filler " * 2000
TEXTS = [
    (1, "x the quick, brown-fox JUMPS over the lazy dog! near the river"), (2, "two-words"), (3, "a single word"), (4, None),
    (5, ""), (6, "nothing to see"), (7, "a " * 25), (8, "é accents é stay as they are in every one of them"),
    (9, "É accents É stay as they are in every one of them"), (10, LONG), (None, "two words"), (None, "two words"), (3, "a single word"),
    (11, "the quick brown fox jumps over the lazy cat"), (12, "Two\nWords two words ... single"), (3, "other text, same id, two words"),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items=ITEMS, size=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        for s in range(max(len(iw) - size, 0) + 1 if iw else 0):
            win = iw[s:s + size]
            for p in range(len(w) - len(win) + 1):
                if w[p:p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    found |= {str(item)} if item is not None else set()
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("broadcast_windows", [50_000, 0])
def test_equals_brute_force(make, broadcast_windows):
    docs = make([(i, t, 1, "x") for i, t in TEXTS], "doc_id bigint, text string, words int, shingle string")
    items = make([(i, t, "y") for i, t in ITEMS], "item_id bigint, text string, length string")
    got = D.contamination(docs, items, broadcast_windows=broadcast_windows).collect()
    key = lambda i, v: (i is None, i or 0, v)
    assert sorted(key(r.doc_id, (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in got) == sorted(
        key(i, brute(t)) for i, t in TEXTS)


@pytest.mark.parametrize("broadcast_windows", [50_000, 0])
def test_empty_tables(make, broadcast_windows):
    docs, items = make(TEXTS), make(ITEMS, "item_id bigint, text string")
    clean = D.contamination(docs, items.limit(0), broadcast_windows=broadcast_windows).collect()
    assert len(clean) == len(TEXTS) and not any(r.contaminated for r in clean)
    assert D.contamination(docs.limit(0), items, broadcast_windows=broadcast_windows).count() == 0


def test_very_long_text(make):
    """An item at the very end of a text of 200,000 words, and one that almost occurs."""
    item = " ".join(f"needle{n}" for n in range(12))
    text = " ".join(f"w{n % 997}" for n in range(200_000))
    items = make([(1, item), (2, "w5 " * 11)], "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in D.contamination(make([(1, f"{text} {item}"), (2, text + " " + item[:-40])]), items).collect()}
    assert got[1] == (200_012, 12, 1) and got[2][1:] == (0, 0)


def test_main_path_has_no_python(make):
    plan = D.contamination(make(TEXTS), make(ITEMS, "item_id bigint, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
