"""Line-first quality rules against a plain Python version."""

import collections
import re

from stride.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")

TEXTS = [
    None, "", " \n\t ", "one", "a b c a b c a b c", "x\x1cy z q r",
    "Home | About | Contact\n" + "This is a sentence of plain prose. " * 20,
    "All rights reserved.\n" + "word " * 60, "WOW!! BUY!! NOW!!\n" * 30, "### $$$ %%%\n" * 30,
    "same line here\nsame line here\n\n  \nsame line here", "naïve café déjà vu. " * 30,
    "un" * 40_000 + " " + "end. " * 70,
]


def plain(text, r=Q.LineRules()):
    text = text or ""
    words = WORD.findall(text)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(wins)
    rep = {i + k for i, w in enumerate(wins) if times[w] > 1 for k in range(3)}
    n, chars = len(words), sum(map(len, words))
    seen, dup, bad, lost = set(), 0, 0, 0
    for line in text.split("\n"):
        w = WORD.findall(line)
        if not w:
            continue
        dup += line in seen
        seen.add(line)
        c, bars = sum(map(len, w)), line.count("|")
        fails = (100 * len(re.findall(r"[#*$%&|<>]", line)) > r.max_symbol_pct * c or r.shout_per_words * line.count("!!") > len(w)
                 or (bars and r.bar_per_words * bars >= len(w))
                 or (len(w) <= r.fragment_words and not re.search(r"[.!?:;\"'][\x20\x09-\x0D]*$", line))
                 or any(p in line.lower() for p in Q.BOILERPLATE))
        bad += bool(fails)
        lost += c if fails else 0
    failed = n < 50 or 100 * len(rep) > 50 * n
    return (n, chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(rep), failed,
            not failed and 100 * lost <= r.max_lost_pct * chars, bad, lost)


def test_equals_plain_version(make):
    rows = [(i, t, "kept", 7) for i, t in enumerate(TEXTS)] + [(None, "x y", None, None), (3, "one", "kept", 7)]
    docs = make(rows, "doc_id bigint, text string, kept string, n_words int")  # clashing extra columns
    got = Q.clean_lines(docs).collect()
    assert len(got) == len(rows)
    expected = sorted((r[0] is None, r[0] or 0, plain(r[1])) for r in rows)
    found = sorted((g.doc_id is None, g.doc_id or 0, (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words,
                    g.base_failed, g.kept, g.n_bad_lines, g.lost_chars)) for g in got)
    assert found == expected


def test_clean_text_loses_failing_lines(make):
    prose = "Plain prose " + " ".join(f"word{n} of{n} its{n} own{n}." for n in range(20))
    docs = make([(1, "Home | About | Shop\n" + prose)])
    row = Q.clean_lines(docs).first()
    assert row.kept and "About" not in row.clean_text and row.clean_text.startswith("Plain prose")


def test_empty_table(make):
    assert Q.clean_lines(make([])).count() == 0
