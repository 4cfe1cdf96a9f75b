"""Quality rules, line first.

Every line is judged by itself: a *punctuation* rule (symbol clutter, shouted
``!!``), a *navigation* rule (menu bars and short fragments without an end
mark) and a *boilerplate* rule (licence and site notices).  Failing lines are
removed; a document that loses more than ``max_lost_pct`` of its word
characters, or that fails the base counts, is rejected.

Cases: null text counts as empty; a text without words has zero counts, is
``base_failed`` and not kept; repeated rows and null ids give one result row
each; equal lines get equal verdicts, and a document that loses exactly the
limit is kept (ties); very long texts are read whole, in pieces of texts of
bounded length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stride.llm.common import map_texts

SYMBOLS = "#*$%&|<>"

#: Notices that mark a line as boilerplate (lower case, anywhere in the line).
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "is licensed under",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "enable javascript",
    "sign up for our newsletter",
    "share this",
    "skip to content",
)


@dataclass(frozen=True)
class LineRules:
    max_symbol_pct: int = 10      # symbol characters per hundred word characters
    shout_per_words: int = 2      # fails if "!!" occurs more than once per so many words
    bar_per_words: int = 3        # fails if "|" stands at least once per so many words
    fragment_words: int = 3       # up to so many words without an end mark is a navigation fragment
    max_lost_pct: int = 30        # rejects a document whose removed lines hold more of its word characters
    min_words: int = 50
    max_repeat_pct: int = 50


SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines bigint, n_bad_lines bigint, "
          "lost_chars bigint, clean_text string")


def repeated_words(words: list) -> int:
    """Words lying in a 3-word window that occurs at least twice."""
    import numpy as np

    n = len(words)
    if n < 4:
        return 0
    seen: dict = {}
    a = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    size = len(seen)
    pair = a[:-2] * size + a[1:-1]
    if size > 2_000_000:  # keep the combined key within 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair * size + a[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def line_fails(line: str, words: list, rules: LineRules, boilerplate) -> bool:
    chars = sum(len(w.decode("utf-8", "replace")) for w in words) if not line.isascii() else sum(map(len, words))
    symbols = sum(line.count(c) for c in SYMBOLS)
    n = len(words)
    bars = line.count("|")
    return (
        100 * symbols > rules.max_symbol_pct * chars
        or rules.shout_per_words * line.count("!!") > n
        or (bars > 0 and rules.bar_per_words * bars >= n)
        or (n <= rules.fragment_words and line.rstrip(" \t\n\r\x0b\x0c")[-1:] not in ".!?:;\"'")
        or boilerplate.search(line.lower()) is not None
    )


def _space_chars(text: str) -> int:
    return sum(text.count(c) for c in " \t\n\r\x0b\x0c")


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), with_text: bool = True) -> DataFrame:
    """One row per document: base counts, line verdicts and (``with_text``) the text without its failing lines."""
    pattern = "|".join(re.escape(p) for p in BOILERPLATE)

    def measure(ids, texts):
        boilerplate = re.compile(pattern)
        out: dict = {k.split()[0]: [] for k in SCHEMA.split(", ")}
        for i, text in zip(ids, texts):
            text = text or ""
            words = text.encode("utf-8", "replace").split()  # splits at the six ASCII blanks only
            n = len(words)
            word_chars = len(text) - _space_chars(text)
            n_repeat = repeated_words(words)
            lines = text.split("\n")
            seen, dup, bad, lost, live, good = set(), 0, 0, 0, 0, []
            for line in lines:
                w = line.encode("utf-8", "replace").split()
                if not w:
                    good.append(line)
                    continue
                live += 1
                if line in seen:
                    dup += 1
                else:
                    seen.add(line)
                if line_fails(line, w, rules, boilerplate):
                    bad += 1
                    lost += len(line) - _space_chars(line)
                else:
                    good.append(line)
            base_failed = n < rules.min_words or 100 * n_repeat > rules.max_repeat_pct * n
            kept = not base_failed and 100 * lost <= rules.max_lost_pct * word_chars
            row = (i, n, word_chars, sum(text.count(c) for c in SYMBOLS), dup, n_repeat, base_failed, kept, live, bad,
                   lost, "\n".join(good) if with_text else None)
            for k, v in zip(out, row):
                out[k].append(v)
        return out

    return map_texts(docs, measure, SCHEMA, "doc_id", "text")
