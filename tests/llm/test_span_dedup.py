"""Sliding sentence spans against a plain Python version."""

import random

import pytest

from stride.llm import span_dedup as S
from stride.llm.span_dedup import Spans
from tests.conftest import SF_SMALL


def word_cut(word, cfg):
    return int(S.words_of([word])[0][0]) % cfg.cut_every == 0


def sentences(text, cfg):
    """Lists of word numbers."""
    import re

    words = [(m[0], m.end()) for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", (text or "").lower())]
    low = (text or "").lower()
    out, now = [], []
    for k, (w, end) in enumerate(words):
        now.append(k)
        core = w[:-1] if len(w) > 1 and w[-1] in "\"')]" else w
        following = low[end:words[k + 1][1] - len(words[k + 1][0])] if k + 1 < len(words) else "\n"
        if core[-1] in ".!?" or "\n" in following:
            out.append(now)
            now = []
    final = []
    for s in out + ([now] if now else []):
        if len(s) <= cfg.long_words:
            final.append(s)
            continue
        part = []
        for k in s:
            part.append(k)
            if word_cut(words[k][0], cfg):
                final.append(part)
                part = []
        if part:
            final.append(part)
    return final, [w for w, _ in words]


def brute(rows, cfg=Spans()):
    """(doc_id, text) rows with distinct ids -> doc_id: (sentences, removed sentences, removed words)"""
    found, per = {}, {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        sents, words = sentences(t, cfg)
        per[d] = (sents, set())
        for i in range(len(sents)):
            j = i + cfg.sentences - 1
            while j < len(sents) and sents[j][-1] + 1 - sents[i][0] < cfg.min_words:
                j += 1
            if j >= len(sents):
                continue
            a, b = sents[i][0], sents[j][-1] + 1
            key = tuple(words[a:b])
            if key in found:
                per[d][1].update(range(a, b))
            else:
                found[key] = (d, a)
    return {d: (len(s), sum(x[0] in gone for x in s), len(gone)) for d, (s, gone) in per.items()}


def test_equals_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.removed_words) for r in S.dedup(docs).collect()}
    assert got == brute(rows)


def prose(rng, n, mark=0.12):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) + ("." if rng.random() < mark else "") for _ in range(n))


def test_planted_passages_go_and_the_rest_stays(make):
    rng = random.Random(3)
    passage = prose(rng, 60)
    unmarked = prose(rng, 70, mark=0.0)
    own = [(prose(rng, 90), prose(rng, 80)) for _ in range(20)]
    rows = [(i, f"{a} {passage if i % 2 else unmarked} {b}") for i, (a, b) in enumerate(own)] + [(50, prose(rng, 200))]
    got = {r.doc_id: r for r in S.dedup(make(rows)).collect()}
    assert {d: (r.n_sentences, r.n_removed, r.removed_words) for d, r in got.items()} == brute(rows)
    assert got[0].n_removed == got[1].n_removed == got[50].n_removed == 0 and got[50].text == rows[50 - 30][1]
    for i in range(2, 20):
        a, b = own[i]
        inside = set((passage if i % 2 else unmarked).split())
        assert got[i].removed_words >= 30
        left = got[i].text.split()
        assert left[: len(a.split()) - 12] == a.split()[: len(a.split()) - 12] and len(inside & set(left)) < len(inside)


@pytest.mark.parametrize("cfg", [Spans(), S.WHOLE])
def test_cases(make, cfg):
    rng = random.Random(4)
    text = prose(rng, 120)
    rows = [(1, None), (2, ""), (3, " \n "), (4, text), (4, text), (None, text), (5, "x" * 100_000), (6, "Une phrase. Deux."),
            (7, "a b c d e f"), (8, "w " * 50_000)]
    docs = make([(i, t, "c", 1) for i, t in rows], "doc_id bigint, text string, span string, a int").repartition(len(rows))
    got = S.dedup(docs, cfg).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].text is None and by[2][0].text == "" and by[3][0].text == " \n "
    assert all(r.n_removed == 0 and r.text == text for r in by[4])  # repeated rows are one document
    assert by[None][0].n_removed > 0
    assert S.dedup(make([]), cfg).count() == 0


@pytest.mark.parametrize("text", ["a b c d e f", "a", "a. b.", "a b c. d e f. g h i."])
def test_a_batch_of_few_sentences(make, text):
    """Each row alone in its task, fewer sentences than a span needs."""
    assert len(S.runs([text], S.WHOLE)[0]) == 0
    rows = S.dedup(make([(1, text), (2, text)]).repartition(2, "doc_id"), S.WHOLE).collect()
    assert [r.text for r in rows] == [text, text]


def test_removed_ranges_rebuild_the_text(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in S.dedup(docs).collect():
        keep, at = [], 0
        for pair in filter(None, r.removed.split(",")):
            a, b = map(int, pair.split(":"))
            keep.append(texts[r.doc_id][at:a])
            at = b
        assert "".join(keep) + texts[r.doc_id][at:] == r.text


def winnowed(text, cfg=S.WHOLE):
    """(numbers of the words that begin a sentence, words): long sentences are cut after words whose hash is smallest of a window."""
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c.lower() for c in text or "")
    words = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", low)]
    sentences, now = [], []
    for k, (w, _, end) in enumerate(words):
        now.append(k)
        core = w[:-1] if len(w.encode()) > 1 and w[-1] in "\"')]" else w
        gap = low[end:words[k + 1][1]] if k + 1 < len(words) else "\n"
        if core[-1] in ".!?" or "\n" in gap:
            sentences.append(now)
            now = []
    sentences += [now] if now else []
    starts = []
    for s in sentences:
        starts.append(s[0])
        if len(s) <= cfg.long_words:
            continue
        value = [int(S.words_of([words[k][0]])[0][0]) for k in s]
        low_at = {k for a in range(len(s) - cfg.window + 1) for k in range(a, a + cfg.window) if value[k] == min(value[a:a + cfg.window])}
        starts += [s[k] + 1 for k in sorted(low_at) if k + 1 < len(s)]
    return starts, [w for w, _, _ in words]


def whole_brute(rows, cfg=S.WHOLE):
    """doc_id -> (sentences, removed words): every run of consecutive sentences is a span, cut or not."""
    found, per = {}, {}
    for d, t in rows:
        starts, words = winnowed(t, cfg)
        starts, per[d] = starts + [len(words)], (len(starts), set())
        for i in range(len(starts) - 1):
            for j in range(i + cfg.sentences, len(starts)):
                a, b = starts[i], starts[j]
                if b - a >= cfg.min_words and found.setdefault(tuple(words[a:b]), (d, a)) != (d, a):
                    per[d][1].update(range(a, b))
    return {d: (n, len(gone)) for d, (n, gone) in per.items()}


def test_whole_rules_remove_every_repeated_run(make):
    rng = random.Random(5)
    shared = [prose(rng, n, mark) + "." for n in (25, 50, 70) for mark in (0.0, 0.1, 0.3)]
    rows = [(i, " ".join(rng.choice([prose(rng, 15, 0.1), rng.choice(shared)]) for _ in range(6))) for i in range(40)]
    got = {r.doc_id: (r.n_sentences, r.removed_words) for r in S.dedup(make(rows), S.WHOLE).collect()}
    assert got == whole_brute(rows)


def test_whole_rules_reach_the_tail_of_an_exact_copy(make):
    rng = random.Random(6)
    text = " ".join(prose(rng, n, 0.0) + "." for n in (10, 10, 12, 5, 4, 3, 2))
    got = {r.doc_id: r.text for r in S.dedup(make([(1, text), (2, text + "\n" + prose(rng, 9, 0.0))]), S.WHOLE).collect()}
    assert got[1] == text and len(got[2].split()) == 9


def test_whole_rules_find_unmarked_passages_of_49_words():
    """Cuts come every ``window`` words, whatever the words hash to and whatever stands beside them."""
    rng = random.Random(7)
    for n in range(300):
        passage = prose(rng, 49, 0.0)
        a, b = (f"{prose(rng, 30, 0.0)} {passage} {prose(rng, 30, 0.0)}" for _ in range(2))
        key, _, _, _, _, text = S.runs([a, b], S.WHOLE)
        assert set(key[text == 0].tolist()) & set(key[text == 1].tolist()), n
    same = [w for w in ("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)) if not word_cut(w, Spans())][:60]
    assert len(S.runs([" ".join(same)], S.WHOLE)[0]) > 0


def test_registered_rules_equal_brute_force_on_the_table(spark):
    """Whole texts of up to 400 words; the plain version cuts sentences by itself.

    It compares every run with every run.  Where one text cuts a passage
    otherwise than another, the last sentence of a repeat may stay.
    """
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if len((r.text or "").split()) <= 400)
    kept = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_sentences, r.removed_words) for r in S.dedup(kept, S.WHOLE).collect()}
    want = whole_brute(rows)
    assert {d: n for d, (n, _) in got.items()} == {d: n for d, (n, _) in want.items()}
    left = {d: want[d][1] - got[d][1] for d in want if want[d] != got[d]}
    assert all(0 < n <= 2 * S.WHOLE.long_words for n in left.values()) and len(left) <= 0.02 * len(want)
    assert sum(n for _, n in got.values()) > 100


def test_one_hash_alone_does_not_remove(make, monkeypatch):
    """Spans that agree in the first hash only are different spans."""
    rng = random.Random(9)
    rows = [(i, prose(rng, 60)) for i in range(6)]
    plain = S.polynomial
    monkeypatch.setattr(S, "polynomial", lambda value, a, b, factor: plain(value, a, b, factor) % (7 if factor == 0x100000001B3 else 1 << 63) )
    for cfg in (Spans(), S.WHOLE):
        assert all(r.n_removed == 0 for r in S.dedup(make(rows), cfg).collect())
