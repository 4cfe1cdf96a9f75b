"""Substring dedup by sliding sentence spans.

A text is cut into sentences (end marks followed by a blank, or line ends);
sentences longer than ``long_words`` are cut further after words whose hash is
0 modulo ``cut_every``, so equal passages are cut equally wherever they stand.
At every sentence begins one span: the shortest run of at least ``sentences``
sentences holding at least ``min_words`` words.  Spans are hashed (lower case,
blanks folded) and joined globally: the first one in (doc_id, text hash,
position) order stays, the sentences covered by any other are removed.  Spans
count as equal where two independent 64-bit hashes of their words agree.

``WHOLE``, the rules of op10_span_dedup, leaves no repeat of enough sentences and
words behind.  Long sentences are cut by winnowing, after the words with the
smallest hash of any ``window`` words in a row: a cut comes every ``window``
words at least, and a repeat of 49 words is found whatever stands beside it.
With ``tails`` the shortest run that ends with each sentence is hashed too, so
a repeat is covered up to its last sentence; such a run takes part only where
the shorter span at its start is met twice.  A run is looked up under its own
text's cuts: where the same words are cut otherwise elsewhere (a long sentence
that begins or ends differently), the sentence at a repeat's edge may stay.

The first span of a hash is a pre-aggregated minimum; only hashes met twice
are joined back, a hash with a third of all spans is split by the skew join.

Cases: null, empty and wordless texts have no spans and stay as they are; rows
repeated with id and text count as one document and get the same result; null
ids come last in the order; texts without end marks are cut by word hashes;
ties cannot occur (positions differ); very long texts are read whole, in pieces
of texts of bounded length (one text is never cut); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stride.llm.bagminhash import GOLDEN, mix
from stride.llm.common import cut, map_texts


@dataclass(frozen=True)
class Spans:
    sentences: int = 3
    min_words: int = 20
    long_words: int = 12
    cut_every: int = 6
    window: int = 0  # at most long_words; 0: cuts by cut_every
    tails: bool = False


WHOLE = Spans(window=10, tails=True)


def words_of(texts: list):
    """(hash, last byte, a line ends after it, text) per word, all texts at once; words are split at ASCII blanks."""
    import numpy as np

    raw = [(t or "").lower().encode("utf-8", "replace") + b"\n" for t in texts]
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    at = np.flatnonzero(~blank)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, bool), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    length = np.diff(np.r_[first, len(at)])
    power = np.cumprod(np.full(int(length.max()), 0x100000001B3, dtype=np.uint64))
    place = np.arange(len(at)) - np.repeat(first, length)
    value = mix(np.add.reduceat((buf[at].astype(np.uint64) + np.uint64(1)) * power[place], first)
                + length.astype(np.uint64) * np.uint64(GOLDEN))
    last = at[first + length - 1]
    lines = np.cumsum(buf == 10)
    begin = at[first]
    ends_line = np.r_[lines[begin[1:]] > lines[last[:-1]], True]
    closing = np.isin(buf[last], np.frombuffer(b"\"')]", dtype=np.uint8)) & (length > 1)
    mark = buf[np.where(closing, last - 1, last)]
    ends = np.cumsum([len(r) for r in raw])
    return value, mark, ends_line, np.searchsorted(ends, begin, side="right")


def smallest(value, size, long, window: int):
    """True for words with the smallest hash of some ``window`` words in a row of one long sentence."""
    import numpy as np

    def slide(x, least):
        wide = 1
        while wide < window:
            step = min(wide, window - wide)
            x = least(x[:-step], x[step:])
            wide += step
        return x

    if len(value) < window:
        return np.zeros(len(value), dtype=bool)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(value))
    inside = (long & (left >= window))[:len(value) - window + 1]
    low = np.where(inside, slide(value, np.minimum), np.uint64(0))
    edge = np.zeros(window - 1, dtype=np.uint64)
    return long & (value == slide(np.r_[edge, low, edge], np.maximum))


def sentence_starts(value, mark, ends_line, owner, cfg: Spans):
    """Numbers of the words that begin a sentence."""
    import numpy as np

    if not len(value):
        return np.zeros(0, np.int64)
    stop = np.isin(mark, np.frombuffer(b".!?", dtype=np.uint8)) | ends_line
    other = np.r_[True, owner[1:] != owner[:-1]]
    begin = np.r_[True, stop[:-1]] | other
    starts = np.flatnonzero(begin)
    size = np.diff(np.r_[starts, len(value)])
    long = np.repeat(size > cfg.long_words, size)
    cuts = smallest(value, size, long, cfg.window) if cfg.window else long & (value % np.uint64(cfg.cut_every) == 0)
    return np.flatnonzero(begin | np.r_[False, cuts[:-1]])


def runs(texts: list, cfg: Spans):
    """(span hash, second hash, hash of the shortest span at its start, first word, word after it, text); words count from the text's own first."""
    import numpy as np

    value, mark, ends_line, owner = words_of(texts)
    starts = sentence_starts(value, mark, ends_line, owner, cfg)
    if not len(starts):
        return *[np.zeros(0, np.uint64)] * 3, *[np.zeros(0, np.int64)] * 3
    ends = np.r_[starts[1:], len(value)]
    i = np.arange(len(starts))
    # the last sentence: enough of them, and enough words
    j = np.maximum(i + cfg.sentences - 1, np.searchsorted(ends, starts + cfg.min_words, side="left"))
    ok = j < len(starts)
    i, j = i[ok], j[ok]
    same = owner[starts[i]] == owner[starts[j]]
    i, j = i[same], j[same]
    n, lead = len(i), np.arange(len(i))
    if cfg.tails:
        # the shortest run before each end, where it is not the shortest one at its start
        last = np.arange(len(starts))
        begin = np.minimum(last - cfg.sentences + 1, np.searchsorted(starts, ends - cfg.min_words, side="right") - 1)
        number = np.full(len(starts), -1)
        number[i] = lead
        short = (begin >= 0) & (owner[starts[np.maximum(begin, 0)]] == owner[starts])
        begin, last = begin[short], last[short]
        more = j[number[begin]] < last
        i, j, lead = np.r_[i, begin[more]], np.r_[j, last[more]], np.r_[lead, number[begin[more]]]
    a, b = starts[i], ends[j]
    key = polynomial(value, a, b, 0x100000001B3)
    check = polynomial(mix(value + np.uint64(GOLDEN)), a, b, 0x9E3779B97F4A7C55)
    text = owner[a]
    zero = np.searchsorted(owner, np.arange(len(texts)), side="left")
    return key, check, key[:n][lead], a - zero[text], b - zero[text], text


def polynomial(value, a, b, factor: int):
    """A hash of the values [a, b) for all pairs at once, wherever they stand."""
    import numpy as np

    # prefix sums; the factor's inverse takes the position out
    powers = [np.cumprod(np.r_[np.uint64(1), np.full(len(value) - 1, f, dtype=np.uint64)]) for f in (factor, pow(factor, -1, 1 << 64))]
    prefix = np.r_[np.uint64(0), np.cumsum(value * powers[0])]
    return mix((prefix[b] - prefix[a]) * powers[1][a] + (b - a).astype(np.uint64) * np.uint64(GOLDEN))


def spans(docs: DataFrame, cfg: Spans = Spans()) -> DataFrame:
    """(span, check, lead, _id, _hash, a, b): one row per span, a document's words [a, b); lead is the shortest span at a."""
    import numpy as np

    def apply(ids, hashes, texts):
        key, check, lead, a, b, text = runs(texts, cfg)
        at = text.tolist()
        return {"span": key.view(np.int64), "check": check.view(np.int64), "lead": lead.view(np.int64), "_id": [ids[k] for k in at], "_hash": [hashes[k] for k in at],
                "a": a.astype(np.int32), "b": b.astype(np.int32)}

    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, apply, "span bigint, check bigint, lead bigint, _id bigint, _hash bigint, a int, b int", "_id", "_hash", "text")


def repeated_ranges(docs: DataFrame, cfg: Spans = Spans()) -> DataFrame:
    """(_id, _hash, ranges): word ranges covered by spans that are not the first of their hash."""
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash", "a")
    all_spans = spans(docs, cfg)

    def firsts(rows: DataFrame) -> DataFrame:
        # two different places at least: the smallest and the largest differ
        first = rows.groupBy("span", "check").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        return first.where(F.col("first") != F.col("last")).select(F.col("span").alias("_s"), F.col("check").alias("_check"), "first")

    first = cut(firsts(all_spans.where(F.col("span") == F.col("lead"))), "span-firsts")
    # a tail only needs its lead to be met twice; a lead must be the first one's equal in both hashes
    same = (F.col("span") != F.col("lead")) | (F.col("check") == F.col("_check"))
    met = all_spans.join(first, (F.col("lead") == F.col("_s")) & same)
    if cfg.tails:
        met = cut(met.select("span", "check", "_id", "_hash", "a", "b", (F.col("span") != F.col("lead")).alias("tail"),
                             (place != F.col("first")).alias("again")), "span-met")
        tails = met.where("tail").drop("again")
        more = tails.join(firsts(tails), (F.col("span") == F.col("_s")) & (F.col("check") == F.col("_check"))).where(place != F.col("first"))
        other = met.where("NOT tail AND again").select("_id", "_hash", "a", "b").unionByName(more.select("_id", "_hash", "a", "b"))
    else:
        other = met.where(place != F.col("first"))
    return other.groupBy("_id", "_hash").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))


SCHEMA = "doc_id bigint, n_sentences bigint, n_removed bigint, removed_words bigint, removed string, text string"


def dedup(docs: DataFrame, cfg: Spans = Spans()) -> DataFrame:
    """Per document: sentence counts, removed code-point ranges (``start:end`` comma-joined) and the remaining text."""
    ranges = repeated_ranges(docs, cfg)
    rows = docs.select("doc_id", F.xxhash64("text").alias("_dh"), F.col("text").cast("string").alias("text"))
    both = rows.join(ranges, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_dh") == F.col("_hash")), "left")
    flat = both.select("doc_id", F.expr("transform(ranges, r -> r.a)").alias("a"), F.expr("transform(ranges, r -> r.b)").alias("b"), "text")

    def clean(ids, starts, ends, texts):
        import numpy as np

        value, mark, ends_line, owner = words_of(texts)
        begins = sentence_starts(value, mark, ends_line, owner, cfg)
        zero = np.searchsorted(owner, np.arange(len(texts) + 1), side="left")
        first = np.searchsorted(begins, zero, side="left")
        out: dict = {k.split()[0]: [] for k in SCHEMA.split(", ")}
        for k, (i, a, b, text) in enumerate(zip(ids, starts, ends, texts)):
            n = int(zero[k + 1] - zero[k])
            sentence = begins[first[k]:first[k + 1]] - zero[k]
            row = (i, len(sentence), 0, 0, "", text)
            if a:
                gone = np.zeros(n + 1, dtype=np.int64)
                np.add.at(gone, a, 1)
                np.add.at(gone, b, -1)
                covered = np.cumsum(gone)[:n] > 0
                row = (i, len(sentence), int(covered[sentence].sum()), int(covered.sum()), *without(text, covered))
            for name, v in zip(out, row):
                out[name].append(v)
        return out

    return map_texts(flat, clean, SCHEMA, "doc_id", "a", "b", "text")


def without(text: str, covered) -> tuple:
    """(code-point ranges of the covered words up to the next word, remaining text)"""
    import re

    starts = [m.start() for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", text)]
    ranges, keep, at, w = [], [], 0, 0
    while w < len(starts):
        if not covered[w]:
            w += 1
            continue
        begin = starts[w]
        while w < len(starts) and covered[w]:
            w += 1
        end = starts[w] if w < len(starts) else len(text)
        ranges.append(f"{begin}:{end}")
        keep.append(text[at:begin])
        at = end
    keep.append(text[at:])
    return ",".join(ranges), "".join(keep)
