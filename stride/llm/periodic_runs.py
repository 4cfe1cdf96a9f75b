"""Periodic run detection by an online sparse diagonal DP.

A text is its words (stretches without ASCII blanks).  A run is a stretch of
words with smallest period q (words q apart are equal) and at least
``max(min_length, repeats * q)`` words, which no neighbouring word extends.  On
the diagonal of lag q a run is an unbroken line of matches, so it is found by
walking the words once, lengthening the active lag by one where the word's
earlier occurrence lies that lag back, and emitting the run where the line ends.

Earlier occurrences are kept sparse without losing a run.  A run's line holds
at least ``(repeats - 1) * q`` matches, so equal words alone need not be looked
at: a word counts together with the words before it, as a stretch of g words,
and g doubles.  Stretches met once in the text are dropped at every doubling,
which leaves next to nothing of prose.  For the periods in (g / 2, g] the
*nearest* earlier occurrence of a stretch of g words inside a run is exactly q
back (a nearer one would give the run a smaller period), so one active lag per
position and size is enough: n log n steps for any text, also for one word
repeated a million times, and no pairs of occurrences are formed.

Rows are independent: one pass over the table, no shuffle.

Cases: null and blank texts have no words and no runs, their collapsed text is
empty; repeated rows give equal rows; a null id is passed on; runs that share
words are all reported, in the order of start, then period; very long texts
are walked whole, memory is a few numbers per word of one piece of texts; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stride.llm.common import map_texts


@dataclass(frozen=True)
class RunRules:
    min_length: int = 24
    repeats: int = 3

    def __post_init__(self):
        if self.repeats < 3 or self.min_length < 1:
            raise ValueError("a run repeats at least three times")

    @property
    def first_size(self) -> int:
        """The largest power of two that no run's line of matches is shorter than."""
        shortest = min(max(self.min_length - q, (self.repeats - 1) * q) for q in range(1, self.min_length + 1))
        return 1 << (max(shortest, 1).bit_length() - 1)


def diagonals(place, stretch, lags: tuple[int, int]):
    """(lag, first place, last place) of every unbroken line; places ascend, equal numbers of ``stretch`` are equal stretches."""
    import numpy as np

    order = np.lexsort((place, stretch))
    same = np.r_[False, stretch[order][1:] == stretch[order][:-1]]
    lag = np.zeros(len(place), dtype=np.int64)
    lag[order[same]] = place[order[same]] - place[order[np.flatnonzero(same) - 1]]
    begins = np.flatnonzero(np.r_[True, (np.diff(place) != 1) | (np.diff(lag) != 0)])
    ends = np.r_[begins[1:], len(place)] - 1
    inside = (lag[begins] >= lags[0]) & (lag[begins] <= lags[1])
    return lag[begins][inside], place[begins][inside], place[ends][inside]


def repeated(key):
    """(a number per distinct key, whether the key is met again)"""
    import numpy as np

    _, number, times = np.unique(key, return_inverse=True, return_counts=True)
    return number, times[number] > 1


def runs_of(word, owner, longest: int, rules: RunRules = RunRules()):
    """(first word, length, period) arrays of all runs; ``word`` numbers equal words alike, ``owner`` is the text of each word."""
    import numpy as np

    found = []
    if len(word):
        size, rank = 1, np.full(len(word), -1, dtype=np.int64)
        number, again = repeated(owner.astype(np.int64) * (np.int64(word.max()) + 1) + word)
        place, number = np.flatnonzero(again), number[again]
        while len(place):
            if size >= rules.first_size:
                lag, a, b = diagonals(place, number, (1 if size == rules.first_size else size // 2 + 1, size))
                start = a - lag - size + 1
                length = b - start + 1
                ok = length >= np.maximum(rules.min_length, rules.repeats * lag)
                found.append(np.stack([start[ok], length[ok], lag[ok]]))
                if rules.repeats * (size + 1) > longest:
                    break
            # stretches of twice the size: both halves are met again
            rank[place] = number
            late = place[place >= size]
            both = late[rank[late - size] >= 0]
            pair = rank[both - size] * (np.int64(number.max()) + 1) + rank[both]
            rank[place] = -1
            number, again = repeated(pair)
            place, number, size = both[again], number[again], size * 2
    out = np.concatenate(found, axis=1) if found else np.zeros((3, 0), dtype=np.int64)
    return out[:, np.lexsort((out[2], out[0]))]


def find(docs: DataFrame, rules: RunRules = RunRules(), order: Callable | None = None) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period in words, by start, then period) and the collapsed text.

    The collapsed text keeps each run's first period: the words that no run
    holds after its first q words, joined by a blank.  ``order(doc_id, n)`` may
    return the numbers of the n words in the order they are to be read in, or
    None for their own order.
    """
    import numpy as np

    def apply(ids, texts):
        words = [(t or b"").split() for t in texts]  # bytes are split at ASCII blanks
        if order:
            for k, (i, w) in enumerate(zip(ids, words)):
                numbers = order(i, len(w))
                words[k] = w if numbers is None else [w[j] for j in numbers]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        known: dict = {}
        number = known.setdefault
        word = np.array([number(x, len(known)) for w in words for x in w], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        start, length, period = runs_of(word, owner, int(sizes.max(initial=0)), rules)
        zero = np.r_[0, np.cumsum(sizes)]
        first = np.searchsorted(start, zero)
        runs, collapsed = [], []
        for k, w in enumerate(words):
            mine = range(first[k], first[k + 1])
            runs.append([{"start": int(start[j] - zero[k]), "length": int(length[j]), "period": int(period[j])} for j in mine])
            if mine:
                gone = np.zeros(len(w) + 1, dtype=np.int64)
                for r in runs[-1]:
                    gone[r["start"] + r["period"]] += 1
                    gone[r["start"] + r["length"]] -= 1
                w = [w[j] for j in np.flatnonzero(np.cumsum(gone)[:len(w)] == 0)]
            collapsed.append(b" ".join(w))
        return {"doc_id": ids, "n_words": sizes, "runs": runs, "collapsed": collapsed}

    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    out = map_texts(rows, apply, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary",
                    "doc_id", "text")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, the first of equals; null where there is none."""
    empty = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    more = lambda a, r: F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a)
    return F.aggregate(runs, empty, more)


def digest(found: DataFrame) -> DataFrame:
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = found.select("doc_id", "n_words", F.size("runs").cast("bigint").alias("n_runs"), strongest(F.col("runs")).alias("best"),
                        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_words", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
