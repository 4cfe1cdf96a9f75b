"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every run of non-letters becomes one blank, and the
n-grams of one to three characters are hashed into ``2**bits`` buckets.  Tasks
count (language, bucket) pairs of the training rows and pre-aggregate them;
the log-probability matrix (languages x buckets, a few hundred KB) goes to the
tasks once, and a batch is scored by gathering its rows in numpy.

Training rows: rows with text and language, at most about ``max_train_rows``
per language, chosen by a hash of the id (a documented bound; scoring always
covers whole texts of all rows).

Cases: null text, or no letter in it: ``und`` with score 0.  A null language
or id is never learned from.  No training rows at all: every text is ``und``.
Ties go to the alphabetically first language.  Repeated rows give repeated
results; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stride.llm.common import filter_texts, map_texts

UNDETERMINED = "und"
KEEP_CHARS = 500_000  # characters scored at a time where whole rows pass through the task


@dataclass(frozen=True)
class NGrams:
    sizes: tuple = (1, 2, 3)
    bits: int = 15
    alpha: float = 0.5


@dataclass
class LanguageModel:
    languages: list
    log_prob: object  # float32 (languages, buckets)
    grams: NGrams
    letters: object   # letter_table()

    def shared(self, spark):
        """Plain lists and arrays only: a broadcast is unpickled where this package may be missing."""
        return spark.sparkContext.broadcast((self.languages, self.log_prob, self.letters))


def letter_table():
    """Per code point: the character itself if it is a letter, else a blank (4 MB, made on the driver, broadcast)."""
    import numpy as np

    is_letter = np.array([chr(c).isalpha() for c in range(0x110000)])
    return np.where(is_letter, np.arange(0x110000), 32).astype(np.uint32)


def hashed_grams(texts: list, grams: NGrams, letters):
    """(bucket per gram, index of its text), texts with no letter give none."""
    import numpy as np

    lowered = [(t or "").lower() + " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    chars = letters[codes]
    blank = chars == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first blank after a letter stays, across texts too
    chars, owner = chars[keep], owner[keep]
    buckets, owners = [], []
    mult = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)
    for n in grams.sizes:
        m = len(chars) - n + 1
        if m <= 0:
            continue
        h = np.full(m, (n * 0x632BE5AB) & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(n):
            h = (h ^ chars[k:k + m]) * mult[k]
            h ^= h >> np.uint32(15)
        inside = owner[:m] == owner[n - 1:]
        if n == 1:
            inside &= chars != 32
        buckets.append((h >> np.uint32(32 - grams.bits))[inside].astype(np.int32))
        owners.append(owner[:m][inside])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(owners)


def train(docs: DataFrame, max_train_rows: int = 4000, grams: NGrams = NGrams()) -> LanguageModel:
    """Learn from (doc_id, text, lang); see the module's note on ``max_train_rows``."""
    import numpy as np

    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = rows.groupBy("lang").agg((F.lit(max_train_rows) / F.count(F.lit(1))).alias("share"))
    share = F.broadcast(sizes.select(F.col("lang").alias("_lang"), "share"))  # one row per language
    unit = (F.xxhash64("doc_id") / F.lit(2.0**64)) + 0.5
    sample = rows.join(share, F.col("lang") == F.col("_lang")).where(unit < F.col("share")).select("lang", "text")
    n_buckets = 1 << grams.bits
    letters = letter_table()
    shared = docs.sparkSession.sparkContext.broadcast(letters)

    def count(langs, texts):
        out = {"lang": [], "bucket": [], "n": []}
        for lang in sorted(set(langs)):
            b, _ = hashed_grams([t for t, x in zip(texts, langs) if x == lang], grams, shared.value)
            c = np.bincount(b, minlength=n_buckets)
            used = np.flatnonzero(c)
            out["lang"] += [lang] * len(used)
            out["bucket"] += used.tolist()
            out["n"] += c[used].tolist()
        return out

    counted = map_texts(sample, count, "lang string, bucket int, n bigint", "lang", "text")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toPandas()  # languages x buckets at most: the model itself
    languages = sorted(found["lang"].unique().tolist())
    counts = np.zeros((len(languages), n_buckets))
    index = {x: i for i, x in enumerate(languages)}
    if len(found):
        counts[found["lang"].map(index).to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    smooth = counts + grams.alpha
    return LanguageModel(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32), grams,
                         letters)


def score_texts(texts: list, languages: list, log_prob, letters, grams: NGrams) -> tuple[list, list]:
    """(language, posterior under equal priors) for each text."""
    import numpy as np

    n = len(texts)
    buckets, owners = hashed_grams(texts, grams, letters)
    counts = np.bincount(owners, minlength=n)
    if not languages:
        return [UNDETERMINED] * n, [0.0] * n
    total = np.stack([np.bincount(owners, weights=row[buckets], minlength=n) for row in log_prob])
    best = total.argmax(axis=0)
    posterior = 1.0 / np.exp(total - total.max(axis=0)).sum(axis=0)
    seen = counts > 0
    return ([languages[b] if s else UNDETERMINED for b, s in zip(best, seen)],
            np.where(seen, posterior, 0.0).tolist())


SCHEMA = "doc_id bigint, lang_pred string, score double"


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; only the text is read."""
    shared, grams = model.shared(docs.sparkSession), model.grams  # languages x 2**bits floats

    def apply(ids, texts):
        langs, scores = score_texts(texts, *shared.value, grams)
        return {"doc_id": ids, "lang_pred": langs, "score": scores}

    return map_texts(docs, apply, SCHEMA, "doc_id", "text")


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.5) -> DataFrame:
    """The rows (all columns) whose language is learned and certain enough."""
    shared, grams = model.shared(docs.sparkSession), model.grams

    def identified(texts):
        langs, scores = score_texts(texts, *shared.value, grams)
        return [x != UNDETERMINED and s >= min_score for x, s in zip(langs, scores)]

    return filter_texts(docs, identified, "text", KEEP_CHARS)
