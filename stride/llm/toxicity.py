"""Toxicity: a subsequence string-kernel SVM on Nystroem landmarks.

The kernel compares two words (with a mark before and after each) by their
common subsequences of three characters that span at most ``max_span`` characters, each weighted by ``decay**span``:
inserted or dropped characters lower it, they do not break it.  Words are runs
of letters and digits; single symbols inside a word are dropped and single
letters up to three blanks or symbols apart are joined, so ``i.d.i.o.t``,
``i d i o t`` and ``i - d - i - o - t`` are read as the word.  A word's squared norm is the sum of its squared subsequence
weights; similarities are clipped to [0, 1] and cut below ``floor``.

Landmarks are the words of the training texts that separate the labels most.
A text is the bag of its words (labels mark whole texts), pooled by the
maximum per landmark; the pooled similarities are mapped by the landmark
kernel's inverse square root (Nystroem) and a linear SVM is fitted on them with
Spark ML, then calibrated to a probability.  Scoring folds both linear maps
into one weight per landmark and covers whole texts; each distinct word of a
batch is compared once.

Training rows: labelled rows, at most about ``max_train_rows``, chosen by a
hash of the id (a documented bound).

Cases: null or wordless texts score the model's value for "no landmark seen";
null labels or ids are never learned from, a document labelled more than once
takes its highest label; repeated rows give repeated results; candidates for
landmarks that separate equally stand in alphabetical order (ties); very long
texts are scored whole, memory grows with one piece of texts and one slice of
new words; an empty table gives no rows; other columns are ignored; without both
labels among the training rows every score is their base rate (0 without any).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stride.llm.common import cut, map_texts, pieces

KNOWN_WORDS = 1_000_000  # words whose comparison a worker remembers (8 bytes each)
KNOWN_SIMILAR = 4_000_000  # their similarities to landmarks (8 bytes each)
PIECE_CHARS = 500_000  # characters of texts scored at a time
SLICE_CHARS = 65_536  # characters of new words compared at a time (one word is never cut)
JOINED_OVER = 3  # blanks and symbols at most between single letters that are read as one word


@dataclass(frozen=True)
class Kernel:
    max_span: int = 5
    decay: float = 0.7
    floor: float = 0.55
    bits: int = 20

    @property
    def offsets(self) -> list:
        """(second, third, weight) of every subsequence shape."""
        return [(a, b, self.decay ** (b + 1)) for b in range(2, self.max_span) for a in range(1, b)]


@dataclass(frozen=True)
class Training:
    max_train_rows: int = 20_000
    landmarks: int = 256
    candidates: int = 1500       # best separating words that landmarks are chosen from
    max_alike: float = 0.9      # a landmark is skipped if it is this similar to one chosen before
    min_docs: int = 3
    regularisation: float = 1e-4


@dataclass
class ToxicityModel:
    landmarks: list
    weights: object      # per landmark, Nystroem map and SVM folded
    bias: float
    scale: float         # calibration: sigmoid(scale * margin + shift)
    shift: float
    kernel: Kernel
    rate: float
    name: str = ""

    def shared(self, spark):
        """Plain lists and arrays only: a broadcast is unpickled where this package may be missing."""
        return spark.sparkContext.broadcast((self.landmarks, self.weights, self.bias, self.scale, self.shift, self.rate,
                                             character_kinds()))


def character_kinds():
    """Per code point: 0 blank, 1 symbol, 2 letter or digit (1 MB, made on the driver, broadcast)."""
    import numpy as np

    kinds = np.ones(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        s = chr(c)
        if s.isalnum():
            kinds[c] = 2
        elif s.isspace() or c < 32:
            kinds[c] = 0
    return kinds


def split_words(texts: list, kinds):
    """(characters of all words, start per word, length per word, text per word)."""
    import numpy as np

    raw = [(t or "").lower() + "\n\n" for t in texts]
    codes = np.frombuffer("".join(raw).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = kinds[codes]
    at = np.flatnonzero(kind == 2)
    if not len(at):
        return np.zeros(0, np.uint32), *[np.zeros(0, np.int64)] * 3
    gap = np.diff(at)
    inner = (gap == 2) & (kind[np.minimum(at[:-1] + 1, len(kind) - 1)] == 1)
    new = np.r_[True, (gap > 1) & ~inner]
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(at)])
    # single letters a little apart belong together, within a text
    lone = size == 1
    ends = np.cumsum([len(r) for r in raw])
    text = np.searchsorted(ends, at[first], side="right")
    near = (at[first[1:]] - at[first[:-1]] <= JOINED_OVER + 1) & (text[1:] == text[:-1])
    joined = np.r_[False, lone[1:] & lone[:-1] & near]
    first = first[~joined]
    size = np.diff(np.r_[first, len(at)])
    return codes[at], first, size, text[~joined]


def shapes(chars, starts, sizes, kernel: Kernel):
    """(word, bucket, weight) of every word's subsequences, one shape after the other; marks stand before and after a word."""
    import numpy as np

    sizes = sizes + 2
    total = int(sizes.sum())
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(sizes, sizes) - place
    c = np.where(place == 0, np.uint32(1), np.uint32(2))
    inside = (place > 0) & (left > 1)
    c[inside] = chars[(np.repeat(starts, sizes) + place - 1)[inside]]
    del place, inside
    for a, b, weight in kernel.offsets:
        i = np.flatnonzero(left > b)
        h = c[i] * np.uint32(0x9E3779B1)
        h = ((h ^ (h >> np.uint32(15))) + c[i + a]) * np.uint32(0x85EBCA6B)
        h = ((h ^ (h >> np.uint32(13))) + c[i + b]) * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
        yield word[i], (h >> np.uint32(32 - kernel.bits)).astype(np.int32), weight


class Landmarks:
    """Landmark words as a feature table; compares batches of words with all of them."""

    def __init__(self, words: list, kernel: Kernel):
        import numpy as np

        self.kernel, self.n = kernel, len(words)
        codes = [np.array([ord(x) for x in w], dtype=np.uint32) for w in words]
        sizes = np.array([len(x) for x in codes], dtype=np.int64)
        chars = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        words_, buckets, weights = zip(*shapes(chars, np.cumsum(sizes) - sizes, sizes, kernel))
        owner, bucket = np.concatenate(words_), np.concatenate(buckets)
        weight = np.repeat(weights, [len(w) for w in words_])
        norm = np.sqrt(np.maximum(np.bincount(owner, weights=weight**2, minlength=self.n), 1e-300))
        # feature -> (landmark, weight / norm) lists
        pair, inverse = np.unique(bucket.astype(np.int64) * max(self.n, 1) + owner, return_inverse=True)
        value = np.bincount(inverse, weights=weight, minlength=len(pair)) / norm[(pair % max(self.n, 1)).astype(int)]
        features, begin = np.unique(pair // max(self.n, 1), return_index=True)
        self.table = np.full(1 << kernel.bits, -1, dtype=np.int32)
        self.table[features] = np.arange(len(features), dtype=np.int32)
        self.begin = np.r_[begin, len(pair)]
        self.who = (pair % max(self.n, 1)).astype(np.int64)
        self.value = value

    def similarities(self, chars, starts, sizes):
        """(numbers of the words that reach the floor, their rows of landmark similarities)."""
        import numpy as np

        norm2, covered, hits = np.zeros(len(sizes)), np.zeros(len(sizes)), []
        for owner, bucket, weight in shapes(chars, starts, sizes, self.kernel):
            norm2 += weight**2 * np.bincount(owner, minlength=len(sizes))
            feature = self.table[bucket]
            hit = feature >= 0
            hits.append((owner[hit], feature[hit], weight))
            covered += weight**2 * np.bincount(owner[hit], minlength=len(sizes))
        # a word can only reach the floor if known subsequences hold enough of its norm
        possible = covered >= self.kernel.floor**2 * norm2 * (1 - 1e-9)
        possible &= norm2 > 0
        rank = np.cumsum(possible) - 1
        some = np.flatnonzero(possible)
        sums = np.zeros(len(some) * self.n)
        for owner, feature, weight in hits:
            hit = possible[owner]
            owner, feature = rank[owner[hit]], feature[hit]
            n = self.begin[feature + 1] - self.begin[feature]
            entry = np.repeat(self.begin[feature], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            sums += np.bincount(np.repeat(owner, n) * self.n + self.who[entry], weights=weight * self.value[entry], minlength=len(sums))
        rows = np.minimum(sums.reshape(len(some), self.n) / np.sqrt(norm2[some])[:, None], 1.0)
        rows[rows < self.kernel.floor] = 0.0
        seen = rows.any(axis=1)
        return some[seen], rows[seen].astype(np.float32)


class Memory:
    """Compared words by key, with the landmarks each of them is near to (lists laid end to end)."""

    def __init__(self, landmarks: Landmarks):
        import numpy as np

        self.landmarks = landmarks
        self.keys, self.row_of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lists = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)

    def look(self, keys, chars, starts, sizes):
        """(list number per key or -1, (begins, landmarks, similarities)); keys are sorted and distinct."""
        import numpy as np

        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        result = np.full(len(keys), -1)
        result[known] = self.row_of[at[known]]
        fresh = np.flatnonzero(~known)
        begins, near, similar = ([x] for x in self.lists)
        count = len(begins[0]) - 1
        for a, b in pieces((sizes[fresh] + 2).tolist(), SLICE_CHARS):
            part = fresh[a:b]
            found, rows = self.landmarks.similarities(chars, starts[part], sizes[part])
            if not len(found):
                continue
            result[part[found]] = count + np.arange(len(found))
            word, landmark = rows.nonzero()
            begins.append(begins[-1][-1] + np.cumsum(np.bincount(word, minlength=len(found))))
            near.append(landmark.astype(np.int32))
            similar.append(rows[word, landmark])
            count += len(found)
        lists = np.concatenate(begins), np.concatenate(near), np.concatenate(similar)
        if len(self.keys) + len(fresh) <= KNOWN_WORDS and len(lists[1]) <= KNOWN_SIMILAR:
            self.keys = np.insert(self.keys, at[fresh], keys[fresh])
            self.row_of = np.insert(self.row_of, at[fresh], result[fresh])
            self.lists = lists
        return result, lists


def _worker_state() -> dict:
    """A dict that lives as long as the Python worker, not just the task."""
    import sys
    import types

    return sys.modules.setdefault("_toxicity_worker_state", types.ModuleType("_toxicity_worker_state")).__dict__


def _memory(name: str, words: list, kernel: Kernel) -> Memory:
    """The worker's memory for one model; another model's is dropped."""
    state = _worker_state()
    if state.get("name") != name:
        state["name"], state["memory"] = name, Memory(Landmarks(words, kernel))
    return state["memory"]


def pooled(texts: list, memory: Memory, kinds):
    """(texts, landmarks): the highest similarity of any word of the text."""
    import numpy as np

    result = np.zeros((len(texts), memory.landmarks.n), dtype=np.float32)
    chars, starts, sizes, text = split_words(texts, kinds)
    long = np.flatnonzero(sizes >= 3)
    if not len(long) or not memory.landmarks.n:
        return result
    starts, sizes, text = starts[long], sizes[long], text[long]
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    power = np.cumprod(np.full(int(sizes.max()), 0x100000001B3, dtype=np.uint64))
    letters = chars[np.repeat(starts, sizes) + place].astype(np.uint64) + np.uint64(7)
    key = np.add.reduceat(letters * power[place], np.cumsum(sizes) - sizes) ^ (sizes.astype(np.uint64) << np.uint64(56))
    key, one, which = np.unique(key, return_index=True, return_inverse=True)
    row_of, (begins, near, similar) = memory.look(key, chars, starts[one], sizes[one])
    at = row_of[which]
    seen = at >= 0
    # a text's repeats of a word add nothing
    pair = np.unique(text[seen] * np.int64(len(begins)) + at[seen])
    owner, at = pair // len(begins), pair % len(begins)
    n = begins[at + 1] - begins[at]
    entry = np.repeat(begins[at], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    np.maximum.at(result.reshape(-1), np.repeat(owner, n) * memory.landmarks.n + near[entry], similar[entry])
    return result


def _training_rows(docs: DataFrame, labels: DataFrame, t: Training) -> DataFrame:
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = F.lit(float(t.max_train_rows)) / F.greatest(F.lit(1), F.lit(labels.count()))
    chosen = known.where((F.xxhash64("_id") / F.lit(2.0**64)) + 0.5 < share)
    # about max_train_rows pairs of numbers at most
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("toxic", "text")


def _landmark_words(rows: DataFrame, n_toxic: int, n_clean: int, t: Training, kernel: Kernel, shared) -> list:
    def distinct_words(labels, texts):
        out: dict = {"word": [], "toxic": []}
        chars, starts, sizes, owner = split_words(texts, shared.value)
        bag = [set() for _ in texts]
        for s, n, o in zip(starts.tolist(), sizes.tolist(), owner.tolist()):
            if 3 <= n <= 32:
                bag[o].add(chars[s:s + n].tobytes())
        for label, words in zip(labels, bag):
            out["word"] += [w.decode("utf-32-le", "surrogatepass") for w in words]
            out["toxic"] += [label] * len(words)
        return out

    words = map_texts(rows, distinct_words, "word string, toxic int", "toxic", "text")
    counts = words.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    p, q = F.col("a") / F.lit(max(n_toxic, 1)), F.col("b") / F.lit(max(n_clean, 1))
    mean = (F.col("a") + F.col("b")) / F.lit(max(n_toxic + n_clean, 1))
    z = (p - q) / F.sqrt(mean * (1 - mean) * F.lit(1 / max(n_toxic, 1) + 1 / max(n_clean, 1)) + 1e-12)
    best = counts.where((F.col("a") >= t.min_docs) & (p > q)).orderBy(z.desc(), "word").limit(t.candidates)
    words = [r["word"] for r in best.select("word").collect()]  # at most t.candidates
    alike = word_similarities(words, kernel)
    chosen: list = []
    for i in range(len(words)):
        if len(chosen) < t.landmarks and (not chosen or alike[i, chosen].max() < t.max_alike):
            chosen.append(i)
    return [words[i] for i in chosen]


def word_similarities(words: list, kernel: Kernel):
    """Square matrix of the words' similarities, ones on the diagonal."""
    import numpy as np

    matrix = np.zeros((len(words), len(words)))
    if words:
        codes = [np.array([ord(x) for x in w], dtype=np.uint32) for w in words]
        sizes = np.array([len(c) for c in codes], dtype=np.int64)
        found, similar = Landmarks(words, kernel).similarities(np.concatenate(codes), np.cumsum(sizes) - sizes, sizes)
        matrix[found] = similar
        np.fill_diagonal(matrix, 1.0)
    return matrix


def train(docs: DataFrame, labels: DataFrame, kernel: Kernel = Kernel(), t: Training = Training()) -> ToxicityModel:
    """Learn from (doc_id, text) and labels (doc_id, toxic)."""
    import numpy as np
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector

    spark = docs.sparkSession
    rows = cut(_training_rows(docs, labels, t), "toxic-train")
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = n_toxic / n if n else 0.0
    flat = ToxicityModel([], np.zeros(0), 0.0, 0.0, 0.0, kernel, rate)
    if n_toxic in (0, n):
        return flat
    kinds = spark.sparkContext.broadcast(character_kinds())
    words = _landmark_words(rows, n_toxic, n - n_toxic, t, kernel, kinds)
    if not words:
        return flat
    gram = word_similarities(words, kernel)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T
    name = uuid.uuid4().hex
    given = spark.sparkContext.broadcast((words, root))

    def features(labels_, texts):
        words_, root_ = given.value
        z = pooled(texts, _memory(name, words_, kernel), kinds.value) @ root_
        return {"toxic": labels_, "z": z.tolist()}

    mapped = map_texts(rows, features, "toxic int, z array<double>", "toxic", "text", most=PIECE_CHARS)
    table = cut(mapped.select(F.col("toxic").cast("double").alias("label"), array_to_vector("z").alias("features")).coalesce(8), "toxic-z")
    svm = LinearSVC(maxIter=60, regParam=t.regularisation, standardization=False, aggregationDepth=2).fit(table)
    weights = root @ svm.coefficients.toArray()
    scored = svm.transform(table).select("label", "rawPrediction").toPandas()  # about max_train_rows margins
    margin = np.array([v[1] for v in scored["rawPrediction"]])
    scale, shift = calibrate(margin, scored["label"].to_numpy())
    return ToxicityModel(words, weights, float(svm.intercept), scale, shift, kernel, rate, name)


def calibrate(margin, label) -> tuple:
    """Platt's sigmoid by Newton steps on smoothed targets."""
    import numpy as np

    up, down = (label > 0).sum(), (label <= 0).sum()
    target = np.where(label > 0, (up + 1) / (up + 2), 1 / (down + 2))
    beta = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - target)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


SCHEMA = "doc_id bigint, score double, predicted int"


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, predicted) of every row; only the text is read."""
    shared, name, kernel = model.shared(docs.sparkSession), model.name, model.kernel

    def apply(ids, texts):
        import numpy as np

        words, weights, bias, scale, shift, rate, kinds = shared.value
        if not words:
            scores = np.full(len(texts), rate)
        else:
            margin = pooled(texts, _memory(name, words, kernel), kinds) @ weights + bias
            scores = 1 / (1 + np.exp(-np.clip(scale * margin + shift, -30, 30)))
        return {"doc_id": ids, "score": scores.tolist(), "predicted": (scores >= 0.5).astype(int).tolist()}

    return map_texts(docs.withColumn("text", F.col("text").cast("string")), apply, SCHEMA, "doc_id", "text", most=PIECE_CHARS)
