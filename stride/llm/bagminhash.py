"""Near-duplicates by BagMinHash signatures of weighted five-word shingles.

A text is the multiset of its five-word shingles (lower case, split at ASCII
blanks; fewer words: one shingle of them all).  The weight axis of a shingle
is discretised at whole counts and cut into dyadic blocks (0,1], (1,2], (2,4],
(4,8] ...  Each block is a Poisson process whose rate is its width; its points
carry an arrival value, a register and a path of left/right halvings that
names the unit level inside the block.  A shingle of weight w takes part with
the points whose level lies below w, so equal shingles share exactly the
points of their common weight, and a register (the first arriving point)
agrees with the probability of the weighted Jaccard similarity.  Points are
drawn only up to a horizon at which every register of the text is filled
(doubled for the few texts where it was too short), all texts of a batch
together in numpy.

Signatures are banded; texts that share a band are candidates.  Exact copies
(equal multisets) are folded first.  Candidates are verified by the exact
multiset overlap in three passes: every text against the smallest text of the
band it meets most often, then the remaining pairs with band pivots, then every
pair of a band whose ends are still in different classes (crowded bands: block
against block, only links leave a block).  A pair is skipped only if its ends
are already connected, so no link between classes is lost and groups are never
expanded into all pairs.

Cases: texts without words (null, empty, blanks) are copies of one another;
repeated rows and null ids are ordinary members; other columns are ignored by
:func:`classes` and kept by :func:`keep_one`; an empty table gives no rows.
Ties are broken by the smallest id (nulls last), then by the text's hash.  Very
long texts are signed whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stride.llm.common import cut, map_texts
from stride.llm.components import components


@dataclass(frozen=True)
class Banding:
    shingle: int = 5
    threshold: float = 0.8
    bands: int = 26
    rows: int = 6  # recall at similarity 0.8: 1 - (1 - 0.8**6) ** 26 = 0.9996
    block: int = 128  # bands with more texts are compared block against block

    @property
    def registers(self) -> int:
        return self.bands * self.rows


GOLDEN = 0x9E3779B97F4A7C15


def mix(x):
    """splitmix64 finaliser on uint64 arrays."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list):
    """(hash per word, index of its text): bytes of all texts at once, split at ASCII blanks."""
    import numpy as np

    raw = [(t or "").lower().encode("utf-8", "replace") + b" " for t in texts]
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    at = np.flatnonzero(~blank)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    length = np.diff(np.r_[first, len(at)])
    power = np.cumprod(np.full(int(length.max()), 0x100000001B3, dtype=np.uint64))
    place = np.arange(len(at)) - np.repeat(first, length)
    value = np.add.reduceat((buf[at].astype(np.uint64) + np.uint64(1)) * power[place], first)
    ends = np.cumsum([len(r) for r in raw])
    return mix(value + length.astype(np.uint64) * np.uint64(GOLDEN)), np.searchsorted(ends, at[first], side="right")


def multisets(texts: list, size: int):
    """(shingle hash, weight, index of its text), ordered by text and hash, each shingle of a text once."""
    import numpy as np

    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    n = np.minimum(counts, size)
    whole = np.repeat(counts < size, counts)
    begins = np.cumsum(counts) - counts
    place = np.arange(len(words)) - np.repeat(begins, counts)
    left = np.repeat(counts, counts) - place
    starts = np.flatnonzero(np.where(whole, place == 0, left >= size))
    key = np.full(len(starts), 0x51, dtype=np.uint64)
    who = owner[starts]
    padded = np.r_[words, np.zeros(size, np.uint64)]
    for k in range(size):
        w = np.where(k < n[who], padded[starts + k], np.uint64(k + 1))
        key = mix((key ^ w) + np.uint64(GOLDEN))
    order = np.lexsort((key, who))
    key, who = key[order], who[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (who[1:] != who[:-1])] if len(key) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    return key[heads], np.diff(np.r_[heads, len(key)]), who[heads]


def signatures(key, weight, who, n_texts: int, m: int):
    """(n_texts, m) uint32; texts without shingles keep zeros."""
    import numpy as np

    result = np.zeros((n_texts, m), dtype=np.uint32)
    total = np.bincount(who, weights=weight, minlength=n_texts)
    todo = np.flatnonzero(total > 0)
    horizon = np.log(m) + 3.0
    while len(todo):
        wanted = np.zeros(n_texts, bool)
        wanted[todo] = True
        pick = wanted[who]
        best, ids = _first_points(key[pick], weight[pick], who[pick], total, n_texts, m, horizon)
        filled = np.isfinite(best).all(axis=1)
        done = todo[filled[todo]]
        result[done] = ids[done]
        todo = todo[~filled[todo]]
        horizon *= 2.0
    return result


def _first_points(key, weight, who, total, n_texts, m, horizon):
    """Arrival and id of each register's first point up to ``horizon / total`` of the text."""
    import numpy as np

    blocks = [(key, weight, who, 0, 1)]
    low, width = 1, 1
    while True:  # block (low, low + width] of the shingles heavier than low
        heavy = weight > low
        if not heavy.any():
            break
        blocks.append((key[heavy], weight[heavy], who[heavy], low, width))
        low, width = low * 2, width * 2
    best = np.full(n_texts * m, np.inf)
    ids = np.zeros(n_texts * m, dtype=np.uint32)
    found_at, found_x, found_id = [], [], []
    for k, w, d, low, width in blocks:
        seed = mix(k + np.uint64((low * GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        x = np.zeros(len(k))
        limit = horizon / total[d]
        step = 0
        while len(seed):
            step += 1
            r = mix(seed + np.uint64((step * GOLDEN) & 0xFFFFFFFFFFFFFFFF))
            x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / (width * m)
            live = x <= limit
            seed, x, d, w, limit, r = seed[live], x[live], d[live], w[live], limit[live], r[live]
            v = mix(r ^ np.uint64(0xD6E8FEB86659FD93))
            register = ((v >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            at = d * m + register.astype(np.int64)
            point = (mix(v + np.uint64(GOLDEN)) >> np.uint64(32)).astype(np.uint32)
            if width > 1 or low:  # the halvings' path is the binary form of the level inside the block
                level = low + (((v & np.uint64(0xFFFFFFFF)) * np.uint64(width)) >> np.uint64(32)).astype(np.int64)
                inside = level < w
                found_at.append(at[inside])
                found_x.append(x[inside])
                found_id.append(point[inside])
            else:
                found_at.append(at)
                found_x.append(x)
                found_id.append(point)
    at, x, point = np.concatenate(found_at), np.concatenate(found_x), np.concatenate(found_id)
    np.minimum.at(best, at, x)
    first = x == best[at]
    ids[at[first]] = point[first]
    return best.reshape(n_texts, m), ids.reshape(n_texts, m)


def _fingerprints(key, weight, who, n_texts: int):
    """128-bit digest of each multiset."""
    import hashlib

    import numpy as np

    ends = np.searchsorted(who, np.arange(n_texts), side="right")
    begins = np.searchsorted(who, np.arange(n_texts), side="left")
    return [hashlib.blake2b(key[a:b].tobytes() + weight[a:b].astype("<i8").tobytes(), digest_size=16).digest()
            for a, b in zip(begins, ends)]


def sketch(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """(doc_id, _hash, id, bands): id is the multiset's digest, bands one 64-bit key per band (null without shingles)."""
    import numpy as np

    b = banding

    def apply(ids, hashes, texts):
        key, weight, who = multisets(texts, b.shingle)
        sig = signatures(key, weight, who, len(texts), b.registers)
        some = np.bincount(who, minlength=len(texts)) > 0
        band = np.full((len(texts), b.bands), 1, dtype=np.uint64)
        for r in range(b.rows):
            band = mix((band ^ sig[:, r::b.rows][:, :b.bands].astype(np.uint64)) + np.uint64(GOLDEN))
        band = mix(band + np.arange(b.bands, dtype=np.uint64)).astype(np.int64)
        return {"doc_id": ids, "_hash": hashes, "id": _fingerprints(key, weight, who, len(texts)),
                "bands": [row.tolist() if s else None for row, s in zip(band, some)]}

    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, apply, "doc_id bigint, _hash bigint, id binary, bands array<bigint>", "doc_id", "_hash", "text")


def overlap(a, wa, b, wb) -> float:
    """Weighted Jaccard similarity of two multisets given as sorted keys and weights."""
    import numpy as np

    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = np.minimum(wa[i], wb[j]).sum()
    whole = wa.sum() + wb.sum() - both
    return float(both / whole) if whole else 1.0


def verified(pairs: DataFrame, texts: DataFrame, banding: Banding) -> DataFrame:
    """pairs (a, b) with their exact similarity; texts is (id, text), one row per id."""
    size = banding.shingle
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "tb", "ta")

    def check(a, b, tb, ta):
        # a pivot's text comes with many pairs: each distinct text of the piece is read once
        place: dict = {}
        rows = [(place.setdefault(x, len(place)), place.setdefault(y, len(place))) for x, y in zip(ta, tb)]
        key, weight, who = multisets(list(place), size)
        ends = who.searchsorted(range(len(place) + 1))
        part = [(key[s:e], weight[s:e]) for s, e in zip(ends[:-1], ends[1:])]
        return {"a": a, "b": b, "similarity": [overlap(*part[i], *part[j]) for i, j in rows]}

    return map_texts(both, check, "a binary, b binary, similarity double", "a", "b", "tb", "ta")


def _smallest(doc_id: str, tie: str):
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), F.col(tie).alias("_hash"))


def _with_class(rows: DataFrame, classes: DataFrame | None) -> DataFrame:
    if classes is None:
        return rows.withColumn("cls", F.col("id"))
    return rows.join(classes, rows["id"] == classes["node"], "left").select(
        *rows.columns, F.coalesce("root", "id").alias("cls"))


def links(docs: DataFrame, rows: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """Verified links (a, b) that connect every class; rows is the written :func:`sketch`."""
    distinct = rows.where(F.col("bands").isNotNull()).groupBy("id").agg(F.first("bands").alias("bands"), F.min(_smallest("doc_id", "_hash")).alias("one"))
    met = distinct.select("id", F.explode("bands").alias("band"))
    crowded = met.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot")).where(F.col("n") > 1)
    met = cut(met.join(crowded.select(F.col("band").alias("_b"), "pivot"), F.col("band") == F.col("_b")).select("band", "pivot", "id"), "bands")
    needed = met.select(F.col("id").alias("_i")).distinct().join(distinct, F.col("_i") == F.col("id")).select(
        "id", F.col("one.doc_id").alias("_d"), F.col("one._hash").alias("_h"))
    source = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_hash"), F.col("text").cast("string").alias("text"))
    texts = cut(
        source.join(needed, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")))
        .select("id", "text"), "candidate-texts").dropDuplicates(["id"])

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        return cut(verified(pairs, texts, banding), name)

    # pass 1: the pivot met in most bands
    hits = met.where(F.col("id") != F.col("pivot")).groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("n"))
    best = hits.groupBy("id").agg(F.max(F.struct("n", "pivot")).alias("p")).select(
        F.col("id").alias("b"), F.col("p.pivot").alias("a"))
    tested = confirm(best.select("a", "b"), "links")
    good = lambda t: t.where(F.col("similarity") >= banding.threshold).select("a", "b")

    # pass 2: the other pivots, where the classes still differ
    classes = cut(components(good(tested), "a", "b"), "classes")
    crossing = _with_class(met, classes)
    pivots = crossing.where(F.col("id") == F.col("pivot")).select(F.col("band").alias("_b"), F.col("cls").alias("pivot_cls"))
    pairs = (
        crossing.join(pivots, F.col("band") == F.col("_b")).where(F.col("cls") != F.col("pivot_cls"))
        .select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
    )
    more = confirm(pairs, "links")
    tested = tested.unionByName(more)
    classes = cut(components(good(tested), "a", "b"), "classes")

    # pass 3: whatever pair of a band still crosses classes
    crossing = cut(_with_class(met, classes).select("band", "id", "cls"), "crossing")
    sizes = crossing.groupBy("band", "cls").agg(F.count(F.lit(1)).alias("n")).groupBy("band").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "cls")).alias("most"), F.count(F.lit(1)).alias("n_classes"))
    mixed = sizes.where(F.col("n_classes") > 1).select(
        F.col("band").alias("_b"), "n", F.col("most.cls").alias("main"), (F.col("n") - F.col("most.n")).alias("n_minor"))
    crossing = cut(crossing.join(mixed, F.col("band") == F.col("_b")).drop("_b"), "crossing")
    few, many = crossing.where(F.col("n") <= banding.block), crossing.where(F.col("n") > banding.block)
    other = few.select(F.col("band").alias("_b"), F.col("id").alias("b"), F.col("cls").alias("_c"))
    pairs = (
        few.withColumnRenamed("id", "a").join(other, (F.col("band") == F.col("_b")) & (F.col("a") < F.col("b")) & (F.col("cls") != F.col("_c")))
        .select("a", "b").distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
    )
    rest = confirm(pairs, "links")
    return good(tested.unionByName(rest)).unionByName(cut(_block_links(many, texts, banding), "links"))


def _block_links(rows: DataFrame, texts: DataFrame, banding: Banding) -> DataFrame:
    """Links across classes inside crowded bands, without a row per pair.

    rows is (band, id, cls, main, n, n_minor).  Texts outside a band's largest
    class meet all texts of the band block against block; a block pair is one
    bounded group, compared by matrix products, and only links leave it.
    """
    block = banding.block

    def dealt(df, own, others):
        mine = F.ceil(F.col(own) / block)
        return df.select("band", F.pmod(F.xxhash64("id", F.lit(own)), mine).alias("mine"),
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(others) / block) - 1)).alias("theirs"), "id", "cls")

    left = dealt(rows.where(F.col("cls") != F.col("main")), "n_minor", "n").select(
        "band", F.col("mine").alias("i"), F.col("theirs").alias("j"), "id", "cls", F.lit(True).alias("minor"))
    right = dealt(rows, "n", "n_minor").select(
        "band", F.col("theirs").alias("i"), F.col("mine").alias("j"), "id", "cls", F.lit(False).alias("minor"))
    both = left.unionByName(right).join(texts.withColumnRenamed("id", "_t"), F.col("id") == F.col("_t")).drop("_t")

    def units(part):
        import pandas as pd

        ids, kinds, minor = part["id"].tolist(), part["cls"].tolist(), part["minor"].to_numpy(dtype=bool)
        left, right = minor.nonzero()[0], (~minor).nonzero()[0]
        near = block_similarities(part["text"].tolist(), left, right, banding.shingle) >= banding.threshold
        found: dict = {}
        for x, y in zip(*near.nonzero()):
            x, y = left[x], right[y]
            if kinds[x] != kinds[y]:  # one link of a text to a class is enough
                found.setdefault((ids[x], kinds[y]), (ids[x], ids[y]))
        return pd.DataFrame(list(found.values()), columns=["a", "b"])

    return both.groupBy("band", "i", "j").applyInPandas(units, "a binary, b binary")


def block_similarities(texts: list, left, right, size: int, columns: int = 8192):
    """(left, right) weighted Jaccard similarities; a shingle of weight w is w unit columns."""
    import numpy as np

    key, weight, who = multisets(texts, size)
    total = np.bincount(who, weights=weight, minlength=len(texts))
    level = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
    unit = mix(np.repeat(key, weight) + level.astype(np.uint64) * np.uint64(GOLDEN))
    owner = np.repeat(who, weight)
    side = np.full(len(texts), -1)
    side[right] = np.arange(len(right))
    rows = np.full(len(texts), -1)
    rows[left] = np.arange(len(left))
    is_left = rows[owner] >= 0
    shared = np.intersect1d(unit[is_left], unit[~is_left])
    at = np.searchsorted(shared, unit)
    known = at < len(shared)
    known[known] = shared[at[known]] == unit[known]
    owner, at, is_left = owner[known], at[known], is_left[known]
    both = np.zeros((len(left), len(right)))
    for c in range(0, len(shared), columns):
        part = (at >= c) & (at < c + columns)
        a = np.zeros((len(left), columns), np.float32)
        b = np.zeros((len(right), columns), np.float32)
        a[rows[owner[part & is_left]], at[part & is_left] - c] = 1
        b[side[owner[part & ~is_left]], at[part & ~is_left] - c] = 1
        both += a @ b.T
    whole = total[left][:, None] + total[right][None, :] - both
    return np.where(whole > 0, both / np.maximum(whole, 1), 1.0)


def classes(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """(doc_id, class_id, class_rows, kept, _hash): class_id is the smallest doc_id of the class, kept marks its first row."""
    rows = cut(sketch(docs, banding), "sketch")
    roots = components(links(docs, rows, banding), "a", "b")
    members = _with_class(rows.select("doc_id", "_hash", "id"), cut(roots, "classes"))
    per_class = members.groupBy("cls").agg(F.min(_smallest("doc_id", "_hash")).alias("one"), F.count(F.lit(1)).alias("class_rows"))
    joined = members.join(per_class.withColumnRenamed("cls", "_cls"), F.col("cls") == F.col("_cls"))
    return joined.select(
        "doc_id", F.col("one.doc_id").alias("class_id"), "class_rows",
        (F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("_hash") == F.col("one._hash"))).alias("kept"), "_hash")


def keep_one(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """The rows of docs (all columns) that stand for their class: exactly one row each."""
    first = classes(docs, banding).where("kept").groupBy(F.col("doc_id").alias("_bm_doc"), F.col("_hash").alias("_bm_hash")).agg(
        F.count(F.lit(1)).alias("_bm_times"))
    first = cut(first, "kept")
    found = docs.join(first, F.col("doc_id").eqNullSafe(F.col("_bm_doc")) & (F.xxhash64("text") == F.col("_bm_hash")))
    kept = found.where(F.col("_bm_times") == 1).select(*[docs[c] for c in docs.columns])
    if first.where(F.col("_bm_times") > 1).isEmpty():
        return kept
    # rows repeated with id and text: one of them
    again = found.where(F.col("_bm_times") > 1).dropDuplicates(["_bm_doc", "_bm_hash"]).select(*[docs[c] for c in docs.columns])
    return kept.unionByName(again)
