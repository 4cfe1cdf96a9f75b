"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has a bit set where more than half of its word shingles'
64-bit hashes have it set.  Texts whose fingerprints differ in at most two bits
are linked; a component is what links reach.

Equal fingerprints are one node, so copies never meet as pairs.  A fingerprint
is cut into two segments of 32 bits: of two bits that differ, one segment holds
at most one.  A segment is indexed under itself and under its 32 one-wildcard
variants (one bit left out).  Two fingerprints agree in a segment where they
share the plain key, and differ there in just one bit where they share that
bit's variant but not the bit; candidates therefore come from equality joins on
the key, each at most once per segment, and are verified by the bits of both
segments.

A segment value of more than ``crowd`` fingerprints is not indexed.  All
fingerprints with such a value, or with one that differs from it in one bit, are
looked up exactly instead, by the deletion variants of the whole: the 64
fingerprints one bit away, and themselves.  All that share such a variant are
within two bits of each other and all within two bits share one, so each is
linked to the smallest of every variant it meets.  That costs 65 rows a
fingerprint whatever the crowd's size, loses no link and forms no pairs.

Values are counted by a pre-aggregated sum (two rows a fingerprint), so a key of
the index has at most ``crowd`` rows on either side of its join.

Cases: null and wordless texts have fingerprint zero and are linked like any
other; texts of fewer words than a shingle are one shingle; repeated rows give
equal rows; a null id gets its component's smallest id (null if there is none);
ties cannot occur, a bit set in just half of the hashes is not set; very long
texts are hashed whole in bounded slices; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stride.llm.common import cut, map_texts
from stride.llm.components import components

HALF = 32
#: Hashes counted at a time.
SLICE = 1 << 18


@dataclass(frozen=True)
class SimHashRules:
    shingle: int = 3
    seed: int = 42
    crowd: int = 64  # fingerprints of one segment value that are still compared in pairs


def hashes_of(text: bytes | None, rules: SimHashRules) -> list[int]:
    """XXH64 of every shingle, repeats included: words lower-cased (A-Z), joined by one blank."""
    from itertools import accumulate

    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    n = max(len(words) - rules.shingle + 1, min(len(words), 1))
    if not n:
        return []
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    begins = [0, *(e + 1 for e in ends[:n - 1])]
    last = ends[-n:]
    seed = rules.seed
    return [xxh64_intdigest(line[a:b], seed) for a, b in zip(begins, last)]


def majority(values, owner_sizes):
    """Fingerprint of each text: bits set in over half of its hashes; zero for a text of none."""
    import numpy as np

    sizes = np.asarray(owner_sizes, dtype=np.int64)
    counts = np.zeros((len(sizes), 64), dtype=np.int64)
    ends = np.cumsum(sizes)
    for a in range(0, len(values), SLICE):
        part = values[a:a + SLICE]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, a + len(part) - 1, side="right")
        begins = np.maximum(ends[first:last + 1] - sizes[first:last + 1] - a, 0)
        real = sizes[first:last + 1] > 0
        counts[first:last + 1][real] += np.add.reduceat(bits, begins[real], axis=0, dtype=np.int64)
    return np.packbits(2 * counts > sizes[:, None], axis=1).view(">u8").astype(np.uint64).reshape(-1)


def fingerprints(docs: DataFrame, rules: SimHashRules = SimHashRules()) -> DataFrame:
    """(doc_id, bits): one row per document, the 64 bits as a signed long."""
    import numpy as np

    def apply(ids, texts):
        hashes = [hashes_of(t, rules) for t in texts]
        flat = np.array([h for one in hashes for h in one], dtype=np.uint64)
        return {"doc_id": ids, "bits": majority(flat, [len(one) for one in hashes]).view(np.int64)}

    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    return map_texts(rows, apply, "doc_id bigint, bits bigint", "doc_id", "text")


def _difference(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def segments(nodes: DataFrame) -> DataFrame:
    """(bits, segment, value): the two halves of each fingerprint."""
    low = F.lit((1 << HALF) - 1).cast("bigint")
    halves = F.explode(F.array(*[
        F.struct(F.lit(k).alias("segment"), F.shiftrightunsigned("bits", k * HALF).bitwiseAND(low).alias("value")) for k in (0, 1)]))
    return nodes.select("bits", halves.alias("h")).select("bits", "h.segment", "h.value")


def variants(rows: DataFrame) -> DataFrame:
    """(bits, left_out, key, side) of segments: each whole (left_out -1), and with each of its bits left out; side is that bit."""
    cuts = F.explode(F.sequence(F.lit(-1), F.lit(HALF - 1)))
    rows = rows.select("bits", "segment", "value", cuts.alias("left_out"))
    hole = F.when(F.col("left_out") < 0, F.lit(0).cast("bigint")).otherwise(F.expr("shiftleft(1L, left_out)"))
    inside = F.col("value").bitwiseAND(hole)
    return rows.select(
        "bits", "left_out",
        # value without the bit; segment and wildcard above it
        (F.col("value") - inside + F.expr("shiftleft(CAST(segment * 64 + left_out + 1 AS BIGINT), 32)")).alias("key"),
        F.when(F.col("left_out") >= 0, inside != 0).alias("side"))


def _marked(rows: DataFrame, crowd: int) -> DataFrame:
    """Segments with ``crowded``: true where the value is, false where it is one bit from such a value, else null."""
    counts = rows.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd)
    flips = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(
        F.sequence(F.lit(0), F.lit(HALF - 1)), lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k)))
    near = counts.select("segment", "value", F.explode(flips).alias("_flip")).groupBy(
        F.col("segment").alias("_segment"), F.col("value").bitwiseXOR(F.col("_flip")).alias("_value")).agg(
        F.max(F.col("_flip") == 0).alias("crowded"))
    return rows.join(near, (F.col("segment") == F.col("_segment")) & (F.col("value") == F.col("_value")), "left").select(
        "bits", "segment", "value", "crowded")


def _crowded_links(bits: DataFrame) -> DataFrame:
    """Links of distinct fingerprints through the deletion variants of the whole: each to the smallest that shares one."""
    flips = F.explode(F.concat(F.array(F.lit(0).cast("bigint")), F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k))))
    rows = bits.select("bits", flips.alias("_flip")).select("bits", F.col("bits").bitwiseXOR(F.col("_flip")).alias("near"))
    least = rows.groupBy("near").agg(F.min("bits").alias("a"), F.max("bits").alias("_most")).where("a < _most").select(
        F.col("near").alias("_near"), "a")
    return rows.join(least, F.col("near") == F.col("_near")).where(F.col("bits") != F.col("a")).select("a", F.col("bits").alias("b")).distinct()


def links(nodes: DataFrame, rules: SimHashRules = SimHashRules()) -> DataFrame:
    """(a, b) links of distinct fingerprints (column bits) that reach whatever pairs within two bits reach, each within two bits."""
    marked = cut(_marked(segments(nodes), rules.crowd), "simhash-segments")
    index = variants(marked.where(F.col("crowded").isNull() | ~F.col("crowded")))
    # plain keys: either order, once; variants: the two sides of the bit
    left = index.where("left_out < 0 OR NOT side").select("key", F.col("bits").alias("a"), "left_out")
    right = index.where("left_out < 0 OR side").select(F.col("key").alias("_key"), F.col("bits").alias("b"))
    # merge: what is joined is 33 times what is scanned, so no side is small for being read from few bytes
    pairs = left.hint("merge").join(right, (F.col("key") == F.col("_key")) & ((F.col("left_out") >= 0) | (F.col("a") < F.col("b"))))
    close = pairs.where(_difference("a", "b") <= 2).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crowds = marked.where(F.col("crowded").isNotNull()).select("bits").distinct()
    return close.unionByName(_crowded_links(crowds)).distinct()


def classes(docs: DataFrame, rules: SimHashRules = SimHashRules()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that links reach) per document."""
    prints = cut(fingerprints(docs, rules), "simhash-fingerprints")
    nodes = cut(prints.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = cut(components(links(nodes.select("bits"), rules), "a", "b"), "simhash-roots")
    rooted = nodes.join(roots, F.col("bits") == F.col("node"), "left").select(
        F.col("bits").alias("_bits"), "least", F.coalesce("root", "bits").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_root")
    named = rooted.join(smallest, F.col("root") == F.col("_root")).select("_bits", "component_id")
    out = prints.join(named, F.col("bits") == F.col("_bits"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
