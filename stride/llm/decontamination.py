"""Benchmark decontamination: prefix-filtered set join, DataFrame operations only.

An item's windows (``window`` consecutive words; a shorter item is one window)
are sets of two-word shingles (one-word windows: the word).  Shingles are
ordered by rarity, counted over all documents.  Exact containment needs every
shingle of the window, so the necessary prefix is its single rarest shingle:
only that one is joined with the documents' shingles, a window with a shingle
that no document has is dropped.  A joined position fixes where the window
would lie (positional bound), it must fit into the document (length bound),
and the words there are compared one by one.

The windows travel by broadcast while they are at most ``broadcast_windows``
(counted first); beyond that, postings and windows are shuffled by shingle and
the candidates verified in a join with the documents.

Cases: null text has no words; a null or empty item has no windows; windows of
an item without id count as hits but name no item; repeated rows, null ids and
ids shared by different texts each give one result row per input row; of
equally rare shingles the first in the window is joined (ties); very long texts
are read whole; other columns are ignored.  An empty benchmark leaves every
document clean, an empty table of documents gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stride.llm.common import no_doc_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything but 0-9, a-z, A-Z and characters beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_SHINGLE = 0


def _split(text: Column) -> Column:
    """Words in their original case; only the first and the last entry can be empty."""
    return F.split(no_doc_text(text), SEPARATORS)


def _pair(a: Column, b: Column) -> Column:
    """Shingle id; lower() folds at least what A-Z folding does, so equal windows have equal shingles."""
    return F.xxhash64(F.lower(a), F.lower(b))


def _single(a: Column) -> Column:
    return F.xxhash64(F.lower(a))


def item_windows(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row per distinct window: words (list), length, item_ids (list)."""
    words = F.filter(F.split(F.translate(no_doc_text(F.col("text")), UPPER, LOWER), SEPARATORS), lambda x: x != "")
    items = benchmark.select(F.col("item_id").alias("_item"), words.alias("_words")).where(F.size("_words") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("_words") - window, F.lit(0))))
    return (
        items.select("_item", "_words", starts.alias("_start"))
        .select("_item", F.slice("_words", F.col("_start") + 1, window).alias("words"))
        .groupBy("words").agg(F.collect_set("_item").alias("item_ids"))
        .withColumn("length", F.size("words"))
    )


def _window_shingles(windows: DataFrame) -> DataFrame:
    """(words, item_ids, length, offset, shingle)"""
    offset = F.explode(F.sequence(F.lit(0), F.greatest(F.col("length") - 2, F.lit(0))))
    rows = windows.select("words", "item_ids", "length", offset.alias("offset"))
    first, second = F.get("words", F.col("offset")), F.get("words", F.col("offset") + 1)
    return rows.withColumn("shingle", F.when(F.col("length") > 1, _pair(first, second)).otherwise(_single(first)))


def _postings(words: DataFrame, singles: bool) -> DataFrame:
    """One row per document position and shingle, plus one row with the shingle NO_SHINGLE per document."""
    ends = words.withColumn("_all", F.array_append("_w", F.lit(None).cast("string")))
    rows = ends.select("_id", "_hash", "_n_words", "_w", F.posexplode_outer("_all").alias("_pos", "_word"))
    pair = F.when(F.col("_word").isNull(), F.lit(NO_SHINGLE)).otherwise(
        _pair(F.col("_word"), F.get("_w", F.col("_pos") + 1)))
    pairs = rows.withColumn("shingle", pair)
    if not singles:
        return pairs
    alone = words.select("_id", "_hash", "_n_words", "_w", F.posexplode_outer("_w").alias("_pos", "_word"))
    return pairs.unionByName(alone.withColumn("shingle", _single(F.col("_word"))))


def _document_words(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), _split(F.col("text")).alias("_w"))
    ends = (F.element_at("_w", 1) == "").cast("bigint") + ((F.size("_w") > 1) & (F.element_at("_w", -1) == "")).cast("bigint")
    return rows.withColumn("_n_words", F.size("_w").cast("bigint") - ends)


def _same_words(words: Column) -> Column:
    """Word by word (no word has a blank); without lambdas, so the probe stays one generated loop over a document."""
    there = F.concat_ws(" ", F.slice(words, F.col("_start") + 1, F.col("length")))
    return F.translate(there, UPPER, LOWER) == F.col("wording")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 10, broadcast_windows: int = 50_000) -> DataFrame:
    """(_id, _hash, _n_words, _start, length, item_ids): every occurrence, and a row without start per document."""
    windows = item_windows(benchmark, window)
    # one aggregate row
    n, singles = windows.agg(F.count(F.lit(1)), F.coalesce(F.min("length") == 1, F.lit(False))).first()
    small = n <= broadcast_windows
    hint = F.broadcast if small else (lambda x: x)
    words = _document_words(docs)
    postings = _postings(words, singles)
    shingles = _window_shingles(windows)
    common = postings.select("shingle").join(hint(shingles.select("shingle").distinct()), "shingle")
    rarity = common.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    order = F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "shingle")
    prefix = (
        shingles.join(rarity, "shingle", "left")
        .groupBy("words").agg(F.min(order).alias("p"), F.first("item_ids").alias("item_ids"), F.first("length").alias("length"))
        .where(F.col("p.seen") > 0)
        .select(F.col("p.shingle").alias("shingle"), F.col("p.offset").alias("offset"),
                F.concat_ws(" ", "words").alias("wording"), "item_ids", "length")
    )
    spark = docs.sparkSession
    mark = spark.range(1).select(
        F.lit(NO_SHINGLE).cast("bigint").alias("shingle"), F.lit(None).cast("int").alias("offset"),
        F.lit(None).cast("string").alias("wording"),
        F.lit(None).cast(prefix.schema["item_ids"].dataType).alias("item_ids"), F.lit(None).cast("int").alias("length"))
    fits = (F.col("_start") >= 0) & (F.col("_start") + F.col("length") <= F.size("_w"))
    kept = ["_id", "_hash", "_n_words", "_start", "length", "item_ids"]
    if small:
        # the documents stay where they are: explode, probe, verify in one stage
        found = postings.join(F.broadcast(prefix.unionByName(mark)), "shingle").withColumn(
            "_start", F.col("_pos") - F.col("offset"))
        return found.where(F.col("wording").isNull() | (fits & _same_words(F.col("_w")))).select(*kept)
    candidates = (
        postings.where(F.col("shingle") != NO_SHINGLE).select("_id", "_hash", "_pos", "shingle").join(prefix, "shingle")
        .select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"), (F.col("_pos") - F.col("offset")).alias("_start"),
                "wording", "item_ids", "length").distinct()
    )
    verified = candidates.join(words.dropDuplicates(["_id", "_hash"]), F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")))
    per_doc = words.select("_id", "_hash", "_n_words", F.lit(None).cast("int").alias("_start"),
                           F.lit(None).cast("int").alias("length"),
                           F.lit(None).cast(prefix.schema["item_ids"].dataType).alias("item_ids"))
    return verified.where(fits & _same_words(F.col("_w"))).select(*kept).unionByName(per_doc)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, broadcast_windows: int = 50_000) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids (sorted as strings)."""
    rows = occurrences(docs, benchmark, window, broadcast_windows)
    # a hit word, a named item or the document itself; the first aggregate removes doubles before and after the shuffle
    fact = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
    positions = F.transform(F.sequence(F.col("_start"), F.col("_start") + F.col("length") - 1), lambda p: fact("hit", p))
    items = F.transform("item_ids", lambda i: fact("item", i))
    facts = F.when(F.col("_start").isNull(), F.array(fact("doc", F.lit("")))).otherwise(F.concat(positions, items))
    key = ["_id", "_hash", "_n_words"]
    once = (
        rows.select(*key, F.explode(facts).alias("f")).select(*key, "f.kind", "f.value")
        .groupBy(*key, "kind", "value").agg(F.count(F.lit(1)).alias("times"))
    )
    per_doc = once.groupBy(*key).agg(
        F.sum(F.when(F.col("kind") == "doc", F.col("times"))).alias("_rows"),
        F.count(F.when(F.col("kind") == "hit", 1)).alias("n_hit"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "item", F.col("value")))).alias("item_ids"),
    )
    repeated = F.when(F.col("_rows") > 1, F.sequence(F.lit(1).cast("bigint"), F.col("_rows"))).otherwise(
        F.array(F.lit(1).cast("bigint")))
    return per_doc.withColumn("_copy", F.explode(repeated)).select(
        F.col("_id").alias("doc_id"), F.col("_n_words").alias("n_words"), "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "item_ids")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, broadcast_windows: int = 50_000) -> DataFrame:
    """The rows of docs (all columns) without any benchmark window."""
    found = occurrences(docs, benchmark, window, broadcast_windows).where(F.col("_start").isNotNull())
    bad = found.select(F.col("_id").alias("_dc_id"), F.col("_hash").alias("_dc_hash")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_dc_id")) & (F.xxhash64("text") == F.col("_dc_hash")), "left_anti")
