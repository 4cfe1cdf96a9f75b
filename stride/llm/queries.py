"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm import bagminhash, conversation_trie, decontamination, language_id, oracles, packing, periodic_runs, private_data, quality_rules, secret_scan, simhash, span_dedup, toxicity, url_filters
from stride.llm.common import cut, held_out, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.clean_lines(table(spark, sf_dir, "documents"), with_text=False)
    return rows.drop("clean_text")


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated list entries made of the tables: event n adds or removes a key of page n modulo the number of pages."""
    events, pages = table(spark, sf_dir, "events"), table(spark, sf_dir, "pages")
    host, path = url_filters.host_of(F.col("url")), url_filters.path_of(F.col("url"))
    # the events' wall clock read as UTC, whatever the session's zone
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    n_pages = pages.agg(F.count(F.lit(1)).alias("n_pages"))
    numbered = events.crossJoin(F.broadcast(n_pages)).withColumn("_page", F.expr("pmod(event_id, n_pages)"))  # one row of one number
    rows = numbered.join(pages, F.col("_page") == F.col("page_id")).select(
        "event_id", F.timestamp_micros(micros).alias("ts"), "event_type", host.alias("h"), path.alias("p"))
    key = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("host:"), "h"))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("domain:"), F.regexp_replace("h", r"^[^.]*\.([^.]*\..*)$", "$1")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit("prefix:"), "h", F.regexp_extract("p", "^(/[^/]*)", 1)))
        .otherwise(F.concat(F.lit("url:"), "h", "p")))
    action = F.when(F.col("event_type").isin("purchase", "signup"), "remove").otherwise("add")
    return rows.where(F.length("h") > 0).select(F.col("event_id").alias("entry_id"), key.alias("key"), action.alias("action"), "ts")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.pmod(F.col("page_id") * 7919, F.lit(30 * 86400))
    captures = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.timestamp_seconds(F.lit(1704067200) + second).alias("fetch_ts"))
    found = url_filters.filter_captures(captures, list_entries(spark, sf_dir))
    return found.withColumn("fetch_ts", F.unix_seconds("fetch_ts"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~held_out("doc_id", 4, 2)))
    return language_id.predict(docs, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(table(spark, sf_dir, "documents")).drop("_hash")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out("doc_id", 5, 0)))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op7_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.digest(private_data.find(table(spark, sf_dir, "documents")))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, benchmark).drop("item_ids")


def op10_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.dedup(table(spark, sf_dir, "documents"), span_dedup.WHOLE)


#: Conversation c begins with up to BRANCH_TURNS - 1 turns of the conversation c - c % BRANCH_CONVERSATIONS.
BRANCH_CONVERSATIONS = 100
BRANCH_TURNS = 6


def rebuilt(turns: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns and conversation lengths after every conversation's first h turns are those of its hundred's first one."""
    c = F.col("conv_id")
    base = own.select(c.alias("_base"), F.col("n_turns").alias("_n"))
    heads = own.select("conv_id", "n_turns", (c - c % BRANCH_CONVERSATIONS).alias("base"),
                       (F.crc32(c.cast("string").cast("binary")) % BRANCH_TURNS).alias("h"))
    plan = heads.join(base, F.col("base") == F.col("_base"), "left").select(
        c.alias("_c"), "base", "h", F.least("h", F.coalesce("_n", F.lit(0))).cast("bigint").alias("taken"),
        F.greatest(F.col("n_turns") - F.col("h"), F.lit(0)).cast("bigint").alias("rest"))
    later = turns.join(plan, c == F.col("_c")).where("place > h").select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("place"), "content", "size")
    first = turns.where((c % BRANCH_CONVERSATIONS == 0) & (F.col("place") < BRANCH_TURNS))
    shared = first.join(plan, c == F.col("base")).where("place <= taken").select(F.col("_c").alias("conv_id"), "place", "content", "size")
    return later.unionByName(shared), plan.select(F.col("_c").alias("conv_id"), (F.col("taken") + F.col("rest")).alias("n_turns"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut(conversation_trie.numbered(table(spark, sf_dir, "conversations")), "trie-own-turns")
    turns, members = rebuilt(turns, conversation_trie.lengths(turns))
    return conversation_trie.digest(conversation_trie.build(cut(turns, "trie-turns"), cut(members, "trie-members")))


def op12_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def reread(doc_id: int | None, n: int):
    """The order in which op13_periodic_runs reads a document's n words: every tenth document repeats a part of itself to its end."""
    import zlib

    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or n == 0 or h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*range(a), *(a + (i - a) % p for i in range(a, n))]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find(table(spark, sf_dir, "documents"), order=reread))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_url_filters": op2_url_filters,
    "op3_language_id": op3_language_id,
    "op4_minhash_neardup": op4_minhash_neardup,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_private_data": op7_private_data,
    "op8_secret_scan": op8_secret_scan,
    "op9_decontamination": op9_decontamination,
    "op10_span_dedup": op10_span_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_simhash_neardup": op12_simhash_neardup,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.quality_rules(),
    "op2_url_filters": oracles.url_filters(),
    "op8_secret_scan": oracles.secret_scan(),
    "op9_decontamination": oracles.decontamination(),
    "op11_conversation_trie": oracles.conversation_trie(),
    "op13_periodic_runs": oracles.periodic_runs(),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return {**ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
