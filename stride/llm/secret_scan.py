"""Secret scans: base patterns, and multipart credentials linked by an interval join; DataFrame operations only.

Base secrets (assignments, access keys, long hex) are always reported.  Weak
parts -- an account or key identifier, a secret-looking value, an endpoint --
are reported only in company: identifiers and secrets whose spans lie within
``scope`` characters of each other in one document link, and an endpoint
within the scope of a linked secret completes them.  The interval join runs on
(document, scope bucket) with the neighbouring buckets of one side, as a semi
join: no pairs are emitted, and only documents holding both roles take part.

Cases: null text is empty; repeated rows and null ids give one row each with
the same spans; overlapping weak parts of one role cannot occur, a weak part
that overlaps a base span is not repeated, and spans that begin together stand
in the order of kinds (ties); very long texts are read whole, their parts meet
by bucket; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stride.llm.common import cut, no_doc_text
from stride.llm.spans import SPANS, joined, labelled, regex_spans

VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = rf"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?({VALUE}+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

#: Weak parts by role.
IDENTIFIER = (r"""(?i:access_key_id|access_?key|client_?id|account|user_?name|user|login)["']?\x20*[:=]\x20*["']?"""
              r"""([A-Za-z0-9@._+-]{3,})""")
WEAK_SECRET = (r"""(?i:pwd|pass|passphrase|private_?key|key|auth|credential)["']?\x20*[:=]\x20*["']?"""
               rf"""({VALUE}{{6,}})""")
ENDPOINT = r"(?i:https?|ftp|ssh|s3|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+"

KINDS = {"assign": 0, "access": 1, "hex": 2, "link_id": 3, "link_secret": 4, "link_endpoint": 5}


@dataclass(frozen=True)
class Linking:
    scope: int = 300  # characters between the spans of linked parts


def base_spans(text: Column) -> list[tuple[str, Column]]:
    """(kind, spans) of the base patterns; failing matches dropped, not retried."""
    long_value = lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6
    assign = F.filter(regex_spans(text, ASSIGN), long_value)
    access = F.filter(regex_spans(text, ACCESS), lambda s: F.length(s["match"]) >= 20)
    # a run of hex digits is matched whole, so asking for 24 at once drops the same runs
    hexes = regex_spans(text, r"[0-9a-f]{24,}")
    return [("assign", assign), ("access", access), ("hex", hexes)]


def _parts(docs: DataFrame) -> DataFrame:
    """doc_id, _hash, base and weak spans per row; the text is not carried on."""
    text = no_doc_text(F.col("text"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash"), text.alias("text"))
    found = {k: v for k, v in base_spans(F.col("text"))}
    weak = {"weak_id": IDENTIFIER, "weak_secret": WEAK_SECRET, "weak_endpoint": ENDPOINT}
    return rows.select(
        "doc_id", "_hash", *[labelled(v, k, KINDS[k]).alias(k) for k, v in found.items()],
        *[F.transform(regex_spans(F.col("text"), p), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k)
          for k, p in weak.items()])


def _near(rows: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """rows (key, start, end) with a span of others in the same document at most ``scope`` characters away."""
    # a span's bucket is that of its start; long spans reach further, so the other side covers whole spans
    reach = F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope)))
    right = others.select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"), F.col("start").alias("_s"),
                          F.col("end").alias("_e"), reach.alias("_b"))
    left = rows.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
    close = (F.col("_s") <= F.col("end") + scope) & (F.col("start") <= F.col("_e") + scope)
    return left.join(right, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h"))
                     & (F.col("_bucket") == F.col("_b")) & close, "left_semi").drop("_bucket").distinct()


def linked_parts(parts: DataFrame, linking: Linking = Linking()) -> DataFrame:
    """(_id, _hash, spans): linked weak parts per document."""
    both = ((F.size("weak_id") + F.size("access")) > 0) & ((F.size("weak_secret") + F.size("assign") + F.size("hex")) > 0)
    some = parts.where(both & (F.size("weak_id") + F.size("weak_secret") + F.size("weak_endpoint") > 0))

    def rows(*columns: str) -> DataFrame:
        spans = F.concat(*[F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for c in columns])
        return some.select(F.col("doc_id").alias("_id"), "_hash", F.explode(spans).alias("s")).select(
            "_id", "_hash", "s.start", "s.end").distinct()

    identifiers, secrets = rows("weak_id", "access"), rows("weak_secret", "assign", "hex")
    ids = _near(rows("weak_id"), secrets, linking.scope)
    weak = _near(rows("weak_secret"), identifiers, linking.scope)
    anchored = _near(secrets, identifiers, linking.scope)
    ends = _near(rows("weak_endpoint"), anchored, linking.scope)
    tag = lambda df, kind: df.select("_id", "_hash", F.struct(
        F.lit(KINDS[kind]).alias("order"), "start", "end", F.lit(kind).alias("kind")).alias("span"))
    found = tag(ids, "link_id").unionByName(tag(weak, "link_secret")).unionByName(tag(ends, "link_endpoint"))
    return found.groupBy("_id", "_hash").agg(F.collect_set("span").alias("_links"))


def scan(docs: DataFrame, linking: Linking = Linking()) -> DataFrame:
    """doc_id, _hash, n_assign, n_access, n_hex, base, all_spans (arrays of order, start, end, kind)."""
    parts = cut(_parts(docs), "secret-parts")
    links = linked_parts(parts, linking)
    rows = parts.select("doc_id", "_hash", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.concat("assign", "access", "hex").alias("base"))
    found = rows.join(links.withColumnRenamed("_hash", "_h"),
                      F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")
    apart = F.filter("_links", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.withColumn("all_spans", F.concat("base", F.coalesce(apart, F.array().cast(SPANS)))).drop("_id", "_h", "_links")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base"), True), 256).alias("base_sha256"),
                        joined(F.col("all_spans"), True).alias("spans"))


def redact(docs: DataFrame, linking: Linking = Linking(), mark: str = "[SECRET]") -> DataFrame:
    """docs (all columns) with every reported span replaced by ``mark``; rows without a span are unchanged."""
    found = scan(docs, linking).where(F.size("all_spans") > 0).groupBy(
        F.col("doc_id").alias("_ss_doc"), F.col("_hash").alias("_ss_hash")).agg(F.first("all_spans").alias("_ss_spans"))
    rows = docs.join(found, F.col("doc_id").eqNullSafe(F.col("_ss_doc")) & (F.xxhash64("text") == F.col("_ss_hash")), "left")
    ordered = F.array_sort(F.transform("_ss_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    # overlapping spans merge: each step writes the text up to the next span and one mark
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        between = F.substring(docs["text"], (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], between, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(docs["text"], (acc["at"] + 1).cast("int"), F.length(docs["text"])))
    clean = F.when(F.col("_ss_spans").isNull(), docs["text"]).otherwise(F.aggregate(ordered, begin, step, rest))
    return rows.select(*[clean.alias("text") if c == "text" else docs[c] for c in docs.columns])
