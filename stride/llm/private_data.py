"""Personal data by bootstrapped contextual extraction, DataFrame operations only.

Base entities (email, ip, card, phone) are found by pattern and checks and are
always reported.  They seed a graph between lexical patterns (the two words
before an entity, an earlier token counting as a word) and instances
(identifier-like tokens; number chunks standing together are one, unless they
hold a base entity or too many digits).  Spark scores the
graph in ``iterations`` rounds: a pattern's confidence for a kind is the score
mass of its instances known to be of that kind over all its distinct
instances; an unknown instance's score is the noisy-or of the confident
patterns it was seen with; instances above ``min_score`` join the seeds of the
next round.  Finally an unknown token is reported where a confident pattern
precedes an accepted instance of the same kind (kind ``ctx_<kind>``).

Edges are pre-aggregated (pattern, instance) counts, so a frequent pattern is
one row per distinct instance; nothing is collected.

Cases: null text is empty; texts without digits or ``@`` have no candidates;
repeated rows and null ids give one row each with the same spans (and count
once in the graph's distinct instances); scores equal to a threshold pass, and a
pattern equally sure of several kinds stands for the alphabetically last (ties);
very long texts are read whole; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stride.llm.common import cut, no_doc_text
from stride.llm.spans import SPANS, joined, labelled, let, regex_spans

#: The base patterns, written so that a run of the leading class is scanned once (same matches, linear time).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

#: An identifier-like token: a blank-separated chunk with a digit or an at sign.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Number chunks of at most nine digits that stand together (blanks, a dash or a slash between) are one token.
GROUP = r"[0-9](?:[().-]*+[0-9]){0,8}+\)?+"
NUMBERS = (rf"(?<!\S)[^\p{{L}}\p{{N}}\s@]*+{GROUP}"
           rf"(?:\x20{{1,2}}+(?:[-/]\x20)?+\(?+{GROUP}(?=[^\p{{L}}\p{{N}}\s@]*+(?:\s|\z)))++\S*+")
MAX_DIGITS = 19
LEFT_CHARS = 64
#: Stands for an earlier token among the words before a token; no other word has a digit.
EARLIER = "0"
ADDRESS = "[A-Za-z0-9]@[A-Za-z0-9]"

KINDS = {"email": 0, "ip": 1, "card": 2, "phone": 3}
CONTEXT_KINDS = {f"ctx_{k}": 4 + i for k, i in KINDS.items()}


@dataclass(frozen=True)
class Bootstrap:
    iterations: int = 3
    min_support: float = 3.0     # score mass of known instances a pattern needs
    min_confidence: float = 0.6
    min_score: float = 0.6
    min_digits: int = 4          # digits of an unknown instance, unless it is an address of kind email


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """kind -> spans; failing matches are dropped, not retried."""
    emails = F.when(F.contains(text, F.lit("@")), regex_spans(text, EMAIL)).otherwise(regex_spans(F.lit(""), EMAIL))
    ips = F.filter(regex_spans(text, IP), lambda s: s["match"].rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"))
    size = lambda s: F.length(_digits(s["match"]))
    cards = F.filter(regex_spans(text, CARD), lambda s: F.when(size(s).between(16, 19), _luhn(_digits(s["match"]))).otherwise(False))
    phones = F.filter(regex_spans(text, PHONE), lambda s: size(s).between(8, 15))
    return {"email": emails, "ip": ips, "card": cards, "phone": phones}


def _seeds(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["match"].alias("match")))


def _occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, _hash, base spans per kind, tokens (start, end, match, left) per row; the text is not carried on."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash"), no_doc_text(F.col("text")).alias("text"))
    found = rows.select("doc_id", "_hash", *[v.alias(k) for k, v in base_spans(F.col("text")).items()],
                        regex_spans(F.col("text"), f"{NUMBERS}|{TOKEN}", LEFT_CHARS).alias("tokens"))
    seeds = F.concat(*[_seeds(k) for k in KINDS])
    found = found.select("doc_id", "_hash", *[labelled(F.col(k), k, KINDS[k]).alias(k) for k in KINDS], seeds.alias("seeds"), "tokens")
    return found.withColumn("tokens", let(F.flatten(F.transform("tokens", _single)), _in_context))


def _single(t: Column) -> Column:
    """The token, or its chunks if several of them hold a base entity or more digits than an identifier has."""
    chunks = F.transform(regex_spans(t["match"], TOKEN, LEFT_CHARS), lambda s, i: F.struct(
        (t["start"] + s["start"]).alias("start"), (t["start"] + s["end"]).alias("end"), s["match"].alias("match"),
        F.when(i == 0, t["left"]).otherwise(s["left"]).alias("left")))
    held = F.exists("seeds", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    apart = t["match"].rlike(r"\s") & (held | (F.length(_digits(t["match"])) > MAX_DIGITS))
    return F.when(apart, chunks).otherwise(F.array(t))


def _in_context(tokens: Column) -> Column:
    """Tokens with the text before them; two tokens back are enough for two words."""
    def one(t, i):
        before = F.concat(F.when(i > 1, F.lit(EARLIER)).otherwise(F.lit("")), F.get(tokens, i - 1)["left"], F.lit(EARLIER))
        left = F.when((i > 0) & (F.length(t["left"]) < LEFT_CHARS), F.concat(before, t["left"])).otherwise(t["left"])
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["match"].alias("match"), left.alias("left"))

    return F.transform(tokens, one)


def _may_be(instance: Column, kind: Column, boot: Bootstrap) -> Column:
    """Unknown instances of every kind but email need digits."""
    return ((kind == "email") & instance.rlike(ADDRESS)) | (F.length(_digits(instance)) >= boot.min_digits)


def _pattern(left: Column) -> Column:
    """The two words before the token, lower case, outer punctuation off; empty if there are not two whole ones."""
    words = F.regexp_extract(F.lower(left), r"(?:^|\s)(\S+\s+\S+)\s*$", 1)
    return F.trim(F.regexp_replace(words, r"[^\p{L}\p{N}\s]+|\s+", " "))


def _edges(tokens: DataFrame) -> DataFrame:
    """tokens (pattern, instance, kind) -> distinct edges; an instance once seen with a kind is a seed of it."""
    rows = tokens.where(F.col("pattern") != "")
    return rows.groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).alias("times"))


def learn(tokens: DataFrame, boot: Bootstrap) -> tuple[DataFrame, DataFrame]:
    """(patterns: pattern, kind, confidence), (instances: instance, kind, score) after the last round."""
    edges = cut(_edges(tokens), "pii-edges")
    sizes = cut(edges.groupBy("pattern").agg(F.countDistinct("instance").alias("n")), "pii-sizes")
    seeds = edges.where(F.col("kind").isNotNull()).select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    unknown = edges.where(F.col("kind").isNull()).select("pattern", "instance").distinct()
    pairs = edges.select("pattern", "instance").distinct()
    known, patterns = seeds, None
    for _ in range(boot.iterations):
        mass = pairs.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
        scored = mass.join(sizes, "pattern").withColumn("confidence", F.col("mass") / F.col("n"))
        good = scored.where((F.col("mass") >= boot.min_support) & (F.col("confidence") >= boot.min_confidence))
        patterns = cut(good.groupBy("pattern").agg(F.max(F.struct("confidence", "kind")).alias("best")).select(
            "pattern", F.col("best.kind").alias("kind"), F.col("best.confidence").alias("confidence")), "pii-patterns")
        odds = F.sum(F.log(1.0 - 0.95 * F.least(F.col("confidence"), F.lit(1.0))))
        found = unknown.join(patterns, "pattern").where(_may_be(F.col("instance"), F.col("kind"), boot)).groupBy("instance", "kind").agg((1.0 - F.exp(odds)).alias("score"))
        found = cut(found.where(F.col("score") >= boot.min_score), "pii-instances")
        known = seeds.unionByName(found.join(seeds.select("instance").distinct(), "instance", "left_anti"))
    return patterns, known


def find(docs: DataFrame, boot: Bootstrap = Bootstrap()) -> DataFrame:
    """doc_id, _hash, n_email, n_ip, n_card, n_phone, base, all_spans (arrays of order, start, end, kind)."""
    rows = cut(_occurrences(docs), "pii")
    base = F.concat(*KINDS)
    token = F.explode("tokens").alias("t")
    flat = rows.select(F.col("doc_id").alias("_id"), "_hash", "seeds", token)
    over = F.filter("seeds", lambda b: (b["start"] < F.col("t.end")) & (F.col("t.start") < b["end"]))
    # the token that opens a base entity stands for it; its further tokens, and repeats of a row, say nothing new
    first = F.element_at(F.array_sort(over), 1)
    core = F.regexp_replace(F.col("t.match"), r"^[^A-Za-z0-9(+]+|[^A-Za-z0-9)]+$", "")
    lead = F.length(F.regexp_extract(F.col("t.match"), r"^[^A-Za-z0-9(+]*", 0))
    opens = (F.size(over) > 0) & (first["start"] >= F.col("t.start"))
    tokens = flat.select(
        "_id", "_hash", (F.col("t.start") + lead).alias("start"), (F.col("t.start") + lead + F.length(core)).alias("end"),
        F.when(opens, first["match"]).otherwise(core).alias("instance"), _pattern(F.col("t.left")).alias("pattern"),
        F.size(over).alias("_over"), F.when(opens, first["kind"]).alias("kind"))
    useful = (F.col("kind").isNotNull()) | ((F.col("_over") == 0) & _may_be(F.col("instance"), F.lit("email"), boot))
    tokens = cut(tokens.where(useful & (F.col("pattern") != "")), "pii-tokens")
    patterns, known = learn(tokens.dropDuplicates(["_id", "_hash", "start"]), boot)
    hit = (
        tokens.where(F.col("kind").isNull()).drop("kind", "_over")
        .join(patterns.select("pattern", "kind"), "pattern").join(known.select("instance", F.col("kind").alias("_k")), "instance")
        .where(F.col("kind") == F.col("_k"))
    )
    order = F.coalesce(*[F.when(F.col("kind") == k, CONTEXT_KINDS[f"ctx_{k}"]) for k in KINDS])
    span = F.struct(order.alias("order"), "start", "end", F.concat(F.lit("ctx_"), F.col("kind")).alias("kind"))
    added = hit.select("_id", "_hash", span.alias("span")).groupBy("_id", "_hash").agg(F.collect_set("span").alias("_added"))
    result = rows.select("doc_id", "_hash", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS], base.alias("base"))
    result = result.join(added.withColumnRenamed("_hash", "_h"),
                         F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")
    return result.withColumn("all_spans", F.concat("base", F.coalesce("_added", F.array().cast(SPANS)))).drop("_id", "_h", "_added")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(joined(F.col("base"), False), 256).alias("base_sha256"),
                        joined(F.col("all_spans"), False).alias("spans"))
