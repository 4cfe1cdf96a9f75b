"""Best-fit packing by a grouping genetic algorithm on islands.

Tokens: a document is its tokenizer ids and an end id; only documents longer
than a sequence are cut.  Ids are made once per distinct blank-separated chunk
of a batch (the tokenizer's words never span a blank) and joined as bytes, so
a piece is known by its length and the crc32 of its ids.

Packing: pieces are dealt at random into shards of about ``shard_pieces``.  Each
shard's first solution is best-fit from the longest piece on; where it has
ceil(tokens / capacity) sequences none has fewer, and the shard is done.  Every
other shard is evolved on several islands, each with its own population of whole
solutions.  Crossover injects whole well-filled bins of one parent into the
other, bins holding a doubled piece are dissolved; displaced pieces are
exchanged for pieces of emptier bins where that fills them better, the rest
placed best-fit; mutation dissolves the emptiest bins.  Between epochs every
island sends its elite to the next island of the shard.  Bins that stay emptier
than ``well_filled`` are dissolved across all shards and packed once more.

Everything is a table: shards, islands and solutions are rows of bounded size.

Cases: null text is empty (one piece: the end id); repeated rows and null ids
are pieces of their own; very long texts are coded whole and cut into pieces of
the capacity; an empty table gives no rows; other columns are ignored.  Ties:
pieces of equal length stand in the order of id, piece, start and ids, so a
shard's solution depends on its rows alone; rows equal in all of these differ in
their number among the equals of a batch of rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stride.llm.common import cut, map_texts


@dataclass(frozen=True)
class Packing:
    capacity: int = 4096
    shard_pieces: int = 4000
    islands: int = 3
    population: int = 4
    epochs: int = 2
    generations: int = 30
    patience: int = 6  # generations without a sequence saved after which an island rests
    well_filled: float = 0.98


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, salt bigint"
KNOWN_CHUNKS = 600_000  # chunks a worker remembers (the first, hence the frequent ones); others are encoded per batch
CALL_CHUNKS = 20_000  # chunks or words joined into one call
REFILLED, REFILLED_PIECES = 100, 5  # emptiest bins, and longest pieces of each, that are offered an exchange
REFILLED_LOOSE = 200  # loose pieces up to which exchanges are tried; among more, best-fit finds what fits
SEPARATOR = "<|endoftext|>"
WORD_END = "</w>"
#: A lower-case Latin word and marks after it: one token run each, untouched by normalisation.  No apostrophe.
SIMPLE_CHUNK = r"([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)"


def _worker_state() -> dict:
    """A dict that lives as long as the Python worker, not just the task."""
    import sys
    import types

    return sys.modules.setdefault("_packing_worker_state", types.ModuleType("_packing_worker_state")).__dict__


class ChunkCoder:
    """Ids (little-endian bytes) of blank-separated chunks, by the tokenizer, many per call.

    Most chunks are a Latin word and marks: their words are encoded once each,
    joined by blanks, and told apart by the tokens that end a word.  All other
    chunks are joined by a special token.
    """

    def __init__(self, path: str):
        import re

        import numpy as np
        from tokenizers import Tokenizer, normalizers

        self.whole, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # plain gets words that are normalised already; whether that holds for this tokenizer is tested once
        self.plain.normalizer = normalizers.Sequence([])
        self.separator = self.whole.token_to_id(SEPARATOR)
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        probe = ["the", "m\u00e4dchen", "ab"]
        self.by_words = [self.whole.encode(p.upper(), add_special_tokens=False).ids for p in probe] == [
            self.plain.encode(p, add_special_tokens=False).ids for p in probe] and all(
            self.ends[self.plain.encode(p, add_special_tokens=False).ids].sum() == 1 for p in probe)
        self.simple = re.compile(SIMPLE_CHUNK).fullmatch
        self.known: dict = {}
        self.marks: dict = {"": b""}

    def _split(self, texts: list, tokenizer, glue: str, stop) -> dict:
        """Encode joined texts; stop tells where one ends (and whether that token is its own)."""
        import numpy as np

        out: dict = {}
        for at in range(0, len(texts), CALL_CHUNKS):
            part = texts[at:at + CALL_CHUNKS]
            ids = np.array(tokenizer.encode_batch_fast([glue.join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            data, begin = ids.tobytes(), 0
            ends, skip = stop(ids)
            if len(ends) != len(part):
                raise ValueError(f"{len(part)} chunks gave {len(ends)} runs of tokens")
            for text, end in zip(part, ends):
                out[text] = data[begin:end]
                begin = end + skip
        return out

    def words(self, words: list) -> dict:
        return self._split(words, self.plain, " ", lambda ids: ((4 * self.ends[ids].nonzero()[0] + 4).tolist(), 0))

    def chunks(self, chunks: list) -> dict:
        if self.separator is None:
            joined, alone = [], chunks
        else:
            joined, alone = [c for c in chunks if "<|" not in c], [c for c in chunks if "<|" in c]
        out = self._split(joined, self.whole, SEPARATOR,
                          lambda ids: ((4 * (ids == self.separator).nonzero()[0]).tolist() + [4 * len(ids)], 4))
        for c in alone:
            out[c] = b"".join(i.to_bytes(4, "little") for i in self.whole.encode(c, add_special_tokens=False).ids)
        return out

    def code(self, chunks: set) -> dict:
        """chunk -> bytes for the given distinct chunks."""
        look = {c: v for c in chunks if (v := self.known.get(c)) is not None}
        fresh = [c for c in chunks if c not in look]
        simple, other = {}, []
        for c in fresh:
            m = self.simple(c.lower()) if self.by_words else None
            if m:
                simple[c] = m.groups()
            else:
                other.append(c)
        words = self.words(list({w for w, _ in simple.values()}))
        marks = [m for m in {m for _, m in simple.values()} if m not in self.marks]
        if len(self.marks) > 10_000:
            self.marks = {"": b""}
            marks = list({m for _, m in simple.values()} - {""})
        self.marks.update(self.chunks(marks))
        coded = self.chunks(other)
        for c, (w, m) in simple.items():
            coded[c] = words[w] + self.marks[m]
        if len(self.known) < KNOWN_CHUNKS:
            self.known.update(coded)
        look.update(coded)
        return look


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, remember: bool = True) -> DataFrame:
    """One row per piece; ``salt`` spreads the pieces at random, by id, piece, ids and the row's number among its equals.

    With ``remember`` a worker keeps coded chunks from task to task, else it
    gives that memory back at the end of each.
    """

    def apply(ids, texts):
        import zlib

        state = _worker_state()
        if tokenizer_path not in state:
            state[tokenizer_path] = ChunkCoder(tokenizer_path)
        chunked = [(t or "").replace("\n", " ").split(" ") for t in texts]
        look = state[tokenizer_path].code(set().union(*chunked))
        end = end_id.to_bytes(4, "little")
        equals: dict = {}
        out: dict = {k.split()[0]: [] for k in PIECES.split(", ")}
        for i, chunks in zip(ids, chunked):
            data = b"".join(map(look.__getitem__, chunks)) + end
            for p, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at:at + 4 * capacity]
                crc = zlib.crc32(part)
                key = b"%d %d %d" % (i or 0, p, crc)
                equals[key] = equals.get(key, 0) + 1
                salt = zlib.crc32(b"%s %d" % (key, equals[key]))
                for k, v in zip(out, (i, p, at // 4, len(part) // 4, crc, salt)):
                    out[k].append(v)
        return out

    return map_texts(docs.withColumn("text", F.col("text").cast("string")), apply, PIECES, "doc_id", "text",
                     after=None if remember else lambda: _worker_state().pop(tokenizer_path, None))


class Bins:
    """One solution: bins of piece numbers over fixed lengths."""

    def __init__(self, lengths, capacity, bins=()):
        self.lengths, self.capacity = lengths, capacity
        self.bins = [list(b) for b in bins]
        self.free = [capacity - sum(lengths[i] for i in b) for b in self.bins]

    def drop(self, gone: set) -> list:
        """Remove the numbered bins; returns their pieces."""
        loose = [i for k in gone for i in self.bins[k]]
        keep = [k for k in range(len(self.bins)) if k not in gone]
        self.bins, self.free = [self.bins[k] for k in keep], [self.free[k] for k in keep]
        return loose

    def best_fit(self, loose: list) -> None:
        """Place pieces in the given order, each into the fullest bin that still takes it."""
        open_bins = sorted((f, k) for k, f in enumerate(self.free) if f)
        for i in loose:
            n = self.lengths[i]
            at = bisect_left(open_bins, (n, -1))
            if at < len(open_bins):
                f, k = open_bins.pop(at)
                self.bins[k].append(i)
            else:
                f, k = self.capacity, len(self.bins)
                self.bins.append([i])
                self.free.append(f)
            self.free[k] = f - n
            if f > n:
                insort(open_bins, (f - n, k))

    def place(self, loose: list) -> None:
        """Displaced pieces: exchanged where that fills a bin better, then best-fit from the longest on."""
        if len(loose) <= REFILLED_LOOSE:
            loose = self.refill(loose)
        self.best_fit(sorted(loose, key=lambda i: -self.lengths[i]))

    def refill(self, loose: list) -> list:
        """Exchange one or two pieces of a bin for one or two loose ones that fill it better; returns what is loose then.

        The fuller a bin gets, the smaller (and the easier to place) is what comes out.
        """
        loose = sorted(loose, key=lambda i: self.lengths[i])
        lengths = [self.lengths[i] for i in loose]
        for k in sorted(range(len(self.bins)), key=lambda k: -self.free[k])[:REFILLED]:
            own = sorted(self.bins[k], key=lambda i: -self.lengths[i])[:REFILLED_PIECES]
            best = None
            for out in [(i,) for i in own] + [(i, j) for n, i in enumerate(own) for j in own[:n]]:
                gone = sum(self.lengths[i] for i in out)
                found = best_pair(lengths, self.free[k] + gone)
                if found and found[0] > gone and (best is None or found[0] - gone > best[0]):
                    best = found[0] - gone, out, found[1:]
            if best:
                gain, out, at = best
                self.bins[k] = [i for i in self.bins[k] if i not in out] + [loose[n] for n in at]
                self.free[k] -= gain
                loose = sorted([i for n, i in enumerate(loose) if n not in at] + list(out), key=lambda i: self.lengths[i])
                lengths = [self.lengths[i] for i in loose]
        return loose

    def fitness(self) -> tuple:
        """Fewer bins first, then fuller ones (sum of squared fills)."""
        return -len(self.bins), sum((self.capacity - f) ** 2 for f in self.free)

    def assignment(self) -> list:
        where = [0] * len(self.lengths)
        for k, b in enumerate(self.bins):
            for i in b:
                where[i] = k
        return where

    @classmethod
    def read(cls, lengths, capacity, where) -> "Bins":
        bins = [[] for _ in range(max(where, default=-1) + 1)]
        for i, k in enumerate(where):
            bins[k].append(i)
        return cls(lengths, capacity, [b for b in bins if b])


def best_pair(lengths: list, room: int) -> tuple | None:
    """(sum, places) of the one or two of ascending lengths that fill the room best; None if none fits."""
    best, b = None, len(lengths) - 1
    for a, n in enumerate(lengths):
        if n > room:
            break
        if best is None or n > best[0]:
            best = n, a
        while b > a and lengths[b] + n > room:
            b -= 1
        if b > a and lengths[b] + n > best[0]:
            best = lengths[b] + n, a, b
    return best


def crossover(a: Bins, b: Bins, rng, cfg: Packing) -> Bins:
    """a with some of b's well-filled bins injected whole."""
    worst = int((1 - cfg.well_filled) * cfg.capacity)
    good = [k for k, f in enumerate(b.free) if f <= worst and len(b.bins[k]) > 1]
    take = rng.sample(good, max(1, len(good) // 3)) if good else []
    injected = {i for k in take for i in b.bins[k]}
    child = Bins(a.lengths, a.capacity, a.bins)
    loose = child.drop({k for k, bin_ in enumerate(child.bins) if not injected.isdisjoint(bin_)})
    child.bins += [list(b.bins[k]) for k in take]
    child.free += [b.free[k] for k in take]
    child.place([i for i in loose if i not in injected])
    return child


def mutate(s: Bins, rng) -> Bins:
    """Dissolve the emptiest bins and some at random, best-fit their pieces."""
    child = Bins(s.lengths, s.capacity, s.bins)
    if child.bins:
        order = sorted(range(len(child.bins)), key=lambda k: -child.free[k])
        some = set(order[: max(2, len(order) // 50)]) | set(rng.sample(order, max(1, len(order) // 50)))
        child.place(child.drop(some))
    return child


def evolve(lengths: list, population: list, seed: int, cfg: Packing) -> list:
    """Some generations on one island; returns the population as assignments, best first."""
    import random

    rng = random.Random(seed)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    people = [Bins.read(lengths, cfg.capacity, w) for w in population]
    ideal = -(-sum(lengths) // cfg.capacity)
    while len(people) < cfg.population and not any(len(s.bins) <= ideal for s in people):
        s = Bins(lengths, cfg.capacity)
        # the first is best-fit decreasing, others follow a blurred order
        blur = 0.0 if not people else 0.15 * len(people)
        s.best_fit(order if not blur else sorted(order, key=lambda i: -lengths[i] * (1 + blur * rng.random())))
        people.append(s)
    calm, fewest = 0, min(len(s.bins) for s in people)
    for _ in range(cfg.generations):
        people.sort(key=Bins.fitness, reverse=True)
        if len(people[0].bins) <= ideal:  # no solution has fewer
            break
        half = people[: max(2, cfg.population // 2)]
        children = [crossover(*rng.sample(half, 2), rng, cfg), mutate(half[0], rng)]
        people = sorted(people + children, key=Bins.fitness, reverse=True)[: cfg.population]
        calm, fewest = (0, len(people[0].bins)) if len(people[0].bins) < fewest else (calm + 1, fewest)
        if calm >= cfg.patience:
            break
    people.sort(key=Bins.fitness, reverse=True)
    return [s.assignment() for s in people]


ISLANDS = "shard bigint, island int, lengths array<int>, population array<array<int>>"


def _evolve_islands(rows: DataFrame, epoch: int, cfg: Packing) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ISLANDS))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                people = (row["population"] or [])[: cfg.population - 1] + ([row["guest"]] if row["guest"] else [])
                seed = (row["shard"] * 31 + row["island"]) * 31 + epoch
                row["population"] = evolve(row["lengths"], people, seed, cfg)
                yield pa.RecordBatch.from_pylist([{f.name: row[f.name] for f in schema}], schema=schema)

    return rows.select("shard", "island", "lengths", "population", "guest").mapInArrow(run, ISLANDS)


def _best_fit(shards: DataFrame, cfg: Packing) -> DataFrame:
    """(shard, lengths, where, over): best-fit from the longest on; over where that takes more bins than the tokens need."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = "shard bigint, lengths array<int>, where array<int>, over boolean"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                lengths = row["lengths"]
                s = Bins(lengths, cfg.capacity)
                s.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]))
                row |= {"where": s.assignment(), "over": len(s.bins) > -(-sum(lengths) // cfg.capacity)}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    return shards.mapInArrow(run, ddl)


def _islands(shards: DataFrame, n: int, cfg: Packing) -> DataFrame:
    """(shard, lengths, where) -> (shard, where) after the epochs of all islands."""
    none = F.lit(None)
    people = shards.select("shard", F.explode(F.array(*[F.lit(k) for k in range(cfg.islands)])).alias("island"), "lengths",
                           F.array("where").alias("population"), none.cast("array<int>").alias("guest"))
    wide = max(1, min(n * cfg.islands, shards.sparkSession.sparkContext.defaultParallelism * 8))
    for epoch in range(cfg.epochs):
        people = cut(_evolve_islands(people.repartition(wide, "shard", "island"), epoch, cfg), "islands")
        elite = people.select(F.col("shard").alias("_s"), ((F.col("island") + 1) % cfg.islands).alias("_i"),
                              F.get("population", F.lit(0)).alias("guest"))
        if epoch + 1 < cfg.epochs:
            people = people.join(elite, (F.col("shard") == F.col("_s")) & (F.col("island") == F.col("_i")))
    # fewest bins; the fitness order inside an island is kept by its first solution
    return elite.groupBy(F.col("_s").alias("shard")).agg(
        F.min_by("guest", F.struct(F.array_max("guest"), F.col("_i"))).alias("where"))


def _pack_shards(pieces: DataFrame, n_pieces: int, cfg: Packing) -> DataFrame:
    """pieces (cut) -> pieces with shard, bin, offset, fill."""
    n = max(1, -(-n_pieces // cfg.shard_pieces))
    item = F.struct("length", "doc_id", "piece", "start", "ids_crc32", "salt")
    shards = cut(
        pieces.withColumn("shard", F.pmod(F.xxhash64("salt", "ids_crc32"), F.lit(n)))
        .groupBy("shard").agg(F.sort_array(F.collect_list(item), asc=False).alias("items")),  # about shard_pieces rows
        "shards")
    lengths = F.transform("items", lambda x: x["length"].cast("int"))
    first = cut(_best_fit(shards.select("shard", lengths.alias("lengths")), cfg), "best-fit")
    best = first.where(~F.col("over")).select("shard", "where")
    over = first.where("over").drop("over")
    if not over.isEmpty():
        best = best.unionByName(_islands(over, n, cfg))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = PIECES + ", shard bigint, bin int, offset bigint, fill bigint"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                used: dict = {}
                out = []
                for item, k in zip(row["items"], row["where"]):
                    at = used.get(k, 0)
                    used[k] = at + item["length"]
                    out.append({**item, "shard": row["shard"], "bin": k, "offset": at})
                for o in out:
                    o["fill"] = used[o["bin"]]
                yield pa.RecordBatch.from_pylist([{f.name: o[f.name] for f in schema} for o in out], schema=schema)

    return shards.join(best, "shard").select("shard", "items", "where").mapInArrow(place, ddl)


def pack(docs: DataFrame, tokenizer_path: str, cfg: Packing = Packing(), end_id: int = 1, remember: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece of every document."""
    pieces = cut(token_pieces(docs, tokenizer_path, end_id, cfg.capacity, remember), "pieces")
    first = cut(_pack_shards(pieces, pieces.count(), cfg), "packed")
    full = F.col("fill") >= int(cfg.well_filled * cfg.capacity)
    poor = cut(first.where(~full).select(pieces.columns), "poor")
    n_poor = poor.count()
    sequence = F.col("shard") * F.lit(1 << 20) + F.col("bin")
    out = [F.col(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    done = first.where(full).select(*out, (sequence * 2).alias("sequence_id"), "offset")
    if not n_poor:
        return done
    again = _pack_shards(poor, n_poor, cfg)
    return done.unionByName(again.select(*out, (sequence * 2 + 1).alias("sequence_id"), "offset"))
