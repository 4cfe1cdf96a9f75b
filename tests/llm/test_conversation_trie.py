"""Conversation trie against nested dictionaries."""

import hashlib
import random
import zlib

import pytest

from stride.llm import conversation_trie as T
from stride.llm.queries import queries, rebuilt
from tests.conftest import SF_CHECK

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def own_turns(rows):
    """conv_id -> [(role, text)] in the order of turns; equal turns by the content's hash."""
    def place(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest())

    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=place):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def branched(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain(convs):
    """Rows of the trie of conv_id -> turns."""
    members, ends = {}, {}
    for c in sorted(convs):
        turns = tuple(convs[c])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    total = {}
    for k in sorted(members, key=len, reverse=True):
        kids = children.get(k, [])
        saved = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        total[k] = (sum(total[x][0] for x in kids) if kids else 1, saved + sum(total[x][1] for x in kids))
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted((members[k][0], len(k), members[k[:-1]][0] if k else -1, len(members[k]), len(children.get(k, [])), *total[k],
                   sha(ends.get(k, []))) for k in members)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rows_of(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in df.collect())


def test_query_equals_nested_dictionaries(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = rows_of(queries()["op11_conversation_trie"](spark, SF_CHECK))
    assert got == plain(branched(own_turns(table)))


def talk(rng, ids):
    """Conversations that share prefixes, copies and chains."""
    known, rows = [[]], []
    for c in ids:
        turns = rng.choice(known)[: rng.randrange(6)] + [(rng.choice("ua"), rng.choice(["x", "yy", "zé\U0001f600", ""])) for _ in range(rng.randrange(4))]
        if rng.random() < 0.3:
            turns = list(rng.choice(known))
        known.append(turns)
        rows += [(c, n, r, t) for n, (r, t) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("rules", [T.TrieRules(), T.TrieRules(shard_rows=2, queue_entries=2, bucket_turns=3, chunk_ids=2),
                                   T.TrieRules(shard_rows=9, queue_entries=4, bucket_turns=2, chunk_ids=50)])
def test_bands_spills_and_buckets(spark, rules):
    """Small limits send messages through every band, spill queues and carry prefixes over buckets."""
    rng = random.Random(rules.shard_rows)
    rows = talk(rng, rng.sample(range(-50, 400), 120))
    df = spark.createDataFrame(rows, SCHEMA)
    found = T.trie(df, rules)
    assert rows_of(T.digest(found, rules)) == plain(own_turns(rows))


def test_branches(spark):
    rng = random.Random(5)
    rows = talk(rng, [*range(0, 40), *range(100, 130), *range(250, 270), 300])
    rows = [r for r in rows if r[0] != 100 or r[1] < 2]  # a short base; conversation 200 is absent
    turns = T.numbered(spark.createDataFrame(rows, SCHEMA))
    turns, members = rebuilt(turns, T.lengths(turns))
    want = branched(own_turns(rows))
    assert {r.conv_id: r.n_turns for r in members.collect()} == {c: len(t) for c, t in want.items()}
    assert rows_of(T.digest(T.build(turns, members))) == plain(want)


def test_cases(spark):
    rows = [(1, None, None, "a"), (1, 0, "u", None), (1, 0, "u", None), (2, 5, "u", "b"), (2, 5, "u", "a"), (2, None, "", "a"), (None, 1, "u", "x"),
            (3, -(1 << 63), "u", "x"), (3, (1 << 63) - 1, "u", "long " * 100_000), (4, 1, "", ""), (5, 7, None, None), (-7, 1, "u", "x"),
            (6, 1, "u:", "x"), (7, 1, "u", ":x")]
    df = spark.createDataFrame([(*r, "k", 3) for r in rows], SCHEMA + ", place string, size int")
    for parts in (1, len(rows)):
        assert rows_of(T.digest(T.trie(df.repartition(parts)))) == plain(own_turns(rows))
    assert T.digest(T.trie(df.limit(0))).count() == 0
    assert T.digest(T.trie(df.where("conv_id IS NULL"))).count() == 0


def test_long_conversation_and_many_copies(spark):
    rows = [(c, n, "u", f"t{n}") for c in range(9000, 9200) for n in range(3)] + [(1, n, "u", f"t{n}") for n in range(5000)]
    rules = T.TrieRules(shard_rows=16, queue_entries=8, chunk_ids=7)
    got = rows_of(T.digest(T.trie(spark.createDataFrame(rows, SCHEMA), rules), rules))
    assert len(got) == 5001 and got[0][:7] == (1, 0, -1, 201, 1, 1, 200 * 6) and got[-1][:7] == (1, 5000, 1, 1, 0, 1, 0)
    ids = ",".join(map(str, range(9000, 9200)))
    assert got[3][7] == hashlib.sha256(ids.encode()).hexdigest()


def test_spilling_queue_is_a_priority_queue():
    rng = random.Random(1)
    for limit in (2, 3, 10, 5000):
        queue, kept, out = T.SpillingQueue(limit), [], []
        for _ in range(2000):
            entry = (rng.randrange(30), rng.randrange(1 << 40))
            queue.push(entry)
            kept.append(entry)
            if rng.random() < 0.3:
                least = min(kept)
                assert queue.pop_if((least[0] - 1,)) is None
                out.append(queue.pop_if(least[:1]))
                assert out[-1] == least
                kept.remove(least)
        assert (queue.spilled > 0) == (limit < 5000)
        while kept:
            least = min(kept)
            kept.remove(least)
            assert queue.pop_if(least) == least
        assert queue.pop_if((0,)) is None
