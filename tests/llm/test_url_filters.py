"""Temporal list join against a plain loop."""

import datetime as dt
import random

from stride.llm import url_filters as U

T0 = dt.datetime(2024, 1, 1)
HOSTS = ["a.example.com", "b.example.com", "example.org", "x.y.z.example.net"]


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def keys_of(url):
    import re

    m = re.match(r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)(/[^?#\s]*)?", url or "")
    host = re.sub(r"\.+$", "", re.sub(r"^.*@|:[0-9]*$", "", m[1]).lower()) if m else ""
    if not host:
        return set()
    path = (m[2] or "").rstrip("/")
    labels, parts = host.split("."), path.split("/")
    out = {f"host:{host}", f"url:{host}{path}"}
    out |= {"domain:" + ".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))}
    return out | {f"prefix:{host}" + "/".join(parts[: i + 1]) for i in range(len(parts))}


def active(entries, key, when):
    last = None
    for e in sorted((e for e in entries if e[1] == key and e[3] is not None and e[2] in ("add", "remove")), key=lambda e: (e[3], e[0])):
        if e[3] <= when:
            last = e[2]
    return last == "add"


def test_equals_plain_loop(make):
    rng = random.Random(2)
    names = [f"host:{HOSTS[0]}", "domain:example.com", f"prefix:{HOSTS[1]}/news", "domain:example.net", f"url:{HOSTS[2]}/p/1", f"host:{HOSTS[2]}"]
    entries = [(k, rng.choice(names), rng.choice(["add", "add", "remove"]), at(rng.choice([0, 1, 5, 6, 7, 30, 100, 100.5, 400]) + rng.randrange(3))) for k in range(60)]
    entries += [(100, None, "add", at(1)), (101, names[0], "add", None), (102, names[0], "block", at(500)), entries[0]]
    urls = [f"https://{h}{p}" for h in HOSTS for p in ("", "/", "/news/1?x=1#y", "/p/1/", "/p/1")] + [None, "", "no url", "HTTP://User@A.Example.com:8080/P", "https:///x"]
    captures = [(n, rng.choice(urls), at(rng.choice([0, 1, 2, 6, 12, 31, 99, 101, 402, 1000]))) for n in range(150)]
    captures += [(None, urls[0], at(3)), (7, urls[0], None), captures[5], captures[5]]
    got = U.filter_captures(make([c + ("z", 1) for c in captures], "page_id bigint, url string, fetch_ts timestamp, key string, bucket int"),
                            make(entries, "entry_id bigint, key string, action string, ts timestamp")).collect()
    assert len(got) == len(captures)
    want = sorted((p is None, p or 0, ",".join(sorted(k for k in keys_of(u) if t is not None and active(entries, k, t)))) for p, u, t in captures)
    assert sorted((r.page_id is None, r.page_id or 0, r.entries) for r in got) == want
    assert all(r.blocked == (r.n_active > 0) == (r.entries != "") for r in got)


def test_intervals(make):
    entries = make([(1, "k", "add", at(0)), (2, "k", "remove", at(200)), (3, "k", "add", at(300)), (4, "k", "remove", at(300)), (5, "j", "add", at(1))],
                   "entry_id bigint, key string, action string, ts timestamp")
    got = sorted((r.key, r.valid_from, r.valid_to) for r in U.validity_intervals(entries).collect())
    assert got == [("j", at(1), None), ("k", at(0), at(200))]


def test_empty_tables(make):
    captures = make([(1, "https://a.b/c", at(0))], "page_id bigint, url string, fetch_ts timestamp")
    entries = make([(1, "host:a.b", "add", at(0))], "entry_id bigint, key string, action string, ts timestamp")
    assert not U.filter_captures(captures, entries.limit(0)).first().blocked
    assert U.filter_captures(captures, entries).first().blocked
    assert U.filter_captures(captures.limit(0), entries).count() == 0


def test_long_history_of_one_key_in_one_bucket(make):
    """10,000 dated entries of a key within one bucket, added and removed in turn; captures in between and hours later."""
    start = T0 + dt.timedelta(seconds=5)
    entries = [(n, "host:a.example.com", "remove" if n % 2 else "add", start + dt.timedelta(milliseconds=50 * n)) for n in range(10_000)]
    captures = [(n, "https://a.example.com/x", start + dt.timedelta(milliseconds=50 * n + 20)) for n in range(0, 10_000, 7)]
    captures += [(20_000, "https://a.example.com/x", at(9)), (20_001, "https://a.example.com/x", T0)]
    got = {r.page_id: r.blocked for r in U.filter_captures(make(captures, "page_id bigint, url string, fetch_ts timestamp"),
                                                         make(entries, "entry_id bigint, key string, action string, ts timestamp")).collect()}
    assert got == {n: n < 10_000 and n % 2 == 0 for n, _, _ in captures}


def test_address_of_many_segments(make):
    path = "/s" * 2000
    captures = make([(1, "https://a.b" + path, at(1))], "page_id bigint, url string, fetch_ts timestamp")
    entries = make([(1, "prefix:a.b" + "/s" * 1500, "add", at(0)), (2, "url:a.b" + path + "/s", "add", at(0))], "entry_id bigint, key string, action string, ts timestamp")
    row = U.filter_captures(captures, entries).first()
    assert row.n_active == 1 and row.entries == "prefix:a.b" + "/s" * 1500
