"""Chains, host graphs and roll-ups beside plain versions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from warcloom.operators import graph


def plain_ends(pointers):
    out = {}
    for start, at in pointers.items():
        seen, hops = {start}, 1
        while at is not None and pointers.get(at) is not None and at not in seen:
            seen.add(at)
            at, hops = pointers[at], hops + 1
        if pointers[start] is not None:
            out[start] = (None, None, "cycle") if at in seen else (at, hops, "original" if at in pointers else "missing")
    return out


@pytest.mark.parametrize("kind", ["long", "hot", "mixed", "empty"])
def test_originals(spark, kind):
    chance = random.Random(4)
    if kind == "long":
        pointers = {f"r{k}": f"r{k + 1}" for k in range(300)} | {"r300": None} | {f"c{k}": f"c{(k + 1) % 7}" for k in range(7)}
    elif kind == "hot":
        pointers = {f"r{k}": "one" for k in range(3000)} | {"one": None} | {f"q{k}": "r7" for k in range(3000)}
    elif kind == "mixed":
        pointers = {f"r{k}": chance.choice([None, f"r{chance.randrange(400)}", f"gone{k % 5}"]) for k in range(400)}
    else:
        pointers = {}
    rows = [(k, v) for k, v in pointers.items()] + [(None, "r1"), (None, None)]
    if pointers:
        rows += rows[:5]  # records that come twice
        rows = [(k, "" if v is None and n % 2 else v) for n, (k, v) in enumerate(rows)]
    frame = spark.createDataFrame(rows, "id string, refers_to string").repartition(4)
    found = graph.originals(frame).collect()
    assert {r.id: (r.original, r.hops, r.status) for r in found} == plain_ends(pointers) and len(found) == len(plain_ends(pointers))


def test_only_hot_keys_are_copied(spark, monkeypatch):
    rows = [(f"r{k}", "one" if k % 2 else f"r{k // 2}") for k in range(1, 400)] + [("one", None), ("r0", None)]
    frame = spark.createDataFrame(rows, "id string, at string")
    one = frame.selectExpr("id AS at", "at AS then")
    plain = graph._joined_salted(frame, one, "at")
    assert "Generate" not in plain._jdf.queryExecution().toString()
    monkeypatch.setattr(graph, "HOT", 50)
    salted = graph._joined_salted(frame, one, "at")
    assert "Generate" in salted._jdf.queryExecution().toString()
    assert sorted(map(str, salted.select("id", "at", "then").collect())) == sorted(map(str, plain.select("id", "at", "then").collect()))
    found = graph.originals(frame, refers_to="at").collect()
    assert {r.id: (r.original, r.hops, r.status) for r in found} == plain_ends(dict(rows))


LINKS = [
    ("http://A.cz:80/x", ["http://b.cz/1", "http://b.cz/2", "http://u@c.cz/", "/no", "http://a.cz/own", None]),
    ("http://a.cz/y", ["http://b.cz/1"]),
    ("https://b.cz/", ["http://a.cz/", "http://a.cz/", "http://d.cz?q"]),
    ("http://c.cz", ["http://d.cz/"]),
    ("http://e.cz", []),
    ("http://f.cz", None),
    (None, ["http://a.cz"]),
    ("mailto:x", ["http://a.cz"]),
]


def links(spark):
    return graph.host_links(spark.createDataFrame(LINKS, "url string, links array<string>"))


def test_host_links_and_degrees(spark):
    assert {tuple(r) for r in links(spark).collect()} == {
        ("a.cz", "b.cz", 3, 2), ("a.cz", "c.cz", 1, 1), ("b.cz", "a.cz", 2, 1), ("b.cz", "d.cz", 1, 1), ("c.cz", "d.cz", 1, 1),
    }
    assert {tuple(r) for r in graph.host_degrees(links(spark)).collect()} == {("a.cz", 1, 2, 2, 4), ("b.cz", 1, 3, 2, 3), ("c.cz", 1, 1, 1, 1), ("d.cz", 2, 2, 0, 0)}


def plain_ranks(pairs, damping=0.85, rounds=200):
    hosts = sorted({h for p in pairs for h in p})
    out = defaultdict(list)
    for a, b in pairs:
        out[a].append(b)
    rank = dict.fromkeys(hosts, 1 / len(hosts))
    for _ in range(rounds):
        loose = sum(rank[h] for h in hosts if not out[h])
        got = Counter()
        for a in hosts:
            for b in out[a]:
                got[b] += rank[a] / len(out[a])
        rank = {h: (1 - damping) / len(hosts) + damping * (got[h] + loose / len(hosts)) for h in hosts}
    return rank


def test_ranks(spark):
    chance = random.Random(8)
    pairs = {(f"h{chance.randrange(30)}", f"h{chance.randrange(40)}") for _ in range(120)}
    pairs = {p for p in pairs if p[0] != p[1]}
    frame = spark.createDataFrame([(*p, 5, 1) for p in pairs], "source string, target string, n_links long, n_pages long")
    found = {r["host"]: r["rank"] for r in graph.host_ranks(frame, rounds=60, enough=1e-7).collect()}
    want = plain_ranks(pairs)
    assert set(found) == set(want) and all(abs(found[h] - want[h]) < 1e-6 for h in want)
    assert abs(sum(found.values()) - 1) < 1e-9
    assert graph.host_ranks(frame.limit(0)).count() == 0


def test_rollups_merge(spark):
    rows = [("h1", "a", 10, f"http://s{k % 50}.cz/") for k in range(200)] + [("h2", "b", None, f"http://s{k % 80}.cz/{k}") for k in range(200)] + [(None, None, 1, None)]
    frame = spark.createDataFrame(rows, "harvest string, kind string, warc_record_size long, url string")
    found = graph.harvest_rollup(frame, ["harvest", "kind"])
    got = {(r.level, r.harvest, r.kind): (r.n_records, r.n_bytes, r.n_hosts) for r in found.collect()}
    assert got == {
        (2, "h1", "a"): (200, 2000, 50), (1, "h1", None): (200, 2000, 50), (2, "h2", "b"): (200, 0, 80), (1, "h2", None): (200, 0, 80),
        (2, None, None): (1, 1, 0), (1, None, None): (1, 1, 0), (0, None, None): (401, 2001, 80),
    }
    merged = graph.merged_hosts(found.filter("level = 2"), []).first()[0]
    assert abs(merged - 80) <= 3
