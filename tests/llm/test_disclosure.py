"""Personal data and disclosing terms beside plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from llm_plain import awkward

from warcloom.llm import op12_disclosure as op12

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def luhn(digits):
    total = 0
    for k, x in enumerate(reversed(digits)):
        d = int(x) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    """(kind, start, end, value) by the patterns as they are given."""
    only = lambda s: "".join(c for c in s if c in "0123456789")
    out = [("email", *m.span(), m[0].lower()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span(), ".".join(str(int(x)) for x in m[0].split("."))) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span(), only(m[0])) for m in CARD.finditer(text) if 13 <= len(only(m[0])) <= 19 and luhn(only(m[0]))]
    return out + [("phone", *m.span(), only(m[0])) for m in PHONE.finditer(text) if 9 <= len(only(m[0])) <= 15]


def private(rows, disclosed=op12.DISCLOSED, least=op12.CONTEXTS):
    """(doc_id, counts.., digest, spans) by tables of all pairs."""
    docs = [(i, t or "", base(t or "")) for i, t in rows]
    cut = lambda t: t[: op12.GENERAL]
    with_term, with_entity, joint, seen = Counter(), Counter(), Counter(), defaultdict(set)
    near = []
    for _, text, found in docs:
        own = [m[0].translate(LOWER) for m in TERM.finditer(text)]
        with_term.update({("t", t) for t in own} | {("g", cut(t)) for t in own})
        with_entity.update({(k, v) for k, _, _, v in found})
        pairs, places = {}, []
        for kind, a, z, value in found:
            low, high = max(0, a - op12.AROUND), min(len(text), z + op12.AROUND)
            around = [m.span() for m in TERM.finditer(text) if m.start() >= low and m.end() <= high and not any(x < m.end() and m.start() < y for _, x, y, _ in found)]
            window = op12._number(" ".join(text[s:e] for s, e in around).lower().encode())
            for s, e in around:
                t = text[s:e].translate(LOWER)
                places.append(((kind, value), t, s, e))
                for x in (("t", t), ("g", cut(t))):
                    pairs[(kind, value), x] = min(window, pairs.get(((kind, value), x), window))
        for pair, window in pairs.items():
            joint[pair] += 1
            seen[pair].add(window)
        near.append(places)
    n = len(docs)

    def tells(entity, x):
        pair = entity, x
        if len(seen[pair]) < least or with_entity[entity] == n:
            return False
        return math.log(joint[pair] * n / (with_entity[entity] * with_term[x])) / math.log(n / with_entity[entity]) >= disclosed - 1e-12

    out = Counter()
    for (doc_id, _, found), places in zip(docs, near, strict=True):
        gone = {}
        for entity, t, s, e in places:
            if tells(entity, ("t", t)):
                gone[s, e] = gone.get((s, e), False) or len(t) <= op12.GENERAL or tells(entity, ("g", cut(t)))
        spans = [f"{k}:{a}:{z}" for k, a, z, _ in found]
        more = [f"{name}:{s}:{e}" for name, r in (("generalise", False), ("remove", True)) for (s, e), x in sorted(gone.items()) if x == r]
        count = Counter(k for k, *_ in found)
        sha = hashlib.sha256(",".join(spans).encode()).hexdigest()
        out[(doc_id, *(count[k] for k in op12.KINDS), sum(not x for x in gone.values()), sum(gone.values()), sha, ",".join(spans + more))] += 1
    return out


PLANTED = (
    [f"Filler{k} opening words {k} then Zorblatt wrote from jane.roe@example.org about item{k} and more" for k in range(5)]
    + [f"Report{k} by Zorblattian office {k}, unrelated to anybody at all number{k}" for k in range(30)]
    + ["copies say quixotic things near bob@copy.example.com always"] * 6
    + [f"call +1 (415) 555-01{k:02} or 4111 1111 1111 1111 now, agent Xu{k % 2} waits {k} days" for k in range(8)]
    + ["+49 30 1234567 @ 10.0.0.256 1.2.3.4.5 a@b@c.de.fg x@y.z@w.v 4111-1111-1111-1111 é1.1.1.1 ..%+-@a.b"]
    + [f"the, words{k} of a text" for k in range(40)]
)


def found_in(frame, **how):
    return Counter(tuple(r) for r in op12.find_private(frame, **how).collect())


def test_spans_against_plain_version(spark):
    for frame in (awkward(spark, PLANTED), spark.read.parquet(f"{SF}/documents.parquet"), awkward(spark).limit(0)):
        assert found_in(frame) == private([(r.doc_id, r.text) for r in frame.collect()])


def test_terms_that_give_an_entity_away(spark):
    frame = awkward(spark, PLANTED)
    rows = op12.find_private(frame).collect()
    texts = {r.doc_id: r.text for r in frame.collect()}
    shown = defaultdict(set)
    for r in rows:
        for kind, a, z in (x.split(":") for x in r.spans.split(",") if x):
            shown[kind].add(texts[r.doc_id][int(a) : int(z)])
    assert "Zorblatt" in shown["generalise"]  # "Zorb" begins the terms of thirty other documents
    assert "Xu0" in shown["remove"] and "wrote" in shown["remove"] | shown["generalise"]
    assert not {"quixotic", "always"} & (shown["remove"] | shown["generalise"])  # copies are one surrounding
    assert "jane.roe@example.org" in shown["email"]
    clean = [r for r in rows if not any(r[f"n_{k}"] for k in op12.KINDS)]
    assert clean and all(r.spans == "" for r in clean)


@pytest.mark.parametrize("how", [{"disclosed": 0.3, "contexts": 1}, {"disclosed": 1.0, "contexts": 2}])
def test_other_thresholds(spark, how):
    frame = awkward(spark, PLANTED)
    assert found_in(frame, **how) == private([(r.doc_id, r.text) for r in frame.collect()], how["disclosed"], how["contexts"])


def test_full_bit_table_changes_nothing(spark, monkeypatch):
    frame = awkward(spark, PLANTED)
    monkeypatch.setattr(op12, "BITS", 7)
    assert found_in(frame) == private([(r.doc_id, r.text) for r in frame.collect()])


def test_patterns_on_random_signs():
    chance = random.Random(5)
    for _ in range(30_000):
        text = "".join(chance.choice("a1@.-+ 9(0é") for _ in range(chance.randint(0, 40)))
        assert [(op12.KINDS[k], a, z, v) for k, a, z, v in op12.base_entities(text)] == base(text)
    for _ in range(300):
        digits = "".join(chance.choice("0123456789") for _ in range(chance.randint(12, 20)))
        assert op12._luhn(digits) == luhn(digits)


@pytest.mark.parametrize("piece", ["a", "1", "1.", "1 ", "@", "a@", "a@b", "a.", "+", "+1", "+1 ", "1.1.1.", "a@b.c@"])
def test_patterns_are_linear(piece):
    start = time.perf_counter()
    op12.base_entities(piece * (2_000_000 // len(piece)))
    assert time.perf_counter() - start < 20


def test_sanitised_rows_keep_their_columns(spark):
    frame = awkward(spark, PLANTED)
    made = op12.sanitise(frame)
    assert made.schema == frame.schema and made.count() == frame.count()
    texts = [r.text for r in made.collect()]
    assert any("Zorb* " in (t or "") and "[email]" in t for t in texts)
    assert not any(EMAIL.search(t or "") for t in texts if t and "jane" in t)
    assert sum(t is None for t in texts) == 2
