"""Personal data, and the terms around it that give it away.

Base kinds are patterns: ``email``, ``ip``, ``card`` (Luhn) and ``phone``. Each matched value is a protected entity. The method
estimates from the whole corpus how strongly a term reveals an entity near which it stands: with documents as events,

    disclosure(e, t) = PMI(e; t) / IC(e) = log(p(e, t) / (p(e) p(t))) / log(1 / p(e)),

which is 1 if the term occurs with the entity only, and 0 if it says nothing about it. p(e, t) counts documents in which t
stands within ``AROUND`` code points of e, p(e) and p(t) those with e and with t anywhere. A term that reaches ``DISCLOSED``
is generalised to its first ``GENERAL`` characters, if the corpus shows that terms with this beginning together stay below
the threshold, and removed otherwise; so is a term that is no longer than that. A pair counts only if it occurs in ``CONTEXTS``
different surroundings, so copies of one text, whose words all meet the entity, are no evidence: surroundings are compared
by the terms in them. An entity of all documents reveals nothing and has no disclosing terms.

Statistics cover all documents. The first pass finds entities and their surroundings. Counts of pairs are ordinary
aggregates. The second pass counts documents of the terms that may disclose something: tasks look terms up in a bit table of a
fixed size (``BITS``), which lets some others through when it is full, and these fall out in the join behind it; so what is
broadcast has a bound and what is shuffled is small. Terms are hashed to 64 bits.

A span is (kind, start, end) in code points, end exclusive, ordered by kind, then start. Kinds of a pattern do not overlap with
themselves but may with each other; a term that touches a base span is not added.

Rules: null is an empty text. Every row gives one row, repeated ones too, and each counts in the statistics; an empty table
gives none. Columns other than doc_id and text are not looked at; ``sanitise`` returns them. All patterns take time linear in
the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.llm.arrays import blocks, mix
from warcloom.llm.stored import stored
from warcloom.llm.terms import as_terms, term_hashes

KINDS = ("email", "ip", "card", "phone")
AROUND, GENERAL, DISCLOSED, CONTEXTS = 100, 4, 0.75, 3
BITS, SALTS = 26, 32
_WORD_BITS = 6

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SIGN = re.compile(r"[^0-9]+")
# a term's first GENERAL characters, in UTF-8
_CUT = re.compile(rb"((?:[a-z0-9]|[\xC0-\xFF][\x80-\xBF]*){%d})[^\x20]+" % GENERAL)
_LUHN = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

_BASE = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string"
_SCANNED = (
    f"row long, {_BASE}, entities array<long>, pairs array<struct<entity: long, term: long, window: long>>,"
    " places array<struct<entity: long, term: long, general: long, start: long, end: long>>"
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        if match := _DOMAIN.match(text, at + 1):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = match.end()
                yield start, done
                at = text.find("@", done)
                continue
        done, at = at + 1, text.find("@", at + 1)  # an "@" ends what can stand before the next one


def _luhn(digits: str) -> bool:
    return (sum(map(int, digits[-1::-2])) + sum(_LUHN[int(x)] for x in digits[-2::-2])) % 10 == 0


def base_entities(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the patterns, by kind, then start. Matches that fail a check are dropped."""
    found = [(0, a, z, text[a:z].lower()) for a, z in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [x.lstrip("0") or "0" for x in m.groups()]
        if all(len(x) <= 3 and int(x) <= 255 for x in parts):
            found.append((1, *m.span(), ".".join(parts)))
    for m in _CARD.finditer(text):
        digits = _SIGN.sub("", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span(), digits))
    for m in _PHONE.finditer(text) if "+" in text else ():
        digits = _SIGN.sub("", m[0])
        if 9 <= len(digits) <= 15:
            found.append((3, *m.span(), digits))
    return found


def _number(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _general(hashes: np.ndarray) -> np.ndarray:
    """Beginnings are counted beside terms, under numbers of their own."""
    return mix(hashes.copy(), 0xA5A5_5A5A_1234_4321)


def beginnings(terms: bytes) -> bytes:
    """``as_terms`` text with terms of more than GENERAL characters cut to these."""
    return _CUT.sub(rb"\1", terms)


def surroundings(text: str, found: list[tuple[int, int, int, str]]) -> tuple[list[int], list[tuple], list[tuple]]:
    """Entities, (entity, term, window) once each, and (entity, term, beginning, start, end) of all terms near an entity."""
    if not found:
        return [], [], []
    taken = sorted((a, z) for _, a, z, _ in found)
    starts, reach = [a for a, _ in taken], np.maximum.accumulate([z for _, z in taken])
    near: list[tuple[int, list[tuple[int, int]]]] = []
    every: dict[str, int] = {}
    for kind, a, z, value in found:
        low, high = max(0, a - AROUND), min(len(text), z + AROUND)
        own = []
        for m in _TERM.finditer(text, low, high):
            s, e = m.span()
            cut = (s == low > 0 and _TERM.match(text, low - 1)) or (e == high < len(text) and _TERM.match(text, high))
            at = int(np.searchsorted(starts, e))  # spans that begin before the term ends
            if not cut and (at == 0 or reach[at - 1] <= s):
                own.append((s, e))
                every.setdefault(text[s:e], len(every))
        near.append((_number(f"{kind}:{value}".encode()), own))
    data = as_terms(" ".join(every))
    terms = term_hashes([data])[0]
    general = _general(term_hashes([beginnings(data)])[0])
    windows: dict[tuple[int, int], int] = {}
    places: set[tuple] = set()
    for entity, own in near:
        window = _number(" ".join(text[s:e] for s, e in own).lower().encode())
        for s, e in own:
            k = every[text[s:e]]
            term, wide = int(terms[k].view(np.int64)), int(general[k].view(np.int64))
            places.add((entity, term, wide if e - s > GENERAL else None, s, e))
            for x in (term, wide):
                windows[entity, x] = min(windows.get((entity, x), window), window)
    return sorted({entity for entity, _ in near}), [(*k, w) for k, w in windows.items()], sorted(places, key=lambda p: (p[0], p[3]))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for k, a, z in spans)


def _scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Rows with a number, their base spans and what stands around entities; written once, so that numbers stay."""
    schema = pa.schema(
        [("row", pa.int64())] + [(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("base", pa.string()), ("entities", pa.list_(pa.int64()))]
        + [("pairs", pa.list_(pa.struct([(x, pa.int64()) for x in ("entity", "term", "window")])))]
        + [("places", pa.list_(pa.struct([(x, pa.int64()) for x in ("entity", "term", "general", "start", "end")])))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for text in batch["_text"].to_pylist():
                found = base_entities(text or "")
                entities, pairs, places = surroundings(text or "", found)
                spans = _joined([x[:3] for x in found])
                kinds = [sum(x[0] == k for x in found) for k in range(4)]
                pairs = [dict(zip(("entity", "term", "window"), x, strict=True)) for x in pairs]
                places = [dict(zip(("entity", "term", "general", "start", "end"), x, strict=True)) for x in places]
                rows.append((number, *kinds, hashlib.sha256(spans.encode()).hexdigest(), spans, entities, pairs, places))
                number += 1
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            made = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays([batch[f"_kept{k}"] for k in range(len(keep))] + made, [f"_kept{k}" for k in range(len(keep))] + schema.names)

    given = docs.select(*(F.col(c).alias(f"_kept{k}") for k, c in enumerate(keep)), F.col("text").cast("string").alias("_text"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema if f.name != "_text")
    return stored(given.mapInArrow(work, f"{kept}, {_SCANNED}"))


def _term_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, df): documents with each term, or beginning, of ``wanted``, and of a few others."""
    slot = F.shiftright(F.col("term"), 64 - BITS + _WORD_BITS).bitwiseAND((1 << (BITS - _WORD_BITS)) - 1)
    bit = F.expr(f"shiftleft(1L, CAST(shiftright(term, {64 - BITS}) & {(1 << _WORD_BITS) - 1} AS int))")
    filled = wanted.groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits")).toPandas()
    table = np.zeros(1 << (BITS - _WORD_BITS), np.uint64)
    table[filled["slot"].to_numpy(np.int64)] = filled["bits"].to_numpy(np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def possible(hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - BITS)
        return shared.value[at >> np.uint64(_WORD_BITS)] >> (at & np.uint64((1 << _WORD_BITS) - 1)) & np.uint64(1) > 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [as_terms(x) for x in batch["text"].to_pylist()]
            for a, z in blocks(texts, 1 << 22):
                made = []
                for kind, own in enumerate((texts[a:z], [beginnings(x) for x in texts[a:z]])):
                    hashes, counts = term_hashes(own)
                    hashes = _general(hashes) if kind else hashes
                    text = np.repeat(np.arange(len(counts)), counts)
                    some = possible(hashes)
                    order = np.lexsort((text[some], hashes[some]))
                    hashes, text = hashes[some][order], text[some][order]
                    new = np.ones(len(hashes), bool)
                    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                    made.append(hashes[new])
                term, df = np.unique(np.concatenate(made), return_counts=True)
                yield pa.record_batch([pa.array(term.view(np.int64)), pa.array(df, pa.int64())], names=["term", "df"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "term long, df long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"))


def disclosure(joint: Column, of_entity: Column, of_term: Column, n: int) -> Column:
    """PMI over information content; null where an entity has no information."""
    return F.log(joint * float(n) / (of_entity * of_term.cast("double"))) / F.nullif(F.log(float(n) / of_entity), F.lit(0.0))


def disclosing_terms(docs: DataFrame, scanned: DataFrame, disclosed: float = DISCLOSED, contexts: int = CONTEXTS) -> DataFrame:
    """(entity, term, disclosure) of all pairs at the threshold; a beginning is a term here."""
    n = scanned.count()
    pairs = scanned.select(F.explode("pairs").alias("p")).select("p.*")
    joint = pairs.groupBy("entity", "term", "window").agg(F.count("*").alias("n")).groupBy("entity", "term")
    joint = stored(joint.agg(F.sum("n").alias("joint"), F.count("*").alias("contexts")).where(F.col("contexts") >= contexts))
    of_entity = scanned.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("of_entity"))
    counted = _term_counts(docs, joint.select("term").distinct())
    told = joint.join(of_entity, "entity").join(counted, "term")
    value = disclosure(F.col("joint"), F.col("of_entity"), F.col("df"), max(n, 1))
    return stored(told.select("entity", "term", value.alias("disclosure")).where(F.col("disclosure") >= disclosed))


def _added(scanned: DataFrame, disclosing: DataFrame) -> DataFrame:
    """(row, spans): array of (start, end, removed) of the terms that go. Rows of a hot pair are dealt by a salt."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    pairs = disclosing.select("entity", "term", salt)
    places = scanned.select("row", F.explode("places").alias("p")).select("row", "p.*", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
    own = places.join(pairs, ["entity", "term", "salt"])
    wide = pairs.select("entity", F.col("term").alias("general"), "salt", F.lit(True).alias("too_wide"))
    own = own.join(wide, ["entity", "general", "salt"], "left")
    removed = F.col("general").isNull() | F.coalesce("too_wide", F.lit(False))
    each = own.groupBy("row", "start", "end").agg(F.max(removed).alias("removed"))
    return each.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed"))).alias("spans"))


def find_private(docs: DataFrame, disclosed: float = DISCLOSED, contexts: int = CONTEXTS) -> DataFrame:
    """One row per row of docs(doc_id, text, ..): counts and digest of the base spans, and all spans."""
    scanned = _scanned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"])
    added = _added(scanned, disclosing_terms(docs, scanned, disclosed, contexts)).withColumnRenamed("spans", "more")
    whole = scanned.drop("entities", "pairs", "places").join(added, "row", "left")

    def listed(kind: str, removed: bool) -> Column:
        own = F.filter("more", lambda s: s["removed"] == removed)
        return F.array_join(F.transform(own, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")

    spans = [F.col("base"), listed("generalise", False), listed("remove", True)]
    return whole.select(
        F.col("_kept0").alias("doc_id"),
        *(f"n_{k}" for k in KINDS),
        F.coalesce(F.size(F.filter("more", lambda s: ~s["removed"])), F.lit(0)).cast("long").alias("n_generalise"),
        F.coalesce(F.size(F.filter("more", lambda s: s["removed"])), F.lit(0)).cast("long").alias("n_remove"),
        "base_sha256",
        F.concat_ws(",", *(F.nullif(x, F.lit("")) for x in spans)).alias("spans"),
    )


def sanitised(text: str, base: str, more: list[tuple[int, int, bool]]) -> str:
    """The text with base spans replaced by their kind in brackets, and terms generalised or removed."""
    spans = [(int(a), int(z), f"[{kind}]") for kind, a, z in (x.split(":") for x in base.split(",") if x)]
    spans += [(a, z, "" if removed else text[a : a + GENERAL] + "*") for a, z, removed in more]
    out, at = [], 0
    for a, z, mark in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, z)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, disclosed: float = DISCLOSED, contexts: int = CONTEXTS) -> DataFrame:
    """docs with personal data masked and disclosing terms generalised or removed in ``text``; rows and columns stay."""
    scanned = _scanned(docs, docs.columns)
    added = _added(scanned, disclosing_terms(docs, scanned, disclosed, contexts)).withColumnRenamed("spans", "more")
    names = {c: f"_kept{k}" for k, c in enumerate(docs.columns)}
    whole = scanned.select(*names.values(), "row", "base").join(added, "row", "left").drop("row")
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch[f"_kept{at}"].to_pylist()
            told = zip(batch["base"].to_pylist(), batch["more"].to_pylist(), strict=True)
            made = [x if x is None else sanitised(x, base, [tuple(s.values()) for s in more or ()]) for x, (base, more) in zip(texts, told, strict=True)]
            kept = [batch[c] for c in names.values()]
            kept[at] = pa.array(made, kept[at].type)
            yield pa.RecordBatch.from_arrays(kept, list(names.values()))

    made = whole.mapInArrow(work, ", ".join(f"{names[f.name]} {f.dataType.simpleString()}" for f in docs.schema))
    return made.select(*(F.col(k).alias(c) for c, k in names.items()))
