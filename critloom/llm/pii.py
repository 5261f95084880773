"""Personal data: pattern spans, and terms that reveal them by corpus co-occurrence."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, map_arrow, mix64, stage

KINDS = ("email", "ip", "card", "phone", "term")  # order of spans that start together
WINDOW = 8         # terms before and after a mention that count as its context
CHANCE = 0.05      # chance that any term of an entity occurs so often in its contexts by accident
BANDS, ROWS = 24, 3  # MinHash bands that find near-copied documents, and hashes a band
COPY = 0.4         # share of equal hashes (Jaccard similarity of the terms) that makes a near copy
DISCLOSURE = 0.5   # share of an entity's information that a term may reveal
BLOCK = 200_000    # terms looked up in one pass over the texts; more terms take more passes

# The patterns of the base spans (possessive, so that long runs stay linear).
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+")


def _emails(t: str):
    """Local part, @ and a dotted domain; the local part starts at the end of the last match at the earliest."""
    end, at = 0, t.find("@")
    while at >= 0:
        m, s = _DOMAIN.match(t, at + 1), at
        if m:
            while s > end and t[s - 1] in _LOCAL:
                s -= 1
            if s < at:
                end = m.end()
                yield s, end
                at = t.find("@", end)
                continue
        at = t.find("@", at + 1)


def _ips(t: str):
    """Four number runs joined by dots, the next four from there on; dropped if a part is over 255."""
    for m in _DOTTED.finditer(t):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind."""
    out = [("email", s, e) for s, e in _emails(t)] if "@" in t else []
    out += [("ip", s, e) for s, e in _ips(t)]
    for m in _DIGITS.finditer(t):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in t:
        out += [("phone", *m.span()) for m in _PHONE.finditer(t) if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def entity(kind: str, value: str) -> str:
    """What is protected: the address in lower case, or the digits."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else re.sub('[^0-9]', '', value)}"


def shape(term: str) -> str | None:
    """The class that a term can be generalised to. Its mark is looked up like a term (no term holds a #)."""
    if term.isdigit():
        return "#number"
    if any(c.isdigit() for c in term):
        return "#code"
    return "#name" if term[0].isupper() else None


def classes(kind: str, value: str) -> list[str]:
    """Classes of entities that a value belongs to: the domain of an address, the network of an ip."""
    if kind == "email":
        return [f"domain:{value.rpartition('@')[2].lower()}"]
    return [f"network:{value.rpartition('.')[0]}"] if kind == "ip" else []


def _contexts(t: str, spans):
    """(entity, context hash, distinct terms) per entity and class of a text, over all its mentions;
    terms inside a base span do not count."""
    found = list(_TERM.finditer(t))
    starts, ends = [m.start() for m in found], [m.end() for m in found]
    inside = set()
    for _, s, e in spans:
        inside.update(range(bisect_right(ends, s), bisect_left(starts, e)))
    free = [i for i in range(len(found)) if i not in inside]
    held: dict[str, tuple[list, set]] = {}
    for kind, s, e in spans:
        i, j = bisect_left(free, bisect_right(ends, s)), bisect_left(free, bisect_left(starts, e))
        near = [found[k].group() for k in free[max(0, i - WINDOW):i] + free[j:j + WINDOW]]
        terms = {x.lower() for x in near} | {shape(x) for x in near if shape(x)}
        for name in (entity(kind, t[s:e]), *classes(kind, t[s:e])):
            words, known = held.setdefault(name, ([], set()))
            words.append(" ".join(near).lower())
            known |= terms
    for name, (words, known) in held.items():
        yield name, _hash("\n".join(words)), sorted(known)


def _hash(x: str) -> int:
    return xxhash.xxh64_intdigest(x) - (1 << 63)


def _sketch(t: str) -> list[int]:
    """MinHash of the distinct terms of a text."""
    terms = np.array([xxhash.xxh64_intdigest(x) for x in {x.lower() for x in _TERM.findall(t)}] or [0], np.uint64)
    salts = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
    return [int(mix64(terms ^ x).min() >> np.uint64(1)) for x in salts]


def _clusters(texts: DataFrame) -> DataFrame:
    """(doc, cluster) of the ``texts`` (doc, sketch) that are near copies of others: components of
    verified links to the smallest document of each MinHash band, so no band is paired with itself."""
    texts = stage(texts.groupBy("doc").agg(F.first("sketch").alias("sketch")), "sketches")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("sketch", i * ROWS + 1, ROWS)))
    banded = texts.select("doc", F.explode(bands).alias("band"))
    least = banded.groupBy("band").agg(F.min("doc").alias("u"), F.count(F.lit(1)).alias("k")).where("k > 1").select("band", "u")
    pairs = banded.join(least, "band").where("doc <> u").select("u", F.col("doc").alias("v")).distinct()
    sides = [texts.select(F.col("doc").alias(c), F.col("sketch").alias(f"s{c}")) for c in ("u", "v")]
    same = F.size(F.filter(F.zip_with("su", "sv", lambda x, y: x == y), lambda x: x))
    edges = pairs.join(sides[0], "u").join(sides[1], "v").where(same >= COPY * BANDS * ROWS).select("u", "v")
    return components(edges).select(F.col("node").alias("doc"), F.col("root").alias("cluster"))


def revealing_terms(docs: DataFrame, text_col: str = "text", chance: float = CHANCE, disclosure: float = DISCLOSURE,
                    block: int = BLOCK) -> DataFrame:
    """(term) that reveal some entity: PMI(entity; term) >= disclosure x IC(entity); staged.

    An entity is a distinct base value or a class of values (mail domain, network). The event is a
    document that mentions it; documents that are equal around it or near copies as a whole are one
    event, so copies add nothing and take nothing away. n(e) and n(e,t) are events, n(t) and N
    documents less the copies among the entity's. With p = n(t) / N, IC = log2(N / n(e)) and
    PMI = log2(((n(e,t) - 1 + p) / n(e)) / p): the first event only names the term, the others
    (shrunk towards p) confirm it, so one event alone discloses nothing and two may. The term
    must also occur more often than chance: n(e) KL(n(e,t)/n(e) || p) >= ln(terms of e / chance).
    Every text and every entity is counted."""
    def contexts(batches):
        for b in batches:
            rows = {"entity": [], "context": [], "terms": [], "doc": [], "sketch": []}
            for t in b.column(0).to_pylist():
                spans = base_spans(t) if t else []
                own = (_hash(t), _sketch(t)) if spans else ()
                for found in _contexts(t, spans) if spans else ():
                    for column, value in zip(rows.values(), (*found, *own)):
                        column.append(value)
            types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), types)], list(rows))

    texts = docs.select(text_col)
    seen = stage(map_arrow(texts, contexts, "entity string, context bigint, terms array<string>, doc bigint, sketch array<bigint>"),
                 "contexts")
    one = F.count(F.lit(1))
    copies = _clusters(seen.select("doc", "sketch"))
    rows = (seen.groupBy("entity", "context", "doc").agg(F.first("terms").alias("terms"), one.alias("rows"))
            .join(copies, "doc", "left").withColumn("cluster", F.coalesce("cluster", "doc")))
    windows = stage(rows.groupBy("entity", "context").agg(F.first("terms").alias("terms"), F.min("cluster").alias("event"),
                                                          F.sum("rows").alias("rows")), "events")
    event = windows.groupBy("entity", "event").agg(F.sum("rows").alias("rows"))
    n_e = event.groupBy("entity").agg(one.alias("n_e"), F.sum("rows").alias("d_e"))
    parts = windows.select("entity", "event", "rows", F.explode("terms").alias("term"))
    n_et = (parts.groupBy("entity", "term", "event").agg(F.sum("rows").alias("rows"))
            .groupBy("entity", "term").agg(one.alias("n_et"), F.sum("rows").alias("d_et")))
    n_et = stage(n_et, "entity_terms")
    tried = n_et.groupBy("entity").agg(one.alias("tried"))
    total = docs.count()
    pairs = n_et.where("n_et > 1").join(n_e, "entity").join(tried, "entity")  # a single event has PMI 0
    pairs = pairs.withColumn("all", F.lit(float(total)) - F.col("d_e") + F.col("n_e")).where("n_e < all")

    def told(n_t):
        p, a, n = n_t / F.col("all"), F.col("n_et") / F.col("n_e"), F.col("n_e")
        pmi = F.log2((F.col("n_et") - 1 + p) / n / p)
        miss = F.when(a < 1, (1 - a) * F.log((1 - a) / (1 - p))).otherwise(0.0)
        return ((p < a) & (pmi >= disclosure * F.log2(F.col("all") / n))
                & (n * (a * F.log(a / p) + miss) >= F.log(F.col("tried") / F.lit(chance))))

    pairs = stage(pairs.where(told(F.col("n_et"))), "entity_pairs")  # a term occurs in its events at least
    wanted = stage(pairs.select("term").distinct(), "wanted_terms")
    n_t = None
    for terms in _blocks(wanted, block):
        part = _document_counts(texts, terms)
        n_t = part if n_t is None else n_t.union(part)
    if n_t is None:
        return wanted
    final = pairs.join(n_t, "term").where(told(F.greatest(F.col("n_t") - F.col("d_et") + F.col("n_et"), F.col("n_et"))))
    return stage(final.select("term").distinct(), "revealing_terms")


def _blocks(terms: DataFrame, block: int):
    """The terms as sets of about ``block``, one after the other; no set holds more than a block's hash share."""
    n = terms.count()
    parts = -(-n // block)
    for i in range(parts):
        yield frozenset(r.term for r in terms.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == i).collect())


def _marks(t: str) -> set[str]:
    words = set(_TERM.findall(t))
    return {w.lower() for w in words} | {s for s in map(shape, words) if s}


def _document_counts(texts: DataFrame, terms: frozenset) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        held: dict[str, int] = {}
        for b in batches:
            for t in b.column(0).to_pylist():
                for w in _marks(t) & sent.value if t else ():
                    held[w] = held.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["term", "n"])

    return stage(map_arrow(texts, run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n_t")), "term_counts")


def _term_spans(t: str, spans, terms: frozenset):
    """Occurrences of the terms outside the base spans."""
    taken = sorted((s, e) for k, s, e in spans if k != "term")
    for m in _TERM.finditer(t):
        if m.group().lower() in terms:
            i = bisect_right(taken, (m.end() - 1, float("inf")))
            if not any(e > m.start() for _, e in taken[max(0, i - 4):i]):
                yield "term", m.start(), m.end()


def rewrite(t: str, spans, terms: frozenset) -> str:
    """Base values become their kind; a revealing term becomes its class, or is removed if it has none or the class reveals too."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))):
        if s >= at:
            out.append(t[at:s])
            mark = f"<{kind.upper()}>"
            if kind == "term":
                c = shape(t[s:e])
                mark = "" if c is None or c in terms else f"<{c[1:].upper()}>"
            out.append(mark)
        at = max(at, e)
    return "".join(out) + t[at:]


def sanitise(docs: DataFrame, text_col: str = "text", block: int = BLOCK, keep_text: bool = True, **limits) -> DataFrame:
    """``docs`` with ``sanitised`` (the rewritten text) and ``spans`` (array of kind, start, end), row by row,
    without the text column unless ``keep_text``.

    All documents form the corpus that revealing terms are learned from, and every occurrence
    of such a term in any document is rewritten. Null texts count as empty and stay null in
    ``sanitised``; copies of a document are one event of its entities; an empty
    table stays empty; columns named sanitised or spans are replaced."""
    revealing = revealing_terms(docs, text_col, block=block, **limits)
    classes = frozenset(r.term for r in revealing.where(F.col("term").startswith("#")).collect())  # three at most
    blocks = list(range(-(-revealing.count() // block))) or [None]
    kept = [c for c in docs.columns if c not in ("sanitised", "spans") and (keep_text or c != text_col)]
    out = docs.select(F.col(text_col).alias("_t"), F.lit(None).cast("array<struct<kind:string,s:int,e:int>>").alias("_spans"), *kept)
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in out.schema.fields[2:])
    sc = docs.sparkSession.sparkContext
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))
    for i in blocks:
        own = F.pmod(F.xxhash64("term"), F.lit(len(blocks))) == i if i is not None else F.lit(False)
        sent = sc.broadcast(frozenset(r.term for r in revealing.where(own).collect()))
        last = i == blocks[-1]

        def run(batches, sent=sent, last=last):
            for b in batches:
                found, texts = [], []
                for t, old in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    spans = base_spans(t or "") if old is None else [(x["kind"], x["s"], x["e"]) for x in old]
                    if sent.value and t:
                        spans = sorted([*spans, *_term_spans(t, spans, sent.value)], key=lambda x: (x[1], KINDS.index(x[0])))
                    found.append([{"kind": k, "s": s, "e": e} for k, s, e in spans])
                    texts.append(rewrite(t, spans, classes) if last and spans else t)
                yield pa.RecordBatch.from_arrays([pa.array(texts, b.column(0).type), pa.array(found, span_type), *b.columns[2:]],
                                                 b.schema.names)

        out = map_arrow(out, run, f"_t string, _spans array<struct<kind:string,s:int,e:int>>, {kinds}".rstrip(", "))
    return out.select(*kept, F.col("_t").alias("sanitised"), F.col("_spans").alias("spans"))
