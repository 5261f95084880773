"""URL filters: longest-rule verdicts, carried over redirect and canonical-link aliases."""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, map_arrow, stage

_HEAD_TAG = re.compile(r"<(link|meta)\b((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^<>])*+)(>?)", re.I)
_ATTRIBUTE = re.compile(r"(?<![a-z-])([a-z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_REFRESH = re.compile(r"^\s*[0-9.]*\s*[;,]?\s*url\s*=\s*['\"]?([^'\"]+)", re.I)
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ``://`` up to / ? # or the end, A-Z lower-cased; then up to ? # or the end."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(_UPPER), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def node(url: str) -> int | None:
    """A 64-bit name of the resource: host, path and query; scheme and fragment do not count."""
    host, path = split_url(url)
    if not host:
        return None
    query = url.partition("#")[0].partition("?")[2]
    return xxhash.xxh64_intdigest(f"{host}{path or '/'}?{query}") - (1 << 63)


def aliases(url: str | None, html: str | None) -> list[str]:
    """Absolute targets of the page's canonical links and immediate redirects (meta refresh)."""
    out = []
    for tag, inner, closed in _HEAD_TAG.findall(html or "") if url and "://" in url else ():
        if not closed:
            continue
        a = {k.lower(): unescape(x or y or z) for k, x, y, z in _ATTRIBUTE.findall(inner)}
        target = None
        if tag.lower() == "link" and "canonical" in a.get("rel", "").lower().split():
            target = a.get("href")
        elif tag.lower() == "meta" and a.get("http-equiv", "").lower() == "refresh":
            m = _REFRESH.match(a.get("content", ""))
            target = m and m.group(1)
        if target:
            try:
                out.append(urljoin(url, target.strip()))
            except ValueError:  # not an address
                continue
    return out


class Rules:
    """Rules (verdict, host, path); a rule fits its host and all subdomains where the path starts with its own.

    The longest rule (host and path) wins; of equally long ones an allow, then the smaller text."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, host, path in rules:
            self.by_host.setdefault(host, []).append((path, host + path, verdict))

    def find(self, url: str | None) -> tuple[str | None, str | None]:
        """(rule, verdict) or nulls."""
        host, path = split_url(url)
        best, at = None, 0
        while host:
            for start, text, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(start):
                    key = (-len(text), verdict != "allow", text)
                    best = min(best, (key, text, verdict)) if best else (key, text, verdict)
            at = host.find(".", at) + 1
            if not at:
                break
        return (best[1], best[2]) if best else (None, None)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", redirects: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """One row per page: ``(<id>, host, path, rule, verdict, component)``.

    A page that a rule fits has the rule's verdict. Others take that of their aliases: the
    connected component over canonical links, meta redirects and the optional ``redirects``
    (from_url, to_url). One explicitly allowed address in it allows, else one blocked address
    blocks, else ``default`` holds. component is the smallest node of the component (null: no
    alias). Null urls have an empty host and path and no aliases; repeated pages are judged each;
    an empty table gives no rows; only the named columns are read. The rule list is held in
    memory; pages, edges and components stay distributed."""
    finder = Rules(rules)

    def run(batches):
        for b in batches:
            rows = {k: [] for k in ("host", "path", "rule", "verdict", "node", "targets")}
            for url, html in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                host, path = split_url(url)
                rule, verdict = finder.find(url)
                own = node(url) if url else None
                rows["host"].append(host)
                rows["path"].append(path)
                rows["rule"].append(rule)
                rows["verdict"].append(verdict)
                rows["node"].append(own)
                found = aliases(url, html) if own is not None else []
                rows["targets"].append([{"node": node(t), "verdict": finder.find(t)[1]} for t in found if node(t) not in (None, own)])
            target = pa.list_(pa.struct([("node", pa.int64()), ("verdict", pa.string())]))
            types = [pa.string()] * 4 + [pa.int64(), target]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, t in zip(rows.values(), types))], ["_id", *rows])

    kind = pages.schema[id_col].dataType.simpleString()
    seen = stage(map_arrow(pages.select(id_col, url_col, html_col), run,
                           f"_id {kind}, host string, path string, rule string, verdict string, node bigint, "
                           "targets array<struct<node:bigint,verdict:string>>"), "pages")
    links = seen.select(F.col("node").alias("u"), "verdict", F.explode("targets").alias("t")).select(
        "u", "verdict", F.col("t.node").alias("v"), F.col("t.verdict").alias("v_verdict"))
    if redirects is not None:
        links = links.union(_redirect_links(redirects, finder))
    links = stage(links, "alias_links")
    comp = stage(components(links.select("u", "v")), "alias_components")
    facts = links.select(F.col("u").alias("node"), "verdict").union(links.select("v", "v_verdict"))
    facts = facts.groupBy("node").agg(F.max(F.col("verdict") == "allow").alias("allow"), F.max(F.col("verdict") == "block").alias("block"))
    shared = comp.join(facts, "node").groupBy("root").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    shared = stage(comp.join(shared, "root").select("node", "root", F.when(F.col("allow"), "allow").when(F.col("block"), "block").alias("shared")),
                   "alias_verdicts")
    return seen.join(shared, "node", "left").select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce("verdict", "shared", F.lit(default)).alias("verdict"), F.col("root").alias("component"))


def _redirect_links(redirects: DataFrame, finder: Rules) -> DataFrame:
    def run(batches):
        for b in batches:
            rows = [(node(u), finder.find(u)[1], node(v), finder.find(v)[1])
                    for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if u and v]
            rows = [r for r in rows if r[0] is not None and r[2] is not None]
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            types = [pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["u", "verdict", "v", "v_verdict"])

    return map_arrow(redirects.select("from_url", "to_url"), run, "u bigint, verdict string, v bigint, v_verdict string")
