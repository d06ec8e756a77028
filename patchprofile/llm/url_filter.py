"""URL filter with redirect equivalence: block decisions spread over connected aliases, allow rules win.

Nodes are URLs without scheme and fragment. Edges are canonical links and refresh redirects in a page's
HTML and, where asked for, the usual redirects between spellings of one address (``www.`` and ``m.``
hosts, tracking parameters, trailing slash, ``index.html``, ``.html``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import materialize
from patchprofile.llm.components import components
from patchprofile.llm.html_text import page_links

#: Rule: (host, path, verdict). A rule fits its host and all subdomains when the path starts with its own; the longest wins.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TRACKING = r"(?<=[?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*&?"
def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The place (from 1) in the list of the longest rule that fits, else 0. Rules are configuration: a short list, no table."""
    out = F.lit(0)
    # the shortest first, so that the longest ends outermost
    for k, (h, p, _) in sorted(enumerate(rules), key=lambda r: len(r[1][0] + r[1][1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.lit(k + 1)).otherwise(out)
    return out


def _pick(place: Column, values: list[str]) -> Column:
    return F.when(place > 0, F.element_at(F.array(*(F.lit(v) for v in values)), F.greatest(place, F.lit(1))))


def no_dots(path: Column) -> Column:
    """A path that begins with ``/`` without its ``.`` and ``..`` segments, as RFC 3986 removes them."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/", -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc)
                       .when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, x)))
    end = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), end)).otherwise(path)


def _resolved(rows: DataFrame) -> DataFrame:
    """``page, target`` from ``page, url, href``: the absolute URL that ``href`` names as seen from ``url``, without dot segments. A column a
    step: nested in one expression they would be worked out again at each mention."""
    rows = rows.withColumn("top", F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)).withColumn("at", path_of(F.col("url"))).where(F.length("top") > 0)
    rows = rows.withColumn("at", F.when(F.col("at") == "", "/").otherwise(F.col("at")))
    href, top, at = F.col("href"), F.col("top"), F.col("at")
    full = (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href).when(href.startswith("//"), F.concat(F.regexp_extract("url", r"(?s)^(.*?:)//", 1), href))
            .when(href.startswith("/"), F.concat(top, href)).when(href.startswith("?"), F.concat(top, at, href))
            .when((href == "") | href.startswith("#"), F.concat(top, at, _query_of(F.col("url")), href))
            .otherwise(F.concat(top, F.regexp_replace(at, r"[^/]*$", ""), href)))
    rows = rows.select("page", full.alias("full"))
    rows = rows.select("page", F.regexp_extract("full", r"(?s)^(.*?://[^/?#]*)", 1).alias("start"), path_of(F.col("full")).alias("path"), F.regexp_extract("full", r"(?s)^.*?://[^?#]*(.*)$", 1).alias("tail"))
    return rows.select("page", F.concat("start", F.when(F.col("path") == "", "").otherwise(no_dots(F.col("path"))), "tail").alias("target"))


def links(pages: DataFrame) -> DataFrame:
    """``url, target`` (absolute) for every canonical link and refresh redirect of each page: tags outside of comments and scripts, entities
    decoded, references resolved against the page's ``<base>``, else its address. What names another scheme without ``//`` (``mailto:``)
    is no address. Only pages that hold one of the words at all leave the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                found = [(u, base, h) for u, page in zip(b.column("url").to_pylist(), b.column("html").to_pylist()) for base, h in page_links(page)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in range(3)], names=["page", "base", "href"])

    some = pages.where("url IS NOT NULL AND html IS NOT NULL").where(F.col("html").rlike("(?i)canonical|refresh"))
    rows = some.select("url", "html").mapInArrow(run, "page string, base string, href string")
    rows = rows.where(~F.col("href").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:(?!//)"))
    plain = rows.where("base IS NULL").select("page", F.col("page").alias("url"), "href")
    # a base is itself a reference, seen from the page; the link is carried along in its place
    based = rows.where("base IS NOT NULL").select(F.struct("page", "href").alias("page"), F.col("page").alias("url"), F.col("base").alias("href"))
    based = _resolved(based).select("page.page", F.col("target").alias("url"), "page.href")
    return _resolved(plain.unionByName(based)).withColumnRenamed("page", "url")


def node_of(url: Column) -> Column:
    return F.concat(host_of(url), F.when(path_of(url) == "", "/").otherwise(path_of(url)), _query_of(url))


def usual_form(url: Column) -> Column:
    """The address the usual redirects of one site lead to."""
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(?:/index)?(?:\.html?)?/*$", "")
    query = F.regexp_replace(F.regexp_replace(_query_of(url), _TRACKING, ""), r"[?&]+$", "")
    return F.concat(host, F.when(path == "", "/").otherwise(path), query)


def judge(pages: DataFrame, rules=RULES, usual_redirects: bool = False) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id, url, html``).

    A page with a rule gets its verdict. Another is blocked when its component has a blocked address and no
    explicitly allowed one, else allowed; addresses named only by links are judged by the rules as well. Null urls and
    urls without ``://``: empty host and path, no rule, allowed. Null html has no links. Repeated rows and
    other columns don't matter.
    """
    url = F.col("url")
    named = [f"{h}{p}" for h, p, _ in rules]
    said = [v for *_, v in rules]
    base = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path")).withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    real = pages.where("url IS NOT NULL AND instr(url, '://') > 0")
    found = materialize(links(real), "url-links")  # written once: the pages are searched once, and the targets are plain columns
    edges = found.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"))
    if usual_redirects:
        both = real.select("url").unionByName(found.select(F.col("target").alias("url")))
        edges = edges.unionByName(both.select(node_of(url).alias("a"), usual_form(url).alias("b")))
    edges = materialize(edges.where("a <> b").distinct(), "url-edges")
    member = materialize(components(edges, "url-cc"), "url-members")
    # a node reads as a URL again: its host and path decide its rule
    host, path = F.regexp_extract("node", r"(?s)^([^/?]*)", 1), F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1)
    state = (member.withColumn("_v", _pick(rule_of(host, path, rules), said))
             .groupBy("component").agg(F.max(F.col("_v") == "allow").alias("ok"), F.max(F.col("_v") == "block").alias("bad")))
    bad = member.join(state.where("bad AND NOT coalesce(ok, false)").select("component"), "component").select(F.col("node").alias("_node"))
    own = F.when(F.length("host") > 0, node_of(url))
    out = base.withColumn("_n", own).join(bad.withColumn("_bad", F.lit(True)), F.col("_n") == F.col("_node"), "left")
    return out.select(F.col("page_id").cast("long").alias("page_id"), "host", "path", _pick(F.col("_r"), named).alias("rule"),
                      F.coalesce(_pick(F.col("_r"), said), F.when(F.col("_bad"), "block"), F.lit("allow")).alias("verdict"))
