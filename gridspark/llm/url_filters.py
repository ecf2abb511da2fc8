"""Operator 3: url rules indexed by their rarest literal token.

A rule allows or blocks a host, its subdomains, and the paths that start with the rule's.  Each rule becomes a regular
expression over ``host/path`` and a set of literal tokens (labels of the host, whole segments of the path) that any url it
fits must hold.  A count over all urls tells how many hold each of the rules' tokens; a rule is filed under its rarest.
A url's own tokens fetch the candidates, and only those run their regular expressions.  Of the rules that fit, the
longest decides; none: the default verdict.  Only the rules are broadcast, and their number is checked; the counting
scan gathers one row for each of the rules' tokens.

Defined results: a null url, or one without ``://``, has an empty host and path, which no rule fits.  Repeated rows are
judged row by row; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_batches

SCHEMA = "page_id long, host string, path string, rule string, verdict string"
MAX_RULES = 1_000_000
DEFAULT = "allow"
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def pattern(self) -> re.Pattern:
        return re.compile(rf"(?:[^/]*\.)?{re.escape(self.host)}\n{re.escape(self.path)}", re.S)

    def literals(self) -> set[str]:
        """Tokens of every url that the rule fits: all labels, and the path's segments that end inside it."""
        return {f"h:{x}" for x in self.host.split(".")} | {f"p:{x}" for x in self.path.split("/")[1:-1]}


#: The production rules (fixed values).
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def parts(url: str | None) -> tuple[str, str]:
    m = _URL.search(url or "")
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


def tokens(host: str, path: str) -> set[str]:
    return {f"h:{x}" for x in host.split(".")} | {f"p:{x}" for x in path.split("/")[1:]}


def build_index(rules: Iterable[Rule], counts: dict[str, int]) -> dict[str, list[tuple[Rule, re.Pattern]]]:
    """Rarest token -> its rules, the longest first; rules as long as each other by their place in the list."""
    index = defaultdict(list)
    for r in sorted(rules, key=lambda r: -len(r.text)):
        index[min(r.literals(), key=lambda t: (counts.get(t, 0), t))].append((r, r.pattern()))
    return dict(index)


def judge(host: str, path: str, index: dict, default: str) -> tuple[str | None, str]:
    found = [r for t in tokens(host, path) for r, fits in index.get(t, ()) if fits.match(f"{host}\n{path}")]
    if not found:
        return None, default
    best = max(found, key=lambda r: (len(r.text), r.text))
    return best.text, best.verdict


def token_counts(pages: DataFrame, wanted: set[str]) -> dict[str, int]:
    """How many urls hold each wanted token, over all pages."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = Counter(t for u in batch.column("url").to_pylist() for t in tokens(*parts(u)) & wanted)
        return pa.RecordBatch.from_pydict({"token": pa.array(list(n), pa.string()), "n": pa.array(list(n.values()), pa.int64())})

    rows = map_batches(pages.select("url"), run, "token string, n long", text="url").groupBy("token").sum("n").collect()
    return {token: n for token, n in rows}


def url_filters(pages: DataFrame, rules: Iterable[Rule] = RULES, default: str = DEFAULT) -> DataFrame:
    """One row for each of pages(page_id, url): its host, path, deciding rule and verdict."""
    rules = tuple(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    index = pages.sparkSession.sparkContext.broadcast(build_index(rules, token_counts(pages, {t for r in rules for t in r.literals()})))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        where = [parts(u) for u in batch.column("url").to_pylist()]
        said = [judge(*w, index.value, default) for w in where]
        columns = [[w[0] for w in where], [w[1] for w in where], [s[0] for s in said], [s[1] for s in said]]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array(c, pa.string()) for c in columns)], names=["page_id", "host", "path", "rule", "verdict"])

    return map_batches(pages.selectExpr("cast(page_id as long) page_id", "url"), run, SCHEMA, text="url")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP3_SQL = r"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from u),
p as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from h),
f as (select *, case
    when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
    when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
    when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
    when (host = 'com' or host like '%.com') and path like '/%' then 'com/' end as rule from p)
select page_id, host, path, rule, case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict from f
"""
