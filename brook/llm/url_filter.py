"""URL filters: pattern rules indexed by their rarest literal token.

Rules are regular expressions over host + path. A rule's whole literal tokens (runs of a-z and 0-9 that the pattern
delimits on both sides) are counted in the URLs of the table; the rule is filed under its rarest one. A URL's
tokens fetch the rules filed under them, and only those run their expression; rules without a whole token run always.

The decision: among host rules that fit, the longest wins (of equal length the one that sorts first). Without one,
among the method's own patterns an allow pattern wins over a block pattern, and the first in order of the list;
without any, the URL is allowed.

Defined cases: null URLs and URLs without "://" have empty host and path; nothing fits those, so they are allowed.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm.common import carried, table

ALLOW, BLOCK = "allow", "block"
#: Host rules of the contract: (verdict, host, path).
HOST_RULES = ((BLOCK, "net", "/"), (ALLOW, "example.net", "/en/"), (BLOCK, "example.com", "/de/"), (ALLOW, "org", "/fr/"))
#: The method's own patterns: verdict and a pattern in which * is any run, | a start or end, and ^ a separator (or the
#: end); || starts at a host or one of its subdomains.
PATTERNS = (
    (ALLOW, "||docs.^"), (ALLOW, "||developer.^"), (ALLOW, "/wiki/"), (ALLOW, "/documentation/"), (ALLOW, "/licenses/"),
    (BLOCK, "||spam-farm.^"), (BLOCK, "||cheap-pills.^"), (BLOCK, "||ads.^"), (BLOCK, "||adserver.^"),
    (BLOCK, "||banners.^"), (BLOCK, "||tracker.^"), (BLOCK, "||tracking.^"), (BLOCK, "||click.^"), (BLOCK, "||pixel.^"),
    (BLOCK, "||telemetry.^"), (BLOCK, "||affiliate.^"), (BLOCK, "||porn.^"), (BLOCK, "||xxx.^"), (BLOCK, "||warez.^"),
    (BLOCK, "||torrent.^"), (BLOCK, "spam-farm"), (BLOCK, "cheap-pills"), (BLOCK, "online-casino"), (BLOCK, "casino-bonus"),
    (BLOCK, "free-porn"), (BLOCK, "adult-dating"), (BLOCK, "payday-loan"), (BLOCK, "buy-followers"),
    (BLOCK, "replica-watches"), (BLOCK, "/ads/"), (BLOCK, "/advert/"), (BLOCK, "/adclick/"), (BLOCK, "/banner/*.gif|"),
    (BLOCK, "/popunder/"), (BLOCK, "/wp-login.php"), (BLOCK, "/xmlrpc.php"), (BLOCK, "/cgi-bin/"), (BLOCK, "/login^"),
    (BLOCK, "/signup^"), (BLOCK, "/cart^"), (BLOCK, "/checkout^"), (BLOCK, "/porn/"), (BLOCK, "/xxx/"),
    (BLOCK, "/casino/"), (BLOCK, "/viagra"), (BLOCK, ".exe|"), (BLOCK, ".apk|"), (BLOCK, ".torrent|"),
)


@dataclass(frozen=True)
class Rule:
    """name; expression over host + path, matched from its start; the literal tokens it cannot match without."""

    name: str
    verdict: str
    expression: str
    tokens: tuple[str, ...]
    host_rule: bool = False
    compiled: re.Pattern = field(init=False, compare=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "compiled", re.compile(self.expression, re.S))


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with the rule's path."""
    tokens = re.findall("[0-9a-z]+", host) + re.findall("(?<=/)[0-9a-z]+(?=/)", path)
    return Rule(host + path, verdict, "(?:[^/]*[.])?" + re.escape(host) + re.escape(path), tuple(tokens), True)


def pattern_rule(verdict: str, pattern: str) -> Rule:
    body, lead, tail = pattern, "(?:.*)", ""
    if body.startswith("||"):
        body, lead = body[2:], "(?:[^/]*[.])?"
    elif body.startswith("|"):
        body, lead = body[1:], ""
    if body.endswith("|"):
        body, tail = body[:-1], "$"
    anchored = not lead.startswith("(?:.*")
    parts = {"*": ".*", "^": "(?:[^0-9a-zA-Z_.%-]|$)"}
    expression = lead + "".join(parts.get(c, re.escape(c)) for c in body).replace("\\.(?:", "[.](?:") + tail
    if pattern.startswith("||") and body.endswith(".^"):  # a label of the host, with anything behind it
        expression = lead + re.escape(body[:-1]) + "[^/]*"
        tokens = re.findall("[0-9a-z]+", body)
    else:
        tokens = [m[0] for m in re.finditer("[0-9a-z]+", body)
                  if (m.start() > 0 and body[m.start() - 1] != "*" or m.start() == 0 and anchored)
                  and (m.end() < len(body) and body[m.end()] != "*" or m.end() == len(body) and tail)]
    return Rule(pattern, verdict, expression, tuple(tokens))


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(*p) for p in PATTERNS]


def split(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL by the contract."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = re.search("[/?#]", rest)
    at = end.start() if end else len(rest)
    path = re.match("[^?#]*", rest[at:], re.S)[0]
    return _lower(rest[:at]), path


_LOWER = {c: c + 32 for c in range(65, 91)}


def _lower(s: str) -> str:
    return s.lower() if s.isascii() else s.translate(_LOWER)


_TOKENS = re.compile("[0-9a-z]+")


class Index:
    """Rules by their rarest token."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple[int, Rule]]] = {}
        for n, r in enumerate(rules):
            rarest = min(r.tokens, key=lambda t: (counts.get(t, 0), t), default="")
            self.by_token.setdefault(rarest, []).append((n, r))
        self.always = self.by_token.pop("", [])

    def decide(self, host: str, path: str) -> tuple[Rule | None, Rule | None]:
        """The host rule and the pattern rule that win."""
        if not host and not path:
            return None, None
        where = host + path
        candidates = list(self.always)
        for t in set(_TOKENS.findall(_lower(where))):
            candidates += self.by_token.get(t, ())
        fit = [(n, r) for n, r in candidates if r.compiled.match(where)]
        hosts = [r for _, r in fit if r.host_rule]
        own = [(r.verdict != ALLOW, n, r) for n, r in fit if not r.host_rule]
        return (min(hosts, key=lambda r: (-len(r.name), r.name), default=None),
                min(own, key=lambda x: x[:2], default=(0, 0, None))[2])


def token_counts(pages: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many URLs hold each token of the rules; as many rows as rules have tokens."""
    wanted = sorted({t for r in rules for t in r.tokens})
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("url"), F.lit("([0-9a-z]+)"), F.lit(1)))
    rows = (pages.select(F.explode(F.array_intersect(tokens, F.array(*map(F.lit, wanted)))).alias("t"))
            .groupBy("t").count().collect())
    return Counter({r.t: r["count"] for r in rows})


def judge(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """page_id, host, path, the host rule, the verdict and the pattern of every URL."""
    rules = default_rules() if rules is None else rules
    counts = token_counts(pages, rules)
    schema = carried(pages, ["page_id"], "host string, path string, rule string, verdict string, pattern string")
    index: list[Index] = []

    def run(batches):
        if not index:
            index.append(Index(rules, counts))
        for batch in batches:
            out = []
            for url in batch.column("url").to_pylist():
                host, path = split(url)
                a, b = index[0].decide(host, path)
                won = a or b
                out.append((host, path, a and a.name, won.verdict if won else ALLOW, b and b.name))
            columns = [pa.array(c, pa.string()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.string())] * 5
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *columns], names=schema.names)

    return pages.select("page_id", "url").mapInArrow(run, schema)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _sql() -> str:
    """Every rule's expression on every URL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ",\n  ".join(f"({n}, {quote(r.name)}, {quote(r.verdict)}, {quote('^(?:' + r.expression + ')')}, {r.host_rule})"
                        for n, r in enumerate(default_rules()))
    return f"""
WITH rules(n, name, verdict, expression, host_rule) AS (VALUES
  {rows}),
cut AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, row_number() OVER () AS k,
  coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path FROM cut),
fit AS (SELECT k, n, name, verdict, host_rule FROM parts JOIN rules ON host || path <> ''
        AND regexp_matches(host || path, expression, 's')),
hosts AS (SELECT k, name, verdict FROM fit WHERE host_rule
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY length(name) DESC, name) = 1),
own AS (SELECT k, name, verdict FROM fit WHERE NOT host_rule
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY verdict, n) = 1)
SELECT page_id, host, path, h.name AS rule, coalesce(h.verdict, o.verdict, 'allow') AS verdict, o.name AS pattern
FROM parts LEFT JOIN hosts h USING (k) LEFT JOIN own o USING (k)
"""


OP1_SQL = _sql()
