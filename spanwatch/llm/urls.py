"""URL filters: pattern rules indexed by their rarest literal token, fetched by the tokens of each URL."""

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.llm.scratch import free_names

TOKEN = "[a-z0-9]+"  # of a subject in lower case; everything else parts tokens
ANY = ""  # the token of rules without a literal one; every URL fetches them
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What ends a literal in a pattern. A group, a class or an escape other than of a mark may stand for anything.
_LITERAL = re.compile(r"\\([^A-Za-z0-9])|([^\\\[\](){}.*+?|^$])")
# A class of marks alone, once at least: it parts tokens.
_MARKS = re.compile(r"\[[^\]\\^A-Za-z0-9-]+\](?![*?{])")


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched for in a URL's subject; ``name`` tells the rule apart.

    Of the rules that a URL fits, those with a ``host`` come first, then those with the
    longest ``weight``, then ``allow`` before ``block``, then the least name.
    """

    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    host: bool = False
    weight: int = 0


def _tokens(literal: str, starts: bool, ends: bool) -> set[str]:
    """Whole tokens of a literal; those at its edges count where nothing can go on there."""
    found = set()
    for m in re.finditer(TOKEN, literal.lower()):
        if (m.start() or starts) and (m.end() < len(literal) or ends):
            found.add(m.group())
    return found


def literal_tokens(pattern: str) -> tuple[str, ...]:
    """Tokens that every subject has in which ``pattern`` is found, as far as its plain text tells.

    Only text outside of groups and classes counts, and none where the pattern has alternatives
    outside of groups. A repeated or optional character ends the text before it.
    """
    found: set[str] = set()
    literal, starts, at = "", False, 0

    def close(ends: bool = False) -> None:
        nonlocal literal, starts
        found.update(_tokens(literal, starts, ends))
        literal, starts = "", False

    while at < len(pattern):
        plain = _LITERAL.match(pattern, at)
        c = pattern[at]
        if plain:
            literal += plain.group(1) or plain.group(2)
            at = plain.end()
            continue
        if c == "|":
            return ()
        if c in "*?+{":
            literal = literal[:-1]
            close()
            at = pattern.index("}", at) + 1 if c == "{" else at + 1
            continue
        edge = _MARKS.match(pattern, at)
        close(ends=edge is not None or c == "$" or pattern.startswith("\\z", at))
        starts = edge is not None or c == "^"
        if c == "\\":
            at += 2
        elif c == "[":
            at = _class_end(pattern, at)
        elif c == "(":
            at = _group_end(pattern, at)
        else:
            at += 1
    close()
    return tuple(sorted(found))


def _class_end(pattern: str, at: int) -> int:
    at += 2 if pattern[at + 1] == "^" else 1
    first = at
    while pattern[at] != "]" or at == first:
        at += 2 if pattern[at] == "\\" else 1
    return at + 1


def _group_end(pattern: str, at: int) -> int:
    depth = 0
    while True:
        c = pattern[at]
        if c == "\\":
            at += 2
            continue
        if c == "[":
            at = _class_end(pattern, at)
            continue
        depth += (c == "(") - (c == ")")
        at += 1
        if not depth:
            return at


def pattern_rule(pattern: str, verdict: str = "block") -> Rule:
    """A rule by a regular expression over the subject: the host in lower case and all that follows it."""
    return Rule(pattern, pattern, verdict, literal_tokens(pattern), weight=len(pattern))


def label_rule(label: str, verdict: str = "block") -> Rule:
    """A rule for hosts with a label, in any place but the last, that fits the pattern ``label``."""
    pattern = rf"^(?:[^/?#]*\.)?{label}\."
    return Rule(pattern, pattern, verdict, literal_tokens(rf"^{label}\."), weight=len(pattern))


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host and its subdomains, and paths that start with ``path``; the longest one wins."""
    plain = re.sub(r"([^A-Za-z0-9])", r"\\\1", host), re.sub(r"([^A-Za-z0-9])", r"\\\1", path)
    end = "" if path else r"(?:[/?#]|\z)"
    tokens = _tokens(host, True, True) | _tokens(path, False, False)
    return Rule(host + path, rf"^(?:[^/?#]*\.)?{plain[0]}{plain[1]}{end}", verdict, tuple(sorted(tokens)),
                host=True, weight=len(host + path))


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lowered), path and subject of a URL; empty for null and for one without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$", i), F.lit(""))
    host = F.translate(part(1), UPPER, LOWER)
    return host, part(2), F.concat(host, part(2), part(3))


def _rules(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    rows = [(r.name, r.pattern, r.verdict, list(r.tokens), r.host, r.weight) for r in rules]
    names = [r[0] for r in rows]
    if len(set(names)) < len(names):
        raise ValueError("rules need different names")
    for r in rows:
        if r[2] not in ("allow", "block"):
            raise ValueError(f"{r[0]}: {r[2]} is neither allow nor block")
    return spark.createDataFrame(
        rows, "name string, pattern string, verdict string, tokens array<string>, host boolean, weight int"
    )


def rule_index(seen: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under the one of its tokens that the fewest URLs have (``seen``: subject, token).

    Only tokens of rules are counted, and partly before their shuffle. Rules without a token stand
    under ``ANY``.
    """
    offered = rules.select("name", F.explode("tokens").alias("token"))
    counts = seen.join(offered.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = (
        offered.join(counts, "token", "left").groupBy("name")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    return rules.drop("tokens").join(rarest, "name", "left").withColumn("token", F.coalesce("token", F.lit(ANY)))


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """subject and ``best`` rule of each distinct ``subject`` in ``urls`` that fits any of ``rules``.

    A subject's tokens fetch the rules that are indexed under them; only those are run on it.
    """
    subjects = urls.select("subject").distinct()
    # The least token is ANY, so that rules without a token are fetched as well.
    tokens = F.array_distinct(F.regexp_extract_all(F.translate("subject", UPPER, LOWER), F.lit(TOKEN), F.lit(0)))
    seen = subjects.select("subject", F.explode(F.array_append(tokens, F.lit(ANY))).alias("token"))
    fetched = seen.join(rule_index(seen, rules), "token").where(F.expr("rlike(subject, pattern)"))
    order = F.struct(~F.col("host"), -F.col("weight"), "verdict", "name")
    return fetched.groupBy("subject").agg(
        F.min_by(F.struct("name", "verdict", "host"), order).alias("best")
    )


def judge_urls(pages: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with the columns host, path, rule, pattern and verdict.

    ``rule`` is the host rule that decided, or null; ``pattern`` the pattern rule that did where
    there was no host rule, or null; ``verdict`` that rule's, or ``default`` where none fits.
    Columns of these names are replaced. A null url, an empty one and one without ``://`` have
    an empty host and path and fit no rule with a host; a pattern may fit the empty subject.
    Each row is judged, repeated or not; an empty table gives an empty one. Equal URLs are judged
    once, so a hot one is one row, and their rows join the verdict, a join that can be split. No text
    is cut: rules run over the whole URL, which patterns should scan without backtracking.
    """
    spark = pages.sparkSession
    new = ("host", "path", "rule", "pattern", "verdict")
    kept = [c for c in pages.columns if c.lower() not in new]
    subject, best, key, h, p = free_names(kept, "subject", "best", "key", "h", "p")
    host, path, rest = url_parts(F.col(f"`{url}`").cast("string"))
    rows = pages.select(*[f"`{c}`" for c in kept], host.alias(h), path.alias(p), rest.alias(subject))
    found = fitting_rules(rows.select(F.col(f"`{subject}`").alias("subject")), _rules(spark, rules))
    found = found.select(F.xxhash64("subject").alias(key + "_"), F.col("subject").alias(subject + "_"), F.col("best").alias(best))
    # The hash makes both sides be shuffled for the join itself, so that Spark can split a hot URL.
    joined = rows.withColumn(key, F.xxhash64(subject)).join(
        found, (F.col(key) == F.col(key + "_")) & (F.col(subject) == F.col(subject + "_")), "left"
    )
    by_host = F.col(f"{best}.host")
    return joined.select(
        *[f"`{c}`" for c in kept], F.col(h).alias("host"), F.col(p).alias("path"),
        F.when(by_host, F.col(f"{best}.name")).alias("rule"),
        F.when(~by_host, F.col(f"{best}.name")).alias("pattern"),
        F.coalesce(f"{best}.verdict", F.lit(default)).alias("verdict"),
    )


# Hosts and paths that are allowed or blocked.
HOST_RULES = [
    host_rule("org", "/", "allow"), host_rule("example.org", "/es/", "block"),
    host_rule("example.org", "/en/1", "block"), host_rule("com", "/fr/", "allow"), host_rule("com", "/de/", "block"),
]
# Kinds of sites and pages that hold no prose worth keeping.
SPAM_LABELS = [
    r"ads?-track", r"adult-[a-z]+", r"casino-win", r"cheap-pills", r"free-bets", r"spam-farm", r"online-casino",
    r"payday-loans?", r"viagra", r"porn", r"xxx", r"torrents?", r"warez", r"doubleclick",
]
PAGES = [
    r"^[^?#]*/wp-admin/", r"^[^?#]*/wp-login\.php", r"^[^?#]*/cgi-bin/", r"^[^?#]*/login/", r"^[^?#]*/cart/",
    r"^[^#]*[?&]phpsessid=", r"^[^#]*[?&]jsessionid=", r"^[^?#]*\.(?:exe|zip|iso|apk|dmg)(?:[?#]|\z)",
]
PATTERN_RULES = [label_rule(label) for label in SPAM_LABELS] + [pattern_rule(p) for p in PAGES]


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, HOST_RULES + PATTERN_RULES).select("page_id", "host", "path", "rule", "verdict", "pattern")


def _case(rules: list[tuple[str, str]], column: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for test, name in rules) + f" END AS {column}"


def _host_test(rule: str) -> str:
    host, slash, path = rule.partition("/")
    return f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{slash}{path}')"


_PLAIN = sorted(PATTERN_RULES, key=lambda r: (-r.weight, r.name))
ORACLE = f"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(.*)$', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(.*)$', 2), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(.*)$', 3), '') AS tail
  FROM pages
), named AS (
  SELECT page_id, host, path,
    {_case([(_host_test(r.name), r.name) for r in sorted(HOST_RULES, key=lambda r: -r.weight)], "rule")},
    {_case([(f"regexp_matches(host || path || tail, '{r.pattern}')", r.name) for r in _PLAIN], "found")}
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN found END AS pattern,
  CASE {" ".join(f"WHEN rule = '{r.name}' THEN '{r.verdict}'" for r in HOST_RULES)}
    WHEN found IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM named
"""
