"""URL filter with redirect equivalence.

Explicit rules decide the URLs they fit, the longest rule first. Block decisions then reach
the aliases of a URL: URLs linked by redirects or canonical links form components, found with
distributed connected components, and a component with a blocked URL is blocked. An explicit
allow keeps its own URL allowed whatever its aliases are.

Everything is DataFrame functions. A URL's identity in the alias graph is its lower-cased
host and all that follows it up to ``#``; the scheme does not count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import components

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Characters of URLs with the names of their character references.
PUNCTUATION = [
    ("/", "sol"), (":", "colon"), ("?", "quest"), ("=", "equals"), ("#", "num"), (".", "period"),
    ("%", "percnt"), ("+", "plus"), ("_", "lowbar"), (";", "semi"), (",", "comma"), ("-", "hyphen"),
]


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, and a prefix of the path; ``allow`` or ``block``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_key(url: Column) -> Column:
    """Identity of a URL in the alias graph; null without a host."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    host = url_host(url)
    slash = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host != "", F.concat(host, slash))


def rule_column(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does.

    Longest means most characters of host and path together; of equals, allow comes first.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.verdict))
    result = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(ordered):
        at_host = (host == rule.host) | host.endswith("." + rule.host)
        fits = at_host & path.startswith(rule.path)
        answer = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        result = F.when(fits, answer).otherwise(result)
    return result


def decoded(text: Column) -> Column:
    """Character references of markup and punctuation, by name or number; ``&amp;`` last."""
    for char, names in (("<", "lt"), (">", "gt"), ('"', "quot"), ("'", "apos"), *PUNCTUATION):
        n = ord(char)
        text = F.regexp_replace(text, f"(?i)&(?:{names}|#0*{n}|#x0*{n:x});", char)
    return F.regexp_replace(text, "(?i)&(?:amp|#0*38|#x0*26);", "&")


def without_dots(path: Column) -> Column:
    """A path that begins with a slash, without its ``.`` and ``..`` segments."""
    segments = F.split(F.regexp_replace(path, r"/(\.\.?)$", "/$1/"), "/")

    def step(done: Column, segment: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return (
            F.when(segment == "..", shorter)
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    return F.array_join(F.aggregate(segments, F.array().cast("array<string>"), step), "/")


def resolved(target: Column, base: Column) -> Column:
    """A target as seen from a URL; null for other schemes and for parts of a URL without host."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?):", 1)
    host, path = url_host(base), url_path(base)
    root = F.concat(scheme, F.lit("://"), host)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.regexp_extract(base, r"(?s)^[^?#]*(\?[^#]*)", 1)
    target_path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)", 1)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    full = F.when(target.startswith("/"), target_path).otherwise(F.concat(folder, target_path))
    inside = (
        F.when(target.startswith("#"), F.concat(root, path, query, target))
        .when(target.startswith("?"), F.concat(root, path, target))
        .otherwise(F.concat(root, without_dots(full), rest))
    )
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(host != "", inside)
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Alias links (src, dst) that pages declare: canonical links and meta refresh redirects.

    Relative targets are resolved against the page's ``<base href>`` or else its URL. Null html, pages without such markup and pages without a host give no row.
    """
    tag = F.explode(
        F.regexp_extract_all(
            F.coalesce(F.col(html), F.lit("")), F.lit(r"(?is)(<(?:link|meta)\s[^>]*>)"), 1
        )
    )
    tags = pages.where(F.col(html).rlike(r"(?i)<(?:link|meta)\s")).select(
        F.col(url).alias("src"),
        F.regexp_extract(html, r"""(?is)<base\s(?:[^>]*?\s)?href\s*=\s*["']?([^"'\s>]+)""", 1).alias("base"),
        tag.alias("tag"),
    )
    t = F.col("tag")
    href = F.regexp_extract(t, r"""(?is)\shref\s*=\s*["']?([^"'\s>]+)""", 1)
    canonical = F.when(t.rlike(r"""(?is)\srel\s*=\s*["']?[^"'>]*\bcanonical\b"""), href)
    refresh = F.when(
        t.rlike(r"""(?is)\shttp-equiv\s*=\s*["']?refresh\b"""),
        F.regexp_extract(t, r"""(?is)\scontent\s*=\s*["']?[^>]*?url\s*=\s*'?([^"'\s>]+)""", 1),
    )
    target = decoded(F.coalesce(canonical, refresh))
    found = tags.select("src", "base", target.alias("dst")).where(F.col("dst") != "")
    own_base = resolved(decoded(F.col("base")), F.col("src"))
    base = F.when(F.col("base") != "", F.coalesce(own_base, "src")).otherwise(F.col("src"))
    dst = resolved(F.col("dst"), F.col("base"))
    found = found.select("src", base.alias("base"), "dst")
    return found.select("src", dst.alias("dst")).where(F.col("dst").isNotNull())


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    links: DataFrame | None = None,
    url: str = "url",
) -> DataFrame:
    """Every row of ``pages`` with its judgement in one struct column ``judged``.

    ``judged`` has host, path, rule (null if none fits) and verdict. ``links`` (src, dst) are
    redirects and canonical links; rows with a null or host-less end are ignored. URLs that
    occur only in links are judged by the rules too and can block their aliases. Null URLs
    and URLs without ``://`` have an empty host and path, fit no rule and are allowed.
    Repeated rows are judged alike; other columns pass through whatever their names are.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")
    u = F.col(f"`{url}`")
    host, path = url_host(u), url_path(u)
    ruled = pages.select(
        row, host.alias("host"), path.alias("path"), rule_column(host, path, rules).alias("hit")
    )
    if links is None:
        blocked = F.lit(False)
        joined = ruled
    else:
        # Rows without a host match nothing; numbering them keeps them out of one task.
        lone = F.concat(F.lit(" "), F.monotonically_increasing_id().cast("string"))
        joined = ruled.withColumn("key", F.coalesce(url_key(F.col(f"row.`{url}`")), lone))
        joined = joined.join(_blocked_keys(links, rules), "key", "left")
        blocked = F.col("alias_blocked").isNotNull()
    verdict = F.coalesce(
        "hit.verdict", F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    )
    judged = F.struct("host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"))
    return joined.select("row", judged.alias("judged"))


def _blocked_keys(links: DataFrame, rules: list[Rule]) -> DataFrame:
    """URL keys (key, alias_blocked) in components that hold a blocked URL."""
    pairs = links.select(url_key(F.col("src")).alias("a"), url_key(F.col("dst")).alias("b"))
    nodes = components(pairs)
    # A key is a URL without its scheme, so the same expressions judge it.
    as_url = F.concat(F.lit("x://"), "key")
    labelled = nodes.withColumnRenamed("node", "key").withColumn(
        "hit", rule_column(url_host(as_url), url_path(as_url), rules)
    )
    bad = (
        labelled.where(F.col("hit.verdict") == "block")
        .select("component")
        .distinct()
        .withColumn("alias_blocked", F.lit(True))
    )
    return labelled.join(bad, "component").select("key", "alias_blocked")
