"""URL rules, and block decisions that redirects and canonical links carry to aliases.

A rule fits a host with all its subdomains and a beginning of the path. Addresses that no rule
fits take the decision of the addresses they are linked to by redirect or canonical link, at any
distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm.base import settle
from gondola.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(spark: SparkSession, rules: dict[str, str]) -> DataFrame:
    """(rule, rule_host, rule_path, verdict) from ``{"example.com/de/": "block"}``."""
    rows = [(r, r.partition("/")[0].translate(str.maketrans(UPPER, LOWER)), "/" + r.partition("/")[2] if "/" in r else "", v) for r, v in rules.items()]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, verdict string")


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): a page's url and the address that its canonical link or its refresh redirect names.

    Relative addresses are taken against the page's host or folder. Attribute order, quotes and
    case don't matter. Null or empty addresses make no edge.
    """
    html = pages.where(F.lower("html").contains("canonical") | F.lower("html").contains("http-equiv"))
    # Tags, then the address within each.
    links = F.regexp_extract_all("html", F.lit(r"""(?is)<link\s[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""), F.lit(0))
    moves = F.regexp_extract_all("html", F.lit(r"""(?is)<meta\s[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""), F.lit(0))
    targets = F.concat(
        F.transform(links, lambda t: F.regexp_extract(t, r"""(?is)\shref\s*=\s*["']?\s*([^"'\s>]+)""", 1)),
        F.transform(moves, lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1)),
    )
    found = html.select("url", F.explode(targets).alias("to")).where("url is not null and to <> ''")
    found = found.withColumn("to", F.replace("to", F.lit("&amp;"), F.lit("&")))
    scheme, site = F.regexp_extract("url", r"^(?s)(.*?:)//", 1), F.regexp_extract("url", r"^(?s)(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("url", r"^(?s)(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    slash = F.when(folder.endswith("/") & ~folder.endswith("://"), "").otherwise("/")
    to = (
        F.when(F.col("to").contains("://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(scheme, "to"))
        .when(F.col("to").startswith("/"), F.concat(site, "to"))
        .when(F.col("to").startswith("?") | F.col("to").startswith("#"), F.concat(F.regexp_extract("url", r"^(?s)([^?#]*)", 1), "to"))
        .otherwise(F.concat(folder, slash, "to"))
    )
    return found.select(F.col("url").alias("a"), to.alias("b"))


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds (host, path, rule, rule_verdict) to ``urls`` with a column ``url``. Of several fitting
    rules the longest wins; null if none fits. Each host meets the rules once, by its suffixes; the
    rules of a host are looked up for its urls."""
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    hosts = urls.select("host").distinct().withColumn("labels", F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    fits = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host")
    fits = fits.groupBy("host").agg(F.collect_list(F.struct((-F.length("rule")).alias("n"), "rule", "rule_path", "verdict")).alias("rules"))
    mine = F.array_min(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    return urls.join(fits, "host", "left").withColumn("mine", mine).withColumns({"rule": F.col("mine.rule"), "rule_verdict": F.col("mine.verdict")}).drop("mine", "rules")


def address(url: Column) -> Column:
    """One way to write an address, by which links and pages meet: scheme and host in lower case,
    without the scheme's own port, a closing dot of the host, and the fragment; an empty path is
    ``/``. What has no ``://`` stays as it is, but for the fragment."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme = F.lower(F.regexp_extract(plain, r"^(?s)(.*?)://", 1))
    site = F.lower(F.regexp_extract(plain, r"^(?s).*?://([^/?]*)", 1))
    rest = F.regexp_extract(plain, r"^(?s).*?://[^/?]*(.*)$", 1)
    port = F.when(scheme == "http", ":80").when(scheme == "https", ":443").otherwise("")
    site = F.when((port != "") & site.endswith(port), F.substr(site, F.lit(1), F.length(site) - F.length(port))).otherwise(site)
    site = F.regexp_replace(F.regexp_replace(site, r":$", ""), r"\.(:\d+)?$", "$1")
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(plain.contains("://"), F.concat(scheme, F.lit("://"), site, path)).otherwise(plain)


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict): one row per row of ``pages`` (page_id, url).

    An address's own rule decides first. Without one, the addresses that ``edges`` (a, b) connect it
    to decide: allow if a rule allows one of them explicitly, else block if a rule blocks one, else
    allow. Those addresses needn't be pages. Null urls and urls without ``://`` have an empty host
    and path, no rule, and are allowed. Repeated rows stay; other columns don't matter. Very long
    urls are urls like any other. Pages and edges meet whatever the case of scheme and host, and
    with or without fragment and the scheme's own port (see ``address``).
    """
    own = ruled(pages.select("page_id", "url"), rules).withColumn("meeting", address(F.col("url")))
    edges = edges.where("a is not null and b is not null").select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b"))
    members = settle(components(edges), "members").withColumnRenamed("node", "url")
    voices = ruled(members, rules).where("rule is not null")
    heard = voices.groupBy("component").agg(F.max(F.col("rule_verdict") == "allow").alias("allowed"))
    aliases = members.join(heard, "component").select(F.col("url").alias("meeting"), F.when(F.col("allowed"), "allow").otherwise("block").alias("carried"))
    out = own.join(aliases, "meeting", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "carried", F.lit("allow")).alias("verdict"))
