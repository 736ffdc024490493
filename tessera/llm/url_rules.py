"""URL filters: pattern rules indexed by their rarest literal token, DataFrame functions only.

A rule is (rule, kind, verdict).  ``site`` rules are a host and a path written together (``example.net/en/``);
they fit their host and all its subdomains where the url's path starts with theirs.  ``host`` and
``path`` rules are patterns over the host or the path: ``*`` is any run of characters, ``^`` one
character that is no letter or digit, or an end, ``|`` at an end of the rule anchors it there, ``||`` at
its start anchors it at the start of the host or of one of its labels.

Every rule is compiled to a regular expression and to its literal tokens, the runs of ``[a-z0-9]``
that must stand in a fitting url as whole tokens, because both their neighbours in the rule are
known not to be letters or digits.  How many urls hold each of these tokens is counted over the
whole table, and a rule is filed under its rarest one; a rule without such a token is filed under
the empty token, which every url has.  The tokens of a url then fetch its candidate rules, and
only those run their expression.

A fitting site rule decides, the longest one; of equally long ones the first by code points, and
``allow`` where the same rule is given twice.  Without one a fitting pattern decides, ``allow`` before ``block``, then
by length and code points; without any the verdict is ``allow``.

The compiled rules are broadcast while they take at most ``most_bytes``; beyond that they are joined by
shuffle, and the tokens that a thousandth of the urls or more hold are dealt over as many salts as
there are shuffle partitions.

Null urls and urls without ``://`` have an empty host and path, which only a rule that matches
empty text can fit.  Urls of any length are read whole.  Repeated rows are judged each, null ids
like others.  An empty table of urls or rules gives no rows or no fitting rule.  Other columns of
the urls' table are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.tables import reliable

# ---- FIXED VALUES: rules ----------------------------------------------------------------------
SITES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
HOST_PATTERNS = [
    ("||ad.", "block"), ("||ads.", "block"), ("||ads-", "block"), ("||adserver^", "block"), ("||adult^", "block"),
    ("||banner^", "block"), ("||banners^", "block"), ("||bet^", "block"), ("||bets^", "block"), ("-bets.", "block"),
    ("-betting.", "block"), ("||casino^", "block"), ("-casino.", "block"), ("||casinos^", "block"),
    ("||doubleclick.", "block"), ("||malware^", "block"), ("||phishing^", "block"), ("||pills^", "block"),
    ("-pills.", "block"), ("||poker^", "block"), ("||porn^", "block"), ("-porn.", "block"), ("||spam^", "block"),
    ("-spam.", "block"), ("||tracker^", "block"), ("||tracking^", "block"), ("-track.", "block"), ("||viagra^", "block"),
    ("-xxx.", "block"), ("||xxx^", "block"), ("||adult-education^", "allow"), ("||spam-filter^", "allow"),
]
PATH_PATTERNS = [
    ("/ads/", "block"), ("/adserver/", "block"), ("/affiliate/", "block"), ("/affiliates/", "block"), ("/banners/", "block"),
    ("^casino^bonus^", "block"), ("/sponsored/", "block"), ("/wp-login.", "block"), ("|/xxx/", "block"),
]
RULES = [(r, "site", v) for r, v in SITES] + [(r, "host", v) for r, v in HOST_PATTERNS] + [(r, "path", v) for r, v in PATH_PATTERNS]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[a-z0-9]+"


def small(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (after the first ``://``, A-Z lower-cased) and path (then, up to ``?`` or ``#``)."""
    u = F.coalesce(F.col(url), F.lit(""))
    return urls.withColumns({"host": small(F.regexp_extract(u, "://([^/?#]*)", 1)),
                             "path": F.regexp_extract(u, "://[^/?#]*([^?#]*)", 1)})


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """A hand-written rule list as a table; longer lists come from files with these columns."""
    return spark.createDataFrame(rules, "rule string, kind string, verdict string")


def compiled(rules: DataFrame) -> DataFrame:
    """rule, kind, verdict, pattern (regular expression) and tokens of every rule."""
    def quoted(c):
        return F.regexp_replace(c, r"([\\.\[\]{}()+?$|*^])", r"\\$1")
    host = small(F.substring_index("rule", "/", 1))
    path = F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)")
    site = F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted(host), F.when(path == "", F.lit("(?:/|$)")).otherwise(quoted(path)))
    p = F.regexp_replace("rule", r"([\\.\[\]{}()+?$|])", r"\\$1")
    for old, new in ((r"\*", ".*"), (r"\^", "(?:^|[^a-zA-Z0-9]|\\$)"), (r"^\\\|\\\|", r"(?:^|\\.)"), (r"^\\\|", "^"), (r"\\\|$", r"\$")):
        p = F.regexp_replace(p, old, new)
    is_site = F.col("kind") == "site"
    literal = small(F.when(is_site, F.concat(F.lit("."), host, F.when(path == "", F.lit("/")).otherwise(path)))
                    .otherwise(F.col("rule")))
    return rules.where("rule is not null and kind in ('site', 'host', 'path') and verdict in ('allow', 'block')") \
        .select("rule", "kind", "verdict", F.when(is_site, site).otherwise(F.concat(F.lit("(?is)"), p)).alias("pattern"),
                F.array_distinct(F.regexp_extract_all(literal, F.lit(f"(?<=[^a-z0-9*]){TOKEN}(?=[^a-z0-9*])"), F.lit(0))).alias("tokens"))


def url_tokens() -> Column:
    """The distinct tokens of host and path, and the empty one."""
    own = F.regexp_extract_all(small(F.concat("host", "path")), F.lit(f"({TOKEN})"), F.lit(1))
    return F.array_union(F.array(F.lit("")), own)


def token_counts(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """How many of the ``rows`` (host, path, n) hold each token of a rule: token, n_urls."""
    wanted = rules.select(F.explode("tokens").alias("token")).union(rules.sparkSession.createDataFrame([("",)], "token string")).distinct()
    held = rows.select(F.explode(url_tokens()).alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n_urls"))
    return held.join(wanted, "token", "left_semi")


def indexed(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """Every rule with its rarest token (ties: the first by code points; none: the empty token)."""
    first = rules.select("rule", "kind", "verdict", "pattern", F.explode_outer("tokens").alias("token")).join(counts, "token", "left") \
        .groupBy("rule", "kind", "verdict", "pattern") \
        .agg(F.min(F.struct(F.coalesce("n_urls", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token"))).alias("rarest"))
    return first.select("rule", "kind", "verdict", "pattern", F.col("rarest.token").alias("token"))


def _fitting() -> Column:
    """Order of a candidate rule if its expression matches, else null; the least one decides."""
    target = F.when(F.col("kind") == "site", F.concat("host", "path")).when(F.col("kind") == "host", F.col("host")).otherwise(F.col("path"))
    return F.when(F.rlike(target, F.col("pattern")),
                  F.struct((F.col("kind") != "site").alias("method"), ((F.col("kind") != "site") & (F.col("verdict") == "block")).alias("late"),
                           (-F.length("rule")).alias("longest"), "rule", "verdict"))


def judged(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", most_bytes: int = 32 << 20,
           hot_share: float = 0.001) -> DataFrame:
    """One row per url: ``key``, host, path, rule (the site rule that decides), verdict, pattern (the
    pattern that decides where no site rule does)."""
    # equal rows become one with a count, so neither a repeated url nor a repeated row is hot below
    rows = with_parts(urls.select(F.col(key).alias("key"), F.col(url).alias("url")).groupBy("key", "url")
                      .agg(F.count("*").alias("n")), "url")
    known = reliable(compiled(rules))
    counts = reliable(token_counts(rows, known))
    index = reliable(indexed(known, counts))
    asked = rows.select("key", "url", "host", "path", "n", F.explode(url_tokens()).alias("token"))
    size = index.agg(F.coalesce(F.sum(F.length("rule") + F.length("pattern") + F.length("token") + 100), F.lit(0))).first()[0]
    if size <= most_bytes:
        pairs = asked.join(F.broadcast(index), "token", "left")
    else:
        pairs = _joined_by_salt(asked, index, counts, hot_share)
    best = pairs.groupBy("key", "url", "host", "path", "n").agg(F.min(_fitting()).alias("best"))
    by_site = ~F.col("best.method")
    return best.select(F.col("key").alias(key), "host", "path", F.when(by_site, F.col("best.rule")).alias("rule"),
                       F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
                       F.when(F.col("best.method"), F.col("best.rule")).alias("pattern"),
                       F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("_copy")).drop("_copy")


def _joined_by_salt(asked: DataFrame, index: DataFrame, counts: DataFrame, hot_share: float) -> DataFrame:
    """The index by shuffle: frequent tokens of rules are dealt over salts, their rules copied to each.

    A token is hot if ``hot_share`` of the urls hold it, so the hot ones are at most the tokens of
    a mean url / ``hot_share``, a size that does not grow with the table: they may be broadcast.
    """
    salts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = counts.where("token = ''").select(F.col("n_urls").alias("all"))
    hot = counts.join(F.broadcast(urls)).where(F.col("n_urls") >= F.col("all") * hot_share) \
        .join(index.select("token").distinct(), "token", "left_semi").select("token", F.lit(salts).alias("salts"))
    spread = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("key", "url"), F.lit(salts)).cast("int"))
    left = asked.join(F.broadcast(hot), "token", "left").withColumn("salt", spread).drop("salts")
    right = index.join(F.broadcast(hot), "token", "left") \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return left.join(right, ["token", "salt"], "left")


