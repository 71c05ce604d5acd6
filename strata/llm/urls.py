"""URL filters (operator 1).

A rule is a host and a path, like ``example.com/en/``. It fits its host and all
subdomains, if the URL's path starts with the rule's.

A URL is expanded into expressions: every suffix of its host at a dot, with
every prefix of its path that ends in a slash (and the empty one). A rule is
filed under its host and its path up to the last slash, so each rule that can fit
is filed under one of the URL's expressions. Expressions and rules meet in an
equi-join on the first ``PREFIX`` hex digits of their SHA-256; equal full digests
and the rest of the rule's path then confirm a match. Of the rules that fit, the
longest wins; of equally long ones the one with the longer host, then a block.

URLs of a host that holds a third of all rows would meet in one task: the join
key holds a salt, a hash of the URL and its id modulo ``SALTS``, and the rules
are copied once a salt. Spark broadcasts the rules instead where their size
allows. All matches of a row come from one task, so the choice among them is
made before the shuffle.

Defined results: a null URL or one without ``://`` has an empty host and path
and no rule, so the default verdict; repeated rows are judged and returned as
often as they occur; a null id is an id like any other; extra columns are
ignored; an empty table or list of rules gives no rows or no matches.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, table

PREFIX = 8
SALTS = 16
ALLOW, BLOCK = "allow", "block"
RULES = (
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
)
_RULE = "rule string, verdict string"


def rules_frame(spark, rules: Iterable[tuple[str, str]] = RULES) -> DataFrame:
    """``rule, verdict`` rows as a frame (a large list is read from a table)."""
    return spark.createDataFrame(list(rules), _RULE)


def host_and_path(url) -> tuple:
    """Columns: the lower-cased host and the path of a URL column."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), r"^([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def _digest(host, path):
    # a host holds no slash, so host and path can be told apart
    return F.sha2(F.concat(host, F.lit("/"), path), 256)


def host_suffixes(host, most: int):
    """The suffixes of at most ``most`` labels."""
    parts = F.split(host, r"\.", -1)
    first = F.greatest(F.lit(1), F.size(parts) - most + 1)
    return F.transform(F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def path_prefixes(path, most: int):
    """The empty prefix and those that end in one of the first ``most`` slashes."""
    parts = F.split(path, "/", -1)
    ends = F.slice(F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(most))), 2, most + 1)
    return F.concat(
        F.array(F.lit("")), F.transform(ends, lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    )


def filed(rules: DataFrame) -> DataFrame:
    """Rules with their host, path, digest and hash prefix."""
    cut = F.instr("rule", "/")
    host = F.when(cut > 0, F.substring("rule", F.lit(1), cut - 1)).otherwise(F.col("rule"))
    path = F.when(cut > 0, F.substring(F.col("rule"), cut, F.length("rule"))).otherwise(F.lit(""))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    digest = _digest(F.col("rule_host"), F.regexp_extract(F.col("rule_path"), r"^(.*/)?", 0))
    return (
        rules.select(F.col("rule"), F.col("verdict"), lower.alias("rule_host"), path.alias("rule_path"))
        .where(F.col("rule").isNotNull())
        .groupBy("rule", "rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))  # a rule listed twice: block before allow
        .withColumn("rule_digest", digest)
        .withColumn("prefix", F.substring("rule_digest", 1, PREFIX))
    )


def judge(
    pages: DataFrame, rules: DataFrame, *, page_id: str = "page_id", url: str = "url", default: str = ALLOW, salts: int = SALTS
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``;
    ``rules`` has the columns ``rule`` and ``verdict`` (allow or block)."""
    host, path = host_and_path(F.col("_url"))
    rows = (
        pages.select(col(page_id).alias("page_id"), col(url).cast("string").alias("_url"))
        .withColumns({"host": host, "path": path, "salt": F.pmod(F.xxhash64("page_id", "_url"), F.lit(salts)).cast("int")})
        .drop("_url")
    )
    listed = filed(rules)
    depth = listed.agg(
        F.max(F.size(F.split("rule_host", r"\."))), F.max(F.size(F.split("rule_path", "/")) - 1)
    ).first()  # no URL needs more labels or slashes than the rules have
    each = rows.withColumn("host_part", F.explode(host_suffixes(F.col("host"), depth[0] or 1))).withColumn(
        "path_part", F.explode(path_prefixes(F.col("path"), depth[1] or 0))
    )
    keyed = each.withColumn("digest", _digest(F.col("host_part"), F.col("path_part"))).withColumn(
        "prefix", F.substring("digest", 1, PREFIX)
    )
    salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    match = F.struct(F.length("rule").alias("length"), F.length("rule_host").alias("host_length"), "verdict", "rule")
    matches = (
        keyed.join(salted, ["prefix", "salt"])
        .where((F.col("rule_digest") == F.col("digest")) & F.startswith(F.col("path"), F.col("rule_path")))
        .select("page_id", "host", "path", F.lit(0).cast("long").alias("n"), match.alias("best"))
    )
    itself = rows.select("page_id", "host", "path", F.lit(1).cast("long").alias("n"))
    judged = (
        itself.unionByName(matches, allowMissingColumns=True)
        .groupBy("page_id", "host", "path")
        .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    )
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("_n"),
    ).drop("_n")


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    """Query: the verdict on every page's URL."""
    return judge(table(spark, sf_dir, "pages"), rules_frame(spark))


ORACLE = """
WITH p AS (
  SELECT page_id,
    CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after
  FROM pages
), q AS (
  SELECT page_id, translate(regexp_extract(after, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(after, length(regexp_extract(after, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM p
), r(rule, rhost, rpath, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
    ('net/fr/', 'net', '/fr/', 'block')
), m AS (
  SELECT q.page_id, q.host, q.path, r.rule, r.verdict,
    row_number() OVER (PARTITION BY q.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS k
  FROM q LEFT JOIN r ON (q.host = r.rhost OR ends_with(q.host, '.' || r.rhost)) AND starts_with(q.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
