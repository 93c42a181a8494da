"""URL filters by a sort-merge range join, in DataFrame functions only.

A host is written with its labels reversed and closed by dots (``blog.example.org`` -> ``org.example.blog.``), so that a
host and all its subdomains are one interval of keys. Rule hosts become a start event and an end event; an event carries
the stack of rules that are active from there on: its own rules and those of every enclosing host (start), or those of
the enclosing hosts only (end). One sorted sweep over events and urls hands each url the last stack before it; the
longest rule in the stack whose path starts the url's path wins.

Intervals nest, as they come from prefixes, so the stacks follow from equality joins on a rule host's own prefixes: their
number is the number of its labels. The sweep is split by the first label of the host and by a salt; events are repeated
for each salt, urls are not, so one label, host or url holding a third of all rows is spread over ``salts`` tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainlytics.llm.tables import table
from chainlytics.session import shuffle_width

#: The rules of the query (action, rule).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

#: The verdict where no rule fits.
DEFAULT = "allow"

#: Sorts behind every character of a host; closes the interval of a host and its subdomains.
_LAST = "\U0010ffff"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, lower_ascii(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"(?s)\A[^/?#]*(/[^?#]*)?", 1)).otherwise("")


def reversed_host(host: Column) -> Column:
    """Labels from right to left, each closed by a dot; empty for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(action, rule) pairs as rows: the host up to the first slash, the path from it."""
    rows = spark.createDataFrame(rules, "verdict string, rule string").distinct()
    cut = F.instr("rule", "/")
    return rows.select(
        "rule",
        "verdict",
        reversed_host(lower_ascii(F.expr("substring(rule, 1, instr(rule, '/') - 1)"))).alias("low"),
        F.when(cut > 0, F.substring(F.col("rule"), cut, F.length("rule"))).otherwise("").alias("start_path"),
    )


def stacks(rules: DataFrame) -> DataFrame:
    """Start and end events of the rule hosts: (key, stack), a stack being rules as (path, rule, verdict)."""
    per_host = rules.groupBy("low").agg(F.collect_list(F.struct("start_path", "rule", "verdict")).alias("own"))
    outer = per_host.select(
        F.col("low").alias("inner"),
        F.expr(r"explode(transform(sequence(1, size(split(low, '\\.', -1)) - 1), k -> concat(substring_index(low, '.', k), '.')))").alias("low"),
    )
    chain = outer.join(per_host, "low").select("inner", (F.col("low") == F.col("inner")).alias("self"), "own")
    both = chain.groupBy("inner").agg(
        F.flatten(F.collect_list("own")).alias("open"),
        F.flatten(F.collect_list(F.when(~F.col("self"), F.col("own")))).alias("close"),
    )
    return both.select(F.inline(F.array(F.struct(F.col("inner").alias("key"), F.col("open").alias("stack")), F.struct(F.concat("inner", F.lit(_LAST)).alias("key"), F.col("close").alias("stack")))))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT, salts: int | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict; every row comes back, other columns as they are.

    A rule fits its host and all subdomains if the url's path starts with the rule's path; the longest rule wins, and of
    rules of one length the one that sorts last. Null urls and urls without ``://`` have an empty host and path, which no
    rule fits. Repeated rows are judged each. Columns of ``pages`` named host, path, rule or verdict are replaced. An empty
    table gives an empty result; without rules every url gets the default.
    """
    spark = pages.sparkSession
    salts = salts or shuffle_width(spark)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*kept).alias("row"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    rows = rows.withColumn("key", reversed_host(F.col("host"))).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    kind = "array<struct<start_path:string,rule:string,verdict:string>>"
    events = stacks(rules).select(
        F.lit(None).cast(rows.schema["row"].dataType).alias("row"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
        "key",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        F.col("stack").cast(kind).alias("stack"),
        F.lit(0).alias("place"),
    )
    swept = rows.withColumns({"stack": F.lit(None).cast(kind), "place": F.lit(1)}).unionByName(events)
    sweep = Window.partitionBy(F.substring_index("key", ".", 1), "salt").orderBy("key", "place").rowsBetween(Window.unboundedPreceding, 0)
    active = swept.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("place = 1")
    fits = F.filter("stack", lambda r: F.col("path").startswith(r["start_path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r["rule"]).alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return active.withColumn("best", best).select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts of all pages under the fixed rules."""
    found = judge(table(spark, folder, "pages").select("page_id", "url"), rule_table(spark, RULES))
    return found.select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    rules = ", ".join(f"('{rule[: rule.index('/')]}', '{rule[rule.index('/') :]}', '{rule}', '{verdict}')" for verdict, rule in RULES)
    return f"""
    WITH rules(h, p, rule, verdict) AS (VALUES {rules}),
    cut AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parsed AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM cut),
    hits AS (SELECT page_id, r.rule, r.verdict FROM parsed JOIN rules r
             ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)),
    best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM hits GROUP BY page_id)
    SELECT p.page_id, coalesce(p.host, '') AS host, coalesce(p.path, '') AS path, b.rule, coalesce(b.verdict, '{DEFAULT}') AS verdict
    FROM parsed p LEFT JOIN best b USING (page_id)"""


ORACLE = _oracle()
