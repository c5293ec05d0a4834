"""URL filters as a sort-merge range join of nested prefix rules.

A rule is a host and a path. Written as `reversed host labels + "."`, the hosts that a rule's
host covers are those in one interval of keys, and intervals of different rules nest or lie
apart. Rule boundaries and page keys are sorted together and swept once: a boundary carries
the stack of rule hosts that are active from there on, and every page takes over the stack
of the last boundary before it. A second sweep of the same kind, now within each active rule
host, finds the longest active path prefix.

All of it is DataFrame functions. Pages are spread over buckets by a hash, so a host that
holds most pages is swept in many tasks; only the rules are repeated for each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DEFAULT_VERDICT = "allow"
RULE_SCHEMA = "host string, path string, verdict string"


def reversed_host(host: Column) -> Column:
    """a.b.c as c.b.a., so that a host is a prefix of its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or a url without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(host, empty), F.coalesce(path, empty)


def boundaries(rules: DataFrame, group: list[str], prefix: str) -> DataFrame:
    """Where the set of active rules changes: (group, key, after, active).

    One row where a prefix begins and one where it ends; `active` is the array of prefixes that
    are active from there on, the longest last. What lies below a prefix is found by an
    equality join on all shorter prefixes that can be rules, so hot prefixes need no sort.
    """
    own = rules.select(*group, prefix).distinct()
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.length(prefix)), lambda n: F.substring(prefix, F.lit(1), n)))
    outer = own.select(*group, F.col(prefix).alias("_outer"))
    chain = (
        own.select(*group, prefix, cut.alias("_outer"))
        .join(outer, [*group, "_outer"])
        .groupBy(*group, prefix)
        .agg(F.array_sort(F.collect_list(F.struct(F.length("_outer").alias("n"), F.col("_outer").alias("p"))))["p"].alias("stack"))
    )
    key = F.encode(prefix, "UTF-8")
    begins = chain.select(*group, key.alias("key"), F.lit(0).alias("after"), F.col("stack").alias("active"))
    # 0xFF is in no UTF-8 text, so this key comes right behind all that begin with the prefix.
    # Popping the prefix leaves the stack of what it is nested in. When prefixes end at one
    # key the shorter one comes last, because its key is then the greater.
    ends = chain.select(
        *group, F.concat(key, F.lit(b"\xff")).alias("key"), F.lit(0).alias("after"),
        F.slice("stack", 1, F.size("stack") - 1).alias("active"),
    )
    return begins.union(ends)


def sweep(pages: DataFrame, rules: DataFrame, group: list[str], prefix: str, text: str, buckets: int) -> DataFrame:
    """Pages with `active`, the rule prefixes of their text within their group, longest last.

    Null where no boundary comes before a page's key.
    """
    cells = boundaries(rules, group, prefix).withColumn(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    )
    keyed = pages.withColumn("key", F.encode(text, "UTF-8")).withColumn("after", F.lit(1))
    both = cells.withColumn("_page", F.lit(False)).unionByName(
        keyed.withColumn("_page", F.lit(True)), allowMissingColumns=True
    )
    order = Window.partitionBy("bucket", *group).orderBy("key", "after").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("active", F.last("active", ignorenulls=True).over(order)).filter("_page")
    return swept.drop("key", "after", "_page")


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """page_id, host, path, rule and verdict for each row of pages.

    A rule fits its host and all subdomains if the path starts with the rule's path; the
    longest rule (host and path together) wins, then the longer host, then the smaller verdict.
    Where none fits, rule is null and the verdict is the default. Null urls and urls without
    `://` have an empty host and path and fit no rule. Rules without host or path are ignored.
    Repeated rows and ids are judged row by row; other columns are not read.
    """
    spark = pages.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts(F.col(url_col))
    own = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    # Rows can repeat in every column, so each gets a number of its own for the last grouping.
    own = own.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("int")
    )
    own = own.withColumn("_host", reversed_host(F.col("host")))
    given = (
        rules.filter("host <> '' and path is not null")
        .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
        .withColumn("_node", reversed_host(F.col("host")))
    )
    on_hosts = sweep(own, given.select("_node"), [], "_node", "_host", buckets)
    # Each active rule host is a group of its own for the path sweep.
    steps = on_hosts.withColumn("_node", F.explode_outer("active")).drop("active")
    on_paths = sweep(
        steps.withColumn("_text", F.concat(F.lit("\x01"), "path")),
        # A leading character makes the empty path a prefix like any other.
        given.select("_node", F.concat(F.lit("\x01"), "path").alias("_prefix")),
        ["_node"], "_prefix", "_text", buckets,
    )
    fitting = on_paths.withColumn("_path", F.expr("substring(try_element_at(active, -1), 2)")).join(
        given.select("_node", F.col("path").alias("_path"), "verdict", F.concat("host", "path").alias("rule")),
        ["_node", "_path"], "left",
    )
    best = F.max(
        F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), F.length("_node").alias("h"), "rule", "verdict"))
    )
    return (
        fitting.groupBy("_row", "page_id", "host", "path").agg(best.alias("b"))
        .select(
            "page_id", "host", "path", F.col("b.rule").alias("rule"),
            F.coalesce("b.verdict", F.lit(default)).alias("verdict"),
        )
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)
