"""URL filter: rules, and for the rest a ratio of two character language models.

One smoothed Markov model of variable order is counted from the URLs that rules
accept, one from those they reject. A URL no rule fits is accepted if the difference
of its log-likelihoods, by its length, reaches a threshold calibrated on the labelled
URLs. Built-in expressions only.

Characters are mapped to an alphabet of 32, contexts are of up to two characters:
a model has 32^3 entries whatever the table holds, and goes to the rows as one array.
Every URL is scored within its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.llm.quality import bound

# The rules, verdict by host and path.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}

SIZE = 32  # letters: padding and end, a-z, any digit, slash, dot, dash, anything else
ALPHABET = "@abcdefghijklmnopqrstuvwxyz0/.-_"
UNITS = 1_000_000  # log-likelihood differences are whole numbers of millionths: sums are exact


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    name, _, rest = rule.partition("/")
    return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))


def letters(url: Column) -> Column:
    """The letters of a URL, and the end."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(url), "[0-9]", "0"), "[^a-z0/.\\-]", "_")
    return F.transform(F.split(plain, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def trigrams(url: Column) -> Column:
    """A number below SIZE^3 for each character and the end: the two letters before it and its own."""
    ended = F.when(F.length(url) > 0, F.concat(letters(url), F.array(F.lit(0)))).otherwise(F.array(F.lit(0)))
    return bound(ended, lambda a: F.transform(a, lambda x, i: (
        F.coalesce(F.get(a, i - 2), F.lit(0)) * (SIZE * SIZE) + F.coalesce(F.get(a, i - 1), F.lit(0)) * SIZE + x).cast("int")))


def model(labelled: DataFrame) -> DataFrame:
    """gram, units: log-likelihood difference, accepted less rejected, for all SIZE^3 trigrams.

    labelled: url, accepted. Witten-Bell smoothing: a context gives as much weight to the
    next shorter one as it has different successors; no context at all to all letters alike.
    """
    spark = labelled.sparkSession
    grams = labelled.select("accepted", F.explode(trigrams(F.col("url"))).alias("gram")).groupBy("accepted", "gram").agg(F.count("*").alias("n"))
    every = spark.range(2 * SIZE**3).select(
        (F.col("id") >= SIZE**3).alias("accepted"), F.pmod("id", F.lit(SIZE**3)).cast("int").alias("gram"))
    rows = every.join(F.broadcast(grams), ["accepted", "gram"], "left").select(
        "accepted", "gram", F.coalesce("n", F.lit(0)).alias("n"),
        F.pmod("gram", F.lit(SIZE)).alias("x"), F.pmod("gram", F.lit(SIZE * SIZE)).alias("bx"),
        F.floor(F.col("gram") / SIZE).cast("int").alias("ab"), F.floor(F.pmod("gram", F.lit(SIZE * SIZE)) / SIZE).cast("int").alias("b"))

    def seen(order: str, of: str) -> DataFrame:
        """Occurrences of each `of`, and how many different ones follow each context `order`."""
        return rows.groupBy("accepted", order, of).agg(F.sum("n").alias("n")).groupBy("accepted", order).agg(
            F.sum("n").alias("total"), F.sum((F.col("n") > 0).cast("int")).alias("kinds"))

    one = rows.groupBy("accepted", "x").agg(F.sum("n").alias("n1"))
    all_ = rows.groupBy("accepted").agg(F.sum("n").alias("n0"))
    two = rows.groupBy("accepted", "bx").agg(F.sum("n").alias("n2"))
    after_b, after_ab = seen("b", "bx").toDF("accepted", "b", "t2", "k2"), seen("ab", "gram").toDF("accepted", "ab", "t3", "k3")
    p = (rows.join(all_, "accepted").join(one, ["accepted", "x"]).join(two, ["accepted", "bx"])
         .join(after_b, ["accepted", "b"]).join(after_ab, ["accepted", "ab"]))
    p1 = (F.col("n1") + 1) / (F.col("n0") + SIZE)
    p2 = F.when(F.col("t2") > 0, (F.col("n2") + F.col("k2") * p1) / (F.col("t2") + F.col("k2"))).otherwise(p1)
    p3 = F.when(F.col("t3") > 0, (F.col("n") + F.col("k3") * p2) / (F.col("t3") + F.col("k3"))).otherwise(p2)
    p = p.select("gram", F.when(F.col("accepted"), F.log(p3)).otherwise(-F.log(p3)).alias("l"))
    return p.groupBy("gram").agg(F.round(F.sum("l") * UNITS).cast("bigint").alias("units"))


def judge_urls(pages: DataFrame, *, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, ratio: one row per row of pages.

    rule: the longest that fits the host or a domain above it and the path's beginning;
    null if none does. verdict: its own, else that of the models: allow if ratio, the
    mean log-likelihood difference per character in millionths, reaches the threshold,
    the middle between the means of the accepted and of the rejected labelled URLs.

    A null URL is an empty one: host and path are empty, and the models judge the end
    alone. Without accepted or without rejected URLs all that no rule fits are allowed.
    Repeated rows count as often as they stand; a null page_id stays null; an empty
    table gives no rows. Other columns are not read.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"))
    rows = rows.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule = F.lit(None).cast("string")
    for name in sorted(RULES, key=len):  # the longest is asked first
        rule = F.when(fits(name, F.col("host"), F.col("path")), name).otherwise(rule)
    rows = rows.withColumn("rule", rule)
    verdict = F.lit(None).cast("string")
    for name, said in RULES.items():
        verdict = F.when(F.col("rule") == name, said).otherwise(verdict)
    rows = rows.withColumn("ruled", verdict)

    labelled = rows.where(F.col("ruled").isNotNull()).select("url", (F.col("ruled") == "allow").alias("accepted"))
    # One row with one array of SIZE^3 numbers: that is the bound for sending it to all tasks.
    table = model(labelled).agg(F.transform(F.array_sort(F.collect_list(F.struct("gram", "units"))), lambda x: x["units"]).alias("model"))
    units = table.first().model
    lookup = F.split(F.lit(",".join(map(str, units))), ",").cast("array<bigint>")

    def ratio(of: Column) -> Column:
        grams = trigrams(of)
        total = bound(grams, lambda g: F.struct(
            F.aggregate(F.transform(g, lambda k: F.get(lookup, k)), F.lit(0).cast("bigint"), lambda t, x: t + x).alias("sum"),
            F.size(g).alias("n")))
        return bound(total, lambda t: t["sum"] / t["n"])

    means = {r.accepted: r.mean for r in labelled.groupBy("accepted").agg(
        F.sum(F.round(ratio(F.col("url"))).cast("bigint")).alias("s"), F.count("*").alias("n")
    ).select("accepted", (F.col("s") / F.col("n")).alias("mean")).collect()}
    threshold = (means[True] + means[False]) / 2 if len(means) == 2 else None
    allowed = F.lit(True) if threshold is None else F.col("ratio") >= threshold
    rows = rows.withColumn("ratio", F.round(ratio(F.col("url"))).cast("bigint"))
    judged = F.coalesce("ruled", F.when(allowed, "allow").otherwise("block"))
    return rows.select("page_id", "host", "path", "rule", judged.alias("verdict"), "ratio")


def oracle_sql(table: str = "pages") -> str:
    """DuckDB SQL for judge_urls() without the ratio."""
    def fit(rule: str) -> str:
        name, _, rest = rule.partition("/")
        return f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"

    rules = " ".join(f"WHEN {fit(r)} THEN '{r}'" for r in sorted(RULES, key=len, reverse=True))
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES.items())
    plain = "regexp_replace(regexp_replace(lower(url), '[0-9]', '0', 'g'), '[^a-z0/.\\-]', '_', 'g')"
    n = SIZE
    return f"""
        WITH u AS (SELECT page_id, COALESCE(url, '') AS url FROM {table}),
        h AS (SELECT page_id, url, translate(COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            COALESCE(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM u),
        r AS (SELECT *, CASE {rules} END AS rule FROM h),
        v AS (SELECT *, CASE rule {verdicts} END AS ruled, row_number() OVER () AS line,
            list_concat([0, 0], list_transform(string_split(CASE WHEN url = '' THEN '@' ELSE {plain} || '@' END, ''),
                lambda c: instr('{ALPHABET}', c) - 1)) AS a FROM r),
        g AS MATERIALIZED (SELECT line, ruled, unnest(list_transform(range(3, len(a) + 1),
            lambda i: a[i - 2] * {n * n} + a[i - 1] * {n} + a[i])) AS gram FROM v),
        every AS (SELECT s.ruled, k.gram FROM (VALUES ('allow'), ('block')) s(ruled), range({n**3}) k(gram)),
        c AS MATERIALIZED (SELECT e.ruled, e.gram, COALESCE(x.n, 0) AS n, e.gram % {n} AS x, e.gram % {n * n} AS bx,
            e.gram // {n} AS ab, (e.gram % {n * n}) // {n} AS b FROM every e
            LEFT JOIN (SELECT ruled, gram, count(*) AS n FROM g WHERE ruled IS NOT NULL GROUP BY ALL) x USING (ruled, gram)),
        one AS (SELECT ruled, x, sum(n) AS n1 FROM c GROUP BY ALL),
        zero AS (SELECT ruled, sum(n) AS n0 FROM c GROUP BY ALL),
        two AS (SELECT ruled, bx, b, sum(n) AS n2 FROM c GROUP BY ALL),
        after_b AS (SELECT ruled, b, sum(n2) AS t2, count(*) FILTER (n2 > 0) AS k2 FROM two GROUP BY ALL),
        after_ab AS (SELECT ruled, ab, sum(n) AS t3, count(*) FILTER (n > 0) AS k3 FROM c GROUP BY ALL),
        p1 AS (SELECT c.*, n2, t2, k2, t3, k3, (n1 + 1) / (n0 + {n})::DOUBLE AS p1 FROM c JOIN zero USING (ruled) JOIN one USING (ruled, x)
            JOIN two USING (ruled, bx) JOIN after_b ON after_b.ruled = c.ruled AND after_b.b = c.b JOIN after_ab USING (ruled, ab)),
        p2 AS (SELECT *, CASE WHEN t2 > 0 THEN (n2 + k2 * p1) / (t2 + k2) ELSE p1 END AS p2 FROM p1),
        p3 AS (SELECT *, CASE WHEN t3 > 0 THEN (n + k3 * p2) / (t3 + k3) ELSE p2 END AS p3 FROM p2),
        m AS (SELECT gram, round(sum(CASE ruled WHEN 'allow' THEN ln(p3) ELSE -ln(p3) END) * {UNITS})::BIGINT AS units FROM p3 GROUP BY gram),
        s AS (SELECT line, round(sum(units) / count(*)::DOUBLE)::BIGINT AS ratio FROM g JOIN m USING (gram) GROUP BY line),
        t AS (SELECT ruled, sum(ratio) / count(*)::DOUBLE AS mean FROM v JOIN s USING (line) WHERE ruled IS NOT NULL GROUP BY ruled),
        limit_ AS (SELECT CASE WHEN count(*) = 2 THEN sum(mean) / 2 END AS l FROM t)
        SELECT page_id, host, path, rule, COALESCE(ruled, CASE WHEN l IS NULL OR ratio >= l THEN 'allow' ELSE 'block' END) AS verdict
        FROM v JOIN s USING (line), limit_"""
