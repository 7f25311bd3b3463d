"""URL filters: rules by host and path, else logistic regression on hashed character n-grams.

Everything here is DataFrame functions. The regression is trained from a small labelled table inside one SQL expression:
gradient ascent on the regularised likelihood, written in the dual (a coefficient for each labelled URL, their common
n-grams as the kernel), then unfolded into one weight for each n-gram bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import cut

BUCKETS = 4096
#: Rules and labelled URLs are literals of the plan; more of either is refused.
MOST_RULES, MOST_LABELS = 2000, 500
STEPS, RATE, RIDGE = 150, 0.5, 0.01
#: Log odds from which a URL is blocked (probability 0.88): blocking a clean host costs more than letting one through.
BLOCK_FROM = 2.0

#: (action, host, path): longest fitting host and path wins.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]

#: The small labelled URL table: names by kind, each under two hosts with two paths.
BAD_NAMES = "cheap-meds buy-pills pill-store casino-royal online-casino big-casino-win free-spins freebets bets-online best-betting spam-links link-farm spamfarm seo-farm ad-tracker ads-click track-ads adserver tracking-pixel popunder payday-loans quick-cash cheap-replica free-viagra poker-win lottery-winner jackpot-slots cheap-deals xxx-tube adult-cams free-prizes cheap-pharmacy adult-dating free-porn sex-chat win-money easy-money miracle-diet crypto-bonus free-followers".split()
GOOD_NAMES = "wikipedia nature python news mozilla museum library gutenberg archive nasa lemonde zeitung elpais forum debian history national maps recipes thetimes weather sport gardening music health photo theatre station another tension thing mother brother father nation motion action teaching learning reading writing running morning evening garden kitchen school university college science research journal letters gazette heritage harbour mountain river village travel".split()
BEFORE = ["", "www.", "blog.", "m."]
AFTER = [".com", ".example.net", ".org", ".example.com", ".net", ".example.org"]
PATHS = ["/en/1024", "/fr/77.html", "/de/3301/", "/es/512", "/index.html"]


def seeds() -> list[tuple[str, float]]:
    """The labelled table: URL and 1 for block, 0 for allow; both kinds go through the same beginnings, endings and paths, so
    only names tell them apart."""
    out = []
    for y, names in ((1.0, BAD_NAMES), (0.0, GOOD_NAMES)):
        for i, name in enumerate(names):
            for k in (2 * i, 2 * i + 1):
                out.append((f"https://{BEFORE[k % 4]}{name}{AFTER[(i + 3 * k) % 6]}{PATHS[k % 5]}", y))
    return out


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null and without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(host_: Column, path_: Column) -> Column:
    """Distinct buckets of the 3- and 4-grams of the host, between ^ and $, and of the path up to its $."""
    def of(text: Column, kind: str, n: int) -> Column:
        last = F.length(text) - n + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.conv(F.substring(F.md5(F.concat(F.lit(kind), F.substring(text, i, F.lit(n))).cast("binary")), 1, 3), 16, 10).cast("int"))).otherwise(F.array().cast("array<int>"))

    h, p = F.concat(F.lit("^"), host_, F.lit("$")), F.concat(path_, F.lit("$"))
    return F.array_distinct(F.concat(of(h, "h", 3), of(h, "h", 4), of(p, "p", 3), of(p, "p", 4)))


def train(spark: SparkSession, labelled: list[tuple[str, float]]) -> tuple[list[float], float]:
    """Weight of each bucket and the offset, from (url, label); at most BUCKETS numbers come to the driver."""
    if len(labelled) > MOST_LABELS:
        raise ValueError(f"the labelled table holds at most {MOST_LABELS} URLs")
    if not labelled:
        return [0.0] * BUCKETS, 0.0
    rows = spark.createDataFrame([(i, u, float(y)) for i, (u, y) in enumerate(labelled)], "i int, url string, y double")
    rows = rows.select("i", "y", grams(host(F.col("url")), path(F.col("url"))).alias("g"))
    one = rows.agg(F.array_sort(F.collect_list(F.struct("i", "y", "g"))).alias("t")).select(F.expr("transform(t, x -> x.y)").alias("y"), F.expr("transform(t, x -> x.g)").alias("g"))
    kernel = F.expr("transform(g, a -> transform(g, b -> 1D + size(array_intersect(a, b)) / sqrt(CAST(size(a) AS DOUBLE) * size(b))))")
    one = cut(one.select("y", "g", kernel.alias("k")))
    fitted = F.expr(f"""
        aggregate(sequence(1, {STEPS}), transform(y, x -> 0D), (a, t) -> transform(sequence(0, size(y) - 1), i ->
            a[i] * (1D - {RATE}D * {RIDGE}D) + {RATE}D * (y[i] - 1D / (1D + exp(-aggregate(zip_with(k[i], a, (p, q) -> p * q), 0D, (s, v) -> s + v))))))""")
    one = cut(one.select("g", fitted.alias("a")))
    each = one.select(F.explode(F.arrays_zip("g", "a")).alias("r")).select(F.col("r.a").alias("a"), F.col("r.g").alias("g"))
    weights = each.select(F.explode("g").alias("b"), (F.col("a") / F.sqrt(F.size("g").cast("double"))).alias("w")).groupBy("b").agg(F.sum("w").alias("w"))
    out = [0.0] * BUCKETS
    for r in weights.collect():
        out[r["b"]] = r["w"]
    return out, one.select(F.aggregate("a", F.lit(0.0), lambda s, x: s + x)).first()[0]


def rule(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(text, action) of the longest rule that fits, else null: its host or a subdomain of it, its path or one below."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    out = F.lit(None).cast("struct<text:string,action:string>")
    for action, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):  # later ones win
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("text"), F.lit(action).alias("action"))).otherwise(out)
    return out


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, labelled: list[tuple[str, float]] | None = None, url: str = "url", id_: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row, in one pass without a shuffle; only id and url are read.

    The score is the regression's log odds for block (its offset alone where host and path are empty or short); the
    verdict is the rule's, else block from BLOCK_FROM on. Null urls and urls without :// have empty host and path.
    """
    weights, offset = train(pages.sparkSession, seeds() if labelled is None else labelled)
    parts = pages.select(pages[id_].alias("page_id"), host(pages[url]).alias("host"), path(pages[url]).alias("path"))
    g = grams(F.col("host"), F.col("path"))
    w = F.lit(weights)
    score = F.lit(offset) + F.aggregate(g, F.lit(0.0), lambda s, b: s + F.get(w, b)) / F.sqrt(F.greatest(F.size(g), F.lit(1)).cast("double"))
    parts = parts.withColumn("__r", rule(F.col("host"), F.col("path"), RULES if rules is None else rules)).withColumn("score", score)
    return parts.select("page_id", "host", "path", F.col("__r.text").alias("rule"), F.coalesce("__r.action", F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")).alias("verdict"), "score")


def oracle() -> str:
    """The query in DuckDB: the same training as a recursive query over one list of coefficients."""
    values = ", ".join(f"({i}, '{u}', {y})" for i, (u, y) in enumerate(seeds()))
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    h = low.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")
    p = "coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"

    def of(text: str, kind: str, n: int) -> str:
        return f"list_transform(range(1, length({text}) - {n} + 2), lambda i: CAST('0x' || substr(md5('{kind}' || substr({text}, i, {n})), 1, 3) AS INTEGER))"

    g = "list_distinct(" + " || ".join(of(t, k, n) for t, k in (("('^' || host || '$')", "h"), ("(path || '$')", "p")) for n in (3, 4)) + ")"
    cases = " ".join(f"WHEN (host = '{a}' OR ends_with(host, '.{a}')) AND starts_with(path, '{b}') THEN '{a}{b}'" for _, a, b in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    acts = " ".join(f"WHEN '{a}{b}' THEN '{x}'" for x, a, b in RULES)
    return f"""
WITH RECURSIVE s0(i, url, y) AS (VALUES {values}),
s AS (SELECT i, CAST(y AS DOUBLE) AS y, {g} AS g FROM (SELECT i, y, {h} AS host, {p} AS path FROM s0)),
k AS (SELECT a.i, list(1.0 + len(list_intersect(a.g, b.g)) / sqrt(CAST(len(a.g) AS DOUBLE) * len(b.g)) ORDER BY b.i) AS k FROM s a, s b GROUP BY a.i),
m AS (SELECT list(CAST(k.k AS DOUBLE[]) ORDER BY k.i) AS k, list(s.y ORDER BY s.i) AS y FROM k JOIN s USING (i)),
r(step, a) AS (
  SELECT 0, list_transform(m.y, lambda x: CAST(0 AS DOUBLE)) FROM m
  UNION ALL
  SELECT step + 1, list_transform(range(1, len(m.y) + 1), lambda i:
    a[i] * (1.0 - CAST({RATE} AS DOUBLE) * CAST({RIDGE} AS DOUBLE)) + {RATE} * (m.y[i] - 1.0 / (1.0 + exp(-list_dot_product(m.k[i], a)))))
  FROM r, m WHERE step < {STEPS}),
f AS (SELECT a FROM r WHERE step = {STEPS}),
w AS (SELECT b, sum(a / sqrt(CAST(n AS DOUBLE))) AS w FROM (SELECT unnest(s.g) AS b, f.a[s.i + 1] AS a, len(s.g) AS n FROM s, f) GROUP BY b),
d AS (SELECT page_id, {h} AS host, {p} AS path FROM pages),
e AS (SELECT page_id, host, path, {g} AS g FROM d),
u AS (SELECT page_id, unnest(g) AS b FROM e),
z AS (SELECT u.page_id, sum(w.w) AS t FROM u JOIN w USING (b) GROUP BY u.page_id),
q AS (
  SELECT e.page_id, host, path, CASE {cases} END AS rule,
         (SELECT list_sum(a) FROM f) + coalesce(z.t, 0) / sqrt(CAST(greatest(len(e.g), 1) AS DOUBLE)) AS score
  FROM e LEFT JOIN z USING (page_id))
SELECT page_id, host, path, rule, coalesce(CASE rule {acts} END, CASE WHEN score >= {BLOCK_FROM} THEN 'block' ELSE 'allow' END) AS verdict FROM q
"""
