"""URL filters: host rules, and a logistic regression on hashed character n-grams.

DataFrame expressions only. A rule blocks or allows a host with its subdomains under a
path; the longest that fits decides. All other URLs are judged by a logistic
regression on the hashed character n-grams of host and path, fitted on a small
labelled URL table. Fitting runs in one row of Spark arrays: gradient descent on the
weights of the examples (each step moves the model within their span), from which the
weights of the buckets follow. The model is an array of ``BUCKETS`` numbers, so that
judging is one pass over the URLs without any shuffle.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm.common import ascii_lower, table, written

#: (verdict, host, start of the path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
SIZES = (3, 4, 5)
BUCKETS = 1 << 13
STEPS = 600
PENALTY = 0.01
#: Score from which a URL is blocked: more than even, as the table has far more unwanted URLs than the web.
THRESHOLD = 0.6
#: Labelled URLs that a model is fitted on at most: the steps hold a square of that many numbers.
MOST_EXAMPLES = 1000

#: Words of hosts in the labelled table; each stands in a URL of every form.
UNWANTED = (
    "casino poker jackpot bets win lottery viagra pills pharmacy adult porn xxx escort spam farm "
    "ads track banner warez replica loans phishing"
).split()
WANTED = (
    "weather news garden kitchen museum history science station motion gathering theatre heather "
    "brother thing string morning reading building market mountain river theory thread south western "
    "earth bread stable border thrift"
).split()
_TEMPLATES = (
    "https://www.{w}-{v}.example.com/{l}/{n}",
    "http://{w}{v}.example.org/{l}/{n}.html?ref=a",
    "https://m.{w}.example.net/{l}/{n}#top",
    "https://blog.{v}-{w}.example.com/{l}/{n}/",
    "https://{w}-{v}.example.net/{l}/{n}?page=2",
)
_TAILS = ("one", "x", "now", "hub", "top")


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 for unwanted): the labelled table, a URL of every form for each word."""
    rows = []
    for label, words in ((1, UNWANTED), (0, WANTED)):
        for i, word in enumerate(words):
            for j, form in enumerate(_TEMPLATES):
                # both labels share tails, languages and forms, so that the words alone tell them apart
                filled = {"w": word, "v": _TAILS[(i + j) % 5], "l": ("en", "de", "fr", "es")[(i + j) % 4]}
                rows.append((form.format(n=17 * i + j, **filled), label))
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    """``labelled_urls()`` as a table (url, label), made by Spark from one literal."""
    text = json.dumps([{"url": url, "label": label} for url, label in labelled_urls()])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<url:string,label:int>>")))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower-case ASCII; else empty."""
    return ascii_lower(_part(url, 1))


def path(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls where none does.

    A rule fits its host and all subdomains of it, where the path starts with the
    rule's. Of rules as long, the one with the longer host goes first, then the first
    listed. Rules are part of the plan: meant for up to some hundreds.
    """
    name = verdict = F
    for action, own, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]))):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = name.when(fits, own + start), verdict.when(fits, action)
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name.otherwise(None), verdict.otherwise(None)


def letters(text: Column) -> Column:
    """The characters of a host or path between two marks; digits count as 0."""
    plain = F.concat(F.lit("^"), F.regexp_replace(text, "[0-9]", "0"), F.lit("$"))
    return F.regexp_extract_all(plain, F.lit("(?s)."), F.lit(0))


def buckets(host_letters: Column, path_letters: Column, sizes=SIZES, count: int = BUCKETS) -> Column:
    """The distinct buckets of the character n-grams of host and path, apart from each other.

    The letters have to be columns of their own, made one projection below, so that they
    are made once and a long URL takes time in proportion to its length.
    """
    parts = []
    for kind, characters in (("h", host_letters), ("p", path_letters)):
        for n in sizes:
            last = F.size(characters) - n
            grams = F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))), _gram(kind, characters, n, count)
            )
            parts.append(F.when(last >= 0, grams).otherwise(F.array().cast("array<int>")))
    return F.array_distinct(F.concat(*parts))


def _gram(kind: str, characters: Column, n: int, count: int):
    def bucket(i: Column) -> Column:
        own = [F.get(characters, i + k) for k in range(n)]
        return F.pmod(F.xxhash64(F.lit(kind), *own), F.lit(count)).cast("int")

    return bucket


def with_buckets(urls: DataFrame, sizes=SIZES, count: int = BUCKETS) -> DataFrame:
    """Adds host, path and their buckets to rows with a ``url``, which goes."""
    others = [c for c in urls.columns if c != "url"]
    parted = urls.select(*others, host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    spelt = parted.withColumns({"host_letters": letters(F.col("host")), "path_letters": letters(F.col("path"))})
    own = buckets(F.col("host_letters"), F.col("path_letters"), sizes, count)
    return spelt.withColumn("buckets", own).drop("host_letters", "path_letters")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def fitted(
    labelled: DataFrame, sizes=SIZES, count: int = BUCKETS, steps: int = STEPS, penalty: float = PENALTY
) -> list[float]:
    """Weight of every bucket and, last, of the constant: logistic regression on (url, label).

    Label 1 is unwanted, 0 is not; rows with other labels aren't looked at. An example
    has its buckets at one over the root of their number, and a constant. ``labelled``
    may have ``MOST_EXAMPLES`` rows at most. An empty table gives zeros.
    """
    rows = labelled.filter(F.col("label").isin(0, 1)).select("url", F.col("label").cast("double").alias("label"))
    found = rows.count()  # bounded by what a labelled table is
    if found > MOST_EXAMPLES:
        raise ValueError(f"A labelled table of at most {MOST_EXAMPLES} rows is expected")
    if not found:
        return [0.0] * (count + 1)
    examples = with_buckets(rows, sizes, count).withColumnRenamed("buckets", "own")
    examples = examples.agg(F.sort_array(F.collect_list(F.struct("host", "path", "label", "own"))).alias("all"))
    examples = examples.select(F.col("all.own").alias("own"), F.col("all.label").alias("labels"))

    def alike(a: Column, b: Column) -> Column:
        return 1 + F.size(F.array_intersect(a, b)) / F.sqrt(F.greatest(F.size(a) * F.size(b), F.lit(1)).cast("double"))

    kernel = F.transform("own", lambda a: F.transform("own", lambda b: alike(a, b)))
    # one written row, so that the kernel isn't made anew in each step
    kernel = written(examples.select("own", "labels", kernel.alias("kernel")), "url-kernel")
    rate = 1.0 / (found / 2 + penalty)  # no kernel of n examples has more than 2n in any direction

    def step(alpha: Column, _: Column) -> Column:
        margins = F.transform("kernel", lambda row: _sum(F.zip_with(row, alpha, lambda k, a: k * a)))
        missing = F.zip_with(margins, F.col("labels"), lambda m, y: y - 1 / (1 + F.exp(-m)))
        return F.zip_with(alpha, missing, lambda a, r: a + rate * (r - penalty * a))

    start = F.transform("labels", lambda _: F.lit(0.0))
    alphas = kernel.select("own", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step).alias("alphas"))
    each = alphas.select(F.inline(F.arrays_zip("own", "alphas")))
    constant = each.select(F.lit(count).alias("bucket"), F.col("alphas").alias("part"))
    shared = each.select(
        F.explode("own").alias("bucket"), (F.col("alphas") / F.sqrt(F.size("own").cast("double"))).alias("part")
    )
    weights = [0.0] * (count + 1)
    for row in constant.unionAll(shared).groupBy("bucket").agg(F.sum("part").alias("weight")).collect():  # count + 1 rows
        weights[row["bucket"]] = row["weight"]
    return weights


def unwanted_score(own: Column, weights: list[float]) -> Column:
    """Probability that a URL with these buckets is unwanted."""
    # one literal array, folded once
    model = F.split(F.lit(",".join(map(repr, weights[:-1]))), ",").cast("array<double>")
    total = F.aggregate(own, F.lit(0.0), lambda s, b: s + F.element_at(model, b + 1))
    margin = total / F.sqrt(F.greatest(F.size(own), F.lit(1)).cast("double")) + weights[-1]
    return 1 / (1 + F.exp(-margin))


def judged(
    pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, threshold: float = THRESHOLD, **options
) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row of ``pages`` (page_id, url, others).

    ``labelled`` (url, label) is the small labelled table, ``labelled_urls()`` unless
    given. ``score`` is the model's, also where a rule decides. A null URL or one
    without ``://`` has an empty host and path; no rule with a path fits it and the
    model judges it by its constant and the empty parts. Null and repeated page_ids are
    rows like any other, an empty table gives an empty result, other columns aren't
    looked at.
    """
    if labelled is None:
        labelled = labelled_table(pages.sparkSession)
    weights = fitted(labelled, **options)
    sizes, count = options.get("sizes", SIZES), options.get("count", BUCKETS)
    spelt = with_buckets(pages.select("page_id", "url"), sizes, count)
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    scored = spelt.select(
        "page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"),
        unwanted_score(F.col("buckets"), weights).alias("score"),
    )
    by_score = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_score).alias("verdict"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
