"""Which URLs to take: rules on hosts and paths first, then a logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.llm.staging import staged

SIZES = (3, 4)
BUCKETS = 4096
MAX_TRAINING = 2_000
MAX_RULES = 10_000
CUT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Labelled URLs: 1 blocks. A small table of invented examples, none with a host of the test tables; callers pass their own.
TRAINING = [
    ("http://www.casino-royal.example/en/1", 1),
    ("https://best-casino.example/win/2", 1),
    ("http://win-big-casino.example/de/3", 1),
    ("https://bets-today.example/en/4", 1),
    ("http://sports-betting.example/fr/5", 1),
    ("https://discount-pills.example/en/6", 1),
    ("http://pills-online-pharmacy.example/buy/7", 1),
    ("https://adult-videos.example/x/8", 1),
    ("http://www.adult-dating.example/en/9", 1),
    ("https://spam-mailer.example/en/10", 1),
    ("http://content-farm-links.example/es/11", 1),
    ("https://ads-server.example/en/12", 1),
    ("http://m.click-tracker.example/click/13", 1),
    ("https://poker-bonus-win.example/en/14", 1),
    ("http://lotto-jackpot-win.example/fr/15", 1),
    ("https://replica-watches-cheap.example/de/16", 1),
    ("http://www.online-casino.example/en/41", 1),
    ("https://blog.win-bets.example/fr/42", 1),
    ("http://m.cheap-meds-pills.example/en/43", 1),
    ("https://www.free-casino-spins.example/es/44/", 1),
    ("http://blog.adult-cams.example/de/45", 1),
    ("https://m.spam-links.example/en/46?page=2", 1),
    ("http://www.weather.example/en/21", 0),
    ("https://news.daily.example/de/22", 0),
    ("http://blog.garden.example/en/23.html", 0),
    ("https://library.example/fr/24/", 0),
    ("http://www.university.example/en/25", 0),
    ("https://m.recipes.example/es/26?page=2", 0),
    ("http://history.museum.example/en/27#top", 0),
    ("https://www.council.example/de/28", 0),
    ("http://blog.travel.example/fr/29", 0),
    ("https://science.journal.example/en/30", 0),
    ("http://www.orchestra.example/es/31/", 0),
    ("https://m.railway.example/en/32", 0),
    ("http://heritage.example/en/33", 0),
    ("https://blog.motherhood.example/de/34.html", 0),
    ("http://www.theatre.example/fr/35", 0),
    ("https://restoration.example/es/36", 0),
    ("http://m.northern-lights.example/en/37?utm_source=feed", 0),
    ("https://stringent.example/en/38", 0),
    ("http://www.institution.example/de/39/", 0),
    ("https://orientation.example/fr/40#top", 0),
    ("http://town-hall.example/en/51", 0),
    ("https://gardening.example/en/52", 0),
    ("http://schools.example/de/53", 0),
    ("https://newspaper.example/en/54", 0),
    ("http://city-archive.example/fr/55", 0),
    ("https://bakery.example/en/56", 0),
    ("http://hospital-care.example/es/57", 0),
    ("https://choir-society.example/en/58/", 0),
    ("http://bridge-club.example/de/59", 0),
    ("https://mountain-rescue.example/en/60", 0),
    ("http://philosophy.example/en/61", 0),
    ("https://book-reviews.example/fr/62.html", 0),
]


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def buckets_of(host: Column, path: Column, sizes: Sequence[int] = SIZES, buckets: int = BUCKETS) -> Column:
    """Distinct hash buckets of the character n-grams of host and path, each with marks at both ends; all digits count as 0."""
    return F.array_distinct(
        F.concat(*[_grams(name, part, size, buckets) for name, part in (("h", host), ("p", path)) for size in sizes])
    )


def _grams(name: str, part: Column, size: int, buckets: int) -> Column:
    text = F.concat(F.lit("^"), F.regexp_replace(part, "[0-9]", "0"), F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.transform(
        starts, lambda at: F.pmod(F.xxhash64(F.lit(name), F.substr(text, at, F.lit(size))), F.lit(buckets)).cast("int")
    )


def fit(examples: DataFrame, sizes: Sequence[int] = SIZES, buckets: int = BUCKETS, most: int = MAX_TRAINING) -> tuple[list[float], float]:
    """Weights and intercept from labelled URLs (url, label 0 or 1).

    The table is small: at most ``most`` rows, or it is refused. Rows without a label are left out.
    """
    rows = examples.where("label is not null").select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label")
    if rows.count() > most:
        raise ValueError(f"more than {most} labelled URLs")
    own = buckets_of(F.col("host"), F.col("path"), sizes, buckets)
    flags = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda i: F.array_contains(F.col("own"), i).cast("double"))
    points = staged(rows.withColumn("own", own).coalesce(1), "labelled-urls").select(F.col("label").cast("double").alias("label"), array_to_vector(flags).alias("features"))
    model = LogisticRegression(regParam=0.01, standardization=False, maxIter=30).fit(points)
    return model.coefficients.toArray().tolist(), float(model.intercept)


def score(host: Column, path: Column, weights: Sequence[float], intercept: float, sizes: Sequence[int] = SIZES) -> Column:
    """Probability that the URL is to be blocked."""
    table = F.split(F.lit(",".join(f"{w:.9g}" for w in weights)), ",").cast("array<double>")
    own = buckets_of(host, path, sizes, len(weights))
    margin = F.aggregate(own, F.lit(float(intercept)), lambda total, bucket: total + F.get(table, bucket))
    return 1 / (1 + F.exp(-margin))


def domains_of(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(labels, i, count), "."))


def joined_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path and best (size, rule, verdict) of every distinct place (host, path) that a rule (host, path, verdict) fits.

    Any number of rules: a place meets them by its domains and by the starts of its path that are as long as some rule's, so
    a domain of many rules or places does not multiply them. Repeated rules count once.
    """
    rules = rules.select("host", "path", "verdict").where("host is not null and path is not null").distinct()
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    if not lengths:
        return places.select("host", "path", F.lit(None).cast("struct<size:int,rule:string,verdict:string>").alias("best")).limit(0)
    keys = rules.select(F.col("host").alias("domain"), F.col("path").alias("start"), "verdict")
    starts = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n)
    )
    ways = places.select("host", "path").distinct().select("host", "path", F.explode(domains_of(F.col("host"))).alias("domain"), starts.alias("starts"))
    ways = ways.select("host", "path", "domain", F.explode("starts").alias("start"))
    rule = F.concat("domain", "start")
    met = ways.join(keys, ["domain", "start"]).select("host", "path", F.struct(F.length(rule).alias("size"), rule.alias("rule"), "verdict").alias("fit"))
    return met.groupBy("host", "path").agg(F.max("fit").alias("best"))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule (host, path, verdict) that fits, as struct(size, rule, verdict); null without one.

    A rule fits its host and all subdomains if the path starts with the rule's path. Of equally long rules the
    alphabetically last counts. Rules are looked up by the URL's host and its parent domains, so their number hardly
    matters; they are part of the plan, so more than ``MAX_RULES`` are joined instead (``joined_rules``).
    """
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    by_host: dict[str, list] = {}
    for rule_host, rule_path, verdict in rules:
        by_host.setdefault(rule_host, []).append((rule_path, verdict))
    entries = []
    for rule_host, own in by_host.items():
        choices = [
            F.struct(
                F.lit(len(rule_host + p)).alias("size"), F.lit(rule_host + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(p).alias("start")
            )
            for p, v in own
        ]
        entries += [F.lit(rule_host), F.array(*choices)]
    table = F.create_map(*entries)
    domains = domains_of(host)
    fitting = F.filter(
        F.flatten(F.filter(F.transform(domains, lambda d: F.try_element_at(table, d)), lambda found: found.isNotNull())),
        lambda rule: F.startswith(path, rule["start"]),
    )
    best = F.array_max(F.transform(fitting, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return best


def training_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRAINING, "url string, label int")


def judge(
    urls: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, examples: DataFrame | None = None, cut: float = CUT
) -> DataFrame:
    """``urls`` (url and any columns) with a struct ``judged``: host, path, rule, verdict and score.

    The verdict is the longest fitting rule's, else ``block`` for a score of ``cut`` or more. No shuffle and no Python:
    the weights are a constant of the plan, and so are rules given as a list. Lists of more than ``MAX_RULES`` and tables of rules
    (host, path, verdict) are joined, with the same results. A null URL, or one without ``://``, has an empty host and path, which only a
    rule for an empty host could fit. Every row is judged on its own, so repeated rows give repeated results.
    """
    weights, intercept = fit(examples if examples is not None else training_table(urls.sparkSession))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    cut_up = urls.withColumn("judged", F.struct(host.alias("host"), path.alias("path")))
    host, path = F.col("judged.host"), F.col("judged.path")
    if isinstance(rules, DataFrame) or len(rules) > MAX_RULES:
        table = rules if isinstance(rules, DataFrame) else urls.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
        known = joined_rules(cut_up.select("judged.host", "judged.path"), table).withColumnsRenamed({"host": "__host", "path": "__path", "best": "__best"})
        cut_up = cut_up.join(known, (host == F.col("__host")) & (path == F.col("__path")), "left")
        best = F.col("__best")
    else:
        best = rule_for(host, path, rules)
    ruled = cut_up.withColumn(
        "judged", F.struct(host.alias("host"), path.alias("path"), best.alias("best"), score(host, path, weights, intercept).alias("score"))
    ).select(*[F.col(f"`{c}`") for c in urls.columns if c != "judged"], "judged")
    verdict = F.coalesce(F.col("judged.best.verdict"), F.when(F.col("judged.score") >= cut, F.lit("block")).otherwise(F.lit("allow")))
    return ruled.withColumn(
        "judged",
        F.struct(
            F.col("judged.host").alias("host"),
            F.col("judged.path").alias("path"),
            F.col("judged.best.rule").alias("rule"),
            verdict.alias("verdict"),
            F.col("judged.score").alias("score"),
        ),
    )
