"""URL filter: explicit rules first, then logistic regression on hashed character n-grams of host and path.

The longest rule that fits an address decides: a rule names a host, which covers its subdomains, and the start of a path.
Addresses without a rule get the model's verdict. Features are the distinct character runs of ``SIZES`` symbols of the host (with its ends marked) and of
the path, hashed apart into ``FEATURES`` places; the model is Spark ML's, fitted on a small table of labelled addresses. Everything runs
inside the JVM, one narrow pass over the addresses; nothing is shuffled, so neither a hot host nor repeated rows matter.

Defined cases: a null address, or one without ``://``, has an empty host and path and no rule, and the model judges the empty
address; an address may be of any length and is read whole; rules of equal length: block wins; repeated rows are judged alike; labels of one class
only, or none, give that class to every address without a rule (none: allow); null labels and null addresses in the labelled table are left out. An
empty table gives an empty result. Extra columns are kept by ``judge``, but for those that carry its results' names, which it replaces.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingguard.llm.common import lower_ascii

ALLOW, BLOCK = "allow", "block"
SIZES = (3, 4, 5)
FEATURES = 1 << 17
PENALTY = 0.002
THRESHOLD = 0.5
#: Rules are part of the plan; a longer list belongs into a table.
MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)

# The labelled table: invented addresses of sites that a corpus does not want (gambling, pills, adult, advertising, link farms, malware).
UNWANTED = (
    "http://casino-royal.example.org/en/12", "https://www.mega-casino.example.net/de/5/", "http://online-casino.example.com/fr/bonus",
    "https://poker-win.example.net/en/77", "http://win-jackpot.example.org/es/3.html", "https://m.slots-win.example.com/de/40",
    "http://free-spins.example.net/fr/8", "https://best-bets.example.org/en/91?ref=x", "http://sports-bets.example.com/es/6",
    "https://blog.bets-now.example.net/de/15", "http://betting-tips.example.org/en/2", "https://free-lottery.example.com/fr/60",
    "http://cheap-viagra.example.net/en/4", "https://pills-online.example.org/de/71", "http://www.diet-pills.example.com/es/9",
    "https://buy-pills.example.net/fr/33.html", "http://cheap-meds.example.org/en/18", "https://m.cheap-pharma.example.com/de/27",
    "http://cheap-watches.example.net/es/80", "https://replica-cheap.example.org/fr/1", "http://adult-video.example.net/en/64",
    "https://www.adult-cams.example.org/de/22", "http://adult-dating.example.com/fr/45", "https://xxx-tube.example.net/es/13",
    "http://hot-x.example.org/en/90", "https://m.sex-x.example.com/de/7", "http://porn-free.example.net/fr/52",
    "https://ads-server.example.org/en/31", "http://www.ads-click.example.net/de/68", "https://pop-ads.example.com/es/20",
    "http://ad-track.example.org/fr/17", "https://click-track.example.net/en/49", "http://track-pixel.example.com/de/36",
    "https://banner-ads.example.org/es/58", "http://spam-blog.example.net/en/23", "https://www.spam-links.example.org/de/81",
    "http://link-farm.example.com/fr/10", "https://seo-farm.example.net/es/74", "http://content-farm.example.org/en/6",
    "https://m.spam-mail.example.com/de/55", "http://free-cracks.example.net/fr/29", "https://warez-free.example.org/en/84",
    "http://free-money.example.com/es/47", "https://payday-loan.example.net/de/3", "http://quick-cash.example.org/fr/66",
    "https://miracle-cure.example.com/en/38", "http://phish-login.example.net/es/11", "https://malware-drop.example.org/de/94",
)
# Addresses of ordinary sites.
WANTED = (
    "http://library.example.org/en/12", "https://www.university.example.net/de/5/", "http://daily-news.example.com/fr/index",
    "https://thenews.example.net/en/77", "http://museum.example.org/es/3.html", "https://m.weather.example.com/de/40",
    "http://recipes.example.net/fr/8", "https://science.example.org/en/91?ref=x", "http://history.example.com/es/6",
    "https://blog.garden.example.net/de/15", "http://teaching.example.org/en/2", "https://motion.example.com/fr/60",
    "http://nation.example.net/en/4", "https://station.example.org/de/71", "http://www.theatre.example.com/es/9",
    "https://other.example.net/fr/33.html", "http://another.example.org/en/18", "https://m.together.example.com/de/27",
    "http://thesis.example.net/es/80", "https://thermal.example.org/fr/1", "http://author.example.net/en/64",
    "https://www.southern.example.org/de/22", "http://northland.example.com/fr/45", "https://mathforum.example.net/es/13",
    "http://healthline.example.org/en/90", "https://m.youth.example.com/de/7", "http://truth.example.net/fr/52",
    "https://fiction.example.org/en/31", "http://www.reading.example.net/de/68", "https://painting.example.com/es/20",
    "http://bookshop.example.org/fr/17", "https://gardening.example.net/en/49", "http://climate.example.com/de/36",
    "https://parliament.example.org/es/58", "http://writers.example.net/en/23", "https://www.wholefood.example.org/de/81",
    "http://hospital.example.com/fr/10", "https://astronomy.example.net/es/74", "http://village.example.org/en/6",
    "https://m.translation.example.com/de/55", "http://orchestra.example.net/fr/29", "https://photo-club.example.org/en/84",
    "http://town-hall.example.com/es/47", "https://chess-club.example.net/de/3", "http://open-data.example.org/fr/66",
    "https://bird-watch.example.com/en/38", "http://flower.example.net/es/11", "https://railway.example.org/de/94",
)


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched(rules: Sequence[Rule]) -> Column:
    """(length, blocks, text) of the longest rule that fits the columns ``host`` and ``path``; null where none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; {MAX_RULES} at most")
    kind = "struct<length:int,blocks:boolean,text:string>"
    found = F.lit(None).cast(kind)
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == BLOCK)):  # the last one that fits is kept
        fits = ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col("path").startswith(r.path)
        one = F.struct(F.lit(len(r.text)).alias("length"), F.lit(r.verdict == BLOCK).alias("blocks"), F.lit(r.text).alias("text"))
        found = F.when(fits, one.cast(kind)).otherwise(found)
    return found


def grams(text: Column, mark: str) -> Column:
    """The distinct runs of ``SIZES`` symbols, each with the mark of its field."""
    signs = F.split(text, "")

    def of(n: int) -> Column:
        last = F.size(signs) - n
        starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(signs, i, n), "")))

    return F.array_distinct(F.concat(*[of(n) for n in SIZES]))


def described(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path`` and the hashed ``_features``."""
    parts = urls.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    ends = F.concat(F.lit("^"), F.col("host"), F.lit("$"))
    listed = parts.withColumn("_grams", F.concat(grams(ends, "h"), grams(F.col("path"), "p")))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="_features").transform(listed).drop("_grams")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table, (url, label)."""
    rows = [(u, 1) for u in UNWANTED] + [(u, 0) for u in WANTED]
    return spark.createDataFrame(rows, "url string, label int")


def fit(labelled: DataFrame) -> LogisticRegressionModel | float:
    """The model of (url, label) rows, 1 for unwanted; a constant where there is only one class."""
    rows = labelled.where(F.col("url").isNotNull() & F.col("label").isin(0, 1)).select("url", F.col("label").cast("double"))
    classes = {r.label for r in rows.select("label").distinct().collect()}
    if len(classes) < 2:
        return max(classes, default=0.0)
    est = LogisticRegression(featuresCol="_features", labelCol="label", regParam=PENALTY, standardization=False, maxIter=200)
    return est.fit(described(rows))


def scored(urls: DataFrame, model: LogisticRegressionModel | float, url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path`` and ``score``, the model's probability that the address is unwanted."""
    rows = described(urls, url)
    if isinstance(model, float):
        return rows.drop("_features").withColumn("score", F.lit(model))
    named = model.copy().setProbabilityCol("_probability").setRawPredictionCol("_raw").setPredictionCol("_predicted")
    out = named.transform(rows).withColumn("score", vector_to_array("_probability")[1])
    return out.drop("_features", "_probability", "_raw", "_predicted")


def judge(
    urls: DataFrame,
    model: LogisticRegressionModel | float,
    rules: Sequence[Rule] = RULES,
    url: str = "url",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``urls`` with host, path, score, rule (text of the deciding rule or null) and verdict (allow or block)."""
    found = scored(urls, model, url).withColumn("_rule", matched(rules))
    blocks = F.coalesce(F.col("_rule.blocks"), F.col("score") >= threshold)
    return found.withColumns({"rule": F.col("_rule.text"), "verdict": F.when(blocks, BLOCK).otherwise(ALLOW)}).drop("_rule")
