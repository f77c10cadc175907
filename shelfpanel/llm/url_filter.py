"""URL filter: explicit rules first, then logistic regression on hashed character n-grams of host and path.

The model is trained here from a small labelled table of URLs (a parameter; a default is below), by gradient
descent in numpy; its weights have a fixed size. Scoring is one pass over the URL column without a shuffle.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule and is scored as such
(allowed, by the model's bias); with an empty labelled table every score is 0.5; ties between rules of equal length go to the rule listed first; repeated rows give
repeated results; only the id and URL columns are read.
"""

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.llm.common import ascii_lower

SIZES = (3, 4, 5)
BUCKETS = 1 << 14
RUN = 1 << 18  # bytes of URLs scored at once
#: (verdict, rule) as the contract gives them (fixed values).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

#: Names and paths of sites to block and to allow, from which the labelled table is made (fixed values).
BAD_NAMES = [
    "casino-win", "casino-royal", "best-casino", "cheap-pills", "pills-online", "buy-pills", "ads-track", "track-ads",
    "click-ads", "ad-server", "adserve", "win-prize", "free-win", "poker-bonus", "slots-jackpot", "bet-now",
    "sports-bets", "viagra-shop", "pharma-cheap", "cheap-meds", "replica-watches", "fast-loans", "payday-loan",
    "xxx-videos", "adult-cams", "hot-singles", "warez-crack", "keygen-free", "crypto-doubler", "lottery-winner",
    "spam-mail", "malware-load", "phish-login", "clickbait-hub", "track-pixel", "banner-ads",
]
GOOD_NAMES = [
    "library", "university", "museum", "daily-news", "weather", "science-notes", "cooking", "gardening", "history",
    "travel-diary", "open-data", "city-council", "school", "math-forum", "linux-help", "docs", "wiki", "research",
    "hospital", "music-review", "book-club", "chess", "astronomy", "nature", "language-learn", "photography",
    "bicycle", "architecture", "local-paper", "radio", "physics", "biology", "poetry", "theatre", "parliament", "archive",
]
BAD_PATHS = ["/win", "/bonus", "/cheap", "/pills/buy", "/ads/click", "/track", "/casino", "/promo/free"]
GOOD_PATHS = ["", "/", "/en/12", "/fr/345", "/de/67.html", "/es/890/", "/article/2020", "/about", "/news/today"]
FRONTS = ["", "www.", "m.", "blog."]
ENDS = ["example.com", "example.org", "example.net"]


def labelled_urls() -> list[tuple[str, str, int]]:
    """The default training table: (host, path, 1 for block). Both kinds get the same front parts, ends and neutral paths."""
    rows = []
    for label, names in ((1, BAD_NAMES), (0, GOOD_NAMES)):
        for i, name in enumerate(names):
            for j, end in enumerate(ENDS):
                host = f"{FRONTS[(i + j) % len(FRONTS)]}{name}.{end}"
                paths = [GOOD_PATHS[(i + j) % len(GOOD_PATHS)], (BAD_PATHS if label else GOOD_PATHS)[(2 * i + j) % len(BAD_PATHS)]]
                rows += [(host, p, label) for p in paths]
    return rows


def bucket_counts(host: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of host and path (apart from each other) and their weights, of length 1 together."""
    found = []
    for seed, part in ((17, host), (29, path)):
        codes = np.frombuffer(("^" + part + "$").encode(), dtype=np.uint8).astype(np.uint64)
        for size in SIZES:
            if len(codes) >= size:
                h = np.full(len(codes) - size + 1, seed * 31 + size, dtype=np.uint64)
                for k in range(size):
                    h = h * np.uint64(0x100000001B3) + codes[k : len(codes) - size + 1 + k] + np.uint64(1)
                found.append((h ^ (h >> np.uint64(29))) % np.uint64(BUCKETS))
    where, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    return where.astype(np.int64), counts / max(1e-9, np.sqrt((counts**2).sum()))


class UrlModel:
    """Weights per bucket and a bias."""

    def __init__(self, rows: Sequence[tuple[str, str, int]], rounds: int = 60, rate: float = 2.0, decay: float = 1e-4):
        self.weights, self.bias = np.zeros(BUCKETS), 0.0
        features = [bucket_counts(h, p) for h, p, _ in rows]
        order = np.random.default_rng(7)
        for step in range(rounds):
            pace = rate / (1 + 0.05 * step)
            for i in order.permutation(len(rows)):
                where, values = features[i]
                error = rows[i][2] - 1 / (1 + np.exp(-(self.weights[where] @ values + self.bias)))
                self.weights[where] += pace * (error * values - decay * self.weights[where])
                self.bias += 0.05 * pace * error

    def score(self, host: str, path: str) -> float:
        where, values = bucket_counts(host, path)
        return float(1 / (1 + np.exp(-(self.weights[where] @ values + self.bias))))

    def scores(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """``score`` of many URLs, the n-grams of all hashed at once, in runs of about ``RUN`` bytes."""
        sizes = np.cumsum([len(h) + len(p) for h, p in zip(hosts, paths)])
        runs = np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(sizes // RUN)) + 1)
        return np.concatenate([self._run([hosts[i] for i in run], [paths[i] for i in run]) for run in runs])

    def _run(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        keys = []  # number of the URL and bucket of each n-gram
        for seed, parts in ((17, hosts), (29, paths)):
            marked = [("^" + p + "$").encode() for p in parts]
            codes = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
            owners = np.repeat(np.arange(len(parts)), [len(m) for m in marked])
            for size in SIZES:
                n = max(0, len(codes) - size + 1)
                h = np.full(n, seed * 31 + size, dtype=np.uint64)
                for k in range(size):
                    h = h * np.uint64(0x100000001B3) + codes[k : n + k] + np.uint64(1)
                places = ((h ^ (h >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)
                within = owners[:n] == owners[size - 1 : size - 1 + n]  # not across two URLs
                keys.append((owners[:n] * BUCKETS + places)[within])
        found, counts = np.unique(np.concatenate(keys), return_counts=True)
        owner, place = found // BUCKETS, found % BUCKETS
        sums = np.bincount(owner, counts * self.weights[place], len(hosts))
        norms = np.sqrt(np.bincount(owner, counts.astype(np.float64) ** 2, len(hosts)))
        return 1 / (1 + np.exp(-(sums / np.maximum(norms, 1e-9) + self.bias)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z folded) and path of a URL; both empty without ``://``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_for(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a path that starts with the rule's."""
    ranked = sorted(rules, key=lambda r: -len(r[1]))  # stable: the first of equal length stays first

    def fits(rule):
        name, slash, rest = rule[1].partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)

    return reduce(
        lambda found, rule: found.when(fits(rule), F.struct(F.lit(rule[1]).alias("rule"), F.lit(rule[0]).alias("verdict"))),
        ranked[1:],
        F.when(fits(ranked[0]), F.struct(F.lit(ranked[0][1]).alias("rule"), F.lit(ranked[0][0]).alias("verdict"))),
    )


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, labelled=None, threshold: float = 0.5
) -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule`` (or null), ``score`` (model's chance of block) and ``verdict``."""
    model = pages.sparkSession.sparkContext.broadcast(UrlModel(labelled_urls() if labelled is None else labelled))

    @F.pandas_udf("double")
    def score(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series(model.value.scores(host.tolist(), path.tolist()), dtype="float64")

    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    parts = rows.select("id", host.alias("host"), path.alias("path"))
    found = rule_for(F.col("host"), F.col("path"), rules) if rules else F.lit(None).cast("struct<rule:string,verdict:string>")
    return (
        parts.withColumn("found", found)
        .withColumn("score", score("host", "path"))
        .select(
            F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"), "score",
            F.coalesce("found.verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"),
        )
    )
