"""URL filtering by domain rules and, where no rule fits, logistic regression on hashed character n-grams.

The model is fitted to a small table of labelled URLs: plain arithmetic on a few hundred features. Judging
pages is one projection of built-in functions: host and path are cut out, rules compared, n-grams of
three characters turned into buckets, and the buckets' weights added. It has no shuffle and no Python.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmill.session import quoted

BUCKETS = 4096
# What unwanted and wanted hosts are commonly called; no host of a given table is among them.
_UNWANTED = (
    "royal-casino lucky-slots poker-room jackpot-city roulette-online sure-betting live-bets lotto-winner viagra-store "
    "discount-pharmacy diet-pills pills-direct payday-loans quick-loans easy-money free-iphone free-gifts win-prizes replica-watches "
    "cheap-handbags cheap-tickets-deal porn-videos xxx-movies adult-dating adult-cams escort-girls hot-singles adserver ads-network "
    "click-tracker track-clicks popup-banner spam-links buy-backlinks link-exchange content-farm warez-download cracked-keys crypto-doubler"
).split()
_WANTED = (
    "library city-museum weather university gardening recipes chess-club history-society physics newspaper railway football council "
    "hospital primary-school open-data python-docs maps savings-bank hiking-trails national-park theatre orchestra astronomy "
    "bookshop translation dictionary farmers-market architecture cycling fishing wood-work genealogy law-review medical-journal "
    "travel-notes photography kitchen-stories village-life radio "
    # Names that mean nothing are no ground to block.
    "lorem ipsum dolor amet consectetur adipiscing elit tempor labore magna aliqua veniam nostrud ullamco commodo consequat"
).split()
_PLACES = [("www.", ".example.com", "/"), ("", ".example", "/index.html"), ("blog.", ".example.net", "/2021/05/17/post"), ("m.", ".example.org", "/about?ref=a"), ("shop.", ".example", "/item/1042#top")]
#: (host and path, 1 = block). A parameter: give your own table for your own policy.
LABELLED = [
    (f"{sub}{name}{end}{path}", label)
    for label, names in ((1, _UNWANTED), (0, _WANTED))
    for i, name in enumerate(names)
    for sub, end, path in (_PLACES[i % 5], _PLACES[(i + 2) % 5])
]


def _buckets(text: str, kind: int) -> list[int]:
    codes = [1, *map(ord, text), 2]
    return [(a * 961 + b * 31 + c + kind * 1777) % BUCKETS for a, b, c in zip(codes, codes[1:], codes[2:], strict=False)]


def _features(host: str, path: str) -> list[int]:
    return sorted({*_buckets(host, 0), *_buckets(path, 1)}) if host or path else []


def trained(labelled: Sequence[tuple[str, int]] = LABELLED, *, rounds: int = 800, rate: float = 0.5, penalty: float = 1e-4) -> list[float]:
    """Weights of the buckets and, last, the bias. Without labelled URLs everything scores 0, which isn't above it."""
    rows = [(_features(*re.match(r"([^/?#]*)([^?#]*)", url.lower()).groups()), label) for url, label in labelled]
    weights = dict.fromkeys({b for buckets, _ in rows for b in buckets}, 0.0)
    bias = 0.0
    for _ in range(rounds):
        slope = dict.fromkeys(weights, 0.0)
        total = 0.0
        for buckets, label in rows:
            error = (1 / (1 + math.exp(-sum(weights[b] for b in buckets) - bias)) - label) / len(rows)
            total += error
            for b in buckets:
                slope[b] += error
        bias -= rate * total
        weights = {b: w - rate * (slope[b] + penalty * w) for b, w in weights.items()}
    return [round(weights.get(b, 0.0), 6) for b in range(BUCKETS)] + [round(bias, 6)]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting (rule, verdict) as a struct, null if none fits; of equally long ones the first by name."""
    fits = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, rest = rule.partition("/")
        own = (host == domain) | host.endswith(f".{domain}")
        fits.append(F.when(own & path.startswith(slash + rest), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule: string, verdict: string>")


def _hashed(text: Column, kind: int) -> Column:
    codes = F.concat(F.array(F.lit(1)), F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), F.ascii), F.array(F.lit(2)))
    shifted = F.arrays_zip(codes.alias("a"), F.slice(codes, 2, F.greatest(F.size(codes), F.lit(1))).alias("b"), F.slice(codes, 3, F.greatest(F.size(codes), F.lit(1))).alias("c"))
    whole = F.filter(shifted, lambda g: g["c"].isNotNull())
    return F.transform(whole, lambda g: (g["a"] * 961 + g["b"] * 31 + g["c"] + kind * 1777) % BUCKETS)


def chance(host: Column, path: Column, weights: Sequence[float]) -> Column:
    """Probability that a URL is to be blocked."""
    known = F.array(*[F.lit(float(w)) for w in weights])
    both = F.array_sort(F.array_distinct(F.concat(_hashed(host, 0), _hashed(path, 1))))
    buckets = F.when((host == "") & (path == ""), F.array().cast("array<int>")).otherwise(both)
    score = F.aggregate(buckets, F.lit(float(weights[-1])), lambda s, b: s + F.element_at(known, b + 1))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], weights: Sequence[float] | None = None, *, url: str = "url", limit: float = 0.5) -> DataFrame:
    """All rows with ``host``, ``path``, ``rule`` (null if none fits), ``p_block`` and ``verdict`` (allow or block).

    ``rules`` are (host/path-prefix, verdict) and fit a host and its subdomains. A null url or one without
    ``://`` has empty host and path, fits no rule and is judged by the model's bias alone. Existing columns
    of the added names are replaced. Repeated rows are judged alike.
    """
    added = ["host", "path", "rule", "p_block", "verdict"]
    weights = trained() if weights is None else weights
    kept = [quoted(c) for c in pages.columns if c.lower() not in added]
    host, path = split_url(F.col(quoted(url)).cast("string"))
    cut = pages.select("*", F.struct(host.alias("host"), path.alias("path")).alias("_cut"))
    h, p = F.col("_cut.host"), F.col("_cut.path")
    fit = matching_rule(h, p, rules)
    block = chance(h, p, weights)
    return cut.select(
        *kept, h.alias("host"), p.alias("path"), fit["rule"].alias("rule"), block.alias("p_block"),
        F.coalesce(fit["verdict"], F.when(block > limit, "block").otherwise("allow")).alias("verdict"),
    )
