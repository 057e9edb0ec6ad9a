"""URL filters (operator 3): host and path rules, and gradient-boosted trees for the rest.

The trees see lexical features only: length, depth, digit ratio, entropy, parameter counts and
the block rate of the host's suffixes. Labels are the verdicts of the rules. Training reads a
bounded sample of labelled URLs (``TRAIN_ROWS``, chosen by hash). One half of it gives the suffixes'
rates and the other fits the trees, so that these learn what a rate is worth on new URLs. The
fitted trees are compiled into one expression, so that judging every row is a projection without
user functions.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
judged by the trees (its features are those of an empty text); without labels, or with one
verdict only, the trees are that constant (allow, if there is none). Rows are judged one by one; an
empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

import json
import math
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS = 24, 3, 0.3, 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``host`` and all its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (UrlRule("net", "/", "block"), UrlRule("example.net", "/en/", "allow"), UrlRule("example.com", "/de/", "block"), UrlRule("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # a longer rule is tested first, as it is wrapped later
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def suffixes_of(host: Column) -> tuple[Column, Column]:
    """The last label of a host, and the last two."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features that need nothing but the URL."""
    text = F.coalesce(url, F.lit(""))
    n = F.length(text)
    chars = F.split(text, "")
    letters = F.filter(chars, lambda c: c != "")
    share = lambda c: F.size(F.filter(letters, lambda x: x == c)) / F.greatest(n, F.lit(1))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return {
        "length": n.cast("double"),
        "host_length": F.length(host).cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "labels": F.size(F.split(host, "\\.")).cast("double"),
        "digit_ratio": F.regexp_count(text, F.lit("[0-9]")) / F.greatest(n, F.lit(1)),
        "entropy": F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c))),
        "parameters": F.when(query == "", F.lit(0.0)).otherwise(F.size(F.split(query, "&")).cast("double")),
        "hyphens": F.regexp_count(host, F.lit("-")).cast("double"),
        "plain_http": F.when(text.startswith("http://"), F.lit(1.0)).otherwise(F.lit(0.0)),
    }


@dataclass
class Model:
    """Trees over binned features, each a nested (feature, threshold, left, right) or a leaf value."""

    prior: float
    suffix_rate: float = 0.5
    suffixes: dict[str, float] = field(default_factory=dict)
    trees: list = field(default_factory=list)


def _suffix_rate(suffix: Column, model: Model) -> Column:
    """The suffix's rate from a constant hash table of small maps; the mean rate for suffixes that the sample lacks."""
    if not model.suffixes:
        return F.lit(model.suffix_rate)
    slots: list[dict[str, float]] = [{} for _ in range(1 << max(0, (len(model.suffixes) // 4).bit_length()))]
    for s, rate in sorted(model.suffixes.items()):
        slots[zlib.crc32(s.encode()) % len(slots)][s] = rate
    table = F.from_json(F.lit(json.dumps(slots)), "array<map<string,double>>")
    slot = (F.crc32(F.encode(suffix, "UTF-8")) % len(slots)).cast("int")
    return F.coalesce(F.element_at(F.get(table, slot), suffix), F.lit(model.suffix_rate))


def _columns(url: Column, host: Column, path: Column) -> dict[str, Column]:
    one, two = suffixes_of(host)
    return lexical(url, host, path) | {"suffix": one, "domain": two}


def fit(urls: DataFrame, url_col: str = "url", rules: tuple[UrlRule, ...] = RULES, rows: int = TRAIN_ROWS) -> Model:
    """Trains on at most ``rows`` distinct URLs that a rule decides, in the order of a hash of the URL."""
    split = urls.select(F.col(url_col).alias("u")).withColumn("h", host_of(F.col("u"))).withColumn("p", path_of(F.col("u")))
    labelled = split.withColumn("label", rule_of(F.col("h"), F.col("p"), rules)[1]).filter("label is not null").select("u", "h", "p", (F.col("label") == "block").cast("int").alias("y"))
    sample = labelled.groupBy("u", "h", "p").agg(F.max("y").alias("y")).orderBy(F.xxhash64("u"), "u").limit(rows)
    features = _columns(F.col("u"), F.col("h"), F.col("p"))
    got = sample.select("u", "y", *(c.alias(k) for k, c in features.items())).collect()
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return Model(prior=-4.0 if not len(y) or y[0] == 0 else 4.0)
    base = float(y.mean())
    model = Model(prior=math.log(base / (1 - base)), suffix_rate=base)
    half = np.array([zlib.crc32((r["u"] or "").encode()) & 1 for r in got], bool)
    counts: dict[str, list[float]] = {}
    for r in (r for r, other in zip(got, half, strict=True) if not other):
        for s in {r["suffix"], r["domain"]}:
            c = counts.setdefault(s, [0.0, 0.0])
            c[0], c[1] = c[0] + r["y"], c[1] + 1
    model.suffixes = {s: (pos + 5 * base) / (n + 5) for s, (pos, n) in sorted(counts.items())}
    names = [k for k in features if k not in ("suffix", "domain")]
    fitting = [r for r, other in zip(got, half, strict=True) if other]
    x = np.array([[float(r[k]) for k in names] + [model.suffixes.get(r["suffix"], base), model.suffixes.get(r["domain"], base)] for r in fitting]).reshape(-1, len(names) + 2)
    y = y[half]
    if not len(y):
        return model
    model.trees = _boost(x, y, [*names, "suffix_rate", "domain_rate"], model.prior)
    return model


def _boost(x: np.ndarray, y: np.ndarray, names: list[str], prior: float) -> list:
    """Second-order boosting on the logistic loss over quantile bins."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    score, trees = np.full(len(y), prior), []

    def grow(rows: np.ndarray, depth: int, g: np.ndarray, h: np.ndarray):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        if depth < DEPTH:
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                gs, hs = (np.cumsum(np.bincount(binned[rows, j], weights=v[rows], minlength=len(e) + 1))[:-1] for v in (g, h))
                gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                gain[(hs < 1) | (total_h - hs < 1)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, k))
        if best[1] is None:
            value = -RATE * total_g / (total_h + 1)
            score[rows] += value
            return float(value)
        j, k = best[1]
        low = binned[rows, j] <= k
        return names[j], float(edges[j][k]), grow(rows[low], depth + 1, g, h), grow(rows[~low], depth + 1, g, h)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        trees.append(grow(np.arange(len(y)), 0, p - y, p * (1 - p)))
    return trees


def _compiled(tree, features: dict[str, Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    name, edge, low, high = tree
    return F.when(features[name] <= edge, _compiled(low, features)).otherwise(_compiled(high, features))


def judge(urls: DataFrame, model: Model, url_col: str = "url", rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``block_score`` (of the trees) and ``verdict``."""
    taken = {"host", "path", "rule", "block_score", "verdict", "__url"} & set(urls.columns)
    if taken:
        raise ValueError(f"the input already has columns {sorted(taken)}")
    url = F.col(url_col)
    df = urls.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    name, decided = rule_of(F.col("host"), F.col("path"), rules)
    one, two = suffixes_of(F.col("host"))
    made = lexical(url, F.col("host"), F.col("path")) | {"suffix_rate": _suffix_rate(one, model), "domain_rate": _suffix_rate(two, model)}
    df = df.withColumn("__url", F.struct(name.alias("rule"), decided.alias("decided"), *(c.alias(k) for k, c in made.items())))
    held = {k: F.col(f"__url.{k}") for k in made}
    total = F.lit(model.prior)
    for tree in model.trees:
        total = total + _compiled(tree, held)
    df = df.withColumn("block_score", 1 / (1 + F.exp(-total)))
    verdict = F.coalesce(F.col("__url.decided"), F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return df.select(*urls.columns, "host", "path", F.col("__url.rule").alias("rule"), "block_score", verdict.alias("verdict"))
