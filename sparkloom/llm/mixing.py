"""Mixing sources to target weights.

Method: entropy balancing. Every document gets a rate at which it is used. The
rates stay as close as they can to "everything once" in relative entropy over
tokens, under two kinds of constraints: each source supplies its share of the
tokens, and over all sources together the mix keeps what the pool is like (the
tokens' mean and spread of document length, their share of each language), so
that changing the weights of sources does not change the corpus in passing. The
dual is convex, with one multiplier for each source and one for each feature,
shared by all sources. Newton iterations solve it, each one a distributed
aggregation over the (source, language, size) histogram of the corpus. The
rates are exponential tilts, min(exp(source + features . multipliers),
max_repeats), and differ from document to document within a source.

The shares and the cap are hard. The features are elastic (a quadratic penalty
of RIDGE on their multipliers), so that there always is a solution: where
sources cannot keep the pool's lengths or languages, they come as near as the
penalty says and the report tells how near.

Rates are rounded into copies by a fixed uniform number of each document,
shifted so that the rounded tokens, not the rates, meet the target; that shift
is found from two histograms of that number per source.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.common import cut
from sparkloom.llm.tokens import VOCABULARY, count_tokens

BINS = 4096
NEWTON_STEPS = 60
#: Weight of the penalty on the features' multipliers, per token of the mix.
RIDGE = 1e-3
#: Relative error of a source's tokens at which the dual counts as solved.
CLOSE = 1e-9
#: Features of a document beside its source, in units of the pool's spread: length, length squared, and language.
FEATURES = ("length", "spread", "hindi", "other_language")


def source_key(c: Column) -> Column:
    """A source's name in one spelling: case, blanks, hyphens and underscores do not matter."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s_-]+", "_")


def language_key(c: Column) -> Column:
    """en, hi or other: the language as tagged, in any spelling; an unknown one is ``other``."""
    tag = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(tag.rlike("^en"), "en").when(tag.rlike("^hi"), "hi").otherwise("other")


def clean_targets(targets: DataFrame) -> list[dict]:
    """Targets as rows on the driver (a table of settings, one row per mix and source): shares add up to 1, repeated rows once."""
    rows = targets.where("mix_name is not null and source is not null and target_share > 0 and max_repeats >= 1").groupBy(
        "mix_name", source_key(F.col("source")).alias("source")
    ).agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).orderBy("mix_name", "source").collect()
    sums: dict[str, float] = {}
    for r in rows:
        sums[r.mix_name] = sums.get(r.mix_name, 0.0) + r.share
    return [{"mix": r.mix_name, "source": r.source, "share": r.share / sums[r.mix_name], "cap": int(r.cap)} for r in rows]


def _features(length: Column, language: Column, mean: Column, spread: Column) -> list[Column]:
    """The values of FEATURES for a document of ``n_tokens`` and a language."""
    z = F.greatest(F.lit(-4.0), F.least(F.lit(4.0), (F.log(length) - mean) / spread))
    return [z, z * z, (language == "hi").cast("double"), (language == "other").cast("double")]


def set_goals(targets: list[dict], totals: dict[str, int]) -> list[dict]:
    """Targets of sources with tokens, with ``goal`` tokens each.

    A mix is as large as its sources' tokens together, or as large as the
    source that its cap binds most allows; such a source is ``bound``: all its
    documents are used as often as they may be. Sources without tokens get
    nothing and the other shares keep their proportions.
    """
    live = [dict(t) for t in targets if totals.get(t["source"], 0) > 0]
    for mix in {t["mix"] for t in live}:
        own = [t for t in live if t["mix"] == mix]
        whole = sum(t["share"] for t in own)
        size = min(sum(totals[t["source"]] for t in own), *(totals[t["source"]] * t["cap"] * whole / t["share"] for t in own))
        for t in own:
            t["goal"] = size * t["share"] / whole
            t["bound"] = t["goal"] >= totals[t["source"]] * t["cap"] * (1 - 1e-12)
    return live


class Dual:
    """The dual of one mix: multipliers of its unbound sources, then of the features."""

    def __init__(self, targets: list[dict], totals: dict[str, int], pool: dict[str, np.ndarray]):
        self.all = targets
        self.free = [t for t in targets if not t["bound"]]
        self.mix = targets[0]["mix"]
        size = sum(t["goal"] for t in targets)
        # What the bound sources bring to the features is given; the rest is what the others have to bring.
        tokens = sum(totals[t["source"]] for t in targets)
        self.want = size * sum(pool[t["source"]] for t in targets) / tokens - sum((t["cap"] * pool[t["source"]] for t in targets if t["bound"]), np.zeros(len(FEATURES)))
        self.goal = np.array([t["goal"] for t in self.free])
        self.size, self.scale = size, max(1.0, float(self.goal.sum()))
        self.x = np.concatenate([np.log([t["goal"] / totals[t["source"]] for t in self.free]), np.zeros(len(FEATURES))])
        self.value, self.step, self.moved, self.steps = np.inf, None, None, 0
        self.done = not self.free
        self.gap = self.error = 0.0

    def take(self, sums: dict[str, dict]) -> None:
        """One Newton step (or half of the last one, where that went too far) from the sums at x."""
        s, m = len(self.free), len(FEATURES)
        value, grad, hess = 0.0, np.zeros(s + m), np.zeros((s + m, s + m))
        for i, t in enumerate(self.free):
            r = sums[t["source"]]
            value += r["phi"]
            grad[i] = r["w"] - t["goal"]
            grad[s:] += r["f"]
            hess[i, i] = r["c"]
            hess[i, s:] = hess[s:, i] = r["cf"]
            hess[s:, s:] += r["cff"]
        lam, mu = self.x[:s], self.x[s:]
        value += 0.5 * RIDGE * self.scale * mu @ mu - lam @ self.goal - mu @ self.want
        grad[s:] += RIDGE * self.scale * mu - self.want
        hess[s:, s:] += RIDGE * self.scale * np.eye(m)
        self.steps += 1
        if value > self.value + 1e-12 * abs(self.value) and self.step is not None and np.abs(self.step).max() > 1e-12:
            self.step = self.step / 2
            self.x = self.moved + self.step
            return
        self.error = float((np.abs(grad[:s]) / self.goal).max())
        self.off = (grad[s:] - RIDGE * self.scale * mu) / self.scale
        hess[np.diag_indices(s + m)] += 1e-12 * self.scale
        step = -np.linalg.solve(hess, grad)
        self.gap = float(-grad @ step / self.scale)
        if self.error < CLOSE and np.abs(grad[s:]).max() < 1e-7 * self.scale:
            self.done = True
            return
        step *= min(1.0, 4.0 / np.abs(step).max())
        self.value, self.moved, self.step, self.x = value, self.x, step, self.x + step

    def multipliers(self) -> list[tuple]:
        """(mix, source, own multiplier, cap, bound, goal, features' multipliers) of every source."""
        own = dict(zip((t["source"] for t in self.free), self.x, strict=False))
        mu = [float(v) for v in self.x[len(self.free) :]]
        return [(self.mix, t["source"], float(own.get(t["source"], 0.0)), int(t["cap"]), bool(t["bound"]), float(t["goal"]), *mu) for t in self.all]


MULTIPLIERS = "mix_name string, source string, lam double, cap int, bound boolean, goal double, " + ", ".join(f"m{k} double" for k in range(len(FEATURES)))


def _exponent() -> Column:
    return sum((F.col(f"m{k}") * F.col(f"f{k}") for k in range(len(FEATURES))), F.col("lam"))


def solve(spark: SparkSession, cells: DataFrame, duals: list[Dual]) -> None:
    """Newton's method on the duals of all mixes at once: every step is one aggregation over the cells.

    cells: source, mass (tokens), f0, f1, ... . What comes to the driver is one row for each mix and source.
    """
    n = range(len(FEATURES))
    for _ in range(NEWTON_STEPS):
        todo = [d for d in duals if not d.done]
        if not todo:
            return
        table = spark.createDataFrame([r for d in todo for r in d.multipliers() if not r[4]], MULTIPLIERS)
        rated = cells.join(F.broadcast(table), "source")  # one row for each mix and source
        u, top = _exponent(), F.log(F.col("cap").cast("double"))
        rated = rated.withColumn("_u", u).withColumn("_w", F.col("mass") * F.least(F.exp(F.least("_u", top)), F.col("cap")))
        rated = rated.withColumn("_c", F.when(F.col("_u") < top, F.col("_w")).otherwise(0.0))
        phi = F.col("_w") + F.when(F.col("_u") > top, F.col("mass") * F.col("cap") * (F.col("_u") - top)).otherwise(0.0)
        sums = [F.sum(phi).alias("phi"), F.sum("_w").alias("w"), F.sum("_c").alias("c")]
        sums += [F.sum(F.col("_w") * F.col(f"f{i}")).alias(f"f{i}") for i in n] + [F.sum(F.col("_c") * F.col(f"f{i}")).alias(f"c{i}") for i in n]
        sums += [F.sum(F.col("_c") * F.col(f"f{i}") * F.col(f"f{j}")).alias(f"c{i}{j}") for i in n for j in n if i <= j]
        got: dict[str, dict[str, dict]] = {}
        for r in rated.groupBy("mix_name", "source").agg(*sums).collect():
            both = np.array([[r[f"c{min(i, j)}{max(i, j)}"] for j in n] for i in n])
            got.setdefault(r.mix_name, {})[r.source] = {"phi": r.phi, "w": r.w, "c": r.c, "f": np.array([r[f"f{i}"] for i in n]), "cf": np.array([r[f"c{i}"] for i in n]), "cff": both}
        for d in todo:
            d.take(got[d.mix])


def _uniform(ids: list[Column], seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *ids), F.lit(1 << 48)) / F.lit(float(1 << 48))


def plan_mixes(docs: DataFrame, targets: DataFrame, path: str = VOCABULARY) -> tuple[DataFrame, list[Dual]]:
    """Sized documents (doc_id, source, n_tokens, f0, ...) of the targets' sources, and the solved dual of every mix."""
    spark = docs.sparkSession
    wanted = clean_targets(targets)
    lang = language_key(F.col("lang")) if "lang" in docs.columns else F.lit("other")
    ready = docs.where("doc_id is not null and text is not null").select("doc_id", source_key(F.col("source")).alias("source"), lang.alias("lang"), "text")
    ready = ready.where(F.col("source").isin([t["source"] for t in wanted]))
    sized = count_tokens(ready, ["doc_id", "source", "lang"], path=path).where("n_tokens > 0")
    sized = sized.groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens", "lang")).alias("x")).select("doc_id", "x.source", "x.n_tokens", "x.lang")
    sized = cut(sized, "mix-sizes")
    counts = cut(sized.groupBy("source", "lang", "n_tokens").agg((F.count(F.lit(1)) * F.col("n_tokens")).cast("double").alias("mass")), "mix-histogram")
    log = F.log("n_tokens")
    mean, spread = counts.agg(F.sum(F.col("mass") * log) / F.sum("mass"), F.sqrt(F.greatest(F.sum(F.col("mass") * log * log) / F.sum("mass") - (F.sum(F.col("mass") * log) / F.sum("mass")) ** 2, F.lit(1e-6)))).first()
    f = [c.alias(f"f{k}") for k, c in enumerate(_features(F.col("n_tokens"), F.col("lang"), F.lit(mean or 0.0), F.lit(spread or 1.0)))]
    cells = counts.select("source", "mass", *f)
    pool = cells.groupBy("source").agg(F.sum("mass").alias("t"), *[F.sum(F.col("mass") * F.col(f"f{k}")).alias(f"f{k}") for k in range(len(FEATURES))]).collect()  # one row a source
    totals = {r.source: r.t for r in pool}
    live = set_goals(wanted, totals)
    moments = {r.source: np.array([r[f"f{k}"] for k in range(len(FEATURES))]) for r in pool}
    duals = [Dual([t for t in live if t["mix"] == mix], totals, moments) for mix in sorted({t["mix"] for t in live})]
    solve(spark, cells, duals)
    return sized.select("doc_id", "source", "n_tokens", *f), duals


CHOSEN = "mix_name string, doc_id bigint, source string, n_tokens bigint, copies int, rate double"


def mix_documents(docs: DataFrame, targets: DataFrame, path: str = VOCABULARY, seed: int = 11) -> DataFrame:
    """mix_name, doc_id, source, n_tokens, copies (1 or more), rate of the chosen documents of every mix.

    A mix is as large as its sources' tokens, or as large as max_repeats
    allows if that is less. No document is used more often than max_repeats.
    Sources are matched in one spelling. Documents without source, of sources
    without target, and without tokens are in no mix; a null language counts
    as one of its own. Repeated rows of a doc_id count once (the first by
    source). Shares are met to within the size of a few documents.
    """
    sized, duals = plan_mixes(docs, targets, path)
    return choose(sized, duals, seed)


def choose(sized: DataFrame, duals: list[Dual], seed: int = 11) -> DataFrame:
    """The documents of solved mixes with their rates rounded into copies."""
    spark = sized.sparkSession
    live = [r for d in duals for r in d.multipliers()]
    if not live:
        return spark.createDataFrame([], CHOSEN)
    rated = sized.join(F.broadcast(spark.createDataFrame(live, MULTIPLIERS)), "source")  # one row for each mix and source
    cap = F.col("cap").cast("double")
    rate = F.when(F.col("bound"), cap).otherwise(F.least(F.exp(F.least(_exponent(), F.lit(50.0))), cap))
    rated = rated.withColumn("rate", rate).withColumn("_u", _uniform([F.col("doc_id"), F.xxhash64("mix_name")], seed))
    # A document has floor(rate) copies and one more if its number lies above 1 - fraction; ``_z`` is what its number exceeds that by.
    rated = rated.withColumn("_low", F.floor("rate").cast("int")).withColumn("_z", F.col("_u") - (1 - (F.col("rate") - F.floor("rate"))))
    rated = rated.withColumn("_z", F.when(F.col("_low") < F.col("cap"), F.col("_z")))
    rated = cut(rated.select("mix_name", "doc_id", "source", "n_tokens", "rate", "_low", "_z"), "mix-rated")
    shift = spark.createDataFrame(_shift(rated, live), "mix_name string, source string, cut double")
    chosen = rated.join(F.broadcast(shift), ["mix_name", "source"]).withColumn("copies", (F.col("_low") + F.when(F.col("_z") >= F.col("cut"), 1).otherwise(0)).cast("int"))
    return chosen.where("copies > 0").select("mix_name", "doc_id", "source", "n_tokens", "copies", "rate")


def _shift(rated: DataFrame, live: list[tuple]) -> list[tuple[str, str, float]]:
    """Where to cut ``_z`` per mix and source so that the rounded tokens meet the goal, by two histograms of BINS bins each."""
    base = {(r.mix_name, r.source): float(r.t or 0) for r in rated.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("_low")).alias("t")).collect()}
    # The whole range of _z is [-1, 1): the first pass finds the bin in which the goal is met, the second the place in the bin.
    state = {r[:2]: (-1.0, 2.0, r[5] - base.get(r[:2], 0.0)) for r in live}
    for _ in range(2):
        spark = rated.sparkSession
        ranges = spark.createDataFrame([(m, s, lo, w) for (m, s), (lo, w, _) in state.items()], "mix_name string, source string, lo double, w double")
        bins = rated.where("_z is not null").join(F.broadcast(ranges), ["mix_name", "source"])
        at = F.floor((F.col("_z") - F.col("lo")) / F.col("w") * BINS)
        counts = bins.withColumn("_bin", at).where((F.col("_bin") >= 0) & (F.col("_bin") < BINS)).groupBy("mix_name", "source", "_bin").agg(F.sum("n_tokens").alias("t")).collect()  # at most BINS rows a source
        per: dict[tuple[str, str], dict[int, int]] = {}
        for r in counts:
            per.setdefault((r.mix_name, r.source), {})[int(r["_bin"])] = int(r.t)
        for key, (lo, w, need) in state.items():
            got, edge = 0.0, BINS
            own = per.get(key, {})
            while edge > 0 and got + own.get(edge - 1, 0) <= need:
                edge -= 1
                got += own.get(edge, 0)
            # Bin edge - 1 holds the place where the goal is met; above it everything is taken.
            lo, w = (lo + (edge - 1) * w / BINS, w / BINS) if edge > 0 else (lo, w / BINS)
            state[key] = (lo, w, need - got)
    return [(m, s, lo + w) for (m, s), (lo, w, _) in state.items()]


def mix_shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """mix_name, source, target_share, reached_share, n_docs, n_tokens, most_copies, max_repeats, at_the_cap: the report of a mix.

    at_the_cap: every document of the source is used as often as it may be, so the source bounds the mix's size.
    Sources that supply nothing come out with 0.
    """
    spark = chosen.sparkSession
    wanted = spark.createDataFrame([(t["mix"], t["source"], float(t["share"]), t["cap"]) for t in clean_targets(targets)], "mix_name string, source string, target_share double, max_repeats int")
    per = chosen.groupBy("mix_name", "source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("n_tokens") * F.col("copies")).alias("n_tokens"), F.max("copies").alias("most_copies"), F.min("rate").alias("_least"),
    )
    all_ = per.groupBy("mix_name").agg(F.sum("n_tokens").alias("_all"))
    zero = {"n_docs": 0, "n_tokens": 0, "most_copies": 0}
    return wanted.join(per, ["mix_name", "source"], "left").join(all_, "mix_name", "left").select(
        "mix_name", "source", F.round("target_share", 6).alias("target_share"),
        F.round(F.coalesce(F.col("n_tokens") / F.col("_all"), F.lit(0.0)), 6).alias("reached_share"), "n_docs", "n_tokens", "most_copies", "max_repeats",
        F.coalesce(F.col("_least") >= F.col("max_repeats"), F.lit(False)).alias("at_the_cap"),
    ).na.fill(zero)


def mix_balance(duals: list[Dual], spark: SparkSession) -> DataFrame:
    """One row for each mix and feature: what the pool has, what the mix is off by (both per token), and how the dual was solved.

    share_of_pool: tokens of the mix over its sources' tokens; below 1 where a cap binds.
    """
    rows = []
    for d in duals:
        off = getattr(d, "off", np.zeros(len(FEATURES)))
        pool = sum(t["goal"] for t in d.all)
        rows += [(d.mix, f, float(off[k]), d.steps, d.gap, d.error, float(pool), ",".join(t["source"] for t in d.all if t["bound"])) for k, f in enumerate(FEATURES)]
    return spark.createDataFrame(rows, "mix_name string, feature string, off_by double, newton_steps int, dual_gap double, worst_source_error double, goal_tokens double, sources_at_the_cap string")
