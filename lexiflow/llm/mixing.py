"""Soft-membership mixing: documents are taken at rates that bring domains to target token shares.

1. A naive Bayes classifier learns domains from a labelled table.  Features are the beginnings (5
   characters) of a text's different words and four binned shapes of the text (share of different words, of
   capitals, of symbols, size); the ``MAX_FEATURES`` that tell a domain most surely are kept.  The training
   rows are the ``MAX_LABELLED`` labelled documents with the smallest id hashes.
2. Every document gets the posterior probabilities p of the domains: it belongs to all of them a little.
   Each half of the training rows is scored by the other's classifier; these scores choose how far evidence is
   believed (a temperature, whether it grows with the amount of evidence, and a share of doubt) by log loss.
   Posteriors are rounded to 4 digits.
3. Document rates ``least`` <= r <= ``most`` minimise

       1/2 (a - goal)' M^-1 (a - goal) + RIDGE / 2 * sum(t (r - 1)^2) / T,   a = sum(r t p) / T

   with t the tokens of a document, T their sum and M = sum(t p p') / T, by projected gradient steps: the slope in
   the rates, scaled by the second moments of the rows that are free to move (not held by a bound), is
   followed as far as the value falls enough, and the rates are cut at their bounds, until no rate can improve by moving along
   its slope.  A step is two aggregations with a few numbers a pair of domains; the rates never leave their rows.
4. A document is written floor(rate + u) times, u a hash of its id and text in [0, 1), so that the expected
   tokens of every domain are as fitted.

``total="down"`` takes the most tokens for which no domain has to grow, and no rate exceeds 1: documents go, none is doubled.
``limits`` are upper limits of shares: where the nearest rates still exceed one, the goal is tightened until they don't, or
until that would cost another domain 2% of its tokens.
What was reached is returned, and goals that were missed are logged as a warning.

DataFrame operations only; a token is a run of letters and digits.  Defined results: null and empty texts
have no tokens and the posteriors of no words; labels of other domains and null ids or domains are ignored,
of several for one id the alphabetically first counts; without labels all domains are equally likely;
without tokens every rate is 1; equal rows get equal rates; an empty table gives an empty table; very long
texts are split into words in one row; further columns are kept by ``mix`` whatever their names, and not read by the others.
"""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text, materialise

LOG = logging.getLogger(__name__)
MAX_LABELLED, MAX_FEATURES, BUCKETS = 20_000, 4_096, 1 << 24
#: A feature needs this many documents of a domain.
LEAST_DOCS = 3
#: Choices of the belief in evidence: temperatures, powers of the number of features found, shares of doubt; and how
#: often the starting points are moved.
TEMPERATURES = (0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0, 24.0, 32.0)
ROUNDS, POWERS, DOUBTS = 12, (0.0, 0.5), (0.0001, 0.001, 0.003, 0.01, 0.03, 0.1)
#: Steps stop when no rate would move by more than the tolerance (root mean square); more than MAX_STEPS is an error.
RIDGE, MAX_STEPS, TOLERANCE, LEAST_MOMENT = 0.005, 200, 1e-7, 1e-9
#: Lengths of a step that are tried at once; steps after which the rates are written.
PACES, WRITTEN = (1.0, 0.5, 0.25, 0.125, 0.03, 0.005), 8
#: Token shares this far from the goal are reported; times a limit is tightened, what it may be exceeded by, and the
#: share of another domain's tokens that it may cost.
MISSED, TIGHTENED, EXCESS, SPENT = 0.01, 12, 1e-4, 0.02
#: Domains of op2 and their target token shares.
TARGETS = {"good": 0.85, "poor": 0.10, "toxic": 0.05}


def featured(docs: DataFrame, keys: list[Column], text_col: str) -> DataFrame:
    """keys, tokens, features (different words and shapes)."""
    text = clean_text(text_col)
    count = lambda others: F.length(F.regexp_replace(text, others, ""))
    rows = docs.select(*keys, F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "").alias("w"),
                       count("[^A-Z]+").alias("u"), count("[^#*$%&|<>!]+").alias("s"),
                       F.greatest(F.length(text), F.lit(1)).alias("n"))
    names = [c for c in rows.columns if c not in ("w", "u", "s", "n")]
    rows = rows.select(*names, F.size("w").cast("long").alias("tokens"), F.array_distinct("w").alias("w"), "u", "s", "n")
    bins = {"=d": F.size("w") / F.greatest("tokens", F.lit(1)) * 10, "=u": F.least(F.col("u") / F.col("n") * 20, F.lit(9)),
            "=s": F.least(F.col("s") / F.col("n") * 20, F.lit(9)), "=n": F.least(F.log2(F.col("tokens") + 1) / 2, F.lit(9))}
    shapes = [F.concat(F.lit(k), F.floor(v).cast("int").cast("string")) for k, v in bins.items()]
    return rows.select(*names, "tokens", F.concat("w", F.array(*shapes)).alias("features"))


def _bucket(feature: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring(feature, 1, 5)), F.lit(BUCKETS))


def _weights(cells: DataFrame, counts: dict[str, int], own: list[Column]) -> DataFrame:
    """(bucket, one weight a domain) of at most MAX_FEATURES buckets, from how many documents of each domain have a
    bucket (``own``) and how many there are (``counts``)."""
    total = sum(counts.values())
    share = (sum(own, F.lit(0)) + 0.5) / (total + 1)
    weights, sure = [], []
    for i, (d, n) in enumerate(zip(counts, own)):
        weights.append((F.log((n + 5 * share) / (counts[d] + 5)) - F.log(share)).alias(f"w_{i}"))
        ratio = F.log(((n + 0.5) / (counts[d] + 1)) / share)
        sure.append(F.when(n >= LEAST_DOCS, ratio - 3 * F.sqrt(1 / (n + 0.5))).otherwise(F.lit(-1.0)))
    table = cells.withColumn("surest", F.greatest(*sure, F.lit(-1.0))).filter("surest > 0").orderBy(
        F.desc("surest"), "bucket").limit(MAX_FEATURES).select("bucket", *weights)
    return materialise(table, "domain-weights")


def _priors(counts: dict[str, int]) -> list[float]:
    total = sum(counts.values())
    return [float(np.log((n + 1) / (total + len(counts)))) for n in counts.values()]


def _evidence(rows: DataFrame, keys: list[str], table: DataFrame, k: int) -> DataFrame:
    """keys, found (how many features have weights), s_0, ... (their summed weights by domain) of rows with features."""
    # plain explode would add a filter on the array's size, which makes the array twice
    words = rows.select(*keys, F.explode_outer("features").alias("f")).withColumn("bucket", _bucket(F.col("f")))
    # the table has MAX_FEATURES rows at most
    return words.join(F.broadcast(table), "bucket", "left").groupBy(*keys).agg(
        F.count("w_0").alias("found"), *[F.coalesce(F.sum(f"w_{i}"), F.lit(0.0)).alias(f"s_{i}") for i in range(k)])


def _softmax(rows: DataFrame, belief: Column, base: list[Column]) -> DataFrame:
    """``rows`` with p_0, ...: probabilities of the domains from ``found`` and s_0, ...; ``base`` has what each starts from."""
    k = range(len(base))
    rows = rows.withColumn("_b", belief)
    rows = rows.withColumns({f"_z{i}": F.col(f"s_{i}") / F.col("_b") + base[i] for i in k})
    rows = rows.withColumn("_top", F.greatest(*[F.col(f"_z{i}") for i in k], F.lit(-1e300)))
    rows = rows.withColumns({f"_e{i}": F.exp(F.col(f"_z{i}") - F.col("_top")) for i in k})
    size = sum((F.col(f"_e{i}") for i in k), F.lit(0.0))
    return rows.withColumns({f"p_{i}": F.col(f"_e{i}") / size for i in k}).drop(
        "_b", "_top", *[f"_{c}{i}" for c in "ze" for i in k])


def _doubted(doubt: float, shares: list[float]) -> list[Column]:
    return [(1 - doubt) * F.col(f"p_{i}") + doubt * x for i, x in enumerate(shares)]


def _belief(seen: DataFrame, priors: list[float]) -> tuple[float, float, float, list[float]]:
    """Temperature, power, doubt and starting points with the least log loss on (top, found, s_0, ...), ``top`` the true
    domain's number.  For each temperature and power the starting points are moved until the domains' mean
    probabilities are their shares, so that a text without evidence gets what such texts deserve."""
    shares = [float(x) for x in np.exp(priors) / np.exp(priors).sum()]
    k = len(priors)
    counted = {r.top: r["count"] for r in seen.groupBy("top").count().collect()}  # one row a domain
    sizes = np.array([counted.get(i, 0) for i in range(k)], float)
    if not sizes.sum():
        return 1.0, 0.0, 0.01, priors
    bases = {(t, g): list(priors) for t in TEMPERATURES for g in POWERS}

    def tried() -> DataFrame:
        grid = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(g).alias("g"), F.array(*map(F.lit, base)).alias("base"))
                         for (t, g), base in bases.items()])
        one = seen.select("*", F.explode(grid).alias("c")).select(*seen.columns, "c.*")
        return _softmax(one, F.col("t") * F.pow(F.col("found") + 1, F.col("g")), [F.get("base", F.lit(i)) for i in range(k)])

    for _ in range(ROUNDS):
        sums = tried().groupBy("t", "g").agg(*[F.sum(f"p_{i}").alias(f"p_{i}") for i in range(k)])
        for r in sums.collect():  # one row a temperature and power
            got = np.array([r[f"p_{i}"] for i in range(k)], float)
            bases[r.t, r.g] = [float(x) for x in bases[r.t, r.g] + np.log((sizes + 0.5) / (got + 0.5))]
    losses = tried().groupBy("t", "g").agg(*[F.avg(-F.log(F.get(F.array(*_doubted(d, shares)), F.col("top")))).alias(f"loss_{j}")
                                             for j, d in enumerate(DOUBTS)]).collect()
    _, t, g, d = min((round(r[f"loss_{j}"], 9), r.t, r.g, d) for r in losses for j, d in enumerate(DOUBTS))
    return t, g, d, bases[t, g]


def memberships(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """row, id_col, key (hash of the text), tokens, p (posteriors in the order of ``domains``)."""
    if id_col in ("row", "key", "tokens", "p", "rate"):
        raise ValueError(f"the id column can't be named {id_col}")
    plain = docs.select(F.col(id_col).alias("_id"), clean_text(text_col).alias("_text"))
    known = labelled.select(F.col(id_col).alias("_l"), F.col("domain").alias("_domain")).filter(
        F.col("_domain").isin(domains) & F.col("_l").isNotNull()).groupBy("_l").agg(F.min("_domain").alias("domain"))
    sample = F.broadcast(known.orderBy(F.xxhash64("_l"), "_l").limit(MAX_LABELLED))
    taught = plain.join(sample, F.col("_id") == F.col("_l"))
    taught = materialise(featured(taught, [F.monotonically_increasing_id().alias("row"), F.col("domain"),
                                           F.pmod(F.xxhash64("_l", F.lit(7)), F.lit(2)).alias("half")], "_text"),
                         "labelled-features")
    sizes = {(r.domain, r.half): r["count"] for r in taught.groupBy("domain", "half").count().collect()}  # two rows a domain
    parts = [(d, h) for d in domains for h in (0, 1)]
    cells = materialise(taught.select("domain", "half", F.array_distinct(F.transform("features", _bucket)).alias("b")).select(
        "domain", "half", F.explode_outer("b").alias("bucket")).groupBy("bucket").agg(
        *[F.count_if((F.col("domain") == d) & (F.col("half") == h)).alias(f"n_{domains.index(d)}_{h}") for d, h in parts]),
        "domain-cells")

    def learnt(halves: tuple[int, ...]) -> tuple[DataFrame, list[float]]:
        counts = {d: sum(sizes.get((d, h), 0) for h in halves) for d in domains}
        own = [sum((F.col(f"n_{i}_{h}") for h in halves), F.lit(0)) for i in range(len(domains))]
        return _weights(cells, counts, own), _priors(counts)

    table, priors = learnt((0, 1))
    place = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")) - 1
    seen = None
    for half in (0, 1):
        one = _evidence(taught.filter(F.col("half") == 1 - half), ["row", "domain"], learnt((half,))[0], len(domains))
        seen = one if seen is None else seen.unionByName(one)
    scores = [f"s_{i}" for i in range(len(domains))]
    t, g, doubt, base = _belief(materialise(seen.select(place.cast("int").alias("top"), "found", *scores), "evidence"), priors)
    keys = [F.monotonically_increasing_id().alias("row"), F.col("_id").alias("id"), F.xxhash64("_text").alias("key")]
    found = _evidence(featured(plain, keys, "_text"), ["row", "id", "key", "tokens"], table, len(domains))
    shares = [float(x) for x in np.exp(priors) / np.exp(priors).sum()]
    found = _softmax(found, t * F.pow(F.col("found") + 1, F.lit(g)), [F.lit(x) for x in base])
    first = [F.round(x, 4) for x in _doubted(doubt, shares)[:-1]]
    rest = F.greatest(F.round(1 - sum(first, F.lit(0.0)), 4), F.lit(0.0))
    return materialise(found.select("row", F.col("id").alias(id_col), "key", "tokens", F.array(*first, rest).alias("p")),
                       "memberships")


def _goal(now: np.ndarray, weight: np.ndarray, low: np.ndarray, total: str | float, tokens: float) -> np.ndarray:
    """Token shares of today's total to aim at; what limits don't use goes to the other domains."""
    held = np.where(low, np.minimum(weight, now), weight)
    if weight[~low].sum() > 0:
        held[~low] *= (1 - held[low].sum()) / weight[~low].sum()
    if total == "same":
        return held
    if total == "down":
        return held * float((now[held > 0] / held[held > 0]).min())
    return held * (float(total) / tokens)


def fit_rates(members: DataFrame, targets: dict[str, float], total: str | float = "same",
              least: float = 0.0, limits: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """``members`` with ``rate``, and what was reached.

    ``total``: tokens to aim at, ``same`` as there are, or ``down``: the most for which no domain grows.
    ``limits``: domains whose target is an upper limit; what they lack of it goes to the other domains.
    """
    names, k = list(targets), len(targets)
    p = [F.get("p", F.lit(i)) for i in range(k)]
    first = members.agg(F.sum("tokens").alias("t"), *[F.sum(F.col("tokens") * x) for x in p],
                        *[F.sum(F.col("tokens") * p[i] * p[j]) for i in range(k) for j in range(k)]).first()
    if not first[0]:
        return members.withColumn("rate", F.lit(1.0)), {}
    tokens = float(first[0])
    now, m = np.array(first[1:1 + k], float) / tokens, np.array(first[1 + k:], float).reshape(k, k) / tokens
    weight = np.array([targets[d] for d in names], float) / sum(targets.values())
    low = np.array([d in limits for d in names])
    goal = aim = _goal(now, weight, low, total, tokens)
    most = 1.0 if total == "down" else float("inf")
    sizes, axes = np.linalg.eigh(m)  # directions without tokens are left out
    kept = sizes > LEAST_MOMENT * sizes[-1]
    inverse = axes[:, kept] / sizes[kept] @ axes[:, kept].T
    rows = members.select("*", F.lit(min(1.0, most)).alias("_rate"))
    last, gain = None, np.ones(k)  # how much an aim has to fall for its share to fall by one, as the last step told
    rows, reached = _steps(rows, p, tokens, m, inverse, aim, float(least), most)
    floor = np.where(low, -1.0, (1 - SPENT) * reached)
    for _ in range(TIGHTENED):
        over = np.where(low, reached - weight * reached.sum() * (1 - EXCESS), 0.0)
        if (reached[low] <= weight[low] * reached.sum() * (1 + EXCESS)).all():
            break
        if last is not None:
            fell = last[1] - over
            gain = np.where(fell > 1e-12, np.clip((last[0] - aim) / np.where(fell > 1e-12, fell, 1.0), 1.0, 50.0), gain)
        last = aim, over
        aim = aim - np.maximum(over, 0.0) * gain  # may fall below 0: what the other goals pull back is made up for
        tighter, got = _steps(rows, p, tokens, m, inverse, aim, float(least), most)
        if (got < floor).any():
            break
        rows, reached = tighter, got
    excess = [d for i, d in enumerate(names) if low[i] and reached[i] > weight[i] * reached.sum() * (1 + MISSED)]
    if np.abs(reached - goal).max() > MISSED or excess:
        LOG.warning("mixing: token shares %s are the nearest to the goal %s%s", *(
            {d: round(float(v), 4) for d, v in zip(names, x)} for x in (reached, goal)),
            f"; over their limits: {excess}" if excess else "")
    out = rows.withColumn("rate", F.round("_rate", 3)).drop("_rate")
    return out, {"goal": dict(zip(names, goal)), "before": dict(zip(names, now)), "reached": dict(zip(names, reached)),
                 "over_limit": excess}


def _steps(rows: DataFrame, p: list[Column], tokens: float, m: np.ndarray, inverse: np.ndarray, goal: np.ndarray,
           least: float, most: float) -> tuple[DataFrame, np.ndarray]:
    """Projected gradient steps on ``_rate`` until it is optimal; the rows with the new rates, and the shares reached."""
    k = len(p)
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    w, rate = F.col("tokens") / tokens, F.col("_rate")

    def along(v: np.ndarray) -> Column:
        return sum((x * float(y) for x, y in zip(p, v)), F.lit(0.0))

    def cut(r: Column) -> Column:
        low = F.greatest(r, F.lit(least))
        return low if most == float("inf") else F.least(low, F.lit(most))

    def sums(r: Column) -> list[Column]:
        """What the value needs: the shares reached, and the spread of the rates."""
        return [*[F.sum(w * r * x) for x in p], F.sum(w * (r - 1) ** 2)]

    def value(got) -> float:
        gap = np.array(got[:k], float) - goal
        return float(gap @ inverse @ gap / 2 + RIDGE / 2 * got[k])

    got = rows.agg(*sums(rate)).first()
    reached, now = np.array(got[:k], float), value(got)
    for step in range(1, MAX_STEPS + 1):
        pull = inverse @ (reached - goal)
        slope = along(pull) + RIDGE * (rate - 1)
        held = ((rate <= least) & (slope > 0)) | (F.lit(most != float("inf")) & (rate >= most) & (slope < 0))
        free = F.when(~held, w).otherwise(0.0)
        moved = (cut(rate - slope) - rate) ** 2
        seen = rows.agg(F.sum(w * moved), *[F.sum(free * slope * x) for x in p],
                        *[F.sum(free * p[i] * p[j]) for i, j in pairs]).first()
        if np.sqrt(seen[0]) <= TOLERANCE:
            return rows, reached
        inner = np.zeros((k, k))
        for (i, j), v in zip(pairs, seen[1 + k:]):
            inner[i, j] = inner[j, i] = v
        # (RIDGE + P M^-1 P'w)^-1 of the free rows, applied to their slope
        back = np.linalg.lstsq(RIDGE * m + inner, np.array(seen[1:1 + k], float), rcond=1e-12)[0]
        down = (slope - along(back)) / RIDGE
        tries = [cut(rate - pace * down) for pace in PACES] + [cut(rate - slope)]
        found = rows.agg(*[x for r in tries for x in sums(r)]).first()
        options = [found[i * (k + 1):(i + 1) * (k + 1)] for i in range(len(tries))]
        best = min(range(len(tries)), key=lambda i: value(options[i]))
        if value(options[best]) >= now - 1e-15 * max(1.0, abs(now)):
            return rows, reached  # as near as the arithmetic goes
        rows = rows.withColumn("_rate", tries[best])
        if step % WRITTEN == 0:
            rows = materialise(rows, "rates")
        reached, now = np.array(options[best][:k], float), value(options[best])
    raise RuntimeError(f"no rates found in {MAX_STEPS} steps")


def copies(id_col: str) -> Column:
    """How often a row is written."""
    u = F.pmod(F.xxhash64(id_col, "key", F.lit(20_11)), F.lit(1_000_003)) / 1_000_003.0
    return F.floor(F.col("rate") + u).cast("long")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: str | float = "same",
        least: float = 0.0, id_col: str = "doc_id", text_col: str = "text",
        limits: tuple[str, ...] = (), told: dict | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its rate asks, with all columns.  What ``fit_rates`` reached is put
    into ``told``.

    ``labelled`` has id_col and domain.  Texts are shuffled once, by id and text hash; repeated rows have
    the same rate.
    """
    members = memberships(docs, labelled, list(targets), id_col, text_col)
    rates, reached = fit_rates(members, targets, total, least, limits)
    if told is not None:
        told.update(reached)
    times = rates.groupBy(F.col(id_col).alias("_id"), F.col("key").alias("_key")).agg(
        F.max(copies(id_col)).alias("_times"))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                        F.col(id_col).alias("_i"), F.xxhash64(clean_text(text_col)).alias("_k")).join(
        times, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")))
    repeated = found.filter("_times > 0").select(
        "_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_n"))
    return repeated.select("_doc.*")


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from a table of quality and toxicity marks."""
    return labels.filter("quality IS NOT NULL AND toxic IS NOT NULL").select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
        .alias("domain"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, p_<domain>, rate, copies of every document."""
    members = memberships(docs, label_domains(labels), list(TARGETS))
    rates, _ = fit_rates(members, TARGETS)
    return rates.select("doc_id", F.col("tokens").alias("n_tokens"), *[
        F.round(F.get("p", F.lit(i)), 6).alias(f"p_{d}") for i, d in enumerate(TARGETS)], "rate",
        copies("doc_id").alias("copies"))
