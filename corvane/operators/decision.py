"""From probabilities to matches: ranks, thresholds with caps, exclusivity, and tuning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metrics import fbeta

PAIR = ["source1_entity_id", "candidate_entity_id"]
THRESHOLDS = tuple(round(0.20 + 0.02 * k, 2) for k in range(36))
CAPS = (None, 1, 2, 3, 5, 8, 12)


def scored_pairs(pairs: DataFrame) -> DataFrame:
    """Add ``prob_rank`` by probability, then candidate rank, then id."""
    w = Window.partitionBy("source1_entity_id").orderBy(F.col("probability").desc(), "candidate_rank", "candidate_entity_id")
    return pairs.withColumn("prob_rank", F.row_number().over(w))


def source_of(id: Column) -> Column:
    return F.when(id.startswith("S2-"), "S2").otherwise("S3")


def decided(scored: DataFrame, s2: float | Column, s3: float | Column | None = None, cap: int | Column | None = None) -> DataFrame:
    """Pairs that reach their source's threshold within the cap; the rank counts all candidates."""
    s3 = s2 if s3 is None else s3
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    rows = scored.where(F.col("probability") >= F.when(source_of(F.col("candidate_entity_id")) == "S2", col(s2)).otherwise(col(s3)))
    return rows if cap is None else rows.where(col(cap).isNull() | (F.col("prob_rank") <= col(cap)))


def exclusive(pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Each target goes to the S1 record with the highest probability, ties to the first id."""
    w = Window.partitionBy(*by, "candidate_entity_id").orderBy(F.col("probability").desc(), "source1_entity_id")
    return pairs.withColumn("_at", F.row_number().over(w)).where("_at = 1").drop("_at")


def decide(scored: DataFrame, rule: dict) -> DataFrame:
    rows = decided(scored, rule["threshold_s2"], rule["threshold_s3"], rule["cap"])
    return exclusive(rows) if rule["bipartite"] else rows


def overridden(rule: dict, threshold: float | None = None, cap: int | None = None) -> dict:
    return rule | ({"threshold_s2": threshold, "threshold_s3": threshold} if threshold is not None else {}) | ({"cap": cap} if cap is not None else {})


def _pass(sides: tuple[list[float], ...], source: Column) -> tuple[Column, Column]:
    """(bin, fixed): the last threshold of a varied list that a probability reaches, -1 for none; null and whether it passes where the list holds one value."""
    s2, s3 = sides
    reached = lambda t: F.size(F.filter(F.array(*[F.lit(float(x)) for x in t]), lambda x: x <= F.col("probability"))) - 1
    return F.when(source == "S2", reached(s2)).otherwise(reached(s3)), F.when(source == "S2", len(s2) == 1).otherwise(len(s3) == 1)


def grid_scores(scored: DataFrame, truth: DataFrame, s1: DataFrame, s2=THRESHOLDS, s3=None, caps=CAPS, bipartite: bool = False, beta: float = 0.5) -> DataFrame:
    """(s2, s3, cap, ord, score): macro F-beta of each point of a small grid, all in one pass over the pairs.

    ``s3`` None takes s2's threshold, else one of the two lists holds one value.  Thresholds rise; they are the outer
    loop of ``ord``, caps the inner.  As a threshold falls, an S1 record's pairs come in one after the other by
    probability, so its F changes only where a pair comes in: each pair within a cap gives the change at the last
    threshold it reaches, and the sum of the changes from a threshold on is the score there.  A pair is never dealt to
    the points.  Which pair keeps a target under exclusivity depends on the cap alone, as all pairs of a target have one
    threshold.
    """
    spark, s2 = scored.sparkSession, [float(x) for x in s2]
    both = s3 is None
    s3 = s2 if both else [float(x) for x in s3]
    if not both and min(len(s2), len(s3)) > 1 or sorted(s2) != s2 or sorted(s3) != s3:
        raise ValueError("thresholds rise, and only one of two lists varies")
    varied = s2 if len(s2) >= len(s3) else s3
    steps = len(varied)
    cap_rows = F.array(*[F.struct(F.lit(k).alias("j"), F.lit(c).cast("int").alias("cap")) for k, c in enumerate(caps)])
    source = source_of(F.col("candidate_entity_id"))
    at, alone = _pass((s2, s3), source)
    rows = labels_of(scored, truth).select(*PAIR, "probability", "prob_rank", "hit", at.alias("at"), (F.lit(not both) & alone).alias("fixed"))
    rows = rows.where("at >= 0").withColumn("c", F.explode(cap_rows)).select("*", "c.j", "c.cap").drop("c").where(F.col("cap").isNull() | (F.col("prob_rank") <= F.col("cap")))
    if bipartite:
        rows = exclusive(rows, ("j",))
    n_truth = truth.groupBy("source1_entity_id").agg(F.count("*").alias("n_truth"))
    ids = s1.select("source1_entity_id").distinct().join(n_truth, "source1_entity_id", "left").na.fill(0, ["n_truth"])
    # pairs of the side whose threshold stands still come in before all others
    came = Window.partitionBy("j", "source1_entity_id").orderBy(F.col("fixed").desc(), F.col("at").desc(), "prob_rank")
    rows = rows.withColumn("n", F.row_number().over(came)).withColumn("tp", F.sum("hit").over(came.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(ids, "source1_entity_id")
    f = lambda tp, n: fbeta(tp, n, F.col("n_truth"), beta)
    change = f(F.col("tp"), F.col("n")) - f(F.col("tp") - F.col("hit"), F.col("n") - 1)
    changes = rows.groupBy("j", F.when(F.col("fixed"), steps - 1).otherwise(F.col("at")).alias("at")).agg(F.sum(change).alias("d"))
    # from here on there are as many rows as points
    totals = ids.agg(F.count("*").alias("n"), F.count_if(F.col("n_truth") == 0).cast("double").alias("start"))
    points = [(float(a), float(b), c, k * len(caps) + j, k, j) for k, (a, b) in enumerate([(t, t) for t in s2] if both else [(a, b) for a in s2 for b in s3]) for j, c in enumerate(caps)]
    points = spark.createDataFrame(points, "s2 double, s3 double, cap int, ord int, k int, j int")
    reached = points.select("ord", "k", "j").join(changes, "j").where(F.col("at") >= F.col("k")).groupBy("ord").agg(F.sum("d").alias("d"))
    rows = points.join(reached, "ord", "left").crossJoin(F.broadcast(totals))
    return rows.select("s2", "s3", "cap", "ord", F.coalesce(F.try_divide(F.col("start") + F.coalesce("d", F.lit(0.0)), F.col("n")), F.lit(0.0)).alias("score"))


def labels_of(scored: DataFrame, truth: DataFrame) -> DataFrame:
    hits = truth.select(*PAIR).distinct().withColumn("hit", F.lit(1))
    return scored.join(hits, PAIR, "left").withColumn("hit", F.coalesce("hit", F.lit(0)))


def best(scores: DataFrame) -> DataFrame:
    """The first point of the highest score, scores compared to 12 digits."""
    return scores.orderBy(F.round("score", 12).desc(), "ord").limit(1)


def grid_search(scored: DataFrame, truth: DataFrame, s1: DataFrame, thresholds=THRESHOLDS, caps=CAPS, beta: float = 0.5) -> DataFrame:
    return best(grid_scores(scored, truth, s1, thresholds, caps=caps, beta=beta))


def source_thresholds(scored: DataFrame, truth: DataFrame, s1: DataFrame, cap: int | None, thresholds=THRESHOLDS, bipartite: bool = False, beta: float = 0.5) -> dict:
    """Thresholds by source, from .5 each: the best for S2, then with it the best for S3."""
    s2 = best(grid_scores(scored, truth, s1, thresholds, [0.5], [cap], bipartite, beta)).first()
    s3 = best(grid_scores(scored, truth, s1, [s2["s2"]], thresholds, [cap], bipartite, beta)).first()
    return {"mode": "source_specific", "threshold_s2": s3["s2"], "threshold_s3": s3["s3"], "cap": cap, "bipartite": bipartite, "score": s3["score"]}


def choose(scored: DataFrame, truth: DataFrame, s1: DataFrame, thresholds=THRESHOLDS, caps=CAPS) -> dict:
    """The best of a global rule, the same with exclusivity, and source thresholds with exclusivity; the first wins ties."""
    g = grid_search(scored, truth, s1, thresholds, caps).first()
    rule = {"mode": "global", "threshold_s2": g["s2"], "threshold_s3": g["s3"], "cap": g["cap"], "bipartite": False, "score": g["score"]}
    again = grid_scores(scored, truth, s1, [g["s2"]], caps=[g["cap"]], bipartite=True).first()
    options = [rule, rule | {"bipartite": True, "score": again["score"]}, source_thresholds(scored, truth, s1, g["cap"], thresholds, True)]
    return max(options, key=lambda r: round(r["score"], 12))
