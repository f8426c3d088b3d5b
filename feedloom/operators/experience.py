"""Scoring, sampling and summarising logged control experience."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.actions import action_value, constrained_scores, huber, masked_argmax
from feedloom.operators.blocks import freeze_order, with_row_number
from feedloom.operators.ranking import smallest_n
from feedloom.session import shared_dir

# Defaults of the replay and training parameters.
PRIORITY_EXPONENT = 0.6
WEIGHT_EXPONENT = 0.4
PRIORITY_FLOOR = 1e-6
PRIORITY_OFFSET = 1e-5
DISCOUNT = 0.99
EMA_RATE = 0.03
DUAL_RATE = 3e-3
COST_BUDGET = 0.10
FIRST_DUAL = 0.1
Q_RATE = 0.3
Q_DISCOUNT = 0.98
# Rows of a run that one window holds.
SEGMENT = 1 << 16


def uniform_from_key(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key and the seed only (52 bits of a digest)."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def _with_mass(buffer: DataFrame, priority: str, alpha: float) -> DataFrame:
    return buffer.withColumn("_mass", F.pow(F.greatest(F.col(priority), F.lit(PRIORITY_FLOOR)), F.lit(alpha)))


def prioritised_sample(
    buffer: DataFrame,
    key: str,
    priority: str,
    n: int,
    alpha: float = PRIORITY_EXPONENT,
    beta: float = WEIGHT_EXPONENT,
    seed: int = 0,
) -> DataFrame:
    """n rows with probability in proportion to priority^alpha, and their importance weights.

    Without replacement by exponential keys; a buffer of fewer than n rows is drawn with
    replacement. ``weight`` is (N * probability)^-beta over the largest of the sample.
    """
    weighted = _with_mass(buffer, priority, alpha)
    totals = weighted.agg(F.count("*").alias("n"), F.sum("_mass").alias("mass")).first()
    size, mass = totals["n"], totals["mass"] or 0.0
    if size < n:
        drawn = _draw_with_replacement(weighted, key, n, mass, seed)
    else:
        keyed = weighted.withColumn("_draw", -F.ln(uniform_from_key(F.col(key), seed)) / F.col("_mass"))
        drawn = smallest_n(keyed, "_draw", key, n).drop("_draw")
    probability = F.col("_mass") / F.lit(float(mass))
    scored = drawn.withColumn("probability", probability).withColumn(
        "_weight", F.pow(F.lit(float(size)) * F.col("probability"), F.lit(-beta))
    )
    # The sample has n rows, so this window is as small as the caller asked for.
    largest = F.max("_weight").over(Window.partitionBy(F.lit(1)))
    return scored.withColumn("weight", F.col("_weight") / largest).drop("_weight", "_mass")


def _draw_with_replacement(weighted: DataFrame, key: str, n: int, mass: float, seed: int) -> DataFrame:
    """n draws by position on the cumulative mass; both sides have at most n rows."""
    up_to = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    ends = weighted.select(F.sum("_mass").over(up_to).alias("at"), F.col(key).alias("hit"))
    draws = weighted.sparkSession.range(n).select(
        (uniform_from_key(F.col("id"), seed) * mass).alias("at"), F.lit(None).alias("hit")
    )
    ahead = Window.orderBy("at", F.col("hit").isNotNull()).rowsBetween(0, Window.unboundedFollowing)
    last = Window.orderBy("at", F.col("hit").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A draw rounded past the last end belongs to the last row.
    owner = F.coalesce(F.first("hit", ignorenulls=True).over(ahead), F.last("hit", ignorenulls=True).over(last))
    hits = draws.unionByName(ends).select("hit", owner.alias(key)).where("hit is null").select(key)
    return hits.join(weighted, key)


def priority_refresh(buffer: DataFrame, td: DataFrame, key: str, priority: str = "priority") -> DataFrame:
    """New priority |td_r| + |td_c| + 1e-5 (at least 1e-6) for rows in ``td``; others unchanged."""
    fresh = td.groupBy(key).agg(
        F.max(
            F.greatest(F.abs("td_r") + F.abs("td_c") + F.lit(PRIORITY_OFFSET), F.lit(PRIORITY_FLOOR))
        ).alias("_fresh")
    )
    return buffer.join(fresh, key, "left").withColumn(priority, F.coalesce("_fresh", priority)).drop("_fresh")


def td_errors(df: DataFrame, gamma: float = DISCOUNT, cost_weight: float = FIRST_DUAL) -> DataFrame:
    """Double-estimator TD errors and their smooth L1 size per row.

    Needs q_r_sa, q_c_sa (values of the taken action), r, c, done, weight; next-state arrays
    next_q_r, next_q_c (online), next_q_r_target, next_q_c_target, and next_mask.
    """
    best = masked_argmax(
        constrained_scores(F.col("next_q_r"), F.col("next_q_c"), cost_weight), F.col("next_mask")
    )
    chosen = df.withColumn("next_action", best)
    live = (1.0 - F.col("done").cast("double")) * gamma
    target_r = F.col("r") + live * action_value(F.col("next_q_r_target"), F.col("next_action"))
    target_c = F.col("c") + live * action_value(F.col("next_q_c_target"), F.col("next_action"))
    return chosen.withColumns(
        {"td_r": F.col("q_r_sa") - target_r, "td_c": F.col("q_c_sa") - target_c}
    ).withColumns({"huber_r": huber(F.col("td_r")), "huber_c": huber(F.col("td_c"))})


def td_loss(errors: DataFrame, cost_weight: float = FIRST_DUAL) -> DataFrame:
    """One row: weighted mean losses over rows (not over the sum of weights) and their combination."""
    means = errors.agg(
        F.avg(F.col("huber_r") * F.col("weight")).alias("loss_r"), F.avg(F.col("huber_c") * F.col("weight")).alias("loss_c")
    )
    return means.withColumn("loss", F.col("loss_r") + cost_weight * F.col("loss_c"))


def ema_dual(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    x: str,
    rate: float = EMA_RATE,
    dual_rate: float = DUAL_RATE,
    budget: float = COST_BUDGET,
    first_dual: float = FIRST_DUAL,
) -> DataFrame:
    """Per row of an ordered run: ema = (1-a)*ema + a*x from 0, and the dual weight
    max(0, weight + lr*(ema - budget)) from ``first_dual``.

    Both recursions are unrolled into running sums and a running minimum over segments of a
    fixed number of rows, with one carried row per (run, segment); no run is held in one place.
    """
    keys = list(keys)
    numbered = with_row_number(freeze_order(df, keys, order), keys)
    scaled = numbered.withColumn("_x", F.col(x).cast("double") * rate)
    rows = _decayed_sum(scaled, keys, "_t", "_x", 1.0 - rate, "ema")
    rows = rows.withColumn("_seg", F.floor((F.col("_t") - 1) / SEGMENT).cast("bigint"))
    segment, across = [*keys, "_seg"], Window.partitionBy(*keys).orderBy("_seg")
    running = Window.partitionBy(*segment).orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)

    # weight_t = S_t + max(first, max over j<=t of -S_j), with S the running sum of the steps.
    rows = rows.withColumn("_sum", F.sum(dual_rate * (F.col("ema") - budget)).over(running))
    rows = rows.withColumn("_low", F.min("_sum").over(running))
    sums = rows.groupBy(*segment).agg(F.max_by("_sum", "_t").alias("_end"), F.min("_sum").alias("_low_end"))
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_end").over(earlier), F.lit(0.0)))
    sums = sums.withColumn("_low_before", F.min(F.col("_before") + F.col("_low_end")).over(earlier))
    rows = _join_segment(rows, sums.select(*segment, "_before", "_low_before"), segment)
    total = F.col("_before") + F.col("_sum")
    lowest = F.least("_low_before", F.col("_before") + F.col("_low"))
    dual = total + F.greatest(F.lit(float(first_dual)), -lowest)
    return rows.select(*df.columns, F.col("_t").alias("step"), "ema", dual.alias("dual_weight"))


def _decayed_sum(rows: DataFrame, keys: list[str], at: str, x: str, keep: float, name: str) -> DataFrame:
    """Add ``name``: the sum over earlier positions j (from 1, gapless) of keep^(t - j) * x_j.

    Positions are cut into segments; a segment's last sum is carried on by the same recursion over
    segments, with keep^length, until one segment is left or older ones have decayed to nothing.
    Null x count as 0.
    """
    # keep^-length stays within 1e120, so scaled sums don't overflow.
    within = 1 if keep <= 0 else SEGMENT if keep >= 1 else max(1, min(SEGMENT, int(math.log(1e120) / -math.log(keep))))
    seg, j = f"{at}_seg", f"{at}_j"
    position = F.col(at) - 1
    rows = rows.withColumns({seg: F.floor(position / within).cast("bigint"), j: (position % within + 1).cast("double")})
    running = Window.partitionBy(*keys, seg).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    value = F.coalesce(F.col(x), F.lit(0.0))
    if within == 1 and keep <= 0:
        return rows.withColumn(name, value).drop(seg, j)
    scaled = value * F.pow(F.lit(keep), -F.col(j))
    # The last sum of a segment needs no window and combines map-side.
    ends = rows.groupBy(*keys, seg).agg((F.sum(scaled) * F.pow(F.lit(keep), F.max(j))).alias("_end"))
    across = Window.partitionBy(*keys).orderBy(seg)
    onward, carried = keep**within, F.col("_carry")
    if onward**4 < 1e-320:  # after a few segments nothing is left
        back = 1 if onward == 0 else math.ceil(-320 / math.log10(onward))
        lags = [F.coalesce(F.lag("_end", k).over(across), F.lit(0.0)) * onward ** (k - 1) for k in range(1, back + 1)]
        ends = ends.withColumn("_carry", sum(lags[1:], lags[0]))
    elif (ends.agg(F.max(seg)).first()[0] or 0) == 0:
        ends = ends.withColumn("_carry", F.lit(0.0))
    else:
        ends = _decayed_sum(ends.withColumn(f"{at}_up", F.col(seg) + 1), keys, f"{at}_up", "_end", onward, "_whole")
        ends = ends.withColumn("_carry", F.coalesce(F.lag("_whole").over(across), F.lit(0.0)))
    rows = rows.withColumn("_local", F.pow(F.lit(keep), F.col(j)) * F.sum(scaled).over(running))
    rows = _join_segment(rows, ends.select(*keys, seg, "_carry"), [*keys, seg])
    return rows.withColumn(name, F.col("_local") + F.pow(F.lit(keep), F.col(j)) * carried).drop(seg, j, "_local", "_carry")


def _join_segment(rows: DataFrame, side: DataFrame, segment: list[str]) -> DataFrame:
    extra = [c for c in side.columns if c not in segment]
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in segment]
    return rows.alias("r").join(side.alias("s"), same).select("r.*", *[f"s.{c}" for c in extra])


def q_sweep(
    transitions: DataFrame,
    n_actions: int,
    q: DataFrame | None = None,
    alpha: float = Q_RATE,
    gamma: float = Q_DISCOUNT,
    sweeps: int = 1,
) -> DataFrame:
    """(s, a, q) after K batch sweeps over logged (s, a, r, s2, done).

    The log is read once: it shrinks to one row per (s, a, s2, done) with its count and reward
    sum, and every sweep runs on that. Unseen values of the ``n_actions`` actions count as 0. Lineage is cut every sweep.
    """
    shared_dir(transitions.sparkSession)
    model = transitions.groupBy("s", "a", "s2", "done").agg(F.sum("r").alias("r_sum"), F.count("*").alias("n")).checkpoint()
    start = q if q is not None else model.select("s", "a").distinct().withColumn("q", F.lit(0.0))
    current = start.select("s", "a", F.col("q").cast("double").alias("q"))
    for sweep in range(sweeps):
        # An action without a value counts as 0, so a state not valued for all actions has at least 0.
        best = current.groupBy(F.col("s").alias("s2")).agg(F.max("q").alias("_q"), F.count("*").alias("_a"))
        value = best.select("s2", F.when(F.col("_a") < n_actions, F.greatest("_q", F.lit(0.0))).otherwise(F.col("_q")).alias("v"))
        future = F.when(F.col("done"), F.lit(0.0)).otherwise(gamma * F.coalesce("v", F.lit(0.0)))
        targets = (
            model.join(value, "s2", "left")
            .groupBy("s", "a")
            .agg((F.sum(F.col("r_sum") + F.col("n") * future) / F.sum("n")).alias("target"))
        )
        old = F.coalesce("q", F.lit(0.0))
        updated = current.join(targets, ["s", "a"], "full").select(
            "s", "a", F.when(F.col("target").isNull(), old).otherwise(old + alpha * (F.col("target") - old)).alias("q")
        )
        current = updated.checkpoint() if sweep + 1 < sweeps else updated
    return current


def greedy_policy(q: DataFrame, n_actions: int, states: DataFrame | None = None) -> DataFrame:
    """(s, action): best action per state, lowest on ties; 0 for a state of ``states`` without values.

    Actions without a value count as 0, so they win over negative values.
    """
    valued = q.groupBy("s").agg(
        F.max(F.struct("q", (-F.col("a")).alias("neg"))).alias("best"),
        F.array_sort(F.collect_set("a")).alias("seen"),
    )
    unseen = F.array_except(F.sequence(F.lit(0), F.lit(n_actions - 1)), F.transform("seen", lambda a: a.cast("int")))
    first_unseen = F.get(unseen, 0)
    best_action = (-F.col("best.neg")).cast("int")
    action = F.when(
        first_unseen.isNotNull()
        & ((F.col("best.q") < 0) | ((F.col("best.q") == 0) & (first_unseen < best_action))),
        first_unseen,
    ).otherwise(best_action)
    policy = valued.select("s", action.alias("action"))
    if states is None:
        return policy
    return states.select("s").distinct().join(policy, "s", "left").select("s", F.coalesce("action", F.lit(0)).alias("action"))


def episode_rollup(
    steps: DataFrame, keys: Sequence[str], order: Sequence[str], reward: str = "r", cost: str = "c", done: str = "done"
) -> DataFrame:
    """(keys, episode, reward, cost, steps): an episode ends with the row that is done.

    Episodes are numbered inside range slices first; only the number of ended episodes per
    (slice, key) is carried over, and totals are combined from partial ones.
    """
    keys = list(keys)
    frozen = freeze_order(steps.select(*keys, *order, reward, cost, done), keys, order)
    ended = F.coalesce(F.col(done).cast("int"), F.lit(0))
    before = Window.partitionBy(*keys, "_slice").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = frozen.withColumns({"_ended": ended, "_local": F.coalesce(F.sum(ended).over(before), F.lit(0))})
    partial = local.groupBy(*keys, "_slice", "_local").agg(
        F.sum(reward).alias("reward"), F.sum(cost).alias("cost"), F.count("*").alias("steps"), F.sum("_ended").alias("_ended")
    )
    slices = partial.groupBy(*keys, "_slice").agg(F.sum("_ended").alias("_ended"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(*keys, "_slice", F.coalesce(F.sum("_ended").over(earlier), F.lit(0)).alias("_carry"))
    placed = _join_segment(partial, carried, [*keys, "_slice"])
    return (
        placed.groupBy(*keys, (F.col("_carry") + F.col("_local")).alias("episode"))
        .agg(
            F.sum("reward").alias("reward"),
            F.sum("cost").alias("cost"),
            F.sum("steps").alias("steps"),
            (F.max("_ended") > 0).alias("finished"),
        )
    )
