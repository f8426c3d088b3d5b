"""Action-value arithmetic over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: score of an action that is not allowed.
FORBIDDEN_SCORE = -1e9


def masked_argmax(q: Column, mask: Column) -> Column:
    """0-based index of the best allowed action, lowest index on ties."""
    scores = F.zip_with(q, mask, lambda score, ok: F.when(ok >= 0.5, score).otherwise(F.lit(FORBIDDEN_SCORE)))
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def constrained_scores(q_reward: Column, q_cost: Column, cost_weight: Column | float) -> Column:
    weight = cost_weight if isinstance(cost_weight, Column) else F.lit(float(cost_weight))
    return F.zip_with(q_reward, q_cost, lambda reward, cost: reward - weight * cost)


def action_value(q: Column, action: Column) -> Column:
    return F.element_at(q, action.cast("int") + 1)


def duelling_q(value: Column, advantage: Column) -> Column:
    """value + advantage - mean(advantage), element-wise."""
    total = F.aggregate(advantage, F.lit(0.0), lambda acc, x: acc + x)
    mean = F.try_divide(total, F.size(advantage))
    return F.transform(advantage, lambda x: value + x - mean)


def huber(error: Column) -> Column:
    """Smooth L1 with threshold 1."""
    size = F.abs(error)
    return F.when(size < 1.0, 0.5 * error * error).otherwise(size - 0.5)
