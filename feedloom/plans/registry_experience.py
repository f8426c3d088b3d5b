"""Registered queries: logged control experience."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import actions
from feedloom.operators import experience
from feedloom.plans.registry_schedule import rounded
from feedloom.plans.views import view, with_views

QUERIES, ORACLES = {}, {}


def query(key: str, sql: str | None = None):
    def register(function):
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def _transitions(spark, sf_dir):
    return view(spark, sf_dir, "transitions")


def _q():
    return F.array("q0", "q1", "q2", "q3")


def _mask():
    return F.array(*[F.col(f"m{i}").cast("double") for i in range(4)])


# Values of a row as scalars: reward scores, cost scores and allowed actions.
_SCORES = """, sc as (
  select *, case when m0 then q0 - 0.1e0 * q3 else -1e9 end as x0, case when m1 then q1 - 0.1e0 * q2 else -1e9 end as x1,
    case when m2 then q2 - 0.1e0 * q1 else -1e9 end as x2, case when m3 then q3 - 0.1e0 * q0 else -1e9 end as x3 from transitions),
 am as (select *, greatest(x0, x1, x2, x3) as top from sc),
 best as (select *, case when x0 = top then 0 when x1 = top then 1 when x2 = top then 2 else 3 end as act from am)"""


def _with(extra: str, body: str) -> str:
    return with_views("--", "transitions").replace("\n--", extra + "\n" + body)


@query("masked_argmax", _with(_SCORES, "select id, act from best"))
def masked_argmax(spark, sf_dir):
    scores = actions.constrained_scores(_q(), F.reverse(_q()), 0.1)
    return _transitions(spark, sf_dir).select("id", actions.masked_argmax(scores, _mask()).alias("act"))


@query(
    "duelling_q",
    with_views(
        "select id, "
        + ", ".join(f"round(priority + q{i} - (q0 + q1 + q2 + q3) / 4, 6) as d{i}" for i in range(4))
        + " from transitions",
        "transitions",
    ),
)
def duelling_q(spark, sf_dir):
    values = _transitions(spark, sf_dir).select("id", actions.duelling_q(F.col("priority"), _q()).alias("d"))
    return values.select("id", *[F.round(F.get("d", i), 6).alias(f"d{i}") for i in range(4)])


_TD = _SCORES + """, tg as (
  select *, r + (case when done then 0 else 1 end) * 0.99e0 * (case act when 0 then q1 when 1 then q2 when 2 then q3 else q0 end) as y_r,
    c + (case when done then 0 else 1 end) * 0.99e0 * (case act when 0 then q2 when 1 then q3 when 2 then q0 else q1 end) as y_c from best),
 td as (select id, act, priority, q0 - y_r as td_r, q1 - y_c as td_c from tg),
 hu as (select *, case when abs(td_r) < 1 then 0.5e0 * td_r * td_r else abs(td_r) - 0.5e0 end as huber_r,
    case when abs(td_c) < 1 then 0.5e0 * td_c * td_c else abs(td_c) - 0.5e0 end as huber_c from td)"""


def _td(spark, sf_dir):
    q = _q()
    ready = _transitions(spark, sf_dir).select(
        "id",
        "priority",
        F.col("q0").alias("q_r_sa"),
        F.col("q1").alias("q_c_sa"),
        "r",
        "c",
        "done",
        F.col("priority").alias("weight"),
        q.alias("next_q_r"),
        F.reverse(q).alias("next_q_c"),
        F.array("q1", "q2", "q3", "q0").alias("next_q_r_target"),
        F.array("q2", "q3", "q0", "q1").alias("next_q_c_target"),
        _mask().alias("next_mask"),
    )
    return experience.td_errors(ready)


@query(
    "td_errors",
    _with(
        _TD,
        """select id, act as next_action, round(td_r, 6) as td_r, round(td_c, 6) as td_c, round(huber_r, 6) as huber_r,
        round(huber_c, 6) as huber_c from hu""",
    ),
)
def td_errors(spark, sf_dir):
    errors = _td(spark, sf_dir).select("id", "next_action", "td_r", "td_c", "huber_r", "huber_c")
    return rounded(errors, "td_r", "td_c", "huber_r", "huber_c")


@query(
    "td_loss",
    _with(
        _TD,
        """select round(avg(huber_r * priority), 4) as loss_r, round(avg(huber_c * priority), 4) as loss_c,
        round(avg(huber_r * priority) + 0.1e0 * avg(huber_c * priority), 4) as loss from hu""",
    ),
)
def td_loss(spark, sf_dir):
    return rounded(experience.td_loss(_td(spark, sf_dir)), "loss_r", "loss_c", "loss", digits=4)


@query(
    "priority_refresh",
    _with(
        _TD,
        """select t.id, round(case when t.c > 0 then greatest(abs(h.td_r) + abs(h.td_c) + 1e-5, 1e-6) else t.priority end, 6) as priority
        from transitions t join hu h on t.id = h.id""",
    ),
)
def priority_refresh(spark, sf_dir):
    scored = _td(spark, sf_dir).where("c > 0").select("id", "td_r", "td_c")
    buffer = _transitions(spark, sf_dir).select("id", "priority")
    return rounded(experience.priority_refresh(buffer, scored, "id"), "priority")


@query(
    "prioritised_sample",
    with_views(
        """select id, round(p, 9) as probability, round(w / max(w) over (), 6) as weight from (
          select id, mass / total as p, pow(n * mass / total, -0.4e0) as w from (
            select id, mass, sum(mass) over () as total, count(*) over () as n,
              -ln((cast(concat('0x', substr(md5(concat('0:', cast(id as string))), 1, 13)) as bigint) + 0.5e0) / 4503599627370496e0) / mass as k
            from (select id, pow(greatest(priority, 1e-6), 0.6e0) as mass from transitions))
          order by k, id limit 500)""",
        "transitions",
    ),
)
def prioritised_sample(spark, sf_dir):
    buffer = _transitions(spark, sf_dir).select("id", "priority")
    drawn = experience.prioritised_sample(buffer, "id", "priority", 500)
    return drawn.select("id", F.round("probability", 9).alias("probability"), F.round("weight", 6).alias("weight"))


@query(
    "ema_dual",
    with_views(
        """, o as materialized (select id, run, c, row_number() over (partition by run order by ord, id) as step from transitions),
        chain as (
          select id, run, step, 0.03e0 * c as ema, greatest(0e0, 0.1e0 + 0.003e0 * (0.03e0 * c - 0.1e0)) as dual from o where step = 1
          union all
          select o.id, o.run, o.step, 0.97e0 * p.ema + 0.03e0 * o.c,
            greatest(0e0, p.dual + 0.003e0 * (0.97e0 * p.ema + 0.03e0 * o.c - 0.1e0))
          from chain p join o on o.run = p.run and o.step = p.step + 1)
        select id, run, step, round(ema, 6) as ema, round(dual, 6) as dual_weight from chain""",
        "transitions",
    )
    .replace("with base", "with recursive base")
    .replace("\n, o as", ", o as"),
)
def ema_dual(spark, sf_dir):
    steps = _transitions(spark, sf_dir).select("id", "run", "ord", "c")
    result = experience.ema_dual(steps, ["run"], ["ord", "id"], "c")
    return rounded(result.select("id", "run", "step", "ema", "dual_weight"), "ema", "dual_weight")


@query(
    "episode_rollup",
    with_views(
        """select run, episode, sum(r) as reward, sum(c) as cost, count(*) as steps, max(cast(done as int)) = 1 as finished from (
          select *, cast(coalesce(sum(cast(done as int)) over (partition by run order by ord, id rows between unbounded preceding and 1 preceding), 0) as bigint) as episode
          from transitions) group by 1, 2""",
        "transitions",
    ),
)
def episode_rollup(spark, sf_dir):
    steps = _transitions(spark, sf_dir).select("run", "ord", "id", "r", "c", "done")
    return experience.episode_rollup(steps, ["run"], ["ord", "id"])


_SWEEPS = """, t1 as (select s, a, 0.3e0 * avg(r) as q from transitions group by 1, 2),
 v1 as (select s, case when count(*) < 4 then greatest(max(q), 0) else max(q) end as v from t1 group by 1),
 t2 as (select t.s, t.a, avg(t.r + case when t.done then 0 else 0.98e0 * coalesce(v.v, 0) end) as target
        from transitions t left join v1 v on t.s2 = v.s group by 1, 2),
 q2 as (select t1.s, t1.a, t1.q + 0.3e0 * (t2.target - t1.q) as q from t1 join t2 on t1.s = t2.s and t1.a = t2.a)"""


@query("q_sweep", _with(_SWEEPS, "select s, a, round(q, 6) as q from q2"))
def q_sweep(spark, sf_dir):
    log = _transitions(spark, sf_dir).select("s", "a", "r", "s2", "done")
    return rounded(experience.q_sweep(log, 4, sweeps=2), "q")


@query("greedy_policy", _with(_SWEEPS, "select s, cast(arg_min(a, {'n': -round(q, 9), 'a': a}) as int) as action from q2 group by 1"))
def greedy_policy(spark, sf_dir):
    log = _transitions(spark, sf_dir).select("s", "a", "r", "s2", "done")
    q = experience.q_sweep(log, 4, sweeps=2).withColumn("q", F.round("q", 9))
    return experience.greedy_policy(q, 4)
