"""DuckDB expressions that repeat the draws of ``operators.bootstrap``."""

from __future__ import annotations

from quotemill.operators.bootstrap import PRIME, poisson_cuts

REPS, SEED = 2000, 7


def _word(text: str, at: int = 1) -> str:
    return f"(('0x' || substr(md5({text}), {at}, 8))::bigint % {PRIME})"


def _ends(source: str, name: str, by: str, value: str) -> str:
    return f"{name} as (select {by}, quantile_cont({value}, 0.025) as ci_lo, quantile_cont({value}, 0.975) as ci_hi from {source} group by {by})"


def factors(seed: int = SEED) -> str:
    return f"factors_{seed} as (select k, {_word(f"'{seed}|rep|' || k")} as c from range({REPS}) t(k))"


def iid(rows: str, value: str, row_id: str, by: str, name: str) -> str:
    """Expressions up to ``name`` (by, ci_lo, ci_hi); ``factors_7`` must stand before them."""
    weight = " + ".join(f"(u >= {c})::int" for c in poisson_cuts())
    return f"""{name}_rows as (select {by}, {value}::double as v, {_word(f"'{SEED}|' || {row_id}")} as a, {_word(f"'{SEED}|' || {row_id}", 9)} as b from {rows} where {value} is not null),
{name}_reps as (select {by}, k, sum(v * w) / nullif(sum(w), 0) as mean from (select {by}, k, v, {weight} as w from (select *, (a * c + b) % {PRIME} as u from {name}_rows cross join factors_{SEED})) group by {by}, k),
{_ends(f"{name}_reps", name, by, "mean")}"""


def day_means(rows: str, value: str, by: str, name: str, seed: int = SEED) -> str:
    """Expressions up to ``name`` (by, k, mean); ``factors_<seed>`` must stand before them."""
    a, b = (_word(f"'{seed}|' || j", at) for at in (1, 9))
    return f"""{name}_days as (select {by}, day, sum({value})::double as s, count({value}) as c, row_number() over (partition by {by} order by day) - 1 as slot from {rows} where {value} is not null group by {by}, day),
{name}_sizes as (select {by}, count(*) as m from {name}_days group by {by}),
{name}_draws as (select {by}, k, (a * f.c + b) % {PRIME} * m // {PRIME} as slot from (select *, {a} as a, {b} as b from (select *, unnest(range(m)) as j from {name}_sizes)) cross join factors_{seed} f),
{name} as (select {by}, k, sum(s) / sum(c) as mean from {name}_draws join {name}_days using ({by}, slot) group by {by}, k)"""


def days(rows: str, value: str, by: str, name: str) -> str:
    return f"{day_means(rows, value, by, name + '_reps')},\n{_ends(name + '_reps', name, by, 'mean')}"


def delta(rows: str, value: str, side: str, a: str, b: str, by: str, name: str) -> str:
    """Expressions up to ``name`` (by, ci_lo, ci_hi) of the difference; ``factors_7`` and ``factors_8`` must stand before them."""
    one = day_means(f"(select * from {rows} where {side} = '{a}')", value, by, f"{name}_a", SEED)
    two = day_means(f"(select * from {rows} where {side} = '{b}')", value, by, f"{name}_b", SEED + 1)
    return f"""{one},
{two},
{name}_reps as (select {by}, k, a.mean - b.mean as mean from {name}_a a join {name}_b b using ({by}, k)),
{_ends(name + '_reps', name, by, 'mean')}"""
