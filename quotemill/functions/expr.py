"""Column expressions of the market domain. Missing values are NULL; NaN and infinities are turned into NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Guards against division by zero, as parts of the definitions.
TINY, SMALL = 1e-12, 1e-9


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The number as double, NULL where it is no number, NaN or infinite."""
    x = col(c).try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts))


def floor_time(ts: Column | str, seconds: int) -> Column:
    """The start of the ``seconds`` long slot of the epoch that ``ts`` is in."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(col(ts)) / F.lit(seconds)) * seconds)


def sign(c: Column | str) -> Column:
    return F.coalesce(F.signum(col(c)), F.lit(0.0))


def mid(bid: Column | str = "bid_0_price", ask: Column | str = "ask_0_price") -> Column:
    return (col(bid) + col(ask)) / 2


def spread_bps(bid: Column | str = "bid_0_price", ask: Column | str = "ask_0_price") -> Column:
    return (col(ask) - col(bid)) / (mid(bid, ask) + TINY) * 1e4


def microprice(bid="bid_0_price", ask="ask_0_price", bid_size="bid_0_size", ask_size="ask_0_size") -> Column:
    """Mid weighted by the opposite sizes."""
    weight = col(bid_size) + col(ask_size) + TINY
    return (col(ask) * col(bid_size) + col(bid) * col(ask_size)) / weight


def micro_bias_bps() -> Column:
    return (microprice() - mid()) / (mid() + TINY) * 1e4


def depth(side: str, k: int) -> Column:
    """Sizes of levels 0 to k of ``side`` (bid or ask); a missing level counts 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(finite(f"{side}_{i}_size"), F.lit(0.0)) for i in range(k + 1)])


def imbalance(bid_depth: Column, ask_depth: Column) -> Column:
    return (bid_depth - ask_depth) / (bid_depth + ask_depth + SMALL)


def spread_ticks(tick: float) -> Column:
    return (col("ask_0_price") - col("bid_0_price")) / (F.lit(tick) + TINY)


def direction(ti: Column | str, bias: Column | str) -> Column:
    """Sign of the trade imbalance, half a sign of the micro bias deciding ties."""
    return sign(F.coalesce(col(ti), F.lit(0.0)) + 0.5 * sign(bias))


def robust_z(x: Column | str, median: Column, mad: Column) -> Column:
    return (col(x) - median) / (mad + TINY)


def quantile_regime(x: Column | str, lo: Column, hi: Column) -> Column:
    """CALM up to ``lo``, NORMAL up to ``hi``, else VOLATILE; NULL stays NULL."""
    c = col(x)
    return F.when(c <= lo, "CALM").when(c <= hi, "NORMAL").when(c.isNotNull(), "VOLATILE")


def vol_regime3(bucket: Column | str) -> Column:
    b = col(bucket)
    return F.when(b.isin("b0", "b1"), "low").when(b == "b2", "mid").when(b.isin("b3", "b4"), "high")


def month_split(month: Column | str, train: tuple[str, str], val: tuple[str, str], test: tuple[str, str]) -> Column:
    """train, val, test or other by closed ranges of 'yyyy-MM'."""
    m = col(month)
    return F.when(m.between(*train), "train").when(m.between(*val), "val").when(m.between(*test), "test").otherwise("other")


def router_branch(bucket: Column | str) -> Column:
    return F.when(col(bucket) == "b2", "MR").otherwise("BO")


def branch_direction(branch: Column | str, dir0: Column | str) -> Column:
    """A mean-reversion branch trades against the signal."""
    return F.when(col(branch) == "MR", -col(dir0)).otherwise(col(dir0))


def exit_pnl(early: Column | str, late: Column | str) -> Column:
    """The early leg where it is negative, else (also where it is unknown) the late leg."""
    return F.when(col(early) < 0, col(early)).otherwise(col(late))


def positive(x: Column | str, than: float = 0.0) -> Column:
    """1 where ``x`` is known and greater, else 0."""
    return F.coalesce(col(x) > than, F.lit(False)).cast("int")


def size_steps(score: Column | str, steps: list[tuple[float, float]], below: float, unknown: float) -> Column:
    """The size of the highest breakpoint (least score, size) reached; NULL scores get ``unknown``."""
    out = F.when(col(score).isNull(), F.lit(unknown))
    for least, size in sorted(steps, reverse=True):
        out = out.when(col(score) >= least, F.lit(size))
    return out.otherwise(F.lit(below))


def label_return(label: Column | str, win: float = 1.3) -> Column:
    return F.when(col(label) == 1, win).when(col(label) == -1, -1.0).when(col(label) == 0, 0.0)


def frequency_ms(name: Column | str) -> Column:
    """Milliseconds of a frequency like 250ms, 1s, 5m, 4h or 1d; NULL where it is none."""
    unit = F.create_map(*[F.lit(v) for kv in (("ms", 1), ("s", 1000), ("m", 60_000), ("h", 3_600_000), ("d", 86_400_000)) for v in kv])
    known = F.when(col(name).rlike(r"^\d+(ms|[smhd])$"), col(name))
    return (F.regexp_extract(known, r"^\d+", 0).cast("long") * unit[F.regexp_extract(known, r"[a-z]+$", 0)]).cast("long")


def resample_name(name: Column | str) -> Column:
    """The frequency as resamplers call it: minutes are min, all others as they are."""
    return F.when(col(name).rlike(r"^\d+m$"), F.concat(F.regexp_extract(col(name), r"^\d+", 0), F.lit("min"))).otherwise(col(name))


def to_bps(x: Column | str) -> Column:
    return finite(x) * 1e4


def in_range(x: Column | str, least: Column | None = None, most: Column | None = None) -> Column:
    """False for NULL."""
    ok = col(x).isNotNull()
    ok = ok if least is None else ok & (col(x) >= least)
    ok = ok if most is None else ok & (col(x) <= most)
    return F.coalesce(ok, F.lit(False))
