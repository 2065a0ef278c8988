"""Hashing, time, unit, vector and file-name functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_modulus(digest: Column, modulus: int, width: int = 12) -> Column:
    """A hexadecimal number of any length modulo ``modulus``, most significant digit first."""
    total = F.lit(0).cast("bigint")
    for at in range(0, 32, width):
        size = min(width, 32 - at)
        part = F.conv(F.substring(digest, at + 1, size), 16, 10).cast("bigint")
        total = (total * (16**size % modulus) + part) % modulus
    return total


def traffic_bucket(user: Column) -> Column:
    """0.00 .. 99.99 from the md5 of a user."""
    return hex_modulus(F.md5(user.cast("string")), 10000) / 100.0


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text)


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalise(a: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    scaled = lambda size: F.transform(a, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(x.cast("double")))
    return bind(norm(a), scaled)


def cosine(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


# fixed values: directory per priority
PRIORITY_DIRS = {0: "p0_critical", 1: "p1_high", 2: "p2_normal"}


def file_name(ts: Column, session: Column, priority: Column, topic: Column, size_kb: Column, digest: Column) -> Column:
    ms = F.unix_millis(ts.cast("timestamp"))
    return F.concat(
        F.concat_ws(
            "_", F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"), ms, session, F.concat(F.lit("p"), priority),
            topic, size_kb, F.substring(digest, 1, 8),
        ),
        F.lit(".mcap"),
    )


def file_path(root: str, robot: Column, ts: Column, priority: Column, name: Column) -> Column:
    folder = F.lit("p2_normal")
    for p, directory in PRIORITY_DIRS.items():
        folder = F.when(priority == p, directory).otherwise(folder)
    return F.concat_ws("/", F.lit(root), F.lit("staging"), robot, F.date_format(ts, "yyyy/MM/dd"), folder, name)


def without_keys(metadata: Column, *keys: str) -> Column:
    return F.map_filter(metadata, lambda k, v: ~k.isin(*keys))


def transfer_cost(
    bandwidth_used: Column, temperature: Column, priority: Column,
    weights: tuple[float, float, float] = (20.0, 1.0, 10.0),
) -> Column:
    w_band, w_temp, w_priority = weights
    return w_band * bandwidth_used + w_temp * temperature + w_priority * priority


def transfer_decision(cost: Column, temperature: Column, priority: Column, limit: float = 100.0, throttle: float = 85.0) -> Column:
    """P0 always passes; others stop on heat first, then on cost."""
    return (
        F.when(priority == 0, "pass")
        .when(temperature >= throttle, "thermal_block")
        .when(cost > limit, "backoff")
        .otherwise("pass")
    )
