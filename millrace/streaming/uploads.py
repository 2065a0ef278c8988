"""Upload lifecycle: a file that fails too often is stuck, tried again every hour and given up after a day."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.ordered import Ordered
from millrace.plans.sequential import Ranges, Step

HOUR = 3_600_000_000
#: fixed values: errors until a file is stuck, time between retries, time until it is given up
MAX_RETRIES, EVERY, GIVE_UP = 10, HOUR, 24 * HOUR

ACTIONS = "action string, attempt int"


def _due(memory: dict, until: int, every: int, give_up: int) -> list[tuple[int, str, int]]:
    """Retries of the open cycle up to ``until``, and its end."""
    out = []
    while memory["since"] is not None and memory["tries"] * every < give_up:
        at = memory["since"] + (memory["tries"] + 1) * every
        if at > until:
            break
        memory["tries"] += 1
        if at - memory["since"] < give_up:
            out.append((at, "retry", memory["tries"]))
        else:
            out.append((memory["since"] + give_up, "given_up", memory["tries"]))
    return out


def retry_step(key: str, at: str, state: str, max_retries: int = MAX_RETRIES, every: int = EVERY, give_up: int = GIVE_UP) -> Step:
    """What happens to a file besides its own events: it is stuck, tried again, given up.

    An error counts for ever; from the ``max_retries``-th on it opens a cycle
    unless one is open, which ends when the file is uploaded. ``every`` divides ``give_up``.
    """

    def step(memory: dict, rows: pd.DataFrame, ranges: Ranges) -> pd.DataFrame:
        out, names = [], rows[key].tolist()
        for a, b, new in ranges:
            if new:
                memory.update(retries=0, since=None, tries=0)
            memory["key"] = names[a]
            for t, s in zip(rows[at].iloc[a:b].tolist(), rows[state].iloc[a:b].tolist()):
                out += [(names[a], *d) for d in _due(memory, t - 1, every, give_up)]
                if s == "ERROR":
                    memory["retries"] += 1
                    if memory["retries"] >= max_retries and memory["since"] is None:
                        memory.update(since=t, tries=0)
                        out.append((names[a], t, "stuck", 0))
                elif s == "UPLOADED":
                    memory.update(since=None, tries=0)
        return pd.DataFrame(out, columns=[key, at, "action", "attempt"])

    return step


def retry_tick(key: str, at: str, every: int = EVERY, give_up: int = GIVE_UP) -> Callable[[dict, int], tuple[pd.DataFrame, int | None]]:
    """Retries of a file without events of its own, and the time of the next one."""

    def tick(memory: dict, until: int) -> tuple[pd.DataFrame, int | None]:
        out = [(memory["key"], *d) for d in _due(memory, until, every, give_up)]
        waits = memory["since"] is not None and memory["tries"] * every < give_up
        following = memory["since"] + (memory["tries"] + 1) * every if waits else None
        return pd.DataFrame(out, columns=[key, at, "action", "attempt"]), following

    return tick


def retries_batch(
    log: DataFrame, key: str, at: str, order: list[str], state: str, max_retries: int = MAX_RETRIES, every: int = EVERY, give_up: int = GIVE_UP
) -> DataFrame:
    """The same rows from a whole log: a cycle opens at the first counting error after each upload.

    Running counts and one ``min`` for each stretch between uploads; the
    retries of a cycle are a sequence of at most ``give_up / every`` numbers.
    """
    failed, up = (F.col(state) == "ERROR"), (F.col(state) == "UPLOADED")
    counted = Ordered(log, [key], order).running(_bad=("sum", failed.cast("bigint")), _up=("sum", up.cast("bigint")))
    opens = F.min(F.when(failed & (F.col("_bad") >= max_retries), F.col(at)))
    # the upload that ends a stretch is the first row of the next one
    stretches = counted.groupBy(key, "_up").agg(opens.alias("since"), F.min(F.when(up, F.col(at))).alias("_began"))
    ends = stretches.select(F.col(key).alias("_k"), (F.col("_up") - 1).alias("_n"), F.col("_began").alias("closed"))
    cycles = stretches.where("since is not null").join(ends, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_up") == F.col("_n")), "left")
    n = give_up // every
    tries = F.explode(F.sequence(F.lit(0), F.lit(n))).alias("attempt")
    rows = cycles.select(key, "since", "closed", tries).withColumn(at, F.col("since") + F.col("attempt") * F.lit(every))
    # an upload at the very time of a retry comes first
    rows = rows.where((F.col("attempt") == 0) | F.col("closed").isNull() | (F.col(at) < F.col("closed")))
    action = F.when(F.col("attempt") == 0, "stuck").when(F.col("attempt") < n, "retry").otherwise("given_up")
    return rows.select(key, at, action.alias("action"), "attempt")
