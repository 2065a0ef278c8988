"""Rolling anomaly scores -> priorities -> promotion of files around them -> summary per robot."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import query
from millrace.operators.aggregates import flag_summary
from millrace.operators.filters import priority_of_score
from millrace.operators.joins import promote_in_windows
from millrace.operators.windows import rolling_zscore

SECOND = 1_000_000


@query("flagship", f"""
WITH {v.TELEMETRY}, z AS (SELECT *, CASE WHEN n >= 20 THEN abs(value - m) / (coalesce(sd, 0) + 1e-9) ELSE 0 END AS z FROM (
  SELECT *, avg(value) OVER f AS m, stddev_samp(value) OVER f AS sd, count(*) OVER f AS n FROM telemetry
  WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 299 PRECEDING AND CURRENT ROW)) q),
alarms AS (SELECT user_id, epoch_us(ts) AS at, CASE WHEN s >= 90 THEN 0 WHEN s >= 60 THEN 1 ELSE 2 END AS priority FROM (SELECT *, least(100, 50 + 10 * z) AS s FROM z WHERE z > 2) a),
files AS (SELECT user_id, event_id, ts, event_type, value, CAST(k % 4 AS INT) AS priority FROM telemetry),
hit AS (SELECT f.user_id, f.event_id, min(a.priority) AS new_priority FROM files f JOIN alarms a ON a.user_id = f.user_id AND epoch_us(f.ts) BETWEEN a.at - 86400000000 AND a.at + 43200000000
  AND a.priority < f.priority GROUP BY 1, 2)
SELECT 'robot-' || f.user_id AS robot_id, event_type || '/p' || new_priority AS flag, count(*) AS files, CAST(sum(CAST(round(value * 1000) AS BIGINT)) AS BIGINT) AS bytes, epoch_us(max(ts)) AS latest
FROM hit h JOIN files f ON f.event_id = h.event_id GROUP BY 1, 2""")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    events = v.telemetry(spark, sf)
    scored = rolling_zscore(events, ["user_id"], ["ts", "event_id"], "value", warm_up=20, limit=2.0).where("is_anomaly")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    alarms = scored.select(
        "user_id", "event_id", at.alias("at"), F.lit(86_400 * SECOND).alias("pre"), F.lit(43_200 * SECOND).alias("post"),
        priority_of_score(F.least(F.lit(100.0), 50 + 10 * F.col("z"))).alias("priority"),
    )
    files = events.select("user_id", F.col("event_id").alias("file_id"), at.alias("at"), (F.col("k") % 4).cast("int").alias("priority"))
    promoted = promote_in_windows(files, alarms, "user_id").select(F.col("file_id").alias("event_id"), "new_priority")
    tagged = events.join(promoted, "event_id").select(
        F.concat(F.lit("robot-"), "user_id").alias("robot_id"),
        F.array(F.concat("event_type", F.lit("/p"), "new_priority")).alias("anomaly_flags"),
        F.round(F.col("value") * 1000).cast("bigint").alias("size_bytes"), F.col("ts").alias("time_start"),
    )
    return flag_summary(tagged).withColumn("latest", F.unix_micros(F.col("latest").cast("timestamp")))
