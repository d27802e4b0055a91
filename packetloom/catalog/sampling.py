"""Training-set queries. ``lineitem`` plays the pools: return flag N the benchmark, R normal and A attack traffic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.catalog import views as v
from packetloom.catalog.common import Catalog
from packetloom.functions.hashing import fingerprint
from packetloom.operators import sampling

query = Catalog()

KEY = ["row_key"]
NOW = 1_009_843_200.0  # 2002-01-01
MAX_SAMPLES = 20_000


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.table(spark, sf_dir, "lineitem")
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    number = F.col("l_linenumber")
    return rows.select(
        F.concat_ws("-", *parts).alias("row_key"),
        F.col("l_returnflag").alias("flag"),
        F.pow(F.col("l_extendedprice") / 100000.0, F.lit(12.0)).alias("duration"),
        F.pow(F.col("l_quantity") / 50.0, F.lit(24.0)).alias("pkts_total"),
        F.pow(F.col("l_discount") * 10.0, F.lit(16.0)).alias("bytes_total"),
        F.when(F.col("l_partkey") % 997 == 0, "worm")
        .when(F.col("l_partkey") % 397 == 1, "botnet")
        .when(number % 3 == 0, "dos")
        .when(number % 3 == 1, "scan")
        .otherwise("bruteforce")
        .alias("attack"),
        F.when(number % 4 == 0, "VERIFIED")
        .when(number % 4 == 1, "HUMAN_REVIEW_NEEDED")
        .when(number % 4 == 2, "PSEUDO_LABELED")
        .otherwise("UNLABELED")
        .alias("label_status"),
        F.when(F.col("l_tax") > 0.01, F.col("l_tax") * 12.5).alias("model_score"),
        (F.unix_micros(F.col("l_shipdate").cast("timestamp")) / F.lit(1e6)).alias("__timestamp"),
    )


_POOL_SQL = """
pool AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key, l_returnflag AS flag,
  pow(l_extendedprice / 100000.0, 12.0) AS duration, pow(l_quantity / 50.0, 24.0) AS pkts_total, pow(l_discount * 10.0, 16.0) AS bytes_total,
  CASE WHEN l_partkey % 997 = 0 THEN 'worm' WHEN l_partkey % 397 = 1 THEN 'botnet' WHEN l_linenumber % 3 = 0 THEN 'dos'
    WHEN l_linenumber % 3 = 1 THEN 'scan' ELSE 'bruteforce' END AS attack,
  CASE l_linenumber % 4 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'HUMAN_REVIEW_NEEDED' WHEN 2 THEN 'PSEUDO_LABELED' ELSE 'UNLABELED' END AS label_status,
  CASE WHEN l_tax > 0.01 THEN l_tax * 12.5 END AS model_score, epoch_us(l_shipdate) / 1e6 AS ts_sec FROM lineitem)"""


def _u(key: str, salt: str) -> str:
    return f"((CAST('0x' || substr(md5({key} || '|{salt}'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {float(1 << 52)!r}::DOUBLE)"


def _weight(alias: str = "") -> str:
    return (
        f"greatest(CASE WHEN {NOW} - {alias}ts_sec > 0 THEN exp(-0.1 * (({NOW} - {alias}ts_sec) / 86400.0)) ELSE 1.0 END "
        f"* CASE {alias}label_status WHEN 'VERIFIED' THEN 2.0 WHEN 'HUMAN_REVIEW_NEEDED' THEN 3.0 ELSE 1.0 END, 0.001)"
    )


@query(f"WITH {_POOL_SQL} SELECT row_key, round({_weight()}, 9) AS weight FROM pool")
def sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pool(spark, sf_dir)
    return rows.select("row_key", F.round(sampling.sample_weight(rows, NOW), 9).alias("weight"))


@query(f"WITH {_POOL_SQL} SELECT row_key FROM pool WHERE NOT coalesce(label_status = 'PSEUDO_LABELED' AND model_score < 0.9, false)")
def weak_pseudo_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.drop_weak_pseudo_labels(pool(spark, sf_dir)).select("row_key")


def _zscore_sql(source: str, prefix: str = "z") -> str:
    """Sequential removal, one pair of tables per column."""
    parts = []
    current = source
    for i, c in enumerate(sampling.OUTLIER_COLUMNS):
        parts.append(f"{prefix}s{i} AS (SELECT count(*) AS n, avg({c}) AS m, stddev_samp({c}) AS s FROM {current})")
        parts.append(
            f"{prefix}{i} AS (SELECT p.* FROM {current} p, {prefix}s{i} st WHERE NOT coalesce(st.n > 100 AND st.s > 0 AND abs((p.{c} - st.m) / st.s) > 4.0, false))"
        )
        current = f"{prefix}{i}"
    return ", ".join(parts)


@query(f"WITH {_POOL_SQL}, local AS (SELECT * FROM pool WHERE flag <> 'N'), {_zscore_sql('local')} SELECT row_key FROM z2 UNION ALL SELECT row_key FROM pool WHERE flag = 'N'")
def zscore_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.when(F.col("flag") == "N", "benchmark").when(F.col("flag") == "R", "local_normal").otherwise("local_attack")
    rows = pool(spark, sf_dir).withColumn("source_type", source)
    return sampling.drop_outliers(rows).select("row_key")


@query(f"WITH {_POOL_SQL} SELECT row_key FROM pool ORDER BY {_u('row_key', 'uniform')}, row_key LIMIT 5000")
def uniform_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.uniform_sample(pool(spark, sf_dir), KEY, 5000).select("row_key")


@query(f"WITH {_POOL_SQL} SELECT row_key FROM pool ORDER BY -ln({_u('row_key', 'weighted')}) / {_weight()}, row_key LIMIT 5000")
def weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pool(spark, sf_dir)
    return sampling.weighted_sample(rows, KEY, sampling.sample_weight(rows, NOW), 5000).select("row_key")


_REPLACE_DRAWS = 20_000


@query(f"""WITH {_POOL_SQL}, rare AS (SELECT row_key, {_weight()} AS w FROM pool WHERE attack IN ('worm', 'botnet')),
ends AS (SELECT row_key, sum(w) OVER (ORDER BY {_u('row_key', 'replace-order')}, row_key ROWS UNBOUNDED PRECEDING) AS e, w FROM rare),
draws AS (SELECT i AS draw, {_u('i::VARCHAR', 'replace')} * (SELECT sum(w) FROM rare) AS a FROM (SELECT unnest(range(1, {_REPLACE_DRAWS} + 1)) AS i) r)
SELECT row_key, count(*) AS draws FROM draws, ends WHERE a >= e - w AND a < e GROUP BY row_key""")
def weighted_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rare = pool(spark, sf_dir).where(F.col("attack").isin("worm", "botnet"))
    drawn = sampling.weighted_sample_with_replacement(rare, KEY, sampling.sample_weight(rare, NOW), _REPLACE_DRAWS)
    return drawn.groupBy("row_key").agg(F.count(F.lit(1)).alias("draws"))


def _oversample_sql(source: str, least: int) -> str:
    return f"""sizes AS (SELECT attack, count(*) AS n FROM {source} GROUP BY attack),
ranked AS (SELECT p.*, row_number() OVER (PARTITION BY p.attack ORDER BY row_key) AS rnk FROM {source} p JOIN sizes USING (attack) WHERE n < {least}),
picks AS (SELECT attack, i AS draw, CAST(floor({_u("attack || '|' || i::VARCHAR", 'oversample')} * n) AS INTEGER) + 1 AS rnk FROM sizes, (SELECT unnest(range(1, {least} + 1)) AS i) r WHERE n < {least}),
filled AS (SELECT {source}.*, 0 AS draw FROM {source} JOIN sizes USING (attack) WHERE n >= {least}
  UNION ALL SELECT ranked.* EXCLUDE (rnk), picks.draw FROM picks JOIN ranked USING (attack, rnk))"""


@query(f"WITH {_POOL_SQL}, a AS (SELECT * FROM pool WHERE flag = 'A'), {_oversample_sql('a', 100)} SELECT attack, row_key, CAST(draw AS BIGINT) AS draw FROM filled")
def oversample_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pool(spark, sf_dir).where("flag = 'A'")
    filled = sampling.oversample_small_classes(rows, "attack", KEY)
    return filled.select("attack", "row_key", F.col("__draw").alias("draw"))


@query(f"""WITH {_POOL_SQL}, r AS (SELECT row_key, attack, row_number() OVER (PARTITION BY attack ORDER BY {_u('row_key', 'split')}, row_key) AS k,
  count(*) OVER (PARTITION BY attack) AS n FROM pool)
SELECT row_key, attack, k <= floor(n * 0.2 + 0.5) AS is_test FROM r""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_split(pool(spark, sf_dir), "attack", KEY).select("row_key", "attack", "is_test")


@query(f"WITH {_POOL_SQL} SELECT row_key FROM pool WHERE {_u('row_key', 'fraction')} < 0.2")
def fraction_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fraction_split(pool(spark, sf_dir), KEY)[0].select("row_key")


_HOLDOUT_SQL = f"""{_POOL_SQL}, named AS (SELECT *, CASE WHEN flag = 'A' THEN attack ELSE 'Normal' END AS attack_type FROM pool),
candidates AS (SELECT attack_type, count(*) AS n FROM named WHERE lower(attack_type) NOT IN ('normal', 'benign', '0') GROUP BY 1 HAVING count(*) > 50),
held AS (SELECT CASE WHEN (SELECT count(*) FROM candidates) >= 2 THEN (SELECT attack_type FROM candidates ORDER BY n, attack_type LIMIT 1) END AS h)"""


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("flag") == "A", F.col("attack")).otherwise("Normal")
    return pool(spark, sf_dir).withColumn("attack_type", kind)


@query(f"WITH {_HOLDOUT_SQL} SELECT row_key, attack_type FROM named, held WHERE attack_type = h")
def zero_day_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.zero_day_split(_named(spark, sf_dir)).held_out.select("row_key", "attack_type")


@query(f"""WITH {_HOLDOUT_SQL} SELECT count(*) FILTER (WHERE NOT coalesce(attack_type = h, false)) AS train_size, any_value(h) AS zero_day_holdout,
  count(*) FILTER (WHERE attack_type = h) AS zero_day_size FROM named, held""")
def zero_day_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.zero_day_split(_named(spark, sf_dir)).report


def mixed(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    rows = pool(spark, sf_dir).withColumnRenamed("attack", "label")
    part = lambda flag: rows.where(F.col("flag") == flag).drop("flag")
    return sampling.build_retrain_set(part("N"), part("R"), part("A"), KEY, NOW, MAX_SAMPLES, **how)


def _mix_sql(normal: int, attack: int) -> str:
    return f"""{_POOL_SQL},
strong AS (SELECT * FROM pool WHERE NOT coalesce(label_status = 'PSEUDO_LABELED' AND model_score < 0.9, false)),
sr AS (SELECT * FROM strong WHERE flag = 'R'), {_zscore_sql('sr', 'r')},
sa AS (SELECT * FROM strong WHERE flag = 'A'), {_zscore_sql('sa', 'a')}, {_oversample_sql('a2', 100)},
mix AS (
  (SELECT 'benchmark' AS source_type, row_key, attack AS label, 0 AS draw FROM pool WHERE flag = 'N' ORDER BY {_u('row_key', 'uniform')}, row_key LIMIT {MAX_SAMPLES // 2})
  UNION ALL (SELECT 'local_normal', row_key, attack, 0 FROM r2 ORDER BY -ln({_u('row_key', 'weighted')}) / {_weight()}, row_key LIMIT {normal})
  UNION ALL (SELECT 'local_attack', row_key, attack, draw FROM filled ORDER BY -ln({_u("row_key || '|' || draw::VARCHAR", 'weighted')}) / {_weight()}, row_key, draw LIMIT {attack}))"""


_MIX_SQL = _mix_sql(MAX_SAMPLES * 3 // 10, MAX_SAMPLES // 5)


@query(f"WITH {_MIX_SQL} SELECT source_type, row_key, label, CAST(draw AS BIGINT) AS draw FROM mix")
def retrain_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, sf_dir).select("source_type", "row_key", "label", F.col("__draw").alias("draw"))


@query(f"WITH {_mix_sql(MAX_SAMPLES * 24 // 100, MAX_SAMPLES * 16 // 100)} SELECT source_type, row_key, label, CAST(draw AS BIGINT) AS draw FROM mix")
def retrain_mix_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix with at most 40 percent of new rows."""
    mix = mixed(spark, sf_dir, max_new_ratio=0.4)
    return mix.select("source_type", "row_key", "label", F.col("__draw").alias("draw"))


@query(f"WITH {_MIX_SQL} SELECT source_type, label, count(*) AS count FROM mix GROUP BY ALL")
def mix_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.composition(mixed(spark, sf_dir))


def _slice_sql(i: int) -> str:
    return f"sum(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT))::DECIMAL(30, 0)::VARCHAR"


@query(f"""WITH {_POOL_SQL}, digests AS (SELECT md5(concat_ws('|', row_key, flag, attack, label_status)) AS h FROM pool)
SELECT count(*) AS n_rows, sha256(concat_ws('|', count(*)::VARCHAR, {', '.join(_slice_sql(i) for i in range(4))})) AS fingerprint FROM digests""")
def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(pool(spark, sf_dir), ["row_key", "flag", "attack", "label_status"])
