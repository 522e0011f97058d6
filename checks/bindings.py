"""How the model's inputs are read from the given tables.

Each binding is one SQL text that Spark and the checking engine both understand, so the two sides
start from equal values. Geography is integer arithmetic on keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _place(key: str) -> str:
    return (
        f"CAST(({key} * 3319 % 4600) * 1000 - 2300000 AS DOUBLE) AS x, "
        f"CAST(({key} * 329 % 2900) * 1000 + 300000 AS DOUBLE) AS y"
    )


BINDINGS = {
    "stn": f"SELECT s_suppkey AS station, {_place('s_suppkey')} FROM {{supplier}}",
    "obs": f"""SELECT s_suppkey AS station, {_place('s_suppkey')},
        CAST(l_shipdate AS DATE) AS date,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS pm25
        FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    "fire": f"""SELECT event_id AS seq, user_id AS station, {_place('user_id')},
        CAST(year(ts) AS INT) AS yr, CAST(dayofyear(ts) AS INT) AS doy,
        CAST(ts AS DATE) AS date, value AS fire_pm25, value * 2 AS area FROM {{events}}""",
    "pix": """SELECT CAST(ts AS DATE) AS date, event_id % 14 AS tile_rank, event_id % 3 AS layer,
        user_id AS row, event_id % 7 AS col, value / 200 AS value,
        event_id * 40503 % 65536 AS qa, event_id AS seq FROM {events}""",
    "emis": """SELECT CAST(2008 + 3 * (year(l_shipdate) % 4) AS INT) AS nei_year,
        CASE l_returnflag WHEN 'A' THEN 'nonroad' WHEN 'N' THEN 'onroad' ELSE 'nonpoint' END AS eis,
        lpad(CAST(s_nationkey AS VARCHAR(9)), 5, '0') AS fips, l_extendedprice AS total
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
        UNION ALL
        SELECT CAST(2011 + 3 * (event_id % 3) AS INT), 'event',
        lpad(CAST(user_id % 25 AS VARCHAR(9)), 5, '0'), value FROM {events}""",
    "site": f"""SELECT c_custkey AS site_id, {_place('c_custkey')},
        CAST(2008 + 3 * (c_custkey % 4) AS INT) AS nei_year, c_acctbal AS total_emissions,
        c_custkey AS seq, CAST(1000 AS DOUBLE) AS population FROM {{customer}}""",
    "county": """SELECT lpad(CAST(n_nationkey AS VARCHAR(9)), 5, '0') AS poly_id,
        CAST(-2300000 + (n_nationkey % 5) * 920000 AS DOUBLE) AS xmin,
        CAST(-2300000 + (n_nationkey % 5) * 920000 + 920000 AS DOUBLE) AS xmax,
        CAST(300000 + floor(n_nationkey / 5) * 580000 AS DOUBLE) AS ymin,
        CAST(300000 + floor(n_nationkey / 5) * 580000 + 580000 AS DOUBLE) AS ymax
        FROM {nation}""",
    "road": """SELECT r_regionkey AS road_id, CAST(-1800000 + 900000 * r_regionkey AS DOUBLE) AS x1,
        CAST(300000 AS DOUBLE) AS y1, CAST(-1800000 + 900000 * r_regionkey AS DOUBLE) AS x2,
        CAST(3200000 AS DOUBLE) AS y2 FROM {region}""",
    "cv": f"""SELECT o_orderkey AS seq, {_place('o_custkey')}, CAST(o_orderdate AS DATE) AS date,
        o_totalprice / 1000 AS pm25, o_totalprice / 1000 * CAST(0.9 AS DOUBLE) + o_orderkey % 10 AS pred_oob,
        o_totalprice / 1000 * CAST(0.98 AS DOUBLE) + o_orderkey % 3 AS pred_inbag,
        CAST(2 + o_orderkey % 7 AS DOUBLE) AS se_oob, CAST(1 + o_orderkey % 4 AS DOUBLE) AS se_inbag
        FROM {{orders}}""",
}
# A road row ends where the study area ends.


def bind(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Spark side of a binding; only the tables it names are read."""
    text = BINDINGS[name]
    tables = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **tables)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ctes(*names: str) -> str:
    """Checking side: the bindings as common table expressions."""
    plain = {t: t for t in TABLES}
    return ", ".join(f"{n} AS ({BINDINGS[n].format(**plain)})" for n in names)


def rectangle(df: DataFrame) -> DataFrame:
    """Rectangle columns to a counter-clockwise ring."""
    corners = (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))
    ring = F.array(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in corners])
    return df.withColumn("ring", ring)
