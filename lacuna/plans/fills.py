"""Catalog: profiles and single-value / group / conditional fills (Q01-Q11, Q45)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lacuna.operators.group import GroupCenterImputer, PartialMeanImputer
from lacuna.operators.profile import missing_summary, missing_totals
from lacuna.operators.simple import ConstantImputer, MeanImputer, MedianImputer, ModeImputer
from lacuna.plans.common import LINEITEM_ID, masked, masked_sql
from lacuna.plans.registry import query
from lacuna.sources.tables import load

# ------------------------------------------------------------------ Q01 profile
ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORD_TYPES = ["bigint", "bigint", "string", "double", "timestamp_ntz", "string"]
Q01_MASKS = {"o_totalprice": (1, 250), "o_orderstatus": (2, 100), "o_orderpriority": (3, 50),
             "o_custkey": (4, 200)}


def _q01_input(spark, sf):
    return masked(spark, sf, "orders", "o_orderkey", Q01_MASKS)


def q01(spark, sf):
    return missing_summary(_q01_input(spark, sf)).select(
        "column_name", "dtype", "n_rows", "n_missing", F.round("pct_missing", 4).alias("pct_missing"),
        "rank_pos")


_q01_union = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, n, n - c_{c} AS n_missing FROM a"
    for c, t in zip(ORD_COLS, ORD_TYPES))
Q01_SQL = f"""
WITH m AS ({masked_sql('orders', ORD_COLS, 'o_orderkey', Q01_MASKS)}),
a AS (SELECT count(*) AS n, {', '.join(f'count({c}) AS c_{c}' for c in ORD_COLS)} FROM m),
u AS ({_q01_union})
SELECT column_name, dtype, CAST(n AS BIGINT) AS n_rows, CAST(n_missing AS BIGINT) AS n_missing,
       round(100.0 * n_missing / n, 4) AS pct_missing,
       CAST(row_number() OVER (ORDER BY 100.0 * n_missing / n DESC, column_name) AS BIGINT) AS rank_pos
FROM u"""
query("q01_missing_summary", Q01_SQL)(q01)


def q01b(spark, sf):
    before = _q01_input(spark, sf)
    after = ModeImputer(columns=["o_orderstatus", "o_orderpriority", "o_custkey"]).fit_transform(
        MeanImputer(columns=["o_totalprice"]).fit_transform(before))
    return missing_totals(before, after)


Q01B_SQL = f"""
WITH m AS ({masked_sql('orders', ORD_COLS, 'o_orderkey', Q01_MASKS)})
SELECT CAST(count(*) * {len(ORD_COLS)} AS BIGINT) AS n_cells,
       CAST({' + '.join(f'(count(*) - count({c}))' for c in ORD_COLS)} AS BIGINT) AS missing_before,
       CAST(0 AS BIGINT) AS missing_after
FROM m"""
query("q01b_missing_totals", Q01B_SQL)(q01b)

# ------------------------------------------------------------------ Q02 constant
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
Q02_MASKS = {"c_acctbal": (5, 250), "c_mktsegment": (6, 250), "c_nationkey": (7, 250)}


def q02(spark, sf):
    m = masked(spark, sf, "customer", "c_custkey", Q02_MASKS)
    out = ConstantImputer({"c_acctbal": 0.0, "c_mktsegment": "UNKNOWN", "c_nationkey": -1}).fit_transform(m)
    return out.select("c_custkey", "c_name", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"),
                      "c_mktsegment")


Q02_SQL = f"""
WITH m AS ({masked_sql('customer', CUST_COLS, 'c_custkey', Q02_MASKS)})
SELECT c_custkey, c_name, coalesce(c_nationkey, -1) AS c_nationkey,
       round(coalesce(c_acctbal, 0.0), 2) AS c_acctbal, coalesce(c_mktsegment, 'UNKNOWN') AS c_mktsegment
FROM m"""
query("q02_constant_fill", Q02_SQL)(q02)


def q02b(spark, sf):
    m = masked(spark, sf, "customer", "c_custkey", Q02_MASKS)
    out = ConstantImputer(0, numeric_only=True, exclude=["c_custkey"]).fit_transform(m)
    return out.select("c_custkey", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"), "c_mktsegment")


Q02B_SQL = f"""
WITH m AS ({masked_sql('customer', CUST_COLS, 'c_custkey', Q02_MASKS)})
SELECT c_custkey, coalesce(c_nationkey, 0) AS c_nationkey, round(coalesce(c_acctbal, 0), 2) AS c_acctbal,
       c_mktsegment
FROM m"""
query("q02b_constant_fill_numeric", Q02B_SQL)(q02b)

# ------------------------------------------------------------------ Q03 / Q04 mean, median
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_MASKS = {"l_quantity": (11, 250), "l_extendedprice": (12, 250), "l_discount": (13, 250),
            "l_tax": (14, 250)}
LI_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _li_fill(imputer):
    def run(spark, sf):
        m = masked(spark, sf, "lineitem", LINEITEM_ID, LI_MASKS)
        out = imputer().fit_transform(m)
        return out.select(*LI_KEYS, *[F.round(c, 4).alias(c) for c in LI_NUM])
    return run


def _li_fill_sql(agg: str) -> str:
    return f"""
WITH m AS ({masked_sql('lineitem', LI_COLS, LINEITEM_ID, LI_MASKS)}),
s AS (SELECT {', '.join(f'{agg}({c}) AS s_{c}' for c in LI_NUM)} FROM m)
SELECT {', '.join(LI_KEYS)}, {', '.join(f'round(coalesce({c}, s_{c}), 4) AS {c}' for c in LI_NUM)}
FROM m CROSS JOIN s"""


query("q03_mean_fill", _li_fill_sql("avg"))(_li_fill(lambda: MeanImputer(columns=LI_NUM)))
query("q04_median_fill", _li_fill_sql("median"))(_li_fill(lambda: MedianImputer(columns=LI_NUM)))

# ------------------------------------------------------------------ Q05 mode
Q05_MASKS = {"o_orderstatus": (2, 250), "o_orderpriority": (3, 250), "o_custkey": (4, 250)}


def q05(spark, sf):
    m = masked(spark, sf, "orders", "o_orderkey", Q05_MASKS)
    out = ModeImputer(columns=["o_custkey", "o_orderstatus", "o_orderpriority"]).fit_transform(m)
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def _mode_sql(src: str, c: str) -> str:
    return f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


Q05_SQL = f"""
WITH m AS ({masked_sql('orders', ORD_COLS, 'o_orderkey', Q05_MASKS)})
SELECT o_orderkey, coalesce(o_custkey, {_mode_sql('m', 'o_custkey')}) AS o_custkey,
       coalesce(o_orderstatus, {_mode_sql('m', 'o_orderstatus')}) AS o_orderstatus,
       coalesce(o_orderpriority, {_mode_sql('m', 'o_orderpriority')}) AS o_orderpriority
FROM m"""
query("q05_mode_fill", Q05_SQL)(q05)

# ------------------------------------------------------------------ Q06 group mean
Q06_MASKS = {"o_totalprice": (1, 250)}


def q06(spark, sf):
    m = masked(spark, sf, "orders", "o_orderkey", Q06_MASKS)
    out = GroupCenterImputer("o_orderpriority", columns=["o_totalprice"]).fit_transform(m)
    return out.select("o_orderkey", "o_orderpriority", F.round("o_totalprice", 4).alias("o_totalprice"))


Q06_SQL = f"""
WITH m AS ({masked_sql('orders', ORD_COLS, 'o_orderkey', Q06_MASKS)}),
g AS (SELECT o_orderpriority, avg(o_totalprice) AS g FROM m GROUP BY o_orderpriority),
o AS (SELECT avg(o_totalprice) AS o FROM m)
SELECT m.o_orderkey, m.o_orderpriority, round(coalesce(m.o_totalprice, g.g, o.o), 4) AS o_totalprice
FROM m LEFT JOIN g ON m.o_orderpriority IS NOT DISTINCT FROM g.o_orderpriority CROSS JOIN o"""
query("q06_group_mean_fill", Q06_SQL)(q06)

# ------------------------------------------------------------------ Q07 group median, two keys
Q07_MASKS = {"l_extendedprice": (12, 250), "l_quantity": (11, 250)}


def q07(spark, sf):
    m = masked(spark, sf, "lineitem", LINEITEM_ID, Q07_MASKS)
    out = GroupCenterImputer(["l_returnflag", "l_linestatus"], strategy="median",
                             columns=["l_quantity", "l_extendedprice"]).fit_transform(m)
    return out.select(*LI_KEYS, "l_returnflag", "l_linestatus",
                      F.round("l_quantity", 4).alias("l_quantity"),
                      F.round("l_extendedprice", 4).alias("l_extendedprice"))


Q07_SQL = f"""
WITH m AS ({masked_sql('lineitem', LI_COLS, LINEITEM_ID, Q07_MASKS)}),
g AS (SELECT l_returnflag, l_linestatus, median(l_quantity) AS gq, median(l_extendedprice) AS gp
      FROM m GROUP BY l_returnflag, l_linestatus),
o AS (SELECT median(l_quantity) AS oq, median(l_extendedprice) AS op FROM m)
SELECT {', '.join('m.' + k for k in LI_KEYS)}, m.l_returnflag, m.l_linestatus,
       round(coalesce(m.l_quantity, g.gq, o.oq), 4) AS l_quantity,
       round(coalesce(m.l_extendedprice, g.gp, o.op), 4) AS l_extendedprice
FROM m LEFT JOIN g ON m.l_returnflag IS NOT DISTINCT FROM g.l_returnflag
                  AND m.l_linestatus IS NOT DISTINCT FROM g.l_linestatus
CROSS JOIN o"""
query("q07_group_median_fill", Q07_SQL)(q07)

# ------------------------------------------------------------------ Q08 group mode
Q08_MASKS = {"c_mktsegment": (6, 250)}


def q08(spark, sf):
    m = masked(spark, sf, "customer", "c_custkey", Q08_MASKS)
    out = GroupCenterImputer("c_nationkey", strategy="mode", columns=["c_mktsegment"]).fit_transform(m)
    return out.select("c_custkey", "c_nationkey", "c_mktsegment")


def _group_mode_sql(src: str, keys: list[str], c: str, name: str) -> str:
    k = ", ".join(keys)
    return f"""{name} AS (SELECT {k}, {c} AS g FROM (
    SELECT {k}, {c}, row_number() OVER (PARTITION BY {k} ORDER BY cnt DESC, {c}) AS rn
    FROM (SELECT {k}, {c}, count(*) AS cnt FROM {src} WHERE {c} IS NOT NULL GROUP BY {k}, {c}) t0) t1
    WHERE rn = 1)"""


Q08_SQL = f"""
WITH m AS ({masked_sql('customer', CUST_COLS, 'c_custkey', Q08_MASKS)}),
{_group_mode_sql('m', ['c_nationkey'], 'c_mktsegment', 'g')}
SELECT m.c_custkey, m.c_nationkey, coalesce(m.c_mktsegment, g.g, {_mode_sql('m', 'c_mktsegment')}) AS c_mktsegment
FROM m LEFT JOIN g ON m.c_nationkey IS NOT DISTINCT FROM g.c_nationkey"""
query("q08_group_mode_fill", Q08_SQL)(q08)

# ------------------------------------------------------------------ Q09 null key, drop, skip
PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
Q09_MASKS = {"p_brand": (21, 250), "p_retailprice": (22, 400)}


def q09(spark, sf):
    m = masked(spark, sf, "part", "p_partkey", Q09_MASKS)
    keys = ["p_brand", "p_size"]
    a = GroupCenterImputer(keys, columns=["p_retailprice"]).fit_transform(m)
    b = GroupCenterImputer(keys, fallback_strategy="drop", columns=["p_retailprice"]).fit_transform(m)
    c = GroupCenterImputer(keys, null_group="skip", columns=["p_retailprice"]).fit_transform(m)
    return (a.select("p_partkey", "p_brand", "p_size", F.round("p_retailprice", 4).alias("price_group"))
            .join(b.select("p_partkey", F.round("p_retailprice", 4).alias("price_drop")), "p_partkey")
            .join(c.select("p_partkey", F.round("p_retailprice", 4).alias("price_skip")), "p_partkey"))


Q09_SQL = f"""
WITH m AS ({masked_sql('part', PART_COLS, 'p_partkey', Q09_MASKS)}),
g AS (SELECT p_brand, p_size, avg(p_retailprice) AS g FROM m GROUP BY p_brand, p_size),
o AS (SELECT avg(p_retailprice) AS o FROM m)
SELECT m.p_partkey, m.p_brand, m.p_size,
       round(coalesce(m.p_retailprice, g.g, o.o), 4) AS price_group,
       round(coalesce(m.p_retailprice, g.g), 4) AS price_drop,
       round(CASE WHEN m.p_brand IS NULL OR m.p_size IS NULL THEN m.p_retailprice
                  ELSE coalesce(m.p_retailprice, g.g, o.o) END, 4) AS price_skip
FROM m LEFT JOIN g ON m.p_brand IS NOT DISTINCT FROM g.p_brand AND m.p_size IS NOT DISTINCT FROM g.p_size
CROSS JOIN o"""
query("q09_group_fill_null_key", Q09_SQL)(q09)

# ------------------------------------------------------------------ Q10 conditional partial mean
EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
Q10_MASKS = {"value": (31, 250), "event_type": (32, 100)}


def q10(spark, sf):
    m = masked(spark, sf, "events", "event_id", Q10_MASKS)
    conds = {
        "purchases": {"event_type": "purchase"},
        "views_clicks": {"event_type": ["view", "click"]},
        "early_users": lambda d: F.col("user_id") < 20,
        "errors": {"event_type": "error", "no_such_column": 1},
    }
    model = PartialMeanImputer(conds, min_subset_size=10, exclude=["event_id", "user_id"]).fit(m)
    return model.transform(m).select("event_id", "event_type", "user_id", F.round("value", 4).alias("value"))


Q10_SQL = f"""
WITH m AS ({masked_sql('events', EV_COLS, 'event_id', Q10_MASKS)}),
s AS (SELECT avg(value) AS o,
        CASE WHEN sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) >= 10
              AND count(CASE WHEN event_type = 'purchase' THEN value END) > 0
             THEN avg(CASE WHEN event_type = 'purchase' THEN value END) END AS p1,
        CASE WHEN sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) >= 10
              AND count(CASE WHEN event_type IN ('view', 'click') THEN value END) > 0
             THEN avg(CASE WHEN event_type IN ('view', 'click') THEN value END) END AS p2,
        CASE WHEN sum(CASE WHEN user_id < 20 THEN 1 ELSE 0 END) >= 10
              AND count(CASE WHEN user_id < 20 THEN value END) > 0
             THEN avg(CASE WHEN user_id < 20 THEN value END) END AS p3,
        CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) >= 10
              AND count(CASE WHEN event_type = 'error' THEN value END) > 0
             THEN avg(CASE WHEN event_type = 'error' THEN value END) END AS p4
      FROM m)
SELECT event_id, event_type, user_id, round(coalesce(value,
         CASE WHEN p1 IS NOT NULL AND event_type = 'purchase' THEN p1
              WHEN p2 IS NOT NULL AND event_type IN ('view', 'click') THEN p2
              WHEN p3 IS NOT NULL AND user_id < 20 THEN p3
              WHEN p4 IS NOT NULL AND event_type = 'error' THEN p4
              ELSE o END), 4) AS value
FROM m CROSS JOIN s"""
query("q10_conditional_partial_mean", Q10_SQL)(q10)

# ------------------------------------------------------------------ Q11 quartile partial mean
Q11_MASKS = {"p_retailprice": (22, 250), "p_size": (23, 250)}


def q11(spark, sf):
    m = masked(spark, sf, "part", "p_partkey", Q11_MASKS)
    out = PartialMeanImputer(exclude=["p_partkey"]).fit_transform(m)
    return out.select("p_partkey", F.round("p_size", 4).alias("p_size"),
                      F.round("p_retailprice", 4).alias("p_retailprice"))


def _band_sql(c: str) -> str:
    return f"""(SELECT CASE WHEN count(CASE WHEN {c} > q1 AND {c} <= q3 THEN {c} END) >= 10
                   THEN avg(CASE WHEN {c} > q1 AND {c} <= q3 THEN {c} END) ELSE avg({c}) END
            FROM m, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM m) q)"""


Q11_SQL = f"""
WITH m AS ({masked_sql('part', PART_COLS, 'p_partkey', Q11_MASKS)})
SELECT p_partkey, round(coalesce(CAST(p_size AS DOUBLE), {_band_sql('p_size')}), 4) AS p_size,
       round(coalesce(p_retailprice, {_band_sql('p_retailprice')}), 4) AS p_retailprice
FROM m"""
query("q11_quartile_partial_mean", Q11_SQL)(q11)

# ------------------------------------------------------------------ Q45 natural holes
def q45(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang")
    lab = load(spark, sf, "labels")
    df = docs.join(lab, "doc_id", "left")
    out = GroupCenterImputer("lang", strategy="mode", columns=["quality", "toxic"]).fit_transform(df)
    return out.select("doc_id", "lang", "quality", "toxic")


Q45_SQL = """
WITH m AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
gq AS (SELECT lang, quality AS g FROM (SELECT lang, quality,
        row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, quality) AS rn
        FROM (SELECT lang, quality, count(*) AS cnt FROM m WHERE quality IS NOT NULL GROUP BY lang, quality) a) b
       WHERE rn = 1),
gt AS (SELECT lang, toxic AS g FROM (SELECT lang, toxic,
        row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, toxic) AS rn
        FROM (SELECT lang, toxic, count(*) AS cnt FROM m WHERE toxic IS NOT NULL GROUP BY lang, toxic) a) b
       WHERE rn = 1)
SELECT m.doc_id, m.lang,
       coalesce(m.quality, gq.g, (SELECT quality FROM m WHERE quality IS NOT NULL GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1)) AS quality,
       coalesce(m.toxic, gt.g, (SELECT toxic FROM m WHERE toxic IS NOT NULL GROUP BY toxic ORDER BY count(*) DESC, toxic LIMIT 1)) AS toxic
FROM m LEFT JOIN gq ON m.lang IS NOT DISTINCT FROM gq.lang LEFT JOIN gt ON m.lang IS NOT DISTINCT FROM gt.lang"""
query("q45_natural_missing_labels", Q45_SQL)(q45)


def q45b(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang")
    df = docs.join(load(spark, sf, "labels"), "doc_id", "left")
    return missing_summary(df).select("column_name", "dtype", "n_rows", "n_missing",
                                      F.round("pct_missing", 4).alias("pct_missing"), "rank_pos")


Q45B_SQL = """
WITH m AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
a AS (SELECT count(*) AS n, count(doc_id) AS c1, count(lang) AS c2, count(quality) AS c3, count(toxic) AS c4 FROM m),
u AS (SELECT 'doc_id' AS column_name, 'bigint' AS dtype, n, n - c1 AS n_missing FROM a
      UNION ALL SELECT 'lang', 'string', n, n - c2 FROM a
      UNION ALL SELECT 'quality', 'int', n, n - c3 FROM a
      UNION ALL SELECT 'toxic', 'int', n, n - c4 FROM a)
SELECT column_name, dtype, CAST(n AS BIGINT) AS n_rows, CAST(n_missing AS BIGINT) AS n_missing,
       round(100.0 * n_missing / n, 4) AS pct_missing,
       CAST(row_number() OVER (ORDER BY 100.0 * n_missing / n DESC, column_name) AS BIGINT) AS rank_pos
FROM u"""
query("q45b_label_missing_summary", Q45B_SQL)(q45b)


# ------------------------------------------------------------------ Q48 preview
def q48(spark, sf):
    from lacuna.operators.profile import preview
    m = masked(spark, sf, "orders", "o_orderkey", {"o_totalprice": (1, 250)})
    return preview(m.select("o_orderkey", "o_totalprice"), F.col("o_orderkey"), 5)


query("q48_preview", f"""SELECT o_orderkey, o_totalprice
FROM ({masked_sql('orders', ['o_orderkey', 'o_totalprice'], 'o_orderkey', {'o_totalprice': (1, 250)})}) m ORDER BY o_orderkey LIMIT 5""")(q48)
