"""Catalog: holdout masks (Q12-Q16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lacuna.functions.hashing import full_hash_sql as _h
from lacuna.functions.hashing import missing_flag_sql as _m
from lacuna.operators import masks as M
from lacuna.plans.registry import query
from lacuna.sources.tables import load


# ------------------------------------------------------------------ Q12 MCAR
def q12(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
        F.col("o_totalprice").alias("cells_totalprice"), F.col("o_custkey").alias("cells_custkey"))
    a = M.mcar(o, "o_orderkey", {"o_totalprice": 1}, rate=0.25)
    b = M.mcar(a, "o_orderkey", {"o_orderstatus": 2}, rate=0.25, exact=True)
    c = M.mcar_cells(b, "o_orderkey", {"cells_totalprice": 5, "cells_custkey": 6}, rate=0.3, exact=True)
    d = M.introduce_missing(c, "o_orderkey", "MCAR", 0.1, columns={"o_orderpriority": 7})
    return d


Q12_SQL = f"""
WITH n AS (SELECT count(*) AS n FROM orders),
st AS (SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {_h('o_orderkey', 2)}, o_orderkey) AS rn
       FROM orders) t, n WHERE rn <= CAST(floor(n.n * 0.25) AS BIGINT)),
cells AS (SELECT o_orderkey, 0 AS j, {_h('o_orderkey', 5)} AS h FROM orders
          UNION ALL SELECT o_orderkey, 1 AS j, {_h('o_orderkey', 6)} AS h FROM orders),
sel AS (SELECT o_orderkey, j FROM (SELECT o_orderkey, j, row_number() OVER (ORDER BY h, o_orderkey, j) AS rn
        FROM cells) t, n WHERE rn <= CAST(floor(n.n * 2 * 0.3) AS BIGINT))
SELECT o.o_orderkey,
       CASE WHEN {_m('o.o_orderkey', 1, 250)} THEN NULL ELSE o.o_totalprice END AS o_totalprice,
       CASE WHEN st.o_orderkey IS NOT NULL THEN NULL ELSE o.o_orderstatus END AS o_orderstatus,
       CASE WHEN {_m('o.o_orderkey', 7, 100)} THEN NULL ELSE o.o_orderpriority END AS o_orderpriority,
       CASE WHEN s0.o_orderkey IS NOT NULL THEN NULL ELSE o.o_totalprice END AS cells_totalprice,
       CASE WHEN s1.o_orderkey IS NOT NULL THEN NULL ELSE o.o_custkey END AS cells_custkey
FROM orders o LEFT JOIN st ON o.o_orderkey = st.o_orderkey
LEFT JOIN (SELECT o_orderkey FROM sel WHERE j = 0) s0 ON o.o_orderkey = s0.o_orderkey
LEFT JOIN (SELECT o_orderkey FROM sel WHERE j = 1) s1 ON o.o_orderkey = s1.o_orderkey"""
query("q12_mcar", Q12_SQL)(q12)


# ------------------------------------------------------------------ Q13 MAR
def q13(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    a = M.mar(c, "c_custkey", "c_acctbal", "c_nationkey", 10, rate=0.3, salt=8)
    b = M.mar(a, "c_custkey", "c_nationkey", "c_mktsegment", "BUILDING", rate=0.5, salt=9, exact=True)
    return b


Q13_SQL = f"""
WITH cond AS (SELECT c_custkey, {_h('c_custkey', 9)} AS h FROM customer WHERE c_mktsegment = 'BUILDING'),
k AS (SELECT CAST(floor(count(*) * 0.5) AS BIGINT) AS k FROM cond),
sel AS (SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY h, c_custkey) AS rn FROM cond) t, k
        WHERE rn <= k.k)
SELECT c.c_custkey,
       CASE WHEN sel.c_custkey IS NOT NULL THEN NULL ELSE c.c_nationkey END AS c_nationkey,
       CASE WHEN c.c_nationkey > 10 AND {_m('c.c_custkey', 8, 300)} THEN NULL ELSE c.c_acctbal END AS c_acctbal,
       c.c_mktsegment
FROM customer c LEFT JOIN sel ON c.c_custkey = sel.c_custkey"""
query("q13_mar", Q13_SQL)(q13)


# ------------------------------------------------------------------ Q14 / Q15 MNAR
def q14(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_retailprice")
    return M.mnar(p, "p_retailprice", "tail", 0.2)


Q14_SQL = """
SELECT p_partkey, CASE WHEN p_retailprice > (SELECT quantile_cont(p_retailprice, 0.8) FROM part)
                       THEN NULL ELSE p_retailprice END AS p_retailprice
FROM part"""
query("q14_mnar_tail", Q14_SQL)(q14)


def q15(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return M.mnar(c, "c_acctbal", "middle", 0.3)


Q15_SQL = """
WITH q AS (SELECT quantile_cont(c_acctbal, 0.35) AS lo, quantile_cont(c_acctbal, 0.65) AS hi FROM customer)
SELECT c_custkey, CASE WHEN c_acctbal >= lo AND c_acctbal <= hi THEN NULL ELSE c_acctbal END AS c_acctbal
FROM customer, q"""
query("q15_mnar_middle", Q15_SQL)(q15)


# ------------------------------------------------------------------ Q16 mixed
def q16(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return M.mixed(c, "c_custkey", [
        {"type": "mcar", "columns": {"c_acctbal": 10}, "rate": 0.1},
        {"type": "mar", "target_column": "c_mktsegment", "condition_column": "c_nationkey",
         "threshold": 12, "rate": 0.4, "salt": 11},
        {"type": "mnar", "target_column": "c_acctbal", "mechanism": "tail", "rate": 0.05},
    ])


Q16_SQL = f"""
WITH a AS (SELECT c_custkey, c_nationkey,
                  CASE WHEN {_m('c_custkey', 10, 100)} THEN NULL ELSE c_acctbal END AS c_acctbal,
                  CASE WHEN c_nationkey > 12 AND {_m('c_custkey', 11, 400)} THEN NULL ELSE c_mktsegment END
                    AS c_mktsegment
           FROM customer),
q AS (SELECT quantile_cont(c_acctbal, 0.95) AS t FROM a)
SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > q.t THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM a, q"""
query("q16_mixed_mask", Q16_SQL)(q16)
