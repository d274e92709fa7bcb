"""Shared pieces of the catalog: masked inputs, built identically in Spark and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.hashing import missing_flag, missing_flag_sql
from lacuna.operators.evaluate import holdout
from lacuna.session import cut
from lacuna.sources.tables import document_features, document_features_sql, load

LINEITEM_ID = "l_orderkey * 8 + l_linenumber"


def masked(spark: SparkSession, sf_dir: str, table: str, id_expr: str,
           masks: dict[str, tuple[int, int]], truth: bool = False) -> DataFrame:
    """Table with ``masks`` = {column: (salt, permille)} applied; with ``truth``
    also c__truth and c__mask columns."""
    df = load(spark, sf_dir, table).withColumn("__id", F.expr(id_expr))
    return _mask(df, masks, truth)


def _mask(df: DataFrame, masks, truth: bool) -> DataFrame:
    if truth:
        by_permille: dict[int, dict[str, int]] = {}
        for c, (s, p) in masks.items():
            by_permille.setdefault(p, {})[c] = s
        out = df
        for p, cols in by_permille.items():
            out = holdout(out, "__id", cols, p)
        return out.drop("__id")
    sel = []
    for c in df.columns:
        if c in masks:
            s, p = masks[c]
            sel.append(F.when(missing_flag("__id", s, p), F.lit(None).cast(df.schema[c].dataType))
                       .otherwise(F.col(c)).alias(c))
        else:
            sel.append(F.col(c))
    return df.select(*sel).drop("__id")


def masked_sql(table_sql: str, columns: list[str], id_expr: str,
               masks: dict[str, tuple[int, int]], truth: bool = False) -> str:
    sel = []
    for c in columns:
        if c in masks:
            s, p = masks[c]
            sel.append(f"CASE WHEN {missing_flag_sql(id_expr, s, p)} THEN NULL ELSE {c} END AS {c}")
        else:
            sel.append(c)
    if truth:
        for c, (s, p) in masks.items():
            sel.append(f"{c} AS {c}__truth")
            sel.append(f"{missing_flag_sql(id_expr, s, p)} AS {c}__mask")
    return f"SELECT {', '.join(sel)} FROM {table_sql}"


# documents feature matrix (FIXTURES part B: the table whose columns correlate)
DOC_MASKS = {"n_chars": (41, 250), "n_words": (42, 250), "n_lines": (43, 250),
             "n_punct": (44, 250), "avg_word_len": (45, 250)}
DOC_COLS = ["doc_id", "lang", "source", "n_chars", "n_words", "n_lines", "n_punct", "avg_word_len"]
DOC_FEATS = ["n_chars", "n_words", "n_lines", "n_punct", "avg_word_len"]


def doc_masked(spark: SparkSession, sf_dir: str, truth: bool = True, masks=None) -> DataFrame:
    """Masked document feature matrix.  The text scan is the expensive part and
    every fit reads this table, so it is materialized once (a few doubles per
    document) in the shared checkpoint folder."""
    df = document_features(load(spark, sf_dir, "documents")).withColumn("__id", F.col("doc_id"))
    return cut(_mask(df, masks or DOC_MASKS, truth))


def doc_masked_sql(truth: bool = True, masks=None) -> str:
    return masked_sql(f"({document_features_sql()}) AS f", DOC_COLS, "doc_id", masks or DOC_MASKS, truth)
