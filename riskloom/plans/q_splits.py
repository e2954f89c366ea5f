"""Queries: stratified split, k-fold, reproducible sample."""

from __future__ import annotations

from riskloom.functions import constants as K
from riskloom.operators import splits as SP
from riskloom.plans.catalog import register
from riskloom.plans.fixture_sql import with_fixtures
from riskloom.sources import fixtures as fx

SQL_SPLIT = f"""
SELECT key, y, CASE WHEN rn <= round({K.OOT_FRACTION} * n_y) THEN 'oot'
                    WHEN rn <= round({K.OOT_FRACTION} * n_y) + round({K.TEST_SIZE} * (n_y - round({K.OOT_FRACTION} * n_y))) THEN 'test'
                    ELSE 'train' END AS split
FROM (SELECT key, y, row_number() OVER (PARTITION BY y ORDER BY md5(key)) AS rn,
             count(*) OVER (PARTITION BY y) AS n_y FROM li_risk) t"""


@register("stratified_split", with_fixtures(SQL_SPLIT, "li_risk"))
def q_split(spark, sf):
    return SP.stratified_split(fx.li_risk(spark, sf).select("key", "y"), "key", "y")


SQL_KFOLD = f"""
SELECT id, y, cast((row_number() OVER (PARTITION BY y ORDER BY md5(cast(id AS varchar))) - 1) % {K.CV_FOLDS} AS int) AS fold
FROM panel"""


@register("stratified_kfold", with_fixtures(SQL_KFOLD, "panel"))
def q_kfold(spark, sf):
    return SP.stratified_kfold(fx.panel(spark, sf).select("id", "y"), "id", "y")


SQL_SAMPLE = "SELECT key, l_extendedprice, y FROM li_risk ORDER BY md5(key) LIMIT 2000"


@register("sample_n", with_fixtures(SQL_SAMPLE, "li_risk"))
def q_sample(spark, sf):
    """Reproducible 2,000-row sample (the sampling operator is the feature)."""
    return SP.sample_n(fx.li_risk(spark, sf).select("key", "l_extendedprice", "y"), "key", 2000)
