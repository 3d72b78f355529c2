"""Properties over random facts."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from searchmill import Mart, create_layers, load_exports
from searchmill.operators.keys import stage_ordered
from searchmill.operators.quality import clean_facts
from searchmill.operators.reshape import keep_positive, wide_to_facts
from tests.test_loads import header, put, raw
from tests.test_tables import FACT_TYPES, random_rows
from workload.inputs import to_wide

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

DAYS = [dt.date(2026, 2, 27) + dt.timedelta(n) for n in range(4)]
counts = st.integers(0, 3)
fact_rows = st.dictionaries(
    st.tuples(st.sampled_from(DAYS), st.sampled_from(["a", "Ü ? b", "", None]), st.sampled_from(["/x?1", "/x", None])),
    st.tuples(counts, counts, st.floats(0, 9), counts),
    min_size=1,
).map(lambda facts: [(*key, *metrics) for key, metrics in facts.items()])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@SLOW
@given(facts=fact_rows)
def test_wide_and_back_is_identity(spark, facts):
    long = spark.createDataFrame(facts, FACT_TYPES)
    assert rows(wide_to_facts(to_wide(long))) == rows(keep_positive(long))


@SLOW
@given(seed=st.integers(0, 10**6))
def test_cleaning_holds_the_funnel_and_is_idempotent(spark, seed):
    once = clean_facts(spark.createDataFrame(random_rows(seed, 100), FACT_TYPES))
    assert once.where("NOT (clicks <= impressions AND impressions <= demand)").count() == 0
    assert once.where(F.col("page_path").contains("?")).count() == 0
    assert rows(clean_facts(once)) == rows(once)


def test_loading_together_equals_loading_one_by_one(spark, mart, tmp_path):
    pick = random.Random(7)
    together = tmp_path / "all"
    together.mkdir()
    one_by_one = Mart(mart.raw + "_s", mart.clean + "_s")
    create_layers(spark, one_by_one)
    for n in range(4):
        days = sorted(pick.sample(DAYS, 2))
        sheet = [header(*days)] + [
            [q, u, *[pick.choice([0, 0, 1, None]) for _ in range(8)]] for q in "ab" for u in ("/", "/?2")
        ]
        alone = tmp_path / f"only{n}"
        alone.mkdir()
        for folder in (together, alone):
            put(folder, f"{9 - n}.xlsx", sheet, age=100 - n)
        load_exports(spark, str(alone), one_by_one)
    load_exports(spark, str(together), mart)
    strip = lambda table: sorted((r[1:] for r in table), key=str)
    assert strip(raw(spark, mart)) == strip(raw(spark, one_by_one)) != []


def test_hot_dates_and_copies_spread_over_tasks(spark, tmp_path):
    """Half of the rows are one row, most of the others share its date."""
    n = 40_000
    facts = spark.range(n).select(
        F.when(F.col("id") % 10 < 9, F.lit(DAYS[0])).otherwise(F.lit(DAYS[1])).alias("dt"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("query"),
        F.lit("/").alias("page_path"),
        *[F.lit(1).alias(m) for m in ("demand", "impressions", "position", "clicks")],
    ).withColumn("dt", F.when(F.col("query") == "hot", F.lit(DAYS[0])).otherwise(F.col("dt")))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        staged = stage_ordered(facts, str(tmp_path / "staged"))
    finally:
        spark.conf.set(setting, before)
    per_task = [r.n for r in staged.counts.groupBy("part").agg(F.sum("n").alias("n")).collect()]
    assert sum(per_task) == n and len(per_task) == 4 and max(per_task) < 0.4 * n
