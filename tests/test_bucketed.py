import pytest
from conftest import rows

from codeloom.functions.levels import TRANSACTION
from codeloom.operators import evaluation
from codeloom.registry import evaluation_queries as queries
from codeloom.registry import views
from codeloom.sources import tables


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def matched(pred, truth):
    return evaluation.layer_one(pred, truth, TRANSACTION, "transaction_code", ["gt_desc"], queries.ORDER)


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_no_exchange_below_the_join(spark, sf, no_broadcast):
    plain = matched(views.predictions(spark, sf), views.truth(spark, sf))
    pred, truth = queries._bucketed(views.predictions(spark, sf), "pred"), queries._bucketed(views.truth(spark, sf), "truth")
    stored = matched(pred, truth)
    assert exchanges(plain) > 0 and exchanges(stored) == 0
    assert "SortMergeJoin" in stored._jdf.queryExecution().executedPlan().toString()
    assert rows(stored, *plain.columns) == rows(plain)


def test_null_codes_repeats_and_an_empty_table(spark, tmp_path):
    data = [(None, 1), ("a", 2), ("a", 2), ("", 3)]
    for name, kept in (("bucketed_some", data), ("bucketed_none", [])):
        df = spark.createDataFrame(kept, "code string, n int")
        tables.save_bucketed(df, name, "code", 4, f"{tmp_path}/{name}")
        tables.save_bucketed(df, name, "code", 4, f"{tmp_path}/{name}")
        assert rows(tables.load(spark, name)) == sorted(kept, key=repr)
