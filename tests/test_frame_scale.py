"""How often the training frame runs its timelines."""

from tideline.queries import catalog

SMALL = "/root/testdata/sf0.001"


def test_the_timeline_of_all_streams_runs_once(spark):
    plan = catalog.stored_frame(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # Running values and bucket totals read one exchange each; the previous offer has written tables of its own.
    assert plan.count("RepartitionByExpression") == 2
