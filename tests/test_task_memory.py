"""One Python worker, with one copy of the model, in a task of a forecast."""

import datetime

from pyspark.sql import functions as F

from meterspan.operators import forecast


class Constant:
    """A model in Python, which keeps the plans that it is given."""

    def __init__(self):
        self.plans = []

    def transform(self, df):
        self.plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        plain = df.drop("features")

        def run(batches):
            yield from batches

        return plain.mapInArrow(run, plain.schema).withColumn("random_forest_kwh", F.lit(3.0))


def test_no_step_of_a_forecast_runs_on_top_of_another_steps_python(spark):
    start = datetime.date(2020, 1, 1)
    days = spark.createDataFrame([(1, start + datetime.timedelta(days=i), 2.0) for i in range(60)], "household_id long, date date, energy_kwh double")
    asked = spark.createDataFrame(
        [(1, 1, [1.0] * 30, start + datetime.timedelta(days=40), 4)],
        "request_id int, household_id long, consumption array<double>, start_date date, horizon_days int",
    )
    model = Constant()
    got = forecast.roll_forward(forecast.plan_requests(asked, days), model, 1.0).collect()
    assert [r.predicted_kwh for r in got] == [3.0] * 4
    assert len(model.plans) == 4 and not any("MapInArrow" in p for p in model.plans)
