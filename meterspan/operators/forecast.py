"""Forecast requests: one day or a roll-forward horizon for many requests at once.

A request carries ``request_id, household_id, consumption, start_date,
horizon_days``. The context vector stands for the 30 records before each target;
records older than those stay as recorded. They reach the features only through
the exponentially weighted means, so a request needs just the weighted sums of
its household at the 31st record back, not the history itself."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.arrays import push, tail_mean, tail_std, vector_reason
from meterspan.functions.calendar import daily_calendar
from meterspan.functions.scalars import first_reason
from meterspan.operators.billing import prediction_band
from meterspan.operators.features import add_ewm_state, series_window
from meterspan.session import ensure_checkpoint_dir


def contexts_before(daily, n=fixed.CONTEXT_DAYS, keys=("household_id",)):
    """Per day the n values before it, oldest first; null until there are n."""
    frame = series_window(keys).rowsBetween(-n, -1)
    values = F.collect_list("energy_kwh").over(frame)
    return daily.withColumn("consumption", F.when(F.size(values) == n, values))


def overwrite_context(daily, requests, n=fixed.CONTEXT_DAYS):
    """Recorded days before each request's start with the last n values replaced
    by the context, as rows per request."""
    prior = (
        requests.select("request_id", "household_id", "consumption", "start_date")
        .join(daily.select("household_id", "date", "energy_kwh"), "household_id")
        .filter(F.col("date") < F.col("start_date"))
    )
    back = F.row_number().over(Window.partitionBy("request_id").orderBy(F.col("date").desc()))
    supplied = F.get(F.col("consumption"), n - F.col("_back"))
    return prior.withColumn("_back", back).select(
        "request_id",
        "household_id",
        "date",
        F.when(F.col("_back") <= n, supplied).otherwise(F.col("energy_kwh")).alias("energy_kwh"),
        (F.col("_back") <= n).alias("replaced"),
    )


def _history_states(daily):
    """What a forecast needs to know after each recorded day."""
    window = series_window()
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    step = F.datediff("date", F.lag("date").over(window))
    older = [
        F.lag(f"_{part}_{s}", fixed.CONTEXT_DAYS, 0.0).over(window).alias(f"old_{part}_{s}")
        for s in fixed.EWM_SPANS
        for part in ("num", "den")
    ]
    return (
        add_ewm_state(daily.select("household_id", "date", "energy_kwh"))
        .withColumn("_step", step)
        .select(
            "household_id",
            "date",
            F.col("date").alias("last_date"),
            (F.col("_position") + 1).alias("records"),
            F.coalesce(F.max("_step").over(so_far), F.lit(0)).alias("largest_gap"),
            *older,
        )
    )


def histories_at(daily, targets):
    """State of the records strictly before each (household_id, target_date).

    Works on distinct target days, of which a household has no more than the
    calendar, whatever the number of requests."""
    states = _history_states(daily)
    fields = [c for c in states.columns if c not in ("household_id", "date")]
    recorded = states.select(
        "household_id", "date", F.lit(1).alias("_order"), F.struct(*fields).alias("_state")
    )
    asked = (
        targets.select("household_id", F.col("target_date").alias("date"))
        .distinct()
        .withColumn("_order", F.lit(0))
    )
    # At the same day the target comes first, so it does not see its own record.
    line = Window.partitionBy("household_id").orderBy("date", "_order")
    seen = line.rowsBetween(Window.unboundedPreceding, 0)
    return (
        recorded.unionByName(asked, allowMissingColumns=True)
        .withColumn("_seen", F.last("_state", ignorenulls=True).over(seen))
        .filter(F.col("_order") == 0)
        .select("household_id", F.col("date").alias("target_date"), "_seen.*")
    )


def target_reason(target, first, last):
    """Why a target day cannot be forecast, from its history state and the
    recorded range of its household."""
    n, gap = fixed.CONTEXT_DAYS, fixed.MAX_GAP_DAYS
    away = F.datediff(target, F.col("last_date"))
    return first_reason(
        [
            (first.isNull(), "No recorded days for the household."),
            (target < first, "Target date is before the start of the recorded range."),
            (target > last, "Target date is after the end of the recorded range."),
            (F.coalesce("records", F.lit(0)) < n, "Not enough history before the target date."),
            (away > gap, f"History ends more than {gap} days before the target date."),
            (F.col("largest_gap") > gap, f"History has a step longer than {gap} days."),
        ]
    )


def plan_requests(requests, daily):
    """Requests with their target days and histories in ``steps`` (at most 30
    entries) and ``reject_reason``, null for a request that can run."""
    horizon = F.col("horizon_days")
    basic = first_reason(
        [
            (
                horizon.isNull() | ~horizon.between(1, fixed.MAX_HORIZON_DAYS),
                f"Horizon must be between 1 and {fixed.MAX_HORIZON_DAYS} days.",
            )
        ]
    )
    vector = vector_reason(F.col("consumption"))
    checked = requests.withColumn("_basic", F.coalesce(vector, basic))
    runnable = checked.filter("_basic is null").select(
        "request_id",
        "household_id",
        F.posexplode(F.sequence(F.lit(0), horizon - 1)).alias("_i", "_d"),
        "start_date",
    )
    targets = runnable.select(
        "request_id", "household_id", "_i", F.date_add("start_date", F.col("_d")).alias("target_date")
    )
    spans = daily.groupBy("household_id").agg(
        F.min("date").alias("_first"), F.max("date").alias("_last")
    )
    looked = (
        targets.join(histories_at(daily, targets), ["household_id", "target_date"], "left")
        .join(spans, "household_id", "left")
        .withColumn(
            "_reason", target_reason(F.col("target_date"), F.col("_first"), F.col("_last"))
        )
    )
    state = [f"old_{p}_{s}" for s in fixed.EWM_SPANS for p in ("num", "den")]
    per_request = looked.groupBy("request_id").agg(
        F.array_sort(F.collect_list(F.struct("_i", "target_date", *state))).alias("steps"),
        F.min_by("_reason", F.when(F.col("_reason").isNotNull(), F.col("_i"))).alias("_late"),
    )
    return (
        checked.join(per_request, "request_id", "left")
        .withColumn("reject_reason", F.coalesce("_basic", "_late"))
        .drop("_basic", "_late")
    )


def context_features(context, target, state):
    """The 26 features of a target day from a context vector and the state of the
    older records, in model order."""
    out = daily_calendar(target)
    for n in fixed.LAGS:
        out[f"lag_{n}"] = F.element_at(context, -n)
    for n in fixed.ROLLING_WINDOWS:
        out[f"rolling_mean_{n}"] = tail_mean(context, n)
    for n in fixed.ROLLING_WINDOWS:
        out[f"rolling_std_{n}"] = tail_std(context, n)
    for s in fixed.EWM_SPANS:
        c = 1.0 - 2.0 / (s + 1.0)
        n = fixed.CONTEXT_DAYS
        recent = F.aggregate(context, F.lit(0.0), lambda acc, x: acc * c + x)
        weight = (1.0 - c**n) / (1.0 - c)
        num = recent + c**n * F.coalesce(state(f"old_num_{s}"), F.lit(0.0))
        den = weight + c**n * F.coalesce(state(f"old_den_{s}"), F.lit(0.0))
        out[f"ewm_{s}"] = num / den
    return out


def request_features(planned):
    """Feature row of the first target day per accepted request."""
    first = F.col("steps")[0]
    features = context_features(F.col("consumption"), first["target_date"], lambda n: first[n])
    return planned.filter("reject_reason is null").select(
        "request_id",
        "household_id",
        first["target_date"].alias("date"),
        *[features[c].alias(c) for c in fixed.DAILY_FEATURES],
    )


def roll_forward(planned, model, mae, prediction="random_forest_kwh"):
    """One row per accepted request and step. Each prediction, floored at zero, is
    the newest value of the next step's context.

    Steps are taken for all requests together and are narrow. The plan is cut at
    a checkpoint after every step: a task then has one Python worker with one copy
    of the model, while steps in one plan would each have their own at a time."""
    spark = planned.sparkSession
    ensure_checkpoint_dir(spark)
    runs = planned.filter("reject_reason is null").select(
        "request_id",
        "household_id",
        "horizon_days",
        "steps",
        F.col("consumption").alias("_context"),
        F.array().cast("array<double>").alias("_out"),
    )
    runs = runs.checkpoint()
    longest = runs.agg(F.max("horizon_days")).first()[0] or 0
    for i in range(longest):
        step = F.get("steps", F.lit(i))
        features = context_features(F.col("_context"), step["target_date"], lambda n, s=step: s[n])
        vector = array_to_vector(F.array(*[F.coalesce(features[c].cast("double"), F.lit(0.0)) for c in fixed.DAILY_FEATURES]))
        active = F.col("horizon_days") > i
        predicted = F.greatest(F.lit(0.0), F.col(prediction))
        runs = (
            model.transform(runs.withColumn("features", vector))
            .withColumn("_next", F.when(active, predicted))
            .withColumn("_out", F.concat("_out", F.array("_next")))
            .withColumn(
                "_context",
                F.when(active, push(F.col("_context"), F.col("_next"))).otherwise(F.col("_context")),
            )
            .select("request_id", "household_id", "horizon_days", "steps", "_context", "_out")
        )
        runs = runs.checkpoint()
    band = prediction_band(F.col("predicted_kwh"), F.lit(float(mae)))
    return (
        runs.select(
            "request_id",
            "household_id",
            "horizon_days",
            F.posexplode(F.arrays_zip(F.col("steps").alias("at"), F.col("_out").alias("kwh"))).alias(
                "_i", "_r"
            ),
        )
        .filter(F.col("_i") < F.col("horizon_days"))
        .select(
            "request_id",
            "household_id",
            (F.col("_i") + 1).alias("step"),
            F.col("_r.at.target_date").alias("target_date"),
            F.col("_r.kwh").alias("predicted_kwh"),
        )
        .withColumns({"uncertainty_kwh": F.lit(float(mae)), **band})
        .drop("width_kwh")
    )


def horizon_totals(forecasts):
    """Total and mean of the rounded daily forecasts and the last day per request."""
    total = F.sum(F.round("predicted_kwh", 3))
    return forecasts.groupBy("request_id", "household_id").agg(
        F.count(F.lit(1)).alias("horizon_days"),
        F.round(total, 3).alias("total_predicted_kwh"),
        F.round(total / F.count(F.lit(1)), 3).alias("avg_predicted_kwh"),
        F.min("target_date").alias("start_date"),
        F.max("target_date").alias("end_date"),
    )


def preset_windows(daily, split, presets=tuple(fixed.FORECAST_PRESETS), n=fixed.CONTEXT_DAYS):
    """Context vector and target day per household and forecast preset.

    ``test_split`` presets use the n days before the household's test rows
    begin, ``tail`` presets the n newest days; the vector is scaled."""
    starts = split.filter("split = 'test'").groupBy("household_id").agg(F.min("date").alias("_start"))
    before_test = (
        daily.join(starts, "household_id").filter(F.col("date") < F.col("_start")).drop("_start")
    )
    newest = Window.partitionBy("household_id").orderBy(F.col("date").desc())

    def window_of(rows, name):
        return (
            rows.withColumn("_r", F.row_number().over(newest))
            .filter(F.col("_r") <= n)
            .groupBy("household_id")
            .agg(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("date", "energy_kwh"))),
                    lambda s: s["energy_kwh"],
                ).alias("_values"),
                F.max("date").alias("_last"),
            )
            .withColumn("_source", F.lit(name))
        )

    windows = window_of(before_test, "test_split").unionByName(window_of(daily, "tail"))
    rules = F.array(
        *[
            F.struct(
                F.lit(name).alias("preset"),
                F.lit(source).alias("source"),
                F.lit(scale).alias("scale"),
                F.lit(offset).alias("offset"),
            )
            for name, source, scale, offset in presets
        ]
    )
    return (
        windows.filter(F.size("_values") == n)
        .withColumn("_p", F.explode(F.filter(rules, lambda r: r["source"] == F.col("_source"))))
        .select(
            "household_id",
            F.col("_p.preset").alias("preset"),
            F.transform("_values", lambda x: F.round(x * F.col("_p.scale"), 3)).alias("consumption"),
            F.date_add("_last", F.col("_p.offset") + 1).alias("target_date"),
        )
    )
