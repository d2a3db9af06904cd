"""Demand panels, supervised frames, global models, recursive forecasts and their scores."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import scalars as S
from ..session import stage
from .sampling import uniform_sample

FITTED_ROWS = 25_000  # labelled rows that a demand model is fitted on at most; every row is scored


def with_calendar(panel: DataFrame) -> DataFrame:
    return panel.withColumns({
        "seasonality_factor": F.round(S.seasonality("date"), 3),
        "holiday_flag": S.holiday_flag("date"),
        "promotion_flag": S.promotion_day("date"),
    })


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Dealt by key to as many partitions as a shuffle has. Series are few and days many: left to itself, adaptive execution would put
    all series into one task before their days are laid out."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


_CALENDAR = ["seasonality_factor", "holiday_flag", "promotion_flag"]


@dataclass
class DenseSeries:
    """A dense panel before its rows are made: each series is one row with its daily sales as an array over the calendar.

    Only sold days are shuffled, by key. A series' array is as long as the calendar, and the rows, with what they need of the days before,
    are read off it where it lies: they are neither grouped nor sorted. Sales without a date are one day before all others.
    """

    series: DataFrame  # the entities' columns, _y, _days (the calendar's days that _y stands for), _total
    columns: list[str]  # the entities' columns
    key: str
    first: Column  # the calendar's first day
    last: Column

    def _by_day(self) -> DataFrame:
        return self.series.select(*self.columns, "_y", "_total", F.posexplode("_days").alias("_i", "_d"))

    def _columns(self) -> list[Column]:
        day = F.col("_d")
        return [*self.columns, day["date"].alias("date"), F.get("_y", F.col("_i")).alias("daily_sales"), *[day[c].alias(c) for c in _CALENDAR]]

    def rows(self) -> DataFrame:
        return self._by_day().select(*self._columns())

    def lagged(self, fill: str = "series") -> DataFrame:
        """The rows with lag_7 and rolling_7, as lags() gives them."""
        def back(n: int) -> Column:
            return F.get("_y", F.col("_i") - n)

        week = reduce(Column.__add__, [F.coalesce(back(n), F.lit(0).cast("bigint")) for n in range(1, 8)]).cast("double")
        spare = F.col("_total").cast("double") / F.size("_y") if fill == "series" else F.when(F.col("_i") > 0, week / F.col("_i")).otherwise(0.0)
        lag_7 = F.coalesce(back(7).cast("double"), spare)
        rolling_7 = F.when(F.col("_i") > 0, week / F.least(F.lit(7), F.col("_i"))).otherwise(lag_7)
        return self._by_day().select(*self._columns(), lag_7.alias("lag_7"), rolling_7.alias("rolling_7"))

    def holdout(self, days: int = K.HOLDOUT_DAYS) -> tuple[DataFrame, DataFrame]:
        """The rows up to the cutoff, and the last `days` days after it; the calendar tells the cutoff."""
        cutoff, rows = F.date_sub(self.last, days), self.rows()
        return rows.where(F.col("date") <= cutoff), rows.where(F.col("date") > cutoff)


def dense_series(sold: DataFrame, entities: DataFrame, key: str = "series_id") -> DenseSeries:
    """Every entity with its sales on every day of the calendar; days without sales are 0.

    `sold` has (key, date, daily_sales); `entities` has one row per key and its category, sales count once for each copy of a row.
    """
    nothing = F.lit(0).cast("bigint")
    span = sold.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    no_day = F.array(F.lit(None).cast("date"))
    days = span.select("lo", "hi", F.explode(F.concat(no_day, F.sequence("lo", "hi"))).alias("date"))
    place = F.coalesce(F.datediff("date", "lo") + 1, F.lit(0)).alias("at")
    listed_days = F.array_sort(F.collect_list(F.struct(place, "date", *_CALENDAR)))
    calendar = with_calendar(days).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), listed_days.alias("full")).select(
        F.struct("lo", "hi", "full", F.slice("full", 2, F.greatest(F.size("full"), F.lit(1))).alias("dated")).alias("c")).scalar()

    daily = sold.groupBy(key, "date").agg(F.sum(F.col("daily_sales").cast("bigint")).alias("y"))
    listed = _spread(daily, key).groupBy(key).agg(
        F.collect_list(F.when(F.col("date").isNotNull(), F.struct("date", F.coalesce("y", nothing).alias("y")))).alias("_sold"),
        F.sum("y").alias("_sum"), F.max(F.col("date").isNull()).alias("_undated"),
        F.sum(F.when(F.col("date").isNull(), F.coalesce("y", nothing))).alias("_before"))
    copies = entities.groupBy(*entities.columns).agg(F.count(F.lit(1)).alias("_copies"))
    joined = _spread(copies, key).join(listed.hint("merge"), key, "left").select(
        *entities.columns, "_copies", F.coalesce("_undated", F.lit(False)).alias("_undated"), F.coalesce("_sum", nothing).alias("_sum"), "_before",
        F.array_sort(F.coalesce("_sold", F.array().cast("array<struct<date:date,y:bigint>>"))).alias("_sold"), calendar["lo"].alias("_lo"),
        F.when(F.col("_undated"), calendar["full"]).otherwise(calendar["dated"]).alias("_days"))

    def zeros(n: Column) -> Column:
        return F.array_repeat(nothing, F.greatest(n, F.lit(0)))

    def gap_and_day(d: Column, i: Column) -> Column:
        before = F.coalesce(F.datediff(F.get("_sold", i - 1)["date"], "_lo"), F.lit(-1))
        return F.concat(zeros(F.datediff(d["date"], "_lo") - before - 1), F.array(d["y"] * F.col("_copies")))

    last = F.coalesce(F.datediff(F.get("_sold", F.size("_sold") - 1)["date"], "_lo"), F.lit(-1))
    undated = F.when(F.col("_undated"), F.array(F.col("_before") * F.col("_copies"))).otherwise(F.array().cast("array<bigint>"))
    rest = F.size("_days") - F.when(F.col("_undated"), 1).otherwise(0) - last - 1
    dense = F.concat(undated, F.flatten(F.transform("_sold", gap_and_day)), zeros(rest))
    laid = joined.select(*entities.columns, dense.alias("_y"), "_days", (F.col("_sum") * F.col("_copies")).alias("_total"))
    return DenseSeries(laid, entities.columns, key, calendar["lo"], calendar["hi"])


def dense_panel(sold: DataFrame, entities: DataFrame, key: str = "series_id") -> DataFrame:
    """Every entity on every day of the calendar; days without sales are 0. See DenseSeries."""
    return dense_series(sold, entities, key).rows()


@dataclass
class Demand:
    """Sold days of the series, written once, and the calendar's ends: parts of the dense panel are built from these."""

    sold: DataFrame  # (key, date, daily_sales)
    entities: DataFrame  # (key, category)
    key: str
    first: dt.date | None
    last: dt.date | None

    def cells(self, first: dt.date | None, last: dt.date | None) -> DataFrame:
        """(key, category, date) of every series on the days from first to last."""
        if first is None or last is None or first > last:
            return self.entities.withColumn("date", F.lit(None).cast("date")).where("false")
        return _spread(self.entities, self.key).withColumn("date", F.explode(F.sequence(F.lit(first), F.lit(last))))

    def since(self, days: int) -> dt.date | None:
        """The first of the last `days` days of the calendar."""
        return None if self.last is None else max(self.first, self.last - dt.timedelta(days - 1))

    def tail(self, days: int) -> DataFrame:
        """The dense panel's last `days` days."""
        start = self.since(days)
        sold = self.sold.select(self.key, "date", "daily_sales")
        joined = self.cells(start, self.last).join(sold if start is None else sold.where(F.col("date") >= F.lit(start)), [self.key, "date"], "left")
        return with_calendar(joined.withColumn("daily_sales", F.coalesce("daily_sales", F.lit(0)).cast("bigint")))

    def sample(self, n: int, last: dt.date) -> DataFrame:
        """At most n cells up to a day, by a hash of series and day; the panel is not built for it.

        Every cell is hashed, so a cell costs one md5: a series' part of the hashed text is made once a series, a day's once a task.
        """
        if self.first is None or last is None or self.first > last:
            return uniform_sample(self.cells(self.first, last), n, [self.key, "date"])
        span = (last - self.first).days + 1
        days = self.entities.sparkSession.createDataFrame(
            [(day, f"{day}|42") for day in (self.first + dt.timedelta(k) for k in range(span))], "date date, _day string")
        own = F.when(F.col(self.key).isNull(), F.lit("")).otherwise(F.concat(F.col(self.key).cast("string"), F.lit("|")))
        cells = _spread(self.entities, self.key).withColumn("_own", own).crossJoin(F.broadcast(days))
        found = uniform_sample(cells, n, [self.key, "date"], "42", self.entities.count() * span, F.concat("_own", "_day"))
        return found.select(*self.entities.columns, "date")

    def rows_at(self, cells: DataFrame, fill: str = "series") -> DataFrame:
        """The supervised rows of some cells: a cell asks for its own day and the seven before, by one join on (key, date)."""
        asked = cells.withColumn("_back", F.explode(F.sequence(F.lit(0), F.lit(7)))).withColumn("_day", F.date_sub("date", F.col("_back")))
        sold = self.sold.select(F.col(self.key).alias("_key"), F.col("date").alias("_day"), "daily_sales")
        met = asked.join(sold, (asked[self.key] == sold["_key"]) & (asked["_day"] == sold["_day"]), "left")
        y = F.coalesce("daily_sales", F.lit(0))
        frame = met.groupBy(*cells.columns).agg(
            F.sum(F.when(F.col("_back") == 0, y).otherwise(0)).cast("bigint").alias("daily_sales"),
            F.sum(F.when(F.col("_back") == 7, y).otherwise(0)).cast("double").alias("_week_ago"),
            F.sum(F.when(F.col("_back") > 0, y).otherwise(0)).cast("double").alias("_week"),
        )
        before = F.datediff("date", F.lit(self.first))
        if fill == "series":
            days = (self.last - self.first).days + 1 if self.last else 1
            means = self.sold.groupBy(self.key).agg((F.sum("daily_sales") / days).alias("_mean"))
            frame = frame.join(means, self.key, "left")
            spare = F.coalesce("_mean", F.lit(0.0))
        else:
            spare = F.when(before > 0, F.col("_week") / before).otherwise(0.0)
        lag_7 = F.when(before >= 7, F.col("_week_ago")).otherwise(spare)
        return with_calendar(frame).withColumns({
            "lag_7": lag_7,
            "rolling_7": F.when(before > 0, F.col("_week") / F.least(F.lit(7), before)).otherwise(lag_7),
            **_day_columns(F.lit(self.first)),
        }).drop("_week", "_week_ago", "_mean")


def demand(sold: DataFrame, entities: DataFrame, key: str = "series_id") -> Demand:
    sold = stage(sold.where(F.col("date").isNotNull()), "demand-sold")
    span = sold.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    return Demand(sold, entities, key, span["lo"], span["hi"])


def lags(panel: DataFrame | DenseSeries, key: str = "series_id", fill: str = "series") -> DataFrame:
    """lag_7 and the mean of the previous seven rows, per series in date order.

    On a dense panel a series has one row per calendar day, so a window partition is bounded by the
    calendar. The first seven lags are filled with the series mean (`fill="series"`), or with the
    mean of the past only (`fill="past"`), which leaks nothing into training. Dense series need no window.
    """
    if isinstance(panel, DenseSeries):
        return panel.lagged(fill)
    ordered = Window.partitionBy(key).orderBy("date")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    week = ordered.rowsBetween(-7, -1)
    whole = Window.partitionBy(key)
    sales = F.col("daily_sales").cast("double")
    spare = F.avg(sales).over(whole) if fill == "series" else F.coalesce(F.avg(sales).over(earlier), F.lit(0.0))
    return panel.withColumn("lag_7", F.coalesce(F.lag(sales, 7).over(ordered), spare)).withColumn(
        "rolling_7", F.coalesce(F.avg(sales).over(week), F.col("lag_7"))
    )


def _day_columns(start: Column) -> dict[str, Column]:
    return {"day_index": F.datediff("date", start), "day_of_week": F.weekday("date"), "month": F.month("date")}


def supervised(panel: DataFrame | DenseSeries, key: str = "series_id", fill: str = "series", start: dt.date | None = None) -> DataFrame:
    """start: the calendar's first day, if known; else the panel is run once more for it."""
    known = panel.first if isinstance(panel, DenseSeries) else None
    first = F.lit(start) if start is not None else known if known is not None else panel.agg(F.min("date")).scalar()
    return lags(panel, key, fill).withColumns(_day_columns(first)).dropna(subset=[*K.FORECAST_NUMERIC, "category", "daily_sales"])


def holdout(frame: DataFrame | DenseSeries, days: int = K.HOLDOUT_DAYS) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cutoff, and the last `days` days after it."""
    if isinstance(frame, DenseSeries):
        return frame.holdout(days)
    cutoff = frame.agg(F.date_sub(F.max("date"), days)).scalar()
    return frame.where(F.col("date") <= cutoff), frame.where(F.col("date") > cutoff)


def errors(scored: DataFrame, actual: str = "daily_sales", predicted: str = "prediction") -> DataFrame:
    y, p = F.col(actual).cast("double"), F.col(predicted)
    miss = F.abs(y - p)
    return scored.agg(
        F.coalesce(F.round(F.avg(miss), 3), F.lit(0.0)).alias("mae"),
        F.coalesce(F.round(F.sqrt(F.avg(miss * miss)), 3), F.lit(0.0)).alias("rmse"),
        F.coalesce(F.round(F.avg(miss / F.greatest(F.abs(y), F.lit(1.0))), 4), F.lit(0.0)).alias("mape"),
        F.coalesce(F.round(F.sum(miss) / F.greatest(F.sum(F.abs(y)), F.lit(1.0)), 4), F.lit(0.0)).alias("wape"),
    )


def seasonal_naive(series: Demand, days: int = K.HOLDOUT_DAYS) -> DataFrame:
    """Score of predicting the value seven days back, on the holdout; no other day of the calendar is looked at."""
    out = errors(series.rows_at(series.cells(series.since(days), series.last)), predicted="lag_7")
    return out.select(
        F.col("mae").alias("baseline_mae"), F.col("rmse").alias("baseline_rmse"), F.col("wape").alias("baseline_wape")
    )


def fit_demand_model(frame: DataFrame, kind: str = "gbt", trees: int = 20, seed: int = 42, key: str = "series_id") -> PipelineModel:
    """One global model over all series, fitted on at most FITTED_ROWS of their rows."""
    frame = frame.select(key, "date", *K.FORECAST_NUMERIC, "category", "daily_sales")
    frame = stage(uniform_sample(frame, FITTED_ROWS, [key, "date"]), "demand-train")
    if kind == "gbt":
        learner = GBTRegressor(labelCol="daily_sales", maxIter=trees, maxDepth=5, stepSize=0.1, seed=seed)
    else:
        learner = RandomForestRegressor(labelCol="daily_sales", numTrees=trees, minInstancesPerNode=3, maxDepth=8, seed=seed)
    return Pipeline(stages=[
        StringIndexer(inputCol="category", outputCol="_cat", handleInvalid="keep"),
        OneHotEncoder(inputCol="_cat", outputCol="_cat_vec", dropLast=False),
        VectorAssembler(inputCols=[*K.FORECAST_NUMERIC, "_cat_vec"], outputCol="features"),
        learner,
    ]).fit(frame)


def fit_series(series: Demand, last: dt.date | None = None, fill: str = "series", **fit) -> PipelineModel:
    """The global model of all days up to `last`: the sampled cells are chosen first, and only their rows are built."""
    cells = series.sample(FITTED_ROWS, last or series.last)
    return fit_demand_model(series.rows_at(cells, fill), key=series.key, **fit)


def scored_holdout(series: Demand, days: int = K.HOLDOUT_DAYS, **fit) -> DataFrame:
    """Fit on the past, predict the last `days` days; lags are filled from the past only."""
    start = series.since(days)
    model = fit_series(series, start - dt.timedelta(1), "past", **fit)
    return model.transform(series.rows_at(series.cells(start, series.last), "past"))


def evaluate_model(series: Demand, days: int = K.HOLDOUT_DAYS, **fit) -> DataFrame:
    return errors(scored_holdout(series, days, **fit))


def recent_history(panel: DataFrame, key: str = "series_id", n: int = 14) -> DataFrame:
    """The last `n` values of every series as one array, oldest first. The panel's last `n` days are enough."""
    days = F.array_sort(F.collect_list(F.struct("date", F.col("daily_sales").cast("double").alias("y"))))
    listed = panel.groupBy(key).agg(F.max("category").alias("category"), F.max("date").alias("last_date"), days.alias("_days"))
    tail = F.slice("_days", -F.least(F.lit(n), F.size("_days")), F.lit(n))
    return listed.select(key, "category", "last_date", F.transform(tail, lambda r: r["y"]).alias("history"))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def _lag_7(history: Column) -> Column:
    return F.when(F.size(history) >= 7, F.element_at(history, -7)).otherwise(_mean(history))


def forecast_naive(panel: DataFrame, horizon: int, key: str = "series_id") -> DataFrame:
    """Recursive forecast whose model is the seven-day lag: one fold per series, no shuffle of steps."""
    def step(history: Column, _i: Column) -> Column:
        return F.concat(history, F.array(F.greatest(_lag_7(history), F.lit(0.0))))

    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("history"), step)
    out = recent_history(panel, key).withColumn("_all", F.slice(grown, -horizon, horizon))
    return out.select(key, "category", "last_date", F.posexplode("_all").alias("i", "y")).select(
        key, "category", F.date_add("last_date", F.col("i") + 1).alias("date"), F.round("y", 2).alias("predicted_demand")
    )


def forecast_model(
    panel: DataFrame, model: PipelineModel, horizon: int, start_date, key: str = "series_id", cut_every: int = 7
) -> DataFrame:
    """Recursive multi-step forecast of all series at once.

    Each step is one narrow transform of the whole set; every `cut_every` steps the state (one short
    array per series) is written to the shared folder so the plan stays small.
    """
    state = stage(recent_history(panel, key).withColumn("forecast", F.array().cast("array<double>")), "forecast")
    kept = state.columns
    for i in range(1, horizon + 1):
        day = F.date_add("last_date", i)
        row = state.withColumns({
            "day_index": F.datediff(day, F.lit(start_date)),
            "day_of_week": F.weekday(day),
            "month": F.month(day),
            "seasonality_factor": S.seasonality(day),
            "holiday_flag": S.holiday_flag(day),
            "promotion_flag": S.promotion_day(day),
            "lag_7": _lag_7(F.col("history")),
            "rolling_7": _mean(F.slice(F.col("history"), -F.least(F.lit(7), F.size("history")), F.lit(7))),
        })
        y = F.greatest(F.col("prediction"), F.lit(0.0))
        state = model.transform(row).withColumns({
            "history": F.slice(F.concat("history", F.array(y)), -F.least(F.lit(14), F.size("history") + 1), F.lit(14)),
            "forecast": F.concat("forecast", F.array(y)),
        }).select(*kept)
        if i % cut_every == 0 and i < horizon:
            state = stage(state, "forecast")
    return state.select(key, "category", "last_date", F.posexplode("forecast").alias("i", "y")).select(
        key, "category", F.date_add("last_date", F.col("i") + 1).alias("date"), F.round("y", 2).alias("predicted_demand")
    )


def forecast_by_category(forecast: DataFrame, first_n: int | None = None, key: str = "series_id") -> DataFrame:
    """Category forecast: the sum over all its series, or over the first `first_n` by id."""
    if first_n is not None:
        by_id = Window.partitionBy("category").orderBy(key)
        names = forecast.select("category", key).distinct().withColumn("_rn", F.row_number().over(by_id))
        forecast = forecast.join(names.where(F.col("_rn") <= first_n).select(key), key, "left_semi")
    return forecast.groupBy("category", "date").agg(F.round(F.sum("predicted_demand"), 2).alias("predicted_demand"))
