"""Seasonal autoregression with a moving-average term, fitted in two stages inside the JVM.

The series is differenced once and over the season. A long autoregression of the differences gives the innovations;
then the differences are explained by their own last value, the seasonal one, the product of both and the last
innovation. The sums of squares are bilinear in the two autoregressive coefficients, so they are solved for in turns, each
time in closed form and never upwards. All of it needs a few sums for each series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS = 200
#: Change of a coefficient in the last turn up to which the fit counts as converged.
STEADY = 1e-8


def differences(df: DataFrame, season: int = 4) -> DataFrame:
    """Training rows with ``z``, the series differenced once and over the season, and its lags 1, ``season`` and ``season`` + 1."""
    order = Window.partitionBy("series_id").orderBy("date")
    y = lambda k: F.lag("y", k).over(order)
    rows = df.filter(~F.col("is_test")).select("series_id", "date", "y").withColumn("z", F.col("y") - y(1) - y(season) + y(season + 1))
    return rows.withColumns({"z1": F.lag("z", 1).over(order), "zs": F.lag("z", season).over(order), "zp": F.lag("z", season + 1).over(order)})


def _three(a: dict[str, Column], b: dict[str, Column]) -> list[Column]:
    """Solution of a symmetric system of three equations by determinants; null if it is singular."""
    minor = {
        "11": a["22"] * a["33"] - a["23"] * a["23"], "12": a["13"] * a["23"] - a["12"] * a["33"], "13": a["12"] * a["23"] - a["13"] * a["22"],
        "22": a["11"] * a["33"] - a["13"] * a["13"], "23": a["12"] * a["13"] - a["11"] * a["23"], "33": a["11"] * a["22"] - a["12"] * a["12"],
    }
    det = a["11"] * minor["11"] + a["12"] * minor["12"] + a["13"] * minor["13"]
    return [F.try_divide(sum((minor["".join(sorted(f"{i}{j}"))] * b[j] for j in "123"), F.lit(0.0)), det) for i in "123"]


def innovations(df: DataFrame, season: int = 4) -> DataFrame:
    """Adds ``e``, what an autoregression on lags 1, ``season`` and ``season`` + 1 leaves of ``z``, and its last value ``e1``."""
    series = Window.partitionBy("series_id")
    order = series.orderBy("date")
    names = {"1": "z1", "2": "zs", "3": "zp"}
    whole = F.col("zp").isNotNull() & F.col("z").isNotNull()
    total = lambda x, y: F.sum(F.when(whole, F.col(x) * F.col(y))).over(series)
    a = {f"{i}{j}": total(names[i], names[j]) for i in names for j in names if i <= j}
    rows = df.withColumns({f"_a{k}": v for k, v in a.items()} | {f"_b{i}": total(names[i], "z") for i in names})
    psi = _three({k: F.col(f"_a{k}") for k in a}, {i: F.col(f"_b{i}") for i in names})
    rows = rows.withColumn("e", F.col("z") - psi[0] * F.col("z1") - psi[1] * F.col("zs") - psi[2] * F.col("zp"))
    return rows.withColumn("e1", F.lag("e", 1).over(order)).drop(*[f"_a{k}" for k in a], *[f"_b{i}" for i in names])


def coefficients(df: DataFrame, season: int = 4) -> DataFrame:
    """``(series_id, ar, seasonal_ar, ma, converged)`` from the training rows of ``df``.

    The turns start without any term. A series too short or too regular for a closed form has null coefficients, as has one
    with null values where a window needs them.
    """
    rows = innovations(differences(df, season), season).filter("e1 IS NOT NULL AND z IS NOT NULL")
    names = ("z", "z1", "zs", "zp", "e1")
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i:]]
    sums = rows.groupBy("series_id").agg(*[F.sum(F.col(x) * F.col(y)).alias(f"{x}_{y}") for x, y in pairs])
    at = {(x, y): F.col(f"{x}_{y}") for x, y in pairs}
    dot = lambda x, y: at[(x, y)] if (x, y) in at else at[(y, x)]

    def turn(state: Column, _: Column) -> Column:
        phi = state["seasonal_ar"]
        # a = z1 - phi zp explains w = z - phi zs together with the last innovation
        aa = dot("z1", "z1") - 2 * phi * dot("z1", "zp") + phi * phi * dot("zp", "zp")
        ae, we = dot("z1", "e1") - phi * dot("zp", "e1"), dot("z", "e1") - phi * dot("zs", "e1")
        aw = dot("z1", "z") - phi * (dot("z1", "zs") + dot("zp", "z")) + phi * phi * dot("zp", "zs")
        det = aa * dot("e1", "e1") - ae * ae
        ar, ma = F.try_divide(aw * dot("e1", "e1") - ae * we, det), F.try_divide(aa * we - ae * aw, det)
        # d = zs - ar zp explains what the other two leave
        dd = dot("zs", "zs") - 2 * ar * dot("zs", "zp") + ar * ar * dot("zp", "zp")
        dv = (dot("zs", "z") - ar * dot("zs", "z1") - ma * dot("zs", "e1")) - ar * (dot("zp", "z") - ar * dot("zp", "z1") - ma * dot("zp", "e1"))
        after = F.try_divide(dv, dd)
        moved = F.greatest(F.abs(ar - state["ar"]), F.abs(ma - state["ma"]), F.abs(after - phi))
        return F.struct(ar.alias("ar"), after.alias("seasonal_ar"), ma.alias("ma"), moved.alias("moved"))

    zero = F.lit(0.0)
    start = F.struct(zero.alias("ar"), zero.alias("seasonal_ar"), zero.alias("ma"), zero.alias("moved"))
    fitted = sums.withColumn("f", F.aggregate(F.sequence(F.lit(1), F.lit(TURNS)), start, turn))
    return fitted.select("series_id", "f.ar", "f.seasonal_ar", "f.ma", F.coalesce(F.col("f.moved") <= STEADY, F.lit(False)).alias("converged"))


def forecast(df: DataFrame, horizon: int, season: int = 4) -> DataFrame:
    """``(series_id, step, y_hat)`` of the periods after the training rows: differences first, then summed up.

    Every step uses values of the training rows and of earlier steps only. Of the innovations the last one
    counts, for the first step. Without coefficients the differences are taken to stay zero.
    """
    rows = innovations(differences(df, season), season)
    tail = rows.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct("date", "y", F.coalesce("z", F.lit(0.0)).alias("z"), F.coalesce("e1", F.lit(0.0)).alias("e1")))).alias("h"))
    reach = season + 2
    tail = tail.filter(F.size("h") >= reach).withColumn("h", F.slice("h", -reach, reach)).join(coefficients(df, season), "series_id", "left")
    ar, sar, ma = (F.coalesce(c, F.lit(0.0)) for c in ("ar", "seasonal_ar", "ma"))
    ys, zs = F.transform(F.slice("h", 2, season + 1), lambda r: r["y"]), F.transform("h", lambda r: r["z"])
    last = F.col("h")[reach - 1]
    shock = last["z"] - ar * zs[reach - 2] - sar * zs[reach - 1 - season] + ar * sar * zs[reach - 2 - season] - ma * last["e1"]
    none = F.array().cast("array<double>")
    start = F.struct(ys.alias("y"), F.slice(zs, 2, season + 1).alias("z"), shock.alias("shock"), none.alias("out"))

    def step(state: Column, _: Column) -> Column:
        y, z = state["y"], state["z"]  # the last season + 1 of each, newest at the end
        z_next = ar * z[season] + sar * z[1] - ar * sar * z[0] + ma * state["shock"]
        y_next = y[season] + y[1] - y[0] + z_next
        push = lambda values, value: F.concat(F.slice(values, 2, season), F.array(value))
        return F.struct(push(y, y_next).alias("y"), push(z, z_next).alias("z"), F.lit(0.0).alias("shock"), F.concat(state["out"], F.array(y_next)).alias("out"))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda state: state["out"])
    return tail.select("series_id", F.posexplode(path).alias("i", "y_hat")).select("series_id", (F.col("i") + 1).alias("step"), "y_hat")


def predict(df: DataFrame, season: int = 4) -> DataFrame:
    """``(series_id, date, y, y_hat)`` of the test rows, forecast from the end of the training rows."""
    order = Window.partitionBy("series_id").orderBy("date")
    test = df.filter("is_test").select("series_id", "date", "y").withColumn("step", F.row_number().over(order))
    horizon = test.agg(F.max("step")).first()[0]
    if not horizon:
        return test.select("series_id", "date", "y", F.lit(None).cast("double").alias("y_hat"))
    return test.join(forecast(df, horizon, season), ["series_id", "step"], "left").select("series_id", "date", "y", "y_hat")
