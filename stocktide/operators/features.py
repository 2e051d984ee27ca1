"""Feature engineering over the windowed feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.functions import expr
from stocktide.operators.chunks import neighbours, ranged, standardise
from stocktide.operators.joins import lookup_join
from stocktide.schemas import KEYS
from stocktide.storage import staged

DEFAULT_CHUNK_S = 7 * 86400


def with_parsed_start(df: DataFrame, column: str = "window_start") -> DataFrame:
    """``window_start`` as a timestamp whether it is stored as epoch milliseconds or ISO text."""
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp"):
        return df
    return df.withColumn(column, expr.window_start_of(column, numeric=kind != "string"))


def lag_features(df: DataFrame, chunk_s: int = DEFAULT_CHUNK_S, depth: int = 6) -> DataFrame:
    """Add ``order_rate_lag1 .. lagN`` per key in window order; six are what the rolling means need."""
    return neighbours(df, KEYS, ["window_start"], "order_rate", depth, chunk_s, "order_rate_lag")


def rolling_features(lagged: DataFrame) -> DataFrame:
    """Mean and deviation of the three, and mean of the six, preceding rows; NULL while the frame is not full.

    The deviation is 0 where it is undefined.
    """
    lag = [F.col(f"order_rate_lag{i}") for i in range(1, 7)]
    mean3 = (lag[0] + lag[1] + lag[2]) / 3
    mean6 = (lag[0] + lag[1] + lag[2] + lag[3] + lag[4] + lag[5]) / 6
    squares = sum(((v - F.col("order_rate_roll3_mean")) * (v - F.col("order_rate_roll3_mean")) for v in lag[:3]), F.lit(0.0))
    return lagged.withColumns({"order_rate_roll3_mean": mean3, "order_rate_roll6_mean": mean6}).withColumn(
        "order_rate_roll3_std", F.coalesce(F.sqrt(squares / 2), F.lit(0.0))
    )


def calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns(expr.calendar("window_start"))


def forecast_features(df: DataFrame, chunk_s: int = DEFAULT_CHUNK_S, lag_domain: bool = False) -> DataFrame:
    """Forecast inputs per key; rows without six preceding rows are dropped.

    ``lag_domain`` takes depletion, momentum and stock from the preceding row, so that no input is measured
    in the window that is predicted.
    """
    df = with_parsed_start(df)
    built = calendar_features(rolling_features(lag_features(df, chunk_s)))
    if lag_domain:
        domain = ["depletion_vel", "demand_momentum", "on_hand_est"]
        shifted = neighbours(built, KEYS, ["window_start"], F.struct(*domain), 1, chunk_s, "_before")
        built = shifted.withColumns({c: F.col("_before1")[c] for c in domain}).drop("_before1")
    return built.dropna(subset=["order_rate_lag3", "order_rate_roll6_mean"]).drop(
        "order_rate_lag4", "order_rate_lag5", "order_rate_lag6"
    )


def anomaly_features(df: DataFrame, chunk_s: int = DEFAULT_CHUNK_S) -> DataFrame:
    """Add the two z-scores against the key's own history; rows with a NULL model input are dropped."""
    scored = standardise(
        df,
        KEYS,
        "window_start",
        {"order_rate": "order_rate_zscore", "depletion_vel": "depletion_vel_zscore"},
        chunk_s,
    )
    return scored.dropna(subset=schemas.ANOMALY_COLUMNS)


def online_anomaly_features(df: DataFrame) -> DataFrame:
    """Model inputs of single rows without history: defaults fill gaps, z-scores are 0."""
    defaults = {"order_rate": 0.0, "depletion_vel": 0.0, "demand_momentum": 1.0, "on_hand_est": 0}
    return df.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()},
        "order_rate_zscore": F.lit(0.0),
        "depletion_vel_zscore": F.lit(0.0),
    })


def online_forecast_features(df: DataFrame, chunk_s: int = DEFAULT_CHUNK_S) -> DataFrame:
    """Forecast inputs of the newest row per key; keys with too little history have no row."""
    built = forecast_features(df, chunk_s)
    return (
        built.groupBy(*KEYS)
        .agg(F.max_by(F.struct("window_start", *schemas.FORECAST_COLUMNS), "window_start").alias("_row"))
        .select(*KEYS, "_row.*")
    )


def label_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """Dense codes 0.. of the distinct values in sorted order; one row per distinct value.

    Distinct ids are cut into parts of even size in order, counted per part and numbered inside; no task orders all.
    """
    ids = ranged(df.select(F.col(column).cast("string").alias(column)).dropna().distinct(), [column], "_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    starts = ids.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    return ids.withColumn("_inside", inside).join(starts, "_part").select(
        column, (F.col("_start") + F.col("_inside")).cast("int").alias(code)
    )


def label_encode(df: DataFrame) -> DataFrame:
    """Add ``store_enc`` and ``sku_enc``. The rows are read once for the ids and once to be encoded."""
    keys = staged(df.select(*KEYS).distinct())
    coded = df
    for column, code in (("store_id", "store_enc"), ("sku_id", "sku_enc")):
        coded = lookup_join(coded, staged(label_codes(keys, column, code)), [column], schemas.FEATURE_KEY)
    return coded


def forecast_matrix(df: DataFrame) -> DataFrame:
    """Model inputs in model order, the target last."""
    codes = [c for c in schemas.FORECAST_CODES if c in df.columns]
    return df.select(*schemas.FORECAST_COLUMNS, *codes, F.col(schemas.FORECAST_TARGET).alias("target"))


def anomaly_matrix(df: DataFrame) -> DataFrame:
    return df.select(*schemas.ANOMALY_COLUMNS)


def union_features(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns that a frame lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def holdout_split(df: DataFrame, holdout: float = 0.2, ts: str = "window_start") -> DataFrame:
    """Add ``is_train``: true for the oldest ``int(n · (1 − holdout))`` rows by ``ts``, ties by store and product.

    Rows without a stamp count as the oldest and are always trained on.

    No global sort. Rows are counted per stamp; the running count tells which stamps lie wholly on one
    side. Only the stamp that straddles the cut is ordered, store by store. The counts are staged and the border
    is one row, so it reaches the scan as a literal filter.
    """

    def preceding(*partition: str, order: str):
        return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def before(n: str, *partition: str, order: str) -> Column:
        return F.coalesce(F.sum(n).over(preceding(*partition, order=order)), F.lit(0))

    per_stamp = staged(df.groupBy(ts).agg(F.count("*").alias("_n"))).withColumn("_day", F.to_date(ts))
    # Days, not stamps, are what a single task orders.
    days = per_stamp.groupBy("_day").agg(F.sum("_n").alias("_dn")).select("_day", before("_dn", order="_day").alias("_d0"))
    stamps = per_stamp.withColumn("_s0", before("_n", "_day", order=ts)).join(days, "_day")
    start, end = F.col("_d0") + F.col("_s0"), F.col("_d0") + F.col("_s0") + F.col("_n")
    n_train = per_stamp.agg(F.floor(F.coalesce(F.sum("_n"), F.lit(0)) * F.lit(1 - holdout))).scalar()
    straddles = (start < n_train) & (end > n_train)
    border = stamps.agg(
        F.max(F.when(straddles, F.col(ts))).alias("cut"),
        F.max(F.when(straddles, n_train - start)).alias("owed"),
        F.min(F.when(start >= n_train, F.col(ts))).alias("after"),
    ).first()

    if border["cut"] is None:
        first_held = F.lit(border["after"])
        return df.withColumn("is_train", F.coalesce(F.col(ts) < first_held, F.lit(True)))
    cut = F.lit(border["cut"])
    ties = df.filter(F.col(ts) == cut)
    stores = ties.groupBy("store_id").agg(F.count("*").alias("_n")).select(
        "store_id", before("_n", order="store_id").alias("_before")
    )
    rank = F.row_number().over(Window.partitionBy("store_id").orderBy("sku_id"))
    placed = (
        ties.withColumn("_rank", rank)
        .join(stores, "store_id")
        .withColumn("is_train", F.col("_before") + F.col("_rank") <= border["owed"])
        .select(*df.columns, "is_train")
    )
    others = df.filter(~F.col(ts).eqNullSafe(cut)).withColumn("is_train", F.coalesce(F.col(ts) < cut, F.lit(True)))
    return others.unionByName(placed)
