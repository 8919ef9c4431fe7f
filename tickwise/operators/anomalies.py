"""Z-score anomaly detection over feature windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise import schemas as S
from tickwise.functions.columns import PCT_FALLBACK_SQL, SEVERITY_SQL, _num, z_score_sql
from tickwise.operators.rolling import FEATURES, merge_moments, moments, rolling_stats
from tickwise.session import materialize


def z_scores(stats: DataFrame, features=FEATURES) -> DataFrame:
    """Add ``{f}_z`` = (x - mean) / std when std > 0, else 0.0."""
    return stats.selectExpr("*", *[
        z_score_sql(f"`{f}`", f"`{f}_mean`", f"`{f}_std`") + f" AS `{f}_z`" for f in features])


def _hit_sql(f: str, label: str, mode: str, threshold: float) -> str:
    z, t = f"`{f}_z`", _num(threshold)
    if mode == "compat":
        return f"(abs({z}) > {t} OR ({z} = 0D AND {PCT_FALLBACK_SQL}))"
    own = {"price_spike": f"abs(price_return_pct) > {_num(S.FALLBACK_RETURN_PCT)}",
           "volatility_burst": f"rolling_volatility > avg_price * {_num(S.FALLBACK_VOL_RATIO)}"}
    finite = f"(NOT isnan({z}) AND abs({z}) < {_num(float('inf'))})"
    return f"(({finite} AND abs({z}) > {t}) OR (`{f}_std` IS NULL AND {own.get(label, 'false')}))"


def detect_anomalies(windows: DataFrame, threshold: float = S.Z_SCORE_THRESHOLD,
                     lookback: int | None = None, mode: str = "compat",
                     detected_at: Column | str | None = None,
                     min_rows: int | None = None, strategy: str = "chunked",
                     chunk_seconds: int | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Flag windows whose feature z-score against the symbol's history is large.

    compat mode (as the reference computes it): a feature row is flagged when
    ``abs(z) > threshold`` or when ``z == 0`` and the early-window fallback
    (big return or volatility) holds — then all three labels fire.
    strict mode: the fallback only applies while no stddev is available
    (fewer than two earlier windows) and only to its own feature (return
    rule -> price_spike, volatility rule -> volatility_burst); non-finite
    values never count.

    The three feature checks run in one pass: each window row becomes up to
    three rows through ``inline(array(struct...))`` and one filter, instead of
    three filtered copies unioned together.

    ``detected_at``: column name or Column; default ``current_timestamp()``.
    ``min_rows``: no anomalies if the input has fewer window rows (the
    reference skips batches with fewer than two); the count is an uncorrelated
    scalar subquery over the stored windows that the statistics are read from.
    ``stats``: pre-computed rolling stats (e.g. from ``score_with_history``).
    """
    if mode not in ("compat", "strict"):
        raise ValueError("mode must be 'compat' or 'strict'")
    if min_rows is not None:
        windows = materialize(windows, "guard-input")
    if stats is None:
        stats = rolling_stats(windows, FEATURES, lookback=lookback,
                              strategy=strategy, chunk_seconds=chunk_seconds)
    z = z_scores(stats)
    if detected_at is None:
        det = F.current_timestamp()
    elif isinstance(detected_at, str):
        det = F.col(detected_at)
    else:
        det = detected_at

    items = [f"named_struct('anomaly_type', '{label}', 'current_value', `{f}`, "
             f"'mean_value', coalesce(`{f}_mean`, 0D), 'std_value', coalesce(`{f}_std`, 1D), "
             f"'z_score', `{f}_z`, '_hit', coalesce({_hit_sql(f, label, mode, threshold)}, false))"
             for f, label in S.FEATURE_LABELS]
    base = z
    if min_rows is not None:
        n = windows.select(F.count(F.lit(1))).scalar()
        base = base.filter(n >= F.lit(min_rows))
    out = (base.select("symbol", "asset_type", det.alias("detected_at"), "window_start",
                       "window_end", F.col("close_price").alias("price"),
                       F.col("total_volume").alias("volume"),
                       F.expr(f"inline(array({', '.join(items)}))"))
           .filter("_hit"))
    return out.selectExpr("symbol", "asset_type", "anomaly_type", "detected_at",
                          "window_start", "window_end", "current_value", "mean_value",
                          "std_value", "z_score", "price", "volume",
                          f"{SEVERITY_SQL} AS severity")


def score_with_history(batch: DataFrame, history: DataFrame | None,
                       threshold: float = S.Z_SCORE_THRESHOLD, mode: str = "compat",
                       detected_at: Column | str | None = None,
                       chunk_seconds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Score a batch of new windows against stored per-symbol history.

    ``history``: moments of all earlier windows per (symbol, asset_type)
    (``moments`` output; None when empty). The history must end before the
    batch's windows, which append-mode streaming guarantees. Returns
    ``(anomalies, new_history)``; the z-scores equal a batch run over all
    windows so far, with no re-read of the lake and a history of one row per
    symbol.
    """
    stats = rolling_stats(batch, FEATURES, base=history, chunk_seconds=chunk_seconds)
    anomalies = detect_anomalies(batch, threshold=threshold, mode=mode,
                                 detected_at=detected_at, stats=stats)
    new = moments(batch)
    return anomalies, (new if history is None else merge_moments(history, new))


def score_with_tail(batch: DataFrame, tail: DataFrame | None, lookback: int,
                    threshold: float = S.Z_SCORE_THRESHOLD, mode: str = "compat",
                    detected_at: Column | str | None = None) -> tuple[DataFrame, DataFrame]:
    """Bounded-lookback variant of ``score_with_history``.

    ``tail``: the last ``lookback`` windows of every symbol seen so far
    (keys, window_start and the three features). Returns ``(anomalies,
    new_tail)``; the z-scores equal a batch run with the same lookback.
    """
    keep = ["symbol", "asset_type", "window_start", *FEATURES]
    b = batch.withColumn("_hist", F.lit(False))
    u = b if tail is None else b.unionByName(
        tail.select(*keep).withColumn("_hist", F.lit(True)), allowMissingColumns=True)
    stats = rolling_stats(u, FEATURES, lookback=lookback)
    anomalies = detect_anomalies(batch, threshold=threshold, mode=mode,
                                 detected_at=detected_at,
                                 stats=stats.filter(~F.col("_hist")).drop("_hist"))
    return anomalies, last_rows(u.select(*keep), lookback)


#: Groups of one level of ``last_rows`` that make one of the next.
FAN = 64


def last_rows(df: DataFrame, n: int, keys=("symbol", "asset_type"),
              order: str = "window_start", chunk_rows: int = 256) -> DataFrame:
    """The newest ``n`` rows of every key, by a tree of bounded groups: the newest n of
    each (key, time chunk), then of each (key, FAN chunks), and so on until one
    group spans the whole time. No group has more than FAN * n rows, whatever the
    number of a key's rows, and none is of the key alone."""
    from pyspark.sql.window import Window
    from tickwise.operators.rolling import _chunk_col
    df = materialize(df, "tail-input")
    top = df.withColumn("_c", _chunk_col(df, order, None, chunk_rows))
    low, high = top.agg(F.min("_c"), F.max("_c")).first()
    if low is None:
        return df
    while True:
        newest = Window.partitionBy(*keys, "_c").orderBy(F.col(order).desc())
        top = top.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= n).drop("_r")
        if low == high:
            return top.drop("_c")
        low, high = low // FAN, high // FAN
        top = top.withColumn("_c", F.floor(F.col("_c") / FAN).cast("long"))


def with_row_defaults(df: DataFrame, kind: str = "anomalies") -> DataFrame:
    """Columns the relational store fills in: id (uuid), created_at (now),
    severity 'medium' and metadata (JSON text, null unless given) for anomalies,
    record_count 0 for clean rows."""
    out = df.withColumn("id", F.expr("uuid()"))
    if "created_at" not in df.columns:
        out = out.withColumn("created_at", F.current_timestamp())
    if kind == "anomalies":
        out = out.withColumn("severity", F.coalesce(F.col("severity"), F.lit("medium")))
        if "metadata" not in df.columns:
            out = out.withColumn("metadata", F.lit(None).cast("string"))
    else:
        out = out.withColumn("record_count",
                             F.coalesce(F.col("record_count").cast("int"), F.lit(0)))
    return out
