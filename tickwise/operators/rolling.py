"""Per-symbol rolling mean / sample stddev over earlier window rows.

Semantics (both strategies): for every row, the average and sample standard
deviation of each feature over the rows of the same key that come *before*
it in ``order`` — all of them (``lookback=None``) or the last ``lookback``
rows. Nulls are ignored as by ``avg``/``stddev``; fewer than two values give
a null stddev, none give a null mean.

``strategy="direct"`` is the textbook ``Window.partitionBy(keys)``. It puts
all rows of one symbol into one task, so a symbol holding a third of the
data makes one straggler task holding a third of the data.

``strategy="chunked"`` (default) splits every key into time chunks of
``chunk_rows`` window widths (or ``chunk_seconds``). A chunk of one key
holds at most ``chunk_rows`` windows however hot the key is, and chunks of
one key spread over all reducers:

1. local running moments inside (key, chunk) by a bounded window;
2. per-chunk moments (count, sum, M2, min, max) — one row per key and chunk;
3. an exclusive prefix over that small table per key (sums of counts, sums
   and shifted squares; shift = the key's first chunk mean, which keeps the
   squares well conditioned). For a large input, whose hottest key may have
   millions of chunks, this is a scan of two levels: inside groups of
   GROUP_CHUNKS chunks, then over the totals of the groups;
4. join 3 back on (key, chunk) and merge prefix and local moments with the
   parallel-variance formula. If all values seen are equal, the stddev is
   exactly 0, as in a sequential update.

For a bounded lookback, step 3 also yields the number of earlier rows, so
each row gets its global index per key; rows are regrouped into blocks of
``block_rows`` indexes, the last ``lookback`` rows of a block are copied into
the next block (halo), and a plain ``rowsBetween(-lookback, -1)`` window runs
per block. Copies are dropped afterwards; nothing is capped or sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwise import schemas as S
from tickwise.functions.columns import epoch_micros
from tickwise.session import materialize

FEATURES = tuple(f for f, _ in S.FEATURE_LABELS)


def rolling_stats(windows: DataFrame, features: Sequence[str] = FEATURES,
                  lookback: int | None = None,
                  keys: Sequence[str] = ("symbol", "asset_type"),
                  order: str = "window_start", strategy: str = "chunked",
                  chunk_seconds: int | None = None, block_rows: int = 4096,
                  base: DataFrame | None = None, chunk_rows: int = 256,
                  levels: int | None = None) -> DataFrame:
    """Add ``{f}_mean`` and ``{f}_std`` for every feature ``f``.

    ``base``: moments of earlier rows per key (``moments()`` output), e.g. the
    stored history of a stream; they count as rows before every input row.
    A null key value is a key like any other. ``levels``: 1 scans the chunks of a
    key in one task, 2 in groups (default: 2 for a large stored input). ``direct`` is the reference for
    tests; production plans use ``chunked``.
    """
    if lookback is not None and lookback < 1:
        raise ValueError("lookback must be >= 1 or None")
    if base is not None and (lookback is not None or strategy != "chunked"):
        raise ValueError("base moments need lookback=None and the chunked strategy")
    if strategy == "direct":
        return _direct(windows, features, lookback, keys, order)
    if strategy != "chunked":
        raise ValueError(f"unknown strategy {strategy!r}")
    return _chunked(windows, features, lookback, list(keys), order,
                    chunk_seconds, max(block_rows, lookback or 1), base, chunk_rows, levels)


def moments(windows: DataFrame, features: Sequence[str] = FEATURES,
            keys: Sequence[str] = ("symbol", "asset_type"), order: str = "window_start"
            ) -> DataFrame:
    """Per key: ``{f}_n, {f}_sum, {f}_m2, {f}_min, {f}_max`` and the newest ``order``.

    One partial/final aggregation; M2 comes from Spark's stable variance.
    """
    aggs = [f"max({_q(order)}) AS {_q('last_' + order)}"]
    for f in features:
        q = _q(f)
        aggs += [f"count({q}) AS {_q(f + '_n')}", f"sum({q}) AS {_q(f + '_sum')}",
                 f"coalesce(var_samp({q}), 0D) * greatest(count({q}) - 1, 0) AS {_q(f + '_m2')}",
                 f"min({q}) AS {_q(f + '_min')}", f"max({q}) AS {_q(f + '_max')}"]
    return windows.groupBy(*keys).agg(*[F.expr(a) for a in aggs])


def merge_moments(a: DataFrame, b: DataFrame, features: Sequence[str] = FEATURES,
                  keys: Sequence[str] = ("symbol", "asset_type"),
                  order: str = "window_start") -> DataFrame:
    """Combine two moment tables key by key (parallel-variance formula).

    Both sides hold one row per key, so the full outer join is over the
    number of symbols, not the number of windows.
    """
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{_q(k)}").eqNullSafe(F.col(f"b.{_q(k)}"))
    j = a.alias("a").join(b.alias("b"), on=same, how="full_outer")
    last = _q("last_" + order)
    out = [f"coalesce(a.{_q(k)}, b.{_q(k)}) AS {_q(k)}" for k in keys] + [f"greatest(a.{last}, b.{last}) AS {last}"]
    for f in features:
        n_, s_, m_ = _q(f + "_n"), _q(f + "_sum"), _q(f + "_m2")
        na, nb = f"coalesce(a.{n_}, 0)", f"coalesce(b.{n_}, 0)"
        sa, sb = f"coalesce(a.{s_}, 0D)", f"coalesce(b.{s_}, 0D)"
        delta = f"(try_divide({sb}, {nb}) - try_divide({sa}, {na}))"
        out += [f"{na} + {nb} AS {n_}",
                f"CASE WHEN {na} + {nb} > 0 THEN {sa} + {sb} END AS {s_}",
                f"coalesce(a.{m_}, 0D) + coalesce(b.{m_}, 0D) + CASE WHEN {na} > 0 AND {nb} > 0 "
                f"THEN try_divide({delta} * {delta} * {na} * {nb}, {na} + {nb}) ELSE 0D END AS {m_}",
                f"least(a.{_q(f + '_min')}, b.{_q(f + '_min')}) AS {_q(f + '_min')}",
                f"greatest(a.{_q(f + '_max')}, b.{_q(f + '_max')}) AS {_q(f + '_max')}"]
    return j.selectExpr(*out)


def _frame(keys, order, lookback):
    w = Window.partitionBy(*keys).orderBy(order)
    return w.rowsBetween(Window.unboundedPreceding if lookback is None else -lookback, -1)


def _direct(df, features, lookback, keys, order):
    w = _frame(list(keys), order, lookback)
    cols = []
    for f in features:
        cols += [F.avg(f).over(w).alias(f"{f}_mean"), F.stddev(f).over(w).alias(f"{f}_std")]
    return df.select("*", *cols)


def _chunk_col(df, order, chunk_seconds, chunk_rows) -> Column:
    """Chunk id: time bucket of ``chunk_seconds``, or by default ``chunk_rows``
    window widths (the smallest width in the input, an uncorrelated scalar
    subquery), so a chunk of one key never holds more than ``chunk_rows``
    distinct windows whatever the width."""
    us = epoch_micros(df, order)
    if chunk_seconds is not None:
        span = F.lit(int(chunk_seconds) * 1_000_000)
    elif "window_end" in df.columns:
        width = df.select(F.min(epoch_micros(df, "window_end") - us)).scalar()
        span = F.greatest(width, F.lit(1)) * F.lit(int(chunk_rows))
    else:
        span = F.lit(86400 * 1_000_000)
    return F.floor(us / span).cast("long")


_BEFORE_ALL = -(2 ** 62)  # chunk id of the base moments: before every real chunk


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Chunks in a group of the second level, and the stored bytes of an input from which
#: there is one (some millions of windows). A choice of plan: results are the same.
GROUP_CHUNKS, TWO_LEVELS_FROM = 256, 256 << 20


def _moments_of(p: str, i: int) -> tuple[str, ...]:
    return tuple(f"{p}{m}{i}" for m in ("n", "s", "m", "min", "max"))


def _joined_moments(a: str, b: str, i: int, out: str) -> list[str]:
    """Moments of feature ``i`` of two row sets, from columns with the prefixes ``a`` and ``b``
    (count, sum, squared deviations, least, greatest), by the parallel-variance formula."""
    (na, sa, ma, la, ga), (nb, sb, mb, lb, gb) = _moments_of(a, i), _moments_of(b, i)
    n, s, m, least, most = _moments_of(out, i)
    delta = f"(try_divide({sa}, {na}) - try_divide({sb}, {nb}))"
    return [f"{na} + {nb} AS {n}",
            f"CASE WHEN {na} = 0 THEN {sb} WHEN {nb} = 0 THEN {sa} ELSE {sa} + {sb} END AS {s}",
            f"CASE WHEN {na} = 0 THEN {mb} WHEN {nb} = 0 THEN {ma} "
            f"ELSE {ma} + {mb} + try_divide({delta} * {delta} * {na} * {nb}, {na} + {nb}) END AS {m}",
            f"least({la}, {lb}) AS {least}", f"greatest({ga}, {gb}) AS {most}"]


def _before(table: DataFrame, part: str, order: str, features: int, a: str, out: str) -> DataFrame:
    """Adds the moments of all earlier rows of the partition (prefix ``out``; count of rows
    ``{out}cnt``) to a table of moments (prefix ``a``). Squares are shifted by the
    first mean of the partition, which keeps them well conditioned."""
    w = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    whole = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    table = table.selectExpr("*", *[
        f"first(CASE WHEN {a}n{i} > 0 THEN try_divide({a}s{i}, {a}n{i}) END, true) {whole} AS _c{i}" for i in range(features)])
    sums = [f"coalesce(sum({a}cnt) {w}, 0) AS {out}cnt"]
    for i in range(features):
        n, s, m, least, most = _moments_of(a, i)
        y = f"(CASE WHEN {n} > 0 THEN try_divide({s}, {n}) - _c{i} END)"
        sums += [f"coalesce(sum({n}) {w}, 0) AS {out}n{i}", f"sum({s}) {w} AS {out}s{i}",
                 f"sum({n} * {y}) {w} AS _t{i}", f"sum(CASE WHEN {n} > 0 THEN {m} + {n} * {y} * {y} END) {w} AS _q{i}",
                 f"min({least}) {w} AS {out}min{i}", f"max({most}) {w} AS {out}max{i}"]
    done = table.selectExpr("*", *sums)
    # about the prefix's own mean: Q - T^2 / N
    about = [f"coalesce(greatest(_q{i} - try_divide(_t{i} * _t{i}, {out}n{i}), 0D), 0D) AS {out}m{i}" for i in range(features)]
    return done.selectExpr("*", *about).drop(*[f"{c}{i}" for c in ("_c", "_t", "_q") for i in range(features)])


def _two_levels(chunks: DataFrame, K: str, features: int) -> DataFrame:
    """``_before`` over the chunks of every key, in groups of GROUP_CHUNKS chunks: prefixes
    inside each group, prefixes over the totals of the groups, and their sum. No
    task holds the chunks of one key."""
    keys = K.split(", ")
    grouped = materialize(chunks.selectExpr("*", f"CAST(floor(_chunk / {GROUP_CHUNKS}) AS BIGINT) AS _group"), "rolling-chunks")
    inner = _before(grouped, f"{K}, _group", "_chunk", features, "_", "_i")
    # a group's total is what is before its last chunk and that chunk
    columns = [c for c in inner.columns if c not in (*keys, "_group", "_chunk")]
    last = inner.groupBy(*keys, "_group").agg(F.max_by(F.struct(*columns), F.col("_chunk")).alias("_l"))
    totals = last.selectExpr(*keys, "_group", "_l.*").selectExpr(
        *keys, "_group", "_icnt + _cnt AS _gcnt", *[e for i in range(features) for e in _joined_moments("_i", "_", i, "_g")])
    outer = _before(totals, K, "_group", features, "_g", "_o").drop(
        "_gcnt", *[c for i in range(features) for c in _moments_of("_g", i)])
    return inner.join(outer, [*keys, "_group"]).selectExpr(
        *keys, "_chunk", "_ocnt + _icnt AS _pcnt", *[e for i in range(features) for e in _joined_moments("_o", "_i", i, "_p")])


def _large(df: DataFrame) -> bool:
    """True when the stored input is large (False where its size is not known)."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return False
    return TWO_LEVELS_FROM <= size < 1 << 60


def _chunked(df, features, lookback, keys, order, chunk_seconds, block_rows, base=None,
             chunk_rows=256, levels=None):
    # Expressions are SQL text through selectExpr: the same plan as Column
    # objects, built with a few JVM calls instead of thousands.
    # both branches below read the input: store it once unless it is stored
    df = materialize(df, "rolling-input")
    base_cols = df.columns
    # the key as values that are never null, and flags, so that rows with a null key
    # value meet their prefix in a plain equi-join that reuses their partitioning
    key = [f"coalesce(CAST({_q(k)} AS STRING), '') AS _k{j}" for j, k in enumerate(keys)] + [
        f"{_q(k)} IS NULL AS _z{j}" for j, k in enumerate(keys)]
    K = ", ".join(f"_{x}{j}" for x in "kz" for j in range(len(keys)))
    df = df.withColumn("_chunk", _chunk_col(df, order, chunk_seconds, chunk_rows)).selectExpr("*", *key)
    KC = f"{K}, _chunk"
    o = _q(order)
    fs = [_q(f) for f in features] if lookback is None else []

    # (1) local running moments inside (key, chunk)
    wl = (f"OVER (PARTITION BY {KC} ORDER BY {o} "
          f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    local = [f"row_number() OVER (PARTITION BY {KC} ORDER BY {o}) AS _rn"]
    for i, f in enumerate(fs):
        local += [f"count({f}) {wl} AS _ln{i}", f"sum({f}) {wl} AS _ls{i}",
                  f"var_samp({f}) {wl} AS _lv{i}", f"min({f}) {wl} AS _lmin{i}",
                  f"max({f}) {wl} AS _lmax{i}"]
    rows = df.selectExpr("*", *local)

    # (2) per-chunk moments: the rows are already clustered by (key, chunk),
    # so this aggregate adds no exchange.
    aggs = ["count(1) AS _cnt"]
    for i, f in enumerate(fs):
        aggs += [f"count({f}) AS _n{i}", f"sum({f}) AS _s{i}",
                 f"coalesce(var_samp({f}), 0D) * greatest(count({f}) - 1, 0) AS _m{i}",
                 f"min({f}) AS _min{i}", f"max({f}) AS _max{i}"]
    chunks = rows.groupBy(*K.split(", "), "_chunk").agg(*[F.expr(a) for a in aggs])
    if base is not None:
        # prior history enters as one more chunk that precedes all others
        pseudo = [*key, f"CAST({_BEFORE_ALL} AS BIGINT) AS _chunk", "CAST(0 AS BIGINT) AS _cnt"]
        for i, f in enumerate(features):
            n = _q(f"{f}_n")
            pseudo += [f"CAST({n} AS BIGINT) AS _n{i}", f"{_q(f + '_sum')} AS _s{i}",
                       f"coalesce({_q(f + '_m2')}, 0D) AS _m{i}",
                       f"{_q(f + '_min')} AS _min{i}", f"{_q(f + '_max')} AS _max{i}"]
        chunks = chunks.unionByName(base.selectExpr(*pseudo))

    # (3) exclusive prefix per key over the chunk table (one row per key/chunk)
    if (levels or (2 if _large(df) else 1)) == 2:
        prefix = _two_levels(chunks, K, len(fs))
    else:
        prefix = _before(chunks, K, "_chunk", len(fs), "_", "_p").drop(
            "_cnt", *[c for i in range(len(fs)) for c in _moments_of("_", i)])

    # (4) merge. The prefix table has one row per key and chunk; AQE turns
    # the join into a broadcast only when its measured size is small.
    joined = rows.join(prefix, on=[*K.split(", "), "_chunk"], how="inner")
    if lookback is None:
        out = [_q(c) for c in base_cols]
        for i, f in enumerate(features):
            out += _merge(i, f)
        return joined.selectExpr(*out)
    return _bounded(joined, base_cols, features, lookback, keys, order, block_rows)


def _merge(i, f):
    """Mean and sample stddev of prefix (p) + local (l) moments, as SQL text."""
    nl, sl, np_, sp = f"_ln{i}", f"_ls{i}", f"_pn{i}", f"_ps{i}"
    n = f"({np_} + {nl})"
    mean = (f"CASE WHEN {n} > 0 THEN try_divide(coalesce({sp}, 0D) + coalesce({sl}, 0D), {n}) "
            f"END AS {_q(f + '_mean')}")
    m2_l = f"(coalesce(_lv{i}, 0D) * ({nl} - 1))"
    m2_p = f"_pm{i}"
    delta = f"(try_divide({sl}, {nl}) - try_divide({sp}, {np_}))"
    m2 = (f"(CASE WHEN {np_} = 0 THEN {m2_l} WHEN {nl} = 0 THEN {m2_p} "
          f"ELSE {m2_p} + {m2_l} + try_divide({delta} * {delta} * {np_} * {nl}, {n}) END)")
    # all values seen equal -> exactly 0, as a sequential update gives
    std = (f"CASE WHEN {n} >= 2 THEN CASE WHEN least(_pmin{i}, _lmin{i}) = "
           f"greatest(_pmax{i}, _lmax{i}) THEN 0D "
           f"ELSE sqrt(try_divide(greatest({m2}, 0D), {n} - 1)) END END AS {_q(f + '_std')}")
    return [mean, std]


def _bounded(joined, base_cols, features, lookback, keys, order, block_rows):
    """Blocks of ``block_rows`` global indexes per key, each with a halo of the
    previous block's last ``lookback`` rows; halo copies are dropped after."""
    rows = joined.selectExpr(*[_q(c) for c in base_cols], "_pcnt + _rn - 1 AS _idx")
    rows = rows.selectExpr(
        "*", f"CAST(floor(_idx / {block_rows}) AS BIGINT) AS _own").selectExpr(
        "*", f"explode(CASE WHEN _idx % {block_rows} >= {block_rows - lookback} "
             f"THEN array(_own, _own + 1) ELSE array(_own) END) AS _blk")
    w = (f"OVER (PARTITION BY {', '.join(_q(k) for k in keys)}, _blk ORDER BY _idx "
         f"ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING)")
    stats = []
    for f in features:
        stats += [f"avg({_q(f)}) {w} AS {_q(f + '_mean')}",
                  f"stddev({_q(f)}) {w} AS {_q(f + '_std')}"]
    out = [f"{f}_{s}" for f in features for s in ("mean", "std")]
    return (rows.selectExpr("*", *stats).filter("_blk = _own")
            .select(*base_cols, *out))
