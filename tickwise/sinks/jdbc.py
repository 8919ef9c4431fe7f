"""Relational store: even parallel reads, and writes of the clean and anomaly tables
over JDBC that a replay does not double.

A batch is written in two steps. Spark's tasks fill a staging table named after the
target, run and batch, which a replay drops and fills again. Then one transaction on
the store copies the staged rows into the targets and enters the batch in the ledger
``TICKWISE_COMMITS``, whose primary key admits it once. A crash before the commit
leaves the targets as they were, one after it leaves a batch that the ledger knows and
the replay skips. The copy runs inside the store; no rows pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise import schemas as S

LEDGER = "TICKWISE_COMMITS"


# ---------------------------------------------------------------------------
# driver-side statements
# ---------------------------------------------------------------------------

@contextmanager
def _connection(spark: SparkSession, url: str, properties: dict | None):
    jvm = spark.sparkContext._jvm
    given = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        given.setProperty(str(k), str(v))
    if driver := (properties or {}).get("driver"):
        jvm.java.lang.Class.forName(driver)
    con = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        yield con
    finally:
        con.close()


def _execute(con, sql: str, *values) -> int:
    st = con.prepareStatement(sql)
    try:
        for i, v in enumerate(values, 1):
            st.setObject(i, v)
        return st.executeUpdate()
    finally:
        st.close()


def _rows(con, sql: str, width: int) -> list[tuple]:
    st = con.prepareStatement(sql)
    try:
        found, out = st.executeQuery(), []
        while found.next():
            out.append(tuple(found.getObject(i + 1) for i in range(width)))
        return out
    finally:
        st.close()


def _exists(con, table: str) -> bool:
    try:
        _rows(con, f"SELECT 1 FROM {table} WHERE 1 = 0", 1)
        return True
    except Exception as e:
        if "SQL" not in type(getattr(e, "java_exception", e)).__name__ and "SQL" not in str(e):
            raise
        return False


def _dialect(spark: SparkSession, url: str):
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)


# ---------------------------------------------------------------------------
# reads
# ---------------------------------------------------------------------------

def _either(parts: Sequence[str], word: str) -> str:
    return "(" + f" {word} ".join(parts) + ")"


def split_predicates(spark: SparkSession, url: str, table: str, columns: Sequence[str],
                     num_partitions: int, properties: dict | None = None) -> list[str]:
    """Predicates that cut a table into parts of equal row counts by the order of ``columns``.

    The cuts are order statistics that the store looks up, each from the one before
    it (with an index on the columns, one walk over the index in all), so a skewed
    column gives even parts; rows that agree in the first column are cut by the
    next ones. Only rows that agree in all of them stay together. Rows with a null
    in one of the columns are a part of their own.
    """
    dialect = _dialect(spark, url)
    names = [dialect.quoteIdentifier(c) for c in columns]
    order = ", ".join(names)
    known = _either([f"{n} IS NOT NULL" for n in names], "AND")

    def from_on(cut: tuple) -> str:
        """Rows whose columns are at or after the cut, in lexicographic order."""
        values = [str(dialect.compileValue(v)) for v in cut]
        steps = []
        for i in range(len(names)):
            same = [f"{n} = {v}" for n, v in zip(names[:i], values[:i])]
            last = ">=" if i == len(names) - 1 else ">"
            steps.append(_either([*same, f"{names[i]} {last} {values[i]}"], "AND"))
        return _either(steps, "OR")

    with _connection(spark, url, properties) as con:
        total, rows = _rows(con, f"SELECT COUNT(*), SUM(CASE WHEN {known} THEN 1 ELSE 0 END) FROM {table}", 2)[0]
        rows = int(rows or 0)
        step = max(1, -(-rows // max(1, num_partitions)))
        cuts: list[tuple] = []
        while True:
            here = f"{known} AND {from_on(cuts[-1])}" if cuts else known
            found = _rows(con, f"SELECT {order} FROM {table} WHERE {here} ORDER BY {order} "
                               f"OFFSET {step} ROWS FETCH NEXT 1 ROWS ONLY", len(names))
            if found and cuts and found[0] == cuts[-1]:   # more than a step of equal rows: go on behind them
                found = _rows(con, f"SELECT {order} FROM {table} WHERE {known} AND {from_on(cuts[-1])} AND NOT "
                              + _either([f"{n} = {dialect.compileValue(v)}" for n, v in zip(names, cuts[-1])], "AND")
                              + f" ORDER BY {order} OFFSET 0 ROWS FETCH NEXT 1 ROWS ONLY", len(names))
            if not found:
                break
            cuts.append(found[0])
    starts = [None, *cuts]
    out = []
    for low, high in zip(starts, [*cuts, None]):
        parts = [known] + ([from_on(low)] if low is not None else []) + ([f"NOT {from_on(high)}"] if high is not None else [])
        out.append(" AND ".join(parts))
    if int(total) > rows:
        out.append(f"NOT {known}")
    return out


def read_table_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                    partition_column: str | Sequence[str] | None = None, lower_bound=None, upper_bound=None,
                    num_partitions: int | None = None) -> DataFrame:
    """Parallel JDBC read. With a partition column and bounds Spark issues
    ``num_partitions`` range queries of equal width; without bounds the parts are cut
    at quantiles of the column, or columns (see ``split_predicates``)."""
    if partition_column and lower_bound is None and upper_bound is None:
        columns = [partition_column] if isinstance(partition_column, str) else list(partition_column)
        cuts = split_predicates(spark, url, table, columns, num_partitions or 8, properties)
        return spark.read.jdbc(url, table, predicates=cuts, properties={str(k): str(v) for k, v in (properties or {}).items()})
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions or 8)))
    return r.load()


# ---------------------------------------------------------------------------
# writes
# ---------------------------------------------------------------------------

def _write(df: DataFrame, url: str, table: str, properties: dict | None,
           batch_size: int, num_partitions: int | None, mode: str = "append") -> None:
    w = df.coalesce(num_partitions) if num_partitions else df
    wr = (w.write.format("jdbc").option("url", url).option("dbtable", table)
          .option("batchsize", str(batch_size)).mode(mode))
    for k, v in (properties or {}).items():
        wr = wr.option(k, v)
    wr.save()


def _staging(table: str, origin: str, run_id: int, batch_id: int) -> str:
    where = hashlib.sha256(origin.encode()).hexdigest()[:8]
    return f"{table}_STAGE_{where}_{run_id}_{batch_id}"


def committed(spark: SparkSession, url: str, properties: dict | None, origin: str, run_id: int, batch_id: int) -> set[str]:
    """Tables into which the ledger says that the batch has been merged."""
    with _connection(spark, url, properties) as con:
        if not _exists(con, LEDGER):
            return set()
        name = "'" + origin.replace("'", "''") + "'"
        return {r[0] for r in _rows(con, f"SELECT table_name FROM {LEDGER} WHERE origin = {name} "
                                         f"AND run_id = {int(run_id)} AND batch_id = {int(batch_id)}", 1)}


def merge_batch(frames: dict[str, DataFrame], url: str, properties: dict | None = None, run_id: int = 0,
                batch_id: int = 0, origin: str = "", batch_size: int = 1000, num_partitions: int | None = None,
                before_merge: Callable[[], Any] | None = None) -> list[str]:
    """Write one batch into several tables, all of them or none, once.

    ``origin`` names the pipeline, so that the runs of two pipelines on one store
    are told apart (at most 300 characters). Returns the tables written now; those
    that the ledger has already are left alone. ``before_merge`` is called between
    staging and merge (for tests of crashes).
    """
    spark = next(iter(frames.values())).sparkSession
    done = committed(spark, url, properties, origin, run_id, batch_id)
    todo = {t: df for t, df in frames.items() if t not in done}
    stages = {t: _staging(t, origin, run_id, batch_id) for t in frames}
    for table, df in todo.items():
        _write(df.limit(0), url, table, properties, batch_size, None)          # creates a table that is missing
        _write(df, url, stages[table], properties, batch_size, num_partitions, mode="overwrite")
    if before_merge is not None:
        before_merge()
    dialect = _dialect(spark, url)
    with _connection(spark, url, properties) as con:
        if todo and not _exists(con, LEDGER):
            _execute(con, f"CREATE TABLE {LEDGER} (origin VARCHAR(300) NOT NULL, table_name VARCHAR(128) NOT NULL, "
                          "run_id BIGINT NOT NULL, batch_id BIGINT NOT NULL, "
                          "PRIMARY KEY (origin, table_name, run_id, batch_id))")
        con.setAutoCommit(False)
        try:
            for table, df in todo.items():
                names = ", ".join(dialect.quoteIdentifier(c) for c in df.columns)
                _execute(con, f"INSERT INTO {LEDGER} (origin, table_name, run_id, batch_id) VALUES (?, ?, ?, ?)",
                         origin, table, int(run_id), int(batch_id))
                _execute(con, f"INSERT INTO {table} ({names}) SELECT {names} FROM {stages[table]}")
            con.commit()
        except Exception:
            con.rollback()
            raise
        con.setAutoCommit(True)
        for stage in stages.values():
            if _exists(con, stage):
                _execute(con, f"DROP TABLE {stage}")
    return list(todo)


def clean_rows(windows: DataFrame) -> DataFrame:
    """Window rows in the table shape (``total_volume`` -> ``volume``)."""
    out = windows.withColumnRenamed("total_volume", "volume").select(*S.CLEAN_COLUMNS)
    return out.withColumn("record_count", F.col("record_count").cast("int"))


def write_clean_jdbc(windows: DataFrame, url: str, table: str = S.TOPIC_CLEAN,
                     properties: dict | None = None, batch_size: int = 1000,
                     num_partitions: int | None = None, batch: tuple[int, int] | None = None, origin: str = "") -> None:
    """Append window rows in the table shape (``total_volume`` -> ``volume``).

    ``num_partitions`` bounds the number of concurrent connections. With ``batch``
    (run and batch id) the rows are merged once, however often the call is repeated.
    """
    out = clean_rows(windows)
    if batch is not None:
        merge_batch({table: out}, url, properties, *batch, origin, batch_size, num_partitions)
    else:
        _write(out, url, table, properties, batch_size, num_partitions)


def write_anomalies_jdbc(anomalies: DataFrame, url: str, table: str = S.TOPIC_ANOMALIES,
                         properties: dict | None = None, batch_size: int = 1000,
                         num_partitions: int | None = None, batch: tuple[int, int] | None = None,
                         origin: str = "") -> None:
    """Append anomaly rows (no count first: an empty frame writes nothing); ``batch``
    as in ``write_clean_jdbc``."""
    out = anomalies.select(*S.ANOMALY_COLUMNS)
    if batch is not None:
        merge_batch({table: out}, url, properties, *batch, origin, batch_size, num_partitions)
    else:
        _write(out, url, table, properties, batch_size, num_partitions)
