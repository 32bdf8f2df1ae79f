"""Read-only SQL over the Gold tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from ..schemas import GOLD
from ..sources.tables import read_optional

ROW_CAP = 100
_QUOTED = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`", re.DOTALL)
_COMMENT = re.compile(r"--|/\*")
# Classes of Spark's plans: what may stand without children, what makes rows of
# its own, calls by reflection, and expressions that hold a query.
_LEAVES = {"OneRowRelation", "CTERelationRef"}
_NO_TABLE = {"Range", "Generate", "UnresolvedTableValuedFunction"}
_JAVA_CALLS = {"CallMethodViaReflection", "TryReflect"}
_SUBQUERIES = {"ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"}


class Refused(ValueError):
    """The statement is not a single SELECT over the Gold tables."""


def gold_tables(spark: SparkSession, gold_dir: str) -> dict[str, DataFrame]:
    """The Gold tables that exist under a folder; missing ones are left out."""
    found = {name: read_optional(spark, f"{gold_dir}/{name}") for name in GOLD}
    return {name: df for name, df in found.items() if df is not None}


def gold_session(spark: SparkSession,
                 tables: Callable[[SparkSession], Mapping[str, DataFrame]]) -> SparkSession:
    """A sibling session whose only views are those ``tables(session)`` returns.
    It shares the cluster and caches; files cannot be queried by path in it."""
    session = spark.newSession()
    for setting in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled"):
        session.conf.set(setting, spark.conf.get(setting))
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    for name, df in tables(session).items():
        df.createOrReplaceTempView(name)
    return session


def _each(sequence):
    """Members of a Scala sequence."""
    return (sequence.apply(i) for i in range(sequence.size()))


def _class(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _objection(plan, views: set[str]) -> str | None:
    """Why an analysed plan is not a query over ``views`` alone, or None. What
    lies below a view is ours and is not looked into."""
    kind = _class(plan)
    if kind == "View":
        name = plan.desc().identifier().table()
        return None if plan.isTempView() and name.lower() in views else f"only Gold tables are accessible, not {name}"
    if kind in _NO_TABLE or (plan.children().isEmpty() and kind not in _LEAVES):
        return f"only Gold tables are accessible, not {plan.simpleString(3)}"
    waiting = list(_each(plan.expressions()))
    while waiting:
        expression = waiting.pop()
        if _class(expression) in _JAVA_CALLS:
            return "calls into Java are not allowed"
        if _class(expression) in _SUBQUERIES and (reason := _objection(expression.plan(), views)):
            return reason
        waiting += _each(expression.children())
    return next((reason for child in _each(plan.children()) if (reason := _objection(child, views))), None)


def check_read_only(session: SparkSession, sql: str) -> tuple[bool, str]:
    """(accepted, cleaned statement or reason). Put in parentheses, anything but
    one SELECT fails to parse; then Spark's analysed plan tells which tables and
    functions the statement uses, whatever words its literals hold."""
    text = sql.strip()
    text = text[:-1].rstrip() if text.endswith(";") else text
    if not re.match(r"select\b", text, re.IGNORECASE):
        return False, "a query must start with SELECT"
    if _COMMENT.search(_QUOTED.sub("''", text)):
        return False, "comments are not allowed"
    try:
        plan = session.sql(f"SELECT * FROM (\n{text}\n)")._jdf.queryExecution().analyzed()
    except ParseException:
        return False, "not a single SELECT statement"
    except AnalysisException as error:
        return False, error.getMessage().splitlines()[0]
    views = {t.name.lower() for t in session.catalog.listTables() if t.isTemporary}
    reason = _objection(plan, views)
    return (False, reason) if reason else (True, text)


def _query(session: SparkSession, sql: str) -> DataFrame:
    accepted, text = check_read_only(session, sql)
    if not accepted:
        raise Refused(text)
    try:
        return session.sql(text)
    except ParseException:
        raise Refused("not a single SELECT statement") from None


def _has_limit(query: DataFrame) -> bool:
    return _class(query._jdf.queryExecution().analyzed()) == "GlobalLimit"


def gold_sql(session: SparkSession, sql: str, cap: int | None = ROW_CAP) -> DataFrame:
    """The result of one SELECT. A statement with a LIMIT of its own gives just
    that; without one at most ``cap`` rows come (None: all)."""
    query = _query(session, sql)
    return query if cap is None or _has_limit(query) else query.limit(cap)


def answer(session: SparkSession, sql: str, cap: int = ROW_CAP, most: int = 10_000) -> dict:
    """Columns, rows, row count and whether rows were left out: beyond ``cap``
    when the statement has no LIMIT, beyond ``most`` when it has, as the rows
    come to the driver."""
    query = _query(session, sql)
    bound = most if _has_limit(query) else cap
    rows = [row.asDict() for row in query.limit(bound + 1).collect()]
    return {"columns": query.columns, "rows": rows[:bound], "count": min(len(rows), bound),
            "truncated": len(rows) > bound}


def gold_catalog(spark: SparkSession) -> DataFrame:
    """Published tables and columns, one row per column."""
    rows = [
        (table, description, position, column)
        for table, (description, columns) in GOLD.items()
        for position, column in enumerate(columns, start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, description string, position int, column_name string"
    )


def session_catalog(session: SparkSession) -> DataFrame:
    """The views of a Gold session as its catalogue has them, one row per column:
    all columns that can be asked for, with their types; ``published`` says
    whether users are told of the column."""
    rows = []
    for view in (t.name for t in session.catalog.listTables() if t.isTemporary):
        description, told = GOLD.get(view, ("", []))
        for position, column in enumerate(session.catalog.listColumns(view), start=1):
            rows.append((view, description, position, column.name, column.dataType, column.name in told))
    return session.createDataFrame(
        rows, "table_name string, description string, position int, column_name string, data_type string, published boolean"
    )


# --- example questions ----------------------------------------------------------------


def viewed_never_bought(views: int = 1000, purchases: int = 0) -> str:
    return (
        "SELECT item_id, view_count, purchase_count FROM product_features "
        f"WHERE view_count > {int(views)} AND purchase_count <= {int(purchases)} ORDER BY item_id"
    )


def top_engaged_users(n: int = 10) -> str:
    return (
        "SELECT user_id, engagement_score FROM user_profiles "
        f"ORDER BY engagement_score DESC, user_id LIMIT {int(n)}"
    )


def conversion_by_device() -> str:
    return (
        "SELECT primary_device, AVG(conversion_rate) AS avg_conversion_rate, COUNT(*) AS users "
        "FROM user_profiles GROUP BY primary_device"
    )


def low_stock_high_demand(stock: int = 10, demand: float = 2.0) -> str:
    return (
        "SELECT item_id, current_stock, demand_score FROM product_features "
        f"WHERE current_stock < {int(stock)} AND demand_score > {float(demand)} ORDER BY item_id"
    )
