"""Rules for ad-hoc SQL, checked on the plan and not on the text: aliases, CTEs and nested queries are seen through.

Refused are queries that select ``*`` instead of named columns, that join without a condition (a comma between tables), or that read a table
of events without bounding ``day`` to a few days and naming the event types in the same ``WHERE``.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from stagewise.functions.dates import date_to_day, day_to_date
from stagewise.sources.scans import EVENT_TYPES, MAX_EVENT_DAYS


class RefusedSql(ValueError):
    """The query breaks a rule; the message says which."""


def guarded_sql(
    spark: SparkSession,
    text: str,
    events: Iterable[str] = ("events",),
    *,
    day: str = "day",
    event_type: str = "event_type",
    known_types: Iterable[str] = EVENT_TYPES,
    max_days: int = MAX_EVENT_DAYS,
    limit: int | None = None,
) -> DataFrame:
    """The result of a query that keeps the rules. ``events`` names the tables and views of events. Nothing is run to check it."""
    text = text.strip().rstrip(";")
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    for node in _nodes(parsed):
        kind = _kind(node)
        if kind in ("Project", "Aggregate"):
            listed = node.projectList() if kind == "Project" else node.aggregateExpressions()
            if any(_kind(e) in ("UnresolvedStar", "UnresolvedStarExceptOrReplace") for e in _list(listed)):
                raise RefusedSql("columns must be named, not *")
        if kind == "Join" and node.condition().isEmpty() and _kind(node.joinType()) not in ("NaturalJoin", "UsingJoin"):
            raise RefusedSql("tables must be joined on a condition")
    found = spark.sql(text)
    analyzed = found._jdf.queryExecution().analyzed()
    guarded = {name.lower() for name in events}
    for alias, above in _scans(analyzed, guarded):
        _check_scan(alias, above, day, event_type, set(known_types), max_days)
    return found if limit is None else found.limit(limit)


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _list(seq) -> list:
    return [seq.apply(k) for k in range(seq.size())]


def _below(node) -> list:
    """Children, definitions of CTEs and plans of subquery expressions."""
    inner = [n for n in _list(node.innerChildren()) if hasattr(n, "subqueries")]
    own = [*_list(node.children()), *_list(node.subqueries())]
    return own + [n for n in inner if "plans.logical" in n.getClass().getName()]


def _nodes(plan):
    stack = [plan]
    while stack:
        node = stack.pop()
        yield node
        stack += _below(node)


def _scans(plan, guarded: set[str]):
    """Every scan of a guarded table, with the conditions of the same query level above it."""
    stack = [(plan, [])]
    while stack:
        node, above = stack.pop()
        kind = _kind(node)
        if kind == "SubqueryAlias" and node.identifier().name().lower() in guarded and _is_table(node):
            yield node, above
            continue
        if kind == "Filter":
            above = [*above, *_conjuncts(node.condition())]
        elif kind == "Join":
            # A condition of the join bounds the side that it may drop rows of.
            own = [] if node.condition().isEmpty() else _conjuncts(node.condition().get())
            which = _kind(node.joinType())
            left = [*above, *(own if which in ("Inner", "LeftSemi", "RightOuter") else [])]
            right = [*above, *(own if which in ("Inner", "LeftSemi", "LeftAnti", "LeftOuter") else [])]
            stack += [(node.left(), left), (node.right(), right)]
            stack += [(n, []) for n in _list(node.subqueries())]
            continue
        elif kind != "SubqueryAlias":
            above = []  # another query level
        children = _list(node.children())
        stack += [(child, above) for child in children]
        stack += [(n, []) for n in _below(node)[len(children) :]]


def _is_table(alias) -> bool:
    """A name of a table or view, and not of a CTE or a subquery that happens to have it."""
    below = alias.child()
    while _kind(below) == "SubqueryAlias":
        below = below.child()
    return _kind(below) in ("View", "LogicalRelation", "LogicalRDD", "HiveTableRelation", "LocalRelation", "DataSourceV2Relation")


def _conjuncts(condition) -> list:
    if _kind(condition) == "And":
        return _conjuncts(condition.left()) + _conjuncts(condition.right())
    return [condition]


def _column(expression) -> int | None:
    while _kind(expression) == "Cast":
        expression = expression.child()
    return expression.exprId().id() if _kind(expression) == "AttributeReference" else None


def _value(expression):
    """The value of an expression of literals."""
    if not expression.foldable():
        return None
    value = expression.eval(None)
    return value if isinstance(value, (int, str)) else str(value)


def _compared(condition, column: int) -> tuple[str, list] | None:
    """(operator, values) of a comparison of the column with literals."""
    kind = _kind(condition)
    if kind == "Between":
        tested, *ends = _list(condition.parameters())
        values = [_value(v) for v in ends]
        return ("Between", values) if _column(tested) == column and None not in values else None
    if kind == "In" and _column(condition.value()) == column:
        values = [_value(v) for v in _list(condition.list())]
        return None if None in values else ("In", values)
    if kind in ("EqualTo", "GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual"):
        swapped = {"GreaterThan": "LessThan", "LessThan": "GreaterThan", "GreaterThanOrEqual": "LessThanOrEqual", "LessThanOrEqual": "GreaterThanOrEqual"}
        for side, other, name in (
            (condition.left(), condition.right(), kind), (condition.right(), condition.left(), swapped.get(kind, kind)),
        ):
            if _column(side) == column and _value(other) is not None:
                return name, [_value(other)]
    return None


def _check_scan(alias, above: list, day: str, event_type: str, known: set[str], max_days: int) -> None:
    table = alias.identifier().name()
    columns = {a.name().lower(): a.exprId().id() for a in _list(alias.output())}
    for needed in (day, event_type):
        if needed.lower() not in columns:
            raise RefusedSql(f"{table} has no column {needed}")
    low = high = types = None
    for condition in above:
        named = _compared(condition, columns[event_type.lower()])
        if named and named[0] in ("In", "EqualTo"):
            types = set(named[1]) if types is None else types & set(named[1])
        bound = _compared(condition, columns[day.lower()])
        if not bound:
            continue
        name, values = bound[0], [int(v) for v in bound[1]]
        if name == "Between":
            least, most = values
        elif name in ("In", "EqualTo"):
            least, most = min(values), max(values)
        else:
            step = {"GreaterThan": 1, "LessThan": -1}.get(name, 0)
            own = values[0] if not step else _next_day(values[0], step)
            least, most = (own, None) if name.startswith("Greater") else (None, own)
        low = least if low is None else low if least is None else max(low, least)
        high = most if high is None else high if most is None else min(high, most)
    if low is None or high is None:
        raise RefusedSql(f"{day} of {table} must be bounded on both sides")
    span = (_date(high) - _date(low)).days + 1
    if span > max_days:
        raise RefusedSql(f"{low}..{high} of {table} is {span} days, allowed are {max_days}")
    if types is None or types - known:
        raise RefusedSql(f"{event_type} of {table} must be among {tuple(sorted(known))}")


def _date(day: int):
    try:
        return day_to_date(day)
    except ValueError as error:
        raise RefusedSql(f"{day} is no day (yyyymmdd)") from error


def _next_day(day: int, step: int) -> int:
    return date_to_day(_date(day) + timedelta(days=step))
