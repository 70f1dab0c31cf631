"""What a statement may do: read registered views, with functions that only compute.

Both plans of the statement are walked node by node, subqueries and WITH parts included;
nothing is judged by text, so quotes, comments and long lists hide nothing. The parsed plan
names the functions, the analysed one the relations and what every expression became. The
statement is not run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import SparkSession

# Groups of built-in functions that only compute.
GROUPS = {
    "agg_funcs", "array_funcs", "bitwise_funcs", "collection_funcs", "conditional_funcs", "conversion_funcs", "csv_funcs",
    "datetime_funcs", "generator_funcs", "hash_funcs", "json_funcs", "lambda_funcs", "map_funcs", "math_funcs", "predicate_funcs",
    "string_funcs", "struct_funcs", "url_funcs", "window_funcs",
}

# Relations without files, and expressions that run code or tell of files.
PLAIN_RELATIONS = {"OneRowRelation", "LocalRelation", "CTERelationRef"}
FOREIGN = {
    "CallMethodViaReflection", "TryReflect", "PythonUDF", "PythonUDAF", "ScalaUDF", "ScalaAggregator", "InputFileName",
    "InputFileBlockStart", "InputFileBlockLength", "SQLFunctionExpression", "SQLScalarFunction",
}


def _items(seq: Any) -> Iterator[Any]:
    for i in range(seq.size()):
        yield seq.apply(i)


def _kind(node: Any) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _expressions(node: Any) -> Iterator[Any]:
    todo = list(_items(node.expressions()))
    while todo:
        one = todo.pop()
        yield one
        todo += _items(one.children())


def _below(node: Any) -> Iterator[Any]:
    """Children, subqueries in expressions, and the parts of a WITH."""
    yield from _items(node.children())
    yield from _items(node.subqueries())
    if _kind(node) == "UnresolvedWith":
        yield from (pair._2() for pair in _items(node.cteRelations()))


def _called(spark: SparkSession, parsed: Any) -> str | None:
    """A function in the parsed plan that does more than compute, or names that are made up at run time."""
    catalog, jvm = spark._jsparkSession.sessionState().catalog(), spark._jvm
    todo = [parsed]
    while todo:
        node = todo.pop()
        if "TableValuedFunction" in _kind(node) or "TableFunction" in _kind(node):
            return "table functions"
        for one in [node, *_expressions(node)]:
            if "UnresolvedIdentifier" in _kind(one):
                return "names made of expressions"
            if _kind(one) == "UnresolvedFunction":
                parts = list(_items(one.nameParts()))
                name = jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(parts[-1])
                if len(parts) > 1 or not catalog.functionExists(name) or catalog.lookupFunctionInfo(name).getGroup() not in GROUPS:
                    return f"function {'.'.join(parts)}"
        todo += _below(node)
    return None


def _reached(analysed: Any, views: set[str]) -> str | None:
    """A relation of the analysed plan that is no registered view, or an expression that runs foreign code."""
    todo = [analysed]
    while todo:
        node = todo.pop()
        kind = _kind(node)
        if kind == "View":
            name = node.desc().identifier().table()
            if name.lower() not in views:
                return f"not a registered view: {name}"
            continue  # what a registered view reads is its own affair
        foreign = next((k for one in _expressions(node) if (k := _kind(one)) in FOREIGN), None)
        if foreign:
            return f"expression {foreign}"
        below = list(_below(node))
        if not below and kind not in PLAIN_RELATIONS:
            return f"not a registered view: {kind}"
        todo += below
    return None


def refusal(spark: SparkSession, statement: str) -> str | None:
    """Why a statement is not to be run; None for one that only reads registered views."""
    state = spark._jsparkSession.sessionState()
    parsed = state.sqlParser().parsePlan(statement)
    reason = _called(spark, parsed)
    if reason:
        return reason
    skip = spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()
    views = {r.viewName.lower() for r in spark.sql("SHOW VIEWS").select("viewName").collect()}  # one per table
    return _reached(state.executePlan(parsed, skip).analyzed(), views)
