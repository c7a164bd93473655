"""SQL predicates taken apart by Spark's own parser and optimizer."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from lidarframe.functions.fields import point_schema
from lidarframe.sources.layouts import COORDINATES, PATH_COLUMN

_COMPARISONS = {"LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "EqualTo": "=", "EqualNullSafe": "="}
_FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<=", "=": "="}


def conjuncts(spark: SparkSession, where: str) -> Iterator[str]:
    """The conditions that a predicate joins by AND, as Spark's own parser sees them."""
    left = [spark._jsparkSession.sessionState().sqlParser().parseExpression(where)]
    while left:
        part = left.pop()
        if part.getClass().getSimpleName() == "And":
            left += [part.right(), part.left()]
        else:
            yield part.sql()


def column_names(spark: SparkSession, texts: Iterable[str]) -> set[str]:
    """Names that Spark's parser takes for columns, without their quotes."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    found, left = set(), [parser.parseExpression(t) for t in texts]
    while left:
        part = left.pop()
        if part.getClass().getSimpleName() == "UnresolvedAttribute":
            names = part.nameParts()
            found.add(names.apply(names.size() - 1))
        children = part.children()
        left += [children.apply(k) for k in range(children.size())]
    return found


def split_by_columns(spark: SparkSession, where: str, fields: Sequence[T.StructField]) -> tuple[list[str], list[str]]:
    """The conditions of ``where`` that use nothing but ``fields`` and are not random, and the others."""
    none = spark.createDataFrame([], T.StructType(list(fields)))
    own, others = [], []
    for text in conjuncts(spark, where):
        try:
            known = none.where(text)._jdf.queryExecution().analyzed().deterministic()
        except AnalysisException:
            known = False
        (own if known else others).append(text)
    return own, others


def box_tree(spark: SparkSession, where: str, fields: Sequence[T.StructField] = (), **kinds) -> list:
    """A predicate as a tree of comparisons of x, y, z with numbers (see ``sources.boxes``).

    Spark's optimizer has folded constants, moved NOT inwards and brought literals to the column's type before.
    """
    # doubles decide in any case: boxes are widened by far more than what they round
    schema = T.StructType([*point_schema(**{**kinds, "exact": None}), T.StructField(PATH_COLUMN, T.StringType(), False), *fields])
    # not known to be empty, or the optimizer would drop the predicate
    points = spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)
    plan = points.where(where)._jdf.queryExecution().optimizedPlan()
    kind = plan.getClass().getSimpleName()
    if kind == "LogicalRDD":
        return ["and"]  # always true
    if kind == "LocalRelation":
        return ["or"]  # never true
    return _tree(plan.condition()) if kind == "Filter" else ["unknown"]


def _tree(e) -> list:
    kind = e.getClass().getSimpleName()
    if kind in ("And", "Or"):
        return [kind.lower(), _tree(e.left()), _tree(e.right())]
    if kind == "Not":
        return ["not", _tree(e.child())]
    if kind in _COMPARISONS:
        for one, other, flip in ((e.left(), e.right(), False), (e.right(), e.left(), True)):
            axis, value = _axis(one), _number(other)
            if axis and value is not None:
                test = _COMPARISONS[kind]
                return [_FLIPPED[test] if flip else test, axis, value]
    if kind == "In":
        items = e.list()
        values = [_number(items.apply(k)) for k in range(items.size())]
        if _axis(e.value()) and None not in values:
            return ["in", _axis(e.value()), values]
    if kind == "InSet" and _axis(e.child()):
        items = e.hset().toSeq()
        values = [items.apply(k) for k in range(items.size())]
        if all(isinstance(v, float) and v == v for v in values):
            return ["in", _axis(e.child()), values]
    return ["unknown"]


def _axis(e) -> str | None:
    plain = e.getClass().getSimpleName() == "AttributeReference"
    return e.name() if plain and e.name() in COORDINATES else None


def _number(e) -> float | None:
    """A literal as a number; NaN compares in a way of its own and is none."""
    if e.getClass().getSimpleName() != "Literal" or not isinstance(e.value(), float):
        return None
    return e.value() if e.value() == e.value() else None
