"""Global min / max / count answered from file headers wherever that is exact."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarframe.operators.header_index import indexed_headers
from lidarframe.operators.predicates import box_tree, column_names, split_by_columns
from lidarframe.operators.tables import (
    LITERAL,
    Paths,
    kinds,
    passing_folders,
    path_options,
    read_headers,
    read_las,
    sql_words,
)
from lidarframe.sources.boxes import ASTRIDE, INSIDE, decidable
from lidarframe.sources.files import one_listing, partition_fields
from lidarframe.sources.headers import HEADER_SCHEMA
from lidarframe.sources.layouts import ATTRIBUTES, COORDINATES, PATH_COLUMN, POINT_FORMATS

_EXTREME = r"\b(?P<fn>min|max)\s*\(\s*`?(?P<axis>[xyz])`?\s*\)"
_COUNT = r"\bcount\s*\(\s*(?:(?P<all>\*|1)|`?(?P<column>\w+)`?)\s*\)"
_NAME = re.compile(r"\w+")
_ANSWERABLE = re.compile(f"(?P<literal>{LITERAL})|{_EXTREME}|{_COUNT}", re.IGNORECASE)


@one_listing()
def las_agg(
    spark: SparkSession,
    path: Paths,
    aggs: Mapping[str, str],
    where: str | None = None,
    group_by: Sequence[str] = (),
    verify: bool = False,
    filters: Sequence[tuple[str, str, object]] = (),
    index: str | None = None,
    **options,
) -> DataFrame:
    """Aggregate LAS files; ``aggs`` maps result names to SQL text, e.g. ``{"dx": "max(x)-min(x)"}``.

    If groups are k=v folder columns or ``_path`` and all results are made of min/max of x, y, z, count(*)
    and count(column), file headers give the answer. A ``where`` on folder columns picks files; one on x, y, z
    splits them by their bounds: files wholly inside are answered from their headers, those
    outside are left out, and only points of files astride are read and tested. Anything else, ``filters`` (see
    ``read_las``) or ``verify=True`` scans the points with just the columns the texts
    mention. With ``index`` headers come from that index, which is refreshed first (see ``refresh_header_index``); files inside
    or outside are then not opened at all. All ways give the same result as long as headers tell the truth (see ``las_audit``).
    """
    if not aggs:
        raise ValueError("no aggregates given")
    group_by = [group_by] if isinstance(group_by, str) else list(group_by)
    if filters or verify:
        return _from_points(spark, path, aggs, where, group_by, {"filters": filters, **options})
    plan = header_plan(spark, aggs)
    if index:
        options = {**options, "index": index}
    if plan is None or not all(_NAME.fullmatch(g) for g in group_by):
        return _from_points(spark, path, aggs, where, group_by, options)
    folders = partition_fields(path_options(path, options)) if where or set(group_by) - {PATH_COLUMN} else []
    if not _named_by_folders(folders, group_by):
        return _from_points(spark, path, aggs, where, group_by, options)
    if not where:
        return _from_totals(_header_totals(spark, path, plan, group_by, options), plan, group_by)
    own, others = split_by_columns(spark, where, folders)
    if own and _clashes(folders):
        own, others = [], [where]
    if own and "index" not in options:  # folders that are ruled out are not opened
        found = passing_folders(spark, path, " AND ".join(f"({t})" for t in own), folders, options)
        options = {**options, "folders": json.dumps(found)}
    if not others:
        return _from_totals(_header_totals(spark, path, plan, group_by, options, own), plan, group_by)
    tree = box_tree(spark, " AND ".join(f"({t})" for t in others), folders, **kinds(options))
    inside, outside = decidable(tree)
    box = {**options, "box": json.dumps(tree)}
    if not inside:  # the predicate needs points of every file, but of those outside
        return _from_points(spark, path, aggs, where, group_by, box if outside else options)
    whole = _header_totals(spark, path, plan, group_by, {**box, "boxFiles": INSIDE}, own)
    astride = _point_totals(spark, path, plan, where, group_by, {**box, "boxFiles": ASTRIDE})
    return _from_totals(whole.unionByName(astride), plan, group_by)


def _named_by_folders(folders: Sequence[T.StructField], group_by: Sequence[str]) -> bool:
    """Whether all groups are values that each file has as a whole."""
    if not set(group_by) - {PATH_COLUMN}:
        return True
    return not _clashes(folders) and set(group_by) <= {*(f.name for f in folders), PATH_COLUMN}


def _clashes(folders: Sequence[T.StructField]) -> bool:
    return bool({f.name.lower() for f in folders} & {PATH_COLUMN, *HEADER_SCHEMA.fieldNames()})


def header_plan(spark: SparkSession, aggs: Mapping[str, str]) -> dict[str, str] | None:
    """The texts over header totals, or None if some text needs the points.

    Each answerable aggregate is replaced by the name of a header total. If no point attribute is
    left, Spark analyses the rest as a filter over these totals alone, a place where neither other
    columns nor further aggregates are allowed; so Spark itself tells whether anything
    unanswerable remains.
    """
    rewritten = {name: _ANSWERABLE.sub(_total_name, text) for name, text in aggs.items()}
    if sql_words(rewritten.values()) & set(ATTRIBUTES):
        return None
    totals = spark.range(0).selectExpr(
        *[f"CAST(NULL AS {_total_type(n)}) AS {n}" for n in _totals_in(rewritten)]
    )
    try:
        totals.where(" AND ".join(f"(\n{text}\n) IS NOT NULL" for text in rewritten.values()))
    except AnalysisException:
        return None
    return rewritten


def _total_name(match: re.Match) -> str:
    if match["fn"]:
        return f"__{match['fn'].lower()}_{match['axis'].lower()}"
    if match["all"]:
        return "__count"
    if match["column"] and match["column"].lower() in ATTRIBUTES:
        return f"__count_{match['column'].lower()}"
    return match[0]


def _totals_in(texts: Mapping[str, str]) -> list[str]:
    names = [f"__{m}_{c}" for m in ("min", "max") for c in COORDINATES]
    names += ["__count"] + [f"__count_{a}" for a in ATTRIBUTES]
    words = sql_words(texts.values())
    return [n for n in names if n in words]


def _total_type(name: str) -> str:
    return "bigint" if name.startswith("__count") else "double"


def _totals(plan: Mapping[str, str]) -> list[str]:
    """Totals that a plan needs; one at least, as a projection of literals alone must give one row, not one per file."""
    return _totals_in(plan) or ["__count"]


def _header_total(name: str, null_missing: bool, exact: int | None = None) -> str:
    """SQL of a file's part of a total; with ``exact``, bounds as the decimals that a scan gives."""
    if name == "__count":
        return f"point_count AS {name}"
    if name.startswith("__count_"):
        column = name.removeprefix("__count_")
        formats = [f for f, names in POINT_FORMATS.items() if column in names]
        held = "point_count"
        if len(formats) < len(POINT_FORMATS):
            # the scan fails on a file without the column, so this way must not answer either
            problem = f"concat(path, ': point format has no column {column}')"
            other = "0L" if null_missing else f"CAST(raise_error({problem}) AS BIGINT)"
            listed = ", ".join(map(str, formats))
            held = f"CASE WHEN point_format IN ({listed}) THEN point_count ELSE {other} END"
        return f"{held} AS {name}"
    bound, c = name.removeprefix("__"), name[-1]
    if exact is None:
        return f"{bound} AS {name}"
    kind = f"DECIMAL(18, {exact})"
    scale, offset = (f"CAST(CAST({n}_{c} AS STRING) AS {kind})" for n in ("scale", "offset"))
    raw = f"CAST(round(({bound} - offset_{c}) / scale_{c}) AS DECIMAL(11, 0))"
    fits = f"CAST({scale} AS DOUBLE) = scale_{c} AND CAST({offset} AS DOUBLE) = offset_{c}"
    problem = f"CAST(raise_error(concat(path, ': scale or offset need more than {exact} digits')) AS {kind})"
    return f"CASE WHEN {fits} THEN CAST({raw} * {scale} + {offset} AS {kind}) ELSE {problem} END AS {name}"


def _header_totals(spark, path, plan, group_by: Sequence[str], options: dict, where: Sequence[str] = ()) -> DataFrame:
    """Groups and totals of each file whose folders pass ``where``."""
    null_missing = str(options.get("missingColumns", "")).lower() == "null"
    names = _totals(plan)
    columns = ["path", "point_format", "point_count"]
    columns += [n.removeprefix("__") for n in names if not n.startswith("__count")]
    exact = kinds(options)["exact"]
    if exact is not None:
        columns += [f"{k}_{c}" for c in COORDINATES for k in ("scale", "offset") if any(n[-1] == c for n in names)]
    narrow = None if where or set(group_by) - {PATH_COLUMN} else columns
    # files without points carry meaningless bounds
    headers = (indexed_headers if "index" in options else read_headers)(spark, path, columns=narrow, **options)
    headers = headers.where("point_count > 0")
    for text in where:
        headers = headers.where(text)
    keys = [F.col("path").alias(g) if g == PATH_COLUMN else F.col(f"`{g}`") for g in group_by]
    return headers.select(*keys, *[F.expr(_header_total(n, null_missing, exact)) for n in names])


def _point_totals(spark, path, plan, where: str, group_by: Sequence[str], options: dict) -> DataFrame:
    """Groups and totals of the points that pass ``where``, in at most one row for each group."""
    names = _totals(plan)
    counted = [n.removeprefix("__count_") for n in names if n.startswith("__count_")]
    needed = [*counted, *[n[-1] for n in names if not n.startswith("__count")], *group_by]
    texts = {
        n: "count(*)" if n == "__count"
        else f"count({n.removeprefix('__count_')})" if n.startswith("__count_")
        else f"{n[2:5]}({n[-1]})"
        for n in names
    }
    points = read_las(spark, path, list(dict.fromkeys(needed)), where=where, **options)
    found = points.groupBy(*[F.col(f"`{g}`") for g in group_by]).agg(*[F.expr(t).alias(n) for n, t in texts.items()])
    return found


def _from_totals(totals: DataFrame, plan: Mapping[str, str], group_by: Sequence[str]) -> DataFrame:
    sums = [
        F.coalesce(F.sum(n), F.lit(0)).alias(n) if n.startswith("__count") else F.expr(f"{n[2:5]}({n}) AS {n}")
        for n in _totals(plan)
    ]
    found = totals.groupBy(*[F.col(f"`{g}`") for g in group_by]).agg(*sums)
    results = [F.expr(text).alias(name) for name, text in plan.items()]
    return found.select(*[F.col(f"`{g}`") for g in group_by], *results)


def _from_points(spark, path, aggs, where, group_by, options) -> DataFrame:
    names = {n.lower() for n in column_names(spark, [*aggs.values(), *([where] if where else []), *group_by])}
    columns = [a for a in (*ATTRIBUTES, PATH_COLUMN) if a in names]
    if names - {*ATTRIBUTES, PATH_COLUMN}:
        folders = partition_fields(path_options(path, options))
        columns += [f.name for f in folders if f.name.lower() in names]
    points = read_las(spark, path, columns, where=where or None, **options)
    results = [F.expr(text).alias(name) for name, text in aggs.items()]
    return points.groupBy(*[F.expr(g) for g in group_by]).agg(*results)
