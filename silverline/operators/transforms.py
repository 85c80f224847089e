"""Config-driven column and row transforms, folded into one lazy plan.

A chain is a list of ``{"name": ..., "params": {...}}`` entries. Each step is a
``DataFrame -> DataFrame`` function looked up in an explicit registry, so the
whole chain becomes a single logical plan: Catalyst collapses the projections,
pushes the filters into the scan and prunes the columns nobody reads. Every step
is stateless, so the same chain works on a streaming DataFrame.

Semantics kept from the pandas original:

* renames are simultaneous (``a``/``b`` swap works); unknown names are ignored;
* ``add_column`` overwrites an existing column in place, else appends it;
  ``expression`` wins over ``value``; a ``None`` value counts as missing;
* unknown drop targets are ignored;
* ``filter_rows`` takes SQL text (SQL null rules), or a structured condition list
  whose ``!=`` and ``not in`` *keep* null rows, as pandas does;
* malformed chain entries and unknown step names are logged and skipped; an
  error inside a step is raised.

Column existence is checked in exact case. Spark resolves names without regard
to case, so a name that differs from an existing column only in case is refused
instead of silently replacing that column.
"""

from __future__ import annotations

import functools
import logging
import re
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

log = logging.getLogger(__name__)

TransformFn = Callable[[DataFrame, Mapping[str, Any]], DataFrame]


def _need(step: str, params: Mapping[str, Any], key: str, fits: Callable[[Any], bool], kind: str) -> Any:
    """``params[key]``, refused unless it fits."""
    value = params.get(key)
    if not fits(value):
        raise ValueError(f"{step}: {key!r} must be {kind}, not {value!r}")
    return value


def _project(df: DataFrame, step: str, names: Mapping[str, str | None]) -> DataFrame:
    """One projection: each column under its new name, or gone where that is None.

    Names the frame does not have are logged; results that differ only in case are refused.
    """
    strangers = sorted(set(names) - set(df.columns))
    if strangers:
        log.warning("%s: no such columns: %s", step, strangers)
    pairs = [(c, names.get(c, c)) for c in df.columns]
    out = [new for _, new in pairs if new is not None]
    if [*map(str.lower, out)] != [*dict.fromkeys(map(str.lower, out))]:
        raise ValueError(f"{step}: two columns would share a name in {out}")
    return df if all(c == new for c, new in pairs) else df.select([F.col(f"`{c}`").alias(new) for c, new in pairs if new is not None])


def rename_columns(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """Rename with ``params["mapper"]`` (old -> new), all at once."""
    mapper = _need("rename_columns", params, "mapper", lambda m: isinstance(m, dict), "a dict")
    for c in set(mapper) & set(df.columns):
        _need("rename_columns", mapper, c, lambda v: isinstance(v, str) and v != "", "a new name")
    return _project(df, "rename_columns", mapper)


# ``df['name']`` / ``df["name"]``: the pandas column accessor used in expression configs
_ACCESSOR = re.compile(r"""\bdf\[\s*(['"])(.+?)\1\s*\]""")


def sql_text(expression: str) -> str:
    """Spark SQL text for an expression; pandas ``df['col']`` accessors become column references."""
    return _ACCESSOR.sub(lambda m: "`" + m.group(2).replace("`", "``") + "`", expression)


def _as_column(df: DataFrame, expression: Any) -> Column:
    if isinstance(expression, Column):
        return expression
    if isinstance(expression, str):
        return F.expr(sql_text(expression))
    if callable(expression):
        result = expression(df)
        if not isinstance(result, Column):
            raise ValueError("add_column: a callable expression must return a Column")
        return result
    raise ValueError("add_column: 'expression' must be SQL text, a Column or a callable")


def _analysed(df: DataFrame, step: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``build(df)`` with its analysis forced, so that what Spark refuses fails here as ``ValueError``."""
    try:
        out = build(df)
        out.schema  # noqa: B018
        return out
    except (PySparkException, TypeError) as e:
        raise ValueError(f"{step}: {e}") from e


def add_column(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """Add or overwrite ``column_name`` from ``expression`` (preferred) or literal ``value``."""
    name = _need("add_column", params, "column_name", lambda v: isinstance(v, str) and v != "", "a name")
    twin = next((c for c in df.columns if c != name and c.lower() == name.lower()), None)
    if twin is not None:
        raise ValueError(f"add_column: {name!r} is {twin!r} in another case; Spark would replace that column")
    source = next(((k, params[k]) for k in ("expression", "value") if params.get(k) is not None), None)
    if source is None:
        raise ValueError("add_column: neither 'expression' nor 'value' is given")
    kind, what = source
    return _analysed(df, "add_column", lambda d: d.withColumn(name, F.lit(what) if kind == "value" else _as_column(d, what)))


def drop_columns(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """Drop the listed columns that exist (exact case); ignore the rest."""
    gone = _need("drop_columns", params, "columns_to_drop",
                 lambda v: isinstance(v, list) and all(isinstance(c, str) for c in v), "a list of strings")
    return _project(df, "drop_columns", dict.fromkeys(gone))


# Order comparisons of the structured filter form; null and NaN fail them all, as in pandas.
_COMPARE: dict[str, Callable[[Column, Any], Column]] = {
    "==": lambda c, v: c == F.lit(v),
    ">": lambda c, v: c > F.lit(v),
    ">=": lambda c, v: c >= F.lit(v),
    "<": lambda c, v: c < F.lit(v),
    "<=": lambda c, v: c <= F.lit(v),
}


def _is_missing(v: Any) -> bool:
    return v is None or isinstance(v, float) and v != v


def _condition(c: Column, floating: bool, op: str, value: Any) -> Column:
    """One condition with pandas' rules for missing values (null, and NaN in floating columns)."""
    missing = (c.isNull() | F.isnan(c)) if floating else c.isNull()
    if op in ("is null", "is not null"):
        return missing if op == "is null" else ~missing
    if op in ("in", "not in"):
        listed = list(value)
        present = [v for v in listed if not _is_missing(v)]
        found = F.coalesce(c.isin(present), F.lit(False)) & ~missing if present else F.lit(False)
        found = found | missing if len(present) < len(listed) else found
        return found if op == "in" else ~found
    if op == "!=":
        return F.lit(True) if _is_missing(value) else ~c.eqNullSafe(F.lit(value))
    if _is_missing(value):
        return F.lit(False)
    return F.coalesce(_COMPARE[op](c, value), F.lit(False)) & ~missing


def condition_from_list(conditions: list, combine: str = "and", schema: StructType | None = None) -> Column:
    """Build a predicate from ``[(column, op, value), ...]`` with pandas null rules.

    ``schema`` tells which columns are floating, where NaN counts as missing.
    """
    if not isinstance(conditions, list) or not conditions:
        raise ValueError("filter_rows: 'conditions' must be a non-empty list")
    if combine not in ("and", "or"):
        raise ValueError("filter_rows: 'combine' must be 'and' or 'or'")
    floating = {f.name for f in schema.fields if isinstance(f.dataType, (FloatType, DoubleType))} if schema else set()
    preds = []
    for item in conditions:
        if not isinstance(item, (list, tuple)) or len(item) not in (2, 3):
            raise ValueError(f"filter_rows: bad condition {item!r}; use (column, op, value)")
        name, op, value = (*item, None)[:3]
        op = str(op).lower()
        if op not in _COMPARE and op not in ("!=", "in", "not in", "is null", "is not null"):
            raise ValueError(f"filter_rows: unknown operator {item[1]!r}")
        preds.append(_condition(F.col(f"`{name}`"), name in floating, op, value))
    return functools.reduce((lambda a, b: a & b) if combine == "and" else (lambda a, b: a | b), preds)


def filter_rows(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """Keep rows matching ``query_string`` (Spark SQL) or ``conditions`` (structured)."""
    if params.get("conditions") is not None:
        pred = condition_from_list(params["conditions"], params.get("combine", "and"), df.schema)
    else:
        query = _need("filter_rows", params, "query_string", lambda v: isinstance(v, (str, Column)), "SQL text unless 'conditions' are given")
        pred = F.expr(sql_text(query)) if isinstance(query, str) else query
    return _analysed(df, "filter_rows", lambda d: d.filter(pred))


BUILTINS: dict[str, TransformFn] = {
    "rename_columns": rename_columns,
    "add_column": add_column,
    "drop_columns": drop_columns,
    "filter_rows": filter_rows,
}


class Transformer:
    """Applies a list of named transforms; custom ones are registered by name."""

    def __init__(self) -> None:
        self.registry: dict[str, TransformFn] = dict(BUILTINS)

    def register(self, name: str, fn: TransformFn | None = None):
        """Register ``fn(df, params) -> df`` under ``name``; usable as a decorator."""
        if not isinstance(name, str) or not name:
            raise ValueError("register: name must be a non-empty string")

        def _add(f: TransformFn) -> TransformFn:
            if not callable(f):
                raise TypeError("register: transform must be callable")
            self.registry[name] = f
            return f

        return _add(fn) if fn is not None else _add

    def _step(self, entry: Any) -> TransformFn | None:
        """The entry as a function of a frame; None (and a log line) where it is malformed or unknown."""
        try:
            name, params = entry["name"], entry["params"]
            fn = self.registry[name]
        except (TypeError, KeyError, IndexError) as e:
            log.error("transform entry %r skipped: %s missing or unknown", entry, e)
            return None
        return lambda df: fn(df, params or {})

    def apply_transformations(self, df: DataFrame, configs: list) -> DataFrame:
        """Fold the chain over ``df``; each step must return a frame."""
        for what, kind in ((df, DataFrame), (configs, list)):
            if not isinstance(what, kind):
                raise TypeError(f"apply_transformations: {what!r} is no {kind.__name__}")
        return functools.reduce(lambda d, step: d.transform(step), filter(None, map(self._step, configs)), df)


def apply_transformations(df: DataFrame, configs: list, transformer: Transformer | None = None) -> DataFrame:
    """Module-level shortcut over a default :class:`Transformer`."""
    return (transformer or Transformer()).apply_transformations(df, configs)
