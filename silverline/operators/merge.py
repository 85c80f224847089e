"""MERGE semantics (update / insert / delete or update by source) as DataFrame joins.

``merge(target, source, spec)`` returns the new content of the target. Plain
parquet tables have no row-level MERGE, so the operator is expressed with joins
and conditional columns that Catalyst plans and codegens like any other query.

Plan shapes, picked from the clauses so that no unneeded join or shuffle is
planned and duplicate source keys never multiply target rows:

* update clause present: ``target LEFT OUTER JOIN source`` (matched and
  target-only rows). A small source is broadcast by the planner's size check,
  so the target is scanned once and never shuffled. Cardinality guard: a target
  row matched by two source rows raises, as SQL MERGE does. When the extra ON
  condition reads only one side, matches are counted per key on the source (a
  map-side combined aggregate joined back on the keys, source-sized work); only
  a condition mixing both sides needs the exact count per target row after the
  join.
* no update clause: by-source clauses need only "is this target row matched",
  so the target is joined once with the *distinct* matching source keys (an
  aggregate combined map-side); duplicate source keys cannot multiply target
  rows. An ON condition that mixes both sides falls back to a ``LEFT SEMI`` /
  ``LEFT ANTI`` pair. Without by-source clauses the target passes through
  untouched (no join).
* insert clause present: ``source LEFT ANTI JOIN (target LEFT SEMI JOIN source
  keys)`` on the full condition. The semi join only drops target rows that
  cannot match; with a small source it is a broadcast join, so no step of the
  merge shuffles the target.
* ``plan="full_outer"`` (``"auto"`` takes it for a source above the broadcast
  limit by the planner's estimate): with update and insert clauses, ``target FULL OUTER JOIN source``; the
  duplicate-match guard is a window on the source over the join's own
  partitioning, so each side is read and shuffled once. Rows with a null key get
  a salt, so they spread over all tasks. A hot key that is not null stays in one
  task, because Spark does not split the skewed partitions of a full outer join.
  Table jobs and micro-batches merge by :func:`silverline.operators.sized_merge.merge_by_size`,
  which measures the source and keeps hot keys and rows without a match out of this join.

A null key never matches (plain ``=``), so a null-key source row is inserted and
a null-key target row is "not matched by source". ``extras`` belong to the ON
condition, not to a source filter: a source row that fails them is not matched
and therefore inserted.

The source is tagged with a literal column *before* the join; matches are
tested on that tag, never on the nullness of a key.

Filter the inputs, not the result: the duplicate-match check is pinned above
the join, so a filter applied to the merged result is not pushed into the
target scan.
"""

from __future__ import annotations

import contextlib
import functools
import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.errors import PySparkException
from pyspark.logger import PySparkLogger
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from silverline.operators.dedup import keep_rows

_T, _S, _TID, _N, _SALT = "__merge_t", "__merge_s", "__merge_tid", "__merge_n", "__merge_salt"
PLANS = ("auto", "narrow", "full_outer")

Expr = str | Column


def _is_none_clause(v: Any) -> bool:
    return v is None or (isinstance(v, str) and v.strip().upper() == "NONE")


@dataclass
class MergeSpec:
    """Structured MERGE clauses.

    keys: columns equal on both sides (``target.k = source.k``), non-empty.
    extras: extra ON condition over ``target.`` / ``source.`` columns; a leading
        ``AND`` is accepted.
    update: WHEN MATCHED THEN UPDATE SET ``{column: expression}``.
    update_condition: optional ``WHEN MATCHED AND <condition>``; matched rows failing
        it stay unchanged (e.g. only apply newer versions).
    insert: WHEN NOT MATCHED THEN INSERT ``{column: expression}`` or ``"*"``
        (by name; target columns missing in the source become null).
    delete_by_source: WHEN NOT MATCHED BY SOURCE THEN DELETE; ``True`` for an
        unconditional delete or a condition over ``target.`` columns.
    update_by_source: WHEN NOT MATCHED BY SOURCE THEN UPDATE SET ``{column: expr}``
        with expressions over target columns only.
    dedupe_source: order column(s); if set, only the latest source row per key
        takes part (the safe precondition for an update).
    check_cardinality: raise when a target row is matched by more than one
        source row while an update clause is present.
    plan: ``"narrow"``, ``"full_outer"``, or ``"auto"`` (full outer where the source is estimated above the
        broadcast limit); the result is the same. The full outer plan acts where update and insert are both
        given and the guard need not look at both sides (see the module text), else the narrow plan runs.

    ``None`` or the text ``"NONE"`` (any case) means "no such clause".
    """

    keys: list[str]
    extras: Expr | None = None
    update: Mapping[str, Expr] | None = None
    update_condition: Expr | None = None
    insert: Mapping[str, Expr] | str | None = None
    delete_by_source: bool | Expr = False
    update_by_source: Mapping[str, Expr] | None = None
    dedupe_source: str | list[str] | None = None
    check_cardinality: bool = True
    plan: str = "auto"

    def validate(self) -> "MergeSpec":
        if isinstance(self.keys, str) or not self.keys or not all(isinstance(k, str) and k for k in self.keys):
            raise ValueError("merge: 'keys' must be a non-empty list of column names")
        if _is_none_clause(self.update):
            self.update = None
        if _is_none_clause(self.insert):
            self.insert = None
        if _is_none_clause(self.update_by_source):
            self.update_by_source = None
        if _is_none_clause(self.delete_by_source) or self.delete_by_source is False:
            self.delete_by_source = False
        if isinstance(self.insert, str) and self.insert.strip() != "*":
            raise ValueError("merge: insert must be a {column: expression} dict or '*'")
        for name in ("update", "update_by_source"):
            v = getattr(self, name)
            if v is not None and (not isinstance(v, Mapping) or not v):
                raise ValueError(f"merge: {name} must be a non-empty {{column: expression}} dict")
        if self.update_condition is not None and self.update is None:
            raise ValueError("merge: update_condition needs an update clause")
        if isinstance(self.insert, Mapping) and not self.insert:
            raise ValueError("merge: insert must not be empty")
        if (
            self.update is None
            and self.insert is None
            and self.delete_by_source is False
            and self.update_by_source is None
        ):
            raise ValueError("merge: at least one WHEN clause is required (MERGE without WHEN)")
        if self.delete_by_source is True and self.update_by_source is not None:
            raise ValueError(
                "merge: with both NOT MATCHED BY SOURCE clauses the delete must carry a "
                "condition; only the last clause may be unconditional"
            )
        if self.plan not in PLANS:
            raise ValueError(f"merge: plan must be one of {PLANS}, not {self.plan!r}")
        return self


def _cond(e: Expr) -> Column:
    if isinstance(e, Column):
        return e
    return F.expr(re.sub(r"^\s*AND\b", "", e, flags=re.IGNORECASE))


def _val(e: Any) -> Column:
    if isinstance(e, Column):
        return e
    if isinstance(e, str):
        return F.expr(e)
    return F.lit(e)


_DUP_MSG = ("MERGE: a target row matched more than one source row; "
            "deduplicate the source (dedupe_source=...)")


@contextlib.contextmanager
def _quiet_analysis():
    """Silence PySpark's error-context loggers while probing an expression that may not resolve."""
    # fetched through PySparkLogger: a plain logging.getLogger() would register plain
    # loggers under these names, which PySpark's own error reporting cannot use
    loggers = [PySparkLogger.getLogger(n) for n in ("DataFrameQueryContextLogger", "SQLQueryContextLogger")]
    levels = [lg.level for lg in loggers]
    for lg in loggers:
        lg.setLevel(logging.CRITICAL + 1)
    try:
        yield
    finally:
        for lg, lv in zip(loggers, levels):
            lg.setLevel(lv)


def _extras_scope(t: DataFrame, s: DataFrame, extras: Expr | None) -> str:
    """Which side the extra ON condition reads: "none", "source", "target" or "mixed".

    Decided by resolving the condition against each side alone (analysis only).
    """
    if extras is None or (isinstance(extras, str) and not extras.strip()):
        return "none"
    with _quiet_analysis():
        for name, side in (("source", s), ("target", t)):
            try:
                side.select(_cond(extras)).schema
                return name
            except PySparkException:
                continue
    return "mixed"


def _check_columns(target: DataFrame, source: DataFrame, spec: MergeSpec) -> None:
    for k in spec.keys:
        if k not in target.columns:
            raise ValueError(f"merge: key {k!r} not in target")
        if k not in source.columns:
            raise ValueError(f"merge: key {k!r} not in source")
    for name in ("update", "update_by_source"):
        v = getattr(spec, name)
        if v:
            unknown = [c for c in v if c not in target.columns]
            if unknown:
                raise ValueError(f"merge: {name} sets unknown target columns {unknown}")
    if isinstance(spec.insert, Mapping):
        unknown = [c for c in spec.insert if c not in target.columns]
        if unknown:
            raise ValueError(f"merge: insert names unknown target columns {unknown}")
    for c in (_T, _S, _TID, _N, _SALT):
        if c in target.columns or c in source.columns:
            raise ValueError(f"merge: reserved column name {c!r} in input")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size estimate of ``df`` is within the broadcast limit (False where there is none)."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        limit = int(limit) if limit.lstrip("-").isdigit() else int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit))
    except AttributeError:  # a session without a local JVM gives no estimates
        return False
    return 0 <= size <= limit


def _insert_values(target: DataFrame, source_cols: list[str], spec: MergeSpec) -> dict[str, Column]:
    tcols = target.columns
    if spec.insert == "*" or (isinstance(spec.insert, str) and spec.insert.strip() == "*"):
        return {c: (F.col(f"source.`{c}`") if c in source_cols else F.lit(None)) for c in tcols}
    return {c: (_val(spec.insert[c]) if c in spec.insert else F.lit(None)) for c in tcols}


def _with_salt(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with a second join key: 0, or a hash of the row where a key is null (such a row matches nothing)."""
    some_null = functools.reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    return df.withColumn(_SALT, F.when(some_null, F.xxhash64(*plain)).otherwise(F.lit(0).cast("long")))


def _merge_full_outer(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """The merge as one full outer join, for a spec with update and insert clauses."""
    on_cols = [*spec.keys, _SALT]
    scope = _extras_scope(target.alias("target"), source.alias("source"), spec.extras)
    t = _with_salt(target, spec.keys).withColumn(_T, F.lit(True)).alias("target")
    s = _with_salt(source, spec.keys).withColumn(_S, F.lit(True)).alias("source")
    guard = spec.check_cardinality and not spec.dedupe_source
    if guard:
        hit = F.when(_cond(spec.extras), F.lit(1)) if scope == "source" else F.lit(1)
        same_key = Window.partitionBy(*[F.col(f"source.`{c}`") for c in on_cols])
        s = s.withColumn(_N, F.count(hit).over(same_key)).alias("source")
    on = functools.reduce(lambda a, b: a & b, [F.col(f"target.`{c}`") == F.col(f"source.`{c}`") for c in on_cols])
    if scope != "none":
        on = on & _cond(spec.extras)
    j = t.join(s, on, "full_outer")
    in_target, in_source = F.col(f"target.{_T}").isNotNull(), F.col(f"source.{_S}").isNotNull()
    if guard:
        # pinned above the join by the nondeterministic conjunct, as in the default plan
        too_many = in_target & in_source & (F.col(f"source.{_N}") > 1) & (F.spark_partition_id() >= 0)
        j = j.filter(F.when(too_many, F.raise_error(F.lit(_DUP_MSG))).isNull())
    if spec.delete_by_source is not False:
        gone = F.lit(True) if spec.delete_by_source is True else F.coalesce(_cond(spec.delete_by_source), F.lit(False))
        j = j.filter(in_source | ~gone)
    applies = F.lit(True) if spec.update_condition is None else F.coalesce(_cond(spec.update_condition), F.lit(False))
    inserted = _insert_values(target, source.columns, spec)

    def value(name: str, kind) -> Column:
        old = F.col(f"target.`{name}`")
        new = _val(spec.update[name]).cast(kind) if name in spec.update else old
        left = _val(spec.update_by_source[name]).cast(kind) if name in (spec.update_by_source or {}) else old
        return (F.when(in_target & in_source, F.when(applies, new).otherwise(old)).when(in_target, left)
                .otherwise(inserted[name].cast(kind)).alias(name))

    return j.select([value(f.name, f.dataType) for f in target.schema.fields])


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Return the target as it is after ``MERGE INTO target USING source``.

    Expressions refer to ``target.<col>`` and ``source.<col>``. Output columns keep
    the target's names, order and types (values are cast as on assignment).
    """
    spec.validate()
    if target.isStreaming or source.isStreaming:
        raise ValueError("merge needs batch DataFrames; for a stream use merge_stream (one merge per micro-batch)")
    _check_columns(target, source, spec)
    if spec.dedupe_source:
        source = keep_rows(source, spec.keys, spec.dedupe_source, keep="last", tiebreak=True)

    wide = spec.plan == "full_outer" or spec.plan == "auto" and not fits_broadcast(source)
    if wide and spec.update is not None and spec.insert is not None:
        unguarded = not spec.check_cardinality or bool(spec.dedupe_source)
        if unguarded or _extras_scope(target.alias("target"), source.alias("source"), spec.extras) != "mixed":
            return _merge_full_outer(target, source, spec)

    tcols = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    t = target
    s = source.withColumn(_S, F.lit(True))
    # after dedupe_source there is one source row per key: the guard cannot fire
    guard = spec.update is not None and spec.check_cardinality and not spec.dedupe_source
    t = t.alias("target")
    s = s.alias("source")
    if guard and _extras_scope(t, s, spec.extras) == "mixed":
        t = t.withColumn(_TID, F.monotonically_increasing_id()).alias("target")
    on = functools.reduce(
        lambda a, b: a & b,
        [F.col(f"target.`{k}`") == F.col(f"source.`{k}`") for k in spec.keys],
    )
    if spec.extras is not None and not (isinstance(spec.extras, str) and not spec.extras.strip()):
        on = on & _cond(spec.extras)

    def out(values: Mapping[str, Column]) -> list[Column]:
        return [values[c].cast(types[c]).alias(c) for c in tcols]

    tgt = {c: F.col(f"target.`{c}`") for c in tcols}
    parts: list[DataFrame] = []

    delete_cond = None
    if spec.delete_by_source is True:
        delete_cond = F.lit(True)
    elif spec.delete_by_source is not False:
        delete_cond = _cond(spec.delete_by_source)
    by_source = delete_cond is not None or spec.update_by_source is not None

    def by_source_values() -> dict[str, Column]:
        if spec.update_by_source is None:
            return tgt
        upd = {c: _val(e) for c, e in spec.update_by_source.items()}
        return {c: upd.get(c, tgt[c]) for c in tcols}

    def keep_unmatched() -> Column:
        # first matching BY SOURCE clause wins: delete (if its condition holds), else update
        if delete_cond is None:
            return F.lit(True)
        return ~F.coalesce(delete_cond, F.lit(False))

    if spec.update is not None:
        src = s
        post_join_guard = False
        if guard:
            scope = _extras_scope(t, s, spec.extras)
            if scope == "mixed":
                post_join_guard = True
            else:
                # matches per key, counted on the source with a map-side combined
                # aggregate (a hot key never sits whole in one task) and joined back on
                # the keys; null keys never match, so they need no count
                hit = F.lit(1) if scope != "source" else F.when(_cond(spec.extras), F.lit(1))
                counts = s.groupBy(*[F.col(f"source.`{k}`").alias(f"__mk{i}") for i, k in enumerate(spec.keys)]) \
                    .agg(F.count(hit).alias(_N))
                back = functools.reduce(
                    lambda a, b: a & b,
                    [F.col(f"source.`{k}`") == counts[f"__mk{i}"] for i, k in enumerate(spec.keys)],
                )
                src = s.join(counts, back, "left_outer").select(F.col("source.*"), counts[_N]).alias("source")
        j = t.join(src, on, "left_outer")
        matched = F.col(f"source.{_S}").isNotNull()
        if guard:
            if post_join_guard:
                w = Window.partitionBy(*[F.col(f"target.`{k}`") for k in spec.keys], F.col(f"target.{_TID}"))
                too_many = F.count(F.col(f"source.{_S}")).over(w) > 1
                j = j.withColumn(_N, too_many)
                too_many = F.col(_N)
            else:
                too_many = matched & (F.col(f"source.{_N}") > 1)
            # The optimizer may turn the outer join into an inner one (delete by source)
            # and move any deterministic predicate into the join condition, from where
            # it is re-inferred onto the source through the key equality; there it would
            # fire for duplicate source rows that match no target row. A nondeterministic
            # conjunct (always true) pins the check above the join.
            too_many = too_many & (F.spark_partition_id() >= 0)
            j = j.filter(F.when(too_many, F.raise_error(F.lit(_DUP_MSG))).isNull())
        upd = {c: _val(e) for c, e in spec.update.items()}
        bys = by_source_values()
        apply = matched
        if spec.update_condition is not None:
            apply = matched & F.coalesce(_cond(spec.update_condition), F.lit(False))
        values = {
            c: F.when(apply, upd.get(c, tgt[c])).otherwise(F.when(matched, tgt[c]).otherwise(bys[c]))
            for c in tcols
        }
        if delete_cond is not None:
            j = j.filter(matched | keep_unmatched())
        parts.append(j.select(out(values)))
    elif by_source:
        scope = _extras_scope(t, s, spec.extras)
        if scope == "mixed":
            # exact, but the target is read by two joins
            parts.append(t.join(s, on, "left_semi").select(out(tgt)))
            anti = t.join(s, on, "left_anti")
            if delete_cond is not None:
                anti = anti.filter(keep_unmatched())
            parts.append(anti.select(out(by_source_values())))
        else:
            # one pass over the target: join the distinct matching source keys
            # (map-side combined, so duplicate or hot source keys cannot multiply rows)
            hits = s.filter(_cond(spec.extras)) if scope == "source" else s
            sk = hits.select(*[F.col(f"source.`{k}`") for k in spec.keys]).distinct() \
                .withColumn(_S, F.lit(True)).alias("source")
            on_k = functools.reduce(
                lambda a, b: a & b,
                [F.col(f"target.`{k}`") == F.col(f"source.`{k}`") for k in spec.keys],
            )
            if scope == "target":
                on_k = on_k & _cond(spec.extras)
            j = t.join(sk, on_k, "left_outer")
            matched = F.col(f"source.{_S}").isNotNull()
            if delete_cond is not None:
                j = j.filter(matched | keep_unmatched())
            bys = by_source_values()
            parts.append(j.select(out({c: F.when(matched, tgt[c]).otherwise(bys[c]) for c in tcols})))
    else:
        parts.append(t.select(out(tgt)))

    if spec.insert is not None:
        # Only target rows whose keys occur in the source can match. Reduce the target
        # with a semi join on the source keys first (broadcast by the planner when the
        # source is small), so finding the inserts never shuffles the whole target.
        sk = s.select(*[F.col(f"source.`{k}`").alias(f"__ik{i}") for i, k in enumerate(spec.keys)])
        t_hit = t.join(
            sk,
            functools.reduce(lambda a, b: a & b,
                             [F.col(f"target.`{k}`") == sk[f"__ik{i}"] for i, k in enumerate(spec.keys)]),
            "left_semi",
        ).alias("target")
        scope = _extras_scope(t, s, spec.extras)
        if scope != "mixed":
            # one row a key leaves each map task, however hot the key
            t_hit = (t_hit.where(_cond(spec.extras)) if scope == "target" else t_hit).select(
                *[F.col(f"target.`{k}`") for k in spec.keys]).distinct().alias("target")
            on = functools.reduce(lambda a, b: a & b, [F.col(f"target.`{k}`") == F.col(f"source.`{k}`") for k in spec.keys])
            if scope == "source":
                on = on & _cond(spec.extras)
        ins = s.join(t_hit, on, "left_anti")
        parts.append(ins.select(out(_insert_values(target, source.columns, spec))))

    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def scd2_expire(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    change_ts: str,
    current_col: str = "is_current",
    valid_to_col: str = "valid_to_ts",
    status_col: str | None = "status",
    archived_value: Any = "archived",
) -> DataFrame:
    """Close current versions that the source names; archive rows that it does not match.

    Archiving sets ``current_col`` to false and ``status_col`` to ``archived_value``. Matching
    requires ``target.<current_col> = true`` in the ON condition. Consequence, kept on purpose:
    history rows (already closed) are never matched, so they count as "not matched by source"
    and get the archived status too.
    """
    archived = {current_col: F.lit(False), **({status_col: F.lit(archived_value)} if status_col else {})}
    spec = MergeSpec(
        keys=keys,
        extras=F.col(f"target.`{current_col}`") == F.lit(True),
        update={current_col: F.lit(False), valid_to_col: F.col(f"source.`{change_ts}`")},
        update_by_source=archived,
    )
    return merge(target, source, spec)


def _one_row_per_key(source: DataFrame, keys: list[str], change_ts: str, identity: Column) -> DataFrame:
    """``source`` as (keys, ``identity``, ``s`` its row); a key with two rows or without ``change_ts`` raises when it is read.

    ``identity`` is null but for rows with a null in their key, which it tells apart; of equal ones the latest counts.
    """
    rows = source.select(F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("s"))
    cols = [F.col(f"s.`{k}`").alias(k) for k in keys]
    grouped = rows.groupBy(*cols, identity.alias("__sid")).agg(F.max_by("s", F.col(f"s.`{change_ts}`")).alias("s"), F.count(F.lit(1)).alias("n"), F.count(
        F.col(f"s.`{change_ts}`")).alias("timed"))
    key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]), {"ignoreNullFields": "false"})
    fault = (F.when(F.col("timed") < F.col("n"), F.concat(F.lit(f"scd2_apply: no {change_ts} for key "), key))
             .when((F.col("n") > 1) & F.col("__sid").isNull(), F.concat(F.lit("scd2_apply: more than one source row for key "), key)))
    return grouped.select(*[F.col(f"`{k}`") for k in keys], "__sid", F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(F.col("s")).alias("s"))


def scd2_apply(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    change_ts: str,
    current_col: str = "is_current",
    valid_from_col: str = "valid_from_ts",
    valid_to_col: str = "valid_to_ts",
    status_col: str | None = "status",
    archived_value: Any = "archived",
    active_value: Any = "active",
    new_version: Mapping[str, Expr] | None = None,
) -> DataFrame:
    """Full SCD type 2 in one join of the current versions with the source.

    A current version whose tracked columns differ (null-safely) from a source row that is newer
    is closed at ``change_ts`` and followed by a new current version; one that does not differ, or
    whose source row is not newer, stays; one that the source lacks is archived; a source row
    without a current version becomes one. History is left alone, so applying the same source
    again changes nothing. Tracked are the columns a new version sets, other than the keys and
    the bookkeeping columns. The source must have one row per key, and each a ``change_ts`` (both checked).
    A row with a null in its key is known by its tracked values as well: it is a version of its own, and meeting the
    same values again changes nothing.

    A source within the broadcast limit leaves the target where it is; above, both sides are shuffled once.

    New version columns come from the source by name unless ``new_version`` maps
    them; the bookkeeping columns are set as current, valid from ``change_ts``.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    mapping = dict(new_version or {})
    own = lambda side, c: F.col(f"{side}.`{c}`")
    fixed = {current_col: F.lit(True), valid_from_col: own("s", change_ts), valid_to_col: F.lit(None)}
    if status_col is not None:
        fixed[status_col] = F.lit(active_value)
    # expressions of new_version name plain source columns: evaluated before the join
    extended = source.select("*", *[_val(e).alias(f"__new_{i}") for i, e in enumerate(mapping.values())])
    mapped = {c: own("s", f"__new_{i}") for i, c in enumerate(mapping)}

    def fresh(c: str) -> Column:
        if c in mapped:
            return mapped[c]
        return fixed[c] if c in fixed else own("s", c) if c in source.columns else F.lit(None)

    new = {c: fresh(c).cast(types[c]) for c in target.columns}
    tracked = [c for c in target.columns if c not in fixed and c not in keys and (c in mapped or c in source.columns)]
    changed = functools.reduce(lambda a, b: a | b, [~own("t", c).eqNullSafe(new[c]) for c in tracked], F.lit(False))
    if valid_from_col in target.columns:
        changed = changed & F.coalesce(own("s", change_ts) > own("t", valid_from_col), own("t", valid_from_col).isNull())

    def version(values: Mapping[str, Column]) -> Column:
        return F.array(F.struct(*[values[c].cast(types[c]).alias(c) for c in target.columns]))

    old = {c: own("t", c) for c in target.columns}
    closed = version({**old, current_col: F.lit(False), **({valid_to_col: own("s", change_ts)} if valid_to_col in types else {})})
    archived = version({**old, current_col: F.lit(False), **({status_col: F.lit(archived_value)} if status_col in types else {})})
    is_current = F.coalesce(F.col(f"`{current_col}`") == F.lit(True), F.lit(False))
    t = target.where(is_current).select(F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("t"))

    def identity(side: str, values: Mapping[str, Column]) -> Column:
        some_null = functools.reduce(lambda a, b: a | b, [own(side, k).isNull() for k in keys])
        return F.when(some_null, F.to_json(F.struct(*[values[c].alias(f"c{i}") for i, c in enumerate(tracked)], F.lit(0).alias("c"))))

    t = t.select(*[own("t", k).alias(f"__t{i}") for i, k in enumerate(keys)], identity("t", old).alias("__tid"), "t")
    s = _one_row_per_key(extended, keys, change_ts, identity("s", new))
    on = functools.reduce(lambda a, b: a & b, [F.col(f"__t{i}").eqNullSafe(F.col(f"`{k}`")) for i, k in enumerate(keys)])
    on = on & F.col("__tid").eqNullSafe(F.col("__sid"))
    versions = (F.when(F.col("t").isNull(), version(new)).when(F.col("s").isNull(), archived)
                .when(changed, F.concat(closed, version(new))).otherwise(version(old)))
    if fits_broadcast(source):
        # the target's keys that occur in the source, one row a key from each task
        here = t.drop("t").join(s.drop("s"), on, "left_semi").distinct()
        new_keys = s.join(here, on, "left_anti").select(F.explode(version(new)).alias("v"))
        applied = t.join(s, on, "left_outer").select(F.explode(versions).alias("v")).unionByName(new_keys).select("v.*")
    else:
        applied = t.join(s, on, "full_outer").select(F.explode(versions).alias("v")).select("v.*")
    return target.where(~is_current).unionByName(applied)


def _sql_text(e: Any, what: str) -> str:
    if isinstance(e, Column):
        raise ValueError(f"merge_into_sql: {what} must be SQL text, not a Column")
    if isinstance(e, str):
        return e
    if isinstance(e, bool):
        return "TRUE" if e else "FALSE"
    if e is None:
        return "NULL"
    if isinstance(e, (int, float)):
        return repr(e)
    raise ValueError(f"merge_into_sql: cannot render {what} {e!r} as SQL")


def merge_into_sql(
    target_table: str,
    source_view: str,
    spec: MergeSpec,
    target_columns: list[str],
    source_columns: list[str],
) -> str:
    """``MERGE INTO`` text for catalogs whose tables support row-level operations.

    Same semantics as :func:`merge`: ``INSERT *`` is spelled out by name with
    NULL for target columns the source lacks, and a conditional delete-by-source
    comes before an update-by-source.
    """
    spec.validate()
    q = lambda c: "`" + c.replace("`", "``") + "`"
    on = " AND ".join(f"target.{q(k)} = source.{q(k)}" for k in spec.keys)
    if spec.extras is not None and not (isinstance(spec.extras, str) and not spec.extras.strip()):
        text = _sql_text(spec.extras, "extras").strip()
        if text[:4].upper() == "AND ":
            text = text[4:]
        on += f" AND ({text})"
    lines = [f"MERGE INTO {target_table} AS target", f"USING {source_view} AS source", f"ON {on}"]
    if spec.update is not None:
        sets = ", ".join(f"{q(c)} = {_sql_text(e, 'update')}" for c, e in spec.update.items())
        cond = "" if spec.update_condition is None else f" AND ({_sql_text(spec.update_condition, 'update_condition')})"
        lines.append(f"WHEN MATCHED{cond} THEN UPDATE SET {sets}")
    if spec.insert is not None:
        if isinstance(spec.insert, str):
            vals = {c: (f"source.{q(c)}" if c in source_columns else "NULL") for c in target_columns}
        else:
            vals = {c: _sql_text(e, "insert") for c, e in spec.insert.items()}
        lines.append(f"WHEN NOT MATCHED THEN INSERT ({', '.join(q(c) for c in vals)}) "
                     f"VALUES ({', '.join(vals.values())})")
    if spec.delete_by_source is True:
        lines.append("WHEN NOT MATCHED BY SOURCE THEN DELETE")
    elif spec.delete_by_source is not False:
        lines.append(f"WHEN NOT MATCHED BY SOURCE AND ({_sql_text(spec.delete_by_source, 'delete_by_source')}) "
                     "THEN DELETE")
    if spec.update_by_source is not None:
        sets = ", ".join(f"{q(c)} = {_sql_text(e, 'update_by_source')}" for c, e in spec.update_by_source.items())
        lines.append(f"WHEN NOT MATCHED BY SOURCE THEN UPDATE SET {sets}")
    return "\n".join(lines)
