"""Preference formatting of chosen and rejected conversations, in built-in expressions only.

The longest common turn prefix of the two sides is rendered once, as the prompt; the turns after
it are the completions, each with the spans that a trainer should score (what assistants say and
its end mark).

No text can forge a mark: where it holds ``<`` before one or more ``|``, one more ``|`` is put in, so a mark, which
has one, never comes from a text (taking one out again gives the text). In roles ``<``, ``|``, ``>`` and
line ends become ``_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 256
TRAINED_ROLE = "assistant"
OPEN, AFTER_ROLE, END = "<|", "|>\n", "<|end|>\n"


def _side(turns: DataFrame, name: str, chunk: int | None) -> DataFrame:
    rows = turns.where("pair_id IS NOT NULL").select("pair_id", F.col("turn").cast("bigint").alias("turn"), "role", "text").distinct()
    part = F.lit(0).cast("bigint") if chunk is None else F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-1))
    return rows.groupBy("pair_id", part.alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias(name))


def _header(t: Column) -> Column:
    return F.concat(F.lit(OPEN), F.regexp_replace(F.coalesce(t["role"], F.lit("")), r"[<|>\r\n]", "_"), F.lit(AFTER_ROLE))


def _body(t: Column) -> Column:
    return F.concat(F.regexp_replace(F.coalesce(t["text"], F.lit("")), r"<(\|+)", "<|$1"), F.lit(END))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def _mask(turns: Column, role: str, before: Column) -> Column:
    """Spans (code points, end exclusive) of the rendered turns to train on, counted from ``before``."""
    kind = "array<struct<start:bigint,stop:bigint>>"
    start = F.struct(before.alias("at"), F.array().cast(kind).alias("spans"))

    def step(acc, t):
        begin = acc["at"] + F.char_length(_header(t))
        end = begin + F.char_length(_body(t))
        span = F.when(t["role"].eqNullSafe(F.lit(role)), F.array(F.struct(begin.alias("start"), end.alias("stop")))).otherwise(F.array().cast(kind))
        return F.struct(end.alias("at"), F.concat(acc["spans"], span).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_preferences(chosen: DataFrame, rejected: DataFrame, role: str = TRAINED_ROLE, chunk: int | None = CHUNK) -> DataFrame:
    """One row for each pair and chunk of ``chunk`` turn numbers; ``chunk=None`` gives one row a pair.

    Both inputs have ``pair_id, turn, role, text``. Columns: ``pair_id, chunk, n_common`` (turns of
    the pair's common prefix that lie in this chunk), ``prompt, chosen, rejected`` and the masks. A pair's text is its
    chunks' in order; a pair whose turn numbers are below ``chunk`` is one row. Chunks are the default as one
    conversation may hold a large share of all turns and no task should hold it whole. Mask
    offsets count from the start of the pair's completion, whatever the chunks.

    Turns are ordered by number, then role and text; exact repeats of a turn count once and turns
    compare null-safely; null roles and texts render as empty; turns without a number come before all others (in chunk
    -1); rows without a pair take no part. A side that is missing has an empty
    completion. Further columns take no part; empty tables give no rows.
    """
    empty = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    sides = _side(chosen, "c", chunk).join(_side(rejected, "r", chunk), ["pair_id", "chunk"], "full")
    sides = sides.select("pair_id", "chunk", F.coalesce("c", empty).alias("c"), F.coalesce("r", empty).alias("r"))
    same = F.zip_with("c", "r", lambda x, y: x.eqNullSafe(y))
    sides = sides.withColumn("differ", F.array_position(same, F.lit(False)))
    breaks = sides.where("differ > 0").groupBy("pair_id").agg(F.min("chunk").alias("break"))
    known = sides.join(breaks, "pair_id", "left")
    common = (F.when(F.col("break").isNull() | (F.col("chunk") < F.col("break")), F.size("c"))
              .when(F.col("chunk") == F.col("break"), F.col("differ") - 1).otherwise(0))
    known = known.select("pair_id", "chunk", common.cast("int").alias("n_common"), "c", "r")
    tail = lambda x: F.slice(x, F.col("n_common") + 1, F.greatest(F.size(x), F.lit(1)))
    parts = known.select("pair_id", "chunk", "n_common", F.slice("c", F.lit(1), F.col("n_common")).alias("p"), tail("c").alias("c"), tail("r").alias("r"))
    shown = parts.select("pair_id", "chunk", "n_common", _render(F.col("p")).alias("prompt"), _render(F.col("c")).alias("chosen"),
                         _render(F.col("r")).alias("rejected"), "c", "r")
    if chunk is None:
        before = {x: F.lit(0).cast("bigint") for x in ("chosen", "rejected")}
    else:
        earlier = Window.partitionBy("pair_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        sums = shown.select("pair_id", "chunk", *[F.char_length(x).alias(x) for x in ("chosen", "rejected")])
        # a row of numbers for each chunk, the turns themselves are not gathered
        sums = sums.select("pair_id", "chunk", *[F.coalesce(F.sum(x).over(earlier), F.lit(0).cast("bigint")).alias(f"{x}_at") for x in ("chosen", "rejected")])
        shown = shown.join(sums, ["pair_id", "chunk"])
        before = {x: F.col(f"{x}_at") for x in ("chosen", "rejected")}
    return shown.select("pair_id", "chunk", "n_common", "prompt", "chosen", "rejected", _mask(F.col("c"), role, before["chosen"]).alias("chosen_mask"),
                        _mask(F.col("r"), role, before["rejected"]).alias("rejected_mask"))


def with_swapped_replies(turns: DataFrame) -> DataFrame:
    """A rejected side for a table without one: ``pair_id, turn, role, text``.

    The last assistant turn of each conversation is replaced by that of its neighbour (``conv_id``
    with the lowest bit flipped); where either has none the conversation stays as it is.
    """
    own = turns.where("conv_id IS NOT NULL")
    last = own.where(F.col("role") == TRAINED_ROLE).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("reply"))
    swap = last.select("conv_id", F.col("last.turn").alias("at")).join(other, "conv_id")
    joined = own.join(swap, "conv_id", "left")
    swapped = (F.col("role") == TRAINED_ROLE) & F.col("turn").eqNullSafe(F.col("at")) & F.col("at").isNotNull()
    return joined.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.when(swapped, F.col("reply")).otherwise(F.col("text")).alias("text"))
