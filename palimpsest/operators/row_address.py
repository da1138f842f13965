"""Where a row lies: its file and its place in it, as a narrow key for the row.

Matching finds rows; changing them needs those rows again.  The address takes the place
of the row's own values as the key between the two, so that a payload is never a join
key, equal payloads are no hot key, and the files that hold an affected row are known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from palimpsest.session import broadcast_if_small, written

FILE, ROW = "_file", "_row"
#: A block is 32 words, a word holds the marks of 32 rows.
_BLOCK_BITS, _WORDS, _IN_WORD = 10, 32, 31
_WORD = f"(shiftright({ROW}, 5) & {_WORDS - 1})"
#: Plan nodes that pass each row of a scan on at most once, and nothing else.
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "View"}


def _nodes(plan) -> set[str]:
    below = plan.children()
    return {plan.nodeName()}.union(*(_nodes(below.apply(k)) for k in range(below.size())))


def addressed(df: DataFrame) -> DataFrame:
    """The rows with ``_file`` and ``_row``.

    A table read from parquet files, filtered and projected, is addressed as it is.  Any
    other frame (joined, exploded, aggregated, from files without row numbers) is written
    to the scratch folder first, and addressed there.
    """
    where = F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)
    if _nodes(df._jdf.queryExecution().analyzed()) <= _ROW_BY_ROW:
        try:
            return df.select("*", *where)
        except AnalysisException:
            pass
    return written(df, "addressed").select("*", *where)


def _blocks(marks: DataFrame, name: str) -> DataFrame:
    """``_mark_file, _mark_block, _words``: the marks of 1,024 rows of a file in 32 words, two bits a row."""
    bits = F.expr(f"shiftleft(cast({name} as bigint), cast(2 * ({ROW} & {_IN_WORD}) as int))")
    words = [F.bit_or(F.when(F.expr(_WORD) == k, bits).otherwise(F.lit(0).cast("long"))) for k in range(_WORDS)]
    block = F.shiftright(ROW, _BLOCK_BITS).alias("_mark_block")
    return marks.groupBy(F.col(FILE).alias("_mark_file"), block).agg(F.array(*words).alias("_words"))


def marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Addressed rows with the code of ``marks``, which has one row per address and codes from 1 to 3 (0 elsewhere).

    Marks are packed before they meet the rows: a row's mark takes two bits instead of its
    address, so what is sent to every task, and held by the driver meanwhile, is some
    hundredths of the marks, and the rows are not shuffled.  Blocks beyond the broadcast limit
    are a plain join side: many broadcasts of one query would lie in the driver at once.
    """
    (name,) = [c for c in marks.columns if c not in (FILE, ROW)]
    # the size is asked for before they are joined
    blocks = broadcast_if_small(written(_blocks(marks, name), "marks"))
    same = (F.col(FILE) == F.col("_mark_file")) & (F.shiftright(ROW, _BLOCK_BITS) == F.col("_mark_block"))
    code = F.expr(f"cast(shiftright(_words[cast({_WORD} as int)], cast(2 * ({ROW} & {_IN_WORD}) as int)) & 3 as int)")
    return rows.join(blocks, same, "left").select(*rows.columns, F.coalesce(code, F.lit(0)).alias(name))
