"""Exact deduplication by content hash and bytes."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import text_or_empty


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.withColumns({"__bytes": text, "__hash": F.unhex(F.md5(text))})


def _keeper(keep: str, column: Column | str) -> Column:
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    return F.min(column) if keep == "min" else F.max(column)


def copy_groups(docs: DataFrame, *, keep: str = "min", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: which row of its group of equal texts stays.

    The groups are formed on the 128-bit hash and the bytes together, so texts
    that only share the hash are different groups.  Equal texts of one task
    meet before the shuffle; the verdict returns to the documents by hash,
    never with the text, and a hot group is then a skewed join that adaptive
    execution splits.

    Columns: id, keep_id, group_size, kept, text_sha256.  A null text counts as
    empty; rows repeating an id and a text are all marked alike; null ids never
    win against others, and a group of null ids only keeps all its rows.
    """
    keyed = _keyed(docs.select(id_col, text_col), text_col)
    groups = (keyed.groupBy("__hash", "__bytes")
              .agg(_keeper(keep, id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select("__hash", F.sha2("__bytes", 256).alias("text_sha256"), "keep_id", "group_size"))
    rows = keyed.select(id_col, "__hash", F.sha2("__bytes", 256).alias("text_sha256"))
    return (rows.join(groups, ["__hash", "text_sha256"])
            .select(id_col, "keep_id", F.col("group_size").cast("bigint").alias("group_size"),
                    F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame, *, keep: str = "min", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each group of equal texts, all columns.

    Ties (repeated ids) fall to the extreme of the remaining columns in order,
    so exactly one row stays.  A null text equals an empty one.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    row = F.struct(F.col(id_col), F.col(text_col).isNull().alias("__null"), *[F.col(c) for c in others])
    best = _keyed(docs, text_col).groupBy("__hash", "__bytes").agg(_keeper(keep, row).alias("__row"))
    text = F.when(F.col("__row.__null"), F.lit(None)).otherwise(F.col("__bytes"))
    return best.select(*[text.alias(c) if c == text_col else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
