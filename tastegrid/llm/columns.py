"""The caller's columns carried through an operator inside one struct, so that their names cannot clash with the operator's own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_document"


def packed(docs: DataFrame, leave_out: Sequence[str] = ()) -> Column:
    """All columns of ``docs`` but the ones left out, as the struct ``_document`` (a null if none is left)."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in leave_out]
    return (F.struct(*kept) if kept else F.lit(None).cast("int")).alias(ROW)


def unpacked(names: Sequence[str], own: dict[str, Column]) -> list[Column]:
    """The caller's columns in their order, then the operator's; a column of the operator replaces the caller's of that name."""
    carried = [own[c].alias(c) if c in own else F.col(ROW)[c].alias(c) for c in names]
    return carried + [column.alias(c) for c, column in own.items() if c not in names]
