"""Data change on a corpus DataFrame ``(id, header_key, text)``.

All three are set operations (anti joins, aggregations and a union), never a
per-row loop:

* upsert by id: every stored row with an upserted id goes, the last upsert
  per id (highest ``seq``) comes in;
* delete by category: exact, case-sensitive ``header_key`` match;
* change feed: an ordered mix of both. A row (existing rows have
  ``seq = -1``) survives when no change with a larger ``seq`` upserts its id
  or deletes its header_key. Only the latest upsert of an id can survive, so
  this is: latest upsert per id (an aggregation), latest delete per key (an
  aggregation), anti join of the stored rows, and one filter -- the batch
  equivalent of replaying the calls one by one.

"Latest per id" is ``max(struct(seq, header_key, text))``, an aggregation with
map-side partial results: an id upserted in a third of all rows still ends
as one row per map task before the shuffle, never one task holding the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOC_COLS = ["id", "header_key", "text"]


def latest_per_id(upserts: DataFrame) -> DataFrame:
    """``id, seq, header_key, text`` of the highest ``seq`` per id (equal
    ``seq``: the larger header_key, then text, to stay deterministic)."""
    m = upserts.groupBy("id").agg(F.max(F.struct("seq", "header_key", "text")).alias("m"))
    return m.select("id", "m.seq", "m.header_key", "m.text")


def upsert(existing: DataFrame, new_docs: DataFrame) -> DataFrame:
    """B1: ``new_docs(seq, id, header_key, text)``: delete every stored row
    with one of the ids, add the latest new row per id."""
    latest = latest_per_id(new_docs.select("seq", *DOC_COLS))
    kept = existing.select(*DOC_COLS).join(latest.select("id"), "id", "left_anti")
    return kept.unionByName(latest.select(*DOC_COLS))


def delete_by_header(existing: DataFrame, header_keys: list[str] | DataFrame) -> DataFrame:
    """B2: drop every row whose header_key is one of the keys (no match is
    fine; a row without a key stays). A list filters directly (pushed to the
    scan); a DataFrame of keys anti-joins."""
    if isinstance(header_keys, DataFrame):
        keys = header_keys.select("header_key").distinct()
        return existing.join(keys, "header_key", "left_anti").select(*existing.columns)
    return existing.filter(~F.coalesce(F.col("header_key").isin(list(header_keys)), F.lit(False)))


def split_changes(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(latest upsert per id, latest delete seq per header_key as _k)``."""
    ups = changes.filter(F.col("op") == "upsert").select("seq", *DOC_COLS)
    last_del = (
        changes.filter(F.col("op") == "delete_header").groupBy("header_key").agg(F.max("seq").alias("_k"))
    )
    return latest_per_id(ups), last_del


def survivors(stored: DataFrame, latest: DataFrame, last_del: DataFrame) -> DataFrame:
    """Stored rows (any table carrying ``id`` and ``header_key``: documents,
    document statistics, postings) that no change removes: their id is not
    upserted and their header_key not deleted. Two anti joins; a change set
    is broadcast where Spark finds it small."""
    return stored.join(latest.select("id"), "id", "left_anti").join(
        last_del.select("header_key"), "header_key", "left_anti"
    )


def incoming(latest: DataFrame, last_del: DataFrame) -> DataFrame:
    """The latest upsert of each id, unless its key is deleted later."""
    new = latest.join(last_del, "header_key", "left").filter(
        F.col("_k").isNull() | (F.col("_k") <= F.col("seq"))
    )
    return new.select(*DOC_COLS)


def apply_changes(existing: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply ``changes(seq, op, id, header_key, text)`` in ``seq`` order."""
    latest, last_del = split_changes(changes)
    old = survivors(existing.select(*DOC_COLS), latest, last_del)
    return old.select(*DOC_COLS).unionByName(incoming(latest, last_del))
