"""Keyed tables: upsert, delete, status changes, change detection, resume points and conversations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspan.functions.text import excerpt
from quillspan.sources.shared import kept


def last_write(rows: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row of greatest version for each key, by aggregation: partial results leave each task, so a hot key is no hot task."""
    rest = [c for c in rows.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_r")
    return rows.groupBy(*key).agg(newest).select(*key, "_r.*").select(*rows.columns)


def upsert(table: DataFrame, changes: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    return last_write(table.unionByName(changes), key, version)


def delete_ids(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return table.join(ids.select(key).distinct(), key, "left_anti")


def delete_where(table: DataFrame, pred: Column) -> DataFrame:
    return table.where(~F.coalesce(pred, F.lit(False)))


def merge_status(table: DataFrame, news: DataFrame, key: str) -> DataFrame:
    """Upsert by natural key: a new status wins, a count of 0 or null keeps the old one. Partial success is an error."""
    status = F.when(F.col("n.status") == "partial", "error").otherwise(F.col("n.status"))
    return table.alias("o").join(news.alias("n"), key, "full_outer").select(
        key, F.coalesce(status, F.col("o.status")).alias("status"), F.coalesce(F.nullif(F.col("n.vectors"), F.lit(0)), F.col("o.vectors"), F.lit(0)).alias("vectors")
    )


def changed(new: DataFrame, cached: DataFrame, key: Sequence[str], digest: str = "digest") -> DataFrame:
    """new with `state`: new, changed or unchanged against the cached digests."""
    old = cached.select(*key, F.col(digest).alias("_old"))
    state = F.when(F.col("_old").isNull(), "new").when(F.col(digest).eqNullSafe(F.col("_old")), "unchanged").otherwise("changed")
    return new.join(old, list(key), "left").withColumn("state", state).drop("_old")


def after(rows: DataFrame, order: str, last: object | None) -> DataFrame:
    """What comes after a checkpoint; everything without one."""
    return rows if last is None else rows.where(F.col(order) > F.lit(last))


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def batches(rows: DataFrame, order: Sequence[str], size: int, by: Sequence[str] = ()) -> DataFrame:
    """Adds position (from 0 within `by`) and batch."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("position", F.row_number().over(w) - 1).withColumn("batch", F.floor(F.col("position") / size))


def cascade_delete(conversations: DataFrame, messages: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return delete_ids(conversations, ids, key), delete_ids(messages, ids, key)


def history(conversations: DataFrame, messages: DataFrame, key: str, most: int = 20) -> DataFrame:
    """Latest conversations with a preview of their first message."""
    first = messages.groupBy(key).agg(F.min_by("text", "turn").alias("first"))
    return conversations.join(first, key, "left").withColumn("preview", F.substring("first", 1, 100)).drop("first").orderBy(F.desc("updated"), F.desc(key)).limit(most)


def new_conversation_title(question: Column) -> Column:
    return excerpt(question, 50)


def matching(rows: DataFrame, **wanted: object) -> DataFrame:
    """Rows that equal every given value; None asks for nothing."""
    for name, value in wanted.items():
        if value is not None:
            rows = rows.where(F.col(name) == F.lit(value))
    return rows


def saved_query(question: str, answer: str, now, conversation: str | None, fresh_id: str, user: str = "system") -> tuple[list[dict], list[dict]]:
    """(conversation rows, message rows) that keep a question and its answer.

    A new conversation is titled by the question's first 50 characters; an old one only gets its updated_at. Citations
    stay in the answer's text and are not stored beside it.
    """
    key = conversation or fresh_id
    title = None if conversation else question if len(question) <= 50 else question[:50] + "..."
    thread = {"conversation_id": key, "user_id": None if conversation else user, "title": title, "created_at": None if conversation else now, "updated_at": now}
    said = [("user", question), ("assistant", answer)]
    return [thread], [{"conversation_id": key, "turn": i, "role": r, "text": t, "status": "complete", "created_at": now, "updated_at": now} for i, (r, t) in enumerate(said)]


def patched(table: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Keyed patch: a column that the patch holds a value for wins, nulls keep the old one; new keys are added."""
    rest = [c for c in table.columns if c != key]
    return table.alias("o").join(patch.alias("n"), key, "full_outer").select(key, *[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) if c in patch.columns else F.col(f"o.{c}").alias(c) for c in rest])


def covering_batches(rows: DataFrame, vectors: DataFrame, key: str, order: list[str], size: int = 100) -> tuple[DataFrame, DataFrame]:
    """(upsert batches with their vectors, rows without any): batch k holds rows [k * size, (k + 1) * size)."""
    numbered = batches(rows, order, size)
    return numbered.join(vectors, key), numbered.join(vectors.select(key).distinct(), key, "left_anti")


def dimension_checked(rows: DataFrame, dimensions: int, embedding: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): vectors of another length than the index has, or none, leave with a reason."""
    n = F.coalesce(F.size(embedding), F.lit(-1))
    reason = F.when(n < 0, "no vector").otherwise(F.format_string("%d dimensions, the index has %d", n, F.lit(dimensions)))
    return rows.where(n == dimensions), rows.where(n != dimensions).withColumn("reason", reason)


def create_index(control, name: str, dimensions: int, metric: str = "cosine") -> dict:
    """Declare an index once; the same declaration again is no error, another one is. control: operators.control.Control."""
    wanted, held = {"dimensions": dimensions, "metric": metric}, control.get(f"indexes/{name}")
    if held is None:
        control.put(f"indexes/{name}", wanted)
    elif held != wanted:
        raise ValueError(f"index {name} has {held}, not {wanted}")
    return wanted


def ranked(rows: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """Adds rank (from 1, equal keys share one) over the whole table without one task for all of it: keys are counted, the counts dealt
    into ranges, each range summed by itself and begun where those before it end."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    dealt = kept(counts.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy("_range").agg(F.sum("_n").alias("_sum"))  # at most `parts` rows
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    own = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    places = dealt.join(F.broadcast(before), "_range").withColumn("rank", F.col("_before") + F.coalesce(F.sum("_n").over(own), F.lit(0)) + 1)
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"p.{key}"))
    return rows.alias("r").join(places.select(key, "rank").alias("p"), same).select("r.*", "p.rank")
