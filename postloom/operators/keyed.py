"""Operations on a table with one row per key.

``base`` always holds a key once; a batch may repeat keys, and is reduced to one row per key
before it meets the base. Batches are joined against the base by key only, so Spark broadcasts a
batch whose measured size is small and leaves the base unshuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.ranking import latest_per_key


def absent_rows(base: DataFrame, batch: DataFrame, key: str, first: Sequence[Column]) -> DataFrame:
    """Rows of the batch to append: keys the base lacks, the first row of each; rows without a key are left out."""
    keyed = batch.filter(F.col(key).isNotNull())
    return latest_per_key(keyed, [key], first).select(base.columns).join(base.select(key), key, "left_anti")


def insert_if_absent(base: DataFrame, batch: DataFrame, key: str, first: Sequence[Column]) -> DataFrame:
    """Base plus the batch rows whose key it lacks; an existing row is never changed."""
    return base.unionByName(absent_rows(base, batch, key, first))


def upsert(base: DataFrame, batch: DataFrame, key: str, newest_first: Sequence[Column]) -> DataFrame:
    """Base with whole rows replaced or added by the newest batch row of each key.

    Batch rows without a key are left out, so a batch that is applied twice changes nothing more;
    :func:`keyless` lists them.
    """
    batch = batch.filter(F.col(key).isNotNull())
    newest = latest_per_key(batch, [key], newest_first).select(base.columns)
    kept = base.join(batch.select(key).distinct(), key, "left_anti")
    return kept.unionByName(newest)


def partial_update(
    base: DataFrame, batch: DataFrame, key: str, columns: Sequence[str], order: str
) -> DataFrame:
    """Base with single columns replaced. A null in the batch leaves the column as it is; of several
    batch rows for a key each column takes its last value that is not null. What can't be applied is
    listed by :func:`partial_update_rejects`."""
    changes = batch.groupBy(key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_new_{c}") for c in columns]
    )
    changed = {c: F.coalesce(f"_new_{c}", c) for c in columns}
    return base.join(changes, key, "left").withColumns(changed).select(base.columns)


def keyless(batch: DataFrame, key: str) -> DataFrame:
    """Batch rows that an insert or upsert leaves out, for want of a key."""
    return batch.filter(F.col(key).isNull())


def partial_update_rejects(base: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Batch rows that :func:`partial_update` can't apply, with a ``reason``: no key, no order, or a missing key."""
    known = base.select(key, F.lit(True).alias("_known"))
    reason = F.when(F.col(key).isNull(), "no key").when(F.col(order).isNull(), "no order").when(F.col("_known").isNull(), "missing")
    judged = batch.join(known, key, "left").withColumn("reason", reason)
    return judged.filter("reason IS NOT NULL").select(*batch.columns, "reason")


def delete_by_id(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return base.join(ids.select(key).distinct(), key, "left_anti")


def get(base: DataFrame, key: str, value, source_only: bool = False) -> DataFrame:
    """The row of one key, or no row; ``source_only`` leaves the key itself out."""
    row = base.filter(F.col(key) == F.lit(value))
    return row.drop(key) if source_only else row


def exists(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Every asked id with a boolean ``exists``."""
    known = base.select(key, F.lit(True).alias("_known"))
    return ids.join(known, key, "left").withColumn("exists", F.coalesce("_known", F.lit(False))).drop("_known")


def multi_get(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return base.join(ids.select(key).distinct(), key, "left_semi")


def multi_get_tables(tables: Mapping[str, DataFrame], wanted: DataFrame, key: str = "id") -> DataFrame:
    """Rows asked for by ``(_index, id)`` from several tables, with the union of their columns.

    Every table calls its key column ``key`` with one type.
    """
    found = None
    for name, table in tables.items():
        ids = wanted.filter(F.col("_index") == name)
        part = multi_get(table, ids, key).select(F.lit(name).alias("_index"), "*")
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    if found is None:
        raise ValueError("no tables given")
    return found


def sorted_search(base: DataFrame, key: str, by: Sequence[Column] = ()) -> DataFrame:
    """All rows in the given order; the key comes last, so equal values cannot pile up in one range."""
    return base.orderBy(*by, F.asc(key))


def paged_search(base: DataFrame, key: str, size: int, start: int = 0, by: Sequence[Column] = ()) -> DataFrame:
    """``size`` rows from position ``start`` of the sorted table."""
    return sorted_search(base, key, by).offset(start).limit(size)


def page_after(base: DataFrame, key: str, size: int, by: Sequence[str] = (), after: Sequence | None = None) -> DataFrame:
    """The next ``size`` rows behind the row with sort values ``after`` (of the columns ``by``, then the key).

    Unlike an offset, the page costs the same wherever it lies: rows up to ``after`` are filtered
    out, and only ``size`` rows of each task are sorted on. Columns sort ascending, nulls first.
    """
    columns = [*by, key]
    page = base
    if after is not None:
        behind = F.lit(False)
        for name, value in reversed(list(zip(columns, after, strict=True))):
            column, here = F.col(name), F.lit(value).cast(base.schema[name].dataType)
            more = column.isNotNull() if value is None else column > here
            behind = more | (column.eqNullSafe(here) & behind)
        page = base.filter(behind)
    return page.orderBy(*[F.asc_nulls_first(c) for c in columns]).limit(size)


def explode_items(orders: DataFrame, order_id: str = "id", items: str = "items") -> DataFrame:
    """One row per order item, text numbers cast, with ``line_total = price * quantity``."""
    return orders.select(order_id, F.explode(items).alias("i")).select(
        order_id,
        F.col("i.product_id").alias("product_id"),
        F.col("i.price").try_cast("double").alias("price"),
        F.col("i.quantity").try_cast("double").alias("quantity"),
    ).withColumn("line_total", F.col("price") * F.col("quantity"))
