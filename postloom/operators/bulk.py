"""Ordered create/index/update/delete actions applied to a keyed table.

Whether an action is valid depends on the actions before it on the same key, and one key may own a
third of the log. So no window ever spans all actions of a key: the log is cut into blocks of
consecutive actions, windows run inside (key, block), and only one or two summary rows per block
meet in the key's own group. Blocks are cut by position in the log, not by sequence number, so a
block holds a fixed number of actions whatever the keys and the numbers are.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.operators.joins import lookup_anti_join
from postloom.operators.positions import positioned

# Actions per block.
BLOCK = 100_000
# The base table enters the log before every action.
BEFORE_ALL = -(2**63)


def _ordered(actions: DataFrame, key: str, seq: str) -> DataFrame:
    """Actions that have a place in the log (a key, and a sequence number of their own), with that ``_place``.

    The log is written in order once, and all that follows reads it. Places are positions in the
    whole log, so a block of places is a block of rows however the numbers are spread. Rows that
    share a number are spread over ranges by a row number; they are refused all the same.
    """
    placed = actions.filter(F.col(key).isNotNull() & F.col(seq).isNotNull()).withColumn("_row", F.monotonically_increasing_id())
    stored = positioned(placed, [F.asc(seq), F.asc("_row")], "_place").drop("_row")
    return lookup_anti_join(stored, repeated_seq(stored, seq), [seq])


def _judged(base: DataFrame, actions: DataFrame, key: str, columns: Sequence[str], seq: str, block: int) -> DataFrame:
    """Log of actions (and of the base rows they touch) with ``_was`` and ``_valid``.

    create, index and delete fix whether the key exists afterwards, valid or not: a refused create
    leaves an existing row, a refused delete leaves none. So an action's validity needs only the
    latest earlier action that is no update.
    """
    touched = base.join(actions.select(key).distinct(), key, "left_semi")
    number = F.col(seq).cast("bigint").alias("_number")
    log = actions.select(key, F.col("_place").alias("_seq"), number, F.col("op").alias("_op"), *columns).unionByName(
        touched.select(key, F.lit(BEFORE_ALL).alias("_seq"), F.lit(None).cast("bigint").alias("_number"), F.lit("index").alias("_op"), *columns)
    )
    log = log.withColumns(
        {
            "_block": F.expr(f"_seq div {int(block)}"),
            "_leaves": F.when(F.col("_op").isin("create", "index"), True).when(F.col("_op") == "delete", False),
        }
    )
    ends = log.groupBy(key, "_block").agg(
        F.max_by("_leaves", F.when(F.col("_leaves").isNotNull(), F.col("_seq"))).alias("_end")
    )
    earlier_blocks = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(key, "_block", F.last("_end", ignorenulls=True).over(earlier_blocks).alias("_carried"))

    earlier = Window.partitionBy(key, "_block").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    was = F.coalesce(F.last("_leaves", ignorenulls=True).over(earlier), "_carried", F.lit(False))
    op = F.col("_op")
    valid = (
        F.when(op == "index", True)
        .when(op == "create", ~F.col("_was"))
        .when(op.isin("update", "delete"), F.col("_was"))
        .otherwise(False)
    )
    return log.join(carried, [key, "_block"]).withColumn("_was", was).withColumn("_valid", valid)


def bulk_rejects(
    base: DataFrame, actions: DataFrame, key: str, seq: str = "seq", block: int | None = None
) -> DataFrame:
    """Actions that were not applied: ``seq, op, key, reason``.

    create of a key that exists, update or delete of one that does not, an unknown action name, or
    an action without a key, without a sequence number, or with one that others have too.
    """
    placed = actions.filter(F.col(key).isNotNull() & F.col(seq).isNotNull())
    again = placed.join(repeated_seq(placed, seq), seq, "left_semi")
    unplaced = [
        (actions.filter(F.col(key).isNull()), "no key"),
        (actions.filter(F.col(key).isNotNull() & F.col(seq).isNull()), "no order"),
        (again, "repeated order"),
    ]
    ordered = _ordered(actions, key, seq)
    judged = _judged(base, ordered, key, [], seq, block or BLOCK)
    reason = (
        F.when(F.col("_op") == "create", "exists")
        .when(F.col("_op").isin("update", "delete"), "missing")
        .otherwise("unknown action")
    )
    refused = judged.filter(~F.col("_valid")).select(
        F.col("_number").alias(seq), F.col("_op").alias("op"), key, reason.alias("reason")
    )
    for rows, why in unplaced:
        refused = refused.unionByName(
            rows.select(F.col(seq).cast("bigint").alias(seq), "op", key, F.lit(why).alias("reason"))
        )
    return refused


def apply_bulk(
    base: DataFrame,
    actions: DataFrame,
    key: str,
    columns: Sequence[str],
    seq: str = "seq",
    block: int | None = None,
) -> DataFrame:
    """Base after all valid actions, in order of ``seq``. Actions without a key or a ``seq`` of their
    own are refused, like others that :func:`bulk_rejects` lists.

    A create or index starts a new life of its key, a delete ends one; a later update sets the
    columns it holds (null means "not in this update"). Keys without an action pass unread by the
    fold.
    """
    actions = _ordered(actions, key, seq)
    block = block or BLOCK
    valid = _judged(base, actions, key, columns, seq, block).filter("_valid")
    in_block = Window.partitionBy(key, "_block")
    so_far = in_block.orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turn = F.when(F.col("_leaves").isNotNull(), F.col("_seq"))
    lives = valid.withColumns({"_life": F.max(turn).over(so_far), "_last": F.max(turn).over(in_block)})
    # Of each block only two stretches can matter: before its first turn, and after its last one.
    stretches = (
        lives.filter(F.col("_life").isNull() | (F.col("_life") == F.col("_last")))
        .groupBy(key, "_block", "_life")
        .agg(
            F.max_by("_leaves", turn).alias("_alive"),
            *[F.max(F.when(F.col(c).isNotNull(), F.struct("_seq", c))).alias(c) for c in columns],
        )
    )
    final_life = F.max("_life").over(Window.partitionBy(key))
    final = stretches.withColumn("_final", final_life).filter(
        (F.col("_life") == F.col("_final"))
        | (F.col("_life").isNull() & (F.col("_block") > F.expr(f"_final div {int(block)}")))
    )
    folded = (
        final.groupBy(key)
        .agg(F.bool_or("_alive").alias("_alive"), *[F.max(c).alias(c) for c in columns])
        .filter("_alive")
        .select(key, *[F.col(f"{c}.{c}").alias(c) for c in columns])
    )
    untouched = base.join(actions.select(key).distinct(), key, "left_anti").select(key, *columns)
    return untouched.unionByName(folded)


# Action names of a bulk log.
OPERATIONS = ["create", "index", "update", "delete"]


def parse_bulk_log(lines: DataFrame, fields: str, line: str = "line", value: str = "value") -> DataFrame:
    """Actions ``(seq, op, _index, id, <fields>)`` of a log of numbered JSON ``lines``.

    An action's line names the operation with ``_index`` and ``_id``; what it writes stands in the
    next line, but for delete. An update may wrap its fields in ``doc``. ``seq`` is the number of
    the action's line. Broken lines are no actions.
    """
    target = "struct<_index string, _id string>"
    schema = "struct<" + ", ".join(f"{op} {target}" for op in OPERATIONS) + ">"
    head = F.from_json(value, schema)
    op = F.coalesce(*[F.when(F.col(f"head.{name}").isNotNull(), F.lit(name)) for name in OPERATIONS])
    chosen = F.coalesce(*[F.col(f"head.{name}") for name in OPERATIONS])
    actions = lines.select(F.col(line).cast("bigint").alias("seq"), head.alias("head"))
    actions = actions.select("seq", op.alias("op"), chosen["_index"].alias("_index"), chosen["_id"].alias("id")).filter("op IS NOT NULL")
    body = F.from_json(value, f"struct<doc struct<{fields}>, {fields}>")
    bodies = lines.select((F.col(line).cast("bigint") - 1).alias("seq"), body.alias("body"))
    names = [f.name for f in T.StructType.fromDDL(fields)]
    has_body = F.col("op") != "delete"
    columns = [F.when(has_body, F.coalesce(f"body.doc.{n}", f"body.{n}")).alias(n) for n in names]
    return actions.join(bodies, "seq", "left").select("seq", "op", "_index", "id", *columns)


def apply_bulk_log(tables: Mapping[str, DataFrame], actions: DataFrame, columns: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Every table after the actions whose ``_index`` names it; ``columns`` are those that a table's actions set.

    Actions for a table that isn't given are refused: :func:`unknown_tables` lists them.
    """
    return {
        name: apply_bulk(table, actions.filter(F.col("_index") == name), "id", columns[name]) for name, table in tables.items()
    }


def unknown_tables(tables: Iterable[str], actions: DataFrame) -> DataFrame:
    """Actions that name no known table."""
    return actions.filter(F.col("_index").isNull() | ~F.col("_index").isin(list(tables)))


def repeated_seq(actions: DataFrame, seq: str = "seq") -> DataFrame:
    """Sequence numbers used more than once; a log is only defined where this is empty."""
    return actions.groupBy(seq).count().filter("count > 1").select(seq)
