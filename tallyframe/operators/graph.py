"""Property graph tables: vertices and edges with JSON property bags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import has_all, json_object
from .dedup import dedup
from .skew import dealt, task_count


def vertices(
    df: DataFrame, identifier: str, kind: str, props: dict[str, Column | str]
) -> DataFrame:
    """Rows (identifier, type, properties)."""
    return df.select(
        F.col(identifier).cast("string").alias("identifier"),
        F.lit(kind).alias("type"),
        json_object(**props).alias("properties"),
    )


def edges(
    df: DataFrame,
    subject: tuple[str, str],
    obj: tuple[str, str],
    kind: str,
    props: dict[str, Column | str],
    unique: bool = False,
) -> DataFrame:
    """One edge per (subject, object) pair of ``df``, which may hold duplicates unless it is ``unique``.

    ``subject`` and ``obj`` are pairs of a column and a vertex type.
    """
    once = df if unique else dedup(df, [subject[0], obj[0]])
    return once.select(
        F.col(subject[0]).cast("string").alias("subject_identifier"),
        F.lit(subject[1]).alias("subject_type"),
        F.col(obj[0]).cast("string").alias("object_identifier"),
        F.lit(obj[1]).alias("object_type"),
        F.lit(kind).alias("edge_type"),
        json_object(**props).alias("properties"),
    )


def member_totals(
    facts: DataFrame,
    member: str,
    event: str,
    amount: str,
    group: str,
    attrs: Sequence[str] = (),
    raw_rows: bool = False,
) -> DataFrame:
    """Per member: attributes, number of events, total amount and the groups it belongs to.

    Facts are deduplicated by (event, member) unless ``raw_rows``. ``group`` should come from a
    small domain: its distinct values become one sorted list, gathered as a set per map task.
    """
    rows = facts if raw_rows else dedup(facts, [event, member])
    return rows.groupBy(member).agg(
        *[F.max(a).alias(a) for a in attrs],
        F.count(F.lit(1)).alias("number_of_events"),
        F.sum(amount).alias("total_amount"),
        F.sort_array(F.collect_set(group)).alias("groups"),
    )


#: Members of an event in one block.
PAIR_BLOCK = 64


def member_pairs(
    facts: DataFrame,
    event: str,
    member: str,
    group: str,
    amount: str,
    block: int = PAIR_BLOCK,
) -> DataFrame:
    """Members that took part in the same events: (a, b, same_group, n_events, a_amount, b_amount), a < b.

    Each pair of an event counts once for its two members' groups being equal or different; a NULL
    group is neither. Amounts are summed over these events. Facts are deduplicated by (event, member)
    first; rows with a NULL event or member are left out.

    An event with more than ``block`` members is dealt into blocks, and each pair of blocks is a cell
    of its own: a cell holds some 2 * ``block`` members, and an event with very many is as many tasks
    as it has cells. The cells are dealt over tasks by the number of facts, which are counted first, so
    neither the cells nor the pairs of a task grow with the table. Pairs are added up within each task
    before they are shuffled.
    """
    n_tasks = task_count(facts, facts.count())
    once = dedup(facts.select(event, member, group, amount).where(has_all([event, member])), [event, member])
    rows = once.select(
        F.col(event).alias("e"), F.col(member).alias("m"), F.col(group).alias("g"), F.col(amount).alias("x")
    )
    # the number of members is combined before the shuffle; only events of several blocks are listed
    large = rows.groupBy("e").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
    placed = (
        rows.join(large, "e", "left")
        .withColumn("blocks", blocks)
        .withColumn("mine", F.pmod(F.xxhash64("m"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("e", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"),
                F.struct("m", "g", "x", "mine").alias("r"))
    )
    cells = dealt(placed, n_tasks, "e", "p", "q").groupBy("e", "p", "q").agg(F.collect_list("r").alias("rs"))

    def pairs(left: Column, right: Column, ordered: bool) -> Column:
        """All (low, high) of the two lists; of a list with itself, each pair once."""
        def with_all(a: Column) -> Column:
            others = F.filter(right, lambda b: a["m"] < b["m"]) if ordered else right
            return F.transform(others, lambda b: F.when(a["m"] < b["m"], F.struct(a.alias("a"), b.alias("b")))
                               .otherwise(F.struct(b.alias("a"), a.alias("b"))))

        return F.flatten(F.transform(left, with_all))

    def of_block(b: str) -> Column:
        return F.filter("rs", lambda r: r["mine"] == F.col(b))

    met = cells.select(F.explode(F.when(F.col("p") == F.col("q"), pairs(F.col("rs"), F.col("rs"), True))
                                 .otherwise(pairs(of_block("p"), of_block("q"), False))).alias("pair"))
    return (
        met.select(F.col("pair.a.m").alias("a"), F.col("pair.b.m").alias("b"),
                   (F.col("pair.a.g") == F.col("pair.b.g")).alias("same_group"), "pair.a.x", F.col("pair.b.x").alias("y"))
        .where(F.col("same_group").isNotNull())
        .groupBy("a", "b", "same_group")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum("x").alias("a_amount"), F.sum("y").alias("b_amount"))
    )


def memberships(facts: DataFrame, event: str, member: str, group: str, amount: str) -> DataFrame:
    """Members and the groups they belong to: (member, group, n_events, total), over deduplicated facts."""
    once = dedup(facts.select(event, member, group, amount).where(has_all([event, member])), [event, member])
    return (
        once.where(F.col(group).isNotNull())
        .groupBy(F.col(member).alias("member"), F.col(group).alias("group"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(amount).alias("total"))
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
