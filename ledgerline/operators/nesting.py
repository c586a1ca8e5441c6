"""Split nesting of children into bounded documents.

``nest_split`` builds nested documents (parent row + array of children) the way
a paged API delivers them: a parent with more than ``per_doc`` children is
delivered as several documents, each repeating the parent fields. This keeps
every array bounded, so one hot parent (say a third of all child rows) is
spread over many groups and tasks instead of one giant array in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Children per nested document; the source API pages nested lists by 250.
ITEMS_PER_DOC = 250


def nest_split(children: DataFrame, keys: list[str], child: Column, sort_key: Column,
               extra_aggs: list[Column] | None = None, per_doc: int = ITEMS_PER_DOC,
               name: str = "items", count_source: DataFrame | None = None,
               max_hot_broadcast: int = 1_000_000, ordered: bool = True) -> DataFrame:
    """Group child rows into arrays per parent, at most ~per_doc per document.

    Returns ``keys + [doc_part, <name>, *extra_aggs]``; ``<name>`` is sorted by
    ``sort_key``. Parents with more than ``per_doc`` children ("hot" parents)
    are found first with a map-side-combined count over the key columns
    (``count_source``, default ``children``). With no hot parent the grouping
    runs as one shuffle on the keys. Otherwise every hot parent's children are
    spread over ceil(n / per_doc) parts by a hash of the sort key; the hot set
    is broadcast when its size is within ``max_hot_broadcast`` rows (else a
    shuffle join), and rows are repartitioned on (keys, doc_part) so one hot
    parent is processed by many tasks instead of one.

    With ``ordered=False`` the arrays hold ``child`` alone, in any order: a
    caller whose children are wide collects their few plain columns, joins them,
    and builds and sorts the nested ones row by row after that, so that neither
    the grouping nor the sort of the join holds them.
    """
    collected = F.struct(sort_key.alias("k"), child.alias("v")) if ordered else child
    arrays = F.array_sort(F.collect_list("_child")) if ordered else F.collect_list("_child")
    built = F.transform("_sorted", lambda x: x["v"]) if ordered else F.col("_sorted")
    src = (count_source if count_source is not None else children).select(*keys)
    hot = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > per_doc)
    n_hot = hot.count()
    if n_hot == 0:
        # group on the keys alone: the result stays hash-partitioned on them,
        # so a following join on the same keys needs no second shuffle
        # shuffle first: collect_list gains nothing from a map-side partial
        # aggregate, and the nested structs are then built in parallel. Sorted
        # rows are grouped as they come and stay sorted for the join: one sort
        # instead of one for each half of the aggregate and one for the join
        tagged = children.repartition(*keys).withColumn("_child", collected).select(*keys, "_child").sortWithinPartitions(*keys)
        aggs = [arrays.alias("_sorted")] + list(extra_aggs or [])
        return (tagged.groupBy(*keys).agg(*aggs)
                .withColumn("doc_part", F.lit(0))
                .withColumn(name, built)
                .drop("_sorted"))
    else:
        side = F.broadcast(hot) if n_hot <= max_hot_broadcast else hot
        tagged = (children.join(side, keys, "left")
                  .withColumn("doc_part", F.when(F.col("_n").isNull(), F.lit(0)).otherwise(
                      F.pmod(F.xxhash64(sort_key), F.ceil(F.col("_n") / per_doc)).cast("int")))
                  .drop("_n")
                  .repartition(*keys, "doc_part"))
    tagged = tagged.withColumn("_child", collected).select(*keys, "doc_part", "_child").sortWithinPartitions(*keys, "doc_part")
    aggs = [arrays.alias("_sorted")] + list(extra_aggs or [])
    return (tagged.groupBy(*keys, "doc_part").agg(*aggs)
            .withColumn(name, built)
            .drop("_sorted"))
