"""Exact dedup as a tree merge of sorted digest runs, in binomial rounds. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.stage import ROW, Numbered, apart, counted_once, cut, numbered, parallelism

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Leaf runs, and how many runs one merge takes in: 256 to 128 to 64 and so on to 1.
RUNS = 256
FAN = 2

#: What must agree for two texts to count as equal: SHA-256, and beside it, against a collision,
#: the length and an independent hash.
KEY = ["digest", "n_bytes", "check"]


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    runs: int = RUNS,
    fan: int = FAN,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256`` and the row's
    number (``stage.ROW``). ``keep`` names which identifier of a group stays, ``max`` or ``min``.

    Rows are dealt to ``runs`` leaf runs by their number. A run is in order of digest and holds each
    digest once, with its retained identifier and its count. In every round the runs ``fan * r`` to
    ``fan * r + fan - 1`` are sent to run ``r``, brought into one order, and equal neighbours are merged;
    a run is spread over all tasks by digest, so that no task holds one whole. The last round leaves
    one run. Its winners go back to the leaf runs, and from there to the rows.

    A group of copies, however large, has at most ``fan`` entries in a merge, ``runs`` entries on
    the way back, and a ``runs``-th of its rows under one key of the last join.

    Null and empty texts are equal. A null identifier ranks below every other for ``max`` and
    above for ``min``. Of rows that repeat the retained identifier, the one with the greatest row
    number stays. An empty table gives an empty result. Other columns of ``df`` are ignored.
    """
    if keep not in ("max", "min"):
        raise ValueError(f"keep must be max or min, not {keep}")
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    rows = counted_once(df, F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        F.col(ROW).alias("row"),
        F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"),
        F.octet_length("t").alias("n_bytes"),
        F.xxhash64("t").alias("check"),
    )
    rows = rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int"))
    leaf = cut(rows, "digests")

    # Ranked as (known, id, row): min has to put unknown identifiers last.
    rank = F.struct(F.col("id").isNull() if keep == "min" else F.lit(True), "id", "row")
    pick = F.max if keep == "max" else F.min
    first = leaf.groupBy("run", *KEY).agg(
        pick(rank).alias("best"), F.count(F.lit(1)).alias("size")
    )
    merged, left, tasks = first, runs, parallelism(leaf.sparkSession)
    while left > 1:
        left = -(-left // fan)
        run = (F.col("run") / fan).cast("int").alias("run")
        # Within a run every digest is there once, so there is nothing to combine ahead of the exchange.
        runs_of_round = merged.select(run, *KEY, "best", "size").repartition(tasks, "run", *KEY)
        merged = (
            runs_of_round.sortWithinPartitions("run", *KEY)
            .groupBy("run", *KEY)
            .agg(pick("best").alias("best"), F.sum("size").alias("size"))
        )
    winners = merged.select(*KEY, "best", "size")
    per_run = first.select("run", *KEY).join(winners, KEY)
    out = leaf.join(per_run, ["run", *KEY])
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("row").alias(ROW),
    )


def keep_distinct(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    own, names, back = apart(df, id_col, text_col)
    rows = numbered(own, *own.columns)
    kept = exact_dedup(Numbered(rows), *names).filter("kept").select(ROW)
    return rows.join(kept, ROW, "left_semi").select(back)
