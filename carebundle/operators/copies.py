"""Tell equal rows apart without ever bringing them together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebundle.operators.columns import quoted

CHUNK = 65_536


def _free(label: str, taken: list[str]) -> str:
    """A column name that is not taken."""
    while label.lower() in {name.lower() for name in taken}:
        label = f"_{label}"
    return label


def number_copies(frame: DataFrame, name: str = "copy", chunk: int = CHUNK) -> DataFrame:
    """Every row with a number 1..n among the n rows equal to it.

    Equal rows are counted, with partial counts before the shuffle, and written out again from the count:
    rows that are equal need no order among them.  A window would bring all copies of a row into one task.
    A count above ``chunk`` is first cut into chunks, which are spread over all tasks, so a row that makes up a
    third of the table is written by the whole cluster.
    """
    total = _free("n", [*frame.columns, name])
    counted = frame.groupBy(*(quoted(column) for column in frame.columns)).agg(F.count(F.lit(1)).alias(total))
    return write_copies(counted, total, name, chunk)


def write_copies(counted: DataFrame, total: str, name: str = "copy", chunk: int = CHUNK) -> DataFrame:
    """Each row as many times as its column ``total`` says, numbered from 1; that column goes.  Null and less than 1 is never.

    The rows are read twice, so what is costly to compute should be stored or end in a shuffle.
    """
    columns = [quoted(column) for column in counted.columns if column != total]
    # Chunk rows are tiny until they are written out, so adaptive execution would merge them into one task if it were free
    # to choose: the number of tasks is given.
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, copies = _free("chunk", [*counted.columns, name]), F.col(quoted(total))
    few = counted.where((copies >= 1) & (copies <= chunk)).select(
        *columns, F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias(name)
    )
    first = F.col(part) * chunk + 1
    last = F.least((F.col(part) + 1) * chunk, copies)
    many = (
        counted.where(copies > chunk)
        .select(
            *columns,
            quoted(total),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((copies - 1) / chunk))).alias(part),
        )
        .repartition(tasks, *columns, part)
        .select(*columns, F.explode(F.sequence(first, last)).alias(name))
    )
    return few.unionByName(many)
