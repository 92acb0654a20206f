"""New keys for rows whose content hashes collide, and the same new keys wherever they are referred to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.functions.keys import LONG_MAX, encoded
from carebundle.operators.access_all import dense_numbers
from carebundle.operators.columns import quoted
from carebundle.sources.storage import stored


def identity(columns: Sequence[Column | str]) -> Column:
    """A digest that tells rows apart which a shorter key cannot."""
    return F.sha2(F.concat_ws("|", *encoded(columns)), 256)


def _salted(digest: Column, salt: Column, bits: int) -> Column:
    text = F.sha2(F.concat(digest, F.lit("#"), salt.cast("string")), 256)
    number = F.conv(F.substring(text, 1, 16), 16, -10).cast("bigint")
    return number.bitwiseAND(F.lit(LONG_MAX if bits >= 63 else (1 << bits) - 1))


def _wide_enough(waiting: DataFrame, taken: DataFrame, bits: int) -> int:
    """``bits`` if the waiting rows find keys of so many beside those that are taken, else the fewest that make eight times as
    many keys as are needed."""
    if bits >= 63 or waiting.isEmpty():
        return bits
    inside = taken.where(F.col("new_key").between(0, (1 << bits) - 1)).distinct()
    needed = inside.count() + waiting.select("identity").distinct().count()
    return bits if needed <= 1 << bits else min((8 * needed - 1).bit_length(), 63)


def _free_keys(waiting: DataFrame, taken: DataFrame, bits: int) -> DataFrame:
    """(new_key, identity): the free keys, in their order, for the waiting digests, in theirs."""
    every = waiting.sparkSession.range(1 << bits).select(F.col("id").alias("new_key"))
    free = dense_numbers(every.join(taken, "new_key", "left_anti"), "new_key", ordered=True)
    return free.join(dense_numbers(waiting, "identity", ordered=True), "number").select("new_key", "identity")


def key_repairs(frame: DataFrame, key: str, natural: Sequence[str], bits: int = 63) -> DataFrame:
    """(key, identity, new_key) of the rows that have to give up their key.

    Of different rows (by their natural columns) that share a key the one with the smallest digest keeps it.  The others try
    keys salted with the number of the round; a key is given away if no row of the table has it, no earlier round gave it
    away and no smaller digest wants it.  Only colliding rows take part in the rounds: the table is read once to find
    them, and its keys once a round to see which wanted ones are taken.  Rows that are equal in their natural columns
    share their key; rows without a key are left alone.  The result is stored; it depends on the rows alone, so it can be
    computed again.

    New keys have ``bits`` bits at most if that makes enough of them.  If there are more rows than such keys no choice would do,
    and new keys have the bits they need.  When a round settles less than half of its rows few keys are left, and the rest
    take the free ones in order.  A round stores what it gave away and what still waits, and nothing again.
    """
    digest = F.unhex(identity(natural))  # half as long as the text
    keyed = frame.where(F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).cast("bigint").alias("key"), digest.alias("identity"))
    shared = keyed.groupBy("key").agg(F.min("identity").alias("first"), F.max("identity").alias("last")).where("first <> last")
    shared = stored(shared.select("key", "first"), "shared-keys")
    waiting = keyed.join(shared, "key").where("identity <> first").select("key", "identity").distinct()
    waiting = stored(waiting, "colliding-rows")
    taken = keyed.select(F.col("key").alias("new_key"))
    bits = _wide_enough(waiting, taken, bits)
    given, salt, before, rows = waiting.withColumn("new_key", F.lit(None).cast("bigint")).where(F.lit(False)), 0, 0, waiting.count()
    while rows:
        salt += 1
        used = taken.union(given.select("new_key"))
        if before and 2 * (before - rows) < before and bits < 63:
            chosen = _free_keys(waiting, used, bits)
            accepted = waiting.join(chosen, "identity").select("key", "identity", "new_key")
        else:
            wanted = waiting.withColumn("new_key", _salted(F.lower(F.hex("identity")), F.lit(salt), bits))
            first = wanted.groupBy("new_key").agg(F.min("identity").alias("identity"))
            accepted = wanted.join(first.join(used, "new_key", "left_anti"), ["new_key", "identity"], "left_semi")
        accepted = stored(accepted.select("key", "identity", "new_key"), "repairs")
        waiting = stored(waiting.join(accepted.select("identity"), "identity", "left_anti"), "colliding-rows")
        given, before, rows = given.unionByName(accepted), rows, waiting.count()
    return given.withColumn("identity", F.lower(F.hex("identity")))


def with_repaired_keys(frame: DataFrame, column: str, natural: Sequence[str], repairs: DataFrame) -> DataFrame:
    """The table with new keys in a column that holds keys made from these natural columns: the table that was repaired, or
    any other that refers to it and has the columns the key was made from.  Column order stays; null stays null."""
    marks = repairs.select(*(F.col(name).alias(f"repair {name}") for name in ("key", "identity", "new_key")))
    digest = identity([frame[quoted(name)] for name in natural])
    same = (frame[quoted(column)] == marks["`repair key`"]) & (F.unhex(digest) == F.unhex(marks["`repair identity`"]))
    joined = frame.join(marks, same, "left")
    value = F.coalesce(marks["`repair new_key`"], frame[quoted(column)])
    return joined.select(*(value.alias(column) if name == column else frame[quoted(name)] for name in frame.columns))
