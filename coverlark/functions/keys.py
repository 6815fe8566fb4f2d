"""Keys that break ties without looking at a name: hashes of a namespace and ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def item_key(item: str, namespace: str) -> Column:
    """Lower-case hex SHA-256 of the namespace and the id."""
    return F.sha2(F.concat(F.lit(namespace), F.col(item).cast("string")), 256)


def member_key(item: str, namespace: str) -> Column:
    """An aggregate: the key of a group from its members, whose ids are sorted and joined by newlines."""
    return F.sha2(F.concat(F.lit(namespace + "species|"), F.array_join(F.array_sort(F.collect_list(F.col(item).cast("string"))), "\n")), 256)


def membership_hash(item: str) -> Column:
    """An aggregate: SHA-256 of the sorted ids, each followed by a newline. For sets whose id list fits a row."""
    return F.sha2(F.concat(F.array_join(F.array_sort(F.collect_list(F.col(item).cast("string"))), "\n"), F.lit("\n")), 256)


def draw_key(item: str, namespace: str, scenario: str) -> Column:
    """The key by which a scenario draws items in a fixed but arbitrary order."""
    return F.sha2(F.concat(F.lit(f"{namespace}|{scenario}|"), F.col(item).cast("string")), 256)


#: A prime below 2 ** 31, whose products stay within 64 bits, and multipliers of generators modulo it.
PRIME, MULTIPLIERS = (1 << 31) - 1, (16_807, 48_271, 69_621)


def mixed(value: Column, replicate: Column, key: Column) -> Column:
    """A number below PRIME that depends on all three, by whole-number arithmetic alone. ``value`` is a plain column, for it is named twice."""
    x = (value + (replicate * MULTIPLIERS[1] + key) % PRIME) % PRIME
    return x * x % PRIME * MULTIPLIERS[1] % PRIME


def round_key(seed: int, step: int) -> int:
    return (seed * MULTIPLIERS[0] + step * MULTIPLIERS[2]) % PRIME


def permuted(value: Column, replicate: Column, rows: int, columns: int, seed: int, rounds: int = 6) -> Column:
    """The place of ``value`` in a permutation of 0 to rows * columns - 1 that belongs to the replicate.

    A Feistel network over a table of unequal sides: by turns the row and the column move round by a mixture of the other.
    """
    keys = F.array(*[F.struct(F.lit(round_key(seed, step)).cast("long").alias("key"), F.lit(step % 2 == 1).alias("odd")) for step in range(rounds)])
    place = F.struct(F.floor(value / columns).cast("long").alias("x"), (value % columns).cast("long").alias("y"))

    def move(s: Column, step: Column) -> Column:
        x = F.when(step["odd"], s["x"]).otherwise((s["x"] + mixed(s["y"], replicate, step["key"])) % rows)
        y = F.when(step["odd"], (s["y"] + mixed(s["x"], replicate, step["key"])) % columns).otherwise(s["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.aggregate(keys, place, move, lambda s: s["x"] * columns + s["y"])
