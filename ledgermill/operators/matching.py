"""Entity resolution: names contained in other names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _contained(keys: DataFrame) -> DataFrame:
    """(key1, key2): distinct keys of which one contains the other, both ways round, and every key with itself.

    A key that occurs in another is one of its substrings of that length. The lengths of keys are few, so every key is listed under its
    substrings of just these lengths (as hashes) and a containment is an equi-join instead of a cross join: apart from
    equal hashes, which are told apart afterwards, no pair is formed that is not a result.
    """
    # one row: as many lengths as the longest key has characters, at most
    lengths = keys.agg(F.sort_array(F.collect_set(F.length("key"))).alias("_lengths"))

    def substrings(size: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length("key") - size + 1)
        return F.transform(starts, lambda i: F.xxhash64(F.substring("key", i, size)))

    fitting = F.filter("_lengths", lambda size: size <= F.length("key"))
    parts = F.array_distinct(F.flatten(F.transform(fitting, substrings)))
    index = keys.crossJoin(F.broadcast(lengths)).select(F.col("key").alias("long"), F.explode(parts).alias("part"))
    whole = keys.select(F.col("key").alias("short"), F.xxhash64("key").alias("part"))
    # merged, since the sizes of files say nothing about the rows of the index
    inside = whole.join(index.hint("merge"), "part").filter(F.col("long").contains(F.col("short")))
    ways = [F.struct(F.col(a).alias("key1"), F.col(b).alias("key2")) for a, b in (("short", "long"), ("long", "short"))]
    return inside.select(F.inline(F.when(F.col("long") == F.col("short"), F.array(ways[0])).otherwise(F.array(*ways))))


def name_match_pairs(entities: DataFrame, id_col: str = "id", name_col: str = "name", first: int | None = None) -> DataFrame:
    """Ordered pairs of different entities where one lower-cased name contains the other.

    Names are matched once each, however many entities bear them; the entities are joined to the matched names
    afterwards. An empty name identifies nothing and takes no part. With ``first`` only the pairs that can
    be among that many smallest by (id1, id2) are formed: of each name the ``first + 1`` smallest identifiers.
    """
    names = entities.select(F.col(id_col).alias("id"), F.col(name_col).alias("name")).filter(F.length("name") > 0)
    keyed = names.withColumn("key", F.lower("name"))
    if first is not None:
        smallest = Window.partitionBy("key").orderBy("id")
        keyed = keyed.withColumn("_at", F.row_number().over(smallest)).filter(F.col("_at") <= first + 1).drop("_at")
    matched = _contained(keyed.select("key").distinct())

    def side(n: int) -> DataFrame:
        return keyed.select(F.col("key").alias(f"key{n}"), F.col("id").alias(f"id{n}"), F.col("name").alias(f"name{n}"))

    pairs = matched.join(side(1).hint("merge"), "key1").join(side(2).hint("merge"), "key2").filter(F.col("id1") != F.col("id2")).select("id1", "name1", "id2", "name2")
    return pairs if first is None else pairs.orderBy("id1", "id2").limit(first)
