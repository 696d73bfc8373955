from pyspark.sql import functions as F

from tidewire.llm.keymap import MAP_BITS, key_map, maybe_in


def test_a_map_has_its_keys_and_is_made_without_a_join(spark):
    keys = spark.createDataFrame([(i * 7, f"k{i % 50}") for i in range(300)] + [(None, "k"), (3, None), (3, None)], "a long, b string")
    marked = spark.range(1).select(key_map(keys).alias("words"))
    # A join is a broadcast that the driver builds, or two more shuffles.
    assert "Join" not in marked._jdf.queryExecution().toString()
    words = marked.first().words
    expected = {r.slot for r in keys.select(F.pmod(F.xxhash64("a", "b"), F.lit(1 << MAP_BITS)).alias("slot")).collect()}
    assert len(words) == 1 << (MAP_BITS - 6)
    assert {64 * i + bit for i, word in enumerate(words) if word for bit in range(64) if word >> bit & 1} == expected
    assert keys.where(~maybe_in(key_map(keys), F.col("a"), F.col("b"))).isEmpty()
    none = spark.range(1).select(key_map(keys.limit(0)).alias("words")).first().words
    assert len(none) == 1 << (MAP_BITS - 6) and not any(none)
