"""Sharding by extendible hashing: a directory of hash prefixes in which only oversized buckets split on another bit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.store import stable_key, stored

HASH_BITS = 60
STEP_BITS = 4
LIMIT_BYTES = 128 << 20
COPIES_CHUNK = 1000


def hash_bits(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Column:
    """The first 60 bits of the md5 of the id as a non-negative long."""
    return F.conv(F.substring(F.md5(stable_key(docs, id_col, text).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def numbered(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, hash, bytes) of every row, with hashes that tell rows of one id apart.

    One row of an id has the hash of the id. Its copies have a hash of the id, of all columns and of their number; rows of
    the id with other content have one of the id, their columns and their number. Which of some equal rows has which number
    makes no difference, so reruns give the same result. Equal rows are collapsed to a count and dealt out again, in chunks
    where they are many. Columns of map type, which cannot be grouped or hashed, are told apart by their JSON text.
    """
    maps = [c for c in docs.columns if "map<" in docs.schema[c].dataType.simpleString()]
    same = [F.to_json(F.struct(docs[c])).alias(f"__json_{k}") if c in maps else docs[c] for k, c in enumerate(docs.columns)]
    copies = F.count(F.lit(1)).alias("__copies")
    counted = docs.groupBy(*same).agg(copies, *[F.any_value(docs[c]).alias(c) for c in maps])
    row = F.struct(*[counted[c] for c in docs.columns])
    content = F.struct(*[counted[f"__json_{k}"] if c in maps else counted[c] for k, c in enumerate(docs.columns)])
    key = stable_key(counted, id_col, text)
    kinds = counted.select(row.alias("row"), key.alias("key"), F.xxhash64(content).alias("content"), hash_bits(counted, id_col, text).alias("hash"), n_bytes(counted, text).alias("bytes"), "__copies")
    kinds = stored(kinds, "shard-kinds")
    several = kinds.groupBy("hash").agg(F.count(F.lit(1)).alias("kinds"), F.min("content").alias("least")).filter("kinds > 1")
    several = stored(several.select(F.col("hash").alias("shared"), "least"), "shard-shared-ids")
    kinds = kinds.join(several, F.col("hash") == F.col("shared"), "left")
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / COPIES_CHUNK))).alias("chunk")
    many = F.col("__copies") > COPIES_CHUNK
    few = kinds.filter(~many).withColumn("chunk", F.lit(0).cast("long"))
    dealt = few.unionByName(kinds.filter(many).select("*", chunk).repartition("content", "chunk"))
    first = F.col("chunk") * COPIES_CHUNK
    last = F.least(first + COPIES_CHUNK, F.col("__copies")) - 1
    dealt = dealt.select("row", "key", "content", "hash", "bytes", "least", F.explode(F.sequence(first, last)).alias("copy"))
    own = (F.col("copy") == 0) & (F.col("content") == F.coalesce("least", "content"))
    salted = F.concat_ws("|", "content", "copy", "key")
    other = F.conv(F.substring(F.md5(salted.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")
    return dealt.select("row", F.when(own, F.col("hash")).otherwise(other).alias("hash"), "bytes")


def n_bytes(docs: DataFrame, text: str = "text") -> Column:
    return F.coalesce(F.octet_length(docs[text].cast("string")), F.lit(0)).cast("long")


def prefix(value: Column, bits: int) -> Column:
    return F.shiftright(value, HASH_BITS - bits)


def directories(sizes: DataFrame, limit: int = LIMIT_BYTES) -> list[DataFrame]:
    """The directory as one frame per pass over `sizes` (hash, bytes): slot, depth, shard_bytes.

    A pass sums the bytes at STEP_BITS more bits of the hash, for the buckets that the pass before left too large, and
    gives each slot the shallowest depth at which its bucket fits the limit. Passes end when nothing is too large.
    A bucket that no bit can split (a row above the limit) keeps all 60 bits and stays too large.
    """
    found: list[DataFrame] = []
    pending = None
    for bits in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        rows = sizes.withColumn("slot", prefix(F.col("hash"), bits))
        if pending is not None:
            rows = rows.withColumn("parent", F.shiftright("slot", STEP_BITS)).join(pending, "parent", "left_semi")
        slots = rows.groupBy("slot").agg(F.sum("bytes").alias("bytes"))
        depths = range(0 if bits == STEP_BITS else bits - STEP_BITS + 1, bits + 1)
        for depth in depths:
            bucket = Window.partitionBy(F.shiftright("slot", bits - depth))
            slots = slots.withColumn(f"bytes_{depth}", F.sum("bytes").over(bucket))
        last = bits == HASH_BITS
        fit = [F.when((F.col(f"bytes_{d}") <= limit) | F.lit(last and d == bits), d) for d in depths]
        depth = F.coalesce(*fit).cast("int")
        size = reduce(lambda rest, d: F.when(depth == d, F.col(f"bytes_{d}")).otherwise(rest), depths, F.lit(None).cast("long"))
        slots = stored(slots.select("slot", depth.alias("depth"), size.alias("shard_bytes")), "shard-slots")
        found.append(slots.filter(F.col("depth").isNotNull()))
        pending = slots.filter(F.col("depth").isNull()).select(F.col("slot").alias("parent"))
        if pending.isEmpty():
            break
    return found


def shard(docs: DataFrame, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text: str = "text", prefix_name: str = "") -> DataFrame:
    """All columns of `docs`, then shard (the bits of the bucket's prefix), shard_depth, shard_bytes, row_bytes.

    The bits come from a hash of the id, so reruns give the same shards. Null or empty text: 0 bytes. Null id: placed by
    its text. Rows of one id after the first are placed by their content and number, so they split like others; rows above
    the limit are the only ones in a shard above it, alone but for rows without bytes. Empty input: empty result. `prefix_name` goes before the four names, where they would clash with columns of `docs`.
    """
    row = stored(numbered(docs, id_col, text), "shard-rows")
    sizes = row.select("hash", "bytes")
    parts = directories(sizes, limit)
    for k, part in enumerate(parts):
        part = part.select(F.col("slot").alias(f"slot_{k}"), F.col("depth").alias(f"depth_{k}"), F.col("shard_bytes").alias(f"size_{k}"))
        row = row.withColumn(f"slot_{k}", prefix(F.col("hash"), STEP_BITS * (k + 1))).join(part, f"slot_{k}", "left")
    depth = F.coalesce(*[F.col(f"depth_{k}") for k in range(len(parts))])
    digits = F.lpad(F.bin(F.col("hash")), HASH_BITS, "0")
    return row.select(
        "row.*",
        F.substring(digits, F.lit(1), depth).alias(f"{prefix_name}shard"),
        depth.alias(f"{prefix_name}shard_depth"),
        F.coalesce(*[F.col(f"size_{k}") for k in range(len(parts))]).alias(f"{prefix_name}shard_bytes"),
        F.col("bytes").alias(f"{prefix_name}row_bytes"),
    )
