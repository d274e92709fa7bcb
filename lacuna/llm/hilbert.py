"""Sharding along a Hilbert curve over document metadata (operator 9).

Language, length and number of lines are quantised to 16 steps each; the cell of a document is
a point of a three-dimensional Hilbert curve, and shards are runs of that order, so each shard
covers a compact box of the metadata.  ``write`` puts the shards into files in that order, with the
least and greatest value of each dimension per shard beside them, so a reader can skip shards.
Languages take steps in their order; more than 16 share steps with their neighbours.  Within a
cell texts are ordered by their CRC, so equal texts lie side by side.

No task sorts the table.  Rows are counted by (cell, leading bits of the CRC, CRC, salt); running
sums over those counts give each group's first rank; a row adds its place in its own group.  The
number of leading bits and of salts follows the row count, so neither a cell nor a text that holds
a third of all rows is ranked in one piece.  Law ``rows``: shard counts differ by one at most.

Cases: a null or empty text has size 1 and the CRC of no bytes; a null language is a value of
its own (the last); rows alike in all fields are placed in any order among themselves; an empty
table gives no rows; extra columns are not read by ``shard`` and pass through ``write``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.llm.common import small, stash
from lacuna.llm.mixing import ranked_sources

DIM_BITS = 4
DIMS = 3
STEPS = 1 << DIM_BITS


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place of a cell on the Hilbert curve: undo the rotations from the highest bit down, then
    Gray-decode and interleave the axes."""
    x, n = list(point), len(point)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                swap = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = 0
    q = top
    while q > 1:
        if x[n - 1] & q:
            flip ^= q - 1
        q >>= 1
    index = 0
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | ((x[i] ^ flip) >> b & 1)
    return index


def curve_cells(bits: int = DIM_BITS, dims: int = DIMS) -> list[tuple[int, int]]:
    """(packed cell, curve index) of every cell: 2^(bits*dims) pairs, 4,096 by default."""
    side = 1 << bits
    out = []
    for cell in range(side ** dims):
        point = tuple(cell >> (bits * (dims - 1 - i)) & (side - 1) for i in range(dims))
        out.append((cell, hilbert_index(point, bits)))
    return out


def bit_step(n: Column, first: int) -> Column:
    """Binary length of a positive integer, moved and clipped to 16 steps."""
    return F.least(F.lit(15), F.greatest(F.lit(0), F.length(F.bin(n)) - first)).cast("int")


def id_hash(doc_id: Column) -> Column:
    key = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("long")


def language_steps(rows: DataFrame) -> tuple[DataFrame, int]:
    """(__lang, step) of every language, and how many there are."""
    langs = stash(ranked_sources(rows.groupBy(F.col("lang").alias("source")).agg(F.count("*").alias("source_size"))))
    n = langs.count()
    step = F.col("rank") if n <= STEPS else F.floor(F.col("rank") * STEPS / n)
    return langs.select(F.col("source").alias("__lang"), step.cast("int").alias("step")), n


def ranked(docs: DataFrame, shards: int, group_rows: int, carried: tuple = ()) -> DataFrame:
    """Per row doc_id, size, crc, lang, lines, rank, shard, slot and the ``carried`` columns."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stash(docs.select(
        "doc_id", F.col("lang"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("crc"),
        (F.length(F.coalesce("text", F.lit(""))) - F.length(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(""))) + 1)
        .cast("long").alias("lines"), id_hash(F.col("doc_id")).alias("idh"), *carried))
    n_rows = rows.count()
    salts, bits = 32, 6
    while n_rows > 3 * salts * group_rows:  # a third of all rows may share one text
        salts *= 2
    while n_rows > (group_rows << bits) and bits < 32:  # or one cell
        bits += 1
    langs, n_langs = language_steps(rows)
    cell = (F.col("step") * STEPS * STEPS + bit_step(F.col("size"), 4) * STEPS + bit_step(F.col("lines"), 1)).cast("int")
    curve = F.broadcast(spark.createDataFrame(curve_cells(), "cell int, h int"))  # 4,096 rows
    placed = stash(rows.join(small(langs, n_langs), rows["lang"].eqNullSafe(F.col("__lang"))).withColumn("cell", cell).join(curve, "cell").select(
        "doc_id", "lang", "size", "lines", "crc", "idh", "h", F.shiftright("crc", 32 - bits).alias("tb"), (F.col("idh") % salts).alias("salt"), *carried))
    groups = stash(placed.groupBy("h", "tb", "crc", "salt").agg(F.count("*").alias("n")))

    def before(*keys, of):
        """Rows before each value of ``of`` among the groups of equal ``keys``: one short window
        per level, so no task holds all groups of a hot cell."""
        w = Window.partitionBy(*keys).orderBy(*of).rowsBetween(Window.unboundedPreceding, -1)
        per = groups.groupBy(*keys, *of).agg(F.sum("n").alias("n"))
        return per.select(*keys, *of, F.coalesce(F.sum("n").over(w), F.lit(0)).alias(f"first_{of[0]}"))

    cells, buckets = before(of=("h",)), stash(before("h", of=("tb",)))  # at most 4,096 rows in the window of cells
    first = stash(before("h", "tb", of=("crc", "salt")).join(small(buckets, buckets.count()), ["h", "tb"]).join(F.broadcast(cells), "h")
                  .select("h", "tb", "crc", "salt", (F.col("first_h") + F.col("first_tb") + F.col("first_crc")).alias("first")))
    keys = ["h", "tb", "crc", "salt"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("idh", "doc_id", "size")) - 1
    n = max(n_rows, 1)
    out = (placed.withColumn("place", place).join(small(first, first.count()), keys).withColumn("rank", F.col("first") + F.col("place"))
           .withColumn("shard", F.floor(F.col("rank").cast("decimal(38,0)") * shards / n).cast("int")))
    begin = F.ceil(F.col("shard").cast("decimal(38,0)") * n / shards).cast("long")
    return out.select("doc_id", "size", "crc", "lang", "lines", "rank", "shard", (F.col("rank") - begin).alias("slot"), *carried)


def shard(docs: DataFrame, shards: int = 8, group_rows: int = 4096) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    return ranked(docs, shards, group_rows).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write(docs: DataFrame, folder: str, shards: int = 8, group_rows: int = 4096) -> DataFrame:
    """Write the rows of ``docs`` as Parquet under ``folder``/data, a directory per shard, files and rows in
    slot order; and ``folder``/bounds, which is returned: per shard its rows and the least and greatest
    language, size and number of lines."""
    rows = stash(ranked(docs.select("doc_id", "lang", "text", F.struct("*").alias("__row")), shards, group_rows, ("__row",)))
    (rows.repartitionByRange("rank").sortWithinPartitions("rank").select("__row.*", F.col("shard").alias("__shard"))
     .write.partitionBy("__shard").parquet(f"{folder}/data"))
    bounds = rows.groupBy("shard").agg(F.count("*").alias("rows"), *[x for c in ("lang", "size", "lines") for x in (
        F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])
    bounds.write.parquet(f"{folder}/bounds")
    return docs.sparkSession.read.parquet(f"{folder}/bounds")
