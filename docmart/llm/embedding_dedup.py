"""Near-duplicate embeddings: sign hashing in several tables, exact cosines, components.

Every vector gets TABLES * BITS signs, one a random hyperplane; each run of
BITS signs is its cell in one table.  Vectors of one label that share a cell
are compared:

1. Equal vectors are one class (label and 128 hash bits of the vector), with
   the number of rows; only classes go on, so exact copies never meet.
2. Members of a cell are compared by the Hamming distance of all their signs.
   A pair counts only in the first table whose cell it shares.  What leaves a
   task is the members with some such pair, not the pairs.
3. Those members get their vectors.  Cosines are taken in double precision as
   products of row blocks.  What leaves a task is one row a member: the number
   of rows it links with, and one link towards the smallest member that it
   reaches inside the task, which spans the same components as all pairs do.

A cell of more than BLOCK members is dealt by hash into blocks, and each pair
of blocks is a group of its own, so no task holds more than two blocks and a
group of near copies spreads over tasks; no pair is ever a row.  Pairs of
classes that meet in no table are not found: at a cosine of 0.93 each table
finds a pair with (1 - acos(0.93) / pi) ** BITS = 0.216, all of them together
with 0.974; at 0.97 with 0.999.  SLACK signs may differ before a pair is
dropped unseen: 180 signs of vectors at 0.93 differ in 21.6 +- 4.4.

Only equal labels and lengths are compared.  Vectors that are null, empty,
zero or hold null or non-finite components link with nothing, and neither do
rows with a null label or vec_id.  Rows are vectors of their own: repeated rows
link with each other.  Rows that share a vec_id share a component.  An empty
table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, stored

SEED = 12
BITS, TABLES, PER_LONG = 12, 15, 5           # 60 signs in each of three longs
LONGS = [f"c{i}" for i in range(TABLES // PER_LONG)]
THRESHOLD = 0.93
SLACK = 48
BLOCK = 4096
ROWS = 256                                   # rows of a block that are multiplied at once

CELL = ["label", "dim", "cell", "part_a", "part_b"]


def planes(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, BITS * TABLES))


def codes_of(x: np.ndarray) -> list[np.ndarray]:
    """The signs of each row of ``x``, PER_LONG cells in each of the longs."""
    signs = (x @ planes(x.shape[1]) > 0).reshape(len(x), len(LONGS), BITS * PER_LONG)
    weight = np.int64(1) << np.arange(BITS * PER_LONG, dtype=np.int64)
    return [signs[:, i] @ weight for i in range(len(LONGS))]


def sign_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds dim and the codes to rows with comparable vectors."""
    for batch in batches:
        vectors = batch.column("embedding")
        dims = np.diff(vectors.offsets.to_numpy())
        flat = np.asarray(vectors.flatten(), dtype=np.float64)
        starts = np.cumsum(dims) - dims
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            x = flat[starts[rows].astype(np.int64)[:, None] + np.arange(dim)]
            # scaled, so neither the largest nor the smallest components overflow
            x = x / np.abs(x).max(axis=1, keepdims=True)
            kept = batch.select(["vec_id", "label", "h1", "h2"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(np.full(len(rows), dim, np.int32)), *map(pa.array, codes_of(x))],
                names=[*kept.schema.names, "dim", *LONGS])


def whole_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sorted rows of a task, cut between cells; a frame holds at least one whole cell."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        key = frame[CELL].to_numpy(np.int64)
        changes = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
        if len(changes):
            yield frame.iloc[:changes[-1] + 1].reset_index(drop=True)
            frame = frame.iloc[changes[-1] + 1:]
        rest = frame
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def cell_numbers(frame: pd.DataFrame) -> np.ndarray:
    key = frame[CELL].to_numpy(np.int64)
    return np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])


def first_shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The first table in which the codes a and b share their cell (TABLES: none)."""
    out = np.full(np.broadcast_shapes(a[0].shape, b[0].shape), TABLES, np.int8)
    for t in reversed(range(TABLES)):
        field = np.int64((1 << BITS) - 1) << np.int64(BITS * (t % PER_LONG))
        out[(a[t // PER_LONG] ^ b[t // PER_LONG]) & field == 0] = t
    return out


def with_partner(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The members that have a likely partner in their cell, in the first table that the two share."""
    for frame in whole_cells(frames):
        number = cell_numbers(frame)
        code = [frame[c].to_numpy(np.int64) for c in LONGS]
        table = frame["cell"].to_numpy(np.int64) >> BITS
        block = frame["block"].to_numpy(np.int32)
        across = (frame["part_a"] != frame["part_b"]).to_numpy()
        found = np.zeros(len(frame), bool)
        left, shift = np.arange(len(frame)), 0
        while len(left):
            shift += 1
            left = left[left + shift < len(frame)]
            left = left[number[left] == number[left + shift]]
            right = left + shift
            apart = sum(np.bitwise_count(c[left] ^ c[right]) for c in code)
            near = (apart <= SLACK) & ~(across[left] & (block[left] == block[right]))
            i, j = left[near], right[near]
            i, j = (x[first_shared([c[i] for c in code], [c[j] for c in code]) == table[i]] for x in (i, j))
            found[i] = found[j] = True
        yield frame[found]


def block_links(x: np.ndarray, code: list[np.ndarray], table: int, block: np.ndarray, across: bool,
                rows: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each member of one cell: the number of rows that it links with, the smallest member that it reaches."""
    n = len(x)
    linked = []
    count = np.zeros(n, np.int64)
    for i in range(0, n, ROWS):
        link = x[i:i + ROWS] @ x.T >= threshold
        link[np.arange(len(link)), np.arange(i, i + len(link))] = False
        if across:
            link &= block[i:i + ROWS, None] != block[None]
        a, b = np.nonzero(link)
        first = first_shared([c[i + a] for c in code], [c[b] for c in code]) == table
        link[a[~first], b[~first]] = False
        count[i:i + ROWS] = link @ rows
        linked.append(np.packbits(link, axis=1))
    reach = np.arange(n)
    while True:
        before = reach.copy()
        for k, bits in enumerate(linked):
            i = k * ROWS
            link = np.unpackbits(bits, axis=1, count=n).astype(bool)
            reach[i:i + len(link)] = np.minimum(reach[i:i + len(link)], np.where(link, reach[None], n).min(axis=1))
        reach = reach[reach]
        if (reach == before).all():
            return count, reach


def verified(threshold: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_cells(frames):
            number = cell_numbers(frame)
            for members in np.split(np.arange(len(frame)), np.flatnonzero(np.diff(number)) + 1):
                if len(members) < 2:
                    continue
                f = frame.iloc[members]
                x = np.stack(f["embedding"].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                count, reach = block_links(
                    x, [f[c].to_numpy(np.int64) for c in LONGS], int(f["cell"].iat[0]) >> BITS,
                    f["block"].to_numpy(np.int32), f["part_a"].iat[0] != f["part_b"].iat[0],
                    f["n"].to_numpy(np.int64), threshold)
                some = count > 0
                yield pd.DataFrame({"vec_id": f["vec_id"].to_numpy()[some], "h1": f["h1"].to_numpy()[some],
                                    "h2": f["h2"].to_numpy()[some], "links": count[some],
                                    "towards": f["vec_id"].to_numpy()[reach][some]})
    return run


def comparable() -> Column:
    """Rows that may link: a label, an id, and a vector of finite components that are not all zero."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite
                      & F.exists("embedding", lambda v: v != 0), F.lit(False))


def members_of_cells(classes: DataFrame) -> DataFrame:
    """One row per class, table and pair of blocks of its cell (one pair where the cell is no larger than BLOCK)."""
    cells = F.array(*[(F.lit(t << BITS) + F.shiftrightunsigned(LONGS[t // PER_LONG], BITS * (t % PER_LONG))
                       .bitwiseAND((1 << BITS) - 1)).cast("int") for t in range(TABLES)])
    members = classes.withColumn("cell", F.explode(cells))
    large = stored(members.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("size")).where(f"size > {BLOCK}")
                   .select("label", "dim", "cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "large_cells")
    dealt = members.join(large, ["label", "dim", "cell"], "left").withColumn(
        "block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod("h1", F.col("blocks"))).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    return (dealt.withColumn("other", others)
            .withColumn("part_a", F.least("block", "other")).withColumn("part_b", F.greatest("block", "other"))
            .select(*CELL, "block", "vec_id", "h1", "h2", "n", *LONGS))


def by_cell(df: DataFrame) -> DataFrame:
    return df.repartition(*CELL).sortWithinPartitions(*CELL)


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    hashed = embeddings.select("vec_id", "label", "embedding", comparable().alias("fine"), F.xxhash64("embedding").alias("h1"),
                               F.xxhash64(F.lit(SEED), "embedding").alias("h2"))
    kinds = dict(hashed.dtypes)
    head = f"vec_id {kinds['vec_id']}, label {kinds['label']}, h1 long, h2 long"
    longs = ", ".join(f"{c} long" for c in LONGS)
    codes = stored(hashed.where("fine").drop("fine").mapInArrow(sign_codes, f"{head}, dim int, {longs}"), "codes")
    same = ["label", "h1", "h2"]
    classes = stored(codes.groupBy(*same).agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n"),
        F.max(F.struct("dim", *LONGS)).alias("code")).select("vec_id", "n", *same, "code.*"), "classes")

    member = ["block", "vec_id", "h1", "h2", "n", *LONGS]
    cells = by_cell(members_of_cells(classes))
    kept = stored(cells.mapInPandas(with_partner, cells.select(*CELL, *member).schema), "partners")
    vectors = hashed.where("fine").select("vec_id", "h1", "h2", "embedding") \
        .join(kept.select("vec_id", "h1", "h2").distinct(), ["vec_id", "h1", "h2"], "left_semi") \
        .dropDuplicates(["vec_id", "h1", "h2"])
    found = stored(by_cell(kept.join(vectors, ["vec_id", "h1", "h2"])).mapInPandas(
        verified(threshold), f"vec_id {kinds['vec_id']}, h1 long, h2 long, links long, towards {kinds['vec_id']}"),
        "embedding_links")

    # a vec_id on rows with different vectors joins their components
    rows = codes.select(F.col("vec_id").alias("id"), *same).join(
        classes.select(*same, "vec_id", "n"), same)
    several = rows.groupBy("id").agg(F.min("vec_id").alias("low"), F.max("vec_id").alias("high")).where("low <> high")
    links = found.select(F.col("vec_id").alias("a"), F.col("towards").alias("b")).where("a <> b").union(
        rows.join(several.select("id"), "id", "left_semi").select("id", "vec_id").where("id <> vec_id"))
    part = components(links)
    counted = found.groupBy("vec_id", "h1", "h2").agg(F.sum("links").alias("links"))
    of_class = classes.join(counted, ["vec_id", "h1", "h2"], "left").join(
        part.withColumnRenamed("node", "vec_id"), "vec_id", "left").select(
        *same, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"))
    return (hashed.select("vec_id", "fine", *same).join(of_class, same, "left")
            .select("vec_id", F.when(F.col("fine"), F.col("n_links")).otherwise(0).alias("n_links"),
                    F.when(F.col("fine"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
