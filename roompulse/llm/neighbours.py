"""Approximate nearest neighbours by cross-polytope hashing, with exact reranking.

Largest inner product becomes largest cosine by one more coordinate: a candidate x is (x / M, sqrt(1 - |x|^2 / M^2)), a
query is (q / |q|, 0).  M is the largest norm of x's band: norms within a factor of NORM_STEP are a band with cells of its
own, so the last coordinate stays small and one large vector does not crowd the others into a few cells.  A query probes
every band, and all it meets is reranked together.  Bands of few vectors are met whole.

In each table a pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns the vector, and its
cell is the nearest signed axis.  A query probes, in every table, the axes nearest to it.  How many tables and probes is
fitted for each length of vectors, at every size: up to SAMPLE queries are compared with all vectors; for each number of
tables the fewest probes are taken with which their mean recall, less two standard errors, is at least RECALL, and of
those the numbers that touch the fewest vectors.  A query always meets its own vector; one that meets fewer than k + 1
entries probes all cells of the first table.

Cells are dealt into bins of about ``BLOCK`` vectors (a large cell into several blocks), so a query travels once to a bin
with the cells it probes there, however small they are.  In a bin only the vectors of those cells are met.  Equal vectors
are one entry, so a very common vector is no hot cell; each keeps its ``k + 1`` smallest ids, which is all that can be
among any query's k nearest.  A pair of blocks is one matrix product; what leaves the task is the best of it, with all
that lies within rounding of the last.  Scores of those are summed in double precision on the original vectors, in one
fixed order.

Defined results: vectors that are null, zero, or hold null or non-finite components, and rows without vec_id, take no
part; vectors of different lengths do not meet; repeated rows count once, and of several vectors of one vec_id the smallest
counts; ties go to the smaller vec_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm.tables import batches, stored, table

K = 20
QUERY_STEP = 20
#: Numbers of tables that are tried.
TABLES = (1, 2, 4, 8)
#: The fit of the probes: mean recall of the sampled queries of a length, less two standard errors, and their number.
RECALL = 0.95
SAMPLE = 128
#: Largest norm of a band over its smallest, at most.
NORM_STEP = 1.15
#: A band of at most so many vectors is met whole by every query of its length.
FEW = 256
#: Vectors of a bucket in one block, on the candidates' and on the queries' side.
BLOCK = 2_048
QUERY_BLOCK = 256

_MEMBER_ARROW = pa.schema([("dim", pa.int32()), ("bin", pa.int64()), ("cell", pa.int32()), ("entry", pa.int64()), ("packed", pa.binary())])
_MEMBER_DDL = "dim int, bin bigint, cell int, entry bigint, packed binary"
_ASKING_ARROW = pa.schema([("dim", pa.int32()), ("bin", pa.int64()), ("entry", pa.int64()), ("probed", pa.binary()), ("packed", pa.binary())])
_ASKING_DDL = "dim int, bin bigint, entry bigint, probed binary, packed binary"
_FOUND_ARROW = pa.schema([("query", pa.int64()), ("entry", pa.int64()), ("score", pa.float64())])
_FOUND_DDL = "query bigint, entry bigint, score double"
_DEPTH_ARROW = pa.schema([("dim", pa.int32()), ("query", pa.int64()), ("depths", pa.list_(pa.int64()))])
_DEPTH_DDL = "dim int, query bigint, depths array<bigint>"
#: The bins of vectors that are met whole lie from here downwards, below those of all bands.
WHOLE = -(1 << 60)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal fast Hadamard transform of each row; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    signs = np.random.Generator(np.random.PCG64(7919 + number)).choice([-1.0, 1.0], (3, x.shape[1]))
    for row in signs:
        x = hadamard(x * row)
    return x


def padded(x: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Unit vectors with the last coordinate behind them, up to a power of two."""
    out = np.zeros((len(x), 1 << int(x.shape[1]).bit_length()))
    out[:, : x.shape[1]], out[:, x.shape[1]] = x, last
    return out


def signed_axes(y: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest signed axes of each row, as 2 * axis + (1 if positive)."""
    both = np.stack([-y, y], axis=2).reshape(len(y), -1)
    if count >= both.shape[1]:
        return np.broadcast_to(np.arange(both.shape[1]), both.shape)
    return np.argpartition(-both, count - 1, axis=1)[:, :count]


def measured(heads: DataFrame) -> DataFrame:
    """(entry, vector, dim, norm, band) of (entry, vector)."""
    most = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x / F.col("most")) * (x / F.col("most")))
    sized = heads.select("entry", "vector", F.size("vector").alias("dim"), most.alias("most")).withColumn("spread", F.sqrt(squares))
    band = F.round((F.log("most") + F.log("spread")) / float(np.log(NORM_STEP))).cast("int")
    return sized.select("entry", "vector", "dim", (F.col("most") * F.col("spread")).alias("norm"), band.alias("band"))


@dataclass
class Bands:
    """The vectors of one length: the vectors met whole and their bands, size and largest norm of each probed band, tables and probes."""

    n_whole: int
    whole: set[int]
    sizes: dict[int, int]
    largest: dict[int, float]
    tables: int = 1
    probes: int = 1

    @property
    def parts(self) -> int:
        """Into how many bins the vectors met whole are dealt."""
        return -(-self.n_whole // BLOCK)

    def share(self, dim: int) -> float:
        """Of a band's vectors, the share that the probes of all tables touch at most."""
        return min(1.0, self.tables * self.probes / (2 * width(dim)))


def width(dim: int) -> int:
    return 1 << dim.bit_length()


def bin_cells(n: int, cells: int) -> int:
    """How many neighbouring cells of a band of n vectors are one bin: a power of two."""
    return 1 << max(0, min(cells, cells * BLOCK // n).bit_length() - 1)


def banded(heads: DataFrame) -> dict[int, Bands]:
    """The bands of each length; heads: (dim, norm, band)."""
    out: dict[int, Bands] = {}
    for row in heads.groupBy("dim", "band").agg(F.count("*").alias("n"), F.max("norm").alias("largest")).collect():
        own = out.setdefault(row["dim"], Bands(0, set(), {}, {}))
        if row["n"] <= FEW:
            own.whole.add(row["band"])
            own.n_whole += row["n"]
        else:
            own.largest[row["band"]], own.sizes[row["band"]] = row["largest"], row["n"]
    return out


def fewest_probes(depths: list[list[int]]) -> int:
    """The fewest probes that reach RECALL; depths: of each sampled query, how many probes find each of its neighbours."""
    for count in sorted({depth for own in depths for depth in own}):
        recall = np.array([np.mean(np.array(own) <= count) for own in depths])
        if recall.mean() - 2 * recall.std() / np.sqrt(len(recall)) >= RECALL:
            return count
    return 1


def fitted(heads: DataFrame, asked: DataFrame, lengths: dict[int, Bands], k: int) -> dict[int, Bands]:
    """``lengths`` with the tables and probes that the sampled queries need."""
    wanted = [dim for dim, own in lengths.items() if own.largest]
    if not wanted:
        return lengths
    drawn = asked.where(F.col("dim").isin(wanted)).withColumn("score", F.xxhash64("entry"))
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    rows_of: dict[int, list] = {}
    for row in top(drawn, "dim", "entry", SAMPLE).select("dim", "entry", "vector").collect():  # at most SAMPLE a length
        rows_of.setdefault(row["dim"], []).append(row)
    for dim, own in rows_of.items():
        sample[dim] = np.array([r["entry"] for r in own]), np.array([r["vector"] for r in own], np.float64)
    shared = heads.sparkSession.sparkContext.broadcast(sample)

    def scores(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for part in parts:
            ids = part.column("entry").to_numpy()
            for dim, some, x in matrices(part):
                if dim in shared.value:
                    queries, y = shared.value[dim]
                    score, entry = y @ x.T, np.broadcast_to(ids[some], (len(y), len(x)))
                    if dim in held:
                        score, entry = np.hstack([held[dim][0], score]), np.hstack([held[dim][1], entry])
                    best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
                    held[dim] = np.take_along_axis(score, best, 1), np.take_along_axis(entry, best, 1)
        for dim, (score, entry) in held.items():
            for query, own, others in zip(shared.value[dim][0].tolist(), score.tolist(), entry.tolist()):
                yield from ((query, other, value) for other, value in zip(others, own))

    def depths(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            asking, ids, bands = (part.column(c).to_numpy() for c in ("query", "entry", "band"))
            for dim, some, x in matrices(part):
                own, (queries, y) = lengths[dim], shared.value[dim]
                place = {q: i for i, q in enumerate(queries.tolist())}
                unit = unit_rows(y)
                at = np.array([place[q] for q in asking[some].tolist()])
                depth = np.full((len(some), max(TABLES)), 1)
                for band in set(bands[some].tolist()) - own.whole:
                    rows = np.flatnonzero(bands[some] == band)
                    for number, cell in enumerate(axes(*scaled(x[rows], own.largest[band]), 1, max(TABLES))):
                        turned = rotated(padded(unit, np.zeros(len(unit))), number)
                        both = np.stack([-turned, turned], axis=2).reshape(len(turned), -1)[at[rows]]
                        depth[rows, number] = (both > np.take_along_axis(both, cell, 1)).sum(axis=1) + 1
                least = np.minimum.accumulate(depth, axis=1)
                for query, values in zip(asking[some].tolist(), least[:, [t - 1 for t in TABLES]].tolist()):
                    yield dim, query, values

    found = heads.where(F.col("dim").isin(wanted)).select("entry", "vector").mapInArrow(lambda parts: batches(_FOUND_ARROW, scores(parts)), _FOUND_DDL)
    true = top(found.where(F.col("query") != F.col("entry")), "query", "entry", k)
    deep = true.join(heads, "entry").select("query", "entry", "band", "vector").mapInArrow(lambda parts: batches(_DEPTH_ARROW, depths(parts)), _DEPTH_DDL)
    needed: dict[int, dict[int, list[list[int]]]] = {}
    for row in deep.collect():  # at most SAMPLE * k a length
        needed.setdefault(row["dim"], {}).setdefault(row["query"], []).append(row["depths"])
    out = dict(lengths)
    for dim in wanted:
        depths_of = list(needed.get(dim, {}).values())
        tried = [(t, fewest_probes([[d[i] for d in own] for own in depths_of])) for i, t in enumerate(TABLES)]
        tables, count = min(tried, key=lambda x: x[0] * x[1])
        out[dim] = replace(lengths[dim], tables=tables, probes=count)
    return out


def all_probes(dim: int, own: Bands) -> Bands:
    return replace(own, tables=1, probes=2 * width(dim))


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrices(part: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The length, rows and vectors of pieces of a batch with a vector column, by length."""
    vectors = part.column("vector")
    sizes = vectors.value_lengths().to_numpy()
    for dim in np.unique(sizes):
        own = np.flatnonzero(sizes == dim)
        for at in range(0, len(own), 1_024):
            some = own[at : at + 1_024]
            yield int(dim), some, np.array([vectors[int(i)].as_py() for i in some], np.float64)


def scaled(x: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of a band by its largest norm, and the coordinate that makes them unit vectors."""
    x = x / largest
    return x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))


def axes(x: np.ndarray, last: np.ndarray, count: int, tables: int) -> Iterator[np.ndarray]:
    """Of each table, the nearest signed axes of unit vectors."""
    unit = padded(x, last)
    for number in range(tables):
        yield signed_axes(rotated(unit, number), count)


def first_bin(band: int, table_: int, dim: int) -> int:
    """Where the bins of a band and table begin; a bin's number is that of its first cell."""
    return (band * max(TABLES) + table_) * 2 * width(dim)


def members_of(heads: DataFrame, lengths: dict[int, Bands]) -> DataFrame:
    """(dim, bin, cell, entry, packed) of candidates (entry, vector, band), once a table; cells count from the bin's first.

    Those met whole lie in cell 0 of one of the bins below; lengths not given take no part.
    """

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            ids, bands = part.column("entry").to_numpy(), part.column("band").to_numpy()
            for dim, some, x in matrices(part):
                if dim not in lengths:
                    continue
                own, entries, in_band = lengths[dim], ids[some], bands[some]
                for band in np.unique(in_band).tolist():
                    at = np.flatnonzero(in_band == band)
                    if band in own.whole:
                        for i in at.tolist():
                            yield dim, WHOLE - int(entries[i]) % own.parts, 0, int(entries[i]), x[i].tobytes()
                        continue
                    step = bin_cells(own.sizes[band], 2 * width(dim))
                    for number, cells in enumerate(axes(*scaled(x[at], own.largest[band]), 1, own.tables)):
                        base = first_bin(band, number, dim)
                        for i, cell in zip(at.tolist(), cells[:, 0].tolist()):
                            yield dim, base + cell // step * step, cell % step, int(entries[i]), x[i].tobytes()

    return heads.select("entry", "vector", "band").mapInArrow(lambda parts: batches(_MEMBER_ARROW, rows(parts), 5_000), _MEMBER_DDL)


def asking_of(asked: DataFrame, lengths: dict[int, Bands]) -> DataFrame:
    """(dim, bin, entry, probed, packed) of queries (entry, vector): the bins they probe, and a byte for each cell there, 1 where probed."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            ids = part.column("entry").to_numpy()
            for dim, some, x in matrices(part):
                if dim not in lengths:
                    continue
                own, entries = lengths[dim], ids[some].tolist()
                packed = [row.tobytes() for row in x]
                for i, entry in enumerate(entries):
                    for number in range(own.parts):
                        yield dim, WHOLE - number, entry, b"\1", packed[i]
                if not own.largest:
                    continue
                cells = 2 * width(dim)
                for number, near in enumerate(axes(unit_rows(x), np.zeros(len(x)), own.probes, own.tables)):
                    probed = np.zeros((len(x), cells), np.uint8)
                    np.put_along_axis(probed, near, 1, axis=1)
                    for band, n in own.sizes.items():
                        step, base = bin_cells(n, cells), first_bin(band, number, dim)
                        by_bin = probed.reshape(len(x), -1, step)
                        for i, place in zip(*(a.tolist() for a in np.nonzero(by_bin.any(axis=2)))):
                            yield dim, base + place * step, entries[i], by_bin[i, place].tobytes(), packed[i]

    return asked.select("entry", "vector").mapInArrow(lambda parts: batches(_ASKING_ARROW, rows(parts), 5_000), _ASKING_DDL)


def met(heads: DataFrame, asked: DataFrame, lengths: dict[int, Bands], best: int) -> DataFrame:
    """(query, entry, score): the best of what each query meets."""
    others = blocked(members_of(heads, lengths), ("entry", "cell", "packed"), BLOCK, "others")
    asking = blocked(asking_of(asked, lengths), ("entry", "probed", "packed"), QUERY_BLOCK, "queries")
    # Spark takes a list for one element when it judges sizes, and would send whole blocks through the driver.
    found = reranked(others.join(asking.hint("merge"), ["dim", "bin"]), best)
    return top(found.groupBy("query", "entry").agg(F.max("score").alias("score")), "query", "entry", best).drop("rank")


def selves(asked: DataFrame) -> DataFrame:
    """(query, entry, score) of each query and its own vector, summed as in ``reranked``."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            ids = part.column("entry").to_numpy()
            for _, some, x in matrices(part):
                for entry, score in zip(ids[some].tolist(), (x * x).sum(axis=1).tolist()):
                    yield entry, entry, score

    return asked.select("entry", "vector").mapInArrow(lambda parts: batches(_FOUND_ARROW, rows(parts)), _FOUND_DDL)


def blocked(rows: DataFrame, columns: tuple[str, ...], size: int, name: str) -> DataFrame:
    """The rows of each bin in blocks of about ``size``, made and met where one shuffle has brought the bin."""
    counts = rows.groupBy("dim", "bin").agg(F.count("*").alias("n"))
    dealt = rows.repartition("dim", "bin").join(counts, ["dim", "bin"]).withColumn("block", F.pmod(F.xxhash64("entry"), F.ceil(F.col("n") / size)))
    return dealt.groupBy("dim", "bin", "block").agg(F.collect_list(F.struct(*columns)).alias(name)).drop("block")


def reranked(pairs: DataFrame, best: int) -> DataFrame:
    """(query, entry, score): the best of each query in each pair of blocks, among the cells it probes.

    The products only choose; what lies within their rounding of the last one chosen is kept as well.
    """

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for dim, queries, others in zip(part.column("dim").to_pylist(), part.column("queries"), part.column("others")):
                queries, others = queries.values, others.values
                ids, cells = (others.field(c).to_numpy() for c in ("entry", "cell"))
                asking = queries.field("entry").to_pylist()
                y, x = (np.frombuffer(b"".join(v.field("packed").to_pylist()), np.float64).reshape(-1, dim) for v in (others, queries))
                probed = np.frombuffer(b"".join(queries.field("probed").to_pylist()), np.uint8).reshape(len(asking), -1)
                scores = x @ y.T
                rounding = 4 * dim * np.finfo(np.float64).eps * np.abs(x) @ np.abs(y).max(axis=0)
                for i, query in enumerate(asking):
                    near = np.flatnonzero(probed[i][cells])
                    if len(near) > best:
                        row = scores[i][near]
                        near = near[row >= np.partition(row, len(row) - best)[len(row) - best] - rounding[i]]
                    exact = (y[near] * x[i]).sum(axis=1)
                    for entry, score in zip(ids[near].tolist(), exact.tolist()):
                        yield query, entry, score

    return pairs.select("dim", "queries", "others").mapInArrow(lambda parts: batches(_FOUND_ARROW, rows(parts)), _FOUND_DDL)


def clean_vectors(rows: DataFrame, name: str = "embedding") -> DataFrame:
    vector = F.col(name).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    own = rows.where(F.col("vec_id").isNotNull() & F.col(name).isNotNull()).where(finite & F.exists(vector, lambda x: x != 0))
    plain = own.select(F.col("vec_id").cast("long"), F.transform(vector, lambda x: x + F.lit(0.0)).alias("vector"))
    return plain.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def top(rows: DataFrame, key: str, member: str, count: int) -> DataFrame:
    """The ``count`` best by score of each key, ties to the smaller member, with their rank from 1."""
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), member)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of each query; both (vec_id, vector), queries among the vectors."""
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    ranked = vectors.withColumn("nth", F.row_number().over(by_vector)).where(F.col("nth") <= k + 1)
    members = stored(ranked.withColumn("entry", F.min("vec_id").over(Window.partitionBy("vector"))), "neighbour-members")
    heads = stored(measured(members.where(F.col("nth") == 1).select("entry", "vector")), "neighbour-heads")
    asked = stored(queries.join(members.where(F.col("nth") == 1).select("vector", "entry"), "vector").select("vec_id", "entry"), "neighbour-queries")
    asked_heads = stored(heads.join(asked.select("entry").distinct(), "entry", "left_semi"), "neighbour-asked")
    lengths = fitted(heads, asked_heads, banded(heads), k)
    found = stored(met(heads, asked_heads, lengths, k + 1), "neighbour-found")
    counts = found.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") > k)
    open_lengths = {dim: all_probes(dim, own) for dim, own in lengths.items() if own.largest}
    short = asked_heads.where(F.col("dim").isin(list(open_lengths))).join(counts, F.col("entry") == F.col("query"), "left_anti")
    short = stored(short, "neighbour-short")
    found = found.unionByName(selves(asked_heads))
    if not short.isEmpty():
        found = found.unionByName(met(heads, short, open_lengths, k + 1))
    best = top(found.groupBy("query", "entry").agg(F.max("score").alias("score")), "query", "entry", k + 1).drop("rank")
    ids = members.select("entry", F.col("vec_id").alias("member"))
    listed = top(best.join(ids, "entry").select("query", "member", "score"), "query", "member", k + 1).drop("rank")
    answers = asked.join(listed, F.col("entry") == F.col("query")).where(F.col("member") != F.col("vec_id"))
    answers = top(answers.select(F.col("vec_id").alias("query_id"), F.col("member").alias("vec_id"), "score"), "query_id", "vec_id", k)
    return answers.select("query_id", "rank", "vec_id", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stored(clean_vectors(table(spark, sf_dir, "embeddings")), "neighbour-vectors")
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))
