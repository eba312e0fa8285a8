"""Near-duplicate removal: MinHash bands, odd sketches, and an exact check of full shingle sets.

A document's set holds its distinct shingles of ``size`` words; a shorter text is one shingle.
Documents with equal sets form a class and are one from there on, the least id standing for them.
Each class gets ``BANDS`` x ``ROWS`` MinHash samples. Classes that share a band are candidates; all
samples of a class are also folded into a parity bitmap, its odd sketch. The population count of
the XOR of two sketches estimates their similarity, precisely where it is high, and candidates
that fall clearly short go no further. All others are compared on their full sets.

Classes are linked in two rounds, so that a large group of near copies needs no comparison of all
its pairs. First every class meets two hubs, a hub being the least class of a band: the one with
which it shares most bands and the least of all. Linked classes form components. Then classes of
one band but of different components meet each other. A pair of one component is never compared,
and a pair of two components always is: no link that could join two components is lost.

A band on very many classes is split: its largest component is dealt into blocks that each meet
all other members, and the others meet each other in blocks.

With 40 bands of 5 samples a pair of similarity 0.8 misses all bands once in 8 million; the sketch
drops it less often than that.

Ids must be integers; a null id is linked with nothing and kept. Null and empty texts and texts
without words have empty sets: they are linked with nothing, and each is kept. Texts of any length
count whole. Rows of one id are one document if their sets are equal; else each has its own set,
and links of either are links of the id. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import words as w
from shelfwise.llm.common import arrow_map, arrow_schema, stored
from shelfwise.operators.joins import small_side

BANDS, ROWS = 40, 5
SKETCH_WORDS = 16  # of 64 bits
BITS = 64 * SKETCH_WORDS
BLOCK = 500  # classes of a band that meet in one task at a time
SLACK = 0.2  # the sketch drops candidates this far below the threshold
CLASS = ["_s1", "_s2"]


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = w.mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
    return (draw[::2].astype(np.uint32) | np.uint32(1)), draw[1::2].astype(np.uint32)


TIMES, PLUS = multipliers()


class Shingles:
    """The distinct shingles of each text of a slice, sorted: ``codes`` cut at ``bounds``."""

    def __init__(self, texts: w.Texts, size: int):
        starts, ends, first = texts.words()
        n = np.diff(first)
        sequence = w.Sequences(texts.hashes(starts, ends))
        at = w.windows(first, size)
        owner = w.owners(first)[at]
        codes = sequence.hashes(at, size)
        short = np.flatnonzero((n > 0) & (n < size))
        owner = np.concatenate([owner, short])
        codes = np.concatenate([codes, sequence.hashes(first[short], n[short])])
        order = np.lexsort((codes, owner))
        owner, codes = owner[order], codes[order]
        fresh = np.ones(len(codes), dtype=bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
        self.codes, self.owner = codes[fresh], owner[fresh]
        self.bounds = np.searchsorted(self.owner, np.arange(len(texts) + 1))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit names of each set."""
        out = []
        for salt in (np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xC2B2AE3D27D4EB4F)):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.mix(self.codes ^ salt))])
            out.append(w.mix(sums[self.bounds[1:]] - sums[self.bounds[:-1]] + self.sizes.astype(np.uint64)))
        return out[0].view(np.int64), out[1].view(np.int64)


def signatures(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples, one row per set; sets must not be empty."""
    x = (w.mix(codes) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, BANDS * ROWS), dtype=np.uint32)
    held = np.empty_like(x)
    for i, (times, plus) in enumerate(zip(TIMES, PLUS)):
        np.multiply(x, times, out=held)
        np.add(held, plus, out=held)
        out[:, i] = np.minimum.reduceat(held, bounds[:-1])
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per set and band."""
    key = np.zeros((len(samples), BANDS), dtype=np.uint64)
    key += np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        key = w.mix(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, row::ROWS])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Each sample flips one bit of its set's bitmap."""
    place = np.arange(samples.shape[1], dtype=np.uint64) << np.uint64(32)
    bit = (w.mix(samples.astype(np.uint64) ^ place) % np.uint64(BITS)).astype(np.int64)
    cell = bit + np.arange(len(samples))[:, None] * BITS
    odd = np.bincount(cell.reshape(-1), minlength=len(samples) * BITS) & 1
    packed = np.packbits(odd.astype(np.uint8).reshape(-1, BITS), axis=1, bitorder="little")
    return packed.view(np.uint64)


def most_differing(threshold: float) -> int:
    """Bits in which two sketches may differ while their estimate is at least ``threshold``."""
    samples = BANDS * ROWS
    return int(np.floor(BITS / 2 * (1 - np.exp(-4 * samples * (1 - threshold) / BITS))))


def scanned(documents: DataFrame, size: int) -> DataFrame:
    """Per document: the size and the names of its set, its band keys, and its odd sketch followed
    by 32 bits of each band key. Empty sets have neither."""
    schema = "_id long, n_shingles long, _s1 long, _s2 long, keys array<long>, sketch binary"
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch):
        for row, texts in w.slices(batch.column(1), lower=True):
            sets = Shingles(texts, size)
            names = sets.names()
            full = np.flatnonzero(sets.sizes)
            keys, sketches = [None] * len(texts), [None] * len(texts)
            if len(full):
                samples = signatures(sets.codes, np.append(sets.bounds[full], len(sets.codes)))
                found = band_keys(samples)
                digests = (found >> 32).astype(np.uint32)
                carried = np.concatenate([odd_sketches(samples).view(np.uint32), digests], axis=1)
                for at, key, sketch in zip(full.tolist(), found, carried):
                    keys[at], sketches[at] = key, sketch.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, len(texts)), pa.array(sets.sizes, pa.int64()),
                pa.array(names[0]), pa.array(names[1]),
                pa.array(keys, out.field("keys").type), pa.array(sketches, pa.binary()),
            ], schema=out)

    return arrow_map(documents, run, schema)


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sketches and band digests."""
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, 2 * SKETCH_WORDS + BANDS)
    sketches = np.ascontiguousarray(data[:, : 2 * SKETCH_WORDS]).view(np.uint64)
    return sketches, data[:, 2 * SKETCH_WORDS :]


def likely(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs of sketches whose estimate allows the threshold."""
    most = most_differing(threshold - SLACK)
    out = arrow_schema("_a long, _b long")

    def run(batch: pa.RecordBatch):
        left, right = (unpacked(batch.column(i))[0] for i in (2, 3))
        differ = np.bitwise_count(left ^ right).sum(axis=1)
        found = batch.select([0, 1]).filter(pa.array(differ <= most))
        yield pa.RecordBatch.from_arrays(found.columns, schema=out)

    return arrow_map(pairs, run, "_a long, _b long")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets have ``100 * intersection >= percent * union``."""
    left = texts.select(F.col("_rep").alias("_a"), F.col("text").alias("_left"))
    right = texts.select(F.col("_rep").alias("_b"), F.col("text").alias("_right"))
    both = pairs.join(left, "_a").join(right, "_b").select("_a", "_b", "_left", "_right")
    out = arrow_schema("_a long, _b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # pieces of bounded text
                stop, held = at, 0
                while stop < batch.num_rows and (stop == at or held < 1 << 21):
                    held += len(batch.column(2)[stop].as_buffer()) + len(batch.column(3)[stop].as_buffer())
                    stop += 1
                part = batch.slice(at, stop - at)
                sets = [
                    [
                        s.codes[a:b]
                        for _, texts in w.slices(part.column(i), lower=True)
                        for s in [Shingles(texts, size)]
                        for a, b in zip(s.bounds[:-1], s.bounds[1:])
                    ]
                    for i in (2, 3)
                ]
                good = []
                for a, b in zip(*sets):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    good.append(100 * common >= percent * (len(a) + len(b) - common))
                found = part.select([0, 1]).filter(pa.array(good, pa.bool_()))
                yield pa.RecordBatch.from_arrays(found.columns, schema=out)
                at = stop

    return both.mapInArrow(run, "_a long, _b long")


def confirmed_in_cells(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs of each cell whose full sets are similar; each text goes once to each cell."""
    rows = members.join(texts, "_rep").select("_cell", "_rep", "_partners", "text")
    out = arrow_schema("_a long, _b long")

    def linked(ids: list[int], partners: list[list[int]], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        places: dict[int, list[int]] = {}
        for at, name in enumerate(ids):
            places.setdefault(name, []).append(at)
        good = []
        for at, others in enumerate(partners):
            a = sets[at]
            for b, name in ((sets[i], name) for name in others for i in places[name]):
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    good.append((ids[at], name))
        return good

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, partners, sets = None, [], [], []
        for batch in chain_last(batches):
            good = []
            if batch is None:
                good = linked(ids, partners, sets)
            else:
                cells, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                others = batch.column(2).to_pylist()
                for row, texts in w.slices(batch.column(3), lower=True):
                    found = Shingles(texts, size)
                    for i in range(len(texts)):
                        if cells[row + i] != cell:
                            good += linked(ids, partners, sets)
                            cell, ids, partners, sets = cells[row + i], [], [], []
                        ids.append(names[row + i])
                        partners.append(others[row + i])
                        sets.append(found.codes[found.bounds[i] : found.bounds[i + 1]].copy())
            a, b = zip(*good) if good else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=out)

    parts = max(8, -(-members.count() // 4000))
    spread = rows.repartition(parts, "_cell").sortWithinPartitions("_cell")
    return spread.mapInArrow(run, "_a long, _b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``_id`` and the least id that its links reach, for every id that has links.

    Rounds of large-star and small-star: ids point to ever smaller neighbours until nothing moves.
    Each round is written to the shared folder.
    """
    edges = edges.select(F.greatest("_a", "_b").alias("_u"), F.least("_a", "_b").alias("_v"))
    edges = stored(edges.filter("_u != _v").distinct(), "links")
    before = None
    while True:
        # Large star: neighbours above an id point to the least of its neighbours and itself.
        both = edges.unionByName(edges.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        least = both.groupBy("_u").agg(F.min("_v").alias("_m"))
        least = stored(least.select("_u", F.least("_u", "_m").alias("_m")), "least")
        large = both.join(least, "_u").filter("_v > _u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
        large = stored(large.filter("_u != _v").distinct(), "large")
        # Small star: an id and its smaller neighbours point to the least of them.
        least = stored(large.groupBy("_u").agg(F.min("_v").alias("_m")), "least")
        small = large.join(least, "_u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
        small = small.unionByName(least.select("_u", F.col("_m").alias("_v")))
        edges = stored(small.filter("_u != _v").distinct(), "links")
        now = edges.agg(
            F.count(F.lit(1)), F.countDistinct("_u"), F.sum("_v"), F.bit_xor(F.xxhash64("_u", "_v"))
        ).head()
        # One edge per id, unchanged by a round: every id points to the least of its component.
        if now[0] == now[1] and now == before:
            return edges.select(F.col("_u").alias("_id"), F.col("_v").alias("_root"))
        before = now


def with_roots(ids: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """Adds ``_root``: the component of ``column``, itself where it has no links."""
    named = roots.select(F.col("_id").alias(column), "_root")
    joined = ids.join(named, column, "left")
    return joined.withColumn("_root", F.coalesce("_root", column))


def met_across(places: DataFrame, sketches: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Likely pairs of one band and different components, each in the first band that it shares.

    A row per cell and class: the classes of that cell with which it is to be compared. Classes
    that are only named by others have a row without any.

    ``places`` has one row per band and class. The largest component of a band key is dealt into
    blocks; the other members meet every block, and each other block by block.
    """
    rooted = stored(with_roots(places, "_rep", roots), "rooted")
    sizes = stored(rooted.groupBy("_key", "_root").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    keys = sizes.groupBy("_key").agg(
        F.sum("_n").alias("_all"), F.max(F.struct("_n", "_root")).alias("_top"), F.count(F.lit(1)).alias("_parts")
    )
    # A key of few members is one block that meets itself.
    small = F.col("_all") <= BLOCK
    keys = stored(keys.filter("_parts > 1").select(
        "_key",
        "_all",
        F.when(~small, F.col("_top._root")).alias("_top"),
        F.when(small, 0).otherwise(F.ceil(F.col("_top._n") / BLOCK)).cast("int").alias("_blocks"),
        F.when(small, 1).otherwise(F.ceil((F.col("_all") - F.col("_top._n")) / BLOCK)).cast("int").alias("_others"),
    ), "keys")
    rows = rooted.join(keys, "_key").join(sketches, "_rep")
    # A cell is a pair of blocks. Blocks of the largest component are numbered -1, -2, ...; those
    # of the others from 0. A member lies in a fixed block and goes to every cell of that block.
    block = F.when(
        F.col("_root").eqNullSafe(F.col("_top")), -1 - F.pmod(F.xxhash64("_rep"), F.col("_blocks"))
    ).otherwise(F.pmod(F.xxhash64("_rep"), F.col("_others"))).cast("int")
    others = F.sequence(F.lit(0), F.col("_others") - 1)
    largest = F.when(F.col("_blocks") > 0, F.sequence(-F.col("_blocks"), F.lit(-1))).otherwise(
        F.array().cast("array<int>")
    )
    cells = F.when(
        F.col("_block") < 0, F.transform(others, lambda o: F.struct(F.col("_block").alias("i"), o.alias("j")))
    ).otherwise(F.concat(
        F.transform(largest, lambda b: F.struct(b.alias("i"), F.col("_block").alias("j"))),
        F.transform(others, lambda o: F.struct(
            F.least(o, F.col("_block")).alias("i"), F.greatest(o, F.col("_block")).alias("j")
        )),
    ))
    dealt = rows.withColumn("_block", block).withColumn("_cell", F.explode(cells)).select(
        "_key", "_band", "_cell.i", "_cell.j", "_rep", "_root", "_block", "sketch"
    )
    most = most_differing(threshold - SLACK)
    schema = "_cell long, _rep long, _partners array<long>"
    out = arrow_schema(schema)

    def compare(band, root, block, sketch, digest) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs of one cell: members of its two blocks, or within its one block."""
        found = [np.zeros((2, 0), np.int64)]
        left = block == block.min()
        mine = np.flatnonzero(left)
        theirs = np.flatnonzero(~left) if not left.all() else mine
        for at in range(0, len(mine), 64):
            rows = mine[at : at + 64]
            differ = np.bitwise_count(sketch[rows, None, :] ^ sketch[None, theirs, :]).sum(axis=2, dtype=np.int32)
            good = (differ <= most) & (root[rows, None] != root[None, theirs])
            if theirs is mine:
                good &= rows[:, None] < theirs[None, :]
            i, j = np.nonzero(good)
            i, j = rows[i], theirs[j]
            earlier = (digest[i, :band] == digest[j, :band]).any(axis=1)
            found.append(np.array([i[~earlier], j[~earlier]]))
        return np.concatenate(found, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in chain_last(batches):
            if batch is not None:
                waiting.append(batch)
            if not waiting:
                return
            if batch is not None and sum(b.num_rows for b in waiting) < 20_000:
                continue
            rows = pa.Table.from_batches(waiting)
            change = np.zeros(len(rows) - 1, dtype=bool)
            for name in ("_key", "i", "j"):
                change |= np.diff(rows[name].to_numpy()) != 0
            edges = np.flatnonzero(change) + 1
            if batch is None:
                edges = np.append(edges, len(rows))
            if not len(edges):
                continue
            rep, root, block, bands = (
                rows[name].to_numpy() for name in ("_rep", "_root", "_block", "_band")
            )
            sketch, digest = unpacked(rows["sketch"].combine_chunks())
            heads = np.append(0, edges[:-1])
            two = heads[edges - heads == 2]
            near = np.bitwise_count(sketch[two] ^ sketch[two + 1]).sum(axis=1) <= most
            two = two[near & (root[two] != root[two + 1])]
            same = digest[two] == digest[two + 1]
            same &= np.arange(BANDS) < bands[two, None]
            two = two[~same.any(axis=1)]
            pairs = [np.array([two, two + 1])]
            for a, b in zip(heads[edges - heads > 2], edges[edges - heads > 2]):
                part = slice(a, b)
                pairs.append(a + compare(bands[a], root[part], block[part], sketch[part], digest[part]))
            left, right = np.concatenate(pairs, axis=1)
            order = np.argsort(left, kind="stable")
            left, right = left[order], right[order]
            members = np.unique(np.concatenate([left, right]))
            ends = np.searchsorted(left, np.append(members, len(rows)))
            partners = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(rep[right], pa.int64())
            )
            yield pa.RecordBatch.from_arrays([
                rows["_cell"].combine_chunks().take(pa.array(members)), pa.array(rep[members]),
                partners.cast(out.field("_partners").type),
            ], schema=out)
            rest = rows.slice(edges[-1])
            waiting = rest.take(pa.array(np.arange(len(rest)))).to_batches()

    total = keys.agg(F.sum(F.col("_all") * (F.col("_others") + 1))).head()[0] or 0
    parts = max(8, -(-total // 200_000))
    dealt = dealt.withColumn("_cell", F.xxhash64("_key", "i", "j"))
    spread = dealt.repartition(parts, "_key", "i", "j").sortWithinPartitions("_key", "i", "j")
    return spread.mapInArrow(run, schema)


def chain_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def groups(documents: DataFrame, size: int = 2, percent: int = 80, id_column: str = "doc_id") -> DataFrame:
    """One row per document: ``_id``, ``n_shingles`` and ``_root``, the least id of its component."""
    threshold = percent / 100
    rows = documents.select(F.col(id_column).cast("long").alias("_id"), "text")
    sets = stored(scanned(rows, size), "sets")
    named = sets.filter(F.col("_id").isNotNull() & (F.col("n_shingles") > 0))
    reps = stored(named.groupBy(*CLASS).agg(F.min("_id").alias("_rep")), "classes")
    own = named.join(reps, CLASS).filter("_id = _rep").select("_rep", "keys", "sketch")
    samples = stored(own, "samples")
    sketches = samples.select("_rep", "sketch")
    places = samples.select("_rep", F.posexplode("keys").alias("_band", "_key"))
    met = places.groupBy("_key").agg(
        F.min("_rep").alias("_hub"), F.max("_rep").alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    met = stored(met.filter("_hub < _last").drop("_last"), "met")
    places = stored(places.join(met, "_key"), "places")
    wanted = stored(places.select(F.col("_rep").alias("_id")).distinct(), "wanted")
    texts = rows.join(small_side(wanted), "_id", "left_semi")
    texts = stored(texts.select(F.col("_id").alias("_rep"), "text"), "texts")
    # First round: every class meets the hub with which it shares most bands, and the least one.
    hubs = places.filter("_rep != _hub").groupBy("_rep", "_hub").agg(F.count(F.lit(1)).alias("_n"))
    stars = hubs.groupBy("_rep").agg(
        F.array_distinct(F.array(F.max_by("_hub", F.struct("_n", -F.col("_hub"))), F.min("_hub"))).alias("_hubs")
    ).select(F.explode("_hubs").alias("_a"), F.col("_rep").alias("_b"))
    left = sketches.select(F.col("_rep").alias("_a"), F.col("sketch").alias("_left"))
    right = sketches.select(F.col("_rep").alias("_b"), F.col("sketch").alias("_right"))
    stars = stars.join(left, "_a").join(right, "_b").select("_a", "_b", "_left", "_right")
    stars = stored(likely(stars, threshold), "stars")
    first = stored(confirmed(stars, texts, size, percent), "first")
    roots = components(first)
    # Second round: members of one band that are not yet in one component.
    across = stored(met_across(places.select("_key", "_band", "_rep"), sketches, roots, threshold), "across")
    second = stored(confirmed_in_cells(across, texts, size, percent), "second")
    # Last, all members of a class join the id that stood for it.
    members = named.join(reps, CLASS).filter("_id != _rep").select(F.col("_id").alias("_a"), F.col("_rep").alias("_b"))
    links = roots.select(F.col("_id").alias("_a"), F.col("_root").alias("_b")).unionByName(second)
    roots = components(links.unionByName(members))
    return with_roots(sets.select("_id", "n_shingles"), "_id", roots)


def labelled(documents: DataFrame, size: int = 2, percent: int = 80, id_column: str = "doc_id") -> DataFrame:
    """One row per document: set size, component, and whether it is the one that stays."""
    kind = documents.schema[id_column].dataType
    return groups(documents, size, percent, id_column).select(
        F.col("_id").cast(kind).alias(id_column),
        "n_shingles",
        F.col("_root").cast(kind).alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_root")).alias("kept"),
    )


def unique(documents: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id") -> DataFrame:
    """The document with the least id of each component, with all its columns.

    Rows of one id and text become one, the one whose columns have the least hash; documents
    without an id all stay. Only ids on several rows are shuffled with their columns.
    """
    found = groups(documents, size, percent, id_column)
    stays = found.filter("_id = _root").groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    stays = stored(stays, "stays")
    # Nested, so that no column of the input can clash.
    whole = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("_row")
    rows = documents.select(F.col(f"`{id_column}`").cast("long").alias("_id"), whole)
    one = rows.join(small_side(stays.filter("_n = 1").select("_id")), "_id", "left_semi")
    many = rows.join(small_side(stays.filter("_n > 1").select("_id")), "_id", "left_semi")
    text = F.col("_row.text")
    least = F.min_by("_row", F.xxhash64(F.to_json("_row")))
    many = many.groupBy("_id", F.xxhash64(text), F.xxhash64(F.lit(1), text)).agg(least.alias("_row"))
    kept = one.select("_row").unionByName(many.select("_row"))
    kept = kept.unionByName(rows.filter(F.col("_id").isNull()).select("_row"))
    return kept.select(*[F.col(f"_row.`{name}`").alias(name) for name in documents.columns])
