"""SimHash near-duplicates with the generalised pigeonhole principle.

Each text gets fingerprints: bit by bit the majority of the XXH64 values of its word shingles. Fingerprints
within ``max_bits`` bits of each other link. To find them, the 64 bits are grouped into parts so that correlated bits
are together, and every part ``i`` gets a threshold ``t_i >= -1`` such that the ``t_i + 1`` add up to ``max_bits + 1``:
then two fingerprints that link are within ``t_i`` bits in at least one part (-1: the part is not probed).
Parts and thresholds are chosen by dynamic programming on the candidate counts that a bounded sample of
fingerprints lets expect. To probe part ``i``, each fingerprint is filed under its bits there with every choice of
``t_i`` bits left out; members of a bucket are verified bit by bit.

Copies are one node. A bucket of more than ``BUCKET`` members only names its key at first. If it is much larger than that
and than any group of equal fingerprints in it, its members are filed again by the bits that are still free, by the same
principle. Otherwise (nodes that only differ in what is verified share their fingerprint, and no filing parts them), or if
too few bits are free, it is dealt into blocks and every two blocks are compared. A bucket gives a spanning forest
of its links, not all pairs. Classes come from repeated hooking of nodes to the smallest node around, with both
steps as joins and map-side minima, each round written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipquarry.llm.common import fresh, released, small_side, store
from clipquarry.llm.files import read_numbers
from clipquarry.operators.ordering import PLACE_BITS
from clipquarry.session import scratch_path

SEED = 42
BITS = 64
BUCKET = 2_048
SAMPLE = 4_096  # fingerprints whose pairs estimate the candidate counts
SCREEN = 64  # members up to which a bucket is first looked through for any link
MOST_KEYS = 160  # keys that one fingerprint is filed under, at most, per level
FILED_AGAIN = 8  # times ``BUCKET``, and times its largest group of equal fingerprints, that a bucket is filed again beyond
TILE = 256  # rows of a bucket that are compared with all at once
ROUNDS = 60
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


# --- fingerprints ------------------------------------------------------------------------------------


def shingles(text: str | None, words: int, distinct: bool = False) -> list[bytes]:
    """Runs of ``words`` words, A-Z in lower case, joined by a blank; the whole sequence where there are fewer."""
    # bytes.lower and bytes.split know just ASCII letters and the blanks \x09-\x0d and \x20
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return []
    if words > 1:
        found = [b" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    return list(set(found)) if distinct else found


def fingerprint(parts: Sequence[bytes], seed: int = SEED) -> int:
    """Bits that are set in over half of the hashes; 0 without any."""
    if not parts:
        return 0
    h = np.array([xxhash.xxh64_intdigest(p, seed) for p in parts], "<u8")
    each = h.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(each[:, b], minlength=256) @ _BYTE_BITS for b in range(8)])
    return int(np.packbits(2 * ones > len(parts), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, kinds: dict[str, tuple[int, bool, int]], *, carry: Sequence[str], text: str = "text"
) -> DataFrame:
    """The columns ``carry`` of ``docs`` and one signed 64-bit column for each of ``kinds``: words of a shingle,
    whether equal shingles count once, seed. Null and empty texts have no shingle: fingerprint 0."""
    rows = docs.select(*[F.col(f"`{c}`") for c in carry])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    at = list(carry).index(text) if text in carry else len(carry)  # texts that are carried go to the worker once
    rows = rows if text in carry else docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text).alias(fresh(docs, "_text")))
    names = [*carry, *kinds]

    @released
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = {k: [] for k in kinds}
            for value in batch.column(at):
                value = value.as_py()
                made: dict[tuple[int, bool], list[bytes]] = {}
                for k, (n, distinct, seed) in kinds.items():
                    parts = made.get((n, distinct))
                    if parts is None:
                        parts = made[n, distinct] = shingles(value, n, distinct)
                    found[k].append(fingerprint(parts, seed))
            new = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in found.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carry)], *new], names)

    return rows.mapInArrow(hashed, ", ".join([*fields, *[f"{k} long" for k in kinds]]))


# --- the plan of parts and thresholds ------------------------------------------------------------------


def correlated_parts(bits: np.ndarray, free: Sequence[int], m: int) -> list[list[int]]:
    """``free`` in ``m`` parts of about equal size; each grows from its first bit by the bit that correlates
    most with those it has. ``bits``: a sample of fingerprints, a row each, 0 and 1."""
    own = bits[:, list(free)].astype(float)
    own -= own.mean(axis=0) if len(own) else 0
    scale = np.sqrt((own**2).sum(axis=0)) + 1e-9
    alike = np.abs(own.T @ own) / np.outer(scale, scale)
    left, parts = list(range(len(free))), []
    for size in [len(free) // m + (i < len(free) % m) for i in range(m)]:
        part = [left.pop(0)] if size else []
        while len(part) < size:
            best = max(left, key=lambda b: (alike[b, part].sum(), -b))
            left.remove(best)
            part.append(best)
        parts.append(sorted(free[b] for b in part))
    return parts


def _keys(width: int, t: int) -> int:
    n = 1
    for i in range(t):
        n = n * (width - i) // (i + 1)
    return n


def allocate(bits: np.ndarray, free: Sequence[int], max_bits: int) -> list[tuple[list[int], int]]:
    """Parts of ``free`` with their thresholds (-1 left out): for every number of parts, dynamic programming over
    parts and the sum of ``t_i + 1`` minimises the expected candidates of the sample plus the keys filed."""
    n = len(bits)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(1, min(max_bits + 1, len(free)) + 1):
        parts = correlated_parts(bits, free, m)
        costs = []
        for part in parts:
            own = bits[:, part].astype(np.float32)
            apart = own.sum(1)[:, None] + own.sum(1)[None, :] - 2 * own @ own.T
            row = {-1: 0.0}
            for t in range(min(max_bits, len(part) - 1) + 1):
                if _keys(len(part), t) > MOST_KEYS:
                    break
                row[t] = (float((apart <= t).sum()) - n) / max(n, 1) + _keys(len(part), t)
            costs.append(row)
        state: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in costs:
            after: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in state.items():
                for t, c in row.items():
                    to = min(used + t + 1, max_bits + 1)
                    if to not in after or cost + c < after[to][0]:
                        after[to] = (cost + c, [*chosen, t])
            state = after
        if max_bits + 1 in state:
            cost, chosen = state[max_bits + 1]
            if best is None or cost < best[0]:
                best = cost, [(p, t) for p, t in zip(parts, chosen) if t >= 0]
    if best is None:  # a bit for each of max_bits + 1 parts is enough
        raise ValueError(f"{len(free)} bits cannot be filed for links of {max_bits} bits")
    return best[1]


# --- probing and verifying -----------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer; equal keys stay equal, and what collides by chance is verified away."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _mask(bits: Sequence[int]) -> int:
    return sum(1 << b for b in bits)


def _bits_of(values: np.ndarray) -> np.ndarray:
    return ((values[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)


def _file(nodes: DataFrame, sample: np.ndarray, max_bits: int, extra: Sequence[str]) -> DataFrame:
    """One row per key of each row: ``key``, ``free`` (bits not fixed by the key), ``fp``, ``extra``."""
    whole = (1 << BITS) - 1
    plans: dict[int, list[tuple[int, int, int]]] = {}

    def plan(free: int) -> list[tuple[int, int, int]]:
        """(bits compared, bits free afterwards, salt) of every key."""
        if free not in plans:
            found, bits = [], [b for b in range(BITS) if free >> b & 1]
            for part, t in allocate(sample, bits, max_bits):
                for k, out in enumerate(combinations(part, t)):
                    used = _mask(part) & ~_mask(out)
                    found.append((used, free & ~used, hash((free, used, k)) & whole))
            plans[free] = found
        return plans[free]

    fields = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    schema = "key long, free long, fp long" + "".join(f", `{c}` {fields[c]}" for c in extra)

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, free, fp = (np.asarray(batch.column(i)).view(np.uint64) for i in range(3))
            for f in np.unique(free).tolist():
                pick = np.flatnonzero(free == f)
                rest = [batch.column(3 + i).take(pa.array(pick)) for i in range(len(extra))]
                for used, after, salt in plan(f):
                    mixed = _mix((fp[pick] & np.uint64(used)) ^ _mix(key[pick] ^ np.uint64(salt)))
                    left = np.full(len(pick), after, np.uint64).view(np.int64)
                    columns = [pa.array(mixed.view(np.int64)), pa.array(left), pa.array(fp[pick].view(np.int64)), *rest]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "free", "fp", *extra])

    return nodes.select("key", "free", "fp", *extra).mapInArrow(filed, schema)


def bucket_links(
    node: np.ndarray, fp: np.ndarray, verify: Sequence[np.ndarray], limits: tuple[int, int]
) -> list[tuple[int, int]]:
    """A spanning forest of the links of a bucket: ``fp`` within the first limit, ``verify`` together within the other."""
    n = len(node)
    near = np.empty((n, n), bool)
    for i in range(0, n, TILE):
        apart = lambda v: np.bitwise_count(v[i:i + TILE, None] ^ v[None, :])  # noqa: B023, E731
        near[i:i + TILE] = apart(fp) <= limits[0]
        if verify:
            near[i:i + TILE] &= sum(apart(v).astype(np.int16) for v in verify) <= limits[1]
    left, out = np.ones(n, bool), []
    for root in np.flatnonzero(near.sum(axis=1) > 1).tolist():
        if not left[root]:
            continue
        left[root], front = False, [root]
        while front:
            a = front.pop()
            for b in np.flatnonzero(near[a] & left).tolist():
                left[b] = False
                front.append(b)
                out.append((int(node[a]), int(node[b])))
    return out


def _screened(key: np.ndarray, fp: np.ndarray, bounds: np.ndarray, most: int) -> list[int]:
    """Of buckets (``bounds``: their first rows, and the end) those that have a pair within ``most`` bits."""
    hit, size, d = np.zeros(len(bounds) - 1, bool), np.diff(bounds), 1
    own = np.repeat(np.arange(len(size)), size)
    small = np.flatnonzero((size > 1) & (size <= SCREEN))
    rows = np.flatnonzero(np.isin(own, small))
    while rows.size:
        rows = rows[rows + d < len(own)]
        rows = rows[own[rows + d] == own[rows]]
        hit[own[rows[np.bitwise_count(fp[rows] ^ fp[rows + d]) <= most]]] = True
        d += 1
    return np.flatnonzero(hit | (size > SCREEN)).tolist()


def links(
    nodes: DataFrame, max_bits: int, *, verify: Sequence[str] = (), verify_bits: int = 0, bucket: int = BUCKET
) -> DataFrame:
    """``a``, ``b``: links that connect every class of rows of ``nodes`` (distinct ``node``, ``fp`` and the columns
    ``verify``) whose ``fp`` are within ``max_bits`` bits and whose ``verify`` columns are within ``verify_bits`` together."""
    extra, limits = ["node", *verify], (max_bits, verify_bits)
    sample = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    bits = _bits_of(np.array([r["fp"] for r in sample], np.int64).view(np.uint64))
    level = nodes.select(F.lit(0).cast("long").alias("key"), F.lit(-1).cast("long").alias("free"), "fp", *extra)

    def compared(rows: DataFrame, most: int | None) -> DataFrame:
        """``a``, ``b``: links in the buckets of ``rows``; of one of more than ``most`` rows its key and null."""

        def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rest: list[np.ndarray] | None = None
            for batch in batches:
                rows = [np.asarray(c) for c in batch.columns]
                if not len(rows[0]):
                    continue
                rows = [np.concatenate(x) for x in zip(rest, rows)] if rest else rows
                cut = np.flatnonzero(np.diff(rows[0])) + 1
                # the last bucket may go on in the next batch; of a large one no more is held than shows that it is
                last = int(cut[-1]) if cut.size else 0
                if last:
                    yield _linked([r[:last] for r in rows], np.concatenate(([0], cut)))
                rest = [r[last:None if most is None else last + most + 1] for r in rows]
            if rest is not None:
                yield _linked(rest, np.array([0, len(rest[0])]))

        def _linked(rows: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
            found: list[tuple[int, int | None]] = []
            prints = [r.view(np.uint64) for r in rows[2:]]
            for k in _screened(rows[0], prints[0], bounds, max_bits):
                a, b = bounds[k], bounds[k + 1]
                if most is not None and b - a > most:
                    found.append((int(rows[0][a]), None))
                else:
                    found += bucket_links(rows[1][a:b], prints[0][a:b], [p[a:b] for p in prints[1:]], limits)
            columns = [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        dealt = rows.select("key", "node", "fp", *verify).repartition("key").sortWithinPartitions("key")
        return store(dealt.mapInArrow(verified, "a long, b long"), "bucket_links")

    found: DataFrame | None = None
    while True:
        filed = _file(level, bits, max_bits, extra)
        out = compared(filed, bucket)
        pairs = out.where("b IS NOT NULL")
        found = pairs if found is None else found.unionByName(pairs)
        large = store(out.where("b IS NULL").select(F.col("a").alias("key")).distinct(), "large_buckets")
        if not large.count():
            return found.distinct()
        # a bucket is filed again only where that can make it small; else it is compared block by block
        level = filed.join(small_side(large), "key", "left_semi")
        equal = level.groupBy("key", "free", "fp").agg(F.count("*").alias("n"))
        sizes = equal.groupBy("key", "free").agg(F.sum("n").alias("n"), F.max("n").alias("equal"))
        again = (F.col("n") > FILED_AGAIN * F.greatest(F.lit(bucket), "equal")) & (F.bit_count("free") > max_bits)
        sizes = store(sizes.select("key", F.ceil(F.col("n") / bucket).alias("blocks"), again.alias("again")), "bucket_sizes")
        whole = sizes.where("NOT again").select("key", "blocks")
        if whole.count():
            found = found.unionByName(compared(_block_pairs(filed.join(small_side(whole), "key")), None))
        more = sizes.where("again").select("key")
        if not more.count():
            return found.distinct()
        level = filed.join(small_side(more), "key", "left_semi")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """``rows`` of buckets dealt by a hash into ``blocks`` blocks, at least two; a row for each other block, whose ``key``
    both blocks share."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    both = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("own <> other")
    return both.withColumn("key", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))


def classes(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node of its class) for all nodes of ``edges`` (``a``, ``b``). Large-star and
    small-star steps alternate until no edge changes."""
    pairs = store(edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct(), "links")
    mark = None
    for _ in range(ROUNDS):
        both = pairs.unionByName(pairs.select(F.col("a").alias("b"), F.col("b").alias("a")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # large star: neighbours above a node go to the least node around it
        large = store(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .where("a > b").distinct(), "large_star")
        # small star: neighbours below a node, and the node, go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        pairs = store(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small_star")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == mark:
            break
        mark = state
    else:
        raise RuntimeError("classes did not settle")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def hexadecimal(fp: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = 3,
    max_bits: int = 2,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket: int = BUCKET,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``: the smallest id that is reachable over links of
    at most ``max_bits`` bits, for every row.

    Null, empty and blank texts have fingerprint 0 and link like any other. Repeated ids keep all their rows and
    are in the classes of each of their texts, separately. A class without any id has a null component.
    Other columns are not read; an empty table gives an empty one."""
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = store(fingerprints(given, {"fp": (shingle_words, False, seed)}, carry=["doc_id"]), "fingerprints")
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct_fingerprints")
    found = classes(links(nodes.select(F.col("fp").alias("node"), "fp"), max_bits, bucket=bucket))
    member = nodes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    member = store(member, "members")
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).select(
        "doc_id", hexadecimal("fp").alias("fingerprint"), "component_id"
    )


def deduplicate(
    docs: DataFrame,
    *,
    shingle_words: int = 3,
    max_bits: int = 2,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket: int = BUCKET,
) -> DataFrame:
    """One row of each class of near copies, with the columns of ``docs``: the one with the smallest id, null ids
    last, ties as the rows come. Classes are those of :func:`near_duplicates`: what links of at most ``max_bits`` bits
    between fingerprints reach. Null, empty and blank texts are copies of each other. An empty table gives an
    empty one; columns may have any names.

    Rows are stored with their fingerprint and number once, and the numbers of rows that go are stored by the task that
    wrote the row; each task drops its own, so that texts are never shuffled, whatever the size."""
    given = docs.columns
    print_, number = fresh(docs, "_print"), fresh(docs, "_row")
    made = fingerprints(docs, {print_: (shingle_words, False, seed)}, carry=given, text=text)
    rows = store(made.withColumn(number, F.monotonically_increasing_id()), "fingerprinted")
    narrow = rows.select(F.col(f"`{doc_id}`").alias("i"), F.col(print_).alias("fp"), F.col(number).alias("r"))
    best = F.min(F.struct(F.col("i").isNull().alias("none"), "i", "r")).alias("best")
    nodes = store(narrow.groupBy("fp").agg(best), "distinct_fingerprints")
    edges = links(nodes.select(F.col("fp").alias("node"), "fp"), max_bits, bucket=bucket)
    roots = classes(edges)
    member = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("best", F.coalesce("root", "fp").alias("root"))
    kept = member.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.r").alias("r"))
    return without_rows(rows, number, narrow.select("r").join(kept, "r", "left_anti")).select(*[F.col(f"`{c}`") for c in given])


def without_rows(rows: DataFrame, number: str, dropped: DataFrame) -> DataFrame:
    """Stored ``rows`` without those whose ``number`` (of ``monotonically_increasing_id``) is in ``dropped`` (``r``). Numbers are
    stored by their partition, which their upper bits name, and looked up there by the task that reads its rows."""
    folder = scratch_path(rows.sparkSession, "dropped")
    parts = dropped.select("r", F.shiftright("r", PLACE_BITS).alias("part"))
    parts.repartition("part").write.partitionBy("part").parquet(folder)
    at = rows.columns.index(number)

    @released
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone: dict[int, np.ndarray] = {}
        for batch in batches:
            own = np.asarray(batch.column(at))
            part = own >> PLACE_BITS
            for p in set(np.unique(part).tolist()).difference(gone):
                gone[p] = read_numbers(f"{folder}/part={p}", "r")
            keep = np.ones(len(own), bool)
            for p in np.unique(part).tolist():
                keep &= (part != p) | ~np.isin(own, gone[p])
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(keep, rows.schema)
