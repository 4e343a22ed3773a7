"""Self-join of documents by the Jaccard similarity of their word shingles, exact, by partitioning the universe."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.arrays import mix, remembered, shingles, slices, word_hashes
from docspark.llm.graph import connected_components
from docspark.llm.sampling import sized
from docspark.session import discard, materialize

#: Sizes of sets in one band differ by at most this factor (and by at least one).
BAND = 1.4
#: Segments beyond those the pigeonhole needs, as a share: what a set may leave out where a segment is common.
SPARE = 0.1
#: Texts that are compared with one other in one go.
GROUP = 1000
#: Keys that a task holds at once, about, and the bits of a key that are compared between tasks.
BUCKET, KEY_BITS = 1_500_000, 48
_SALT = 0x9E3779B97F4A7C15


def most_apart(a, b, percent: int):
    """The largest symmetric difference of sets of sizes a and b whose similarity is ``percent`` or more; below 0: none."""
    return a + b - 2 * -(-percent * (a + b) // (100 + percent))


@remembered
def budget(size: int, percent: int, larger: bool) -> int:
    """The same over all partners: no smaller ones, or no larger ones."""
    other = np.arange(size, 100 * size // percent + 1) if larger else np.arange(-(-percent * size // 100), size + 1)
    return int(most_apart(size, other, percent).max())


@remembered
def band_start(k: int) -> int:
    start = 1
    for _ in range(k):
        start = max(start + 1, int(start * BAND))
    return start


def band_of(size: int) -> int:
    k = 0
    while band_start(k + 1) <= size:
        k += 1
    return k


@remembered
def segments(band: int, percent: int) -> int:
    """Segments of a band: one more than any two similar sets differ by, if the smaller is of the band; and the spare ones."""
    most = max(budget(s, percent, True) for s in range(max(band_start(band), band_start(band + 1) - 100), band_start(band + 1)))
    return most + 1 + int(np.ceil(SPARE * most))


def keys_of(hashes: np.ndarray, band: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set in a band: one per segment of the universe, and those of segment 0 with one element left out.

    ``hashes`` are sorted, so segments of the hash space lie one after the other; a segment's key comes
    from a sum over its elements, from which one element is taken away by a subtraction.
    """
    m = segments(band, percent)
    value = mix(hashes ^ np.uint64(_SALT))
    at = np.searchsorted((hashes >> np.uint64(32)) * np.uint64(m) >> np.uint64(32), np.arange(m + 1))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
    salt = mix(np.arange(m, dtype=np.uint64) + np.uint64((band + 1) << 32))
    sums = total[at[1:]] - total[at[:-1]]
    return mix(sums + salt), mix(sums[0] - value[: at[1]] + salt[0])


def sketch_of(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Parities of the elements' counts in hashed places: two sketches differ in at most as many bits as the sets in elements."""
    bits = 256
    while bits < 4 * budget(len(hashes), percent, True):
        bits *= 2
    place = (mix(hashes + np.uint64(_SALT)) >> np.uint64(20)) % np.uint64(bits)
    odd = np.bincount(place.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate([p.view(np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def signatures(docs: DataFrame, text: str, id: str, size: int, percent: int) -> DataFrame:
    """Rows (id, n, sum1, sum2, sketch, keys, n_own, n_low, spare_own, spare_low), one per text.

    keys: those of the set's own band, then of the band below where a partner may be of it, then the
    one-deletion keys of either. spare_*: how many segments the set may leave out. A set too small to
    have a similar one but its copies has no keys.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, bounds = word_hashes(batch.column("text"))
            out: dict[str, list] = {c: [] for c in ("n", "sum1", "sum2", "sketch", "keys", "n_own", "n_low", "spare_own", "spare_low")}
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                h = shingles(words[a:b], size)
                n = len(h)
                none = np.zeros(0, np.uint64)
                own = low = own_less = low_less = none
                spare_own = spare_low = 0
                up, down = (budget(n, percent, True), budget(n, percent, False)) if n else (0, 0)
                if up > 0 or down > 0:
                    band = band_of(n)
                    own, own_less = keys_of(h, band, percent)
                    spare_own = len(own) - 1 - max(up, down)
                    if band and -(-percent * n // 100) < band_start(band):
                        low, low_less = keys_of(h, band - 1, percent)
                        spare_low = len(low) - 1 - down
                v = mix(h ^ np.uint64(_SALT))
                row = (n, v.sum(dtype=np.uint64).astype(np.int64), mix(v).sum(dtype=np.uint64).astype(np.int64), sketch_of(h, percent) if n else none,
                       np.concatenate([own, low, own_less, low_less]), len(own), len(low), spare_own, spare_low)
                for c, x in zip(out.values(), row, strict=True):
                    c.append(x)
            columns = [batch.column("id"), *[_lists(x) if c in ("sketch", "keys") else pa.array(x, pa.int64()) for c, x in out.items()]]
            yield pa.RecordBatch.from_arrays(columns, ["id", *out])

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, n long, sum1 long, sum2 long, sketch array<long>, keys array<long>, n_own long, n_low long, spare_own long, spare_low long")


def _packed(x: np.ndarray) -> bytes:
    """Integers as planes of their bytes, so that high bytes that are all zero take no room once compressed."""
    return np.ascontiguousarray(np.asarray(x, "<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").reshape(-1)


def shared_keys(sets: DataFrame, count: int) -> DataFrame:
    """Rows (key, row, marks) of all ``count`` keys of ``sets`` that two rows or more have; marks: 4 exact, 2 of the band below, 1 segment 0.

    A task sorts some millions of keys at a time. Those that it meets twice are known to be shared; of
    them only a mark goes to the other tasks' keys, the rest by a way of its own, so that a key of very many rows
    does not gather in one task. The others meet in buckets of the key space, whose number grows with the keys, as
    differences of sorted keys cut to KEY_BITS bits: two keys that fall together only make a pair more to compare.
    """
    buckets = max(1, -(-count // BUCKET))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            lists = batch.column("keys")
            sizes = np.diff(lists.offsets.to_numpy())
            row, own, low = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("row", "n_own", "n_low"))
            at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            exact, below = at < own + low, (at >= own) & (at < own + low)
            first = exact & (at == np.where(below, own, 0))
            held.append((lists.flatten().to_numpy().view(np.uint64) >> np.uint64(64 - KEY_BITS), row * 8 + exact * 4 + below * 2 + first))
            if sum(len(k) for k, _ in held) >= BUCKET:
                yield from flush(held)
                held = []
        if held:
            yield from flush(held)

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order].astype(np.int64), values[order]
        same = keys[1:] == keys[:-1]
        before, after = np.concatenate([[False], same]), np.concatenate([same, [False]])
        out = []
        if same.any():
            known = before | after
            spread = int(values[0] % buckets) if len(values) else 0
            out.append((spread, True, keys[known], values[known]))
        keys, values = keys[~before], np.where(after, -1, values)[~before]  # the first of several stands for all
        bounds = np.searchsorted((keys >> (KEY_BITS - 31)) * buckets >> 31, np.arange(buckets + 1))
        out += [(b, False, keys[i:j], values[i:j]) for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if j > i]
        for bucket, known, k, v in out:
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([bucket], pa.int32()), "known": [known], "keys": [_packed(np.diff(k, prepend=0))], "base": [int(v.min())], "vals": [_packed(v - v.min())],
            })

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for bucket, known, keys, base, values in zip(*[batch.column(c).to_pylist() for c in ("bucket", "known", "keys", "base", "vals")], strict=True):
                k, v = np.cumsum(_unpacked(keys)), _unpacked(values) + base
                if known:
                    yield rows(k, v)
                    continue
                if bucket != current:
                    yield from finish(held)
                    current, held = bucket, []
                held.append((k, v))
        yield from finish(held)

    def finish(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if held:
            keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
            same = keys[1:] == keys[:-1]
            shared = (np.concatenate([[False], same]) | np.concatenate([same, [False]])) & (values >= 0)
            yield rows(keys[shared], values[shared])

    def rows(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": keys, "row": values >> 3, "marks": values & 7})

    sent = sets.select("row", "n_own", "n_low", "keys").mapInArrow(send, "bucket int, known boolean, keys binary, base long, vals binary")
    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "key long, row long, marks long")


def _similar(n1: Column, n2: Column, percent: int) -> Column:
    """Whether sizes allow the similarity."""
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent


def _plausible(a: str, b: str, percent: int) -> Column:
    """Sizes allow it, and the sketches differ in no more bits than the sets may in elements. Never false for a link."""
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    apart = n - 2 * F.floor((n * percent + (99 + percent)) / (100 + percent))
    x, y = F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    size = F.least(F.size(x), F.size(y))

    def folded(s: Column) -> Column:
        """A sketch of twice the size, brought to the smaller one's: places fall together modulo a power of two."""
        halves = F.zip_with(F.slice(s, 1, size), F.slice(s, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(s) == 2 * size, halves).otherwise(s)

    x, y = folded(x), folded(y)
    differ = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, d: s + d)
    return _similar(F.col(f"{a}.n"), F.col(f"{b}.n"), percent) & ((F.size(x) != F.size(y)) | (differ <= apart))


def verified(docs: DataFrame, pairs: DataFrame, text: str, id: str, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose shingle sets are as similar as asked for, by their exact intersection, as a table.

    Only the texts that some pair names move, each once per pair in which it is b, and once per GROUP
    pairs in which it is a: a's text comes first, is made a set once, and the others pass by it one by one.
    An id may have several texts: a pair links if some two of them do.
    """
    pairs = pairs.withColumn("group", F.pmod(F.xxhash64("b"), F.lit(2**20)))
    crowd = pairs.groupBy("a").agg(F.count("*").alias("m"))
    pairs = materialize(pairs.join(crowd, "a").select("a", "b", F.pmod("group", F.ceil(F.col("m") / GROUP)).cast("int").alias("group")), "pairs")
    heads = pairs.select(F.col("a").alias("id"), "a", "group", F.lit(0).alias("kind")).distinct()
    roles = sized(heads.unionByName(pairs.select(F.col("b").alias("id"), "a", "group", F.lit(1).alias("kind"))))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).join(roles, "id")
    rows = rows.repartition("a", "group").sortWithinPartitions("a", "group", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []
        for batch in slices(batches, "text"):
            words, bounds = word_hashes(batch.column("text"))
            out = []
            columns = (batch.column(c).to_pylist() for c in ("a", "group", "kind", "id"))
            for k, (a, group, kind, b) in enumerate(zip(*columns, strict=True)):
                own = shingles(words[bounds[k] : bounds[k + 1]], size)
                if (a, group) != at:
                    at, heads = (a, group), []
                if kind == 0:
                    heads.append(own)
                    continue
                for h in heads:
                    shared = len(np.intersect1d(h, own, assume_unique=True))
                    if len(own) and shared * 100 >= percent * (len(h) + len(own) - shared):
                        out.append((a, b))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in (0, 1)], ["a", "b"])

    return materialize(rows.mapInArrow(run, "a long, b long").distinct(), "links")


def jaccard_components(docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = 3, percent: int = 90) -> DataFrame:
    """Rows (id, n_shingles, component_id, copies_of), one per row of ``docs``.

    Two documents link when 100 * intersection >= percent * union of their sets of distinct shingles of
    ``size`` words; fewer words are one shingle, no words (or null) an empty set that links with nothing.
    component_id is the smallest id reachable by links, copies_of the smallest id with the same set.

    Sets with equal sums of hashes (128 bits and the size) are copies and joined as one. For the others
    the hash space is cut into segments, by a band of sizes: similar sets differ by fewer elements than
    there are segments, so they agree in one. A set that meets common segments leaves out those of the
    highest cost that its spare segments allow, and one more where it is cheaper to probe segment 0
    with one-element deletions on either side instead. Candidates of one key are first compared with
    the key's most common member alone; after that only pairs of different components are looked at,
    and of those only what sizes and parity sketches, which never rule out a link, leave. Each pair
    left is verified on its exact sets. No cap holds anywhere, and no pair inside a component found is made.

    Sets are compared by 64-bit hashes of shingles. Rows without an id link with nothing and have
    component_id null; rows that repeat an id are one document with several texts, each of which links.
    Empty tables give empty results. Other columns are not read.
    """
    sets = materialize(signatures(docs, text, id, size, percent).withColumn("row", F.monotonically_increasing_id()), "signatures")
    sizes = materialize(sets.select("row", "id", "n", "sum1", "sum2", "spare_own", "spare_low", F.size("keys").alias("n_keys")), "sizes")
    usable, narrow = (x.filter(F.col("id").isNotNull() & (F.col("n") > 0)) for x in (sets, sizes))
    # written, so that the join deals the rows anew and can split a large group of copies
    same = materialize(narrow.groupBy("sum1", "sum2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("of")).filter("of > 1").drop("of"), "same")
    named = materialize(narrow.join(same, ["sum1", "sum2", "n"], "left").select("row", "id", "n", "spare_own", "spare_low", F.coalesce("rep", "id").alias("rep")), "copies")

    rows = shared_keys(usable, narrow.agg(F.sum("n_keys")).first()[0] or 0)
    # copies share all keys: what only they share goes
    low = F.col("marks").bitwiseAND(2) > 0
    marks = F.col("marks") + 8 * F.when(low, F.col("spare_low")).otherwise(F.col("spare_own"))
    rows = rows.join(named, "row").select("key", F.col("rep").alias("node"), marks.alias("marks")).distinct()
    rows = materialize(rows, "shared-keys")
    counts = rows.select("key", "node").distinct().groupBy("key").agg(F.count("*").alias("f")).filter("f > 1")
    bit = [(F.col("marks").bitwiseAND(b) > 0).alias(c) for c, b in (("exact", 4), ("low", 2), ("first", 1))]
    shared = materialize(rows.join(counts, "key").select("key", "node", *bit, F.shiftright("marks", 3).alias("spare"), "f"), "shared-keys")
    discard(rows)
    heads = named.filter(F.col("id") == F.col("rep")).select(F.col("id").alias("node")).join(shared.select("node").distinct(), "node", "left_semi")
    sketches = materialize(
        usable.select(F.col("id").alias("node"), "n", "sketch").join(heads, "node", "left_semi").dropDuplicates(["node"]), "sketches"
    )
    discard(sets)

    def plausible(pairs: DataFrame) -> DataFrame:
        x = sketches.select(F.col("node").alias("a"), F.struct("n", "sketch").alias("p"))
        y = sketches.select(F.col("node").alias("b"), F.struct("n", "sketch").alias("q"))
        return pairs.join(x, "a").join(y, "b").filter(_plausible("p", "q", percent)).select("a", "b")

    # one comparison per member: with the member of the key that shares most with others
    fame = shared.groupBy("node").agg(F.sum("f").alias("fame"))
    centers = shared.select("key", "node").distinct().join(fame, "node").groupBy("key").agg(F.max(F.struct("fame", "node")).alias("c"))
    stars = shared.join(centers.select("key", F.col("c.node").alias("a")), "key").filter(F.col("a") != F.col("node"))
    stars = stars.select("a", F.col("node").alias("b")).distinct()
    links = verified(docs, materialize(plausible(stars), "stars"), text, id, size, percent)
    parts = materialize(connected_components(links), "parts")

    pairs = materialize(_open_pairs(shared, sketches, parts, percent), "open-pairs")
    more = verified(docs, pairs, text, id, size, percent)
    for table in (shared, sketches, parts):
        discard(table)
    parts = materialize(connected_components(links.unionByName(more)), "parts")

    named = named.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("id", "rep", F.coalesce("component", "rep").alias("component"))
    # a component's name is its smallest id; ids that repeat tie the components of all their texts together
    tie = named.groupBy("id").agg(F.min("component").alias("component"), F.max("component").alias("last"), F.min("rep").alias("copies_of"))
    split = materialize(tie.filter("component != last").select("id", F.col("component").alias("least")), "several")
    ties = connected_components(named.join(split, "id").select("least", "component"), "least", "component")
    named = tie.join(ties.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left")
    named = named.select(F.col("id").alias("_id"), F.coalesce("root", "component").alias("component"), "copies_of")
    out = sizes.select("id", "n").join(named, (F.col("id") == F.col("_id")) & (F.col("n") > 0), "left")
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"), F.coalesce("copies_of", "id").alias("copies_of"))


def _open_pairs(shared: DataFrame, sketches: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that meet in a key which one of them probes, and that the sketches allow."""
    rows = shared.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 != c2").select("key")
    rows = rows.join(mixed, "key")
    # allocation per set and band: a segment's cost is the number of sets in it
    side = Window.partitionBy("node", "low")
    order = side.orderBy(F.col("exact").desc(), F.col("first"), F.col("f").desc(), "key")
    rows = rows.withColumns({
        "rank": F.row_number().over(order),
        "probe0": F.sum(F.when(~F.col("exact") | F.col("first"), F.col("f")).otherwise(0)).over(side),
    }).withColumn("next", F.max(F.when(F.col("exact") & ~F.col("first") & (F.col("rank") == F.col("spare") + 1), F.col("f"))).over(side))
    up = F.coalesce(F.col("next") > F.col("probe0"), F.lit(False))
    active = F.when(F.col("exact") & ~F.col("first"), F.col("rank") > F.col("spare") + up.cast("int")).when(F.col("first"), F.lit(True)).otherwise(up)
    rows = rows.select("key", "node", "component", "exact", "first", up.alias("up"), active.alias("active"))
    rows = materialize(rows.join(sketches.select("node", F.struct("n", "sketch").alias("s")), "node"), "probes")
    a, b = rows.filter("active").alias("a"), rows.alias("b")
    deletion = ~F.col("a.exact") | ~F.col("b.exact")
    met = F.when(deletion, F.col("a.up") & (F.col("a.exact") | F.col("b.exact"))).otherwise(F.lit(True))
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component")) & met
    pairs = a.join(b, on & _plausible("a.s", "b.s", percent))
    return pairs.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()
