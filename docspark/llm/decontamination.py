"""Benchmark decontamination: shared q-grams in diagonal bands, the q-gram lemma, banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm.arrays import slices

#: Characters per q-gram, and edits allowed per character of an item.
Q, RATE = 8, 0.1
#: Characters of items that are looked for in one pass over the documents.
BLOCK_CHARS = 2_000_000
#: A q-gram in more places of an item than this is not counted place by place (rulers, lists of one character).
REPEATS = 2
#: Hits held at once.
HITS = 4_000_000
_FILTER_BITS = 22
_NOWHERE = 0xFFFFFFFF


def plain(text: str) -> str:
    """Lower case, each run of white space one blank."""
    return " ".join(text.lower().split())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash per run of q characters."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    # hashes of twice the length from those of neighbours; the last step may overlap, which tells as much
    total, step, n = codes.astype(np.uint64), 0x5851F42D4C957F2D, 1
    while n < q:
        k = min(n, q - n)
        total = total[:-k] * np.uint64(step) + total[k:]
        step, n = (step * step + 2 * k) % 2**64, n + k
    return total * np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Items:
    """A block of items: ids, texts, edit budgets, thresholds, and their q-grams sorted by hash.

    Places whose q-gram the item repeats too often are not listed; ``least`` is lowered by their number, as if each of
    them was met. Items for which that leaves no bound are in the second list instead: one entry per q-gram
    with its first and last place, and ``all_least`` hits asked for.
    """

    ids: list[int]
    texts: list[str]
    size: np.ndarray
    edits: np.ndarray
    least: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    filter: np.ndarray
    all_least: np.ndarray
    loose: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # hash, item, first place, last place

    @staticmethod
    def of(ids: list[int], texts: list[str], q: int, rate: float) -> Items:
        size = np.array([len(t) for t in texts], np.int64)
        # a text with k edits keeps size - q + 1 - k * q q-grams at least, so the budget ends where that is 1
        edits = np.minimum((size * rate).astype(np.int64), (size - q) // q)
        all_least = size - q + 1 - edits * q
        least = all_least.copy()
        listed, loose = [], []
        for i, t in enumerate(texts):
            grams = gram_hashes(codes_of(t), q)
            own, first, which, times = np.unique(grams, return_index=True, return_inverse=True, return_counts=True)
            rare = np.flatnonzero(times[which] <= REPEATS)
            least[i] -= len(grams) - len(rare)
            if least[i] > 0:
                listed.append((grams[rare], np.full(len(rare), i), rare))
            else:
                last = np.zeros(len(own), np.int64)
                last[which] = np.arange(len(grams))  # the last one stays
                loose.append((own, np.full(len(own), i), first, last))
        empty = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
        hashes, item, place = [np.concatenate(c) for c in zip(*listed, empty[:3], strict=True)]
        others = [np.concatenate(c) for c in zip(*loose, empty, strict=True)]
        order, by_hash = np.argsort(hashes, kind="stable"), np.argsort(others[0], kind="stable")
        seen = np.zeros(1 << _FILTER_BITS, bool)
        for h in (hashes, others[0]):
            seen[h >> np.uint64(64 - _FILTER_BITS)] = True
        return Items(ids, texts, size, edits, least, hashes[order], item[order], place[order], seen, all_least, tuple(c[by_hash] for c in others))


def banded_distance(pattern: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int]:
    """Fewest edits that turn the pattern into some part of the text, and where that part ends.

    Only alignments between the diagonals low and low + width are tried; a diagonal is a place in the
    text less one in the pattern.
    """
    m = len(pattern)
    around = np.full(m + width, _NOWHERE, np.uint32)
    a, b = max(low, 0), min(low + m + width, len(text))
    if a < b:
        around[a - low : b - low] = text[a:b]
    steps = np.arange(width, dtype=np.int32)
    row = np.zeros(width, np.int32)
    for i in range(m):
        new = row + (around[i : i + width] != pattern[i])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    best = int(row.argmin())
    return int(row[best]), min(max(low + m + best, 0), len(text))


def found_in(texts: list[str], items: Items, q: int) -> Iterator[tuple[int, int, int, int]]:
    """(number of the text, number of the item, edits, end in the plain text) for each region that verifies."""
    codes = [codes_of(t) for t in texts]
    gap = np.full(1, _NOWHERE, np.uint32)
    joined = np.concatenate([x for c in codes for x in (c, gap)])
    begins = np.concatenate([[0], np.cumsum([len(c) + 1 for c in codes])])
    grams = gram_hashes(joined, q)
    at = np.flatnonzero(items.filter[grams >> np.uint64(64 - _FILTER_BITS)])
    grams = grams[at]
    everywhere = np.arange(len(items.hashes))
    for text, one, low, width in [*_bands(at, grams, begins, items, everywhere), *_loose_bands(at, grams, begins, items)]:
        pattern, k = items.texts[one], int(items.edits[one])
        # an occurrence begins at most k characters before the text, and ends at most k behind it
        start, stop = max(low, -k), min(low + width, len(codes[text]) - len(pattern) + k + 1)
        if start >= stop:
            continue
        exact = texts[text].find(pattern, max(start, 0), max(stop, 0) + len(pattern))
        if exact >= 0:
            yield text, one, 0, exact + len(pattern)
            continue
        edits, end = banded_distance(codes_of(pattern), codes[text], start, stop - start)
        if edits <= k:
            yield text, one, edits, end


def _dense(at: np.ndarray, need: int, reach: int) -> np.ndarray:
    """Which of these places (ascending) lie among ``need`` of them that are at most ``reach`` apart."""
    cover = np.zeros(len(at) + 1, np.int64)
    if len(at) >= need:
        near = np.flatnonzero(at[need - 1 :] - at[: len(at) - need + 1] <= reach)
        np.add.at(cover, near, 1)
        np.add.at(cover, near + need, -1)
    return np.cumsum(cover[:-1]) > 0


def _times_met(hashes: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """For each entry of the index how many of the texts' q-grams meet it."""
    grams = np.sort(grams)
    return np.searchsorted(grams, hashes, "right") - np.searchsorted(grams, hashes, "left")


def _bands(at: np.ndarray, grams: np.ndarray, begins: np.ndarray, items: Items, entries: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, lowest diagonal, width) of the regions with enough q-grams of an item, for these entries of the index.

    Where there are more hits than may be held, the items go in groups.
    """
    if not len(entries) or not len(at):
        return
    hashes, owner, places = items.hashes[entries], items.item[entries], items.place[entries]
    lo = np.searchsorted(hashes, grams, "left")
    n = np.searchsorted(hashes, grams, "right") - lo
    at, grams, lo, n = at[n > 0], grams[n > 0], lo[n > 0], n[n > 0]
    # no region can verify unless as many places have hits as the least demanding item asks for, near one another
    there = np.flatnonzero(np.bincount(owner))
    length = items.size[there]
    stay = _dense(at, int(items.least[there].min()), int((length + items.edits[there]).max()))
    at, grams, lo, n = at[stay], grams[stay], lo[stay], n[stay]
    if int(n.sum()) > HITS and len(there) > 1:
        hits = np.bincount(owner, _times_met(hashes, grams), len(items.ids)).astype(np.int64)
        able = there[hits[there] >= items.least[there]]
        group = np.full(len(items.ids), -1)
        group[able] = np.minimum((np.cumsum(hits[able]) - hits[able]) // HITS, np.arange(len(able)))
        if len(able) == len(there) and group[able].max() == 0:
            group[able] = np.arange(len(able)) % 2
        for g in np.unique(group[able]):
            yield from _bands(at, grams, begins, items, entries[group[owner] == g])
        return
    pick = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    item, place = owner[pick], places[pick]
    spot = np.repeat(at, n)
    ahead = int(length.max())  # no diagonal is below its negative
    band = (spot - place + ahead) // (items.edits[item] + 1)
    doc = np.searchsorted(begins, spot, "right") - 1
    # each diagonal is in two bands of twice the stride, so the k + 1 diagonals of an occurrence are all in one;
    # the q-grams that an occurrence keeps stand in different places of the item, so repeats of one place count once
    bands = int(band.max(initial=0)) + 1
    key = (doc * len(items.ids) + item) * bands
    key, place = np.concatenate([key + band, key + np.maximum(band - 1, 0)]), np.tile(place, 2)
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])])[: len(key)]
    key = key[new]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    count = np.diff(np.append(first, len(key)))
    group = key[first]
    group = group[count >= items.least[group // bands % len(items.ids)]]
    # bands next to each other are one region
    begin = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1] + 1) | (group[1:] // bands != group[:-1] // bands)])[: len(group)])
    for start, last in zip(group[begin].tolist(), group[np.append(begin[1:], len(group)) - 1].tolist() if len(group) else [], strict=True):
        text, one = divmod(start // bands, len(items.ids))
        stride = int(items.edits[one]) + 1
        yield text, one, start % bands * stride - ahead - int(begins[text]), (last - start + 2) * stride


def _loose_bands(at: np.ndarray, grams: np.ndarray, begins: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """The same for items that repeat themselves: wherever enough of their q-grams are near one another, one item at a time."""
    hashes, owner, first, last = items.loose
    if not len(hashes) or not len(at):
        return
    met = _times_met(hashes, grams)
    total = np.bincount(owner, met, len(items.ids))
    for one in np.unique(owner[met > 0]).tolist():
        need, k, size = int(items.all_least[one]), int(items.edits[one]), int(items.size[one])
        if total[one] < need:
            continue
        mine = owner == one
        entry = np.minimum(np.searchsorted(hashes[mine], grams), int(mine.sum()) - 1)
        hit = np.flatnonzero(hashes[mine][entry] == grams)
        hit = hit[_dense(at[hit], need, size + k)]
        spot, entry = at[hit], entry[hit]
        doc = np.searchsorted(begins, spot, "right") - 1
        for text in np.unique(doc).tolist():
            here = doc == text
            low = np.sort(spot[here] - last[mine][entry[here]]) - k
            high = np.sort(spot[here] - first[mine][entry[here]]) + k + 1
            # so many ranges begin before the next one begins as have ended: a gap between regions
            gap = np.flatnonzero(low[1:] > high[:-1])
            starts, stops = np.append(0, gap + 1), np.append(gap, len(low) - 1)
            for a, b in zip(low[starts].tolist(), high[stops].tolist(), strict=True):
                yield text, one, a - int(begins[text]), b - a


def item_blocks(items: DataFrame, text: str, id: str, q: int, most: int = BLOCK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """The items in blocks of at most ``most`` characters (or one item), read one partition at a time."""
    ids, texts, held = [], [], 0
    for r in items.select(F.col(id).alias("id"), F.col(text).alias("text")).toLocalIterator():
        t = plain(r["text"] or "")
        if r["id"] is None or len(t) < q:
            continue
        if held + len(t) > most and ids:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(r["id"])
        texts.append(t)
        held += len(t)
    if ids:
        yield ids, texts


def find_items(
    docs: DataFrame, items: DataFrame, text: str = "text", id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    q: int = Q, rate: float = RATE, block: int = BLOCK_CHARS,
) -> DataFrame:
    """Rows (id, item_id, edits, ends_at), one per document and item that occurs in it.

    Texts are compared in lower case with single blanks. An item of n characters occurs where some part
    of the document is at most ``rate`` * n edits away (fewer for items so short that the lemma would
    bound nothing). edits is the smallest number found, ends_at the smallest end in the plain text of
    such a place. Items go in blocks of a bounded size, one pass over the documents each; per block the
    documents' q-grams are looked up, hits are counted in overlapping bands of diagonals, bands with
    fewer hits than the edits leave are dropped, and the rest are aligned within the band, neighbouring bands as one. Places of an item whose
    q-gram it repeats count as met, and items made of such places are aligned wherever enough of their q-grams are near one
    another, so long runs of one character cost time in proportion to text and item, and bounded memory. Only matches
    are shuffled. Items without id, or shorter than q, occur nowhere; null and empty documents hold none;
    documents without id are left out; repeated rows give one. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    kind = {"id": docs.schema[id].dataType.simpleString(), "item_id": items.schema[item_id].dataType.simpleString()}
    schema = f"id {kind['id']}, item_id {kind['item_id']}, edits long, ends_at long"
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).filter(F.col("id").isNotNull() & F.col("text").isNotNull())

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(*shared.value)
            for batch in slices(batches, "text"):
                ids = batch.column("id").to_pylist()
                found = list(found_in([plain(t) for t in batch.column("text").to_pylist()], index, q))
                out = {"id": [ids[t] for t, *_ in found], "item_id": [index.ids[i] for _, i, *_ in found]}
                out |= {"edits": [e for *_, e, _ in found], "ends_at": [e for *_, e in found]}
                if found:
                    yield pa.RecordBatch.from_pydict(out)

        return rows.mapInArrow(run, schema)

    parts = []
    for ids, texts in item_blocks(items, item_text, item_id, q, block):
        parts.append(search(spark.sparkContext.broadcast(astuple(Items.of(ids, texts, q, rate)))))
    if not parts:
        return spark.createDataFrame([], schema.replace("id ", f"`{id}` ", 1))
    found = reduce(DataFrame.unionByName, parts).groupBy("id", "item_id").agg(F.min(F.struct("edits", "ends_at")).alias("m"))
    return found.select(F.col("id").alias(id), "item_id", "m.edits", "m.ends_at")


def drop_found(docs: DataFrame, found: DataFrame, id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents in which an item occurs; rows without id stay."""
    return docs.join(found.select(id).distinct(), id, "left_anti").select(*docs.columns)
