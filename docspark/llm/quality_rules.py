"""Text rules, and the likelihood of a text's n-grams under a trusted corpus against the raw one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.arrays import buffers, mix, run_hashes, run_starts, slices, stream, word_hashes

#: Buckets that unigrams and bigrams of tokens are hashed to.
BUCKETS = 1 << 16
#: A text stays if its mean log-likelihood ratio per n-gram (natural logarithm) is at least this.
LEAST_RATIO = -0.25
#: Fewest words, words of a window that may not repeat, and the percentage of words in repeated ones that is too much.
LEAST_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20
SYMBOLS = b"#*$%&|<>"

_CLASS = np.full(256, 2, np.uint8)  # 0 white space, 1 letters, digits and _, 2 other signs
_CLASS[[32, 9, 10, 11, 12, 13]] = 0
_CLASS[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 1
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_PLACE = np.uint64(0x9E3779B97F4A7C15)


def _owners(bounds: np.ndarray) -> np.ndarray:
    """The text that each item belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def _repeats(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash whether its text has it twice or more, and whether it is a later occurrence there."""
    key = mix(hashes + owner.astype(np.uint64) * _PLACE)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    twice[order[1:][same]] = later[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data, offsets = buffers(column)
    n = len(column)
    words, bounds = word_hashes(column, lower=False)
    owner = _owners(bounds)
    counts = np.diff(bounds)
    if not len(data):
        return {c: np.zeros(n, np.int64) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    solid = _CLASS[data] > 0

    def per_text(marks: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(marks)])[offsets])

    # words covered by windows that their text has twice or more
    covered = np.zeros(n, np.int64)
    if len(words) >= WINDOW:
        salt = stream(41, WINDOW)
        last = len(words) - WINDOW + 1
        inside = np.flatnonzero(owner[:last] == owner[WINDOW - 1 :])
        windows = np.zeros(last, np.uint64)
        for k in range(WINDOW):
            windows += mix(words[k : last + k] ^ salt[k])
        twice, _ = _repeats(windows[inside], owner[inside])
        steps = np.zeros(len(words) + 1, np.int64)
        steps[inside[twice]] += 1
        steps[inside[twice] + WINDOW] -= 1
        covered = np.bincount(owner[np.cumsum(steps)[:-1] > 0], minlength=n)
    # lines that have a word
    body = data != 10
    first = run_starts(body, offsets)
    begins = np.flatnonzero(first[body])
    hashes = run_hashes(data[body], begins)
    told = np.add.reduceat(solid[body].astype(np.int64), begins) > 0 if len(begins) else np.zeros(0, bool)
    text = _owners(np.searchsorted(np.flatnonzero(first), offsets))[told]
    later = _repeats(hashes[told], text)[1]
    return {
        "n_words": counts,
        "word_chars": per_text(solid & ((data & 0xC0) != 0x80)),
        "n_symbols": per_text(_IS_SYMBOL[data]),
        "n_dup_lines": np.bincount(text[later], minlength=n),
        "n_repeat_words": covered,
    }


def hashed_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the unigrams and bigrams of all texts, and the text of each.

    Tokens are runs of letters, digits, _ and characters beyond ASCII, and runs of other signs that are not white space; case counts.
    """
    data, offsets = buffers(column)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _CLASS[data]
    first = run_starts(kind == 1, offsets) | run_starts(kind == 2, offsets)
    tokens = run_hashes(data[kind > 0], np.flatnonzero(first[kind > 0]))
    owner = _owners(np.searchsorted(np.flatnonzero(first), offsets))
    inner = owner[1:] == owner[:-1]
    pairs = mix(tokens[:-1] * _PLACE ^ tokens[1:])[inner]
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    return (np.concatenate([mix(tokens), pairs]) >> shift).astype(np.int64), np.concatenate([owner, owner[1:][inner]])


@dataclass
class Ratios:
    """log of a bucket's probability among the trusted n-grams over that among the raw ones."""

    logs: np.ndarray


def gram_counts(texts: DataFrame, text: str) -> np.ndarray:
    """How often each bucket occurs in all rows of ``texts``: summed up per task, one row per bucket comes to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(hashed_grams(batch.column("text"))[0], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": at, "n": total[at]})

    out = np.zeros(BUCKETS)
    for r in texts.select(F.col(text).alias("text")).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def learn_ratios(raw: DataFrame, trusted: DataFrame, text: str = "text") -> Ratios:
    """Two multinomials over buckets, add-one smoothed, from all rows of ``raw`` and of ``trusted`` (whole texts, repeats included).

    Null texts are empty. Without any trusted n-gram every ratio is 0, so that no text goes by them.
    """
    p, q = gram_counts(trusted, text), gram_counts(raw, text)
    if not p.sum():
        return Ratios(np.zeros(BUCKETS))
    return Ratios(np.log((p + 1) / (p.sum() + BUCKETS)) - np.log((q + 1) / (q.sum() + BUCKETS)))


def judge(docs: DataFrame, ratios: Ratios, text: str = "text", id: str = "doc_id", least: float = LEAST_RATIO) -> DataFrame:
    """Rows (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio, base_failed, kept), one per row of ``docs``; no shuffle.

    Words are ``[^\\x20\\x09-\\x0D]+``. word_chars: code points in words; n_symbols: characters ``[#*$%&|<>]``;
    n_dup_lines: lines (cut at \\n) with a word that equal an earlier line; n_repeat_words: words in windows of
    WINDOW words that the text has twice or more, the first included. base_failed: fewer than LEAST_WORDS words,
    or more than MOST_REPEATED percent of them in repeated windows. ratio: mean log-likelihood ratio of the
    text's n-grams, 0 if it has none. kept: not base_failed, and ratio at least ``least``, for every text alike.

    Null texts are empty, and so not kept. Rows may repeat and have no id; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios.logs)  # of fixed size
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for batch in slices(batches, "text"):
            m = measures(batch.column("text"))
            grams, owner = hashed_grams(batch.column("text"))
            n = len(batch)
            ratio = np.bincount(owner, logs[grams], n) / np.maximum(np.bincount(owner, minlength=n), 1)
            failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
            columns = [*[pa.array(m[c], pa.int64()) for c in names], pa.array(ratio, pa.float64()), pa.array(failed), pa.array(~failed & (ratio >= least))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", *names, "ratio", "base_failed", "kept"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in names)}, ratio double, base_failed boolean, kept boolean"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
