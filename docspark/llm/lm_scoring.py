"""Subword lattice likelihood: the probability of a text summed over all its segmentations into vocabulary pieces."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.arrays import larger, mix, slices
from docspark.session import materialize

#: Bytes of text that share one dictionary of words while their scores are looked up.
BLOCK_BYTES = 16 << 20
#: Distinct words whose lattices are worked on at once, those of one length together.
WORDS = 40_000
#: Rounds of expectation and maximization that fit the vocabulary's scores to the training words.
ROUNDS = 2
#: Added to each piece's expected count.
PRIOR = 0.1
_MARK, _STEP = "▁", np.uint64(0x5851F42D4C957F2D)


@dataclass
class Vocabulary:
    """Pieces with log scores: a hash table of their code points, one score per piece, per byte, and for the end of a text."""

    table: np.ndarray
    index: np.ndarray
    longest: int
    score: np.ndarray
    byte: np.ndarray
    end: float

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the piece with this hash, or -1."""
        slot = (mix(hashes) >> np.uint64(44)).astype(np.int64)
        index = self.index[slot]
        out = np.where(self.table[slot] == hashes, index, -1)
        rest = np.flatnonzero((out < 0) & (index >= 0))  # a place taken by another piece: try the next ones
        for probe in range(1, self.table.shape[0] - (1 << 20) + 1):
            at = slot[rest] + probe
            hit = self.table[at] == hashes[rest]
            out[rest[hit]] = self.index[at[hit]]
        return out


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a sentencepiece model and their scores, made probabilities by the law of ranks.

    A model of merges scores a piece by less than the one merged before it; its place in that order is
    taken as its rank by frequency.
    """
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [i for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
    pieces = [lib.id_to_piece(i) for i in sorted(kept, key=lambda i: (-lib.get_score(i), i))]
    hashes = [_hash(np.array([list(map(ord, p))], np.uint64), 0, len(p))[0] for p in pieces]
    width = 1
    while True:
        table, index = np.zeros((1 << 20) + width - 1, np.uint64), np.full((1 << 20) + width - 1, -1, np.int64)
        if all(_put(table, index, h, k, width) for k, h in enumerate(hashes)):
            break
        width += 1
    rank = 1 / (np.arange(len(pieces)) + 3.0)
    total = rank.sum() * 1.02
    return Vocabulary(table, index, max(map(len, pieces)), np.log(rank / total), np.full(256, np.log(0.01 / 256)), float(np.log(0.01)))


def _hash(codes: np.ndarray, start: int, stop: int) -> np.ndarray:
    h = np.full(len(codes), 7, np.uint64)
    for k in range(start, stop):
        h = h * _STEP + codes[:, k]
    return h


def _put(table: np.ndarray, index: np.ndarray, h: int, k: int, width: int) -> bool:
    slot = int(mix(np.array([h], np.uint64))[0] >> np.uint64(44))
    for at in range(slot, slot + width):
        if index[at] < 0:
            table[at], index[at] = h, k
            return True
    return False


def same_length(words: list[str], most: int = 8000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of words with a mark in front, those of one length together."""
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, cuts):
        n = int(sizes[group[0]]) + 1
        step = max(1, min(most, (1 << 18) // n))  # a slice's edges fit in some MB
        for k in range(0, len(group), step):
            part = group[k : k + step]
            text = "".join([_MARK + words[i] for i in part.tolist()])
            yield part, np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(part), n).astype(np.uint64)


def edges(codes: np.ndarray, v: Vocabulary, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, piece or -1, log score) of each stretch from ``start``; a character without a piece has its bytes' score."""
    h = np.full(len(codes), 7, np.uint64)
    for size in range(1, min(v.longest, codes.shape[1] - start) + 1):
        h = h * _STEP + codes[:, start + size - 1]
        piece = v.find(h)
        score = np.where(piece >= 0, v.score[piece], -np.inf)
        if size == 1:
            for k in np.flatnonzero(piece < 0).tolist():
                score[k] = v.byte[list(chr(int(codes[k, start])).encode())].sum()
        yield size, piece, score


def forward(codes: np.ndarray, v: Vocabulary, known_edges: list | None = None) -> np.ndarray:
    """Log probability of each beginning of the words, summed over its segmentations, by recursion over the positions."""
    n = codes.shape[1]
    alpha = np.full((len(codes), n + 1), -np.inf)
    alpha[:, 0] = 0
    for i in range(n):
        for size, _, score in known_edges[i] if known_edges else edges(codes, v, i):
            alpha[:, i + size] = np.logaddexp(alpha[:, i + size], alpha[:, i] + score)
    return alpha


def expected_counts(codes: np.ndarray, times: np.ndarray, v: Vocabulary, pieces: np.ndarray, bytes_: np.ndarray) -> None:
    """Add how often each piece and byte is expected in the words' segmentations."""
    n = codes.shape[1]
    known_edges = [list(edges(codes, v, i)) for i in range(n)]
    alpha = forward(codes, v, known_edges)
    beta = np.full((len(codes), n + 1), -np.inf)
    beta[:, n] = 0
    for i in range(n - 1, -1, -1):
        for size, piece, score in known_edges[i]:
            beta[:, i] = np.logaddexp(beta[:, i], score + beta[:, i + size])
            share = np.exp(alpha[:, i] + score + beta[:, i + size] - alpha[:, n]) * times
            known = piece >= 0
            pieces += np.bincount(piece[known], share[known], len(pieces))
            if size == 1:
                for k in np.flatnonzero(~known).tolist():
                    np.add.at(bytes_, list(chr(int(codes[k, i])).encode()), share[k])


def word_postings(docs: DataFrame, text: str, id: str, training: Column, block: int = BLOCK_BYTES) -> DataFrame:
    """Per block of texts one row per distinct word, and one row, without a word, for the block itself.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z in lower case. A word's row has its number k in the block
    and how many times it occurs in training texts. The block's row has the ids, training marks and
    word counts of its texts, the number of words, all words of training texts (as times), and the
    postings: for each word in turn the places of the texts that hold it (16 bits), and how often
    (8 bits; more than 255 take more postings); starts says where each word's postings begin.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"), training.alias("train"), F.spark_partition_id().alias("part"))
    fields = [("block", pa.int64()), ("word", pa.string()), ("k", pa.int32()), ("times", pa.int64()), ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
              ("sizes", pa.list_(pa.int64())), ("starts", pa.binary()), ("places", pa.binary()), ("counts", pa.binary())]

    def rows_of(number: int, ids: list, texts: list[str], train: np.ndarray) -> Iterator[pa.RecordBatch]:
        split = [t.encode().lower().split() for t in texts]
        sizes = np.array([len(s) for s in split], np.int64)
        coded = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = len(coded.dictionary)
        pair, count = np.unique(code * len(split) + np.repeat(np.arange(len(split)), sizes), return_counts=True)
        word, place = pair // len(split), pair % len(split)
        times = np.bincount(word, count * train[place], n).astype(np.int64)
        parts = -(-count // 255)
        word, place = np.repeat(word, parts), np.repeat(place, parts)
        last = np.cumsum(parts) - 1
        each = np.full(len(word), 255)
        each[last] = count - 255 * (parts - 1)
        starts = np.searchsorted(word, np.arange(n + 1))
        for at in range(0, n, 50_000):
            some = min(n - at, 50_000)
            part = {"block": pa.array(np.full(some, number)), "word": coded.dictionary[at : at + some].cast(pa.string()), "k": pa.array(np.arange(at, at + some, dtype=np.int32)), "times": pa.array(times[at : at + some])}
            yield pa.RecordBatch.from_arrays([part.get(c, pa.nulls(some, t)) for c, t in fields], [c for c, _ in fields])
        one = [number, None, n, int(sizes[train].sum()), ids, train.tolist(), sizes.tolist(), starts.astype("<u4").tobytes(), place.astype("<u2").tobytes(), each.astype("u1").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, (_, t) in zip(one, fields, strict=True)], [c for c, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = 0, [], 0
        for batch in slices(batches, "text", block // 8):
            held.append(batch)
            size += batch.nbytes
            if size >= block:
                number += 1
                yield from flush(number, held)
                held, size = [], 0
        if held:
            yield from flush(number + 1, held)

    def flush(number: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        for at in range(0, len(table), 1 << 16):  # places have 16 bits
            part = table.slice(at, 1 << 16)
            key = part.column("part")[0].as_py() << 40 | number << 16 | at >> 16
            yield from rows_of(key, part.column("id").to_pylist(), part.column("text").to_pylist(), np.array(part.column("train").to_pylist(), bool))

    schema = "block long, word string, k int, times long, ids array<long>, train array<boolean>, sizes array<long>, starts binary, places binary, counts binary"
    return rows.mapInArrow(run, schema)


def fit_scores(words: DataFrame, vocabulary: Vocabulary, texts: int = 0, rounds: int = ROUNDS) -> Vocabulary:
    """Scores of the existing pieces, re-estimated from all of the given words (word, times) and the number of texts.

    Each round is one pass over the distinct words; a task adds up its expected counts, and one sum per
    piece, so a table of the vocabulary's size, comes to the driver.
    """
    v = vocabulary
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(astuple(v))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            v = Vocabulary(*shared.value)
            pieces, bytes_ = np.zeros(len(v.score)), np.zeros(256)
            for batch in larger(batches, WORDS):
                times = batch.column("times").to_numpy(zero_copy_only=False).astype(float)
                for at, codes in same_length(batch.column("word").to_pylist()):
                    expected_counts(codes, times[at], v, pieces, bytes_)
            counts = np.concatenate([pieces, bytes_])
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"piece": at, "n": counts[at]})

        sums = words.select("word", "times").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = np.full(len(v.score) + 256, PRIOR)
        for r in sums.collect():  # at most one row per piece and byte
            counts[r["piece"]] += r["n"]
        total = counts.sum() + texts + PRIOR
        logs = np.log(counts / total)
        v = Vocabulary(v.table, v.index, v.longest, logs[:-256], logs[-256:], float(np.log((texts + PRIOR) / total)))
    return v


def score_texts(docs: DataFrame, path: str, training: Column, text: str = "text", id: str = "doc_id", rounds: int = ROUNDS, mixture: bool = False) -> DataFrame:
    """Rows (id, train, n_tokens, n_known, train_tokens, base_score, score), one per row of ``docs``; with ``mixture`` mixture_score too.

    score is the log10 probability of the text under a unigram model of the pieces in the vocabulary
    file ``path`` alone: each word's probability, summed over all its segmentations by the forward
    recursion in log space, and that of the end. The vocabulary is as it is; its scores start from those
    of the file and are fitted to all words of the ``training`` rows (``rounds=0``: those of the file).
    n_tokens counts words and one end; n_known those tokens seen in training; train_tokens all training
    tokens; base_score is the log10 probability under add-one word counts.

    mixture_score gives a word of the training texts one more path, the word whole, scored by its
    frequency; the end of a text is such a token too. The pieces' paths share what the seen tokens
    leave: distinct tokens / (tokens + distinct tokens), the expected share of new ones (Witten and
    Bell; copied documents hardly change it).

    Counts and probabilities are looked up by a join on the word, so nothing that grows with the
    corpus is broadcast: a block of texts is one row per distinct word, whose postings lead back to
    the block's texts. Null and empty texts are the end alone. A null ``training`` is false. Rows that
    repeat an id stay rows of their own; a null id stays null. Without training rows the file's scores
    stand. Empty tables give empty results. Other columns are not read.
    """
    postings = materialize(word_postings(docs, text, id, F.coalesce(training, F.lit(False))), "postings")
    listed, held = postings.filter(F.col("word").isNull()), postings.filter(F.col("word").isNotNull())
    words = materialize(held.groupBy("word").agg(F.sum("times").alias("times")), "words")
    tokens, texts = listed.agg(F.sum("times"), F.sum(F.size(F.filter("train", lambda x: x)))).first()
    known = words.filter("times > 0")
    tokens, texts = (tokens or 0) + (texts or 0), texts or 0
    distinct = known.count() + (texts > 0)
    fresh = distinct / (tokens + distinct) if tokens else 1.0
    vocabulary = read_vocabulary(path)
    if texts:
        vocabulary = fit_scores(known, vocabulary, rounds=rounds)
    shared = docs.sparkSession.sparkContext.broadcast(astuple(vocabulary))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        for batch in larger(batches, WORDS):
            all_words = batch.column("word").to_pylist()
            out = np.zeros(len(all_words))
            for at, codes in same_length(all_words):
                out[at] = forward(codes, v)[:, -1]
            logs = [out]
            if mixture and tokens:
                with np.errstate(divide="ignore"):
                    whole = np.log(batch.column("times").to_numpy(zero_copy_only=False) / tokens)
                logs.append(np.logaddexp(whole + np.log1p(-fresh), out + np.log(fresh)))
            elif mixture:
                logs.append(out)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("times"), *[pa.array(x / np.log(10)) for x in logs]], ["word", "seen", *logps])

    logps = ["logp", "mixed"] if mixture else ["logp"]
    weighed = words.mapInArrow(weigh, f"word string, seen long, {', '.join(f'{c} double' for c in logps)}")
    rows = held.select("block", "word", "k").join(weighed, "word").select("block", "k", "seen", *logps)
    whole = ["ids", "train", "sizes", "starts", "places", "counts"]
    rows = rows.withColumns({c: F.lit(None).cast(listed.schema[c].dataType) for c in whole})
    rows = rows.unionByName(listed.select("block", "k", F.lit(None).cast("long").alias("seen"), *[F.lit(None).cast("double").alias(c) for c in logps], *whole))
    rows = rows.repartition("block").sortWithinPartitions("block", F.col("ids").isNull())
    floor = float(tokens + distinct + 1)
    end = vocabulary.end / np.log(10)
    ends = [end, np.log10((1 - fresh) * texts / tokens) if texts else end][: len(logps)]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # block, its row, and per word whether and how often it was seen, and its scores

        def done() -> pa.RecordBatch:
            _, row, seen, logs = state
            n = len(row["ids"])
            each = np.diff(np.frombuffer(row["starts"], "<u4").astype(np.int64))
            place, count = np.frombuffer(row["places"], "<u2"), np.frombuffer(row["counts"], "u1").astype(np.float64)
            add = lambda x: np.bincount(place, count * np.repeat(x, each), n)
            known = add((seen > 0).astype(float)).round().astype(np.int64) + (texts > 0)
            base = add(np.log10((seen + 1) / floor)) + np.log10((texts + 1) / floor)
            arrays = [row["ids"], row["train"], np.array(row["sizes"], np.int64) + 1, known, np.full(n, tokens), base, *[add(x) + e for x, e in zip(logs, ends, strict=True)]]
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), *[pa.float64()] * len(logs)]
            names = ["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score", "mixture_score"][: len(kinds)]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(arrays, kinds, strict=True)], names)

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if state is None or state[0] != blocks[a]:
                    if state is not None:
                        yield done()
                    row = {c: batch.column(c)[a].as_py() for c in whole}
                    words_here = batch.column("k")[a].as_py()
                    state = (blocks[a], row, np.zeros(words_here, np.int64), np.zeros((len(logps), words_here)))
                    a += 1
                part = batch.slice(a, b - a)
                k = part.column("k").to_numpy(zero_copy_only=False)
                state[2][k] = part.column("seen").to_numpy(zero_copy_only=False)
                for n, c in enumerate(logps):
                    state[3][n, k] = part.column(c).to_numpy(zero_copy_only=False)
        if state is not None:
            yield done()

    schema = "id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = rows.mapInArrow(gather, schema + (", mixture_score double" if mixture else ""))
    return out.withColumnRenamed("id", id)
