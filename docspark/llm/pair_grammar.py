"""Re-Pair over many short sequences at once: rounds of frequent pairs, and one min-plus matrix per symbol."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.arrays import buffers

#: Rules of a grammar, rounds of pair counting, and rules added in one round, at most. What no rule covers stays a longer sequence of symbols.
MAX_RULES, ROUNDS, PER_ROUND = 2048, 10, 512
_SHIFT = 20


@dataclass
class Grammar:
    """rounds: for each round the pairs (left, right) replaced in it; symbols number from ``base`` on in that order. Symbol 0 separates sequences."""

    base: int
    rounds: list[list[tuple[int, int]]] = field(default_factory=list)

    @property
    def rules(self) -> list[tuple[int, int]]:
        return [pair for r in self.rounds for pair in r]


def symbols_of(column: pa.Array) -> np.ndarray:
    """The symbols of all sequences one after the other, each followed by 0: a letter's symbol is its place after the sign before 'a'."""
    data, _ = buffers(pc.binary_join_element_wise(column, "", "`"))
    return data.astype(np.int64) - 96


def _even_in_run(equal: np.ndarray) -> np.ndarray:
    """Of places where a symbol equals the next one, every other one from the start of its run on."""
    at = np.arange(len(equal))
    start = np.maximum.accumulate(np.where(equal & ~np.concatenate([[False], equal[:-1]]), at, -1))
    return equal & ((at - start) % 2 == 0)


def _pairs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of the pair that begins at each place, and whether it counts: not over a separator, in a run every other one."""
    left, right = x[:-1], x[1:]
    equal = left == right
    return (left << _SHIFT) | right, (left > 0) & (right > 0) & (~equal | _even_in_run(equal))


def compress(x: np.ndarray, grammar: Grammar) -> np.ndarray:
    """The sequences with all rules applied, round by round."""
    new = grammar.base
    for pairs in grammar.rounds:
        if not pairs:
            continue
        wanted = np.array([(a << _SHIFT) | b for a, b in pairs], np.int64)
        names = np.arange(new, new + len(pairs))
        order = np.argsort(wanted)
        new += len(pairs)
        if len(x) < 2:
            continue
        keys, counts = _pairs(x)
        at = np.minimum(np.searchsorted(wanted[order], keys), len(wanted) - 1)
        hit = np.flatnonzero(counts & (wanted[order][at] == keys))
        x = x.copy()
        x[hit] = names[order][at[hit]]
        x = np.delete(x, hit + 1)
    return x


def _apart(counted: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs, most frequent first, without those that could overlap one taken before: no symbol is both a left and a right end."""
    lefts, rights, out = set(), set(), []
    for a, b in counted:
        if a not in rights and b not in lefts and not (a == b and a in lefts):
            lefts.add(a)
            rights.add(b)
            out.append((a, b))
    return out


def learn(sequences: DataFrame, column: str, base: int) -> Grammar:
    """The grammar of all rows of ``column`` (letters from 'a' on, symbols 1 to ``base`` - 1).

    Each round counts adjacent pairs over all sequences, combined per task, and replaces the most
    frequent one, and with it those next in order that cannot overlap it, so that a round does the
    work of many steps of one pair each. A pair must occur twice. Only the most frequent pairs of a
    round (PER_ROUND) come to the driver.
    """
    grammar = Grammar(base)
    rows = sequences.select(F.col(column).alias("seq"))
    while len(grammar.rounds) < ROUNDS and len(grammar.rules) < MAX_RULES:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = compress(symbols_of(batch.column("seq")), grammar)
                keys, counts = _pairs(x) if len(x) > 1 else (x[:0], np.zeros(0, bool))
                pair, n = np.unique(keys[counts], return_counts=True)
                yield pa.RecordBatch.from_pydict({"pair": pair, "n": n})

        pairs = rows.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        room = min(PER_ROUND, MAX_RULES - len(grammar.rules))
        top = pairs.orderBy(F.col("n").desc(), "pair").limit(room).collect()
        if not top:
            break
        grammar.rounds.append(_apart([(r["pair"] >> _SHIFT, r["pair"] & ((1 << _SHIFT) - 1)) for r in top]))
    return grammar


#: A cost that no way has.
NEVER = 1 << 40


@dataclass
class Transfer:
    """Per symbol and pair of states: the least cost, the order of the audits among the symbol's 16, and for rules the state between the parts.

    Symbols below ``base`` have their audits as text; a rule's audit is a rope: its left part's up to the
    state between, then its right part's.
    """

    base: int
    rules: list[tuple[int, int]]
    cost: np.ndarray
    rank: np.ndarray
    mid: np.ndarray
    text: list[list[list[str | None]]]


def ranked(keys: list) -> list[int]:
    """Places of the keys in order, equal keys equal; None goes last."""
    place = {k: n for n, k in enumerate(sorted({k for k in keys if k is not None}))}
    return [len(place) if k is None else place[k] for k in keys]


def chain(first: tuple, second: tuple, states: int) -> tuple[list, list, list]:
    """Min-plus product of two (cost, rank) matrices as nested lists: cost, rank and the state between, ties by the least audit.

    Every audit ends in the letter of its last row, so none of two audits of the same rows continues
    the other, and the order of joined audits is that of the pairs of ranks.
    """
    (c1, r1), (c2, r2) = first, second
    cost, mid, keys = [], [], []
    for i in range(states):
        for j in range(states):
            best = min((c1[i][k] + c2[k][j], r1[i][k], r2[k][j], k) for k in range(states))
            reached = best[0] < NEVER
            cost.append(best[0] if reached else NEVER)
            mid.append(best[3])
            keys.append(best[1:3] if reached else None)
    rank = ranked(keys)
    fold = [slice(i * states, (i + 1) * states) for i in range(states)]
    return [cost[s] for s in fold], [rank[s] for s in fold], [mid[s] for s in fold]


def evaluate(grammar: Grammar, cost: list, text: list) -> Transfer:
    """The matrices of all symbols, bottom-up: each rule's from those of its two parts, once."""
    states = len(cost[0])
    flat = [ranked([t for row in m for t in row]) for m in text]
    costs = [[[c if c is not None else NEVER for c in row] for row in m] for m in cost]
    ranks = [[r[i * states : (i + 1) * states] for i in range(states)] for r in flat]
    mids = [[[0] * states for _ in range(states)] for _ in cost]
    for a, b in grammar.rules:
        c, r, m = chain((costs[a], ranks[a]), (costs[b], ranks[b]), states)
        costs.append(c)
        ranks.append(r)
        mids.append(m)
    return Transfer(grammar.base, grammar.rules, np.array(costs, np.int64), np.array(ranks, np.int8), np.array(mids, np.int8), text)


def rope_text(t: Transfer, symbol: int, i: int, j: int, memo: dict | None = None) -> str:
    """The audit of a symbol from state i to state j."""
    if symbol < t.base:
        return t.text[symbol][i][j]
    key = (symbol, i, j)
    if memo is not None and key in memo:
        return memo[key]
    (a, b), k = t.rules[symbol - t.base], int(t.mid[symbol, i, j])
    out = rope_text(t, a, i, k, memo) + rope_text(t, b, k, j, memo)
    if memo is not None:
        memo[key] = out
    return out
