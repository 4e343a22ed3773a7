"""Exact merge-type encoding of SentencePiece models by backtracking, and decoding."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docspark.llm.arrays import Memo, kept, slices

_MARK = "▁"
#: Characters that are worked on side by side, and texts below which that is slower than one by one.
_CHUNK, _FEW = 1 << 18, 32
#: Bytes of text that are encoded at once: half of the usual, as many ids are held beside them.
_SLICE = 1 << 20
_SLOTS = 20  # bits of a place in the table of known neighbours


class PieceModel:
    """The pieces of a merge-type (BPE) model with byte fallback, ready for backtracking.

    The greedy merge result of a text is the one sequence of pieces in which every two neighbours are
    compatible: merging their joined characters again gives just these two. ``encode`` walks the text
    with the longest piece that matches and is compatible with the one before, tries shorter ones
    where none fits, steps back where none is left, and marks each position from which nothing leads
    to the end in a bitfield, so no position is tried twice. Pieces that their own characters do not
    merge to never occur and are left out. Characters without a piece become their UTF-8 bytes.

    ``many`` takes one such step of all texts at a time, on arrays; ``backtrack`` walks a single one.
    """

    def __init__(self, path: str, memo: int = 100_000) -> None:
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.score = {}
        self.id = {}
        self.byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for i in range(lib.get_piece_size()):
            if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)):
                self.id[lib.id_to_piece(i)] = i
                self.score[lib.id_to_piece(i)] = lib.get_score(i)
        self.histories: dict[str, tuple] = {}
        self.usable = {p for p in self.id if len(p) == 1 or self.merge(list(p)) == [p]}
        self.names = sorted(self.usable)
        self.number = {p: k for k, p in enumerate(self.names)}
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.usable), None) for p in self.names}
        self.trie = ahocorasick.Automaton()
        for p, k in self.number.items():
            if len(p) > 1:
                self.trie.add_word(p[::-1], k)
        self.trie.make_automaton()
        #: Neighbours inside some piece: no piece, so no merge, reaches over any other two characters.
        self.inside = {p[k : k + 2] for p in self.usable for k in range(len(p) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo = Memo(memo)
        self._arrays()

    def _arrays(self) -> None:
        """The same tables by number of piece and code point."""
        self.piece_ids = np.array([self.id[p] for p in self.names], np.int32)
        self.byte_ids = np.array(self.byte, np.int32)
        self.sizes = np.array([len(p) for p in self.names], np.int64)
        self.less = np.array([self.number.get(self.shorter[p], -1) for p in self.names], np.int32)
        self.single = np.full(0x110000, -1, np.int32)
        for p, k in self.number.items():
            if len(p) == 1:
                self.single[ord(p)] = k
        letters = {c: k + 1 for k, c in enumerate(sorted(set().union(*self.inside)))}
        self.letter = np.zeros(0x110000, np.uint16)
        self.letter[[ord(c) for c in letters]] = list(letters.values())
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for one, two in self.inside:
            self.joined[letters[one], letters[two]] = True
        used = set().union(*self.id)
        self.gap = next(chr(k) for k in range(0x110000) if chr(k) not in used)
        self.decimal = [str(k) for k in range(self.library.get_piece_size())]
        self.slot_pair, self.slot_fits = np.full(1 << _SLOTS, -1, np.int64), np.zeros(1 << _SLOTS, bool)

    def merge(self, parts: list[str]) -> list[str]:
        """Join the neighbours with the best score, the leftmost of equals, until no two make a piece."""
        parts = list(parts)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 400_000:
                self.pairs.clear()
            # both are what their own characters merge to; only merges across the border can differ
            known = self.pairs[a, b] = a[-1] + b[0] not in self.inside or self.stay_apart(a, b)
        return known

    def history(self, piece: str) -> tuple[list[float], list[str], list[str]]:
        """The scores of the merges of a piece's characters in order, and its first and last part before each and at the end."""
        found = self.histories.get(piece)
        if found is None:
            parts, score = list(piece), self.score
            scores, heads, tails = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                best, at = max((score.get(parts[k] + parts[k + 1], -np.inf), -k) for k in range(len(parts) - 1))
                at = -at
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                scores.append(best)
                heads.append(parts[0])
                tails.append(parts[-1])
            found = self.histories[piece] = scores, heads, tails
        return found

    def stay_apart(self, a: str, b: str) -> bool:
        """Whether the characters of two pieces merge to just these two: both histories go on by score, the left one first at
        equal scores, and no merge across the border has its turn."""
        own, _, tails = self.history(a)
        other, heads, _ = self.history(b)
        score, i, j, n, m = self.score, 0, 0, len(own), len(other)
        while True:
            across = score.get(tails[i] + heads[j])
            if across is not None and (i == n or across > own[i]) and (j == m or across >= other[j]):
                return False
            if i < n and (j == m or own[i] >= other[j]):
                i += 1
            elif j < m:
                j += 1
            else:
                return True

    def longest_matches(self, text: str) -> list[str | None]:
        """For each position the longest piece that begins there: Aho-Corasick over the reversed text."""
        n = len(text)
        usable, names = self.usable, self.names
        out: list[str | None] = [c if c in usable else None for c in text]
        last = -1
        for end, k in self.trie.iter(text[::-1]):  # the longest of an end comes first
            if end != last:
                out[n - 1 - end] = names[k]
                last = end
        return out

    def backtrack(self, text: str) -> list[str]:
        """The pieces of a text all of whose characters are pieces."""
        n, longest, shorter, pairs = len(text), self.longest_matches(text), self.shorter, self.pairs
        failed = 0  # bit k: nothing leads from position k to the end
        out: list[str] = []
        at, last, piece = 0, None, longest[0]
        while True:
            while piece is not None:
                if not failed >> at + len(piece) & 1:
                    if last is None:
                        break
                    fits = pairs.get((last, piece))
                    if self.compatible(last, piece) if fits is None else fits:
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                at += len(piece)
                if at == n:
                    return out
                last, piece = piece, longest[at]
            else:
                failed |= 1 << at
                if not out:
                    raise ValueError("no sequence of pieces makes up the text")
                dropped = out.pop()
                at -= len(dropped)
                last, piece = out[-1] if out else None, shorter[dropped]

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each begins (and the last ends).

        Texts are cut where no piece reaches over; one character without a piece becomes bytes.
        """
        text = self.gap.join(texts) + self.gap
        n = len(text)
        signs = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        gaps = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        longest = self._longest(text, signs)
        letters = self.letter[signs]
        on = np.zeros(n + 1, bool)  # whether some piece reaches over from the position before
        on[1:n] = self.joined[letters[:-1], letters[1:]]
        alone = ~(on[:-1] | on[1:])
        chosen = np.where(alone, longest, -1)
        self._walk(text, longest, chosen, np.flatnonzero(on[1:] & ~on[:-1]), np.flatnonzero(on[:-1] & ~on[1:]) + 1)

        counts = (chosen >= 0).astype(np.int64)
        alone[gaps] = False
        bare = np.flatnonzero(alone & (chosen < 0))
        kinds, kind = np.unique(signs[bare], return_inverse=True)
        coded = [chr(c).encode() for c in kinds]
        lengths = np.array([len(c) for c in coded], np.int64)
        counts[bare] = lengths[kind]
        at = np.zeros(n + 1, np.int64)
        np.cumsum(counts, out=at[1:])
        ids = np.empty(at[-1], np.int32)
        whole = np.flatnonzero(chosen >= 0)
        ids[at[whole]] = self.piece_ids[chosen[whole]]
        for j in range(4):
            some = lengths[kind] > j
            values = np.array([c[j] if j < len(c) else 0 for c in coded], np.int64)
            ids[at[bare[some]] + j] = self.byte_ids[values[kind[some]]]
        return ids, at[np.append(0, gaps + 1)]

    def _longest(self, text: str, signs: np.ndarray) -> np.ndarray:
        """``longest_matches`` as numbers of pieces, -1 where none begins."""
        n, longest, last = len(text), self.single[signs], -1
        found = chain.from_iterable(self.trie.iter(text[::-1]))
        while len(block := np.fromiter(islice(found, 2 << 18), np.int64)):
            ends, piece = block[::2], block[1::2]
            first = np.diff(ends, prepend=last) != 0  # the longest of an end comes first
            longest[n - 1 - ends[first]] = piece[first]
            last = ends[-1]
        return longest

    def _walk(self, text: str, longest: np.ndarray, chosen: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> None:
        """``backtrack`` from each ``begin`` to its ``stop``, a step of all at a time; ``chosen`` gets the piece that begins at a position."""
        failed = np.zeros(len(text) + 1, bool)  # nothing leads from here to the end
        before = np.zeros(len(text) + 1, np.int64)  # where the piece begins that ends here
        at, last, piece = begin.copy(), np.full(len(begin), -1, np.int32), longest[begin]
        while len(at) >= _FEW:
            back = np.flatnonzero(piece < 0)
            if len(back):
                failed[at[back]] = True
                if (at[back] == begin[back]).any():
                    raise ValueError("no sequence of pieces makes up the text")
                to = before[at[back]]
                piece[back] = self.less[chosen[to]]
                chosen[to] = -1
                at[back] = to
                last[back] = np.where(to == begin[back], -1, chosen[before[to]])
            k = np.flatnonzero(piece >= 0)
            here, now, prior = at[k], piece[k], last[k]
            to = here + self.sizes[now]
            fits = ~failed[to]
            asked = np.flatnonzero(fits & (prior >= 0))
            fits[asked] = self._fits(prior[asked], now[asked])
            piece[k[~fits]] = self.less[now[~fits]]
            k, here, now, to = k[fits], here[fits], now[fits], to[fits]
            chosen[here], before[to] = now, here
            at[k], last[k], piece[k] = to, now, longest[to]
            if (at[k] == stop[k]).any():
                rest = at != stop
                begin, stop, at, last, piece = begin[rest], stop[rest], at[rest], last[rest], piece[rest]
        for b, e in zip(begin.tolist(), stop.tolist(), strict=True):
            chosen[b:e] = -1
            for p in self.backtrack(text[b:e]):
                chosen[b] = self.number[p]
                b += len(p)

    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` of neighbours inside some piece; a slot keeps the last pair that fell to it."""
        pair = a.astype(np.int64) * len(self.names) + b
        slot = ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)
        fits = self.slot_fits[slot]
        new = np.flatnonzero(self.slot_pair[slot] != pair)
        if len(new):
            kinds, first, kind = np.unique(pair[new], return_index=True, return_inverse=True)
            names = self.names
            found = np.array([self.stay_apart(names[i], names[j]) for i, j in zip(a[new[first]].tolist(), b[new[first]].tolist(), strict=True)], bool)
            fits[new] = found[kind]
            for s, p, f in zip(slot[new[first]].tolist(), kinds.tolist(), found.tolist(), strict=True):
                self.slot_pair[s], self.slot_fits[s] = p, f
        return fits

    def learn(self, stretches: list[str]) -> None:
        """Keep the ids of stretches of normalized text, as bytes."""
        young, sizes = self.memo.young, np.fromiter(map(len, stretches), np.int64, len(stretches))
        chunk = (np.cumsum(sizes) // _CHUNK) if len(sizes) else sizes
        bounds = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(stretches)]
        for b, e in zip(bounds[:-1], bounds[1:], strict=True):
            some = stretches[b:e]
            if some:
                ids, at = self.many([_MARK + s for s in some])
                raw, at = ids.tobytes(), (at * ids.itemsize).tolist()
                young.update(zip(some, [raw[i:j] for i, j in zip(at[:-1], at[1:], strict=True)], strict=True))

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], str]]:
        """(ids, the same in decimal joined by commas) of each text.

        Normalization is that of the model: a mark in front, and each blank a mark. No piece has a mark
        behind another sign, so a text falls into stretches that begin with a mark, each encoded once.
        """
        cut = [t.replace(_MARK, " ").split(" ") if t else [] for t in texts]
        runs = [merge_blanks(one) if "" in one else one for one in cut]
        self.learn(self.memo.missing(set().union(*runs)))
        known, decimal = self.memo.young.__getitem__, self.decimal.__getitem__
        for one in runs:
            ids = np.frombuffer(b"".join(map(known, one)), np.int32).tolist()
            yield ids, ",".join(map(decimal, ids))

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids)


def merge_blanks(parts: list[str]) -> list[str]:
    """Parts between blanks, with the marks of doubled blanks put in front of the part that follows them."""
    out, marks = [], ""
    for k, p in enumerate(parts):
        if p or k == len(parts) - 1:
            out.append(marks + p)
            marks = ""
        else:
            marks += _MARK
    return out


def piece_model(path: str, memo: int = 100_000) -> Callable[[], PieceModel]:
    """A maker of the model; one per Python worker."""
    return lambda: kept(f"model {path}", lambda: PieceModel(path, memo), large=True)


def encode_decode(docs: DataFrame, model: Callable[[], PieceModel], text: str = "text", id: str = "doc_id", ids: bool = False) -> DataFrame:
    """Rows (id, n_tokens, ids_sha256, decoded_sha256, decoded, ids), one per row of ``docs``; no shuffle.

    ids_sha256 is over the decimal ids joined by commas, decoded the text that the ids decode to,
    decoded_sha256 over its UTF-8 bytes. ids (array) only if asked for. Null is the empty text, which
    has no ids. Repeated rows and null ids keep their rows. Columns other than id and text are not read.
    """
    rows = docs.select(id, text) if id != text else docs.select(id)
    schema = f"`{id}` {rows.schema[id].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = model()
        for batch in slices(batches, text, _SLICE):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            numbers, joined = zip(*codec.encode(texts), strict=True)
            decoded = codec.decode(list(numbers))
            columns = [
                batch.column(id),
                pa.array([len(x) for x in numbers], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined]),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                pa.array(decoded, pa.string()),
            ]
            names = [id, "n_tokens", "ids_sha256", "decoded_sha256", "decoded"]
            if ids:
                columns.append(pa.array(numbers, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema + (", ids array<long>" if ids else ""))
