"""Token ids in files of fixed-width bit-packed blocks, and reading them back by document."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.arrays import Memo, kept, larger, slices
from docspark.session import materialize, scratch_dir

#: Ids per block. A block starts at a whole byte, so any block can be read alone.
BLOCK = 1 << 16
#: Documents and bytes of text that are encoded at once; one longer text is encoded alone.
ROWS, TEXT_BYTES = 4000, 8 << 20
_MAGIC = b"IDBLOCK1"
_HEAD = "<8sIIQQQ"  # magic, bits per id, ids per block, ids, documents, byte where the tables begin
_HEAD_BYTES = struct.calcsize(_HEAD)

# Fixed value: how the byte-level vocabulary splits a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each id, one after the other, lowest bit first, filled up to a whole byte."""
    ids = np.ascontiguousarray(ids, "<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
    return np.packbits(planes.reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of a packed block as unsigned 32-bit integers."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = planes
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


class Writer:
    """One file: header, blocks, then the block offsets, the document ends and the document ids."""

    def __init__(self, sink, bits: int) -> None:
        self.sink, self.bits = sink, bits
        self.offsets, self.ends, self.docs, self.ids, self.open, self.held = [_HEAD_BYTES], [], [], 0, [], 0
        sink.write(struct.pack(_HEAD, _MAGIC, bits, BLOCK, 0, 0, 0))

    def add(self, doc: int, ids: np.ndarray) -> None:
        self.ids += len(ids)
        self.docs.append(doc)
        self.ends.append(self.ids)
        self._hold(ids)

    def add_all(self, docs: list[int], ids: np.ndarray, bounds: np.ndarray) -> None:
        """Many documents: ids one after the other, and where each one's begin and the last one's end."""
        self.docs += docs
        self.ends += (self.ids + bounds[1:]).tolist()
        self.ids += len(ids)
        self._hold(ids)

    def _hold(self, ids: np.ndarray) -> None:
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            self._flush(False)

    def _flush(self, all: bool) -> None:
        ids = np.concatenate(self.open) if self.open else np.zeros(0, np.uint32)
        full = len(ids) if all else len(ids) // BLOCK * BLOCK
        for k in range(0, full, BLOCK):
            self.sink.write(pack(ids[k : min(k + BLOCK, full)], self.bits))
            self.offsets.append(self.sink.tell())
        self.open, self.held = [ids[full:]], len(ids) - full

    def close(self) -> None:
        """The tables, and a closing header: everything in one forward pass, as object stores need it."""
        self._flush(True)
        tables = self.sink.tell()
        for table, kind in ((self.offsets, "<u8"), (self.ends, "<u8"), (self.docs, "<i8")):
            self.sink.write(np.asarray(table, kind).tobytes())
        self.sink.write(struct.pack(_HEAD, _MAGIC, self.bits, BLOCK, self.ids, len(self.docs), tables))
        self.sink.close()


class Reader:
    """Random access to one file: documents by place, ids by position; only the blocks asked for are read."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        magic, self.bits, self.block, self.ids, count, tables = struct.unpack(_HEAD, self._read(size - _HEAD_BYTES, _HEAD_BYTES))
        if magic != _MAGIC:
            raise ValueError("not a file of token ids")
        blocks = -(-self.ids // self.block) + 1
        data = self._read(tables, size - _HEAD_BYTES - tables)
        self.offsets = np.frombuffer(data, "<u8", blocks)
        self.ends = np.frombuffer(data, "<u8", count, 8 * blocks).astype(np.int64)
        self.docs = np.frombuffer(data, "<i8", count, 8 * (blocks + count))

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids at positions start to stop (not included) of the file."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        parts, first, last = [], start // self.block, (stop - 1) // self.block
        for b in range(first, last + 1):
            data = self._read(int(self.offsets[b]), int(self.offsets[b + 1] - self.offsets[b]))
            ids = unpack(data, min(self.block, self.ids - b * self.block), self.bits)
            parts.append(ids[max(0, start - b * self.block) : stop - b * self.block])
        return np.concatenate(parts)

    def document(self, place: int) -> np.ndarray:
        """All ids of the document at a place (0 is the first)."""
        return self.slice(int(self.ends[place - 1]) if place else 0, int(self.ends[place]))

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document id, position of its first id, ids) in order; one block is held at a time, and the document's ids."""
        at, block, ids = 0, -1, np.zeros(0, np.uint32)
        for doc, end in zip(self.docs.tolist(), self.ends.tolist(), strict=True):
            parts, k = [], at
            while k < end:
                if k // self.block != block:
                    block = k // self.block
                    ids = self.slice(block * self.block, min((block + 1) * self.block, self.ids))
                stop = min(end, (block + 1) * self.block)
                parts.append(ids[k - block * self.block : stop - block * self.block])
                k = stop
            yield doc, at, parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            at = end


class PieceEncoder:
    """Token ids by the tokenizers library; what a batch repeats is encoded once and remembered.

    A byte-level vocabulary merges within the pieces of its split pattern only, and a blank before a
    sign always begins a piece. So the ids of a text are those of its stretches between such blanks
    in turn. Texts with other blanks (doubled, or next to white space or an end) are cut by the
    pattern itself, texts in which a special token stands are handed to the library whole.
    """

    def __init__(self, path: str, size: int = 300_000) -> None:
        import re

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.find = regex.compile(PIECES).findall
        self.blanks = re.compile(r" \s").search
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = Memo(size)

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        ids, bounds = self.encode(pa.array(texts, pa.string()))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield ids[a:b]

    def encode(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each followed by ``end`` if given, and where each text's begin; null is empty.

        The words of all texts are numbered by Arrow, so that Python sees each distinct one once; the
        ids come from one gathering of the distinct words' ids.
        """
        texts = [t or "" for t in column.to_pylist()]
        whole = {k: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for k, t in enumerate(texts) if any(s in t for s in self.special)}
        odd = np.array([t[-1:] == " " or t[:1].isspace() or "\0" in t or self.blanks(t) is not None for t in texts], bool)
        plain = np.flatnonzero(~odd & ~np.isin(np.arange(len(texts)), list(whole)))
        words = pc.split_pattern(pa.array([texts[k] for k in plain.tolist()], pa.large_string()), " ")
        numbered = words.flatten().dictionary_encode()
        code, starts = numbered.indices.to_numpy().astype(np.int64), words.offsets.to_numpy() - words.offsets[0].as_py()
        keys = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        # stretches lack their blank: pieces keep theirs, so the two are told apart by a mark in front of a piece
        number = {}
        first = np.array([number.setdefault("\0" + keys[c], len(keys) + len(number)) for c in code[starts[:-1]].tolist()], np.int64)
        code[starts[:-1]] = first
        pieces = {k: [number.setdefault("\0" + p, len(keys) + len(number)) for p in self.find(texts[k])] for k in np.flatnonzero(odd).tolist() if k not in whole}
        keys += number
        self._learn(self.memo.missing(keys))
        known = self.memo.young.__getitem__
        values = [*map(known, keys), *whole.values(), b"" if end is None else np.array([end], "<u4").tobytes()]
        # slots of each text's codes, the last one for the end
        counts = np.ones(len(texts), np.int64)
        counts[plain] = np.diff(starts)
        for k, one in pieces.items():
            counts[k] = len(one)
        slots = np.concatenate([[0], np.cumsum(counts + 1)])
        codes = np.empty(slots[-1], np.int64)
        codes[slots[1:] - 1] = len(values) - 1
        fill = np.ones(len(codes), bool)
        fill[slots[1:] - 1] = False
        for n, k in enumerate(whole):
            codes[slots[k]] = len(keys) + n
            fill[slots[k]] = False
        for k, one in pieces.items():
            codes[slots[k] : slots[k] + len(one)] = one
            fill[slots[k] : slots[k + 1]] = False
        codes[fill] = code
        pool = np.frombuffer(b"".join(values), "<u4")
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        length = sizes[codes]
        ends = np.cumsum(length)
        at = np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - length), length)
        at += np.arange(len(at))
        return pool[at], np.concatenate([[0], ends])[slots]

    def _learn(self, stretches: list[str]) -> None:
        """Encode many at once: joined where the pattern cuts them again, each piece's ids known by its number."""
        young = self.memo.young
        joined, alone = [], []
        for s in stretches:
            (alone if s[:1] == "\0" else joined).append(s)
        for s, e in zip(alone, self.tokenizer.encode_batch([s[1:] for s in alone], add_special_tokens=False), strict=True):
            young[s] = np.array(e.ids, "<u4").tobytes()
        groups = [joined[k : k + 256] for k in range(0, len(joined), 256)]
        texts = ["".join([f" {s}" for s in g]) for g in groups]
        for g, e in zip(groups, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ids, at = np.array(e.ids, "<u4"), np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(e))[::2]
            starts = np.cumsum([0, *[len(s) + 1 for s in g]])
            bounds = np.searchsorted(at, starts).tolist()
            data = ids.tobytes()
            for s, i, j in zip(g, bounds[:-1], bounds[1:], strict=True):
                young[s] = data[4 * i : 4 * j]


def write_ids(
    docs: DataFrame,
    folder: str,
    vocabulary: int,
    encoder: Callable[[], Callable[[pa.Array, int | None], tuple[np.ndarray, np.ndarray]]],
    end: int | None = None,
    text: str = "text",
    id: str = "doc_id",
) -> DataFrame:
    """Encode and write all texts in ascending id order; rows (part, file, n_docs, n_ids), one per file written.

    Rows are range-partitioned by id and a hash of the text, so no task sees more than its share, and
    repeated ids keep a fixed order. Each task writes one file under a name of its own and only then
    returns a row; what a lost or repeated task left behind has no row, and is not read. ``end`` is
    appended to each document. Null texts are empty. Rows without an id come first, under id -2**63.
    """
    version = F.xxhash64(text)
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(-(2**63))).alias("id"), version.alias("version"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.repartitionByRange("id", "version").sortWithinPartitions("id", "version")
    rows = rows.select(F.spark_partition_id().alias("part"), "id", "text")
    bits = bits_for(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        writer, encode = None, encoder()
        for batch in slices(larger(batches, ROWS), "text", TEXT_BYTES):
            if writer is None:
                part, name = batch.column("part")[0].as_py(), f"{folder}/ids-{uuid.uuid4().hex}.bin"
                system, path = pafs.FileSystem.from_uri(name)
                system.create_dir(path.rpartition("/")[0], recursive=True)
                writer = Writer(system.open_output_stream(path), bits)
            writer.add_all(batch.column("id").to_pylist(), *encode(batch.column("text"), end))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [len(writer.docs)], "n_ids": [writer.ids]})

    return materialize(rows.mapInArrow(run, "part long, file string, n_docs long, n_ids long"), "id-files")


def file_starts(files: DataFrame) -> DataFrame:
    """``files`` with start: the ids in all files before it. One row per file, so far fewer than documents; as many partitions as files."""
    starts, at = [], 0
    for r in sorted(files.select("part", "file", "n_ids").collect()):
        starts.append((r["part"], r["file"], at))
        at += r["n_ids"]
    return files.sparkSession.createDataFrame(starts, "part long, file string, start long").repartition(max(1, len(starts)))


def read_ids(files: DataFrame) -> DataFrame:
    """Read the files of ``write_ids`` back: rows (doc_id, start, n_tokens, ids_crc32), one per document.

    start counts the ids of all documents before it; the checksum is over its ids as little-endian
    unsigned 32-bit integers. Files are dealt out to tasks, one to each; a file is read block by block.
    """
    rows = file_starts(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                system, path = pafs.FileSystem.from_uri(name)
                with system.open_input_file(path) as source:
                    out = [(d if d > -(2**63) else None, start + at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))) for d, at, ids in Reader(source).documents()]
                columns = list(zip(*out, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def piece_encoder(path: str, size: int = 300_000) -> Callable[[], Callable]:
    """A maker of encoders (a column of texts and the end id give ids and bounds) for a byte-level vocabulary file; one per Python worker."""
    return lambda: kept(f"pieces {path}", lambda: PieceEncoder(path, size), large=True).encode


def id_folder(spark) -> str:
    """A new folder below the shared one, as a URI that any file system library reads: a path without scheme is on Hadoop's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, "token-ids"))
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return folder if "://" in folder else folder.replace("file:", "file://", 1)
