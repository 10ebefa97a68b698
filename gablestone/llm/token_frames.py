"""Token ids in a binary file format of independent zstandard frames.

A shard file holds, one after the other:
  frames      one zstandard frame for each run of up to `frame_tokens` ids of one document (little-
              endian unsigned integers of `width` bytes), each with its content checksum;
  index       a skippable frame (magic 0x184D2A50): a zstandard frame of the arrays doc_id (int64),
              is_null (uint8), n_tokens (int64) and n_frames (uint32), after the header
              <n_docs: u64, width: u8>;
  seek table  a skippable frame (magic 0x184D2A5E) in the public seekable format: for each frame
              its size, its size when decompressed and the low 32 bits of the XXH64 of its content;
              then the number of frames, a descriptor with the checksum bit, magic 0x8F92EAB1.
A reader gets the two tables from the end of the file and then only the frames of the documents
that it wants; each frame is checked against the seek table.

Shards are ranges of doc_id in ascending order, so a document's place in the whole is the sum over
the shards before it plus its place in its own. A task writes to a name of its own and moves the
file into place when it is whole: a task that runs again leaves the same file.

Defined results: a null text is an empty one and has the end id only; a null doc_id comes first;
rows that repeat a doc_id stay, in the order of their texts; no rows give no files; other columns
are not read. A text of any length is cut into frames of bounded size.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablestone.llm._base import cut, scratch, texts

INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
SHARD_DOCS = 4096
FRAME_TOKENS = 1 << 18
#: Pieces that an encoder keeps; beyond that it starts anew. Texts of 90 MB have 950 000, in a process of some 400 MB.
MEMO = 1_400_000
MANIFEST = "shard int, file string, n_docs long, n_tokens long, n_bytes long"


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


class Encoder:
    """Ids of whole texts by the tokenizers library, piece by piece where that is the same."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        from gablestone.llm._pieces import splits_anywhere

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_piece = splits_anywhere(tokenizer_file)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # Bytes of each token; in a byte-level vocabulary a character stands for a byte.
        self.token_bytes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = added.get(i, len(token))
        self._forget()

    def _forget(self):
        from gablestone.llm._pieces import Numbers

        self.memo, self.n = Numbers(), 0
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.sizes = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: list) -> None:
        """Encode the pieces of keys that the memo has numbered, in the order of their numbers."""
        from gablestone.llm._pieces import JOINABLE, piece

        new = [piece(k) for k in keys]
        self.starts, self.sizes = _room(self.starts, self.n + len(new)), _room(self.sizes, self.n + len(new))
        row: list[list] = []
        joined = [k for k, p in enumerate(new) if JOINABLE(p)]
        alone = set(range(len(new))).difference(joined)
        for i in range(0, len(joined), 1000):
            part = joined[i : i + 1000]
            row.append(["".join([new[k] for k in part]), np.array(part), np.cumsum([len(new[k].encode()) for k in part])])
        row += [[new[k], np.array([k]), None] for k in sorted(alone)]
        for i in range(0, len(row), 500):
            for (_, part, ends), ids in zip(row[i : i + 500], self._ids([x[0] for x in row[i : i + 500]]), strict=True):
                ids = np.array(ids, np.uint32)
                cuts = np.array([len(ids)]) if ends is None else np.searchsorted(np.cumsum(self.token_bytes[ids]), ends, side="left") + 1
                self.pool = _room(self.pool, self.used + len(ids))
                self.pool[self.used : self.used + len(ids)] = ids
                self.starts[self.n + part] = self.used + np.concatenate([[0], cuts[:-1]])
                self.sizes[self.n + part] = np.diff(cuts, prepend=0)
                self.used += len(ids)
        self.n += len(new)

    def batch(self, texts: list[str]):
        """The ids of each text, as arrays."""
        if not self.by_piece:
            for t in texts:
                yield np.array(self._ids([t])[0], np.uint32)
            return
        for x in self._numbered(texts):
            sizes = self.sizes[x]
            ends = np.cumsum(sizes)
            yield self.pool[np.repeat(self.starts[x] - ends + sizes, sizes) + np.arange(ends[-1] if len(x) else 0)]

    def counts(self, texts: list[str]):
        """How many ids each text has."""
        if not self.by_piece:
            return [len(x) for x in self.batch(texts)]
        return [int(self.sizes[x].sum()) for x in self._numbered(texts)]

    def _numbered(self, texts: list[str]):
        """The numbers of the pieces of each text, all of them learned."""
        from gablestone.llm._pieces import keys

        part, size = [], 0
        for k, t in enumerate(texts):
            part.append(t)
            size += len(t)
            if size < 1_000_000 and k + 1 < len(texts):
                continue
            if self.n > MEMO:
                self._forget()
            memo = self.memo
            memo.new = []
            numbers = [np.fromiter(map(memo.__getitem__, keys(x)), np.int64) for x in part]
            if memo.new:
                try:
                    self._learn(memo.new)
                except BaseException:
                    # Numbers without their ids must not serve a later task.
                    self._forget()
                    raise
            yield from numbers
            part, size = [], 0


@lru_cache(maxsize=1)
def encoder(tokenizer_file: str, call: str) -> Encoder:
    """The encoder of one call in a worker process: the pieces it has learned serve the call's tasks that follow."""
    return Encoder(tokenizer_file)


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])


def write_shard(file: str, docs, width: int, frame_tokens: int = FRAME_TOKENS) -> tuple[int, int, int]:
    """Write (doc_id, ids) pairs to one file; the number of documents, of ids and of bytes."""
    import xxhash
    import zstandard

    where, path = _fs(file)
    where.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    press = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
    seek, doc_ids, nulls, sizes, frames = bytearray(), [], [], [], []
    with where.open_output_stream(own) as out:
        for doc_id, ids in docs:
            if len(ids) and int(ids.max()) >> 8 * width:
                raise ValueError(f"id {int(ids.max())} needs more than {width} bytes")
            pieces = range(0, max(1, len(ids)), frame_tokens)
            for i in pieces:
                raw = ids[i : i + frame_tokens].astype(f"<u{width}").tobytes()
                done = press.compress(raw)
                out.write(done)
                seek += struct.pack("<III", len(done), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)
            doc_ids.append(0 if doc_id is None else doc_id)
            nulls.append(doc_id is None)
            sizes.append(len(ids))
            frames.append(len(pieces))
        index = struct.pack("<QB", len(doc_ids), width) + press.compress(
            np.array(doc_ids, "<i8").tobytes() + np.array(nulls, "u1").tobytes() + np.array(sizes, "<i8").tobytes() + np.array(frames, "<u4").tobytes()
        )
        out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        out.write(struct.pack("<II", SEEK_MAGIC, len(seek) + 9) + bytes(seek) + struct.pack("<IBI", len(seek) // 12, 0x80, FOOTER_MAGIC))
        total = out.tell()
    where.move(own, path)
    return len(doc_ids), int(sum(sizes)), total


class ShardReader:
    """The documents of one shard file; only what is asked for is read and decompressed."""

    def __init__(self, file: str):
        import zstandard

        where, path = _fs(file)
        self.file, self.press = where.open_input_file(path), zstandard.ZstdDecompressor()
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != FOOTER_MAGIC or flags != 0x80:
            raise ValueError(f"{file}: no seek table at its end")
        at = size - 9 - 12 * n - 8
        if struct.unpack("<II", self.file.read_at(8, at)) != (SEEK_MAGIC, 12 * n + 9):
            raise ValueError(f"{file}: a broken seek table")
        table = np.frombuffer(self.file.read_at(12 * n, at + 8), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.raw, self.sums = table.T
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        head = self.file.read_at(8, int(self.starts[-1]))
        magic, length = struct.unpack("<II", head)
        if magic != INDEX_MAGIC:
            raise ValueError(f"{file}: no index after its frames")
        index = self.file.read_at(length, int(self.starts[-1]) + 8)
        m, self.width = struct.unpack("<QB", index[:9])
        data = self.press.decompress(index[9:], max_output_size=21 * m)
        self.doc_ids = np.frombuffer(data, "<i8", m)
        self.is_null = np.frombuffer(data, "u1", m, 8 * m).astype(bool)
        self.n_tokens = np.frombuffer(data, "<i8", m, 9 * m)
        self.frames = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<u4", m, 17 * m).astype(np.int64))])

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document."""
        import xxhash

        found = []
        for i in range(self.frames[k], self.frames[k + 1]):
            raw = self.press.decompress(self.file.read_at(int(self.sizes[i]), int(self.starts[i])), max_output_size=int(self.raw[i]))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i}: its checksum differs")
            found.append(np.frombuffer(raw, f"<u{self.width}"))
        return np.concatenate(found)

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The ids of the documents of this doc_id."""
        return [self.ids(k) for k in np.flatnonzero((self.doc_ids == doc_id) & ~self.is_null)]


def _id_bytes(tokenizer_file: str, end_id: int | None) -> int:
    from tokenizers import Tokenizer

    most = max([end_id or 0, *Tokenizer.from_file(tokenizer_file).get_vocab(with_added_tokens=True).values()])
    return 2 if most < 1 << 16 else 4


def write_frames(docs: DataFrame, path: str, tokenizer_file: str, end_id: int | None, width: int | None = None, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Encode docs (doc_id, text), append end_id to each and write them under path in ascending
    doc_id order; the table of the shards (shard, file, n_docs, n_tokens, n_bytes). Ids take width
    bytes, by default as many as the vocabulary needs."""
    width = width or _id_bytes(tokenizer_file, end_id)
    shards, call = max(1, -(-docs.count() // shard_docs)), uuid.uuid4().hex

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        own, tail = encoder(tokenizer_file, call), np.array([] if end_id is None else [end_id], np.uint32)

        def rows():
            for b in batches:
                ids = own.batch([t or "" for t in b.column("text").to_pylist()])
                for doc_id, x in zip(b.column("doc_id").to_pylist(), ids, strict=True):
                    yield doc_id, np.concatenate([x, tail])

        found, shard = rows(), TaskContext.get().partitionId()
        first = next(found, None)
        if first is not None:
            file = f"{path}/shard-{shard:07d}.ztok"
            n_docs, n_tokens, n_bytes = write_shard(file, (x for part in ([first], found) for x in part), width)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "file": file, "n_docs": n_docs, "n_tokens": n_tokens, "n_bytes": n_bytes}], schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))

    dealt = texts(docs).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    return cut(dealt.mapInArrow(run, MANIFEST), "token-manifest")


def read_frames(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 (of the ids as little-
    endian unsigned 32-bit integers) of every document, from the files of a manifest."""
    spark = manifest.sparkSession
    # One row a shard.
    start, rows = 0, []
    for r in sorted(manifest.collect(), key=lambda r: r["shard"]):
        rows.append((r["shard"], r["file"], start))
        start += r["n_tokens"]
    places = spark.createDataFrame(rows, "shard int, file string, start long").repartition(max(1, len(rows)), "shard")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for file, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                reader = ShardReader(file)
                n = reader.n_tokens
                starts = start + np.concatenate([[0], np.cumsum(n)[:-1]])
                sums = [zlib.crc32(reader.ids(k).astype("<u4").tobytes()) for k in range(len(n))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.doc_ids, pa.int64(), mask=reader.is_null), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return places.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1(docs: DataFrame, tokenizer_file: str, end_id: int = 2) -> DataFrame:
    return read_frames(write_frames(docs, scratch(docs.sparkSession, "tokens"), tokenizer_file, end_id))


def shard_files(spark: SparkSession, manifest: DataFrame) -> list[str]:
    return [r["file"] for r in manifest.select("file").collect()]
