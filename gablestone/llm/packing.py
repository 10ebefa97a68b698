"""Best-fit packing of documents into sequences of fixed length, with conflicts.

Documents are dealt into shards by hash, of a bounded number of documents; each shard is packed by
itself, the longest pieces first. A document longer than a sequence is cut: its full pieces are
sequences of their own, its rest is packed. Open bins are ordered by what is left in them. A bin
carries a bitmap of the sources and one of the duplicate clusters in it; a piece may not join a bin
that has its source or its cluster. The search goes to the tightest bin that the piece fits (the
successor of its length among the residuals) and on to the next until a compatible one is found; of
equally tight ones the oldest. So that a hot source costs no long searches, a tree over the
residuals holds, at each node, the sources that all bins below have: subtrees in which every bin has
the piece's source are passed over whole. Where no bin is compatible a new one is opened; nothing is
dropped.

Lengths are tokens of a tokenizer file, with one end token a document, as the queries have it; or what
the caller gives as a Column; or else words and an end. Clusters are texts that are equal but for case and white space.

Defined results: a null or empty text is its end token; a null source is in conflict with nothing;
repeated rows are one cluster and never share a bin; no rows give none; other columns are not read.
"""

from __future__ import annotations

from bisect import insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.llm._base import cut

CAPACITY = 2048
SHARD_DOCS = 8192
PACKED = "doc_id long, bin_id long, piece int, doc_start long, length int, bin_start int"


class BestFit:
    """Bins of one shard, ordered by residual."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        #: Sources that all bins of a subtree have; -1 (all) where there are none.
        self.common = [-1] * (2 * self.size)
        #: By residual, by source bitmap: bins in order of age.
        self.leaves: list[dict[int, list[int]]] = [{} for _ in range(self.size)]
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.left: list[int] = []
        self.capacity = capacity

    def _update(self, residual: int) -> None:
        all_ = -1
        for bitmap in self.leaves[residual]:
            all_ &= bitmap
        i = residual + self.size
        self.common[i] = all_
        i >>= 1
        while i:
            both = self.common[2 * i] & self.common[2 * i + 1]
            if self.common[i] == both:
                break
            self.common[i] = both
            i >>= 1

    def _put(self, b: int) -> None:
        if self.left[b]:
            insort(self.leaves[self.left[b]].setdefault(self.sources[b], []), b)
            self._update(self.left[b])

    def _take(self, b: int) -> None:
        group = self.leaves[self.left[b]][self.sources[b]]
        group.remove(b)
        if not group:
            del self.leaves[self.left[b]][self.sources[b]]
        self._update(self.left[b])

    def _next(self, residual: int, source: int) -> int:
        """The smallest residual from here on with a bin without the source bit; -1 if none."""
        if residual >= self.size:
            return -1
        i = residual + self.size
        free = lambda k: self.common[k] & source != source if source else self.common[k] != -1
        while not free(i):
            while i & 1:
                i >>= 1
                if i <= 1:
                    return -1
            i += 1
            if free(i):
                break
            # Both children are passed over; go on from the parent.
        while i < self.size:
            i = 2 * i if free(2 * i) else 2 * i + 1
        return i - self.size

    def add(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin of a piece and its place there. source, cluster: bits, or 0 for none."""
        at = self._next(length, source)
        while at >= 0:
            best = -1
            for bitmap, group in self.leaves[at].items():
                if not bitmap & source:
                    found = next((b for b in group if not self.clusters[b] & cluster), -1)
                    if found >= 0 and (best < 0 or found < best):
                        best = found
            if best >= 0:
                self._take(best)
                start = self.capacity - self.left[best]
                self.left[best] -= length
                self.sources[best] |= source
                self.clusters[best] |= cluster
                self._put(best)
                return best, start
            at = self._next(at + 1, source)
        self.left.append(self.capacity - length)
        self.sources.append(source)
        self.clusters.append(cluster)
        self._put(len(self.left) - 1)
        return len(self.left) - 1, 0


def pack_shard(rows: list[tuple], capacity: int = CAPACITY) -> list[tuple]:
    """(doc_id, bin, piece, doc_start, length, bin_start) for rows (doc_id, source, cluster, length)."""
    bits: dict = {}
    source_of = [0 if s is None else 1 << bits.setdefault(s, len(bits)) for _, s, _, _ in rows]
    times: dict = {}
    for _, _, c, _ in rows:
        times[c] = times.get(c, 0) + 1
    # Only clusters with several documents here need a bit.
    shared = {c: 1 << k for k, c in enumerate(c for c, n in times.items() if n > 1)}
    full, rest, out = 0, [], []
    for k, (doc_id, _, c, length) in enumerate(rows):
        whole = length // capacity
        out += [(doc_id, full + p, p, p * capacity, capacity, 0) for p in range(whole)]
        full += whole
        if length % capacity:
            rest.append((-(length % capacity), doc_id is not None, doc_id or 0, k, whole, shared.get(c, 0)))
    bins = BestFit(capacity)
    for negative, _, _, k, piece, cluster in sorted(rest):
        b, start = bins.add(-negative, source_of[k], cluster)
        out.append((rows[k][0], full + b, piece, piece * capacity, -negative, start))
    return out


#: Words of a text between white space, and its end.
WORDS = (r"cast(size(filter(split(replace(translate(coalesce(text, ''), '\u0009\u000b\u000c\u000d', '    '), '\u000a', ' '), ' ', -1), w -> w <> '')) + 1 as bigint)")


def _counter(tokenizer: str):
    """The function from texts to their numbers of tokens: new pieces of the usual texts are encoded by the library in rows, longer
    texts and other tokenizers are counted as token_counts does, whose memory a text's length does not raise."""
    from gablestone.llm._pieces import splits_anywhere
    from gablestone.llm.token_counts import CHUNK, counter
    from gablestone.llm.token_frames import Encoder

    if tokenizer.endswith(".model") or not splits_anywhere(tokenizer):
        return counter(tokenizer)
    encoder, others = Encoder(tokenizer), []

    def count(texts: list[str]) -> list[int]:
        usual = [k for k, t in enumerate(texts) if len(t) <= CHUNK]
        out = dict(zip(usual, encoder.counts([texts[k] for k in usual]), strict=True))
        for k in range(len(texts)):
            if k not in out:
                if not others:
                    others.append(counter(tokenizer))
                out[k], = others[0]([texts[k]])
        return [out[k] for k in range(len(texts))]

    return count


def lengths(docs: DataFrame, length=None, tokenizer: str | None = None) -> DataFrame:
    """doc_id, source, cluster, length of each document."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"\s+", " "))
    kept = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64(plain).alias("cluster")]
    if tokenizer is None:
        length = F.expr(WORDS) if length is None else length
        return docs.select(*kept, F.greatest(F.coalesce(length.cast("long"), F.lit(1)), F.lit(1)).alias("length"))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        count = _counter(tokenizer)
        for b in batches:
            text, n = pc.fill_null(b.column("text"), ""), []
            for i in range(0, len(text), 500):
                n += count(text.slice(i, 500).to_pylist())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "source", "cluster")], pc.add(pa.array(n, pa.int64()), 1)], names=["doc_id", "source", "cluster", "length"])

    return docs.select(*kept, "text").mapInArrow(run, "doc_id long, source string, cluster long, length long")


def pack(docs: DataFrame, length=None, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, bin_id, piece (its number in the document), doc_start (where it
    begins there), length, bin_start (where it begins in the bin)."""
    sized = cut(lengths(docs, length, tokenizer), "lengths")
    shards = max(1, -(-sized.count() // shard_docs))
    # The place in the written table spreads rows that repeat.
    sized = sized.withColumn("place", F.monotonically_increasing_id())
    sized = sized.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "place"), F.lit(shards))).drop("place")

    def run(table):
        import pyarrow as pa

        cols = [table.column(c).to_pylist() for c in ("doc_id", "source", "cluster", "length")]
        rows = sorted(zip(*cols, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1] or ""))
        shard = table.column("shard")[0].as_py() << 32
        found = list(zip(*pack_shard(rows, capacity), strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
        found[1] = [shard + b for b in found[1]]
        return pa.table([pa.array(x, k) for x, k in zip(found, kinds, strict=True)], names=[x.split()[0] for x in PACKED.split(", ")])

    return sized.groupBy("shard").applyInArrow(run, PACKED)
