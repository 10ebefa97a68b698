"""Target-distribution importance resampling: documents are drawn by how much more likely their features
are in a target than in all documents, with Gumbel noise from their ids.

A task writes the bucket of each feature as a packed stream of unsigned 16-bit integers, some documents to a
row, with each document's offset; streams lie in the shared folder. Counts are made from the streams alone:
a stream is sorted and run-length encoded, and sums of runs are all that is shuffled, a row for each bucket
and task. Gains (a number for each bucket) go to the tasks, which gather them along the streams and add them up between
offsets. A stream ends after STREAM features; a document with more goes on in the next row, and its sums are
brought together by its key. The draw ranks within equal scores only: scores are whole numbers of a bounded
range, so their histogram (at most some 200 000 rows) gives each score's first rank.

Defined results: a null text has no features; a document without features has weight 0; a null doc_id counts as
an empty one in the noise, and comes first in ties; rows that repeat a doc_id are documents of their own, which
tie in the noise; ties beyond doc_id go by features, weight and place; a text of any length is read in runs of
bytes; no documents, or no target, are no error: without a target all gains follow from its zero counts; other
columns are not read."""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablestone.llm._base import Work
from gablestone.llm._words import ALNUM, FOLD, buffers, flat, slices, spans

#: Features of a row of streams.
STREAM = 1 << 20
#: Words with more bytes than this are summed one by one.
LONG = 64
STREAMS = "key array<long>, doc_id array<long>, end array<long>, n_words array<long>, split array<boolean>, stream binary"


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def crc32(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each slice, a byte of all slices at a time."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    n_long = int(np.searchsorted(-sizes, -LONG, "left"))
    out = np.full(len(sizes), 0xFFFFFFFF, np.uint32)
    for k in range(int(sizes[n_long]) if n_long < len(sizes) else 0):
        live = slice(n_long, int(np.searchsorted(-sizes, -k, "left")))
        out[live] = _CRC[(out[live] ^ raw[starts[live] + k]) & 0xFF] ^ (out[live] >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    out[:n_long] = [zlib.crc32(raw[a : a + n]) for a, n in zip(starts[:n_long].tolist(), sizes[:n_long].tolist(), strict=True)]
    back = np.empty(len(out), np.uint32)
    back[order] = out
    return back


def features(column, low: int, high: int, buckets: int, run: int = 1 << 20):
    """(texts, buckets, words): for runs of words (of about run bytes) of a column, the number of the text and the bucket of each feature, texts
    ascending, and the words of each text of the run."""
    raw, offsets = buffers(column)
    raw = FOLD[raw]
    tail, owner = [], -1  # the last words of a text that goes on in the next run
    for starts, ends, docs in spans(raw, offsets, ALNUM, run):
        if not len(starts):
            continue
        found = [(docs, crc32(raw, starts, ends))] if low == 1 else []
        if high > 1:
            words = (tail if owner == docs[0] else []) + [raw[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            carried = len(words) - len(starts)
            where = np.concatenate([np.full(carried, docs[0]), docs])
            for n in range(max(2, low), high + 1):
                at = np.flatnonzero(where[n - 1 :] == where[: len(where) - n + 1]) if len(where) >= n else np.zeros(0, int)
                at = at[at + n > carried]  # the others were in the run before
                found.append((where[at], np.array([zlib.crc32(b" ".join(words[i : i + n])) for i in at.tolist()], np.uint32)))
            owner = docs[-1]
            tail = [w for w, d in zip(words[1 - high :], where[1 - high :].tolist(), strict=True) if d == owner]
        text, bucket = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(text, kind="stable") if len(found) > 1 else slice(None)
        yield text[order], (bucket[order] % buckets).astype(np.uint16), docs


def streams(docs: DataFrame, low: int, high: int, buckets: int, length: int = STREAM) -> DataFrame:
    """Rows of bucket streams of docs (doc_id, text): of each document in a row its key, doc_id, the end of its part of
    the stream, its words there, and whether the document has parts in other rows."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        first, seen = TaskContext.get().partitionId() << 40, 0
        schema = pa.schema([("key", pa.list_(pa.int64())), ("doc_id", pa.list_(pa.int64())), ("end", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("split", pa.list_(pa.bool_())), ("stream", pa.binary())])
        for b in batches:
            ids, column = b.column("doc_id").to_pylist(), b.column("text")
            for i, n in slices(column, length):
                sizes, words, parts, held = np.zeros(n, np.int64), np.zeros(n, np.int64), [], 0
                at, again = 0, False  # the first text that is not written, and whether a part of it is

                def row(upto, split):
                    data = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
                    flags = [False] * (upto - at)
                    if flags:
                        flags[0], flags[-1] = again or flags[0], split or (again and len(flags) == 1)
                    return pa.RecordBatch.from_pylist([{
                        "key": [first + seen + k for k in range(at, upto)], "doc_id": ids[i + at : i + upto], "end": np.cumsum(sizes[at:upto]).tolist(), "n_words": words[at:upto].tolist(), "split": flags, "stream": data.astype("<u2").tobytes(),
                    }], schema=schema)

                for text, bucket, of in features(column.slice(i, n), low, high, buckets, min(2 * length, STREAM)):
                    np.add.at(sizes, text, 1)
                    np.add.at(words, of, 1)
                    parts.append(bucket)
                    held += len(bucket)
                    if held > length:  # the last text of the run may go on
                        last = int(of[-1])
                        yield row(last + 1, True)
                        at, again, parts, held = last, True, [], 0
                        sizes[last] = words[last] = 0
                if at < n:
                    yield row(n, False)
                seen += n

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, STREAMS)


def bucket_counts(packed: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket: streams sorted and run-length encoded in the tasks. At most 65 536 rows reach the driver."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for b in batches:
            for data in b.column("stream"):
                ranked = np.sort(np.frombuffer(data.as_buffer(), "<u2"))
                if len(ranked):
                    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
                    total[ranked[heads]] += np.diff(np.append(heads, len(ranked)))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in packed.select("stream").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket floor(1000 * ln of how much likelier it is in the target), each count one more than it is."""
    n, s, t = len(ours), float(ours.sum() + len(ours)), float(target.sum() + len(ours))
    return np.array([math.floor(1000 * math.log((float(y + 1) * s) / (float(x + 1) * t))) for x, y in zip(ours.tolist(), target.tolist(), strict=True)], np.int64).reshape(n)


def weights(packed: DataFrame, gain: np.ndarray) -> DataFrame:
    """key, doc_id, n_features, n_words, weight (the mean of the gains of its features, rounded down)."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for k in range(b.num_rows):
                key, ids, end, words, split = (b.column(c)[k].values for c in ("key", "doc_id", "end", "n_words", "split"))
                ends = end.to_numpy()
                sizes = np.diff(ends, prepend=0)
                value = gain[np.frombuffer(b.column("stream")[k].as_buffer(), "<u2")]
                some, sums = np.flatnonzero(sizes), np.zeros(len(sizes), np.int64)
                if len(some):
                    sums[some] = np.add.reduceat(value, ends[some] - sizes[some])
                yield pa.RecordBatch.from_arrays([key, ids, pa.array(sizes), words, pa.array(sums), split], names=["key", "doc_id", "n_features", "n_words", "gain", "split"])

    parts = packed.mapInArrow(run, "key long, doc_id long, n_features long, n_words long, gain long, split boolean")
    whole = parts.where("not split").drop("split")
    joined = parts.where("split").groupBy("key", "doc_id").agg(*(F.sum(c).alias(c) for c in ("n_features", "n_words", "gain")))
    return whole.unionByName(joined).withColumn("weight", F.expr("if(n_features = 0, 0, (gain - pmod(gain, n_features)) div n_features)")).drop("gain")


def resample(docs: DataFrame, target: DataFrame, ngrams: tuple[int, int] = (1, 1), buckets: int = 10_000, seed: int = 2024, percent: int = 10, min_words: int = 20, length: int = STREAM) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document: of those with at least min_words words,
    percent of a hundred with the highest scores are drawn. docs: doc_id, text; target: text."""
    if not 0 < buckets <= 1 << 16 or not 0 < ngrams[0] <= ngrams[1]:
        raise ValueError("1 to 65 536 buckets, and runs of one word or more")
    spark = docs.sparkSession
    with Work(spark, "resampling") as work:
        packed = work.cut(streams(docs, *ngrams, buckets, length), "streams")
        aim = bucket_counts(streams(target.select(F.lit(0).alias("doc_id"), "text"), *ngrams, buckets, length), buckets)
        noise = F.expr(f"conv(substr(sha2(concat('{seed}:', coalesce(cast(doc_id as string), '')), 256), 1, 8), 16, 10)").cast("double")
        noise = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
        scored = work.cut(weights(packed, gains(bucket_counts(packed, buckets), aim)).withColumn("score", F.col("weight") + noise), "scored")
        # One row for each score that occurs; scores are sums of two numbers of bounded range.
        able = F.col("n_words") >= min_words
        found = sorted(((r["score"], r["n"]) for r in scored.where(able).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
        drawn, before, firsts = percent * sum(n for _, n in found) // 100, 0, []
        for score, n in found:
            if before >= drawn:
                break
            firsts.append((score, before))
            before += n
        least = firsts[-1][0] if firsts else None
        may = able & (F.col("score") >= least) if firsts else F.lit(False)
        place = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_first(), "n_features", "weight", "key")
        first = F.broadcast(spark.createDataFrame(firsts, "score long, before long"))
        ranked = scored.where(may).join(first, "score").withColumn("rank", F.col("before") + F.row_number().over(place))
        ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
        columns = ["doc_id", "n_features", "weight", "score", "rank"]
        return work.keep(ranked.select(*columns).unionByName(scored.where(~may).withColumn("rank", F.lit(None).cast("long")).select(*columns)))


def selected(docs: DataFrame, ranks: DataFrame) -> DataFrame:
    """The documents that resample drew, with all their columns."""
    return docs.join(ranks.where("rank is not null").select("doc_id").distinct(), "doc_id", "left_semi")
