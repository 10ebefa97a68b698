"""Language-model scores by a Katz backoff model of word pairs.

P(w | h) = d(c(h,w)) c(h,w) / c(h)  where the pair was seen in training,
           alpha(h) P(w)            where only the history was,
           P(w)                     otherwise;
P(w)     = d(c(w)) c(w) / N, and what the discounts leave goes to the one unknown word.
Discounts d are Good-Turing's for counts up to 5, renormalised as Katz has it, from the counts of
counts of all training tokens; where those counts of counts are too few to give values in (0, 1],
absolute discounting with n1 / (n1 + 2 n2) stands in. alpha(h) = (1 - sum of the seen pairs'
probabilities) / (1 - sum of P(w) over the words seen after h), so each history's probabilities sum
to 1 exactly; where no count of a history is discounted, c(h) + 1 is its denominator.

Documents are cut into chunks of some megabytes. A chunk's distinct words, with their training
counts, go to buckets by word hash; a bucket adds them up, keeps its part of the word table, and
answers each chunk with the totals in the order asked. Then each chunk's distinct pairs go to
buckets by history, pairs of very frequent histories by pair, and their totals and backoff weights
come back the same way. What a hot history has in several buckets is added up in a small table of at
most as many rows as buckets. Nothing is sent for each token, and no table goes to the driver. The
chunks are kept in a table bucketed by chunk, so that answers meet them without dealing them out.
Tables: words (bucket, words, counts), pairs (bucket, histories, pairs, counts), weights (bucket,
histories, counts, alpha).

Words are told apart by 64-bit hashes, the words after one history by 48 bits.

Defined results: a null or empty text is its end token only; rows that repeat stay, and learn each
time; a null doc_id counts as the empty string in the split; without training documents all words
are unknown with probability 1 (score 0); no rows give none; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.llm._base import cut, remove, scratch

CHUNK_BYTES = 12 << 20
#: Rows of words or pairs in a bucket, about.
BUCKET_ROWS = 600_000
#: A history is hot, and its pairs are dealt out by pair, above a bucket's share of all tokens, and
#: above this count.
LEAST_HOT = 1000
#: Counts above this are not discounted.
TRUSTED = 5

END, BEGIN = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_K = np.uint64(0x9E3779B97F4A7C15)


def _press(a: np.ndarray, dtype: str) -> bytes:
    """An array's bytes by significance, compressed: the high bytes of small numbers cost nothing."""
    import zstandard

    a = np.ascontiguousarray(a, dtype)
    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())


def _open(b: bytes, dtype: str) -> np.ndarray:
    import zstandard

    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    """Ranges of the hash."""
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _batch(schema: str, rows: list[tuple]):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split(" ", 1) for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def discounts(n: list[int]) -> np.ndarray:
    """d[r] for r = 0 .. TRUSTED + 1 (the last for all larger counts), from n[r] items of count r."""
    k = TRUSTED
    d = np.ones(k + 2)
    if n[1] and n[k + 1]:
        a = (k + 1) * n[k + 1] / n[1]
        if a < 1 and all(n[1 : k + 2]):
            for r in range(1, k + 1):
                d[r] = ((r + 1) * n[r + 1] / (n[r] * r) - a) / (1 - a)
    if not (d[1] < 1 and (d[1:] > 0).all() and (d[1:] <= 1).all()):
        cut_ = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        d[1 : k + 1] = 1 - cut_ / np.arange(1, k + 1)
    return d


class Unigrams:
    """Probabilities of words by their counts."""

    def __init__(self, total: int, kinds: int, n: list[int]):
        self.total, self.kinds, self.d = total, kinds, discounts(n)
        lost = sum(n[r] * r * (1 - self.d[r]) for r in range(1, TRUSTED + 1))
        # Without a count that is discounted, the unknown word gets one more count.
        self.size, self.unknown = (total, lost / total) if lost > 0 else (total + 1, 1 / (total + 1))

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d[np.minimum(c, TRUSTED + 1)] * c / self.size, self.unknown)


CHUNKS = "chunk long, n_tokens long, n_words long, n_train long, doc_ids binary, is_null binary, held binary, sizes binary, words binary, counts binary, stream binary"
WORDS = "bucket int, chunk long, words binary, counts binary, stats array<long>"
PAIRS = "bucket int, chunk long, h binary, hc binary, runs binary, g_hi binary, g_lo binary, counts binary, wc binary"
SUMS = "bucket int, chunk long, h binary, hc binary, few binary, many binary, mass binary, runs binary, g_hi binary, g_lo binary, counts binary, stats array<long>"
ANSWERS = "bucket int, chunk long, h binary, hc binary, alpha binary, counts binary, asked binary, plus binary"


def _chunks(docs: DataFrame, held) -> DataFrame:
    def run(batches):
        from pyspark import TaskContext

        from gablestone.llm import _words

        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for at, n in _words.slices(b.column("text"), CHUNK_BYTES):
                part = b.slice(at, n)
                hashes, counts = _words.words(*_words.buffers(part.column("text")), _words.DARK)
                sizes = counts + 1
                tokens = np.full(len(hashes) + n, END, np.uint64)
                last = np.zeros(len(tokens), bool)
                last[np.cumsum(sizes) - 1] = True
                tokens[~last] = hashes
                words, stream = np.unique(tokens, return_inverse=True)
                out = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
                seen = np.bincount(stream[~np.repeat(out, sizes)], minlength=len(words))
                ids = part.column("doc_id")
                yield _batch(CHUNKS, [(
                    number, len(tokens), len(words), int((~out).sum()), ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes(), out.tobytes(),
                    sizes.astype("<i8").tobytes(), words.astype("<u8").tobytes(), _press(seen, "<u4"), _press(stream, "<u4"),
                )])
                number += 1

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held.alias("held"))
    return docs.mapInArrow(run, CHUNKS)


def _count_words(chunks: DataFrame, n: int) -> DataFrame:
    """WORDS: a row of the table for each bucket (chunk null), and an answer for each chunk in it."""

    def ask(batches):
        for b in batches:
            for r in b.to_pylist():
                words, counts = np.frombuffer(r["words"], "<u8"), _open(r["counts"], "<u4")
                edges = np.searchsorted(_bucket(words, n), np.arange(n + 1))
                yield _batch("bucket int, chunk long, words binary, counts binary", [
                    (k, r["chunk"], words[i:j].tobytes(), _press(counts[i:j], "<u4")) for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if j > i
                ])

    def add(table):
        import pyarrow as pa

        rows = table.to_pylist()
        asked = [np.frombuffer(r["words"], "<u8") for r in rows]
        words, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(place, np.concatenate([_open(r["counts"], "<u4") for r in rows]), len(words)).astype(np.int64)
        edges = np.cumsum([0, *map(len, asked)])
        known = total > 0
        stats = [int(total.sum()), int(known.sum()), *np.bincount(np.minimum(total, TRUSTED + 2), minlength=TRUSTED + 3)[1 : TRUSTED + 2].tolist()]
        out = [(rows[0]["bucket"], None, words[known].tobytes(), _press(total[known], "<u8"), stats)]
        out += [(r["bucket"], r["chunk"], None, _press(total[place[i:j]], "<u8"), None) for r, i, j in zip(rows, edges, edges[1:], strict=False)]
        return pa.Table.from_batches([_batch(WORDS, out)])

    asked = chunks.select("chunk", "words", "counts").mapInArrow(ask, "bucket int, chunk long, words binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(add, WORDS)


def _stats(table: DataFrame) -> list[int]:
    rows = table.where("stats is not null").select(F.posexplode("stats").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()
    return [r["n"] for r in sorted(rows, key=lambda r: r["k"])]


class _Pairs:
    """The distinct pairs of a chunk, in the order of their buckets."""

    def __init__(self, row: dict, answers: list, n_train: int, n: int, hot: int):
        from gablestone.llm._words import mix

        self.words = np.frombuffer(row["words"], "<u8")
        self.counts = np.concatenate([_open(a["counts"], "<u8") for a in sorted(answers, key=lambda a: a["bucket"])]).astype(np.int64)
        self.stream = _open(row["stream"], "<u4").astype(np.int64)
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.held = np.frombuffer(row["held"], bool)
        size = len(self.words)
        before = np.empty_like(self.stream)
        before[1:] = self.stream[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = size
        kinds, inverse = np.unique(before * size + self.stream, return_inverse=True)
        h, w = kinds // size, kinds % size
        histories, totals = np.append(self.words, BEGIN), np.append(self.counts, n_train)
        g = mix(histories[h] * _K + self.words[w])
        bucket = np.where(totals[h] > hot, _bucket(g, n), _bucket(histories[h], n))
        order = np.argsort(bucket, kind="stable")
        self.place = np.empty_like(order)
        self.place[order] = np.arange(len(order))
        self.place = self.place[inverse]  # of each token's pair
        self.h, self.w, self.g = h[order], w[order], g[order] >> np.uint64(16)
        self.histories, self.totals = histories, totals
        self.edges = np.searchsorted(bucket[order], np.arange(n + 1))

    def runs(self, i: int, j: int) -> np.ndarray:
        """Where histories begin in a bucket's pairs."""
        h = self.h[i:j]
        return np.flatnonzero(np.append(True, h[1:] != h[:-1]))


def _joined(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    for k, a in enumerate(answers):
        lists = a.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct(*[c for c in a.columns if c in ("bucket", "counts", "asked", "alpha", "plus")])).alias(f"answers{k}"))
        chunks = chunks.join(lists.hint("merge"), "chunk")
    return chunks


def _ask_pairs(chunks: DataFrame, words: DataFrame, n_train: int, n: int, hot: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                p = _Pairs(r, r["answers0"], n_train, n, hot)
                train = ~np.repeat(p.held, p.sizes)
                seen = np.bincount(p.place[train], minlength=len(p.h))
                for k, (i, j) in enumerate(zip(p.edges, p.edges[1:], strict=False)):
                    if j > i:
                        first = p.runs(i, j)
                        h = p.h[i:j][first]
                        yield _batch(PAIRS, [(
                            k, r["chunk"], p.histories[h].tobytes(), _press(p.totals[h], "<u8"), _press(np.diff(np.append(first, j - i)), "<u4"),
                            _press(p.g[i:j] >> np.uint64(16), "<u4"), _press(p.g[i:j] & np.uint64(0xFFFF), "<u2"), _press(seen[i:j], "<u4"), _press(p.counts[p.w[i:j]], "<u8"),
                        )])

    columns = ["chunk", "words", "stream", "sizes", "held", "answers0"]
    return _joined(chunks, words).select(*columns).mapInArrow(run, PAIRS)


def _count_pairs(asked: DataFrame, unigrams: Unigrams) -> DataFrame:
    """SUMS: for each bucket its pairs and, for each of its histories, how many followers have each
    small count, the sum of the larger counts, and the sum of P(w) over the followers; and for each
    chunk the pairs' totals (counts) and the histories' places (h)."""

    def add(table):
        import pyarrow as pa

        rows = table.to_pylist()
        hs = [np.frombuffer(r["h"], "<u8") for r in rows]
        history, at = np.unique(np.concatenate(hs), return_inverse=True)
        hc = np.zeros(len(history), np.int64)
        hc[at] = np.concatenate([_open(r["hc"], "<u8") for r in rows]).astype(np.int64)
        runs = np.concatenate([_open(r["runs"], "<u4") for r in rows])
        of = np.repeat(at, runs)
        g = np.concatenate([(_open(r["g_hi"], "<u4").astype(np.uint64) << np.uint64(16)) | _open(r["g_lo"], "<u2") for r in rows])
        order = np.lexsort((g, of))
        new = np.ones(len(order), bool)
        new[1:] = (g[order][1:] != g[order][:-1]) | (of[order][1:] != of[order][:-1])
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        first = order[new]
        total = np.bincount(kind, np.concatenate([_open(r["counts"], "<u4") for r in rows]), len(first)).astype(np.int64)
        wc = np.concatenate([_open(r["wc"], "<u8") for r in rows]).astype(np.int64)[first]
        own, seen = of[first], total > 0
        few = np.stack([np.bincount(own[total == c], minlength=len(history)) for c in range(1, TRUSTED + 1)])
        many = np.bincount(own[total > TRUSTED], total[total > TRUSTED], len(history)).astype(np.int64)
        mass = np.bincount(own[seen], unigrams.p(wc[seen]), len(history))
        stats = np.bincount(np.minimum(total, TRUSTED + 2), minlength=TRUSTED + 3)[1 : TRUSTED + 2].tolist()
        k = rows[0]["bucket"]
        out = [(
            k, None, history.tobytes(), _press(hc, "<u8"), _press(few.reshape(-1), "<u4"), _press(many, "<u8"), mass.astype("<f8").tobytes(), _press(np.bincount(own[seen], minlength=len(history)), "<u4"),
            _press(g[first][seen] >> np.uint64(16), "<u4"), _press(g[first][seen] & np.uint64(0xFFFF), "<u2"), _press(total[seen], "<u8"), stats,
        )]
        a = t = 0
        for r, h in zip(rows, hs, strict=True):
            size = int(_open(r["runs"], "<u4").sum())
            out.append((k, r["chunk"], _press(at[a : a + len(h)], "<u4"), None, None, None, None, r["runs"], None, None, _press(total[kind[t : t + size]], "<u8"), None))
            a, t = a + len(h), t + size
        return pa.Table.from_batches([_batch(SUMS, out)])

    return asked.groupBy("bucket").applyInArrow(add, SUMS)


def _history(row: dict):
    """(history, c, counts of small counts, larger counts, mass) of a bucket's histories."""
    h = np.frombuffer(row["h"], "<u8")
    return h, _open(row["hc"], "<u8").astype(np.int64), _open(row["few"], "<u4").astype(np.int64).reshape(TRUSTED, len(h)), _open(row["many"], "<u8").astype(np.int64), np.frombuffer(row["mass"], "<f8")


def _hot_sums(sums: DataFrame, hot: int) -> dict:
    """Of the histories whose pairs lie in several buckets: the sums over all of them."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                h, c, few, many, mass = _history(r)
                k = np.flatnonzero(c > hot)
                yield _batch("h long, few array<long>, many long, mass double", [(int(h[i].view(np.int64)), few[:, i].tolist(), int(many[i]), float(mass[i])) for i in k])

    rows = sums.where("chunk is null").select("h", "hc", "few", "many", "mass").mapInArrow(run, "h long, few array<long>, many long, mass double")
    totals = rows.groupBy("h").agg(*[F.sum(F.col("few")[i]).alias(f"f{i}") for i in range(TRUSTED)], F.sum("many").alias("many"), F.sum("mass").alias("mass"))
    return {r["h"]: ([r[f"f{i}"] for i in range(TRUSTED)], r["many"], r["mass"]) for r in totals.collect()}  # at most N / hot


def _answers(sums: DataFrame, hot_sums: dict, hot: int, d: np.ndarray) -> DataFrame:
    """ANSWERS: each bucket's histories with their backoff weights (chunk null), and for each chunk
    its pairs' totals, the weights of the histories that have an unseen pair there, and which
    histories have c + 1 for a denominator."""
    held = sums.sparkSession.sparkContext.broadcast(hot_sums)

    def weigh(table):
        import pyarrow as pa

        rows = table.to_pylist()
        model = next(r for r in rows if r["chunk"] is None)
        h, c, few, many, mass = _history(model)
        few, many, mass = few.astype(float), many.astype(float), mass.copy()
        for i in np.flatnonzero(c > hot):
            few[:, i], many[i], mass[i] = held.value[int(h[i].view(np.int64))]
        kept = (d[1 : TRUSTED + 1, None] * np.arange(1, TRUSTED + 1)[:, None] * few).sum(0) + many
        plus = (c > 0) & (c - kept < 1e-9)
        left = np.where(plus, 1.0, c - kept) / np.maximum(np.where(plus, c + 1, c), 1)
        alpha = np.where(c > 0, left / np.maximum(1 - mass, 1e-300), 1.0)
        out = [(model["bucket"], None, model["h"], model["hc"], alpha.astype("<f8").tobytes(), None, None, None)]
        for r in rows:
            if r["chunk"] is None:
                continue
            at, runs, total = _open(r["h"], "<u4"), _open(r["runs"], "<u4").astype(np.int64), _open(r["counts"], "<u8")
            unseen = np.flatnonzero(np.add.reduceat((total == 0).astype(np.int64), np.cumsum(runs) - runs))
            out.append((r["bucket"], r["chunk"], None, None, alpha[at[unseen]].astype("<f8").tobytes(), r["counts"], _press(unseen, "<u4"), _press(np.flatnonzero(plus[at]), "<u4")))
        return pa.Table.from_batches([_batch(ANSWERS, out)])

    return sums.select("bucket", "chunk", "h", "hc", "few", "many", "mass", "runs", F.when(F.col("chunk").isNotNull(), F.col("counts")).alias("counts")).groupBy("bucket").applyInArrow(weigh, ANSWERS)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(chunks: DataFrame, words: DataFrame, answers: DataFrame, unigrams: Unigrams, d: np.ndarray, n_train: int, n: int, hot: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                p = _Pairs(r, r["answers0"], n_train, n, hot)
                c = p.counts[p.stream]
                starts = np.cumsum(p.sizes) - p.sizes
                base = np.log10((c + 1) / (unigrams.total + unigrams.kinds + 1))
                value = np.log10(unigrams.p(p.counts))[p.w]  # of each pair, if its history is unknown
                for a in r["answers1"]:
                    i, j = p.edges[a["bucket"]], p.edges[a["bucket"] + 1]
                    total = _open(a["counts"], "<u8").astype(np.int64)
                    first = p.runs(i, j)
                    sizes = np.diff(np.append(first, j - i))
                    weight, under = np.ones(len(first)), p.totals[p.h[i:j][first]].astype(float)
                    weight[_open(a["asked"], "<u4")] = np.frombuffer(a["alpha"], "<f8")
                    under[_open(a["plus"], "<u4")] += 1
                    weight, under = np.repeat(weight, sizes), np.repeat(under, sizes)
                    seen = np.log10(d[np.minimum(total, TRUSTED + 1)] * np.maximum(total, 1) / np.maximum(under, 1))
                    value[i:j] = np.where(total > 0, seen, np.log10(weight) + value[i:j])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(r["doc_ids"], "<i8"), pa.int64(), mask=np.frombuffer(r["is_null"], bool)), pa.array(p.held), pa.array(p.sizes, pa.int64()), pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                        pa.array(np.full(len(starts), unigrams.total)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(value[p.place], starts)),
                    ],
                    names=[x.split()[0] for x in SCORES.split(", ")],
                )

    columns = ["chunk", "words", "stream", "sizes", "held", "doc_ids", "is_null", "answers0", "answers1"]
    return _joined(chunks, words, answers).select(*columns).mapInArrow(run, SCORES)


def split(docs: DataFrame, folds: int = 7, held: int = 2):
    """Whether a document is held out of training."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds)) == held


def score(docs: DataFrame, held) -> DataFrame:
    """Learn from docs (doc_id, text) where the Column held is false and score all of them: SCORES.
    The tables lie under the work folder until the scores are written."""
    spark = docs.sparkSession
    path, name = scratch(spark, "katz"), f"gablestone_{uuid.uuid4().hex}"
    try:
        return _scored(docs, held, path, name)
    finally:
        spark.sql(f"drop table if exists {name}")
        remove(spark, path)


def _scored(docs: DataFrame, held, path: str, name: str) -> DataFrame:
    spark = docs.sparkSession
    parts = max(1, docs.rdd.getNumPartitions())
    _chunks(docs, held).write.bucketBy(2 * parts, "chunk").sortBy("chunk").option("path", f"{path}/chunks").saveAsTable(name)
    chunks = spark.table(name)
    size = chunks.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum("n_train")).first()
    if not size[1]:
        return spark.createDataFrame([], SCORES)
    n_words, n_pairs, n_train = -(-size[0] // BUCKET_ROWS), -(-size[1] // BUCKET_ROWS), size[2]

    def written(df: DataFrame, what: str) -> DataFrame:
        df.write.parquet(f"{path}/{what}")
        return spark.read.schema(df.schema).parquet(f"{path}/{what}")

    words = written(_count_words(chunks, n_words), "words")
    total, kinds, *n = _stats(words)
    if not total:
        return cut(_untrained(chunks), "scores")
    unigrams = Unigrams(total, kinds, [0, *n])
    hot = max(LEAST_HOT, total // n_pairs)
    sums = written(_count_pairs(_ask_pairs(chunks, words, n_train, n_pairs, hot), unigrams), "pairs")
    d = discounts([0, *_stats(sums)])
    answers = written(_answers(sums, _hot_sums(sums, hot), hot, d), "weights")
    return cut(_scores(chunks, words, answers, unigrams, d, n_train, n_pairs, hot), "scores")


def _untrained(chunks: DataFrame) -> DataFrame:
    """Scores without a training token: the unknown word has it all."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                sizes = np.frombuffer(r["sizes"], "<i8").tolist()
                ids = [None if x else int(i) for i, x in zip(np.frombuffer(r["doc_ids"], "<i8"), np.frombuffer(r["is_null"], bool), strict=True)]
                yield _batch(SCORES, [(i, True, n, 0, 0, 0.0, 0.0) for i, n in zip(ids, sizes, strict=True)])

    return chunks.select("doc_ids", "is_null", "sizes").mapInArrow(run, SCORES)


def op4(docs: DataFrame) -> DataFrame:
    return score(docs, split(docs))
