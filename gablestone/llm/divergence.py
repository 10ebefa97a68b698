"""Source divergence audit: how the words of each source differ from other sources of its language.

A task finds words by a lookup table over the bytes of whole Arrow columns, groups equal slices by their
XXH64 and compares the bytes of each with those of its group's first, so that no two terms are ever taken
for one. Documents are rows of a sparse matrix of terms; rows of one (lang, source) are added up before
anything is shuffled, and a task hands on its sums whenever it holds HELD of them. Smoothed shares are
integers, worked out by exact decimal division. Kept terms are dealt into blocks of about BLOCK counts;
a block is a sparse matrix of sources by terms, of which each source is spread out once and compared with
all others by sums over row pointers. What blocks give is added up by pairs of sources, which the result has
as its rows anyway.

Defined results: null text, lang and source are ''; each row is a document, also if it repeats a doc_id
(which is not read) or a text; a text of any length is cut into runs of bytes at the ends of words; a
(lang, source) without terms has pairs, but no terms; a language of one source has no pairs; ties go by the
bytes of the item; no documents give no rows; other columns, whatever their names, are not read."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablestone.llm._base import Work
from gablestone.llm._words import FOLD, LETTERS, buffers, flat, slices, spans

#: Sums and terms that a task holds before it hands them on.
HELD = 1_000_000
#: Counts of a block of terms.
BLOCK = 1 << 15
#: Groups up to which totals are broadcast.
BROADCAST_GROUPS = 50_000
COUNTS = "lang string, source string, term string, n long, n_docs long"


def _digest(piece: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(piece)


def distinct(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, digest=None) -> tuple[list[bytes], np.ndarray]:
    """The distinct slices of raw, and the number of each slice among them. Slices of one digest are compared
    byte by byte with the first of them; those that differ are told apart by their bytes."""
    digest = digest or _digest
    data, low = raw[starts[0] : ends[-1]].tobytes(), int(starts[0])
    sizes = ends - starts
    sums = np.fromiter([digest(data[a:b]) for a, b in zip((starts - low).tolist(), (ends - low).tolist(), strict=True)], np.uint64, len(starts))
    _, first, number = np.unique(sums, return_index=True, return_inverse=True)
    model = first[number]
    same = sizes == sizes[model]
    asked = np.flatnonzero(same)
    equal = raw[flat(starts[asked], sizes[asked])] == raw[flat(starts[model[asked]], sizes[asked])]
    same[asked] = np.logical_and.reduceat(equal, np.cumsum(sizes[asked]) - sizes[asked])
    found = [data[a:b] for a, b in zip((starts[first] - low).tolist(), (ends[first] - low).tolist(), strict=True)]
    known: dict[bytes, int] = {}
    for i in np.flatnonzero(~same).tolist():
        piece = data[starts[i] - low : ends[i] - low]
        if piece not in known:
            known[piece] = len(found)
            found.append(piece)
        number[i] = known[piece]
    return found, number


def _added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, in order, and the sum of each column of values over each."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], *(np.add.reduceat(v[order], heads) for v in values)


class Matrix:
    """Counts of terms by group, as far as one task has come."""

    def __init__(self, most: int = HELD):
        self.most = most
        self.terms: dict[bytes, int] = {}
        self.groups: dict[tuple, int] = {}
        self.parts, self.size = [], 0

    def add(self, column, langs: list, sources: list) -> None:
        """Add rows of texts. Keys are group or document in the upper half, term in the lower."""
        raw, offsets = buffers(column)
        raw = FOLD[raw]
        cells, held = [], 0
        for starts, ends, docs in spans(raw, offsets, LETTERS):
            if not len(starts):
                continue
            found, number = distinct(raw, starts, ends)
            terms = np.array([self.terms.setdefault(t, len(self.terms)) for t in found], np.int64)
            cells.append(_added(docs << 32 | terms[number], np.ones(len(docs), np.int64)))
            held += len(cells[-1][0])
            if held > self.most:  # runs of one long text
                cells = [_joined(cells)]
                held = len(cells[0][0])
        if cells:
            keys, n = _joined(cells)
            group = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources, strict=True)], np.int64)
            self.parts.append(_added(group[keys >> 32] << 32 | keys & 0xFFFFFFFF, n, np.ones(len(n), np.int64)))
            self.size += len(self.parts[-1][0])
        if self.size > self.most:
            self.parts = [_joined(self.parts)]
            self.size = len(self.parts[0][0])

    def full(self) -> bool:
        return max(self.size, len(self.terms)) > self.most

    def rows(self):
        """The sums as an Arrow batch; the matrix is empty afterwards."""
        import pyarrow as pa

        keys, n, n_docs = _joined(self.parts) if self.parts else (np.zeros(0, np.int64),) * 3
        group, term = keys >> 32, keys & 0xFFFFFFFF
        langs, sources = (pa.array([g[k] for g in self.groups], pa.string()) for k in (0, 1))
        terms = pa.array([t.decode() for t in self.terms], pa.string())
        out = pa.RecordBatch.from_arrays([langs.take(pa.array(group)), sources.take(pa.array(group)), terms.take(pa.array(term)), pa.array(n), pa.array(n_docs)], names=["lang", "source", "term", "n", "n_docs"])
        self.__init__(self.most)
        return out


def _joined(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    return parts[0] if len(parts) == 1 else _added(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame, most: int = HELD) -> DataFrame:
    """lang, source, term, n (occurrences) and n_docs (documents with it)."""

    def run(batches):
        held = Matrix(most)
        for b in batches:
            column, langs, sources = b.column("text"), b.column("lang").to_pylist(), b.column("source").to_pylist()
            for i, k in slices(column):
                held.add(column.slice(i, k), langs[i : i + k], sources[i : i + k])
                if held.full():
                    yield held.rows()
        yield held.rows()

    return _named(docs).mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def block_sums(rows: np.ndarray, cols: np.ndarray, p: np.ndarray, base: np.ndarray, n_terms: int):
    """(i, j, sum over the terms of abs(p_i - p_j)) for sources i < j of a sparse matrix: entries (row, term, p),
    and the value of each row where it has no entry."""
    order = np.lexsort((cols, rows))
    rows, cols, p = rows[order], cols[order], p[order]
    n = len(base)
    at = np.searchsorted(rows, np.arange(n + 1))
    filled = np.flatnonzero(np.diff(at))
    for i in range(n - 1):
        line = np.full(n_terms, base[i], np.int64)
        line[cols[at[i] : at[i + 1]]] = p[at[i] : at[i + 1]]
        # All terms against the others' base value, then entries put right.
        ranked = np.sort(line)
        below = np.concatenate([[0], np.cumsum(ranked)])
        k = np.searchsorted(ranked, base)
        out = k * base - below[k] + below[-1] - below[k] - (n_terms - k) * base
        if len(cols):
            mine = line[cols]
            out[filled] += np.add.reduceat(np.abs(p - mine) - np.abs(base[rows] - mine), at[filled])
        yield i, out


def _pair_sums(cells: DataFrame) -> DataFrame:
    """lang, a, b, value of each block. cells: lang, block, source, term, p; a row without a term has the value
    of the source's absent terms, and each source of the language has one in each block."""

    def run(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        term = table.column("term").combine_chunks()
        heads, body = table.filter(pc.is_null(term)), table.filter(pc.is_valid(term))
        heads = heads.sort_by("source")
        names = heads.column("source").combine_chunks()
        cols = body.column("term").combine_chunks().dictionary_encode()
        rows = pc.index_in(body.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False).astype(np.int64)
        sums = block_sums(rows, cols.indices.to_numpy(zero_copy_only=False).astype(np.int64), body.column("p").to_numpy().astype(np.int64), heads.column("p").to_numpy().astype(np.int64), len(cols.dictionary))
        a, b, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, out in sums:
            a.append(np.full(len(out) - i - 1, i))
            b.append(np.arange(i + 1, len(out)))
            value.append(out[i + 1 :])
        a, b, value = (np.concatenate(x) for x in (a, b, value))
        lang = pa.array([table.column("lang")[0].as_py()] * len(a), pa.string())
        return pa.Table.from_arrays([lang, names.take(pa.array(a)), names.take(pa.array(b)), pa.array(value)], names=["lang", "a", "b", "value"])

    return cells.groupBy("lang", "block").applyInArrow(run, "lang string, a string, b string, value long")


def audit(docs: DataFrame, min_docs: int = 30, smooth: int = 5, scale: int = 1_000_000_000, top: int = 50, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank. Pairs: each other source of the language and
    the sum of differences of shares over all kept terms; terms: the top ones that the source has more of than its
    language. A language keeps the terms of at least min_docs of its documents; a share is
    1 + floor(scale * (count + smooth) / (all + smooth * kept terms))."""
    spark = docs.sparkSession
    share = lambda n, total: F.expr(f"1 + (cast({n} + {smooth} as decimal(20, 0)) * {scale}) div ({total} + {smooth} * n_terms)")
    with Work(spark, "divergence") as work:
        term = Window.partitionBy("lang", "term")
        counts = term_counts(docs, held).select("*", F.sum("n_docs").over(term).alias("lang_docs"), F.sum("n").over(term).alias("lang_n"), F.min("source").over(term).alias("least"))
        kept = work.cut(counts.where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", (F.col("source") == F.col("least")).cast("long").alias("first")), "kept")
        by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("all_n"), F.sum("first").alias("n_first"), F.count("*").alias("n_cells"))
        groups = _named(docs).select("lang", "source").distinct().join(by_group, ["lang", "source"], "left").na.fill(0, ["all_n", "n_first", "n_cells"])
        lang = Window.partitionBy("lang")
        groups = work.cut(
            groups.select("lang", "source", "all_n", F.sum("all_n").over(lang).alias("lang_all"), F.sum("n_first").over(lang).alias("n_terms"), F.count("*").over(lang).alias("n_sources"), F.greatest(F.lit(1), F.ceil(F.sum("n_cells").over(lang) / block)).cast("int").alias("blocks")),
            "groups",
        )
        small = F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups
        cells = kept.join(small, ["lang", "source"]).withColumn("p", share("n", "all_n"))
        best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
        terms = (
            cells.withColumn("value", F.col("p") - share("lang_n", "lang_all")).where("value > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
        )
        absent = F.when(F.col("n_terms") > 0, share("0", "all_n")).otherwise(0)
        heads = groups.where("n_sources > 1").select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), absent.alias("p"))
        dealt = cells.where("n_sources > 1").select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "source", "term", "p")
        sums = _pair_sums(heads.unionByName(dealt)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value").select("lang", "x.*", "value")
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
        return work.keep(pairs.unionByName(terms))
