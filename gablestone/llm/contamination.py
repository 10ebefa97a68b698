"""Benchmark decontamination by a distributed positional inverted index.

Index: documents are cut into segments of about two megabytes. A segment holds the postings of all its
words: sorted word hashes, how many places each has, and the places (ascending, counted over the
segment), together with the documents' ids and lengths. Segments are rows of a table in the shared
folder; they can be searched again and again.

Search: a test item's windows (13 words in a row; all of a shorter item) are the queries. Document
frequencies of the query terms are summed over the segments' dictionaries first. Within a segment, a
window with a term that the segment lacks is done; the others begin with the postings of their
rarest term, shifted by its place in the window, and are intersected with the shifted postings of
the next rarest, and so on: exact phrases. With slop s > 0, a term may be up to s places away from
where the phrase has it: proximity matches. No postings leave their segment and nothing is shuffled
but the frequencies. Queries travel in blocks of bounded size, which a task loads one at a time.

Words are compared by 64-bit hashes; a window match needs as many equal hashes in a row as it has
words.

Defined results: a null or empty text has no words and is never contaminated; an item without words
has no windows; repeated items count once by their id; repeated documents are judged each by itself;
an empty benchmark leaves all clean; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.llm._base import Work, cut, texts, without

WINDOW = 13
SEGMENT_BYTES = 2 << 20
#: Bytes of item texts in a block of queries.
BLOCK_BYTES = 4 << 20
#: Places between two documents, so that no match crosses; windows and slop are shorter.
GAP = 1024
SEGMENTS = "doc_ids binary, is_null binary, n_words binary, terms binary, n_places binary, places binary"


def _press(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(np.ascontiguousarray(a).tobytes())


def _open(b: bytes, dtype) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES, work: Work | None = None) -> DataFrame:
    """The table of segments of docs (doc_id, text), written to the shared folder."""

    def run(batches):
        import pyarrow as pa

        from gablestone.llm import _words

        for b in batches:
            for at, n in _words.slices(b.column("text"), segment_bytes):
                ids = b.column("doc_id").slice(at, n)
                hashes, counts = _words.words(*_words.buffers(b.column("text").slice(at, n)), _words.ALNUM)
                order = np.argsort(hashes, kind="stable")
                hashes = hashes[order]
                new = np.ones(len(hashes), bool)
                new[1:] = hashes[1:] != hashes[:-1]
                firsts = np.flatnonzero(new)
                places = order + GAP * np.repeat(np.arange(n), counts)[order]
                steps = np.diff(places, prepend=0)
                steps[firsts] = places[firsts]
                row = [
                    ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes(), counts.astype("<i8").tobytes(),
                    _press(hashes[firsts]), _press(np.diff(np.append(firsts, len(hashes))).astype("<u4")), _press(steps.astype("<u4")),
                ]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    segments = texts(docs).mapInArrow(run, SEGMENTS)
    return work.cut(segments, "segments") if work else cut(segments, "segments")


class Block:
    """The windows of some items: a row of term numbers each, padded with -1."""

    def __init__(self, items: list[tuple], window: int):
        import pyarrow as pa

        from gablestone.llm import _words

        hashes, counts = _words.words(*_words.buffers(pa.array([t for _, t in items], pa.string())), _words.ALNUM)
        self.terms, term = np.unique(hashes, return_inverse=True)
        self.df = np.zeros(len(self.terms), np.int64)
        found: dict[tuple, set] = {}
        at = 0
        for (item, _), n in zip(items, counts, strict=True):
            row = term[at : at + n].tolist()
            at += n
            for i in range(max(1, n - window + 1) if n else 0):
                found.setdefault(tuple(row[i : i + window]), set()).add(item)
        self.items = [sorted(x) for x in found.values()]
        self.sizes = np.array([len(w) for w in found], np.int64)
        self.windows = np.full((len(found), window), -1, np.int64)
        for k, w in enumerate(found):
            self.windows[k, : len(w)] = w

    def present(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a segment's sorted terms have those of the block, and which it has."""
        at = np.searchsorted(terms, self.terms)
        return at, (terms[np.minimum(at, len(terms) - 1)] == self.terms) if len(terms) else np.zeros(len(self.terms), bool)


def _blocks(items: DataFrame, window: int) -> list:
    """Broadcast blocks of queries, each of bounded size."""
    sc = items.sparkSession.sparkContext
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).where("item_id is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    out = []
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) if n > 1 else items
        out.append(Block([(r["item_id"], r["text"]) for r in part.collect()], window))
    return [(sc, b) for b in out if len(b.sizes)]


def _frequencies(segments: DataFrame, blocks: list) -> list:
    """Blocks with the number of places of each term over all segments."""
    held = []
    for sc, block in blocks:
        asked = sc.broadcast(block.terms)

        def run(batches, asked=asked):
            import pyarrow as pa

            terms = asked.value
            total = np.zeros(len(terms), np.int64)
            for b in batches:
                for t, c in zip(b.column("terms").to_pylist(), b.column("n_places").to_pylist(), strict=True):
                    own, count = _open(t, "<u8"), _open(c, "<u4")
                    at = np.minimum(np.searchsorted(own, terms), max(0, len(own) - 1))
                    if len(own):
                        total += np.where(own[at] == terms, count[at], 0)
            k = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], names=["term", "n"])

        sums = segments.select("terms", "n_places").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        for r in sums.collect():  # at most one row for each term of the block
            block.df[r["term"]] = r["n"]
        asked.unpersist()
        held.append(sc.broadcast(block))
    return held


def _phrases(block: Block, segment: dict, slop: int):
    """(window, place of its first word) of all matches in a segment, as arrays."""
    terms, ends, starts = segment["terms"], segment["ends"], segment["starts"]
    at, has = block.present(terms)
    ok = np.append(has, True)[block.windows].all(axis=1)
    places = segment["places"]
    out = []
    for w in np.flatnonzero(ok):
        size = int(block.sizes[w])
        row = block.windows[w, :size]
        order = np.argsort(block.df[row], kind="stable")
        a = order[0]
        base = places[starts[at[row[a]]] : ends[at[row[a]]]] - a
        for j in order[1:]:
            if not len(base):
                break
            own = places[starts[at[row[j]]] : ends[at[row[j]]]]
            near = np.searchsorted(own, base + j - slop)
            base = base[(near < len(own)) & (own[np.minimum(near, len(own) - 1)] <= base + j + slop)]
        if len(base):
            out.append((np.full(len(base), w), np.clip(base, 0, None)))
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _segments(batches):
    for b in batches:
        for r in b.to_pylist():
            n_places = _open(r["n_places"], "<u4").astype(np.int64)
            ends = np.cumsum(n_places)
            steps = _open(r["places"], "<u4").astype(np.int64)
            # Sums start anew with each term.
            sums = np.cumsum(steps)
            starts = ends - n_places
            lost = np.concatenate([[0], sums])[starts] if len(starts) else sums
            n_words = np.frombuffer(r["n_words"], "<i8")
            yield {
                "doc_ids": np.frombuffer(r["doc_ids"], "<i8"), "is_null": np.frombuffer(r["is_null"], bool), "n_words": n_words, "limits": np.concatenate([[0], np.cumsum(n_words + GAP)]),
                "terms": _open(r["terms"], "<u8"), "starts": starts, "ends": ends, "places": sums - np.repeat(lost, n_places),
            }


def matches(segments: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """(doc_id, item_id, place): each match of a window of an item, with the place of its first word
    in the document; with slop, of the place where the phrase would begin."""
    if window + slop >= GAP:
        raise ValueError(f"window and slop must be below {GAP} together")
    held, kind = _frequencies(segments, _blocks(items, window)), _id_type(items)

    def run(batches):
        import pyarrow as pa

        of = pa.string() if kind == "string" else pa.int64()
        for s in _segments(batches):
            for block in map(_load, held):
                w, base = _phrases(block, s, slop)
                doc = np.searchsorted(s["limits"], base, side="right") - 1
                rows = [
                    {"doc_id": None if s["is_null"][d] else int(s["doc_ids"][d]), "item_id": i, "place": int(p - s["limits"][d])} for k, d, p in zip(w, doc, base, strict=True) for i in block.items[k]
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("item_id", of), ("place", pa.int64())]))

    return segments.mapInArrow(run, f"doc_id long, item_id {kind}, place long")


def _id_type(items: DataFrame) -> str:
    """item_ids are integers or strings."""
    return "string" if items.schema["item_id"].dataType.simpleString() == "string" else "long"


def _load(held) -> Block:
    """One block at a time stays loaded."""
    found = held.value
    held.__dict__.pop("_value", None)
    return found


def contamination(segments: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each indexed document: doc_id, n_words, n_hit (words inside an occurrence of a window),
    n_items, items_sha256 (of the sorted item ids, joined by commas), contaminated, items."""
    held, kind = _frequencies(segments, _blocks(items, window)), _id_type(items)

    def run(batches):
        import pyarrow as pa

        of = pa.string() if kind == "string" else pa.int64()
        for s in _segments(batches):
            limits, n_docs = s["limits"], len(s["doc_ids"])
            edge = np.zeros(int(limits[-1]) + 1, np.int64)
            found: dict[int, set] = {}
            for block in (_load(h) for h in held):
                w, base = _phrases(block, s, 0)
                np.add.at(edge, base, 1)
                np.add.at(edge, base + block.sizes[w], -1)
                doc = np.searchsorted(limits, base, side="right") - 1
                for d, k in {*zip(doc.tolist(), w.tolist(), strict=True)}:
                    found.setdefault(d, set()).update(block.items[k])
            hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
            n_hit = hit[limits[1:]] - hit[limits[:-1]]
            lists = [sorted(found.get(d, ()), key=str) for d in range(n_docs)]
            digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in lists]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(s["doc_ids"], pa.int64(), mask=s["is_null"]), pa.array(s["n_words"], pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in lists], pa.int64()),
                    pa.array(digest), pa.array((n_hit > 0) & (20 * n_hit >= s["n_words"])), pa.array(lists, pa.list_(of)),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
            )

    return segments.mapInArrow(run, f"doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<{kind}>")


def op2(docs: DataFrame, items: DataFrame) -> DataFrame:
    with Work(docs.sparkSession, "contamination") as work:
        return work.keep(contamination(build_index(docs, work=work), items).drop("items"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns; rows that share a doc_id go if
    one of them is."""
    with Work(docs.sparkSession, "contaminated") as work:
        bad = work.keep(contamination(build_index(docs, work=work), items).where("contaminated").select("doc_id"))
    return without(docs, bad)
