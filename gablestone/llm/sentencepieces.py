"""SentencePiece encoding and decoding (byte-pair models) by vectorised merge rounds.

Words are cut where no piece of the vocabulary reaches across: before a space mark that follows something else, and around
line ends where no piece has one. New words of a batch lie as symbols in one flat array. In each round the lowest rank of a
pair of neighbours is found for each word by a segmented minimum; its leftmost occurrences are merged in all words
at once and the array is compacted; words without a pair leave. Where a piece can grow into one of lower or equal rank, the
library would do that before it merges the next occurrence, so a word's occurrences after
the first such piece wait for the next round. Words of over LONG symbols are cut between characters that no piece has side by side, and what is still longer
is merged by a heap, in n log n steps. Words seen before come from a worker's memo, which starts anew after MEMO words, or MEMO_CHARS characters.
Decoding gathers the bytes of the pieces.

Defined results: a null text is an empty one and has no ids; rows that repeat a doc_id, or have none, stay; texts of any
length are read in runs of PART characters and more, which end where a word does; no rows give none; other columns are
not read. A model of another kind (unigram, other normalisation, unused or user-defined pieces) is refused."""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.llm._base import texts
from gablestone.llm._pieces import Numbers
from gablestone.llm._words import flat

SPACE = "▁"
#: Symbols of a word up to which rounds are used alone.
LONG = 256
#: Characters of a run; words in the memo; symbols of new words that are merged together.
PART, MEMO, ROUND = 1 << 18, 400_000, 1 << 18
#: Characters of the words in the memo.
MEMO_CHARS = 1 << 24
_NONE = np.int64(1 << 40)


class Codec:
    """Ids of texts and texts of ids, as the library has them."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(model_file, "rb") as f:
            spec = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        normal, trainer = spec.normalizer_spec, spec.trainer_spec
        plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and not normal.remove_extra_whitespaces and normal.escape_whitespaces
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix or not plain or any(p.type in (kinds.UNUSED, kinds.USER_DEFINED) for p in spec.pieces):
            raise ValueError(f"{model_file}: not a plain byte-pair model with byte fallback")
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        scores = sorted({p.score for p in spec.pieces if p.type == kinds.NORMAL}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        rank = {p: place[spec.pieces[i].score] for p, i in ids.items()}
        # Characters that are only parts of pieces have numbers after the ids; all others are kept as their code.
        symbols = dict(ids)
        for c in sorted({c for p in ids for c in p} - ids.keys()):
            symbols[c] = len(spec.pieces) + len(symbols) - len(ids)
        self.width = len(spec.pieces) + len(symbols) - len(ids)
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + self.width
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        self.codes = {i: s for s, i in symbols.items() if i >= len(spec.pieces)}
        pairs = [(symbols[p[:k]] * self.width + symbols[p[k:]], rank[p], ids[p]) for p in ids for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        self.pairs, self.ranks, self.merged = np.array(sorted(pairs), np.int64).reshape(-1, 3).T.copy()
        # Pieces that can grow into one that is not later than themselves.
        early = {part for p in ids for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols for part in (p[:k], p[k:]) if part in ids and rank[p] <= rank[part]}
        self.early = np.zeros(self.width, bool)
        self.early[[ids[p] for p in early]] = True
        beside = {(a, b) for p in ids for a, b in zip(p, p[1:])}
        self.beside = np.array(sorted(ord(a) << 21 | ord(b) for a, b in beside), np.int64)
        # Where words end.
        whole = any(a != SPACE and b == SPACE for a, b in beside)
        line = any("\n" in p for p in beside)
        stop = "" if line else r"\n"
        self.word = re.compile(r"(?s).+" if whole else rf"{SPACE}*[^{SPACE}{stop}]+|{SPACE}+" + ("" if line else r"|\n"))
        self.part = re.compile(r"(?s).+" if whole else rf"(?s).{{1,{PART}}}{SPACE}*[^{SPACE}{stop}]*")
        self.byte_ids = np.zeros(256, np.int64)
        surface, self.spaced = [], np.zeros(len(spec.pieces), bool)
        for i, p in enumerate(spec.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
                surface.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == kinds.CONTROL:
                surface.append(b"")
            elif p.type == kinds.UNKNOWN:
                surface.append(trainer.unk_surface.encode())
            else:
                self.spaced[i] = p.piece.startswith(SPACE)
                surface.append(p.piece.replace(SPACE, " ").encode())
        self.bytes, self.byte_sizes = np.frombuffer(b"".join(surface), np.uint8), np.array([len(x) for x in surface], np.int64)
        self.byte_starts = np.cumsum(self.byte_sizes) - self.byte_sizes
        digits = [f"{i},".encode() for i in range(len(spec.pieces))]
        self.digits, self.digit_sizes = np.frombuffer(b"".join(digits), np.uint8), np.array([len(x) for x in digits], np.int64)
        self.digit_starts = np.cumsum(self.digit_sizes) - self.digit_sizes
        self._forget()

    def _forget(self):
        self.memo, self.pool, self.chars = Numbers(), [np.zeros(0, np.int32)], 0
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # Merging

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of the piece that each pair makes, and its id; no rank where it makes none."""
        known = np.maximum(left, right) < self.width
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        hit = known & (self.pairs[at] == keys)
        return np.where(hit, self.ranks[at], _NONE), self.merged[at]

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that remain of words of so many symbols each, and their numbers."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        out, owners = [], []
        while len(symbols):
            rank, made = self._pairs(symbols[:-1], symbols[1:])
            rank = np.append(np.where(word[1:] == word[:-1], rank, _NONE), _NONE)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(word)))
            ready = np.repeat(least == _NONE, lengths)
            out.append(symbols[ready])
            owners.append(word[ready])
            least = np.repeat(least, lengths)
            at = np.flatnonzero((rank == least) & ~ready)
            if not len(at):
                break
            # Of occurrences that share symbols every other one, from the left; of early pieces the first of the word.
            head = np.concatenate([[True], (np.diff(at) > 1) | (word[at[1:]] != word[at[:-1]])])
            run = np.flatnonzero(head)[np.cumsum(head) - 1]
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            seen = np.cumsum(self.early[made[at]]) - self.early[made[at]]
            first = np.flatnonzero(np.concatenate([[True], word[at[1:]] != word[at[:-1]]]))
            at = at[seen == np.repeat(seen[first], np.diff(np.append(first, len(at))))]
            symbols = symbols.copy()
            symbols[at] = made[at]
            stays = ~ready
            stays[at + 1] = False
            symbols, word = symbols[stays], word[stays]
        out, owners = np.concatenate(out or [symbols]), np.concatenate(owners or [word])
        return out[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(sizes))

    def _heap(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one long word: pairs in order of rank and place."""
        n, syms = len(symbols), symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, made = self._pairs(symbols[:-1], symbols[1:])
        some = np.flatnonzero(rank < _NONE)
        queue = [(int(rank[i]), i, syms[i], syms[i + 1], int(made[i])) for i in some.tolist()]
        heapq.heapify(queue)
        table = self.__dict__.setdefault("_table", None) or dict(zip(self.pairs.tolist(), zip(self.ranks.tolist(), self.merged.tolist(), strict=True), strict=True))
        self._table = table
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = after[i]
            if syms[i] != a or j >= n or syms[j] != b:
                continue
            syms[i], syms[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if 0 <= x and y < n and max(syms[x], syms[y]) < self.width:
                    got = table.get(syms[x] * self.width + syms[y])
                    if got:
                        heapq.heappush(queue, (got[0], x, syms[x], syms[y], got[1]))
        return np.array([s for s in syms if s >= 0], np.int64)

    def _ids(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no pieces become the ids of their bytes."""
        n = self.library.get_piece_size()
        odd = np.flatnonzero(symbols >= n)
        if not len(odd):
            return symbols, sizes
        spelt = [(self.codes[s] if s < self.width else chr(s - self.width)).encode() for s in symbols[odd].tolist()]
        counts = np.ones(len(symbols), np.int64)
        counts[odd] = [len(x) for x in spelt]
        out = np.repeat(symbols, counts)
        out[np.repeat(symbols >= n, counts)] = self.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
        return out, np.add.reduceat(counts, np.cumsum(sizes) - sizes)

    def words(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        codes = np.frombuffer("".join(new).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(w) for w in new], np.int64)
        symbols = self.symbol_of[codes]
        if not len(new) or sizes.max() <= LONG:
            return self._ids(*self.merge(symbols, sizes))
        # Long words are cut where no piece has two characters side by side.
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        begins = np.zeros(len(codes), bool)
        begins[ends - sizes] = True
        apart = ~np.isin(codes[:-1] << 21 | codes[1:], self.beside)
        begins[1:] |= apart & np.repeat(sizes > LONG, sizes)[1:]
        heads = np.flatnonzero(begins)
        lengths = np.diff(np.append(heads, len(codes)))
        big = lengths > LONG
        at = np.repeat(big, lengths)
        done, counts = self.merge(symbols[~at], lengths[~big])
        parts, kept = np.split(done, np.cumsum(counts)[:-1]) if len(counts) else [], []
        rest = iter(parts)
        for k in range(len(heads)):
            kept.append(self._heap(symbols[heads[k] : heads[k] + lengths[k]]) if big[k] else next(rest))
        held = np.bincount(owner[heads], weights=[len(x) for x in kept], minlength=len(sizes)).astype(np.int64)
        return self._ids(np.concatenate(kept), held)

    def _learn(self) -> None:
        new, self.memo.new = self.memo.new, []
        ends = np.cumsum([len(w) for w in new])
        self.chars += int(ends[-1])
        at = 0
        while at < len(new):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ROUND, "right")))
            ids, sizes = self.words(new[at:to])
            used = self.starts[-1] + self.sizes[-1] if len(self.starts) else 0
            self.pool.append(ids.astype(np.int32))
            self.starts = np.concatenate([self.starts, used + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            at = to
        self.pool = [np.concatenate(self.pool)]

    # Texts

    def parts(self, texts: list[str]):
        """(number of the text, ids) in order; a long text has several, an empty one has none."""
        held, owners, size = [], [], 0
        for k, text in enumerate(texts):
            if not text:
                continue
            text = SPACE + text.replace(" ", SPACE)
            for part in [text] if len(text) <= PART else map(re.Match.group, self.part.finditer(text)):
                held.append(part)
                owners.append(k)
                size += len(part)
                if size > PART:
                    yield from self._known(held, owners)
                    held, owners, size = [], [], 0
        yield from self._known(held, owners)

    def _known(self, held: list[str], owners: list[int]):
        if len(self.memo) > MEMO or self.chars > MEMO_CHARS:
            self._forget()
        self.memo.new = []
        numbers = [np.fromiter(map(self.memo.__getitem__, self.word.findall(p)), np.int64) for p in held]
        if self.memo.new:
            self._learn()
        for k, x in zip(owners, numbers, strict=True):
            yield k, self.pool[0][flat(self.starts[x], self.sizes[x])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found: list[list] = [[] for _ in texts]
        for k, ids in self.parts(texts):
            found[k].append(ids)
        return [np.concatenate(x) if x else np.zeros(0, np.int32) for x in found]

    def surface(self, ids: np.ndarray, begins: bool = True) -> bytes:
        """The bytes of ids; where a text begins, the space mark that encoding put there is taken off."""
        out = self.bytes[flat(self.byte_starts[ids], self.byte_sizes[ids])].tobytes()
        if begins:
            some = np.flatnonzero(self.byte_sizes[ids])
            if len(some) and self.spaced[ids[some[0]]]:
                return out[1:]
        return out

    def decode(self, ids) -> str:
        try:
            return self.surface(np.asarray(ids, np.int64)).decode()
        except UnicodeDecodeError:  # bytes that are no text: as the library shows them
            return self.library.decode([int(i) for i in ids])

    def decimal(self, ids: np.ndarray) -> bytes:
        """Each id in decimal, with a comma after it."""
        return self.digits[flat(self.digit_starts[ids], self.digit_sizes[ids])].tobytes()


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id and ids of every document."""

    def run(batches):
        import pyarrow as pa

        codec = Codec(model_file)
        for b in batches:
            found = codec.encode(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x.tolist() for x in found], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of rows of ids; no ids (or null) are an empty text."""

    def run(batches):
        import pyarrow as pa

        codec = Codec(model_file)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([codec.decode(x or []) for x in b.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document. A text's ids and bytes are hashed run by run, so
    neither is held whole."""

    def run(batches):
        import pyarrow as pa

        codec = Codec(model_file)
        for b in batches:
            n = b.num_rows
            counts, ids_sums, text_sums = [0] * n, [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
            for k, ids in codec.parts(b.column("text").to_pylist()):
                ids_sums[k].update((b"," if counts[k] else b"") + codec.decimal(ids)[:-1])
                text_sums[k].update(codec.surface(ids, not counts[k]))
                counts[k] += len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array([x.hexdigest() for x in ids_sums]), pa.array([x.hexdigest() for x in text_sums])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
