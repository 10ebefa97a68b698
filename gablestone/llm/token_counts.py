"""Token counts by a compiled finite-state transducer.

A byte-level BPE vocabulary is compiled, as texts ask for it, into a deterministic transducer over
bytes. Its state holds what can still matter of the word read so far: the longest suffix that
begins some vocabulary entry and, before each of its suffixes that do, the last token of the
encoding up to there and how many tokens fewer it has. After a byte exactly one vocabulary entry
that ends there may follow its predecessor (the pair encodes as itself), so the next state is
unique, and the transition is annotated with the change of the number of tokens. States and
transitions are found on first use and kept in a table; many words run through it in lockstep.

Texts are cut into chunks of bounded size. A chunk's state map is (head, inner, tail): the
characters before the first place where the splitter's state does not depend on what came before
(white space after a character that is none), the tokens between the first and the last such place,
and the characters after it. Maps compose associatively, so the chunks of a text are combined by the
up-sweep of a parallel prefix scan (only the last prefix is asked for), which holds no more than the
text; only the short seams tail + head are counted anew.

Sentencepiece models have no such word boundaries: they are counted by their own library.

Defined results: a null text counts as an empty one, which has 0 tokens; special strings inside a
text count as the library's default has it; repeated rows stay; no rows give none; other columns
are not read.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import DataFrame

LIMIT = 512
CHUNK = 1 << 18
#: States of a worker's table; beyond that it starts anew.
STATES = 300_000
#: Pairs of tokens that a worker remembers.
PAIRS = 500_000
#: Longer words are run one by one.
LANE = 96

_NEVER = float("inf")
_CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d"
#: The splitter, over a text in which every character is one of its class.
_SPLIT = re.compile(rf"{_CONTRACTIONS}| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


def byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for
    themselves, the others in order from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    found = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return found | {chr(256 + i): b for i, b in enumerate(others)}


class Transducer:
    """The lazily determinised transducer of a vocabulary with ranked merges."""

    def __init__(self, vocab: dict[bytes, int], merges: dict[tuple[int, int], tuple[int, int]]):
        self.vocab, self.merges = vocab, merges
        self.bytes_of = {i: t for t, i in vocab.items()}
        self.heads = {t[:k] for t in vocab for k in range(1, len(t))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.parts = {new: (a, b, rank) for (a, b), (rank, new) in merges.items()}
        self.spines: tuple[dict, dict] = ({}, {})
        self._forget()

    def _forget(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.column = np.full(256, -1, np.int64)
        self.width = 0
        # 256 x the next state + 128 + the change of the number of tokens; 0 is not yet known.
        self.next = np.zeros((1024, 64), np.int32)
        self._state((b"", ((-1, 0),)))

    def _state(self, state: tuple) -> int:
        k = self.numbers.get(state)
        if k is None:
            k = self.numbers[state] = len(self.states)
            self.states.append(state)
            if k >= len(self.next):
                self._grow(2 * k, self.next.shape[1])
        return k

    def _grow(self, rows: int, columns: int) -> None:
        """Rows of zeros take no memory before they are written to."""
        grown = np.zeros((rows, columns), np.int32)
        used = min(len(self.states), len(self.next))
        grown[:used, : self.next.shape[1]] = self.next[:used]
        self.next = grown

    def encode(self, word: bytes) -> list[int]:
        """By merging, the lowest rank first; the definition that the transducer is compiled from."""
        ids = [self.vocab[bytes([b])] for b in word]
        while len(ids) > 1:
            rank, i = min((self.merges.get(p, (1 << 60, 0))[0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)))
            if rank == 1 << 60:
                break
            pair, new = (ids[i], ids[i + 1]), self.merges[ids[i], ids[i + 1]][1]
            out, j = [], 0
            while j < len(ids):
                if j + 1 < len(ids) and (ids[j], ids[j + 1]) == pair:
                    out.append(new)
                    j += 2
                else:
                    out.append(ids[j])
                    j += 1
            ids = out
        return ids

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at the left (0) or right (1) edge while a token is built up, each with the rank
        of the merge that takes it up; the token itself is never taken up."""
        found = self.spines[side].get(token)
        if found is None:
            found, last = [(token, _NEVER)], token
            while last in self.parts:
                a, b, rank = self.parts[last]
                last = b if side else a
                found.append((last, rank))
            self.spines[side][token] = found = found[::-1]
        return found

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether a, b encodes as itself: no merge over the border comes before the merges that take
        up the tokens at the border; of equal ranks the left one comes first."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            left, right, i, j = self._spine(a, 1), self._spine(b, 0), 0, 0
            found = True
            while True:
                (x, taken_x), (y, taken_y) = left[i], right[j]
                over = self.merges.get((x, y))
                if over is not None and over[0] < taken_x and over[0] <= taken_y:
                    found = False
                    break
                if taken_x == taken_y == _NEVER:
                    break
                if taken_x <= taken_y:
                    i += 1
                else:
                    j += 1
            self.pairs[a, b] = found
        return found

    def _step(self, k: int, byte: int) -> tuple[int, int]:
        """The state after a byte, and the change of the number of tokens."""
        suffix, before = self.states[k]
        b = bytes([byte])
        for j in range(len(suffix), -1, -1):
            if before[j] is None:
                continue
            token = self.vocab.get(suffix[len(suffix) - j :] + b)
            if token is not None and (before[j][0] < 0 or self._may_follow(before[j][0], token)):
                break
        else:
            raise ValueError("no token may end here")
        change = before[j][1] + 1
        read = suffix + b
        while read and read not in self.heads:
            read = read[1:]
        after: list = [(token, 0)]
        for j in range(1, len(read) + 1):
            old = before[j - 1] if read[len(read) - j :] in self.heads else None
            after.append(None if old is None else (old[0], old[1] - change))
        return self._state((read, tuple(after))), change

    def _columns(self, used: np.ndarray) -> None:
        for b in used[self.column[used] < 0]:
            if self.width == self.next.shape[1]:
                self._grow(len(self.next), self.width + 16)
            self.column[b] = self.width
            self.width += 1

    def _fill(self, states: np.ndarray, bytes_: np.ndarray) -> None:
        for key in np.unique(states * 256 + bytes_):
            k, b = divmod(int(key), 256)
            to, change = self._step(k, b)
            self.next[k, self.column[b]] = to << 8 | change + 128

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word; the words run through the table in lockstep, the longest first."""
        if len(self.states) > STATES:
            self._forget()
        sizes = np.array([len(w) for w in words], np.int64)
        found = np.zeros(len(words), np.int64)
        for k in np.flatnonzero(sizes > LANE):
            found[k] = self._long(words[k])
        lanes = np.flatnonzero((sizes <= LANE) & (sizes > 0))
        if not len(lanes):
            return found
        lanes = lanes[np.argsort(-sizes[lanes], kind="stable")]
        size = sizes[lanes]
        data = np.frombuffer(b"".join(words[k] for k in lanes), np.uint8)
        start = np.cumsum(size) - size
        self._columns(np.flatnonzero(np.bincount(data, minlength=256)))
        state, total = np.zeros(len(lanes), np.int64), np.zeros(len(lanes), np.int64)
        for j in range(int(size[0])):
            n = int(np.searchsorted(-size, -j, side="left"))  # lanes longer than j
            byte = data[start[:n] + j]
            col, now = self.column[byte], state[:n]
            entry = self.next[now, col]
            if (missing := entry == 0).any():
                self._fill(now[missing], byte[missing].astype(np.int64))
                entry = self.next[now, col]
            total[:n] += (entry & 255) - 128
            state[:n] = entry >> 8
        found[lanes] = total
        return found

    def _long(self, word: bytes) -> int:
        self._columns(np.unique(np.frombuffer(word, np.uint8)))
        k = total = 0
        for b in word:
            c = self.column[b]
            if not self.next[k, c]:
                if len(self.states) > 4 * STATES:  # a state says all that is needed to go on
                    state = self.states[k]
                    self._forget()
                    self._columns(np.unique(np.frombuffer(word, np.uint8)))
                    k, c = self._state(state), self.column[b]
                to, change = self._step(k, b)
                self.next[k, c] = to << 8 | change + 128
            total += int(self.next[k, c] & 255) - 128
            k = int(self.next[k, c]) >> 8
        return total


class Counter:
    """Tokens of texts by the transducer of a tokenizer file."""

    def __init__(self, tokenizer_file: str, chunk: int = CHUNK):
        from tokenizers import Tokenizer

        from gablestone.llm._pieces import Numbers

        with open(tokenizer_file) as f:
            spec = json.load(f)
        letters = byte_letters()
        added = {t["content"] for t in spec.get("added_tokens", [])}
        vocab = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        merges = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b = (bytes(letters[c] for c in x) for x in (a, b))
            merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.transducer, self.chunk = Transducer(vocab, merges), chunk
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.library = Tokenizer.from_file(tokenizer_file)
        self.classes: dict[int, str] = {c: chr(c) for c in range(128)}
        self.memo, self.known = Numbers(), np.zeros(0, np.int64)

    def _class(self, code: int) -> str:
        """A character of the same class as another one, as the library's own splitter has it."""
        found = self.classes.get(code)
        if found is None:
            c, one = chr(code), lambda s: len(self.library.pre_tokenizer.pre_tokenize_str(s)) == 1
            try:
                found = "a" if one(f"a{c}a") else "0" if one(f"0{c}0") else "!" if one(f"!{c}!") else "\t"
            except Exception:  # not a character that UTF-8 has
                found = "!"
            self.classes[code] = found
        return found

    def _words(self, piece: str) -> tuple[list[bytes], int]:
        """The splitter's words of a piece, and the special strings in it."""
        words, special, at = [], 0, 0
        spans = [(m.start(), m.end()) for m in self.special.finditer(piece)] if self.special else []
        for start, end in [*spans, (len(piece), len(piece))]:
            part = piece[at:start]
            shape = part if part.isascii() else "".join(self._class(ord(c)) for c in part)
            words += [part[m.start() : m.end()].encode() for m in _SPLIT.finditer(shape)]
            special += end > start
            at = end
        return words, special

    def _count(self, pieces: list[str]) -> np.ndarray:
        words, owner, extra = [], [], np.zeros(len(pieces), np.int64)
        for k, p in enumerate(pieces):
            if p.isascii() and p[1:].isalpha() and (p[0] == " " or p[0].isalpha()):
                words.append(p.encode())
                owner.append(k)
            else:
                found, extra[k] = self._words(p)
                words += found
                owner += [k] * len(found)
        if words:
            np.add.at(extra, np.array(owner), self.transducer.counts(words))
        return extra

    def _sum(self, parts: list[str]) -> list[int]:
        """Tokens of closed parts: each begins and ends where the splitter forgets."""
        from gablestone.llm._pieces import MEMO, Numbers, keys, piece

        if len(self.memo) > MEMO:
            self.memo, self.known = Numbers(), np.zeros(0, np.int64)
        self.memo.new = []
        numbers = [np.fromiter(map(self.memo.__getitem__, keys(p)), np.int64) for p in parts]
        if self.memo.new:
            self.known = np.concatenate([self.known, self._count([piece(k) for k in self.memo.new])])
        return [int(self.known[x].sum()) for x in numbers]

    def batch(self, texts: list[str]) -> list[int]:
        """Tokens of each text: chunk maps, then a prefix scan over the chunks of each text."""
        from gablestone.llm._pieces import _SPACES

        whole, maps, owner = [], [], []
        for k, t in enumerate(texts):
            if len(t) <= self.chunk:
                whole.append(k)
                continue
            for i in range(0, len(t), self.chunk):
                maps.append(t[i : i + self.chunk])
                owner.append(k)
        found = [0] * len(texts)
        for k, n in zip(whole, self._sum([texts[k] for k in whole]), strict=True):
            found[k] = n
        if maps:
            elements: dict[int, list] = {}
            for k, m in zip(owner, self._maps(maps, _SPACES), strict=True):
                elements.setdefault(k, []).append(m)
            for k, row in elements.items():
                found[k] = self._close(self.total(row))
        return found

    def _maps(self, chunks: list[str], spaces) -> list[tuple]:
        """(head, inner, tail) of each chunk; inner is None where the splitter never forgets."""
        out, inside = [], []
        for c in chunks:
            first = next((i for i in range(1, len(c)) if c[i] in spaces and c[i - 1] not in spaces), None)
            if first is None:
                out.append((c, None, ""))
                inside.append("")
                continue
            last = next(i for i in range(len(c) - 1, 0, -1) if c[i] in spaces and c[i - 1] not in spaces)
            out.append((c[:first], 0, c[last:]))
            inside.append(c[first:last])
        return [(h, n if n is None else k, t) for (h, n, t), k in zip(out, self._sum(inside), strict=True)]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[1] is None and b[1] is None:
            return self._maps([a[0] + b[0]], _spaces())[0] if _forgets_between(a[0], b[0]) else (a[0] + b[0], None, "")
        if a[1] is None:
            return self._reopen(a[0] + b[0], "head", b)
        if b[1] is None:
            return self._reopen(a[2] + b[0], "tail", a)
        return a[0], a[1] + self._sum([a[2] + b[0]])[0] + b[1], b[2]

    def _reopen(self, seam: str, side: str, m: tuple) -> tuple:
        """Put a seam before the head or behind the tail of a map."""
        h, n, t = self._maps([seam], _spaces())[0]
        if side == "head":
            return (seam, m[1], m[2]) if n is None else (h, n + self._sum([t])[0] + m[1], m[2])
        if n is None:
            return m[0], m[1], seam
        return m[0], m[1] + self._sum([h])[0] + n, t

    def total(self, row: list[tuple]) -> tuple:
        """The last prefix of the scan: neighbours are composed in a logarithmic number of rounds."""
        while len(row) > 1:
            row = [self.compose(*row[i : i + 2]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
        return row[0]

    def _close(self, m: tuple) -> int:
        return self._sum([m[0]])[0] if m[1] is None else sum(self._sum([m[0], m[2]])) + m[1]


def _spaces():
    from gablestone.llm._pieces import _SPACES

    return _SPACES


def _forgets_between(a: str, b: str) -> bool:
    return bool(a) and bool(b) and b[0] in _spaces() and a[-1] not in _spaces()


def counter(tokenizer_file: str):
    """The function from texts to their numbers of tokens."""
    from gablestone.llm._pieces import splits_anywhere

    if tokenizer_file.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file)
        return lambda t: [len(x) for x in model.encode(t, num_threads=1)]
    if splits_anywhere(tokenizer_file):
        return Counter(tokenizer_file).batch
    # A splitter or normalizer of another kind is not compiled: the library counts whole texts.
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_file(tokenizer_file)
    library.no_truncation()
    library.no_padding()
    return lambda t: [len(e.ids) for e in library.encode_batch_fast(t, add_special_tokens=False)]


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        count = counter(tokenizer_file)
        for b in batches:
            text = pc.fill_null(b.column("text"), "")
            n: list[int] = []
            for i in range(0, len(text), 500):
                n += count(text.slice(i, 500).to_pylist())
            n = pa.array(n, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pc.binary_length(text).cast(pa.int64()), n, pc.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
