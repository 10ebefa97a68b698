"""Language identification by character language models.

For each language an interpolated Kneser-Ney model of character 4-grams is learned: raw counts at
the highest order, continuation counts below, one absolute discount for each order (n1 / (n1 + 2
n2)), down to a uniform distribution. The models of all languages are merged into sorted arrays of
n-gram hashes, with the log-probability in each language beside each hash, and sorted arrays of
context hashes with the weight of the lower order. A text gets the language of the lowest
cross-entropy per character.

Characters are letters in lower case; runs of anything else are one space.

Bounded sample: training texts are drawn by a hash of doc_id, `TRAIN_BYTES` of text a language on
average, of the labelled training rows; one in `CALIBRATION` of those is kept apart. On these, the
cross-entropies per language give mean, spread and the `1 - ALPHA` quantile of the standardised
excess: a text whose excess is above the quantile is rejected, as is one whose runner-up is as
likely as the winner. A language with fewer than `FEW` calibration texts is judged by the texts of
all languages together; where these too are fewer, only ties and texts without a letter go. The score is the winner's posterior probability, tempered to
the calibration texts, and lowered for untypical texts.

Defined results: a null text, or one without a letter, is `und` with score 0 and rejected; ties go
to the first language by name; without any labelled text all are `und`; rows without a language are
predicted but not learned from; repeated rows stay; whole texts count, whatever their length; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.llm._base import unused

ORDER = 4
TRAIN_BYTES = 2_000_000
CALIBRATION = 5
ALPHA = 0.001
FEW = 20
#: Characters of text worked on at once.
SLICE = 1 << 18

_K = np.uint64(0x9E3779B97F4A7C15)
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For each code point its letter in lower case, or a space."""
    if not _FOLD:
        _FOLD.append(np.array([ord(c.lower()[0]) if c.isalpha() else 32 for c in map(chr, range(0x110000))], np.uint32))
    return _FOLD[0]


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, text): the folded characters of the texts in a row, each text between spaces, and the
    number of the text of each."""
    raw = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.array([len(t) + 2 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    codes = _fold()[raw]
    space = codes == 32
    keep = ~space
    keep[1:] |= space[1:] & (~space[:-1] | (owner[1:] != owner[:-1]))
    keep[0] = True
    return codes[keep], owner[keep]


def _grams(codes: np.ndarray, owner: np.ndarray, order: int = ORDER) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of the n-grams that end at each character but a text's first; places before the text
    are spaces."""
    ends = np.flatnonzero(np.append(False, owner[1:] == owner[:-1]))
    begin = np.searchsorted(owner, owner[ends])
    return [np.where(ends - k >= begin, codes[np.maximum(ends - k, 0)], 32).astype(np.uint64) for k in range(order - 1, -1, -1)], owner[ends]


def _keys(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row of code points."""
    key = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        key = (key ^ (c + np.uint64(1))) * _K
        key ^= key >> np.uint64(29)
    return key


class _Model:
    """Interpolated Kneser-Ney of one language, from rows of ORDER code points and their counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.levels = {}
        n = codes.shape[1]
        while True:
            key, first, inverse = np.unique(_keys(list(codes.T)), return_index=True, return_inverse=True)
            counts = np.bincount(inverse, counts, len(key))
            codes = codes[first]
            n1, n2 = (counts == 1).sum(), (counts == 2).sum()
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            context, inverse = np.unique(_keys(list(codes[:, :-1].T)) if n > 1 else np.zeros(len(codes), np.uint64), return_inverse=True)
            total, kinds = np.bincount(inverse, counts), np.bincount(inverse)
            self.levels[n] = (key, counts, context, total, kinds, discount, codes)
            if n == 1:
                break
            codes, counts, n = codes[:, 1:], np.ones(len(codes)), n - 1
        self.uniform = 1 / (len(self.levels[1][0]) + 1)

    def weight(self, n: int, context: np.ndarray) -> np.ndarray:
        """Of the lower order, after each context."""
        _, _, own, total, kinds, discount, _ = self.levels[n]
        at = np.minimum(np.searchsorted(own, context), len(own) - 1)
        return np.where(own[at] == context, discount * kinds[at] / total[at], 1.0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        n = codes.shape[1]
        if n == 0:
            return np.full(len(codes), self.uniform)
        key, counts, own, total, _, discount, _ = self.levels[n]
        asked = _keys(list(codes.T))
        context = _keys(list(codes[:, :-1].T)) if n > 1 else np.zeros(len(codes), np.uint64)
        at, c = np.minimum(np.searchsorted(key, asked), len(key) - 1), np.minimum(np.searchsorted(own, context), len(own) - 1)
        seen = np.where((key[at] == asked) & (own[c] == context), np.maximum(counts[at] - discount, 0) / total[c], 0.0)
        return seen + self.weight(n, context) * self.probability(codes[:, 1:])


class Identifier:
    """The merged models and what the calibration gave."""

    def __init__(self, models: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(models)
        fitted = [_Model(*models[x]) for x in self.langs]
        self.tables, self.weights = {}, {}
        for n in range(1, ORDER + 1) if fitted else ():
            codes = np.concatenate([m.levels[n][6] for m in fitted])
            key, first = np.unique(_keys(list(codes.T)), return_index=True)
            codes = codes[first]
            self.tables[n] = key, np.log(np.stack([m.probability(codes) for m in fitted], 1)).astype(np.float32)
            context = np.unique(_keys(list(codes[:, :-1].T))) if n > 1 else np.zeros(1, np.uint64)
            self.weights[n] = context, np.log(np.stack([m.weight(n, context) for m in fitted], 1)).astype(np.float32)
        self.floor = np.log([m.uniform for m in fitted]).astype(np.float32)
        self.mean, self.spread, self.bound = np.zeros(len(fitted)), np.ones(len(fitted)), np.full(len(fitted), np.inf)
        self.temper = 1.0

    def _log(self, columns: list[np.ndarray]) -> np.ndarray:
        """Log-probability of each row's last character after the others, in each language."""
        n = len(columns)
        if n == 0:
            raise ValueError
        key, values = self.tables[n]
        asked = _keys(columns)
        at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
        out = values[at]
        missed = np.flatnonzero(key[at] != asked)
        if len(missed):
            rest = [c[missed] for c in columns]
            context = _keys(rest[:-1]) if n > 1 else np.zeros(len(missed), np.uint64)
            own, weight = self.weights[n]
            at = np.minimum(np.searchsorted(own, context), len(own) - 1)
            lower = self._log(rest[1:]) if n > 1 else np.broadcast_to(self.floor, (len(missed), len(self.langs)))
            out[missed] = lower + np.where((own[at] == context)[:, None], weight[at], 0)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character in each language, characters) of each text; texts without a
        letter have no characters."""
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= SLICE):
                size += len(texts[to])
                to += 1
            codes, owner = letters(texts[at:to])
            dark = np.bincount(owner[codes != 32], minlength=to - at) > 0
            for i in range(0, len(codes), SLICE):  # a long text in parts, each with what is before it
                a = max(0, i - ORDER)
                columns, of = _grams(codes[a : i + SLICE], owner[a : i + SLICE])
                fresh = slice(max(0, len(of) - self._new(owner, i)), None)
                columns, of = [c[fresh] for c in columns], of[fresh]
                if len(of):
                    logs = self._log(columns)
                    for k in range(len(self.langs)):
                        total[at:to, k] += np.bincount(of, logs[:, k], minlength=to - at)
                    n[at:to] += np.bincount(of, minlength=to - at)
            n[at:to][~dark] = 0
            at = to
        return -total / np.maximum(n, 1)[:, None], n

    @staticmethod
    def _new(owner: np.ndarray, i: int) -> int:
        """How many of the characters of a part end an n-gram."""
        part = owner[max(0, i - 1) : i + SLICE]
        return int((part[1:] == part[:-1]).sum())

    def calibrate(self, texts: list[str], langs: list[str]) -> None:
        if not texts:
            return
        h, n = self.entropies(texts)
        truth = np.array([self.langs.index(x) for x in langs])
        for k in range(len(self.langs)):
            own = np.flatnonzero((truth == k) & (n > 0))
            if len(own) < FEW:
                own = np.flatnonzero(n > 0)
            if len(own) < FEW:
                continue
            x, size = h[own, truth[own]], n[own]
            self.mean[k] = np.average(x, weights=size)
            self.spread[k] = max(1e-6, np.sqrt(np.mean((x - self.mean[k]) ** 2 * size)))
            self.bound[k] = np.quantile((x - self.mean[k]) * np.sqrt(size) / self.spread[k], 1 - ALPHA, method="higher")
        # The temperature under which the calibration texts are likeliest.
        own = np.flatnonzero(n > 0)
        tried = 2.0 ** np.arange(0, 8)
        loss = [-np.mean(self._posterior(h[own], n[own], t)[np.arange(len(own)), truth[own]].clip(1e-12)) for t in tried]
        self.temper = float(tried[int(np.argmin(loss))])

    @staticmethod
    def _posterior(h: np.ndarray, n: np.ndarray, temper: float) -> np.ndarray:
        x = -(h - h.min(1, keepdims=True)) * n[:, None] / temper
        x = np.exp(x)
        return x / x.sum(1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, cross-entropy, rejected) of each text."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n = self.entropies(texts)
        best = np.argmin(h, 1)
        rows = np.arange(len(texts))
        posterior = self._posterior(h, n, self.temper)[rows, best] if len(texts) else np.zeros(0)
        excess = (h[rows, best] - self.mean[best]) * np.sqrt(n) / self.spread[best]
        strange = excess > self.bound[best]
        typical = np.where(strange, np.clip(self.bound[best] / np.maximum(excess, 1e-9), 0, 1), 1.0)
        score = np.where(n > 0, np.clip(posterior * typical, 0, 1), 0.0)
        two = np.sort(h, 1)[:, :2]
        tied = (two[:, 1] - two[:, 0]) * n <= 1e-9 if len(self.langs) > 1 else np.zeros(len(texts), bool)
        rejected = (n == 0) | strange | tied
        return [self.langs[k] if m else "und" for k, m in zip(best, n, strict=True)], score, h[rows, best], rejected


def train(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> Identifier:
    """Learn from docs (doc_id, text, lang), those with a language."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text", "lang").where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size"))
    share = F.broadcast(sizes.select(F.col("lang").alias("_lang"), (F.lit(float(train_bytes)) / F.greatest("size", F.lit(1))).alias("share")))
    # One row a language; languages are labels.
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.join(share, rows["lang"] == F.col("_lang")).where(drawn < F.col("share"))
    sample = sample.select("lang", "text", (F.pmod(F.xxhash64(F.concat("id", F.lit("/"))), F.lit(CALIBRATION)) == 0).alias("apart"))

    def count(pdf):
        import pandas as pd

        part = pdf[~pdf["apart"]] if (~pdf["apart"]).any() else pdf
        columns, _ = _grams(*letters(part["text"].tolist()))
        _, first, counts = np.unique(_keys(columns), return_index=True, return_counts=True)
        codes = np.stack([c[first] for c in columns], 1).astype("<u4")
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "codes": [codes.tobytes()], "counts": [counts.astype("<i8").tobytes()]})

    def measure(texts_and_langs):
        return [r["text"] for r in texts_and_langs], [r["lang"] for r in texts_and_langs]

    models = {}
    for r in sample.groupBy("lang").applyInPandas(count, "lang string, codes binary, counts binary").collect():
        codes = np.frombuffer(r["codes"], "<u4").reshape(-1, ORDER).astype(np.uint64)
        if len(codes):
            models[r["lang"]] = codes, np.frombuffer(r["counts"], "<i8").astype(float)
    found = Identifier(models)
    found.calibrate(*measure([r for r in sample.where("apart").select("lang", "text").collect() if r["lang"] in models]))
    return found


PREDICTED = "lang_pred string, score double, cross_entropy double, rejected boolean"


def predict(docs: DataFrame, identifier: Identifier, name: str = "found") -> DataFrame:
    """docs with a struct of PREDICTED of that name; only texts are looked at."""
    held = docs.sparkSession.sparkContext.broadcast(identifier)

    @F.pandas_udf(PREDICTED)
    def label(text):
        import pandas as pd

        lang, score, h, rejected = held.value.predict([t or "" for t in text])
        return pd.DataFrame({"lang_pred": lang, "score": score, "cross_entropy": h, "rejected": rejected})

    return docs.withColumn(name, label(F.col("text")))


def split(docs: DataFrame, folds: int = 4, held: int = 2):
    """Whether a document is held out of training."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds)) == held


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    docs = docs.select("doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text", split(docs).alias("held_out")), train(docs.where(~split(docs))))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


def keep(docs: DataFrame) -> DataFrame:
    """The documents whose language is not rejected, with their columns."""
    name, = unused(docs, "found")
    return predict(docs, train(docs.where(~split(docs))), name).where(~F.col(f"{name}.rejected")).drop(name)
