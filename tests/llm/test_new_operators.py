"""Divergence audit, SentencePiece codec and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gablestone.llm import divergence, queries, resampling, sentencepieces
from gablestone.llm._words import ALNUM, LETTERS, spans
from gablestone.llm.queries import tokenizer_file

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "\n\n", "a", "A a B", "x's 'tis it's,", "a  b", "<s>foo</s><unk><0x0A>", "é, ñ. ²,", "🙂 🙂🙂 . ,", "Word " * 400, "ab" * 3000 + " c", "a\x1cb \x00 d", "▁a▁ ▁b", "全角 文字列です。" * 90, " " * 700, "\t" * 20, "a" * 900]
SCHEMA = "doc_id long, text string, lang string, source string, n long, score string, rank int, term string"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """Real documents, odd ones, repeated rows, rows without an id, and columns with clashing names."""
    real = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(150).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, 1, "x", 1, "t") for r in real]
    rows += [(10_000 + i, t, "en" if i % 3 else None, None, None, None, None, None) for i, t in enumerate(ODD)]
    rows += [rows[3], rows[4], (None, "a row without an id " * 9, "en", "src1", 2, "", 0, ""), (None, None, "it", "src1", 2, "", 0, ""), (5, "1 2 3", "it", "src2", 2, "", 0, ""), (6, "alone", "xx", "src2", 2, "", 0, "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_spans_find_the_words_of_any_run():
    texts = ["", "ab c", "d", "", "éé-f", "x" * 50, " y "]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    want = [(k, w) for k, t in enumerate(texts) for w in re.findall(r"[^\W\d_]+", t)]
    for size in (1, 2, 3, 7, 100):
        got = [(int(d), raw[a:b].tobytes().decode()) for s, e, docs in spans(raw, offsets, LETTERS, size) for a, b, d in zip(s, e, docs)]
        assert got == want


# Divergence


def test_equal_digests_do_not_join_slices():
    words = [b"ab", b"cd", b"ab", b"efg", b"cd", b"x", b"ab"]
    raw = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    for digest in (lambda piece: 7, lambda piece: len(piece), None):
        found, number = divergence.distinct(raw, starts, ends, digest)
        assert [found[k] for k in number] == words


def audited(docs, least, smooth, scale, top):
    """The contract, in plain Python."""
    held, seen = defaultdict(Counter), defaultdict(Counter)
    for r in docs:
        lang, source = r.lang or "", r.source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r.text or "").translate(LOW))
        held[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in held}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        groups = {s: held[g, s] for g, s in held if g == lang}
        every = sum(groups.values(), Counter())

        def share(count):
            total = sum(count[t] for t in kept)
            return [1 + scale * (count[t] + smooth) // (total + smooth * len(kept)) for t in kept]

        p, q = {s: share(c) for s, c in groups.items()}, share(every)
        for s in groups:
            pairs = sorted(((-sum(abs(a - b) for a, b in zip(p[s], p[o])), o.encode()) for o in groups if o != s))
            out += [(lang, s, "pair", o.decode(), -f, k + 1) for k, (f, o) in enumerate(pairs)]
            terms = sorted((-(a - b), t.encode()) for t, a, b in zip(kept, p[s], q) if groups[s][t] and a > b)
            out += [(lang, s, "term", t.decode(), -f, k + 1) for k, (f, t) in enumerate(terms[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("least, top, block, held", [(5, 50, 400_000, 1_000_000), (3, 4, 37, 500), (10_000, 5, 10, 100)])
def test_audit_is_the_contracts(docs, least, top, block, held):
    got = rows(divergence.audit(docs, min_docs=least, top=top, block=block, held=held))
    assert got == audited(docs.collect(), least, 5, 1_000_000_000, top)


def test_shares_are_exact_beyond_long(spark):
    n = 4_000_000_000_000
    got = spark.sql(f"select 1 + (cast({n} + 5 as decimal(20, 0)) * 1000000000) div ({3 * n} + 5 * 7) as p").first().p
    assert got == 1 + (n + 5) * 10**9 // (3 * n + 35)


def test_block_sums_match_dense_ones():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n, m = int(rng.integers(1, 7)), int(rng.integers(0, 9))
        dense, base = rng.integers(1, 50, (n, m)), rng.integers(1, 50, n)
        has = rng.random((n, m)) < 0.4
        full = np.where(has, dense, base[:, None])
        i, t = np.nonzero(has)
        order = rng.permutation(len(i))
        for k, out in divergence.block_sums(i[order], t[order], dense[has][order], base, m):
            assert out[k + 1 :].tolist() == np.abs(full - full[k]).sum(1)[k + 1 :].tolist()


def test_audit_of_no_documents(empty):
    assert divergence.audit(empty).count() == 0


# SentencePiece


@pytest.fixture(scope="module")
def codec():
    return sentencepieces.Codec(tokenizer_file("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))


def fuzz(library, seed):
    rng = random.Random(seed)
    letters = ["a", "b", "e", "n", " ", "▁", "\n", "t", "h", "0", "=", "-", "é", "ß", "ж", "中", "🙂", "\t"]
    out = ["".join(rng.choice(letters[:k]) for _ in range(rng.randint(1, 400))) for k in (2, 4, 6, 9, 18) for _ in range(60)]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    out += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 150))) for _ in range(200)]
    return out + ["".join(rng.choice(pieces).strip() for _ in range(rng.randint(1, 600))) for _ in range(30)]


def test_ids_and_texts_are_the_librarys(codec, library):
    texts = [t or "" for t in ODD] + fuzz(library, 3)
    got = codec.encode(texts)
    assert [x.tolist() for x in got] == library.encode(texts)
    assert [codec.decode(x) for x in got] == [library.decode(x.tolist()) for x in got]


@pytest.mark.parametrize("long, part, memo", [(2, 8, 5), (16, 1, 50), (100_000, 64, 1)])
def test_any_cut_gives_the_same_ids(library, monkeypatch, long, part, memo):
    """Heap instead of rounds, short runs, a memo that starts anew."""
    for name, value in (("LONG", long), ("PART", part), ("MEMO", memo)):
        monkeypatch.setattr(sentencepieces, name, value)
    texts = [t or "" for t in ODD] + fuzz(library, 5)[::4]
    codec = sentencepieces.Codec(tokenizer_file("piece_bpe_32k.model"))
    assert [x.tolist() for x in codec.encode(texts)] == library.encode(texts)


def test_decoding_any_ids(codec, library):
    rng = random.Random(9)
    for _ in range(200):
        ids = [rng.choice([rng.randrange(library.get_piece_size()), rng.randrange(3, 259), 0, 1, 2, 259]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_round_trip_of_documents(docs, library):
    model = tokenizer_file("piece_bpe_32k.model")
    ids = {i: library.encode(t) for i, t in {(r.doc_id, r.text or ""): r.text or "" for r in docs.collect()}.items()}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted(((r.doc_id, len(x := ids[r.doc_id, r.text or ""]), digest(",".join(map(str, x))), digest(library.decode(x))) for r in docs.collect()), key=repr)
    assert rows(sentencepieces.round_trip(docs, model)) == want
    encoded = sentencepieces.encode(docs, model)
    assert sorted((repr(r.doc_id), r.ids) for r in encoded.collect()) == sorted((repr(r.doc_id), ids[r.doc_id, r.text or ""]) for r in docs.collect())
    assert sorted((repr(r.doc_id), r.text) for r in sentencepieces.decode(encoded, model).collect()) == sorted((repr(r.doc_id), (r.text or "").replace("▁", " ")) for r in docs.collect())


def test_round_trip_of_no_documents(empty):
    assert sentencepieces.round_trip(empty, tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_a_model_of_another_kind_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        spec.ParseFromString(f.read())
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    (tmp_path / "other.model").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError):
        sentencepieces.Codec(str(tmp_path / "other.model"))


# Resampling


def test_crc32_of_slices():
    rng = np.random.default_rng(2)
    words = [rng.bytes(n) for n in [1, 2, 3, 64, 65, 200, 5, 1000, 4, 4, 63]]
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    assert resampling.crc32(raw, ends - [len(w) for w in words], ends).tolist() == [zlib.crc32(w) for w in words]


def resampled(docs, target, low, high, buckets, percent, least):
    def found(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    held = [(r.doc_id, *found(r.text)) for r in docs]
    s, t = Counter(b for x in held for b in x[2]), Counter(b for r in target for b in found(r.text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log(float(t[b] + 1) * float(S + buckets) / (float(s[b] + 1) * float(T + buckets)))) for b in range(buckets)}
    out = []
    for doc_id, n, x in held:
        weight = sum(gain[b] for b in x) // len(x) if x else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[1], x[2]))
    drawn = able[: percent * len(able) // 100]
    return sorted([(*x[:4], k + 1) for k, x in enumerate(drawn)] + [(*x[:4], None) for x in out if not any(x is d for d in drawn)], key=repr)


@pytest.mark.parametrize("ngrams, length, percent", [((1, 1), 1 << 20, 10), ((1, 1), 50, 37), ((1, 2), 64, 10), ((2, 3), 1, 100)])
def test_resampling_is_the_contracts(spark, sf_dir, docs, ngrams, length, percent):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = rows(resampling.resample(docs, target, ngrams=ngrams, buckets=997, percent=percent, length=length))
    assert got == resampled(docs.collect(), target.collect(), *ngrams, 997, percent, 20)


def test_ties_go_to_the_smaller_id_and_repeats_stay(spark):
    rows_ = [(i % 4, "one two " * 12) for i in range(40)]
    frame, target = spark.createDataFrame(rows_, "doc_id long, text string"), spark.createDataFrame([("two",)], "text string")
    got = rows(resampling.resample(frame, target, percent=50))
    assert got == resampled(frame.collect(), target.collect(), 1, 1, 10_000, 50, 20) and sum(r[4] is not None for r in got) == 20


def test_resampling_of_no_documents_or_no_target(spark, docs, empty):
    assert resampling.resample(empty, docs).count() == 0
    assert rows(resampling.resample(docs, empty, buckets=97)) == resampled(docs.collect(), [], 1, 1, 97, 10, 20)
    with pytest.raises(ValueError):
        resampling.resample(docs, docs, buckets=70_000)


def test_selected_documents_keep_their_columns(spark, docs):
    ranks = resampling.resample(docs, docs, percent=20)
    drawn = {r.doc_id for r in ranks.collect() if r.rank is not None}
    got = resampling.selected(docs, ranks)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == drawn - {None}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_are_counted_by_their_library(docs, empty, name):
    from gablestone.llm import token_counts

    if name.endswith(".json"):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(tokenizer_file(name))
        count = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(name))
        count = lambda t: len(own.encode(t))
    got = token_counts.count_tokens(docs, tokenizer_file(name))
    assert rows(got.select("doc_id", "n_tokens")) == sorted(((r.doc_id, count(r.text or "")) for r in docs.collect()), key=repr)
    assert token_counts.count_tokens(empty, tokenizer_file(name)).count() == 0


def test_url_rules_of_one_length_and_no_pages(spark):
    from gablestone.llm import url_rules

    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, None)], "page_id long, url string")
    rules = url_rules.rule_table(spark, [("block", "com", "/x"), ("allow", "com", "/x")])
    assert {r.page_id: r.verdict for r in url_rules.judge(pages, rules).collect()} == {1: "allow", 2: "allow"}
    assert url_rules.judge(pages.limit(0), rules).count() == 0


def test_packing_counts_what_the_library_counts():
    from tokenizers import Tokenizer

    from gablestone.llm import packing
    from gablestone.llm.token_counts import CHUNK

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own, count = Tokenizer.from_file(tokenizer_file(name)), packing._counter(tokenizer_file(name))
        texts = [t or "" for t in ODD] + ["long words and lines\n" * (CHUNK // 15), "", "x" * 300]
        assert count(texts) == [len(own.encode(t, add_special_tokens=False).ids) for t in texts]
        assert count([]) == []


def test_url_rules_are_the_contracts(spark, tmp_path):
    urls = ["http://a.net/de/1", "http://example.net/de/7", "http://example.net/de/81", "http://a.com/en/1", "http://example.com/en/7", "http://a.org/es/1", "http://a.net/en/1"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.rule, r.verdict) for r in queries.op7_url_filter(spark, str(tmp_path)).collect()}
    assert [got[k] for k in range(len(urls))] == [
        ("net/de/", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("com/en/", "block"), ("example.com/en/7", "allow"), ("org/es/", "block"), (None, "allow"),
    ]
