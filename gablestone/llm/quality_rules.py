"""Quality rules with risk-controlled cutoffs, in DataFrame functions throughout.

Each rule is a share of a text in thousandths (symbols, words in repeated windows, words equal to
the one before, repeated lines) and rejects from a cutoff on. The cutoffs of all rules lie on one fixed path
from loose to tight (`path`); a labelled holdout says for each stratum (language) how far along it goes. A step is
certified when the exact binomial test rejects "at least `limit` of the good documents of this stratum would be
rejected by one rule or another at this step", that is P(Bin(n, limit) <= k) <= delta / strata for k of n good
documents rejected. Steps are tried from the loosest on, up to the first that fails (fixed-sequence testing: each has the
whole delta), and Bonferroni's correction covers strata, so with probability 1 - delta no stratum loses `limit` of its
good documents or more, over all rules together. With one step for all rules, ln(delta / strata) / ln(1 - limit)
good documents certify something (some 440 for four strata at one in a hundred). Where nothing can be certified the rules
stay off: few labels never cost documents. A trial is a labelled document: repeated labels and repeated rows of one doc_id
are one (rejected if one of its rows is), and it is good if all its labels say so.

Words are `[^\\x20\\x09-\\x0D]+`. Windows are found by hash; a text in which two hashes agree is
worked out again on the words themselves.

Defined results: a null or empty text has no words and fails the base rule; a null language is a
stratum of its own; labels that are null or of unknown documents count for nothing; repeated rows are
judged each by itself; keep() returns other columns, whatever their names, and report() drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.llm._base import Work

WINDOW = 8
#: Levels of the path, the loosest first.
LEVELS = (900, 700, 500, 300, 200, 100, 50, 30, 20, 10)
#: Cutoff of each rule at a level, in thousandths: refrains and lists repeat windows and lines in good texts, so those
#: two follow at a third of the pace.
RULES = {"symbols": 1, "repeats": 3, "adjacent": 1, "lines": 3}
LIMIT, DELTA = 0.01, 0.05
#: Strata above this number are joined by a shuffle, not broadcast.
BROADCAST_STRATA = 20_000

# One space character for all, so that the split is by a plain character; most texts have two kinds.
_RARE = "if(t rlike '[\\\\x09\\\\x0B-\\\\x0D]', translate(t, '\\u0009\\u000b\\u000c\\u000d', '    '), t)"
_WORDS = f"filter(split(replace({_RARE}, '\\u000a', ' '), ' ', -1), w -> w <> '')"
_LINES = r"filter(split(t, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')"


def _let(name: str, value: str, body: str) -> str:
    """Evaluate value once, whatever the optimizer inlines."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeated() -> str:
    """Words in windows found twice or more, of words w and their hashes h."""
    n = WINDOW
    keys = f"transform(sequence(0, size(w) - {n}), i -> xxhash64({', '.join(f'h[i + {j}]' for j in range(n))}))"
    sorted_windows = f"sort_array(transform(sequence(0, size(w) - {n}), i -> struct(array_join(slice(w, i + 1, {n}), ' ') as k, i as i)))"
    places = "sort_array(transform(filter(transform(s, (x, j) -> struct(x.i as i, coalesce(get(s, j - 1).k = x.k, false) or coalesce(get(s, j + 1).k = x.k, false) as hit)), x -> x.hit), x -> x.i))"
    covered = f"aggregate(transform(p, (x, j) -> least({n}, coalesce(get(p, j + 1) - x, {n}))), 0, (a, b) -> a + b)"
    exact = _let("s", sorted_windows, _let("p", places, covered))
    return f"if(size(w) < {n}, 0, {_let('k', keys, f'if(size(array_distinct(k)) = size(k), 0, {exact})')})"


def features(text: str = "text"):
    """Struct column of what is counted in a text."""
    inner = f"""struct(
        cast(size(w) as bigint) as n_words,
        cast(length(array_join(w, '')) as bigint) as word_chars,
        cast(regexp_count(t, '[#*$%&|<>]') as bigint) as n_symbols,
        cast(size(l) - size(array_distinct(l)) as bigint) as n_dup_lines,
        cast(size(l) as bigint) as n_lines,
        cast({_repeated()} as bigint) as n_repeat_words,
        cast(size(filter(h, (x, i) -> i > 0 and x = h[i - 1])) as bigint) as n_adjacent)"""
    inner = _let("w", _WORDS, _let("h", "transform(w, x -> xxhash64(x))", _let("l", _LINES, inner)))
    return F.expr(_let("t", f"coalesce({text}, '')", inner))


def _shares(f: str) -> dict:
    per = lambda a, b: F.expr(f"{f}.{a} * 1000 div greatest({f}.{b}, 1)")
    return {"symbols": per("n_symbols", "word_chars"), "repeats": per("n_repeat_words", "n_words"), "adjacent": per("n_adjacent", "n_words"), "lines": per("n_dup_lines", "n_lines")}


def _base_failed(f: str):
    return (F.col(f"{f}.n_words") < 20) | (100 * F.col(f"{f}.n_repeat_words") > 30 * F.col(f"{f}.n_words"))


def path() -> list[dict[str, int]]:
    """The cutoff of each rule at each step."""
    return [{rule: min(LEVELS[0], pace * level) for rule, pace in RULES.items()} for level in LEVELS]


def _first_step(f: str):
    """The first step at which a document is rejected; one more than there are where none rejects it."""
    shares, steps = _shares(f), path()
    at = F.lit(len(steps))
    for k in reversed(range(len(steps))):
        rejects = F.lit(False)
        for rule, cutoff in steps[k].items():
            rejects = rejects | (shares[rule] >= cutoff)
        at = F.when(rejects, F.lit(k)).otherwise(at)
    return at


def thresholds(counted: DataFrame, labels: DataFrame, limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """(stratum, step): the last certified step of the path; strata without one are absent. counted: doc_id,
    stratum and f of the documents."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("good")).where("good = 1").select("doc_id")
    seen = counted.select("doc_id", "stratum", "f").join(good, "doc_id")
    # A null array gives no rows; a filter would be pushed below the counting and count again.
    passed = F.when(~_base_failed("f"), F.array(_first_step("f")))
    rows = seen.select("doc_id", "stratum", F.explode(passed).alias("first")).groupBy("doc_id", "stratum").agg(F.min("first").alias("first"))
    # A row for each stratum and step before anything is compared.
    rows = rows.groupBy("stratum", "first").agg(F.count("*").alias("times"))
    counts = rows.groupBy("stratum").agg(F.sum("times").alias("n"), F.array(*[
        F.struct(F.lit(t).alias("step"), F.sum(F.when(F.col("first") <= t, F.col("times")).otherwise(0)).alias("k")) for t in range(len(LEVELS))
    ]).alias("tried"))
    counts = counts.crossJoin(counts.groupBy().agg(F.count("*").alias("strata")))  # one row
    tail = f"""if(c.k >= n * {limit}D, 1D, exp(aggregate(sequence(0, c.k), struct(cast(0 as double) as term, cast(0 as double) as total), (a, i) ->
        if(i = 0, struct(n * ln(1 - {limit}D) as term, n * ln(1 - {limit}D) as total),
        struct(a.term + ln((n - i + 1) * {limit}D / (i * (1 - {limit}D))) as term,
        greatest(a.total, a.term + ln((n - i + 1) * {limit}D / (i * (1 - {limit}D)))) + ln(1 + exp(-abs(a.total - a.term - ln((n - i + 1) * {limit}D / (i * (1 - {limit}D)))))) as total)), a -> a.total)))"""
    # Rejections grow along the path, so the steps that pass are its beginning.
    passed = F.expr(f"array_max(transform(filter(tried, c -> {tail} <= {delta}D / strata), c -> c.step))")
    return counts.select("stratum", passed.alias("step")).where("step is not null")


def _verdict(docs: DataFrame, steps: DataFrame) -> DataFrame:
    """docs (with stratum and f, the counts) with base_failed and kept, by the certified steps."""
    steps = steps.withColumnRenamed("stratum", "key")
    out = docs.join(F.broadcast(steps) if steps.count() <= BROADCAST_STRATA else steps, F.col("key") == F.col("stratum"), "left")
    rejected = F.coalesce(_first_step("f") <= F.col("step"), F.lit(False))
    # One case over both sides: a conjunct of its own would be pushed below the counting and count again.
    kept = F.when(_base_failed("f") | rejected, F.lit(False)).otherwise(F.lit(True))
    return out.withColumn("base_failed", _base_failed("f")).withColumn("kept", kept).drop("key", "step")


def _counted(docs: DataFrame, stratum: str, *more) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), features().alias("f"), *more)


def report(docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = LIMIT) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document. The counts are worked out once and
    written: the cutoffs and the verdicts both read them."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    with Work(docs.sparkSession, "quality") as work:
        counted = work.cut(_counted(docs, stratum), "counts")
        cuts = work.cut(thresholds(counted, labels, limit), "cuts")
        return work.keep(_verdict(counted, cuts).select("doc_id", *[f"f.{c}" for c in counts], "base_failed", "kept"))


def keep(docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = LIMIT) -> DataFrame:
    """The documents that pass, with their columns, which travel as one so that no name clashes. The
    cutoffs are worked out first, from counts without texts; the verdicts count each text again, which
    spares a second copy of all texts on disk."""
    with Work(docs.sparkSession, "quality") as work:
        cuts = work.keep(thresholds(work.cut(_counted(docs, stratum), "counts"), labels, limit))
    rows = _counted(docs, stratum, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return _verdict(rows, cuts).where("kept").select("row.*")
