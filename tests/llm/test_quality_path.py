"""The certified path of cutoffs by brute force."""

import math

from gablestone.llm import quality_rules


def steps_by_force(good, limit, delta):
    """{stratum: last certified step} from {stratum: [shares of a good document by rule, ...]}."""
    out = {}
    for stratum, docs in good.items():
        for k, cutoffs in enumerate(quality_rules.path()):
            lost = sum(any(d[r] >= c for r, c in cutoffs.items()) for d in docs)
            n = len(docs)
            tail = sum(math.comb(n, i) * limit**i * (1 - limit) ** (n - i) for i in range(lost + 1))
            if tail > delta / len(good):
                break
            out[stratum] = k
    return out


def test_the_path_only_tightens():
    steps = quality_rules.path()
    assert all(a[r] >= b[r] for a, b in zip(steps, steps[1:]) for r in a) and set(steps[0]) == set(quality_rules.RULES)


def test_steps_are_those_of_the_exact_test(spark):
    text = lambda i, extra: " ".join(f"w{i}x{k}" for k in range(40)) + extra
    rows, good = [], {"a": [], "b": [], "": []}
    for i in range(700):  # a share of symbols that grows along the rows, in two strata of other sizes
        stratum = ("a", "b", None)[0 if i < 400 else 1 if i < 640 else 2]
        symbols = (i % 100 > 96) * (i % 7) * 12 + (i % 50 == 0) * 3
        rows.append((i, text(i, " " + "%" * symbols), stratum))
        chars = sum(len(f"w{i}x{k}") for k in range(40)) + symbols
        good[stratum or ""].append({"symbols": symbols * 1000 // chars, "repeats": 0, "adjacent": 0, "lines": 0})
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(700)], "doc_id long, quality int")
    for limit in (0.01, 0.02, 0.05, 0.1):
        got = {r.stratum: r.step for r in quality_rules.thresholds(quality_rules._counted(docs, "lang"), labels, limit).collect()}
        assert got == steps_by_force(good, limit, quality_rules.DELTA), limit


def test_the_method_rejects_in_two_strata(spark):
    """At a limit that the small tables certify, documents go that the base rule keeps."""
    from gablestone.llm.queries import quality_rules_loose

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    gone = quality_rules_loose(spark, "/root/testdata/sf0.01").where("not kept and not base_failed").join(docs, "doc_id")
    assert gone.select("lang").distinct().count() >= 2


def test_no_documents_or_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.report(none, labels).count() == 0 and quality_rules.keep(none, labels).columns == none.columns
    one = spark.createDataFrame([(1, "a b " * 3 + " ".join(map(str, range(30))), None, 3)], none.schema)
    assert quality_rules.report(one, labels).first().kept
