import random

from gablestone.llm import near_dups
from gablestone.llm._base import Work


class Counted(Work):
    """Counts the rows of what is written."""

    def cut(self, df, name):
        out = super().cut(df, name)
        self.rows = getattr(self, "rows", {}) | {name: out.count()}
        return out


def test_deviations_list_only_values_that_make_pairs(spark):
    n, own = 400, 1000
    # A crowd around one leader: each member lacks and adds values of its own, and 80 of them add the same
    # ten values, which come first; members 1 and 2 share nearly all and are linked with each other only.
    rows = []
    for x in range(1, 101):
        dev = ([*range(10)] if x <= 80 else []) + [*range(own * x, own * x + 110)]
        if x == 2:
            dev = [*range(10), *range(own, own + 100), *range(own * x, own * x + 10)]
        rows.append((0, x, n, n, dev, False))
    met = spark.createDataFrame(rows, "c long, x long, n_c long, n_x long, dev array<long>, linked boolean")
    with Counted(spark, "test") as work:
        found = near_dups._by_deviation(met, 80, work, "t").collect()
        assert {frozenset(r) for r in found} == {frozenset((1, 2))}
        # The prefixes were some 60 values of each member; only 1 and 2 share more than the ten.
        assert work.rows["t-entries"] < 200


def test_pairs_that_a_leader_has_decided_are_not_compared_again(spark):
    # Every member keeps some 0.6 of a text, too little to be linked with it, and half the similarity to it
    # and, by and large, to the others; the last two are copies of one member.
    r, base = random.Random(5), [f"w{i}" for i in range(400)]
    texts = [base] + [[f"x{k}y{i}" if r.random() < 0.12 else w for i, w in enumerate(base)] for k in range(80)]
    texts += [[*texts[1][:-2], f"z{k}"] for k in range(2)]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    with Counted(spark, "test") as work:
        found = {x.doc_id: x.component_id for x in near_dups._groups(docs, 2, 80, work).collect()}
        assert found == {k: k for k in range(81)} | {81: 1, 82: 1}
        # Some hundreds of pairs are half similar by their sketches; the members' common leader has decided them.
        assert work.rows.get("rest-pairs", 0) < 100
