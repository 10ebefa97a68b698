"""From documents to packed sequences: five stages, each on all that its predecessor kept.

Defined results: null and empty texts, and those of under 20 words, go with the quality rules; a null
language is a stratum of its own; texts without a letter go with the languages; rows that repeat a
doc_id stay or go together but for the quality rules, which judge each row; a row without a doc_id is a
near copy of nothing; very long texts are read whole; no documents give no sequences; extra columns,
whatever their names, stay up to the packing, which has columns of its own."""

from __future__ import annotations

from gablestone.llm import contamination, lang_id, near_dups, packing, quality_rules
from gablestone.llm._base import scratch, table
from gablestone.llm.queries import tokenizer_file

#: SQL expresses neither the language models nor the sketches; tests compare with brute force.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def language(spark, docs, sf_dir):
    """Documents whose language is not rejected."""
    return lang_id.keep(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return near_dups.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without benchmark passages."""
    return contamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark, docs, sf_dir):
    """The pieces of the documents and their places in sequences, in tokens."""
    return packing.pack(docs, tokenizer=tokenizer_file())


STAGES = [
    ("quality rules", quality), ("language ID", language), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("packing", pack),
]


def run(spark, sf_dir):
    """The last stage's rows; each stage's output is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(path := scratch(spark, f"stage-{k}"))
            docs = spark.read.parquet(path)
    return docs
