"""Corpus preparation: documents in, packed training sequences out.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread as the next
one's documents.  All but the last return the columns of ``documents``:

1. quality rules: rejected documents go; lines above the limits go from the others.
2. line dedup: common blocks go from the later of two documents.  A text that is
   a whole copy becomes empty; its row stays.
3. n-gram Jaccard join on shingles of 5 words at 0.8: one document of each component stays.
4. benchmark decontamination: documents that overlap an item go.
5. best-fit packing: one row per piece, with its sequence and place.

Cases: what the operators say of nulls, empty and repeated rows holds stage by
stage; extra columns pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers

from ferret.llm import decontaminate, jaccard_join, line_alignment, packing, quality_rules
from ferret.llm.common import stored
from ferret.sources.tables import table

# the alignment of lines and the packing of token ids have no SQL form
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    return quality_rules.apply_rules(docs)


def line_dedup(spark, docs, sf_dir):
    return line_alignment.delete_blocks(docs, every_run=True).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    return jaccard_join.keep_one_each(docs, size=5, percent=80)


def decontamination(spark, docs, sf_dir):
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def pack(spark, docs, sf_dir):
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), forget=True)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", pack),
]


def run(spark, sf_dir):
    """All stages over ``documents``; what lies between them is written to the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
