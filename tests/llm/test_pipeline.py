import os
import subprocess
import sys

import public_tokenizers

import corpus_pipeline
from ferret.llm import decontaminate, jaccard_join, line_alignment, quality_rules
from ferret.llm.common import stored

from llm.helpers import documents
from llm.test_decontaminate_lines import brute_lines, brute_overlaps
from llm.test_encoder_packing import WORD, check_packed
from llm.test_native_and_join import brute_components, brute_quality

SF = "/root/testdata/sf0.001"


def test_each_stage_equals_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    state = {r["doc_id"]: r["text"] for r in docs.collect()}
    hosts = {r["doc_id"]: r["source"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        ids = list(state)
        if name == "quality_rules":
            want = {d: w[7] for d, w in zip(ids, brute_quality([state[d] for d in ids], [hosts[d] for d in ids], ids)) if w[6]}
        elif name == "line_dedup":
            want = brute_lines([state[d] for d in ids], ids)
        elif name == "ngram_jaccard_join":
            parts = brute_components(ids, [state[d] for d in ids], size=5, percent=80)
            want = {d: t for d, t in state.items() if parts[d][1] == d}
        else:
            bad = {d for d, _ in brute_overlaps(list(state.items()), bench)}
            want = {d: t for d, t in state.items() if d not in bad}
        assert docs.columns == columns
        state = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert state == want, name
    plain = Tokenizer.from_file(WORD)
    ids = {d: plain.encode(t, add_special_tokens=False).ids + [1] for d, t in state.items()}
    packed = corpus_pipeline.run(spark, SF).collect()
    check_packed(packed, ids, 4096)
    assert 0 < len(state) < len(hosts)


def test_stages_keep_extra_columns_and_survive_edges(spark):
    docs = documents(spark, [None, "", "word " * 30, "a b c"], ids=[None, 1, 1, 2], sources=[None, "s", "s", "s"])
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SF).columns == docs.columns, name
            stage(spark, frame, SF).collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()


def test_near_duplicates_take_five_words_at_four_fifths(spark):
    words = [f"w{k}" for k in range(100)]
    near = words.copy()
    near[30] = near[70] = "other"  # 86 of 106 shingles of 5 words are shared; of 4 words 89 of 105, less than 0.85
    texts = [" ".join(words), " ".join(near), " ".join(f"x{k}" for k in range(50))]
    assert brute_components([0, 1, 2], texts)[1][1] == 1
    parts = brute_components([0, 1, 2], texts, size=5, percent=80)
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, documents(spark, texts), SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d in parts if parts[d][1] == d) == [0, 2]


def test_a_task_returns_its_memory_to_the_system():
    # blocks below one that lives on: the allocator keeps them unless it is told to return them
    code = """
from pathlib import Path
from ferret.llm.words import forgetting

def resident():
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 >> 20

lives_on = []

def task(batches):
    blocks = [b"x" * 100_000 for _ in range(2000)]
    lives_on.append(b"x" * 100_000)
    yield from batches

before = resident()
assert list(forgetting(task)([1])) == [1]
print(resident() - before)
"""
    root = os.path.dirname(corpus_pipeline.__file__)
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert int(out) < 50  # MB, of some 200
