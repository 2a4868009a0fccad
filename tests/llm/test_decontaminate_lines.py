import itertools
import random
from collections import Counter

import numpy as np
import pytest

from ferret.llm import decontaminate, line_alignment
from ferret.llm.line_alignment import common_blocks, patience

from llm.helpers import EDGE_TEXTS, documents, prose

SF = "/root/testdata/sf0.001"


# ---- operator 3 -----------------------------------------------------------

def brute_overlaps(docs, items):
    """(doc, item) pairs by trying every diagonal that any seed allows; one with fewer than 12 equal words can't be accepted,
    but for items of fewer words.
    """
    out = {}
    hashed = [(i, b := decontaminate.word_hashes(item or ""), {h: np.flatnonzero(b == h) for h in set(b.tolist())}) for i, item in items]
    for d, text in docs:
        a = decontaminate.word_hashes(text or "")
        for i, b, places in hashed:
            if 0 < len(b) < 12:  # a short item, as a whole
                at = [k for k in range(len(a) - len(b) + 1) if (a[k:k + len(b)] == b).all()]
                if at:
                    out[d, i] = (len(b), len(b), at[0])
                continue
            best = None
            equal = Counter(k - j for k, h in enumerate(a.tolist()) if h in places for j in places[h].tolist())
            for diagonal in sorted(g for g, n in equal.items() if n >= 12):
                first, skip = max(diagonal, 0), max(-diagonal, 0)
                n = min(len(a) - first, len(b) - skip)
                same = a[first:first + n] == b[skip:skip + n]
                hit = any(same[k:k + len(m)][[c == "1" for c in m]].all() for m in decontaminate.MASKS for k in range(n - len(m) + 1))
                if hit:
                    matched, span = decontaminate.best_overlap(a[first:first + n], b[skip:skip + n])
                    if matched >= 12 and matched >= 0.8 * span:
                        best = max(best or (0,), (matched, -first, span))
            if best:
                out[d, i] = (best[0], best[2], -best[1])
    return out


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(11)
    items = [prose(rng, n) for n in (14, 20, 30, 45, 8, 40)] + [None, ""]
    texts = list(EDGE_TEXTS)
    for k in range(40):
        words = items[k % 6].split()
        for _ in range(k // 8):  # substitutions
            words[rng.randrange(len(words))] = "zzz"
        a = rng.randrange(0, max(1, len(words) // 3))
        leak = " ".join(words[a:]).upper() if k % 2 else ", ".join(words[a:]) + "."
        texts.append(f"{prose(rng, rng.randrange(0, 30))} {leak} {prose(rng, rng.randrange(0, 30))}")
    docs = documents(spark, texts)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_matched"], r["n_span"], r["doc_pos"])
           for r in decontaminate.overlapping_documents(docs, bench).collect()}
    want = brute_overlaps(list(enumerate(texts)), list(enumerate(items)))
    assert got == want and len(want) > 15
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(len(texts))) - {d for d, _ in want})


def test_overlaps_edges(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    bench = spark.createDataFrame([(1, item), (1, item)], "item_id long, text string")
    docs = documents(spark, [item, item, "other", None], ids=[5, 5, None, None])
    rows = decontaminate.overlapping_documents(docs, bench).collect()
    assert [(r["doc_id"], r["item_id"], r["n_matched"]) for r in rows] == [(5, 1, 13)]
    assert decontaminate.drop_contaminated(docs, bench).count() == 2
    assert decontaminate.overlapping_documents(docs.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 4


def test_overlaps_of_the_given_documents(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    d, b = docs.select("doc_id", "text").collect(), bench.collect()
    words = {r["doc_id"]: " ".join(decontaminate.FIND(r["text"].lower())) for r in d}
    whole = {(k, r["item_id"]) for k, w in words.items() for r in b if " ".join(decontaminate.FIND(r["text"].lower())) in w}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlapping_documents(docs, bench).collect()}
    assert whole and whole <= got
    assert len(got - whole) <= 2


def test_best_overlap():
    a = np.array([1, 2, 3, 4, 5, 6, 7], np.uint64)
    b = np.array([9, 2, 3, 8, 5, 6, 9], np.uint64)
    assert decontaminate.best_overlap(a, b) == (4, 5)
    assert decontaminate.best_overlap(a, a + np.uint64(1)) == (0, 0)
    assert decontaminate.best_overlap(a[:0], b[:0]) == (0, 0)


def brute_best(same, ratio=0.8):
    """(equal words, length) over all stretches."""
    n, best = len(same), (0, 0)
    for i in range(n):
        for j in range(i + 1, n + 1):
            m = int(sum(same[i:j]))
            if 10 * m >= round(10 * ratio) * (j - i):
                best = max(best, (m, i - j))
    return best[0], -best[1]


def test_best_overlap_tries_all_stretches():
    rng = np.random.default_rng(4)
    for k in range(300):
        same = rng.random(rng.integers(0, 40)) < (0.5, 0.7, 0.8, 0.9)[k % 4]
        a = np.arange(len(same), dtype=np.uint64)
        got = decontaminate.best_overlap(a, np.where(same, a, a + np.uint64(1000)))
        want = brute_best(same)
        assert got[0] == want[0] and 10 * got[0] >= 8 * got[1] and (got[0] == 0 or got[1] >= want[1])


def test_long_runs_around_a_replaced_passage(spark):
    rng = random.Random(12)
    items = [prose(rng, n, 10 ** 6) for n in (52, 59, 160)]
    texts = []
    for item, (head, other) in zip(items, ((20, 12), (24, 13), (60, 40))):
        words = item.split()
        words[head:head + other] = [f"x{k}" for k in range(other)]
        texts.append(" ".join(["before"] * 5 + words + ["after"] * 5))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_matched"] for r in decontaminate.overlapping_documents(documents(spark, texts), bench).collect()}
    assert got == {(0, 0): 20, (1, 1): 24, (2, 2): 60}
    assert decontaminate.drop_contaminated(documents(spark, texts), bench).count() == 0


def test_every_accepted_stretch_has_a_seed():
    def seeded(same):
        return any(all(same[k + i] for i, c in enumerate(m) if c == "1") for m in decontaminate.MASKS for k in range(len(same) - len(m) + 1))

    # the shortest stretch with 12 or more equal words and ratio 0.8 for each number of mismatches; longer ones hold one of these
    for n, other in ((12, 0), (13, 1), (14, 2), (15, 3), (20, 4), (25, 5)):
        for gone in itertools.combinations(range(n), other):
            assert seeded([k not in gone for k in range(n)]), (n, gone)
    rng = np.random.default_rng(8)
    tried = 0
    for _ in range(3000):
        same = rng.random(rng.integers(12, 45)) < 0.75
        if brute_best(same)[0] >= 12:
            tried += 1
            assert seeded(same)
    assert tried > 200


def test_short_items_match_as_a_whole(spark):
    rng = random.Random(13)
    items = [prose(rng, n, 10 ** 6) for n in (1, 2, 5, 8, 11, 12)] + ["", None]
    texts = [f"{prose(rng, 9, 10 ** 6)} {x} {prose(rng, 9, 10 ** 6)}" for x in items[:6]]
    texts += [" ".join(x.split()[:-1] + ["other"]) for x in items[:5]] + [items[3].upper(), " ".join(items[3].split()[1:])]
    docs, bench = documents(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(d, i): len(x.split()) for d, t in enumerate(texts) for i, x in enumerate(items) if x
            and f" {' '.join(x.lower().split())} " in f" {' '.join(t.lower().split())} "}
    got = {(r["doc_id"], r["item_id"]): r["n_matched"] for r in decontaminate.overlapping_documents(docs, bench, short_items=True).collect()}
    assert got == want and len(got) == 7
    kept = decontaminate.drop_contaminated(docs, bench, short_items=True)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(len(texts))) - {d for d, _ in want})


# ---- operator 6 -----------------------------------------------------------

def test_patience_aligns_in_order():
    assert patience(list("abcde"), list("xbcyde")) == [(1, 1), (2, 2), (3, 4), (4, 5)]
    assert patience(list("aab"), list("baa")) in ([(2, 0)], [(0, 1), (1, 2)])
    assert patience([None, "a", None], [None, "a"]) == [(1, 1)]
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(12))] for _ in range(2))
        p = patience(a, b)
        assert all(a[i] == b[j] for i, j in p)
        assert all(i < i2 and j < j2 for (i, j), (i2, j2) in zip(p, p[1:]))


def test_common_blocks_need_words_in_a_run():
    a, b = ["p", "q", None, "r", "s"], ["q", "r", "x", "s"]
    assert common_blocks(a, b, [4, 4, 9, 4], 8) == [0, 1]
    assert common_blocks(a, b, [4, 3, 9, 4], 8) == []


def brute_lines(texts, ids, least_words=10, link_words=3, share=0.05, least=20):
    norm = lambda x: " ".join(x.split(" ")) if False else " ".join(__import__("re").split(r"[\x20\x09-\x0D]+", x.lower())).strip()
    has = lambda x: any(c not in "\x20\t\n\x0b\x0c\r" for c in x)
    lines = {}
    for d, t in zip(ids, texts):
        ls = [norm(x) if has(x) else None for x in (t or "").split("\n")]
        lines[d] = (ls, [len(x.split(" ")) if x else 0 for x in ls])
    first = {}
    for d, t in sorted(zip(ids, texts)):
        first.setdefault(t or "", d)
    distinct = sorted(first.values())
    holders = {}
    for d in distinct:
        for x, n in set(zip(*lines[d])):
            if x is not None and n >= link_words:
                holders.setdefault(x, []).append(d)
    gone, pairs = {d: set() for d in ids}, set()
    for hs in holders.values():
        if 1 < len(hs) <= max(least, share * len(distinct)):
            pairs |= {(d, hs[0]) for d in hs[1:]}
    for d, own in pairs:
        gone[d] |= set(common_blocks(lines[own][0], lines[d][0], lines[d][1], least_words))
    for d, t in zip(ids, texts):
        if first[t or ""] != d and sum(lines[d][1]) >= least_words:
            gone[d] = {k for k, x in enumerate(lines[d][0]) if x is not None}
    out = {}
    for d, t in zip(ids, texts):
        left = [x for k, x in enumerate((t or "").split("\n")) if k not in gone[d]]
        out[d] = t if not gone[d] else "\n".join(left) if any(map(has, left)) else ""
    return out


def test_line_alignment_equals_brute_force(spark):
    rng = random.Random(21)
    base = [prose(rng, rng.randrange(20, 90)) for _ in range(6)]
    texts = [*EDGE_TEXTS, *base, base[0], base[0], None]
    for _ in range(30):
        ls = rng.choice(base).split("\n") + rng.choice(base).split("\n")[:rng.randrange(4)]
        rng.random() < 0.3 and ls.insert(rng.randrange(len(ls)), "  ")
        rng.random() < 0.6 and ls.__setitem__(rng.randrange(len(ls)), prose(rng, 6))
        texts.append("\n".join(x.upper() if rng.random() < 0.2 else x for x in ls[rng.randrange(3):]))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    out = line_alignment.delete_blocks(documents(spark, texts, ids=ids), every_run=False)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    want = brute_lines(texts, ids)
    assert got == want
    assert sum(a != b for a, b in ((want[d], t) for d, t in zip(ids, texts))) > 10
    for r in out.collect():
        assert r["n_chars"] is None or r["n_chars"] == len(r["text"])


def test_line_alignment_edges(spark):
    text = "\n".join(f"line number {k} of this text" for k in range(5))
    docs = documents(spark, [text, text, text, text + "\nmore of it here", None], ids=[7, 7, None, 9, None])
    got = sorted(((r["doc_id"] is None, r["doc_id"]), r["text"]) for r in line_alignment.delete_blocks(docs).collect()
                 if r["text"] is not None)
    # repeated rows of one id and rows without an id stay
    assert [x[1] for x in got] == [text, text, "more of it here", text]
    assert line_alignment.delete_blocks(docs.limit(0)).count() == 0
    assert line_alignment.delete_blocks(docs).columns == [*docs.columns, "line_report"]


def runs_left(texts, ids, gone, least_words=10):
    """Documents with a whole run left that an earlier text holds, and those that lost a line which is in none."""
    listed = {d: t.split("\n") for d, t in zip(ids, texts)}
    missed, wrong = set(), set()
    for d, mine in listed.items():
        earlier = [x for e, x in listed.items() if e < d]
        common = set()
        for i in range(len(mine)):
            for j in range(i + 1, len(mine) + 1):
                if sum(len(x.split()) for x in mine[i:j]) >= least_words and any(mine[i:j] == x[q:q + j - i] for x in earlier for q in range(len(x))):
                    common |= set(range(i, j))
                    if not gone[d] & set(range(i, j)):
                        missed.add(d)
        if gone[d] - common:
            wrong.add(d)
    return missed, wrong


def common_runs(a, b, words, least):
    """Lines of ``b`` in any run of lines with words, of enough words, that stands in ``a`` as well."""
    xs, at = [x for x in a if x is not None], [j for j, x in enumerate(b) if x is not None]
    out = set()
    for i in range(len(at)):
        for j in range(i + 1, len(at) + 1):
            run = [b[k] for k in at[i:j]]
            if sum(words[k] for k in at[i:j]) >= least and any(run == xs[q:q + j - i] for q in range(len(xs))):
                out.update(at[i:j])
    return sorted(out)


def random_line_pairs(rng, n):
    for _ in range(n):
        names = "abcdefghijklmnop"[:rng.choice([3, 6, 16])]
        size = {x: rng.randrange(1, 12) for x in names}
        a, b = ([rng.choice([*names, None]) for _ in range(rng.randrange(16))] for _ in range(2))
        if rng.random() < 0.5 and a:  # moved and doubled pieces
            k = rng.randrange(len(a))
            b = [*a[k:], *b[:3], *a[:k], *a[k:][:rng.randrange(6)]]
        yield a, b, [size.get(x, 0) for x in b]


@pytest.mark.parametrize("rounds", [1, 2, line_alignment.ROUNDS])
def test_alignment_finds_every_common_run(monkeypatch, rounds):
    monkeypatch.setattr(line_alignment, "ROUNDS", rounds)
    for a, b, words in random_line_pairs(random.Random(31), 3000):
        assert common_blocks(a, b, words, 10) == common_runs(a, b, words, 10)


def test_without_the_alignment_blocks_stay(monkeypatch):
    cases = list(random_line_pairs(random.Random(32), 1000))
    whole = [common_blocks(*c, 10) for c in cases]
    monkeypatch.setattr(line_alignment, "patience", lambda a, b: [])
    less = [common_blocks(*c, 10) for c in cases]
    assert all(set(x) <= set(y) for x, y in zip(less, whole)) and sum(x != y for x, y in zip(less, whole)) > 200


def test_report_beside_an_input_column_of_its_name(spark):
    docs = documents(spark, ["one two three four five six seven eight nine ten", "x"]).selectExpr("*", "'mine' AS line_report")
    out = line_alignment.delete_blocks(docs)
    assert out.columns == [*docs.columns, "line_report_2"]
    assert {r["line_report"] for r in out.collect()} == {"mine"}


def delete_every_run(spark, texts, ids):
    return {r["doc_id"]: r["text"] for r in line_alignment.delete_blocks(documents(spark, texts, ids=ids), every_run=True).collect()}


def test_frequent_lines_still_link(spark):
    rng = random.Random(22)
    group = prose(rng, 60, 10 ** 6)
    # a third of the texts are near copies, and all their lines are in more than 20 texts
    texts = [f"{prose(rng, 30, 10 ** 6)}\n{group}\n{prose(rng, 5, 10 ** 6)}" for _ in range(30)] + [prose(rng, 30, 10 ** 6) for _ in range(60)]
    ids = list(range(len(texts)))
    got = delete_every_run(spark, texts, ids)
    assert got[0] == texts[0] and all(got[d] == texts[d] for d in range(30, 90))
    assert all(got[d] == texts[d].replace(f"\n{group}\n", "\n") for d in range(1, 30))


def test_no_repeated_run_is_left(spark):
    rng = random.Random(23)
    lines = [prose(rng, n, 10 ** 6).replace("\n", " ").strip() for n in (9, 9, 4, 4, 1, 1, 2, 12, 3, 6)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9))) for _ in range(50)]
    ids = rng.sample(range(1000), len(texts))
    rows = line_alignment.removed_lines(documents(spark, texts, ids=ids), every_run=True).collect()
    gone = dict.fromkeys(ids, set()) | {r["doc_id"]: set(r["gone"]) for r in rows}
    assert runs_left(texts, ids, gone) == (set(), set())
    assert sum(map(bool, gone.values())) > 10


def test_repeats_without_a_unique_line():
    block = ["p", "q", "r"]
    # held twice by the later text, moved, and without an anchor
    assert common_blocks(block, [*block, "x", *block], [4] * 7, 10) == [0, 1, 2, 4, 5, 6]
    assert common_blocks([*block, "x", "s", "t", "u"], ["s", "t", "u", "y", *block], [4] * 7, 10) == [0, 1, 2, 4, 5, 6]
    assert common_blocks(["z", "p", "p", "q", "q", "z"], ["q", "p", "p", "q", "q", "p"], [4] * 6, 10) == [1, 2, 3, 4]
    # the short last line of a run goes with it
    assert common_blocks(["m", "n", "a", "m"], ["k", "m", "n", "l", "m", "n"], [9, 11, 1, 9, 11, 1], 10) == [1, 2, 4, 5]
