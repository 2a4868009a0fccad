import hashlib
import random
import re
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from ferret.llm import jaccard_join, pii, quality_rules, queries
from ferret.llm.graph import connected_components

from llm.helpers import EDGE_TEXTS, documents, prose

SF = "/root/testdata/sf0.001"


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    r = con.execute(queries.ORACLE[name])
    assert [c[0] for c in r.description] == df.columns
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(r.fetchall(), key=repr)


# ---- operator 5 -----------------------------------------------------------

def feistel(values, radices, tag, key):
    v = list(values)
    half = len(v) // 2
    for k in range(1, pii.ROUNDS + 1):
        left = k % 2 == 1
        other = ",".join(map(str, v[half:] if left else v[:half]))
        v = [(x + int(hashlib.sha256(f"{key}|{tag}|{k}|{i}|{other}".encode()).hexdigest()[:15], 16)) % radices[i]
             if (i < half) == left else x for i, x in enumerate(v)]
    return v


def luhn(digits):
    return sum(d if k % 2 == 0 else 2 * d - 9 * (2 * d > 9) for k, d in enumerate(map(int, reversed(digits)))) % 10


def test_feistel_equals_plain_python_and_permutes(spark):
    rows = [(a, b) for a in range(7) for b in range(5)]
    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", pii.feistel(F.array("a", "b"), F.array(F.lit(7), F.lit(5)), "t", "k").alias("v"))
    got = {(r["a"], r["b"]): tuple(r["v"]) for r in df.collect()}
    assert got == {p: tuple(feistel(p, (7, 5), "t", "k")) for p in rows}
    assert len(set(got.values())) == 35


def run(spark, texts, key="k"):
    out = pii.pseudonymise(documents(spark, texts), key=key)
    no_python(out)
    return [(r["text"], r["pii_counts"]) for r in out.orderBy("doc_id").collect()]


def test_pseudonyms_keep_format_and_validity(spark):
    card = "4337166598464399"
    texts = [f"pay {card} now", f"{card[:4]}-{card[4:8]}-{card[8:12]}-{card[12:]}", "4337166598464398", "on 2024-02-29 and 2023-02-29",
             "29.02.2000, 12/31/1999 or 1/2/1999", "ssn 123-45-6789 666-12-1234", "ip 10.0.255.1 not 10.0.256.1",
             "+1 (136) 555-7479 and (212) 555-0100", "mail aB.9-x@mail8.example.com!", "1234 56"]
    (a, b, c, d, e, f, g, h, i, j) = (t for t, _ in run(spark, texts))
    new = a.split()[1]
    assert new != card and len(new) == 16 and new[0] == "4" and luhn(new) == 0
    assert b.replace("-", "") == new and [len(x) for x in b.split("-")] == [4] * 4
    assert c == texts[2] and j == texts[9]
    day, kept = d.split()[1], d.split()[3]
    assert kept == "2023-02-29" and day != "2024-02-29" and date.fromisoformat(day).year // 100 == 20
    dotted, slashed, short = e.replace(",", "").replace(" or", "").split()
    assert len(dotted) == 10 and dotted[6:8] == "20" and slashed[6:8] == "19" and short.split("/")[2][:2] == "19"
    s = f.split()
    assert s[2] == "666-12-1234" and s[1] != "123-45-6789" and s[1][:3] not in ("000", "666") and s[1][:3] < "900"
    assert g.endswith("10.0.256.1") and all(0 <= int(x) <= 255 for x in g.split()[1].split("."))
    assert h.startswith("+1 (") and "555-7479" not in h and "555-0100" not in h
    local = i.split("@")[0].split()[1]
    assert i.endswith("@mail8.example.com!") and [c.isdigit() for c in local] == [c.isdigit() for c in "aB.9-x"]
    assert local[1].isupper() and local[2] == "." and local != "aB.9-x"


def test_equal_values_stay_linked_and_keys_matter(spark):
    texts = ["a 10.1.2.3", "b 10.1.2.3 c 10.1.2.4"]
    (a, _), (b, counts) = run(spark, texts)
    assert a.split()[1] == b.split()[1] != b.split()[3] and counts["ipv4"] == 2
    assert run(spark, texts, key="other")[0][0] != a


def test_dates_of_a_century_are_permuted(spark):
    days = [date(1900, 1, 1) + timedelta(k) for k in range(0, 36524, 97)] + [date(2000, 1, 1) + timedelta(k) for k in range(0, 36525, 97)]
    out = run(spark, [" ".join(d.isoformat() for d in days)])[0][0].split()
    assert len(set(out)) == len(days)
    for d, x in zip(days, out):
        century = d.year // 100
        n, radices = ((d - date(century * 100, 1, 1)).days, (75, 487) if century == 20 else (92, 397))
        v = feistel((n // radices[1], n % radices[1]), radices, "date", "k")
        assert x == (date(century * 100, 1, 1) + timedelta(v[0] * radices[1] + v[1])).isoformat()


def plain_scramble(text, tag, key):
    base = [48 if c in "0123456789" else 97 if "a" <= c <= "z" else 65 if "A" <= c <= "Z" else None for c in text]
    radices = [10 if b == 48 else 26 if b else 1 for b in base]
    moved = feistel([ord(c) - b if b else 0 for c, b in zip(text, base)], radices, tag, key)
    return "".join(chr(b + v) if b else c for c, b, v in zip(text, base, moved))


def plain_luhn(digits, doubled):
    return sum(d if k % 2 != doubled else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits))))


def plain_date(h, key):
    parts = re.split("[-/.]", h)
    at = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0) if "." in h else (2, 0, 1)
    try:
        day = date(*(int(parts[k]) for k in at))
    except ValueError:
        return None
    if not 1800 <= day.year <= 2199:
        return None
    start, radices = date(day.year // 100 * 100, 1, 1), (75, 487) if day.year // 100 % 4 == 0 else (92, 397)
    past = (day - start).days
    v = feistel((past // radices[1], past % radices[1]), radices, "date", key)
    new = start + timedelta(v[0] * radices[1] + v[1])
    width = "02d" if len(h) == 10 else "d"
    out = [""] * 3
    for k, x in zip(at, (f"{new.year:04d}", format(new.month, width), format(new.day, width))):
        out[k] = x
    return re.search("[-/.]", h)[0].join(out)


def plain_pseudonym(h, key):
    """(kind, pseudonym) of a matched string, (None, itself) if it isn't valid."""
    digits = re.sub("[^0-9]", "", h)
    into = lambda new: "".join(c if c not in "0123456789" else next(new) for c in h)
    full = lambda kind: re.fullmatch(pii.SHAPES[kind], h)
    if "@" in h:
        at = h.index("@")
        return "email", plain_scramble(h[:at], "email", key) + h[at:]
    if full("date"):
        new = plain_date(h, key)
        return ("date", new) if new else (None, h)
    if full("ssn"):
        a, g, n = map(int, h.split("-"))
        if a in (0, 666) or a >= 900 or not g or not n:
            return None, h
        v = feistel((a - 1 - (a > 666), g - 1, n - 1), (898, 99, 9999), "ssn", key)
        return "ssn", f"{v[0] + 1 + (v[0] >= 665):03d}-{v[1] + 1:02d}-{v[2] + 1:04d}"
    if full("ipv4"):
        octets = h.split(".")
        if any(int(o) > 255 for o in octets):
            return None, h
        span = [(0, 10 ** (len(o) - 1)) if len(o) > 1 and o[0] == "0" else {1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(o)] for o in octets]
        v = feistel([int(o) - low for o, (low, _) in zip(octets, span)], [n for _, n in span], "ipv4", key)
        return "ipv4", ".".join(str(x + low).zfill(len(o)) for x, (low, _), o in zip(v, span, octets))
    if full("phone"):
        return "phone", into(iter(digits[:-10] + plain_scramble(digits[-10:], "phone", key)))
    if plain_luhn(digits, 1) % 10:
        return None, h
    body = digits[0] + plain_scramble(digits[1:-1], "card", key)
    return "card", into(iter(body + str(-plain_luhn(body, 0) % 10)))


def test_query_equals_a_plain_version_on_whole_texts(spark):
    spark.conf.set(queries.PII_KEY, "a key of this test")
    try:
        got = {r["doc_id"]: r.asDict() for r in queries.QUERIES["op5_feistel_pseudonyms"](spark, SF).collect()}
    finally:
        spark.conf.unset(queries.PII_KEY)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    hits = 0
    for doc, text in docs:
        counts = dict.fromkeys(pii.KINDS, 0)

        def swap(m):
            kind, new = plain_pseudonym(m[0], "a key of this test")
            if kind:
                counts[kind] += 1
            return new

        new = None if text is None else re.sub(pii.VALUE, swap, text)
        hits += sum(counts.values())
        assert got[doc] == {"doc_id": doc, "text": new} | {f"n_{k}": n for k, n in counts.items()}
    assert len(got) == len(docs) and hits > 20


def test_addresses_keep_their_lengths(spark):
    texts = [f"{a}.{b}.{c}.7" for a in ("1", "10", "255", "010", "001", "00") for b in ("0", "99", "100") for c in ("8", "42")]
    out = [t for t, _ in run(spark, texts)]
    assert len(set(out)) == len(texts) and out == [plain_pseudonym(t, "k")[1] for t in texts]
    assert all([len(x) for x in a.split(".")] == [len(x) for x in b.split(".")] for a, b in zip(texts, out))
    assert all(0 <= int(x) <= 255 for t in out for x in t.split("."))


def test_a_session_without_a_key_draws_one(spark):
    spark.conf.unset(queries.PII_KEY)
    first = queries.QUERIES["op5_feistel_pseudonyms"](spark, SF)
    key = spark.conf.get(queries.PII_KEY)
    assert len(key) == 64
    queries.QUERIES["op5_feistel_pseudonyms"](spark, SF)
    assert spark.conf.get(queries.PII_KEY) == key and first.columns[:2] == ["doc_id", "text"]
    spark.conf.unset(queries.PII_KEY)


def test_counts_beside_an_input_column_of_their_name(spark):
    docs = documents(spark, ["10.1.2.3"]).selectExpr("*", "1 AS PII_counts")
    out = pii.pseudonymise(docs, key="k")
    assert out.columns == [*docs.columns, "pii_counts_2"] and out.first()["PII_counts"] == 1


def test_pseudonym_edges(spark):
    out = run(spark, [*EDGE_TEXTS, "x" * 50_000 + " 10.1.2.3 " + "@" * 1000])
    assert [t for t, _ in out[:-1]] == EDGE_TEXTS and out[-1][1]["ipv4"] == 1
    docs = documents(spark, ["10.1.2.3", "10.1.2.3"], ids=[None, None])
    done = pii.pseudonymise(docs, key="k")
    assert done.columns == [*docs.columns, "pii_counts"] and done.select("text").distinct().count() == 1
    assert pii.pseudonymise(docs.limit(0), key="k").count() == 0


# ---- operator 10 ----------------------------------------------------------

def brute_quality(texts, hosts, ids=None, share=0.05, least_docs=20, most_docs=10_000):
    import re
    word, norm = re.compile(r"[^\x20\x09-\x0D]+"), lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x.lower()).strip(" ")
    rows, held, per_host = [], {}, {}
    for d, t, h in sorted(zip(ids or range(len(texts)), texts, hosts), key=lambda r: r[0]):
        t = t or ""
        per_host.setdefault(h, set()).add(t)
        for x in t.split("\n"):
            if word.search(x):
                held.setdefault((h, norm(x)), dict()).setdefault(t)
    often = {k: next(iter(v)) for k, v in held.items()
             if len(v) >= least_docs and (len(v) > share * len(per_host[k[0]]) or len(v) > most_docs)}
    for t, h in zip(texts, hosts):
        t = t or ""
        w, ls = word.findall(t), [x for x in t.split("\n") if word.search(x)]
        windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        cover = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(8)}
        gone = lambda x: often.get((h, norm(x)), t) != t  # noqa: B023,E731
        lost = sum(len(norm(x).split(" ")) for x in ls if gone(x))
        failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        left = len(w) - lost
        text = "\n".join(x for x in t.split("\n") if not gone(x))
        rows.append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), len(cover), failed,
                     not failed and left >= 20 and left >= 0.3 * len(w), text))
    return rows


def test_quality_rules_equal_brute_force(spark):
    rng = random.Random(31)
    footer = "All  Rights reserved by this HOST of pages"
    texts, hosts = list(EDGE_TEXTS), ["h"] * len(EDGE_TEXTS)
    for k in range(60):
        body = prose(rng, rng.randrange(10, 80), 2000)
        loop = " ".join(["again and again we say the same old thing"] * rng.randrange(4)) if k % 5 == 0 else ""
        texts.append(f"{body} {loop} #%é\n{footer if k % 3 else footer.lower()}" + ("\n" + footer) * (20 if k % 11 == 0 else 0))
        hosts.append("h" if k % 4 else "other" if k % 8 else None)
    texts += [texts[-1]] * 40  # copies of one text count once
    hosts += ["copies"] * 40
    out = quality_rules.judge(documents(spark, texts, sources=hosts))
    no_python(out)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = brute_quality(texts, hosts)
    got = {r["doc_id"]: tuple(r[c] for c in cols) for r in out.collect()}
    assert [got[k] for k in range(len(texts))] == [w[:-1] for w in want]
    assert any(w[5] for w in want) and any(not w[5] and not w[6] for w in want)
    docs = documents(spark, texts, sources=hosts)
    applied = quality_rules.apply_rules(docs)
    assert applied.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in applied.collect()} == {k: w[7] for k, w in enumerate(want) if w[6]}
    assert all(r["n_chars"] == len(r["text"]) for r in applied.collect())


def test_frequent_lines_of_the_given_tables_go(spark):
    """The method decides on given rows: without it these documents would all stay as they are."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    often = quality_rules.frequent_lines(docs)
    assert often.count() > 0
    applied = quality_rules.apply_rules(docs).select("doc_id", "text")
    off = quality_rules.apply_rules(docs, least_docs=1 << 40).select("doc_id", "text")
    assert applied.exceptAll(off).count() > 100


def test_first_holders_and_huge_hosts(spark):
    rng = random.Random(4)
    shared = [" ".join(f"s{k}w{j}" for j in range(9)) for k in range(6)]
    texts = ["\n".join(shared) + f"\n{prose(rng, 5, 9000)}" for _ in range(30)]  # near copies: all but the first are depleted
    texts += [prose(rng, 40, 9000) for _ in range(300)]
    for share, most, want in ((0.05, 10_000, 1), (0.5, 10_000, 30), (0.5, 25, 1)):
        kept = {r["doc_id"]: r["text"] for r in quality_rules.apply_rules(documents(spark, texts), line_share=share, most_docs=most).collect()}
        assert sum(d < 30 for d in kept) == want and sum(d >= 30 for d in kept) == 300
        assert kept[0] == texts[0]


def test_quality_edges(spark):
    text = prose(random.Random(1), 30, 5000)
    docs = documents(spark, [text, text, None, ""], ids=[1, 1, None, None], sources=[None] * 4)
    assert sorted((r["kept"], r["n_words"]) for r in quality_rules.judge(docs).collect()) == [(False, 0), (False, 0), (True, 30), (True, 30)]
    assert quality_rules.judge(docs.limit(0)).count() == 0
    long_text = documents(spark, ["w " * 30_000 + prose(random.Random(2), 1000, 10 ** 6)])
    assert quality_rules.judge(long_text).first()["n_repeat_words"] == 30_000


# ---- operator 9 -----------------------------------------------------------

def brute_components(ids, texts, size=4, percent=85):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        n = min(size, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set())
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= percent * (len(a) + len(sets[j]) - o):
                x, y = sorted((find(ids[i]), find(ids[j])))
                root[y] = x
    return {d: (len(s), find(d)) for d, s in zip(ids, sets)}


def near_texts(rng, n):
    base = [prose(rng, rng.randrange(6, 130), 3000) for _ in range(8)]
    texts = [*EDGE_TEXTS, "one two three", "ONE two  three", *base, base[0], base[1].upper()]
    shared = prose(rng, 40, 3000)
    for _ in range(n):  # chains of edits: similar to their neighbours only
        w = texts[rng.randrange(len(EDGE_TEXTS), len(texts))].split(" ")
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
        texts.append(" ".join(w))
        if rng.random() < 0.3:
            texts.append(shared + " " + prose(rng, rng.randrange(10, 60), 3000))
    return texts


@pytest.mark.parametrize("block,often", [(3, 10 ** 6), (2048, 2)])
def test_components_equal_brute_force(spark, block, often):
    rng = random.Random(41)
    texts = near_texts(rng, 120)
    ids = rng.sample(range(1000), len(texts))
    docs = documents(spark, texts, ids=ids)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(docs, block=block, often=often).collect()}
    want = brute_components(ids, texts)
    assert got == want
    assert len({c for _, c in want.values()}) < len(texts) - 40
    kept = jaccard_join.keep_one_each(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})
    assert kept.columns == docs.columns


def kept_tables(monkeypatch):
    """The scratch tables of the join by name, as they are written."""
    tables, plain = {}, jaccard_join.stored

    def keep(df, name):
        out = plain(df, name)
        tables.setdefault(name, out)
        return out

    monkeypatch.setattr(jaccard_join, "stored", keep)
    return tables


@pytest.mark.parametrize("full", [-1, 2])
def test_classes_that_cannot_link_go_first(spark, monkeypatch, full):
    """With the filter alone and with the join for a full filter: no bucket is opened for texts that share a passage only."""
    monkeypatch.setattr(jaccard_join, "TOO_FULL", full)
    tables = kept_tables(monkeypatch)
    rng = random.Random(43)
    passage = prose(rng, 40, 3000)
    texts = [*near_texts(rng, 60), *[f"{passage} {prose(rng, 400, 3000)}" for _ in range(60)]]
    ids = rng.sample(range(1000), len(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(documents(spark, texts, ids=ids)).collect()}
    assert got == brute_components(ids, texts)
    assert not {r["first"] for r in tables["linkable-classes"].collect()} & set(ids[-60:])


@pytest.mark.parametrize("size", [60, 600])
def test_pairs_in_a_group_of_near_copies_grow_with_the_group(spark, monkeypatch, size):
    """Copies with similarities around the limit, of sets with and without marks: fewer pairs than rows are given and verified."""
    tables = kept_tables(monkeypatch)
    monkeypatch.setattr(jaccard_join, "STAR_SHARE", 100.0)  # no comparison with owners before
    rng = random.Random(47)
    first, texts = prose(rng, size, 10 ** 6).split(), []
    for _ in range(150):
        w = list(first)
        for k in rng.sample(range(0, size - 4, 5), size // 100 + rng.randrange(2)):
            w[k] = f"new{rng.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    ids = rng.sample(range(1000), len(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(documents(spark, texts, ids=ids)).collect()}
    assert got == brute_components(ids, texts)
    pairs = [tables[t].count() for t in ("tree-pairs", "last-pairs") if t in tables]
    assert 0 < sum(pairs) < 2000  # of 11,175


def test_marks_bound_the_overlap():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.choice(1 << 12, rng.integers(1, 300)).astype(np.uint64) << np.uint64(24)) for _ in range(40)]  # many equal marks
    sets += [np.unique(np.concatenate([s, rng.choice(1 << 62, 3).astype(np.uint64)])) for s in sets]
    sets.append(np.arange(jaccard_join.MOST_MARKS + 1).astype(np.uint64))
    m = len(sets)
    zeros = np.zeros(m, np.int64)
    table = pa.table({"h": zeros, "block_a": zeros, "block_b": zeros, "own": zeros, "place": zeros, "class": np.arange(m),
                      "component": np.arange(m), "n": [len(s) for s in sets], "marks": [jaccard_join.marks(s) for s in sets],
                      "bits": [jaccard_join.bitmap(s).tobytes() if len(s) > jaccard_join.MOST_MARKS else None for s in sets]})
    rows = jaccard_join.Members(table)
    assert rows.bits == [jaccard_join.bitmap(s).tobytes() for s in sets]
    i, j = np.triu_indices(m, 1)
    ok = jaccard_join._agreeing(rows, i, j, 85, 100)
    linked = np.array([100 * (o := len(np.intersect1d(sets[a], sets[b]))) >= 85 * (len(sets[a]) + len(sets[b]) - o) for a, b in zip(i, j)])
    assert linked.any() and ok[linked].all() and ok[j == m - 1].all() and not ok.all()
    # the forest connects what all pairs connect
    pairs, tree = jaccard_join.bucket_pairs(rows, 85), jaccard_join.bucket_pairs(rows, 85, True)
    roots = [brute_roots(p, m) for p in (pairs, tree)]
    assert roots[0] == roots[1] and len(tree) == m - len(set(roots[0])) < len(pairs) + 1


def brute_roots(pairs, m):
    root = list(range(m))
    for _ in range(m):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(docs).collect()}
    assert got == brute_components([r[0] for r in rows], [r[1] for r in rows])


def test_join_edges(spark):
    docs = documents(spark, ["a b c d e", "a b c d e", "a b c d e", "", None], ids=[3, 3, None, 4, 5])
    got = sorted(((r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(docs).collect() if r["doc_id"])
    assert got == [(3, 2, 3), (3, 2, 3), (4, 0, 4), (5, 0, 5)]
    assert jaccard_join.keep_one_each(docs).count() == 5
    assert jaccard_join.join_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("leaf", [1, 64, 1000])
def test_tree_traversal_loses_no_pair(monkeypatch, leaf):
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(150):
        s = rng.choice(1 << 62, rng.integers(1, 90), replace=False).astype(np.uint64) if not sets or rng.random() < 0.4 else \
            np.unique(np.concatenate([sets[rng.integers(len(sets))], rng.choice(1 << 62, 2).astype(np.uint64)]))
        sets.append(np.sort(s))
    sizes, groups = np.array([len(s) for s in sets]), rng.integers(0, 40, 150)
    linked = {(i, j) for i in range(150) for j in range(i + 1, 150) if groups[i] != groups[j]
              and 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (sizes[i] + sizes[j] - o)}
    for across in (False, True):
        own = rng.integers(0, 2, 150)
        table = pa.table({"h": np.zeros(150, np.int64), "block_a": np.zeros(150, np.int32), "block_b": np.full(150, across, np.int32),
                          "own": own.astype(np.int32), "place": np.zeros(150, np.int32), "class": np.arange(150), "component": groups, "n": sizes.astype(np.int32),
                          "bits": [jaccard_join.bitmap(s).tobytes() for s in sets]})
        pairs = {tuple(sorted(p)) for p in jaccard_join.bucket_pairs(jaccard_join.Members(table), 85).tolist()}
        want = {(i, j) for i, j in linked if not across or own[i] != own[j]}
        assert want and want <= pairs and len(pairs) < 150 * 149 // 4


def test_one_of_equal_rows_stays_beside_any_column(spark):
    docs = spark.createDataFrame([(3, "a b c d e", 1), (3, "a b c d e", 1), (3, "a b c d e", 2), (9, "a b c d e", 1), (9, "a b c d e", 1),
                                  (4, "other words stand here", 1), (None, "a b c d e", 1), (None, "a b c d e", 1)],
                                 "doc_id long, text string, gone_id int").withColumn("own_id", F.lit("x"))
    kept = jaccard_join.keep_one_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"] or 0), r["gone_id"], r["own_id"]) for r in kept.collect())
    assert got == [(0, 1, "x"), (0, 1, "x"), (3, 1, "x"), (3, 2, "x"), (4, 1, "x")]


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(100, 130)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(200, k) for k in range(201, 230)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in links for x in p}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}
