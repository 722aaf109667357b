"""Sharding, top-k search, near-duplicates, secrets and the pipeline against brute force."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coldspot.llm import neardup, queries, secrets, sharding, topk

from .conftest import DATA, ODD_TEXTS, SMALL, frame


# ---- sharding

def check_shards(rows, docs, shards=16):
    assert len(rows) == len(docs)
    per = Counter(r["shard"] for r in rows)
    assert all(0 <= s < shards for s in per)
    counts = [per.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in per:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(per[s]))
    want = sorted(((d if d is not None else -1), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in docs)
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["size"], r["text_crc32"]) for r in rows) == want
    assert {r["law"] for r in rows} <= {"rows"} and {r["grown_shard"] for r in rows} <= {None}


def test_sharding_mixture(spark, documents):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in documents.collect()]
    rows = queries.op4_sharding(spark, DATA).collect()
    check_shards(rows, docs)
    share = Counter(s for _, _, _, s in docs)
    for shard in range(16):
        own = Counter(r["source"] for r in rows if r["shard"] == shard)
        for source, n in share.items():
            assert abs(own[source] - n / 16) <= 2


@pytest.mark.parametrize("bucket_rows", [3, 2048])
def test_sharding_does_not_depend_on_buckets(spark, documents, bucket_rows, monkeypatch):
    monkeypatch.setattr(sharding, "_bucket_rows", lambda rows: bucket_rows)
    some = documents.where("doc_id < 150")
    got = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(some).collect()}
    # brute force: rank by the seeded hash within the source, sort by fraction, cut
    import hashlib
    by = defaultdict(list)
    for r in some.collect():
        by[r["source"]].append((hashlib.md5(f"17:{r['doc_id']}:{r['text']}".encode()).hexdigest(), r["doc_id"]))
    order = sorted((((2 * i + 1) / (2 * len(v))), s, h, d) for s, v in by.items() for i, (h, d) in enumerate(sorted(v)))
    n = len(order)
    want = {(d, p * 16 // n, p - -(-(p * 16 // n) * n // 16)) for p, (_, _, _, d) in enumerate(order)}
    assert got == want


def test_sharding_edge_cases(odd, empty):
    rows = sharding.shard(odd).collect()
    check_shards(rows, ODD_TEXTS)
    assert sharding.shard(empty).count() == 0
    assert "grown_shard" in sharding.shard(empty).columns


def test_sharding_equal_rows(spark, monkeypatch):
    """A third of the rows is one row, another third has no doc_id: the interleaving in plain Python."""
    rows = [(7, "same", "a")] * 60 + [(None, None, None)] * 55 + [(i, f"text {i}", "ab"[i % 2]) for i in range(60)]
    monkeypatch.setattr(sharding, "RUN_ROWS", 8)
    monkeypatch.setattr(sharding, "_bucket_rows", lambda rows: 16)
    got = sorted((r["shard"], r["slot"], r["doc_id"] or -1, r["text_crc32"], r["source"] or "") for r in
                 sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    made = []
    for source in {s for _, _, s in rows}:
        own = sorted((hashlib.md5(f"17:{'' if d is None else d}:{t or ''}".encode()).hexdigest(), d or -1, zlib.crc32((t or "").encode()))
                     for d, t, s in rows if s == source)
        made += [((2 * r - 1) / (2 * len(own)), "" if source is None else "s" + source, *row, source or "") for r, row in enumerate(own, 1)]
    starts = [-(-shard * len(rows) // 16) for shard in range(17)]
    want = []
    for p, (_, _, _, doc, crc, source) in enumerate(sorted(made)):
        shard = p * 16 // len(rows)
        want.append((shard, p - starts[shard], doc, crc, source))
    assert got == sorted(want)


# ---- top-k search

def brute_topk(vectors, k=5):
    made = set()
    ok = {i: [int(np.floor(256 * float(x))) for x in v] for i, v in vectors
          if v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q, a in ok.items():
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok.items() if c != q)[:k]
            made |= {(q, rank, c, -s) for rank, (s, c) in enumerate(scored, 1)}
    return made


def test_topk_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(6)]) for i in range(400)]  # many ties
    rows += [(1000, None), (1050, [0.1, None]), (1100, [float("nan")] * 6), (1150, [float("inf")] * 6), (1200, []),
             (1250, [0.5, 0.25]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    vectors = topk.quantise(df.selectExpr("*", "1 as score", "2 as terms", "3 as rank"), "vec_id", "embedding")
    got = {tuple(r) for r in topk.search(vectors.where("vec_id % 50 = 0"), vectors).collect()}
    assert got == brute_topk(rows)


def test_topk_blocks_of_queries(spark, monkeypatch):
    rows = [(i, [((i * 7 + j) % 13) / 13 for j in range(4)]) for i in range(300)]
    df = topk.quantise(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v")
    monkeypatch.setattr(topk, "QUERY_TERMS", 8)
    monkeypatch.setattr(topk, "CANDIDATE_TERMS", 200)
    monkeypatch.setattr(topk, "CANDIDATES", 7)
    monkeypatch.setattr(topk, "TILE", 1)
    assert topk._sides(df.where("vec_id % 50 = 0"), df) == (3, 6)
    found = topk.search(df.where("vec_id % 50 = 0"), df)
    assert {tuple(r) for r in found.collect()} == brute_topk(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "Cartesian" not in plan


def test_topk_repeated_rows(spark):
    """A third of all rows is one row: at most k copies are candidates, as in the full ranking."""
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)] + [(33, [6.0, 2.0])] * 40 + [(50, [1.0, 1.0])] * 9
    df = topk.quantise(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v")
    got = sorted(tuple(r) for r in topk.search(df.where("vec_id % 50 = 0"), df).collect())
    whole = [(i, [256 * int(x) for x in v]) for i, v in rows]
    want = []
    for q in (0, 50):
        a = min(v for i, v in whole if i == q)
        scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in whole if c != q)[:5]
        want += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored, 1)]
    assert got == want
    assert all(c == 33 for q, _, c, _ in got if q == 50)


def test_topk_few_and_none(spark):
    df = topk.quantise(spark.createDataFrame([(0, [1.0]), (50, [2.0]), (1, [0.5])], "vec_id long, v array<double>"), "vec_id", "v")
    assert {tuple(r) for r in topk.search(df.where("vec_id % 50 = 0"), df).collect()} == {
        (0, 1, 50, 256 * 512), (0, 2, 1, 256 * 128), (50, 1, 0, 256 * 512), (50, 2, 1, 512 * 128)}
    none = df.where("vec_id < 0")
    assert topk.search(none, df).count() == 0 and topk.search(df, none).count() == 0
    assert topk.search(none, df).columns == ["query_id", "rank", "vec_id", "score"]


def test_best_takes_ties_by_id():
    scores = np.array([5, 7, 5, 5, 9, 5])
    assert sorted(topk.best(scores, np.arange(6), 3).tolist()) == [0, 1, 4]


# ---- near-duplicates

def brute_sets(texts):
    lower = {c: c + 32 for c in range(65, 91)}
    made = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        made.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return made


def brute_components(ids, texts):
    sets = brute_sets(texts)
    least = list(range(len(ids)))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    posting = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            posting[x].append(i)
    first = {}
    for i in range(len(ids)):
        if ids[i] in first:
            least[find(i)] = find(first[ids[i]])
        first.setdefault(ids[i], i)
        for j in {j for x in sets[i] for j in posting[x] if j > i}:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * len(sets[i] | sets[j]):
                least[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(ids[i])
    return {ids[i]: (len(sets[i]), min(groups[find(i)])) for i in range(len(ids))}


@pytest.mark.parametrize("options", [{}, {"node_rows": 6, "max_depth": 3}])
def test_near_duplicates_by_brute_force(spark, options):
    """Families of edited copies, chains, copies and a passage that many texts share."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for family in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 150))]
        for copy in range(rng.choice([1, 1, 2, 3, 15])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append(" ".join(words))
            if copy % 3 == 2:
                base = words  # drift: chains of near copies
    rows += [" ".join([rng.choice(vocabulary) for _ in range(15)] + passage + [rng.choice(vocabulary) for _ in range(15)])
             for _ in range(40)]
    rows += [rows[0]] * 30 + ["only three words", "Only THREE\twords", "one", None, "", "  \n"]
    rng.shuffle(rows)
    ids = list(range(100, 100 + len(rows)))
    docs = frame(spark, [(i, t, "en", "s") for i, t in zip(ids, rows)]).repartition(5)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs, **options).collect()}
    want = brute_components(ids, rows)
    assert len(got) == len(want)
    for i, (n, component) in want.items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, component, i == component)


def test_links_inside_a_family_without_links(spark):
    """Pairs of true links among many texts that share most of their words: every class of a
    large node meets every other, also where nodes do not branch."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(140)]
    rows = []
    for _ in range(120):
        own = [rng.choice(vocabulary) for _ in range(40)]
        rows.append(" ".join(passage + own))
        rows.append(" ".join(passage + [rng.choice(vocabulary) if k in (3, 12, 21, 30) else w for k, w in enumerate(own)]))
    ids = list(range(100, 100 + len(rows)))
    docs = frame(spark, [(i, t, "en", "s") for i, t in zip(ids, rows)]).repartition(4)
    want = brute_components(ids, rows)
    assert len({component for _, component in want.values()}) == 120
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, node_rows=20, max_depth=0).collect()}
    assert got == {i: component for i, (_, component) in want.items()}


def test_every_pair_of_a_crowded_node_is_confirmed(spark, monkeypatch):
    """Each class has many partners whose estimates may rank above its one true partner's:
    none is left unconfirmed, however few candidates are tried first."""
    monkeypatch.setattr(neardup, "ALL_PAIRS", 2)
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(200)]
    rows = []
    for _ in range(60):
        own = [rng.choice(vocabulary) for _ in range(34)]
        rows.append(" ".join(passage + own))
        rows.append(" ".join(passage + [rng.choice(vocabulary) if k in (3, 8, 13, 18, 23, 28) else w for k, w in enumerate(own)]))
    ids = list(range(100, 100 + len(rows)))
    docs = frame(spark, [(i, t, "en", "s") for i, t in zip(ids, rows)]).repartition(4)
    want = brute_components(ids, rows)
    assert len({component for _, component in want.values()}) == 60
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: component for i, (_, component) in want.items()}


def test_near_duplicates_edge_cases(spark, odd, empty):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == len(ODD_TEXTS)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert by[6][0]["component_id"] == by[7][0]["component_id"] == 6 and not by[7][0]["kept"]
    assert [r["component_id"] for r in by[8]] == [8, 8]
    assert by[None][0]["component_id"] is None and by[None][0]["kept"]
    for i in (1, 2, 3):
        assert by[i][0]["n_shingles"] == 0 and by[i][0]["component_id"] == i
    assert by[4][0]["n_shingles"] == 1
    assert neardup.near_duplicates(empty).count() == 0
    left = neardup.deduplicated(odd)
    assert left.columns == odd.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([1, 2, 3, 4, 5, 6, 8, None, 9, 10, 11])


def test_repeated_id_with_two_texts_links_both(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    docs = frame(spark, [(5, a, "en", "s"), (5, b, "en", "s"), (7, a, "en", "s"), (3, b, "en", "s"), (9, "z y x w v", "en", "s")])
    got = sorted((r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(docs).collect())
    assert got == [(3, 3), (5, 3), (5, 3), (7, 3), (9, 9)]


def test_components_of_a_long_chain(spark):
    n = 200
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(min(x, y), max(x, y)) for x, y in zip(order, order[1:])] + [(1000, 1001)], "a long, b long")
    got = {r["id"]: r["component"] for r in neardup.components(links).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
    assert neardup.components(links.limit(0)).count() == 0


def _similar_rows(n=40, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 256, (6, neardup.SKETCH), dtype=np.uint8)
    rows = base[rng.integers(0, 6, n)].copy()
    for r in rows:
        change = rng.random(neardup.SKETCH) < rng.choice([0.0, 0.1, 0.2, 0.35])
        r[change] = rng.integers(0, 256, change.sum())
    return rng.integers(80, 121, n), rows


def test_spanning_forest_against_kruskal():
    sizes, sketches = _similar_rows()
    a, b = neardup.similar_pairs(sizes, sketches, 0.6, 75)
    weight = {(i, j): neardup.estimate(sketches[j:j + 1], sketches[i])[0] for i, j in zip(a.tolist(), b.tolist())}
    assert set(weight) == {(i, j) for i in range(40) for j in range(i + 1, 40)
                           if neardup.estimate(sketches[j:j + 1], sketches[i])[0] >= 0.6
                           and max(sizes[i], sizes[j]) * 75 <= min(sizes[i], sizes[j]) * 100}
    made = {(min(e), max(e)) for e in neardup.spanning_forest(sizes, sketches, 0.6, 75).tolist()}
    assert made <= set(weight)
    root = list(range(40))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    kept = []
    for e in sorted(weight, key=lambda e: -weight[e]):
        x, y = find(e[0]), find(e[1])
        if x != y:
            root[x] = y
            kept.append(e)
    assert len(made) == len(kept) and abs(sum(weight[e] for e in made) - sum(weight[e] for e in kept)) < 1e-9


def test_best_lower_partner():
    sizes, sketches = _similar_rows()
    a, b = neardup.similar_pairs(sizes, sketches, 0.6, 75)
    order = np.random.default_rng(1).permutation(40)
    at = {int(v): i for i, v in enumerate(order)}
    best = {}
    for i, j in zip(a.tolist(), b.tolist()):
        late, early = (i, j) if at[i] > at[j] else (j, i)
        near = neardup.estimate(sketches[i:i + 1], sketches[j])[0]
        best[late] = max(best.get(late, (-1, 0)), (near, -at[early]))
    rows, partners, values = neardup.best_lower(order, sizes, sketches, 0.6, 75)
    assert {u: (near, -at[v]) for u, v, near in zip(rows.tolist(), partners.tolist(), values.tolist())} == best


WORDS_AND_BLANKS = st.text(st.sampled_from(list("abAB \t\n\x0b\x0c\r\x1c中é\xa0")), max_size=40)


@given(WORDS_AND_BLANKS, st.integers(1, 12))
@settings(max_examples=300, deadline=None)
def test_word_hashes(text, block):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    h = neardup.word_hashes(text.encode())
    assert len(h) == len(words)
    assert all((x == y) == (v == w) for x, v in zip(h.tolist(), words) for y, w in zip(h.tolist(), words))
    whole, neardup.BLOCK_BYTES = neardup.BLOCK_BYTES, block
    try:
        assert neardup.word_hashes(text.encode()).tolist() == h.tolist()
    finally:
        neardup.BLOCK_BYTES = whole


def test_estimate_of_known_similarity():
    """The sketch's estimates of sets of 3/4 similarity, small and large, spread as the
    binomial distribution says."""
    rng = np.random.default_rng(3)
    wide, narrow = neardup._constants(3)
    for size in (70, 1400):
        near = []
        for _ in range(200):
            both = rng.integers(0, 1 << 63, size * 8 // 7, dtype=np.uint64)
            x, y = both[:size], both[-size:]
            for functions in (narrow, neardup._wide()):
                one, two = (np.frombuffer(neardup.tokens(s << np.uint64(1), functions), np.uint8) for s in (x, y))
                near.append(neardup.estimate(one[None], two)[0])
        assert abs(np.mean(near[::2]) - 0.75) < 0.02 and np.std(near[::2]) < 0.045
        assert abs(np.mean(near[1::2]) - 0.75) < 0.01 and np.std(near[1::2]) < 0.016


# ---- secrets

@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return secrets.fit(docs, spark.read.parquet(f"{DATA}/pages.parquet"))


def test_secret_scan_finds_planted_and_leaves_the_rest(spark, trained):
    planted = {
        1: ('the ed token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" of an', "04dbebab91ab85687d33eeaaf9ac699e1188f962"),
        2: ("onent password=b7db7aa4a5fcc78305 enes onnd", "b7db7aa4a5fcc78305"),
        3: ("anere\npassword: 'q7Zk2mP9xL1vB4' the", "q7Zk2mP9xL1vB4"),
    }
    clean = {11: "see http://tion.example.net/en/article-78172 for the ed of", 12: "mail rethly.29@mail7.example.com of the",
             13: "ordinary words of an onble theaing only", 14: None, 15: "", 16: "call 555-1234 or 555 1234 1234 at 10:30",
             17: "your key is example-key-12345678 of"}
    docs = frame(spark, [(i, t, "en", "s") for i, (t, _) in planted.items()] + [(i, t, "en", "s") for i, t in clean.items()])
    rows = secrets.scan(docs, *trained).collect()
    texts = {i: t for i, (t, _) in planted.items()} | clean
    for r in rows:
        assert texts[r["doc_id"]][r["start"]:r["start"] + r["length"]] == r["finding"]
        assert 0 <= r["score"] <= 1
    assert {(r["doc_id"], r["finding"]) for r in rows if r["is_secret"]} == {(i, s) for i, (_, s) in planted.items()}
    masked = {r["doc_id"]: r["text"] for r in secrets.mask(docs, *trained).collect()}
    assert masked == {i: t.replace(s, "[SECRET]") for i, (t, s) in planted.items()} | clean


def test_secret_scan_of_the_table_by_pattern(spark, trained, documents):
    """Brute force in Python: every key assigned to a name and every access key."""
    want = set()
    for r in documents.collect():
        for m in re.finditer(r'(?i:token|password)\s?=\s?"?([0-9a-f]{16,})|\b(AKIA[0-9A-Z]{16})\b', r["text"]):
            want.add((r["doc_id"], m.start(m.lastindex), m[m.lastindex]))
    rows = secrets.scan(documents, *trained).where("is_secret").collect()
    assert want and want <= {(r["doc_id"], r["start"], r["finding"]) for r in rows}


def test_secret_scan_plan_is_native(spark, trained, documents):
    plan = secrets.scan(documents, *trained)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_secret_edge_cases(spark, trained, odd, empty):
    secrets.scan(odd, *trained).collect()
    assert secrets.scan(empty, *trained).count() == 0
    assert secrets.mask(odd, *trained).columns == odd.columns
    assert secrets.mask(odd, *trained).count() == len(ODD_TEXTS)
    language, forest = secrets.fit(empty)
    assert forest is None
    doc = frame(spark, [(1, "password=b7db7aa4a5fcc78305", "en", "s")])
    assert [(r["score"], r["is_secret"]) for r in secrets.scan(doc, language, forest).collect()] == [(0.0, False)]


def test_context_goes_on_through_other_candidates(spark):
    texts = ["oauth2_token=b7db7aa4a5fcc78305 s3_secret: 'q7Zk2mP9xL1vB4' a1b2c3d4e5 f6a7b8c9d0 the end",
             " ".join(f"id{i:06d}" for i in range(40)), "s3_secret: 'q7Zk2mP9xL1vB4'"]
    # the character that marks candidates, in the text and inside a candidate
    texts += [f"\uf0f1{texts[0]}\uf0f1", "password=b7db\uf0f17aa4\uf0f1 and id000001", "\uf0f1", "😀 id000001 😀"]
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    rows = secrets.candidates(docs).collect()
    assert len(rows) > 40
    for r in rows:
        text, end = texts[r["doc_id"]], r["start"] + len(r["finding"])
        assert text[r["start"]:end] == r["finding"]
        assert r["before"] == text[max(0, r["start"] - secrets.BEFORE):r["start"]] and r["after"] == text[end:end + secrets.AFTER]


def test_assigned_values_of_names_in_any_case(spark):
    values = {'DB_PASSWORD="correct-horse!" x': "correct-horse!", "PASSWORD=hunter2": "hunter2", 'Password: "p@ss!w0rd"': "p@ss!w0rd",
              "Api_Key  =  'no+digits!'": "no+digits!", "password=hunter2": "hunter2"}
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(values)])
    rows = secrets.candidates(docs).collect()
    assert {(r["doc_id"], r["finding"]) for r in rows} == set(enumerate(values.values()))
    assert all(re.search(secrets.ASSIGNED, r["before"]) for r in rows)


def test_mask_replaces_the_found_span_only(spark, trained):
    key, other = "b7db7aa4a5fcc78305", "q7Zk2mP9xL1vB4"
    texts = [
        (1, f"password={key} and https://cdn.pages.net/assets/{key}.js the end", f"password=[SECRET] and https://cdn.pages.net/assets/{key}.js the end"),
        # two texts of one doc_id, and null doc_ids, each with secrets of its own
        (2, f"password={key} first", "password=[SECRET] first"), (2, f"token: '{other}' second", "token: '[SECRET]' second"),
        (None, f"password={key} third", "password=[SECRET] third"), (None, f"ordinary {other[:6]} text", f"ordinary {other[:6]} text"),
        (None, None, None), (None, "", ""),
        # the mark itself as text, and a secret next to another one
        (3, f"[SECRET] password={key} token='{other}' SECRET", "[SECRET] password=[SECRET] token='[SECRET]' SECRET"),
        (5, f"\uf0f1 password={key} \uf0f1", "\uf0f1 password=[SECRET] \uf0f1"),
        (4, f"password={key} first", "password=[SECRET] first"), (4, f"password={key} first", "password=[SECRET] first"),
    ]
    docs = frame(spark, [(i, t, "en", "s") for i, t, _ in texts])
    names = {"score": "_Text_Key", "key": "_secrets", "kept": "k", "_b": "any"}
    docs = docs.withColumnsRenamed(names).withColumn("a.b", F.lit(1))
    out = secrets.mask(docs, *trained)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == sorted((str(i), str(t)) for i, _, t in texts)
    assert all((r["_Text_Key"], r["_secrets"], r["k"], r["any"]) == ("x", "y", "z", "w") for r in got)


def test_forest_finds_secrets_of_names_it_was_not_trained_on(spark, trained):
    """Labelled findings of two names are held out as a whole. The features hold that a value
    is assigned and that some name stands before it, not which one."""
    docs, language = spark.read.parquet(f"{DATA}/documents.parquet"), trained[0]
    rows = secrets.example_findings(docs).cache()
    held = F.col("before").rlike("secret|api_key")
    forest = secrets.train(rows.where(~held).unionAll(secrets.ordinary_words(docs).select(rows.columns)), language)
    counts = {(r["label"], r["hit"]): r["n"] for r in secrets.scored(rows.where(held), language, forest).groupBy(
        "label", (F.col("score") >= secrets.SECRET_FROM).alias("hit")).agg(F.count(F.lit(1)).alias("n")).collect()}
    right, missed, wrong = (counts.get(k, 0) for k in ((1, True), (1, False), (0, True)))
    print(f"held-out names: precision {right / max(1, right + wrong):.4f}, recall {right / max(1, right + missed):.4f}, {counts}")
    assert right + missed > 100 and right >= 0.95 * (right + missed) and right >= 0.95 * (right + wrong)


def test_samples_of_words_do_not_follow_the_alphabet(spark):
    docs = spark.range(400).selectExpr(
        "id as doc_id", "concat_ws(' ', transform(sequence(0, 400), i -> translate(concat('word', 100000 + id * 401 + i), '0123456789', 'abcdefghij'))) as text")
    picked = [r["finding"] for r in secrets.ordinary_words(docs, rows=100).collect()]
    assert len(picked) == 100 and len({w[:6] for w in picked}) > 10


def test_words_and_pairs_are_counted_over_all_documents(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "if(id % 2 = 0, 'common words', 'zqzq') as text")
    language = secrets.Language(docs)
    assert language.words == ["common", "words", "zqzq"]
    # 4500 texts hold zq twice and qz once
    assert abs(language.pairs["zq"] - 9000.5 / (9000 + 0.5 * 27)) < 1e-9


def test_candidate_features(spark, trained):
    rows = spark.createDataFrame([("04dbebab91ab85687d33", 'token = "', '"'), ("thetheonly", " ", " "), ("ABCDEF12", "a/b/", "/c")],
                                 "finding string, before string, after string")
    got = secrets.with_features(rows, trained[0]).collect()
    assert got[0]["f_length"] == 20 and got[0]["f_hex"] == 1 and got[0]["f_named"] == 1 and got[0]["f_assigned"] == 1
    assert got[1]["f_kinds"] == 0.1 and got[1]["f_digits"] == 0 and got[1]["f_pairs"] > got[0]["f_pairs"]
    assert got[2]["f_path"] == 1 and got[2]["f_upper"] == 0.75


# ---- pipeline

def test_pipeline_stages(spark, documents):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_dedup", "secrets", "packing"]
    docs, seen = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
        rows = out.collect()
        seen[name] = rows
        if name == "near_dedup":
            want = brute_components(list(before), [r["text"] for r in before.values()])
            assert sorted(r["doc_id"] for r in rows) == sorted(i for i, (_, c) in want.items() if i == c)
        elif name == "secrets":
            assert sorted(r["doc_id"] for r in rows) == sorted(before)
            changed = [r for r in rows if r["text"] != before[r["doc_id"]]["text"]]
            assert all("[SECRET]" in r["text"] and r["n_chars"] == len(r["text"]) for r in changed)
            assert not [r for r in rows if re.search(r"(token|password)\s?=\s?\"?[0-9a-f]{16,}", r["text"])]
        elif name == "packing":
            assert {r["doc_id"] for r in rows} == set(before)
        else:
            assert {tuple(r) for r in rows} <= {tuple(r) for r in before.values()}
            field, bad = ("quality", 0) if name == "quality_rules" else ("toxic", 1)
            wrong = [i for i in {r["doc_id"] for r in rows} if i in labels and labels[i][field] == bad]
            assert len(wrong) <= 0.1 * len(rows)
        if name != "packing":
            docs = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in seen["packing"]}


def test_pipeline_without_rows(spark, empty):
    import corpus_pipeline

    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0, name
