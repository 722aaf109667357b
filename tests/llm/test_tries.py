"""Spelling variants, best-fit packing and the conversation trie against brute force."""
import collections
import hashlib
import re
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from coldspot.llm import bestfit, queries, spelling, turntrie
from coldspot.llm.common import tokenizer_path
from coldspot.llm.ranges import common_units, shared_prefixes

from .conftest import DATA, ODD_TEXTS, frame

BYTES = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture()
def many_ranges(spark):
    """Small tables keep their partitions, so that tries have borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# --- borders of ranges ---


@given(st.sets(st.text("ab", max_size=6), min_size=1, max_size=30), st.data())
@settings(max_examples=200, deadline=None)
def test_prefixes_of_several_ranges_have_one_name(keys, data):
    keys = sorted(keys)
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(keys) - 1)), max_size=5)) - {len(keys)})
    ranges = [keys[a:b] for a, b in zip([0, *cuts], [*cuts, len(keys)])]
    shared = shared_prefixes([(i, r[0], r[-1]) for i, r in enumerate(ranges)])
    names = collections.defaultdict(set)
    for i, r in enumerate(ranges):
        numbers = spelling.NodeNumbers(i, shared[i])
        for word in r:
            for depth, number in enumerate(list(numbers.next(word))):
                names[word[:depth]].add(number)
    assert all(len(n) == 1 for n in names.values())
    assert len(set().union(*names.values())) == len(names)


def test_common_units():
    assert common_units("abc", "abd") == 2 and common_units("ab", "abc") == 2 and common_units("", "a") == 0
    assert common_units(b"aabbcc", b"aabbcd", 2) == 2 and common_units(b"aabb", b"aabb", 2) == 2


# --- operator 11 ---


def spelling_brute(rows, min_length=7, min_count=2, ratio=10, modulus=31):
    lower = str.maketrans({i: i + 32 for i in range(65, 91)})
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % modulus == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count}
    near = collections.defaultdict(set)
    skipped = collections.defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            skipped[w[:i], w[i + 1:]].add(w)
    for (a, b), words in skipped.items():
        for w in words:
            near[w] |= words - {w}
            if a + b in counts:
                near[w].add(a + b)
                near[a + b].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def told(df):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]


def test_spelling_query(spark, documents):
    rows = told(queries.op11_spelling_variants(spark, DATA))
    assert len(rows) == len(set(rows))
    assert set(rows) == spelling_brute([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_spelling_over_many_ranges(many_ranges, documents):
    few = documents.where("doc_id < 200")
    rows = told(spelling.group(few))
    assert set(rows) == spelling_brute([(r["doc_id"], r["text"]) for r in few.collect()])


def test_spelling_chains_ties_and_runs_of_letters(many_ranges):
    """Doubled letters, ties of n, chains of forms, short words and a hot word."""
    counts = {"aaaaaaa": 3, "aaaaaaaa": 40, "aaaaaaaaa": 3, "abcdefg": 2, "abcdefh": 50, "abcdefi": 50, "abcdxfi": 600,
              "bcdefgh": 2, "straße": 5, "straßen": 60, "strassen": 5, "ÀÀÀÀÀÀÀ": 2, "ÀÀÀÀÀÀÀÀ": 30, "zzzzzzz": 1}
    text = " ".join(w for w, n in counts.items() for _ in range(n)) + " the" * 5000 + " hotwords" * 5000
    rows = [(1, text, "en", "a"), (None, "Abcdefg  abcdefG", "en", "a"), (2, None, None, None), (3, "", None, None)]
    got = set(told(spelling.group(frame(many_ranges, rows))))
    assert got == spelling_brute([(r[0], r[1]) for r in rows])
    by_word = {r[0]: r for r in got}
    assert by_word["abcdefg"][1:3] == ("abcdefh", "abcdefh") and by_word["abcdefi"][1] == "abcdxfi"
    assert by_word["ÀÀÀÀÀÀÀ"][1] == "ÀÀÀÀÀÀÀÀ"


def test_spelling_edge_cases(odd, empty, spark):
    assert spelling.group(empty).collect() == []
    assert set(told(spelling.group(odd))) == spelling_brute([r[:2] for r in ODD_TEXTS])
    assert told(spelling.group(frame(spark, [(1, None, None, None)]))) == []
    long = "q" * 1500
    assert set(told(spelling.group(frame(spark, [(1, f"{long} {long}", None, None)])))) == spelling_brute([(1, f"{long} {long}")])


def test_last_of_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21)], "id long, form long")
    assert {(r["id"], r["root"]) for r in spelling.last_of_chain(links).collect()} == {(i, 9) for i in range(9)} | {(20, 21)}


# --- operator 12 ---


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(BYTES)


TOKENS = bestfit.TokenIds(BYTES)
ANY = st.text(st.one_of(st.sampled_from(list(" \n\t\x1c\x85\xa0 　'.,_sStTlLrRvVmMdD09²½ªé中😀​᠎")),
                        st.characters(max_codepoint=255), st.characters(blacklist_categories=("Cs",))), max_size=40)


@given(st.one_of(ANY, ANY.map(lambda t: t + "  <|endoftext|> " + t)))
@settings(max_examples=500, deadline=None)
def test_ids_equal_the_tokenizer(byte_tokenizer, text):
    want = byte_tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(TOKENS.packed([text])[0], "<u4").tolist() == want
    assert np.frombuffer(TOKENS.by_chunks([text])[0], "<u4").tolist() == want


def test_long_words_are_not_remembered(byte_tokenizer):
    own = bestfit.TokenIds(BYTES)
    texts = ["中" * 3000 + str(i) for i in range(20)] + ["ab" * 5000, " " * 9000 + "x"]
    for text, ids in zip(texts, own.packed(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == byte_tokenizer.encode(text, add_special_tokens=False).ids
    assert not any(len(k) > bestfit.CACHED_CHARS for k in own.known)


def test_cuts():
    assert bestfit.cuts(1) == [(0, 1)] and bestfit.cuts(1024) == [(0, 1024)]
    assert bestfit.cuts(1025) == [(0, 1), (1, 1024)] and bestfit.cuts(3000) == [(0, 952), (952, 1024), (1976, 1024)]


@given(st.lists(st.integers(0, 30), min_size=1, max_size=40).map(lambda c: [0, *c]))
@settings(max_examples=200, deadline=None)
def test_groups_hold_every_piece(counts):
    counts = np.array(counts)
    window = len(counts) - 1
    groups = bestfit.plan_groups(counts)
    used = np.zeros_like(counts)
    for g in groups:
        assert sum(length * each for length, each in g.parts) <= window
        for length, each in g.parts:
            used[length] += g.times * each
    assert (used == counts).all()
    # never more than two half-filled sequences' worth above the volume bound of best fit
    volume = int((counts * np.arange(window + 1)).sum())
    assert sum(g.times for g in groups) <= 2 * -(-volume // window) + 1


def test_least_squares_meets_an_exact_histogram():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 30, 70, 25]] = [50, 50, 20, 20, 40]
    x = bestfit.fit(bestfit.patterns(counts), counts)
    assert (x >= 0).all()
    groups = bestfit.plan_groups(counts)
    assert sum(g.times for g in groups) == 50 + 20 + 10


def check_packing(rows, texts, tokenizer, window=1024):
    """Rows against the texts (in any order): pieces, sums, gapless sequences. Returns the
    number of sequences and the volume bound."""
    want = collections.Counter()
    tokens = 0
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        tokens += len(ids)
        for piece, (start, length) in enumerate(bestfit.cuts(len(ids), window)):
            want[doc_id, piece, start, length, zlib.crc32(struct.pack(f"<{length}I", *ids[start:start + length]))] += 1
    assert want == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), -(-tokens // window)


def test_best_fit_query(spark, documents, byte_tokenizer):
    rows = queries.op12_best_fit_packing(spark, DATA).collect()
    made, least = check_packing(rows, [(r["doc_id"], r["text"]) for r in documents.collect()], byte_tokenizer)
    assert made <= 1.02 * least


def test_best_fit_over_many_tasks(many_ranges, documents, byte_tokenizer):
    rows = bestfit.pack(documents.repartition(13), BYTES).collect()
    made, least = check_packing(rows, [(r["doc_id"], r["text"]) for r in documents.collect()], byte_tokenizer)
    assert made <= 1.02 * least


def test_best_fit_edge_cases(odd, empty, byte_tokenizer):
    assert bestfit.pack(empty, BYTES).collect() == []
    check_packing(bestfit.pack(odd, BYTES).collect(), [r[:2] for r in ODD_TEXTS], byte_tokenizer)


# --- operator 13 ---

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("base", T.StringType()), T.StructField("k", T.StringType()),
    T.StructField("seq", T.StringType()), T.StructField("depth", T.StringType())])


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], TURNS)


def trie_brute(rows, group=5, heads=9):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [t[2] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in convs.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        made[c] = tuple(own.get(c - c % group, [])[:h] + ts[h:])
    members = collections.defaultdict(list)
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    return collections.Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if made[c] == p))).encode()).hexdigest()) for p, m in members.items())


def nodes(df):
    return collections.Counter(tuple(r) for r in df.select(*turntrie.COLUMNS).collect())


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(queries.op13_conversation_trie(spark, DATA)) == trie_brute(rows)


def test_trie_over_many_ranges_with_hot_turns(many_ranges):
    """A third of the conversations are copies, nearly all open alike, some are prefixes of others."""
    rng = np.random.default_rng(4)
    rows = []
    for c in range(400):
        if c % 3 == 0:
            texts = ["hello", "hot", "hot", "hot"]
        else:
            texts = ["hello"] + [f"text {rng.integers(3)}" for _ in range(rng.integers(0, 9))]
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    assert nodes(turntrie.prefix_trie(turns(many_ranges, rows), stretch=7)) == trie_brute(rows)


def test_trie_edge_cases(many_ranges):
    assert turntrie.prefix_trie(turns(many_ranges, [])).collect() == []
    rows = [(None, 0, "user", "no conversation"), (5, None, "user", "before all"), (5, 0, None, None), (5, 0, "", ""),
            (6, 1, "user", "same"), (6, 1, "user", "same"), (6, 0, "a", "tie"), (6, 0, "b", "tie"), (7, 3, "user", "x" * 200_000),
            (8, 3, "user", "x" * 200_000), (9, 0, "ab", "c"), (14, 0, "a", "bc"), (19, 0, "user", "ÄÖ中"),
            *[(c, 0, "user", "alone") for c in range(100, 160)], *[(30, i, "user", str(i % 3)) for i in range(150)]]
    got = nodes(turntrie.prefix_trie(turns(many_ranges, rows)))
    assert got == trie_brute(rows)
    assert any(r[1] == 0 and r[3] == 68 for r in got)


@given(st.sets(st.binary(max_size=4).map(lambda b: b * 2), min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_radix_tree_holds_its_keys(keys):
    tree = turntrie.RadixTree()
    for k in keys:
        tree.insert(k, k)
    found, stack = set(), [(tree.root, b"")]
    while stack:
        node, path = stack.pop()
        path += node.prefix
        if node.value is not None:
            assert node.value == path
            found.add(path)
        kids = list(node.items())
        assert [b for b, _ in kids] == sorted({b for b, _ in kids}) and len(kids) <= node.places
        stack += [(kid, path + bytes([b])) for b, kid in kids]
    assert found == keys


@pytest.mark.parametrize("n, kind, places", [(4, "SmallNode", 4), (5, "SmallNode", 16), (17, "IndexedNode", 48), (49, "DirectNode", 256)])
def test_radix_nodes_grow(n, kind, places):
    tree = turntrie.RadixTree()
    for i in range(n):
        tree.insert(bytes([200 - i, 1]), i)
    assert type(tree.root).__name__ == kind and tree.root.places == places
    assert [node.value for _, node in tree.root.items()] == list(range(n - 1, -1, -1))
