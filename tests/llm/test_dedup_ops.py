"""Exact, near and repeated-string dedup, packing, chat formatting and the pipeline against brute force."""

import hashlib
import random
import sys
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stocktide.llm import chat, components, exact_dedup, hot, packing, registry, simhash, suffix_dedup
from stocktide.storage import staged

DOCS = "doc_id long, text string, sha string, key long, row string, n_chars int"
WORDS = P.path("word_bpe_49k.json")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in any column, empty and long texts, ties, repeated rows, columns whose names clash with internal ones."""
    long = " ".join(f"w{i}" for i in range(8000))
    texts = ["same text here", "Same TEXT here", None, "", "É", "é", long, long, "only once", "same text here", "x"]
    rows = [(i, t, "s", None, None, None) for i, t in enumerate(texts)] + [(None, "same text here", None, 1, "r", 2), (None, "alone", None, None, None, 1)]
    rows += [(4, "É", "s", None, None, None)] * 2 + [(50, "twice the winner", None, None, None, None)] * 2
    return spark.createDataFrame(rows, DOCS), rows


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[lowered(t)].append(i)
    top = {k: max((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return Counter((i, top[lowered(t)], len(groups[lowered(t)]), i == top[lowered(t)], hashlib.sha256(lowered(t).encode()).hexdigest()) for i, t, *_ in rows)


@pytest.mark.parametrize("max_bits", [1 << 15, 1 << 30])
def test_exact_dedup_of_odd_rows(odd, max_bits):
    docs, rows = odd
    assert Counter(map(tuple, exact_dedup.exact_dedup(docs, max_bits=max_bits).collect())) == brute_exact(rows)
    stays = exact_dedup.without_copies(docs, max_bits=max_bits)
    assert stays.columns == docs.columns
    assert Counter(map(tuple, stays.collect())) == Counter({r for r in rows if (r[0], r[1]) in {(i, r[1]) for i, *_, k, _ in brute_exact([r for r in rows]) if k} and r[0] == max(
        (i for i, t, *_ in rows if lowered(t) == lowered(r[1]) and i is not None), default=None)})


def test_exact_dedup_with_a_full_filter(spark):
    """Far more rows than bits: every row may be repeated, the result is the same."""
    rows = [(i, f"text {i % 30000}", None, None, None, None) for i in range(36000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = exact_dedup.exact_dedup(docs, max_bits=1 << 15).collect()
    assert Counter(map(tuple, found)) == brute_exact(rows)
    assert exact_dedup.exact_dedup(docs.limit(0)).collect() == [] == exact_dedup.without_copies(docs.limit(0)).collect()


def test_main_paths_without_python(spark, sf_dir):
    for query in ("op9_chat_format", "op10_exact_dedup"):
        plan = registry.QUERIES[query](spark, sf_dir)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("query", sorted(registry.SQL))
def test_queries_equal_their_sql(spark, sf_dir, query):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.execute(registry.SQL[query])
    names = [d[0] for d in want.description]
    found = registry.QUERIES[query](spark, sf_dir)
    assert sorted(map(tuple, found.select(names).collect())) == sorted(want.fetchall())


def test_spread_join_and_apart(spark):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 3000 + [2] * 5 + [3])] + [(None, -1)], "k long, v int")
    groups = spark.createDataFrame([(1, 3000, "a"), (2, 5, "b")], "k long, n long, name string")
    found = hot.spread_join(rows, groups, "k", "n", 3007).groupBy("k", "n", "name").count().collect()
    assert {tuple(r) for r in found} == {(1, 3000, "a", 3000), (2, 5, "b", 5), (3, None, None, 1), (None, None, None, 1)}
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "d"), (None, "e")], "id long, key string")
    listed = spark.createDataFrame([(1, False), (2, True), (None, False)], "key long, stays boolean")
    for bits in (1 << 15, 1 << 30):
        assert sorted(map(tuple, hot.apart(docs, "id", listed, bits).collect())) == [(2, "b"), (3, "c")]


# SimHash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, radius=3):
    top = {v: v for v in values}

    def find(v):
        while top[v] != v:
            v = top[v]
        return v

    for a, b in combinations(sorted(set(values)), 2):
        if (a ^ b).bit_count() <= radius:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB é\x0b\x1c\n", max_size=60))
def test_fingerprints(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_fingerprint(text)


def clustered(n, seed=5):
    """Dense clusters around a few centres, and strangers."""
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(4)]
    out = {r.getrandbits(64) for _ in range(n // 2)}
    while len(out) < n:
        v = r.choice(centres)
        for _ in range(r.randrange(1, 6)):
            v ^= 1 << r.randrange(64)
        out.add(v)
    return sorted(out)


def same_partition(found, want):
    seen = {}
    return all(seen.setdefault(want[v], found[v]) == found[v] for v in want) and len(set(found.values())) == len(set(want.values()))


@pytest.mark.parametrize("chosen", [None, [0, 2], [2, 0], [1, 1], [0, -1, 2], [1, 0, 0], [0, 0, 0, 0]])
@pytest.mark.parametrize("largest_key", [16, 8192])
def test_links_connect_all_pairs(spark, monkeypatch, chosen, largest_key):
    values = clustered(500)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    if chosen:
        monkeypatch.setattr(simhash, "plan", lambda counts, radius: (simhash.grouped_bits(counts, len(chosen)), chosen))
    elif largest_key == 16:
        pytest.skip("as with four parts")
    links = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.fingerprint_links(fps, largest_key=largest_key).collect()]
    top = {v: v for v in values}

    def find(v):
        while top[v] != v:
            v = top[v]
        return v

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    assert same_partition({v: find(v) for v in values}, brute_components(values))


def test_plan_is_cheapest_and_valid(spark):
    values = np.array(clustered(400), np.uint64)
    counts = simhash.bit_counts(spark.createDataFrame([(v,) for v in values.view(np.int64).tolist()], "fp long"))
    bits = (values[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(int)
    assert (counts[:64] == bits.T @ bits).all() and counts[64, 0] == 400
    for scale in (1, 10**4, 10**8):
        groups, chosen = simhash.plan(counts * scale)
        assert sorted(b for g in groups for b in g) == list(range(64)) and sum(chosen) == 3 - len(groups) + 1
    assert len(simhash.plan(counts * 10**8)[0]) < len(simhash.plan(counts)[0])


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101 + i) for i in range(30)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    found = {x["node"]: x["component"] for x in components.components(spark.createDataFrame([*links, (5, 5), (None, 7)], "a long, b long")).collect()}
    top = {v: v for e in links for v in e if e[0] != e[1]}
    for _ in top:
        for a, b in links:
            if a != b:
                top[a] = top[b] = min(top[a], top[b])
    assert found == top


def test_simhash_of_odd_rows(spark, odd):
    docs, rows = odd
    found = simhash.simhash_components(docs).collect()
    fp = {t: brute_fingerprint(t) for _, t, *_ in rows}
    comp = brute_components(fp.values())
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[comp[fp[t]]] = min(first.get(comp[fp[t]], i), i)
    want = Counter((i, fp[t], first.get(comp[fp[t]])) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in found) == want
    stays = simhash.without_near_copies(docs)
    assert stays.columns == docs.columns and simhash.simhash_components(docs.limit(0)).collect() == []
    assert Counter(r["doc_id"] for r in stays.collect()) == Counter({i for i, _, c in want if i == c})
    assert simhash.without_near_copies(docs.limit(0)).collect() == []


def test_near_copies_of_rows_without_an_id_or_with_one_id_on_several_texts(spark):
    """Whole rows: each component keeps its one winner, also where many rows share an id."""
    r = random.Random(8)
    make = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(30))
    shared, twins, alone, same_id = make(), make(), [make() for _ in range(5)], [make() for _ in range(3)]
    rows = [(1, shared, "a"), (None, shared.upper(), "b"), (7, shared, "c")]
    rows += [(None, t, "d") for t in alone] + [(5, t, "e") for t in same_id] + [(None, twins, "f"), (None, twins.upper(), "f")]
    rows += [(6, same_id[0].upper(), "g"), (8, alone[0].upper(), "h"), (None, None, "i"), (9, "", "j"), (None, "", "k")]
    rows += [(4, alone[1].upper(), v) for v in "xyz"]
    fp = {t: brute_fingerprint(t) for _, t, _ in rows}
    comp, winners = brute_components(fp.values()), {}
    for row in rows:
        i, t, _ = row
        digest = b"" if t is None else hashlib.md5(t.encode()).digest()
        rank = (i is None, i or 0, fp[t] - (1 << 64) * (fp[t] >> 63), digest)
        winners.setdefault(comp[fp[t]], {}).setdefault(rank, set()).add(row)
    assert len(winners) == 11
    docs = spark.createDataFrame(rows, "doc_id long, text string, v string")
    found = [tuple(x) for x in simhash.without_near_copies(docs).collect()]
    assert len(found) == len(winners)
    assert all(len([x for x in found if x in ranked[min(ranked)]]) == 1 for ranked in winners.values())
    again = simhash.without_near_copies(docs.orderBy(F.rand(3)).repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(str(tuple(x)) for x in again)


def test_simhash_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fp = {i: brute_fingerprint(t) for i, t in texts.items()}
    comp = brute_components(fp.values())
    first = defaultdict(lambda: 1 << 62)
    for i, v in fp.items():
        first[comp[v]] = min(first[comp[v]], i)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op8_simhash(spark, sf_dir).collect()}
    assert found == {i: (f"{v:016x}", first[comp[v]]) for i, v in fp.items()}


# Repeated strings


def brute_repeats(texts, length):
    counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def passages(seed):
    r = random.Random(seed)
    make = lambda n, letters="abcdefgh ": "".join(r.choice(letters) for _ in range(n))
    passage = make(1500)
    rows = []
    for i in range(40):
        a = r.randrange(1200)
        rows.append((i, make(r.randrange(300)) + passage[a:a + r.randrange(150, 420)] + make(r.randrange(300))))
    rows += [(100, "a" * 900), (101, "ab" * 300), (102, None), (103, ""), (None, "é" * 300 + passage[:250]), (104, passage), (104, passage)]
    rows += [(105, "xyz " * 60 + make(20) + "xyz " * 55), (106, passage[:200]), (107, passage[:199])]
    return rows


@pytest.mark.parametrize("length,reach", [(200, 160), (20, 16), (30, 10)])
def test_repeated_strings(spark, length, reach):
    rows = passages(length)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    found = suffix_dedup.repeated_bytes(docs, length, reach).collect()
    want = brute_repeats([(t or "").encode() for _, t in rows], length)
    assert Counter(map(tuple, found)) == Counter((i, *w) for (i, _), w in zip(rows, want))


def test_repeated_strings_with_a_full_filter(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "bits_for", lambda rows, max_bits: 1 << 15)
    rows = passages(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.repeated_bytes(docs, 20, 16, max_bits=64).collect()
    want = brute_repeats([(t or "").encode() for _, t in rows], 20)
    assert Counter(map(tuple, found)) == Counter((i, *w) for (i, _), w in zip(rows, want))


def test_repeated_strings_across_parts(spark, monkeypatch):
    """Texts longer than a part: the same strings at other places of the parts."""
    r = random.Random(9)
    make = lambda n: "".join(r.choice("abcd") for _ in range(n))
    shared = make(3000)
    rows = [(1, make(777) + shared + make(400)), (2, make(5000) + shared[500:2500]), (3, make(2000))]
    texts = [t.encode() for _, t in rows]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1024)
    runs = list(suffix_dedup.runs(texts))
    monkeypatch.undo()
    positions = Counter((int(t), p) for x in runs for t, a, b in zip(x.text, x.first, x.last) for p in range(a, b + 1))
    assert positions == Counter((i, p) for i, t in enumerate(texts) for p in range(len(t) - 199))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.repeated_bytes(docs).collect()
    assert Counter(map(tuple, found)) == Counter((i, *w) for (i, _), w in zip(rows, brute_repeats(texts, 200)))


def test_texts_without_repeated_strings(spark, odd):
    docs, rows = odd
    left = suffix_dedup.without_repeated_strings(docs)
    found = left.collect()
    assert left.columns == docs.columns and len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[6]["text"] == by_id[7]["text"] == "" and by_id[6]["n_chars"] == 0 and by_id[8]["text"] == "only once" and by_id[2]["text"] is None
    empty = docs.limit(0)
    assert suffix_dedup.without_repeated_strings(empty).collect() == [] == suffix_dedup.repeated_bytes(empty).collect()
    part = "é" * 150
    rows = [(1, "è" + part + "x", 3), (2, "a" + part + "y", 3), (3, "z", 1)]
    found = suffix_dedup.without_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()
    assert {tuple(r) for r in found} == {(1, "èx", 2), (2, "ay", 2), (3, "z", 1)}


def test_texts_of_one_id_with_one_32_bit_hash(spark):
    r = random.Random(6)
    body = "".join(r.choice("abcdefgh ") for _ in range(600))
    rows = [(None, f"{2437:08d}{body}"), (None, f"{152445:08d} stays"), (1, body[100:500])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert docs.filter("doc_id IS NULL").select(F.hash("text")).distinct().count() == 1
    found = suffix_dedup.repeated_bytes(docs).collect()
    assert Counter(map(tuple, found)) == Counter((i, *w) for (i, _), w in zip(rows, brute_repeats([t.encode() for _, t in rows], 200)))
    left = {tuple(x) for x in suffix_dedup.without_repeated_strings(docs).collect()}
    assert left == {(None, f"{2437:08d}{body[:100]}{body[500:]}"), (None, f"{152445:08d} stays"), (1, "")}


@pytest.mark.parametrize("named", [True, False])
def test_one_copy_of_a_repeated_text_goes_on(spark, monkeypatch, named):
    r = random.Random(4)
    make = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    shared, copied = make(205), make(150)
    rows = [(i if named else None, t) for i, t in enumerate([copied + shared + "the end of the copies" * 9] * 200)]
    rows += [(1000, make(100) + shared + make(90)), (1001, make(50) + copied[40:] + shared + make(20))]
    most, plain = [], suffix_dedup._first_parts

    def counted(*a):
        out = staged(plain(*a))
        most.append(out.groupBy("parent", "core", "cover", "low").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(suffix_dedup, "_first_parts", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = suffix_dedup.repeated_bytes(docs).collect()
    want = brute_repeats([t.encode() for _, t in rows], 200)
    assert Counter(map(tuple, found)) == Counter((i, *w) for (i, _), w in zip(rows, want))
    assert most and most[0] <= (1 if named else 4)


def test_suffix_dedup_query(spark, sf_dir):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.op6_suffix_dedup(spark, sf_dir).collect()}
    assert found == {i: w for (i, _), w in zip(rows, brute_repeats([t for _, t in rows], 200))}


# Packing


def fewest(lengths, capacity):
    """The least number of sequences, by trying all."""
    best = len(lengths)
    lengths = sorted(lengths, reverse=True)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_an_optimum(lengths):
    fixed, rest = packing.reduced(Counter(lengths), 20)
    left = [n for n, c in rest.items() for _ in range(c)]
    assert sum(t for _, t in fixed) + fewest(left, 20) == fewest(lengths, 20)
    plan = fixed + packing.best_fit(rest, 20)
    got = Counter()
    for filling, times in plan:
        assert sum(n * k for n, k in filling) <= 20 and times > 0
        for n, k in filling:
            got[n] += k * times
    assert got == Counter(lengths)


def best_fit_one_by_one(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=200))
def test_best_fit_over_counts(lengths):
    assert sum(t for _, t in packing.best_fit(Counter(lengths), 50)) == best_fit_one_by_one(lengths, 50)


def check_packing(rows, found, capacity=4096):
    tokenizer = Tokenizer.from_file(WORDS)
    want = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_of_odd_rows_and_documents(spark, odd, sf_dir, monkeypatch):
    docs, rows = odd
    check_packing([r[:2] for r in rows], packing.best_fit_packing(docs, WORDS).collect())
    assert packing.best_fit_packing(docs.limit(0), WORDS).collect() == []
    monkeypatch.setattr(packing, "RANKED", 10)  # many parts of a length
    check_packing([r[:2] for r in rows], packing.best_fit_packing(docs, WORDS, 512).collect(), 512)
    monkeypatch.undo()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = packing.op3_best_fit_packing(spark, sf_dir).collect()
    assert check_packing(rows, found) <= 1.02 * -(-sum(r["length"] for r in found) // 4096) + 1


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aBT' sé\n1.ÄΣİ’"), st.characters(codec="utf-8")), max_size=40))
def test_word_ids_as_the_library(text):
    words = word_ids()
    assert words.encode(text) == np.array(words.library(text), "<u4").tobytes()


def test_word_ids_merge_letters_once():
    words = packing.WordIds(open(WORDS, encoding="utf-8").read())

    class Counted:
        model, n = words.model, 0

        def tokenize(self, piece):
            self.n += 1
            return self.model.tokenize(piece)

    words.model = counted = Counted()
    for text in ("thanticoil", "Thanticoil, hatior,", "thanticoil. reeuxré, hatior."):
        assert words.encode(text) == np.array(words.library(text), "<u4").tobytes()
    assert counted.n <= 6  # thanticoil, hatior twice, reeuxré and two marks; every piece of the different words before, 11
    odd = "a\x00, b\x7f. c's, d'. e_. f1, g--h; rock'n'roll!! it's' x\x01\x02 'tis, ³. ª, ª! don't.), (y). [z] 12, é\x7f, ß..., İ. ŉ!"
    assert words.encode(odd) == np.array(words.library(odd), "<u4").tobytes()


def word_ids(made=[]):  # noqa: B006 one tokenizer for all examples
    if not made:
        made.append(packing.WordIds(open(WORDS, encoding="utf-8").read()))
    return made[0]


# Chat formatting


def test_reply_trees(spark):
    rows = [
        ("t", 1, None, "user", "a </turn> \\ b", 1.0, None), ("t", 2, 1, "assistant", "x<turn>", 5.0, None), ("t", 3, 1, "assistant", None, 1.0, None),
        ("t", 4, 2, "user", "<text>\\t\n", None, None), ("t", 5, 3, None, "", 2.0, None), ("u", 7, 99, "assistant", "é😀", 0.0, None), ("u", 8, 7, "user", "q", 0.0, None),
    ]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double, formatted string")
    made = chat.chat_format(messages)
    read = made.select("tree", "leaf", chat.parsed(made["formatted"]).alias("turns"), chat.loss_text(made["formatted"], made["loss_spans"]).alias("loss"))
    found = {(r["tree"], r["leaf"]): ([tuple(t) for t in r["turns"]], r["loss"]) for r in read.collect()}
    assert found == {
        ("t", 4): ([("user", "a </turn> \\ b"), ("assistant", "x<turn>"), ("user", "<text>\\t\n")], "x<turn>"),
        ("t", 5): ([("user", "a </turn> \\ b"), ("assistant", ""), ("", "")], ""),
        ("u", 8): ([("assistant", "é😀"), ("user", "q")], "é😀"),
    }
    best = chat.chat_format(messages, 1).collect()
    assert {(r["tree"], r["leaf"]) for r in best} == {("t", 4), ("u", 8)}  # means 2.0 and 4/3
    assert chat.chat_format(messages.limit(0)).collect() == []


def test_branches_are_ranked_without_a_limit(spark):
    rows = [("t", 1, None, 0.0), ("t", 2, 1, 1.0), ("t", 3, 1, 5.0), ("t", 4, 1, 1.0), ("t", 5, 1, None), ("u", 1, None, None)]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, score double").selectExpr("*", "'user' AS role", "'x' AS text")
    want = {("t", 3, 1), ("t", 2, 2), ("t", 4, 3), ("t", 5, 4), ("u", 1, 1)}
    for branches in (None, 2):
        found = chat.chat_format(messages, branches).select("tree", "leaf", "branch").collect()
        assert {tuple(r) for r in found} == {w for w in want if w[2] <= (branches or 9)} and len(found) == (5 if branches is None else 3)


def test_long_chains(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"m{t}") for t in range(300)] + [(None, 1, "user", "x"), (2, None, None, None), (2, None, None, None)]
    made = chat.chat_format(chat.chains(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")))
    found = {r["tree"]: [t["text"] for t in r["turns"]] for r in made.select("tree", chat.parsed(made["formatted"]).alias("turns")).collect()}
    assert found == {1: [f"m{t}" for t in range(300)], 2: ["", ""], None: ["x"]}


def test_reply_trees_are_not_broadcast(spark, monkeypatch):
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(chat, "staged", lambda df, staged=chat.staged: (plans.append(plan(df)), staged(df))[1])
    rows = [("t", i, i - 1, 0.0, "user", "x") for i in range(9)]
    messages = chat.staged(spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string"))
    for branches in (None, 1):
        made = chat.chat_format(messages, branches)
        assert made.count() == 1
        plans.append(plan(made))
    # by (tree, node), each join would set aside up to 64 MB on the driver and every executor for these nine rows
    assert plans and not any("Broadcast" in p for p in plans)
    assert sum(p.count("SortMergeJoin") for p in plans) == 2 * (2 + 4 + 3) + 1  # one join a round


# Pipeline


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at, columns = docs, docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, sf_dir)
        rows = at.collect()
        at = spark.createDataFrame(rows, at.schema)
        kept[name] = rows
        if name != "packing":
            assert at.columns == columns
    clean = {r["doc_id"]: r["text"] for r in kept["toxicity"]}
    top = {}
    for i, t in clean.items():
        top[lowered(t)] = max(top.get(lowered(t), i), i)
    assert {r["doc_id"] for r in kept["exact_dedup"]} == set(top.values())
    fp = {i: brute_fingerprint(clean[i]) for i in top.values()}
    comp, first = brute_components(fp.values()), {}
    for i, v in fp.items():
        first[comp[v]] = min(first.get(comp[v], i), i)
    assert {r["doc_id"] for r in kept["near_dedup"]} == set(first.values())
    ids = sorted(first.values())
    want = brute_repeats([clean[i].encode() for i in ids], 200)
    left = {r["doc_id"]: r["text"] for r in kept["suffix_dedup"]}
    assert sorted(left) == ids and all(0 <= len(left[i].encode()) - (n - gone) <= 6 * runs for i, (n, gone, runs, _) in zip(ids, want))
    check_packing(list(left.items()), kept["packing"])
    total = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert total == Counter(r["doc_id"] for r in kept["packing"])


def test_packing_remembers_a_bounded_amount_of_words():
    words = packing.WordIds(open(WORDS, encoding="utf-8").read())
    texts = [" ".join(f"w{i:06x}" for i in range(a, a + 10_000)) for a in range(0, 700_000, 10_000)]
    found = [words.encode(t) for t in texts]
    held = sys.getsizeof(words.known) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in words.known.items())
    assert held < 100 << 20
    # emptying the memory changes no ids
    assert found[0] == words.encode(texts[0]) == np.array(words.library(texts[0]), "<u4").tobytes()


def test_packing_keeps_the_words_in_use_when_others_go(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 1_000)
    words, looked_up = packing.WordIds(open(WORDS, encoding="utf-8").read()), Counter()
    merged = words.merged
    words.merged = lambda word: looked_up.update([word]) or merged(word)
    texts = ["often " + " ".join(f"w{i:06x}" for i in range(a, a + 100)) for a in range(0, 5_000, 100)]
    for text in texts:
        assert words.encode(text) == np.array(words.library(text), "<u4").tobytes()
    assert looked_up["often"] == 1
    assert len(words.known) <= 1_000
