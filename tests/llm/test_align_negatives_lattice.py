"""Token alignment, hard negatives and the subword lattice against brute force."""

import hashlib
import itertools
import math
import re
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stocktide.llm import align, lattice, negatives
from stocktide.llm.tokens import read_text

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "a", "  a  b\n\n c <|endoftext|> d", "<s> </s> <0x41>", "don't I'LL 12 3,4 ... é́ \U0001f600 漢字 \x1c b \x85c",
    "a▁b and so on", "x" * 5000, "thtion and " * 900, "and the thing", "and the thing", "A thing AND the", "\ta\vb\x0c\r",
]
SCHEMA = "doc_id long, text string, links string, row long, pair long, held_out string, rest string, `odd.name` int"


def documents(spark):
    rows = [*enumerate(ODD), (None, "no id"), (None, None), (3, "a"), (3, "a")]
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", "z", 3) for i, t in rows], SCHEMA), rows


# --- alignment


@pytest.fixture(scope="module")
def aligner():
    with open(B, "rb") as f:
        return align.Aligner(read_text(A), f.read())


def overlaps(aligner, text):
    """Ids of both sides, the groups' text and all overlapping pairs, token by token."""
    ids = aligner.encode(text) if text else None
    if ids is None:
        return [], [], "", []
    sides, spans = [i.tolist() for i in ids], []
    for side, lengths in zip(sides, (aligner.a_length, aligner.b_length)):
        ends = np.cumsum([lengths[i] for i in side]).tolist()
        spans.append(list(zip([0, *ends], ends)))
    common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, low = [], 0
    for high in common:
        groups.append("|".join(",".join(str(i) for i, (_, e) in zip(side, span) if low < e <= high) for side, span in zip(sides, spans)))
        low = high
    links = [(a, b) for a, (s, e) in zip(sides[0], spans[0]) for b, (t, u) in zip(sides[1], spans[1]) if s < u and t < e]
    return *sides, ";".join(groups), links


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab thenion' \n\t.é▁<s>1"), st.characters(codec="utf-8")), max_size=30))
def test_chunks_align_as_whole_texts(aligner, text):
    n_a, n_b, n_groups, groups, pairs, times, _ = aligner.texts([text])
    a, b, want, links = overlaps(aligner, text)
    assert (n_a[0], n_b[0], n_groups[0], groups[0]) == (len(a), len(b), want.count(";") + bool(want), want)
    assert {(p >> 20, p & 0xFFFFF): n for p, n in zip(pairs.tolist(), times.tolist())} == Counter(links)


def test_token_bytes_are_those_of_the_texts(aligner):
    text = " the thing é漢"
    a, b = aligner.encode(text[1:])
    assert b"".join(aligner.a_bytes[i] for i in a).decode() == text == b"".join(aligner.b_bytes[i] for i in b).decode()


def expected_links(aligner, rows):
    found = [overlaps(aligner, t) for _, t in rows]
    counts = Counter(pair for *_, links in found for pair in set(links))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    return Counter(
        (i, len(a), len(b), g.count(";") + bool(g), hashlib.sha256(g.encode()).hexdigest() if g else "", len(links),
         sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links))
        for (i, _), (a, b, g, links) in zip(rows, found)
    )


@pytest.mark.parametrize("hot", [1 << 18, 5, 0])
def test_link_counts_of_odd_rows(spark, aligner, hot):
    docs, rows = documents(spark)
    found = align.with_link_counts(align.aligned(docs, A, B, digest=True), hot)
    assert Counter(tuple(r) for r in found.collect()) == expected_links(aligner, rows)


def test_alignment_of_an_empty_table_and_plain_groups(spark):
    docs, _ = documents(spark)
    empty = align.aligned(docs.limit(0), A, B)
    assert empty.collect() == [] and align.with_link_counts(empty).collect() == []
    one = align.aligned(docs.filter("doc_id = 10"), A, B).first()
    assert re.fullmatch(r"(\d+,)*\d+\|(\d+,)*\d+(;(\d+,)*\d+\|(\d+,)*\d+)*", one["groups"]) and one["links"]


def test_alignment_query(spark, sf_dir, aligner):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = align.op11_align(spark, sf_dir).select(
        "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"
    )
    some = {i for i, t in rows if len(t or "") < 2500}
    want = expected_links_fast(aligner, rows)
    assert {tuple(r) for r in found.collect() if r[0] in some} == {w for w in want if w[0] in some}


def expected_links_fast(aligner, rows):
    """As ``expected_links``; overlaps by walking both sides once, for whole tables."""
    every, counts = [], Counter()
    for i, t in rows:
        ids = aligner.encode(t) if t else None
        a, b = (x.tolist() for x in ids) if ids else ([], [])
        links, groups, x, y, at_a, at_b, part = [], [], 0, 0, 0, 0, ([], [])
        while x < len(a) and y < len(b):
            links.append((a[x], b[y]))
            end_a, end_b = at_a + aligner.a_length[a[x]], at_b + aligner.b_length[b[y]]
            if end_a <= end_b:
                part[0].append(str(a[x]))
                x, at_a = x + 1, end_a
            if end_b <= end_a:
                part[1].append(str(b[y]))
                y, at_b = y + 1, end_b
            if end_a == end_b:
                groups.append(",".join(part[0]) + "|" + ",".join(part[1]))
                part = ([], [])
        counts.update(set(links))
        every.append((i, a, b, groups, links))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    return {
        (i, len(a), len(b), len(g), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "", len(links),
         sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links))
        for i, a, b, g, links in every
    }


# --- hard negatives


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 150), st.sampled_from([3, 255, 10**5, 10**8]))
def test_residues_give_the_exact_product(seed, width, most):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-most, most + 1, (n, width)) for n in (5, 7))
    a[0], b[0] = most, -most
    gemm = negatives.ResidueGemm(a, width * most * most)
    assert (gemm.scores(slice(None), gemm.residues(b)) == a @ b.T).all()


def test_primes_are_few_and_enough():
    assert negatives.primes(64 * 256 * 256) == [1021, 1019, 1013]
    with pytest.raises(ValueError):
        negatives.primes(10**2000)


def brute_negatives(rows, every, positives=5, n=3):
    """rows: (id, vector, label) that take part, labels as given."""
    last = 2**70
    found = []
    for a, (i, v, label) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = [(-sum(x * y for x, y in itertools.zip_longest(v, w, fillvalue=0)), last if j is None else j, j, m, k) for k, (j, w, m) in enumerate(rows) if k != a]
        near = sorted((s, o, k, j) for s, o, j, m, k in scored if m == label)[:positives]
        for s, _, _, j in near:
            p = -s
            hard = sorted((t, o, k, g) for t, o, g, m, k in scored if m != label and 50 * p <= -100 * t <= 95 * p)[:n]
            found += [(i, j, r + 1, g, p, -t) for r, (t, _, _, g) in enumerate(hard)]
    return Counter(found)


VECTORS = "vec_id long, embedding array<float>, label int, id string, row string, vector int, slot int"


@pytest.mark.parametrize("chunk", [1 << 14, 3])
def test_negatives_of_odd_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(negatives, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.integers(-3, 4, 6) / 4).tolist(), int(rng.integers(0, 3))) for i in rng.permutation(120)]
    rows += [rows[0], rows[7], (10, rows[3][1], 1), (None, [1.0] * 6, 1), (130, [0.5, 0.5], 2), (140, [], 0), (150, [-1.0] * 6, 0)]
    taken = [(i, [math.floor(256 * x) for x in v], m) for i, v, m in rows]
    rows += [(160, None, 1), (170, [1.0] * 6, None), (180, [1.0, None], 1), (190, [float("nan")] * 6, 1), (200, [float("inf")] * 6, 1), (210, [3e38] * 6, 1)]
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], VECTORS).repartition(3)
    found = negatives.hard_negatives(df, "id % 10 = 0").collect()
    # equal rows are interchangeable, so ties between them leave the same values
    assert Counter(tuple(r) for r in found) == brute_negatives(taken, 10)
    assert found and negatives.hard_negatives(df.limit(0)).collect() == []
    assert negatives.hard_negatives(df.filter("label IS NULL")).collect() == []


def test_negatives_query(spark, sf_dir):
    duckdb.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = duckdb.execute(negatives.OP12_SQL).fetchall()
    found = negatives.op12_hard_negatives(spark, sf_dir)
    assert sorted(tuple(r) for r in found.collect()) == sorted(want) and want


# --- lattice


@pytest.fixture(scope="module")
def pieces():
    with open(B, "rb") as f:
        return lattice.vocabulary(f.read())


def test_vocabulary_holds_every_byte_and_sums_to_one(pieces):
    names, weights = pieces
    assert set(names) >= {bytes([i]) for i in range(256)} and len(set(names)) == len(names)
    assert weights.sum() == pytest.approx(1) and not any(b" " in p[1:] for p in names)
    assert dict(zip(names, weights))[b" the"] > dict(zip(names, weights))[b" there"]


def segmentations(word, weight):
    """Sum over all ways to cut a word, and the expected count of each piece, by enumeration."""
    total, expected = 0.0, Counter()
    for cuts in itertools.product([False, True], repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[i:j] for i, j in zip(at, at[1:])]
        p = math.prod(weight.get(x, 0.0) for x in parts)
        total += p
        for x in parts:
            expected[x] += p
    return total, {x: n / total for x, n in expected.items() if n}


def test_sums_are_those_of_all_segmentations(pieces):
    names, weights = pieces
    weight, found = dict(zip(names, weights)), lattice.Lattice(*pieces)
    words = [w.encode() for w in ("a", "the", "there", "ñandú", "xyzzy", "漢", "12,3")]
    want = [segmentations(b" " + w, weight) for w in words]
    assert found.log10(words) == pytest.approx([math.log10(p) for p, _ in want])
    times = np.arange(1, len(words) + 1)
    expected = Counter()
    for (_, counts), n in zip(want, times):
        expected.update({x: n * c for x, c in counts.items()})
    got = found.expected(words, times)
    assert got == pytest.approx([expected[x] for x in names])


def test_matches_are_read_as_numbers(pieces):
    found = lattice.Lattice(*pieces)
    words = [f"{i:x}thanticoil".encode() for i in range(20_000)]
    tracemalloc.start()
    start, *_ = found.edges(words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 * len(start)  # a pair of Python numbers a match took over 100 bytes


def test_long_words_and_batches_do_not_matter(pieces):
    found = lattice.Lattice(*pieces)
    words = [b"q" * 3000, b"the", b"x" * 20, b"the"]
    parts = list(lattice.bounded(words))
    assert sorted(itertools.chain.from_iterable(parts)) == [0, 1, 2, 3]
    alone = [found.log10([w])[0] for w in words]
    assert found.log10(words) == pytest.approx(alone) and alone[1] == alone[3]


LOWER = str.maketrans(lattice.UPPER, lattice.LOWER)


def words_by_pattern(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aAZzÀİ \t\n\x0b\x0c\r\x1c\x85\u2003"), st.characters(codec="utf-8")), max_size=40))
def test_words_are_those_of_the_pattern(text):
    assert [w.decode() for w in lattice.split_words(text)] == words_by_pattern(text)


def brute_scores(spark_weights, names, rows, held_out):
    weights, end = spark_weights
    split = [words_by_pattern(t) for _, t in rows]
    train = Counter(itertools.chain.from_iterable([*w, None] for w, h in zip(split, held_out) if not h))
    n, v = sum(train.values()), len(train)
    base = lambda w: math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1)))
    found = lattice.Lattice(names, weights)
    known = {w: found.log10([w.encode()])[0] for w in set(itertools.chain.from_iterable(split))}
    return [
        (i, h, len(w) + 1, sum(train[x] > 0 for x in [*w, None]), n, sum(map(base, [*w, None])), sum(known[x] for x in w) + math.log10(end))
        for (i, _), w, h in zip(rows, split, held_out)
    ]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) if not isinstance(x, float) else (True, round(x, 6)) for x in r))


@pytest.mark.parametrize("hot", [1 << 17, 3, 0])
def test_scores_of_odd_rows(spark, monkeypatch, hot):
    docs, rows = documents(spark)
    fits = []
    fitted = lattice.fitted
    monkeypatch.setattr(lattice, "fitted", lambda *a, **k: fits.append((a[1], fitted(*a, **k))) or fits[-1][1])
    found = lattice.lattice_scores(docs, B, F.col("doc_id") % 3 == 1, hot_words=hot).collect()
    names, weights = fits[0]
    held = [i is not None and i % 3 == 1 for i, _ in rows]
    for got, want in zip(order(map(tuple, found)), order(brute_scores(weights, names, rows, held)), strict=True):
        assert got[:5] == want[:5] and got[5:] == pytest.approx(want[5:])


def test_scores_without_training_rows_or_rows(spark):
    docs, rows = documents(spark)
    assert lattice.lattice_scores(docs.limit(0), B, F.lit(False)).collect() == []
    found = lattice.lattice_scores(docs, B, F.lit(True)).collect()
    assert len(found) == len(rows) and all(r.train_tokens == r.n_known == 0 and math.isfinite(r.score) and r.score < 0 for r in found)


def test_fitting_raises_the_probability_of_held_out_texts(spark, sf_dir, pieces):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = lattice.op13_lattice(spark, sf_dir)
    got = {r.doc_id: r for r in scored.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = [i for i in texts if zlib.crc32(str(i).encode()) % 5 == 1]
    assert sorted(i for i, r in got.items() if r.held_out) == sorted(held) and len(got) == len(texts)
    plain = lattice.Lattice(*pieces)
    unfitted = sum(plain.log10([w.encode() for w in words_by_pattern(texts[i]) or ["a"]]).sum() for i in held)
    assert sum(got[i].score for i in held) > 0.95 * unfitted  # both negative: nearer to zero
    train = [i for i in texts if i not in set(held)]
    n = sum(len(words_by_pattern(texts[i])) + 1 for i in train)
    assert {r.train_tokens for r in got.values()} == {n}
