"""Packing, whitening and token alignment against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import alignment, packing, whitening
from ledgerloom.llm.byte_bpe import byte_alphabet
from ledgerloom.llm.units import SPACE, WORD_END, StemIds, byte_level, check_pieces, cut, encode_units
from ledgerloom.llm.whitening import op12_whitening

ODD = [
    None, "", " ", "  ", "\n", "a", "a b", " a", "a  b", "a \nb\n\n c ", "x\t y z", "don't stop\n", "<|endoftext|> <s> </s> <unk> <0x0A>", "tab\tend \n", "　全角 文字 テスト", "emoji 🙂🙂🙃 é ﬁ",
    "▁ literal", "a▁b", "\x00nul \x1c \x85", "#" * 3000, "ab" * 5000, "word " * 4000, "\r\n windows\r\nlines", "12345 678 9,999.00", "ÀÉÎ naïve café", "a​b",
]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    own = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    return ODD + own + own[:5]


def model(path):
    t = Tokenizer.from_file(public_tokenizers.path(path))
    t.encode_special_tokens = True
    return t


def frame(spark, texts):
    rows = [(i if i else None, t, "x", 1, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, part int, uid string").repartition(3)


# packing ------------------------------------------------------------------------------------------------------
def test_units_join_to_their_text():
    for t in ODD:
        assert "".join(cut(t or "")) == (t or "")
    m = model(packing.VOCABULARY)
    units = [u for t in ODD for u in cut(t or "")]
    want = [m.encode(u, add_special_tokens=False).ids for u in units]
    sizes = np.array([len(t) for t in byte_level(public_tokenizers.path(packing.VOCABULARY))[1]])
    for chars in (1, 20, 1 << 16):
        assert [np.frombuffer(x, "<u4").tolist() for x in encode_units(units, lambda t: m.encode(t, add_special_tokens=False).ids, sizes, chars)] == want
    with pytest.raises(ValueError):
        check_pieces(["▁a", "a▁b"])


MARKED = [
    "word, word. word! word?! (word) word's, it's. 'word' don't, d'you", "\nword,\nword.\n", "word,", "Word$$$ 12, 12. 1.5, 12th;", "né, né. ñ? Ünü!", "ª, º. ×, ÷. ²; Ω, Ω. 語、語, 한, é, é. ٣, ٣.", "... , . ''' ?!", " word, ",
    "\n", "a,\n", "a \n b", "a\t b,", "word\t", "word\xa0", "word,\xa0x, \x1cx.", "a,\n\nb,  c. \n d;   ", "<|endoftext|>, <|endoftext|>. x<|endoftext|>",
]


def test_stems_give_whole_texts_ids(texts):
    m = model(packing.VOCABULARY)
    some = [*ODD, *MARKED, *(t + "," for t in ODD if t), *texts[-300:]]
    want = [m.encode(t or "", add_special_tokens=False).ids for t in some]
    sizes = np.array([len(t) for t in byte_level(public_tokenizers.path(packing.VOCABULARY))[1]])
    learn = lambda units: encode_units(units, lambda t: m.encode(t, add_special_tokens=False).ids, sizes)
    for remembered, rows in ((0, 1), (5, 3), (10**6, len(some))):
        ids = StemIds(learn, remembered)
        got = [x for lo in range(0, len(some), rows) for x in ids.of(pa.array(some[lo : lo + rows], pa.string()))]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert ids.of(pa.array([], pa.string())) == []


def test_words_are_learnt_once_whatever_marks_follow():
    learnt = Counter()

    def learn(units):
        learnt.update(units)
        return [u.encode() for u in units]

    ids = StemIds(learn, 4)
    lots = ['a house, house. house; "house" house\'s, house!', "house, and house?\nhouse,\nhouse.", "house. tree, tree"]
    assert [ids.of(pa.array([t])) for t in lots] == [[t.encode()] for t in lots]
    assert learnt[" house"] == learnt["\nhouse"] == learnt[" tree"] == 1
    assert not any(u.startswith((" house,", " house.", " house;", " house!", " house?", "\nhouse,")) for u in learnt)


def test_classes_for_arrow_are_those_of_python():
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    column = pa.array(chars)
    assert {c for c, x in zip(chars, pc.match_substring_regex(column, SPACE).to_pylist()) if x} == {c for c in chars if c.isspace()}
    ends = [c for c, x in zip(chars, pc.match_substring_regex(column, WORD_END).to_pylist()) if x]
    assert len(ends) == 124 and all(c.isalnum() for c in ends)


def test_lots_hold_every_row():
    batch = pa.record_batch({"i": list(range(7)), "t": ["abc", None, "", "x" * 50, "ab", "cd", "é" * 4]})
    for size in (1, 5, 12, 1000):
        lots = list(packing.lots(batch, 1, size))
        assert [x for lot in lots for x in lot.column(0).to_pylist()] == list(range(7)) and all(lot.num_rows for lot in lots)
        assert all(sum(len((t or "").encode()) for t in lot.column(1).to_pylist()[1:]) <= size for lot in lots)
    assert len(lots) == 1 and list(packing.lots(batch.slice(0, 0), 1)) == []


def test_pieces_and_places(spark, texts):
    docs = frame(spark, texts)
    packed = packing.pack(packing.pieces_of(docs, public_tokenizers.path(packing.VOCABULARY)))
    got = defaultdict(list)
    for r in packed.collect():
        got[r.doc_id].append(r)
    gpt, by_sequence = model(packing.VOCABULARY), defaultdict(list)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = [*gpt.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        rows = sorted(got[i or None], key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(-(-len(ids) // 1024)))
        assert [r.start for r in rows] == [0, *range((len(ids) - 1) % 1024 + 1, len(ids), 1024)]
        assert [x for r in rows for x in r.ids] == ids
        for r in rows:
            assert len(r.ids) == r.length <= 1024
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            by_sequence[r.sequence_id].append(r)
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))]
        assert sum(r.length for r in rows) <= 1024
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    assert {k: [x for r in rows for x in r.ids] for k, rows in by_sequence.items()} == {k: r.ids for k, r in whole.items()}
    assert packing.pack(packing.pieces_of(docs.limit(0), public_tokenizers.path(packing.VOCABULARY))).count() == 0


def brute_best_fit(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - x)
    return len(gaps)


def every_place(plan, histogram, capacity):
    held = defaultdict(set)
    for size, n in histogram.items():
        sequence, offset = plan.place(np.full(n, size), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            cells = set(range(o, o + size))
            assert not held[s] & cells
            held[s] |= cells
    assert all(len(c) == max(c) + 1 <= capacity for c in held.values())
    return len(held)


@pytest.mark.parametrize("seed, capacity, n, most", [(0, 64, 500, 64), (1, 64, 300, 20), (2, 100, 2000, 100), (3, 16, 50, 16), (4, 64, 1, 64), (5, 128, 400, 3)])
def test_plan_places_every_piece(seed, capacity, n, most):
    lengths = np.random.default_rng(seed).integers(1, most + 1, n)
    histogram = Counter(lengths.tolist())
    plan = packing.Plan(histogram, capacity)
    assert every_place(plan, histogram, capacity) == plan.sequences
    assert -(-int(lengths.sum()) // capacity) <= plan.sequences <= brute_best_fit(lengths.tolist(), capacity) * 1.02 + 1
    assert sum(n for _, n in packing.best_fit(histogram, capacity)) == brute_best_fit(lengths.tolist(), capacity)


def test_patterns_are_all_exact_ones():
    lengths = np.array([1, 2, 3, 5, 6])
    got = {tuple(sorted(lengths[p[p < 5]].tolist())) for p in packing.patterns(lengths, 8, 3, 0.0)}
    assert got == {(2, 6), (3, 5), (1, 1, 6), (1, 2, 5), (2, 3, 3)}
    assert packing.patterns(np.zeros(0, np.int64), 8).shape[1] == 3


def test_fit_reaches_what_patterns_can_make():
    """A histogram made of patterns is met, and most sequences of a large one come from the fit."""
    lengths = np.arange(1, 65)
    pats = packing.patterns(lengths, 64)
    x = np.random.default_rng(0).integers(0, 2000, len(pats)) * (np.random.default_rng(1).random(len(pats)) < 0.2)
    counts = np.zeros(65)
    np.add.at(counts, pats, np.broadcast_to(x[:, None], pats.shape))
    plan = packing.Plan(dict(zip(lengths.tolist(), counts[:64].astype(int).tolist())), 64)
    assert plan.sequences <= x.sum() * 1.003
    assert plan.fitted > 0.7 * plan.sequences


def test_plan_grows_with_the_capacity_not_the_counts():
    base = {k: 1000 + 7 * k for k in range(1, 129)}
    small, large = packing.Plan(base, 128), packing.Plan({k: n * 10**9 for k, n in base.items()}, 128)
    assert len(large.size) < 3 * len(small.size) + 1000
    assert large.sequences <= 1.01 * sum(n for _, n in packing.best_fit({k: n * 10**9 for k, n in base.items()}, 128))
    with pytest.raises(ValueError):
        packing.Plan({129: 1}, 128)


# whitening ----------------------------------------------------------------------------------------------------
def brute_whiten(vectors, k):
    x = [[int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    v = [[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3)) for j in range(d)] for i in range(d)]
    values, to = np.linalg.eigh(np.array(v))
    order = np.argsort(-values)[:k]
    centred = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(r, s)] for r in x])
    deviation = [sum((n * c - t) ** 2 for c, t in zip(r, s)) for r in x]
    return n, deviation, centred @ to[:, order] / np.sqrt(values[order]), values[order] / np.trace(np.array(v))


def check_whitened(got, vectors, k):
    n, deviation, whitened, explained = brute_whiten(vectors, k)
    assert [r.n for r in got] == [n] * len(vectors) and [r.deviation for r in got] == deviation
    w = np.array([r.whitened for r in got])
    sign = np.sign((w * whitened).sum(axis=0))
    assert np.abs(w * sign - whitened).max() < 1e-6
    assert np.abs(np.array([r.explained for r in got]) / explained - 1).max() < 1e-9
    assert all(r.identity_error < 1e-9 for r in got)


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(5)
    good = (rng.standard_normal((150, 40)) @ rng.standard_normal((40, 40)) / 6).astype(np.float32)
    good[7] = good[8]
    good[9, 3] = -900.5  # a wide dimension
    rows = [(i, v.tolist(), "a", 1) for i, v in enumerate(good)] + [(500, None, "a", 1), (501, [None] + [1.0] * 39, "a", 1), (502, [float("nan")] * 40, "a", 1), (503, [float("inf")] * 40, "a", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, dims int").repartition(3)
    got = sorted(whitening.whiten(df).collect(), key=lambda r: r.vec_id)
    assert [r.vec_id for r in got] == list(range(150))
    check_whitened(got, good, 32)
    assert whitening.whiten(df.limit(0)).count() == 0


def test_whitening_edges(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (None, [0.5, -4.0]), (2, [3.0, 5.0]), (5, [7.0]), (6, []), (7, [1e300, 1.0, 2.0]), (8, [-1e300, 5.0, 1.0]), (9, [1.0, 1.0, 1.0])]
    got = defaultdict(list)
    for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got[len(r.whitened)].append(r)
    assert len(got[2]) == 4 and {r.n for r in got[2]} == {4} and 0 not in got  # a fit for each length; an empty vector has no components
    assert [(r.whitened, r.explained, r.deviation) for r in got[1]] == [([None], [None], 0)]
    assert {r.vec_id: r.deviation is None for r in got[3]} == {7: True, 8: True, 9: False}  # over a long


def test_bit_slices_give_exact_products():
    rng = np.random.default_rng(0)
    for bits, rows in ((1, 1), (7, 130), (20, 65)):
        y = rng.integers(0, 1 << bits, (rows, 5))
        counts = whitening.product_counts(whitening.planes(y, bits))
        exact = (counts * (1 << np.arange(2 * bits - 1, dtype=object))).sum(axis=2)
        assert (np.triu(exact) == np.triu(y.astype(object).T @ y.astype(object))).all()


def test_op12_rows(spark, sf_dir):
    got = op12_whitening(spark, sf_dir)
    vectors = [np.array(r.embedding, np.float32) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(whitening.is_whole(F.col("embedding"))).orderBy("vec_id").collect()]
    assert got.count() == len(vectors) * min(32, len(vectors[0]))
    assert [c for c, _ in got.dtypes] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.agg(F.min("component"), F.max("component")).first()[:] == (1, 32)


# alignment ----------------------------------------------------------------------------------------------------
def brute_alignment(texts):
    gpt = model(alignment.A_FILE)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.B_FILE))
    back = {c: bytes([i]) for i, c in enumerate(byte_alphabet())}
    b_bytes = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    out, held = [], defaultdict(set)
    for d, t in enumerate(texts):
        ids = (gpt.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)) if t else ([], [])
        raw = [[b"".join(back[c] for c in gpt.id_to_token(i)) for i in ids[0]], [b_bytes(i) for i in ids[1]]]
        if not t or b"".join(raw[0]) != (" " + t).encode() or b"".join(raw[1]) != (" " + t).encode():
            ids, raw = ([], []), [[], []]
        ends = [np.cumsum([len(x) for x in r]).tolist() if r else [] for r in raw]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for c in cuts:
            upto = [e.index(c) + 1 for e in ends]
            groups.append(tuple(ids[k][at[k] : upto[k]] for k in (0, 1)))
            at = upto
        links = Counter()
        for x, y in groups:
            for (p, n), (q, m) in ((u, v) for u in Counter(x).items() for v in Counter(y).items()):
                links[p, q] += n * m
                held[p, q].add(d)
        out.append((ids, groups, links))
    best = defaultdict(int)
    for (p, _), who in held.items():
        best[p] = max(best[p], len(who))
    for ids, groups, links in out:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (
            len(ids[0]), len(ids[1]), len(groups), sum(links.values()), sum(n for k, n in links.items() if len(held[k]) == best[k[0]]),
            sum(n * len(held[k]) for k, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else "",
        )


@pytest.mark.parametrize("records, fan, slice_", [(1 << 20, 64, 8), (3000, 3, 2)])
def test_alignment_against_brute_force(spark, texts, monkeypatch, records, fan, slice_):
    monkeypatch.setattr(alignment, "FAN", fan)
    monkeypatch.setattr(alignment, "SLICE", slice_)
    docs = frame(spark, texts)
    out = alignment.align_corpus(docs, records=records)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(brute_alignment(texts)):
        r = got[i or None]
        sha = hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else ""
        assert sha == r.groups_sha256
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, sha) == want, texts[i]
    assert alignment.align_corpus(docs.limit(0)).count() == 0


def test_merge_of_runs():
    rng = np.random.default_rng(0)
    total, blobs = Counter(), []
    for n in (0, 1, 50, 3000, 3000, 7):
        keys = np.unique(rng.integers(0, 5000, n))
        counts = rng.integers(1, 1 << 40, len(keys))
        blobs.append(alignment.write_blocks(keys, counts, size=100))
        for k, c in zip(keys.tolist(), counts.tolist()):
            total[k] += c
    best = {}
    for k, c in total.items():
        best[k // 100] = max(best.get(k // 100, 0), c)
    got = [x for block in alignment.with_maxima(alignment.merge_runs(blobs), 100) for x in zip(*(c.tolist() for c in block))]
    assert got == [(k, c, int(c == best[k // 100])) for k, c in sorted(total.items())]


def test_long_stretches_are_counted_by_distinct_ids():
    both = alignment.aligner(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))
    a, b = next(i for i, x in enumerate(both.a_bytes) if x == b"xx"), next(i for i, x in enumerate(both.b_bytes) if x == b"x")
    a1 = next(i for i, x in enumerate(both.a_bytes) if x == b"x")
    text, numbers, codes, times = both.align([a1] + [a] * 1999 + [a1], [b] * 4000)
    assert numbers[3] == 1 + sum(2 for _ in range(1999)) + 1 and sum(times) == numbers[3]
    bb = next(i for i, x in enumerate(both.b_bytes) if x == b"xx")
    text, numbers, codes, times = both.align([a1] + [a] * 1999 + [a1], [bb] * 2000)
    assert numbers[2:] == (1, 2001 * 2000) and sorted(times) == [2 * 2000, 1999 * 2000]
