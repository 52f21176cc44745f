import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import byte_bpe, licenses, pages, quality, simhash, token_files, toxicity
from ledgerloom.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n string, fp long, h int, key string"
WORDS = [f"w{i}" for i in range(400)]


def texts():
    rng = np.random.default_rng(5)
    base = " ".join(rng.choice(WORDS, 300))
    odd = ["", None, " \n\t", "one", "one two", "Ünïcödé ß 日本語\nλίνε\x0bend", "a" * 3000, "x y " * 20000, base, base, base.upper(), base + " extra", base.replace("w1 ", "w2 ")]
    return odd + [" ".join(rng.choice(WORDS, int(k))) for k in rng.integers(1, 200, 60)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "s1", "s2"][i % 2], None, "clash", 7, 1, "k") for i, t in enumerate(texts())]
    rows += [(None, "null id here", "en", "s1", 1, None, None, None, None), rows[8], rows[8]]
    return spark.createDataFrame(rows, SCHEMA)


def empty(docs):
    return docs.limit(0)


# SimHash ----------------------------------------------------------------------------------------------------
def slow_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash_against_brute_force(docs):
    source = docs.collect()
    got = sorted(((r.doc_id is None, r.doc_id), r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs).collect())
    fps = [slow_fingerprint(r.text) for r in source]
    want = sorted(((r.doc_id is None, r.doc_id), f"{f:016x}", c) for r, f, c in zip(source, fps, brute_components(fps, [r.doc_id for r in source])))
    assert got == want
    assert simhash.simhash_groups(empty(docs)).count() == 0


@pytest.mark.parametrize("pairwise", [2, 64])
def test_golay_links_find_all_pairs(spark, pairwise):
    rng = np.random.default_rng(1)
    fps = {int(x) for x in rng.integers(0, 1 << 63, 300)}
    seed = list(fps)[:20]
    for f in seed:  # clusters of near fingerprints, some of them large
        for _ in range(30):
            g = f
            for b in rng.integers(0, 64, int(rng.integers(1, 4))):
                g ^= 1 << int(b)
            fps.add(g)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    from ledgerloom.llm.common import components, written

    df = written(spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, i long"))
    nodes = written(df.selectExpr("fp AS node", "i AS least"))
    got = {r.node: r.component for r in components(nodes, simhash.links(df, pairwise)).collect()}
    assert [got[x] for x in signed] == brute_components(fps, list(range(len(fps))))


def test_golay_tables():
    errors = simhash.golay_errors()
    sizes = (errors >= 0).sum(axis=1)
    assert sorted(set(sizes)) == [1, 6] and (sizes == 6).sum() == 1771


# tokens -----------------------------------------------------------------------------------------------------
def test_byte_bpe_is_the_reference_encoding(docs):
    path = public_tokenizers.path(byte_bpe.RANKS)
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(path))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = byte_bpe.digests(byte_bpe.encode_decode(docs, path, ["doc_id"])).collect()
    want = {}
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert len(out) == docs.count() and all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id] for r in out)
    assert byte_bpe.digests(byte_bpe.encode_decode(empty(docs), path, ["doc_id"])).count() == 0


def test_encoders_on_odd_text():
    rng = np.random.default_rng(2)
    alphabet = list(" \n\t'sdaltEé1,.!#*😀Σ́\x1c\xa0ªºß")
    odd = ["".join(rng.choice(alphabet, int(n))) for n in rng.integers(1, 40, 3000)]
    bpe = byte_bpe.ByteBpe(public_tokenizers.path(byte_bpe.RANKS))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.whole, special_tokens={})
    assert all(enc.encode_ordinary(t) == x.tolist() and bpe.decode(x) == t.encode() for t, x in zip(odd, bpe.encode(odd)))
    chunk = token_files.ChunkEncoder(public_tokenizers.path(token_files.VOCABULARY))
    odd += ["", " ab", "<|endoftext|> x"]
    assert all(chunk.model.encode(t, add_special_tokens=False).ids == np.frombuffer(x, chunk.kind).tolist() for t, x in zip(odd, chunk.encode(odd)))


def test_token_files(spark, docs):
    from ledgerloom.llm.common import scratch_dir

    path = public_tokenizers.path(token_files.VOCABULARY)
    folder = scratch_dir(spark)
    index = token_files.write_token_files(docs, path, folder, length=16)
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    by_id = {r.doc_id: r.text for r in docs.collect()}
    back = token_files.read_token_files(index, folder).orderBy("part", "at").collect()
    assert len(back) == docs.count()
    ids = [x.doc_id for x in back]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    streams, files = {}, {r.part: r.file for r in back}
    for r in back:
        want = np.array(model.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        assert bytes(r.ids_le32) == want.tobytes() and r.n_tokens == len(want) and r.at == len(streams.setdefault(r.part, []))
        streams[r.part] += want.tolist()
    for part, stream in streams.items():
        file = token_files.SequenceFile(f"{folder}/{files[part]}")
        for i in range(-(-len(stream) // 16)):
            got, mask = file.sequence(i)
            here = stream[16 * i : 16 * i + 16]
            assert got[: len(here)].tolist() == here and mask.tolist() == [k < len(here) for k in range(16)]
    assert token_files.write_token_files(empty(docs), path, scratch_dir(spark)).count() == 0


def test_equal_rows_are_dealt_to_many_parts(spark):
    from ledgerloom.llm.common import scratch_dir

    rows = [(7 if i % 3 == 0 else i, "same words" if i % 3 == 0 else f"words {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    index = token_files.write_token_files(df, public_tokenizers.path(token_files.VOCABULARY), scratch_dir(spark))
    sizes = [r.n for r in index.groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 2 * 6000 / 4


def test_other_tokenizers_encode_whole_texts(tmp_path):
    import json

    settings = json.load(open(public_tokenizers.path(token_files.VOCABULARY), encoding="utf-8"))
    assert token_files.may_cut(settings)
    del settings["normalizer"]["normalizers"][2]  # keeps capitals
    assert not token_files.may_cut(settings)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(settings))
    chunk = token_files.ChunkEncoder(str(path))
    texts = ["It's A Test, of 12 words.", "it's", ""]
    assert [np.frombuffer(x, chunk.kind).tolist() for x in chunk.encode([*texts, None])] == [chunk.model.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]


def test_token_query_starts(spark, sf_dir):
    rows = sorted(QUERIES["op7_token_files"](spark, sf_dir).collect())
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    r = rows[3]
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").where(f"doc_id = {r.doc_id}").first().text
    model = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    assert r.ids_crc32 == zlib.crc32(np.array(model.encode(text, add_special_tokens=False).ids + [1], "<u4").tobytes())


# quality ----------------------------------------------------------------------------------------------------
def slow_statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = {g for g in grams if grams.count(g) > 1} if len(grams) < 2000 else {g for g in set(grams)}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_statistics():
    rng = np.random.default_rng(4)
    cases = texts() + [" ".join(rng.choice(["a", "b", "c|"], 60)) + "\n" + "x y\n\nx y\n \nx y" for _ in range(20)]
    assert all(quality.statistics(t) == slow_statistics(t) for t in cases)


def test_quality_rules(spark, docs):
    verdicts = quality.quality_rules(docs).collect()
    assert len(verdicts) == docs.count()
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed) for r in verdicts)  # too few rows to estimate
    assert quality.quality_rules(empty(docs)).count() == 0
    rng = np.random.default_rng(3)
    good = [(i, " ".join(rng.choice(WORDS, int(n))), "en", "s") for i, n in enumerate(rng.integers(30, 300, 400))]
    bad = [(1000 + i, " ".join(f"{w}###" for w in rng.choice(WORDS, 80)), "en", "s") for i in range(40)]
    got = {r.doc_id: r.kept for r in quality.quality_rules(spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i, *_ in good) and not any(got[i] for i, *_ in bad)


@pytest.mark.parametrize("size", [1, 2, 4])
def test_duplicate_lines_are_outliers(spark, size):
    rng = np.random.default_rng(8)
    good = [(i, " ".join(rng.choice(WORDS, int(n))), "en", "s") for i, n in enumerate(rng.integers(100, 900, 300))]
    pool = [" ".join(WORDS[k * size : (k + 1) * size]) for k in range(60)]
    bad = [(1000 + i, "\n".join(rng.choice(pool, 800 // size + 60)), "en", "s") for i in range(5)]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i].base_failed or got[1000 + i].kept for i in range(5)) and all(got[i].kept for i, *_ in good)


def test_each_statistic_reaches_the_limit():
    most = {"z_lines": 100, "z_repeats": quality.REPEAT_PERCENT}
    assert all((np.log1p(n) / quality.VECTOR[z][1]) ** 2 > quality.chi2_quantile(1 - quality.TAIL, quality.P) for z, n in most.items())


def test_mcd_is_not_pulled_by_outliers(spark):
    from ledgerloom.llm.common import written

    rng = np.random.default_rng(9)
    clean = rng.multivariate_normal([5, 1.6, 0, 0, 0], np.diag([1, 0.01, 0.01, 0.01, 0.01]), 1000)
    rows = np.vstack([clean, rng.normal(20, 0.1, (250, 5))])
    df = written(spark.createDataFrame([("g", *map(float, r)) for r in rows], "g string, " + ", ".join(f"{c} double" for c in quality.COLUMNS)))
    centre = quality.covariance_estimates(df).first().centre
    assert np.abs(np.array(centre) - clean.mean(axis=0)).max() < 0.2


def test_mcd_against_all_subsets(spark):
    """Small groups: the determinant found is among the least hundredth of those of all subsets of the nearest share, and the least of
    all where there are plain outliers."""
    from itertools import combinations

    from ledgerloom.llm.common import written

    rng = np.random.default_rng(31)
    groups = {}
    for g in range(8):
        x = rng.normal(0, 1, (16, 5)) @ np.diag([2, 1, 1, 1, 1]) + g
        x[: g % 5] += rng.normal(9, 2, (g % 5, 5))
        groups[f"g{g}"] = x
    groups["ties"] = np.repeat(rng.normal(0, 1, (4, 5)), 4, axis=0)
    df = written(spark.createDataFrame([(g, *map(float, r)) for g, x in groups.items() for r in x], "g string, " + ", ".join(f"{c} double" for c in quality.COLUMNS)))
    got = {r.g: r for r in quality.concentrated(df).collect()}
    scale = quality.SHARE / quality.chi2_cdf(quality.chi2_quantile(quality.SHARE, 5), 7)
    subsets = np.array(list(combinations(range(16), 12)))
    for g, x in groups.items():
        some = x[subsets]
        some = some - some.mean(axis=1, keepdims=True)
        every = np.sort(np.linalg.slogdet(scale * some.transpose(0, 2, 1) @ some / 12 + quality.FLOOR)[1])
        # 4 outliers leave one subset; the four equal rows of "ties" lie at one distance, and are taken whole
        assert got[g].logdet <= every[len(every) // 100] + 1e-9 or g == "ties", (g, got[g].logdet, every[:3])
        assert g != "g4" or abs(got[g].logdet - every[0]) < 1e-9
    assert {r.start for r in got.values()} <= {0, 1, 2}


def test_verdict_against_brute_force(spark):
    """The verdict of each row from its distance to the estimate, worked out again; levels by number of rows."""
    rng = np.random.default_rng(32)
    rows = [(i, " ".join(rng.choice(WORDS, int(n))) + ("#" * 90 if i % 60 == 0 else ""), "en" if i % 5 else "de", ["s", "t", None][i % 3]) for i, n in enumerate(rng.integers(20, 400, 420))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = quality.quality_rules(df).collect()
    limit = quality.chi2_quantile(1 - quality.TAIL, quality.P)
    size = {}
    for _, _, lang, source in rows:
        size[lang, source] = size.get((lang, source), 0) + 1
    for r in out:
        many = size[r.lang, r.source] - sum(o.base_failed for o in out if (o.lang, o.source) == (r.lang, r.source)) >= quality.LEAST_ROWS
        if not r.base_failed:
            assert r.level == ("pair" if many else "all") and r.kept == (r.distance2 <= limit)
    assert {r.doc_id for r in out if not r.kept and not r.base_failed} == {i for i in range(420) if i % 60 == 0}
    again = {r.doc_id: r.distance2 for r in quality.quality_rules(df.repartition(7)).collect()}
    assert all(r.base_failed or abs(again[r.doc_id] - r.distance2) < 1e-6 * max(1, r.distance2) for r in out)


def test_chi_square():
    assert abs(quality.chi2_quantile(0.95, 5) - 11.0705) < 1e-3 and abs(quality.chi2_cdf(6.6257, 5) - 0.75) < 1e-4


# toxicity ---------------------------------------------------------------------------------------------------
def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.model_for(docs, labels.where("doc_id % 3 < 2"))
    assert np.all(np.diff(model.thresholds) > 0)
    held = docs.join(labels.where("doc_id % 3 = 2").withColumnRenamed("toxic", "label"), "doc_id")
    out = toxicity.score(held, model).join(held.select("doc_id", "label"), "doc_id").collect()
    hit = [r.toxic for r in out if r.label == 1]
    false = [r.toxic for r in out if r.label == 0]
    assert sum(hit) / len(hit) > 0.85 and sum(false) / len(false) < 0.01
    assert np.mean([r.severity for r in out if r.label == 1]) > 10 * np.mean([r.severity for r in out if r.label == 0])


def test_grades_are_ordered_on_held_out_rows(spark):
    """Severity on rows that the model hasn't seen rises with the odds that another model, fitted on yet other rows, gives them."""
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    one, two = (toxicity.model_for(docs, labels.where(f"doc_id % 5 IN {folds}")) for folds in ("(0, 1)", "(2, 3)"))
    held = docs.join(labels.where("doc_id % 5 = 4 AND toxic = 1").select("doc_id"), "doc_id").collect()
    find = [toxicity.Features(m.words) for m in (one, two)]
    a, b = (np.array([m.score(r.text, f)[0] for r in held]) for m, f in zip((one, two), find))
    rank = lambda v: np.argsort(np.argsort(v))
    assert len(held) > 30 and np.corrcoef(rank(a), rank(b))[0, 1] > 0.5
    assert toxicity.grades_of(np.array([0, 1, 1, 1, 1, 1, 1]), np.array([9.0, 1, 2, 3, 4, 5, 6])).tolist() == [0, 1, 1, 2, 2, 3, 3]


def test_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(8, 1), (8, 0), (9, 0), (None, 1), (999, 1), (12, None), (11, 3)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, labels).count() == docs.count()
    none = toxicity.toxicity(docs, labels.limit(0))
    assert none.where("toxic").count() == 0 and toxicity.toxicity(empty(docs), labels).count() == 0


def test_toxicity_sample_bounds_rows(spark, monkeypatch):
    rows = [(1, f"same id {i % 3}") for i in range(300)] + [(i, f"text {i}") for i in range(2, 30)] + [(30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 9)) for i in range(1, 31)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "train", lambda labelled: labelled.collect())
    got = toxicity.model_for(docs, labels)
    assert sorted((r.doc_id, r.toxic) for r in got) == [(i, int(i < 9)) for i in range(1, 31)]
    assert set(got) == set(toxicity.model_for(docs.repartition(5), labels))
    assert len(toxicity.model_for(docs, labels, 10)) == 10


def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=3000)
    grade = np.digitize(2 * x + rng.logistic(size=3000), [-1, 1, 3])
    w, t = toxicity.fit_ordinal(np.arange(3000), np.zeros(3000, int), x, 1, grade, 4)
    assert abs(w[0] - 2) < 0.3 and np.abs(t - [-1, 1, 3]).max() < 0.4


# licences ---------------------------------------------------------------------------------------------------
def test_licenses(spark, docs):
    mit = licenses.KNOWN[1][1]
    variants = [
        mit.replace("MIT License\n", "MIT License\n\nCopyright (c) 2020 Jane Doe\n© 2021 Others. All rights reserved.\n"),
        mit.upper().replace("LICENSE", "LICENCE").replace(",", " ;"),
        " * " + mit.replace("\n", "\n * "),
        mit + " More.",
        "Title\n  Licensed under the Apache License, Version 2.0\nText",
        None,
        "",
    ]
    df = spark.createDataFrame(list(enumerate(variants)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_scan(df).collect()}
    assert [got[i].license_id for i in range(7)] == ["MIT", "MIT", "MIT", None, None, None, None]
    assert got[4].notices == "Apache-2.0" and got[4].has_license and not got[5].has_license and got[5].text_digest == got[6].text_digest
    assert licenses.license_scan(empty(docs)).count() == 0 and licenses.license_scan(docs).count() == docs.count()
    plan = licenses.license_scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_copyright_lines_and_headers(spark):
    mit = licenses.KNOWN[0][1]
    lines = ["Copyright Jane Doe", "Copyright, 2020 X\nAll rights reserved.\nCopyright (c) Y", "(c) 2019 Z\n(C) Copyright W", "Portions copyright <who>", "© Q. All rights reserved."]
    later = licenses.NOTICES[9][1].replace("and/or", "and/or\n   ")
    rows = [*(f"{x}\n\n{mit}" for x in lines), mit.replace("copies or substantial", "copies or\nsubstantial"), "A\n\n" + later + "\n\nB", "# SPDX-License-Identifier: MPL-2.0", "x", "copyright notice", *("license " * 300_000, None)]
    got = [(r.license_id, r.notices) for r in licenses.license_scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [x for x, _ in got[:6]] == ["MIT"] * 6 and got[6] == (None, licenses.NOTICES[9][0]) and got[7] == ("MPL-2.0", "MPL-2.0") and got[8:] == [(None, "")] * 4
    from oracle import compare

    import duckdb

    view = duckdb.connect()
    view.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    view.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t in enumerate(rows) if not t or len(t) < 100_000])
    compare(licenses.license_scan(spark.createDataFrame([(i, t) for i, t in enumerate(rows) if not t or len(t) < 100_000], "doc_id long, text string")), view, ORACLE_SQL["op4_licenses"])


def test_digests_of_long_licenses(spark):
    import os

    if not os.path.isdir("/usr/share/common-licenses"):
        pytest.skip("no licence texts on this machine")
    found = {r.known_digest for r in licenses.digest_files(spark, "file:///usr/share/common-licenses").collect()}
    assert len(set(d for _, d in licenses.DIGESTS)) == len(licenses.DIGESTS) and {d for _, d in licenses.DIGESTS} <= found


def test_licenses_agree_with_sql(spark, sf_dir):
    from oracle import compare, views

    compare(QUERIES["op4_licenses"](spark, sf_dir), views(sf_dir), ORACLE_SQL["op4_licenses"])


# pages ------------------------------------------------------------------------------------------------------
def slow_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_lines():
    rng = np.random.default_rng(7)
    for _ in range(300):
        a, b = (rng.integers(0, 6, int(rng.integers(0, 30))).tolist() for _ in range(2))
        i, j = pages.common_lines(a, b)
        assert [a[k] for k in i] == [b[k] for k in j] and len(i) == slow_lcs(a, b) and i == sorted(set(i)) and j == sorted(set(j))
    a, b = ([int(x) for x in rng.integers(0, 40, 9000)] for _ in range(2))
    i, j = pages.common_lines(a, b)  # halved
    assert [a[k] for k in i] == [b[k] for k in j] and len(i) == len(pages.common_lines(b, a)[0])


PAGE = """<html><head><title>T</title><script>var a='</p>'</script></head><body><header>Site</header><div class="cookie-notice">We use cookies</div>
<main><h1>Head &amp; tail</h1><div class="share-bar">Share</div><p>One <b>bo</b>ld &lt;x&gt;\n para.<p>Two<br>lines</p><form>Search</form>
<section id="comments"><p>Nice!</p></section></main><aside>Side</aside><footer>F</footer></body></html>"""


def alone(html):
    """Text of a page of which only its own markup is known."""
    page = pages.Page(html)
    return " ".join(t for t, r in zip(page.lines, page.regions()) if pages.BELIEF[r.partition(":")[0]] < 0.5)


def test_page_zones():
    assert alone(PAGE) == "Head & tail One bold <x> para. Two lines"
    assert alone('<div class=menu><ul><li>a<li>b</ul></div><p class="notice">N<p>Real<ul><li class=ad>x<li>y</ul><p>end') == "Real y end"
    assert alone("<nav>menu<article><p>Text</article>") == "Text"
    assert alone("<article><header><h1>Head</h1></header><p>Text<footer>by</footer></article>") == "Head Text"
    assert alone("<main><p>Text<section id=comments><article>Hi</article></section></main>") == "Text"
    assert alone("<table><tr><td>a<td>b<tr><td><ul><li>c<li>d</ul></table></div></b><p>e") == "a b c d e"


def test_articles_lose_no_text_to_markup():
    assert alone('<p>One <svg class="i" title="a>b"/> two</p><p>Three</p><svg><text>no</text></svg>') == "One two Three"
    assert alone("<p>So <math><mi>x</mi> = <mn>2</mn></math> and <math/> on <object>or so</object></p>") == "So x = 2 and on or so"
    inside = '<p class="market-share">A</p><section class="related-work"><p>B</p></section><p class="notice">C</p><div class="social-science">D</div><p class="social-history">E'
    assert alone(f"<article>{inside}<div class='x share-bar'>no</div><section id=comments>no</section></article>") == "A B C D E"


def test_differencing_against_brute_force(spark):
    rng = np.random.default_rng(12)
    site, n = [], 70
    for i in range(n):  # lines in one order, so that the common subsequence is the intersection
        standing = [k for k in range(12) if rng.random() < 0.7]
        site.append([f"line {k}" for k in standing[:6]] + [f"own {i} {k}" for k in range(int(rng.integers(0, 4)))] + [f"line {k}" for k in standing[6:]])
    site[20] = site[19]
    site[33] = [f"line {k}" for k in range(12)]
    rows = [(i, f"http://a.example/{i:03d}", "".join(f"<p>{x}" for x in lines)) for i, lines in enumerate(site)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), span=8).collect()}
    unlike = [i for i in range(n) if site[i] not in site[:i]]
    for at, i in enumerate(unlike):
        copy = lambda j: set(site[i]) <= set(site[j]) or set(site[j]) <= set(site[i])
        right = [j for j in unlike[at + 1 : at + 9] if not copy(j)]
        left = [j for j in unlike[max(0, at - 8) : at][::-1] if not copy(j)]
        two = [left[0], right[0]] if left and right else (left + right)[:2]
        want = [x for x in site[i] if not two or not all(x in site[j] for j in two)]
        assert got[i] == " ".join(want), i
    assert got[20] == got[19]


def test_differencing_alone_finds_articles(spark):
    """The given pages with the names of their elements and classes blanked: only the alignments can tell."""
    import html

    given = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    blank = F.col("html")
    for old, new in (("<nav>", "<div class=ka>"), ("</nav>", "</div>"), ('<div class="ad">', "<div class=kb>"), ("<article>", "<div class=kc>"), ("</article>", "</div>"), ("<footer>", "<div class=kd>"), ("</footer>", "</div>")):
        blank = F.replace(blank, F.lit(old), F.lit(new))
    want = {}
    for r in given.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want[r.page_id] = " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", body))).split())
    right = lambda align: sum(r.text == want[r.page_id] for r in pages.main_text(given.withColumn("html", blank), align).collect())
    assert right(True) > 0.95 * len(want) and right(False) == 0


def test_boxes_of_changing_text(spark):
    """An advert whose text changes goes, because its like are template elsewhere; a very long page is compared too."""
    page = lambda i: f"<body><div class=x>Buy {i // 2}</div><div class=y><p>{'Long ' * (50000 if i == 3 else 50)} story {i}.</p><p>End {i}</p></div><div class=x2>{'Tel ' * 3}</div></body>"
    rows = [(i, f"http://h{i // 40}.example/{i:03d}", page(i)) for i in range(120)]
    out = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == 120 and all(r.text == " ".join(f"{'Long ' * (50000 if r.page_id == 3 else 50)} story {r.page_id}. End {r.page_id}".split()) for r in out)


def test_neighbours_remove_templates(spark):
    page = lambda i: f"<body><div>Our shop</div><p>Story {i} about {i * 7}.</p><p>It ends {i}.</p><div>Call us: {'1' * 9}</div><div>Terms</div></body>"
    rows = [(i, f"http://a.example/x/{i:03d}?q={i}", page(i)) for i in range(19)] + [(50, "https://A.example/x/001.html#top", page(1)), (60, None, None), (61, None, ""), (62, "http://alone.example/", page(3)), (None, "http://a.example/zz", "<p>broken <b"), (0, "http://a.example/x/000?q=0", page(0))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string")
    out = pages.main_text(df).collect()
    got = {}
    for r in out:
        got.setdefault(r.page_id, r)
        assert r.n_chars == len(r.text)
    assert len(out) == len(rows) and all(got[i].text == f"Story {i} about {i * 7}. It ends {i}." for i in range(19) if i not in (0, 1))
    assert got[60].text == got[61].text == "" and got[62].text.startswith("Our shop Story 3")
    assert pages.main_text(df.limit(0)).count() == 0


def test_copies_and_large_templates(spark):
    big = "".join(f"<div>{'menu ' * 20}{k}</div>" for k in range(9))  # 0.8 and more of each page
    page = lambda i: f"<body>{big}<p>Story {i} about {i * 7}.</p><div>Terms</div></body>"
    rows = [(i, f"http://a.example/x/{i:03d}", page(i)) for i in range(12)]
    rows += [(100 + i, f"http://b.example/y/{i:03d}", page(i // 20)) for i in range(60)]  # runs of copies longer than a group
    rows += [(200 + i, f"http://c.example/{i}", f"<p>Long {'tale ' * 90}</p><p>Seen {i}</p>" if i < 2 else f"<p>Other {i}</p>") for i in range(6)]
    out = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert all(got[i] == f"Story {i} about {i * 7}." for i in range(12))
    assert all(got[100 + i] == f"Story {i // 20} about {i // 20 * 7}." for i in range(60))
    assert all(got[200 + i].startswith("Long tale") for i in range(2))  # near copies keep their text


def test_alignments_decide_and_markup_settles_the_rest(spark):
    """On the given pages nearly all text is judged by alignments; tags hold where they show the opposite, and judge a lone page."""
    given = pages.main_text(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))
    assert given.agg(F.sum("aligned_chars") / F.sum(F.col("aligned_chars") + F.col("marked_chars"))).first()[0] > 0.95
    # near copies that share their articles, and a menu of changing words: the tags hold
    page = lambda i: f"<nav><ul><li>Go {i % 5}</li><li>To {i % 7}</li><li>Home</li></ul></nav><article><p>{'Same story. ' * 30}</p><p>Seen {i} times.</p></article>"
    rows = [(i, f"http://a.example/{i:03d}", page(i)) for i in range(300)] + [(1000, "http://b.example/", "<nav>menu</nav><article>Text</article>")]
    out = {r.page_id: r for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i].text == f"{'Same story. ' * 30}Seen {i} times." for i in range(300))
    assert out[1000].text == "Text"


def test_pages_query_keeps_articles(spark, sf_dir):
    import html

    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op1_main_text"](spark, sf_dir).collect():
        body = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", body))).split())
