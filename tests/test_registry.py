"""CSV to Parquet to document, in the shapes of the registry with invented values."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.documents import entity_documents, entity_rows
from ledgerloom.operators.quality import conformance_report
from ledgerloom.operators.shards import shard_index, verify_shards
from ledgerloom.sources import readers, schemas, writers

EST = ["12ABC345", "0001", "90", "1", "LOJA; DO \"ZÉ\"", "2", "20200131", "00", "", "", "20190615", "4711301", "4711302,4712100", "RUA", "DAS FLORES", "10", "", "CENTRO", "01310100", "SP", "7107", "11", "40028922", "", "", "11", "40020000", "ze@ex.com", "", ""]


def line(values):
    return ";".join('"' + v.replace('"', '""') + '"' for v in values) + "\r\n"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("registry")
    other = ["99000111", "0001", "55", "3", "", "77", "0", "00", "", "", "junk", "", "", "", "", "", "", "", "", "RJ", "9999", "", "", "", "", "", "", "", "", ""]
    files = {
        "K1.ESTABELE": [EST, other, ["too", "short"]],
        "K1.EMPRECSV": [["12ABC345", "ZÉ & FILHOS", "2062", "49", "1000,00", "01", ""]],
        "K1.SOCIOCSV": [["12ABC345", "2", "MARIA", "***123456**", "49", "20190615", "", "", "", "", "4"], ["12ABC345", "9", "ANA", "", "99", "x", "", "", "", "", "z"]],
        "K1.SIMPLES.CSV": [["12ABC345", "S", "20190701", "", "N", "00000000", ""]],
        "K1.NATJUCSV": [["2062", "Sociedade Limitada"]],
        "K1.MUNICCSV": [["7107", "SÃO PAULO"]],
        "K1.QUALSCSV": [["49", "Sócio-Administrador"]],
    }
    for name, rows in files.items():
        (folder / name).write_bytes("".join(map(line, rows)).encode("cp1252"))
    found = readers.discover_tables(spark, str(folder))
    assert found["empresa"] and found["natureza"] and not found["cnae"]
    out = {}
    for t, there in found.items():
        df = readers.read_registry_csv(spark, str(folder), t) if there else readers.empty_like(spark, schemas.registry_schema(t))
        target = str(tmp_path_factory.mktemp("parquet") / t)
        if t in schemas.PARTITIONED:
            assert writers.write_partitioned(df, target, "cnpj_basico", 3)
            assert not writers.write_partitioned(df, target, "cnpj_basico", 3, skip_existing=True)
            out[t] = readers.read_partitioned(spark, target, schemas.registry_schema(t))
        else:
            writers.write_lookup(df, target)
            writers.write_lookup(df, target, "ignore")
            out[t] = readers.load_lookups(spark, {t: target})[t]
    return out


def test_csv(tables):
    assert tables["estabelecimento"].count() == 2
    r = tables["estabelecimento"].where("cnpj_prefix = '12A'").first()
    assert r.nome_fantasia == 'LOJA; DO "ZÉ"' and r.ddd2 is None and dict(tables["estabelecimento"].dtypes)["cnpj_prefix"] == "string"


def test_documents(tables):
    docs = {r.key: json.loads(r.value) for r in entity_documents(tables).collect()}
    d = docs["12ABC345000190"]
    assert (d["razao_social"], d["situacao_cadastral"], d["data_situacao_cadastral"], d["matriz_filial"]) == ("ZÉ & FILHOS", "Ativa", "2020-01-31", "Matriz")
    assert d["cnaes_secundarios"] == ["4711302", "4712100"] and d["municipio"] == "SÃO PAULO" and d["porte_empresa"] == "Microempresa (ME)"
    assert d["telefones"] == [{"ddd": "11", "numero": "40028922", "is_fax": False}, {"ddd": "11", "numero": "40020000", "is_fax": True}]
    assert [p["nome_socio"] for p in d["QSA"]] == ["ANA", "MARIA"] and d["QSA"][1]["qualificacao_socio"] == "Sócio-Administrador" and d["QSA"][1]["faixa_etaria"] == "31 a 40 anos"
    other = docs["99000111000155"]
    assert other["QSA"] == [] and other["telefones"] == [] and other["situacao_cadastral"] == "77" and other["data_inicio_atividade"] == "junk" and other["razao_social"] == ""
    assert list(d)[:2] == ["cnpj", "razao_social"] and list(d)[-1] == "QSA" and len(d) == 27


def test_scopes_prune_partitions(tables):
    one = entity_documents(tables, keys=["12ABC345000190"])
    assert [r.key for r in one.collect()] == ["12ABC345000190"]
    assert "PartitionFilters: [isnotnull(cnpj_prefix" in one._jdf.queryExecution().executedPlan().toString()
    assert entity_documents(tables, prefixes=["990"]).count() == 1 and entity_documents(tables, prefixes=["000"]).count() == 0


def test_conformance(tables):
    report = {r.rule: r.n for r in conformance_report(entity_rows(tables), root="document").collect()}
    assert report == {"data_inicio_atividade:pattern": 1, "data_situacao_cadastral:pattern": 1, "QSA[].data_entrada_sociedade:pattern": 1}


def test_shards_are_byte_exact(spark, tables, tmp_path):
    docs = entity_documents(tables)
    writers.write_shards(docs, str(tmp_path / "s"))
    index = shard_index(docs)
    for r in index.collect():
        (file,) = (tmp_path / "s" / f"prefix={r.prefix}").glob("part-*.txt")
        raw = file.read_bytes()[r.offset : r.offset + r.length]
        assert raw.endswith(b"\n") and json.loads(raw)["cnpj"] == r.key
    assert verify_shards(index, docs).count() == 0
    assert {r.fault for r in verify_shards(index.where("prefix = '12A'"), docs, counts=docs.groupBy("prefix").count().withColumnRenamed("count", "records")).collect()} == {"wrong_count"}
    with pytest.raises(Exception, match="wrong length"):
        shard_index(docs.selectExpr("prefix", "concat(key, '0') AS key", "value")).collect()


def test_offsets_and_checks_across_stretches(spark):
    """Against a plain walk over each shard: many stretches and spans, one value after another, null prefix."""
    import random

    from ledgerloom.operators.relational import running_offsets

    draw = random.Random(5)
    rows = [(p, f"{k:05d}", "é" * draw.randrange(4)) for p in ("a", "b", None) for k in draw.sample(range(100000), 200)]
    docs = spark.createDataFrame(rows, "prefix string, key string, value string").repartition(3)
    want = set()
    for p in ("a", "b", None):
        at = 0
        for i, (_, k, v) in enumerate(sorted((r for r in rows if r[0] == p), key=lambda r: r[1])):
            want.add((p, k, i, at, len(v.encode()) + 1))
            at += len(v.encode()) + 1
    for stretch in (0, 1, 2, 9):
        index = running_offsets(docs, stretch=stretch)
        assert set(map(tuple, index.collect())) == want and index.columns == ["prefix", "key", "ordinal", "offset", "length"]
    assert [index.schema[c].dataType.simpleString() for c in index.columns] == ["string", "string", "int", "bigint", "int"]
    # faults at the first line of a span are seen from the last of the span before
    keys = {(p, i): k for p, k, i, _, _ in want}
    bad = [(p, keys[p, 15] if p == "a" and i == 16 else k, i, at + (3 if p == "b" and i >= 32 else 0), n) for p, k, i, at, n in want]
    spoilt = spark.createDataFrame(bad, index.schema)
    for span in (1, 16, 1000):
        assert verify_shards(index, span=span).count() == 0
        assert {tuple(r) for r in verify_shards(spoilt, span=span).collect()} == {("duplicate", "a", keys["a", 15]), ("gap", "b", keys["b", 32])}


def test_bucketed_tables_join_without_exchange(spark, tables):
    """The documents of bucketed tables are the same, and only the code tables (broadcast here, as Spark would by their size) move."""
    from pyspark.sql.functions import broadcast

    big = {t: broadcast(df) for t, df in tables.items() if t not in schemas.PARTITIONED}
    for t in ("estabelecimento", "empresa", "simples", "socio"):
        writers.write_bucketed(tables[t].drop("cnpj_prefix"), f"bucketed_{t}", "cnpj_basico", 4)
        big[t] = spark.table(f"bucketed_{t}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        docs = entity_documents(big)
        plan = docs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 3 and "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, entity_documents(tables).collect()))


def test_regenerated_documents_equal_all_made_anew(spark, tables):
    from ledgerloom.operators.incremental import changed_companies, regenerate

    text = lambda t, **put: tables[t].select(*[F.lit(put[c]).alias(c) if c in put else F.col(c) for c in tables[t].columns])
    cases = {
        "none": {},
        "company": {"empresa": text("empresa", capital_social="1,00")},
        "partner gone": {"socio": tables["socio"].where("nome_socio <> 'ANA'")},
        "same rows twice": {"socio": tables["socio"].unionByName(tables["socio"])},
        "code": {"municipio": text("municipio", descricao="S PAULO")},
        "branch gone": {"estabelecimento": tables["estabelecimento"].where("cnpj_basico <> '99000111'")},
    }
    touched = {"none": set(), "branch gone": {"990"}}
    before = entity_documents(tables)
    for name, put in cases.items():
        new = tables | put
        docs, prefixes = regenerate(before, tables, new)
        assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, entity_documents(new).collect())), name
        assert {r[0] for r in prefixes.collect()} == touched.get(name, {"12A"}), name
    assert changed_companies(tables, tables).isEmpty()


def test_compressed_documents_and_their_artifacts(spark, tables, tmp_path):
    import hashlib

    from ledgerloom.operators.shards import file_artifacts, release_totals, shard_counts, upload_targets

    docs = entity_documents(tables)
    writers.write_documents(docs, str(tmp_path / "z"))
    found = {r.path.rsplit("/", 1)[1]: (r.bytes, r.md5) for r in file_artifacts(spark, str(tmp_path / "z"), "*.gz").collect()}
    want = {p.name: (p.stat().st_size, hashlib.md5(p.read_bytes()).hexdigest()) for p in (tmp_path / "z").glob("*.gz")}
    assert found == want and found
    assert readers.read_documents(spark, str(tmp_path / "z"), "cnpj string").count() == docs.count()
    assert tuple(release_totals(shard_counts(shard_index(docs))).first()) == (2, 2)
    assert [r.file for r in upload_targets(docs.select("prefix")).collect()] == ["12A.index", "12A.ndjson", "990.index", "990.ndjson"]


def test_publish_flag(spark):
    from ledgerloom.operators.changes import any_publish

    rows = spark.createDataFrame([("a", False), ("b", True)], "module string, publish boolean")
    assert any_publish(rows).first().publish and not any_publish(rows.limit(0)).first().publish


def test_missing_period_is_an_error(spark):
    months = spark.createDataFrame([("2024-01",), ("2024-02",), ("x",)], "period string")
    assert readers.select_period(months, "2024-01").first().selected == "2024-01" and readers.select_period(months).first().selected == "2024-02"
    with pytest.raises(Exception, match="2023-12 is not there"):
        readers.select_period(months, "2023-12").collect()


def test_one_document_is_exported(spark, tables, tmp_path):
    from ledgerloom.operators.documents import export_document

    export_document(tables, "12ABC345000190", str(tmp_path / "one"))
    assert json.loads(spark.read.text(str(tmp_path / "one")).first()[0])["cnpj"] == "12ABC345000190"
    with pytest.raises(ValueError, match="no document"):
        export_document(tables, "00000000000000", str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_state_follows_publication(spark, tmp_path):
    rows = spark.createDataFrame([("cno", "1", "h")], "module string, cnpj string, content_hash string")

    def fail():
        raise RuntimeError("upload failed")

    with pytest.raises(RuntimeError):
        writers.commit_state(fail, rows, str(tmp_path), "1")
    assert readers.read_state(spark, f"{tmp_path}/version=1").isEmpty()
    assert readers.read_state(spark, writers.commit_state(lambda: None, rows, str(tmp_path), "1")).count() == 1


def test_enabled_modules():
    from ledgerloom.operators.modules import WorksModule, enabled_modules

    found = enabled_modules({"rntrc": {"enabled": False}, "cno": {"refresh_hours": 2.0}})
    assert list(found) == ["cno"] and found["cno"].descriptor.refresh_hours == 2.0 and WorksModule.descriptor.refresh_hours == 24.0
    with pytest.raises(ValueError, match="unknown modules: x"):
        enabled_modules({"x": {}})
    with pytest.raises(ValueError, match="share"):
        enabled_modules({}, (WorksModule, WorksModule))


def test_shard_faults_in_documents(spark, tables):
    docs = entity_documents(tables)
    index = shard_index(docs)
    wrong = docs.selectExpr("prefix", "key", "replace(value, key, '99999999999999') AS value")
    assert {r.fault for r in verify_shards(index, wrong).collect()} == {"wrong_key"}
    assert {(r.fault, r.prefix) for r in verify_shards(index, docs.where("prefix = '990'")).collect()} == {("missing_document", "12A")}


def test_large_shards_are_refused(spark, monkeypatch):
    from ledgerloom.operators import shards

    df = spark.createDataFrame([("a", "1", "xx"), ("a", "2", "yy"), ("b", "1", "z")], "prefix string, key string, value string")
    assert {r.prefix: r.bytes for r in shards.shard_artifact_summary(df).collect()} == {"a": 6, "b": 2}
    monkeypatch.setattr(shards, "SHARD_BYTES", 5)
    with pytest.raises(Exception, match="use a longer prefix: a"):
        shards.shard_artifact_summary(df).collect()


def test_lookup_prunes_partitions(spark, tables, tmp_path):
    from ledgerloom.operators.lookup import lookup

    writers.write_partitioned(entity_documents(tables).select("key", "value"), str(tmp_path / "d"), "key", column="prefix")
    docs = readers.read_partitioned(spark, str(tmp_path / "d"), key="prefix")
    asked = spark.createDataFrame([(" 12.ABC.345/0001-90 ",), ("12ABC345000100",), ("no",)], "raw string")
    found = lookup(asked, docs, {})
    assert [r.outcome for r in found.orderBy("raw").collect()] == ["ok", "not_found", "invalid"]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, lookup(asked, docs, {}, bloom=False).collect())) == sorted(map(tuple, found.collect()))


def test_bloom_filter(spark):
    from ledgerloom.operators.bloom import only_near

    rows, keys = spark.range(20000).selectExpr("cast(id AS string) AS k", "id"), spark.range(0, 20000, 100).selectExpr("cast(id AS string) AS a")
    near = only_near(rows, "k", keys.unionByName(keys.limit(1).selectExpr("cast(null AS string) AS a")), "a", bits=1 << 14)
    got = {r.id for r in near.collect()}
    assert set(range(0, 20000, 100)) <= got and len(got) < 200 + 0.01 * 20000
    assert only_near(rows, "k", keys.limit(0), "a", bits=1 << 10).count() == 0
    assert only_near(rows, "k", rows, "k", bits=64).count() == 20000  # overfull, and still right


def test_digest_tree(spark, tmp_path):
    from ledgerloom.operators.digests import tree_diff, write_tree
    from ledgerloom.operators.relational import hash_diff

    rows = [(f"{p:03d}{i:02d}0001000190", f"h{i}") for p in range(6) for i in range(40)]
    states = [rows, [*rows[:50], (rows[50][0], "other"), *rows[51:]], rows[::-1], [*rows[1:], ("00500", None), ("x", "y")]]
    frames = [spark.createDataFrame(x, "cnpj string, content_hash string") for x in states]
    for i, f in enumerate(frames):
        write_tree(f, str(tmp_path / f"s{i}"))
    path = lambda i: str(tmp_path / f"s{i}")
    for i, j in ((0, 1), (0, 3), (3, 1), (1, 1)):
        assert sorted(map(tuple, tree_diff(spark, path(i), path(j)).collect()), key=str) == sorted(map(tuple, hash_diff(frames[i], frames[j]).collect()), key=str)
    one = tree_diff(spark, path(0), path(1))
    assert [r.cnpj for r in one.collect()] == [rows[50][0]]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dynamicpruning") >= 2
    read = sum(int(m.value()) for m in _metrics(one, "numFiles"))
    assert 0 < read <= 8  # digests of both states and the files of one prefix, of six
    assert tree_diff(spark, path(0), path(2)).isEmpty()


def _metrics(df, name):
    """Metrics of the scans that a query ran, of one prefix at most if pruned."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.metrics().contains(name) and "PartitionFilters: [isnotnull(prefix" in node.toString().split("\n")[0]:
            found.append(node.metrics().apply(name))
        kids = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else [node.children().apply(i) for i in range(node.children().size())]
        todo += kids
    return found


def test_large_shards_are_written_in_pieces(spark, tmp_path):
    from ledgerloom.operators import shards

    rows = [("hot" if i % 12 else f"p{i % 36}", f"{i:014d}", json.dumps({"cnpj": f"{i:014d}", "v": "é" * (i % 7)}, ensure_ascii=False)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "prefix string, key string, value string").repartition(4)
    writers.write_shard_pieces(docs, str(tmp_path / "s"), 12)
    pieces = {(r.prefix, r.piece): r for r in shards.shard_pieces(spark, str(tmp_path / "s")).collect()}
    hot = [r for r in pieces.values() if r.prefix == "hot"]
    total = sum(r.bytes for r in hot)
    assert 9 <= len(hot) <= 13 and max(r.bytes for r in hot) < 2.5 * total / len(hot)
    sums = {r.prefix: r for r in shards.shard_checksums(shards.shard_pieces(spark, str(tmp_path / "s"))).collect()}
    for p in {r[0] for r in rows}:
        text = "".join(v + "\n" for q, _, v in sorted(rows) if q == p).encode()
        files = [(tmp_path / "s" / f"prefix={p}" / pieces[p, k].file).read_bytes() for k in range(sums[p].pieces)]
        assert b"".join(files) == text and sums[p].bytes == len(text)
        assert sums[p].checksum == hashlib.md5("".join(hashlib.md5(f).hexdigest() + "\n" for f in files).encode()).hexdigest()
    index = shards.shard_index(docs)
    assert shards.verify_files(index, shards.file_lines(spark, str(tmp_path / "s"))).isEmpty()


def test_json_rules(spark):
    from ledgerloom.operators import quality

    good = {"updated_at": "t", "numero_rntrc": "1", "nome": "n", "categoria": "", "situacao": "", "data_primeiro_cadastro": "", "data_situacao": "", "cep": "", "municipio": "", "uf": "SP", "equiparado": True}
    texts = [json.dumps(x) for x in (good, good | {"uf": "SPX"}, good | {"extra": 1}, {k: v for k, v in good.items() if k != "equiparado"})] + ["[1]", None]
    report = {r.rule: r.n for r in quality.json_report(spark.createDataFrame([(t,) for t in texts], "value string"), "value", quality.CARRIER_TREE).collect()}
    assert report == {"uf:too_long": 1, "extra:unknown": 1, "equiparado:required": 1, ":no_object": 2}
    text = json.dumps({"updated_at": "t", "obras": [{"cno": "x" * 21, "new": 1}]})
    report = {r.rule for r in quality.json_report(spark.createDataFrame([(text,)], "value string"), "value", quality.WORKS_TREE).collect()}
    assert {"obras[].cno:too_long", "obras[].new:unknown", "obras[].uf:required", "obras[].situacao:required"} <= report


def test_typed_conformance(spark):
    from ledgerloom.operators.quality import ENTITY_TREE, json_violations
    from ledgerloom.functions.exprs import parsed_json
    from ledgerloom.plans.registry import _filled

    good = json.loads(_filled(ENTITY_TREE)) | {"cnpj": "1" * 14, "data_opcao_mei": "2024-01-31"}
    cases = {
        "capital_social": (5, ["capital_social:type"]),
        "QSA": ([{}], [f"QSA[].{n}:required" for n in good["QSA"][0]]),
        "telefones": ([{"ddd": "1", "numero": "2", "is_fax": "yes"}, 3, None], ["telefones[].is_fax:type", "telefones[]:type"]),
        "cnaes_secundarios": ([["1"], "12345678"], ["cnaes_secundarios[]:type", "cnaes_secundarios[]:too_long"]),
        "data_opcao_mei": ("31/01/2024", ["data_opcao_mei:pattern"]),
        "cno": (None, []),
        "rntrc": ({"updated_at": []}, ["rntrc.updated_at:type", *(f"rntrc.{n}:required" for n in good["rntrc"] if n != "updated_at")]),
        "anything": ({"at": "all"}, []),
        "uf": ("SPX", ["uf:too_long"]),
        "cnpj": ("1", ["cnpj:pattern", "cnpj:too_short"]),
    }
    rows = [(name, json.dumps(good | {name: value}), sorted(rules)) for name, (value, rules) in cases.items()]
    rows += [("none", None, [":no_object"]), ("list", "[1]", [":no_object"]), ("more", json.dumps(good) + "}", [":no_object"]), ("same", json.dumps(good), []), ("twice", '{"a":1,"a":2}', [":no_object"])]
    df = spark.createDataFrame(rows, "name string, value string, want array<string>")
    for r in df.withColumn("doc", parsed_json("value")).select("*", json_violations("doc", ENTITY_TREE).alias("got")).drop("doc").collect():
        assert sorted(r.got) == r.want, r.name


def test_stream_needs_its_state(spark, tmp_path):
    import shutil

    from ledgerloom.streaming.changes import stream_module_changes

    args = (spark, str(tmp_path / "in"), "cnpj string, content_hash string", lambda df: df, *(str(tmp_path / x) for x in ("state", "feed", "check")))
    put = lambda h: spark.createDataFrame([("1", h)], "cnpj string, content_hash string").write.mode("append").parquet(str(tmp_path / "in"))
    put("a")
    stream_module_changes(*args)
    shutil.rmtree(tmp_path / "state")
    put("b")
    with pytest.raises(Exception, match="is gone"):
        stream_module_changes(*args)


def test_rest_works_without_the_corpus_operators(tmp_path):
    """A copy with both folders deleted (and one without the pipeline too) still imports and lists its queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    for name, gone in (("two", ["ledgerloom/llm", "tests/llm"]), ("three", ["ledgerloom/llm", "tests/llm", "corpus_pipeline.py"])):
        shutil.copytree(root, tmp_path / name, ignore=shutil.ignore_patterns(".git", "__pycache__", *(g.rpartition("/")[2] for g in gone)))
        code = "import __spark_entry__ as e; q = e.queries(); assert 'registry_documents' in q and not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path / name, check=True, timeout=120)


def test_shared_lists_are_judged_as_parts_of_documents(spark):
    from ledgerloom.operators import quality
    from ledgerloom.plans.registry import _filled

    tree = quality.ENTITY_TREE
    good = json.dumps(json.loads(_filled(tree)) | {"cnpj": "1" * 14}, separators=(",", ":"))
    doc = json.loads(good)
    people = doc.pop("QSA")
    head = json.dumps(doc, separators=(",", ":"))[:-1]
    qsa = json.dumps(people, separators=(",", ":"))
    at = lambda h=head, q=qsa, end="}": f'{h},"QSA":{q}{end}'
    long_uf = head.replace('"uf":""', '"uf":"ABC"')
    texts = [at(), at(), at(q="[]"), at(long_uf), at(q=qsa.replace('"faixa_etaria"', '"age"')), at(long_uf, "[3]"), at(q="[1,]"), at(long_uf, "[{]"), at(end="}}"), at(end=""), at(end=' }'), at(q='[{"nome_socio":"a]}"}]')]
    texts += [at(q=qsa + ',"x":1'), at(q=qsa + ',"uf":"SP"'), at(head + ',"QSA":[]'), at(head + ',"QSA" :[]'), '{,"QSA":[]}', ' { ,"QSA":[]}', '[1,"QSA":[]}', '{"a":{"b":1,"QSA":[]}', '{"a":{"b":1,"QSA":[1]}}', '{"a":"x,"QSA":[]}', '{"a":"x,\\"QSA\\":[]}"}', at(head[:-1]), at(q='{}'), at(q='{},"was":[]'), "{}", "", None]
    texts += [at(head.replace('"nome_fantasia":""', '"nome_fantasia":"é\\u00e9\\u0000"')), at(long_uf.replace('"email":""', '"email":null')), at(q='["é]"]'), at(q='[{"nome_socio":"' + "ü" * 201 + '"}]')]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got, want = ({r.rule: r.n for r in quality.json_report(df, "value", tree, shared).collect()} for shared in ("QSA", None))
    assert got == want and want[":no_object"] > 10 and want["QSA[].age:unknown"] == 1 and want["uf:too_long"] == 3
    one = lambda t, shared: sorted(r.rule for r in quality.json_report(spark.createDataFrame([(t,)], "value string"), "value", tree, shared).collect())
    assert one(at(q="[1,]"), "QSA") == [":no_object"] and one(at(), "QSA") == []


def test_conformance_parses_a_shared_list_once(spark, sf_dir):
    from ledgerloom.plans import catalog

    plan = catalog.QUERIES["registry_conformance"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "contains(" in plan.lower() and "from_json" in plan.lower()
    text = catalog.QUERIES["registry_documents"](spark, sf_dir)._jdf.queryExecution().analyzed().toString()
    # partners become text below the joins
    assert text.index("Join") < text.rindex("to_json(")


def _odd_documents():
    """Documents that levelling must not judge otherwise: faults, looser limits elsewhere, names with quotes, repeats, other orders, no JSON."""
    from ledgerloom.operators.quality import ENTITY_TREE
    from ledgerloom.plans.registry import _filled

    dense = lambda x: json.dumps(x, separators=(",", ":"), ensure_ascii=False)
    good = json.loads(_filled(ENTITY_TREE)) | {"cnpj": "12ABC345000190", "razao_social": "É" * 200, "cep": "01310100", "cnaes_secundarios": ["4711301", ""], "data_opcao_mei": "2024-01-31"}
    person, phone = good["QSA"][0] | {"nome_socio": "A}]{", "data_entrada_sociedade": "2020-01-01"}, good["telefones"][0]
    del good["cno"], good["rntrc"]
    put = [{}, {"razao_social": "É" * 201}, {"razao_social": "😀" * 200}, {"cep": "013101000"}, {"cnpj": "12abc345000190"}, {"cnpj": ""}, {"cnpj": None}, {"cnaes_secundarios": ["47113011", "1"]}, {"cnaes_secundarios": []}]
    put += [{"cnaes_secundarios": "x"}, {"uf": ["SP"]}, {"uf": {"uf": "SPX"}}, {"nome_fantasia": 'a"b\\'}, {"nome_fantasia": "�\u0000"}, {"data_opcao_mei": "2024-1-31"}, {"QSA": "SP"}, {"QSA": [person, person]}, {"QSA": [person, person | {"x": 1}, person]}]
    put += [{"telefones": [phone, phone | {"numero": "1" * 16}]}, {"telefones": [phone, phone | {"is_fax": "true"}, 3]}, {"cno": None, "rntrc": {"cep": "123456789", "uf": "SPX"}}, {"cno": {"obras": [{"numero": "1" * 18, "cep": "123456789"}]}}]
    put += [{'a"uf': "SPX", "b": {"uf": "SPX", "QSA": [1]}}, {"numero": "1" * 18}, {"numero": "1" * 21}, {"extra": [good]}]
    texts = [dense(good | x) for x in put] + [json.dumps(good), dense(dict(reversed(good.items()))), dense({k: v for k, v in good.items() if k != "email"}), "{}", "[]", "", None]
    texts += [dense(good)[:-1], dense(good) + "}", dense(good).replace('"uf":', '"uf":"SP","uf":'), dense(good).replace('"uf":', '"uf"'), dense(good).replace('"uf":""', '"uf":"SP" "'), dense(good).replace('"uf":""', '"uf":"\t"')]
    return texts + [dense(good).replace('"uf":""', f'"uf":"{x}"') for x in ('x","cep":"', "\\", '\\"uf":"', '","uf":"SP', "\\u0041")] + [dense(good).replace('"QSA":[', '"QSA":[,'), dense(good).replace('"telefones":[', '"telefones":[]')]


def test_levelled_documents_break_the_same_rules(spark):
    from ledgerloom.functions.exprs import parsed_json
    from ledgerloom.operators import quality

    tree = quality.ENTITY_TREE
    rows = spark.createDataFrame([(t,) for t in _odd_documents()], "text string").unionByName(spark.sql("SELECT replace(text, 'ZZ', CAST(X'FF41' AS STRING)) AS text FROM VALUES ('{\"uf\":\"ZZ\"}'), ('{\"uf\":\"ZZZ\",\"cep\":\"ZZ\"}') AS t(text)"))
    ways = {"as it is": F.col("text"), "levelled": quality._levelled(F.col("text"), tree), "by name": quality._levelled_by_name(F.col("text"), tree)}
    found = {}
    for way, text in ways.items():
        docs = rows.select("text", text.alias("t")).select("text", "t", parsed_json("t").alias("doc"))
        found[way] = [(r.text, sorted(r.rules)) for r in docs.select("text", quality.json_violations("doc", tree, "t").alias("rules")).collect()]
    assert found["levelled"] == found["as it is"] and found["by name"] == found["as it is"]
    assert len({tuple(r) for _, r in found["as it is"]}) > 15


def test_lists_are_thinned_without_a_change_of_rules(spark):
    from ledgerloom.functions.exprs import parsed_json
    from ledgerloom.operators import quality

    node = quality.ENTITY_TREE.fields["QSA"]
    good = '{"nome_socio":"%s","cnpj_cpf_socio":"","qualificacao_socio":"","data_entrada_sociedade":"2020-01-01","identificador_socio":"","faixa_etaria":""}'
    one, two, bad = good % "A", good % "B}]", (good % "C").replace("2020-01-01", "x")
    kept = {f"[{one},{two},{one}]": f"[{one}]", f"[{one},{bad},{two},{two},{bad}]": f"[{bad},{bad}]", "[]": "[]", f"[{one}]": f"[{one}]", f'["a{{{one},{{b"]': None, f"[{one},[{two},{one}]]": None, f"{one},{two}": None, f"[{one},{two}": f"[{two}", f"[{bad},{{,{one},{two}]": None, f'[{{"a":{{}}}},{one},{two}]': None}
    rows = spark.createDataFrame(list(kept.items()), "text string, want string").select("*", quality.thinned_list(F.col("text"), node).alias("got"))
    for r in rows.select("*", parsed_json("text").isNull().alias("a"), parsed_json("got").isNull().alias("b")).collect():
        assert r.got == (r.want or r.text) and r.a == r.b, r.text


def test_conformance_judges_documents_that_are_alike_once(spark, sf_dir):
    from ledgerloom.operators import quality
    from ledgerloom.plans import registry

    docs = registry._judged(spark, sf_dir)
    assert docs.count() == registry.registry_documents(spark, sf_dir).count() == 1500
    assert quality._counted(docs.select(F.col("value").alias("text")), quality.ENTITY_TREE).count() < 50
    assert docs.agg(F.max(F.length("value"))).first()[0] < 1500
    for name in ("registry_conformance", "typed_conformance"):
        plan = getattr(registry, name)(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().lower()
        # the nodes above come first: what is parsed has been counted before
        assert plan.rindex("from_json") < plan.rindex("count(1)") < plan.rindex("structstojson")


def test_documents_are_kept_in_less_space(spark, tmp_path):
    from ledgerloom.plans import registry

    folder, docs = str(tmp_path / "kept"), registry.registry_documents(spark, "/root/testdata/sf0.001")
    back = writers.keep_documents(docs, folder)
    assert back.exceptAll(docs).isEmpty() and docs.exceptAll(back).isEmpty()
    size = sum(p.stat().st_size for p in (tmp_path / "kept").glob("*.parquet"))
    assert all(".zstd." in p.name for p in (tmp_path / "kept").glob("*.parquet")) and size * 20 < back.agg(F.sum(F.octet_length("value"))).first()[0]


def test_changes_are_found_by_a_digest_a_prefix(spark, tables, sf_dir, monkeypatch):
    from ledgerloom.operators import incremental
    from ledgerloom.plans import registry

    new = registry.registry_tables(spark, sf_dir)
    simples = new["simples"].unionByName(new["simples"].where("cnpj_basico = '20000000'"))
    for put in ({}, {"estabelecimento": new["estabelecimento"].where("cnpj_prefix <> '210'"), "simples": simples}):
        old = new | put
        want = {r[0] for r in incremental.changed_companies(old, new).collect()}
        assert {r[0] for r in incremental.changed_prefixes(old, new).collect()} == want and bool(want) == bool(put), put
    # the documents are made again from prefixes that are found without a row a company
    monkeypatch.setattr(incremental, "changed_companies", None)
    docs, _ = incremental.regenerate(entity_documents(tables), tables, tables)
    assert docs.count() == 2
