"""Data-quality reports: conformance of documents, validity of keys, duplicate keys."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import key_reason, parsed_json

#: Shapes of the objects in a list that are told apart before each object is judged on its own.
SHAPES = 16
DATE = r"^$|^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
KEY = r"^[A-Z0-9]{12}[0-9]{2}\z"


@dataclass(frozen=True)
class Rule:
    """What the text at ``path`` must be; ``path`` may go through one array, as in ``telefones[].ddd``."""

    path: str
    required: bool = True
    pattern: str | None = None
    shortest: int = 0
    longest: int | None = None
    kind: str = "text"


# Limits of the published document schema.
ENTITY_RULES = (
    Rule("cnpj", pattern=KEY, shortest=14, longest=14),
    Rule("razao_social", longest=200),
    Rule("nome_fantasia", longest=200),
    Rule("situacao_cadastral", longest=30),
    Rule("data_situacao_cadastral", pattern=DATE, longest=10),
    Rule("matriz_filial", longest=10),
    Rule("data_inicio_atividade", pattern=DATE, longest=10),
    Rule("cnae_principal", longest=7),
    Rule("cnaes_secundarios[]", longest=7),
    Rule("natureza_juridica", longest=200),
    Rule("tipo_logradouro", longest=20),
    Rule("logradouro", longest=200),
    Rule("numero", longest=20),
    Rule("complemento", longest=200),
    Rule("bairro", longest=100),
    Rule("cep", longest=8),
    Rule("uf", longest=2),
    Rule("municipio", longest=100),
    Rule("email", longest=115),
    Rule("telefones[].ddd", longest=4),
    Rule("telefones[].numero", longest=15),
    Rule("telefones[].is_fax", kind="flag"),
    Rule("capital_social", longest=25),
    Rule("porte_empresa", longest=50),
    Rule("opcao_simples", longest=1),
    Rule("data_opcao_simples", pattern=DATE, longest=10),
    Rule("opcao_mei", longest=1),
    Rule("data_opcao_mei", pattern=DATE, longest=10),
    Rule("QSA[].nome_socio", longest=200),
    Rule("QSA[].cnpj_cpf_socio", longest=20),
    Rule("QSA[].qualificacao_socio", longest=100),
    Rule("QSA[].data_entrada_sociedade", pattern=DATE, longest=10),
    Rule("QSA[].identificador_socio", longest=30),
    Rule("QSA[].faixa_etaria", longest=30),
)
# in the order in which works are written
_WORK = {
    "cno": 20, "nome": 200, "nome_empresarial": 200, "situacao.codigo": 10, "situacao.descricao": 200, "data_inicio": 30, "data_inicio_responsabilidade": 30,
    "data_registro": 30, "data_situacao": 30, "cep": 8, "uf": 2, "codigo_municipio": 10, "municipio": 100, "tipo_logradouro": 20, "logradouro": 200, "numero": 20,
    "bairro": 100, "complemento": 200, "unidade_medida": 10, "area_total": 25, "cno_vinculado": 20, "codigo_pais": 5, "pais": 100,
    "qualificacao_responsavel.codigo": 10, "qualificacao_responsavel.descricao": 200, "codigo_localizacao": 10,
}
_CARRIER = dict(numero_rntrc=20, nome=200, categoria=20, situacao=30, data_primeiro_cadastro=30, data_situacao=30, cep=10, municipio=100, uf=2)
WORKS_RULES = (
    Rule("updated_at", longest=40),
    *(Rule(f"obras[].{name}", longest=n) for name, n in _WORK.items()),
)
CARRIER_RULES = (Rule("updated_at", longest=40), *(Rule(name, longest=n) for name, n in _CARRIER.items()), Rule("equiparado", kind="flag"))


@dataclass(frozen=True)
class Node:
    """What a JSON value must be: ``text`` or ``flag`` (with a rule), ``list`` (of ``item``) or ``object`` (of ``fields``).

    An object that isn't ``open`` has no other fields. A ``null`` one may be JSON's null instead.
    """

    kind: str
    rule: Rule | None = None
    item: Node | None = None
    fields: dict[str, Node] = field(default_factory=dict)
    open: bool = False
    null: bool = False
    required: bool = True


def schema_tree(rules: tuple[Rule, ...], open: bool = False, null: bool = False, required: bool = True, more: dict[str, Node] | None = None) -> Node:
    """The object whose values ``rules`` name by their paths; ``more``: fields with trees of their own."""
    root = Node("object", open=open, null=null, required=required, fields=dict(more or {}))
    for rule in rules:
        at = root
        *outer, last = rule.path.split(".")
        for part in outer:
            name = part.removesuffix("[]")
            if name not in at.fields:
                inner = Node("object")
                at.fields[name] = Node("list", item=inner) if part.endswith("[]") else inner
            at = at.fields[name].item or at.fields[name]
        leaf = Node(rule.kind, rule, required=rule.required)
        at.fields[last.removesuffix("[]")] = Node("list", item=leaf, required=rule.required) if last.endswith("[]") else leaf
    return root


WORKS_TREE, CARRIER_TREE = schema_tree(WORKS_RULES), schema_tree(CARRIER_RULES)
#: A published document: root names are free, and module payloads may stand in it or be null.
ENTITY_TREE = schema_tree(ENTITY_RULES, open=True, more={"cno": schema_tree(WORKS_RULES, null=True, required=False), "rntrc": schema_tree(CARRIER_RULES, null=True, required=False)})


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _limits(rule: Rule, value: str, path: str) -> list[str]:
    """SQL of the faults that a text can have; null for null."""
    tests = [(f"NOT rlike({value}, {_literal(rule.pattern)})", "pattern")] if rule.pattern else []
    tests += [(f"length({value}) < {rule.shortest}", "too_short")] if rule.shortest else []
    tests += [(f"length({value}) > {rule.longest}", "too_long")] if rule.longest is not None else []
    return [f"CASE WHEN {test} THEN {_literal(f'{path}:{kind}')} END" for test, kind in tests]


def _expected(node: Node, as_type: bool = False) -> str:
    """What ``schema_of_variant`` says of a value of which every part is there and of its type, or the type to read it as."""
    if node.kind == "list":
        return f"ARRAY<{_expected(node.item, as_type)}>"
    if node.kind == "object":
        fields = sorted((name, _expected(inner, as_type)) for name, inner in node.fields.items())
        return f"STRUCT<{', '.join(f'`{n}`: {t}' for n, t in fields)}>" if as_type else f"OBJECT<{', '.join(f'{n}: {t}' for n, t in fields)}>"
    return {"text": "STRING", "flag": "BOOLEAN", "void": "VOID"}[node.kind]


def _typed_faults(node: Node, x: str, path: str, depth: int) -> list[str]:
    """SQL of arrays with the limits that a value of the expected shape breaks."""
    if node.kind == "list":
        inside = _typed_faults(node.item, f"y{depth}", f"{path}[]", depth + 1)
        return [f"flatten(transform({x}, y{depth} -> concat({', '.join(inside)})))"] if inside else []
    if node.kind == "object":
        return [c for name, inner in node.fields.items() for c in _typed_faults(inner, f"{x}.`{name}`", f"{path}.{name}" if path else name, depth)]
    tests = _limits(node.rule, x, path)
    return [f"array({', '.join(tests)})"] if tests else []


def _faults(node: Node, x: str, path: str, depth: int = 0) -> list[str]:
    """SQL of arrays with the rules that the variant ``x`` breaks and nulls for those that hold. One text for a whole tree is
    parsed at once; building its columns one by one would take the driver seconds."""
    named = lambda kind: _literal(f"{path}:{kind}")
    there = f"{x} IS NOT NULL" + (f" AND NOT is_variant_null({x})" if node.null else "")
    out = [f"array(CASE WHEN {x} IS NULL THEN {named('required')} END)"] if node.required and path else []
    if node.kind in ("text", "flag"):
        value = f"CASE WHEN schema_of_variant({x}) = '{'STRING' if node.kind == 'text' else 'BOOLEAN'}' THEN try_variant_get({x}, '$', 'string') END"
        tests = [f"CASE WHEN {there} AND ({value}) IS NULL THEN {named('type')} END", *_limits(node.rule, value, path)]
        return [*out, f"array({', '.join(tests)})"]
    if node.kind == "list":
        items, y = f"try_variant_get({x}, '$', 'array<variant>')", f"y{depth}"
        if node.item.kind == "object" and (leaves := _leaves(node.item, y, f"{path}[]")):
            # the list and its items are taken once: each time they would be built anew
            v, l = f"v{depth}", f"l{depth}"
            there = there.replace(x, v)
            wrong = f"array(CASE WHEN {there} AND {l} IS NULL THEN {named('type')} END)"
            inside = f"CASE WHEN {l} IS NULL THEN {wrong} ELSE {_grouped_faults(node, l, path, depth, leaves)} END"
            return [*out, f"flatten(transform(array({x}), {v} -> flatten(transform(array(try_variant_get({v}, '$', 'array<variant>')), {l} -> {inside}))))"]
        inside = f"transform(coalesce({items}, array()), {y} -> concat({', '.join(_faults(node.item, y, f'{path}[]', depth + 1))}))"
        slow = ", ".join([*out, f"array(CASE WHEN {there} AND {items} IS NULL THEN {named('type')} END)", f"flatten({inside})"])
        # items of the expected shape, which nearly all are, are read as what they are at once
        fast = ", ".join(_typed_faults(node, f"try_variant_get({x}, '$', '{_expected(node, True)}')", path, depth))
        return [f"CASE WHEN schema_of_variant({x}) = {_literal(_expected(node))} THEN concat({fast or 'array()'}) ELSE concat({slow}) END"]
    names = f"map_keys(try_variant_get({x}, '$', 'map<string,variant>'))"
    dot = f"{path}." if path else ""
    out.append(f"array(CASE WHEN {there} AND {names} IS NULL THEN {named('type')} END)")
    if not node.open:
        known = ", ".join(map(_literal, sorted(node.fields)))
        out.append(f"transform(coalesce(array_except({names}, array({known})), array()), n{depth} -> concat({_literal(dot)}, n{depth}, ':unknown'))")
    # what is no object has no fields to miss
    inside = [c for name, inner in node.fields.items() for c in _faults(inner, f"try_variant_get({x}, '$.{name}', 'variant')", f"{dot}{name}", depth)]
    return [*out, f"CASE WHEN {names} IS NOT NULL THEN concat({', '.join(inside)}) ELSE array() END"]


def _leaves(node: Node, at: str, path: str) -> list[tuple[str, str, Rule]] | None:
    """(value, path, rule) of the texts and flags in an object ``at``; null where a list is among them."""
    found = []
    for name, inner in node.fields.items():
        value, below = f"{at}.`{name}`", f"{path}.{name}"
        more = _leaves(inner, value, below) if inner.kind == "object" else [(value, below, inner.rule)] if inner.rule else None
        if more is None:
            return None
        found += more
    return found


def _any_limits(leaves: list[tuple[str, str, Rule]], rows: str, y: str, known: str | None = None) -> str:
    """SQL of an array with the limits that any of ``rows`` breaks; ``known``: faults among which no wrong type of the value may be."""
    tests = [(path, test) for value, path, rule in leaves for test in _limits(rule, value, path)]
    return f"array({', '.join(f'CASE WHEN {f"NOT array_contains({known}, {_literal(path + ':type')}) AND " if known else ""}exists({rows}, {y} -> ({test}) IS NOT NULL) THEN {named} END' for path, test in tests for named in (test.rsplit(' THEN ', 1)[1].removesuffix(' END'),))})"


def _grouped_faults(node: Node, l: str, path: str, depth: int, leaves: list[tuple[str, str, Rule]]) -> str:
    """SQL of an array with the faults of the objects in a list of variants. What an object's shape breaks is found on one of each shape, and the
    limits on all objects of that shape as rows. Lists of many shapes are judged object by object."""
    h, d, s, g, q, y, t, i = (f"{c}{depth}" for c in "hdsgqyti")
    each = lambda v: f"concat({', '.join(_faults(node.item, v, f'{path}[]', depth + 1))})"
    first = f"flatten(transform(array({l}[array_position({h}, {s}) - 1]), {t} -> {each(t)}))"
    alike = f"transform(CASE WHEN size({d}) = 1 THEN {l} ELSE filter({l}, ({y}, {i}) -> {h}[{i}] = {s}) END, {y} -> try_variant_get({y}, '$', '{_expected(node.item, True)}'))"
    limits = f"flatten(transform(array({alike}), {g} -> {_any_limits(leaves, g, y, q)}))"
    by_rule = f"CASE WHEN {s} = {_literal(_expected(node.item))} THEN array() ELSE {first} END"
    shape = f"flatten(transform(array({by_rule}), {q} -> concat({q}, {limits})))"
    few = f"flatten(transform({d}, {s} -> {shape}))"
    many = f"flatten(transform({l}, {y} -> {each(y)}))"
    by_shape = f"flatten(transform(array(array_distinct({h})), {d} -> CASE WHEN size({d}) <= {SHAPES} THEN {few} ELSE {many} END))"
    return f"flatten(transform(array(transform({l}, {t} -> schema_of_variant({t}))), {h} -> {by_shape}))"


#: A character of a JSON string that stands for itself. Bytes that are no UTF-8 are U+FFFD to patterns, as they are to the parsers. The class lists single bytes, as one with a range is scanned much slower.
_PLAIN = f"[^{''.join(f'\\x{i:02x}' for i in (*range(0x20), ord('"'), ord(chr(92))))}]"
#: What the texts are that hold a pattern, one of them, and their least and greatest length.
_HELD = {DATE: ("(?:[0-9]{4}-[0-9]{2}-[0-9]{2})?+", "", 0, 10), KEY: ("[A-Z0-9]{12}[0-9]{2}", "0" * 14, 14, 14)}


def _holding(rule: Rule) -> tuple[str, str] | None:
    """A pattern of texts without escapes that hold ``rule``, and one such text; null for a pattern that isn't known here."""
    if rule.longest is not None and rule.longest < rule.shortest:
        return None
    if rule.pattern is None:
        return f"{_PLAIN}{{{rule.shortest},{'' if rule.longest is None else rule.longest}}}+", "x" * rule.shortest
    inside, one, least, most = _HELD.get(rule.pattern, ("", "", -1, 0))
    return (inside, one) if rule.shortest <= least and (rule.longest is None or rule.longest >= most) else None


def _written(node: Node) -> str | None:
    """A pattern of the texts of objects that break no rule: their fields in the order of the rules, without blanks or escapes; null where one is needed that it can't tell."""
    if node.kind == "object":
        inside = {name: _written(inner) for name, inner in node.fields.items()}
        return None if None in inside.values() else r"\{" + ",".join(f'"{re.escape(name)}":{p}' for name, p in inside.items()) + r"\}"
    if node.kind == "flag":
        return "(?:true|false)"
    known = _holding(node.rule) if node.kind == "text" else None
    return known and f'"{known[0]}"'


def _thinned(value: str, tree: Node) -> Column:
    """JSON documents that break the same rules of ``tree`` as those of ``value``, without most items that break none.

    At the beginning of a list items go that are written as ``_written`` has it and that another object follows. Nothing else can tell: in JSON, a list
    begins where the list's name, a colon and a bracket stand, and where they do not begin one the text is no JSON with the items or without them.
    """
    text = F.col(value)
    for name, node in tree.fields.items():
        if node.kind == "list" and node.item.kind == "object" and (item := _written(node.item)):
            text = F.regexp_replace(text, rf'(?s)\A(.*?"{re.escape(name)}":\[)(?:{item},(?=\{{))*+', "$1")
    return text


def thinned_list(text: Column, node: Node) -> Column:
    """The JSON text of a list (``node``) of objects, without the items that break no rule and that another object follows: a document that ends with the
    one breaks the same rules as with the other. Every item is held against the rules, up to one that has lists or objects within; from there on all stay.

    The items are taken one after the other from the bracket that begins the list, so a text that is no JSON is none without them.
    """
    if (good := _written(node.item)) is None:
        return text
    flat = r'\{(?:[^"{}\[\]]|"(?:[^"\\]|\\.)*+")*+\}'
    return F.regexp_replace(text, rf"(?s)(\A\[|(?!\A)\G)(?:(?:{good},(?=\{{))++|({flat},(?=\{{)))", "$1$2")


def _known_texts(tree: Node) -> dict[str, tuple[str, str]]:
    """What ``_holding`` says of the texts in a tree, by their names: if rules have a name in several places, a text must hold all."""
    given: dict[str, list[Rule]] = {}

    def gather(node: Node) -> None:
        for name, inner in node.fields.items():
            if inner.rule:
                given.setdefault(name, []).append(inner.rule)
            gather(inner.item or inner)

    gather(tree)
    found = {}
    for name, rules in given.items():
        patterns = {r.pattern for r in rules if r.pattern}
        longest = min((r.longest for r in rules if r.longest is not None), default=None)
        every = Rule(name, pattern=next(iter(patterns), None), shortest=max(r.shortest for r in rules), longest=longest)
        if {r.kind for r in rules} == {"text"} and len(patterns) < 2 and (known := _holding(every)):
            found[name] = known
    return found


def _levelled(text: Column, tree: Node) -> Column:
    """JSON documents that break the same rules of ``tree`` as those of ``text``, most values that break none replaced by one that breaks none: so most
    documents become equal to many others.

    Members of the root are looked for in the order of the rules, and where one is written otherwise or has a fault, all up to the next one's name stays as
    it is. In JSON, a name in quotes with a colon after it and then a text or a list begins that member (or one whose name ends with an escaped quote and
    this name, which no rule knows), so another text or list can stand there, wherever it is.
    """
    texts = _known_texts(tree)
    members = [(name, node) for name, node in tree.fields.items() if node.required]
    slots, groups, start = [], 0, r"\{"
    for i, (name, node) in enumerate(members):
        here, way = f'{start}"{re.escape(name)}":', ""
        inside, one = texts.get(name, ("", "")) if node.kind == "text" else ("", "")
        if one and not i:
            # a text that can't be empty is replaced on its own, as what a pattern puts in is fixed; only one as long as its substitute
            put = f'{{"{name}":"{one}"'
            text = F.when(F.left(text, F.lit(len(put))).rlike(rf'\A{here}"{inside}"\z'), F.concat(F.lit(put), F.substring(text, F.lit(len(put) + 1), F.octet_length(text)))).otherwise(text)
        elif inside and not one:
            way = f'({here}"){inside}(")|'
        elif node.kind == "list" and name not in texts and (item := _written(node.item)):
            way = rf"({here}\[)(?:{item}(?:,{item})*+)?+(\])|"
        upto = f'(?:(?!,"{re.escape(members[i + 1][0])}":).)*+' if i + 1 < len(members) else ""
        slots.append(f"(?>{way}({upto}))")
        groups += 3 if way else 1
        start = ","
    return F.regexp_replace(text, rf"(?s)\A{''.join(slots)}", "".join(f"${i}" for i in range(1, groups + 1)))


def _levelled_by_name(text: Column, tree: Node) -> Column:
    """What ``_levelled`` does, for texts at any place and in any order, at some times the cost."""
    ways: dict[tuple[str, str], list[str]] = {}
    for name, known in _known_texts(tree).items():
        ways.setdefault(known, []).append(re.escape(name))
    # empty texts, most of those that are left, are passed by before any name is looked at
    behind = lambda names, inside: rf'(?<="(?:{"|".join(names)})":"){inside}"'
    for (inside, one), names in ways.items():
        text = F.regexp_replace(text, f'":"{behind(names, inside)}', f'":"{one}"') if one else text
    empty = [behind(names, inside) for (inside, one), names in ways.items() if not one]
    return F.regexp_replace(text, f'":"(?!")(?:{"|".join(empty)})', '":""') if empty else text


def json_violations(doc: str, tree: Node, text: str | None = None) -> Column:
    """An array with every rule of ``tree`` that a parsed document (a column of ``parsed_json``) breaks: ``path:kind``, kind being required, type,
    pattern, too_short, too_long or unknown (a name that a closed object doesn't list). Null, and what is no object, gives
    ``:no_object``. A list is ``name[]`` in a path, and a fault is given once however many items have it. ``text``: the column that was
    parsed, from which a document of the expected shape is read faster than from a variant."""
    found = f"array_distinct(array_compact(concat({', '.join(_faults(tree, doc, ''))})))"
    # a document that has all fields, of their types and none besides, is read as such a row at once; its lists may be empty
    plain = replace(tree, fields={name: inner for name, inner in tree.fields.items() if inner.required})
    lists = [name for name, inner in plain.fields.items() if inner.kind == "list"][:4]
    shapes = [_expected(replace(plain, fields=plain.fields | dict.fromkeys(some, Node("list", item=Node("void"))))) for k in range(len(lists) + 1) for some in combinations(lists, k)]
    read = f"from_json({text}, '{_expected(plain, True)}')" if text else f"try_variant_get({doc}, '$', '{_expected(plain, True)}')"
    fast = f"transform(array({read}), r -> array_distinct(array_compact(concat({', '.join(_typed_faults(plain, 'r', '', 0))}))))[0]"
    shape = f"schema_of_variant({doc})"
    if not text and any(inner.kind == "list" and inner.item.kind == "object" for inner in tree.fields.values()):
        # a list's shape doesn't tell what some of its items lack
        return F.expr(f"CASE WHEN try_variant_get({doc}, '$', 'map<string,variant>') IS NOT NULL THEN {found} ELSE array(':no_object') END")
    return F.expr(f"CASE WHEN {shape} IN ({', '.join(map(_literal, shapes))}) THEN {fast} WHEN startswith({shape}, 'OBJECT') THEN {found} ELSE array(':no_object') END")


def _counted(df: DataFrame, tree: Node) -> DataFrame:
    """(text, n): levelled documents and how many there are of each. Tasks combine equal ones before the shuffle, and the costlier levelling meets what is left."""
    some = df.select(_levelled(F.col("text"), tree).alias("text")).groupBy("text").agg(F.count("*").alias("n"))
    return some.select("n", _levelled_by_name(F.col("text"), tree).alias("text")).groupBy("text").agg(F.sum("n").alias("n"))


def json_report(df: DataFrame, value: str, tree: Node, shared: str | None = None) -> DataFrame:
    """(rule, n): how many JSON documents break each rule of ``tree``. Values that break none are levelled first, by patterns, so that documents become equal; those
    that are equal are counted, and parsed once, into a variant.

    ``shared``: a list of the root that documents end with and that many have alike. It is parsed once for all that have it, and what stands
    before it once a document. A document counts as cut only where the list's name stands once in this place and the list's text has one ``]``, which with
    the root's brace ends it: then it is one object exactly if both parts are JSON values, and what stands before has a member and not this one.
    Others are parsed whole. Lists are told apart by two 64-bit hashes.
    """
    if shared is None:
        parsed = _counted(df.select(_thinned(value, tree).alias("text")), tree).select("n", parsed_json("text").alias("doc"))
        return parsed.select("n", F.explode(json_violations("doc", tree)).alias("rule")).groupBy("rule").agg(F.sum("n").alias("n"))
    mark = f',"{shared}":['
    # substring_index is slow on long texts, so it is left at the first mark; contains isn't
    heads = _counted(df.select(F.col(value).alias("text")), tree).select("n", "text", F.substring_index("text", mark, 1).alias("head"))
    ends = heads.select("n", "text", "head", F.expr(f"substring(text, length(head) + {len(mark) + 1})").alias("rest"))
    one = (F.octet_length("head") < F.octet_length("text")) & F.endswith("rest", F.lit("]}")) & ~F.contains("rest", F.lit(mark)) & ~F.contains(F.expr("left(rest, length(rest) - 2)"), F.lit("]"))
    cut = ends.select("n", F.when(one, F.concat("head", F.lit("}"))).otherwise(F.col("text")).alias("text"), F.when(one, F.col("rest")).alias("rest"))
    parsed = cut.select("n", "rest", "text", F.col("text").rlike(r"^\s*\{\s*\}").alias("bare"), parsed_json("text").alias("doc"))
    before = json_violations("doc", replace(tree, fields={n: inner for n, inner in tree.fields.items() if n != shared}), "text")
    wrong = F.col("bare") | F.try_variant_get("doc", f"$.{shared}", "variant").isNotNull()
    none = F.array(F.lit(":no_object"))
    found = F.when(F.col("rest").isNull(), json_violations("doc", tree, "text")).when(wrong, none).otherwise(before)
    judged = parsed.select("n", "rest", found.alias("rules")).select("n", F.when(F.col("rules") != none, F.col("rest")).alias("rest"), "rules")
    name = lambda seed: F.when(F.col("rest").isNotNull(), F.xxhash64("rest", F.lit(seed)))
    named = judged.select("n", name(1).alias("a"), name(2).alias("b"), "rules", "rest")
    # a row for what stands before the list and one for the list: tasks combine equal ones before the shuffle
    rows = F.array(F.struct("rules", F.lit(None).cast("string").alias("rest")), F.when(F.col("rest").isNotNull(), F.struct(F.lit(None).cast("array<string>").alias("rules"), "rest")))
    counts = named.select("n", "a", "b", F.explode(F.array_compact(rows)).alias("x")).groupBy("a", "b", "x.rules", "x.rest").agg(F.sum("n").alias("n"))
    lists = counts.select("a", "b", "rules", "n", F.when(F.col("rest").isNotNull(), parsed_json(F.concat(F.lit("["), F.expr("left(rest, length(rest) - 1)")))).alias("list"), F.col("rest").isNotNull().alias("is_list"))
    inside = F.when(F.col("list").isNull(), none).otherwise(F.expr(f"array_distinct(array_compact(concat({', '.join(_faults(tree.fields[shared], 'list', shared))})))"))
    known = lists.select("a", "b", "rules", "n", F.when(F.col("is_list"), inside).alias("inside"))
    met = known.groupBy("a", "b").agg(F.collect_list(F.when(F.col("rules").isNotNull(), F.struct("rules", "n"))).alias("before"), F.first("inside", True).alias("inside"))
    each = met.select("inside", F.explode("before").alias("x")).select(F.when(F.col("inside") == none, none).otherwise(F.concat("x.rules", F.coalesce("inside", F.array().cast("array<string>")))).alias("rules"), "x.n")
    return each.select(F.explode("rules").alias("rule"), "n").groupBy("rule").agg(F.sum("n").alias("n"))


def _inside(x: Column, path: str) -> Column:
    for part in path.split(".")[1:]:
        x = x[part]
    return x


def _broken(rule: Rule) -> dict[str, "callable"]:
    """Kind of violation -> test of a text column."""
    checks = {}
    if rule.required:
        checks["required"] = lambda c: c.isNull()
    if rule.pattern:
        checks["pattern"] = lambda c: ~c.rlike(rule.pattern)
    if rule.shortest:
        checks["too_short"] = lambda c: F.length(c) < rule.shortest
    if rule.longest is not None:
        checks["too_long"] = lambda c: F.length(c) > rule.longest
    return checks


def violations(df: DataFrame, rules: tuple[Rule, ...], root: str | None = None) -> Column:
    """An array with the name of every rule that a row breaks. Each rule is one column expression made from its table row."""
    start = f"{root}." if root else ""
    tests = []
    for rule in rules:
        outer, is_list, inner = rule.path.partition("[]")
        for kind, broken in _broken(rule).items():
            if is_list:
                hit = F.exists(F.coalesce(F.col(start + outer), F.array()), lambda x: F.coalesce(broken(_inside(x, inner)), F.lit(False)))
            else:
                hit = F.coalesce(broken(F.col(start + outer)), F.lit(False))
            tests.append(F.when(hit, f"{rule.path}:{kind}"))
        if is_list and rule.required:
            tests.append(F.when(F.col(start + outer).isNull(), f"{outer}:required"))
    return F.array_distinct(F.array_compact(F.array(*tests)))


def conformance_report(df: DataFrame, rules: tuple[Rule, ...] = ENTITY_RULES, root: str | None = None) -> DataFrame:
    """(rule, n): how many rows break each rule."""
    return df.select(F.explode(violations(df, rules, root)).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def key_quality(df: DataFrame, key: str, level: str = "check_digits") -> DataFrame:
    return df.groupBy(key_reason(key, level).alias("reason")).agg(F.count("*").alias("n"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
