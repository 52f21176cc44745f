"""Column builders. All of them compile to JVM expressions; none calls Python for a row."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import TRUE_WORDS

KEY_LENGTH = 14
#: Weights of the two check digits.
WEIGHTS_FIRST = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
WEIGHTS_SECOND = (6, *WEIGHTS_FIRST)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# keys -------------------------------------------------------------------------------------------------------
def entity_key(base, order, digits) -> Column:
    """Base, order and check digits joined; null if a part is."""
    return F.concat(col(base), col(order), col(digits))


def key_prefix(key, length: int = 3, start: int = 1) -> Column:
    if length < 1:
        raise ValueError("a prefix has at least one character")
    return F.substring(col(key), start, length)


def clean_identifier(c) -> Column:
    """Letters and digits only, case kept; null becomes empty."""
    c = F.coalesce(col(c), F.lit(""))
    # most identifiers are clean already, which a scan tells at less cost than a replacement
    return F.when(c.rlike(r"^[0-9A-Za-z]*+\z"), c).otherwise(F.regexp_replace(c, "[^0-9A-Za-z]", ""))


def trimmed(c) -> Column:
    """Text without white space of any kind at its ends."""
    c = col(c)
    # most text has no white space, which a scan for visible ASCII tells at less cost than two searches
    return F.when(c.rlike(r"^[!-~]*+\z"), c).otherwise(F.regexp_replace(c, r"(?U)^\s+|\s+\z", ""))


def normalize_key(c) -> Column:
    """Mask characters removed, upper case; null or white space becomes empty."""
    c = col(c)
    return F.when(~F.coalesce(c, F.lit("")).rlike(r"(?U)\S"), "").otherwise(F.upper(F.translate(c, "./-", "")))


def check_digits(base) -> Column:
    """The two check digits of a 12-character base, as text; null for any other text.

    A character counts as its code less 48. A digit is 11 less the weighted sum modulo 11, and 0 where that is over 9.
    """
    base = F.upper(col(base))
    # an array is made once for each sum; twelve substrings would evaluate the base twelve times
    values = F.transform(F.split(base, ""), lambda c: F.ascii(c) - 48)
    times = lambda weights: F.zip_with(values, F.array(*map(F.lit, weights)), lambda v, w: v * w)
    weighted = lambda weights: F.aggregate(times(weights), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    digit = lambda total: (11 - total % 11) % 11 % 10
    first = digit(weighted(WEIGHTS_FIRST))
    second = digit(weighted(WEIGHTS_SECOND[:12]) + first * WEIGHTS_SECOND[12])
    return F.when(base.rlike(r"^[A-Z0-9]{12}\z"), F.concat(first.cast("string"), second.cast("string")))


def key_reason(c, level: str = "check_digits") -> Column:
    """Why a key is not valid, or ``ok``: empty, bad_character, bad_length, bad_pattern, repeated, bad_digits.

    level: ``pattern`` ignores white space around the key and stops after the pattern, ``format`` also refuses repeated characters, ``check_digits`` also
    compares the last two digits.
    """
    if level not in ("pattern", "format", "check_digits"):
        raise ValueError(level)
    c = trimmed(c) if level == "pattern" else col(c)
    raw = normalize_key(c)
    out = F.when(raw == "", "empty").when(c.rlike("[^A-Za-z0-9./-]"), "bad_character").when(F.length(raw) != KEY_LENGTH, "bad_length").when(~raw.rlike(r"^[A-Z0-9]{12}[0-9]{2}\z"), "bad_pattern")
    if level != "pattern":
        out = out.when(raw.rlike(r"^(.)\1{13}\z"), "repeated")
    if level == "check_digits":
        out = out.when(check_digits(F.substring(raw, 1, 12)) != F.substring(raw, 13, 2), "bad_digits")
    return out.otherwise("ok")


def is_valid_key(c, level: str = "check_digits") -> Column:
    if level != "pattern":
        return key_reason(c, level) == "ok"
    # what key_reason says, with the text named only twice: nested, its own form can outgrow what Spark compiles
    c = col(c)
    bare = F.upper(F.regexp_replace(c, r"(?U)[./\s-]", ""))
    return F.coalesce(c.rlike(r"(?U)^\s*[A-Za-z0-9./-]*\s*\z") & bare.rlike(r"^[A-Z0-9]{12}[0-9]{2}\z"), F.lit(False))


def key_parts(c) -> Column:
    """struct(base, ord, digits, problem): null parts and a reason where the length is wrong."""
    raw = normalize_key(c)
    good = F.length(raw) == KEY_LENGTH
    part = lambda at, n: F.when(good, F.substring(raw, at, n))
    return F.struct(part(1, 8).alias("base"), part(9, 4).alias("ord"), part(13, 2).alias("digits"), F.when(~good, F.concat(F.lit("length "), F.length(raw).cast("string"))).alias("problem"))


def mask_key(c) -> Column:
    """XX.XXX.XXX/XXXX-XX; other lengths stay as they are."""
    raw = normalize_key(c)
    return F.when(F.length(raw) == KEY_LENGTH, F.regexp_replace(raw, "^(.{2})(.{3})(.{3})(.{4})(.{2})$", r"$1.$2.$3/$4-$5")).otherwise(col(c))


# values -----------------------------------------------------------------------------------------------------
def or_empty(c) -> Column:
    return F.coalesce(col(c), F.lit(""))


def label(c, names: dict[str, str], fallback: str = "raw", pad: int = 0) -> Column:
    """Name of a code. fallback: ``raw`` (the code, perhaps null), ``empty`` (the code, null becomes '') or ``blank`` ('')."""
    raw = col(c)
    code = F.lpad(raw, pad, "0") if pad else raw
    out = None
    for k, v in names.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out.otherwise({"raw": raw, "empty": or_empty(raw), "blank": F.lit("")}[fallback])


def code_struct(c, names: dict[str, str]) -> Column:
    return F.struct(or_empty(c).alias("codigo"), label(c, names, "blank").alias("descricao"))


def guarded_date(c) -> Column:
    """YYYYMMDD becomes YYYY-MM-DD; other text stays, null becomes ''."""
    c = col(c)
    return F.when(c.rlike(r"^[0-9]{8}\z"), F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))).otherwise(or_empty(c))


def typed_date(c) -> Column:
    """A date from the text fields; null where there is none."""
    return F.try_to_date(F.nullif(col(c), F.lit("")), "yyyy-MM-dd")


def split_list(c, separator: str = ",") -> Column:
    """Items of a list in text; null and '' give an empty list."""
    c = col(c)
    return F.when(c.isNotNull() & (c != ""), F.split(c, re.escape(separator))).otherwise(F.array().cast("array<string>"))


def compact(*structs: Column) -> Column:
    """An array of the structs that aren't null."""
    return F.filter(F.array(*structs), lambda x: x.isNotNull())


def json_text(*fields: Column) -> Column:
    """A JSON object with its fields in order, nulls included."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


#: Stands between the values of ``json_values``; no JSON text has it but as an escape.
UNIT = "\x1f"


def json_values(*fields: Column) -> Column:
    """Texts that aren't null as they stand within the quotes of JSON strings, joined by ``UNIT``: what is left of an object when its names are known."""
    raw = F.concat_ws(UNIT, *fields)
    # nearly no value needs an escape, which one scan tells for all of them; text that is no UTF-8 counts as one that does. The class
    # lists single bytes: with a range and U+FFFD in it the scan took many times as long
    escapes = "".join(f"\\x{i:02x}" for i in (*range(0x20), ord('"'), ord("\\")))
    plain = rf"[^{escapes}]*+"
    quoted = [F.to_json(F.array(f)) for f in fields]
    escaped = F.concat_ws(UNIT, *[F.substring(q, F.lit(3), F.length(q) - 4) for q in quoted])
    known = raw.rlike(rf"^(?:{plain}\x1f){{{len(fields) - 1}}}{plain}\z") & F.is_valid_utf8(raw) & ~F.contains(raw, F.lit("\ufffd"))
    return F.when(known, raw).otherwise(escaped)


def json_objects(values, names: list[str | tuple[str, ...]]) -> Column:
    """The JSON text of a list of objects from an array of ``json_values``. A tuple in ``names`` is a name and the names of the object it stands for."""
    gaps, before = [], "{"
    for name in names:
        outer, *inner = (name,) if isinstance(name, str) else name
        gaps += [f'{before}"{outer}":{{"{inner[0]}":"', *(f'","{n}":"' for n in inner[1:])] if inner else [f'{before}"{outer}":"']
        before = '"},' if inner else '",'
    # one replacement for the whole list: no JSON text holds the marks around an object
    value, template = "([^\\x1d\\x1f]*+)", "".join(f"{gap}${i}" for i, gap in enumerate(gaps, 1))
    marked = F.concat(F.lit("\x1e"), F.array_join(col(values), "\x1d,\x1e"), F.lit("\x1d"))
    objects = F.regexp_replace(marked, rf"\x1e{r'\x1f'.join([value] * len(gaps))}\x1d", template + before.removesuffix(",") + "}")
    return F.when(F.size(col(values)) > 0, F.concat(F.lit("["), objects, F.lit("]"))).otherwise("[]")


def money(c) -> Column:
    """Decimal from text with a comma before the cents; points between thousands are allowed."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(col(c)), r"\.", ""), ",", ".")
    return F.when(plain.rlike(r"^-?[0-9]+(\.[0-9]+)?\z"), plain.try_cast("decimal(18,2)"))


def truth(c) -> Column:
    """Whether text means yes; never null."""
    return F.lower(or_empty(c)).isin(*TRUE_WORDS)


def content_hash(payload) -> Column:
    return F.md5(col(payload))


def source_fingerprint(given, *seed) -> Column:
    """A hex digest of 32, 40 or 64 digits as it is (lower-cased), else SHA-256 of the joined seed."""
    given = F.trim(or_empty(given))
    return F.when(given.rlike(r"^(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64})\z"), F.lower(given)).otherwise(F.sha2(F.concat_ws("|", *map(or_empty, seed)), 256))


def parsed_json(text) -> Column:
    """The variant of text that is exactly one JSON value; null for any other text, also where something follows the value or an object
    names a property twice."""
    # a parser stops after the first value: so the text is made an item, and what must follow it is a mark that it can't know
    text = col(text)
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.md5(text), F.lit('"]')))
    return F.when(F.try_variant_get(pair, "$[1]", "string") == F.md5(text), F.try_variant_get(pair, "$[0]", "variant"))


def json_members(text) -> Column:
    """The members of a JSON object as texts ``"name":value``, values as they are written (blanks between tokens left out)."""
    # control characters don't occur in valid JSON strings, so they can stand for escapes that would hide where a string ends
    plain = F.replace(F.replace(col(text), F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    tokens = F.regexp_extract_all(plain, F.lit(r'"[^"]*"|[{}\[\],:]|[^\s"{}\[\],:]+'), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("now"), F.array().cast("array<string>").alias("done"))

    def step(a: Column, t: Column) -> Column:
        depth = a["depth"] + F.when(t.isin("{", "["), 1).when(t.isin("}", "]"), -1).otherwise(0)
        ends = ((a["depth"] == 1) & (t == ",")) | (depth == 0)
        begins = a["depth"] == 0
        now = F.when(ends | begins, "").otherwise(F.concat(a["now"], t))
        return F.struct(depth.alias("depth"), now.alias("now"), F.when(ends, F.array_append(a["done"], a["now"])).otherwise(a["done"]).alias("done"))

    found = F.filter(F.aggregate(tokens, start, step)["done"], lambda m: m != "")
    return F.transform(found, lambda m: F.replace(F.replace(m, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\")))


def inject_key(payload, key, name: str = "cnpj", strict: bool = False) -> Column:
    """A JSON object with the property ``name`` set to the key: appended, and taken from where the payload had it before; all else stays as
    it is written. A JSON string that holds an object is unwrapped first.

    Null stays null. A payload that isn't exactly one JSON object, or names a property twice, gives null, or an error where ``strict``.
    """
    text = F.trim(col(payload))
    text = F.when(text.startswith('"'), F.trim(F.try_variant_get(parsed_json(text), "$", "string"))).otherwise(text)
    doc = parsed_json(text)
    is_object = text.startswith("{") & doc.isNotNull()
    # only a payload that has the property is taken apart
    has = F.try_variant_get(doc, f"$.{name}", "variant").isNotNull()
    rest = F.filter(json_members(text), lambda m: F.json_object_keys(F.concat(F.lit("{"), m, F.lit("}")))[0] != name)
    body = F.when(has, F.array_join(rest, ",")).otherwise(F.trim(F.substring(text, F.lit(2), F.length(text) - 2)))
    tail = F.concat(F.lit(f'"{name}":'), F.to_json(F.array(col(key))))
    tail = F.regexp_replace(tail, r":\[(.*)\]$", ":$1")
    out = F.when(is_object, F.concat(F.lit("{"), body, F.when(body != "", ",").otherwise(""), tail, F.lit("}")))
    return out.when(col(payload).isNotNull(), F.raise_error(F.concat(F.lit("no JSON object: "), F.substring(col(payload), 1, 100)))) if strict else out


def month(c) -> Column:
    """yyyy-MM of a timestamp or of text that holds one; null for other text."""
    return F.date_format(F.try_to_timestamp(col(c).cast("string")), "yyyy-MM")
