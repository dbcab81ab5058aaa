"""SQL-text forms of the column helpers, for operators stated as Spark SQL.

Operators run ``spark.sql(text, df=...)``: the DataFrame arguments become temporary
views for the one statement, so a whole step costs a few driver-JVM round trips
however many expressions it has (the Column API pays one per function call).
Catalyst sees the same plan either way.

In texts passed with DataFrame arguments, ``{name}`` is a DataFrame placeholder;
every literal below escapes braces, quotes and backslashes as ``\\uXXXX``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .text import PY_WHITESPACE

_ASCII_SEPARATORS = " \t\n\r\f"


def lit(s: str) -> str:
    """A Spark SQL string literal for any text (non-ASCII-letter specials as \\uXXXX)."""
    out = []
    for ch in s:
        if ch in "'\\{}" or ch.isspace() or not ch.isprintable():
            out.append("\\u%04X" % ord(ch))
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


WS = lit(PY_WHITESPACE)

# Fixed value: keyword separator of the documents binding (space, tab, LF, CR, FF).
SPLIT = lit(r"[ \t\n\r\f]+")
# Separator runs plus tokens made only of other whitespace (see text.split_keywords).
_OTHER = "".join("\\u%04x" % ord(c) for c in PY_WHITESPACE if c not in _ASCII_SEPARATORS)
_ANY_OTHER = lit("[" + _OTHER + "]")
SPLIT_EXACT = lit(r"(?:[ \t\n\r\f]|(?<![^ \t\n\r\f])[" + _OTHER + r"]+(?![^ \t\n\r\f]))+")


def strip(x: str) -> str:
    """Python ``str.strip()`` of a SQL expression."""
    return f"btrim({x}, {WS})"


def strip_word(x: str) -> str:
    """``strip`` of a column of short words: one that begins and ends with a visible ASCII character,
    as nearly all do, is taken as it is (``btrim`` builds tables as long as its text, and looks the
    ends up among all white space). ``x`` is stated several times: a column, no expression."""
    return f"(CASE WHEN {x} BETWEEN '!' AND '~' AND substring({x}, -1) BETWEEN '!' AND '~' THEN {x} ELSE {strip(x)} END)"


def visible_word(x: str) -> str:
    """Whether a column of short words has more than white space in it."""
    return f"({x} BETWEEN '!' AND '~' OR {strip(x)} <> '')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} = '')"


def falsy_key(text: str, falsy: str | None) -> str:
    """``str(x or "").strip()`` given the text and its falsy flag."""
    base = f"coalesce({strip(text)}, '')"
    return base if falsy is None else f"CASE WHEN coalesce({falsy}, false) THEN '' ELSE {base} END"


def clean_keywords(arr: str) -> str:
    return (f"coalesce(filter(transform({arr}, k -> {strip_word('k')}), k -> k IS NOT NULL AND k <> ''), "
            f"cast(array() AS array<string>))")


def split_keywords(text: str) -> str:
    # without those other white spaces the plain separators split alike, in a third of the time
    return f"array_remove(CASE WHEN {text} RLIKE {_ANY_OTHER} THEN split({text}, {SPLIT_EXACT}) ELSE split({text}, {SPLIT}) END, '')"


# ---- JSON values (VARIANT) ----

def is_missing(v: str) -> str:
    return f"({v} IS NULL OR is_variant_null({v}))"


def as_list(v: str) -> str:
    return f"try_variant_get({v}, '$', 'array<variant>')"


def as_dict(v: str) -> str:
    return f"try_variant_get({v}, '$', 'map<string,variant>')"


_ROOT, _DOUBLE = "'$'", "'double'"


def plain_text(v: str) -> str:
    """A JSON value as Spark prints it: for fields that no key or rule is made of."""
    return f"cast({v} AS string)"


def as_text(v: str) -> str:
    """``str()`` of a JSON scalar as Python has it (null stays NULL); a list or object comes as JSON
    text, for which ``python_text`` has Python's form. Strings and integers, nearly all values, take
    the first branch; the expression is kept small, for it is stated for every field. VARIANT does not
    keep the sign of -0.0, integers beyond 38 digits, and whether a whole number beyond 64 bits had a
    decimal point (it counts as an integer)."""
    return (f"(CASE WHEN coalesce(schema_of_variant({v}) IN ('STRING', 'BIGINT', 'VOID'), true) THEN cast({v} AS string) "
            f"ELSE {_let(f'named_struct({_K}, schema_of_variant({v}), {_S}, cast({v} AS string))', 'x', _SCALAR)} END)")


_K, _S = "'k'", "'s'"


def python_text(v: str) -> str:
    """``str()`` of any JSON value, lists and objects included (their whole floats and the order of
    keys are what VARIANT keeps of them)."""
    kind = f"schema_of_variant({v})"
    return (f"(CASE WHEN {kind} LIKE 'ARRAY%' OR {kind} LIKE 'OBJECT%' THEN {python_container(f'to_json({v})')} "
            f"ELSE {as_text(v)} END)")


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is stated and evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def python_quoted(s: str) -> str:
    """SQL: ``repr`` of a string: single quotes unless it holds those and no double ones; backslash,
    line ends and what does not print as escapes."""
    slash, hidden = "char(92)", lit(r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}[\p{Zs}&&[^ ]]]")
    base = f"replace(s, {slash}, concat({slash}, {slash}))"
    for code, letter in ((10, "n"), (13, "r"), (9, "t")):
        base = f"replace({base}, char({code}), concat({slash}, {lit(letter)}))"
    code = "lower(hex(ascii(c)))"
    escaped = (f"CASE WHEN NOT b RLIKE {hidden} THEN b ELSE array_join(transform(split(b, ''), c -> "
               f"CASE WHEN c = '' OR NOT c RLIKE {hidden} THEN c WHEN ascii(c) < 256 THEN concat({slash}, 'x', lpad({code}, 2, '0')) "
               f"WHEN ascii(c) < 65536 THEN concat({slash}, 'u', lpad({code}, 4, '0')) "
               f"ELSE concat({slash}, 'U', lpad({code}, 8, '0')) END), '') END")
    body = (f"CASE WHEN NOT contains(s, char(39)) THEN concat(char(39), {_let(base, 'b', escaped)}, char(39)) "
            f"WHEN NOT contains(s, char(34)) THEN concat(char(34), {_let(base, 'b', escaped)}, char(34)) "
            f"ELSE concat(char(39), {_let(f'replace({base}, char(39), concat({slash}, char(39)))', 'b', escaped)}, char(39)) END")
    return _let(s, "s", body)


def python_container(json: str) -> str:
    """SQL: the JSON text of a list or object as Python prints it, token by token, however deep."""
    text = "get_json_object(concat(char(123), char(34), 'k', char(34), ':', t, char(125)), '$.k')"
    return (f"array_join(transform({json_tokens(json)}, t -> CASE t WHEN ',' THEN ', ' WHEN ':' THEN ': ' "
            f"WHEN 'true' THEN 'True' WHEN 'false' THEN 'False' WHEN 'null' THEN 'None' "
            f"ELSE CASE WHEN startswith(t, char(34)) THEN {python_quoted(text)} "
            f"WHEN t RLIKE '[.E]' THEN {python_number('t')} ELSE t END END), '')")


def _scalar_text() -> str:
    """SQL over ``x`` (kind k, Spark's text s): booleans and floats as Python prints them."""
    return (f"CASE WHEN x.k = 'BOOLEAN' THEN initcap(x.s) "
            f"WHEN x.k = 'DOUBLE' OR (x.k LIKE 'DECIMAL%' AND (x.k NOT LIKE '%,0)' OR try_cast(x.s AS bigint) IS NOT NULL)) "
            f"THEN {python_float('cast(x.s AS double)')} ELSE x.s END")


def is_falsy(v: str) -> str:
    kind = f"schema_of_variant({v})"
    num = f"try_variant_get({v}, '$', 'double')"
    return (f"(CASE WHEN {is_missing(v)} THEN true "
            f"WHEN {kind} = 'STRING' THEN {plain_text(v)} = '' "
            f"WHEN {kind} = 'BOOLEAN' THEN {plain_text(v)} = 'false' "
            f"WHEN startswith({kind}, 'ARRAY') THEN size({as_list(v)}) = 0 "
            f"WHEN startswith({kind}, 'OBJECT') THEN size(map_keys({as_dict(v)})) = 0 "
            f"WHEN {num} IS NOT NULL THEN {num} = 0 ELSE false END)")


def extraction_keywords(v: str) -> str:
    # a list of strings, as nearly all are, is taken in one piece, not element by element
    return (f"(CASE WHEN {is_missing(v)} THEN cast(array() AS array<string>) "
            f"WHEN schema_of_variant({v}) = 'ARRAY<STRING>' THEN "
            f"filter(try_variant_get({v}, '$', 'array<string>'), s -> s IS NOT NULL AND {visible_word('s')}) "
            f"WHEN {as_list(v)} IS NOT NULL THEN filter(transform({as_list(v)}, e -> {as_text('e')}), "
            f"s -> s IS NOT NULL AND {strip('s')} <> '') "
            f"ELSE {_let(as_text(v), 'k', f"filter(array(k), s -> {strip('s')} <> '')")} END)")


def _class_code(e: str) -> str:
    d = as_dict(e)
    return (f"CASE WHEN {d} IS NOT NULL THEN named_struct('system', {plain_text(d + '[' + lit('system') + ']')}, "
            f"'code', {plain_text(d + '[' + lit('code') + ']')}) "
            f"ELSE named_struct('system', cast(NULL AS string), 'code', {plain_text(e)}) END")


def class_codes(v: str) -> str:
    return (f"(CASE WHEN {is_missing(v)} THEN cast(array() AS array<struct<system:string,code:string>>) "
            f"WHEN {as_list(v)} IS NOT NULL THEN transform({as_list(v)}, e -> {_class_code('e')}) "
            f"ELSE array({_class_code(v)}) END)")


# ---- JSON text, token by token ----

#: Strings, brackets and separators, and everything else (numbers, true, false, null).
_TOKENS = lit(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{}:,]|[^\[\]{}:,"\s]++')


def json_tokens(text: str) -> str:
    return f"regexp_extract_all({text}, {_TOKENS}, 0)"


def python_float(d: str) -> str:
    """A double as Python prints it: the shortest digits, with an exponent from 1e16 on and below 1e-4."""
    # f is plain from 1e-3 to 1e7, otherwise one digit, point, digits, E, exponent; here n = digits, e = exponent
    whole = "rpad(n, greatest(e + 1, length(n)), '0')"
    spread = (f"CASE WHEN e >= 16 OR e < -4 THEN concat(substring(n, 1, 1), CASE WHEN length(n) > 1 THEN "
              f"concat('.', substring(n, 2)) ELSE '' END, 'e', CASE WHEN e < 0 THEN '-' ELSE '+' END, "
              f"lpad(cast(abs(e) AS string), greatest(2, length(cast(abs(e) AS string))), '0')) "
              f"WHEN e < 0 THEN concat('0.', repeat('0', -e - 1), n) "
              f"ELSE {_let(whole, 'w', 'concat(substring(w, 1, e + 1), char(46), CASE WHEN length(w) > e + 1 THEN substring(w, e + 2) ELSE char(48) END)')} END")
    digits = "replace(regexp_replace(replace(element_at(split(f, 'E'), 1), '-', ''), '[.]0$', ''), '.', '')"
    long = _let(digits, "n", _let("cast(element_at(split(f, 'E'), 2) AS int)", "e", spread))
    body = ("CASE WHEN f IN ('Infinity', '-Infinity') THEN replace(lower(f), 'inity', '') WHEN f = 'NaN' THEN 'nan' "
            f"WHEN NOT contains(f, 'E') THEN f ELSE concat(CASE WHEN startswith(f, '-') THEN '-' ELSE '' END, {long}) END")
    return _let(f"cast({d} AS string)", "f", body)


def python_number(token: str) -> str:
    """A JSON number as Python prints it."""
    return f"(CASE WHEN {token} RLIKE '[.eE]' THEN {python_float(f'cast({token} AS double)')} ELSE {token} END)"


_SCALAR = _scalar_text()


def run(spark: SparkSession, text: str, **dfs: DataFrame) -> DataFrame:
    """One SQL step over DataFrame arguments (``{name}`` placeholders)."""
    return spark.sql(text, **dfs) if dfs else spark.sql(text)


def cols(names) -> str:
    return ", ".join(names)
