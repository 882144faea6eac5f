"""JSON helpers: many JSON paths from one parse.

``get_json_object`` re-parses the document once per path.  Here the set of
paths of a spec is turned into one ``from_json`` schema whose leaves are all
STRING (Spark renders numbers, booleans and nested values of a STRING field
as their JSON text), so a payload is parsed once and every leaf is a plain
struct/array access afterwards.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

_TOKEN = re.compile(r"\.([A-Za-z_][A-Za-z0-9_]*)|\['([^']+)'\]|\[(\d+)\]")


def parse_path(path: str) -> list[tuple[str, object]]:
    """``$.a.b[1]`` -> [("field","a"), ("field","b"), ("index",1)]."""
    if not path.startswith("$"):
        raise ValueError(f"JSON path must start with '$': {path!r}")
    pos, out = 1, []
    while pos < len(path):
        m = _TOKEN.match(path, pos)
        if not m:
            raise ValueError(f"unsupported JSON path syntax at {path[pos:]!r} in {path!r}")
        if m.group(1) is not None:
            out.append(("field", m.group(1)))
        elif m.group(2) is not None:
            out.append(("field", m.group(2)))
        else:
            out.append(("index", int(m.group(3))))
        pos = m.end()
    if not out:
        raise ValueError(f"empty JSON path {path!r}")
    return out


def _merge(node: dict | None, tokens: list[tuple[str, object]], path: str) -> dict | str:
    if not tokens:
        if node not in (None, "leaf"):
            raise ValueError(f"path {path!r} is both a leaf and a container")
        return "leaf"
    kind, name = tokens[0]
    if node is None:
        node = {"kind": kind, "children": {}}
    if node == "leaf" or node["kind"] != kind:
        raise ValueError(f"conflicting JSON structure at {path!r}")
    key = name if kind == "field" else "*"
    node["children"][key] = _merge(node["children"].get(key), tokens[1:], path)
    return node


def _to_type(node) -> DataType:
    if node == "leaf":
        return StringType()
    if node["kind"] == "field":
        return StructType([StructField(k, _to_type(v), True) for k, v in node["children"].items()])
    return ArrayType(_to_type(node["children"]["*"]), True)


def schema_for_paths(paths: list[str]) -> StructType:
    """The ``from_json`` schema that covers every path, leaves as STRING."""
    root = None
    for p in paths:
        toks = parse_path(p)
        if toks[0][0] != "field":
            raise ValueError(f"top-level JSON value must be an object for {p!r}")
        root = _merge(root, toks, p)
    t = _to_type(root)
    assert isinstance(t, StructType)
    return t


def path_column(parsed: Column, path: str) -> Column:
    """Navigate a parsed struct along ``path`` (out-of-range index -> NULL)."""
    c = parsed
    for kind, name in parse_path(path):
        if kind == "field":
            c = c.getField(name)
        else:
            # 1-based, NULL when out of range even under ANSI.
            c = F.try_element_at(c, F.lit(int(name) + 1))
    return c


#: What counts as JSON: NaN and Infinity do, single quotes do not.
_STRICT = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "true", "allowSingleQuotes": "false"}


def parse_object(text: Column, field: str) -> Column:
    """``struct<field string>`` of a text that is exactly one JSON object, else NULL.

    The parser stops at the end of the first value, so the text is parsed as
    the only element of an array and, if that holds, as the only field of an
    object: what follows the text's object would have to begin with ``]`` to
    get past the one and with ``}`` or ``,`` to get past the other.  The second
    parse is made only for texts that hold a ``}`` followed by a ``]``."""
    entry = StructType([StructField(field, StringType(), True)])
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), ArrayType(entry, True), _STRICT)
    boxed = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), StructType([StructField("x", entry, True)]), _STRICT)
    starts = F.startswith(F.ltrim(text, F.lit(" \t\n\r")), F.lit("{"))
    closed = F.rlike(text, F.lit(r"\}[\x00-\x20]*\]"))
    whole = ~closed | boxed.getField("x").isNotNull()
    # a lambda's variable: Catalyst would repeat the parse where it is asked for its size and again for its element
    only = F.transform(F.array(parsed), lambda a: F.when((F.size(a) == 1) & whole, F.get(a, F.lit(0))))
    return F.when(starts, F.get(only, F.lit(0)))


def json_string_field(text: Column, field: str, parsed: Column | None = None) -> Column:
    """Top-level field of a JSON text as STRING (NULL if absent / not JSON)."""
    v = F.try_parse_json(text) if parsed is None else parsed
    return F.try_variant_get(v, f"$.{field}", "string")
