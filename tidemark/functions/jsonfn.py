"""JSON identity and field access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


#: Where a number starts, outside strings, after all that is no number.
_NUMBER = (r'\G((?:[^"0-9\-]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+)'
           r'(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+\-]?[0-9]++)?+)(?=\s*+(?:[,\]}]|\z))')
#: A text without these has no number that Spark's own normal form would change
#: or refuse: exponents, and more digits than a 38-digit decimal holds.
_WIDE = r"[0-9][eE]|[0-9][0-9.]{37}"
_CUT = "\u0000"
#: Stands in front of a number that is kept as a string on its way.
_MARK = r"\u0001"
#: Longest run of zeros, and integer, that is written out in full.
_PLAIN = 40


def _normal_numbers(texts: Column) -> Column:
    """One decimal text for each value, computed on digits: ``0.1e1``, ``1.0``
    and ``1`` give ``1``. Beyond 40 places it has an exponent (``1e400``).
    Element NULL where the exponent itself is beyond 38 digits."""
    parts = F.transform(texts, lambda n: F.struct(
        F.startswith(n, F.lit("-")).alias("minus"),
        F.ltrim(F.concat(F.regexp_extract(n, "^-?([0-9]+)", 1), F.regexp_extract(n, r"\.([0-9]+)", 1)), F.lit("0")).alias("digits"),
        F.length(F.regexp_extract(n, r"\.([0-9]+)", 1)).alias("after"),
        F.regexp_extract(n, "[eE](.+)$", 1).alias("power")))
    exact = F.transform(parts, lambda p: F.struct(
        p["minus"].alias("minus"), F.rtrim(p["digits"], F.lit("0")).alias("d"),
        (F.when(p["power"] == "", F.lit(0).cast("decimal(38,0)")).otherwise(p["power"].try_cast("decimal(38,0)"))
         - p["after"] + F.length(p["digits"]) - F.length(F.rtrim(p["digits"], F.lit("0")))).cast("decimal(38,0)").alias("e")))

    def spelt(x):
        d, e, n = x["d"], x["e"], F.length(x["d"])
        places = F.when(F.abs(e) <= _PLAIN, e).cast("int")
        plain = F.when((e >= 0) & (e + n <= _PLAIN), F.concat(d, F.repeat(F.lit("0"), places))) \
            .when((e < 0) & (e >= -_PLAIN) & (n > -e), F.concat(F.substring(d, F.lit(1), n + places), F.lit("."), F.substring(d, n + places + 1, -places))) \
            .when((e < 0) & (e >= -_PLAIN), F.concat(F.lit("0."), F.repeat(F.lit("0"), -places - n), d))
        first, rest = F.substring(d, F.lit(1), F.lit(1)), F.substring(d, F.lit(2), n)
        powered = F.concat(first, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), F.lit("e"), (e + n - 1).cast("decimal(38,0)").cast("string"))
        return F.when(d == "", F.lit("0")).otherwise(F.concat(F.when(x["minus"], "-").otherwise(""), F.coalesce(plain, powered)))

    return F.transform(exact, spelt)


def _exact_json(text: Column) -> Column:
    """Canonical text in which every number keeps its value. Numbers pass the
    parser as marked strings; strings that begin with the mark get it twice."""
    escaped = F.regexp_replace(text, r'(?<!\\)"\\u0001', r'"\\u0001\\u0001')
    pieces = F.split(F.regexp_replace(escaped, _NUMBER, "$1" + _CUT), _CUT)
    numbers = _normal_numbers(F.regexp_extract_all(escaped, F.lit(_NUMBER), F.lit(2)))
    # one piece more than numbers
    joined = F.zip_with(pieces, F.concat(numbers, F.array(F.lit(""))), lambda piece, n: F.when(
        n == "", piece).otherwise(F.concat(piece, F.lit(f'"{_MARK}'), n, F.lit('"'))))
    whole = ~F.exists(joined, lambda piece: piece.isNull()) & ~F.contains(text, F.lit(_CUT))
    marked = F.to_json(F.try_parse_json(F.when(whole, F.array_join(joined, ""))))
    numbers_back = F.regexp_replace(marked, r'(?<!\\)"\\u0001([0-9\-][^"\\]*+)"', "$1")
    return F.regexp_replace(numbers_back, r'(?<!\\)"\\u0001\\u0001', r'"\\u0001')


def canonical_json(col: Column | str) -> Column:
    """Canonical text of a JSON document: keys sorted, no spacing, numbers in
    their exact normal form (``2.0``, ``0.2e1`` → ``2``), whatever their size.
    NULL when the text is not JSON. Two payloads have the same canonical text
    exactly when they are the same record."""
    # the argument is computed once, however dear it is
    return F.transform(F.array(_c(col)), lambda x: F.when(x.rlike(_WIDE), _exact_json(x)).otherwise(F.to_json(F.try_parse_json(x))))[0]


def json_value(col: Column | str, path: str) -> Column:
    """Scalar at ``path`` as STRING; NULL for objects, arrays, JSON null,
    missing paths and unparseable text."""
    v = F.try_parse_json(_c(col))
    node = F.try_variant_get(v, path, "variant")
    kind = F.schema_of_variant(node)
    scalar = ~(kind.startswith("OBJECT") | kind.startswith("ARRAY") | (kind == "VOID"))
    return F.when(scalar, F.try_variant_get(v, path, "string"))
