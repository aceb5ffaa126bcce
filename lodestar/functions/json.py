"""JSON document accessors over a VARIANT column.

Semantics follow PostgreSQL's jsonb operators, which is what the silver rules
were written against:

* ``jtext``  (``->>``)  missing key and JSON null both give SQL NULL, scalars give
  their text, objects and arrays their JSON text;
* ``jvalue`` (``->``)   SQL NULL only when the key is *absent*; a JSON null is a
  (non-NULL) VARIANT null;
* ``jbool``  strict JSON boolean: only the JSON literals true/false convert; the
  JSON *string* "true" does not.

All of them are built-in expressions (``variant_get`` and friends), so they stay
inside whole-stage codegen and are pushed into the Parquet scan as typed
sub-columns when the documents are stored as VARIANT.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEGMENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*|\[\d+\]")


def jpath(path: str) -> str:
    """``"spaceTrack.DECAYED"`` or ``"chart.result[0]"`` -> a JSONPath for variant_get."""
    if path.startswith("$"):
        return path
    out = "$"
    for part in path.split("."):
        pieces = _SEGMENT.findall(part)
        if "".join(pieces) != part:
            # keys with unusual characters use the bracket form
            out += "['" + part.replace("'", "\\'") + "']"
            continue
        for piece in pieces:
            out += piece if piece.startswith("[") else "." + piece
    return out


def _col(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def jvalue(v, path: str) -> Column:
    """The VARIANT at ``path``; SQL NULL iff the path is absent."""
    return F.variant_get(_col(v), jpath(path), "variant")


def jabsent(v, path: str) -> Column:
    """True when the key is absent (``(data->'k') IS NULL``); false for JSON null."""
    return jvalue(v, path).isNull()


def jnull(v, path: str) -> Column:
    """True when the key is present and holds JSON null."""
    return F.coalesce(F.is_variant_null(jvalue(v, path)), F.lit(False))


def jtext(v, path: str) -> Column:
    """``data->>'k'`` / ``data->'a'->>'b'``."""
    return F.variant_get(_col(v), jpath(path), "string")


def jbool(v, path: str) -> Column:
    """Strict JSON boolean: ``true``/``false`` literals only, everything else NULL."""
    text = F.to_json(jvalue(v, path))
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def jlen(v, path: str) -> Column:
    """Array length if the key holds an array, 0 if the key is absent, NULL otherwise."""
    arr = F.try_variant_get(_col(v), jpath(path), "array<variant>")
    return (F.when(jabsent(v, path), F.lit(0))
             .when(arr.isNotNull(), F.size(arr)))


def jnum(v, path: str, dtype: str = "decimal(38,18)", lenient: bool = False) -> Column:
    """Number at ``path`` as ``dtype``; a JSON number and a numeric string both work.
    Strict mode raises on malformed text (like a ``::numeric`` cast), lenient gives NULL."""
    fn = F.try_variant_get if lenient else F.variant_get
    return fn(_col(v), jpath(path), dtype)


#: Map values and their totals: below 10^19, 18 places (sums of two fit DECIMAL(38,18)).
NUMBER = "decimal(37,18)"


def jmap(s, dtype: str = NUMBER) -> Column:
    """Flat JSON object text -> MAP; values (numbers or numeric strings) as DECIMAL, so sums
    are exact in any order.  Malformed text, repeated keys and values that are no number or
    do not fit raise; JSON null is NULL."""
    made = F.variant_get(F.parse_json(_col(s)), "$", f"map<string,{dtype}>")
    # documents may repeat keys (a session setting), a map that is added up may not
    keys = F.json_object_keys(_col(s))
    return F.when(F.size(keys) > F.size(F.array_distinct(keys)), F.raise_error(F.lit("a map repeats a key"))).otherwise(made)


def map_sum(m) -> Column:
    """Sum of a map's values (0 for an empty map, NULL for a NULL map); raises beyond ``NUMBER``."""
    zero = F.lit(0).cast(NUMBER)
    return F.aggregate(F.map_values(_col(m)), zero, lambda acc, x: (acc + F.coalesce(x, zero)).cast(NUMBER))


def json_null() -> Column:
    """A JSON null value, to place in a struct before ``to_document``."""
    return F.parse_json(F.lit("null"))


def to_document(struct: Column, keep_null_fields: bool = False) -> Column:
    """Serialise a struct to JSON text.

    By default SQL NULL fields are left out (an *absent* key), while VARIANT
    nulls (``json_null()``) print as ``null``; that keeps the absent-vs-null
    distinction the silver rules depend on.  ``keep_null_fields`` prints every
    SQL NULL as ``null`` instead.
    """
    opts = {"ignoreNullFields": "false"} if keep_null_fields else None
    return F.to_json(struct, opts) if opts else F.to_json(struct)


def _plain(c: Column, kind: T.DataType) -> Column:
    """True when the value as a VARIANT reads like its JSON text parsed again: no NULL
    field (it would be left out), no type that JSON text turns into another one."""
    if isinstance(kind, T.StructType):
        out = c.isNotNull()
        for f in kind.fields:
            out = out & _plain(c[f.name], f.dataType)
        return out
    if isinstance(kind, T.ArrayType):
        kind = kind.elementType
    if isinstance(kind, T.DecimalType):
        return c.isNotNull() if kind.scale <= 6 else F.lit(False)     # smaller ones print with an exponent
    same = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.VariantType)
    return c.isNotNull() if isinstance(kind, same) else F.lit(False)


def with_document(rows: DataFrame, struct: Column, name: str = "data") -> DataFrame:
    """``rows`` with ``name``: the VARIANT of ``parse_json(to_document(struct))``.  Rows whose
    fields are all present, as JSON has them, become one without a text in between: printing
    and parsing costs several times what the document does.  VARIANT fields stay as they are."""
    made = rows.withColumn(name, struct)
    doc = F.col(name)
    return made.withColumn(name, F.when(_plain(doc, made.schema[name].dataType), F.to_variant_object(doc))
                           .otherwise(F.parse_json(to_document(doc))))
