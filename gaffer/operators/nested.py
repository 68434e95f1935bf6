"""JSON payload operators: typed unnesting and packing.

Payloads stay strings until read; each read names its fields with an explicit
schema whose leaves are STRING, then casts (schema-on-read, no inference).
Catalyst prunes the ``from_json`` schema down to the fields actually used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaffer.functions.scalars import typed


def _leaf_struct(fields: dict) -> T.StructType:
    """Schema of one JSON object from a field spec ``{out: (path, type, cleaner)}``.

    Paths may be dotted (``entry_history.bank``); every leaf is STRING.
    """
    tree: dict = {}
    for spec in fields.values():
        path = spec[0] if isinstance(spec, (tuple, list)) else spec
        node = tree
        parts = path.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node.setdefault(parts[-1], None)

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(k, T.StringType() if v is None else build(v), True)
            for k, v in node.items()
        ])

    return build(tree)


def _project(obj: Column, fields: dict, lenient: bool) -> list[Column]:
    cols = []
    for out, spec in fields.items():
        if isinstance(spec, (tuple, list)):
            path, dtype = spec[0], spec[1]
            cleaner = spec[2] if len(spec) > 2 else None
        else:
            path, dtype, cleaner = spec, "string", None
        c = obj
        for p in path.split("."):
            c = c.getField(p)
        if cleaner is not None:
            c = cleaner(c)
        c = dtype(c) if callable(dtype) else typed(c, dtype, lenient)
        cols.append(c.alias(out))
    return cols


def unnest_json(df: DataFrame, payload: str, fields: dict, path: str | None = None,
                carry: Sequence[str] = (), lenient: bool = False) -> DataFrame:
    """JSN-1/2/3: one row per element of the array at ``path`` (root array when
    ``path`` is None), projected to typed columns.

    An empty array, a missing key or JSON null gives zero rows (``explode``),
    matching ``jsonb_array_elements`` on the happy path.
    """
    elem = _leaf_struct(fields)
    if path is None:
        schema = T.ArrayType(elem)
        arr = F.from_json(F.col(payload), schema)
    else:
        schema = T.StructType([T.StructField(path, T.ArrayType(elem), True)])
        arr = F.from_json(F.col(payload), schema).getField(path)
    exploded = df.select(*[F.col(c) for c in carry], F.explode(arr).alias("__e"))
    return exploded.select(*[F.col(c) for c in carry], *_project(F.col("__e"), fields, lenient))


def documents(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(doc, payload): payloads parsed once to VARIANT, for models that take different
    arrays out of one payload. A payload that a variant can't hold (not JSON, or
    beyond its size limit) is kept as text instead and read by :func:`unnest_documents` as such."""
    doc = F.try_parse_json(F.col(payload))
    return df.select(doc.alias("doc"), F.col(payload).alias("payload")) \
        .withColumn("payload", F.when(F.col("doc").isNull(), F.col("payload")))


def unnest_documents(docs: DataFrame, fields: dict, path: str, lenient: bool = False) -> DataFrame:
    """JSN-1/3 over :func:`documents`: as :func:`unnest_json`, without parsing again."""
    elem = T.ArrayType(_leaf_struct(fields))
    stored = F.try_variant_get(F.col("doc"), f"$.{path}", elem.simpleString())
    text = F.from_json(F.col("payload"), T.StructType([T.StructField(path, elem, True)])).getField(path)
    rows = docs.select(F.explode(F.when(F.col("payload").isNull(), stored).otherwise(text)).alias("__e"))
    return rows.select(*_project(F.col("__e"), fields, lenient))


def parse_json(df: DataFrame, payload: str, fields: dict, carry: Sequence[str] = (),
               lenient: bool = False) -> DataFrame:
    """JSN-4/5: fields of a root object (dotted paths reach nested objects)."""
    obj = F.from_json(F.col(payload), _leaf_struct(fields))
    return df.select(*[F.col(c) for c in carry], F.struct(obj.alias("__o")).alias("__w")) \
        .select(*[F.col(c) for c in carry], *_project(F.col("__w.__o"), fields, lenient))


def null_array_payloads(df: DataFrame, payload: str, path: str | None = None) -> DataFrame:
    """T10 strict mode: payloads whose array is absent or not an array (the
    reference raises on these; we report them for the quality suite)."""
    probe = T.ArrayType(T.StringType()) if path is None else \
        T.StructType([T.StructField(path, T.ArrayType(T.StringType()), True)])
    arr = F.from_json(F.col(payload), probe)
    if path is not None:
        arr = arr.getField(path)
    return df.where(arr.isNull())


def pack_json(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
              order_col: str, batch: int = 64, path: str | None = None,
              payload: str = "payload") -> DataFrame:
    """JSN-6: rows -> JSON array cells (the landing form of an array payload).

    Cells are bounded: rows are grouped by ``keys`` and ``floor(order_col /
    batch)`` so no cell (and no task) ever holds an unbounded group. With
    ``path`` the array is wrapped as ``{path: [...]}``, else it is the root.
    """
    bucket = F.floor(F.col(order_col) / F.lit(batch)).alias("__cell")
    grouped = (df.select(*keys, bucket, F.struct(*cols).alias("__r"))
                 .groupBy(*keys, "__cell")
                 .agg(F.collect_list("__r").alias("__arr")))
    value = F.struct(F.col("__arr").alias(path)) if path else F.col("__arr")
    return grouped.select(*keys, "__cell", F.to_json(value).alias(payload))


def array_sizes(df: DataFrame, payload: str, paths: Sequence[str | None]) -> DataFrame:
    """SRC-8: element count of each named array per snapshot row."""
    out = []
    for p in paths:
        if p is None:
            arr = F.from_json(F.col(payload), T.ArrayType(T.StringType()))
            name = "n_root"
        else:
            arr = F.from_json(F.col(payload), T.StructType(
                [T.StructField(p, T.ArrayType(T.StringType()), True)])).getField(p)
            name = f"n_{p}"
        out.append(F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr)).alias(name))
    return df.select("*", *out)
