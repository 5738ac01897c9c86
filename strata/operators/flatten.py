"""Nested documents -> flat rows, driven by the DataFrame schema.

``flatten`` (B1) turns a nested schema into flat columns:

* struct ``a`` with field ``b``            -> column ``a_b``
* array of structs ``l``                   -> ``l_0_x``, ``l_1_x``, ... one set per position
* array of scalars ``t``                   -> one string, elements joined by ``', '``
                                              (null element -> ``'None'``; empty -> null)
* scalar                                   -> itself

The number of positions of every array of structs, nested ones included, is measured by one
aggregate over their sizes in each row, the only pass besides the projection itself; what is collected is
one row an array and position.

A list's first element alone says whether it is one of objects, row by row.  ``parse_json_column`` finds the lists
whose elements have no common type (Spark's reader takes them for lists of text): of rows where such a list starts with an
object the elements become structs, of the others they are joined.

``unpivot_panel`` (B2) turns items of the form ``{indicator: value, ...}`` into
long rows, using only the first key of each item (JSON parsed into a map keeps
document order): a scalar gives one row with a null position, a list gives one
row per element with its 0-based position, and an object element's fields
become columns and may overwrite ``indicator``/``position``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _scalar_list(c: Column, elem: T.DataType) -> Column:
    if isinstance(elem, T.BooleanType):
        s = F.transform(c, lambda x: F.when(x.isNull(), F.lit("None"))
                        .when(x, F.lit("True")).otherwise(F.lit("False")))
    elif isinstance(elem, (T.StructType, T.ArrayType, T.MapType)):
        s = F.transform(c, lambda x: F.coalesce(F.to_json(x), F.lit("None")))
    else:
        s = F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("None")))
    return F.when(F.size(c) > 0, F.array_join(s, ", "))


#: Ends the name of a field that holds the objects of a list whose type differs from row to row.
OBJECTS = "\x00objects"


def _is_objects(t: T.DataType) -> bool:
    return isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType)


def _named(name: str, parent: str | None, sep: str) -> str:
    name = name.removesuffix(OBJECTS)
    return f"{parent}{sep}{name}" if parent else name


def _holds_objects(t: T.DataType) -> bool:
    return _is_objects(t) or isinstance(t, T.StructType) and any(_holds_objects(f.dataType) for f in t.fields)


def _lengths(ref: Column, t: T.DataType, path: Column) -> Column:
    """``array<struct<path, n>>``: every array of structs within a value, with its length."""
    none = F.array().cast("array<struct<path:string,n:int>>")
    if _is_objects(t):
        own = F.array(F.struct(path.alias("path"), F.size(ref).alias("n")))
        if not _holds_objects(t.elementType):
            return F.when(ref.isNotNull(), own).otherwise(none)
        inner = F.flatten(F.transform(ref, lambda x, i: _lengths(
            x, t.elementType, F.concat(path, F.lit("\x01"), i.cast("string")))))
        return F.when(ref.isNotNull(), F.concat(own, inner)).otherwise(none)
    if isinstance(t, T.StructType):
        parts = [_lengths(ref.getField(f.name), f.dataType, F.concat(path, F.lit("\x01" + f.name)))
                 for f in t.fields if _holds_objects(f.dataType)]
        return F.concat(*parts) if parts else none
    return none


def _leaves(ref: Column, t: T.DataType, name: str, path: str, lengths: dict[str, int], sep: str):
    """``(name, column)`` of everything below a value, in the order of the document's schema."""
    if isinstance(t, T.StructType):
        for f in t.fields:
            yield from _leaves(ref.getField(f.name), f.dataType, _named(f.name, name, sep), f"{path}\x01{f.name}",
                               lengths, sep)
    elif _is_objects(t):
        for i in range(lengths.get(path, 0)):
            yield from _leaves(F.get(ref, i), t.elementType, f"{name}{sep}{i}", f"{path}\x01{i}", lengths, sep)
    elif isinstance(t, T.ArrayType):
        yield name, _scalar_list(ref, t.elementType)
    else:
        yield name, ref


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """B1: flatten every struct and array column of ``df`` (see module doc)."""
    refs = [(F.col(f"`{f.name}`"), f) for f in df.schema.fields]
    nested = [_lengths(ref, f.dataType, F.lit(f.name)) for ref, f in refs if _holds_objects(f.dataType)]
    lengths = {}
    if nested:
        found = df.select(F.explode(F.concat(*nested)).alias("e")).groupBy("e.path").agg(F.max("e.n").alias("n"))
        lengths = {r["path"]: r["n"] for r in found.collect()}  # one row an array and position
    columns: dict[str, Column] = {}
    for ref, f in refs:
        # later duplicates win, as with dict updates
        columns.update(_leaves(ref, f.dataType, _named(f.name, None, sep), f.name, lengths, sep))
    return df.select(*[c.alias(n) for n, c in columns.items()])


def json_schema(texts: DataFrame, mode: str = "PERMISSIVE") -> T.StructType:
    """The schema that Spark's JSON reader infers from a column of texts, all of them, inside the JVM.

    Damaged texts count as null, or raise with ``FAILFAST``."""
    spark = texts.sparkSession
    reader = spark._jsparkSession.read().option("mode", mode)
    found = reader.json(getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING()))
    return T.StructType.fromJson(json.loads(found.schema().json()))


def infer_json_schema(spark: SparkSession, df: DataFrame, col: str) -> T.StructType:
    """Schema of a JSON text column, by the JSON reader's own inference."""
    found = json_schema(df.select(F.col(f"`{col}`").cast("string").alias("value")))
    fields = [f for f in found.fields if f.name != "_corrupt_record"]
    if not fields:
        raise ValueError(f"column {col} holds no JSON objects")
    return T.StructType(fields)


def _text_lists(t: T.StructType, path: tuple[str, ...] = ()):
    """Paths of the lists of text in a schema, those below other lists left out."""
    for f in t.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _text_lists(f.dataType, (*path, f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            if not any("'" in name for name in (*path, f.name)):
                yield (*path, f.name)


def _elements(doc: Column, path: Sequence[str]) -> Column:
    """The list at a path of a variant as an array of variants; null if there is no list."""
    return F.try_variant_get(doc, "$" + "".join(f"['{name}']" for name in path), "array<variant>")


def _with_objects(ref: Column, path: Sequence[str], objects: Column) -> Column:
    """A struct whose list at ``path`` is null where ``objects`` is not, which becomes a field beside it."""
    name, *rest = path
    if rest:
        return F.when(ref.isNotNull(), ref.withField(f"`{name}`", _with_objects(ref.getField(name), rest, objects)))
    texts = F.when(objects.isNull(), ref.getField(name))
    return F.when(ref.isNotNull(), ref.withField(f"`{name}`", texts).withField(f"`{name}{OBJECTS}`", objects))


def split_mixed_lists(df: DataFrame, doc: str, parsed: str, schema: T.StructType) -> DataFrame:
    """Lists of objects in rows where a list of text starts with one; ``doc``: the variant, ``parsed``: the struct.

    One aggregate finds the lists that start with an object somewhere; only these are inferred and read again."""
    paths = list(_text_lists(schema))
    if not paths:
        return df
    firsts = [F.schema_of_variant(F.get(_elements(F.col(doc), p), 0)).startswith("OBJECT<") for p in paths]
    found = df.agg(*[F.bool_or(F.coalesce(f, F.lit(False))).alias(f"p{i}") for i, f in enumerate(firsts)]).first()
    out = F.col(parsed)
    for i, (path, first) in enumerate(zip(paths, firsts)):
        if not found[i]:
            continue
        elements = F.when(first, F.transform(_elements(F.col(doc), path), lambda e: F.to_json(e)))
        kind = json_schema(df.select(F.explode(elements).alias("value")))
        kind = T.StructType([f for f in kind.fields if f.name != "_corrupt_record"])
        out = _with_objects(out, path, F.transform(elements, lambda e: F.from_json(e, kind)))
    return df.withColumn(parsed, out)


def parse_json_column(df: DataFrame, col: str, schema: T.StructType | None = None,
                      alias: str | None = None) -> DataFrame:
    """JSON text column -> struct column (schema inferred when not given).

    With an inferred schema, lists that start with an object in some rows and not in others are split by
    row (see module doc)."""
    name = alias or col
    if schema is not None:
        return df.withColumn(name, F.from_json(F.col(col), schema))
    schema = infer_json_schema(df.sparkSession, df, col)
    both = df.withColumn("_doc", F.try_parse_json(F.col(col))).withColumn(name, F.from_json(F.col(col), schema))
    return split_mixed_lists(both, "_doc", name, schema).drop("_doc")


def union_heterogeneous(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with different key sets (missing columns -> null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def unpivot_panel(items: DataFrame, item_col: str = "item",
                  fields: Sequence[str] | None = None,
                  indicator: str = "indicador", position: str = "indice",
                  value: str = "valor", keep: Sequence[str] = ()) -> DataFrame:
    """B2: one-key items -> long rows (see module doc).

    A value is a list or an object by its JSON type: a string that looks like one stays a
    string.  ``fields`` are the keys that object elements may carry; when None they are
    discovered with one distributed ``distinct`` over the element keys.  A damaged item raises.
    Every output column is a string except ``position`` (bigint).
    """
    keep = list(keep)
    raw = F.col(item_col)
    # the first key in document order, and its value with its JSON type
    order = F.json_object_keys(raw)
    damaged = F.raise_error(F.concat(F.lit("not a JSON object: "), raw)).cast("string")
    first = F.when(raw.isNull(), F.lit(None)).when(order.isNull(), damaged).otherwise(F.get(order, 0))
    base = items.select(F.try_parse_json(raw).alias("_doc"), first.alias("_ind"), *keep).where("_ind IS NOT NULL")
    entry = F.try_variant_get("_doc", "$", "map<string,variant>")
    base = base.select("_ind", F.try_element_at(entry, F.col("_ind")).alias("_v"), *keep)
    kind = F.schema_of_variant("_v")
    listed = kind.startswith("ARRAY<")
    base = base.select("_ind", "_v", listed.alias("_listed"), *keep)
    elements = F.when(F.col("_listed"), F.try_variant_get("_v", "$", "array<variant>"))
    # scalars explode themselves (one row); an empty list gives no row
    exploded = base.select("_ind", "_listed", *keep, F.posexplode(
        F.coalesce(elements, F.array("_v"))).alias("_pos", "_elem"))
    is_object = F.col("_listed") & F.schema_of_variant("_elem").startswith("OBJECT<")
    rows = exploded.select("_ind", "_listed", "_pos", "_elem", *keep, F.when(
        is_object, F.try_variant_get("_elem", "$", "map<string,variant>")).alias("_obj"))
    if fields is None:
        fields = sorted(r[0] for r in rows.select(F.explode(F.map_keys("_obj"))).distinct().collect())

    def text(v: Column) -> Column:
        # strings as they are, other scalars and nested values as JSON
        return F.coalesce(F.try_variant_get(v, "$", "string"), F.nullif(F.to_json(v), F.lit("null")))

    def from_obj(name: str, otherwise: Column) -> Column:
        return F.when(F.col("_obj").isNotNull() & F.map_contains_key("_obj", name),
                      text(F.col("_obj")[name])).otherwise(otherwise)

    out = [from_obj(indicator, F.col("_ind")).alias(indicator),
           from_obj(position, F.when(F.col("_listed"), F.col("_pos").cast("string")))
           .try_cast("bigint").alias(position),
           from_obj(value, F.when(F.col("_obj").isNull(), text(F.col("_elem")))).alias(value)]
    out += [from_obj(f, F.lit(None).cast("string")).alias(f) for f in fields
            if f not in (indicator, position, value)]
    return rows.select(*out, *keep)
