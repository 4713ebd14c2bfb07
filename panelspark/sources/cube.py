"""Statistical cubes: JSON documents with dimensions and row-major cell offsets.

A document has ``id`` (dimension names), ``size`` (their lengths), ``dimension`` (per name
the categories with their positions and labels) and ``value``: either an object
``{offset: number}`` that leaves out empty cells, or a list with nulls.  The positions of a category
are an object ``{code: position}`` or a list of codes; a dimension with one category may leave them out.
One document is one row.  It is parsed once, into a VARIANT; the axes are read from it per document, and
``variant_explode`` turns either shape of ``value`` into one row per cell inside generated code, so
no array of cells is built and there is no shuffle.  Offsets are taken apart arithmetically from
the strides of the document itself, so any number and order of dimensions is accepted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelspark.functions.numeric import lenient_double


def read_documents(spark: SparkSession, path: str, *, per_line: bool = False) -> DataFrame:
    """Landed documents as ``(document, arrived, body)``: one per file, or one per line.

    ``arrived`` orders documents for last-write-wins: a later file replaces an earlier one.
    """
    return spark.read.text(path, wholetext=not per_line).select(
        F.col("_metadata.file_path").alias("document"),
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("value").alias("body"),
    )


def parse_documents(raw: DataFrame, keep: Sequence[str] = (), body: str = "body") -> DataFrame:
    """One row per document: ``keep``, ``size``, ``id``, ``dimension`` (a VARIANT per name) and ``value``.

    Malformed text raises, and so does a document without an object or a list of values.
    """
    kept = F.struct(*keep, F.lit(0))
    parsed = _once(raw, kept=kept, start=F.left(body, F.lit(80)), doc=F.try_parse_json(body))
    names = F.try_variant_get("doc", "$.id", "array<string>")
    value = F.variant_get("doc", "$.value", "variant")
    shaped = _is_object(value) | F.try_variant_get(value, "$", "array<variant>").isNotNull()
    malformed = F.raise_error(F.concat(F.lit("not a cube document: "), "start"))
    empty = F.raise_error(F.concat(F.lit("cube document without values: "), "start"))
    return _once(
        parsed,
        kept=F.col("kept"),
        id=F.when(names.isNull(), malformed).otherwise(names),
        size=F.try_variant_get("doc", "$.size", "array<int>"),
        dimension=F.try_variant_get("doc", "$.dimension", "map<string, variant>"),
        value=F.when(F.coalesce(shaped, F.lit(False)), value).otherwise(empty),
    )


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """The columns, evaluated once for a row of ``df``, however often they are used.

    Projections are merged and would evaluate them at every use, and the optimizer would carry every
    one of them as a constraint; an explode of one element stops both.
    """
    fields = [x for name, column in columns.items() for x in (F.lit(name), column)]
    return df.select(F.explode(F.array(F.named_struct(*fields))).alias("_once")).select("_once.*")


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string, variant>").isNotNull()


def _cell_rows(docs: DataFrame, value: str, document: Sequence[str]) -> DataFrame:
    """One row per cell of ``value``: ``_document`` (a struct), its ``offset`` and ``cell``.

    The document's columns are evaluated once for each document, below the generator.
    """
    exploded = docs.select(F.struct(*document).alias("_document"), F.col(value).alias("_cells")).lateralJoin(
        docs.sparkSession.tvf.variant_explode(F.col("_cells").outer())
    )
    return exploded.select(
        "_document",
        F.coalesce(F.col("key").cast("bigint"), F.col("pos").cast("bigint")).alias("offset"),
        F.col("value").alias("cell"),
    )


def _number(cell: Column) -> Column:
    """The number of a cell; a mark in its place is NULL, like an empty cell."""
    kind = F.schema_of_variant(cell)
    text = lenient_double(F.try_variant_get(cell, "$", "string"))
    number = F.try_variant_get(cell, "$", "double")
    return F.when(kind == "STRING", text).when(kind != "BOOLEAN", number)


def cell_marks(raw: DataFrame, keep: Sequence[str] = (), body: str = "body") -> DataFrame:
    """Texts that stand where numbers belong, with their number of cells, per ``keep`` columns."""
    cells = _cell_rows(parse_documents(raw, keep, body), "value", ["kept"])
    mark = F.try_variant_get("cell", "$", "string")
    marks = cells.where(_number(F.col("cell")).isNull() & mark.isNotNull())
    return marks.groupBy(*[F.col(f"_document.kept.`{c}`") for c in keep], mark.alias("mark")).agg(
        F.count(F.lit(1)).alias("cells")
    )


def _volume(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(1).cast("bigint"), lambda a, n: a * n)


def _codes(described: Column) -> Column:
    """Codes of a dimension by position: the positions must be 0..n-1, else NULL."""
    index = F.try_variant_get(described, "$.category.index", "map<string, int>")
    placed = F.sort_array(
        F.transform(F.map_entries(index), lambda e: F.struct(e["value"].alias("at"), e["key"].alias("code")))
    )
    numbered = F.transform(placed, lambda e, i: F.when(e["at"] == i, e["code"]))
    listed = F.try_variant_get(described, "$.category.index", "array<string>")
    named = F.map_keys(F.try_variant_get(described, "$.category.label", "map<string, string>"))
    alone = F.when(F.variant_get(described, "$.category.index", "variant").isNull() & (F.size(named) == 1), named)
    codes = F.coalesce(numbered, listed, alone)
    return F.when(~F.exists(codes, lambda c: c.isNull()), codes)


def _labels(described: Column, codes: Column) -> Column:
    labels = F.try_variant_get(described, "$.category.label", "map<string, string>")
    return F.transform(codes, lambda code: F.try_element_at(labels, code))


def decode_cube(
    raw: DataFrame,
    dims: Sequence[str],
    value: str = "value",
    *,
    on_missing: str = "drop",
    labels: Mapping[str, str] | None = None,
    where: Mapping[str, Sequence[str]] | None = None,
    last: Mapping[str, int] | None = None,
    keep: Sequence[str] = (),
    body: str = "body",
) -> DataFrame:
    """Cells as long rows: ``keep`` columns, ``offset``, one code column per dimension, value.

    ``where`` keeps the listed codes only, ``last`` the last n positions of a dimension (the latest periods of
    each document, whether or not a series has a value there): other cells are left out before
    their codes are looked up.  ``on_missing`` says what an empty cell among the wanted ones is: no row
    (``drop``), a NULL (``keep``) or an error (``error``).  ``labels`` maps dimensions to columns for their
    labels.  A dimension of the document that is not in ``dims`` must have one category; a listed one
    that is absent or not numbered 0..n-1 raises, and so does a cell outside the cube.
    """
    if on_missing not in ("drop", "keep", "error"):
        raise ValueError(f"unknown on_missing {on_missing!r}")
    labels, where, last = dict(labels or {}), dict(where or {}), dict(last or {})

    # Per document: the axes, their strides, and the wanted positions of the restricted ones.
    docs = parse_documents(raw, keep, body)
    axes, size = {}, F.col("size")
    for dim in dims:
        place = F.array_position("id", F.lit(dim)).cast("int")
        axes[f"codes_{dim}"] = _codes(F.try_element_at("dimension", F.lit(dim)))
        axes[f"size_{dim}"] = F.try_element_at(size, F.nullif(place, F.lit(0)))
        axes[f"stride_{dim}"] = _volume(F.slice(size, place + 1, F.size(size)))
    docs = _once(docs, **{c: F.col(c) for c in docs.columns}, volume=_volume(size), **axes)

    def positions(dim: str) -> Column:
        length = F.col(f"size_{dim}")
        every = F.sequence(F.lit(0), length - 1)
        if dim in where:
            codes = list(where[dim])
            every = F.filter(every, lambda p: F.get(F.col(f"codes_{dim}"), p).isin(codes))
        if dim in last:
            every = F.filter(every, lambda p: p >= length - last[dim])
        return F.when(length > 0, every).otherwise(F.array().cast("array<int>"))

    wanted = {dim: positions(dim) for dim in dims if dim in where or dim in last}

    covered, sound = F.lit(1).cast("bigint"), F.lit(True)
    for dim in dims:
        length = F.col(f"size_{dim}")
        covered = covered * F.coalesce(length, F.lit(0))
        sound = sound & F.coalesce(F.size(f"codes_{dim}") == length, F.lit(False))
    sound = sound & (covered == F.col("volume"))
    unsound = F.raise_error(F.lit(f"cube dimensions do not fit {list(dims)}"))
    cells = F.when(sound, F.col("value")).otherwise(unsound)

    named = {}
    for dim, kept in wanted.items():
        named[f"wanted_{dim}"] = kept
    for dim in labels:
        described = F.try_element_at("dimension", F.lit(dim))
        named[f"labels_{dim}"] = _labels(described, F.col(f"codes_{dim}"))
    document = ["kept", "volume", *axes, *named]
    docs = _once(docs, **{c: F.col(c) for c in ("kept", "volume", *axes)}, **named, _cells=cells)

    if on_missing == "drop":
        rows = _cell_rows(docs, "_cells", document)
    else:
        rows = _wanted_rows(docs, document, dims, wanted, on_missing == "error")

    inside = lambda name: F.col(f"_document.`{name}`")

    def position(dim: str) -> Column:
        at = F.pmod(F.floor(F.col("offset") / inside(f"stride_{dim}")), inside(f"size_{dim}"))
        return at.cast("int")

    rows = rows.where(F.col("offset").isNotNull())
    if on_missing == "drop":
        outside = (F.col("offset") >= inside("volume")) | (F.col("offset") < 0)
        refused = F.raise_error(F.lit("cube has cells outside its dimensions"))
        chosen = F.lit(True)
        for dim in wanted:
            chosen = chosen & F.array_contains(inside(f"wanted_{dim}"), position(dim))
        rows = rows.where(F.when(outside, refused).otherwise(chosen))
        rows = rows.withColumn("number", _number(F.col("cell"))).where(F.col("number").isNotNull())
    else:
        rows = rows.withColumn("number", _number(F.col("cell")))

    columns = [F.col(f"_document.kept.`{c}`").alias(c) for c in keep] + [F.col("offset")]
    for dim in dims:
        columns.append(F.get(inside(f"codes_{dim}"), position(dim)).alias(dim))
        if dim in labels:
            columns.append(F.get(inside(f"labels_{dim}"), position(dim)).alias(labels[dim]))
    return rows.select(*columns, F.col("number").alias(value))


def _wanted_rows(
    docs: DataFrame, document: Sequence[str], dims: Sequence[str], wanted: Sequence[str], complete: bool
) -> DataFrame:
    """One row per wanted offset, whether or not the document has a cell there.

    The offsets follow from the wanted positions; each looks its cell up in the VARIANT, by a binary
    search over the keys of an object or by place in a list.  ``complete`` raises if a cell is empty.
    """

    def spread(offsets: Column, dim: str) -> Column:
        every = F.sequence(F.lit(0), F.col(f"size_{dim}") - 1)
        places = F.col(f"wanted_{dim}") if dim in wanted else every
        steps = F.transform(places, lambda p: p * F.col(f"stride_{dim}"))
        return F.flatten(F.transform(offsets, lambda o: F.transform(steps, lambda s: o + s)))

    every = F.array(F.lit(0).cast("bigint"))
    for dim in dims:
        every = spread(every, dim)
    keyed = F.map_keys(F.try_variant_get("_cells", "$", "map<string, variant>"))
    beyond = F.when(
        keyed.isNotNull(),
        F.exists(keyed, lambda k: (k.cast("bigint") >= F.col("volume")) | (k.cast("bigint") < 0)),
    ).otherwise(F.size(F.try_variant_get("_cells", "$", "array<variant>")) > F.col("volume"))
    refused = F.raise_error(F.lit("cube has cells outside its dimensions"))
    offsets = F.when(beyond, refused).when(F.col("_cells").isNotNull(), every)
    prepared = _once(
        docs,
        **{c: F.col(c) for c in docs.columns},
        _object=_is_object(F.col("_cells")),
        _offsets=offsets,
    )

    def cell(offset: Column, cells: Column, is_object: Column) -> Column:
        text = offset.cast("string")
        path = F.when(is_object, F.concat(F.lit("$['"), text, F.lit("']"))).otherwise(
            F.concat(F.lit("$["), text, F.lit("]"))
        )
        return F.variant_get(cells, path, "variant")

    if complete:
        at = lambda o: cell(o, F.col("_cells"), F.col("_object"))
        empty = F.size(F.filter("_offsets", lambda o: _number(at(o)).isNull()))
        incomplete = F.raise_error(F.concat(F.lit("empty cells: "), empty.cast("string")))
        checked = F.when(empty > 0, incomplete).otherwise(F.col("_offsets"))
        prepared = prepared.withColumn("_offsets", checked)
    rows = prepared.select(
        F.struct(*document, "_cells", "_object").alias("_document"), F.explode("_offsets").alias("offset")
    )
    found = cell(F.col("offset"), F.col("_document._cells"), F.col("_document._object"))
    return rows.withColumn("cell", found)


def cube_metadata(raw: DataFrame, keep: Sequence[str] = (), body: str = "body") -> DataFrame:
    """One row per dimension and category: names, labels, order, size and positions."""
    parsed = raw.select(F.struct(*keep, F.lit(0)).alias("kept"), F.try_parse_json(body).alias("doc"))
    dims = parsed.select(
        "kept",
        F.try_variant_get("doc", "$.label", "string").alias("dataset_label"),
        F.try_variant_get("doc", "$.size", "array<int>").alias("sizes"),
        F.try_variant_get("doc", "$.dimension", "map<string, variant>").alias("dimension"),
        F.posexplode(F.try_variant_get("doc", "$.id", "array<string>")).alias("dim_position", "dim"),
    ).withColumn("described", F.col("dimension")[F.col("dim")])
    codes = _codes(F.col("described"))
    columns = [
        *[F.col(f"kept.`{c}`") for c in keep],
        "dataset_label",
        "dim",
        F.try_variant_get("described", "$.label", "string").alias("dim_label"),
        "dim_position",
        F.get(F.col("sizes"), F.col("dim_position")).alias("dim_size"),
    ]
    entry = F.arrays_zip(codes.alias("code"), _labels(F.col("described"), codes).alias("label"))
    rows = dims.select(*columns, F.posexplode(entry).alias("position", "entry"))
    return rows.select(
        *keep,
        "dataset_label",
        "dim",
        "dim_label",
        "dim_position",
        "dim_size",
        "entry.code",
        "entry.label",
        "position",
    )
