"""JSON-lines sources with an explicit schema, record order and quarantine.

Lines are read as text and parsed with ``from_json`` so that every line keeps
its position and a bad line is *kept* with a reason instead of vanishing:
``read_jsonl`` returns parsed rows plus ``_corrupt_record``/``_error``;
``split_valid`` routes them to a good and a quarantine DataFrame.

Record order (``ord``) is ``struct(file path, block start, row id)``: files
in path order, then lines in file order. A gzip file is one split, so its
row ids follow its lines; for plain files every split is a separate block.
Blank lines are skipped. The order holds within one evaluation of the lines;
jobs write what they have read before they use it twice.

``_line`` keeps the whole line, so that fields the schema does not know reach
the outputs (``sinks.write_merged``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StringType, StructField, StructType, VariantType

ERR_BAD_JSON = "Malformed JSON"
ERR_NOT_OBJECT = "Not a JSON object"
ERR_SECOND = "More than one JSON value on a line"
ERR_TYPE = "A field does not fit its type"

# white space that JSON allows around a value
_JSON_WS = r"[ \t\r\n]*"


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_jsonl(spark: SparkSession, paths, schema: StructType, path_glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """Parse JSON lines with ``schema``; add ``ord``, ``_file``,
    ``_corrupt_record`` (raw line when unparsable) and ``_error``."""
    r = spark.read
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    lines = r.text(_paths(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
    )
    lines = lines.where(~F.col("value").rlike("^" + _JSON_WS + "$"))
    # a list of strings may be given as one string
    loose = {f.name for f in schema.fields if f.dataType == ArrayType(StringType())}
    full = StructType([StructField(f.name, VariantType()) if f.name in loose else f for f in schema.fields]
                      + [StructField("_corrupt_record", StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    # as the only element of a list a line is parsed to its end
    n = F.json_array_length(F.concat(F.lit("["), "value", F.lit("]")))
    out = lines.withColumn("_p", parsed).withColumn("_n", n)
    bad = F.col("_p").isNull() | F.col("_p._corrupt_record").isNotNull()
    leads = F.json_object_keys("value").isNotNull() & F.col("value").rlike("^" + _JSON_WS + r"\{")
    err = (F.when(F.col("_n").isNull() | (F.col("_n") != 1), F.when(leads, F.lit(ERR_SECOND)).otherwise(F.lit(ERR_BAD_JSON)))
           .when(~F.col("value").rlike("^" + _JSON_WS + r"\{"), F.lit(ERR_NOT_OBJECT))
           .when(bad, F.lit(ERR_TYPE)))

    def field(f: StructField):
        v = F.col("_p")[f.name]
        if f.name not in loose:
            return v.alias(f.name)
        one = F.array(F.try_variant_get(v, "$", "string"))
        return (F.when(v.isNull() | F.is_variant_null(v), F.lit(None))
                .when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<string>"))
                .otherwise(one).alias(f.name))

    return out.select(
        *[field(f) for f in schema.fields],
        F.when(err.isNotNull(), F.col("value")).alias("_corrupt_record"),
        err.alias("_error"),
        "ord",
        "_file",
        F.col("value").alias("_line"),
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` by the ``_error`` column."""
    return df.where(F.col("_error").isNull()), df.where(F.col("_error").isNotNull())


def read_jsonl_strict(spark: SparkSession, paths, schema: StructType,
                      required: Sequence[str] = ()) -> DataFrame:
    """Any malformed line, or a null ``required`` field, fails the job."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(_paths(paths))
    if required:
        ok = F.lit(True)
        for c in required:
            ok = ok & F.col(c).isNotNull()
        msg = "missing required field: " + ", ".join(required)
        df = df.where(F.assert_true(ok, F.lit(msg)).isNull())
    return df


def with_dataset(frames: dict[str, DataFrame]) -> DataFrame:
    """Union named inputs (e.g. ``train``/``dev``) with a ``dataset`` column."""
    out = None
    for name, df in frames.items():
        df = df.withColumn("dataset", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def select_datasets(df: DataFrame, names: Sequence[str] | str | None) -> DataFrame:
    """Keep the named datasets (``None`` or ``'both'``/``'all'`` keeps all)."""
    if names is None or names in ("both", "all"):
        return df
    names = [names] if isinstance(names, str) else list(names)
    return df.where(F.col("dataset").isin(names))


def first_files(spark: SparkSession, paths: Sequence[str] | str, n: int, path_glob: str = "*.jsonl*") -> list[str]:
    """The first ``n`` files in sorted order among ``paths``: files, globs or
    folders, which Spark lists (no file is opened)."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", path_glob).option("recursiveFileLookup", "true")
             .load(_paths(paths)).select("path").distinct().orderBy("path").limit(n))
    return [r["path"] for r in found.collect()]


def sample_files(spark: SparkSession, folders: Mapping[str, int], path_glob: str = "*.jsonl*") -> list[str]:
    """The first k files of each folder, e.g. ``{train: 2, dev: 1}``."""
    return [f for folder, k in folders.items() for f in first_files(spark, folder, k, path_glob)]


def merged_type(known: DataType, found: DataType) -> DataType:
    """``known`` with the struct fields, at any depth, that only ``found`` has."""
    if isinstance(known, StructType) and isinstance(found, StructType):
        own = {f.name: f for f in found.fields}
        fields = [StructField(f.name, merged_type(f.dataType, own[f.name].dataType) if f.name in own else f.dataType) for f in known]
        return StructType(fields + [f for f in found.fields if f.name not in known.names])
    if isinstance(known, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(merged_type(known.elementType, found.elementType))
    return known


def full_schema(spark: SparkSession, paths, known: StructType) -> StructType:
    """``known`` with every other field that the records have, from one pass over them."""
    return merged_type(known, spark.read.json(_paths(paths)).schema)


def quoted_type(t: DataType) -> str:
    """``t`` in SQL's words, every field name quoted."""
    if isinstance(t, StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {quoted_type(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, ArrayType):
        return f"array<{quoted_type(t.elementType)}>"
    return "string" if isinstance(t, NullType) else t.simpleString()


def variant_type(found: str) -> DataType:
    """The type that ``schema_of_variant_agg`` names (objects there are structs here)."""
    pieces = re.split(r"(`(?:[^`]|``)*`)", found)           # quoted names are left alone
    return DataType.fromDDL("".join(x if x.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", x) for x in pieces))


def with_payload(lines: DataFrame, names: Sequence[str], line: str = "_line") -> DataFrame:
    """``lines`` with the fields ``names`` of each valid record as VARIANT: all
    that the record holds there, whatever a schema knows of it. A record that VARIANT
    cannot hold (a name twice in one object) keeps the fields that the schema has."""
    valid, whole = F.col("_error").isNull(), F.col("_whole")
    out = lines.withColumn("_whole", F.when(valid, F.try_parse_json(line)))
    return out.withColumns({
        n: F.when(valid & whole.isNull(), F.to_variant_object(n)).otherwise(F.try_variant_get(whole, f'$["{n}"]', "variant"))
        for n in names}).drop("_whole")


def typed_payload(rows: DataFrame, known: StructType, names: Sequence[str]) -> DataFrame:
    """VARIANT columns ``names`` of (written) ``rows`` as typed columns: ``known``
    with the fields, at any depth, that the values have besides. One aggregate over
    these columns finds them; a field of several types stays VARIANT, one that is always null is text."""
    seen = rows.agg(*[F.schema_of_variant_agg(n).alias(n) for n in names]).first()
    types = {n: merged_type(known[n].dataType, variant_type(seen[n])) for n in names}
    return rows.withColumns({n: F.variant_get(n, "$", quoted_type(t)) for n, t in types.items()})


def first_records(df: DataFrame, n: int, order: str = "ord") -> DataFrame:
    """The first ``n`` records in input order."""
    return df.orderBy(order).limit(n)
