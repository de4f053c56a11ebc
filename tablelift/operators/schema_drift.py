"""Schemas of the files of one Parquet table: generations, drift, and one read in common types.

A job lists the files (``binaryFile`` without content) and tasks read the footers, so no footer
passes through the driver. Files with equal schemas form a generation; per column the types meet
in a lattice of lossless widenings:

* integers: the widest, and ``decimal(20,0)`` above 64 bits
* integers and decimals: the decimal that holds all whole digits and all fraction digits
* integers and floats: ``double`` where it holds every value (53 bits)
* dates and timestamps without a zone: ``timestamp_ntz``
* everything else that differs: ``string``, and with bytes among it ``binary``

A join is a maximum over features of the types, so it depends on neither the order nor the number
of the files and is combined before the shuffle. Column names are compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.columns import col

FILES_PER_TASK = 256
FOOTERS = "file string, rows long, ordinal int, column_name string, data_type string"
INT_BITS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
FLOAT_BITS = {"float": 24, "double": 53}


def _spark_type(field, int96: bool) -> str:
    """Spark's name for an Arrow field of a footer ("void" for a column of NULLs without a type)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_type

    t = field.type
    if pa.types.is_dictionary(t):
        t = t.value_type
    if int96:
        return "timestamp"  # written by engines that have no other timestamp: an instant
    if pa.types.is_null(t):
        return "void"
    if pa.types.is_unsigned_integer(t):
        return {8: "smallint", 16: "int", 32: "bigint", 64: "decimal(20,0)"}[t.bit_width]
    if pa.types.is_time(t):
        return "time"
    try:
        return from_arrow_type(t, prefer_timestamp_ntz=True).simpleString()
    except Exception:  # noqa: BLE001 - a type that Spark has no name for is reported by Arrow's
        return str(t)


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, ordinal, column_name, data_type), one row per file and top-level column. A file
    without columns has one row with NULLs; a directory without Parquet files gives no rows."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(path).select("path"))
    tasks = max(1, -(-files.count() // FILES_PER_TASK))

    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        from tablelift.sources.arrow_ipc import _fs

        kinds = pa.schema([("file", pa.string()), ("rows", pa.int64()), ("ordinal", pa.int32()),
                           ("column_name", pa.string()), ("data_type", pa.string())])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, at = _fs(name)
                with fs.open_input_file(at) as f:
                    footer = pq.ParquetFile(f)
                    schema, n = footer.schema_arrow, footer.metadata.num_rows
                    leaves = [footer.schema.column(i) for i in range(len(footer.schema))]
                int96 = {c.path for c in leaves if c.physical_type == "INT96"}
                rows = [{"file": name, "rows": n, "ordinal": i + 1, "column_name": c.name,
                         "data_type": _spark_type(c, c.name in int96)} for i, c in enumerate(schema)]
                yield pa.RecordBatch.from_pylist(rows or [{"file": name, "rows": n}], schema=kinds)

    return files.repartition(tasks, "path").mapInArrow(footers, FOOTERS)


def schema_generations(footers: DataFrame) -> DataFrame:
    """(fingerprint, files, rows, columns, first_file) of each distinct schema, names, types and order
    counted; ``footers`` is what ``file_schemas`` gives."""
    column = F.struct("ordinal", "column_name", "data_type")
    per_file = footers.groupBy("file").agg(
        F.max("rows").alias("rows"), F.count("column_name").alias("columns"),
        F.sha2(F.to_json(F.array_sort(F.collect_list(column))), 256).alias("fingerprint"))
    return per_file.groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.max("columns").alias("columns"),
        F.min("file").alias("first_file"))


def _bits(t: Column, table: dict[str, int]) -> Column:
    """The largest ``table`` value of the types ``t`` in a group (NULL: none of these types)."""
    return F.max(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[t])


def common_type(t: Column) -> Column:
    """Aggregate: the least type that holds every value of the types named in ``t`` ("void" and NULL
    add nothing; "void" where there is nothing else)."""
    real = F.when(t != "void", t)
    digits = F.regexp_extract(t, r"^decimal\((\d+),(-?\d+)\)$", 1).try_cast("int")
    scale = F.regexp_extract(t, r"^decimal\((\d+),(-?\d+)\)$", 2).try_cast("int")
    ints, floats = _bits(t, INT_BITS), _bits(t, FLOAT_BITS)
    whole, part = F.max(digits - scale), F.max(scale)
    kind = (F.when(real.isin(*INT_BITS), "int").when(real.isin(*FLOAT_BITS), "float")
            .when(digits.isNotNull(), "decimal").otherwise(real))
    kinds = F.array_sort(F.collect_set(kind))
    # a decimal that takes integers has room for all of their type, as Parquet readers ask for it
    room = F.greatest(whole, F.when(ints <= 31, 10).when(ints <= 63, 20))
    fits = (room + part) <= 38
    one = F.size(kinds) == 1
    only = lambda *names: F.size(F.array_except(kinds, F.array(*[F.lit(n) for n in names]))) == 0
    return (F.when(F.size(kinds) == 0, "void")
            .when(one & ints.isNotNull(), F.when(ints <= 7, "tinyint").when(ints <= 15, "smallint")
                  .when(ints <= 31, "int").otherwise("bigint"))
            .when(one & floats.isNotNull(), F.when(floats <= 24, "float").otherwise("double"))
            .when(only("int", "decimal") & fits, F.format_string("decimal(%d,%d)", room + part, part))
            .when(only("int", "float") & (ints <= 53), "double")
            .when(only("date", "timestamp_ntz") & ~one, "timestamp_ntz")
            .when(one & ~only("decimal"), kinds[0])
            .when(F.array_contains(kinds, "binary"), "binary")
            .otherwise("string"))


def schema_drift(footers: DataFrame) -> DataFrame:
    """Per column: (column_name, common_type, types, files, missing_files, drift). ``types`` lists the
    distinct types, ``missing_files`` counts the files without the column; drift: more than one type,
    or missing somewhere."""
    all_files = footers.agg(F.countDistinct("file")).first()[0]
    per = footers.where(F.col("column_name").isNotNull()).groupBy("column_name").agg(
        common_type(F.col("data_type")).alias("common_type"),
        F.array_join(F.array_sort(F.collect_set("data_type")), ", ").alias("types"),
        F.countDistinct("file").alias("files"), F.countDistinct("data_type").alias("n_types"))
    missing = F.lit(all_files) - F.col("files")
    return per.select(
        "column_name", "common_type", "types", "files", missing.alias("missing_files"),
        ((F.col("n_types") > 1) | (missing > 0)).alias("drift"))


def read_in_common_types(spark: SparkSession, path: str) -> DataFrame:
    """The whole table in one scan, every column in its common type and NULL in files without it.
    The reader widens while it decodes. Columns whose types meet only as text or bytes can't be read
    so: E004 names them all."""
    drift = schema_drift(file_schemas(spark, path)).orderBy("column_name").collect()  # one row a column
    torn = [r.column_name for r in drift if ", " in _outside_brackets(r.types) and r.common_type in ("string", "binary")]
    if torn:
        raise ValueError(f"E004 no common type but text for columns {torn} of {path}")
    schema = T.StructType([T.StructField(r.column_name, T.NullType() if r.common_type == "void"
                                         else T.DataType.fromDDL(r.common_type)) for r in drift])
    known = T.StructType([f for f in schema if not isinstance(f.dataType, T.NullType)])
    df = spark.read.option("recursiveFileLookup", True).schema(known).parquet(path)
    return df.select(*[F.lit(None).alias(f.name) if isinstance(f.dataType, T.NullType) else col(f.name) for f in schema])


def _outside_brackets(types: str) -> str:
    """``types`` without "void" and without what stands in brackets, where commas separate no types."""
    out, depth = [], 0
    for ch in types:
        depth += ch in "<("
        if not depth:
            out.append(ch)
        depth -= ch in ">)"
    return ", ".join(t for t in "".join(out).split(", ") if t != "void")
