"""Files to tables and back."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.functions.fixed_values import NULL_TOKENS
from docengine.functions.text import document_key
from docengine.sources.stages import StageFolder

# Files of a name taken by another one that a scan leaves out by their paths.
NAMED_FILES = 10_000


def null_tokens(
    df: DataFrame, tokens: list[str] = NULL_TOKENS, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Null for every text cell that a table hand-over would read as null, but in `keys`."""
    # One text that becomes one literal list, instead of a literal per token and column.
    listed = F.split(F.lit("\x01".join(tokens)), "\x01")
    return df.select(
        *[
            F.when(
                ~F.array_contains(listed, F.col(f"`{f.name}`")), F.col(f"`{f.name}`")
            ).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in keys
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    tokens: list[str] = NULL_TOKENS,
    multi_line: bool = True,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """CSV with a header to the given schema, columns by name in any order.

    A column that the header lacks, a row with more or fewer cells than the header and a
    quote that isn't closed are errors. `keys` never turn null. Cells may hold line breaks,
    which keeps a file in one task; pass `multi_line=False` for large files without such
    cells, so that they split.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line, "inferSchema": False}
    header = spark.read.options(**options).csv(path).columns
    texts = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.schema(texts).options(**options, mode="FAILFAST", enforceSchema=False)
    return null_tokens(raw.csv(path), tokens, keys).select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def write_csv(
    df: DataFrame, path: str, delimiters: dict[str, str] | None = None
) -> None:
    """CSV with a header; lists become text, joined by `", "` unless told otherwise."""
    delimiters = delimiters or {}

    def cell(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, delimiters.get(f.name, ", "))
        elif isinstance(f.dataType, T.BooleanType):
            c = F.initcap(c.cast("string"))
        return c.alias(f.name)

    (
        df.select(*[cell(f) for f in df.schema.fields])
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def write_stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a stage once and go on from the written table; see `StageFolder`."""
    return StageFolder(df.sparkSession, folder).write(df, name)


def read_texts(
    spark: SparkSession, folder: str, pattern: str = "*_cleaned.txt"
) -> DataFrame:
    """`(doc_key, file_name, text)`: whole text files, sub-folders included.

    Of files with equal names the one whose path comes first is taken.  The choice is made on
    the listing, which reads no contents; files that are not taken are left out of the scan,
    or, where they are too many to name, by a join on the path.
    """
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": True}
    listed = spark.read.format("binaryFile").options(**options).load(folder)
    path = F.col("_metadata.file_path")
    # Names come as in an address: blanks and percent signs are written as numbers.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    first = Window.partitionBy("doc_key").orderBy("path")
    passed_over = (
        listed.select(path.alias("path"), document_key(name).alias("doc_key"))
        .withColumn("place", F.row_number().over(first))
        .filter("place > 1")
        .select("path")
    )
    paths = [r.path for r in passed_over.limit(NAMED_FILES + 1).collect()]
    texts = spark.read.options(**options).text(folder, wholetext=True)
    found = texts.select(
        document_key(name).alias("doc_key"),
        name.alias("file_name"),
        F.col("value").alias("text"),
        path.alias("path"),
    )
    if len(paths) > NAMED_FILES:
        found = found.join(passed_over, "path", "left_anti")
    elif paths:
        found = found.filter(~F.col("path").isin(paths))
    return found.drop("path")


def list_files(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.[pP][dD][fF]",
    recursive: bool = True,
) -> DataFrame:
    """`(doc_key, path, length)` of matching files; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive)
        .load(folder)
        .select(document_key(F.col("path")).alias("doc_key"), "path", "length")
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

