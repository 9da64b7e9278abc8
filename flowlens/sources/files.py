"""File sources (S1-S11): flow tables, feature lists and JSON reports.

Readers are lazy: a scan is only planned; column pruning and filters reach it
through Catalyst.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.clean import col


def read_flows(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame:
    """One or more flow files; ``.parquet`` (any case) is Parquet, the
    rest CSV with a header. Several files are united by column name.

    CSV types are inferred unless a schema is given. pandas would also turn
    ``NA``/``null``/``N/A`` into missing; here those stay text and the numeric
    coercion (``to_double``) maps them to 0.0 exactly as a missing value.
    """
    if isinstance(paths, str):
        paths = [paths]
    if not paths:
        raise ValueError("no input file")     # D6
    pq = [p for p in paths if p.lower().endswith(".parquet")]
    csv = [p for p in paths if not p.lower().endswith(".parquet")]
    frames = []
    if pq:
        frames.append(spark.read.schema(schema).parquet(*pq) if schema else spark.read.parquet(*pq))
    if csv:
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema else r.option("inferSchema", True)
        frames.append(r.csv(csv))
    return _united(frames)


#: Column that keeps the text of a CSV row that does not fit its schema.
RESCUED = "_rescued"


def sampled_schema(spark: SparkSession, path: str, rows: int = 1000) -> T.StructType:
    """Column types from the header and the first ``rows`` lines of a CSV file;
    the rest of it is not read."""
    lines = [r["value"] for r in spark.read.text(path).head(rows + 1)]
    sample = spark.sparkContext.parallelize(lines, 1)
    return spark.read.option("header", True).option("inferSchema", True).csv(sample).schema


def read_csv_flows(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame:
    """CSV files with a header in one scan, by a declared schema or that of a
    sample of the first file. A row that does not fit keeps its text in ``RESCUED``
    (null otherwise), with what could be read in its columns."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = schema or sampled_schema(spark, paths[0])
    whole = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    return (spark.read.schema(whole).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RESCUED).csv(paths))


def read_libsvm(spark: SparkSession, path: str, features) -> DataFrame:
    """D3: (label, features) of LIBSVM text, as wide as the feature list; a row with
    a higher index fails when it is read, and a width is never guessed from the data."""
    return spark.read.format("libsvm").option("numFeatures", len(list(features))).load(path)


def libsvm_max_index(spark: SparkSession, path: str) -> int:
    """D3: the highest index in LIBSVM text (1-based; 0 without any)."""
    last = F.try_element_at(F.regexp_extract_all("value", F.lit(r"(\d+):"), F.lit(1)), F.lit(-1))
    return spark.read.text(path).agg(F.max(last.cast("int")).alias("m")).first()["m"] or 0


def _united(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column whose type differs between the files becomes
    text, so that a dash in one file doesn't fail the numbers of another."""
    kinds: dict[str, set] = {}
    for f in frames:
        for name, kind in f.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {n for n, k in kinds.items() if len(k) > 1}
    out = None
    for f in frames:
        f = f.select(*[col(n).cast("string").alias(n) if n in mixed else col(n) for n in f.columns])
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def read_dataset_tree(spark: SparkSession, root: str, file_name: str = "*.parquet") -> DataFrame:
    """Files under ``root/dataset*/``, or the layout that ``save_selected``
    writes (``root/dataset=<name>/split=<name>/``).

    Folders of the second kind are partitions: ``dataset`` and ``split`` come
    with them and filters on them prune folders. In the first kind the name of
    a file's own ``dataset*`` folder becomes the column (the innermost, so the
    names of parent folders play no part)."""
    base = root.rstrip("/")
    reader = spark.read.option("pathGlobFilter", file_name)
    try:
        return reader.option("basePath", base).parquet(f"{base}/dataset=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    df = spark.read.option("pathGlobFilter", file_name).option("recursiveFileLookup", True).parquet(f"{base}/dataset*")
    ds = F.regexp_extract(F.col("_metadata.file_path"), r".*/(dataset[^/]*)/", 1)
    return df.withColumn("dataset", ds)


def read_feature_list(spark: SparkSession, path: str) -> DataFrame:
    """One name per line, trimmed, blanks dropped, with its 0-based
    position (the file is read whole, so line order is explicit)."""
    whole = spark.read.option("wholetext", True).text(path)
    lines = whole.select(F.posexplode(F.split(F.col("value"), "\n")).alias("pos", "line"))
    names = lines.select("pos", F.trim("line").alias("feature")).where(F.col("feature") != "")
    from pyspark.sql import Window
    return names.select((F.row_number().over(Window.orderBy("pos")) - 1).alias("position"), "feature")


def feature_list(spark: SparkSession, path: str) -> list[str]:
    """The feature list as a Python list (small metadata, driver side)."""
    return [r["feature"] for r in read_feature_list(spark, path).orderBy("position").collect()]


SPLIT_METRICS = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("class_counts", T.MapType(T.StringType(), T.LongType())),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("pr_auc", T.DoubleType()),
    T.StructField("best_threshold_by_f1", T.DoubleType()),
    T.StructField("best_f1", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("f1_macro", T.DoubleType()),
    T.StructField("f1_weighted", T.DoubleType()),
    T.StructField("logloss", T.DoubleType()),
    T.StructField("note", T.StringType()),
])

REPORT_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("meta", T.StructType([
        T.StructField("dataset", T.StringType()),
        T.StructField("num_class", T.LongType()),
        T.StructField("feature_count", T.LongType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("class_counts_train", T.MapType(T.StringType(), T.LongType())),
        T.StructField("scale_pos_weight", T.DoubleType()),
        T.StructField("chosen_threshold", T.DoubleType()),
    ])),
    T.StructField("metrics", T.StructType([
        T.StructField("train", SPLIT_METRICS),
        T.StructField("validation", SPLIT_METRICS),
        T.StructField("test", SPLIT_METRICS),
    ])),
    T.StructField("test_metrics", SPLIT_METRICS),
])


def read_reports(spark: SparkSession, paths, schema: T.StructType = REPORT_SCHEMA) -> DataFrame:
    """Multi-line JSON reports with an explicit schema; absent keys are
    null, and ``num_class`` defaults to 2."""
    df = spark.read.schema(schema).option("multiLine", True).json(paths)
    return df.withColumn("num_class", F.coalesce(F.col("meta.num_class"), F.lit(2)))


def report_class_counts(reports: DataFrame, split: str = "test") -> DataFrame:
    """Class counts (object keyed by class) exploded to rows."""
    src = F.coalesce(F.col(f"metrics.{split}.class_counts"), F.col("test_metrics.class_counts")) \
        if split == "test" else F.col(f"metrics.{split}.class_counts")
    return reports.select(F.coalesce("dataset", "meta.dataset").alias("dataset"),
                          F.explode(src).alias("cls", "n")) \
                  .withColumn("cls", F.col("cls").cast("int"))


def row_count(df: DataFrame) -> int:
    """Row count (Parquet answers from footers where it can)."""
    return df.count()


def column_list(df: DataFrame) -> list[str]:
    """Column names."""
    return list(df.columns)
