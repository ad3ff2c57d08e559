"""Batch sources: document collections, feature CSV, svmlight text and kernel-SVM model text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyscore.functions.scalar import let


def read_documents(
    spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | None = None, **options
) -> DataFrame:
    """A collection of nested records. Without a schema it is inferred, which reads JSON twice.

    ``fmt="mongodb"`` takes its connection from ``options`` and needs the connector's jar.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load() if fmt == "mongodb" else reader.load(path)


def read_feature_csv(spark: SparkSession, path: str, n_features: int, vector: bool = True) -> DataFrame:
    """Lines of ``n_features`` numbers and a label, no header."""
    names = [f"f{i}" for i in range(n_features)]
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names] + [T.StructField("label", T.IntegerType())])
    rows = spark.read.schema(schema).csv(path, sep=",", ignoreLeadingWhiteSpace=True, mode="FAILFAST")
    features = F.array(*names)
    return rows.select("label", (array_to_vector(features) if vector else features).alias("features"))


def read_svmlight(spark: SparkSession, path: str, n_features: int, vector: bool = True) -> DataFrame:
    """``label i:v i:v ...`` lines with 0-based indices; slots that a line leaves out are 0.

    An entry outside 0 to ``n_features`` - 1, or one that is no ``index:value``, is an error.
    """
    parts = F.split(F.trim(F.col("value")), " +")
    rows = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    rows = rows.select(parts[0].cast("double").cast("int").alias("label"), dense(F.slice(parts, 2, F.size(parts) - 1), n_features).alias("features"))
    return rows.select("label", (array_to_vector("features") if vector else F.col("features")).alias("features"))


#: Slots up to which a line is held against a pattern of all its indices.
PATTERN_SLOTS = 1024


def dense(pairs: Column, width: int) -> Column:
    """``index:value`` texts as an array of ``width`` numbers, zero where there is no entry; wrong ones are an error.

    A line with every slot in order is cut at its indices and cast as a whole. Any other is looked at pair by pair.
    """
    if not 0 < width <= PATTERN_SLOTS:
        return _dense_by_pair(pairs, width)
    every = "^" + " ".join(f"{i}:[^: ]+" for i in range(width)) + "$"
    cut = lambda line: F.split(F.substr(line, F.lit(3)), " [0-9]+:").try_cast("array<double>")

    def from_pairs(p: Column) -> Column:
        by_pair = _dense_by_pair(p, width)
        numbers = lambda line: let(cut(line), lambda v: F.when(F.forall(v, lambda x: x.isNotNull()), v).otherwise(by_pair))
        return let(F.array_join(p, " "), lambda line: F.when((F.size(p) == width) & line.rlike(every), numbers(line)).otherwise(by_pair))

    return let(pairs, from_pairs)


def _dense_by_pair(pairs: Column, width: int) -> Column:
    wrong = F.filter(pairs, lambda p: ~_fits(p, width))
    values = F.map_from_arrays(F.transform(pairs, _index), F.transform(pairs, _value))
    slots = F.sequence(F.lit(0), F.lit(width - 1))
    filled = let(values, lambda v: F.transform(slots, lambda i: F.coalesce(F.element_at(v, i), F.lit(0.0))))
    message = F.concat(F.lit(f"not an entry of {width} slots: "), wrong[0])
    return F.when(F.size(wrong) > 0, F.raise_error(message).cast("array<double>")).otherwise(filled)


def _index(pair: Column) -> Column:
    return F.element_at(F.split(pair, ":"), 1).try_cast("int")


def _value(pair: Column) -> Column:
    return F.element_at(F.split(pair, ":"), 2).try_cast("double")


def _fits(pair: Column, width: int) -> Column:
    return F.coalesce(pair.rlike("^[0-9]+:[^:]+$") & (_index(pair) < width) & _value(pair).isNotNull(), F.lit(False))


@dataclass(frozen=True)
class SvmParams:
    svm_type: str
    kernel: str
    gamma: float
    rho: float
    labels: tuple[int, ...]
    nr_sv: tuple[int, ...]

    @property
    def total_sv(self) -> int:
        return sum(self.nr_sv)


# The header words of a kernel-SVM model file.
SVM_HEADER = ("svm_type", "kernel_type", "gamma", "nr_class", "total_sv", "rho", "label", "nr_sv")


def read_svm_model(spark: SparkSession, path: str, n_features: int | None = None) -> tuple[SvmParams, DataFrame]:
    """Header of a kernel-SVM model and its support vectors as rows ``coef, vector``.

    Vectors have the width of the largest index (or ``n_features``); a vector may leave out slots, which are 0, or all.
    Only the header comes to the driver, a line for each word; the vectors stay distributed. A header word with two
    values, a line that is neither header nor vector, or another number of vectors than the header says is an error.
    """
    text = spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")
    word = F.split("line", " +")
    rows = text.select(word.alias("w")).filter(F.col("w")[0].isin(*SVM_HEADER)).groupBy(F.col("w")[0].alias("word"))
    found = rows.agg(F.min("w").alias("w"), (F.min("w") != F.max("w")).alias("twice")).collect()
    if any(row.twice for row in found):
        raise ValueError("a header word has two values")
    header = {row.word: row.w[1:] for row in found}
    if header.get("kernel_type") != ["rbf"] or header.get("svm_type") != ["c_svc"]:
        raise ValueError("only c_svc models with an rbf kernel can be read")
    params = SvmParams(
        svm_type="c_svc",
        kernel="rbf",
        gamma=float(header["gamma"][0]),
        rho=float(header["rho"][0]),
        labels=tuple(int(v) for v in header["label"]),
        nr_sv=tuple(int(v) for v in header["nr_sv"]),
    )
    body = text.select(word.alias("w")).filter(~F.col("w")[0].isin(*SVM_HEADER, "SV"))
    pairs = F.slice("w", 2, F.size("w") - 1)
    largest = F.array_max(F.transform(pairs, _index))
    number = F.col("w")[0].try_cast("double")
    seen = body.agg(F.count("*").alias("n"), F.max(largest).alias("largest"), F.count_if(number.isNull()).alias("strange")).first()
    stated = int(header["total_sv"][0])
    if seen.strange or not seen.n == stated == params.total_sv:
        raise ValueError(f"the header says {stated} and {params.total_sv} support vectors, there are {seen.n}, {seen.strange} of them without a number")
    width = n_features or (seen.largest or 0) + 1
    return params, body.select(number.alias("coef"), dense(pairs, width).alias("vector"))


def write_svm_model(params: SvmParams, vectors: DataFrame, path: str) -> str:
    """Write a kernel-SVM model as text: the header, then a line ``coef index:value ...`` for each vector, zeros left out.

    Vectors of the first label (positive coefficients) come first, as the header's counts have it. Numbers are written
    so that they read back as they were. The vectors stay distributed; the header is a part of its own, before theirs.
    """
    spark = vectors.sparkSession
    lines = [
        f"svm_type {params.svm_type}",
        f"kernel_type {params.kernel}",
        f"gamma {params.gamma!r}",
        f"nr_class {len(params.labels)}",
        f"total_sv {params.total_sv}",
        f"rho {params.rho!r}",
        "label " + " ".join(map(str, params.labels)),
        "nr_sv " + " ".join(map(str, params.nr_sv)),
        "SV",
    ]
    header = spark.createDataFrame(list(enumerate(lines)), "place long, line string").select(F.lit(0).alias("part"), F.col("place").cast("double").alias("at"), "line")
    entry = F.transform("vector", lambda v, i: F.when(v != 0, F.concat(i.cast("string"), F.lit(":"), v.cast("string"))))
    line = F.concat_ws(" ", F.col("coef").cast("string"), F.concat_ws(" ", F.array_compact(entry)))
    body = vectors.select(F.when(F.col("coef") > 0, 1).otherwise(2).alias("part"), F.col("coef").alias("at"), line.alias("line"))
    header.unionByName(body).orderBy("part", "at").select("line").write.mode("overwrite").text(path)
    return path
