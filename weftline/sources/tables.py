"""Readers: declared schemas, projection at the scan, bad records as a side output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.plans.shared import materialize

#: Tasks a core among which many small files are dealt.
TASKS = 4
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def relational(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """A read-only scan over JDBC (a driver for the database must be on the class path)."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array: a row an element."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_lines(spark: SparkSession, path: str, schema: str, id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, bad): one object a line; lines that do not parse go to ``bad`` with their text.

    ``id_col`` names a content hash of the line: line numbers are not stable across splits of a file.
    """
    raw = spark.read.text(path).where(F.trim("value") != "")
    parsed = raw.select("value", F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("j"))
    good = parsed.where("j is not null and j._corrupt is null")
    rows = good.select("j.*", *([F.sha2("value", 256).alias(id_col)] if id_col else [])).drop("_corrupt")
    return rows, parsed.where("j is null or j._corrupt is not null").select(F.col("value").alias("line"))


def array_lines(spark: SparkSession, path: str, column: str = "turns") -> tuple[DataFrame, DataFrame]:
    """(rows, bad) of plain or gzip text whose lines are bare JSON arrays of strings; lines that are not go to ``bad`` with their text."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    parsed = raw.select("value", F.from_json("value", "array<string>").alias(column))
    rows = parsed.where(F.col(column).isNotNull()).select(column, F.sha2("value", 256).alias("line_key"))
    return rows, parsed.where(F.col(column).isNull()).select(F.col("value").alias("line"))


def dictionary(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """(key, value) of a tab-separated dictionary: the first of the space-separated values; the first line of a key counts."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.regexp_replace("value", "\r$", "").alias("line"))
    parts = F.split("line", "\t", 2)
    rows = lines.where((F.trim("line") != "") & ~F.col("line").startswith(comment)).select("line_no", F.get(parts, F.lit(0)).alias("key"), F.split(F.get(parts, F.lit(1)), " ")[0].alias("value"))
    return rows.where("key <> '' and value <> ''").groupBy("key").agg(F.min_by("value", "line_no").alias("value"))


def persona_files(spark: SparkSession, folder: str, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, errors) of a folder of JSON files, one object each; errors hold the path, what is missing and, as ``found``, what was read.

    The folder is listed once and each file read once, many to a task: what they hold is kept in the shared folder.
    """
    raw = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select(F.input_file_name().alias("path"), "value")
    raw = raw.coalesce(TASKS * spark.sparkContext.defaultParallelism)
    rows = raw.select("path", F.from_json("value", schema).alias("j"), F.try_parse_json("value").isNull().alias("broken"))
    lost = F.array_compact(F.array(*[F.when(F.col(f"j.{c}").isNull(), F.lit(c)) for c in required]))
    rows = materialize(rows.withColumn("missing", lost), "files")
    bad = F.col("broken") | (F.size("missing") > 0)
    return rows.where(~bad).select("path", "j.*"), rows.where(bad).select("path", "broken", "missing", F.col("j").alias("found"))


def annotation_file(spark: SparkSession, path: str, schema: str, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(notes, bad, repeated) of JSON lines keyed by content: lines that do not parse, and keys that stand more than once, whose notes are left out."""
    rows, bad = json_lines(spark, path, schema)
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    repeated = counts.where("n > 1")
    return rows.join(counts.where("n = 1").select(key), key, "left_semi"), bad, repeated


def grouped_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, rows): every row of a key with all its columns, in the order of some."""
    whole = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in df.columns if c not in order])
    return df.groupBy(key).agg(F.array_sort(F.collect_list(whole)).alias("rows"))


class Catalogue:
    """Named external sources: path, format, licence, and an id column with its prefix; a missing name or path is an error."""

    def __init__(self, entries: dict[str, dict]):
        self.entries = entries

    def _entry(self, name: str) -> dict:
        if name not in self.entries:
            raise KeyError(f"unknown source {name!r}; there are {sorted(self.entries)}")
        return self.entries[name]

    def require(self, spark: SparkSession) -> None:
        """Raise if a source's path is not there."""
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = lambda e: jvm.org.apache.hadoop.fs.Path(e["path"])
        lost = sorted(n for n, e in self.entries.items() if not path(e).getFileSystem(conf).exists(path(e)))
        if lost:
            raise FileNotFoundError(f"sources without their files: {lost}")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The rows of a source with source_name, licence and, where it has an id column, ``source_id``: the prefix and that id."""
        e = self._entry(name)
        reader = spark.read.format(e.get("format", "parquet"))
        df = (reader.schema(e["schema"]) if "schema" in e else reader).load(e["path"])
        if "id" in e:
            df = df.withColumn("source_id", F.concat(F.lit(e.get("prefix", f"{name}:")), F.col(e["id"]).cast("string")))
        return df.withColumn("source_name", F.lit(name)).withColumn("licence", F.lit(e.get("licence")))

    def digest(self, spark: SparkSession, name: str, known: DataFrame | None = None) -> DataFrame:
        """One row: files, bytes and digest of a source."""
        from weftline.sources.digests import file_digests, folder_digest

        path = self._entry(name)["path"]
        return folder_digest(file_digests(spark, path, known), path)


def conversations_as_arrays(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """One row a conversation: first_role, turns in order."""
    rows = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "role", "text"))).alias("t"))
    return rows.select(key, F.col("t")[0]["role"].alias("first_role"), F.transform("t", lambda x: x["text"]).alias("turns"))


def exploded_turns(rows: DataFrame, key: str = "conv_id", roles: tuple[str, str] = ("user", "assistant")) -> DataFrame:
    """The other way: roles alternate from first_role on."""
    first = F.array_position(F.array(*map(F.lit, roles)), F.col("first_role")) - 1
    out = rows.select(key, first.alias("__f"), F.posexplode("turns").alias("turn", "text"))
    return out.select(key, "turn", F.element_at(F.array(*map(F.lit, roles)), ((F.col("turn") + F.col("__f")) % 2 + 1).cast("int")).alias("role"), "text")


def numbered(df: DataFrame, order: list, per: str) -> DataFrame:
    """Row numbers in a total order within a group."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy(per).orderBy(*order)))
