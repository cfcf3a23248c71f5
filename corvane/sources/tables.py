"""Sources and sinks with explicit schemas; nothing is inferred. Spark's committer makes a sink's files appear together."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corvane.functions.ids import clean_pmcid, clean_pmid


def strings_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ",", wanted: list[str] | None = None) -> DataFrame:
    """A delimited file with a header whose cells are all strings; an empty cell is null. Only wanted columns are parsed."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    out = spark.read.csv(path, schema=schema, header=True, sep=sep, multiLine=True, escape='"')
    return out.select(*wanted) if wanted else out


def id_pairs(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Clean (pmcid, pmid) of a delimited file with columns PMCID and PMID."""
    return strings_csv(spark, path, ["PMCID", "PMID"], sep).select(clean_pmcid(F.col("PMCID")).alias("pmcid"), clean_pmid(F.col("PMID")).alias("pmid"))


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines, also gzipped; a gzip file can't be split, so its rows are dealt anew."""
    out = spark.read.schema(schema).json(path)
    return out.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else out


def whole_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines without torn ones: a line that isn't a whole object, as the last of a job that was killed, is left out."""
    text = spark.read.text(path)
    return text.where(F.json_object_keys("value").isNotNull()).select(F.from_json("value", schema).alias("r")).select("r.*")


def wanted_json_lines(spark: SparkSession, path: str, pattern: str, wanted: DataFrame, key: str, schema: str) -> DataFrame:
    """Lines whose key, cut out by a pattern, is wanted; only those are parsed."""
    lines = spark.read.text(path).withColumn(key, F.regexp_extract("value", pattern, 1))
    return lines.join(wanted.select(key).distinct(), key, "left_semi").select(F.from_json("value", schema).alias("r")).select("r.*")


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of files; their content isn't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


#: Where a file's id is in its path: PMC1_main.pdf, or a folder PMC1.
LAYOUTS = {"flat_main_pdf": r"/(PMC[^/]*)_main\.pdf$", "pmcid_subdir": r"/(PMC[^/]*)/[^/]+$"}


def pdf_ids(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Distinct ids that a folder of files names, by its layout."""
    found = F.regexp_extract("path", LAYOUTS[layout], 1)
    return file_names(spark, path).select(clean_pmcid(found).alias("pmcid")).where("pmcid is not null").distinct()


def manifest(spark: SparkSession, roots: dict[str, tuple[str, str]]) -> DataFrame:
    """source, pmcid, path and size of all files of some roots (name -> path, layout); the first root that has an id keeps it."""
    parts = []
    for turn, (name, (path, layout)) in enumerate(roots.items()):
        f = file_names(spark, path)
        parts.append(f.select(clean_pmcid(F.regexp_extract("path", LAYOUTS[layout], 1)).alias("pmcid"), F.lit(turn).alias("turn"), F.lit(name).alias("source"), "path", F.col("length").alias("size")).where("pmcid is not null"))
    return reduce(DataFrame.union, parts).groupBy("pmcid").agg(F.min_by(F.struct("source", "path", "size"), F.struct("turn", "path")).alias("f")).select("pmcid", "f.*")


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


#: Readers of sources by kind; a reader takes (spark, config) and returns records and unresolved rows (or none).
ADAPTERS: dict[str, Callable[[SparkSession, dict], tuple[DataFrame, DataFrame | None]]] = {}


def adapter(kind: str):
    def keep(f):
        ADAPTERS[kind] = f
        return f

    return keep


@adapter("csv")
def _csv(spark: SparkSession, cfg: dict):
    rows = strings_csv(spark, cfg["path"], cfg["columns"], cfg.get("sep", ","))
    has = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cfg["ids"]]).isNotNull()
    named = lambda d: d.withColumns({"source_name": F.lit(cfg["name"]), "label": F.lit(cfg.get("label"))})
    return named(rows.where(has)), named(rows.where(~has))


@adapter("pdf_directory")
def _pdf(spark: SparkSession, cfg: dict):
    return pdf_ids(spark, cfg["path"], cfg["layout"]).withColumns({"source_name": F.lit(cfg["name"]), "label": F.lit(cfg.get("label"))}), None


@adapter("batches_json")
def _batches(spark: SparkSession, cfg: dict):
    from corvane.operators.merging import first_of_batches

    rows = spark.read.text(cfg["path"], wholetext=True).select(F.from_json("value", f"map<string, array<{cfg['entry']}>>").alias("b"))
    found, rest = first_of_batches(rows, "b", "_id")
    name = F.lit(cfg["name"])
    return found.withColumn("source_name", name), rest.withColumn("source_name", name)


def load_sources(spark: SparkSession, configs: list[dict]) -> tuple[DataFrame, DataFrame | None]:
    """Records and unresolved rows of all configured sources, by column name. KeyError for a kind without an adapter."""
    made = [ADAPTERS[c["kind"]](spark, c) for c in configs]
    unresolved = [u for _, u in made if u is not None]
    return union_sources([r for r, _ in made]), union_sources(unresolved) if unresolved else None


class CapturedAnswers(DataSource):
    """Answers of a service that were captured as files (path/key.json), one partition for each chunk of keys. Options: path, keys (comma-separated), chunk."""

    @classmethod
    def name(cls) -> str:
        return "captured_answers"

    def schema(self) -> str:
        return "key string, body string, found boolean"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return CapturedReader(self.options)


class CapturedReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.keys, self.chunk = options["path"].removeprefix("file://"), options["keys"].split(","), int(options.get("chunk", "100"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.keys[i : i + self.chunk]) for i in range(0, len(self.keys), self.chunk)]

    def read(self, partition: InputPartition):
        from pathlib import Path

        for key in partition.value:
            at = Path(self.path) / f"{key}.json"
            yield (key, at.read_text(), True) if at.exists() else (key, None, False)


def existing(rows: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Which of some keys a store has."""
    return rows.select(key).distinct().join(store.select(key), key, "left_semi")


def scanned(store: DataFrame, condition, fields: list[str], key: str) -> DataFrame:
    """A store's rows in the order of their key, with some fields only; the condition goes to the files."""
    return store.where(condition).select(key, *fields).orderBy(key)


def write_chunks(rows: DataFrame, path: str, order: list[str], size: int) -> None:
    """Files of at most size rows in order."""
    rows.orderBy(*order).write.option("maxRecordsPerFile", size).mode("overwrite").json(path)


def write_rows(rows: DataFrame, path: str, form: str = "csv") -> None:
    """CSV with a header, or JSON lines, in place of what was there."""
    w = rows.write.mode("overwrite")
    w.option("header", True).option("escape", '"').csv(path) if form == "csv" else w.json(path)


def append_log(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """Rows added to a log; each CSV file of it has its header once."""
    w = rows.write.mode("append")
    w.option("header", True).option("escape", '"').csv(path) if form == "csv" else w.parquet(path)


def export_corpus(rows: DataFrame, path: str, key: str) -> dict:
    """Gzipped JSON lines in the order of the key; returns a sidecar with rows and a digest of their content, which doesn't depend on files."""
    lines = rows.select(key, F.to_json(F.struct(*rows.columns)).alias("line"))
    lines.orderBy(key).select("line").write.mode("overwrite").option("compression", "gzip").text(path)
    return digest(lines, "line")


def digest(rows: DataFrame, column: str) -> dict:
    """Rows and a digest of a column's values in any order: the sum of the first 15 hexadecimal digits of their SHA-256, as a decimal."""
    part = F.conv(F.substring(F.sha2(column, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    n, total = rows.agg(F.count("*"), F.sum(part)).first()
    return {"rows": n, "digest": str(total or 0)}


def write_keys(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Identifiers alone, rows without any left out."""
    write_rows(rows.select(*columns).where(F.coalesce(*columns).isNotNull()).distinct(), path)
