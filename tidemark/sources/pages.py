"""The raw layer: JSON pages below <root>/<entity>/year=/month=/day=/."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.functions.columns import page_path
from tidemark.operators.paging import assign_pages, page_bounds
from tidemark.session import shared_dir, there
from tidemark.spec import EntitySpec

# Fixed pattern: a page is named <cursor>_<offset>, as a file or as a folder.
PAGE_NAME = r"/(?:page=)?(-?\d+)_(\d+)(?:\.json)?(?:/[^/]*)?$"

ARRIVAL = ("_cursor", "_offset")


def loose_schema(spec: EntitySpec) -> T.StructType:
    """Every field as text: a value of a wrong type neither hides its record nor turns null unseen."""
    names = [spec.source_names.get(f.name, f.name) for f in spec.schema]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def with_arrival(frame: DataFrame, spec: EntitySpec, *keep: Column) -> DataFrame:
    """Declared names plus the cursor and offset of the page a record came in."""
    path = F.col("_metadata.file_path")
    return frame.select(
        *[F.col(spec.source_names.get(f, f)).alias(f) for f in spec.fields],
        *[
            F.regexp_extract(path, PAGE_NAME, i + 1).try_cast("long").alias(name)
            for i, name in enumerate(ARRIVAL)
        ],
        path.alias("_file"),
        *keep,
    )


def scan_pages(
    spark: SparkSession, spec: EntitySpec, paths: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Records of landed pages, untyped. A path that does not exist is an error."""
    if not paths:
        return spark.createDataFrame([], loose_schema(spec))
    reader = (
        spark.read.schema(loose_schema(spec))
        .option("ignoreMissingFiles", "false")
        .option("multiLine", str(multi_line).lower())
    )
    return with_arrival(reader.json(paths), spec)


def scan_refs(spark: SparkSession, spec: EntitySpec, root: str, refs: DataFrame) -> DataFrame:
    """Records of the pages named by ``refs`` (cursor_value, offset_value, created_at).

    Every page is opened by its name, so only the named files are listed and read, and one that is
    not there is an error. The driver holds one path per page.
    """
    path = page_path(spec.path.strip("/"), F.col("created_at"), F.col("cursor_value"), F.col("offset_value"))
    return scan_pages(spark, spec, [f"{root}/{r.path}" for r in refs.select(path.alias("path")).distinct().collect()])


def list_pages(spark: SparkSession, *folders: str) -> DataFrame:
    """Paths of all landed files below folders; file contents are not read."""
    if not folders:
        return spark.createDataFrame([], "path string")
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(folders)).select("path")
    )


def list_days(spark: SparkSession, root: str, refs: DataFrame) -> DataFrame:
    """Paths of the landed files of the days that ``refs`` (path) name; other days are not listed."""
    day = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    days = [f"{root}/{r.day}" for r in refs.select(day.alias("day")).distinct().collect()]
    return list_pages(spark, *[d for d in days if there(spark, d)])


def missing_pages(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Referenced pages without a file. ``refs`` has ``path``, relative to any root.

    A page may be a file or a folder of files, so both sides are reduced to
    day and page name.
    """
    key = r"([^/]+/year=\d+/month=\d+/day=\d+/)(?:page=)?(-?\d+_\d+)"
    label = lambda c: F.concat(F.regexp_extract(c, key, 1), F.regexp_extract(c, key, 2))
    present = files.select(label(F.col("path")).alias("_page")).distinct()
    return refs.withColumn("_page", label(F.col("path"))).join(present, "_page", "left_anti").drop("_page")


def require_pages(refs: DataFrame, files: DataFrame, spec: EntitySpec) -> None:
    """Raise if a logged page has no file, naming the first five."""
    missing = missing_pages(refs, files)
    shown = [r.path for r in missing.orderBy("path").limit(6).collect()]
    if shown:
        more = " ..." if len(shown) > 5 else ""
        raise FileNotFoundError(f"pages of {spec.name} are logged but missing: {shown[:5]}{more}")


def page_format(fields: str) -> type[DataSource]:
    """Sink for (page, ``fields`` as JSON text): one file per page, under the name of the page.

    Rows of a page come together. A file is written under a name that readers pass over and moved to
    its own when it is whole, so a page that is landed again is replaced in one step, a retried task
    writes the same file again, and no reader sees half a page. The class is defined in here so that
    workers get it by value and need not have this package.
    """

    class PageWriter(DataSourceArrowWriter):
        def __init__(self, folder: str):
            self.folder = folder

        def write(self, batches):
            import uuid

            import pyarrow.fs
            from pyspark import TaskContext

            files, base = pyarrow.fs.FileSystem.from_uri(self.folder)
            done, name, out, draft = [], None, None, None

            def close():
                if out is not None:
                    out.close()
                    files.move(draft, f"{base}/{name}")
                    done.append(name)

            for batch in batches:
                for page, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if page != name:
                        close()
                        name = page
                        day = f"{base}/{page}".rpartition("/")[0]
                        files.create_dir(day, recursive=True)
                        draft = f"{day}/_{uuid.uuid4().hex}"
                        out = files.open_output_stream(draft)
                    out.write(line.encode() + b"\n")
            close()
            message = PageFiles()
            message.names = done
            message.task = TaskContext.get().partitionId() if TaskContext.get() else 0
            return message

        def commit(self, messages):
            names = [n for m in messages if m is not None for n in m.names]
            if len(set(names)) != len(names):
                raise RuntimeError("two tasks wrote one page: rows of a page have to come together")

        def abort(self, messages):
            """Whole pages stay: landing them again replaces them."""

    class PageFiles(WriterCommitMessage):
        names: list[str]
        task: int

    class PageFormat(DataSource):
        @classmethod
        def name(cls):
            return "tidemark_pages"

        def schema(self):
            return fields

        def writer(self, schema, overwrite):
            return PageWriter(self.options["path"])

    return PageFormat


def land_pages(
    frame: DataFrame, spec: EntitySpec, root: str, ingested_at: datetime, since: int = 0
) -> DataFrame:
    """Write a delta as pages and return the page table (cursor, offset, records, ...).

    One file per page, ``year=/month=/day=/<cursor>_<offset>.json``; landing the same delta on the
    same day again replaces its pages.
    """
    spark = frame.sparkSession
    shared_dir(spark)
    paged = assign_pages(frame, spec)
    # One small row per page, written once: it names the files and is returned.
    bounds = page_bounds(paged, spec, since).checkpoint()
    name = page_path(spec.path.strip("/"), F.lit(ingested_at), F.col("cursor"), F.col("offset"))
    labels = bounds.select("page_no", name.alias("page"))
    record = [F.col(f).alias(spec.source_names.get(f, f)) for f in spec.fields if f in frame.columns]
    schema = "page string, record string"
    spark.dataSource.register(page_format(schema))
    (
        paged.join(labels, "page_no")
        .repartition("page")
        .sortWithinPartitions("page", "_rank")
        .select("page", F.to_json(F.struct(*record)).alias("record"))
        .write.format("tidemark_pages")
        .mode("append")
        .save(root)
    )
    return bounds
