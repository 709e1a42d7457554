"""Tables in versions: a load appears as a whole or not at all, and readers never see a half-written one.

Below a table's folder, ``versions/<name>`` holds the files of each version and ``pointers/<number>`` one line of JSON that
names the version and says its rows and schema. The pointer with the greatest number is the table. A pointer is
written aside and renamed to a number that must not exist, so of two writers one fails and none is lost.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VERSIONS, POINTERS = "versions", "pointers"
_DIGITS = 12


class PublishConflict(RuntimeError):
    """Another writer has published since this one began."""


class IncompleteVersion(RuntimeError):
    """A version does not hold the rows that were written to it."""


@dataclass(frozen=True)
class Version:
    """A published version: its number, folder, format, rows and schema."""

    number: int
    folder: str
    fmt: str
    rows: int
    schema: str


class _Folder:
    """A folder of any file system that Spark reaches, through Hadoop's classes."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop, self.jvm = spark._jvm.org.apache.hadoop.fs, spark._jvm
        self.root = self.hadoop.Path(path)
        self.conf = spark._jsc.hadoopConfiguration()
        self.system = self.root.getFileSystem(self.conf)

    def at(self, name: str):
        return self.hadoop.Path(self.root, name)

    def names(self) -> list[str]:
        if not self.system.exists(self.root):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.root))

    def write(self, name: str, text: str, overwrite: bool = True) -> None:
        """A small file, whole or not at all; without ``overwrite``, FileExistsError where there is one of that name."""
        draft = self.at(f"_draft-{uuid.uuid4().hex}")
        out = self.system.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            self._rename(draft, name, overwrite)
        except Py4JJavaError as e:
            kind = e.java_exception.getClass().getName()
            if "UnsupportedFileSystemException" in kind and self._rename_plainly(draft, name, overwrite):
                return
            self.system.delete(draft, False)
            if "FileAlreadyExistsException" in kind or "UnsupportedFileSystemException" in kind:
                raise FileExistsError(name) from e
            raise

    def _rename(self, draft, name: str, overwrite: bool) -> None:
        renames = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        kinds = self.jvm.java.lang.reflect.Array.newInstance(renames.NONE.getClass(), 1)
        kinds[0] = renames.OVERWRITE if overwrite else renames.NONE
        home, here = self.system.getUri(), self.system.getWorkingDirectory()
        context = self.hadoop.FileContext.getFileContext(home, self.conf)
        context.rename(draft.makeQualified(home, here), self.at(name).makeQualified(home, here), kinds)

    def _rename_plainly(self, draft, name: str, overwrite: bool) -> bool:
        """For file systems that Hadoop knows by their older interface alone, whose rename refuses a name that exists."""
        if overwrite:
            self.system.delete(self.at(name), False)
        return not self.system.exists(self.at(name)) and self.system.rename(draft, self.at(name))

    def read(self, name: str) -> str:
        stream = self.system.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.system.delete(self.at(name), True)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file, without a Spark job."""
    folder, _, name = path.rstrip("/").rpartition("/")
    _Folder(spark, folder).write(name, text)


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """The file's text, None where there is none."""
    folder, _, name = path.rstrip("/").rpartition("/")
    found = _Folder(spark, folder)
    return found.read(name) if found.system.exists(found.at(name)) else None


def published_versions(spark: SparkSession, target: str) -> list[Version]:
    """All versions with a pointer, oldest first."""
    folder = _Folder(spark, f"{target.rstrip('/')}/{POINTERS}")
    return [Version(**json.loads(folder.read(n))) for n in folder.names() if n.isdigit()]


def current_version(spark: SparkSession, target: str) -> Version | None:
    folder = _Folder(spark, f"{target.rstrip('/')}/{POINTERS}")
    numbers = [n for n in folder.names() if n.isdigit()]
    return Version(**json.loads(folder.read(numbers[-1]))) if numbers else None


def new_version_folder(target: str) -> str:
    return f"{target.rstrip('/')}/{VERSIONS}/v-{uuid.uuid4().hex}"


def switch_to(spark: SparkSession, target: str, folder: str, rows: int, schema: StructType, fmt: str, seen: Version | None) -> Version:
    """Make a written folder the table, unless another writer has published since ``seen`` was current."""
    version = Version((seen.number if seen else 0) + 1, folder.rpartition("/")[2], fmt, rows, schema.json())
    pointers = _Folder(spark, f"{target.rstrip('/')}/{POINTERS}")
    try:
        pointers.write(f"{version.number:0{_DIGITS}d}", json.dumps(asdict(version)), overwrite=False)
    except FileExistsError as e:
        raise PublishConflict(f"{target} has a version {version.number} already") from e
    return version


def publish_version(df: DataFrame, target: str, fmt: str = "parquet", expected_rows: int | None = None, max_records_per_file: int = 0) -> Version:
    """Write a frame as a new version of ``target`` and switch readers to it.

    Rows are counted by the write itself, then in the files (their footers, for Parquet), and held against each
    other and against ``expected_rows``. Whatever fails before the switch leaves the table as it was; what was
    written until then stays in a folder without a pointer, which ``remove_old_versions`` clears.
    """
    spark = df.sparkSession
    seen, folder = current_version(spark, target), new_version_folder(target)
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt).option("maxRecordsPerFile", max_records_per_file).save(folder)
    wrote = counted.get["rows"]
    verify_rows(spark, folder, fmt, df.schema, wrote if expected_rows is None else expected_rows)
    return switch_to(spark, target, folder, wrote, df.schema, fmt, seen)


def verify_rows(spark: SparkSession, folder: str, fmt: str, schema: StructType, rows: int) -> None:
    found = spark.read.schema(schema).format(fmt).load(folder).count()
    if found != rows:
        raise IncompleteVersion(f"{folder} holds {found} rows, not {rows}")


def read_published(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The current version of a table, or that of a number. A frame keeps its version when another is published later."""
    versions = published_versions(spark, target) if number is not None else [current_version(spark, target)]
    chosen = next((v for v in versions if v and number in (None, v.number)), None)
    if chosen is None:
        raise FileNotFoundError(f"{target} has no version{'' if number is None else f' {number}'}")
    schema = StructType.fromJson(json.loads(chosen.schema))
    return spark.read.schema(schema).format(chosen.fmt).load(f"{target.rstrip('/')}/{VERSIONS}/{chosen.folder}")


def restore_version(spark: SparkSession, target: str, number: int) -> Version:
    """Make an older version current again, under a new number; no rows are copied."""
    versions = published_versions(spark, target)
    old = next((v for v in versions if v.number == number), None)
    if old is None:
        raise FileNotFoundError(f"{target} has no version {number}")
    schema = StructType.fromJson(json.loads(old.schema))
    return switch_to(spark, target, old.folder, old.rows, schema, old.fmt, versions[-1])


def remove_old_versions(spark: SparkSession, target: str, keep: int = 1) -> list[str]:
    """Remove all but the last ``keep`` versions and folders that never became one; returns the folders removed.

    Never called by the library: frames read earlier, and a load that is still writing, lose their files.
    """
    if keep < 1:
        raise ValueError("keep at least the current version")
    versions = published_versions(spark, target)
    kept = {v.folder for v in versions[-keep:]}
    pointers, folders = _Folder(spark, f"{target.rstrip('/')}/{POINTERS}"), _Folder(spark, f"{target.rstrip('/')}/{VERSIONS}")
    for version in versions[:-keep]:
        pointers.remove(f"{version.number:0{_DIGITS}d}")
    gone = [name for name in folders.names() if name not in kept]
    for name in gone:
        folders.remove(name)
    return gone
