"""A table that is always readable: builds are written beside each other, one small pointer names the
build that counts, and a build rewrites only the months that differ from the one before.

``<path>/data/build=<id>/year=/month=`` holds rows, ``<path>/manifests/<id>`` says which folder holds each
month of a build, and the largest number under ``<path>/current`` names the build that readers see.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, ShortType, StructField, StructType

PARTITIONS = ("year", "month")
MANIFEST = "year int, month int, rows long, digest string, folder string"


class Folder:
    """The few file operations that publishing needs, on whatever store the path is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        root = self._at("")
        self.files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self.files.listStatus(at)) if self.files.exists(at) else []

    def create(self, name: str, text: str) -> None:
        """A new file; one that is there already is an error, so of two writers one fails."""
        out = self.files.create(self._at(name), False)
        try:
            out.writeBytes(text)
        finally:
            out.close()

    def text(self, name: str) -> str:
        stream = self.files.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.files.delete(self._at(name), True)


def _pointers(folder: Folder) -> list[tuple[int, dict]]:
    """(number, what it says) of every complete pointer, the oldest first. One whose writer hasn't
    finished is empty and doesn't count yet."""
    found = [(int(n), folder.text(f"current/{n}")) for n in folder.names("current") if n.isdigit()]
    return [(n, json.loads(text)) for n, text in found if text.endswith("}")]


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(_pointers(Folder(spark, path)))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The months of the build that counts: rows, digest, and the folder that holds them."""
    pointers = _pointers(Folder(spark, path))
    if not pointers:
        raise FileNotFoundError(f"nothing is published under {path}")
    return spark.read.schema(MANIFEST).json(f"{path}/manifests/{pointers[-1][1]['build']}")


def month_digests(df: DataFrame) -> DataFrame:
    """``(year, month, rows, digest)``: the digest is the same for the same rows in any order, and
    counts repeated rows. It combines map-side, so a large month costs a row per task."""
    names = sorted(c for c in df.columns if c not in PARTITIONS)
    kinds = F.lit(",".join(f"{n}:{df.schema[n].dataType.simpleString()}" for n in names))
    # a null is told from the next column's value by its own mark
    row = F.xxhash64(kinds, *[F.col(n) for n in names], *[F.col(n).isNull() for n in names])
    mark = F.xxhash64(row, F.lit(1))
    return df.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(mark).alias("_x"), F.sum(row.cast("decimal(38,0)")).alias("_s")).select(
        *[F.col(c).cast("int").alias(c) for c in PARTITIONS], "rows", F.concat_ws(":", F.hex("_x"), F.col("_s").cast("string")).alias("digest")
    )


def _among(months: list[tuple[int, int]]) -> Column:
    return (F.col("year").cast("int") * 100 + F.col("month").cast("int")).isin([y * 100 + m for y, m in months])


def publish(df: DataFrame, path: str, *, keep: int = 2, rows_per_file: int = 5_000_000) -> DataFrame:
    """Make ``df`` (with its year and month) the table under ``path``; returns ``(year, month, rows, state)``
    with state ``new``, ``changed``, ``kept`` or ``stale``.

    Months whose digest is that of the present build keep their folder; only others are written, to a
    folder of this build. Readers see the old build until the pointer to the new one is there, so a
    build that fails half-way changes nothing for them. Then the folders that none of the last
    ``keep`` builds uses go; a reader that began on an older one has that long to finish.
    """
    spark, folder = df.sparkSession, Folder(df.sparkSession, path)
    pointers = _pointers(folder)
    old = {(r["year"], r["month"]): r for r in manifest(spark, path).collect()} if pointers else {}
    wanted = {(r["year"], r["month"]): r for r in month_digests(df).collect()}
    state = {k: "kept" if k in old and old[k]["digest"] == r["digest"] else "changed" if k in old else "new" for k, r in wanted.items()}
    stale = [k for k in old if k not in wanted]
    written = [k for k, s in state.items() if s != "kept"]
    if written or stale or not pointers:
        build = uuid.uuid4().hex
        if written:
            _write(df.where(_among(written)), f"{path}/data/build={build}", rows_per_file)
        rows = [(*k, r["rows"], r["digest"], old[k]["folder"] if state[k] == "kept" else f"data/build={build}/year={k[0]}/month={k[1]}") for k, r in wanted.items()]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{path}/manifests/{build}")
        number = pointers[-1][0] + 1 if pointers else 1
        columns = df.drop(*PARTITIONS).schema.jsonValue()
        folder.create(f"current/{number:012d}", json.dumps({"build": build, "columns": columns}))
        _clean(spark, path, folder, keep)
    report = [(*k, r["rows"], state[k]) for k, r in wanted.items()] + [(*k, 0, "stale") for k in stale]
    return spark.createDataFrame(report, "year int, month int, rows long, state string")


def _write(df: DataFrame, path: str, rows_per_file: int) -> None:
    (
        df.hint("rebalance", *PARTITIONS)
        .write.option("compression", "snappy").option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def _folders(spark: SparkSession, path: str, build: str) -> set[str]:
    return {r["folder"] for r in spark.read.schema(MANIFEST).json(f"{path}/manifests/{build}").collect()}


def _clean(spark: SparkSession, path: str, folder: Folder, keep: int) -> None:
    """Forget all builds but the last ``keep``, and delete the months that only forgotten ones use."""
    pointers = _pointers(folder)
    used = set().union(*(_folders(spark, path, says["build"]) for _, says in pointers[-keep:]))
    for number, says in pointers[:-keep]:
        gone = _folders(spark, path, says["build"]) - used
        for name in gone:
            folder.delete(name)
        for build in {name.split("/year=")[0] for name in gone}:
            if not any(folder.names(f"{build}/{y}") for y in folder.names(build) if y.startswith("year=")):
                folder.delete(build)
        folder.delete(f"current/{number:012d}")
        folder.delete(f"manifests/{says['build']}")


def remove_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Delete what builds that never were published have left, and say which; only to be called while no
    build is running."""
    folder = Folder(spark, path)
    builds = {says["build"] for _, says in _pointers(folder)}
    used = {f.split("/year=")[0] for b in builds for f in _folders(spark, path, b)}
    left = [f"data/{n}" for n in folder.names("data") if f"data/{n}" not in used]
    left += [f"manifests/{n}" for n in folder.names("manifests") if n not in builds and not n.startswith(".")]
    for name in left:
        folder.delete(name)
    return left


def read_published(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The rows of the build that counts, with their year and month; ``since`` (a date) opens the
    folders of its month and later ones only. What is read stays the same if another build follows."""
    pointers = _pointers(Folder(spark, path))
    if not pointers:
        raise FileNotFoundError(f"nothing is published under {path}")
    says = pointers[-1][1]
    months = spark.read.schema(MANIFEST).json(f"{path}/manifests/{says['build']}").collect()
    if since is not None:
        first = int(since[:4]) * 100 + int(since[5:7])
        months = [r for r in months if r["year"] * 100 + r["month"] >= first]
    columns = StructType.fromJson(says["columns"])
    shape = StructType([*columns.fields, StructField("year", ShortType()), StructField("month", ByteType())])
    by_build: dict[str, list[str]] = {}
    for r in months:
        by_build.setdefault(r["folder"].split("/year=")[0], []).append(f"{path}/{r['folder']}")
    out = None
    for build, folders in sorted(by_build.items()):
        part = spark.read.schema(shape).option("basePath", f"{path}/{build}").parquet(*sorted(folders))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], shape) if out is None else out
