"""Which chunks of a stored log are committed.

``manifest/<version>.json`` lists, for every committed chunk, the folder of the attempt that wrote it and a
few totals. A writer puts all tables of a chunk into folders of a new attempt and then adds the next
version by one atomic rename that fails if that version is there. Readers start from the newest
version, or from one they name, and read its folders only: a write that stopped half-way, or one that
is going on, is never seen, and of two writers that start from one version the second fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentWriteError(RuntimeError):
    """Another writer has committed in the meantime."""


@dataclass(frozen=True)
class Chunk:
    """A committed chunk: the attempt that wrote it, and totals that readers plan with."""

    attempt: str
    width: int
    n_events: int = 0
    n_streams: int = 0
    n_logtypes: int = 0
    top_logtype: int = -1
    logtype_bytes: int = 0


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    chunks: dict[int, Chunk] = field(default_factory=dict)
    #: Attempts that closed streams of the log on their own.
    closings: tuple[str, ...] = ()

    def with_chunk(self, number: int, chunk: Chunk) -> Manifest:
        return replace(self, chunks=self.chunks | {number: chunk})

    def with_closing(self, attempt: str) -> Manifest:
        return replace(self, closings=(*self.closings, attempt))

    def before(self, number: int) -> Manifest:
        return replace(self, chunks={n: c for n, c in self.chunks.items() if n < number})

    @property
    def logtype_bytes(self) -> int:
        return sum(c.logtype_bytes + 64 * c.n_logtypes for c in self.chunks.values())


def new_attempt() -> str:
    return f"a{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def _file(path: str, version: int) -> str:
    return f"{path}/manifest/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions of a log, oldest first."""
    fs, folder = _located(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(("_", ".")))


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The newest manifest, or that of ``version``; an empty one where nothing is committed."""
    known = versions(spark, path)
    if version is None:
        if not known:
            return Manifest()
        version = known[-1]
    elif version == 0:
        return Manifest()
    elif version not in known:
        raise ValueError(f"{path} has no version {version}")
    fs, file = _located(spark, _file(path, version))
    stream = fs.open(file)
    try:
        content = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    chunks = {int(n): Chunk(**c) for n, c in content["chunks"].items()}
    return Manifest(version, chunks, tuple(content["closings"]))


def commit(spark: SparkSession, path: str, changed: Manifest) -> Manifest:
    """Make ``changed``, derived from the version it names, the next version."""
    following = replace(changed, version=changed.version + 1)
    content = {"chunks": {n: vars(c) for n, c in following.chunks.items()}, "closings": list(following.closings)}
    fs, draft = _located(spark, f"{path}/manifest/_{new_attempt()}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, jvm.org.apache.hadoop.fs.Path(_file(path, following.version)), no_overwrite)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass()):
            raise ConcurrentWriteError(f"version {following.version} of {path} was committed by another writer") from error
        raise
    return following


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this writer has made for itself."""
    fs, folder = _located(spark, path)
    fs.delete(folder, True)


def remove_uncommitted(spark: SparkSession, path: str, keep_versions: int = 1) -> int:
    """Delete attempts that none of the newest ``keep_versions`` manifests names; say how many folders went.

    For use while nobody writes: an attempt that is going on is not committed either.
    """
    kept = [read_manifest(spark, path, v) for v in versions(spark, path)[-keep_versions:]]
    named = {c.attempt for m in kept for c in m.chunks.values()} | {a for m in kept for a in m.closings}
    fs, root = _located(spark, path)
    removed = 0
    for pattern in ("*/chunk=*/attempt=*", "closed/attempt=*", "staging/attempt=*"):
        for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")) or []:
            if status.getPath().getName().removeprefix("attempt=") not in named:
                removed += bool(fs.delete(status.getPath(), True))
    return removed
