"""A log of versions under one root: what readers see changes by one file that is published whole or not at all.

Data go to folders of their own names; version v is the file ``_log/v``, which says where they are. A commit has two
phases: the entry is written and closed under a private name, then published under its version by a step that fails if
that name is taken: a hard link on a local or mounted file system, a rename with ``Rename.NONE`` elsewhere, a conditional
put on ``CONDITIONAL_PUT`` stores (where a rename is no single step). So of writers of the same version one succeeds, also
if they race, and a reader sees no entry before it has its content. A writer that is lost leaves private files and folders
that no entry names (``sweep`` removes the former).

An entry says its own version. One that is torn or foreign (no such content: half a file of another program, a copied
name) stands for nothing: readers pass over it to the version before, writers go on with the next free number.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import SparkSession

PRIVATE = ".private-"
#: Schemes whose store creates a file on condition that it is absent, in the step that makes it visible.
CONDITIONAL_PUT = ("s3a",)


class StaleVersion(RuntimeError):
    pass


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """All numbers that are taken, by an entry or by something that is none."""
    fs, p = _files(spark, f"{root}/_log")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()) if fs.exists(p) else []


def _read(spark: SparkSession, root: str, version: int) -> dict | None:
    """The content of a version; None if the file is torn or says another version."""
    fs, p = _files(spark, f"{root}/_log/{version:020d}")
    stream = fs.open(p)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:
        return None
    finally:
        stream.close()
    return found["content"] if isinstance(found, dict) and found.get("version") == version and isinstance(found.get("content"), dict) else None


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that the log has, in order."""
    return [v for v in _numbers(spark, root) if _read(spark, root, v) is not None]


def latest(spark: SparkSession, root: str, at_most: int | None = None) -> tuple[int, dict]:
    """The highest version (up to ``at_most``) and its content; (0, {}) if there is none. One entry is read, but for torn ones."""
    for v in reversed(_numbers(spark, root)):
        if (at_most is None or v <= at_most) and (content := _read(spark, root, v)) is not None:
            return v, content
    return 0, {}


def entry(spark: SparkSession, root: str, version: int) -> dict:
    """What the log says of a version."""
    if (found := _read(spark, root, version)) is None:
        raise ValueError(f"version {version} of {root} is torn or foreign")
    return found


def next_version(spark: SparkSession, root: str) -> int:
    """The number after all that are taken."""
    return max(_numbers(spark, root), default=0) + 1


def _taken(e: Py4JError) -> bool:
    return any(x in str(e) for x in ("already exists", "AlreadyExists", "FileExists"))


def _write(stream, data: bytes) -> None:
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def prepare(spark: SparkSession, root: str, version: int, content: dict) -> str:
    """First phase: the entry under a private name, whole and closed; the name."""
    name = f"{root}/_log/{PRIVATE}{version}-{uuid.uuid4().hex}"
    fs, p = _files(spark, name)
    _write(fs.create(p, False), json.dumps({"version": version, "content": content}).encode())
    return name


def publish_prepared(spark: SparkSession, root: str, version: int, private: str) -> None:
    """Second phase: the private entry becomes the version, unless it is there."""
    sc = spark.sparkContext
    jvm = sc._jvm
    fs, source = _files(spark, private)
    _, target = _files(spark, f"{root}/_log/{version:020d}")
    scheme = fs.getUri().getScheme()
    try:
        if scheme == "file":
            local = [jvm.java.nio.file.Paths.get(x.toUri().getPath(), sc._gateway.new_array(jvm.java.lang.String, 0)) for x in (target, source)]
            jvm.java.nio.file.Files.createLink(*local)
        elif scheme in CONDITIONAL_PUT:
            stream = fs.open(source)
            data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
            stream.close()
            _write(fs.createFile(target).must("fs.option.create.conditional.overwrite", "true").build(), data)
        else:
            none = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration()).rename(source, target, none)
            return
    except Py4JJavaError as e:
        fs.delete(source, False)
        if _taken(e):
            raise StaleVersion(f"version {version} is there already") from e
        raise
    fs.delete(source, False)


def add_entry(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Make ``content`` that version, unless it is there."""
    publish_prepared(spark, root, version, prepare(spark, root, version, content))


def sweep(spark: SparkSession, root: str, older_than: float = 24 * 3600) -> int:
    """Remove private entries of lost writers that are older than so many seconds; their number."""
    fs, p = _files(spark, f"{root}/_log")
    before, gone = (time.time() - older_than) * 1000, 0
    for s in fs.listStatus(p) if fs.exists(p) else []:
        if s.getPath().getName().startswith(PRIVATE) and s.getModificationTime() <= before:
            gone += fs.delete(s.getPath(), False)
    return gone


def new_folder(root: str, name: str) -> str:
    """A path under ``root`` that nobody else writes to."""
    return f"{root}/{name}-{uuid.uuid4().hex}"
